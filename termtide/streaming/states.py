"""States of a store's series at past times, kept on disk and rolled forward.

    path/cut=d/state     latest rows of all samples before day d
    path/cut=d/counts    how many samples each of those days held

A state still holds if the store's manifest gives the same counts for the same days, so that telling this reads no
sample: a row that comes late changes the count of its day and, with it, every state cut after that day. A state that is
asked for starts from the newest one that holds and reads only the days since. Where none does, all days are read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.operators import series
from termtide.streaming.store import Store


@dataclass
class States:
    store: Store
    path: str

    def _counts(self) -> dict[dt.date, dict[dt.date, int]]:
        """The counts that each state was cut with."""
        try:
            rows = self.store.spark.read.schema("day date, n long, cut date").option("basePath", self.path).parquet(f"{self.path}/cut=*/counts").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        out: dict[dt.date, dict[dt.date, int]] = {}
        for r in rows:
            own = out.setdefault(r["cut"], {})
            if r["day"]:
                own[r["day"]] = r["n"]
        return out

    def holding(self) -> list[dt.date]:
        """The cuts whose states still hold, oldest first."""
        now = self.store.day_counts()
        return sorted(cut for cut, own in self._counts().items() if own == {d: n for d, n in now.items() if d < cut and n})

    def before(self, day: dt.date) -> tuple[DataFrame, dt.date | None]:
        """The latest rows of all samples before a day, and the cut that they were rolled forward from."""
        rows = self.store.manifest()
        days = sorted(d for d, n in self.store.day_counts(rows).items() if d < day and n)
        start = max((c for c in self.holding() if c <= day), default=None)
        key, metrics = list(self.store.key), self.store.metrics
        later = self.store.samples([d for d in days if start is None or d >= start], rows).drop("day")
        if start is None:
            return series.fold_latest(later, key, metrics), None
        state = self.store.spark.read.schema(self.store.schema).parquet(f"{self.path}/cut={start}/state")
        return (series.fold_incremental(state, later, key, metrics) if any(d >= start for d in days) else state), start

    def at(self, ts: dt.datetime) -> DataFrame:
        """The latest rows of all samples up to a time."""
        state, _ = self.before(ts.date())
        today = self.store.samples([ts.date()]).drop("day").where(F.col("ts") <= F.lit(ts))
        return series.fold_incremental(state, today, list(self.store.key), self.store.metrics)

    def write(self, day: dt.date) -> dt.date | None:
        """Keep the state before a day; returns the cut that it was rolled forward from. A state of that cut that still holds is left as it is."""
        if day in self.holding():
            return day
        counts = [(d, n) for d, n in sorted(self.store.day_counts().items()) if d < day and n] or [(None, 0)]
        state, start = self.before(day)
        # counts are written last: a state without them doesn't count
        state.select(*self.store.columns).write.mode("overwrite").parquet(f"{self.path}/cut={day}/state")
        self.store.spark.createDataFrame(counts, "day date, n long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cut={day}/counts")
        return start
