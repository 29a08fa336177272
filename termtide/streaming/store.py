"""A store of samples that only grows, with a manifest of what was merged, a cursor, and a latest table in buckets.

    path/manifest/seq=n                 one row a merge: who wrote it, counts, cursor, days and buckets it touched
    path/samples/seq=n/day=d            the samples that merge n added
    path/latest/seq=n/bucket=b          the latest rows of the buckets that merge n touched
    path/late/seq=n                     rows behind the watermark, until `merge_late` takes them in
    path/passes/seq=n                   passes, where a source hands them over

The manifest row is written last and makes a merge visible; what a crash leaves before it is overwritten by the next
merge of that number. A batch that its writer repeats is known by its number and skipped, whatever checkpoint another
writer has. Merges read only the days and rewrite only the buckets that their rows touch. One merge at a time.

Rows that repeat (key, time) keep the first that was stored. Rows without a key column or a time are not samples: they
are counted as read and left out. An empty batch is recorded with its writer and changes nothing else. Days are those of
the session's time zone, which must stay the same.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.operators import series
from termtide.sources.durable import cut

MANIFEST = (
    "seq int, kind string, writer string, batch long, cursor timestamp, n_read long, n_inserted long, n_older long, n_late long, "
    "days array<struct<day date, n long>>, buckets array<int>, filled array<int>, n_buckets int, has_late boolean, has_passes boolean, writers array<struct<writer string, batch long>>"
)


@dataclass
class Store:
    """The samples at `path`; buckets: parts of the latest table, fixed by the first merge (thousands for large stores)."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: Sequence[str]
    metrics: Sequence[str] = series.METRICS
    buckets: int = 64
    columns: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.columns = [*self.key, "ts", *self.metrics]
        self.schema = T.StructType([T.StructField(c, self.schema[c].dataType) for c in self.columns])

    # --- reading ---

    def manifest(self) -> list:
        """Rows of the manifest in order, from the last compaction on."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").orderBy("seq").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        packed = [i for i, r in enumerate(rows) if r["kind"] == "compact"]
        return rows[packed[-1] :] if packed else rows

    def _read(self, name: str, folders: list[str], extra: Sequence[T.StructField] = ()) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *extra])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*folders).select(*schema.names)

    def samples(self, days: Sequence[dt.date] | None = None, rows: list | None = None) -> DataFrame:
        """All samples, or those of some days, with their `day`."""
        rows, wanted = self.manifest() if rows is None else rows, None if days is None else set(days)
        folders = [f"{self.path}/samples/seq={r['seq']}/day={d['day']}" for r in rows for d in r["days"] or [] if wanted is None or d["day"] in wanted]
        return self._read("samples", folders, [T.StructField("day", T.DateType())])

    def latest(self, only: Sequence[int] | None = None, rows: list | None = None) -> DataFrame:
        """The latest rows, or those of some buckets."""
        rows, wanted = self.manifest() if rows is None else rows, None if only is None else set(only)
        newest: dict[int, str | None] = {}
        for r in rows:
            filled = set(r["filled"] or [])
            for b in r["buckets"] or []:
                newest[b] = f"{self.path}/latest/seq={r['seq']}/bucket={b}" if b in filled else None
        return self._read("latest", [f for b, f in sorted(newest.items()) if f and (wanted is None or b in wanted)])

    def cursor(self, rows: list | None = None) -> dt.datetime | None:
        """The newest time that any merge has read."""
        return max((r["cursor"] for r in (self.manifest() if rows is None else rows) if r["cursor"]), default=None)

    def day_counts(self, rows: list | None = None) -> dict[dt.date, int]:
        """How many samples each day holds, from the manifest alone."""
        out: dict[dt.date, int] = {}
        for r in self.manifest() if rows is None else rows:
            for d in r["days"] or []:
                out[d["day"]] = out.get(d["day"], 0) + d["n"]
        return out

    def passes(self, scope: Sequence[str], schema: T.StructType, rows: list | None = None) -> DataFrame:
        """Each pass once, as the newest merge that brought it had it."""
        seqs = [r["seq"] for r in (self.manifest() if rows is None else rows) if r["has_passes"]]
        whole = T.StructType([*schema.fields, T.StructField("seq", T.IntegerType())])
        if not seqs:
            return self.spark.createDataFrame([], schema)
        all_ = self.spark.read.schema(whole).option("basePath", f"{self.path}/passes").parquet(*(f"{self.path}/passes/seq={s}" for s in seqs))
        rest = [c for c in schema.names if c not in scope and c != "ts"]
        return all_.groupBy(*scope, "ts").agg(F.max_by(F.struct(*rest), "seq").alias("r")).select(*scope, "ts", "r.*").select(*schema.names)

    # --- merging ---

    def done(self, writer: str, batch: int, rows: list) -> bool:
        """Whether a writer's batch, or a later one of it, was merged."""
        own = [r["batch"] for r in rows if r["writer"] == writer] + [w["batch"] for r in rows for w in r["writers"] or [] if w["writer"] == writer]
        return max(own, default=-1) >= batch

    def merge(self, batch: DataFrame, writer: str, number: int, delay: dt.timedelta | None = None, passes: DataFrame | None = None, kind: str = "merge") -> dict | None:
        """Add a batch's samples, advance the latest rows and the cursor; None if this writer's batch was merged before.

        delay: rows more than this behind the cursor go to the late table. Others meet the stored rows of their days.
        A row older than its series' latest is stored and leaves the latest row as it is.
        """
        rows = self.manifest()
        if self.done(writer, number, rows):
            return None
        seq = rows[-1]["seq"] + 1 if rows else 0
        n_buckets = next((r["n_buckets"] for r in rows if r["n_buckets"]), self.buckets)
        cursor = self.cursor(rows)
        whole = F.lit(True)
        for c in (*self.key, "ts"):
            whole = whole & F.col(c).isNotNull()
        fresh = cut(batch.select(*self.columns).withColumn("day", F.to_date("ts")))
        n_read, newest = fresh.agg(F.count(F.lit(1)), F.max("ts")).first()
        fresh = fresh.where(whole).dropDuplicates([*self.key, "ts"])
        n_late = 0
        if delay is not None and cursor is not None:
            behind = F.col("ts") < F.lit(cursor - delay)
            fresh.where(behind).drop("day").write.mode("overwrite").parquet(f"{self.path}/late/seq={seq}")
            n_late = self._read("late", [f"{self.path}/late/seq={seq}"]).count()
            fresh = fresh.where(~behind)
        days = [r["day"] for r in fresh.select("day").distinct().collect()]
        fresh = fresh.join(self.samples(days, rows).select(*self.key, "ts"), [*self.key, "ts"], "left_anti")
        fresh.write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/samples/seq={seq}")
        new = self._read("samples", [f"{self.path}/samples/seq={seq}"], [T.StructField("day", T.DateType())])
        counts = [{"day": r["day"], "n": r["n"]} for r in new.groupBy("day").agg(F.count(F.lit(1)).alias("n")).orderBy("day").collect()]
        bucket = F.pmod(F.hash(*self.key), F.lit(n_buckets))
        touched = sorted(r["b"] for r in new.select(bucket.alias("b")).distinct().collect())
        old = self.latest(touched, rows)
        n_older = new.join(old.select(*self.key, F.col("ts").alias("_ts")), list(self.key)).where(F.col("ts") < F.col("_ts")).count() if touched else 0
        filled: list[int] = []
        if touched:
            filled = self._write_latest(series.fold_incremental(old, new.drop("day"), list(self.key), self.metrics), seq, n_buckets, len(touched))
        if passes is not None:
            passes.write.mode("overwrite").parquet(f"{self.path}/passes/seq={seq}")
            newest = max((t for t in (newest, passes.agg(F.max("ts")).first()[0]) if t), default=None)
        row = {
            "seq": seq, "kind": kind, "writer": writer, "batch": number, "cursor": max((t for t in (cursor, newest) if t), default=None), "n_read": n_read, "n_inserted": sum(c["n"] for c in counts), "n_older": n_older, "n_late": n_late,
            "days": counts, "buckets": touched, "filled": filled, "n_buckets": n_buckets, "has_late": n_late > 0, "has_passes": passes is not None, "writers": None,
        }
        self._commit(row)
        return row

    def _write_latest(self, latest: DataFrame, seq: int, n_buckets: int, parts: int) -> list[int]:
        """Latest rows by bucket, a file each; the buckets that have any."""
        folder = f"{self.path}/latest/seq={seq}"
        by_bucket = latest.withColumn("bucket", F.pmod(F.hash(*self.key), F.lit(n_buckets)))
        by_bucket.repartition(min(parts, 10_000), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        return sorted(r["bucket"] for r in self._read("latest", [folder], [T.StructField("bucket", T.IntegerType())]).select("bucket").distinct().collect())

    def _commit(self, row: dict) -> None:
        schema = T._parse_datatype_string(MANIFEST)
        self.spark.createDataFrame([tuple(row[f] for f in schema.names)], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/seq={row['seq']}")

    def pull(self, source: DataFrame, writer: str, passes: DataFrame | None = None, everything: bool = False) -> dict | None:
        """Merge what a source has after the cursor, its passes too; with `everything` all of it (to fetch gaps behind the cursor)."""
        rows = self.manifest()
        cursor = None if everything else self.cursor(rows)
        after = lambda df: df if cursor is None else df.where(F.col("ts") > F.lit(cursor))
        number = 1 + max([r["batch"] for r in rows if r["writer"] == writer] + [w["batch"] for r in rows for w in r["writers"] or [] if w["writer"] == writer], default=-1)
        return self.merge(after(source), writer, number, passes=None if passes is None else after(passes))

    def late(self, rows: list | None = None) -> DataFrame:
        """Rows behind the watermark that no merge has taken in yet."""
        rows = self.manifest() if rows is None else rows
        taken = max((r["batch"] for r in rows if r["writer"] == "late"), default=-1)
        taken = max([taken, *(w["batch"] for r in rows for w in r["writers"] or [] if w["writer"] == "late")])
        return self._read("late", [f"{self.path}/late/seq={r['seq']}" for r in rows if r["has_late"] and r["seq"] > taken])

    def merge_late(self) -> dict | None:
        """Take the late table's rows into the store. Their days' counts change, so checkpoints taken after them no longer hold."""
        rows = self.manifest()
        upto = max((r["seq"] for r in rows if r["has_late"]), default=-1)
        return None if upto < 0 else self.merge(self.late(rows), "late", upto, kind="late")

    def compact(self) -> dict | None:
        """Write all live samples and latest rows as one part each, so that later merges list and read few folders."""
        self.merge_late()
        rows = self.manifest()
        if not rows:
            return None
        seq, n_buckets = rows[-1]["seq"] + 1, rows[-1]["n_buckets"]
        all_ = self.samples(rows=rows)
        all_.repartition("day").write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/samples/seq={seq}")
        filled = self._write_latest(self.latest(rows=rows), seq, n_buckets, n_buckets)
        writers: dict[str, int] = {}
        for r in rows:
            for name, number in [(w["writer"], w["batch"]) for w in r["writers"] or []] + [(r["writer"], r["batch"])]:
                writers[name] = max(number, writers.get(name, -1))
        seqs = [r["seq"] for r in rows if r["has_passes"]]
        if seqs:
            held = self.spark.read.option("basePath", f"{self.path}/passes").parquet(*(f"{self.path}/passes/seq={s}" for s in seqs))
            scope = [c for c in self.key if c in held.columns]
            rest = [c for c in held.columns if c not in (*scope, "ts", "seq")]
            held.groupBy(*scope, "ts").agg(F.max_by(F.struct(*rest), "seq").alias("r")).select(*scope, "ts", "r.*").write.mode("overwrite").parquet(f"{self.path}/passes/seq={seq}")
        row = {
            "seq": seq, "kind": "compact", "writer": "compact", "batch": seq, "cursor": self.cursor(rows), "n_read": 0, "n_inserted": 0, "n_older": 0, "n_late": 0,
            "days": [{"day": d, "n": n} for d, n in sorted(self.day_counts(rows).items())], "buckets": list(range(n_buckets)), "filled": filled, "n_buckets": n_buckets, "has_late": False, "has_passes": bool(seqs),
            "writers": [{"writer": w, "batch": b} for w, b in sorted(writers.items()) if w != "compact"],
        }
        self._commit(row)
        return row


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming checkpoint keeps through restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
