"""Writes that a gate decides on: the figures are taken in the pass that writes, and rows show only if the gate holds.

    path/version=n       the rows of attempt n
    path/published/n     what was observed of attempt n, written once its gate held: readers take the newest

A refused or lost attempt leaves rows that no reader sees, and the next attempt of that number overwrites them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.operators.snapshots import check_snapshot

PUBLISHED = "version int, terms array<struct<year int, term string, classes long, tagged long, failed long>>"


@dataclass
class GatedTable:
    spark: SparkSession
    path: str
    schema: T.StructType

    def published(self) -> list:
        """What was observed of each version that readers may have seen, oldest first."""
        try:
            return self.spark.read.schema(PUBLISHED).parquet(f"{self.path}/published/*").orderBy("version").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def read(self) -> DataFrame:
        held = self.published()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={held[-1]['version']}") if held else self.spark.createDataFrame([], self.schema)

    def publish(self, df: DataFrame, terms: Sequence[tuple[int, str]], tagged: Column, failed: Column, min_ratio: float = 0.9, max_failed: float = 0.02) -> dict[tuple[int, str], str]:
        """Write the rows of some terms in one pass and let them show if every term is ok; the verdict of each term.

        Rows where `failed` holds are counted and left out. The gate is `check_snapshot` against the version that shows
        now; a term without a row is `empty`. Rows of other terms are left out.
        """
        held = self.published()
        version = held[-1]["version"] + 1 if held else 0
        wrong = F.coalesce(failed, F.lit(False))
        own = [(F.col("year") == year) & (F.col("term") == term) for year, term in terms]
        seen = Observation(f"gate-{uuid.uuid4().hex}")
        count = lambda *when: F.count_if(F.coalesce(_all(when), F.lit(False)))
        figures = [f for i, o in enumerate(own) for f in (count(o, ~wrong).alias(f"classes{i}"), count(o, ~wrong, tagged).alias(f"tagged{i}"), count(o, wrong).alias(f"failed{i}"))]
        asked = F.lit(False)
        for o in own:
            asked = asked | o
        df.observe(seen, *figures).where(asked & ~wrong).select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/version={version}")
        rows = [(version, [(year, term, *(seen.get[f"{name}{i}"] for name in ("classes", "tagged", "failed"))) for i, (year, term) in enumerate(terms)])]
        told = self.spark.createDataFrame(rows, PUBLISHED)
        before = [(t["year"], t["term"], t["classes"], 0) for t in held[-1]["terms"]] if held else []
        verdicts = check_snapshot(told.select(F.explode("terms").alias("t")).select("t.*"), self.spark.createDataFrame(before, "year int, term string, classes long, missing long"), min_ratio, max_failed)
        out = {(r["year"], r["term"]): r["verdict"] for r in verdicts.collect()}
        if set(out.values()) <= {"ok"}:
            told.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/published/{version}")
        return out


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
