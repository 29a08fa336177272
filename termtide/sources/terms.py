"""Snapshots of terms with their digests: pushed where they changed, pulled where they differ.

    path/rows/year=y/term=t        the rows of a term
    path/digests/year=y/term=t     its digest, row count, and when it was fetched and last checked

Rows are swapped by partition and the digest after them: if a run is lost in between, the old digest makes the next one
swap the same rows again. A term whose digest did not change keeps its rows; only its time of check is written. Terms
are never removed, and a null year or term is refused. Digests ignore the order of rows; repeated rows count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.operators.snapshots import pull_changed, snapshot_status, term_digest
from termtide.sources.durable import cut, stored


@dataclass
class TermStore:
    spark: SparkSession
    path: str
    schema: T.StructType
    scope: Sequence[str] = ("year", "term")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").select(*schema.names)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def rows(self, terms: DataFrame | None = None) -> DataFrame:
        """All rows, or those of some terms."""
        rows = self._read("rows", self.schema)
        return rows if terms is None else rows.join(terms.select(*self.scope), list(self.scope), "left_semi")

    def digests(self) -> DataFrame:
        own = [self.schema[c] for c in self.scope]
        return self._read("digests", T.StructType([*own, *T._parse_datatype_string("digest string, n long, fetched_at timestamp, checked_at timestamp").fields]))

    def _swap(self, name: str, df: DataFrame) -> None:
        # a file a term, or several where a term is large
        df.hint("rebalance", *self.scope).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.scope).parquet(f"{self.path}/{name}")

    def push(self, new: DataFrame, now: Column, min_keep: float = 0.9, force: bool = False) -> DataFrame:
        """Store the terms of `new` that are new or changed; (scope, status) of all of them.

        Refused as a whole, with nothing written, if a term holds less than `min_keep` of its stored rows, unless forced.
        """
        if not new.where(" or ".join(f"{c} is null" for c in self.scope)).isEmpty():
            raise ValueError("rows without a term")
        new, was = new.select(*self.schema.names), cut(self.digests())
        own = cut(term_digest(new, self.scope))
        shrunk = own.join(was.select(*self.scope, F.col("n").alias("was")), list(self.scope)).where(F.col("n") < min_keep * F.col("was")).limit(5).collect()
        if shrunk and not force:
            raise ValueError(f"terms shrink too much: {[(*(r[c] for c in self.scope), r['was'], r['n']) for r in shrunk]}")
        status = cut(snapshot_status(own, was, self.scope))
        moved = status.where("status <> 'unchanged'")
        self._swap("rows", new.join(moved.select(*self.scope), list(self.scope), "left_semi"))
        fetched = F.when(F.col("status") == "unchanged", F.col("fetched_at")).otherwise(now)
        counted = status.join(own.select(*self.scope, "n"), list(self.scope)).join(was.select(*self.scope, "fetched_at"), list(self.scope), "left")
        self._swap("digests", counted.select(*self.scope, "digest", "n", fetched.alias("fetched_at"), now.alias("checked_at")))
        return status.select(*self.scope, "status")

    def pull(self, remote: TermStore, now: Column, max_age_hours: float, targets: DataFrame | None = None) -> DataFrame:
        """Take over the remote's terms whose digests differ from ours; (scope, action, stale) of each target.

        What was read must have the digest that the remote gives for it: a remote that is just being written to is
        refused, and nothing of ours is changed. Our other terms, and terms the remote lacks, stay as they are.
        """
        theirs = cut(remote.digests())
        targets = theirs.select(*self.scope) if targets is None else targets
        out = cut(pull_changed(theirs, self.digests(), targets, now, max_age_hours, self.scope))
        wanted = out.where("action = 'apply'").select(*self.scope)
        rows = stored(remote.rows(wanted))
        told = theirs.join(wanted, list(self.scope), "left_semi")
        torn = told.join(term_digest(rows, self.scope).select(*self.scope, F.col("digest").alias("read")), list(self.scope), "left")
        torn = torn.where(~F.col("digest").eqNullSafe(F.col("read"))).limit(5).collect()
        if torn:
            raise ValueError(f"rows do not have the digest of their term: {[tuple(r[c] for c in self.scope) for r in torn]}")
        self._swap("rows", rows)
        self._swap("digests", told)
        return out
