"""Substring search by posting lists: for every three letters, the texts that hold them, and for each text its rows.

    path/shard=s          (field, gram, block, ids), sorted by field and gram: hashes of texts; the gram decides on the shard
    path.rows/shard=s     (field, code, scope, id), sorted by field and hash of text, which decides on the shard

A text is indexed once, however many rows have it. A search reads the lists of its words' grams alone, by shard, field
and gram, intersects them block by block, looks up the rows of the texts that are left, and then checks these: grams may
stand in another order, and hashes may meet. Blocks part the texts of a gram that very many hold, so that no list grows
with the table. Case is ignored as `lower` does. Words of fewer than three letters have no gram: they are no condition
here, and the check alone decides. Null texts hold nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.operators import catalog
from termtide.sources.durable import stored

GRAM, SHARDS = 3, 16


def _grams(text):
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.substring(text, i, F.lit(GRAM))))


def _shard(code: str):
    return F.pmod(code, F.lit(SHARDS)).cast("int").alias("shard")


@dataclass
class Postings:
    spark: SparkSession
    path: str
    schema: T.StructType
    id_col: str = "class_id"
    scope: Sequence[str] = ("year", "term")

    def build(self, df: DataFrame, fields: Sequence[str], block_rows: int = 10_000) -> None:
        """Index some text columns; block_rows: texts of a list, about, at most."""
        text = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.lower(F.col(f).cast("string")).alias("text")) for f in fields)))
        rows = df.select(*self.scope, F.col(self.id_col).alias("id"), text.alias("t")).where(F.length("t.text") >= GRAM).select(*self.scope, "id", "t.*", F.xxhash64("t.text").alias("code"))
        texts = stored(rows.select("field", "text", "code").distinct())
        blocks = max(1, -(-texts.count() // block_rows))
        grams = texts.select("field", "code", F.explode(_grams(F.col("text"))).alias("gram"), F.pmod("code", F.lit(blocks)).alias("block"))
        lists = grams.groupBy("field", "gram", "block").agg(F.array_sort(F.collect_set("code")).alias("ids")).withColumn("shard", F.pmod(F.hash("gram"), F.lit(SHARDS)))
        lists.hint("rebalance", "shard").sortWithinPartitions("shard", "field", "gram").write.mode("overwrite").partitionBy("shard").parquet(self.path)
        own = rows.select("field", "code", *self.scope, "id", _shard("code"))
        own.hint("rebalance", "shard").sortWithinPartitions("shard", "field", "code").write.mode("overwrite").partitionBy("shard").parquet(f"{self.path}.rows")

    def candidates(self, contains: dict[str, str], equal: dict[str, object] | None = None) -> DataFrame | None:
        """Ids of the rows that hold all grams of each field's word; None if no word has a gram."""
        out, own_id = None, self.schema[self.id_col].dataType
        scope = [self.schema[c] for c in self.scope]
        lists_schema = "field string, gram string, block long, ids array<long>, shard int"
        rows_schema = T.StructType([T.StructField("field", T.StringType()), T.StructField("code", T.LongType()), *scope, T.StructField("id", own_id), T.StructField("shard", T.IntegerType())])
        for field, word in contains.items():
            one = self.spark.range(1).select(F.lower(F.lit(word)).alias("w"))
            grams = one.where(F.length("w") >= GRAM).select(F.explode(_grams(F.col("w"))).alias("g")).select("g", F.pmod(F.hash("g"), F.lit(SHARDS)).alias("s")).collect()
            if not grams:
                continue
            lists = self.spark.read.schema(lists_schema).parquet(self.path).where(F.col("shard").isin(sorted({r["s"] for r in grams})) & (F.col("field") == field) & F.col("gram").isin([r["g"] for r in grams]))
            met = lists.groupBy("block").agg(F.collect_list("ids").alias("lists")).where(F.size("lists") == len(grams))
            both = F.aggregate(F.slice("lists", 2, len(grams)), F.get("lists", 0), F.array_intersect)
            texts = met.select(F.explode(both).alias("code")).select("code", _shard("code"))
            rows = self.spark.read.schema(rows_schema).parquet(f"{self.path}.rows").where(F.col("field") == field)
            for c, value in (equal or {}).items():
                if c in self.scope:
                    rows = rows.where(F.col(c) == value)
            own = rows.join(texts, ["shard", "code"], "left_semi").select(F.col("id").alias(self.id_col))
            out = own if out is None else out.join(own, self.id_col, "left_semi")
        return out

    def search(self, classes: DataFrame, slots: DataFrame | None = None, *, equal: dict[str, object] | None = None, contains: dict[str, str] | None = None, **filters) -> DataFrame:
        """The rows that `catalog.search` finds, looked up by their words first."""
        met = self.candidates(contains or {}, equal)
        rows = classes if met is None else classes.join(met.distinct(), self.id_col, "left_semi")
        return catalog.search(rows, slots, equal=equal, contains=contains, **filters)
