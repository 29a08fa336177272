"""Sharding by histogram sort, in DataFrame operations only.

Law `bytes`: rows are ordered by a key and cut into ranges whose byte sizes are as equal as whole rows
allow. The key is a fixed-width hexadecimal string (id, content hash, position), so its prefixes are
candidate boundaries in key order. Each round counts the exact bytes and rows under every next prefix of
the ranges that hold a target, moves each splitter to the boundary nearest its target, and stops when it
is within the tolerance or a single row is left. One exchange then brings each range together.

Texts of any length count with all their bytes; rows with one id are ordered by content, wholly equal rows by position;
columns besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from termtide.llm.common import cut

WIDTH = 1 + 16 * 3
#: Sorts after every hexadecimal digit.
AFTER = "~"


@dataclass
class Splitter:
    target: float
    tolerance: float
    prefix: str
    key: str = ""
    size: int = 0
    rows: int = 0
    start_size: int = 0
    start_rows: int = 0
    open: bool = True

    def consider(self, key: str, size: int, rows: int) -> None:
        if not self.key or abs(size - self.target) < abs(self.size - self.target):
            self.key, self.size, self.rows = key, size, rows
        if abs(self.size - self.target) <= self.tolerance:
            self.open = False


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def _find(keyed: DataFrame, targets: list[tuple[float, float]], step: int) -> list[Splitter]:
    low, high = keyed.agg(F.min("key"), F.max("key")).first()
    shared = next((i for i, (a, b) in enumerate(zip(low, high, strict=True)) if a != b), WIDTH)
    found = [Splitter(t, tol, low[:shared]) for t, tol in targets]
    for s in found:
        s.consider(low[:shared], 0, 0)
    depth = shared
    while depth < WIDTH and (live := [s for s in found if s.open]):
        deeper = min(WIDTH, depth + step)
        prefixes = sorted({s.prefix for s in live})
        cells = keyed.withColumn("cell", F.substring("key", 1, deeper))
        if depth:
            cells = cells.where(F.substring("key", 1, depth).isin(prefixes))
        got = sorted(tuple(r) for r in cells.groupBy("cell").agg(F.sum("size"), F.count(F.lit(1))).collect())
        names = [g[0] for g in got]
        for s in live:
            i, j = bisect.bisect_left(names, s.prefix), bisect.bisect_left(names, s.prefix + AFTER)
            size, rows = s.start_size, s.start_rows
            for cell, cell_size, cell_rows in got[i:j]:
                s.consider(cell, size, rows)
                if s.target < size + cell_size or cell == names[j - 1]:
                    s.consider(cell + AFTER, size + cell_size, rows + cell_rows)
                    s.prefix, s.start_size, s.start_rows = cell, size, rows
                    s.open = s.open and cell_rows > 1
                    break
                size, rows = size + cell_size, rows + cell_rows
        depth = deeper
    for a, b in zip(found, found[1:], strict=False):
        if b.rows < a.rows:  # both lie within their tolerances of close targets
            b.key, b.size, b.rows = a.key, a.size, a.rows
    return found


def _below(key: Column, splitters: list[Splitter]) -> Column:
    """How many splitters are at or below the key."""
    if not splitters:
        return F.lit(0)
    return sum((F.when(key >= s.key, 1).otherwise(0) for s in splitters), F.lit(0))


def histogram_shards(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
    tolerance: float = 0.0005, rows_per_range: int = 2_000_000, most_ranges: int = 4096,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard): each row's shard, and its place in it.

    Shards larger than `rows_per_range` rows are sorted as several ranges, so that no task sorts a whole
    shard; counts known from the search give each range its first slot. A key that holds many rows is
    split by content hash, and wholly equal rows by position. Null ids sort first; null texts have size 8
    and a null checksum; an empty table gives no rows. Other columns are ignored.
    """
    key = F.concat(F.when(F.col(id_col).isNull(), "0").otherwise("1"),
                   _hex(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).bitwiseXOR(F.lit(-(2**63)))),
                   _hex(F.xxhash64(id_col, text_col)), _hex(F.monotonically_increasing_id()))
    keyed = cut(docs.select(
        F.col(id_col), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"), key.alias("key"),
    ))
    total, rows = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not rows:
        return keyed.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    per = min(max(1, math.ceil(rows / (shards * rows_per_range))), max(1, most_ranges // shards))
    ideal = total / (shards * per)
    targets = [(ideal * j, (tolerance * per if j % per == 0 else 0.05) * ideal) for j in range(1, shards * per)]
    found = _find(keyed, targets, 2 if len(targets) <= 256 else 1)
    first = Splitter(0, 0, "", "", 0, 0)
    outer, starts = found[per - 1 :: per], [first, *found]
    at, shard = F.col("key"), _below(F.col("key"), outer)
    if per > 1:
        inner = F.array(*(F.array(*(F.lit(s.key) for s in found[h * per : h * per + per - 1])) for h in range(shards)))
        part = F.col("shard") * per + F.size(F.filter(inner[F.col("shard")], lambda k: k <= at))
        offsets = F.array(*(F.lit(int(s.rows - starts[i // per * per].rows)).cast("long") for i, s in enumerate(starts)))
    else:
        part, offsets = F.col("shard"), None
    ranged = keyed.withColumn("shard", shard.cast("int")).withColumn("part", part)
    slot = F.row_number().over(Window.partitionBy("part").orderBy("key")).cast("long") - 1
    if offsets is not None:
        slot = slot + offsets[F.col("part")]
    return ranged.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
