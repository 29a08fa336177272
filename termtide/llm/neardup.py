"""Near-duplicate documents: min-max hashing, banding, and exact confirmation on whole shingle sets.

1. Each text becomes its set of five-word shingles. Under each of `VALUES / 2` permutations both the
   smallest and the largest hash are kept, so one evaluation gives two signature values. Sets that are
   equal (size and 128 bits of fingerprint) form one class with one representative.
2. Bands of `ROWS` values bring representatives together. Their number follows from the bar (a similarity
   in percent): a pair at the bar shares no band with probability (1 - bar ** 5) ** bands < 1e-6, which
   takes 24 bands at 0.85 and 36 at 0.80. Within a bucket one byte of each signature value is compared;
   pairs that agree too rarely for the bar (5.5 standard deviations below) part. What remains connected is
   a family.
3. Within families full sets are compared exactly by sparse-to-dense matrix products. Tasks give only links
   that join parts; connected components of those are the result.

A large bucket or family is cut into blocks. Each block meets the group's smallest member first, and only what does not
match it goes on against the other blocks (`graph.group_links`), so copies of one page cost one comparison each.

Null and empty texts, and texts without words, have empty sets and link with nothing. Texts of any length give their
whole set. Repeated rows are copies. Of equally small ids in a component `deduplicate` keeps the row whose text
has the smaller hash. Rows without id join the class of their text and get its component (null if no row of it has an
id); `near_duplicates` never marks them as kept, `deduplicate` keeps one where the component has no id. An empty
table gives no rows; other columns, whatever their names, are ignored (`near_duplicates`) or passed through
(`deduplicate`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import cut, lean, texts
from termtide.llm.graph import components, group_links
from termtide.llm.shingles import U, mix, shingle_sets

ROWS = 5
#: Greatest chance of a pair at the bar to meet in no band.
MISSED = 1e-6
#: Documents of a block, and shingles of a block of full sets.
BLOCK, BLOCK_SHINGLES = 128, 1_000_000
#: Rows of a few numbers (under 100 bytes each) that may be broadcast; beyond it both sides shuffle.
BROADCAST_ROWS = 250_000
PERCENT = 85


@dataclass(frozen=True)
class Bar:
    """What follows from the least similarity of a link: bands, the permutations, and the agreement of sketches."""

    percent: int
    bands: int
    agree: int
    factor: np.ndarray
    offset: np.ndarray

    @property
    def values(self) -> int:
        return ROWS * self.bands


def bar_at(percent: int) -> Bar:
    if not 50 <= percent < 100:
        raise ValueError(f"a bar from 50 to 99 percent is asked for, not {percent}")
    t = percent / 100
    bands = math.ceil(math.log(MISSED) / math.log(1 - t**ROWS))
    bands += bands % 2  # each permutation gives two values
    values = ROWS * bands
    seeds = np.random.default_rng(41)
    factor = seeds.integers(1, 2**63, values // 2, dtype=np.uint64) | U(1)
    offset = seeds.integers(0, 2**63, values // 2, dtype=np.uint64)
    # signature values of a pair at the bar agree less often than this with probability < 1e-7
    return Bar(percent, bands, int(values * (t - 5.5 * (t * (1 - t) / values) ** 0.5)), factor, offset)


def signatures(sizes: np.ndarray, flat: np.ndarray, bar: Bar) -> np.ndarray:
    """Smallest and largest permuted hash of each set that is not empty, side by side."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((len(starts), bar.values), np.uint32)
    for p in range(bar.values // 2):
        h = ((flat * bar.factor[p] + bar.offset[p]) >> U(32)).astype(np.uint32)
        out[:, 2 * p] = np.minimum.reduceat(h, starts)
        out[:, 2 * p + 1] = np.maximum.reduceat(h, starts)
    return out


def _sketch(text_col: str, bar: Bar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc"), batch.column("mark")
            for first, sizes, flat in shingle_sets(texts(batch, text_col)):
                full = sizes > 0
                sums, xors, bands = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64), np.zeros((len(sizes), bar.bands), np.uint64)
                bytes_ = [b""] * len(sizes)
                if full.any():
                    starts = (np.cumsum(sizes) - sizes)[full]
                    sums[full] = np.add.reduceat(mix(flat ^ U(0x5BD1E995)), starts)
                    xors[full] = np.bitwise_xor.reduceat(mix(flat + U(0x2545F4914F6CDD1D)), starts)
                    sig = signatures(sizes, flat, bar)
                    key = np.zeros((len(sig), bar.bands), np.uint64)
                    for r in range(ROWS):
                        key = mix(key + sig[:, r::ROWS].astype(np.uint64) + U(r))
                    bands[full] = mix(key + np.arange(bar.bands, dtype=np.uint64))
                    small = mix(sig.astype(np.uint64)).astype(np.uint8)
                    for at, row in zip(np.flatnonzero(full), small, strict=True):
                        bytes_[at] = row.tobytes()
                n = len(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bar.bands, pa.int32()), pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n), marks.slice(first, n), pa.array(sizes), pa.array(sums.view(np.int64)), pa.array(xors.view(np.int64)), lists, pa.array(bytes_, pa.binary())],
                    ["doc", "mark", "n_shingles", "f1", "f2", "bands", "sketch"],
                )

    return run


def _may_match(bar: Bar):
    """Which representatives of a bucket have sketches that may reach the bar."""

    def match(group: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        rows = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, bar.values)
        a, b = rows[left], rows[right]
        out = np.empty((len(a), len(b)), bool)
        for i, row in enumerate(a):
            out[i] = (b == row).sum(axis=1) >= bar.agree
        return out

    return match


def _match(bar: Bar):
    """Which members of a family reach the bar on full sets."""

    def match(group: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        used = np.union1d(left, right)
        left, right = np.searchsorted(used, left), np.searchsorted(used, right)
        sets = [np.frombuffer(group["shingles"][i], np.uint64) for i in used.tolist()]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1
        keep = shared[column]
        row, column = np.repeat(np.arange(len(sets)), sizes)[keep], (np.cumsum(shared) - 1)[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(left), len(right)), np.float32)
        step = 8192
        for low in range(0, int(shared.sum()), step):
            i, j = np.searchsorted(column, [low, low + step])
            part = np.zeros((len(sets), step), np.float32)
            part[row[i:j], column[i:j] - low] = 1
            both += part[left] @ part[right].T
        union = sizes[left][:, None] + sizes[right][None, :] - both
        return 100 * both.astype(np.float64) >= bar.percent * union.astype(np.float64)

    return match


def _with_sets(text_col: str):
    """Each node's row once a task, with its set in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = []
            for i, node in enumerate(batch.column("node").to_pylist()):
                if node not in seen:
                    seen.add(node)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            kept = batch.select([n for n in batch.schema.names if n != text_col])
            for first, sizes, flat in shingle_sets(texts(batch, text_col)):
                ends = np.cumsum(sizes)
                own = [flat[e - s : e].tobytes() for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                part = kept.slice(first, len(sizes))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own, pa.binary())], [*part.schema.names, "shingles"])

    return run


def _few(df: DataFrame) -> DataFrame:
    """A checkpointed table of a few numbers a row, broadcast up to BROADCAST_ROWS."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _families(classes: DataFrame, bar: Bar) -> DataFrame:
    """(node, component): representatives that sketches connect."""
    rows = classes.select("node", F.explode("bands").alias("bucket"))
    full = cut(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    sketches = classes.select("node", "sketch")
    small = rows.join(full.where(F.col("n") <= BLOCK).select("bucket", blocks), "bucket").join(sketches, "node")
    large = cut(full.where(F.col("n") > BLOCK).select("bucket", blocks))
    large = None if large.isEmpty() else rows.join(_few(large), "bucket").join(sketches, "node")
    return components(group_links(small, large, "bucket", _may_match(bar), BLOCK))


def _linked_rows(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(doc, mark, n_shingles, first) of each row: the hash of its text, and the first row (unnamed, doc, mark) of its component, null for an empty set."""
    bar = bar_at(percent)
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    sketched = cut(plain.mapInArrow(lean(_sketch("text", bar)), "doc long, mark long, n_shingles long, f1 long, f2 long, bands array<long>, sketch binary"))
    shape = ["n_shingles", "f1", "f2"]
    some = F.min(F.struct(F.col("doc").isNull(), "doc", "mark"))
    classes = cut(
        sketched.where("n_shingles > 0").groupBy(*shape).agg(some.alias("some"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .select(*shape, "some.doc", "some.mark", "bands", "sketch", F.monotonically_increasing_id().alias("node"))
    )
    family = cut(_families(classes, bar)).join(classes.select("node", "n_shingles", "doc", "mark"), "node")
    totals = family.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    members = cut(family.join(totals, "component").select("node", F.col("component").alias("family"), blocks.alias("blocks"), F.col("doc").alias("its_doc"), F.col("mark").alias("its_mark"), F.col("n_shingles").alias("its_size")))

    def sets(wanted: DataFrame) -> DataFrame:
        own = (F.col("mark") == F.col("its_mark")) & F.col("doc").eqNullSafe(F.col("its_doc"))
        found = plain.join(_few(wanted), own).select("node", "family", "blocks", "its_size", "text")
        found = found.mapInArrow(lean(_with_sets("text")), "node long, family long, blocks int, its_size long, shingles binary")
        return found.where(F.length("shingles") == F.col("its_size") * 8).drop("its_size")

    large = members.where("blocks > 1")
    linked = components(group_links(sets(members.where("blocks = 1")), None if large.isEmpty() else sets(large), "family", _match(bar), BLOCK))
    placed = classes.select(*shape, F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "mark").alias("own"), "node").join(linked, "node", "left")
    placed = cut(placed.select(*shape, "own", F.coalesce("component", "node").alias("class")))
    first = cut(placed.groupBy("class").agg(F.min("own").alias("first")))  # a table of its own, so that its join may split a large class
    final = placed.join(first, "class").select(*shape, "first")
    return sketched.select("doc", "mark", *shape).join(final, shape, "left").select("doc", "mark", "n_shingles", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row; texts whose similarity is `percent` or more are linked."""
    rows = _linked_rows(docs, id_col, text_col, percent)
    component = F.when(F.col("first").isNull(), F.col("doc")).otherwise(F.col("first.doc"))
    out = rows.select(F.col("doc").alias(id_col), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each component and all rows without words, all columns.

    The row with the smallest id stays (one without id only where no other has one). Rows that go are found by id
    and hash of their text; where a row that stays occurs several times, one of its occurrences does.
    """
    rows = _linked_rows(docs, id_col, text_col, percent).where("first is not null").groupBy("doc", "mark", "first").agg(F.count(F.lit(1)).alias("n"))
    judged = rows.withColumn("stays", (F.col("mark") == F.col("first.mark")) & F.col("doc").eqNullSafe(F.col("first.doc")))
    judged = cut(judged.where("not stays or n > 1").select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), "stays"))
    own = (F.xxhash64(text_col) == F.col("_mark")) & F.col(id_col).cast("long").eqNullSafe(F.col("_doc"))
    kept = docs.join(_few(judged.select("_doc", "_mark")), own, "left_anti")
    repeated = judged.where("stays").select("_doc", "_mark")
    if repeated.isEmpty():
        return kept
    again = docs.join(_few(repeated), own).dropDuplicates(["_doc", "_mark"]).drop("_doc", "_mark")
    return kept.unionByName(again)
