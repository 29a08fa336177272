"""Hard negatives by exact integer scores, with Four-Russians tables.

Components become integers and are stored as packed bit planes: byte g of plane p holds bit p of the eight dimensions of
group g, in two's complement. For a block of anchors, a table holds each group's 256 subset sums of anchor components;
a candidate's bytes index these tables, and sums of planes are shifted and added, which is the whole inner product.

Rows without label or vector, or with a null or non-finite component, take no part. Vectors are scored against those of
their own length only; one of length 0 scores 0. Components of more than `most(length)`, which is 2 ** 25 for 64
dimensions, count as that: all sums fit 64 bits. Repeated rows are rows of their own (each an anchor, each the others'
positive); rows without id are candidates, after those of equal score, and never anchors. Anchors without positives,
and an empty table, give no rows. Other columns, whatever their names, are ignored.

Every anchor meets every row of its length: candidates and anchors are dealt into blocks, and each pair of blocks is one
group of a shuffle, so memory is that of two blocks however large the table is. A block pair hands on the best few of
each anchor; a window over these finds the best of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termtide.llm.common import cut, lean

#: Rows of a block of candidates and of anchors; candidates and anchors scored at a time.
ROWS, ANCHORS, SLICE, WIDE = 8192, 1024, 1024, 256
#: Most tasks of one shuffle of block pairs.
TASKS = 20_000


def most(width: int) -> int:
    """The largest component that counts as itself: a hundred times a sum of `width` products stays within 64 bits."""
    return 1 << (56 - max(width - 1, 0).bit_length()) // 2


def planes(values: np.ndarray) -> np.ndarray:
    """(rows, planes, groups) bytes of integer rows in two's complement, as few planes as hold all values."""
    n, width = values.shape
    bits = int(np.abs(values).max(initial=0)).bit_length() + 1
    wide = np.zeros((n, -(-width // 8) * 8), np.int64)
    wide[:, :width] = values
    return np.stack([np.packbits((wide >> p & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(bits)], 1)


def integers(packed: np.ndarray) -> np.ndarray:
    """(rows, 8 * groups) integers of bit planes."""
    n, bits, groups = packed.shape
    out = np.zeros((n, groups * 8), np.int64)
    for p in range(bits):
        digit = np.unpackbits(packed[:, p], axis=1, bitorder="little").astype(np.int64) << p
        out += -digit if p == bits - 1 else digit
    return out


def stacked(rows: list[bytes], width: int) -> np.ndarray:
    """Bit planes of rows that may have fewer planes than others: the last plane, the sign, is repeated."""
    groups = -(-width // 8)
    if not groups:
        return np.zeros((len(rows), 1, 0), np.uint8)
    sizes = np.array([len(r) for r in rows]) // groups
    out = np.empty((len(rows), sizes.max(initial=1), groups), np.uint8)
    for bits in np.unique(sizes):
        own = np.flatnonzero(sizes == bits)
        out[own, :bits] = np.frombuffer(b"".join(rows[i] for i in own), np.uint8).reshape(len(own), bits, groups)
        out[own, bits:] = out[own, bits - 1 : bits]
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each group of eight dimensions, the sums of all subsets of an anchor's components."""
    n, width = anchors.shape
    parts = anchors.reshape(n, width // 8, 8).transpose(1, 2, 0)
    table = np.zeros((width // 8, 256, n), anchors.dtype)
    for j in range(8):
        table[:, 1 << j : 2 << j] = table[:, : 1 << j] + parts[:, j : j + 1]
    return table


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products: lookups of each plane's bytes, shifted and added from the sign down."""
    n, bits, groups = packed.shape
    out, found = np.zeros((n, table.shape[2]), table.dtype), np.empty((n, table.shape[2]), table.dtype)
    for p in reversed(range(bits)):
        out <<= 1
        for g in range(groups):
            np.take(table[g], packed[:, p, g], axis=0, out=found)
            if p == bits - 1:
                out -= found
            else:
                out += found
    return out


def scored(anchors: list[bytes], candidates: list[bytes], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first anchor's place, scores by anchor and candidate) for slices of anchors."""
    held, packed = integers(stacked(anchors, width)), stacked(candidates, width)
    top = int(np.abs(held).max(initial=0)) << packed.shape[1]
    for i in range(0, len(held), WIDE):
        part = held[i : i + WIDE].astype(np.int32 if top * max(width, 1) < 2**31 else np.int64)
        table = subset_sums(part)
        out = np.empty((len(part), len(packed)), np.int64)
        for j in range(0, len(packed), SLICE):
            out[:, j : j + SLICE] = scores(table, packed[j : j + SLICE]).T
        yield i, out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector").combine_chunks() if isinstance(batch.column("vector"), pa.ChunkedArray) else batch.column("vector")
        sizes = np.diff(vectors.offsets.to_numpy())
        flat, begins = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(sizes)])
        out: list[bytes] = [b""] * len(sizes)
        for width in np.unique(sizes):
            own, bound = np.flatnonzero(sizes == width), most(int(width))
            with np.errstate(over="ignore"):  # beyond the largest double: infinite, and cut to the bound
                values = np.clip(np.floor(256 * flat[begins[own][:, None] + np.arange(width)]), -bound, bound).astype(np.int64)
            for i, row in zip(own, planes(values), strict=True):
                out[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "label", "width", "packed"])


def pack(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(vec_id, label, width, packed) of the rows that take part."""
    bad = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(vector_col).isNotNull() & ~bad).select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_col).alias("vector")).where("label is not null")
    return rows.mapInArrow(lean(_packed), "vec_id long, label long, width int, packed binary")


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _in_order(table: pa.Table) -> pa.Table:
    """By id, null last, then row: the order of equal scores."""
    return table.sort_by([("unknown", "ascending"), ("vec_id", "ascending"), ("rid", "ascending")]) if len(table) else table


def _positives(keep: int):
    schema = pa.schema([("arid", pa.int64()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = _in_order(rows)
        if not len(anchors) or not len(rows):
            return schema.empty_table()
        arid, alabel, rid, label = _column(anchors, "rid"), _column(anchors, "label"), _column(rows, "rid"), _column(rows, "label")
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, score in scored(anchors.column("packed").to_pylist(), rows.column("packed").to_pylist(), anchors.column("width")[0].as_py()):
            for k in range(len(score)):
                own = np.flatnonzero((label == alabel[i + k]) & (rid != arid[i + k]))
                best = own[np.argsort(-score[k, own], kind="stable")[:keep]]
                found.append((np.full(len(best), arid[i + k]), best, score[k, best]))
        place = np.concatenate([f[1] for f in found])
        return pa.table([np.concatenate([f[0] for f in found]), rid[place], rows.column("vec_id").take(pa.array(place)), np.concatenate([f[2] for f in found])], schema=schema)

    return work


def _negatives(keep: int, low: int, high: int):
    schema = pa.schema([("arid", pa.int64()), ("k", pa.int32()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = _in_order(rows)
        if not len(anchors) or not len(rows):
            return schema.empty_table()
        arid, alabel, rid, label = _column(anchors, "rid"), _column(anchors, "label"), _column(rows, "rid"), _column(rows, "label")
        bars = anchors.column("bars").to_pylist()
        found: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for i, score in scored(anchors.column("packed").to_pylist(), rows.column("packed").to_pylist(), anchors.column("width")[0].as_py()):
            for k in range(len(score)):
                bar = bars[i + k]
                own = np.flatnonzero((label != alabel[i + k]) & (100 * score[k] >= min(low * b for b in bar)) & (100 * score[k] <= max(high * b for b in bar)))
                own = own[np.argsort(-score[k, own], kind="stable")]
                percent = 100 * score[k, own]
                for j, b in enumerate(bar):
                    best = own[np.flatnonzero((percent >= low * b) & (percent <= high * b))[:keep]]
                    found.append((arid[i + k], j, best, score[k, best]))
        sizes, place = [len(f[2]) for f in found], np.concatenate([f[2] for f in found])
        first, second = np.repeat(np.array([f[0] for f in found], np.int64), sizes), np.repeat(np.array([f[1] for f in found], np.int32), sizes)
        return pa.table([first, second, rid[place], rows.column("vec_id").take(pa.array(place)), np.concatenate([f[3] for f in found])], schema=schema)

    return work


def _blocks(anchors: DataFrame, rows: DataFrame, work, schema: str, n_anchors: int, n_rows: int) -> DataFrame:
    """`work` on each pair of a block of anchors and a block of candidates of one length."""
    a, b = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // ROWS))
    tasks, key = min(a * b, TASKS), ["width", "pair"]
    block = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n))
    left = anchors.withColumn("pair", F.explode(F.sequence(block(a) * b, block(a) * b + b - 1)))
    right = rows.withColumn("pair", F.explode(F.sequence(block(b), block(b) + F.lit((a - 1) * b), F.lit(b))))
    return left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key)).applyInArrow(work, schema)


def hard_negatives(
    vectors: DataFrame, label: Column, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = 5, keep: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Each anchor's first `positives` other rows of its label, and for each of them the first `keep` rows of another label
    that score from `low` to `high` percent of it. label: of `vectors`; anchor: a condition on `vec_id`.
    """
    rows = cut(pack(vectors, id_col, vector_col, label).withColumn("rid", F.monotonically_increasing_id()).withColumn("unknown", F.col("vec_id").isNull()))
    anchors = rows.where(anchor).drop("unknown")
    n_rows, n_anchors = rows.count(), anchors.count()
    slim = rows.select("rid", "vec_id", "unknown", "label", "width", "packed")
    near = _blocks(anchors.select("rid", "label", "width", "packed"), slim, _positives(positives), "arid long, rid long, vec_id long, score long", n_anchors, n_rows)
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("rid")]
    near = near.withColumn("k", F.row_number().over(Window.partitionBy("arid").orderBy(*order)) - 1).where(F.col("k") < positives)
    near = near.groupBy("arid").agg(F.sort_array(F.collect_list(F.struct("k", "vec_id", "score"))).alias("near"))
    held = cut(anchors.join(near, anchors.rid == near.arid).select("rid", F.col("vec_id").alias("anchor_id"), "label", "width", "packed", "near"))
    far = _blocks(
        held.select("rid", "label", "width", "packed", F.col("near.score").alias("bars")), slim, _negatives(keep, low, high),
        "arid long, k int, rid long, vec_id long, score long", n_anchors, n_rows)
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("arid", "k").orderBy(*order))).where(F.col("rank") <= keep)
    own = held.select(F.col("rid").alias("arid"), "anchor_id", F.explode("near").alias("p")).select("arid", "anchor_id", "p.k", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return far.select("arid", "k", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(own, ["arid", "k"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
