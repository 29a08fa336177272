"""Connected components of link tables, and grouped numpy work over sorted rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import cut, lean, shared_dir


#: Most links that one task joins by itself (16 bytes each).
LOCAL_LINKS = 250_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of the links reaches, itself included.

    Alternating large and small stars: each round points every neighbour of a node at the smallest one, until
    nothing moves or so few links are left (`LOCAL_LINKS`, a bound on memory) that one task can follow them all. The
    smallest neighbours are a checkpointed table with one row a node, so that its join with the links has an exchange
    of its own and Spark may split the links of a hub among tasks. A round's links are written as a table (in two
    folders in turn), so that Spark plans each round by their real size: the size that it expects of a join is a
    product, which would grow without bound from round to round.
    """
    spark, folder = edges.sparkSession, f"{shared_dir(edges.sparkSession).rstrip('/')}/components-{uuid.uuid4().hex}"

    def written(links: DataFrame, turn: int) -> DataFrame:
        links.distinct().write.mode("overwrite").parquet(f"{folder}/{turn % 2}")
        return spark.read.schema("u long, v long").parquet(f"{folder}/{turn % 2}")

    low, high = F.least(a, b), F.greatest(a, b)
    edges, seen, turn = written(edges.select(high.alias("u"), low.alias("v")).where("u > v"), 0), None, 0
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if now[0] <= LOCAL_LINKS:
            edges = cut(edges.coalesce(1).mapInArrow(_followed, "u long, v long"))
            break
        if now == seen:
            break
        seen = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = cut(both.groupBy("u").agg(F.min("v").alias("m")))
        large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = cut(large.where("u > v").distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turn += 1
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))), turn)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars."""
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if parts:
        u, v = stars(*(np.concatenate(side) for side in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its part) of the links from a to b, without the smallest nodes themselves."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        # joined at their smallest nodes so far, then every node jumps on as far as it can
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, high, low)
        while not (new[new] == new).all():
            new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


def forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its part) that join what a matrix of links joins; left, right: ids of rows and columns."""
    a, b = np.nonzero(links)
    return stars(left[a], right[b])


def by_group(df: DataFrame, keys: list[str], work: Callable[[dict[str, np.ndarray | list]], list[pa.RecordBatch]], schema: str) -> DataFrame:
    """Rows with equal keys together, each group handed to `work` as a dict of columns.

    One exchange and a sort; a task streams its groups, so that thousands of small groups cost little. The
    caller splits large groups by a block number among the keys, so no group is larger than two blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            rest = got if rest is None else pa.concat_tables([rest, got])
            cuts = bounds(rest)
            if len(cuts) > 2:
                yield from done(rest, cuts[:-1])
                rest = rest.slice(cuts[-2]).combine_chunks()
        if rest is not None and len(rest):
            yield from done(rest, bounds(rest))

    def bounds(t: pa.Table) -> list[int]:
        change = np.zeros(max(0, len(t) - 1), bool)
        for k in keys:
            col = t.column(k).to_numpy()
            change |= col[1:] != col[:-1]
        return [0, *(np.flatnonzero(change) + 1).tolist(), len(t)]

    def done(t: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        cols = {n: t.column(n).to_numpy() if not pa.types.is_binary(t.schema.field(n).type) else t.column(n).to_pylist() for n in t.schema.names}
        for i, j in zip(cuts, cuts[1:], strict=False):
            yield from work({n: c[i:j] for n, c in cols.items()})

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(run, 1_000_000), schema)


Match = Callable[[dict[str, np.ndarray | list], np.ndarray, np.ndarray], np.ndarray]


def group_links(small: DataFrame, large: DataFrame | None, key: str, match: Match, size: int) -> DataFrame:
    """(a, b): links that join what matching members of a group join; members: key, node, blocks and what `match` reads.

    `match` gets the columns of a group and the places of two sets of its rows, and gives a matrix of matches. `small`
    has the groups of one block, which are compared whole. Every block of a group in `large` (None: there is none) is
    compared with the group's smallest node first; members that match it are joined already, so only those that
    don't (the rest) go on, against all blocks of the group. Rows go out once for each block of the other side.
    """
    if large is None:
        return by_group(small.withColumn("is_head", F.lit(False)), [key], _first(key, match), "a long, b long, rest long").select("a", "b")
    large = cut(large.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    head = large.groupBy(key).agg(F.min_by(F.struct(*large.columns), "node").alias("head")).select("head.*")
    spread = head.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("is_head", F.lit(True))
    members = small.withColumn("block", F.lit(0)).unionByName(large).withColumn("is_head", F.lit(False)).unionByName(spread)
    first = cut(by_group(members, [key, "block"], _first(key, match), "a long, b long, rest long"))
    links = first.where("b is not null").select("a", "b")
    rest = first.where("rest is not null").select(F.col("rest").alias(key), F.col("a").alias("node")).distinct()
    if rest.isEmpty():
        return links
    counts = rest.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("rest_blocks"))
    open_ = large.join(counts, key).join(rest.withColumn("is_rest", F.lit(True)), [key, "node"], "left").withColumn("is_rest", F.coalesce("is_rest", F.lit(False)))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("rest_blocks")).cast("int")
    asking = open_.where("is_rest").withColumn("rest_block", own).withColumn("block", F.explode(upto("blocks"))).withColumn("asks", F.lit(True))
    asked = open_.withColumn("rest_block", F.explode(upto("rest_blocks"))).withColumn("asks", F.lit(False))
    return links.unionByName(by_group(asking.unionByName(asked), [key, "block", "rest_block"], _second(match), "a long, b long"))


def _links(found: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[pa.Array, pa.Array]:
    return tuple(map(pa.array, forest(found, left, right)))


def _first(key: str, match: Match):
    """A whole small group, or one block of a large group against its head."""

    def work(group: dict) -> list[pa.RecordBatch]:
        node, head = np.asarray(group["node"]), np.flatnonzero(group["is_head"])
        rows = np.flatnonzero(~np.asarray(group["is_head"]))
        rows = rows[np.unique(node[rows], return_index=True)[1]]
        other = head[:1] if len(head) else rows
        found = match(group, rows, other)
        a, b = _links(found, node[rows], node[other])
        out = [pa.RecordBatch.from_arrays([a, b, pa.nulls(len(a), pa.int64())], ["a", "b", "rest"])] if len(a) else []
        if len(head):
            left = node[rows][~found[:, 0] & (node[rows] != node[head[0]])]
            out += [pa.RecordBatch.from_arrays([pa.array(left), pa.nulls(len(left), pa.int64()), pa.array(np.full(len(left), group[key][0]))], ["a", "b", "rest"])] if len(left) else []
        return out

    return work


def _second(match: Match):
    """Members that do not match the head against a block of the group."""

    def work(group: dict) -> list[pa.RecordBatch]:
        node, asks = np.asarray(group["node"]), np.asarray(group["asks"])
        sides = [rows[np.unique(node[rows], return_index=True)[1]] for rows in (np.flatnonzero(asks), np.flatnonzero(~asks))]
        if not len(sides[0]) or not len(sides[1]):
            return []
        a, b = _links(match(group, *sides), *(node[s] for s in sides))
        return [pa.RecordBatch.from_arrays([a, b], ["a", "b"])] if len(a) else []

    return work
