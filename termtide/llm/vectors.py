"""Near-duplicate vectors: inverted lists, product-quantised residuals, and an exact cosine rerank.

Vectors of each length have an index of their own. A bounded sample trains its coarse centres and the codebooks of
`SUBSPACES` residual subspaces (k-means on the driver), and says how many lists are probed: so many of the nearest
that neighbours at the threshold, drawn in random directions around the sample, are met with chance `recall` or
more. Every distinct vector is indexed: its nearest centre is its list, its residual becomes one code per subspace,
and the length of what the codes leave out is kept. It visits the other lists that it probes. In a list, table
lookups give the distance from each visitor to each coded member; by the triangle inequality a pair above its
threshold plus the kept length can't be a link, and all others get the exact cosine in double precision. A pair
whose lists probe one another is counted in the later one. Large lists are compared block against block, since every
link counts. Tasks give link counts and the links that join parts; connected components give the rest.

Null or zero vectors and vectors with null or non-finite components link with nothing, vectors of unequal lengths not
with each other; a cosine equal to the threshold is a link. Equal vectors are one indexed row and count as links of
each other. Rows without id get the component of their equals and are never kept. Vectors of any length are taken
whole. An empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from termtide.llm.common import cut, lean
from termtide.llm.graph import by_group, components, forest

SUBSPACES, CODES = 16, 64
#: Most bytes of the training samples of all lengths together, most vectors of one; rows aimed at in a list, rows of a block.
SAMPLE_BYTES, SAMPLE, PER_LIST, BLOCK = 32_000_000, 65_536, 256, 1024
#: Sample vectors around which neighbours are drawn to measure probes, and most values of a matrix of scores.
MEASURED, SCORES = 2048, 4_000_000


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rnd = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    centres = x[rnd.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        step, norms = max(1, SCORES // k), 0.5 * (centres**2).sum(1)
        own = np.concatenate([(x[i : i + step] @ centres.T - norms).argmax(1) for i in range(0, len(x), step)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


@dataclass
class Index:
    """Coarse centres, the parts of a residual, their codebooks, the threshold as a distance, probes, and the first list's number."""

    centres: np.ndarray
    parts: list[np.ndarray]
    books: list[np.ndarray]
    reach: float
    probes: int
    base: int = 0

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each vector in order, without the base."""
        out = np.empty((len(x), n), np.int32)
        step = max(1, SCORES // len(self.centres))
        norms = (self.centres**2).sum(1)
        for i in range(0, len(x), step):
            score = (x[i : i + step] @ self.centres.T) * -2 + norms
            part = np.argpartition(score, n - 1, axis=1)[:, :n] if n < len(self.centres) else np.broadcast_to(np.arange(n), score.shape)
            out[i : i + step] = np.take_along_axis(part, np.take_along_axis(score, part, 1).argsort(1, kind="stable"), 1)
        return out

    def code(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they leave out."""
        codes, left = np.empty((len(residual), len(self.parts)), np.uint8), np.zeros(len(residual))
        for s, (dims, book) in enumerate(zip(self.parts, self.books, strict=True)):
            own = (residual[:, dims] @ book.T - 0.5 * (book**2).sum(1)).argmax(1)
            codes[:, s] = own
            left += ((residual[:, dims] - book[own]) ** 2).sum(1)
        return codes, np.sqrt(left)

    def distances(self, visitor: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of visitors' residuals to coded residuals, by table lookups."""
        out = np.zeros((len(visitor), len(codes)), np.float32)
        for s, (dims, book) in enumerate(zip(self.parts, self.books, strict=True)):
            table = ((visitor[:, dims][:, None] - book[None]) ** 2).sum(2).astype(np.float32)
            out += table[:, codes[:, s]]
        return out


def sufficient_probes(index: Index, x: np.ndarray, threshold: float, recall: float) -> int:
    """The fewest probes by which one of two neighbours at the threshold meets the other's list with chance `recall`."""
    rnd = np.random.default_rng(3)
    x = x[:MEASURED]
    away = rnd.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(away, axis=1, keepdims=True)
    y = threshold * x + np.sqrt(1 - threshold**2) * away / np.where(length > 0, length, 1)
    most = len(index.centres)
    n = min(4, most)
    while True:
        ox, oy = index.nearest(x, n), index.nearest(y, n)
        met = (ox == oy[:, :1]) | (oy == ox[:, :1])
        share = np.maximum.accumulate(met, axis=1).mean(0)
        if share[-1] >= recall or n == most:
            return int(np.argmax(share >= recall)) + 1 if share[-1] >= recall else most
        n = min(most, n * 4)


def fit(sample: np.ndarray, rows: int, threshold: float, recall: float, base: int = 0) -> Index:
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    lists = max(1, min(rows // PER_LIST, len(x) // 4))
    centres = kmeans(x, lists, 8 if lists <= 2048 else 2, 1)
    index = Index(centres, [p for p in np.array_split(np.arange(x.shape[1]), SUBSPACES) if len(p)], [], float(np.sqrt(2 - 2 * threshold)), 1, base)
    residual = x - centres[index.nearest(x, 1)[:, 0]]
    index.books = [kmeans(residual[:16_384, p], CODES, 6, 2 + i) for i, p in enumerate(index.parts)]
    index.probes = sufficient_probes(index, x, threshold, recall)
    return index


def _matrix(raw: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1)


def _assign(sent, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = sent.value
        for whole in batches:
            sizes = np.diff(whole.column("v").offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                same = whole.filter(pa.array(sizes == d))
                for at in range(0, len(same), 2048):
                    yield placed(same.slice(at, 2048), indexes[d])

    def placed(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
        values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(batch), -1)
        x = values.astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        lists = index.nearest(x, index.probes)
        codes, left = index.code(x - index.centres[lists[:, 0]])
        row, turn = np.divmod(np.arange(lists.size), index.probes)
        home = turn == 0
        lists += index.base
        take = lambda name: batch.column(name).take(pa.array(row))
        return pa.RecordBatch.from_arrays(
            [pa.array(lists.ravel()), pa.array(home), pa.array(lists[row, 0]), take("node"), take("copies"), pa.array([v.tobytes() for v in values], pa.binary()).take(pa.array(row)),
             pa.array([codes[r].tobytes() if h else b"" for r, h in zip(row, home, strict=True)], pa.binary()),
             pa.array([lists[r].tobytes() if h else b"" for r, h in zip(row, home, strict=True)], pa.binary()), pa.array(left[row].astype(np.float32))],
            ["list", "home", "own", "node", "copies", "v", "codes", "probes", "left"],
        )

    return run


def _link(sent, kind: str, threshold: float):
    def work(group: dict) -> list[pa.RecordBatch]:
        """Links between a block of members and one other of members or visitors (`other` 0: its own rest and the first visitors)."""
        first, other, home = group["block_a"][0], group["other"][0], group["home"]
        member = np.flatnonzero(home & (group["block"] == first))
        if not len(member):
            return []
        index = next(i for i in sent.value.values() if i.base <= group["list"][0] < i.base + len(i.centres))
        x = _matrix(group["v"], kind)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        out = []
        if other == 0:
            out += pairs(group, index, x, member, member)
        rest = np.flatnonzero(home & (group["block"] == other) if other > 0 else ~home)
        return out + (pairs(group, index, x, rest, member) if len(rest) else [])

    def pairs(group: dict, index: Index, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[pa.RecordBatch]:
        across, at = a is not b, group["list"][0]
        codes = np.frombuffer(b"".join(group["codes"][i] for i in b), np.uint8).reshape(len(b), -1)
        within = index.reach + group["left"][b].astype(np.float64) + 1e-4
        residual = x[a] - index.centres[at - index.base]
        links = np.zeros((len(a), len(b)), bool)
        for i in range(0, len(a), 128):
            maybe = index.distances(residual[i : i + 128], codes) <= (within**2)[None, :]
            q, m = np.nonzero(maybe)
            for j in range(0, len(q), 100_000):
                qq, mm = q[j : j + 100_000], m[j : j + 100_000]
                ok = np.einsum("ij,ij->i", x[a[i + qq]], x[b[mm]]) >= threshold
                links[i + qq[ok], mm[ok]] = True
        if not across:
            np.fill_diagonal(links, False)
        elif (later := group["own"][a] > at).any():  # a member that probes the visitor's list has met it there
            probes = np.frombuffer(b"".join(group["probes"][i] for i in b), np.int32).reshape(len(b), -1)
            q, m = np.nonzero(links & later[:, None])
            links[q, m] = (probes[m] != group["own"][a[q]][:, None]).all(1)
        copies = group["copies"]
        counts = [(group["node"][a], links @ copies[b])] + ([(group["node"][b], links.T @ copies[a])] if across else [])
        out = []
        for nodes, n in counts:
            if (some := n > 0).any():
                out.append(pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(n[some].astype(np.int64))], ["a", "b", "n"]))
        s, t = forest(links, group["node"][a], group["node"][b])
        if len(s):
            out.append(pa.RecordBatch.from_arrays([pa.array(s), pa.array(t), pa.nulls(len(s), pa.int64())], ["a", "b", "n"]))
        return out

    return work


def _indexes(classes: DataFrame, kind: str, threshold: float, recall: float) -> dict[int, Index]:
    """An index for each length of vectors, from bounded samples in hash order."""
    counts = {r["d"]: r["n"] for r in classes.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect()}
    width = np.dtype(kind).itemsize
    most = {d: max(1, min(SAMPLE, n, SAMPLE_BYTES // (len(counts) * d * width))) for d, n in counts.items()}
    order = Window.partitionBy("d").orderBy("node_key", "node")
    bound = F.create_map(*(F.lit(x) for d, n in most.items() for x in (d, n)))[F.col("d")]
    drawn = classes.select("d", "node_key", "node", "v").withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= max(most.values())).where(F.col("turn") <= bound)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.asarray(v, kind).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("turn"), pa.array(own, pa.binary())], ["d", "turn", "v"])

    rows = sorted((r["d"], r["turn"], bytes(r["v"])) for r in drawn.select("d", "turn", "v").mapInArrow(lean(packed), "d int, turn int, v binary").collect())
    out, base = {}, 0
    for d, n in sorted(counts.items()):
        out[d] = fit(_matrix([v for e, _, v in rows if e == d], kind), n, threshold, recall, base)
        base += len(out[d].centres)
    return out


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, recall: float = 0.995) -> DataFrame:
    """(id, n_links, component_id, kept) of each row."""
    single = isinstance(rows.schema[vector_col].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    v = F.col(vector_col) if single else F.transform(F.col(vector_col), lambda x: x.cast("double"))
    plain = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    good = plain.where(ok).withColumn("node_key", F.xxhash64("v"))
    classes = good.groupBy("node_key", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("d", F.size("v")))
    if classes.isEmpty():
        return plain.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    sent = rows.sparkSession.sparkContext.broadcast(_indexes(classes, kind, threshold, recall))
    placed = cut(classes.select("node", "copies", "v").mapInArrow(lean(_assign(sent, kind)), "list int, home boolean, own int, node long, copies long, v binary, codes binary, probes binary, left float"))
    blocks = lambda c: F.ceil(F.count(F.when(c, 1)) / BLOCK).cast("int")
    sizes = placed.groupBy("list").agg(blocks(F.col("home")).alias("members"), blocks(~F.col("home")).alias("guests"))
    placed = placed.join(F.broadcast(sizes), "list").withColumn("block", F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.when(F.col("home"), F.col("members")).otherwise(F.col("guests")))).cast("int"))
    block, members, guests = F.col("block"), F.col("members"), F.col("guests")
    meets = lambda a, other: F.struct(a.cast("int").alias("block_a"), other.cast("int").alias("other"))
    others = F.filter(F.sequence(F.lit(0), members - 1), lambda o: o != block)
    at_home = F.concat(
        F.array(meets(block, F.lit(0))), F.transform(others, lambda o: meets(F.least(o, block), F.greatest(o, block))),
        F.transform(F.sequence(F.lit(1), F.greatest(guests - 1, F.lit(1))), lambda g: meets(block, -g)),
    )
    at_home = F.filter(at_home, lambda p: p["other"] > -F.greatest(guests, F.lit(1)))
    visiting = F.transform(F.sequence(F.lit(0), F.greatest(members, F.lit(1)) - 1), lambda o: meets(o, -block))
    met = placed.withColumn("pair", F.explode(F.when(F.col("home"), at_home).otherwise(visiting))).select("list", "pair.*", "block", "home", "own", "node", "copies", "v", "codes", "probes", "left")
    found = cut(by_group(met, ["list", "block_a", "other"], _link(sent, kind, threshold), "a long, b long, n long"))
    parts = components(found.where("b is not null").select("a", "b"))
    links = found.where("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    known = cut(classes.select("node", "node_key", "v", "least", "copies").join(links, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
    smallest = cut(known.groupBy("component").agg(F.min("least").alias("component_id")))
    known = known.join(smallest, "component").select("node_key", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = good.join(known, ["node_key", "v"]).select("id", "n_links", "component_id")
    alone = plain.where(~ok).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
