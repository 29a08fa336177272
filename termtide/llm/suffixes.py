"""Repeated passages of a fixed least length, found in suffix arrays built by induced sorting.

A window is `length` bytes of one document. Its smallest gram of `gram` bytes, by a hash, deals it to a shard: equal
windows have equal smallest grams, and neighbouring windows mostly share theirs, so a run of them travels as one string.
Grams that are smallest at one place only can't belong to a repeated window; a Bloom filter of bounded size leaves most
of them at home (what it lets through by mistake costs time, not truth). Equal strings are one string with its first
place. A shard's strings, one behind another, get a suffix array: suffixes are classed as smaller (S) or larger (L) than
their successors, leftmost S substrings are sorted and named, the string of names is sorted the same way recursively,
and from these all L and then all S suffixes are induced. Common prefixes are computed in text order, where all but
those at a change of the preceding byte follow from their predecessor's. Neighbours that share `length` bytes are one
class of windows; only its first place stays. A gram whose strings would overfill a shard has each of them cut in two, at
most, by the bytes some way before or behind the gram, which part the texts that a common line stands in; where even
these are the same in very many strings, their windows are dealt singly.

Null texts count as empty; texts shorter than `length` bytes have no window. Documents come in order of id, null last,
then of a hash of their texts; of equal rows one, no matter which, comes first. Texts of any length are read whole. An
empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termtide.llm.common import cut, lean, shared_dir
from termtide.llm.shingles import BASE, BYTE_WEIGHT, INVERSE, mix

U = np.uint64
#: Bytes of text hashed at a time; windows of one string at most; bytes of a shard, and of one gram's strings in it.
BATCH_BYTES, RUN, SHARD_BYTES, HOT_BYTES = 500_000, 4096, 1_000_000, 2_000_000
#: Bits of the filter a gram, bits of one block of it, and most blocks (32 MB).
BITS_A_GRAM, BLOCK_BITS, MOST_BLOCKS = 16, 19, 512


# --- suffix arrays -----------------------------------------------------------------------------------------------


def smaller_type(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last symbol is the only smallest one and counts as smaller."""
    n = len(t)
    change = np.where(t[:-1] != t[1:], np.arange(n - 1, dtype=np.int64), n)
    change = np.minimum.accumulate(change[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = t[change] < t[change + 1]
    return out


def induce(t: np.ndarray, own: np.ndarray, seed_rank: np.ndarray, seeds_after: bool) -> np.ndarray:
    """Suffixes of one type in order, from the ranks of those of the other type that follow them.

    own: flags of the type. A suffix is compared by its symbols up to the first suffix of the other type, and by that
    one's rank. Symbols are read from the deepest forward, several in one sort, so that a suffix is sorted about once.
    seeds_after: whether the other type's suffixes come after this type's where they start with the same symbol.
    """
    n = len(t)
    items = np.flatnonzero(own)
    if not len(items):
        return items
    following = np.minimum.accumulate(np.where(own, n, np.arange(n))[::-1])[::-1]
    ends = following[items]
    depth = ends - items
    symbol = t.astype(np.int64) * 2 + (own ^ seeds_after)
    low, wide = n.bit_length(), int(symbol.max()).bit_length()
    many = max(1, (63 - low) // wide)
    packed, upto = pack_symbols(symbol, wide, many)
    block = depth // many
    by_block = np.argsort(block.astype(np.uint16) if block.max() < 2**16 else block, kind="stable")
    bounds = np.searchsorted(block[by_block], np.arange(block.max() + 2))
    held = items[:0]
    for b in range(int(block.max()), -1, -1):
        new, skip = by_block[bounds[b] : bounds[b + 1]], b * many
        # deeper suffixes go on past this block; others end in it, at a suffix of the other type
        deeper = (packed[held + skip] << low) + np.arange(len(held))
        ending = ((packed[items[new] + skip] & upto[depth[new] - skip + 1]) << low) + seed_rank[ends[new]]
        at = np.concatenate([held, items[new]])
        held = at[np.argsort(np.concatenate([deeper, ending]))]
    return held


def pack_symbols(symbol: np.ndarray, wide: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """`many` symbols of `wide` bits from each place on in one number, and masks of the first 0, 1, ... of them."""
    packed = np.zeros(len(symbol), np.int64)
    for j in range(many):
        packed <<= wide
        packed[: max(len(symbol) - j, 0)] += symbol[j:]
    full = (1 << wide * many) - 1
    return packed, np.array([full ^ ((1 << wide * (many - v)) - 1) for v in range(many + 1)], np.int64)


def _merged(t: np.ndarray, larger: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """Both types in one order: by first symbol, L before S."""
    k = int(t.max()) + 1
    n_larger, n_smaller = np.bincount(t[larger], minlength=k), np.bincount(t[smaller], minlength=k)
    out = np.empty(len(t), np.int64)
    out[np.arange(len(larger)) + (np.cumsum(n_smaller) - n_smaller)[t[larger]]] = larger
    out[np.arange(len(smaller)) + np.cumsum(n_larger)[t[smaller]]] = smaller
    return out


def names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Numbers of the leftmost S substrings in text order, equal for equal ones; `ordered` has them sorted."""
    size = np.zeros(len(t), np.int64)
    size[lms] = np.concatenate([np.diff(lms) + 1, [1]])
    wide = int(t.max()).bit_length()
    many = 63 // wide
    packed, upto = pack_symbols(t.astype(np.int64), wide, many)
    sizes = size[ordered]
    word = packed[ordered] & upto[np.minimum(sizes, many)]
    same = (sizes[1:] == sizes[:-1]) & (word[1:] == word[:-1])
    open_, j = np.flatnonzero(same & (sizes[1:] > many)), many
    while len(open_):
        mask = upto[np.minimum(sizes[open_] - j, many)]
        equal = (packed[ordered[open_] + j] & mask) == (packed[ordered[open_ + 1] + j] & mask)
        same[open_[~equal]] = False
        open_, j = open_[equal], j + many
        open_ = open_[sizes[open_] > j]
    number = np.zeros(len(t), np.int64)
    number[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return number[lms]


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; the last symbol must be smaller than all others."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    is_s = smaller_type(t)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    end = np.array([n - 1])

    def both(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        larger = induce(t, ~is_s, rank, True)
        own = np.zeros(n, np.int64)
        own[larger] = np.arange(len(larger))
        inner = is_s.copy()
        inner[-1] = False  # the end follows nothing
        return larger, np.concatenate([end, induce(t[:-1], inner[:-1], own[:-1], False)])

    rank = np.zeros(n, np.int64)  # leftmost S suffixes by their first symbol only: this sorts the substrings
    leftmost = np.zeros(n, bool)
    leftmost[lms] = True
    smaller = both(rank)[1]
    ordered = smaller[leftmost[smaller]]
    number = names(t, lms, ordered)
    if number.max() + 1 < len(lms):
        ordered = lms[suffix_array(number)]
    rank[ordered] = np.arange(len(ordered))
    return _merged(t, *both(rank))


def common_prefixes(t: np.ndarray, order: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """For each place of the text what its suffix shares with the one before it in order, up to the end of its string.

    rest: symbols from a place to the end of its string. Where the symbol before is the same on both sides, one less is
    shared than at the place before; elsewhere symbols are compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    begins = np.concatenate([[True], rest[1:] != rest[:-1] - 1])
    derived = ~begins & (before > 0)
    derived[derived] = t[place[derived] - 1] == t[before[derived] - 1]
    # the place before must have that very neighbour: it has, since equal symbols keep the order
    open_ = np.flatnonzero(~derived & (before >= 0))
    shared = np.zeros(n, np.int64)
    at, step = 0, 16
    padded = np.concatenate([t, np.zeros(step, t.dtype)])
    ahead = np.arange(step)
    while len(open_):
        going = []
        for i in range(0, len(open_), 65_536):
            part = open_[i : i + 65_536]
            a, b = part + at, np.minimum(before[part] + at, n - 1)
            differs = padded[a[:, None] + ahead] != padded[b[:, None] + ahead]
            met = differs.any(1)
            shared[part] += np.where(met, differs.argmax(1), step)
            going.append(part[~met & (shared[part] < rest[part])])
        open_, at = np.concatenate(going), at + step
    shared = np.minimum(shared, rest)
    anchor = np.maximum.accumulate(np.where(derived, 0, place))
    return np.maximum(shared[anchor] - (place - anchor), 0)


def first_windows(strings: list[bytes], key: np.ndarray, length: int) -> np.ndarray:
    """Flags over the strings laid one behind another, each with one place for its end: windows that come first of their equals.

    key: for each string a number that orders its first byte's place among all; places within a string follow by one.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1)
    raw = np.frombuffer(b"\0".join(strings) + b"\0\0", np.uint8)
    t = raw.astype(np.int32) + 2
    t[ends - 1], t[-1] = 1, 0
    rest = np.repeat(ends - 1, sizes + 1) - np.arange(ends[-1])
    order = suffix_array(t)
    shared = common_prefixes(t, order, np.concatenate([rest, [0]]))
    order = order[1:]
    windows = order[rest[order] >= length]
    place = np.repeat(key - (ends - sizes - 1), sizes + 1)[windows] + windows
    starts = np.flatnonzero(shared[windows] < length)
    least = np.minimum.reduceat(place, starts) if len(starts) else place[:0]
    first = place == np.repeat(least, np.diff(np.concatenate([starts, [len(windows)]])))
    out = np.zeros(ends[-1], bool)
    out[windows[first]] = True
    return out


# --- windows of documents ----------------------------------------------------------------------------------------


def _slide(x: np.ndarray, w: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every w neighbours, by doubling."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


class Runs:
    """Windows of a few texts, and the runs of neighbouring windows whose smallest grams hash alike."""

    def __init__(self, texts: list[bytes], length: int, gram: int):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        n, w = len(self.raw), length - gram + 1
        self.grams = self.smallest = np.zeros(0, np.uint64)
        if n >= length:
            power = np.full(n, BASE, np.uint64)
            power[0] = 1
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_WEIGHT[self.raw] * np.multiply.accumulate(power), dtype=np.uint64)])
            power[1:] = INVERSE
            self.grams = mix((sums[gram:] - sums[:-gram]) * np.multiply.accumulate(power)[: n - gram + 1])
            self.smallest = _slide(self.grams, w, np.minimum)
        m = len(self.smallest)
        # a window must end in its text
        self.valid = np.zeros(m + 1, np.int64)
        long = self.sizes >= length
        np.add.at(self.valid, self.begins[long], 1)
        np.add.at(self.valid, self.begins[long] + self.sizes[long] - length + 1, -1)
        self.valid = np.cumsum(self.valid)[:m] > 0
        self.w = w

    def selected(self) -> np.ndarray:
        """Keys of the grams that are smallest in some window of their text, once for each place."""
        if not len(self.smallest):
            return self.smallest
        # windows that reach over the end of a text select nothing: their value can't be the greatest
        value = np.where(self.valid, self.smallest, U(0))
        pad = np.zeros(self.w - 1, np.uint64)
        greatest = _slide(np.concatenate([pad, value, pad]), self.w, np.maximum)
        return keyed(self.grams[(greatest == self.grams) & (greatest > 0)])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, first window, windows) of each run; at most RUN windows each."""
        if not self.valid.any():
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.concatenate([[True], self.smallest[1:] != self.smallest[:-1]])
        new[self.begins[self.begins < len(new)]] = True
        new |= np.concatenate([[True], ~self.valid[:-1]])
        starts = np.flatnonzero(new & self.valid)
        stops = np.append(np.flatnonzero(new | ~self.valid), len(new))
        sizes = stops[np.searchsorted(stops, starts, side="right")] - starts
        if len(sizes) and sizes.max() > RUN:
            parts = -(-sizes // RUN)
            inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            starts, left = np.repeat(starts, parts) + inner * RUN, np.repeat(sizes, parts) - inner * RUN
            sizes = np.minimum(left, RUN)
        return keyed(self.smallest[starts]), starts, sizes


def keyed(grams: np.ndarray) -> np.ndarray:
    """Smallest grams have small hashes; keys are spread evenly again."""
    return mix(grams + U(BASE))


def _passes(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    return ((bits[_first_bit(key, len(bits)) >> 3] >> (_first_bit(key, len(bits)) & 7).astype(np.uint8)) & (bits[_second_bit(key, len(bits)) >> 3] >> (_second_bit(key, len(bits)) & 7).astype(np.uint8)) & 1).astype(bool)


def _block(key: np.ndarray, n_bytes: int) -> np.ndarray:
    return ((key >> U(44)) % U(n_bytes * 8 >> BLOCK_BITS)).astype(np.int64)


def _first_bit(key: np.ndarray, n_bytes: int) -> np.ndarray:
    return (_block(key, n_bytes) << BLOCK_BITS) + (key & U((1 << BLOCK_BITS) - 1)).astype(np.int64)


def _second_bit(key: np.ndarray, n_bytes: int) -> np.ndarray:
    return (_block(key, n_bytes) << BLOCK_BITS) + (key >> U(BLOCK_BITS) & U((1 << BLOCK_BITS) - 1)).astype(np.int64)


def _slices(batch: pa.RecordBatch, column: str = "raw") -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of parts of a batch of bounded size."""
    held = [t or b"" for t in batch.column(column).to_pylist()]
    i = 0
    while i < len(held):
        j, size = i, 0
        while j < len(held) and (j == i or size + len(held[j]) <= BATCH_BYTES):
            size += len(held[j])
            j += 1
        yield i, held[i:j]
        i = j


def gram_filter(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """A Bloom filter of the grams that are smallest at two places or more, as bytes."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array(Runs(part, length, gram).selected().view(np.int64))], names=["key"])

    repeated = docs.select("raw").mapInArrow(lean(chosen, 500), "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    repeated = cut(repeated)
    blocks = min(max(1, -(-repeated.count() * BITS_A_GRAM >> BLOCK_BITS)), MOST_BLOCKS)
    size = blocks << BLOCK_BITS - 3

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_block(key, size)), batch.column("key")], names=["block", "key"])

    def filled(table: pa.Table) -> pa.Table:
        block, key = table.column("block")[0].as_py(), table.column("key").to_numpy().view(np.uint64)
        bits = np.zeros(1 << BLOCK_BITS, np.uint8)
        for place in (_first_bit, _second_bit):
            bits[place(key, size) - (block << BLOCK_BITS)] = 1
        return pa.table({"block": [block], "bits": [np.packbits(bits, bitorder="little").tobytes()]}, schema=pa.schema([("block", pa.int64()), ("bits", pa.binary())]))

    out = np.zeros(size, np.uint8)
    for row in repeated.mapInArrow(marked, "block long, key long").groupBy("block").applyInArrow(filled, "block long, bits binary").toLocalIterator():  # MOST_BLOCKS of 64 KB at most
        out[row["block"] << BLOCK_BITS - 3 : row["block"] + 1 << BLOCK_BITS - 3] = np.frombuffer(row["bits"], np.uint8)
    return out


DOC = ["no_id", "id", "hash"]


def strings(docs: DataFrame, bits, length: int, gram: int) -> DataFrame:
    """(key, string, first) of the distinct strings that may hold a repeated window; first: the struct of DOC and `start`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in batches:
            for i, part in _slices(batch):
                runs = Runs(part, length, gram)
                key, start, size = runs.runs()
                met = _passes(held, key)
                key, start, size = key[met], start[met], size[met] + length - 1
                doc = np.searchsorted(runs.begins, start, side="right") - 1
                offsets = np.concatenate([[0], np.cumsum(size)])
                flat = runs.raw[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
                own = pa.array(doc + i)
                string = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), string, *(batch.column(c).take(own) for c in DOC), pa.array(start - runs.begins[doc])], names=["key", "string", *DOC, "start"])

    found = docs.select("raw", *DOC).mapInArrow(lean(work, 500), "key long, string binary, no_id boolean, id long, hash long, start long")
    return found.groupBy("key", "string").agg(F.min(F.struct(*DOC, "start")).alias("first"))


def _firsts(length: int):
    schema = pa.schema([("no_id", pa.bool_()), ("id", pa.int64()), ("hash", pa.int64()), ("ranges", pa.list_(pa.int64()))])

    def work(table: pa.Table) -> pa.Table:
        docs = [table.column(c).to_numpy() for c in DOC]
        by_doc = np.lexsort(docs[::-1])
        change = np.concatenate([[False], np.any([d[by_doc][1:] != d[by_doc][:-1] for d in docs], axis=0)])
        rank = np.empty(len(by_doc), np.int64)
        rank[by_doc] = np.cumsum(change)
        start, held = table.column("start").to_numpy(), table.column("string").to_pylist()
        first = first_windows(held, (rank << 40) + start, length)
        sizes = np.array([len(s) + 1 for s in held], np.int64)
        begins = np.cumsum(sizes) - sizes
        edge = np.diff(np.concatenate([[0], first.astype(np.int8), [0]]))
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # a string's last place is never a window, so ranges don't join
        own = np.searchsorted(begins, lo, side="right") - 1
        pairs = np.stack([lo, hi], 1) + (start - begins)[own][:, None]
        by_rank = np.argsort(rank[own], kind="stable")
        own, pairs = own[by_rank], pairs[by_rank]
        heads = np.flatnonzero(np.concatenate([[True], rank[own][1:] != rank[own][:-1]])) if len(own) else own
        offsets = np.append(heads, len(own)) * 2
        ranges = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pairs.ravel(), pa.int64()))
        return pa.table([*(pa.array(d[own[heads]]) for d in docs), ranges], schema=schema)

    return work


def cut_by_context(found: DataFrame, length: int, gram: int) -> DataFrame:
    """The same windows as (key, string, first), keyed by their gram and the bytes half a window's rest away from it.

    A window has its gram's first place p in it; what lies before p is compared where there is enough of it, else what
    lies behind. Both are the same for neighbouring windows, so a string gives two pieces for each place of its gram.
    """
    half = (length - gram) // 2
    width = min(16, half)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, part in _slices(batch, "string"):
                runs, context = Runs(part, length, gram), Runs(part, max(width, 1), max(width, 1)).grams
                window = np.flatnonzero(runs.valid)
                own = np.searchsorted(runs.begins, window, side="right") - 1
                value = np.repeat(runs.smallest[runs.begins], runs.sizes)[: len(runs.grams)]
                places = np.flatnonzero(runs.grams == value)
                at = places[np.searchsorted(places, window)]
                left = window <= at - half
                seen = context[np.where(left, at - half, at + gram + half - width)] if width else np.zeros(len(window), np.uint64)
                key = keyed(mix(seen + left.astype(np.uint64)) ^ runs.smallest[window])
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
                head = np.flatnonzero(new)
                start, size, own = window[head], np.diff(np.append(head, len(window))) + length - 1, own[head]
                offsets = np.concatenate([[0], np.cumsum(size)])
                flat = runs.raw[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
                string = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat)])
                rows = pa.array(own + i)
                first = pa.array(batch.column("start").to_numpy()[own + i] + start - runs.begins[own])
                yield pa.RecordBatch.from_arrays([pa.array(key[head].view(np.int64)), string, *(batch.column(c).take(rows) for c in DOC), first], names=["key", "string", *DOC, "start"])

    pieces = found.select("string", *DOC, "start").mapInArrow(lean(work, 2000), "key long, string binary, no_id boolean, id long, hash long, start long")
    return pieces.groupBy("key", "string").agg(F.min(F.struct(*DOC, "start")).alias("first")).select("key", "string", "first.*")


def _heavy(found: DataFrame) -> tuple[DataFrame, int]:
    """Keys whose strings hold more than HOT_BYTES, and the bytes of all strings."""
    sizes = found.groupBy("key").agg(F.sum(F.length("string")).alias("n"))
    return sizes.where(F.col("n") > HOT_BYTES).select("key"), sizes.agg(F.sum("n")).first()[0] or 0


def first_places(found: DataFrame, length: int, gram: int) -> DataFrame:
    """(DOC, ranges): the windows among the strings' that come first of their equals, as begins and ends one after another."""
    spark = found.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/passages-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    found = kept(found.select("key", "string", "first.*"), "strings")
    hot, total = _heavy(found)
    pieces = kept(cut_by_context(found.join(hot, "key", "left_semi"), length, gram), "pieces")
    still, more = _heavy(pieces)
    shards = max(1, -(-(total + more) // SHARD_BYTES))
    own = ["string", *DOC, "start"]
    by_key = found.join(hot, "key", "left_anti").unionByName(pieces.join(still, "key", "left_anti")).select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), *own)
    single = pieces.join(still, "key", "left_semi").select(*own, F.explode(F.sequence(F.lit(0), F.length("string") - length)).alias("at"))
    single = single.select(F.expr(f"substring(string, at + 1, {length})").alias("string"), F.struct(*DOC, (F.col("start") + F.col("at")).alias("start")).alias("first"))
    single = single.groupBy("string").agg(F.min("first").alias("first")).select(F.pmod(F.xxhash64("string"), F.lit(shards)).alias("shard"), "string", "first.*")
    dealt = by_key.unionByName(single).repartition(int(min(shards, 100_000)), "shard")
    out = dealt.groupBy("shard").applyInArrow(_firsts(length), "no_id boolean, id long, hash long, ranges array<long>")
    return kept(out.groupBy(*DOC).agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "firsts")


def spans_of(raw: bytes, repeated: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of bytes that repeated windows cover."""
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return starts, starts
    cuts = np.flatnonzero(np.diff(starts) > length)
    return starts[np.concatenate([[0], cuts + 1])], starts[np.concatenate([cuts, [len(starts) - 1]])] + length


def repeated_passages(docs: DataFrame, length: int = 100, gram: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, begins, ends, kept): for every text its runs of bytes covered by windows that also start earlier, and the rest of it.

    kept is binary, since a run may end inside a character.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), raw.alias("raw"))
    short = rows.where(F.octet_length("raw") < length).select(
        "doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), *(F.array().cast("array<long>").alias(c) for c in ("begins", "ends")), F.col("raw").alias("kept"))
    rows = rows.where(F.octet_length("raw") >= length).withColumn("hash", F.xxhash64("raw"))
    bits = docs.sparkSession.sparkContext.broadcast(gram_filter(rows, length, gram))
    first = first_places(strings(rows, bits, length, gram), length, gram)
    copy = F.row_number().over(Window.partitionBy(*DOC).orderBy(*DOC))
    held = rows.withColumn("copy", copy).join(first, DOC, "left").select("doc_id", "raw", F.when(F.col("copy") == 1, F.col("ranges")).alias("ranges"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bits.value
        for batch in batches:
            ranges = batch.column("ranges").to_pylist()
            for i, part in _slices(batch):
                runs = Runs(part, length, gram)
                key, start, size = runs.runs()
                met = _passes(marks, key)
                edge = np.zeros(len(runs.raw) + 1, np.int64)
                np.add.at(edge, start[met], 1)
                np.add.at(edge, start[met] + size[met], -1)
                repeated = np.cumsum(edge)[:-1] > 0
                out: tuple[list, list, list, list] = ([], [], [], [])
                for k, text in enumerate(part):
                    own = repeated[runs.begins[k] : runs.begins[k] + runs.sizes[k]]
                    pairs = ranges[i + k] or []
                    for lo, hi in zip(pairs[::2], pairs[1::2], strict=True):
                        own[lo:hi] = False
                    begins, ends = spans_of(text, own, length)
                    edges = [0, *np.stack([begins, ends], 1).ravel().tolist(), len(text)]
                    for values, value in zip(out, (len(text), begins, ends, b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])), strict=True):
                        values.append(value)
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, len(part)), *(pa.array(v, t) for v, t in zip(out, kinds, strict=True))], names=["doc_id", "n_bytes", "begins", "ends", "kept"])

    return held.mapInArrow(lean(work, 500), f"doc_id {kind}, n_bytes long, begins array<long>, ends array<long>, kept binary").unionByName(short)
