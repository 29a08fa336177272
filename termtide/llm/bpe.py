"""Byte-level BPE encoding and decoding with a transducer lexicon of frequent words.

Spark counts the pieces between spaces of all texts; the words of the most frequent ones (`lexicon_words` of
them, a bound on the file and not on the texts) are compiled with their ids into a minimal acyclic transducer
(see `lexicon`), which tasks map from a file. A task works on runs of texts at a time: it cuts them into the words of
the splitting pattern by the kinds of their characters, brings equal words together by a hash whose hits are
compared byte by byte, walks the distinct words through the transducer, and merges those it lacks exactly,
lowest rank first. Decoding joins the bytes of the ids. Nothing is remembered from one run to the next.

Null texts count as empty and give no ids; texts of any length are encoded whole, in memory that grows with the
longest one; a special token's string in a text gives its id, as in the tokenizers library; pairs of one rank merge
from the left; repeated rows give repeated results; an empty table gives none; other columns are passed through by
`encode`, where a column that has the name of an added one is replaced, and ignored by `digests`.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.llm.common import cut, lean, texts
from termtide.llm.lexicon import Lexicon, compile_lexicon
from termtide.llm.shingles import U, mix

WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Kinds of characters in the splitting pattern, and the characters (besides letters) that it names.
LETTER, NUMBER, OTHER, SPACE = range(4)
BLANK, QUOTE = ord(" "), ord("'")
#: Words of more bytes are merged one by one.
LONG_WORD = 48
#: Characters of texts that are encoded at a time, and most characters of a piece or word that may enter the lexicon.
RUN, LEXICON_CHARS = 700_000, 16
#: Masks of the first bytes of eight.
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable Latin-1 as itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def char_kinds() -> np.ndarray:
    """The kind of every code point."""
    code = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = "".join(map(chr, code.tolist()))
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            kinds[code[m.start() : m.end()]] = kind
    return kinds


def word_starts(chars: np.ndarray, begins: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the words of the splitting pattern start in texts that stand one after another from `begins` on."""
    n = len(chars)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds[chars]
    new = np.ones(n + 2, bool)  # a run of one kind starts here; two more places, so that one may look ahead
    new[1:n] = kind[1:] != kind[:-1]
    new[begins] = True
    begin = np.zeros(n + 2, bool)
    begin[begins] = True
    begin[n:] = True
    start = new.copy()
    # the last blank before a word is its own, any other last space is a word, and spaces before that are one
    behind = np.flatnonzero(new[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~begin[1:n]) + 1
    start[behind - 1] = True
    start[behind[chars[behind - 1] == BLANK]] = False
    # a quote alone before a letter takes s, t, m, d, re, ve or ll with it
    quote = np.flatnonzero(chars == QUOTE)
    quote = quote[start[quote] & (quote + 1 < n)]
    quote = quote[~begin[quote + 1] & (kind[np.minimum(quote + 1, n - 1)] == LETTER)]
    if len(quote):
        one, two = chars[quote + 1], np.where(begin[quote + 2], 0, chars[np.minimum(quote + 2, n - 1)])
        pair = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(pair, 2, 0))
        quote, taken = quote[taken > 0], taken[taken > 0]
        start[quote + 1] = False
        start[quote + 1 + taken] = True
    return np.flatnonzero(start[:n])


def _block(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, j: int) -> np.ndarray:
    """Bytes 8j to 8j + 7 of words as numbers, without what lies behind a word; raw has eight bytes more at its end."""
    view = np.ndarray(len(raw) - 7, "<u8", raw.data, strides=(1,))
    return view[starts + 8 * j] & FIRST[np.minimum(sizes - 8 * j, 8)]


def distinct(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashed=mix) -> tuple[np.ndarray, np.ndarray]:
    """(an occurrence of each distinct word, the number of its distinct word for each word)."""
    code = sizes.astype(np.uint64)
    for j in range(LONG_WORD // 8):
        own = np.flatnonzero((sizes > 8 * j) & (sizes <= LONG_WORD))
        code[own] = hashed(code[own] * U(0x9E3779B97F4A7C15) ^ _block(raw, starts[own], sizes[own], j))
    long: dict[bytes, int] = {}
    for w in np.flatnonzero(sizes > LONG_WORD).tolist():
        code[w] = long.setdefault(raw[starts[w] : starts[w] + sizes[w]].tobytes(), w)
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    same = sizes == sizes[first][number]
    for j in range(LONG_WORD // 8):
        own = np.flatnonzero(same & (sizes > 8 * j) & (sizes <= LONG_WORD))
        other = first[number[own]]
        same[own] = _block(raw, starts[own], sizes[own], j) == _block(raw, starts[other], sizes[other], j)
    apart = np.flatnonzero(~same)  # unequal words of one hash go on as words of their own
    number[apart] = len(first) + np.arange(len(apart))
    return np.concatenate([first, apart]), number


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of `flat` from `starts` on, one after another."""
    kind = np.int32 if len(flat) < 2**31 else np.int64
    ends = np.cumsum(sizes)
    at = np.repeat((starts - (ends - sizes)).astype(np.int64), sizes)
    at += np.arange(len(at))
    return flat[at.astype(kind, copy=False)]


def _laid(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte strings one after another: the bytes, where each starts, and its size."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.laid = _laid(self.token_bytes)
        self.names = _laid([b"%d," % i for i in range(size)])
        self.byte_ids = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocab[a] << 20 | vocab[b], (rank, vocab[a + b]))
        self.kinds = char_kinds()
        self._table()

    def _table(self) -> None:
        """The ranks as an open hash table in arrays, for many lookups at once; the last rank stands for none."""
        self.bits = max(4, (4 * len(self.ranks) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.found = np.full(1 << self.bits, len(self.ranks), np.int32)
        self.made = np.zeros(len(self.ranks) + 1, np.int32)
        for number, (key, (_, new)) in enumerate(sorted(self.ranks.items(), key=lambda x: x[1])):
            at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - self.bits)
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.found[at], self.made[number] = key, number, new

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(key), len(self.made) - 1, np.int32)
        open_ = np.arange(len(key))
        while len(open_):
            seen = self.keys[at]
            hit = seen == key[open_]
            out[open_[hit]] = self.found[at[hit]]
            on = ~hit & (seen >= 0)
            open_, at = open_[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def merge_many(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Exact ids of many words of a buffer, in the shape of `_laid`: words of about one length take a step at a time."""
        flat, at, count, end = [], np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
        for low, high in ((1, 6), (7, 10), (11, 16), (17, 28), (29, LONG_WORD)):
            chosen = np.flatnonzero((sizes >= low) & (sizes <= high))
            for i in range(0, len(chosen), 20_000):
                part = chosen[i : i + 20_000]
                ids, own = self._merge_rows(raw, starts[part], sizes[part], high)
                flat.append(ids)
                count[part], at[part] = own, end + np.cumsum(own) - own
                end += len(ids)
        for w in np.flatnonzero(sizes > LONG_WORD).tolist():
            flat.append(np.array(self.merge(raw[starts[w] : starts[w] + sizes[w]].tobytes()), np.int32))
            count[w], at[w] = len(flat[-1]), end
            end += len(flat[-1])
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), at, count

    def _merge_rows(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of at most `width` bytes one after another, and how many each has."""
        none, n = len(self.made) - 1, len(starts)
        column = np.arange(width, dtype=np.int16)
        ids = self.byte_ids[raw[np.minimum(starts[:, None] + column, len(raw) - 1)]]
        ranks = np.full((n, width), none, np.int32)
        pair = column[:-1] + 1 < sizes[:, None]
        ranks[:, :-1][pair] = self._rank(ids[:, :-1][pair], ids[:, 1:][pair])
        size, live, row = sizes.copy(), np.arange(n), np.arange(n)
        result, count = np.empty((n, width), np.int32), np.empty(n, np.int64)
        while True:
            best = ranks.argmin(axis=1)
            rank = ranks[row, best]
            on = np.flatnonzero(rank < none)
            if 4 * len(on) < 3 * len(live):  # lay finished words aside
                result[live], count[live] = ids, size
                if not len(on):
                    return result[column < count[:, None]], count
                ids, ranks, size, live, best, rank = ids[on], ranks[on], size[on], live[on], best[on], rank[on]
                row = on = np.arange(len(live))
            at, made = best[on], self.made[rank[on]]
            edge = np.full(len(live), width, np.int16)
            edge[on] = at
            np.copyto(ids[:, :-1], ids[:, 1:], where=column[:-1] > edge[:, None])
            np.copyto(ranks[:, :-1], ranks[:, 1:], where=column[:-1] >= edge[:, None])
            ids[on, at] = made
            size[on] -= 1
            right, left = at + 1 < size[on], at > 0
            ranks[on[~right], at[~right]] = none
            where, place = np.concatenate([on[right], on[left]]), np.concatenate([at[right], at[left] - 1])
            ranks[where, place] = self._rank(ids[where, place], ids[where, place + 1])

    def merge(self, word: bytes) -> list[int]:
        """Exact ids of one word of any length, with a heap."""
        ids = [int(self.byte_ids[b]) for b in word]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j >= 0 and (found := self.ranks.get(ids[i] << 20 | ids[j])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    def lexicon(self, words: list[str]) -> bytes:
        """The compiled lexicon of these words and of the special tokens."""
        raw = [w.encode() for w in words]
        buffer, starts, sizes = _laid([*raw, b"\0" * 8])
        flat, at, count = self.merge_many(buffer, starts[:-1], sizes[:-1])
        entries = {w: flat[i : i + n].tolist() for w, i, n in zip(raw, at.tolist(), count.tolist(), strict=True)}
        return compile_lexicon(entries | {s.encode(): [i] for s, i in self.special.items()})


class Codec:
    """Encoder and decoder of one task; the lexicon holds the special tokens, as `Merges.lexicon` makes it."""

    def __init__(self, merges: Merges, lexicon: bytes):
        self.merges, self.lexicon = merges, Lexicon(lexicon)
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(merges.special, key=len, reverse=True)) + ")") if merges.special else None

    def _ids(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, in the shape of `_laid`: from the transducer, and merged where it lacks them."""
        number = self.lexicon.find(raw, starts, sizes)
        lacks = number < 0
        flat, at, count = self.merges.merge_many(raw, starts[lacks], sizes[lacks])
        known, begin = self.lexicon.ids, self.lexicon.starts
        begins, counts = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        begins[lacks], counts[lacks] = len(known) + at, count
        own = number[~lacks]
        begins[~lacks], counts[~lacks] = begin[own], begin[own + 1] - begin[own]
        return np.concatenate([known, flat]), begins, counts

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        parts, owner = batch, None
        if any(s in text for s in self.merges.special for text in batch):
            cut_up = [self.split.split(text) for text in batch]
            parts, owner = [*chain.from_iterable(cut_up)], np.repeat(np.arange(len(batch)), [len(c) for c in cut_up])
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = np.cumsum(sizes) - sizes
        joined = "".join(parts)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = word_starts(chars, begins[sizes > 0], self.merges.kinds)
        if owner is not None:  # a special token is one word
            special = np.array([p in self.merges.special for p in parts])
            part = np.searchsorted(begins, starts, side="right") - 1
            starts = starts[~special[part] | (starts == begins[part])]
        raw = np.frombuffer(joined.encode() + b"\0" * 8, np.uint8)
        first_words = np.searchsorted(starts, np.append(begins, len(chars)))
        if len(raw) - 8 != len(chars):
            width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
            starts = (np.cumsum(width) - width)[starts]
        widths = np.diff(starts, append=len(raw) - 8)
        first, number = distinct(raw, starts, widths)
        flat, at, count = self._ids(raw, starts[first], widths[first])
        own = count[number]
        ids = ragged(flat, at[number], own)
        per_part = np.diff(np.concatenate([[0], np.cumsum(own)])[first_words])
        return ids, per_part if owner is None else np.bincount(owner, per_part, len(batch)).astype(np.int64)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> Iterator[str]:
        """The text of each run of ids."""
        raw, _, ends = self._written(ids, sizes, self.merges.laid)
        for i, j in zip([0, *ends], ends, strict=False):
            yield raw[i:j].decode("utf-8", "replace")

    def decimals(self, ids: np.ndarray, sizes: np.ndarray) -> Iterator[bytes]:
        """Each run of ids as decimal numbers with commas between."""
        raw, _, ends = self._written(ids, sizes, self.merges.names)
        for i, j in zip([0, *ends], ends, strict=False):
            yield raw[i : max(i, j - 1)]

    @staticmethod
    def _written(ids: np.ndarray, sizes: np.ndarray, laid: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray, list[int]]:
        flat, at, size = laid
        own = size[ids]
        ends = np.concatenate([[0], np.cumsum(own)])[np.cumsum(sizes)]
        return ragged(flat, at[ids], own).tobytes(), own, ends.tolist()


def _runs(batch: list[str], limit: int) -> Iterator[list[str]]:
    """Runs of texts of about so many characters."""
    own, size = [], 0
    for text in batch:
        own.append(text)
        size += len(text)
        if size >= limit:
            yield own
            own, size = [], 0
    if own:
        yield own


def piece_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): how often each piece between spaces occurs in all texts, for pieces that may enter the lexicon."""
    pieces = docs.select(F.explode(F.split(text_col, " ")).alias("word"))
    return pieces.where(F.length("word").between(1, LEXICON_CHARS)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def frequent_words(counted: DataFrame, most: int) -> DataFrame:
    """The `most` most frequent of the counted words that occur more than once (ties by text).

    A histogram of counts in quarter powers of two gives a lower bound first, so that few more than `most`
    rows are sorted however many tasks hold words.
    """
    counted = cut(counted.where(F.col("n") > 1))
    step = F.floor(F.log2("n") * 4).cast("int")
    held, bound = 0, 0
    for r in sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True):
        held, bound = held + r["count"], r["step"]
        if held >= most:
            break
    return counted.where(step >= bound).orderBy(F.desc("n"), "word").limit(most)


def build_lexicon(docs: DataFrame, merges: Merges, text_col: str = "text", lexicon_words: int = 65_536) -> bytes:
    """The compiled lexicon of the words of the most frequent pieces; `lexicon_words` bounds both."""
    words: Counter[str] = Counter()
    for piece, n in frequent_words(piece_counts(docs, text_col), lexicon_words).collect():
        for word in WORD.findall(" " + piece):
            words[word] += n
    return merges.lexicon([w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:lexicon_words]])


def _codecs(docs: DataFrame, path: str, text_col: str, lexicon_words: int):
    merges = Merges(path)
    return docs.sparkSession.sparkContext.broadcast((merges, build_lexicon(docs, merges, text_col, lexicon_words)))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = 65_536) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each text encoded and decoded again."""
    sent = _codecs(docs, path, text_col, lexicon_words)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*sent.value)
        for batch in batches:
            at = 0
            for own in _runs(texts(batch, text_col), RUN):
                ids, sizes = codec.encode(own)
                hashed = [hashlib.sha256(line).hexdigest() for line in codec.decimals(ids, sizes)]
                decoded = [hashlib.sha256(text.encode()).hexdigest() for text in codec.decode(ids, sizes)]
                yield pa.RecordBatch.from_arrays([batch.column(id_col).slice(at, len(own)), pa.array(sizes), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())], schema.names)
                at += len(own)

    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids", check_col: str | None = None, lexicon_words: int = 65_536) -> DataFrame:
    """The table with the ids of each text as an array in `ids_col`, which replaces a column of that name.

    With `check_col` the ids are decoded at once, and the column says whether that gives the text again.
    """
    sent = _codecs(docs, path, text_col, lexicon_words)
    kept = docs.drop(ids_col, *([check_col] if check_col else []))
    more = [T.StructField(check_col, T.BooleanType())] if check_col else []
    schema = T.StructType([*kept.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType())), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*sent.value)
        for batch in batches:
            at = 0
            for own in _runs(texts(batch, text_col), RUN):
                ids, sizes = codec.encode(own)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                same = [pa.array([a == b for a, b in zip(own, codec.decode(ids, sizes), strict=True)])] if check_col else []
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(own)).columns, column, *same], schema.names)
                at += len(own)

    return kept.mapInArrow(lean(run), schema)


def decode(table: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """The table with the text of each array of ids in `text_col`; a null array gives null."""
    sent = table.sparkSession.sparkContext.broadcast(Merges(path))
    kept = table.drop(text_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes = sent.value.token_bytes
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                out = [None if ids is None else b"".join(map(token_bytes.__getitem__, ids)).decode("utf-8", "replace") for ids in (x.as_py() for x in batch.column(ids_col))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], schema.names)

    return kept.mapInArrow(lean(run), schema)
