"""Two tokenizers' views of one text: which tokens overlap, where both end, and how often ids meet.

A text is read as a space and itself. Both tokenizers' tokens are laid out as byte ranges; `merge_asof`, keyed by
document, finds for each token's start the other side's token that covers it. Both directions together are all overlaps,
each once: of two that overlap, the one that starts later starts inside the other. Places where tokens of both end cut
the document into groups.

A null or empty text, or one whose tokens don't spell the space and the text on either side, has no tokens. Long texts
go through whole, alone in their batch. Rows that repeat, or share an id, count as documents of their own; an empty
table gives no rows, and other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termtide.llm.common import lean, shared_dir, texts

#: Bytes of text aligned at a time, rows of it at most, and rows of pair counts that may be broadcast.
BATCH_BYTES, BATCH_ROWS, FEW_PAIRS = 1_000_000, 2000, 1_000_000
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for bytes: printable ones stand for themselves, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Characters that all Unicode versions class alike.
SETTLED = re.compile("[\x00-\u024f\u2010-\u2027]*")


@dataclass
class Pair:
    """Both tokenizers and each token's bytes; quick: A's merges as ranks, which gives settled text the same ids sooner."""

    a: object
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    quick: object = None

    def a_ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [self.quick.encode_to_numpy(t, disallowed_special=()) if self.quick and SETTLED.fullmatch(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.a.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False) if rest else [], strict=True):
            out[i] = np.array(e.ids, np.int64)
        return out


def _ranked(path: str, names: list[bytes]):
    """The same encoder by ranks, where the file's tokens are the bytes and its merges in order, and nothing else changes the text."""
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    model, split = held["model"], held.get("pre_tokenizer") or {}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    in_order = [model["vocab"].get(m) for m in merged] == list(range(256, 256 + len(merged)))
    plain = held.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not model.get("ignore_merges")
    if not in_order or not plain:
        return None
    import tiktoken
    from public_tokenizers import PATTERN

    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(names[: 256 + len(merged)])}, special_tokens={})


@functools.lru_cache(2)
def tokenizers(path_a: str, path_b: str) -> Pair:
    """A byte-level tokenizers file and a sentencepiece model; loaded once a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True  # their strings in a text are ordinary text
    a.no_truncation()
    a.no_padding()
    letters = _byte_letters()
    spelled = [a.id_to_token(i) or "" for i in range(a.get_vocab_size())]
    a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in spelled]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    return Pair(a, b, a_bytes, b_bytes, _ranked(path_a, a_bytes))


def covering(left: np.ndarray, left_doc: np.ndarray, right: np.ndarray, right_doc: np.ndarray) -> np.ndarray:
    """For each start on the left the number of the token on the right that covers it; starts grow within and across documents."""
    found = pd.merge_asof(
        pd.DataFrame({"at": left, "doc": left_doc}), pd.DataFrame({"at": right, "doc": right_doc, "token": np.arange(len(right))}), on="at", by="doc")
    return found["token"].to_numpy()


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1 from the left, with room for one byte behind them, and how many there are."""
    wide = len(str(max(n - 1, 0)))
    sizes = np.array([len(str(i)) for i in range(n)], np.int64)
    text = "".join(str(i).ljust(wide + 1, "0") for i in range(n))
    return np.frombuffer(text.encode(), np.uint8).reshape(n, wide + 1), sizes


@functools.lru_cache(4)
def digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _digits(n)


def group_texts(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups written as `a1,a2|b1;a3|b2`, and where each group ends in these bytes; last: which groups end a document.

    Groups count from 0 without holes and hold tokens of both sides.
    """
    n = len(last)
    a_before, b_before = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=n))]), np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=n))])
    a_at, b_at = np.arange(len(a)) + b_before[a_group], np.arange(len(b)) + a_before[b_group + 1]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[a_at], ids[b_at] = a, b
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[a_at[a_before[1:] - 1]], mark[b_at[b_before[1:] - 1]] = ord("|"), ord(";")
    drop = np.zeros(len(ids), bool)
    drop[b_at[b_before[1:][last] - 1]] = True
    table, sizes = digits(int(max(a.max(), b.max())) + 1 if len(ids) else 1)
    written, size = table[ids], sizes[ids]
    written[np.arange(len(ids)), size] = mark
    size = size + ~drop
    ends = np.cumsum(size)
    return written[np.arange(written.shape[1]) < size[:, None]], ends[b_at[b_before[1:] - 1]]


def _sides(batch: list[str], pair: Pair) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Each text's ids on both sides, or nothing where they don't spell it."""
    a = pair.a_ids([" " + t for t in batch])
    b = pair.b.encode(batch, out_type=int, num_threads=1)
    out = []
    for text, x, y in zip(batch, a, b, strict=True):
        raw = (" " + text).encode()
        ok = text and b"".join(map(pair.a_bytes.__getitem__, x.tolist())) == raw and b"".join(map(pair.b_bytes.__getitem__, y)) == raw
        out.append((x.astype(np.int64), np.array(y, np.int64)) if ok else None)
    return out


def _lists(n: int, rows: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]), pa.int32()), pa.array(values, kind))


def align_batch(batch: list[str], pair: Pair) -> list[pa.Array]:
    """The columns of ALIGNED for a few texts; a pair's number is its id on side A times B's vocabulary plus that on side B."""
    sides, n = _sides(batch, pair), len(batch)
    held = [(d, *s) for d, s in enumerate(sides) if s]
    none = np.zeros(0, np.int64)
    a, b = (np.concatenate([h[i] for h in held]) if held else none for i in (1, 2))
    a_doc, b_doc = (np.repeat(np.array([h[0] for h in held], np.int64), [len(h[i]) for h in held]) if held else none for i in (1, 2))
    # the texts lie one behind another, so that ranges of all documents grow together
    a_end, b_end = (np.cumsum(np.array([len(x) for x in names], np.int64)[ids]) for ids, names in ((a, pair.a_bytes), (b, pair.b_bytes)))
    a_start, b_start = np.concatenate([[0], a_end])[: len(a)], np.concatenate([[0], b_end])[: len(b)]
    if held:
        over, under = covering(a_start, a_doc, b_start, b_doc), covering(b_start, b_doc, a_start, a_doc)
        later = b_start != a_start[under]  # a pair that starts together is found from both sides
        link_a, link_b = np.concatenate([np.arange(len(a)), under[later]]), np.concatenate([over, np.flatnonzero(later)])
    else:
        link_a = link_b = none
    ends = np.intersect1d(a_end, b_end, assume_unique=True)
    end_doc = a_doc[np.searchsorted(a_end, ends)] if len(ends) else none
    last = np.concatenate([end_doc[1:] != end_doc[:-1], [True]]) if len(ends) else np.zeros(0, bool)
    flat, cuts = group_texts(a, np.searchsorted(ends, a_end), b, np.searchsorted(ends, b_end), last) if held else (np.zeros(0, np.uint8), none)
    bounds = np.zeros(n + 1, np.int64)
    bounds[end_doc[last] + 1] = cuts[last]
    groups = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(np.maximum.accumulate(bounds).astype(np.int32)), pa.py_buffer(flat)])
    n_b, space = len(pair.b_bytes), len(pair.a_bytes) * len(pair.b_bytes)
    codes, times = np.unique(a_doc[link_a] * space + a[link_a] * n_b + b[link_b], return_counts=True)
    rows = codes // space
    count = lambda docs: pa.array(np.bincount(docs, minlength=n), pa.int64())
    return [count(a_doc), count(b_doc), count(end_doc), count(a_doc[link_a]), groups, _lists(n, rows, codes % space, pa.int64()), _lists(n, rows, times, pa.int32())]


def _runs(batch: list[str]) -> Iterator[tuple[int, int]]:
    """Places of runs of texts of bounded size."""
    begin, size = 0, 0
    for i, text in enumerate(batch):
        if i > begin and (size + len(text) > BATCH_BYTES or i - begin >= BATCH_ROWS):
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(batch):
        yield begin, len(batch)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the columns of ALIGNED: counts, the groups written out, the distinct id pairs linked and how often each is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(path_a, path_b)
        for batch in batches:
            held = texts(batch)
            for i, j in _runs(held):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *align_batch(held[i:j], pair)], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(work, 500), f"doc_id {kind}, {ALIGNED}")


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): how many documents hold an id pair linked, and whether no pair of its A id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(F.floor(F.col("pair") / n_b))
    return counts.withColumn("best", F.col("n") == F.max("n").over(own))


def alignment_figures(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its counts, the digest of its groups ('' without tokens), and its links rated by the counts of all documents.

    Aligned rows are written once to the shared folder and read twice: their pairs are counted, then rated. Counts are
    broadcast up to FEW_PAIRS rows, and joined by a shuffle beyond.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/aligned-{uuid.uuid4().hex}"
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = align(docs, path_a, path_b, id_col, text_col).withColumn("groups_sha256", digest).drop("groups").withColumn("rid", F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    pair_counts(rows, len(tokenizers(path_a, path_b).b_bytes)).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    if counts.limit(FEW_PAIRS + 1).count() <= FEW_PAIRS:
        counts = F.broadcast(counts)
    own = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    links = rows.select(*own, F.explode_outer(F.arrays_zip("pairs", "times")).alias("l")).select(*own, F.col("l.pairs").alias("pair"), F.col("l.times").cast("long").alias("times"))
    rated = links.join(counts, "pair", "left").groupBy(*own).agg(
        F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), F.lit(0)).alias("n_best"), F.coalesce(F.sum(F.col("n") * F.col("times")), F.lit(0)).alias("count_sum"))
    return rated.drop("rid")
