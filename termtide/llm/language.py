"""Language ID with string kernels, Nystrom landmarks and one-versus-rest kernel ridge regression.

The kernel of two texts is the number of n-grams (1 to 4 bytes of the lower-cased UTF-8 text, any number
of times) that both contain, over the geometric mean of their numbers of n-grams: a blended-spectrum
presence kernel. N-grams are told apart by a hash of `2 ** BITS` values. A text of more than `PIECE`
characters is cut into even pieces, so that flags stay sparse however long it is; its scores are the mean
of its pieces' scores by length (pieces without a letter do not count), and a training row gives one piece,
chosen by a hash. All languages are learned: a bounded sample of labelled rows of each is the training set
(`per_language`, less where there are many languages: `MOST_ROWS` in all, `LEAST_ROWS` of each at least):
the distinct rows with the smallest hashes of id and text, so that null or repeated ids are as good as any.
Its first rows are the landmarks. The ridge systems are solved once on the driver; tasks score whole texts
in batches of matrix products.

Texts that are null or hold no letter (Unicode category L, here and in training) get `und` and score 0. Without
labelled rows every text gets `und`. Of languages with equal scores the first by name is taken. Repeated rows get
equal results and train once; texts of any length are scored whole; an empty table gives none; columns named like
the added ones are replaced, others ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from termtide.llm.common import lean, texts

BITS, ORDERS, BATCH = 14, 4, 256
MULTIPLIER = np.uint32(2654435761)
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Characters of a text whose n-grams are hashed at a time.
SLICE = 1_000_000
#: Most characters of a piece of a text that is scored on its own.
PIECE = 8192
#: Training rows of all languages together, and of each language at least, as far as it has them.
MOST_ROWS, LEAST_ROWS = 20_000, 8
#: Landmarks of each language at least, and most landmarks so gained.
LANDMARKS_EACH, MOST_LANDMARKS = 2, 1024


def mark(text: str, row: np.ndarray) -> None:
    """Set the cells of the text's n-grams in a row of 2 ** BITS flags."""
    low = text.lower()
    for start in range(0, len(low), SLICE):
        raw = np.frombuffer(low[start : start + SLICE + ORDERS].encode(), np.uint8).astype(np.uint32)
        code = raw
        for n in range(1, ORDERS + 1):
            if n > 1:
                code = (code[:-1] << np.uint32(8)) | raw[n - 1 :]
            row[((code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * MULTIPLIER) >> np.uint32(32 - BITS)] = 1


def pieces(text: str) -> list[str]:
    """The text in even pieces of at most PIECE characters, those without a letter left out unless all are."""
    n = -(-len(text) // PIECE)
    if n <= 1:
        return [text]
    cuts = [len(text) * i // n for i in range(n + 1)]
    out = [text[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
    return [p for p in out if LETTER.search(p)] or out[:1]


def presence(batch: list[str]) -> np.ndarray:
    out = np.zeros((len(batch), 1 << BITS), np.float32)
    for text, row in zip(batch, out, strict=True):
        mark(text, row)
    return out


@dataclass
class Model:
    """Packed n-gram flags of the landmarks, and for each language a weight per landmark and a constant."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    constants: np.ndarray

    def unpacked(self) -> tuple[np.ndarray, np.ndarray]:
        flags = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        return flags.T.copy(), np.sqrt(flags.sum(axis=1))


def kernel(flags: np.ndarray, other: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Kernel values of each row of flags with each landmark (columns of other)."""
    own = np.sqrt(np.maximum(flags.sum(axis=1), 1))
    return (flags @ other) / (own[:, None] * np.maximum(norms, 1))


def fit(packed: np.ndarray, langs: list[str], landmarks: int, ridge: float) -> Model:
    """Kernel ridge regression in the space that the landmarks span, from packed flags of the training rows."""
    languages = sorted(set(langs))
    number = {lang: i for i, lang in enumerate(languages)}
    own = np.array([number[lang] for lang in langs])
    chosen = np.unpackbits(packed[:landmarks], axis=1).astype(np.float32)
    norms = np.sqrt(chosen.sum(axis=1))
    among = kernel(chosen, chosen.T, norms).astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    parts = (np.unpackbits(packed[i : i + BATCH], axis=1).astype(np.float32) for i in range(0, len(packed), BATCH))
    phi = np.concatenate([kernel(part, chosen.T, norms).astype(np.float64) @ root for part in parts])
    mean, ymean = phi.mean(axis=0), np.bincount(own, minlength=len(languages)) / len(own)
    phi -= mean
    sums = np.zeros((len(languages), phi.shape[1]))
    np.add.at(sums, own, phi)
    beta = np.linalg.solve(phi.T @ phi + ridge * len(phi) * np.eye(phi.shape[1]), sums.T)
    return Model(languages, packed[:landmarks].copy(), (root @ beta).astype(np.float32), (ymean - mean @ beta).astype(np.float32))


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = 800, landmarks: int = 160, ridge: float = 1e-4) -> Model | None:
    """Fit on a bounded number of distinct rows of each language; tasks send flags, not texts."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    known = known.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("hash"), F.col(text_col).alias("text"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("n")).collect()
    if not counts:
        return None
    per_language = min(per_language, max(LEAST_ROWS, MOST_ROWS // len(counts)))
    landmarks = max(landmarks, min(LANDMARKS_EACH * len(counts), MOST_LANDMARKS))
    # hashes are uniform: a slice of them holds about four times the distinct rows wanted (and 64 more, for few are
    # wanted of many languages), so the smallest are in it and few rows leave their tasks
    shares = [(r["lang"], min(1.0, (4 * per_language + 64) / r["n"])) for r in counts]
    highest = [(name, int(-(2**63) + share * (2**64 - 1) - 1) if share < 1 else 2**63 - 1) for name, share in shares]
    bounds = F.broadcast(labelled.sparkSession.createDataFrame(highest, "lang string, highest long"))
    order = Window.partitionBy("lang").orderBy("hash")
    sample = (
        known.join(bounds, "lang").where(F.col("hash") <= F.col("highest")).groupBy("lang", "hash").agg(F.first("text").alias("text"))
        .withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= per_language).select("turn", "lang", "text")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts(batch):
                flags, parts = np.zeros(1 << BITS, np.uint8), pieces(text)
                mark(parts[zlib.crc32(text.encode()) % len(parts)], flags)
                rows.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("turn"), batch.column("lang"), pa.array(rows, pa.binary())], ["turn", "lang", "flags"])

    rows = sorted(tuple(r) for r in sample.mapInArrow(lean(pack), "turn int, lang string, flags binary").collect())
    if not rows:
        return None
    packed = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
    return fit(packed, [r[1] for r in rows], landmarks, ridge)


def score(batch: list[str], model: Model | None, unpacked: tuple[np.ndarray, np.ndarray] | None) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    if model is None:
        return [UNKNOWN] * len(batch), [0.0] * len(batch)
    total = np.zeros((len(batch), len(model.languages)))
    weight = np.zeros(len(batch))
    waiting: list[tuple[int, str]] = []

    def flush() -> None:
        out = kernel(presence([p for _, p in waiting]), *unpacked) @ model.weights + model.constants
        rows, sizes = [i for i, _ in waiting], np.array([max(1, len(p)) for _, p in waiting])
        np.add.at(total, rows, out * sizes[:, None])
        np.add.at(weight, rows, sizes)
        waiting.clear()

    for i, text in enumerate(batch):
        for part in pieces(text):
            waiting.append((i, part))
            if len(waiting) == BATCH:
                flush()
    if waiting:
        flush()
    total /= np.maximum(weight, 1)[:, None]
    best = total.argmax(axis=1)
    known = [LETTER.search(text) is not None for text in batch]
    langs = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
    return langs, [min(1.0, max(0.0, s)) if k else 0.0 for s, k in zip(total[np.arange(len(batch)), best].tolist(), known, strict=True)]


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The table with `lang_pred` and `score` (which replace columns of those names)."""
    kept = docs.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        unpacked = model.unpacked() if model else None
        for batch in batches:
            langs, scores = score(texts(batch, text_col), model, unpacked)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return kept.mapInArrow(lean(run), schema)


def keep_known(docs: DataFrame, model: Model | None, text_col: str = "text", least: float = 0.2) -> DataFrame:
    """The rows whose text has a language with a score of `least` or more, all columns; without a model, all rows with a letter."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        unpacked = model.unpacked() if model else None
        for batch in batches:
            column = texts(batch, text_col)
            if model is None:
                mask = [LETTER.search(t) is not None for t in column]
            else:
                langs, scores = score(column, model, unpacked)
                mask = [x != UNKNOWN and s >= least for x, s in zip(langs, scores, strict=True)]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fitting) -> Model | None:
    """A model from the rows that are not held out."""
    return train(docs.where(~held_out(id_col)), id_col, text_col, lang_col, **fitting)


def held_out(id_col: str):
    """Rows never learned from: crc32 of the id as text has remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fitting) -> DataFrame:
    """(id, held_out, lang_pred, score) of each row."""
    model = learn(docs, id_col, text_col, lang_col, **fitting)
    return predict(docs.select(id_col, text_col, held_out(id_col).alias("held_out")), model, text_col).select(id_col, "held_out", "lang_pred", "score")
