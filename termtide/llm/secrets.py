"""Secret scans: fixed patterns, and a battery of randomness tests over unexplained tokens.

Three fixed kinds (assign, access, hex) are always reported. Every other token of 20 symbols or more that mixes letters
and digits is a candidate (letters alone are names and words, digits alone numbers: neither is ever reported): its encoding is inferred, the smallest of hex,
base32, base36, base58, base62 and base64 that holds it, and a chi-squared test of alphabet uniformity, a
runs test and a lag-one serial correlation test ask whether it looks like uniform random symbols. The
three p-values join by Fisher's method.

What is reported (kind `random`) is what is rejected as text: the ratio of a token's uniform to its text
probability (`textlike`) is x or more with probability 1 / x at most where the token is text, so 1 / ratio is
its p-value under text. Within each length class Benjamini-Hochberg control of those p-values at level `q`
bounds the share of text among the reported tokens. Of the rejected ones only those are left out that the
battery in turn rejects as random at level `q`, so that a constructed token which is neither is no secret.
Strong evidence is far below any bound that other tokens of a corpus can set: a class of m candidates asks for
q / m at the least, and 40 random base64 symbols give about 1e-17.

Null texts count as empty; empty texts give a row without spans; texts of any length are scanned whole, in time
that grows with their length and the logarithm of their spans; tokens of equal evidence share one decision;
repeated rows give repeated results; an empty table gives an empty result; columns other than id and text are
ignored (`scan`) or passed through (`redact`).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.llm.common import Cover, cut, lean, texts
from termtide.llm.textlike import evidence

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")

ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base58", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
#: Lower ends of the length classes.
LENGTHS = (20, 28, 40, 64, 128)
#: p-values are counted in bins of a twentieth of a power of ten; the last bin holds all smaller ones.
BINS_PER_DECADE, LAST_BIN = 20, 800

FOUND = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("rank", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("stratum", T.IntegerType()), T.StructField("bin", T.IntegerType()), T.StructField("text_bin", T.IntegerType()),
]))


def chi2_tail(x: float, k: float) -> float:
    """Upper tail of chi-squared with k degrees of freedom (Wilson-Hilferty)."""
    v = 2 / (9 * k)
    return 0.5 * math.erfc(((max(x, 0) / k) ** (1 / 3) - 1 + v) / math.sqrt(2 * v))


def fisher(ps: tuple[float, float, float]) -> float:
    h = -sum(math.log(max(p, 1e-300)) for p in ps)
    return math.exp(-h) * (1 + h + h * h / 2)


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def p_bin(p: float) -> int:
    return min(LAST_BIN, int(-math.log10(max(p, 1e-300)) * BINS_PER_DECADE))


def infer(token: str) -> tuple[list[int], int]:
    """Symbol numbers of the token, and size of the smallest alphabet that holds it."""
    body = token.rstrip("=")
    bare = body.replace("-", "").replace("_", "")
    for name, alphabet in ENCODINGS[:-1]:
        # dashes part groups of the small alphabets, which are written in one case
        form = bare if len(alphabet) <= 36 else body
        for text in (form, form.lower()) if name != "base32" and len(alphabet) <= 36 else (form,):
            at = [alphabet.find(c) for c in text]
            if at and min(at) >= 0:
                return at, len(alphabet)
    return base64_symbols(body), 64


def base64_symbols(body: str) -> list[int]:
    return [ENCODINGS[-1][1].find({"-": "+", "_": "/"}.get(c, c)) for c in body]


def battery(at: list[int], k: int) -> float:
    """Combined p-value of the hypothesis that the symbols are independent and uniform."""
    n = len(at)
    counts: dict[int, int] = {}
    for a in at:
        counts[a] = counts.get(a, 0) + 1
    uniform = chi2_tail(k / n * sum(c * c for c in counts.values()) - n, k - 1)
    high = [a >= k / 2 for a in at]
    n1 = sum(high)
    n2 = n - n1
    if n1 and n2:
        mean, runs = 2 * n1 * n2 / n + 1, 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = two_sided((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        runs_p = 2.0 ** (1 - n)
    m = sum(at) / n
    spread = sum((a - m) ** 2 for a in at)
    serial = sum((x - m) * (y - m) for x, y in zip(at, at[1:], strict=False)) / spread if spread else 1.0
    return fisher((uniform, runs_p, two_sided((serial + 1 / n) * math.sqrt(n))))


def text_bin(token: str, at: list[int], k: int) -> int:
    """The bin of the p-value of the hypothesis that the token is text."""
    return min(LAST_BIN, max(0, int(evidence(token, at, k) / math.log(10) * BINS_PER_DECADE)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed kinds in order."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, length class, bin, text bin) of tokens that no fixed pattern explains."""
    taken = Cover((s, e) for s, _, e in base)
    for m in TOKEN.finditer(text):
        token, start, end = m[0], m.start(), m.end()
        if not any("0" <= c <= "9" for c in token) or not any(c.isalpha() for c in token) or taken.meets(start, end):
            continue
        at, k = infer(token)
        if len(at) >= LENGTHS[0]:
            yield start, end, sum(len(at) >= x for x in LENGTHS) - 1, p_bin(battery(at, k)), text_bin(token, at, k)


def _label(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(id_col: str, text_col: str):
    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts, digests = [], ([], [], []), []
            for text in texts(batch, text_col):
                base = base_spans(text)
                for k in range(3):
                    counts[k].append(sum(b[1] == k for b in base))
                digests.append(hashlib.sha256(_label(base).encode()).hexdigest())
                rows = [(s, k, e, -1, 0, 0) for s, k, e in base] + [(s, 3, e, c, b, t) for s, e, c, b, t in candidates(text, base)]
                found.append([dict(zip(FOUND.elementType.names, r, strict=True)) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(found, pa.list_(pa.struct([(n, pa.int32()) for n in FOUND.elementType.names])))],
                [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "found"],
            )

    return scan_batches


def scan_raw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and undecided candidates of each text, in one pass without a shuffle."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("found", FOUND),
    ])
    return docs.select(id_col, text_col).mapInArrow(lean(_scan(id_col, text_col)), schema)


def first_rejected(bins: dict[int, int], q: float) -> int:
    """The first bin that Benjamini-Hochberg rejects at level q, from counts by bin.

    With k of m candidates rejected the bound is q * k / m, or q / m where none is.
    """
    total, below, rejected = sum(bins.values()), 0, 1
    for b in sorted(bins, reverse=True):
        below += bins[b]
        if 10 ** (-b / BINS_PER_DECADE) <= q * below / total:
            rejected = below
    return math.ceil(-math.log10(q * rejected / total) * BINS_PER_DECADE - 1e-9)


def thresholds(raw: DataFrame, q: float) -> dict[int, tuple[int, int]]:
    """For each length class the first bins that are declared not random and not text.

    Spark counts all candidates by class and bin of either kind; at most two times classes x bins rows,
    however large the corpus, come to the driver.
    """
    tests = F.array(F.struct(F.lit(0).alias("test"), F.col("f.bin").alias("bin")), F.struct(F.lit(1).alias("test"), F.col("f.text_bin").alias("bin")))
    counted = (
        raw.select(F.explode("found").alias("f")).where("f.rank = 3").select(F.col("f.stratum").alias("stratum"), F.explode(tests).alias("t"))
        .groupBy("stratum", F.col("t.test").alias("test"), F.col("t.bin").alias("bin")).count().collect()
    )
    out = {}
    for stratum in {r["stratum"] for r in counted}:
        random, text = ({r["bin"]: r["count"] for r in counted if (r["stratum"], r["test"]) == (stratum, test)} for test in (0, 1))
        out[stratum] = first_rejected(random, q), min(first_rejected(text, q), LAST_BIN)
    return out


def _kept(found: Column, limits: dict[int, tuple[int, int]]) -> Column:
    def decide(f: Column) -> Column:
        ok = f["rank"] < 3
        for stratum, (limit, least) in sorted(limits.items()):
            ok = ok | ((f["stratum"] == stratum) & (f["bin"] < limit) & (f["text_bin"] >= least))
        return ok

    return F.filter(found, decide)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.01) -> DataFrame:
    """One row per document: counts and digest of the fixed kinds, and all spans as `kind:start:end`."""
    raw = cut(scan_raw(docs, id_col, text_col))
    kinds = F.array(*map(F.lit, KINDS))
    spans = F.transform(F.array_sort(_kept(F.col("found"), thresholds(raw, q))), lambda f: F.concat_ws(":", kinds[f["rank"]], f["start"], f["end"]))
    return raw.select(id_col, "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(spans, ",").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.01) -> DataFrame:
    """The same rows and columns, each secret in a text replaced by its kind in angle brackets.

    The first pass only counts candidate bins; the second cuts the texts where they are, without a shuffle.
    """
    limits = thresholds(scan_raw(docs, id_col, text_col), q)
    schema = docs.schema

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(text_col).to_pylist():
                base = base_spans(text) if text else []
                more = [(s, 3, e) for s, e, c, b, t in candidates(text, base) if c in limits and b < limits[c][0] and t >= limits[c][1]] if text else []
                done, pieces = 0, []
                for s, k, e in sorted(base + more):
                    if s >= done:
                        pieces += [text[done:s], f"<{KINDS[k]}>"]
                    done = max(done, e)
                out.append("".join([*pieces, text[done:]]) if pieces else text)
            arrays = [pa.array(out, pa.string()) if n == text_col else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return docs.mapInArrow(lean(cut_batches), schema)
