"""Personal data by weak supervision: labelers vote, EM weighs them, and a span classifier decides.

Four fixed kinds (email, ip, card, phone) are always reported. Wider patterns propose further spans of the
same kinds (bracketed or spaced addresses, card numbers that fail the checksum, national phone numbers).
Regex, gazetteer and context labelers vote for, against, or abstain on every span, fixed or proposed.
Spark counts the vote patterns of all spans; expectation-maximisation over that table (at most 3 ** 5
patterns a kind, whatever the corpus) estimates both error rates of each labeler and each pattern's chance of
being personal. A logistic model on votes and span shapes, trained on those chances over all counted
patterns, decides which proposed spans are reported (probability `least` or more, and at least two votes
for).

Null texts count as empty; texts without spans give a row with counts of 0; texts of any length are scanned
whole, in time that grows with their length and the logarithm of their spans; spans of equal votes and shape share
one decision; of proposed spans that overlap the leftmost stays, of those the longest, then the first kind; repeated
rows give repeated results; an empty table gives none; columns besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.llm.common import Cover, cut, lean, texts

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", re.A)
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+", re.A)
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]", re.A)
WIDE = (
    (0, re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]{2,63})+", re.I)),
    (3, re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![\w-])", re.A)),
)
#: Gazetteers (fixed values): generic ends of mail domains (besides the two letters of any country), ranges of
#: card issuers' first four digits, first two digits of all calling codes (1 and 7 stand alone), and words in
#: English, German, French and Spanish that stand before such data, or before numbers of another sort.
MAIL_ENDS = frozenset(("com", "org", "net", "edu", "gov", "int", "mil", "info", "biz", "name", "pro", "app", "dev", "cloud", "email", "online", "tech", "eu"))
ISSUERS = ((2221, 2720), (3000, 3059), (3095, 3095), (3400, 3499), (3528, 3589), (3600, 3999), (4000, 4999), (5000, 5099), (5100, 5599), (5600, 5899), (6011, 6011), (6200, 6299), (6440, 6599))
CALLING = frozenset("20 21 22 23 24 25 26 27 29 30 31 32 33 34 35 36 37 38 39 40 41 42 43 44 45 46 47 48 49 50 51 52 53 54 55 56 57 58 59 60 61 62 63 64 65 66 67 68 69 80 81 82 84 85 86 87 88 90 91 92 93 94 95 96 97 98 99".split())
BEFORE = (
    ("mail", "contact", "write", "reach", "address", "kontakt", "schreib", "adresse", "anschrift", "courriel", "écri", "contacte", "correo", "escrib", "direcci"),
    ("ip", "host", "server", "address", "client", "adresse", "serveur", "hôte", "servidor", "direcci", "rechner"),
    ("card", "visa", "credit", "payment", "pay ", "karte", "kredit", "zahl", "bezahl", "carte", "paiement", "tarjeta", "pago", "crédit", "crédito"),
    ("phone", "tel", "call", "mobile", "fax", "cell", "ruf", "anruf", "handy", "mobil", "appel", "portable", "llam", "móvil"),
)
OTHER = ("order", "version", "isbn", "sku", "item", "page", "line", "invoice", "bestell", "rechnung", "seite", "zeile", "artikel", "commande", "facture", "pedido", "factura", "página", "línea", "ligne")
#: The same as beginnings of words: `tel` stands in telephone, not in hotel.
BEFORE_WORDS, OTHER_WORDS = tuple(re.compile(r"\b(?:" + "|".join(map(re.escape, words)) + ")") for words in BEFORE), re.compile(r"\b(?:" + "|".join(OTHER) + ")")
VOTES = 5
SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("kind", "start", "end", "base", "shape")])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from their @ in linear time."""
    done = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed kinds, by kind and start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def proposed(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the wider patterns that overlap neither a fixed span nor one another."""
    found = [(2, m.start(), m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 15 and 15 <= len(d := _digits(m[0])) <= 16 and not luhn(d)]
    low = text.lower()
    for kind, pattern in WIDE:
        if kind or "at" in low:
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    taken, out = Cover((s, e) for _, s, e in base), []
    for kind, start, end in sorted(found, key=lambda f: (f[1], -f[2], f[0])):  # leftmost, then longest, then by kind
        if not taken.meets(start, end) and (not out or start >= out[-1][2]):
            out.append((kind, start, end))
    return out


def votes(text: str, kind: int, start: int, end: int) -> tuple[int, ...]:
    """Votes (2 for, 0 against, 1 abstains) of form, gazetteer, context, surroundings and checksum labelers."""
    span, before = text[start:end], text[max(0, start - 40) : start].lower()
    digits = _digits(span)
    edge = (text[start - 1] if start else " ") + (text[end] if end < len(text) else " ")
    form = gazetteer = check = 1
    if kind == 0:
        form = 2 if "@" in span and ".." not in span else 1
        ending = re.split(r"\W+", span.rstrip(")]}"))[-1].lower()
        gazetteer = 2 if ending in MAIL_ENDS or len(ending) == 2 and ending.isalpha() else 0
        check = 2 if span[0].isalnum() else 0
    elif kind == 1:
        form = 2 if all(str(int(p)) == p for p in span.split(".") if len(p) < 9) else 0
        gazetteer = 0 if span.split(".")[0] in ("0", "255") or span in ("1.2.3.4", "1.0.0.0", "127.0.0.1") else 2
    elif kind == 2:
        form = 2 if re.fullmatch(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{3,4}", span) else 1
        gazetteer = 2 if any(low <= int(digits[:4]) <= high for low, high in ISSUERS) else 0
        check = 2 if luhn(digits) else 0
    else:
        form = 2 if len(digits) in (10, 11, 12) else 1
        gazetteer = (2 if digits[0] in "17" or digits[:2] in CALLING else 0) if span[0] == "+" else 1
        check = 2 if "555" not in span or span[0] == "+" else 1
    context = 2 if BEFORE_WORDS[kind].search(before) else 0 if OTHER_WORDS.search(before) else 1
    around = 0 if edge[0].isalnum() or edge[1].isalnum() else 2 if edge[0].isspace() and not edge[1].isalnum() else 1
    return form, gazetteer, context, around, check


def shape(pattern: tuple[int, ...], text: str, start: int, end: int) -> int:
    """The votes and a few traits of the span (length class, letters, separators) as one small number."""
    span = text[start:end]
    number = 0
    for v in pattern:
        number = number * 3 + v
    traits = min(3, (end - start) // 8) * 4 + 2 * any(c.isalpha() for c in span) + (" " in span)
    return number * 16 + traits


def unpack(shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and trait indicators of shape numbers."""
    pattern, traits = shapes // 16, shapes % 16
    v = np.stack([pattern // 3 ** (VOTES - 1 - i) % 3 for i in range(VOTES)], 1)
    return v, np.concatenate([np.eye(4)[traits // 4], (traits // 2 % 2)[:, None], (traits % 2)[:, None]], 1)


def em(v: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(chance of each vote pattern to be personal, two rates of each labeler), from counted patterns.

    The rates are the share of votes for among a labeler's votes on personal spans, and of votes against among its
    votes on others, so that a labeler that always votes for counts for nothing. Who abstains says nothing.
    """
    yes, no = (v == 2).astype(float), (v == 0).astype(float)
    right, prior = np.full((2, VOTES), 0.8), 0.5
    p = np.full(len(v), 0.5)
    for _ in range(rounds):
        a = np.log(prior) + yes @ np.log(right[0]) + no @ np.log(1 - right[0])
        b = np.log(1 - prior) + yes @ np.log(1 - right[1]) + no @ np.log(right[1])
        p = 1 / (1 + np.exp(np.clip(b - a, -50, 50)))
        prior = np.clip((p @ n + 1) / (n.sum() + 2), 0.05, 0.95)
        good, bad = n * p, n * (1 - p)
        right = np.stack([(good @ yes + 4) / (good @ (yes + no) + 5), (bad @ no + 4) / (bad @ (yes + no) + 5)])
        right = np.clip(right, 0.01, 0.99)
    return p, right


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (the last is the constant) by Newton's method on soft labels."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (n * p * (1 - p))[:, None]) + penalty * np.eye(len(w))
        w += np.linalg.solve(curve, x.T @ (n * (y - p)) - penalty * w)
    return w


def train(counted: list[tuple[int, int, int]], least: float) -> set[tuple[int, int]]:
    """(kind, shape) of the spans to report, from (kind, shape, count) of all spans."""
    out = set()
    for kind in range(len(KINDS)):
        own = [(s, n) for k, s, n in counted if k == kind]
        if not own:
            continue
        shapes, n = np.array([s for s, _ in own]), np.array([c for _, c in own], float)
        v, traits = unpack(shapes)
        chance, _ = em(v, n)
        features = np.concatenate([v == 2, v == 0, traits], 1).astype(float)
        w = logistic(features, chance, n)
        p = 1 / (1 + np.exp(-np.clip(features @ w[:-1] + w[-1], -30, 30)))
        out |= {(kind, int(s)) for s, q, votes_for in zip(shapes, p, (v == 2).sum(1), strict=True) if q >= least and votes_for >= 2}
    return out


def _scan(id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for text in texts(batch, text_col):
                base = base_spans(text)
                for k in range(len(KINDS)):
                    counts[k].append(sum(b[0] == k for b in base))
                digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base).encode()).hexdigest())
                rows = [(*b, 1) for b in base] + [(*b, 0) for b in proposed(text, base)]
                spans.append([dict(zip(SPAN.names, (k, s, e, b, shape(votes(text, k, s, e), text, s, e)), strict=True)) for k, s, e, b in rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.list_(pa.struct([(n, pa.int32()) for n in SPAN.names])))],
                [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "found"],
            )

    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each row, in one pass over the texts."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
        T.StructField("base_sha256", T.StringType()), T.StructField("found", T.ArrayType(SPAN)),
    ])
    raw = cut(docs.select(id_col, text_col).mapInArrow(lean(_scan(id_col, text_col)), schema))
    counted = raw.select(F.explode("found").alias("f")).groupBy("f.kind", "f.shape").count().collect()
    good = train([tuple(r) for r in counted], least)
    number = lambda f: f["kind"] * 3**VOTES * 16 + f["shape"]
    chosen = sorted(k * 3**VOTES * 16 + s for k, s in good)
    kept = F.filter("found", lambda f: (f["base"] == 1) | (number(f).isin(chosen) if chosen else F.lit(False)))
    names = F.array(*map(F.lit, KINDS))
    spans = F.array_join(F.transform(F.array_sort(kept), lambda f: F.concat_ws(":", names[f["kind"]], f["start"], f["end"])), ",")
    return raw.select(id_col, *(f"n_{k}" for k in KINDS), "base_sha256", spans.alias("spans"))
