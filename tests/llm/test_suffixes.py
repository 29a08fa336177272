import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termtide.llm import suffixes


def plain(rows, length):
    """(id, n_bytes, spans, kept) of each row: every window looked up in a dictionary of first places."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2]))
    first, out = {}, []
    for n, i in enumerate(order):
        raw = (rows[i][1] or "").encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - length + 1):
            if first.setdefault(raw[j : j + length], (n, j)) != (n, j):
                gone[j : j + length] = b"\1" * length
        spans, at = [], 0
        while at < len(raw):
            end = at
            while end < len(raw) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                spans.append((at, end))
            at = end
        out.append((rows[i][0], len(raw), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def found(spark, rows, length, gram):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, raw string, hash string")
    hashes = [r[0] for r in spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "n int, t string").orderBy("n").select(F.xxhash64(F.coalesce("t", F.lit("")).cast("binary"))).collect()]
    got = suffixes.repeated_passages(df, length, gram).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], list(zip(r["begins"], r["ends"], strict=True)), bytes(r["kept"])) for r in got), key=repr)
    return got, plain([(i, t, h) for (i, t), h in zip(rows, hashes, strict=True)], length)


def test_suffix_arrays_equal_sorted_suffixes():
    rnd = random.Random(1)
    for _ in range(300):
        k = rnd.choice([2, 3, 5, 300])
        t = [rnd.randrange(1, k + 1) for _ in range(rnd.randrange(0, 50))]
        t = t[: len(t) // 2] * rnd.randrange(1, 4) + t + [0]
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert suffixes.suffix_array(np.array(t, np.int32)).tolist() == want


def test_common_prefixes():
    rnd = random.Random(2)
    for _ in range(200):
        strings = [[rnd.randrange(2, 4) for _ in range(rnd.randrange(1, 40))] for _ in range(rnd.randrange(1, 5))]
        strings += strings[:1] * (rnd.random() < 0.5)
        t = np.array([x for s in strings for x in [*s, 1]] + [0], np.int32)
        rest = np.concatenate([np.arange(len(s), -1, -1) for s in strings] + [[0]])
        order = suffixes.suffix_array(t)
        got = suffixes.common_prefixes(t, order, rest)
        for a, b in zip(order, order[1:]):
            n = 0
            while b + n < len(t) and a + n < len(t) and t[a + n] == t[b + n] and n < rest[b]:
                n += 1
            assert got[b] == min(n, rest[b])


@pytest.mark.parametrize(("hot", "run"), [(2_000_000, 4096), (40, 7), (600, 4096)])
def test_equals_plain_windows(spark, hot, run, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_BYTES", hot)
    monkeypatch.setattr(suffixes, "RUN", run)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 400)
    monkeypatch.setattr(suffixes, "BATCH_BYTES", 300)
    rnd = random.Random(run)
    words = ["lorem ", "ipsum ", "été ", "dolor-", "sit\n", "x", "a" * 9, "\0"]
    line = "one line that many texts share, "
    texts = ["".join(rnd.choice(words) for _ in range(rnd.randrange(0, 40))) for _ in range(60)]
    texts += [texts[i][:50] + line + texts[i + 1][9:] for i in range(30)] + [line, line * 5, "z" * 200, "ab" * 60, "abc" * 50, None, "", "short", "é" * 12]
    rows = [(rnd.choice([None, n, n, n, n // 2]), t) for n, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (900, line * 5)]
    got, want = found(spark, rows, 12, 5)
    assert got == want and sum(len(r[2]) for r in got) > 30


def test_hundred_bytes_and_long_texts(spark):
    rnd = random.Random(7)
    passage = "".join(chr(rnd.randrange(97, 123)) for _ in range(99))
    own = lambda: "".join(chr(rnd.randrange(97, 123)) for _ in range(300))
    texts = [own() + "!" + passage + "1" + own(), own() + "!" + passage + "1" + own(), own() + "?" + passage + "2" + own(), own() + "." + passage + "3", "0" * 30_000, "0" * 99, "0" * 100, "ab" * 5_000, "é" * 400]
    got, want = found(spark, list(enumerate(texts)), 100, 30)
    assert got == want
    spans = {r[0]: r[2] for r in got}
    assert [b - a for a, b in spans[1]] == [101] and spans[2] == spans[3] == spans[5] == [] and spans[4] == [(1, 30_000)] and spans[6] == [(0, 100)]


def test_empty_table_and_tables_without_windows(spark):
    assert found(spark, [], 100, 30) == ([], [])
    got, want = found(spark, [(1, "a"), (None, None), (2, "b" * 120)], 100, 30)
    assert got == want
