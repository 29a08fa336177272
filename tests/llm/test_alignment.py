import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from termtide.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    pair = alignment.tokenizers(A, B)
    found = []
    for t in texts:
        raw = (" " + (t or "")).encode()
        a, b = pair.a.encode(raw.decode(), add_special_tokens=False).ids, pair.b.encode(t or "", out_type=int)
        if not t or b"".join(pair.a_bytes[i] for i in a) != raw or b"".join(pair.b_bytes[i] for i in b) != raw:
            found.append(([], [], [], [], []))
            continue
        spans = []
        for ids, names in ((a, pair.a_bytes), (b, pair.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(names[i]), i))
                at += len(names[i])
            spans.append(own)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, was = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(s[2]) for s in side if was < s[1] <= e) for side in spans))
            was = e
        found.append((a, b, ends, links, groups))
    count = Counter(p for f in found for p in set(f[3]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return [(len(a), len(b), len(ends), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "") for a, b, ends, links, groups in found]


def figures(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs string, n_a string, rid string, groups string")
    out = alignment.alignment_figures(df, A, B)
    return sorted(map(repr, (tuple(r) for r in out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())))


TEXTS = [
    None, "", " ", "  two  spaces", "\n\t lines\r\n\n end ", "The cat sat on the mat; the cat sat.", "naïve café über straße, Åse", "<|endoftext|> </s> <s> <unk> <0x41>", "日本語のテキスト", "👩‍👩‍👧 emoji", "ﬁne ligature", "½ ² Ⅷ",
    "a▁b ▁", "0000000000000000000000", "\x00 nul", "x" * 300, "é combining", "　wide", "tab\tand hard", "The cat sat on the mat; the cat sat.",
]


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_equals_plain_alignment(spark, few, monkeypatch):
    monkeypatch.setattr(alignment, "FEW_PAIRS", few)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 200)
    rnd = random.Random(3)
    words = ["the", "of", "token", "ization", "naïve", "Überraschung", "2024", "don't", "—", "été", "\n", "  "]
    texts = TEXTS + ["".join(rnd.choice(words) + rnd.choice([" ", "", " ", "-"]) for _ in range(rnd.randrange(1, 60))) for _ in range(80)]
    ids = [i if i % 9 else None for i in range(len(texts))]
    rows = [(i, t, "x", "y", "z", "g") for i, t in zip(ids, texts, strict=True)]
    assert figures(spark, rows) == sorted(map(repr, ((i, *f) for i, f in zip(ids, plain(texts), strict=True))))


def test_long_text_repeated_rows_and_empty_table(spark):
    long = " ".join(f"word{i % 977} été" for i in range(40_000))
    rows = [(1, long, "", "", "", ""), (1, long, "", "", "", ""), (2, "word1", "", "", "", "")]
    got = figures(spark, rows)
    assert len(got) == 3 and got[0] == got[1] and "(2, " in got[2]
    assert figures(spark, []) == []


def test_ranks_give_the_library_ids():
    pair, rnd = alignment.tokenizers(A, B), random.Random(9)
    assert pair.quick
    settled = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028)]]
    common = ["'s", "'ll", "'T", " ", "  ", "\n", "\t ", "\u00a0", "ab", "é", "1", "²", "½", "--", "_", "<|endoftext|>"]
    texts = ["".join(rnd.choice(settled if rnd.random() < 0.5 else common) for _ in range(rnd.randrange(1, 80))) for _ in range(4000)] + [a + b + a for a in settled for b in (" ", "x", "7", "!")]
    texts += [" " * 5000 + "x", "x" * 5000, "ab" * 4000 + "!" * 3000]
    assert all(alignment.SETTLED.fullmatch(t) for t in texts) and not alignment.SETTLED.fullmatch("日本")
    assert [ids.tolist() for ids in pair.a_ids(texts)] == [e.ids for e in pair.a.encode_batch_fast(texts, add_special_tokens=False)]
