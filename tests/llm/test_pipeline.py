"""The corpus pipeline on a small fixture against brute force."""

import random
import re

import public_tokenizers
from test_models import windows_brute
from test_neardup import brute
from test_scans import base
from tokenizers import Tokenizer

import corpus_pipeline

WORDS = {"en": "the house and garden with this thing there where whose".split(), "de": "das haus und der garten mit dieser sache wo doch".split()}


def fixture(folder, spark):
    rnd = random.Random(8)
    text = lambda lang, n: " ".join(rnd.choice(WORDS[lang]) + str(rnd.randrange(40)) for _ in range(n))
    items = [(1, text("en", 14)), (2, text("de", 11))]
    docs = []
    for i in range(80):
        lang = ("en", "de")[i % 2]
        body = text(lang, rnd.randint(20, 60))
        if i % 9 == 4:
            body += " " + items[i % 2][1] + " and"
        if i % 7 == 2:
            body += ' token = "' + "%040x" % rnd.getrandbits(160) + '" end'
        if i % 5 == 3 and i > 10:
            body = docs[i - 10][1] if i % 10 == 3 else docs[i - 10][1] + " tail"
        docs.append((i, body, lang, "src", len(body)))
    docs += [(100, "12 ## 34", "en", "src", 8), (101, None, None, None, None), (102, "", "de", "src", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs, items = fixture(str(tmp_path), spark)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    known = [(d[0], d[1]) for d in docs if re.search(r"[^\W\d_]", d[1] or "")]
    kept = {r[0] for r in brute(known, corpus_pipeline.NEAR_PERCENT) if r[3]}
    left = [d for d in known if d[0] in kept]
    dirty = {r[0] for r in windows_brute(left, items) if r[4]}
    want = {i: t for i, t in left if i not in dirty}
    assert set(got) == set(want) and 0 < len(dirty) and len(kept) < len(known)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in want.items():
        for s, k, e in reversed(base(text)):
            text = text[:s] + f"<{('assign', 'access', 'hex')[k]}>" + text[e:] if not any(a <= s < b for a, x, b in base(text) if (a, x, b) < (s, k, e)) else text
        assert got[i]["round_trip"] and got[i]["text"] == text
        assert list(got[i]["token_ids"]) == lib.encode(text, add_special_tokens=False).ids and got[i]["n_tokens"] == len(got[i]["token_ids"])


def test_stages_keep_the_columns(spark, tmp_path):
    fixture(str(tmp_path), spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).schema == docs.schema
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs.limit(0), str(tmp_path)).count() == 0
    own = docs.limit(3).selectExpr("*", "1 AS token_ids", "'x' AS round_trip", "'y' AS n_tokens", "2 AS word")
    assert sorted(last(spark, own, str(tmp_path)).columns) == sorted(own.columns)


def test_each_text_is_left_once_whatever_its_id(spark, tmp_path):
    """Rows without ids, ids of several texts, repeated rows and a very long text go through all stages."""
    rnd = random.Random(9)
    text = lambda lang, n: " ".join(rnd.choice(WORDS[lang]) + str(rnd.randrange(40)) for _ in range(n))
    a, b, c, long = text("en", 30), text("de", 30), text("en", 40), text("en", 60_000)
    rows = [(None, a), (None, a), (1, b), (1, b), (1, c), (2, long), (3, a + " tail"), (None, None), (4, "")]
    docs = [(i, t, None, "src", 0) for i, t in rows] + [(100 + i, text(lang, 25), lang, "src", 0) for i, lang in enumerate(("en", "de") * 15)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing of this is anywhere in the texts of this corpus")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect() if (r["doc_id"] or 0) < 100))
    assert got == sorted([(1, b), (1, c), (2, long), (3, a + " tail")])
