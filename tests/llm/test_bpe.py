import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from termtide.llm import bpe
from termtide.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
MERGES = bpe.Merges(PATH)
CODEC = bpe.Codec(MERGES, MERGES.lexicon([" the", "the", " two", "ab", " spaces"]))
ODD = [
    "", " ", "a", "  two  spaces ", "tab\tand\n\nlines \n x\n", " \n lead", "it's we'll I'D 12345 a1b2", "naïve éàü ñ 한국어 日本 🙂🙂", "x<|endoftext|> y<|endoftext|>", "<|endoftext|>", "<|endoftext|> 's<|endoftext|><|endoftext|>'ll",
    "a\x1cb \x1c c\x85d  e　f  g", "ab" * 400, "the " * 50 + "the", "don't  'll 's\r\n", "​zero ́mark", "'", "''s", "\n's", "x'rest 'reye've've'll'lla'l", "½ ²Ⅷ① 1²", "'s's's", "end'", "end'r", "end'l l'l", " '", "\x00\x00 \x00", "a  ", "  ", "a \t b",
]


def lists(batch, codec=CODEC):
    ids, sizes = codec.encode(batch)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] if batch else []


def test_codec_equals_library():
    for batch in (ODD, *([t] for t in ODD)):
        want = [LIB.encode(t, add_special_tokens=False).ids for t in batch]
        assert lists(batch) == want
        ids, sizes = CODEC.encode(batch)
        assert [*CODEC.decode(ids, sizes)] == [LIB.decode(w, skip_special_tokens=False) for w in want]
        assert [*CODEC.decimals(ids, sizes)] == [",".join(map(str, w)).encode() for w in want]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("sstdmrevlab19.'’ \n\t 　éﬁ한²🙂'  "), max_size=30), min_size=1, max_size=6))
def test_any_texts_equal_library(batch):
    assert lists(batch) == [LIB.encode(t, add_special_tokens=False).ids for t in batch]


def test_words_of_one_hash_stay_apart():
    text = "the cat and the dog, the cat of a cat and naïve " + "x" * 60 + " " + "y" * 60 + " " + "x" * 60
    raw = np.frombuffer(text.encode() + b"\0" * 8, np.uint8)
    starts = np.flatnonzero(raw[:-8] == 32)
    sizes = np.diff(starts, append=len(raw) - 8)
    for hashed in (bpe.mix, lambda x: x & bpe.U(3), lambda x: x * bpe.U(0)):
        first, number = bpe.distinct(raw, starts, sizes, hashed)
        words = [raw[s : s + n].tobytes() for s, n in zip(starts, sizes, strict=True)]
        assert [words[first[i]] for i in number] == words


def test_very_long_words_and_texts():
    batch = ["é" * 30_000, "word, " * 60_000, "a" * 5000 + " " + "b1" * 3000]
    assert lists(batch) == [LIB.encode(t, add_special_tokens=False).ids for t in batch]


def test_many_words_merge_as_one_by_one():
    words = sorted({w.encode() for t in ODD for w in bpe.WORD.findall(t)} | {b"x" * n for n in range(1, 60)} | {(b"ab cd the" * 9)[i : i + n] for i in range(9) for n in range(1, 40)})
    raw, starts, sizes = bpe._laid([*words, b"\0" * 8])
    flat, at, count = MERGES.merge_many(raw, starts[:-1], sizes[:-1])
    assert [flat[i : i + n].tolist() for i, n in zip(at, count, strict=True)] == [MERGES.merge(w) for w in words]


def test_lexicon_shares_suffixes_and_rejects_others():
    entries = {b"tops": [1], b"top": [2, 3], b"taps": [4], b"tap": [], b"x": [9]}
    lex = Lexicon(compile_lexicon(entries))
    assert len(lex.edges) < sum(map(len, entries))
    numbers = lex.find(*bpe._laid([*entries, b"to", b"topsy", b"", b"zz"]))
    assert [lex.output(n) for n in numbers[:5]] == [tuple(v) for v in entries.values()]
    assert (numbers[5:] == -1).all()


def digest(i, text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    back = LIB.decode(ids, skip_special_tokens=False)
    return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_query_equals_library_on_nulls_repeats_and_long_texts(spark):
    rows = [(1, None), (2, ""), (3, ODD[6]), (3, ODD[6]), (None, ODD[7]), *((10 + i, t) for i, t in enumerate(ODD)), (90, "many words of a text, " * 100_000), (91, "z" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", bpe.F.lit("x"))
    got = sorted(map(tuple, bpe.digests(docs, PATH).collect()), key=str)
    assert got == sorted((digest(*r) for r in rows), key=str)
    assert bpe.digests(docs.limit(0), PATH).count() == 0


def test_encode_replaces_columns_of_its_names_and_comes_back(spark):
    rows = [(1, None), (2, ""), (3, ODD[6]), (None, ODD[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token_ids", bpe.F.lit("x")).withColumn("same", bpe.F.lit(1)).withColumn("word", bpe.F.lit(2))
    made = bpe.encode(docs, PATH, check_col="same")
    assert sorted(made.columns) == sorted(docs.columns)
    back = bpe.decode(made, PATH).collect()
    assert len(back) == len(rows) and all((r["text"] or "") == r["decoded"] and r["same"] and r["word"] == 2 for r in back)
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_frequent_words_are_the_top_by_count(spark):
    rows = [(f"w{i}", 1 + i * i % 97) for i in range(500)]
    want = [r[0] for r in sorted((r for r in rows if r[1] > 1), key=lambda r: (-r[1], r[0]))]
    for most in (1, 50, 480, 2000):
        got = bpe.frequent_words(spark.createDataFrame(rows, "word string, n long"), most).collect()
        assert [r["word"] for r in got] == want[:most]


def test_pieces_are_counted_over_all_texts(spark):
    texts = ["a b  a", None, "", "b b " + "x" * 17, "a\nb"]
    got = bpe.piece_counts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r["word"]: r["n"] for r in got} == {"a": 2, "b": 3, "a\nb": 1}
