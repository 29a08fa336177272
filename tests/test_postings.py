import random

from termtide.operators import catalog
from termtide.sources.postings import Postings

SCHEMA = "class_id string, year int, term string, name string, professor string, lt_no string, sbjt_cd string, subh_cd string"


def test_indexed_search_finds_what_a_scan_finds(spark, tmp_path):
    rnd = random.Random(4)
    words = ["Linear", "linen", "ALGEBRA", "bragel", "수학", "기초수학", "100%", "a_b", "ärger", "x", "aaa", "aaaa"]
    rows = [(f"c{i}", 2020 + i % 3, str(i % 2), None if i % 17 == 0 else "".join(rnd.choice([*words, " "]) for _ in range(rnd.randrange(0, 6))), rnd.choice(words), "1", "A", "0") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    index = Postings(spark, str(tmp_path / "index"), df.schema)
    index.build(df, ["name", "professor"], block_rows=30)
    asked = [({"name": w}, e) for w in ("LINE", "brage", "수학", "초수학", "100%", "a_b", "ÄRG", "aaaaa", "", "zzz") for e in ({}, {"year": 2021, "term": "1"})]
    asked += [({"name": "line", "professor": "ALG"}, {}), ({"name": "ne", "professor": "linear"}, {"term": "0"})]
    total = 0
    for contains, equal in asked:
        got = [r["class_id"] for r in index.search(df, equal=equal, contains=contains).collect()]
        assert got == [r["class_id"] for r in catalog.search(df, equal=equal, contains=contains).collect()], (contains, equal)
        total += len(got)
    assert total > 500
    plan = index.candidates({"name": "linear"}, {"year": 2021})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan and "In(gram" in plan and "EqualTo(field,name)" in plan
    longest = spark.read.parquet(str(tmp_path / "index")).selectExpr("max(size(ids)) as n").first()["n"]
    assert longest <= 60


def test_an_empty_table_and_words_without_grams(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    index = Postings(spark, str(tmp_path / "index"), df.schema)
    index.build(spark.createDataFrame([("a", 2020, "1", "ab", None, "1", "A", "0")], SCHEMA), ["name"])
    assert index.candidates({"name": "ab"}) is None and index.search(df, contains={"name": "abc"}).count() == 0


def test_a_text_of_many_rows_is_indexed_once(spark, tmp_path):
    df = spark.createDataFrame([(f"c{i}", 2020 + i % 3, "1", "linear algebra", None, "1", "A", "0") for i in range(300)], SCHEMA)
    index = Postings(spark, str(tmp_path / "index"), df.schema)
    index.build(df, ["name", "professor"])
    assert spark.read.parquet(str(tmp_path / "index")).selectExpr("max(size(ids)) as n").first()["n"] == 1
    assert index.search(df, contains={"name": "AR ALG"}, equal={"year": 2021}).count() == 100
