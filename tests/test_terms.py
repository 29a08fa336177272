import datetime as dt

import pytest
from pyspark.sql import functions as F

from termtide.operators import snapshots
from termtide.sources import tables
from termtide.sources.terms import TermStore

SCHEMA = "year int, term string, code string, quota int"


def at(day, hour=0):
    return F.lit(dt.datetime(2024, 1, day, hour))


def rows(*terms):
    """(year, term, rows, quota) as that many rows."""
    return [(y, t, f"C{i}", q) for y, t, n, q in terms for i in range(n)]


def digests(store):
    return {(r["year"], r["term"]): (r["n"], r["fetched_at"].day, r["checked_at"].day) for r in store.digests().collect()}


def test_push_swaps_what_changed_and_refuses_what_shrank(spark, tmp_path):
    df = lambda *t: spark.createDataFrame(rows(*t), SCHEMA)
    store = TermStore(spark, str(tmp_path), df().schema)
    status = lambda out: {(r["year"], r["term"]): r["status"] for r in out.collect()}
    assert store.rows().count() == 0 and digests(store) == {}
    assert status(store.push(df((2024, "1", 10, 5), (2024, "2", 10, 5)), at(1))) == {(2024, "1"): "new", (2024, "2"): "new"}
    assert status(store.push(df((2024, "1", 10, 5), (2024, "2", 12, 6), (2025, "1", 3, 1)), at(2))) == {(2024, "1"): "unchanged", (2024, "2"): "changed", (2025, "1"): "new"}
    want = {(2024, "1"): (10, 1, 2), (2024, "2"): (12, 2, 2), (2025, "1"): (3, 2, 2)}
    assert digests(store) == want and store.rows().count() == 25
    with pytest.raises(ValueError, match="shrink"):
        store.push(df((2024, "1", 11, 5), (2024, "2", 5, 6)), at(3))
    with pytest.raises(ValueError, match="without a term"):
        store.push(spark.createDataFrame([(2024, None, "C", 1)], SCHEMA), at(3))
    assert digests(store) == want and store.rows().count() == 25
    store.push(df((2024, "2", 5, 6)), at(4), force=True)
    assert store.rows().where("term = '2'").count() == 5 and digests(store)[2024, "2"] == (5, 4, 4)


def test_a_crash_after_the_rows_is_mended_by_the_next_push(spark, tmp_path, monkeypatch):
    old, new = (spark.createDataFrame(rows((2024, "1", 10, q)), SCHEMA) for q in (1, 2))
    store, swap = TermStore(spark, str(tmp_path), old.schema), TermStore._swap
    store.push(old, at(1))

    def lost(self, name, df):
        if name == "digests":
            raise RuntimeError("lost")
        swap(self, name, df)

    monkeypatch.setattr(TermStore, "_swap", lost)
    with pytest.raises(RuntimeError):
        store.push(new, at(2))
    monkeypatch.setattr(TermStore, "_swap", swap)
    store.push(new, at(3))
    assert {r["quota"] for r in store.rows().collect()} == {2} and digests(store) == {(2024, "1"): (10, 3, 3)}


def test_pull_takes_what_differs_and_refuses_a_torn_remote(spark, tmp_path):
    df = lambda *t: spark.createDataFrame(rows(*t), SCHEMA)
    remote, local = (TermStore(spark, f"{tmp_path}/{n}", df().schema) for n in "rl")
    remote.push(df((2024, "1", 10, 5), (2024, "2", 10, 5), (2024, "3", 4, 1)), at(2))
    local.push(df((2024, "1", 10, 5), (2024, "2", 10, 9), (2023, "1", 2, 2)), at(1))
    targets = spark.createDataFrame([(2024, "1"), (2024, "2"), (2024, "4")], "year int, term string")
    out = {(r["year"], r["term"]): (r["action"], r["stale"]) for r in local.pull(remote, at(4), 24, targets).collect()}
    assert out == {(2024, "1"): ("same", True), (2024, "2"): ("apply", True), (2024, "4"): ("uncollected", False)}
    assert digests(local) == {(2024, "1"): (10, 1, 1), (2024, "2"): (10, 2, 2), (2023, "1"): (2, 1, 1)}
    assert {(r["term"], r["quota"]) for r in local.rows().where("year = 2024").collect()} == {("1", 5), ("2", 5)}
    local.pull(remote, at(4), 72)
    assert digests(local)[2024, "3"] == (4, 2, 2) and local.rows().count() == 26
    remote._swap("rows", df((2024, "1", 9, 5)))
    remote._swap("digests", remote.digests().where("term = '1'").withColumn("digest", F.lit("other")))
    with pytest.raises(ValueError, match="digest"):
        local.pull(remote, at(5), 72)
    assert local.rows().count() == 26 and digests(local)[2024, "1"] == (10, 1, 1)


def test_replacing_asks_for_rows_of_every_scope(spark, tmp_path):
    df = lambda *t: spark.createDataFrame(rows(*t), SCHEMA)
    tables.write_terms(df((2024, "1", 5, 1), (2024, "2", 5, 1)), str(tmp_path))
    with pytest.raises(ValueError, match="2024-2"):
        tables.replace_terms(df((2024, "1", 5, 2)), str(tmp_path), scopes=["2024-1", "2024-2"], aliases={}, force=True)
    tables.replace_terms(df((2024, "1", 5, 2), (2024, "2", 5, 2)), str(tmp_path), scopes=["2024-1"], aliases={})
    assert {(r["term"], r["quota"]) for r in spark.read.parquet(str(tmp_path)).selectExpr("cast(term as string) as term", "quota").collect()} == {("1", 2), ("2", 1)}


def test_csv_has_a_mark_headings_and_quotes(spark, tmp_path):
    slot = "array<struct<day_index:int,start_time:string,end_time:string>>"
    schema = f"year int, term string, name string, professor string, department string, sbjt_cd string, lt_no string, credits int, grade string, classification array<string>, quota int, quota_returning int, applied int, grading string, slots {slot}"
    held = [(2026, "X", ' a "b", c ', "P\nQ", "D", "C1", "002", 3, "1", ["x", "y"], 30, None, 7, None, [(0, "09:00", "10:15")]), (2026, "X", "가", None, "", "C0", "001", 3, "1", None, None, None, None, "G", [])]
    classes = spark.createDataFrame(held, schema)
    tables.write_flat_csv(classes, f"{tmp_path}/one")
    files = list((tmp_path / "one").glob("*.csv"))
    text = files[0].read_bytes()
    assert len(files) == 1 and text.startswith("﻿연도,학기,교과목명,".encode()) and ',"' in text.decode() and '""b""' in text.decode()
    import csv
    import io

    table = list(csv.reader(io.StringIO(text.decode("utf-8-sig"))))
    assert table[0] == list(tables.HEADINGS) and table[1][2:4] == [' a "b", c ', "P\nQ"] and table[2][2:6] == ["가", "", "", ""]
    got = tables.read_flat_csv(spark, f"{tmp_path}/one").orderBy("lt_no").collect()
    assert [(r["name"], r["professor"], r["quota"], r["times"]) for r in got] == [("가", None, None, None), (' a "b", c ', "P\nQ", 30, "월(09:00~10:15)")]
    tables.write_flat_csv(classes, f"{tmp_path}/two", files=2)
    assert tables.read_flat_csv(spark, f"{tmp_path}/two").count() == 2


def test_tags_are_compared_without_order_and_shown_as_stored(spark):
    schema = "k string, name string, classification array<string>, slots array<struct<day_index:int,start_time:string,end_time:string>>"
    df = lambda *r: spark.createDataFrame([(k, "n", tags, []) for k, tags in r], schema)
    old, new = df(("a", ["B", "A"]), ("b", ["B", "A"]), ("c", None)), df(("a", ["C", "A"]), ("b", ["A", "B"]), ("c", []))
    assert [tuple(r) for r in snapshots.catalog_diff(old, new, ["k"]).collect()] == [("a", "CLS", "n", "B,A → C,A")]


def test_a_summary_takes_the_diff_once_and_counts_repeated_keys_once(spark):
    rows = [("a", "NEW"), ("b", "QUOTA"), ("b", "NAME"), ("b", "NAME"), ("c", "NAME")]
    diff = spark.createDataFrame([(k, c, "n", "d") for k, c in rows], "k string, code string, name string, detail string")
    out = snapshots.diff_summary(diff, ["k"])
    assert {tuple(r) for r in out.collect()} == {("NEW", 1, 1), ("QUOTA", 1, 1), ("NAME", 3, 2), ("*", 4, 2)}
    assert {tuple(r) for r in snapshots.diff_summary(diff.limit(0), ["k"]).collect()} == {("*", 0, 0)}
    joined = snapshots.diff_summary(diff.join(diff.select("k").distinct(), "k"), ["k"])
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_a_flat_csv_of_many_rows_is_split_in_search_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 40, raising=False)
    schema = "year int, term string, name string, professor string, department string, sbjt_cd string, lt_no string, credits int, grade string, classification array<string>, quota int, applied int, grading string, slots array<struct<day_index:int,start_time:string,end_time:string>>"
    rows = [(2026, "X", f"n{i % 100:03}", "p", "D", f"C{i}", "001", 3, "1", [], 30, 7, "", []) for i in range(100)]
    tables.write_flat_csv(spark.createDataFrame(rows, schema), f"{tmp_path}/many")
    files = sorted((tmp_path / "many").glob("*.csv"))
    names = [line.split(",")[2] for f in files for line in f.read_text(encoding="utf-8").splitlines()[1:]]
    assert len(files) > 1 and names == [f"n{i:03}" for i in range(100)]
