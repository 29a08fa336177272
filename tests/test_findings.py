"""Steps that shuffled or scanned more than their rows."""

import re

import pytest

from termtide.functions import markup
from termtide.operators import catalog, snapshots
from termtide.plans import catalog_queries, page_queries, snapshot_queries


@pytest.mark.parametrize(("module", "query"), [(catalog_queries, "classes_untagged"), (snapshot_queries, "digest_status")])
def test_classes_are_taken_once(spark, monkeypatch, module, query):
    scanned = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            scanned.add(b.num_rows)
            yield b

    rows = [(2024, f"Q{1 + i % 4}", f"P{i}", "001", "000", i % 9, str(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "year int, term string, sbjt_cd string, lt_no string, subh_cd string, quota int, class_id string")
    monkeypatch.setattr(module, "classes", lambda *_: df.mapInArrow(once, df.schema))
    got = {tuple(r) for r in module.QUERIES[query](spark, "").collect()}
    assert scanned.value == 40
    assert got == ({(40, sum(r[5] % 2 for r in rows))} if query == "classes_untagged" else {(2024, "Q1", "unchanged"), (2024, "Q2", "changed"), (2024, "Q3", "unchanged"), (2024, "Q4", "new")})


def test_records_without_a_class_do_not_meet_under_null(spark):
    slot = "day_index int, period int, start_time string, end_time string, room string"
    classes = spark.createDataFrame([("c1", "P1", "001"), ("c2", "P2", "001"), ("c3", "P2", "001")], "class_id string, sbjt_cd string, lt_no string")
    records = spark.createDataFrame([("r1", "P1", "001", "A"), ("r2", "P2", "001", "B"), ("r3", "P3", "001", "C")], "rec_id string, sbjt_cd string, lt_no string, room string")
    slots = spark.createDataFrame([("c1", 1, 1, "09:00", "10:00", "")], "class_id string, " + slot)
    theirs = spark.createDataFrame([("r1", 1, 1, "09:00", "10:00", "A")], "rec_id string, " + slot)
    status = catalog.backfill_rooms(classes, slots, records, theirs)[1]
    assert sorted(map(tuple, status.collect()), key=str) == [("r1", "c1", "matched", False, "A"), ("r2", None, "ambiguous", False, None), ("r3", None, "unmatched", False, None)]
    plan = status._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join LeftOuter, \(+(\w+)#", plan) == ["rec_id", "sbjt_cd", "class_id"]


def test_carried_entries_come_from_one_join(spark):
    df = lambda rows: spark.createDataFrame(rows, "k string, v int")
    fresh, failed, previous = df([("a", 1), (None, 1)]), df([("a", 0), ("b", 0), ("b", 0), ("c", 0), (None, 0)]), df([("b", 8), ("b", 9), ("a", 7), (None, 6)])
    out = snapshots.carried(fresh, failed, previous, ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("b", 8, False), ("b", 9, False), ("c", None, True), (None, None, True)], key=str)
    kept, missing = snapshots.carry_forward(fresh, failed, previous, ["k"])
    assert sorted((r["k"] or "", r["v"]) for r in kept.collect()) == [("", 1), ("a", 1), ("b", 8), ("b", 9)] and {r["k"] for r in missing.collect()} == {"c", None}
    assert len(re.findall(r"Join", out._jdf.queryExecution().optimizedPlan().toString())) == 1


@pytest.mark.parametrize("query", ["live_resolution", "live_overlay", "live_report", "null_audit"])
def test_live_records_and_sections_come_from_one_shuffle_of_the_line_items(spark, query):
    plan = catalog_queries.QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("l_returnflag") <= 1 and plan.optimizedPlan().toString().count("l_orderkey#") > 0
    keys = set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan.executedPlan().toString()))
    assert keys and keys <= {"l_partkey", "p_partkey", "s_suppkey"}


def test_overlay_report_and_audit_of_gathered_records(spark):
    key = "year int, term string, sbjt_cd string, lt_no string, subh_cd string, name string, professor string, department string, "
    of = lambda code, subh, name, *rest: (1, "T", code, "1", subh, name, "P", "D", *rest)
    cat = spark.createDataFrame([of("A", "0", "x", "a", 5, None), of("B", "0", "x", "b0", None, 1), of("B", "1", "y", "b1", None, 1), of("C", "0", "x", "c", None, 1), (None, "T", "A", "1", "0", "x", "P", "D", "n", None, 1)], key + "class_id string, cart int, quota int")
    live = [of("A", "0", "x", "1", 7, None), of("A", "9", "x", "2", 0, None), of("A", "9", "x", "3", None, None), of("B", "9", "Ｙ", "4", None, 3), of("B", "9", "z", "5", 9, 9), of("D", "0", "x", "6", 9, 9), (None, "T", "A", "1", "0", "x", "P", "D", "7", 9, 9)]
    live = spark.createDataFrame(live, key + "live_id string, cart int, quota int")
    over = {r["class_id"]: (r["name"], r["cart"], r["quota"]) for r in catalog.overlay_counts(cat, live).collect()}
    assert over == {"a": ("x", 0, None), "b0": ("x", None, 1), "b1": ("y", None, 3), "c": ("x", None, 1), "n": ("x", None, 1)}
    assert [tuple(r) for r in catalog.overlay_report(cat, live).collect()] == [(7, 2, 3)]
    assert {tuple(r) for r in catalog.audit_nulls(cat, live, "cart").collect()} == {("b0", "ambiguous"), ("b1", "site_null"), ("c", "not_seen"), ("n", "not_seen")}
    assert [tuple(r) for r in catalog.overlay_report(cat.limit(0), live.limit(0)).collect()] == [(0, 0, 0)]


@pytest.mark.parametrize("query", ["rooms_backfilled", "slots_backfilled"])
def test_backfilled_rooms_come_from_one_shuffle_of_the_line_items(spark, query):
    plan = catalog_queries.QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and {re.sub(r"#.*", "", k) for k in keys} <= {"l_partkey", "p_partkey", "s_suppkey"}


def test_gathered_backfill_equals_joins(spark):
    slot = "day_index int, period int, start_time string, end_time string, room string"
    at = lambda day, room="": (day, 1, "09:00", "10:00", room)
    classes = {"c1": ("A", [at(1, "x"), at(1, "y")]), "c2": ("B", [at(1)]), "c3": ("B", [at(2)]), "c4": ("C", [at(3)]), "c5": ("E", [])}
    records = {"r1": ("A", "R", [at(1, "R")]), "r2": ("A", "S", [at(2, "S")]), "r3": ("B", "R", [at(1, "R")]), "r4": ("D", "R", [at(1, "R")]), "r5": ("C", "R", []), "r6": ("A", "T", [at(1, "T")]), "r7": ("E", "T", [])}
    df = lambda rows, cols: spark.createDataFrame(rows, cols)
    own, theirs = df([(i, c, "1") for i, (c, _) in classes.items()], "class_id string, sbjt_cd string, lt_no string"), df([(i, c, "1", room) for i, (c, room, _) in records.items()], "rec_id string, sbjt_cd string, lt_no string, room string")
    blank = df(sorted({(i, *t[:4], "") for i, (_, ts) in classes.items() for t in ts}), "class_id string, " + slot)
    want = catalog.backfill_rooms(own, blank, theirs, df([(i, *t) for i, (_, _, ts) in records.items() for t in ts], "rec_id string, " + slot))
    codes = sorted({c for c, _ in classes.values()} | {r[0] for r in records.values()})
    met = [([(i, "", ts) for i, (c, ts) in classes.items() if c == code], [(i, room, ts) for i, (c, room, ts) in records.items() if c == code]) for code in codes]
    held = f"array<struct<id:string,room:string,slots:array<struct<{slot.replace(' ', ':').replace(',:', ',')}>>>>"
    got = catalog.backfill_gathered(df(met, f"classes {held}, records {held}"))
    for a, b in zip(got, want, strict=True):
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)


@pytest.mark.parametrize("query", ["catalogue_diff", "catalogue_diff_summary"])
def test_years_of_a_section_meet_in_one_shuffle_of_the_line_items(spark, query):
    plan = snapshot_queries.QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    keys = {re.sub(r"#.*", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)}
    assert "l_partkey" in keys and keys <= {"l_partkey", "p_partkey", "s_suppkey", "code"}


def test_paired_changes_equal_the_diff_of_two_catalogues(spark):
    row = "name string, quota int, classification array<string>, slots array<struct<day_index:int,start_time:string,end_time:string>>"
    at = lambda *days: [(d, "09:00", "10:00") for d in days]
    old = {"a": ("x", 1, ["R", "N"], at(1)), "b": ("x", None, [], at()), "c": ("x", 1, ["R"], at(2)), "d": ("", 1, None, at(1)), "e": ("x", 1, ["R"], at(1))}
    new = {"a": ("x", 1, ["N", "R"], at(1)), "b": ("y", 2, ["R"], at(1)), "d": (None, 1, [], at(1)), "e": ("x", 3, ["R"], at(2)), "f": ("z", 1, ["R"], at(3))}
    side = lambda rows: spark.createDataFrame([(k, *v) for k, v in rows.items()], "k string, " + row)
    diff = snapshots.catalog_diff(side(old), side(new), ["k"])
    held = f"struct<{row.replace(', ', ',').replace(' ', ':')}>"
    pairs = spark.createDataFrame([(k, old.get(k), new.get(k)) for k in "abcdef"], f"k string, old {held}, new {held}")
    plain = lambda df, by: sorted(tuple(r[c] for c in by) for r in df.collect())
    cols = ["k", "code", "detail"]
    assert plain(snapshots.paired_diff(pairs, ["k"]), cols) == plain(diff, cols) and diff.count() > 6
    short = snapshots.changes_summary(snapshots.paired_changes(pairs, ["k"], detail=False))
    assert plain(short, short.columns) == plain(snapshots.diff_summary(diff, ["k"]), short.columns)


CARD = '<div class="course-info-item"><input name="sbjtCd" value="{0}"><a class="course-name">[{1}]<strong>{2}<br></strong></a><ul><li class="txt"><span>{3}</span><span>D</span><span>z</span></li><li class="txt"><span>정원 <em>{4}/9</em></span></li><li>수(15:00~16:15)</li></ul></div>'


def test_cards_of_one_form_are_read_alike_wherever_they_stand(monkeypatch):
    """The elements of a form are read once; pages in which a card is not alone go to the reader of pages."""
    one, two = CARD.format("A", "x", "R &amp; D", "P", 3), CARD.format("B", "y", "b", "Q > R", 4)
    page = lambda body, end="": f'<input id="srchOpenSchyy" value="2001"><div class="search-result-con"><small><em>2</em></small>{body}{end}'
    odd = [
        page(one + two), page(one + "\n" + CARD.format("B", "y", "b", "Q", 4), "<p>end</p></div>"), page(one.replace("</ul>", "</ul></p>") + one), page(one.replace("</div>", "") + one), page(one + "<small><em>7</em></small>"), page(one, "<!-- " + one + "-->"),
        page("<script>" + one + "</script>" + one), page(one.replace('value="A"', 'value="A&amp;B"') + one), page(one.replace('value="A"', "value='" + one.replace("'", "") + "'")), page(one.replace("<ul>", '<ul><input id="srchOpenSchyy" value="1999">')),
        page(one).replace("</small>", ""), page(one).replace("<em>2</em></small>", "<em>2"), page(one + "\0"), one.replace("course-info-item", "course-info-item x") + one, page(one.replace("<ul>", "<ul><small><em>5</em></small>")).replace("<em>2</em>", ""), "", one[:90],
    ]
    got = [markup.cards(p) for p in odd]
    assert got[1][0] == 2 and [c["name"] for c in got[1][1]] == ["R & D", "b"] and [c["year"] for c in got[1][1]] == ["2001"] * 2
    assert [(t, [{} for _ in c]) for t, c in got] == [markup.cards(p, fields=False) for p in odd]
    read = []
    taken = markup._Page._read
    with monkeypatch.context() as m:
        m.setattr(markup._Page, "_read", lambda self, tokens, text: read.append(len(tokens)) or taken(self, tokens, text))
        markup.cards(page(one * 200, "</div>"))
    assert sum(read) < 50  # not the elements of 200 cards
    monkeypatch.setattr(markup, "START", "\0never")
    assert got == [markup.cards(p) for p in odd]


@pytest.mark.parametrize("query", ["result_cards", "pages_complete"])
def test_pages_are_written_where_classes_met(spark, query):
    plan = page_queries._cards(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    keys = {re.sub(r"#.*", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)}
    assert "l_partkey" in keys and keys <= {"l_partkey", "p_partkey", "s_suppkey"}
    assert page_queries.QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0
