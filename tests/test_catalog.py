import pytest
from pyspark.sql import functions as F

from termtide.functions import markup, scalars
from termtide.operators import catalog, crossterm, requirements, snapshots
from termtide.sources import pages, tables

CAT = "year int, term string, sbjt_cd string, lt_no string, subh_cd string, name string, professor string, department string, class_id string"


def test_resolution_cascade(spark):
    cat = [(1, "T", "A", "1", "0", "X", "P", "D", "a"), (1, "T", "B", "1", "0", "Ｘ y", "P", "", "b0"), (1, "T", "B", "1", "1", "Z", "P", "D", "b1")]
    live = [("exact", "A", "0", ""), ("lone", "A", "9", ""), ("meta", "B", "9", "x  Y"), ("both", "B", "9", ""), ("none", "C", "0", "X")]
    rows = [(1, "T", c, "1", s, n, "P", "D", i) for i, c, s, n in live]
    got = {r["live_id"]: (r["class_id"], r["method"]) for r in catalog.resolve_live(spark.createDataFrame(rows, CAT.replace("class_id", "live_id")), spark.createDataFrame(cat, CAT)).collect()}
    assert got == {"exact": ("a", "exact"), "lone": ("a", "code+lecture"), "meta": ("b0", "metadata"), "both": (None, "ambiguous"), "none": (None, "missing")}


def test_rooms_blocks_quotas_and_names(spark):
    df = spark.createDataFrame([("월(12:00~14:50)/화(11:00~12:15)", "3-213(무선랜제공)/3-116(무선랜제공)", "130 (120)"), ("월(07:00~08:00)/월(07:00~08:00)", "3-1/3-1/ ", "30"), (None, "/ /", "")], "t string, r string, q string")
    got = df.select(scalars.pair_rooms("t", "r").alias("m"), scalars.parse_room("r").alias("r"), scalars.parse_quota("q").alias("q")).collect()
    assert [(m["day_index"], m["period"], m["room"]) for m in got[0]["m"]] == [(0, 4, "3-213"), (1, 3, "3-116")]
    assert [(m["period"], m["room"]) for m in got[1]["m"]] == [(0, "3-1"), (0, "3-1")] and got[2]["m"] == []
    assert [r["r"] for r in got] == ["3-213/3-116", "3-1", ""] and [tuple(r["q"]) for r in got] == [(130, 120), (30, None), (None, None)]
    rooms = spark.createDataFrame([("043-1-0102",), ("#017-203",), ("*5--007",), ("000",), ("9-2-B1",), ("-",), (None,)], "raw string")
    norm = [tuple(r["n"]) if r["n"] else None for r in rooms.select(scalars.normalize_room("raw").alias("n")).collect()]
    assert norm == [("관악", "43-1", "43-1-102"), ("연건", "17", "17-203"), ("평창", "5", "5-7"), ("관악", "0", "0"), ("관악", "9-2", "9-2-B1"), None, None]
    order = spark.createDataFrame([(b,) for b in ("100", "x", "10-1", "9-2", "2", "10")], "b string").orderBy(scalars.building_rank("b")).collect()
    assert [r["b"] for r in order] == ["2", "9-2", "10", "10-1", "100", "x"]


def test_uuid5_equals_standard_library(spark):
    import uuid

    names = ["김 교수|통계학과", "A|B", "|"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(scalars.uuid5(F.col("n")).alias("u")).collect()
    assert [r["u"] for r in got] == [str(uuid.uuid5(scalars.IDENTITY_SPACE, n)) for n in names]


def test_windows_with_open_ends(spark):
    days = spark.createDataFrame([("2026-08-03",), ("2026-08-04",), ("2026-09-09",)], "d string").select(F.to_date("d").alias("d"))
    pick = lambda c: [r[0] for r in days.select(c).collect()]
    assert pick(catalog.in_windows(F.col("d"), " 2026-08-04..2026-08-05 , 2026-09-09")) == [False, True, True]
    assert pick(catalog.in_windows(F.col("d"), " ")) == [False] * 3 and pick(catalog.in_window(F.col("d"), "", None)) == [True] * 3


def test_term_tables_are_pruned_guarded_and_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "classes")
    rows = [(2026, "1", i) for i in range(20)] + [(2026, "2", i) for i in range(20)]
    make = lambda r: spark.createDataFrame(r, "year int, term string, v int")
    tables.write_terms(make(rows), path)
    assert tables.read_terms(spark, path, ["2026-fall", "2026-2"], {"fall": "2"}).count() == 20
    with pytest.raises(ValueError, match="shrink"):
        tables.replace_terms(make(rows[:10]), path)
    with pytest.raises(ValueError, match="nothing"):
        tables.replace_terms(make([]), path)
    tables.replace_terms(make([(2026, "1", 99)]), path, force=True)
    assert sorted(r["v"] for r in tables.read_terms(spark, path, "2026-spring", {"spring": "1"}).collect()) == [99] and spark.read.parquet(path).count() == 21


def test_diff_of_equals_is_empty_and_blank_is_null(spark):
    slot = "array<struct<day_index:int,start_time:string,end_time:string>>"
    schema = f"k string, name string, professor string, grade string, classification array<string>, slots {slot}"
    old = [("a", "A", "p", "", ["x", "y"], [(0, "09:00", "10:00")]), ("b", "B", "p", None, [], []), ("c", "C", None, None, None, None)]
    new = [("a", "A", "q", None, ["y", "x"], [(1, "09:00", "10:00")]), ("b", "B", "p", None, [], []), ("d", "D", None, None, None, None)]
    df = lambda r: spark.createDataFrame(r, schema)
    assert snapshots.catalog_diff(df(old), df(old), ["k"]).count() == 0
    got = sorted(tuple(r) for r in snapshots.catalog_diff(df(old), df(new), ["k"]).collect())
    assert got == [("a", "PROF", "A", "p → q"), ("a", "TCHG", "A", "월09:00~10:00 → 화09:00~10:00"), ("c", "DEL", "C", "시간미정"), ("d", "NEW", "D", "시간미정")]


def test_diff_codes_of_all_fields(spark):
    fields = [f for f, _ in snapshots.FIELDS]
    row = lambda tag: ("k", *(f"{f}-{tag}" for f in fields), [], None)
    schema = "k string, " + ", ".join(f"{f} string" for f in fields) + ", classification array<string>, slots array<struct<day_index:int,start_time:string,end_time:string>>"
    got = snapshots.catalog_diff(spark.createDataFrame([row("a")], schema), spark.createDataFrame([row("b")], schema), ["k"]).collect()
    assert [r["code"] for r in got] == ["NAME", "PROF", "DEPT", "COLL", "GRADE", "CRED", "QUOTA", "QRET", "APPL", "ENRL", "GRD", "GRDSW"]
    assert {r["code"]: r["detail"] for r in got}["APPL"] == "applied-a → applied-b"


def test_deep_markup_does_not_overflow():
    total, found = markup.cards("<p>" * 5000 + '<div class="search-result-con"><small><em>1</em></small></div><div class="course-info-item"><input name="sbjtCd" value="A">' + "<b>" * 5000 + "화(10:00~11:00)")
    assert total == 1 and found[0]["sbjt_cd"] == "A" and found[0]["slots"][0]["day_index"] == 1


def test_cards_text_and_requirement_figures(spark):
    card = '<div class="course-info-item"><input name="sbjtCd" value="M1"><a class="course-name">[전필][영어]<strong>Name  <i>two</i></strong></a><ul><li class="txt"><span>P</span><span>D</span><span>x</span></li>'
    card += "<li class=txt><span>정원 <em>12 / 30</em></span><span>총수강인원<em>7</em></span></li><li class='state'></li><li>수(9:00~10:15)</li></ul></div>"
    total, found = markup.cards(f'<div class="search-result-con"><small><em>2</em></small></div>{card}<div class="course-info-item"></div>')
    assert total == 2 and len(found) == 2 and found[1]["cancel_vacancy"] is None
    assert (found[0]["name"], found[0]["classification"], found[0]["applied"], found[0]["quota"], found[0]["enrolled"], found[0]["cancel_vacancy"]) == ("Name two", ["전필", "영어"], 12, 30, 7, 0)
    page = "<p>6 과목 이상, 최대 12 학점</p><table><tr><th>졸업</th></tr><tr><td>130</td><td>49</td><td>60/39</td><td>39</td><td>21</td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")
    got = {r["page_id"]: r for r in requirements.requirement_numbers(pages.html_tables(df), pages.html_to_text(df)).collect()}
    assert (got[1]["total"], got[1]["general"], got[1]["minor"], got[1]["select_min"], got[1]["approval_max"]) == (130, 49, 21, 6, 12)
    assert got[2]["total"] is None and got[2]["select_min"] == 5 and got[2]["total_ok"]
    labels = spark.createDataFrame([("a", "m", "2023~2025학번"), ("b", "m", "2026학번 이후"), ("c", "n", None)], "id string, major string, label string")
    assert [(r["id"], r["batch"], r["rules"]) for r in requirements.requirement_index(labels).collect()] == [("b", 2026, "after"), ("a", 2025, "after"), ("a", 2024, "after"), ("a", 2023, "after")]


def test_dictionary_ids_are_dense_in_order(spark):
    df = spark.range(5000).select(F.concat(F.lit("v"), F.col("id") % 700).alias("v"), F.col("id").alias("at"))
    got = crossterm.dictionary_encode(df.repartition(7), "v", ["at"]).collect()
    assert sorted(r["id"] for r in got) == list(range(700)) and all(r["value"] == f"v{r['id']}" for r in got)


def test_codes_of_the_same_terms_meet_as_lists(spark, monkeypatch):
    """All pairs of many codes alike, lists cut anywhere, from fewer joined rows than there are codes."""
    monkeypatch.setattr(crossterm, "CHUNK", 7, raising=False)
    offer = lambda terms, credits: [(t, "001", "Name", "p", "D", credits) for t in terms]
    rows = [(f"o{i}", offer([4, 5], i % 2), ["Name"]) for i in range(20)] + [(f"n{i}", offer([2, 3], 0), ["Name"]) for i in range(20)] + [("far", offer([30], 0), ["Name"]), ("mid", offer([3, 4], 0), ["Name"])]
    history = spark.createDataFrame(rows, "sbjt_cd string, offerings array<struct<term_idx:int,lt_no:string,name:string,professor:string,department:string,credits:int>>, names array<string>")
    out = crossterm.infer_code_links(history)
    got = [tuple(r) for r in out.collect()]
    want = [(f"o{i}", f"n{j}", "low" if i % 2 else "high") for i in range(20) for j in range(20)] + [(f"o{i}", "mid", "low") for i in range(20)] + [("mid", f"n{j}", "low") for j in range(20)]
    assert sorted(got) == sorted(want)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") >= 2


def test_classes_with_meetings_in_one_pass_equal_nested_slots(spark):
    from termtide.plans.model import classes, slots

    d = "/root/testdata/sf0.001"
    plain = lambda df: {r["class_id"]: str(r["slots"]) for r in df.select("class_id", "slots").collect()}
    out = classes(spark, d, nested=True)
    assert plain(out) == plain(catalog.nest_slots(classes(spark, d), slots(spark, d)))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("lineitem") <= 1


def test_resolution_counts_records_where_they_met(spark):
    """No shuffle by record behind the join on the code."""
    live = spark.createDataFrame([(1, "T", "B", "1", "9", "x  Y", "P", "D", "meta")], CAT.replace("class_id", "live_id"))
    cat = spark.createDataFrame([(1, "T", "B", "1", "0", "Ｘ y", "P", "", "b0"), (1, "T", "B", "1", "1", "Z", "P", "D", "b1")], CAT)
    out = catalog.resolve_live(live, cat)
    assert [tuple(r) for r in out.collect()] == [("meta", "b0", "metadata")]
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("hashpartitioning(live_id" in line for line in lines)
