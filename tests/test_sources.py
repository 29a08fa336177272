import json

from pyspark.sql import functions as F

from termtide.operators import catalog, requirements, rooms, snapshots
from termtide.sources import pages, tables

SLOT = "class_id string, day_index int, period int, start_time string, end_time string, room string"


def test_scopes_keep_order_and_drop_repeats():
    fall, winter = tables.ALIASES["fall"], tables.ALIASES["winter"]
    assert tables.scope_list(["2026-fall", "2025-winter", f"2026-{fall}"]) == [(2026, fall), (2025, winter)]
    assert tables.scope_list("all") is None


def test_flat_export_has_the_columns_of_the_listing_in_order(spark):
    slot = "array<struct<day_index:int,start_time:string,end_time:string>>"
    schema = f"year int, term string, name string, professor string, department string, sbjt_cd string, lt_no string, credits int, grade string, classification array<string>, quota int, quota_returning int, applied int, grading string, college string, slots {slot}"
    rows = [
        (2026, tables.ALIASES["fall"], "N", "P", "D", "C1", "001", 3, "1", ["a", "b"], 30, 25, 7, None, "K", [(0, "09:00", "10:15"), (None, "1", "2"), (9, "13:00", None), (2, None, None)]),
        (2026, "X", "N", "P", "D", "C1", "002", 3, "1", None, 30, None, 7, "G", None, []),
    ]
    out = tables.export_flat(spark.createDataFrame(rows, schema))
    assert tuple(out.columns) == tables.FLAT and len(out.columns) == 18
    got = {r["lt_no"]: r for r in out.collect()}
    assert (got["001"]["term_label"], got["001"]["quota_new"], got["001"]["times"], got["001"]["grading"], got["001"]["college"], got["001"]["classification"]) == ("2학기", 5, "월(09:00~10:15)/?(13:00~)", "", "K", "a b")
    assert (got["002"]["term_label"], got["002"]["quota_new"], got["002"]["times"], got["002"]["grading_switch"]) == ("X", None, "", "")


def test_json_export_nests_ordered_slots(spark, tmp_path):
    classes = spark.createDataFrame([("a", 2026, "1", "N", "001", "C"), ("b", 2026, "2", "M", "001", "D")], "class_id string, year int, term string, name string, lt_no string, sbjt_cd string")
    slots = spark.createDataFrame([("a", 1, 2, "10:00", "11:00", "2-1"), ("a", 1, 2, "10:00", "11:00", "1-1"), ("a", 0, 1, "09:00", "10:00", "")], SLOT)
    tables.export_terms_json(classes, slots, str(tmp_path / "out"))
    files = list((tmp_path / "out" / "year=2026" / "term=1").glob("*.json"))
    row = json.loads("".join(f.read_text() for f in files))
    assert [(s["day_index"], s["room"]) for s in row["slots"]] == [(0, ""), (1, "1-1/2-1")]
    assert catalog.nest_slots(classes, slots).where("class_id = 'b'").first()["slots"] == []


def test_attachments_with_missing_lists(spark):
    entry = {"rowIdx": 0, "korFileNm": "a.pdf", "engFileNm": " ", "korAttachNo": "7", "engAttachNo": "8", "korAttachDetaNo": None, "engAttachDetaNo": 1}
    rows = [(1, json.dumps({"LISTTAB03_LIST_ATTACH": [entry, {**entry, "engFileNm": "b", "korAttachNo": None}]})), (2, '{"LISTTAB03_LIST_ATTACH":null}'), (3, None), (4, "x")]
    got = sorted(tuple(r) for r in tables.parse_attachments(spark.createDataFrame(rows, "k int, json string")).collect())
    assert got == [(1, "en", "b", "8", 1), (1, "ko", "a.pdf", "7", 0)]


def test_links_resolve_against_the_page(spark):
    html = '<p><a href="/a?x=1&amp;y">2023학번 <b>이전</b></a><a href="b.html">no</a><a href="/a?x=1&amp;y">2024학번</a><a name=z>학번</a>'
    got = pages.html_links(spark.createDataFrame([(1, "http://h.kr/d/i", html), (2, None, None)], "page_id long, url string, html string"), "학번").collect()
    assert [(r["href"], r["text"]) for r in got] == [("http://h.kr/a?x=1&y", "2023학번 이전")]


def test_drift_digest_and_carry_forward(spark):
    label = F.concat("c", F.lit("("), "l", F.lit(")"))
    df = lambda r: spark.createDataFrame(r, "t string, c string, l string")
    out = snapshots.roster_drift(df([("T", "A", "1"), ("T", "B", "1")]), df([("T", "A", "1"), ("T", "A", "1"), ("T", "C", "2")]), ["t"], label).first()
    import hashlib

    assert (out["added"], out["removed"]) == (["C(2)"], ["B(1)"]) and out["signature"] == hashlib.sha1(b'[["C(2)"],["B(1)"]]').hexdigest()[:16]
    rows = spark.range(50).select(F.lit("T").alias("t"), "id", F.rand().alias("at"))
    one, two = (snapshots.term_digest(r, ["t"], exclude=["at"]).first()["digest"] for r in (rows, rows.orderBy(F.desc("id"))))
    assert one == two != snapshots.term_digest(rows.where("id > 0"), ["t"], exclude=["at"]).first()["digest"]
    entries = lambda r: spark.createDataFrame(r, "k string, v int")
    kept, missing = snapshots.carry_forward(entries([("a", 1)]), entries([("b", 0), ("c", 0)]), entries([("a", 9), ("b", 8), ("z", 7)]), ["k"])
    assert sorted(map(tuple, kept.collect())) == [("a", 1), ("b", 8)] and [r["k"] for r in missing.collect()] == ["c"]


def test_conflicts_equal_brute_force_over_hours(spark):
    import random

    rnd = random.Random(6)
    time = lambda m: f"{m // 60:02}:{m % 60:02}"
    rows = []
    for i in range(120):
        start = rnd.randrange(480, 1200, 15)
        rows.append((f"c{i % 90:02}", rnd.randrange(3), time(start), time(start + rnd.choice([15, 60, 75, 180, 300])), rnd.choice("RS")))
    got = rooms.meeting_conflicts(spark.createDataFrame(rows, "class_id string, day_index int, start_time string, end_time string, name string"), ["name"]).collect()
    want = {(a, b) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and a[4] == b[4] and a[2] < b[3] and b[2] < a[3]}
    assert len(got) == len(want) and {(r["a_class_id"], r["b_class_id"], r["a_start_time"], r["b_start_time"]) for r in got} == {(a[0], b[0], a[2], b[2]) for a, b in want}


def test_free_rooms_against_brute_force(spark):
    import random

    rnd = random.Random(2)
    hour = lambda h: f"{h:02d}:00"
    slots = [(f"c{i}", rnd.randrange(3), 1, hour(s := rnd.randrange(9, 17)), hour(s + rnd.randint(1, 2)), f"{rnd.randrange(1, 4)}-{rnd.randrange(3)}") for i in range(60)]
    df = spark.createDataFrame(slots, SLOT)
    index = rooms.rooms_index(df.select("class_id").withColumn("year", F.lit(2026)).withColumn("term", F.lit("1")), df)
    asked = spark.createDataFrame([(1, 0, "10:00", "12:00", "관악", None), (2, 1, "09:00", "10:00", "관악", "2")], "query_id int, day_index int, start string, end string, campus string, building string")
    got = {(r["query_id"], r["name"], r["next_start"]) for r in rooms.free_rooms(rooms.room_meetings(df), index, asked).collect()}
    want = set()
    for q, day, s, e, b in ((1, 0, "10:00", "12:00", None), (2, 1, "09:00", "10:00", "2")):
        for room in {x[5] for x in slots}:
            own = [x for x in slots if x[5] == room and x[1] == day]
            if (b is None or room.split("-")[0] == b) and not any(x[3] < e and x[4] > s for x in own):
                want.add((q, room, min((x[3] for x in own if x[3] >= e), default=None)))
    assert got == want


def test_recognition_needs_major_tags_for_units(spark):
    rows = [("s", 0, c, d, col, cls, 3) for c, d, col, cls in [("P1", "통계학과", "", ["전선"]), ("X1", "수리과학부", "", ["전선"]), ("X2", "수리과학과", "", ["교양"]), ("P9", "물리", "", ["교양"]), ("Y", "화학", "공대", ["전필"])]]
    df = spark.createDataFrame(rows, "student string, spec_id int, code string, dept string, college string, cls array<string>, credits int")
    specs = spark.createDataFrame([(0, "통계", [], ["P"], False, ["공대"], ["수리과학부"])], "spec_id int, own string, courses array<string>, prefixes array<string>, any_dept boolean, colleges array<string>, depts array<string>")
    assert sorted(r["code"] for r in requirements.recognized(df, specs).collect()) == ["P9", "X1", "Y"]
    tracks = spark.createDataFrame([(0, "a", 5), (0, "b", None)], "spec_id int, track string, recog_max int")
    assert {r["track"]: r["credits"] for r in requirements.elective_credits(df, specs, tracks).collect()} == {"a": 8, "b": 12}


def test_references_without_a_semicolon_stay_in_texts(spark):
    df = spark.createDataFrame([(1, "<p>a&amp;b and&amp</p><b>&lt x &#65; &#65 &copy;&nosuch; & &amp;amp;</b>")], "page_id long, html string")
    assert pages.html_to_text(df).collect()[0]["text"] == "a&b and&amp\n&lt x A &#65 ©&nosuch; & &amp;"


def test_pages_of_plain_tags_are_read_without_the_parser_and_others_by_it(monkeypatch):
    from termtide.functions import markup

    plain = '<input id="srchOpenSchyy" value="2026"><div class="search-result-con"><small><em>3</em></small><div class=\'course-info-item\'><br/><a class="course-name">[A]<strong>x &amp; y</strong></a></div>'
    odd = [plain + tail for tail in ("<!-- c -->", "<p class=x>", "<a href='?a&amp;b'>", "< 3", "<script>if (a<b) '<em>'</script>")]
    events = lambda text: (lambda p: (p.tags, p.attrs, p.end, p.begins, p.stops, p.pieces))(markup._Page(text))
    read = {text: events(text) for text in (plain, *odd)}
    monkeypatch.setattr(markup, "TOKEN", __import__("re").compile("(?!)"))
    assert all(events(text) == got for text, got in read.items())
    monkeypatch.undo()
    monkeypatch.setattr(markup._Page, "feed", lambda self, text: 1 / 0)
    total, (card,) = markup.cards(plain)
    assert (total, card["year"], card["name"], card["classification"]) == (3, "2026", "x & y", ["A"])
