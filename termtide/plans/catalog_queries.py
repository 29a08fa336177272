"""Registered queries of the catalogue operators, on classes and slots derived from `lineitem`."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.operators import catalog, series
from termtide.plans.model import CLASSES_SQL, classes, classes_and_records, live_and_sections, slots, table
from termtide.sources import tables
from termtide.sources.durable import shared_dir, stored
from termtide.sources.postings import Postings



def class_search(spark: SparkSession, d: str) -> DataFrame:
    c = classes(spark, d)
    word = {"name": "RED", "professor": "supplier#0000000"}
    return catalog.search(c, slots(spark, d), equal={"year": 1996}, contains=word, any_of=[["R", "A", "N"]], within={"grading": ["R", "A", "N"]}, meets=(2, 3)).select("class_id", "name")


def class_search_indexed(spark: SparkSession, d: str) -> DataFrame:
    """The same words looked up in posting lists of all classes' names and professors."""
    c = stored(classes(spark, d))
    index = Postings(spark, f"{shared_dir(spark).rstrip('/')}/termtide-{uuid.uuid4().hex}", c.schema)
    index.build(c, ["name", "professor"])
    word = {"name": "RED", "professor": "supplier#0000000"}
    return index.search(c, slots(spark, d), equal={"year": 1996}, contains=word, any_of=[["R", "A", "N"]], within={"grading": ["R", "A", "N"]}, meets=(2, 3)).select("class_id", "name")


def class_page(spark: SparkSession, d: str) -> DataFrame:
    """The paging feature itself: rows 101 to 150 of a term in search order."""
    return catalog.search(classes(spark, d), equal={"year": 1997, "term": "Q2"}, limit=50, offset=100).select("class_id", "name", "lt_no")


def class_count(spark: SparkSession, d: str) -> DataFrame:
    return catalog.search_count(classes(spark, d), slots(spark, d), any_of=[["R"]], meets=(4, 5))


def window_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    hit = catalog.in_windows(F.col("o_orderdate"), "1996-01-05..1996-02-03, 1997-07-07,1998-03-01..1998-03-04")
    single = catalog.in_window(F.col("o_orderdate"), "1998-01-01", "")
    return o.where(hit | single).select("o_orderkey", hit.alias("listed"), single.alias("single"))


def pass_flags(spark: SparkSession, d: str) -> DataFrame:
    passes = table(spark, d, "events").select("event_id", "ts")
    cfg = {"cart_windows": "2024-01-03..2024-01-05", "enroll_windows": "2024-01-08,2024-01-10..2024-01-12", "slow_windows": "2024-01-20..2024-01-25", "slow_minutes": 10}
    return catalog.pass_flags(passes, cfg).select("event_id", "applied", "cart", "enrolled")


def term_states(spark: SparkSession, d: str) -> DataFrame:
    return catalog.term_status(catalog.list_terms(classes(spark, d)), 1998, "Q2")


def cart_ratios(spark: SparkSession, d: str) -> DataFrame:
    return catalog.cart_ratio(classes(spark, d)).select("class_id", F.round("cart_ratio", 6).alias("cart_ratio"))


def live_resolution(spark: SparkSession, d: str) -> DataFrame:
    return catalog.resolution(live_and_sections(spark, d))


def live_overlay(spark: SparkSession, d: str) -> DataFrame:
    return catalog.overlay_gathered(live_and_sections(spark, d), ["cart", "applied", "quota"])


def live_report(spark: SparkSession, d: str) -> DataFrame:
    return catalog.report_gathered(live_and_sections(spark, d))


def null_audit(spark: SparkSession, d: str) -> DataFrame:
    met = live_and_sections(spark, d)
    kept = lambda row: row.withField("cart", F.when(row["applied"] % 2 == 0, row["cart"]))
    return catalog.audit_gathered(met.withColumn("sections", F.transform("sections", lambda s: s.withField("row", kept(s["row"])))), "cart")


def null_figures(spark: SparkSession, d: str) -> DataFrame:
    return catalog.null_summary(classes(spark, d), "cart")


def latest_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Classes of 1998 overlaid with the newest figures of the same sections in earlier years."""
    c = classes(spark, d)
    key = ["term", "sbjt_cd", "lt_no"]
    latest = c.where("year < 1998").groupBy(*key).agg(F.max_by("applied", "year").alias("applied"), F.max_by("cart", "year").alias("cart"))
    return catalog.apply_latest(c.where("year = 1998"), latest, key, ["applied", "cart"]).select("class_id", "applied", "cart")


def carts_restored(spark: SparkSession, d: str) -> DataFrame:
    c = classes(spark, d)
    key = ["term", "sbjt_cd", "lt_no"]
    return catalog.restore_metric(c.where("year = 1998"), c.where("year = 1997"), key, "cart").select("class_id", "cart")


def grading_tags(spark: SparkSession, d: str) -> DataFrame:
    """Sweeps of the classes with even quotas; the section codes of all years together."""
    c = stored(classes(spark, d).select("class_id", "term", "sbjt_cd", "lt_no", "subh_cd", "quota", "grading"))
    sweeps = c.where("quota % 2 = 0").select("sbjt_cd", "lt_no", "subh_cd", F.concat(F.lit("G"), "quota", "term").alias("grading"), F.concat("class_id", F.lit("")).alias("sweep"))
    return catalog.tag_grading(c, sweeps, c.where("quota > 40")).select("class_id", "grading", "grading_switch")


def timing_recovered(spark: SparkSession, d: str) -> DataFrame:
    """Only the slots of early hours are known (under half); the rest come from any class of the code and lecture."""
    c, s = classes(spark, d), slots(spark, d)
    found = c.join(s, "class_id").select("sbjt_cd", "lt_no", s["day_index"], s["period"], s["start_time"], s["end_time"], s["room"])
    return catalog.recover_timing(c, s.where("period <= 2"), found)


def rooms_backfilled(spark: SparkSession, d: str) -> DataFrame:
    """Records of each year give rooms to the classes of the year before with the same code, lecture and times: each record's status."""
    return catalog.backfill_gathered(classes_and_records(spark, d))[1]


def slots_backfilled(spark: SparkSession, d: str) -> DataFrame:
    """The slots with the rooms that records gave."""
    return catalog.backfill_gathered(classes_and_records(spark, d))[0].select("class_id", "day_index", "period", "start_time", "end_time", "room")


def freshness(spark: SparkSession, d: str) -> DataFrame:
    """The newer of the newest order and the newest shipping."""
    return catalog.freshness(table(spark, d, "orders").select(F.col("o_orderdate").alias("ts")), table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts")))


def saved_classes(spark: SparkSession, d: str) -> DataFrame:
    """Sections saved in each year looked up in the next: same, changed or cancelled."""
    c, s = classes(spark, d), slots(spark, d)
    saved = catalog.nest_slots(c, s).withColumn("year", F.col("year") + 1).select("year", "term", "sbjt_cd", "lt_no", "slots")
    return catalog.reconcile(saved, c, s)


def open_work(spark: SparkSession, d: str) -> DataFrame:
    c = classes(spark, d)
    key = ["sbjt_cd", "lt_no"]
    cache = c.where("year <= 1997").groupBy(*key).agg((F.min("quota") > 10).alias("ok"))
    return catalog.worklist(c, cache, key, retry_failed=True)


def tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.token_counts(classes(spark, d))


def departments(spark: SparkSession, d: str) -> DataFrame:
    return catalog.vocabulary(classes(spark, d), "department", "count")


def term_times(spark: SparkSession, d: str) -> DataFrame:
    c = classes(spark, d)
    labels = c.where("term <> 'Q3'").select("year", "term").distinct().withColumn("label", F.concat_ws("-", "term", "year"))
    return catalog.time_stats(c, slots(spark, d).where("period > 3"), labels)


def term_overview(spark: SparkSession, d: str) -> DataFrame:
    """Terms with their vocabularies, and the chunks of eight shipping days of a term."""
    c = classes(spark, d)
    days = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), F.concat(F.lit("Q"), F.quarter("l_shipdate")).alias("term"), F.col("l_shipdate").cast("timestamp").alias("ts"), F.lit(True).alias("applied"))
    axis = series.load_axis(None, days, ["year", "term"], ["applied"])
    out = catalog.term_index(c, 1998, "Q2", series.chunk_axis(axis, ["year", "term"], 8))
    text = lambda col: F.array_join(col, ",").alias(col)
    return out.select("year", "term", "n", "status", text("departments"), text("grades"), text("gradings"), "live_from", "exposed", F.array_join(F.transform("chunk_starts", lambda t: F.date_format(t, "yyyy-MM-dd")), ",").alias("chunk_starts"))


def classes_untagged(spark: SparkSession, d: str) -> DataFrame:
    c = stored(classes(spark, d).select("sbjt_cd", "lt_no", "subh_cd", "quota"))
    return catalog.untagged(c, c.where("quota % 2 = 0"))


def nested_slots(spark: SparkSession, d: str) -> DataFrame:
    out = catalog.nest_slots(classes(spark, d), slots(spark, d))
    text = F.array_join(F.transform("slots", lambda s: F.concat_ws(" ", s["day_index"], s["start_time"], s["end_time"], s["room"])), ";")
    return out.select("class_id", text.alias("slots"))


def flat_classes(spark: SparkSession, d: str) -> DataFrame:
    c = classes(spark, d).withColumns({"quota_returning": F.when(F.col("cart").isNotNull(), F.col("quota") - 1), "college": F.concat(F.lit("C"), F.col("credits") % 5)})
    code = F.create_map(*(F.lit(x) for quarter, alias in (("Q1", "spring"), ("Q2", "summer"), ("Q3", "fall")) for x in (quarter, tables.ALIASES[alias])))
    c = c.withColumns({"term": F.coalesce(code[F.col("term")], "term"), "grading_switch": F.when(F.col("quota") > 40, "Y")})
    return catalog.nest_slots(c, slots(spark, d))


def flat_export(spark: SparkSession, d: str) -> DataFrame:
    return tables.export_flat(flat_classes(spark, d))


QUERIES = {f.__name__: f for f in (
    class_search, class_search_indexed, class_page, class_count, window_orders, pass_flags, term_states, cart_ratios, live_resolution, live_overlay, live_report, null_audit, null_figures,
    latest_overlay, carts_restored, grading_tags, timing_recovered, rooms_backfilled, slots_backfilled, freshness, classes_untagged, saved_classes, open_work, tag_counts, departments, term_times, term_overview, nested_slots, flat_export,
)}

_LIVE = CLASSES_SQL + """, live AS (
  SELECT year, term, sbjt_cd || CASE WHEN l_suppkey % 3 = 1 THEN 'X' ELSE '' END AS sbjt_cd, lt_no, l_suppkey, CASE WHEN l_suppkey % 2 = 1 THEN '777' ELSE min(subh_cd) END AS subh_cd, min(name) AS name, min(professor) AS professor, min(department) AS department,
         min(applied) AS applied, min(cart) AS cart, min(quota) AS quota, year || '/' || term || '/' || sbjt_cd || CASE WHEN l_suppkey % 3 = 1 THEN 'X' ELSE '' END || '/' || lt_no || '/' || l_orderkey || '/' || l_suppkey AS live_id
  FROM class_rows r GROUP BY year, term, r.sbjt_cd, lt_no, l_orderkey, l_suppkey
), cat AS (
  SELECT year, term, sbjt_cd, lt_no, subh_cd, professor, min(name) AS name, min(department) AS department, min(cart) AS cart, min(applied) AS applied, min(quota) AS quota,
         year || '/' || term || '/' || sbjt_cd || '/' || lt_no || '/' || subh_cd || '/' || professor AS class_id
  FROM class_rows GROUP BY ALL
), pairs AS (
  SELECT l.live_id, c.class_id, l.subh_cd = c.subh_cd AS exact, lower(l.name) = lower(c.name) AND lower(l.professor) = lower(c.professor) AND lower(l.department) = lower(c.department) AS fits
  FROM live l LEFT JOIN cat c USING (year, term, sbjt_cd, lt_no)
), agg AS (
  SELECT live_id, count(class_id) AS n, min(class_id) FILTER (exact) AS e, min(class_id) AS one, count(*) FILTER (fits) AS m, min(class_id) FILTER (fits) AS f FROM pairs GROUP BY live_id
), res AS (
  SELECT live_id, CASE WHEN e IS NOT NULL THEN e WHEN n = 1 THEN one WHEN n > 1 AND m = 1 THEN f END AS class_id,
         CASE WHEN e IS NOT NULL THEN 'exact' WHEN n = 0 THEN 'missing' WHEN n = 1 THEN 'code+lecture' WHEN m = 1 THEN 'metadata' ELSE 'ambiguous' END AS method FROM agg
)"""
_BACKFILL = CLASSES_SQL + """, n_ AS (SELECT year, sbjt_cd, lt_no, count(*) AS n, min(class_id) AS class_id FROM classes GROUP BY ALL),
sig AS (SELECT class_id, list_sort(list(DISTINCT day_index || start_time || end_time)) AS g FROM slots GROUP BY class_id),
st AS (SELECT r.class_id AS rec_id, CASE WHEN n = 1 THEN o.class_id END AS class_id, CASE WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS status,
       coalesce(n = 1, false) AND a.g IS DISTINCT FROM b.g AS timing_differs, CASE WHEN n = 1 THEN room END AS room
  FROM classes r LEFT JOIN n_ o ON o.year = r.year - 1 AND o.sbjt_cd = r.sbjt_cd AND o.lt_no = r.lt_no LEFT JOIN sig a ON a.class_id = o.class_id LEFT JOIN sig b ON b.class_id = r.class_id)"""
_NESTED = CLASSES_SQL + """, one AS (
  SELECT class_id, day_index, start_time, end_time, period, string_agg(DISTINCT room, '/' ORDER BY room) AS room FROM slots GROUP BY ALL
)"""
ORACLE_SQL = {
    "class_search": f"WITH {CLASSES_SQL} SELECT class_id, name FROM classes WHERE year = 1996 AND lower(name) LIKE '%red%' AND lower(professor) LIKE '%supplier#0000000%' AND list_has_any(classification, ['R', 'A', 'N']) AND grading IN ('R', 'A', 'N') AND class_id IN (SELECT class_id FROM slots WHERE day_index = 2 AND period = 3)",
    "class_page": f"WITH {CLASSES_SQL} SELECT class_id, name, lt_no FROM classes WHERE year = 1997 AND term = 'Q2' ORDER BY name, lt_no, sbjt_cd, subh_cd, class_id LIMIT 50 OFFSET 100",
    "class_count": f"WITH {CLASSES_SQL} SELECT count(*) AS n FROM classes WHERE list_contains(classification, 'R') AND class_id IN (SELECT class_id FROM slots WHERE day_index = 4 AND period = 5)",
    "window_orders": "WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders), f AS (SELECT o_orderkey, (dt BETWEEN '1996-01-05' AND '1996-02-03') OR dt = '1997-07-07' OR (dt BETWEEN '1998-03-01' AND '1998-03-04') AS listed, dt >= '1998-01-01' AS single FROM o) SELECT * FROM f WHERE listed OR single",
    "pass_flags": "WITH e AS (SELECT event_id, ts, CAST(ts AS DATE) AS dt FROM events) SELECT event_id, true AS applied, dt BETWEEN '2024-01-03' AND '2024-01-05' AS cart, dt = '2024-01-08' OR (dt BETWEEN '2024-01-10' AND '2024-01-12') OR ((dt BETWEEN '2024-01-20' AND '2024-01-25') AND minute(ts) < 10) AS enrolled FROM e",
    "term_states": f"WITH {CLASSES_SQL} SELECT DISTINCT year, term, CASE WHEN (year, term) < (1998, 'Q2') THEN 'past' WHEN (year, term) = (1998, 'Q2') THEN 'current' ELSE 'upcoming' END AS status FROM classes",
    "cart_ratios": f"WITH {CLASSES_SQL} SELECT class_id, CASE WHEN quota > 0 THEN round(cart / quota::DOUBLE, 6) END AS cart_ratio FROM classes",
    "live_resolution": f"WITH {_LIVE} SELECT * FROM res",
    "live_overlay": f"""WITH {_LIVE}, fresh AS (SELECT res.class_id, arg_max(cart, live_id) FILTER (cart IS NOT NULL) AS cart, arg_max(applied, live_id) FILTER (applied IS NOT NULL) AS applied, arg_max(quota, live_id) FILTER (quota IS NOT NULL) AS quota FROM res JOIN live USING (live_id) GROUP BY res.class_id)
SELECT c.class_id, coalesce(f.cart, c.cart) AS cart, coalesce(f.applied, c.applied) AS applied, coalesce(f.quota, c.quota) AS quota FROM cat c LEFT JOIN fresh f USING (class_id)""",
    "live_report": f"WITH {_LIVE} SELECT count(*) AS fetched, count(DISTINCT class_id) AS updated, count(*) FILTER (class_id IS NULL) AS unmatched FROM res",
    "null_audit": f"""WITH {_LIVE}, miss AS (SELECT * FROM cat WHERE NOT (applied % 2 = 0 AND cart IS NOT NULL)), seen AS (SELECT class_id, bool_or(coalesce(l.cart >= 0, false)) AS ok FROM res JOIN live l USING (live_id) WHERE class_id IS NOT NULL GROUP BY class_id),
amb AS (SELECT DISTINCT l.year, l.term, l.sbjt_cd, l.lt_no FROM res JOIN live l USING (live_id) WHERE method = 'ambiguous')
SELECT m.class_id, CASE WHEN s.ok THEN 'recoverable' WHEN s.class_id IS NOT NULL THEN 'site_null' WHEN a.year IS NOT NULL THEN 'ambiguous' ELSE 'not_seen' END AS verdict
FROM miss m LEFT JOIN seen s ON s.class_id = m.class_id LEFT JOIN amb a ON a.year = m.year AND a.term = m.term AND a.sbjt_cd = m.sbjt_cd AND a.lt_no = m.lt_no""",
    "null_figures": f"WITH {CLASSES_SQL} SELECT year, term, subh_cd, count(*) AS n, count(*) FILTER (cart IS NULL) AS n_null FROM classes GROUP BY ALL",
    "latest_overlay": f"WITH {CLASSES_SQL}, l AS (SELECT term, sbjt_cd, lt_no, arg_max_null(applied, year) AS a, arg_max_null(cart, year) AS k FROM classes WHERE year < 1998 GROUP BY ALL) SELECT c.class_id, coalesce(a, applied) AS applied, coalesce(k, cart) AS cart FROM classes c LEFT JOIN l USING (term, sbjt_cd, lt_no) WHERE year = 1998",
    "carts_restored": f"WITH {CLASSES_SQL} SELECT c.class_id, coalesce(o.cart, c.cart) AS cart FROM classes c LEFT JOIN (SELECT * FROM classes WHERE year = 1997) o USING (term, sbjt_cd, lt_no) WHERE c.year = 1998",
    "grading_tags": f"WITH {CLASSES_SQL}, c AS (SELECT * FROM classes), s AS (SELECT sbjt_cd, lt_no, subh_cd, arg_max('G' || quota || term, class_id) AS g FROM c WHERE quota % 2 = 0 GROUP BY ALL) SELECT class_id, coalesce(g, grading) AS grading, CASE WHEN (sbjt_cd, lt_no, subh_cd) IN (SELECT (sbjt_cd, lt_no, subh_cd) FROM c WHERE quota > 40) THEN 'Y' ELSE 'N' END AS grading_switch FROM c LEFT JOIN s USING (sbjt_cd, lt_no, subh_cd)",
    "timing_recovered": f"""WITH {CLASSES_SQL}, own AS (SELECT * FROM slots WHERE period <= 2),
found AS (SELECT DISTINCT sbjt_cd, lt_no, s.day_index, s.period, s.start_time, s.end_time, s.room FROM classes k JOIN slots s USING (class_id))
SELECT * FROM own UNION ALL SELECT c.class_id, f.day_index, f.period, f.start_time, f.end_time, f.room FROM classes c JOIN found f USING (sbjt_cd, lt_no) WHERE class_id NOT IN (SELECT class_id FROM own)""",
    "rooms_backfilled": f"WITH {_BACKFILL} SELECT rec_id, class_id, status, timing_differs, room FROM st",
    "slots_backfilled": f"""WITH {_BACKFILL}, good AS (SELECT rec_id, class_id FROM st WHERE status = 'matched' AND NOT timing_differs)
SELECT class_id, day_index, period, start_time, end_time, '' AS room FROM (SELECT DISTINCT class_id, day_index, period, start_time, end_time FROM slots) WHERE class_id NOT IN (SELECT class_id FROM good)
UNION ALL SELECT good.class_id, day_index, period, start_time, end_time, room FROM good JOIN slots ON slots.class_id = good.rec_id""",
    "freshness": "SELECT max(ts) AS fresh_at FROM (SELECT o_orderdate AS ts FROM orders UNION ALL SELECT l_shipdate FROM lineitem)",
    "saved_classes": f"""WITH {CLASSES_SQL}, sig AS (SELECT class_id, list_sort(list(DISTINCT day_index || start_time || end_time)) AS g FROM slots GROUP BY class_id)
SELECT s.year + 1 AS year, s.term, s.sbjt_cd, s.lt_no, CASE WHEN n.class_id IS NULL THEN 'cancelled' WHEN a.g = b.g THEN 'same' ELSE 'changed' END AS status
FROM classes s LEFT JOIN classes n ON n.year = s.year + 1 AND n.term = s.term AND n.sbjt_cd = s.sbjt_cd AND n.lt_no = s.lt_no LEFT JOIN sig a ON a.class_id = s.class_id LEFT JOIN sig b ON b.class_id = n.class_id""",
    "open_work": f"WITH {CLASSES_SQL} SELECT DISTINCT sbjt_cd, lt_no FROM classes WHERE (sbjt_cd, lt_no) NOT IN (SELECT (sbjt_cd, lt_no) FROM classes WHERE year <= 1997 GROUP BY sbjt_cd, lt_no HAVING min(quota) > 10)",
    "tag_counts": f"WITH {CLASSES_SQL} SELECT token, count(*) AS n FROM (SELECT unnest(classification) AS token FROM classes) GROUP BY token",
    "departments": f"WITH {CLASSES_SQL} SELECT department AS value, count(*) AS n FROM classes GROUP BY department",
    "term_times": f"WITH {CLASSES_SQL}, t AS (SELECT year, term, count(*) AS classes, count(*) FILTER (class_id IN (SELECT class_id FROM slots WHERE period > 3)) AS timed FROM classes GROUP BY ALL) SELECT year, term, CASE WHEN term <> 'Q3' THEN term || '-' || year ELSE year || ' ' || term END AS label, classes, timed, classes - timed AS timeless FROM t",
    "term_overview": f"""WITH {CLASSES_SQL}, v AS (SELECT year, term, count(*) AS n, CASE WHEN (year, term) < (1998, 'Q2') THEN 'past' WHEN (year, term) = (1998, 'Q2') THEN 'current' ELSE 'upcoming' END AS status, string_agg(DISTINCT department, ',' ORDER BY department) AS departments,
  string_agg(DISTINCT grade, ',' ORDER BY grade) AS grades, string_agg(DISTINCT grading, ',' ORDER BY grading) AS gradings FROM classes GROUP BY year, term),
p AS (SELECT *, row_number() OVER (PARTITION BY year, term ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY year, term) // 8 AS complete FROM (SELECT DISTINCT year(l_shipdate)::INTEGER AS year, 'Q' || quarter(l_shipdate) AS term, l_shipdate AS ts FROM lineitem)),
k AS (SELECT year, term, any_value((complete - 1) * 8) AS live_from, any_value(complete - 1) AS exposed, string_agg(strftime(ts, '%Y-%m-%d'), ',' ORDER BY ts) AS chunk_starts FROM p WHERE i % 8 = 0 AND i // 8 < complete GROUP BY year, term)
SELECT v.*, live_from, coalesce(exposed, 0) AS exposed, coalesce(chunk_starts, '') AS chunk_starts FROM v LEFT JOIN k USING (year, term)""",
    "classes_untagged": f"WITH {CLASSES_SQL} SELECT count(*) AS classes, count(*) FILTER ((sbjt_cd, lt_no, subh_cd) NOT IN (SELECT (sbjt_cd, lt_no, subh_cd) FROM classes WHERE quota % 2 = 0)) AS untagged FROM classes",
    "nested_slots": f"WITH {_NESTED} SELECT c.class_id, string_agg(o.day_index || ' ' || o.start_time || ' ' || o.end_time || ' ' || o.room, ';' ORDER BY o.day_index, o.start_time, o.end_time) AS slots FROM classes c LEFT JOIN one o USING (class_id) GROUP BY c.class_id",
    "flat_export": f"""WITH {_NESTED}, t AS (SELECT class_id, string_agg(substr('월화수목금토일', day_index + 1, 1) || '(' || start_time || '~' || end_time || ')', '/' ORDER BY day_index, start_time, end_time) AS times FROM one GROUP BY class_id)
SELECT year, CASE term WHEN 'Q1' THEN '1학기' WHEN 'Q2' THEN '여름학기' WHEN 'Q3' THEN '2학기' ELSE term END AS term_label, name, professor, 'C' || (credits % 5) AS college, department, sbjt_cd, lt_no, credits, grade, array_to_string(classification, ' ') AS classification,
       quota, CASE WHEN cart IS NOT NULL THEN quota - 1 END AS quota_returning, CASE WHEN cart IS NOT NULL THEN 1 END AS quota_new, applied, grading, CASE WHEN quota > 40 THEN 'Y' ELSE '' END AS grading_switch, times FROM classes JOIN t USING (class_id)""",
}
ORACLE_SQL["class_search_indexed"] = ORACLE_SQL["class_search"]
