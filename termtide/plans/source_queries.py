"""Registered queries of sinks, requirement pages and streams: written to the shared folder, run, and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.operators import requirements, series
from termtide.plans.catalog_queries import ORACLE_SQL as CATALOG_SQL
from termtide.plans.catalog_queries import flat_classes
from termtide.plans.model import CLASSES_SQL, KEY, SAMPLES_SQL, classes, samples, table
from termtide.sources import tables
from termtide.sources.durable import shared_dir, stored
from termtide.sources.terms import TermStore
from termtide.streaming import deltas
from termtide.streaming.states import States
from termtide.streaming.store import Store, writer_of

SCOPES = ["1996-spring", "1997-fall", "1996-Q1", "1994-Q2", "1996-spring"]
CODES = {"spring": "Q1", "fall": "Q3"}


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/termtide-{uuid.uuid4().hex}"


def _offered(spark: SparkSession, d: str) -> DataFrame:
    return classes(spark, d).select("class_id", "year", "term", "name", "quota")


def terms_read(spark: SparkSession, d: str) -> DataFrame:
    """The feature itself: four scopes, one of them twice, of a table written by term."""
    path = _folder(spark)
    tables.write_terms(_offered(spark, d), path)
    return tables.read_terms(spark, path, SCOPES, CODES)


def terms_replaced(spark: SparkSession, d: str) -> DataFrame:
    """All terms, of which the second quarters, asked for by name, were written anew with other quotas."""
    path, c = _folder(spark), stored(_offered(spark, d))
    tables.write_terms(c, path)
    years = sorted(r["year"] for r in c.where("term = 'Q2'").select("year").distinct().collect())
    tables.replace_terms(stored(c.where("term = 'Q1' or quota > 1").withColumn("quota", -F.col("quota"))), path, scopes=[f"{y}-Q2" for y in years], aliases={})
    return tables.read_terms(spark, path)


def terms_exported(spark: SparkSession, d: str) -> DataFrame:
    """The JSON of all terms read again."""
    path = _folder(spark)
    c = classes(spark, d, nested=True).select("class_id", "year", "term", "name", "quota", "sbjt_cd", "lt_no", "slots")
    tables.export_terms_json(c, None, path, compression="gzip")
    out = spark.read.schema("class_id string, name string, quota int, slots array<struct<day_index:int,start_time:string,end_time:string,period:int,room:string>>, year int, term string").json(path)
    text = F.array_join(F.transform("slots", lambda s: F.concat_ws(" ", s["day_index"], s["start_time"], s["end_time"], s["room"])), ";")
    return out.select("class_id", "year", "term", "name", "quota", text.alias("slots"))


def flat_csv(spark: SparkSession, d: str) -> DataFrame:
    """The flat export written as CSV files that a spreadsheet opens and read again."""
    path = _folder(spark)
    tables.write_flat_csv(flat_classes(spark, d), path)
    return tables.read_flat_csv(spark, path)


def digest_applied(spark: SparkSession, d: str) -> DataFrame:
    """Local terms, of which one quarter is missing and another lacks rows, after a pull from a remote that was pushed twice."""
    c = stored(_offered(spark, d))
    at = lambda text: F.lit(text).cast("timestamp")
    local, remote = (TermStore(spark, _folder(spark), c.schema) for _ in range(2))
    local.push(c.where("term <> 'Q1' and not (term = 'Q2' and quota = 7)"), at("2024-01-01 00:00:00"))
    for day in ("2024-01-02 00:00:00", "2024-01-03 00:00:00"):
        remote.push(c.where("term <> 'Q4'"), at(day))
    local.pull(remote, at("2024-01-03 12:00:00"), 24, c.select("year", "term").distinct())
    return local.rows().join(local.digests().select("year", "term", "n", "fetched_at", "checked_at"), ["year", "term"])


def requirement_figures(spark: SparkSession, d: str) -> DataFrame:
    """A requirement page for each part, with a table of two rows and a text."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), F.col("p_size").alias("size"))
    first = F.array(F.lit("기준"), F.concat(F.col("size").cast("string"), F.lit(" 99 98 97 96")))
    second = F.concat(F.array(F.concat((120 + F.col("size") % 23).cast("string"), F.lit(" 학점"))), F.transform(F.sequence(F.lit(1), 3 + F.col("size") % 4), lambda i: (10 * i + F.col("size")).cast("string")))
    rows = p.select("page_id", F.lit(0).alias("table"), F.posexplode(F.array(first, second)).alias("row", "cells"))
    text = F.concat_ws(" ", F.when(F.col("size") % 2 == 0, F.concat(F.col("size").cast("string"), F.lit(" 과목 이상"))), F.when(F.col("size") % 3 == 0, F.concat(F.lit("최대 "), F.col("size"), F.lit("학점"))), F.when(F.col("size") % 5 == 0, F.lit("영어진행강좌")))
    return requirements.requirement_numbers(rows, p.select("page_id", text.alias("text")))


def requirement_years(spark: SparkSession, d: str) -> DataFrame:
    """Batches of supplier's requirements, one year or a range, by the rule set that holds."""
    first = 2018 + F.col("s_suppkey") % 8
    label = F.when(F.col("s_suppkey") % 3 == 0, F.concat(first, F.lit("~"), first + F.col("s_suppkey") % 4, F.lit("학번"))).when(F.col("s_suppkey") % 3 == 1, F.concat(first, F.lit(" 이후"))).otherwise("전체")
    specs = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("major"), label.alias("label"))
    return requirements.requirement_index(specs)


def _written(spark: SparkSession, df: DataFrame, parts: list) -> tuple[str, DataFrame]:
    """A folder with one file for each condition in order, and a stream that reads one file at a time."""
    path, df = f"{_folder(spark)}/in", stored(df)
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(path)
    return path, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream_encoded(spark: SparkSession, d: str) -> DataFrame:
    """All samples as a stream of observations in two batches, encoded as deltas by series."""
    seen = samples(spark, d).withColumn("gone", F.coalesce(*series.METRICS).isNull())
    early = F.pmod(F.dayofmonth("ts") - 1, F.lit(10)) < 5
    path, stream = _written(spark, seen, [early, ~early])
    out = path.removesuffix("/in") + "/out"
    encoded = deltas.stream_deltas(stream, KEY)
    encoded.writeStream.format("parquet").option("path", out).option("checkpointLocation", path.removesuffix("/in") + "/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(encoded.schema).parquet(out)


def _early():
    return F.pmod(F.dayofmonth("ts") - 1, F.lit(10)) < 5, F.hour("ts") == 5


def _merged(spark: SparkSession, d: str) -> Store:
    """Samples merged in three batches from two checkpoints: the second repeats rows of the first, the third has only late ones, and the first comes again."""
    all_ = samples(spark, d)
    early, late = _early()
    store = Store(spark, f"{_folder(spark)}/store", all_.schema, KEY)
    for parts in ([early & ~late], [(~early | (F.col("user_id") % 2 == 0)) & ~late, late]):
        path, stream = _written(spark, all_, parts)
        state = path.removesuffix("/in") + "/state"
        deltas.stream_merge(stream, store.path, state, KEY).awaitTermination()
        store.merge(all_.where(parts[0]), writer_of(spark, state), 0)
    return store


def stream_stored(spark: SparkSession, d: str) -> DataFrame:
    """Each sample once, repeated and late ones too."""
    return _merged(spark, d).samples().drop("day")


def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest rows, which samples older than a series' newest leave as they are."""
    return _merged(spark, d).latest()


def stream_batches(spark: SparkSession, d: str) -> DataFrame:
    """What the manifest says of each merge, and once more after all parts were put together."""
    store = _merged(spark, d)
    rows = store.manifest()
    store.compact()
    schema = "seq int, n_read long, n_inserted long, n_older long, cursor timestamp, n_days int"
    return spark.createDataFrame([(r["seq"], r["n_read"], r["n_inserted"], r["n_older"], r["cursor"], len(r["days"])) for r in [*rows, *store.manifest()]], schema)


def _behind(spark: SparkSession, d: str) -> Store:
    """The rows of hour 5 come last, those more than three days behind the newest by way of the late table."""
    all_ = samples(spark, d)
    late = F.hour("ts") == 5
    store = Store(spark, f"{_folder(spark)}/store", all_.schema, KEY)
    path, stream = _written(spark, all_.unionByName(all_.where("user_id % 5 = 0")), [~late, late])
    deltas.stream_merge(stream, store.path, path.removesuffix("/in") + "/state", KEY, delay=dt.timedelta(days=3)).awaitTermination()
    return store


def stream_late(spark: SparkSession, d: str) -> DataFrame:
    """The late table, each row once."""
    return _behind(spark, d).late()


def stream_days(spark: SparkSession, d: str) -> DataFrame:
    """Samples a day by the manifest, after the late rows were taken in."""
    store = _behind(spark, d)
    was = store.day_counts()
    store.merge_late()
    return spark.createDataFrame([(day, was.get(day, 0), n) for day, n in store.day_counts().items()], "day date, n_before long, n long")


def states_kept(spark: SparkSession, d: str) -> DataFrame:
    """The state before January 25 from states cut at three days, of which rows of the 14th that come late leave the oldest two."""
    all_ = samples(spark, d)
    gap = F.to_date("ts") == F.lit("2024-01-14")
    store = Store(spark, f"{_folder(spark)}/store", all_.schema, KEY)
    store.merge(all_.where(~gap), "collector", 0)
    states = States(store, f"{_folder(spark)}/states")
    for day in (6, 12, 18):
        states.write(dt.date(2024, 1, day))
    store.merge(all_, "recovered", 0)
    rows, start = states.before(dt.date(2024, 1, 25))
    return rows.withColumn("from_cut", F.lit(str(start)))


QUERIES = {f.__name__: f for f in (terms_read, terms_replaced, terms_exported, flat_csv, digest_applied, requirement_figures, requirement_years, stream_encoded, stream_stored, stream_latest, stream_batches, stream_late, stream_days, states_kept)}

_LATEST = """{name} AS (SELECT term, user_id, max(ts) AS ts, arg_max(applied, ts) FILTER (applied IS NOT NULL) AS applied, arg_max(cart, ts) FILTER (cart IS NOT NULL) AS cart,
  arg_max(enrolled, ts) FILTER (enrolled IS NOT NULL) AS enrolled, arg_max(quota, ts) FILTER (quota IS NOT NULL) AS quota
FROM (SELECT *, max(ts) FILTER (coalesce(applied, cart, enrolled, quota) IS NULL) OVER (PARTITION BY term, user_id) AS tomb FROM ({rows})) WHERE tomb IS NULL OR ts > tomb GROUP BY term, user_id)"""
ORACLE_SQL = {
    "terms_read": f"WITH {CLASSES_SQL} SELECT class_id, year, term, name, quota FROM classes WHERE (year, term) IN ((1996, 'Q1'), (1997, 'Q3'), (1994, 'Q2'))",
    "terms_replaced": f"WITH {CLASSES_SQL} SELECT class_id, year, term, name, CASE WHEN term = 'Q2' THEN -quota ELSE quota END AS quota FROM classes WHERE term <> 'Q2' OR quota > 1",
    "terms_exported": f"""WITH {CLASSES_SQL}, one AS (SELECT class_id, day_index, start_time, end_time, period, string_agg(DISTINCT room, '/' ORDER BY room) AS room FROM slots GROUP BY ALL)
SELECT c.class_id, year, term, name, quota, string_agg(o.day_index || ' ' || o.start_time || ' ' || o.end_time || ' ' || o.room, ';' ORDER BY o.day_index, o.start_time, o.end_time) AS slots FROM classes c JOIN one o USING (class_id) GROUP BY ALL""",
    "flat_csv": f"SELECT * REPLACE (nullif(grading_switch, '') AS grading_switch, nullif(classification, '') AS classification) FROM ({CATALOG_SQL['flat_export']})",
    "digest_applied": f"""WITH {CLASSES_SQL}, t AS (SELECT year, term, count(*) AS n, term = 'Q1' OR (term = 'Q2' AND count(*) FILTER (quota = 7) > 0) AS pulled FROM classes GROUP BY year, term)
SELECT class_id, year, term, name, quota, n, CASE WHEN pulled THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS fetched_at, CASE WHEN pulled THEN TIMESTAMP '2024-01-03' ELSE TIMESTAMP '2024-01-01' END AS checked_at FROM classes JOIN t USING (year, term)""",
    "requirement_figures": """WITH p AS (SELECT p_partkey AS page_id, p_size AS s, 120 + p_size % 23 AS t, 3 + p_size % 4 AS k FROM part), n AS (SELECT *, len(list_filter(range(1, k + 1), lambda i: 10 * i + s BETWEEN 10 AND 999)) + 1 AS c FROM p)
SELECT page_id, CASE WHEN t <= 140 AND c >= 5 THEN t END AS total, CASE WHEN t <= 140 AND c >= 6 THEN 10 + s END AS general, CASE WHEN t <= 140 AND c >= 6 THEN 20 + s END AS major_single, CASE WHEN t <= 140 AND c >= 6 THEN 50 + s END AS minor,
       CASE WHEN s % 2 = 0 THEN s ELSE 5 END AS select_min, CASE WHEN s % 3 = 0 THEN s ELSE 9 END AS approval_max, CASE WHEN s % 5 = 0 THEN 1 ELSE 0 END AS english_min,
       coalesce(CASE WHEN t <= 140 AND c >= 5 THEN t END, 130) BETWEEN 100 AND 140 AS total_ok, coalesce(CASE WHEN t <= 140 AND c >= 6 THEN 20 + s END, 60) BETWEEN 30 AND 90 AS major_ok FROM n""",
    "requirement_years": """WITH s AS (SELECT s_suppkey AS id, s_name AS major, 2018 + s_suppkey % 8 AS a, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 4 ELSE 0 END AS n FROM supplier WHERE s_suppkey % 3 < 2)
SELECT id, major, unnest(range(a, a + n + 1))::INTEGER AS batch, CASE WHEN a + n >= 2025 THEN 'after' ELSE 'before' END AS rules FROM s""",
    "stream_encoded": f"""WITH {SAMPLES_SQL}, m AS (SELECT *, coalesce(applied, cart, enrolled, quota) IS NULL AS gone, sum((coalesce(applied, cart, enrolled, quota) IS NULL)::INTEGER) OVER (PARTITION BY term, user_id ORDER BY ts) AS episode FROM samples),
k AS (SELECT *, lag(gone) OVER (PARTITION BY term, user_id ORDER BY ts) AS gone_before, last_value(applied IGNORE NULLS) OVER w AS pa, last_value(cart IGNORE NULLS) OVER w AS pc, last_value(enrolled IGNORE NULLS) OVER w AS pe, last_value(quota IGNORE NULLS) OVER w AS pq,
  count(*) FILTER (NOT gone) OVER w AS before FROM m WINDOW w AS (PARTITION BY term, user_id, episode ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT term, user_id, ts, applied, cart, enrolled, quota FROM k WHERE (gone AND NOT coalesce(gone_before, true)) OR (NOT gone AND (before = 0 OR (applied IS NOT NULL AND applied IS DISTINCT FROM pa) OR (cart IS NOT NULL AND cart IS DISTINCT FROM pc)
  OR (enrolled IS NOT NULL AND enrolled IS DISTINCT FROM pe) OR (quota IS NOT NULL AND quota IS DISTINCT FROM pq)))""",
    "stream_stored": f"WITH {SAMPLES_SQL} SELECT * FROM samples",
    "stream_latest": f"""WITH {SAMPLES_SQL}, {_LATEST.format(name='was', rows='SELECT * FROM samples WHERE hour(ts) <> 5')},
late AS (SELECT s.* FROM samples s LEFT JOIN was USING (term, user_id) WHERE hour(s.ts) = 5 AND (was.ts IS NULL OR s.ts >= was.ts)),
both_ AS (SELECT term, user_id, ts, applied, cart, enrolled, quota FROM was UNION ALL SELECT * FROM late), {_LATEST.format(name='l', rows='SELECT * FROM both_')} SELECT * FROM l""",
    "stream_batches": f"""WITH {SAMPLES_SQL}, {_LATEST.format(name='was', rows='SELECT * FROM samples WHERE hour(ts) <> 5')}, s AS (SELECT *, (day(ts) - 1) % 10 < 5 AS early, hour(ts) = 5 AS late, max(ts) FILTER (hour(ts) <> 5) OVER () AS top, ts::DATE AS d FROM samples)
SELECT 0::INTEGER AS seq, count(*) AS n_read, count(*) AS n_inserted, 0::BIGINT AS n_older, max(ts) AS cursor, count(DISTINCT d)::INTEGER AS n_days FROM s WHERE early AND NOT late
UNION ALL SELECT 1, count(*), count(*) FILTER (NOT early), 0, max(top), (count(DISTINCT d) FILTER (NOT early))::INTEGER FROM s WHERE (NOT early OR user_id % 2 = 0) AND NOT late
UNION ALL SELECT 2, count(*), count(*), count(*) FILTER (s.ts < was.ts), greatest(max(s.ts), max(top)), count(DISTINCT d)::INTEGER FROM s LEFT JOIN was USING (term, user_id) WHERE late
UNION ALL SELECT 3, 0, 0, 0, max(ts), count(DISTINCT d)::INTEGER FROM s""",
    "stream_late": f"WITH {SAMPLES_SQL} SELECT * FROM samples WHERE hour(ts) = 5 AND ts < (SELECT max(ts) FROM samples WHERE hour(ts) <> 5) - INTERVAL 3 DAYS",
    "stream_days": f"WITH {SAMPLES_SQL} SELECT ts::DATE AS day, count(*) FILTER (hour(ts) <> 5 OR ts >= (SELECT max(ts) FROM samples WHERE hour(ts) <> 5) - INTERVAL 3 DAYS) AS n_before, count(*) AS n FROM samples GROUP BY ALL",
    "states_kept": f"WITH {SAMPLES_SQL}, {_LATEST.format(name='l', rows='SELECT * FROM samples WHERE ts < TIMESTAMP \'2024-01-25\'')} SELECT *, '2024-01-12' AS from_cut FROM l",
}
