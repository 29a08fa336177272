"""Requirements: figures and years from pages, transcripts, recognised and elective credits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termtide.sources.durable import narrow

MAJOR = ("전선", "전필")  # fixed values: tags of major courses


#: What pages say of minimums, and how years are written (fixed patterns).
FIGURES, SELECTED, APPROVED = r"\b(\d{2,3})\b", r"(\d+)\s*과목\s*이상", r"최대\s*(\d+)\s*학점"
ENGLISH, YEARS = "영어진행강좌|외국어진행강좌|영어강의", r"(20\d{2})"


def requirement_numbers(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Per page the figures of its first row with five integers or more that starts with 120 to 140, and text minimums.

    rows: page_id, table, row, cells (array); texts: page_id, text. Six integers give all figures, five only
    the total; minimums fall back to 5 courses and 9 credits; figures out of range are flagged.
    """
    numbers = F.transform(F.flatten(F.transform("cells", lambda c: F.regexp_extract_all(c, F.lit(FIGURES), F.lit(1)))), lambda x: x.cast("int"))
    hits = rows.withColumn("n", numbers).where((F.size("n") >= 5) & F.get("n", 0).between(120, 140))
    first = hits.groupBy("page_id").agg(F.min_by("n", F.struct("table", "row")).alias("n"))
    six = F.size("n") >= 6
    pick = lambda i: F.when(six, F.get("n", i))
    grab = lambda p, default: F.coalesce(F.regexp_extract("text", p, 1).try_cast("int"), F.lit(default))
    out = texts.join(first, "page_id", "left").select(
        "page_id", F.get("n", 0).alias("total"), pick(1).alias("general"), pick(2).alias("major_single"), pick(5).alias("minor"),
        grab(SELECTED, 5).alias("select_min"), grab(APPROVED, 9).alias("approval_max"),
        F.when(F.col("text").rlike(ENGLISH), 1).otherwise(0).alias("english_min"),
    )
    return out.withColumn("total_ok", F.coalesce("total", F.lit(130)).between(100, 140)).withColumn("major_ok", F.coalesce("major_single", F.lit(60)).between(30, 90))


def batch_years(label: Column | str) -> Column:
    """`2023~2024...` to all its years, else the first year."""
    text = F.coalesce(F.col(label) if isinstance(label, str) else label, F.lit(""))
    years = F.transform(F.regexp_extract_all(text, F.lit(YEARS), F.lit(1)), lambda y: y.cast("int"))
    span = F.contains(text, F.lit("~")) & (F.size(years) == 2) & (F.get(years, 0) <= F.get(years, 1))
    return F.when(span, F.sequence(F.get(years, 0), F.get(years, 1))).otherwise(F.slice(years, 1, 1))


def requirement_index(specs: DataFrame, boundary: int = 2025) -> DataFrame:
    """One row per (id, major, year) with its rule set, by major and year descending."""
    one = specs.withColumn("years", batch_years("label")).withColumn("rules", F.when(F.exists("years", lambda y: y >= boundary), "after").otherwise("before"))
    return one.select("id", "major", F.explode("years").alias("batch"), "rules").orderBy(F.desc("major"), F.desc("batch"), "id")


def transcript(picks: DataFrame, sheets: DataFrame, key: list[str]) -> DataFrame:
    """The union of one timetable per semester, each class once; picks without a sheet row are dropped.

    picks: student, semester, sheet; sheets: student, sheet and the class columns with `key`.
    """
    chosen = sheets.join(picks.select("student", "semester", "sheet"), ["student", "sheet"])
    first = Window.partitionBy("student", *key).orderBy("semester", "sheet")
    return chosen.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def recognized(rows: DataFrame, specs: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """(student, spec_id, class columns): courses of other departments that a spec recognises.

    rows: student, spec_id, code, dept, college, cls (array), credits. specs: spec_id, own, courses,
    prefixes, any_dept, colleges, depts. A course counts by exact code or prefix; or, if it is a major
    course, by any department, college, or a department whose name (without a final 부) its own contains.
    """
    if canonical is not None:
        rows = rows.join(narrow(canonical.select("code", F.col("canonical").alias("_c"))), "code", "left").withColumn("code", F.coalesce("_c", "code")).drop("_c")
    both = rows.join(narrow(specs), "spec_id")
    dept = F.coalesce("dept", F.lit(""))
    own = F.contains(dept, F.col("own")) & (F.col("own") != "")
    major = F.arrays_overlap("cls", F.array(*map(F.lit, MAJOR)))
    by_code = F.array_contains("courses", F.col("code")) | F.exists("prefixes", lambda p: F.startswith(F.col("code"), p))
    by_unit = F.col("any_dept") | F.array_contains("colleges", F.coalesce("college", F.lit(""))) | F.exists("depts", lambda d: F.contains(dept, F.regexp_replace(d, "부$", "")))
    return both.where(~own & (by_code | (major & by_unit))).select(*rows.columns)


def elective_credits(rows: DataFrame, specs: DataFrame, tracks: DataFrame) -> DataFrame:
    """(student, spec_id, track, credits): own electives plus recognised credits up to the track's cap (null: none)."""
    owned = rows.join(narrow(specs.select("spec_id", "own")), "spec_id").where(F.contains(F.coalesce("dept", F.lit("")), F.col("own")) & F.array_contains("cls", MAJOR[0]))
    both = owned.select("student", "spec_id", F.col("credits").alias("own_credits"), F.lit(0).alias("other")).unionByName(
        recognized(rows, specs).select("student", "spec_id", F.lit(0).alias("own_credits"), F.col("credits").alias("other")))
    sums = both.groupBy("student", "spec_id").agg(F.sum("own_credits").alias("own_credits"), F.sum("other").alias("other"))
    return sums.join(narrow(tracks), "spec_id").select("student", "spec_id", "track", (F.col("own_credits") + F.least("other", F.coalesce("recog_max", "other"))).alias("credits"))
