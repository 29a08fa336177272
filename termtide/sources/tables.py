"""Reading and writing term-scoped tables, roster sheets, exports and attachment responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.functions import scalars
from termtide.operators.catalog import nest_slots
from termtide.sources.durable import stored

#: Term codes by their aliases, and the labels of the codes (fixed values).
ALIASES = {"spring": "U000200001U000300001", "summer": "U000200001U000300002", "fall": "U000200002U000300001", "winter": "U000200002U000300002"}
LABELS = {"U000200001U000300001": "1학기", "U000200002U000300001": "2학기", "U000200001U000300002": "여름학기", "U000200002U000300002": "겨울학기"}


def scope_list(scopes: list[str] | str, aliases: dict[str, str] | None = None) -> list[tuple[int, str]] | None:
    """`["2026-fall", "2026-1"]` to (year, term) pairs in order, each once; `all` is no restriction."""
    aliases = ALIASES if aliases is None else aliases
    out: dict[tuple[int, str], None] = {}
    for scope in [scopes] if isinstance(scopes, str) else scopes:
        if scope.strip().lower() == "all":
            return None
        year, _, term = scope.strip().partition("-")
        out[int(year), aliases.get(term.lower(), term)] = None
    return list(out)


def read_terms(spark: SparkSession, path: str, scopes: list[str] | str = "all", aliases: dict[str, str] | None = None) -> DataFrame:
    """A table partitioned by (year, term), only the partitions asked for."""
    df, pairs = spark.read.parquet(path), scope_list(scopes, aliases)
    if pairs is None:
        return df
    wanted = F.lit(False)
    for year, term in pairs:
        wanted = wanted | ((F.col("year") == year) & (F.col("term").cast("string") == term))
    return df.where(wanted)


def write_terms(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.hint("rebalance", "year", "term").write.mode(mode).partitionBy("year", "term").parquet(path)


def replace_terms(new: DataFrame, path: str, min_ratio: float = 0.9, force: bool = False, scopes: list[str] | None = None, aliases: dict[str, str] | None = None) -> None:
    """Replace only the partitions that `new` holds; refused if it is empty or a term shrinks below `min_ratio`.

    scopes: the terms to replace; other rows of `new` are left out, and a term that it has no row of is refused, even
    with `force`: an absent term is a failed collection, not an empty one.
    """
    spark = new.sparkSession
    pairs = scope_list(scopes, aliases) if scopes is not None else None
    if pairs is not None:
        asked = spark.createDataFrame(pairs, "year int, term string")
        new = new.join(F.broadcast(asked), [new["year"] == asked["year"], new["term"].cast("string") == asked["term"]], "left_semi")
        there = {(r["year"], r["term"]) for r in new.select("year", F.col("term").cast("string").alias("term")).distinct().collect()}
        absent = [f"{year}-{term}" for year, term in pairs if (year, term) not in there]
        if absent:
            raise ValueError(f"no rows of {', '.join(absent)}")
    counts = new.groupBy("year", "term").agg(F.count(F.lit(1)).alias("n"))
    if not force:
        if counts.isEmpty():
            raise ValueError("nothing to write")
        old = spark.read.parquet(path).groupBy("year", "term").agg(F.count(F.lit(1)).alias("was"))
        shrunk = counts.join(old, ["year", "term"]).where(F.col("n") < min_ratio * F.col("was")).limit(5).collect()
        if shrunk:
            raise ValueError(f"terms shrink too much: {[r.asDict() for r in shrunk]}")
    out = new.hint("rebalance", "year", "term")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "term").parquet(path)


def export_terms_json(classes: DataFrame, slots: DataFrame | None, path: str, compression: str = "none") -> None:
    """One JSON folder per term, classes with their nested slots in search order.

    slots: None where the classes hold them as an array already. compression: of the files, such as gzip.
    """
    nested = (classes if slots is None else nest_slots(classes, slots)).repartitionByRange("year", "term", "name", "lt_no", "sbjt_cd")
    nested.sortWithinPartitions("year", "term", "name", "lt_no", "sbjt_cd").write.mode("overwrite").partitionBy("year", "term").json(path, compression=compression)


#: Columns of the flat export in their order (fixed values): year, term, name, professor, college, department, code,
#: lecture, credits, grade, tags, quota, quota of returning and of new students, applied, grading, its switch, times.
FLAT = ("year", "term_label", "name", "professor", "college", "department", "sbjt_cd", "lt_no", "credits", "grade", "classification",
        "quota", "quota_returning", "quota_new", "applied", "grading", "grading_switch", "times")


def export_flat(classes: DataFrame) -> DataFrame:
    """Eighteen flat columns: the term's label, quota left to new students, tags joined by blanks, meetings as text."""
    have = lambda c: F.col(c) if c in classes.columns else F.lit(None)
    label = F.coalesce(*(F.when(F.col("term") == code, F.lit(text)) for code, text in LABELS.items()), F.col("term"))
    returning = have("quota_returning").cast("int")
    known = F.filter("slots", lambda s: s["day_index"].isNotNull() & (F.coalesce(s["start_time"], F.lit("")) != ""))
    day = lambda d: F.when(d.between(0, 6), F.substring(F.lit(scalars.DAYS), d + 1, F.lit(1))).otherwise("?")
    times = F.transform(known, lambda s: F.concat(day(s["day_index"]), F.lit("("), s["start_time"], F.lit("~"), F.coalesce(s["end_time"], F.lit("")), F.lit(")")))
    made = {
        "term_label": label, "college": have("college").cast("string"), "classification": F.array_join("classification", " "), "quota_returning": returning,
        "quota_new": F.col("quota") - returning, "grading": F.coalesce("grading", F.lit("")), "grading_switch": F.coalesce(have("grading_switch").cast("string"), F.lit("")), "times": F.array_join(times, "/"),
    }
    return classes.select(*(made[c].alias(c) if c in made else F.col(c) for c in FLAT))


#: Headings of the flat export in its order (fixed values).
HEADINGS = ("연도", "학기", "교과목명", "교수", "단과대학", "학과", "교과목번호", "강좌번호", "학점", "학년", "이수구분", "정원", "재학생정원", "신입생정원", "신청", "평가방식", "평가방식전환가능", "수업시간")
#: How spreadsheets read and write CSV: quotes doubled, blanks kept, nothing for null and empty.
CSV = {"escape": '"', "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: Rows that a spreadsheet opens, headings not counted, and those that a file of several is meant to hold.
SHEET, FILE_ROWS = 1_048_575, 500_000


def write_flat_csv(classes: DataFrame, path: str, files: int | None = None) -> None:
    """The flat export as CSV with headings and a byte order mark, in search order.

    By default one file up to `FILE_ROWS` rows, and one for as many rows each beyond it: no spreadsheet opens more than
    `SHEET`, and no task sorts the whole table. Each of several holds a range of the order and has headings of its own.
    """
    flat, order = stored(export_flat(classes)), ["year", "term_label", "name", "lt_no", "sbjt_cd"]
    files = max(1, -(-flat.count() // FILE_ROWS)) if files is None else files
    flat = flat.coalesce(1) if files == 1 else flat.repartitionByRange(files, *order)
    flat = flat.sortWithinPartitions(*order).toDF("\ufeff" + HEADINGS[0], *HEADINGS[1:])
    flat.write.mode("overwrite").options(header="true", maxRecordsPerFile=SHEET, **CSV).csv(path)


def read_flat_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of such files; empty values are null."""
    kinds = ", ".join(f"{c} {'int' if c in ('year', 'credits', 'quota', 'quota_returning', 'quota_new', 'applied') else 'string'}" for c in FLAT)
    return spark.read.schema(kinds).options(header="true", multiLine="true", **CSV).csv(path)


def normalize_roster(raw: DataFrame) -> DataFrame:
    """Roster rows (code, lecture, name, subtitle, tag_a, tag_b, credits, quota, times, rooms) to class records.

    Rows without a code go; the lecture defaults to 001; a subtitle that differs from the name follows it in
    parentheses.
    """
    quota = scalars.parse_quota("quota")
    subtitle = F.trim(F.coalesce("subtitle", F.lit("")))
    name = F.trim(F.coalesce("name", F.lit("")))
    return raw.where(F.trim(F.coalesce("code", F.lit(""))) != "").select(
        F.trim("code").alias("sbjt_cd"), F.when(F.trim(F.coalesce("lecture", F.lit(""))) == "", "001").otherwise(F.trim("lecture")).alias("lt_no"),
        F.when((subtitle != "") & (subtitle != name), F.concat(name, F.lit(" ("), subtitle, F.lit(")"))).otherwise(name).alias("name"),
        F.filter(F.array(F.trim(F.coalesce("tag_a", F.lit(""))), F.trim(F.coalesce("tag_b", F.lit("")))), lambda t: t != "").alias("classification"),
        scalars.truncated_int("credits").alias("credits"), quota["total"].alias("quota"), quota["returning"].alias("quota_returning"),
        scalars.parse_room("rooms").alias("room"), scalars.pair_rooms("times", "rooms").alias("slots"),
    )


ATTACHMENTS = "struct<LISTTAB03_LIST_ATTACH:array<struct<rowIdx:int,korFileNm:string,engFileNm:string,korAttachNo:string,engAttachNo:string,korAttachDetaNo:int,engAttachDetaNo:int>>>"


def parse_attachments(df: DataFrame, json_col: str = "json") -> DataFrame:
    """(other columns, lang, name, file_no, detail_no): entries with a name and a file number; the detail defaults to 0."""
    entry = F.explode(F.from_json(json_col, ATTACHMENTS)["LISTTAB03_LIST_ATTACH"])
    both = df.withColumn("_e", entry).withColumn("_f", F.explode(F.array(*(
        F.struct(F.lit(lang).alias("lang"), F.col(f"_e.{p}FileNm").alias("name"), F.col(f"_e.{p}AttachNo").alias("file_no"), F.coalesce(F.col(f"_e.{p}AttachDetaNo"), F.lit(0)).alias("detail_no"))
        for lang, p in (("ko", "kor"), ("en", "eng"))))))
    out = both.select(*(c for c in df.columns if c != json_col), "_f.*")
    return out.where((F.trim(F.coalesce("name", F.lit(""))) != "") & (F.coalesce("file_no", F.lit("")) != ""))
