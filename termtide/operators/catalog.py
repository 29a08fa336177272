"""Catalogue tables: search, windows, live resolution, overlays, tagging, recovery, vocabularies, nesting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.functions import scalars
from termtide.functions.text import identity_text

SEARCH_ORDER = ("name", "lt_no", "sbjt_cd", "subh_cd", "class_id")


# --- search ---------------------------------------------------------------------------------------------


def search(
    classes: DataFrame, slots: DataFrame | None = None, *, equal: dict[str, object] | None = None, contains: dict[str, str] | None = None,
    any_of: Sequence[Sequence[str]] = (), within: dict[str, Sequence[str]] | None = None, meets: tuple[int, int] | None = None,
    limit: int | None = None, offset: int = 0, order: Sequence[str] = SEARCH_ORDER, ordered: bool = True,
) -> DataFrame:
    """Classes under the given conditions; an absent filter is no condition.

    equal: column = value; contains: substring, case ignored (`%` and `_` stand for themselves); any_of: for
    each group of tokens, one of them is in `classification`; within: column in list; meets: (day, period).
    """
    out = classes
    for col, value in (equal or {}).items():
        out = out.where(F.col(col) == value)
    for col, part in (contains or {}).items():
        out = out.where(F.contains(F.lower(col), F.lower(F.lit(part))))
    for group in any_of:
        if group:
            out = out.where(F.arrays_overlap("classification", F.array(*map(F.lit, group))))
    for col, values in (within or {}).items():
        out = out.where(F.col(col).isin(list(values)))
    if meets:
        out = out.join(slots.where((F.col("day_index") == meets[0]) & (F.col("period") == meets[1])).select("class_id").distinct(), "class_id", "left_semi")
    if ordered:
        out = out.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def search_count(classes: DataFrame, slots: DataFrame | None = None, **filters) -> DataFrame:
    """One row `n`: how many classes a search finds, paging ignored."""
    filters = {k: v for k, v in filters.items() if k not in ("limit", "offset")}
    return search(classes, slots, ordered=False, **filters).agg(F.count(F.lit(1)).alias("n"))


# --- windows --------------------------------------------------------------------------------------------


def window_list(spec: str | None) -> list[tuple[str, str]]:
    """`2026-08-04..2026-08-05,2026-08-09` to (first day, last day) pairs; '' is an open end."""
    out = []
    for part in (spec or "").split(","):
        if part := part.strip():
            start, _, end = part.partition("..")
            out.append((start.strip(), end.strip() or start.strip()))
    return out


def in_windows(day: Column, spec: str | None) -> Column:
    """Whether a day (yyyy-MM-dd text or date) is in any window of a list; a blank list is never."""
    text, hit = F.date_format(day, "yyyy-MM-dd"), F.lit(False)
    for start, end in window_list(spec):
        hit = hit | ((F.lit(not start) | (text >= start)) & (F.lit(not end) | (text <= end)))
    return hit


def in_window(day: Column, start: str | None, end: str | None) -> Column:
    """The single-window variant: a blank bound is open."""
    text, s, e = F.date_format(day, "yyyy-MM-dd"), (start or "").strip(), (end or "").strip()
    return (F.lit(not s) | (text >= s)) & (F.lit(not e) | (text <= e))


def pass_flags(passes: DataFrame, cfg: dict[str, object], ts: str = "ts") -> DataFrame:
    """The passes with applied, cart and enrolled: which metrics each collects.

    cfg: cart_windows, enroll_windows, slow_windows, slow_minutes, cart (start, end), enroll (start, end),
    forced, collect_cart, collect_enrollment.
    """
    day, minute = F.col(ts), F.minute(ts)
    single = lambda name: in_window(day, *(cfg.get(name) or (None, None)))
    cart = in_windows(day, cfg["cart_windows"]) if cfg.get("cart_windows") else single("cart")
    enrolled = in_windows(day, cfg["enroll_windows"]) if cfg.get("enroll_windows") else single("enroll")
    enrolled = enrolled | (in_windows(day, cfg.get("slow_windows")) & (minute < cfg.get("slow_minutes", 60)))
    if cfg.get("forced"):
        cart, enrolled = F.lit(False), F.lit(True)
    on_cart, on_enrollment = bool(cfg.get("collect_cart", True)), bool(cfg.get("collect_enrollment", True))
    return passes.withColumns({"applied": F.lit(on_enrollment), "cart": cart & F.lit(on_cart), "enrolled": enrolled & F.lit(on_enrollment)})


def term_status(terms: DataFrame, year: int, term: str) -> DataFrame:
    """past, current or upcoming against the counted term, by (year, term code)."""
    own, now = F.struct("year", "term"), F.struct(F.lit(year).alias("year"), F.lit(term).alias("term"))
    return terms.withColumn("status", F.when(own < now, "past").when(own == now, "current").otherwise("upcoming"))


def cart_ratio(classes: DataFrame) -> DataFrame:
    return classes.withColumn("cart_ratio", F.when(F.col("quota") > 0, F.col("cart") / F.col("quota")))


# --- live records ---------------------------------------------------------------------------------------

LIVE_KEY = ("year", "term", "sbjt_cd", "lt_no")
EVIDENCE = ("name", "professor", "department")


def gather_live(live: DataFrame, catalog: DataFrame, live_row: Sequence[str] = (), catalog_row: Sequence[str] = (), live_id: str = "live_id", catalog_id: str = "class_id") -> DataFrame:
    """(LIVE_KEY, records, sections): what live records and catalogue have of one (year, term, code, lecture), as arrays.

    Each is struct<id, subh_cd, told: struct<name, professor, department>, row: struct>; `told` is normalised, `row` holds
    the columns asked for. A key has few of both, and everything below is told within its row, without another shuffle.
    """
    def side(df: DataFrame, own_id: str, row: Sequence[str], name: str) -> DataFrame:
        told = F.struct(*(identity_text(F.col(c)).alias(c) for c in EVIDENCE))
        one = F.struct(F.col(own_id).alias("id"), "subh_cd", told.alias("told"), F.struct(*row, F.lit(None).alias("_")).alias("row"))
        return df.select(*LIVE_KEY, one.alias("one")).groupBy(*LIVE_KEY).agg(F.collect_list("one").alias(name))

    out = side(live, live_id, live_row, "records").join(side(catalog, catalog_id, catalog_row, "sections"), list(LIVE_KEY), "full")
    return out.withColumns({c: F.coalesce(c, F.array().cast(out.schema[c].dataType)) for c in ("records", "sections")})


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def resolve_gathered(met: DataFrame) -> DataFrame:
    """The rows of `gather_live` with `class_id` and `method` in each record.

    Names are compared only for records that neither the exact section nor a lone candidate settles.
    """
    result = lambda found, method: F.struct(found.cast("string").alias("class_id"), F.lit(method).alias("method"))

    def fits(mine: Column, theirs: Column) -> Column:
        agree, compared = F.lit(True), F.lit(False)
        for c in EVIDENCE:
            both = (mine[c] != "") & (theirs[c] != "")
            agree, compared = agree & (~both | (mine[c] == theirs[c])), compared | both
        return agree & compared

    def settled(r: Column) -> Column:
        exact = F.array_min(F.transform(F.filter("sections", lambda s: s["subh_cd"] == r["subh_cd"]), lambda s: s["id"]))
        alike = F.filter("sections", lambda s: fits(r["told"], s["told"]))
        by_names = _let(alike, lambda a: F.when(F.size(a) == 1, result(F.get(a, 0)["id"], "metadata")).otherwise(result(F.lit(None), "ambiguous")))
        lone = F.when(F.size("sections") == 1, result(F.get("sections", 0)["id"], "code+lecture")).otherwise(by_names)
        return F.when(F.size("sections") == 0, result(F.lit(None), "missing")).otherwise(_let(exact, lambda e: F.when(e.isNotNull(), result(e, "exact")).otherwise(lone)))

    known = F.transform("records", lambda r: _let(settled(r), lambda f: F.struct(r["id"].alias("id"), r["row"].alias("row"), f["class_id"].alias("class_id"), f["method"].alias("method"))))
    return met.withColumn("records", known)


def resolution(met: DataFrame, live_id: str = "live_id", catalog_id: str = "class_id") -> DataFrame:
    """(live_id, class_id, method) of gathered records."""
    out = resolve_gathered(met).select(F.explode("records").alias("r"))
    return out.select(F.col("r.id").alias(live_id), F.col("r.class_id").alias(catalog_id), "r.method")


def resolve_live(live: DataFrame, catalog: DataFrame, live_id: str = "live_id", catalog_id: str = "class_id") -> DataFrame:
    """(live_id, class_id, method): exact, code+lecture, metadata, ambiguous or missing."""
    return resolution(gather_live(live, catalog, live_id=live_id, catalog_id=catalog_id), live_id, catalog_id)


def overlay_gathered(met: DataFrame, chosen: Sequence[str], catalog_id: str = "class_id") -> DataFrame:
    """The rows of the gathered sections, with the figures `chosen` from the records that resolve to them.

    Null keeps the old value, 0 overrides; of several records the last one (largest id) with a value counts.
    """
    newest = lambda mine, m: F.array_max(F.transform(F.filter(mine, lambda r: r["row"][m].isNotNull()), lambda r: F.struct(r["id"].alias("id"), r["row"][m].alias("v"))))["v"]
    over = lambda s, mine: F.struct(s["id"].alias("id"), s["row"].alias("row"), *(F.coalesce(newest(mine, m), s["row"][m]).alias(m) for m in chosen))
    fresh = lambda s: _let(F.filter("records", lambda r: r["class_id"] == s["id"]), lambda mine: over(s, mine))
    one = resolve_gathered(met).select(F.explode(F.transform("sections", fresh)).alias("s"))
    kept = [c for c in one.schema["s"].dataType["row"].dataType.names if c not in (catalog_id, "_")]
    return one.select(F.col("s.id").alias(catalog_id), *(F.col(f"s.{c}" if c in chosen else f"s.row.{c}").alias(c) for c in kept))


def overlay_counts(catalog: DataFrame, live: DataFrame, collect_cart: bool = True, collect_enrollment: bool = True, live_id: str = "live_id") -> DataFrame:
    """The catalogue with live counts of the selected groups: null keeps the old value, 0 overrides.

    Where several live records resolve to one class, the last one (largest id) with a value counts.
    """
    chosen = [m for m in (["cart"] if collect_cart else []) + (["applied", "enrolled", "quota"] if collect_enrollment else []) if m in live.columns and m in catalog.columns]
    return overlay_gathered(gather_live(live, catalog, chosen, catalog.columns, live_id), chosen).select(*catalog.columns) if chosen else catalog


def report_gathered(met: DataFrame) -> DataFrame:
    """One row: fetched, updated, unmatched live records. A class belongs to one key, so classes are told apart within it."""
    found = F.filter("records", lambda r: r["class_id"].isNotNull())
    n = resolve_gathered(met).select(F.size("records").alias("n"), F.transform(found, lambda r: r["class_id"]).alias("found"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return n.agg(total("n").alias("fetched"), total(F.size(F.array_distinct("found"))).alias("updated"), total(F.col("n") - F.size("found")).alias("unmatched"))


def overlay_report(catalog: DataFrame, live: DataFrame, live_id: str = "live_id") -> DataFrame:
    """One row: fetched, updated, unmatched live records."""
    return report_gathered(gather_live(live, catalog, live_id=live_id))


def apply_latest(catalog: DataFrame, latest: DataFrame, key: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The catalogue with the latest samples by stable key; null keeps the old value."""
    right = latest.select(*key, *(F.col(m).alias(f"_{m}") for m in metrics))
    out = catalog.join(right, list(key), "left")
    return out.select(*(F.coalesce(f"_{c}", c).alias(c) if c in metrics else F.col(c) for c in catalog.columns))


def freshness(latest: DataFrame, passes: DataFrame) -> DataFrame:
    """One row: the newer of the newest latest-time and the newest pass; null without latest rows."""
    both = latest.select("ts", F.lit(1).alias("is_latest")).unionByName(passes.select("ts", F.lit(0).alias("is_latest")))
    return both.agg(F.max("ts").alias("ts"), F.max("is_latest").alias("any")).select(F.when(F.col("any") == 1, F.col("ts")).alias("fresh_at"))


def restore_metric(rebuilt: DataFrame, old: DataFrame, key: Sequence[str], col: str) -> DataFrame:
    """Saved non-null values win over rebuilt ones."""
    saved = old.where(F.col(col).isNotNull()).select(*key, F.col(col).alias("_saved"))
    return rebuilt.join(saved, list(key), "left").select(*(F.coalesce("_saved", c).alias(c) if c == col else F.col(c) for c in rebuilt.columns))


def tag_grading(classes: DataFrame, methods: DataFrame, switchable: DataFrame, key: Sequence[str] = ("sbjt_cd", "lt_no", "subh_cd")) -> DataFrame:
    """Grading of each class from sweeps (the largest `sweep` wins) and a switch flag Y or N; an error without any sweep.

    A class that no sweep holds keeps its grading.
    """
    if methods.isEmpty() and not classes.isEmpty():
        raise ValueError("the term has classes but no grading sweep")
    last = methods.groupBy(*key).agg(F.max_by("grading", "sweep").alias("_grading"))
    flags = switchable.select(*key).distinct().withColumn("_switch", F.lit("Y"))
    out = classes.join(last, list(key), "left").join(flags, list(key), "left")
    return out.withColumn("grading", F.coalesce("_grading", "grading")).withColumn("grading_switch", F.coalesce("_switch", F.lit("N"))).drop("_grading", "_switch")


def recover_timing(classes: DataFrame, slots: DataFrame, found: DataFrame, minimum: float = 0.5) -> DataFrame:
    """Slots, with blocks found elsewhere for classes that have none, only if the timed share is under `minimum`."""
    timed = slots.select("class_id").distinct()
    total, have = classes.count(), classes.join(timed, "class_id", "left_semi").count()
    if not total or have / total >= minimum:
        return slots
    lacking = classes.join(timed, "class_id", "left_anti").select("class_id", "sbjt_cd", "lt_no")
    blocks = found.select("sbjt_cd", "lt_no", *(c for c in slots.columns if c != "class_id")).distinct()
    return slots.unionByName(lacking.join(blocks, ["sbjt_cd", "lt_no"]).select(*slots.columns))


def backfill_rooms(classes: DataFrame, slots: DataFrame, records: DataFrame, record_slots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slots, status of each record): rooms from a record whose (code, lecture) names one class and whose times are equal.

    records: rec_id, sbjt_cd, lt_no, room; record_slots: rec_id and the slot columns. status: matched,
    unmatched or ambiguous, with `timing_differs`, and the class it matched.
    """
    n = classes.groupBy("sbjt_cd", "lt_no").agg(F.count(F.lit(1)).alias("n"), F.min("class_id").alias("class_id"))
    signature = lambda t, k: t.groupBy(k).agg(F.array_sort(F.collect_set(F.struct("day_index", "start_time", "end_time"))))
    own, theirs = signature(slots, "class_id").toDF("class_id", "_own"), signature(record_slots, "rec_id").toDF("rec_id", "_theirs")
    # times join the classes before records do: records without a class would all meet under null
    matched = records.join(n.join(own, "class_id", "left"), ["sbjt_cd", "lt_no"], "left").join(theirs, "rec_id", "left")
    status = matched.withColumn("status", F.when(F.col("n").isNull(), "unmatched").when(F.col("n") > 1, "ambiguous").otherwise("matched"))
    status = status.withColumn("timing_differs", (F.col("status") == "matched") & ~F.col("_own").eqNullSafe(F.col("_theirs")))
    good = status.where("status = 'matched' and not timing_differs").select("rec_id", "class_id")
    fresh = record_slots.join(good, "rec_id").select(*slots.columns)
    out = slots.join(good.select("class_id").distinct(), "class_id", "left_anti").unionByName(fresh)
    return out, status.select("rec_id", F.when(F.col("status") == "matched", F.col("class_id")).alias("class_id"), "status", "timing_differs", F.when(F.col("status") == "matched", F.col("room")).alias("room"))


def backfill_gathered(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slots, status of each record) as `backfill_rooms` has them, from rows that hold all of one (code, lecture).

    met: `classes` and `records`, arrays of struct<id, room, slots: array<struct>>. The classes' own slots lose their rooms
    and then repeats; nothing is moved.
    """
    signature = lambda slots: F.array_sort(F.array_distinct(F.transform(slots, lambda t: F.struct(t["day_index"].alias("day_index"), t["start_time"].alias("start_time"), t["end_time"].alias("end_time")))))
    n = F.size("classes")
    status = F.when(n == 0, "unmatched").when(n > 1, "ambiguous").otherwise("matched")
    only = F.when(n == 1, F.get("classes", 0))
    own = met.select("classes", "records", status.alias("status"), only["id"].alias("class_id"), signature(only["slots"]).alias("own"))
    told = F.transform("records", lambda r: F.struct(r["id"].alias("rec_id"), F.when(F.col("class_id").isNotNull(), r["room"]).alias("room"), r["slots"].alias("slots"), (F.col("class_id").isNotNull() & ~signature(r["slots"]).eqNullSafe(F.col("own"))).alias("timing_differs")))
    known = own.select("classes", "status", "class_id", told.alias("records"))
    one = known.select(F.explode("records").alias("r"), "class_id", "status")
    good = F.filter("records", lambda r: (F.col("status") == "matched") & ~r["timing_differs"])
    blank = lambda c: F.struct(c["id"].alias("class_id"), F.array_distinct(F.transform(c["slots"], lambda t: t.withField("room", F.lit("")))).alias("slots"))
    given = F.transform("good", lambda r: F.struct(F.col("class_id").alias("class_id"), r["slots"].alias("slots")))
    lists = known.withColumn("good", good).select(F.explode(F.when(F.size("good") > 0, given).otherwise(F.transform("classes", blank))).alias("c"))
    return lists.select("c.class_id", F.inline("c.slots")), one.select("r.rec_id", "class_id", "status", "r.timing_differs", "r.room")


def lookup(classes: DataFrame, keys: DataFrame, key: Sequence[str] = LIVE_KEY) -> DataFrame:
    return classes.join(keys.select(*key).distinct(), list(key), "left_semi")


def reconcile(saved: DataFrame, classes: DataFrame, slots: DataFrame, key: Sequence[str] = LIVE_KEY) -> DataFrame:
    """(key, status): saved rows with an array `slots` against today's: same, changed or cancelled."""
    now = nest_slots(classes.select("class_id", *key), slots).select(*key, scalars.slot_signature("slots").alias("_now"), F.lit(True).alias("_here"))
    out = saved.withColumn("_was", scalars.slot_signature("slots")).join(now, list(key), "left")
    return out.select(*key, F.when(F.col("_here").isNull(), "cancelled").when(F.col("_was").eqNullSafe(F.col("_now")), "same").otherwise("changed").alias("status"))


def audit_gathered(met: DataFrame, col: str) -> DataFrame:
    """(class_id, verdict) of the gathered sections in which a column is null."""
    unsure = F.exists("records", lambda r: r["method"] == "ambiguous")

    def verdict(s: Column) -> Column:
        seen = F.filter("records", lambda r: r["class_id"] == s["id"])
        good = lambda r: F.coalesce(r["row"][col] >= 0, F.lit(False))
        said = _let(seen, lambda x: F.when(F.exists(x, good), "recoverable").when(F.size(x) > 0, "site_null").when(unsure, "ambiguous").otherwise("not_seen"))
        return F.struct(s["id"].alias("class_id"), said.alias("verdict"))

    missing = F.filter("sections", lambda s: s["row"][col].isNull())
    return resolve_gathered(met).select(F.explode(F.transform(missing, verdict)).alias("s")).select("s.*")


def audit_nulls(catalog: DataFrame, live: DataFrame, col: str, live_id: str = "live_id") -> DataFrame:
    """(class_id, verdict) of stored nulls: recoverable, site_null, ambiguous or not_seen."""
    return audit_gathered(gather_live(live, catalog, [col], [col], live_id), col)


def null_summary(catalog: DataFrame, col: str, by: Sequence[str] = ("year", "term", "subh_cd")) -> DataFrame:
    return catalog.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(col).isNull(), 1)).alias("n_null"))


def worklist(classes: DataFrame, cache: DataFrame, key: Sequence[str], retry_failed: bool = False, limit: int | None = None) -> DataFrame:
    """Distinct keys without a cached result (with `retry_failed` also those whose result failed), in order."""
    done = cache.where("ok") if retry_failed else cache
    out = classes.select(*key).distinct().join(done.select(*key), list(key), "left_anti").orderBy(*key)
    return out if limit is None else out.limit(limit)


# --- vocabularies, nesting ------------------------------------------------------------------------------


def token_counts(classes: DataFrame, col: str = "classification") -> DataFrame:
    return classes.select(F.explode(col).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "token")


def vocabulary(df: DataFrame, col: str, by: str = "value") -> DataFrame:
    """Distinct non-blank values, by value or by frequency (ties by value)."""
    out = df.where(F.trim(F.coalesce(F.col(col), F.lit(""))) != "").groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy("value") if by == "value" else out.orderBy(F.desc("n"), "value")


def list_terms(terms: DataFrame) -> DataFrame:
    return terms.select("year", "term").distinct().orderBy(F.desc("year"), "term")


def time_stats(classes: DataFrame, slots: DataFrame, terms: DataFrame) -> DataFrame:
    """Per term: classes, timed, timeless, and a label that falls back to `year term`."""
    timed = slots.select("class_id").distinct().withColumn("_timed", F.lit(1))
    n = classes.join(timed, "class_id", "left").groupBy("year", "term").agg(F.count(F.lit(1)).alias("classes"), F.count("_timed").alias("timed"))
    out = n.join(terms.select("year", "term", "label"), ["year", "term"], "left")
    return out.select("year", "term", F.coalesce("label", F.concat_ws(" ", "year", "term")).alias("label"), "classes", "timed", (F.col("classes") - F.col("timed")).alias("timeless"))


def term_index(classes: DataFrame, year: int, term: str, chunks: DataFrame | None = None) -> DataFrame:
    """Per term its row count, status, and vocabularies as ordered lists.

    With `chunks` (`series.chunk_axis` by year and term) also where the live slice starts, how many complete chunks are
    before it, and the times at which chunks start; null, 0 and none for terms without a series.
    """
    listed = lambda c: F.array_sort(F.collect_set(F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.col(c)))).alias(f"{c}s")
    out = term_status(classes.groupBy("year", "term").agg(F.count(F.lit(1)).alias("n"), listed("department"), listed("grade"), listed("grading")), year, term)
    if chunks is None:
        return out
    starts = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "start_ts"))), lambda c: c["start_ts"])
    live = chunks.groupBy("year", "term").agg(F.max("live_from").alias("live_from"), F.max("exposed").alias("exposed"), starts.alias("chunk_starts"))
    out = out.join(live, ["year", "term"], "left")
    return out.withColumns({"exposed": F.coalesce("exposed", F.lit(0)), "chunk_starts": F.coalesce("chunk_starts", F.array().cast(live.schema["chunk_starts"].dataType))})


def untagged(classes: DataFrame, methods: DataFrame, key: Sequence[str] = ("sbjt_cd", "lt_no", "subh_cd")) -> DataFrame:
    """One row: classes, and those that no sweep holds."""
    held = methods.select(*key).distinct().withColumn("_held", F.lit(1))
    return classes.join(held, list(key), "left").agg(F.count(F.lit(1)).alias("classes"), F.count(F.when(F.col("_held").isNull(), 1)).alias("untagged"))


def nest_slots(classes: DataFrame, slots: DataFrame) -> DataFrame:
    """The classes with an array `slots`: one per (day, start, end), its rooms sorted and joined by `/`.

    Slots are dealt out by class once, for both groupings and the join.
    """
    one = slots.repartition("class_id").groupBy("class_id", "day_index", "period", "start_time", "end_time").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.coalesce("room", F.lit("")) != "", F.col("room")))), "/").alias("room"))
    nested = one.groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("day_index", "start_time", "end_time", "period", "room"))).alias("slots"))
    out = classes.join(nested, "class_id", "left")
    return out.withColumn("slots", F.coalesce("slots", F.array().cast(out.schema["slots"].dataType)))
