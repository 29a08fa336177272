"""Delta time series: encode, fold, merge, replay, change points, windows, feeds.

`key` columns identify a series (scope columns such as the term first); `ts` orders it. A sample row holds
the metrics that a pass collected, null where it did not look; a row of nulls is a tombstone. The axis is
one row per (scope, pass) with a boolean per maskable metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termtide.sources.durable import by_size, cut

METRICS = ("applied", "cart", "enrolled", "quota")
MASKED = ("applied", "cart", "enrolled")


def _gone(metrics) -> Column:
    return F.coalesce(*metrics).isNull() if metrics else F.lit(False)


def load_axis(passes: DataFrame | None, samples: DataFrame, scope: list[str], masked=MASKED) -> DataFrame:
    """Passes in order with `pass_idx` from 0 and a flag per metric; scopes without passes derive them from samples."""
    derived = samples.groupBy(*scope, "ts").agg(*(F.max(F.col(m).isNotNull()).alias(m) for m in masked))
    if passes is not None:
        own = passes.select(*scope, "ts", *(F.col(m).cast("boolean").alias(m) for m in masked))
        derived = own.unionByName(derived.join(own.select(*scope).distinct(), scope, "left_anti"))
    return derived.withColumn("pass_idx", F.row_number().over(Window.partitionBy(*scope).orderBy("ts")) - 1)


def mark_keyframes(axis: DataFrame, scope: list[str], hours: int = 24) -> DataFrame:
    """The axis with `full`: no full pass before, or at least `hours` since the last one; never if hours <= 0.

    The rule is sequential, so each scope's times (thousands, however many series) are folded in one array.
    """
    if hours <= 0:
        return axis.withColumn("full", F.lit(False))
    times = axis.groupBy(*scope).agg(F.sort_array(F.collect_set("ts")).alias("all"))
    step = F.expr(f"INTERVAL {int(hours)} HOURS")
    start = F.filter("all", lambda t: F.lit(False))
    full = F.aggregate("all", start, lambda kept, t: F.when((F.size(kept) == 0) | (t >= F.element_at(F.coalesce(F.when(F.size(kept) > 0, kept), F.array(t)), -1) + step), F.concat(kept, F.array(t))).otherwise(kept))
    marks = times.select(*scope, F.explode(full).alias("ts"), F.lit(True).alias("full"))
    return axis.join(marks, [*scope, "ts"], "left").withColumn("full", F.coalesce("full", F.lit(False)))


def delta_encode(obs: DataFrame, axis: DataFrame, key: list[str], scope: list[str], metrics=METRICS, masked=MASKED, keyframes: bool = False) -> DataFrame:
    """Samples (key, ts, metrics, moved) that store dense observations: changes, tombstones, and keyframe rows.

    A row is kept when a collected metric differs from the last known value of its episode; a series absent
    from the next pass of the axis closes with a row of nulls, and starts anew when it returns.
    """
    near = by_size(axis)
    extra = ["full"] if keyframes else []
    # a pass that collects neither of the windowed metrics is not recorded at all
    axis = axis.where(F.greatest(*(F.col(m) for m in masked if m != "applied"), F.lit(False)))
    axis = axis.withColumn("pass_idx", F.row_number().over(Window.partitionBy(*scope).orderBy("ts")) - 1)
    held = obs.select(*key, "ts", *metrics).join(
        near(axis.select(*scope, "ts", "pass_idx", *extra, *(F.col(m).alias(f"_{m}") for m in masked))), [*scope, "ts"])
    for m in masked:
        held = held.withColumn(m, F.when(F.col(f"_{m}"), F.col(m)))
    by_key = Window.partitionBy(*key).orderBy("pass_idx")
    held = held.withColumn("new", F.coalesce(F.col("pass_idx") - F.lag("pass_idx").over(by_key) > 1, F.lit(True)).cast("int"))
    held = held.withColumn("episode", F.sum("new").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    held = held.withColumn("next_idx", F.lead("pass_idx").over(by_key))
    seen = Window.partitionBy(*key, "episode").orderBy("pass_idx").rowsBetween(Window.unboundedPreceding, -1)
    observed = ~_gone(metrics)
    known = [F.last(m, ignorenulls=True).over(seen) for m in metrics]
    first = F.coalesce(F.max(F.when(observed, 1)).over(seen), F.lit(0)) == 0
    differs = F.lit(False)
    for m, was in zip(metrics, known, strict=True):
        differs = differs | (F.col(m).isNotNull() & ~F.col(m).eqNullSafe(was))
    held = held.withColumn("moved", observed & (first | differs))
    wanted = F.col("moved") | (F.col("full") & observed if keyframes else F.lit(False))
    last = axis.groupBy(*scope).agg(F.max("pass_idx").alias("last_idx"))
    ends = (
        held.join(near(last), scope)
        .where((F.coalesce("next_idx", F.lit(2**31 - 1)) > F.col("pass_idx") + 1) & (F.col("pass_idx") < F.col("last_idx")))
        .select(*key, (F.col("pass_idx") + 1).alias("pass_idx"))
        .join(near(axis.select(*scope, "pass_idx", "ts")), [*scope, "pass_idx"])
        .select(*key, "ts", *(F.lit(None).cast(obs.schema[m].dataType).alias(m) for m in metrics), F.lit(True).alias("moved"))
    )
    return held.where(wanted).select(*key, "ts", *metrics, "moved").unionByName(ends)


def fold_latest(samples: DataFrame, key: list[str], metrics=METRICS) -> DataFrame:
    """Per series its newest sample time and last non-null metrics since its last tombstone; none if closed.

    One aggregate that combines before the shuffle: each metric's last value and its time, and the last tombstone's.
    """
    ts = F.col("ts")
    held = [c for m in metrics for c in (F.max_by(m, F.when(F.col(m).isNotNull(), ts)).alias(m), F.max(F.when(F.col(m).isNotNull(), ts)).alias(f"_{m}"))]
    last = samples.groupBy(*key).agg(F.max("ts").alias("ts"), F.max(F.when(_gone(metrics), ts)).alias("_tomb"), *held)
    since = lambda t: F.col("_tomb").isNull() | (F.col(t) > F.col("_tomb"))
    return last.where(since("ts")).select(*key, "ts", *(F.when(since(f"_{m}"), F.col(m)).alias(m) for m in metrics))


def fold_incremental(latest: DataFrame, batch: DataFrame, key: list[str], metrics=METRICS) -> DataFrame:
    """Latest rows after a batch of newer samples: rows older than the stored time are ignored, tombstones cut."""
    stored = latest.select(*key, F.col("ts").alias("_ts"), *(F.col(m).alias(f"_{m}") for m in metrics))
    fresh = batch.join(stored.select(*key, "_ts"), key, "left").where(F.col("_ts").isNull() | (F.col("ts") >= F.col("_ts"))).drop("_ts")
    cut = fresh.groupBy(*key).agg(F.max(F.when(_gone(metrics), 1).otherwise(0)).alias("_cut"))
    joined = stored.join(fold_latest(fresh, key, metrics), key, "full").join(cut, key, "left")
    keep = F.coalesce(F.col("_cut"), F.lit(0)) == 0
    out = joined.where(keep | F.col("ts").isNotNull())
    return out.select(*key, F.coalesce("ts", "_ts").alias("ts"), *(F.coalesce(m, F.when(keep, F.col(f"_{m}"))).alias(m) for m in metrics))


def merge_samples(store: DataFrame, source: DataFrame, key: list[str], since: Column | None = None) -> DataFrame:
    """The store's rows and those of the source (after a cursor) whose (key, ts) it lacks."""
    fresh = source if since is None else source.where(F.col("ts") > since)
    return store.unionByName(fresh.dropDuplicates([*key, "ts"]).join(store.select(*key, "ts"), [*key, "ts"], "left_anti"))


def merge_passes(store: DataFrame, source: DataFrame, scope: list[str]) -> DataFrame:
    """Passes of both, the source's where both have one."""
    return source.unionByName(store.join(source.select(*scope, "ts"), [*scope, "ts"], "left_anti"))


def merge_report(store: DataFrame, source: DataFrame, key: list[str], passes: DataFrame | None = None, scope: list[str] | None = None) -> DataFrame:
    """One row: rows read, rows inserted, the new cursor, and with `passes` how many there are, those without samples too."""
    own = store.select(*key, "ts").withColumn("_old", F.lit(1))
    out = source.dropDuplicates([*key, "ts"]).join(own, [*key, "ts"], "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("_old").isNull(), 1)).alias("inserted"), F.max("ts").alias("cursor"))
    if passes is None:
        return out
    n = passes.select(*(scope or []), "ts").distinct().count()
    return out.withColumn("passes", F.lit(n).cast("long"))


def dedupe_or_raise(samples: DataFrame, key: list[str]) -> DataFrame:
    """Rows equal in every column once; an error if a key still repeats with different values."""
    out = samples.distinct()
    clash = out.groupBy(*key).count().where("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"key repeats with different values: {clash[0].asDict()}")
    return out


def backfill_dense(samples: DataFrame, key: list[str], scope: list[str], metrics=METRICS) -> DataFrame:
    """Tombstones for a dense history: a series that ends before the newest pass closes at the first pass after it."""
    axis = load_axis(None, samples, scope, metrics)
    following = axis.select(*scope, "ts", F.lead("ts").over(Window.partitionBy(*scope).orderBy("ts")).alias("next_ts"))
    ends = samples.groupBy(*key).agg(F.max("ts").alias("ts")).join(following, [*scope, "ts"]).where("next_ts is not null")
    return ends.select(*key, F.col("next_ts").alias("ts"), *(F.lit(None).cast(samples.schema[m].dataType).alias(m) for m in metrics))


def at_pass(samples: DataFrame, axis: DataFrame, scope: list[str]) -> DataFrame:
    """Samples with the first pass at or after their time; samples after the last pass are dropped.

    Passes become intervals split by day, so the as-of join is an equality on (scope, day) with at most a
    day's passes behind each sample.
    """
    near = by_size(axis)
    before = F.lag("ts").over(Window.partitionBy(*scope).orderBy("ts"))
    spans = axis.select(*scope, "pass_idx", F.col("ts").alias("to_ts"), before.alias("from_ts"))
    first = spans.where("from_ts is null").select(*scope, F.col("to_ts").alias("first_ts"))
    days = F.sequence(F.to_date(F.coalesce("from_ts", "to_ts")), F.to_date("to_ts"))
    spans = spans.withColumn("day", F.explode(days))
    held = samples.join(near(first), scope).withColumn("eff_ts", F.greatest("ts", "first_ts")).withColumn("day", F.to_date("eff_ts"))
    within = (F.col("eff_ts") <= F.col("to_ts")) & (F.col("from_ts").isNull() | (F.col("eff_ts") > F.col("from_ts")))
    return held.join(near(spans), [*scope, "day"]).where(within).drop("day", "eff_ts", "first_ts", "to_ts", "from_ts")


def _states(samples: DataFrame, axis: DataFrame, key: list[str], scope: list[str], metrics) -> DataFrame:
    """(key, pass_idx, alive, metrics): what is known of each series from the pass on, one row per pass that brought samples."""
    held = at_pass(samples.select(*key, "ts", *metrics), axis, scope).withColumn("alive", ~_gone(metrics))
    order = Window.partitionBy(*key).orderBy("ts")
    held = held.withColumn("episode", F.sum((~F.col("alive")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    seen = Window.partitionBy(*key, "episode").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    held = held.select(*key, "ts", "pass_idx", "alive", *(F.last(m, ignorenulls=True).over(seen).alias(m) for m in metrics))
    return held.groupBy(*key, "pass_idx").agg(*(F.max_by(c, "ts").alias(c) for c in ("alive", *metrics)))


def replay(samples: DataFrame, axis: DataFrame, key: list[str], scope: list[str], lo: int = 0, hi: int | None = None, metrics=METRICS, masked=MASKED) -> DataFrame:
    """(key, pass_idx, metrics) for every pass of [lo, hi) and every series alive in it; null where dead or not collected.

    States of a series, dead ones too, are spans of passes; the first reaches back to `lo`. One window finds their
    ends and whether the series is ever alive, and each span is exploded once.
    """
    near = by_size(axis)
    states = _states(samples, axis, key, scope, metrics)
    ends = axis.groupBy(*scope).agg((F.max("pass_idx") + 1).alias("n_passes"))
    top = F.col("n_passes") if hi is None else F.least("n_passes", F.lit(hi))
    order, all_ = Window.partitionBy(*key).orderBy("pass_idx"), Window.partitionBy(*key)
    spans = states.withColumn("next", F.lead("pass_idx").over(order)).withColumn("first", F.lag("pass_idx").over(order).isNull()).join(near(ends), scope)
    spans = spans.withColumn("from", F.greatest("pass_idx", F.lit(lo))).withColumn("to", F.least(F.coalesce("next", top), top))
    spans = spans.withColumn("ever", F.max(F.col("alive") & (F.col("from") < F.col("to"))).over(all_)).where("ever")
    begin = F.when(F.col("first"), F.lit(lo)).otherwise(F.col("from"))
    rows = spans.withColumn("begin", begin).where(F.col("begin") < F.col("to"))
    rows = rows.select(*key, F.col("pass_idx").alias("since"), "alive", *metrics, F.explode(F.sequence("begin", F.col("to") - 1)).alias("pass_idx"))
    rows = rows.join(near(axis.select(*scope, "pass_idx", *(F.col(m).alias(f"_{m}") for m in masked))), [*scope, "pass_idx"])
    known = F.col("alive") & (F.col("pass_idx") >= F.col("since"))
    return rows.select(*key, "pass_idx", *(F.when(known & F.col(f"_{m}") if m in masked else known, F.col(m)).alias(m) for m in metrics))

def restate(samples: DataFrame, axis: DataFrame, key: list[str], scope: list[str], metrics=METRICS, masked=MASKED, keyframes: bool = False) -> DataFrame:
    """What `delta_encode` stores of the dense replay (key, ts, metrics, moved), without building the grid.

    A state holds over a span of recorded passes, and is seen in runs of passes that collect one of its metrics. Within a run
    a row can only move at its start and where a metric is first collected again, so these passes and the keyframes are
    the only rows; a run that does not go on from the one before starts anew. Long runs are cut in chunks of passes.
    """
    near, size, free = by_size(axis), F.lit(64), [m for m in metrics if m not in masked]
    recorded = F.greatest(*(F.col(m) for m in masked if m != "applied"), F.lit(False))
    by_scope = Window.partitionBy(*scope).orderBy("pass_idx")
    before = F.sum("rec").over(by_scope.rowsBetween(Window.unboundedPreceding, -1))
    axis = axis.withColumn("rec", recorded.cast("int")).withColumn("rp", F.coalesce(before, F.lit(0)).cast("int")).withColumn("n_rec", F.sum("rec").over(Window.partitionBy(*scope)).cast("int"))
    passes = axis.where("rec = 1").withColumn("chunk", F.floor(F.col("rp") / size).cast("int"))
    # what a state knows: a bit for each metric that only some passes collect, or -1 where others are known as well
    sets = F.array(*(F.lit(i) for i in [*([-1] if free else []), *range(1, 2 ** len(masked))]))
    bits = lambda on: sum((F.when(c, 2**i).otherwise(0) for i, c in enumerate(on)), F.lit(0))
    runs = passes.select(*scope, "chunk", "rp", F.col("full") if keyframes else F.lit(False).alias("full"), bits([F.col(m) for m in masked]).alias("on"), F.explode(sets).alias("known"))
    runs = runs.where((F.col("known") == -1) | (F.col("known").bitwiseAND(F.col("on")) > 0))
    runs = runs.withColumn("run", F.col("rp") - F.row_number().over(Window.partitionBy(*scope, "chunk", "known").orderBy("rp")))
    runs = runs.groupBy(*scope, "chunk", "known", "run").agg(F.min("rp").alias("lo"), (F.max("rp") + 1).alias("hi"), F.collect_list(F.when(F.col("full"), F.col("rp"))).alias("fulls"))

    states = _states(samples, axis, key, scope, metrics).join(near(axis.select(*scope, "pass_idx", "rp", "n_rec")), [*scope, "pass_idx"])
    spans = states.withColumn("to", F.coalesce(F.lead("rp").over(Window.partitionBy(*key).orderBy("pass_idx")), "n_rec")).where((F.col("rp") < F.col("to")) & F.col("alive"))
    known = bits([F.col(m).isNotNull() for m in masked])
    spans = spans.withColumn("known", F.when(~_gone([F.col(m) for m in free]), -1).otherwise(known) if free else known)
    spans = spans.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("rp") / size).cast("int"), F.floor((F.col("to") - 1) / size).cast("int"))))
    pieces = spans.join(near(runs), [*scope, "chunk", "known"]).withColumn("lo", F.greatest("rp", "lo")).withColumn("hi", F.least("to", "hi")).where("lo < hi")
    ahead = by_scope.rowsBetween(0, Window.unboundedFollowing)
    following = passes.select(*scope, F.col("rp").alias("lo"), F.array(*(F.first(F.when(F.col(m), F.col("rp")), ignorenulls=True).over(ahead) for m in masked)).alias("again"))
    within = F.filter(F.concat(F.array("lo"), "again", "fulls"), lambda i: (i >= F.col("lo")) & (i < F.col("hi")))
    rows = pieces.join(near(following), [*scope, "lo"]).select(*key, *metrics, "lo", "hi", "n_rec", F.explode(F.array_distinct(within)).alias("rp"))
    flags = passes.select(*scope, "rp", "full" if keyframes else F.lit(False).alias("full"), *(F.col(m).alias(f"_{m}") for m in masked))
    rows = rows.join(near(flags), [*scope, "rp"]).withColumns({m: F.when(F.col(f"_{m}"), F.col(m)) for m in masked})

    by_key = Window.partitionBy(*key).orderBy("rp")
    rows = rows.withColumn("new", ((F.col("rp") == F.col("lo")) & ~F.col("lo").eqNullSafe(F.lag("hi").over(by_key))).cast("int"))
    rows = rows.withColumn("episode", F.sum("new").over(by_key.rowsBetween(Window.unboundedPreceding, 0))).withColumn("ends", F.coalesce(F.lead("new").over(by_key), F.lit(1)) == 1)
    before, moved = by_key.rowsBetween(Window.unboundedPreceding, -1), F.col("new") == 1
    for m in metrics:
        was = F.last(F.when(F.col(m).isNotNull(), F.struct("episode", F.col(m).alias("v"))), ignorenulls=True).over(before)
        moved = moved | (F.col(m).isNotNull() & ~F.col(m).eqNullSafe(F.when(was["episode"] == F.col("episode"), was["v"])))
    rows = rows.withColumn("moved", moved)
    row = F.struct("rp", *metrics, "moved")
    end = F.struct(F.col("hi").alias("rp"), *(F.lit(None).cast(samples.schema[m].dataType).alias(m) for m in metrics), F.lit(True).alias("moved"))
    kept = F.array(F.when(F.col("moved") | F.col("full"), row), F.when(F.col("ends") & (F.col("hi") < F.col("n_rec")), end))
    out = rows.select(*key, F.explode(F.array_compact(kept)).alias("r")).select(*key, "r.*")
    return out.join(near(passes.select(*scope, "rp", "ts")), [*scope, "rp"]).select(*key, "ts", *metrics, "moved")


def cp_encode(samples: DataFrame, axis: DataFrame, key: list[str], scope: list[str], window: int | None = None, metrics=METRICS, masked=MASKED) -> DataFrame:
    """(key, window, metric, cp): change points `[0, v0, i1, v1, ...]` of each series in windows of passes.

    The dense grid is never built: a state takes effect at the first pass at or after it that collects the
    metric (a lookup on the axis), and equal neighbours fall away. A constant is `[0, v]`. Metrics that no
    pass of a window collects are left out; without `window` the whole axis is one window.
    """
    near = by_size(axis)
    size = F.lit(window) if window else F.lit(2**31 - 1)
    states = _states(samples, axis, key, scope, metrics)
    base = axis.withColumn("window", F.floor(F.col("pass_idx") / size).cast("int"))
    bounds = base.groupBy(*scope, "window").agg(F.min("pass_idx").alias("lo"), F.max("pass_idx").alias("hi"))
    ahead = Window.partitionBy(*scope, "window").orderBy("pass_idx").rowsBetween(0, Window.unboundedFollowing)
    effects = [F.struct(F.lit(m).alias("metric"), (F.first(F.when(F.col(m), F.col("pass_idx")), ignorenulls=True).over(ahead) if m in masked else F.col("pass_idx")).alias("eff")) for m in metrics]
    effect = base.withColumn("effects", F.array(*effects)).select(*scope, "window", "pass_idx", F.explode("effects").alias("e")).select(*scope, "window", "pass_idx", "e.metric", "e.eff").where("eff is not null")
    following = F.lead("pass_idx").over(Window.partitionBy(*key).orderBy("pass_idx"))
    spans = states.withColumn("until", F.coalesce(following, F.lit(2**31 - 1)))
    placed = spans.join(near(bounds), scope).where((F.col("pass_idx") <= F.col("hi")) & (F.col("until") > F.col("lo")))
    placed = placed.withColumn("at", F.greatest("pass_idx", "lo"))
    alive = placed.where("alive").select(*key, "window").distinct()
    values = placed.select(*key, "window", "lo", F.col("at").alias("pass_idx"), F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics))).alias("v"))
    values = values.select(*key, "window", "lo", "pass_idx", "v.metric", "v.value").join(near(effect), [*scope, "window", "pass_idx", "metric"])
    last = values.groupBy(*key, "window", "metric", (F.col("eff") - F.col("lo")).alias("pos")).agg(F.max_by(F.struct("value"), "pass_idx").alias("s"))
    last = last.select(*key, "window", "metric", "pos", F.col("s.value").alias("value"))
    # every metric that some pass of the window collects starts with a point at 0: null unless a state is there
    covered = effect.select(*scope, "window", "metric").distinct()
    starts = alive.join(near(covered), [*scope, "window"]).select(*key, "window", "metric", F.lit(0).alias("pos"), F.lit(None).cast(last.schema["value"].dataType).alias("value"))
    points = last.join(alive, [*key, "window"], "left_semi").withColumn("own", F.lit(1)).unionByName(starts.withColumn("own", F.lit(0)))
    points = points.groupBy(*key, "window", "metric", "pos").agg(F.max_by(F.struct("value"), "own").alias("s")).select(*key, "window", "metric", "pos", F.col("s.value").alias("value"))
    order = Window.partitionBy(*key, "window", "metric").orderBy("pos")
    points = points.withColumn("new", (F.col("pos") == 0) | ~F.col("value").eqNullSafe(F.lag("value").over(order))).where("new")
    pairs = F.sort_array(F.collect_list(F.struct("pos", "value")))
    return points.groupBy(*key, "window", "metric").agg(F.flatten(F.transform(pairs, lambda p: F.array(p["pos"].cast("long"), p["value"].cast("long")))).alias("cp"))


def cp_decode(encoded: DataFrame, axis: DataFrame, key: list[str], scope: list[str], window: int | None = None, masked=MASKED) -> DataFrame:
    """(key, window, metric, pos, value): dense rows again, null at passes that did not collect the metric."""
    near = by_size(axis)
    size = F.lit(window) if window else F.lit(2**31 - 1)
    points = encoded.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("cp") - 2, F.lit(2))))
    points = points.select(*key, "window", "metric", F.get("cp", F.col("i")).alias("pos"), F.get("cp", F.col("i") + 1).alias("value"), F.get("cp", F.col("i") + 2).alias("to"))
    base = axis.withColumn("window", F.floor(F.col("pass_idx") / size).cast("int"))
    base = base.withColumn("pos", F.col("pass_idx") - F.min("pass_idx").over(Window.partitionBy(*scope, "window")))
    n = base.groupBy(*scope, "window").agg(F.count(F.lit(1)).alias("n"))
    dense = points.join(near(n), [*scope, "window"]).select(*key, "window", "metric", F.explode(F.sequence(F.col("pos"), F.coalesce("to", "n") - 1)).alias("pos"), "value")
    flags = base.select(*scope, "window", F.col("pos").cast("long").alias("pos"), *(F.col(m).alias(f"_{m}") for m in masked))
    on = F.coalesce(*(F.when(F.col("metric") == m, F.col(f"_{m}")) for m in masked), F.lit(True))
    return dense.join(near(flags), [*scope, "window", "pos"]).select(*key, "window", "metric", "pos", F.when(on, F.col("value")).alias("value"))


def chunk_axis(axis: DataFrame, scope: list[str], window: int) -> DataFrame:
    """(scope, chunk, start_ts, live_from, exposed): complete windows; the live slice starts at the newest of them."""
    n = axis.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*scope))).withColumn("complete", F.floor(F.col("n") / window))
    chunks = n.withColumn("chunk", F.floor(F.col("pass_idx") / window)).where("chunk < complete")
    return chunks.groupBy(*scope, "chunk").agg(F.min("ts").alias("start_ts"), F.first((F.col("complete") - 1) * window).alias("live_from"), F.first(F.greatest(F.col("complete") - 1, F.lit(0))).alias("exposed"))


def state_before(samples: DataFrame, key: list[str], cut: Column, metrics=METRICS, checkpoint: tuple[DataFrame, int, Column] | None = None) -> tuple[DataFrame, int]:
    """Latest rows up to a time, and the number of samples behind them.

    checkpoint: (rows, sample count, its time). It is rolled forward if its count still holds, so that only
    later samples are read; a late older sample makes the count differ, and the state is rebuilt.
    """
    upto = samples.where(F.col("ts") <= cut)
    if checkpoint:
        rows, count, at = checkpoint
        before = samples.where(F.col("ts") <= at).count()
        if before == count:
            later = upto.where(F.col("ts") > at)
            return fold_incremental(rows, later, key, metrics), count + later.count()
    return fold_latest(upto, key, metrics), upto.count()


def export_trend(samples: DataFrame, passes: DataFrame | None, state: DataFrame, key: list[str], scope: list[str], window: int) -> DataFrame:
    """Encoded series of the live slice of each scope, with the last pass time and the closed flag."""
    axis = load_axis(passes, samples, scope)
    n = Window.partitionBy(*scope)
    complete = F.floor(F.count(F.lit(1)).over(n) / window)
    live = axis.withColumn("lo", F.greatest(complete - 1, F.lit(0)) * window).withColumn("updated", F.max("ts").over(n)).where(F.col("pass_idx") >= F.col("lo"))
    live = cut(live)
    slim = live.select(*scope, "ts", *MASKED, (F.col("pass_idx") - F.col("lo")).cast("int").alias("pass_idx"))
    encoded = cp_encode(samples, slim, key, scope)
    times = live.groupBy(*scope).agg(F.max("updated").alias("updated"))
    near = by_size(times)
    return encoded.join(near(times), scope).join(by_size(state)(state), scope, "left")


def seat_steps(samples: DataFrame, axis: DataFrame, key: list[str], scope: list[str], metrics=METRICS) -> DataFrame:
    """(key, pass_idx, before, after): free seats (quota less applied, 0 at least) at neighbouring passes where a state changes.

    Free seats can only change where a state does, so the passes between are never built: a state is compared with
    the one before it, if the passes at its start and just before both collected what they need.
    """
    near = by_size(axis)
    states = _states(samples, axis, key, scope, metrics)
    seats = F.when(F.col("alive") & F.col("quota").isNotNull() & F.col("applied").isNotNull(), F.greatest(F.col("quota") - F.col("applied"), F.lit(0)))
    steps = states.withColumn("after", seats).withColumn("before", F.lag("after").over(Window.partitionBy(*key).orderBy("pass_idx"))).where("before is not null and after is not null")
    both = axis.withColumn("_was", F.lag("applied").over(Window.partitionBy(*scope).orderBy("pass_idx"))).where(F.col("applied") & F.col("_was"))
    return steps.join(near(both.select(*scope, "pass_idx")), [*scope, "pass_idx"]).select(*key, "pass_idx", "before", "after")


def change_feed(steps: DataFrame, key: list[str], kind: str = "open", since: int = 0, limit: int | None = None) -> DataFrame:
    """Per series its newest qualifying step of free seats, newest first."""
    moved = (F.col("after") > F.col("before")) & (F.col("after") > 0) if kind == "open" else F.col("after") != F.col("before")
    last = steps.where(moved & (F.col("pass_idx") >= since)).groupBy(*key).agg(
        F.max("pass_idx").alias("pass_idx"), F.max_by("before", "pass_idx").alias("before"), F.max_by("after", "pass_idx").alias("after"))
    return last.orderBy(F.desc("pass_idx"), *key).limit(limit) if limit else last


def vacancy_alerts(steps: DataFrame, watch: DataFrame, key: list[str]) -> DataFrame:
    """One row each time a watched series goes from no free seat to some."""
    return steps.where("before = 0 and after > 0").join(watch, key, "left_semi").select(*key, "pass_idx", F.col("after").alias("seats"))


def segment_axis(axis: DataFrame, scope: list[str], gap: str = "3 hours") -> DataFrame:
    """The axis with a segment number that grows at every hole longer than `gap`."""
    order = Window.partitionBy(*scope).orderBy("ts")
    broken = F.coalesce(F.col("ts") > F.lag("ts").over(order) + F.expr(f"INTERVAL {gap}"), F.lit(False)).cast("int")
    return axis.withColumn("_b", broken).withColumn("segment", F.sum("_b").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")


def roster_counts(df: DataFrame, raw: str = "enrolled", quota: str = "quota") -> DataFrame:
    """Live columns from roster totals: enrolled as it is, applied at most the quota."""
    return df.withColumn("applied", F.when(F.col(raw).isNotNull() & F.col(quota).isNotNull(), F.least(raw, quota)).otherwise(F.col(raw)))
