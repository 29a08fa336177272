"""Quality gates, catalogue diffs, roster drift, digests, push and pull by digest, carry-forward."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.functions import scalars
from termtide.operators.catalog import in_windows, window_list

# --- gates ----------------------------------------------------------------------------------------------


def check_coverage(resolved: DataFrame, scope: Sequence[str], minimum: float = 0.95) -> DataFrame:
    """Per scope: roster rows, rows with `matched`, and whether the share reaches the minimum."""
    n = resolved.groupBy(*scope).agg(F.count(F.lit(1)).alias("roster"), F.count(F.when(F.col("matched"), 1)).alias("matched"))
    return n.withColumn("ok", (F.col("roster") > 0) & (F.col("matched") >= minimum * F.col("roster")))


def require(verdicts: DataFrame, ok: str = "ok") -> None:
    bad = verdicts.where(~F.col(ok)).limit(5).collect()
    if bad:
        raise ValueError(f"gate failed: {[r.asDict() for r in bad]}")


def check_snapshot(new: DataFrame, previous: DataFrame, min_ratio: float = 0.9, max_failed: float = 0.02) -> DataFrame:
    """Per (year, term) a verdict: ok, empty, no_tags, shrunk (under the ratio of before) or failures (over the share).

    new: year, term, classes, tagged, failed; previous: year, term, classes, missing.
    """
    was = previous.select("year", "term", (F.col("classes") + F.coalesce("missing", F.lit(0))).alias("was"))
    out = new.join(was, ["year", "term"], "left")
    verdict = (
        F.when(F.col("classes") == 0, "empty").when(F.col("tagged") == 0, "no_tags")
        .when(F.col("classes") < min_ratio * F.coalesce("was", F.lit(0)), "shrunk")
        .when(F.col("failed") > max_failed * (F.col("classes") + F.col("failed")), "failures").otherwise("ok")
    )
    return out.withColumn("verdict", verdict)


def staleness(latest: DataFrame, now: Column, windows: str | None, slow_windows: str | None = None, minutes: int = 45, slow_minutes: int = 180) -> DataFrame:
    """The scopes with `stale`: no sample, or the newest older than allowed, while a window is open; else false."""
    fast, slow = in_windows(now, windows), in_windows(now, slow_windows)
    age = (F.unix_timestamp(now) - F.unix_timestamp("ts")) / 60
    limit = F.when(fast, F.lit(minutes)).when(slow, F.lit(slow_minutes))
    return latest.withColumn("stale", F.when(limit.isNull(), False).otherwise(F.col("ts").isNull() | (age > limit)))


def compare_tables(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row: keys that match in all columns, that differ, and that only one side has."""
    left = a.select(*key, F.struct(*cols).alias("_a"), F.lit(1).alias("_l"))
    right = b.select(*key, F.struct(*cols).alias("_b"), F.lit(1).alias("_r"))
    both, same = F.col("_l").isNotNull() & F.col("_r").isNotNull(), F.col("_a").eqNullSafe(F.col("_b"))
    return left.join(right, list(key), "full").agg(
        F.count(F.when(both & same, 1)).alias("matching"), F.count(F.when(both & ~same, 1)).alias("different"),
        F.count(F.when(F.col("_r").isNull(), 1)).alias("only_left"), F.count(F.when(F.col("_l").isNull(), 1)).alias("only_right"))


def key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys that repeat."""
    n = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"), F.count(F.when(F.col("n") > 1, 1)).alias("repeated"))


# --- diff -----------------------------------------------------------------------------------------------

#: Codes of scalar fields in the order of the change log (fixed values).
FIELDS = (
    ("name", "NAME"), ("professor", "PROF"), ("department", "DEPT"), ("college", "COLL"), ("grade", "GRADE"), ("credits", "CRED"),
    ("quota", "QUOTA"), ("quota_returning", "QRET"), ("applied", "APPL"), ("enrolled", "ENRL"), ("grading", "GRD"), ("grading_switch", "GRDSW"),
)


def _shown(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), "(none)").otherwise(text)


def _packed(get: Callable[[str], Column], present: Sequence[tuple[str, str]], met: Column | None = None) -> tuple[Column, Column]:
    """(a row's fields, tags and meetings as the diff compares them, their hash); only name and times unless `met`."""
    only = (lambda c: c) if met is None else (lambda c: F.when(met, c))
    values = {f: only(F.nullif(get(f).cast("string"), F.lit(""))) for f, _ in present}
    tags, sig = only(F.coalesce(get("classification"), F.array().cast("array<string>"))), only(scalars.slot_signature(get("slots")))
    row = F.struct(*(v.alias(f) for f, v in values.items()), get("name").alias("label"), tags.alias("tags"), sig.alias("sig"), scalars.slot_text(get("slots")).alias("times"))
    return row, F.coalesce(only(F.xxhash64(*values.values(), F.array_sort(tags), sig)), F.lit(0))


def _changes(both: DataFrame, key: Sequence[str], present: Sequence[tuple[str, str]], detail: bool = True) -> DataFrame:
    """(key, name, changes) of packed rows `o` and `n` whose hashes `o_mark` and `n_mark` differ; each change with its detail, if asked for."""
    said = lambda code, text: F.struct(F.lit(code).alias("code"), *([text.alias("detail")] if detail else []))
    both = both.where(~F.col("o_mark").eqNullSafe(F.col("n_mark")))
    change = lambda code, when, text: F.when(when, said(code, text))
    old_tags, new_tags = (F.when(F.size(f"{r}.tags") == 0, "(none)").otherwise(F.array_join(f"{r}.tags", ",")) for r in "on")
    same_sig = F.col("o.sig").eqNullSafe(F.col("n.sig"))
    none_before, none_after = F.size("o.sig") <= 0, F.size("n.sig") <= 0
    arrow = lambda a, b: F.concat(a, F.lit(" → "), b)
    changes = [change(c, ~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}")), arrow(_shown(F.col(f"o.{f}")), _shown(F.col(f"n.{f}")))) for f, c in present]
    changes += [
        change("CLS", F.array_sort("o.tags") != F.array_sort("n.tags"), arrow(old_tags, new_tags)),
        change("TADD", ~same_sig & none_before, F.col("n.times")), change("TDEL", ~same_sig & ~none_before & none_after, F.col("o.times")),
        change("TCHG", ~same_sig & ~none_before & ~none_after, arrow(F.col("o.times"), F.col("n.times"))),
    ]
    whole = F.when(F.col("o").isNull(), F.array(said("NEW", F.col("n.times")))).when(
        F.col("n").isNull(), F.array(said("DEL", F.col("o.times")))).otherwise(F.array_compact(F.array(*changes)))
    return both.select(*key, F.coalesce("n.label", "o.label").alias("name"), whole.alias("changes"))


def _rows(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    return changes.withColumn("_c", F.explode("changes")).select(*key, F.col("_c.code").alias("code"), "name", F.col("_c.detail").alias("detail"))


def catalog_diff(old: DataFrame, new: DataFrame, key: Sequence[str], fields: Sequence[tuple[str, str]] = FIELDS) -> DataFrame:
    """(key, code, name, detail) between two catalogues: NEW, DEL, field codes, CLS, TADD, TDEL, TCHG.

    Each side hashes its rows before they meet, and fields are compared only where the hashes differ. '' and null are
    equal; tags are compared without order and shown in the order they are stored in; meetings count by day and time only.
    """
    present = [(f, c) for f, c in fields if f in old.columns and f in new.columns]
    packed = lambda df, name: df.select(*key, *(c.alias(a) for c, a in zip(_packed(F.col, present), (name, f"{name}_mark"), strict=True)))
    return _rows(_changes(packed(old, "o").join(packed(new, "n"), list(key), "full"), key, present), key)


def paired_changes(pairs: DataFrame, key: Sequence[str], fields: Sequence[tuple[str, str]] = FIELDS, detail: bool = True) -> DataFrame:
    """(key, name, changes) of rows that hold both states of a key as structs `old` and `new`, null where there is none.

    Rows of one state are not hashed.
    """
    present = [(f, c) for f, c in fields if f in pairs.schema["old"].dataType.names]
    met = F.col("old").isNotNull() & F.col("new").isNotNull()
    sides = [F.when(F.col(side).isNotNull(), c).alias(a) for side, names in (("old", ("o", "o_mark")), ("new", ("n", "n_mark"))) for c, a in zip(_packed(F.col(side).getField, present, met), names, strict=True)]
    return _changes(pairs.select(*key, *sides), key, present, detail)


def paired_diff(pairs: DataFrame, key: Sequence[str]) -> DataFrame:
    """`catalog_diff` of such rows, which are not moved."""
    return _rows(paired_changes(pairs, key), key)


_TALLY = "struct<code:string,n:bigint,keys:bigint>"


def _tallies(codes: DataFrame) -> DataFrame:
    """(code, n, keys) of rows that hold the `codes` of one key each."""
    own = F.transform(F.array_distinct("codes"), lambda c: F.struct(c.alias("code"), F.size(F.filter("codes", lambda x: x == c)).cast("long").alias("n"), F.lit(1).cast("long").alias("keys")))
    changed = F.size(F.filter("codes", lambda x: ~x.isin("NEW", "DEL"))).cast("long")
    any_ = F.struct(F.lit("*").alias("code"), changed.alias("n"), F.lit(1).cast("long").alias("keys"))
    tallies = codes.select(F.explode(F.concat(own, F.when(changed > 0, F.array(any_)).otherwise(F.array().cast(f"array<{_TALLY}>")))).alias("t")).select("t.*")
    none = codes.sparkSession.createDataFrame([("*", 0, 0)], "code string, n long, keys long")
    return tallies.unionByName(none).groupBy("code").agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"))


def diff_summary(diff: DataFrame, key: Sequence[str]) -> DataFrame:
    """(code, n, keys): tallies per code, and one row `*` with the changed keys that are neither new nor gone.

    The diff is taken once: the codes of a key meet in one row, which the tallies are counted from.
    """
    return _tallies(diff.groupBy(*key).agg(F.collect_list("code").alias("codes")))


def changes_summary(changes: DataFrame) -> DataFrame:
    """`diff_summary` of `paired_changes`, in which a key's codes are in one row already."""
    return _tallies(changes.select(F.transform("changes", lambda c: c["code"]).alias("codes")))


# --- drift ----------------------------------------------------------------------------------------------


def roster_drift(roster: DataFrame, live: DataFrame, scope: Sequence[str], label: Column) -> DataFrame:
    """Per scope: labels only live (added) and only in the roster (removed), sorted, and a 16-digit signature."""
    a, b = roster.select(*scope, label.alias("label")).distinct(), live.select(*scope, label.alias("label")).distinct()
    sides = a.withColumn("_r", F.lit(1)).join(b.withColumn("_l", F.lit(1)), [*scope, "label"], "full").where("_r is null or _l is null")
    out = sides.groupBy(*scope).agg(
        F.array_sort(F.collect_list(F.when(F.col("_r").isNull(), F.col("label")))).alias("added"),
        F.array_sort(F.collect_list(F.when(F.col("_l").isNull(), F.col("label")))).alias("removed"))
    return out.withColumn("signature", drift_signature("added", "removed"))


def drift_signature(added: str, removed: str) -> Column:
    text = F.concat(F.lit("["), F.to_json(added), F.lit(","), F.to_json(removed), F.lit("]"))
    return F.substring(F.sha1(F.encode(text, "UTF-8")), 1, 16)


def drift_ledger(drifts: DataFrame, scope: Sequence[str]) -> DataFrame:
    """One row per signature: first and last seen, and passes. Passes without drift add none."""
    seen = drifts.where((F.size("added") > 0) | (F.size("removed") > 0))
    return seen.groupBy(*scope, "signature").agg(
        F.first("added").alias("added"), F.first("removed").alias("removed"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("passes"))


def sync_drift(store: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The source's columns over the store's; the store's `handled_at` stays."""
    cols = [c for c in source.columns if c not in key and c != "handled_at"]
    right = source.select(*key, *(F.col(c).alias(f"_{c}") for c in cols), F.lit(1).alias("_new"))
    out = store.join(right, list(key), "full")
    return out.select(*key, *(F.when(F.col("_new") == 1, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in cols), "handled_at")


def drift_decision(ledger: DataFrame, passes: DataFrame, windows: str | None, today: str, scope: Sequence[str], min_passes: int = 3) -> DataFrame:
    """Per scope on its newest drift: gone, handled, too_few, not_over or act."""
    days = [end or start for start, end in window_list(windows)]
    over = F.lit(bool(days) and today > max(days)) if days else F.lit(False)
    newest = ledger.groupBy(*scope).agg(F.max_by(F.struct("signature", "last_seen", "handled_at", "passes"), F.struct("last_seen", "signature")).alias("d"))
    out = newest.join(passes.groupBy(*scope).agg(F.max("ts").alias("newest_pass")), list(scope), "left")
    decision = (
        F.when(F.col("d.last_seen") < F.col("newest_pass"), "gone").when(F.col("d.handled_at").isNotNull(), "handled")
        .when(F.col("d.passes") < min_passes, "too_few").when(~over, "not_over").otherwise("act")
    )
    return out.select(*scope, F.col("d.signature").alias("signature"), F.col("d.passes").alias("passes"), decision.alias("decision"))


# --- digests --------------------------------------------------------------------------------------------


def term_digest(df: DataFrame, scope: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Per scope a digest that ignores row order and the excluded columns, and the row count.

    Row digests are added up in four 32-bit parts, so a term is never collected in one place.
    """
    cols = sorted(c for c in df.columns if c not in scope and c not in exclude)
    row = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    parts = [F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = df.select(*scope, *(p.alias(f"_p{i}") for i, p in enumerate(parts))).groupBy(*scope).agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"_p{i}").alias(f"_p{i}") for i in range(4)))
    return sums.select(*scope, F.sha2(F.concat_ws("|", F.col("n").cast("string"), *(F.col(f"_p{i}").cast("string") for i in range(4))), 256).alias("digest"), "n")


def snapshot_status(new: DataFrame, stored: DataFrame, scope: Sequence[str]) -> DataFrame:
    """new, changed or unchanged by digest."""
    out = new.join(stored.select(*scope, F.col("digest").alias("_was")), list(scope), "left")
    return out.select(*scope, "digest", F.when(F.col("_was").isNull(), "new").when(F.col("_was") == F.col("digest"), "unchanged").otherwise("changed").alias("status"))


def pull_changed(remote: DataFrame, local: DataFrame, targets: DataFrame, now: Column, max_age_hours: float, scope: Sequence[str]) -> DataFrame:
    """Per target: apply (digest differs or absent here), same, or uncollected; and `stale` (checked too long ago)."""
    have = remote.select(*scope, F.col("digest").alias("_r"), "checked_at")
    mine = local.select(*scope, F.col("digest").alias("_l"))
    out = targets.join(have, list(scope), "left").join(mine, list(scope), "left")
    action = F.when(F.col("_r").isNull(), "uncollected").when(F.col("_r").eqNullSafe(F.col("_l")), "same").otherwise("apply")
    age = (F.unix_timestamp(now) - F.unix_timestamp("checked_at")) / 3600
    return out.select(*scope, action.alias("action"), F.coalesce(age > max_age_hours, F.lit(False)).alias("stale"))


def carried(fresh: DataFrame, failed: DataFrame, previous: DataFrame, key: Sequence[str]) -> DataFrame:
    """The entries of failed keys that are not fresh, with `missing`: their previous ones, or one of nulls if there is none.

    One join: fresh and failed keys are told apart in one aggregate by key, which combines before the shuffle.
    """
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    keys = failed.select(*key, F.lit(False).alias("_fresh")).unionByName(fresh.select(*key, F.lit(True).alias("_fresh")).where(whole))
    lacking = keys.groupBy(*key).agg(F.max("_fresh").alias("_fresh")).where("not _fresh").drop("_fresh")
    out = lacking.join(previous.withColumn("_kept", F.lit(True)), list(key), "left")
    return out.select(*previous.columns, F.col("_kept").isNull().alias("missing"))


def carry_forward(fresh: DataFrame, failed: DataFrame, previous: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(entries, missing keys): a failed key keeps its previous entry; failed keys without one are missing."""
    out = carried(fresh, failed, previous, key)
    return fresh.unionByName(out.where("not missing").drop("missing")), out.where("missing").select(*key)


def export_attachments(snapshot: DataFrame, missing: DataFrame, scope: Sequence[str] = ("year", "term")) -> tuple[DataFrame, DataFrame]:
    """(rows by short key code|lecture, terms skipped because two sections share a short key)."""
    kept = snapshot.join(missing, [*scope, "sbjt_cd", "lt_no", "subh_cd"], "left_anti").withColumn("short", F.concat_ws("|", "sbjt_cd", "lt_no"))
    clash = kept.groupBy(*scope, "short").agg(F.count_distinct("subh_cd").alias("n")).where("n > 1").select(*scope).distinct()
    return kept.join(clash, list(scope), "left_anti").drop("sbjt_cd", "lt_no", "subh_cd"), clash


def collect_roster(classes: DataFrame, snapshots: DataFrame, terms: DataFrame) -> DataFrame:
    """Sections to collect per term: the catalogue's, or the snapshot's where it has none; a blank section is 000."""
    key = ["year", "term"]
    cols = [*key, "sbjt_cd", "lt_no", F.when(F.trim(F.coalesce("subh_cd", F.lit(""))) == "", "000").otherwise(F.col("subh_cd")).alias("subh_cd")]
    own = classes.join(terms, key, "left_semi").select(*cols)
    rest = snapshots.join(terms, key, "left_semi").join(own.select(*key).distinct(), key, "left_anti").select(*cols)
    return own.unionByName(rest).distinct()


def past_terms(classes: DataFrame, since: int, targets: DataFrame) -> DataFrame:
    return classes.where(F.col("year") >= since).select("year", "term").distinct().join(targets, ["year", "term"], "left_anti")
