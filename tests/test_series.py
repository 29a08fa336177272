import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from termtide.operators import series

KEY, SCOPE = ["term", "code"], ["term"]
SAMPLE = "term string, code string, ts timestamp, applied int, cart int, enrolled int, quota int"
AXIS = "term string, ts timestamp, applied boolean, cart boolean, enrolled boolean"


def at(minute, hour=9, day=1):
    return dt.datetime(2026, 9, day, hour, minute)


def axis(spark, rows):
    return series.load_axis(spark.createDataFrame([("T", *r) for r in rows], AXIS), spark.createDataFrame([], SAMPLE), SCOPE)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_delta_encode_scenarios(spark):
    passes = axis(spark, [(at(0), True, False, True), (at(10), True, False, True), (at(20), True, True, True), (at(30), True, False, True)])
    obs = [("T", c, at(m), a, 12 if m == 20 else None, 10, 30) for c, m, a in [
        ("A", 0, 10), ("A", 10, 10), ("A", 20, 11), ("A", 30, 11), ("B", 0, 10), ("B", 10, 10), ("C", 0, None), ("C", 30, 5)]]
    got = series.delta_encode(spark.createDataFrame(obs, SAMPLE), passes, KEY, SCOPE).select("code", "ts", *series.METRICS)
    none = (None,) * 4
    want = [("A", at(0), 10, None, 10, 30), ("A", at(20), 11, 12, 10, 30), ("B", at(0), 10, None, 10, 30), ("B", at(20), *none),
            ("C", at(0), None, None, 10, 30), ("C", at(10), *none), ("C", at(30), 5, None, 10, 30)]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want


def test_keyframes_first_within_after_and_off(spark):
    a = axis(spark, [(at(0), True, True, True), (at(0, 8, 2), True, True, True), (at(0, 9, 2), True, True, True), (at(0, 10, 2), True, True, True)])
    assert [r["full"] for r in series.mark_keyframes(a, SCOPE, 24).orderBy("ts").collect()] == [True, False, True, False]
    assert not any(r["full"] for r in series.mark_keyframes(a, SCOPE, 0).collect())


def test_fold_replay_encode_and_decode_agree(spark):
    samples = spark.createDataFrame([
        ("T", "A", at(0), 5, None, None, 30), ("T", "A", at(5), None, 2, None, None), ("T", "A", at(20), 6, None, 1, None), ("T", "B", at(0), 1, 1, 1, 1),
        ("T", "B", at(20), None, None, None, None), ("T", "B", at(30), 2, None, None, 9), ("T", "Z", at(50), 1, 1, 1, 1)], SAMPLE)
    a = axis(spark, [(at(0), True, True, False), (at(10), True, False, True), (at(20), False, True, True), (at(30), True, True, True)])
    dense = series.replay(samples, a, KEY, SCOPE)
    assert rows(dense.where("code = 'A'").select("pass_idx", *series.METRICS)) == [(0, 5, None, None, 30), (1, 5, None, None, 30), (2, None, 2, 1, 30), (3, 6, 2, 1, 30)]
    assert dense.where("code = 'B' and pass_idx = 2").select(*series.METRICS).first() == (None,) * 4
    assert dense.where("code = 'Z'").count() == 0
    for window in (None, 2):
        encoded = series.cp_encode(samples, a, KEY, SCOPE, window)
        decoded = series.cp_decode(encoded, a, KEY, SCOPE, window)
        want = dense.select(*KEY, (F.col("pass_idx") % (window or 99)).alias("pos"), F.floor(F.col("pass_idx") / (window or 99)).alias("window"), F.explode(F.create_map(*(x for m in series.METRICS for x in (F.lit(m), F.col(m)))))).toDF(*KEY, "pos", "window", "metric", "value")
        joined = decoded.join(want, [*KEY, "window", "metric", "pos"], "left").select(decoded["value"].alias("a"), want["value"].alias("b"))
        assert joined.where("not a <=> b").count() == 0 and decoded.count() > 20
    whole = {(r["code"], r["metric"]): r["cp"] for r in series.cp_encode(samples, a, KEY, SCOPE).collect()}
    assert whole["A", "applied"] == [0, 5, 3, 6] and whole["A", "quota"] == [0, 30] and whole["A", "enrolled"] == [0, None, 2, 1]
    latest = rows(series.fold_latest(samples, KEY))
    assert latest == [("T", "A", at(20), 6, 2, 1, 30), ("T", "B", at(30), 2, None, None, 9), ("T", "Z", at(50), 1, 1, 1, 1)]


def test_feeds_and_folds_equal_the_dense_replay(spark):
    """Random series with tombstones and holes: steps of free seats, newest steps and latest rows against brute force."""
    import random

    rnd = random.Random(3)
    data, times = [], [at(5 * i) for i in range(12)]
    for code in "ABCDEFGH":
        for i in sorted(rnd.sample(range(12), 8)):
            data.append(("T", code, times[i], *((None,) * 4 if rnd.random() < 0.15 else (rnd.choice([None, 1, 2, 3]), rnd.choice([None, 4]), rnd.choice([None, 5]), rnd.choice([2, 3, None])))))
    samples = spark.createDataFrame(data, SAMPLE)
    a = axis(spark, [(t, rnd.random() < 0.8, True, True) for t in times])
    dense = {}
    for r in series.replay(samples, a, KEY, SCOPE).collect():
        dense.setdefault(r["code"], {})[r["pass_idx"]] = None if r["quota"] is None or r["applied"] is None else max(r["quota"] - r["applied"], 0)
    assert all(sorted(v) == list(range(12)) for v in dense.values()) and len(dense) > 5
    want = {(c, p, v[p - 1], v[p]) for c, v in dense.items() for p in range(1, 12) if v[p] is not None and v[p - 1] is not None and v[p] != v[p - 1]}
    steps = series.seat_steps(samples, a, KEY, SCOPE)
    assert {(r["code"], r["pass_idx"], r["before"], r["after"]) for r in steps.where("before <> after").collect()} == want and want
    newest = {c: max((w for w in want if w[0] == c and w[3] > w[2]), key=lambda w: w[1], default=None) for c in dense}
    assert {(r["code"], r["pass_idx"], r["before"], r["after"]) for r in series.change_feed(steps, KEY).collect()} == {w for w in newest.values() if w}
    watch = spark.createDataFrame([("T", "A"), ("T", "B")], "term string, code string")
    assert {(r["code"], r["pass_idx"], r["seats"]) for r in series.vacancy_alerts(steps, watch, KEY).collect()} == {(c, p, x) for c, p, b, x in want if b == 0 and x > 0 and c in "AB"}
    latest = {r["code"]: tuple(r)[2:] for r in series.fold_latest(samples, KEY).collect()}
    for code in "ABCDEFGH":
        own = [d for d in data if d[1] == code]
        dead = max((d[2] for d in own if d[3:] == (None,) * 4), default=None)
        live = [d for d in own if dead is None or d[2] > dead]
        known = tuple(next((d[i] for d in reversed(live) if d[i] is not None), None) for i in range(3, 7))
        assert latest.get(code) == ((live[-1][2], *known) if live else None)
    plan = series.change_feed(steps, KEY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sequence(") == 1  # the days between passes; no series x passes grid


def test_checkpoint_rolls_forward_and_late_rows_invalidate_it(spark):
    early = [("T", "A", at(0), 5, None, None, 30), ("T", "B", at(1), 1, 1, 1, 1)]
    later = [("T", "A", at(20), None, 3, None, None), ("T", "B", at(25), None, None, None, None)]
    late = [("T", "C", at(0), 7, None, None, 8)]
    df = lambda r: spark.createDataFrame(r, SAMPLE)
    saved, n = series.state_before(df(early), KEY, F.lit(at(10)))
    for extra in ([], late):
        all_ = df(early + later + extra)
        got, _ = series.state_before(all_, KEY, F.lit(at(40)), checkpoint=(saved, n, F.lit(at(10))))
        assert rows(got) == rows(series.state_before(all_, KEY, F.lit(at(40)))[0])


def test_merge_twice_is_merge_once_and_keys_are_checked(spark):
    df = lambda r: spark.createDataFrame(r, SAMPLE)
    a = [("T", "A", at(0), 5, None, None, 30)]
    b = [("T", "A", at(10), 6, None, None, 30), ("T", "C", at(10), 9, None, None, 40)]
    once = series.merge_samples(df(a), df(a + b), KEY)
    assert rows(series.merge_samples(once, df(a + b), KEY)) == rows(once) and once.count() == 3
    assert series.merge_report(df(a), df(a + b), KEY).first() == (3, 2, at(10))
    assert series.dedupe_or_raise(df(a + a), [*KEY, "ts"]).count() == 1
    with pytest.raises(ValueError, match="repeats"):
        series.dedupe_or_raise(df(a + [("T", "A", at(0), 6, None, None, 30)]), [*KEY, "ts"])


@pytest.mark.parametrize("keyframes", [False, True])
def test_restating_spans_equals_encoding_the_dense_replay(spark, keyframes):
    """Passes that collect only some metrics, gaps within spans, tombstones, a chunk's border."""
    rng = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda i: t0 + dt.timedelta(hours=i)
    rows = [("T", u, at(i), *(rng.randint(0, 2) if rng.random() < share else None for share in (0.3, 0.3, 0.3, 0.1 * (u % 2)))) for u in range(12) for i in range(150) if rng.random() < 0.15]
    passes = [("T", at(i), *(rng.random() < 0.5 for _ in series.MASKED)) for i in range(150)]
    samples = spark.createDataFrame(rows, "term string, u int, ts timestamp, applied int, cart int, enrolled int, quota int")
    axis = series.load_axis(spark.createDataFrame(passes, "term string, ts timestamp, applied boolean, cart boolean, enrolled boolean"), samples, ["term"])
    axis = series.mark_keyframes(axis, ["term"], 20)
    key = ["term", "u"]
    dense = series.replay(samples, axis, key, ["term"]).where("coalesce(applied, cart, enrolled, quota) is not null").join(axis.select("term", "pass_idx", "ts"), ["term", "pass_idx"])
    want = series.delta_encode(dense, axis, key, ["term"], keyframes=keyframes)
    out = series.restate(samples, axis, key, ["term"], keyframes=keyframes)
    plain = lambda df: sorted(map(str, df.select(*key, "ts", *series.METRICS, "moved").collect()))
    assert plain(out) == plain(want) and out.count() > 300
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(begin" not in plan
