import datetime as dt

import pytest

from termtide.operators import series
from termtide.streaming import deltas
from termtide.streaming.store import Store

KEY = ["term", "user_id"]
SCHEMA = "term string, user_id long, ts timestamp, applied int, cart int, enrolled int, quota int"


def at(minute, day=1):
    return dt.datetime(2024, 1, day, 9, minute)


def encode(spark, folder, parts, **kw):
    """Observations streamed part by part; samples in order, and the state rows that each part left."""
    schema, left = SCHEMA + ", gone boolean", []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = deltas.stream_deltas(stream, KEY, **kw).writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(availableNow=True).start()
        query.awaitTermination()
        left.append(sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"]))
    return sorted(tuple(r)[1:] for r in spark.read.parquet(f"{folder}/out").collect()), left


def test_stream_deltas_equals_batch_rules(spark, tmp_path):
    rows = [
        ("T", 1, at(0), 5, None, 1, 30, False), ("T", 1, at(1), 5, None, 1, 30, False), ("T", 1, at(2), 6, None, None, 30, False),
        ("T", 1, at(3), 6, 2, 1, 30, False), ("T", 1, at(4), None, None, None, None, True), ("T", 1, at(5), 6, 2, 1, 30, False), ("T", 2, at(0), None, None, None, None, False),
    ]
    got, _ = encode(spark, tmp_path, (rows[:3], rows[3:]))
    assert got == [(1, at(0), 5, None, 1, 30), (1, at(2), 6, None, None, 30), (1, at(3), 6, 2, 1, 30), (1, at(4), None, None, None, None), (1, at(5), 6, 2, 1, 30)]


def test_closed_series_leave_no_state(spark, tmp_path):
    opened = [("T", u, at(u), 5, None, 1, 30, False) for u in range(8)]
    closed = [("T", u, at(20), None, None, None, None, True) for u in range(8)]
    got, left = encode(spark, tmp_path, (opened, closed), closed_for=dt.timedelta(0))
    assert left == [8, 0] and len(got) == 16


def test_rows_older_than_the_end_do_not_open_a_series(spark, tmp_path):
    parts = (
        [("T", 1, at(5), 5, None, 1, 30, False)], [("T", 1, at(9), None, None, None, None, True)],
        [("T", 1, at(7), 4, None, 1, 30, False), ("T", 1, at(8), None, None, None, None, True)],  # late
        [("T", 1, at(12), 4, None, 1, 30, False), ("T", 1, at(11), 3, None, None, None, None), (None, None, None, 1, 1, 1, 1, False)],
    )
    got, left = encode(spark, tmp_path, parts)
    assert got == [(1, at(5), 5, None, 1, 30), (1, at(7), 4, None, 1, 30), (1, at(9), None, None, None, None), (1, at(11), 3, None, None, None), (1, at(12), 4, None, 1, 30)]
    assert left[0] == 1 and left[-1] == 1


def stream(spark, folder, part, checkpoint, **kw):
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in-{checkpoint}")
    source = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in-{checkpoint}")
    deltas.stream_merge(source, f"{folder}/store", f"{folder}/cp-{checkpoint}", KEY, **kw).awaitTermination()
    return Store(spark, f"{folder}/store", source.schema, KEY)


def plain(df):
    return sorted(tuple(r) for r in df.collect())


def check_latest(store):
    assert plain(store.latest()) == plain(series.fold_latest(store.samples(), KEY))


def test_stream_merge_once_per_key_and_late_rows(spark, tmp_path):
    first = [("T", 1, at(1), 5, None, None, 30), ("T", 2, at(1), 9, None, None, 40)]
    second = [("T", 1, at(1), 5, None, None, 30), ("T", 1, at(3), None, 4, None, None), ("T", 2, at(0), 1, None, None, 1), ("T", 2, at(2), None, None, None, None), ("T", None, at(2), 1, 1, 1, 1), ("T", 3, None, 1, 1, 1, 1)]
    for part in (first, second):
        store = stream(spark, tmp_path, part, "a")
    assert store.samples().count() == 5
    assert plain(store.latest()) == [("T", 1, at(3), 5, 4, None, 30)]
    check_latest(store)
    assert [(r["n_read"], r["n_inserted"], r["n_older"], r["cursor"]) for r in store.manifest()] == [(2, 2, 0, at(1)), (6, 3, 1, at(3))]


def test_two_checkpoints_feed_one_store(spark, tmp_path):
    a = [("T", 1, at(1), 5, None, None, 30), ("T", 2, at(1), 9, None, None, 40)]
    b = [("T", 2, at(1), 9, None, None, 40), ("T", 3, at(2), 7, None, None, 20), ("T", 1, at(4, 2), 6, None, None, 30)]
    stream(spark, tmp_path, a, "a")
    store = stream(spark, tmp_path, b, "b")
    assert store.samples().count() == 4 and store.latest().count() == 3
    check_latest(store)
    store = stream(spark, tmp_path, [("T", 4, at(5), 1, 1, 1, 1)], "a")
    assert store.samples().count() == 5 and store.cursor() == at(4, 2)
    check_latest(store)


def test_a_retried_batch_and_a_crash_between_writes(spark, tmp_path, monkeypatch):
    a, b = [("T", u, at(1), u, None, None, 30) for u in range(6)], [("T", u, at(2), u + 1, None, None, 30) for u in range(3, 9)]
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    store = Store(spark, str(tmp_path), df(a).schema, KEY)
    assert store.merge(df(a), "w", 0)["n_inserted"] == 6 and store.merge(df(a), "w", 0) is None
    for point in ("_write_latest", "_commit"):
        with monkeypatch.context() as m:
            def crash(*args):
                raise RuntimeError("lost")
            m.setattr(Store, point, crash)
            with pytest.raises(RuntimeError):
                store.merge(df(b), "w", 1)
        assert store.samples().count() == 6 and len(store.manifest()) == 1
        check_latest(store)
    assert store.merge(df(a[:2] + [("T", 50, at(3), 1, 1, 1, 1)]), "other", 0)["n_inserted"] == 1  # takes the number of the crashed one
    assert store.merge(df(b), "w", 1)["n_inserted"] == 6
    assert store.samples().count() == 13
    check_latest(store)


def test_few_keys_touch_few_buckets_and_compaction_keeps_all(spark, tmp_path):
    all_ = spark.range(5000).selectExpr("'T' as term", "id as user_id", "timestamp'2024-01-01 09:01:00' as ts", "cast(id as int) as applied", "cast(null as int) as cart", "1 as enrolled", "30 as quota")
    store = Store(spark, str(tmp_path), all_.schema, KEY, buckets=1200)
    store.merge(all_, "w", 0)
    row = store.merge(spark.createDataFrame([("T", u, at(2), 1, 1, 1, 1) for u in range(0, 100, 10)], SCHEMA), "w", 1)
    assert len(row["buckets"]) <= 10 and store._read("latest", [f"{tmp_path}/latest/seq=1"]).count() < 0.01 * 5000 * 1.5
    before = plain(store.samples().drop("day")), plain(store.latest()), store.day_counts(), store.cursor()
    store.compact()
    assert len(store.manifest()) == 1
    assert (plain(store.samples().drop("day")), plain(store.latest()), store.day_counts(), store.cursor()) == before
    assert store.merge(all_, "w", 1) is None and store.merge(all_, "w", 2)["n_inserted"] == 0  # writers outlive a compaction


def test_rows_behind_the_watermark_wait_in_the_late_table(spark, tmp_path):
    parts = [[("T", 1, at(0, 5), 5, None, None, 30)], [("T", 1, at(9, 1), 4, None, None, 30), ("T", 2, at(9, 1), 7, None, None, 9), ("T", 1, at(0, 4), 3, None, None, 30)], [("T", 2, at(9, 1), 7, None, None, 9)]]
    for part in parts:
        store = stream(spark, tmp_path, part, "a", delay=dt.timedelta(days=2))
    assert store.samples().count() == 2 and store.late().count() == 3
    assert [r["n_late"] for r in store.manifest()] == [0, 2, 1] and store.day_counts() == {dt.date(2024, 1, 5): 1, dt.date(2024, 1, 4): 1}
    row = store.merge_late()
    assert row["n_inserted"] == 2 and store.late().count() == 0 and store.merge_late() is None
    assert store.day_counts()[dt.date(2024, 1, 1)] == 2 and store.latest().count() == 2
    check_latest(store)


def test_pull_goes_on_after_the_cursor(spark, tmp_path):
    rows = [("T", 1, at(0), 5, None, None, 30), ("T", 1, at(10), 6, None, None, 30), ("T", 2, at(10), 9, None, None, 40)]
    source = spark.createDataFrame(rows, SCHEMA)
    passes = spark.createDataFrame([("T", at(0), True), ("T", at(10), True), ("T", at(30), False)], "term string, ts timestamp, cart boolean")
    store = Store(spark, str(tmp_path), source.schema, KEY)
    store.merge(source.limit(1), "local", 0)
    assert store.pull(source, "cloud", passes)["n_inserted"] == 2
    assert store.cursor() == at(30)  # a pass without samples moves the cursor too
    again = store.pull(source, "cloud", passes)
    assert again["n_inserted"] == 0 and again["n_read"] == 0 and again["cursor"] == at(30)
    gap = source.unionByName(spark.createDataFrame([("T", 9, at(5), 1, 1, 1, 1)], SCHEMA))
    assert store.pull(gap, "cloud")["n_inserted"] == 0 and store.pull(gap, "cloud", passes, everything=True)["n_inserted"] == 1
    store.compact()
    assert [tuple(r) for r in store.passes(["term"], passes.schema).orderBy("ts").collect()] == [("T", at(0), True), ("T", at(10), True), ("T", at(30), False)]
    check_latest(store)


def test_an_empty_store_and_an_empty_batch(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    store = Store(spark, str(tmp_path), none.schema, KEY)
    assert store.samples().count() == store.latest().count() == 0 and store.cursor() is None and store.compact() is None and store.merge_late() is None
    assert store.merge(none, "w", 0)["n_inserted"] == 0 and store.samples().count() == 0


def test_a_series_that_reopens_and_ends_in_one_batch_has_its_new_end(spark, tmp_path):
    gone = lambda minute: ("T", 1, at(minute), None, None, None, None, True)
    row = lambda minute: ("T", 1, at(minute), 5, None, 1, 30, False)
    got, left = encode(spark, tmp_path, ([row(5), gone(9)], [row(12), gone(15)], [row(13)], [row(16)]))
    assert [r[1] for r in got] == [at(5), at(9), at(12), at(13), at(15), at(16)] and left == [1, 1, 1, 1]
