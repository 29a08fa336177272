"""Streams of observations and samples: stateful delta encoding, and merging into a store."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from termtide.operators import series
from termtide.streaming.store import Store, writer_of

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _encoder(metrics: Sequence[str], names: Sequence[str], closed_ms: int):
    """The state function of one series: its newest time and baseline while it lives, and for a while the time at which it closed.

    Times are microseconds. State: the newest time, when a closed series expires (null while it lives), and the baseline.
    It comes and goes with the rows of many series at once, so a series costs no calls of its own.
    """
    none = (None,) * len(metrics)

    def encode(_key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, expires, *known = state.get if state.exists else (None, None, *none)
        if expires is not None and expires <= state.getCurrentProcessingTimeMs():
            last = expires = None
        ended, known = (None, known) if state.exists and expires is None and last is not None else (last, None)
        frames = list(frames)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        batch = batch.iloc[batch["ts"].to_numpy().argsort(kind="stable")]
        columns = [[None if v != v else int(v) for v in batch[m].tolist()] for m in metrics]
        kept = []
        for i, (ts, gone, values) in enumerate(zip(batch["ts"].tolist(), batch["gone"].tolist(), zip(*columns, strict=True), strict=True)):
            late = last is not None and ts < last
            if gone:
                if known is not None and not late:
                    kept.append(i)
                    known, last = None, ts
                continue
            if values == none:
                continue
            if late:
                kept.append(i)  # passed on, but the baseline stays
                continue
            if known is None or any(v is not None and v != k for v, k in zip(values, known, strict=True)):
                kept.append(i)
                known = values if known is None else [k if v is None else v for v, k in zip(values, known, strict=True)]
            last = ts
        if known is not None:
            state.update((last, None, *known))
        elif closed_ms and last is not None:
            now = state.getCurrentProcessingTimeMs()
            expires = expires if last == ended else now + closed_ms
            state.update((last, expires, *none))
            state.setTimeoutDuration(max(expires - now, 1))
        elif state.exists:
            state.remove()
        if kept:
            yield batch.iloc[kept][list(names)]

    return encode


def stream_deltas(observations: DataFrame, key: Sequence[str], metrics: Sequence[str] = series.METRICS, closed_for: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """Samples (key, ts, metrics) of a stream of observations with a boolean `gone`.

    A live series has one row of state: its baseline and its newest time. A `gone` row closes it with a row of nulls and
    deletes that state; its time is kept for `closed_for` more, so that rows older than the end don't open the series
    anew, and then expires (with zero nothing is kept). A row older than the state is passed on without changing it.
    State is in RocksDB, so that it may outgrow memory. Expired state goes when the next rows come: batches without rows
    are turned off in the session, since with a time to live they would follow one another for ever.
    """
    conf = observations.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    longs = [T.StructField(m, T.LongType()) for m in metrics]
    out = T.StructType([*(observations.schema[k] for k in key), T.StructField("ts", T.LongType()), *longs])
    held = T.StructType([T.StructField("ts", T.LongType()), T.StructField("expires", T.LongType()), *longs])
    gone = F.coalesce("gone", F.lit(False))
    values = (F.when(~gone, F.col(m).cast("long")).alias(m) for m in metrics)
    rows = observations.where("ts is not null").select(*key, F.unix_micros("ts").alias("ts"), *values, gone.alias("gone"))
    closed_ms = int(closed_for.total_seconds() * 1000)
    timeout = GroupStateTimeout.ProcessingTimeTimeout if closed_ms else GroupStateTimeout.NoTimeout
    encoded = rows.groupBy(*key).applyInPandasWithState(_encoder(metrics, out.names, closed_ms), out, held, "append", timeout)
    return encoded.withColumn("ts", F.timestamp_micros("ts"))


def stream_merge(samples: DataFrame, path: str, checkpoint: str, key: Sequence[str], metrics: Sequence[str] = series.METRICS, buckets: int = 64, delay: dt.timedelta | None = None):
    """Start the merge of a stream of samples into the store at `path`; returns the streaming query.

    Each micro-batch is one merge of the store (see `Store.merge`), known by the checkpoint's own id and the batch's
    number: a repeated batch is skipped, and a new checkpoint, or another one, goes on from what the store holds.
    delay: rows more than this behind the newest time go to the store's late table, which `merge_late` takes in.
    """
    store = Store(samples.sparkSession, path, samples.schema, key, metrics, buckets)

    def work(batch: DataFrame, number: int) -> None:
        dataclasses.replace(store, spark=batch.sparkSession).merge(batch, writer_of(batch.sparkSession, checkpoint), number, delay)

    return samples.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
