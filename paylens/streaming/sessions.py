"""Sender sessions on a stream: runs of payments with short gaps, late payments told apart.

A session is a run of a sender's payments, each within ``gap_seconds`` of one
before. The state of a sender is its clock (the latest payment time seen) and
its open sessions. A payment more than ``delay_seconds`` behind the clock, as
it stood before the micro-batch, is late: its session may be out already, so
it is passed on as a row of its own and never dropped. A session is closed and
passed on once the clock has left it behind by gap and delay; what is still
open can be read from the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from paylens.sources.payments import read_processed

MICROS = 1_000_000
#: Kinds of rows: a closed session, a late payment, a payment without sender or time.
SESSION, LATE, UNPLACED = "session", "late", "unplaced"
OUT = "kind string, party string, start long, end long, payments long, total double"
STATE = "clock long, starts array<long>, ends array<long>, payments array<long>, totals array<double>"


def merged(starts: np.ndarray, ends: np.ndarray, payments: np.ndarray, totals: np.ndarray, gap: int) -> tuple[np.ndarray, ...]:
    """Sessions, in order, that the given ones form when those within ``gap`` of each other are joined."""
    order = np.lexsort((ends, starts))
    starts, ends, payments, totals = starts[order], ends[order], payments[order], totals[order]
    reach = np.maximum.accumulate(ends)
    first = np.flatnonzero(np.concatenate([[True], starts[1:] - reach[:-1] > gap]))
    return starts[first], np.maximum.reduceat(ends, first), np.add.reduceat(payments, first), np.add.reduceat(totals, first)


def _rows(kind: str, party: str | None, starts, ends, payments, totals) -> pd.DataFrame:
    return pd.DataFrame({"kind": kind, "party": [party] * len(starts), "start": starts, "end": ends, "payments": payments, "total": totals})


def sender_sessions(
    stream: DataFrame,
    gap_seconds: int = 3600,
    delay_seconds: int = 3600,
    idle_seconds: int | None = None,
    party: str = "sender_bic",
    time: str = "timestamp",
    amount: str = "amount",
) -> DataFrame:
    """Rows ``kind``, ``party``, ``session_start``, ``session_end``, ``payments``, ``total_amount`` of a payment stream.

    Every payment is in exactly one row: in that of its session, or alone as
    ``late`` or, without sender or time, as ``unplaced``. With ``idle_seconds``
    the sessions of a sender that sends nothing for so long are closed by a
    timer. A null amount adds nothing, a NaN makes the total NaN. Sessions do
    not depend on how the payments are cut into micro-batches, but for late
    ones.
    """
    gap, delay = gap_seconds * MICROS, delay_seconds * MICROS

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (name,) = key
        clock, *held = state.get if state.exists else (None, [], [], [], [])
        if state.hasTimedOut:
            if len(held[0]):
                yield _rows(SESSION, name, *(np.asarray(x) for x in held))
            state.update((clock, [], [], [], []))
            return
        starts, ends, payments, totals = (np.asarray(x, kind) for x, kind in zip(held, (np.int64, np.int64, np.int64, np.float64)))
        latest = clock
        for batch in batches:
            at, paid = batch["at"], batch["amount"].fillna(0.0).where(~batch["odd"], np.nan).to_numpy(np.float64)
            placed = at.notna().to_numpy() & (name is not None)
            times = at.where(placed, 0).to_numpy(np.int64)
            if not placed.all():
                none = ~placed
                yield _rows(UNPLACED, name, at[none].astype("Int64"), at[none].astype("Int64"), 1, paid[none])
            late = placed & (times < clock - delay) if clock is not None else np.zeros(len(times), bool)
            if late.any():
                yield _rows(LATE, name, times[late], times[late], 1, paid[late])
            new = placed & ~late
            if new.any():
                t = times[new]
                latest = max(int(t.max()), latest if latest is not None else int(t.max()))
                starts, ends, payments, totals = merged(
                    np.concatenate([starts, t]), np.concatenate([ends, t]), np.concatenate([payments, np.ones(len(t), np.int64)]),
                    np.concatenate([totals, paid[new]]), gap)
        if latest is None:
            return
        closed = ends + gap < latest - delay
        if closed.any():
            yield _rows(SESSION, name, starts[closed], ends[closed], payments[closed], totals[closed])
        left = [x[~closed].tolist() for x in (starts, ends, payments, totals)]
        state.update((latest, *left))
        if idle_seconds is not None:
            state.setTimeoutDuration(idle_seconds * 1000)

    timeout = GroupStateTimeout.NoTimeout if idle_seconds is None else GroupStateTimeout.ProcessingTimeTimeout
    rows = stream.select(
        F.col(party).cast("string").alias("party"), F.unix_micros(time).alias("at"),
        F.col(amount).alias("amount"), F.coalesce(F.isnan(amount), F.lit(False)).alias("odd"))
    return _named(rows.groupBy("party").applyInPandasWithState(update, OUT, STATE, "append", timeout))


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(
        "kind", "party", F.timestamp_micros("start").alias("session_start"), F.timestamp_micros("end").alias("session_end"),
        "payments", F.col("total").alias("total_amount"))


def start_session_stream(spark: SparkSession, input_path: str, output_path: str, checkpoint: str, **options) -> StreamingQuery:
    """Sessions of the processed payments that land under ``input_path``, as Parquet; ends when all files are taken.

    Started again with the same ``checkpoint`` it takes only new files and goes
    on with the open sessions.
    """
    files = spark.readStream.schema(read_processed(spark, input_path).schema).parquet(input_path)
    out = sender_sessions(files, **options).writeStream.format("parquet").option("path", output_path)
    return out.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions still open, read from the state of a stopped stream; columns of :func:`sender_sessions`."""
    state = spark.read.format("statestore").load(checkpoint)
    value = "value.groupState"
    each = F.arrays_zip(*[F.col(f"{value}.{c}").alias(c) for c in ("starts", "ends", "payments", "totals")])
    rows = state.select(F.col("key.party").alias("party"), F.explode(each).alias("s"))
    rows = rows.select(F.lit(SESSION).alias("kind"), "party", F.col("s.starts").alias("start"), F.col("s.ends").alias("end"),
                       F.col("s.payments").alias("payments"), F.col("s.totals").alias("total"))
    return _named(rows)
