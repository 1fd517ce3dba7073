"""Rows of responses as they end, while frames of others still arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tunelake.sources.frames import parse_frames

NUMBERS = ("last_seq", "content_us", "last_us", "usage", "contents", "expires_ms")
ROWS = "request_id {kind}, ended boolean, content_us long, last_us long, completion_tokens long"
BUCKETS = 1_024
NONE, LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def opened(ids: pd.Index, before: pd.DataFrame | None) -> pd.DataFrame:
    """What is known of these requests, one row each; nothing yet of those not met before."""
    if before is None:
        before = pd.DataFrame({n: pd.array([], "Int64") for n in NUMBERS} | {"ended": pd.array([], "boolean")}, index=ids[:0])
    return before.reindex(ids).fillna({"last_seq": -1, "contents": 0, "ended": False})


def fold_frames(state: pd.DataFrame, frames: pd.DataFrame) -> pd.DataFrame:
    """The states after further frames, in order of ``seq``: what the batch fold knows of each request, in one row.

    ``state`` has a row for each request of the frames. Frames up to its ``last_seq`` were
    folded before, and nothing counts after the end mark.
    """
    n, at = len(state), state.index.get_indexer(frames["request_id"])
    fresh = ~state["ended"].to_numpy(bool)[at] & (frames["seq"].to_numpy() > state["last_seq"].to_numpy(np.int64)[at])
    frames, at = frames[fresh], at[fresh]
    seq, recv = frames["seq"].to_numpy(np.int64), frames["recv_us"].to_numpy(np.int64)
    is_end, reported = frames["is_end"].to_numpy(bool), frames["usage_tokens"].notna().to_numpy()

    def most(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.full(n, LEAST)
        np.maximum.at(out, at[rows], values[rows])
        return out

    def least(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.full(n, NONE)
        np.minimum.at(out, at[rows], values[rows])
        return out

    def known(values: np.ndarray, nothing: int) -> pd.Series:
        return pd.Series(pd.array(values, "Int64"), state.index).mask(values == nothing)

    end_at = least(is_end, seq)
    seen, live = seq <= end_at[at], seq < end_at[at]
    content, reported = live & frames["has_content"].to_numpy(bool), live & reported
    usage_at = most(reported, seq)
    usage = most(reported & (seq == usage_at[at]), pd.to_numeric(frames["usage_tokens"]).fillna(0).to_numpy(np.int64))
    after = content & (seq > usage_at[at])
    last_us = most(seen, recv)
    return state.assign(
        last_seq=known(most(seen, seq), LEAST).fillna(state["last_seq"]),
        content_us=state["content_us"].fillna(known(least(content, recv), NONE)),
        last_us=known(np.maximum(last_us, state["last_us"].fillna(LEAST).to_numpy(np.int64)), LEAST),
        usage=known(np.where(usage_at == LEAST, LEAST, usage), LEAST).fillna(state["usage"]),
        contents=state["contents"].where(usage_at == LEAST, 0) + np.bincount(at[after], minlength=n),
        ended=state["ended"] | (end_at != NONE))


def packed(state: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(state.rename_axis("request_id").reset_index(), preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas().set_index("request_id")


class EndedResponses(StatefulProcessor):
    """Folds requests and gives each one's row when it ends, or when no frame has come for ``idle_ms``.

    A key is a bucket of requests, so that a call folds many of them together; its timer is
    that of the request which goes first. An ended request's state is dropped after
    ``idle_ms`` too; frames that come later begin it anew.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "requests binary")

    def rows(self, state: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "request_id": state.index, "ended": state["ended"].to_numpy(bool), "content_us": state["content_us"].array, "last_us": state["last_us"].array,
            "completion_tokens": (state["usage"].fillna(0) + state["contents"]).to_numpy(np.int64)})

    def keep(self, state: pd.DataFrame, timer: int | None) -> None:
        """Store the requests still known, and move the timer to the first of them."""
        first = int(state["expires_ms"].min()) if len(state) else None
        if len(state):
            self.open.update((packed(state),))
        else:
            self.open.clear()
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = pd.concat(list(rows))
        before = unpacked(bytes(self.open.get()[0])) if self.open.exists() else None
        old = opened(pd.Index(frames["request_id"].unique()), before)
        new = fold_frames(old, frames)
        new = new[new["last_us"].notna()]
        soonest = timerValues.getCurrentWatermarkInMs() + 1
        new = new.assign(expires_ms=(new["last_us"] // 1000 + 1 + self.idle_ms).clip(lower=soonest))
        just = new[(new["ended"] & ~old["ended"].reindex(new.index)).to_numpy(bool)]
        if len(just):
            yield self.rows(just)
        rest = before[~before.index.isin(new.index)] if before is not None else None
        timer = int(before["expires_ms"].min()) if before is not None else None
        self.keep(new if rest is None else pd.concat([rest, new]), timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            state, timer = unpacked(bytes(self.open.get()[0])), expiredTimerInfo.getExpiryTimeInMs()
            due = (state["expires_ms"] <= max(timer, timerValues.getCurrentWatermarkInMs() - 1)).to_numpy(bool)
            silent = state[due & ~state["ended"].to_numpy(bool)]
            if len(silent):
                yield self.rows(silent)
            # The timer that went off is removed by itself.
            self.keep(state[~due], None)

    def close(self) -> None:
        pass


def ended_responses(frames: DataFrame, starts: DataFrame, idle_ms: int, *, late_ms: int = 60_000, buckets: int = BUCKETS) -> DataFrame:
    """A stream of rows (request_id, ended, ttft_us, completion_tokens, total_us), one for each request that has ended.

    Each row is what ``fold_responses`` gives for the request, and comes out with the
    micro-batch that holds its end mark. A request without one is given up, with
    ``ended`` false, when event time, the latest ``recv_us`` less ``late_ms``, has passed its last
    frame by ``idle_ms``. Frames older than event time are left out. State is a few numbers for each open request and ends with it; text
    is parsed before and not kept. A request's frames must arrive in order of ``seq``; frames seen
    again are passed over. Requests are kept in ``buckets`` by hash, which a stream must not change. ``starts`` is a table: a request without a start has null times.

    Start it within :func:`tunelake.streaming.run.keyed_state`, which sets the state store it needs.
    """
    kind = frames.schema["request_id"].dataType.simpleString()
    timed = parse_frames(frames).filter("request_id is not null and seq is not null and recv_us is not null").withColumn(
        "at", F.timestamp_micros(F.col("recv_us") + 1_000)).withWatermark("at", f"{late_ms} milliseconds")
    folded = timed.withColumn("bucket", F.pmod(F.xxhash64("request_id"), F.lit(buckets))).groupBy("bucket").transformWithStateInPandas(
        EndedResponses(idle_ms), outputStructType=ROWS.format(kind=kind), outputMode="append", timeMode="eventtime")
    return folded.join(starts.select("request_id", "start_us"), "request_id", "left").select(
        "request_id", "ended", (F.col("content_us") - F.col("start_us")).alias("ttft_us"), "completion_tokens",
        (F.col("last_us") - F.col("start_us")).alias("total_us"))
