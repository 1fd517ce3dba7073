"""Caller-supplied Python over examples: row maps and text generators."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

GENERATED = T.StructType([
    T.StructField("prediction", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("latency_s", T.DoubleType()),
])


def map_examples(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType
) -> DataFrame:
    """Apply ``fn`` to Arrow batches of examples; its result replaces the columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(fn, batches)

    return df.mapInPandas(run, schema)


class Call:
    """One call under way in a thread of its own."""

    def __init__(self, fn: Callable[[str], str], prompt: str):
        self.done = threading.Event()
        self.began = time.monotonic()
        threading.Thread(target=self.run, args=(fn, prompt), daemon=True).start()

    def run(self, fn: Callable[[str], str], prompt: str) -> None:
        self.outcome = attempt(fn, prompt)
        self.done.set()

    def result(self, limit_s: float | None) -> tuple[str, str | None, float]:
        left = None if limit_s is None else max(0.0, self.began + limit_s - time.monotonic())
        if self.done.wait(left):
            return self.outcome
        return "", f"TimeoutError: no answer within {limit_s:g} s", 0.0


def attempt(fn: Callable[[str], str], prompt: str) -> tuple[str, str | None, float]:
    """(text, error, seconds) of one call."""
    began = time.monotonic()
    try:
        return fn(prompt), None, time.monotonic() - began
    except Exception as e:  # noqa: BLE001
        return "", f"{type(e).__name__}: {e}", 0.0


def answers(fn: Callable[[str], str], prompts: Iterable[str], in_flight: int, limit_s: float | None) -> Iterator[tuple[str, str | None, float]]:
    """Outcomes in the order of the prompts, with at most ``in_flight`` calls waited for at a time."""
    if in_flight == 1 and limit_s is None:
        yield from (attempt(fn, p) for p in prompts)
        return
    window: deque[Call] = deque()
    for p in prompts:
        if len(window) == in_flight:
            yield window.popleft().result(limit_s)
        window.append(Call(fn, p))
    while window:
        yield window.popleft().result(limit_s)


def generate(
    df: DataFrame, fn: Callable[[str], str], *, prompt: str = "prompt", keep: list[str],
    concurrency: int | None = None, in_flight: int = 1, limit_s: float | None = None,
) -> DataFrame:
    """Call ``fn`` on every prompt and record its text, error and seconds.

    A failing call leaves '' and the error on its own row, with 0 seconds.

    concurrency  number of partitions the prompts are dealt over; as they lie if not given
    in_flight    calls a task has under way at once, each in a thread, so ``fn`` must
                 bear that; rows keep their order
    limit_s      seconds after which a call is given up as a failing one. Its thread
                 is left behind and holds no place among those in flight
    """
    if in_flight < 1:
        raise ValueError("in_flight must be 1 or more")
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors, seconds = [], [], []
            for text, error, took in answers(fn, batch[prompt], in_flight, limit_s):
                texts.append(text)
                errors.append(error)
                seconds.append(took)
            yield batch[keep].assign(prediction=texts, error=errors, latency_s=seconds)

    spread = df.repartition(concurrency) if concurrency else df
    return spread.select(*dict.fromkeys([*keep, prompt])).mapInPandas(
        run, T.StructType(fields + GENERATED.fields))
