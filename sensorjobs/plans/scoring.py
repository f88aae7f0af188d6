"""Model calls that cannot harm a run: saved models, one process beside each worker, a deadline for every call.

A saved model is a small JSON text (``Saved``); nothing is unpickled. The model runs in a child process of the
Python worker, where it is made once and then asked station by station. A call that takes too
long, or a child that dies, costs its station alone: the child is replaced, the station tried again, and after
the last attempt its error says what happened.
"""

from __future__ import annotations

import json
import multiprocessing
import signal
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cache
from math import ceil
from typing import Any

import pandas as pd
from pyspark.sql import SparkSession

Model = Callable[[pd.DataFrame, int], Any]

#: Characters of the largest saved model that is sent to the workers.
MOST_TEXT = 16 << 20


def persistence(frame: pd.DataFrame, horizon: int, column: str = "aqi_pm2_5") -> list[float]:
    """A model for tests and baselines: the last value for every hour."""
    return [float(frame[column].iloc[-1])] * horizon


def drift(frame: pd.DataFrame, horizon: int, column: str = "aqi_pm2_5") -> list[float]:
    """A model for tests and baselines: the line through the window's first and last value."""
    y = frame[column].astype(float)
    slope = (y.iloc[-1] - y.iloc[0]) / max(1, len(y) - 1)
    return [float(y.iloc[-1] + slope * (k + 1)) for k in range(horizon)]


def linear(frame: pd.DataFrame, horizon: int, weights: Mapping[str, float], intercept: float = 0.0, by_hour: float = 0.0) -> list[float]:
    """A linear model of the window's last row, and of the hours ahead."""
    now = intercept + sum(w * float(frame[c].iloc[-1]) for c, w in weights.items())
    return [now + by_hour * (k + 1) for k in range(horizon)]


#: The kinds of saved models; a library of one's own adds to these before it scores.
KINDS: dict[str, Callable[..., Any]] = {"persistence": persistence, "drift": drift, "linear": linear}


@dataclass(frozen=True)
class Saved:
    """A model as text: its kind and its numbers. The workers make it once for each process."""

    kind: str
    numbers: Mapping[str, Any] = field(default_factory=dict)
    version: str = "unversioned"

    def text(self) -> str:
        return json.dumps({"kind": self.kind, "numbers": dict(self.numbers), "version": self.version}, sort_keys=True)


def save_model(spark: SparkSession, model: Saved, path: str) -> None:
    """Write a model as one line of JSON; an existing model is replaced."""
    spark.createDataFrame([(model.text(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_model(spark: SparkSession, path: str) -> Saved:
    """Read a model from any place that Spark reads."""
    rows = spark.read.text(path).limit(2).collect()
    if len(rows) != 1 or len(rows[0]["value"]) > MOST_TEXT:
        raise ValueError(f"no saved model of at most {MOST_TEXT} characters at {path}")
    return _parsed(rows[0]["value"])


def _parsed(text: str) -> Saved:
    got = json.loads(text)
    if got.get("kind") not in KINDS or not isinstance(got.get("numbers"), dict):
        raise ValueError(f"unknown kind of model: {got.get('kind')!r}")
    return Saved(got["kind"], got["numbers"], str(got.get("version", "unversioned")))


@cache
def made(text: str) -> Model:
    """The model of a text, once for each process."""
    saved = _parsed(text)
    fn = KINDS[saved.kind]
    return lambda frame, horizon: fn(frame, horizon, **saved.numbers)


def _serve(pipe: Any, model: Model | Saved, answer: Callable[[Any, pd.DataFrame, int], Any], seconds: float) -> None:
    """The child: answers (frame, horizon) until the pipe closes; it ends by itself if a call hangs and nobody ends it."""
    call = made(model.text()) if isinstance(model, Saved) else model
    while True:
        try:
            frame, horizon = pipe.recv()
        except EOFError:
            return
        signal.alarm(ceil(seconds) + 10)
        try:
            said = (answer(call(frame, horizon), frame, horizon), None)
        except Exception as e:
            said = (None, str(e)[:500])
        signal.alarm(0)
        pipe.send(said)


class Scorer:
    """Asks a model in a child process. To be used as a context: the child ends with it."""

    def __init__(self, model: Model | Saved, answer: Callable[[Any, pd.DataFrame, int], Any], seconds: float, attempts: int) -> None:
        self.args, self.seconds, self.attempts = (model, answer, seconds), seconds, attempts
        self.child: Any = None
        self.pipe: Any = None

    def __enter__(self) -> Scorer:
        return self

    def __exit__(self, *_: object) -> None:
        self._end()

    def _end(self) -> int | None:
        if self.child is None:
            return None
        self.child.kill()
        self.child.join()
        self.pipe.close()
        code, self.child = self.child.exitcode, None
        return code

    def _begin(self) -> None:
        # A fork, so that the model needs no pickling and starts at once.
        context = multiprocessing.get_context("fork")
        self.pipe, theirs = context.Pipe()
        self.child = context.Process(target=_serve, args=(theirs, *self.args), daemon=True)
        self.child.start()
        theirs.close()

    def ask(self, frame: pd.DataFrame, horizon: int) -> tuple[Any, str | None]:
        """The model's answer and None, or None and what went wrong."""
        problem = None
        for _ in range(self.attempts):
            if self.child is None:
                self._begin()
            try:
                self.pipe.send((frame, horizon))
                if self.pipe.poll(self.seconds):
                    return self.pipe.recv()
                problem = f"no answer within {self.seconds:g} s"
            except (EOFError, OSError):
                self.child.join(1)
                problem = f"the model's process ended (exit code {self.child.exitcode})"
            self._end()
        return None, problem


def windows(batches: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The rows of one key after the other, from batches sorted by key. Only one key's rows are held besides a batch."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for k, rows in batch.groupby(key, sort=False, dropna=False):
            if held and not _same(held[-1][key].iloc[-1], k):
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(rows)
    if held:
        yield pd.concat(held, ignore_index=True)


def _same(a: Any, b: Any) -> bool:
    return a == b or (pd.isna(a) and pd.isna(b))
