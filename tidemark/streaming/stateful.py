"""Causal operators on streams: average with unknown margin, events on transitions, median of three.

Each has a batch twin; state is a few numbers a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

QUIET_RESET = 3


class MarginAverage:
    """Exponential average from zeros; the unknown class needs a margin over the best other class to win."""

    def __init__(self, alpha: float = 0.3, margin: float = 0.2, unknown: int = 1, state: list[float] | None = None):
        self.alpha, self.margin, self.unknown = alpha, margin, unknown
        self.e = np.array(state, np.float64) if state else None

    def step(self, p: list[float]) -> tuple[int, float]:
        p = np.asarray(p, np.float64)
        self.e = self.alpha * p + (1 - self.alpha) * (np.zeros_like(p) if self.e is None else self.e)
        top = int(self.e.argmax())
        if top == self.unknown and len(p) > 1:
            rest = self.e.copy()
            rest[self.unknown] = -np.inf
            alt = int(rest.argmax())
            if self.e[top] - self.e[alt] < self.margin:
                top = alt
        return top, float(self.e[top])


class Transitions:
    """Fires once when a class other than the last one appears; three quiet frames (class 0 or unknown) forget the last."""

    def __init__(self, unknown: int = 1, last: int = -1, quiet: int = 0):
        self.unknown, self.last, self.quiet = unknown, last, quiet

    def step(self, c: int) -> bool:
        if c in (0, self.unknown):
            self.quiet += 1
            if self.quiet >= QUIET_RESET:
                self.last = -1
            return False
        self.quiet = 0
        fired = c != self.last
        self.last = c
        return fired


OUT = "stream long, pos long, pred long, confidence double, event boolean"


def batch(df: DataFrame, **options) -> DataFrame:
    """The batch twin over (stream, pos, p)."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        average, events = MarginAverage(**options), Transitions(options.get("unknown", 1))
        rows = [average.step(p) for p in part["p"]]
        return pd.DataFrame({"stream": part["stream"], "pos": part["pos"], "pred": [c for c, _ in rows], "confidence": [v for _, v in rows], "event": [events.step(c) for c, _ in rows]})

    return df.select("stream", "pos", "p").groupBy("stream").applyInPandas(run, OUT)


def stream(df: DataFrame, **options) -> DataFrame:
    """The same over a streaming frame of (stream, pos, p); frames of a trigger are put in order of pos."""
    unknown = options.get("unknown", 1)

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        e, last, quiet = state.get if state.exists else ([], -1, 0)
        average, events = MarginAverage(state=list(e), **options), Transitions(unknown, last, quiet)
        part = pd.concat(list(parts)).sort_values("pos")
        rows = [average.step(p) for p in part["p"]]
        fired = [events.step(c) for c, _ in rows]
        state.update((average.e.tolist(), events.last, events.quiet))
        yield pd.DataFrame({"stream": part["stream"], "pos": part["pos"], "pred": [c for c, _ in rows], "confidence": [v for _, v in rows], "event": fired})

    grouped = df.select("stream", "pos", "p").groupBy("stream")
    return grouped.applyInPandasWithState(run, OUT, "e array<double>, last int, quiet int", "append", "NoTimeout")


def median3_stream(df: DataFrame) -> DataFrame:
    """(stream, pos, y): the first two samples pass, then the median of the last three."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        part = pd.concat(list(parts)).sort_values("pos")
        out = []
        for x in part["x"]:
            out.append(float(np.median([*held, x])) if len(held) == 2 else float(x))
            held = [*held, float(x)][-2:]
        state.update((held,))
        yield pd.DataFrame({"stream": part["stream"], "pos": part["pos"], "y": out})

    grouped = df.select("stream", "pos", "x").groupBy("stream")
    return grouped.applyInPandasWithState(run, "stream long, pos long, y double", "held array<double>", "append", "NoTimeout")
