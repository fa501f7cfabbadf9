"""ST4: the moving-average detector (D1) as a stateful streaming operator.

Per series the state holds the points of the last window W with their
residuals r = |x - m| - exactly what the shifted frames of the next points
need (their frames end at the previous point, so they reach back at most W
before the newest point).  Each micro-batch extends the state with the new
points of the series (in time order), scores them with the same frame rules
as the batch operator, emits them, and trims the state to W.  State is
bounded by the points of one window and one watermark delay per series;
series that stop sending are dropped by an event-time timeout.  A point that
arrives late but within the watermark is scored at its place in time, on the
points known by then; scores already emitted stay.  Only points behind the
watermark are dropped, by Spark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from orbitlens.functions.time import DAY, HOUR, MIN, SEC, duration_us, epoch_us, from_epoch_us
from orbitlens.streaming.telemetry import EVENT_TIME

#: units of a watermark text
DELAY_US = {"second": SEC, "minute": MIN, "hour": HOUR, "day": DAY}


def _frame_stats(t, x, rows, W, min_periods):
    """mean / sample std of the finite ``x`` in the frame of the row before each of ``rows``: rows before it in the order
    of ``t`` that lie after ``t[row - 1] - W``.  A frame is cut at the edge of a stretch of W, as ``operators.windows``
    does: the part of its last row's stretch and the end of the stretch before, both built up by running sums."""
    n = len(t)
    before = rows - 1
    first = np.searchsorted(t, t[np.maximum(before, 0)] - W, side="right")       # frame: first .. before
    ok = np.isfinite(x)
    stretch = np.floor_divide(t, W)
    starts = np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]])
    which = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
    head, tail = _running(x, ok, starts, False), _running(x, ok, starts, True)
    at = np.maximum(before, 0)
    cut = starts[which[at]] > first                                              # the frame begins in an earlier stretch
    n1, m1, q1 = (a[at] for a in head)
    n2, m2, q2 = (np.where(cut, a[np.minimum(first, n - 1)], 0.0) for a in tail)
    count = n1 + n2                                                              # a stretch is W long: its head is always in the frame
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = m1 + (m2 - m1) * n2 / count
        std = np.sqrt((q1 + q2 + (m1 - m2) ** 2 * n1 * n2 / count) / (count - 1))
    seen = (before >= 0) & (first <= before) & (count >= max(min_periods, 1))     # without a time: the smallest number, no frame
    return np.where(seen, mean, np.nan), np.where(seen & (count >= 2), std, np.nan)


def _running(x, ok, starts, backward):
    """Count, mean and sum of squared deviations of the finite values so far, from each stretch's edge on."""
    count, mean, square = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
    for a, b in zip(starts, np.r_[starts[1:], len(x)]):
        seg, fin = (x[a:b][::-1], ok[a:b][::-1]) if backward else (x[a:b], ok[a:b])
        k = np.cumsum(fin)
        centre = seg[fin][0] if fin.any() else 0.0
        d = np.where(fin, seg, centre) - centre
        dm = np.cumsum(d) / np.maximum(k, 1)
        # Welford's increments: a sum of terms that are never negative
        was = np.r_[0.0, dm[:-1]]
        q = np.cumsum(np.where(fin, (d - was) * (d - dm), 0.0))
        out = slice(a, b)
        count[out], mean[out], square[out] = (v[::-1] if backward else v for v in (k, centre + dm, q))
    return count, mean, square


def stateful_moving_average(stream: DataFrame, keys: list[str], *, window="30D", min_periods: int = 48,
                            sigma: float = 4.0, delta: float = 0.01, ts: str = "ts",
                            value: str = "value", watermark: str = "1 hour") -> DataFrame:
    """Streaming D1 on raw points; output columns as ``moving_average_anomaly``."""
    W = duration_us(window)
    number, unit = watermark.split()
    delay = int(DELAY_US[unit.rstrip("s")] * float(number))
    x = (stream.select(*keys, ts, value)
         .withColumn("_t", epoch_us(ts))
         .withColumn(EVENT_TIME, F.timestamp_micros(F.col("_t")))
         .withWatermark(EVENT_TIME, watermark))
    p = value
    out_schema = ", ".join([f"`{k}` string" for k in keys] +
                           ["_t bigint", f"`{p}_ma_anomaly_score` double", f"`{p}_ma_anomaly` double",
                            f"`{p}_ma_upper_bound` double", f"`{p}_ma_lower_bound` double"])
    state_schema = "t array<bigint>, v array<double>, r array<double>"

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        new = pd.concat(list(pdfs), ignore_index=True)
        if state.exists:
            st_t, st_v, st_r = state.get
            st_t, st_v, st_r = list(st_t), list(st_v), list(st_r)
        else:
            st_t, st_v, st_r = [], [], []
        new = new.sort_values("_t", kind="stable")
        nt = new["_t"].to_numpy(np.int64)
        nv = new[value].to_numpy(np.float64)
        t = np.concatenate([np.asarray(st_t, dtype=np.int64), nt])
        v = np.concatenate([np.asarray(st_v, dtype=np.float64), nv])
        r = np.concatenate([np.asarray(st_r, dtype=np.float64), np.full(len(nt), np.nan)])
        order = np.argsort(t, kind="stable")               # a new point comes after known ones of its time
        t, v, r = t[order], v[order], r[order]
        # a mean needs values only, a residual its own row's mean: all means, then all residual frames
        rows = np.flatnonzero(order >= len(st_t))
        m, _ = _frame_stats(t, v, rows, W, min_periods)
        r[rows] = np.abs(v[rows] - m)
        mr, sr = _frame_stats(t, r, rows, W, min_periods)
        score = ((r[rows] - mr - delta) / (sr + 1e-8)) / sigma
        up = sigma * (sr + 1e-8) + mr + m + delta
        lo = -sigma * (sr + 1e-8) - mr + m - delta
        anomaly = np.where(np.isfinite(score) & (score > 1), v[rows], np.nan)
        if len(t):
            keep = t > t[-1] - W - delay
            state.update((t[keep].tolist(), v[keep].tolist(), r[keep].tolist()))
            state.setTimeoutTimestamp(int(t[-1] // 1000) + (W + delay) // 1000)
        if len(rows):
            yield pd.DataFrame({**{k: [one] * len(rows) for k, one in zip(keys, key)}, "_t": t[rows], f"{p}_ma_anomaly_score": score,
                                f"{p}_ma_anomaly": anomaly, f"{p}_ma_upper_bound": up, f"{p}_ma_lower_bound": lo})

    res = x.groupBy(*keys).applyInPandasWithState(fn, out_schema, state_schema, "append",
                                                  GroupStateTimeout.EventTimeTimeout)
    cols = [f"{p}_ma_anomaly_score", f"{p}_ma_anomaly", f"{p}_ma_upper_bound", f"{p}_ma_lower_bound"]
    return res.select(*keys, from_epoch_us("_t").alias(ts), *cols)
