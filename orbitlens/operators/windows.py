"""Window operators.

Rolling statistics follow pandas time-based rolling: frame ``(t - W, t]``,
NULL while fewer than ``min_periods`` non-null values are in the frame, and
an optional ``shift(1)`` so a point is never part of its own baseline (the
shifted value of a row is the statistic of the *previous row's* frame).

Two physical layouts, same result:

* default: one shuffle by series; a shifted statistic is read by ``lag`` over
  the series.
* ``tile_us``: the series is cut into time blocks; each row is copied to the
  later blocks its frame still reaches, windows run per (series, block), only
  home rows are kept.  The shift across a block edge comes from a table with
  one row per (series, block) holding that block's last statistics.  A series
  holding a third of all rows is then spread over many tasks.

Both cut a frame at the edge of a block of length W: it is the part of its own
block up to t and the rows of the block before that lie after ``t - W``.  Either
part only grows along the block (forward in time the one, backward the other),
so a point costs the same however many points a frame holds, and parts are
added, never subtracted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbitlens.functions.time import duration_us, epoch_us

T = "_t"


def join_null_safe(x: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``on`` with null-safe equality (``<=>``).

    Used to join per-block summaries back to the rows they came from: a NULL
    tag value is a valid series key, and - unlike ``=`` - ``<=>`` makes the
    optimizer infer no ``isnotnull`` filters for the summary branch, so its
    exchange of the raw rows stays identical to the main branch's and is
    reused (one scan and one shuffle instead of two).
    """
    r = small.select(*[F.col(c).alias(f"_j_{c}") for c in on],
                     *[c for c in small.columns if c not in on])
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col(f"_j_{c}"))
        cond = e if cond is None else cond & e
    return x.join(r, cond, how).drop(*[f"_j_{c}" for c in on])


def with_epoch(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df if T in df.columns else df.withColumn(T, epoch_us(ts))


def _frame_copies(x: DataFrame, W: int, keep_untimed: bool) -> DataFrame:
    """Every row in its own block of length W (``_blk = _home``) and, moved on by W, in the next one if a frame there
    reaches it.  ``_u`` orders a block: a copy is in the frame of the block's rows with a smaller ``_u``."""
    x = x.withColumn("_home", F.floor(F.col(T) / F.lit(W)).cast("bigint"))
    reach = F.floor((F.col(T) + F.lit(W - 1)) / F.lit(W)).cast("bigint")
    each = F.explode_outer if keep_untimed else F.explode
    x = x.withColumn("_blk", each(F.sequence(F.col("_home"), reach)))
    return x.withColumn("_u", F.col(T) + F.when(F.col("_blk") > F.col("_home"), F.lit(W)).otherwise(F.lit(0)))


def _frame_stats(x: DataFrame, keys: list[str], col: str, min_periods: int, names, stats) -> DataFrame:
    """Adds ``_raw_{name}``: statistics of the frame ``(t - W, t]`` of ``_frame_copies``, home rows only."""
    part = [*keys, "_blk"]
    sides = {"1": (Window.partitionBy(*part).orderBy("_u").rangeBetween(Window.unboundedPreceding, 0),
                   F.when(F.col("_blk").eqNullSafe(F.col("_home")), F.col(col))),
             "2": (Window.partitionBy(*part).orderBy(F.col("_u").desc()).rangeBetween(Window.unboundedPreceding, -1),
                   F.when(F.col("_blk") > F.col("_home"), F.col(col)))}
    aggs = {"_n": F.count}
    if {"mean", "std", "sum"} & set(stats):
        aggs["_s"] = F.sum
    if "std" in stats:
        aggs |= {"_m": F.avg, "_v": F.var_pop}
    if {"std", "min"} & set(stats):
        aggs["_lo"] = F.min
    if {"std", "max"} & set(stats):
        aggs["_hi"] = F.max
    x = x.withColumns({f"{a}{i}": f(v).over(w) for i, (w, v) in sides.items() for a, f in aggs.items()})
    x = x.filter(F.col("_blk").eqNullSafe(F.col("_home")))
    n = F.col("_n1") + F.col("_n2")
    total = F.coalesce("_s1", F.lit(0)) + F.coalesce("_s2", F.lit(0))
    apart = F.coalesce(F.col("_m1") - F.col("_m2"), F.lit(0.0))
    squares = (F.coalesce(F.col("_v1") * F.col("_n1"), F.lit(0.0)) + F.coalesce(F.col("_v2") * F.col("_n2"), F.lit(0.0))
               + apart * apart * F.col("_n1") * F.col("_n2") / n)
    least, most = F.least("_lo1", "_lo2"), F.greatest("_hi1", "_hi2")
    out = {}
    for name, s in zip(names, stats):
        if s == "mean":
            e = F.when(n > 0, total / n)
        elif s == "std":                                     # a flat frame's is exactly 0
            e = F.when(n >= 2, F.when((least == most) & ~F.isnan(least), F.lit(0.0)).otherwise(F.sqrt(squares / (n - 1))))
        elif s == "sum":
            e = F.when(n > 0, total)
        elif s == "count":
            e = n.cast("double")
        elif s == "min":
            e = least
        elif s == "max":
            e = most
        else:
            raise ValueError(s)
        out[f"_raw_{name}"] = F.when(n >= F.lit(min_periods), e)
    return x.withColumns(out).drop("_home", "_u", *[f"{a}{i}" for i in sides for a in aggs])


def _sums_prepare(x: DataFrame, part: list[str], col: str) -> DataFrame:
    """Columns the running-sum path needs: a per-partition centre, the centred
    value, and a 'value changes at the next row' flag for exact flat frames."""
    wp = Window.partitionBy(*part)
    wl = Window.partitionBy(*part).orderBy(T)
    x = x.withColumn("_c", F.min(col).over(wp))  # any value of the partition; min is deterministic
    x = x.withColumn("_xc", F.col(col) - F.col("_c"))
    nxt = F.lead(col).over(wl)
    return x.withColumn("_nc", F.when(nxt.isNull() & F.lead(T).over(wl).isNull(), F.lit(0))
                        .when(F.col(col).eqNullSafe(nxt), F.lit(0)).otherwise(F.lit(1)))


def _sums_exprs(part: list[str], col: str, W: int, min_periods: int, stats):
    """Frame (t - W, t] statistics as differences of two growing frames:
    ``(-inf, t]`` minus ``(-inf, t - W]``.  Spark evaluates growing frames
    incrementally, so this is O(rows) instead of O(rows x rows-in-frame).
    A frame is flat when no value changes inside it (prefix count of changes);
    its std is then exactly 0, as pandas reports."""
    wu = Window.partitionBy(*part).orderBy(T).rangeBetween(Window.unboundedPreceding, 0)
    wb = Window.partitionBy(*part).orderBy(T).rangeBetween(Window.unboundedPreceding, -W)

    def frame(agg):
        return agg.over(wu) - F.coalesce(agg.over(wb), F.lit(0))

    n = frame(F.count(col))
    s1 = frame(F.sum("_xc"))
    s2 = frame(F.sum(F.col("_xc") * F.col("_xc")))
    changes = frame(F.sum("_nc")) - F.col("_nc")
    out = {}
    for s in stats:
        if s == "mean":
            e = F.col("_c") + s1 / n
        elif s == "std":
            var = (s2 - s1 * s1 / n) / (n - 1)
            e = F.when(n < 2, F.lit(None)).when(changes == 0, F.lit(0.0)) \
                 .otherwise(F.sqrt(F.greatest(var, F.lit(0.0))))
        elif s == "sum":
            e = F.col("_c") * n + s1
        elif s == "count":
            e = n.cast("double")
        else:
            raise ValueError(f"{s} needs method='frame'")
        out[s] = F.when(n >= F.lit(max(min_periods, 1)), e)
    return out


def rolling_stats(df: DataFrame, keys: list[str], col: str, window, *, min_periods: int = 1,
                  shift: int = 0, stats=("mean", "std"), ts: str = "ts",
                  prefix: str | None = None, tile_us: int | None = None,
                  method: str = "frame") -> DataFrame:
    """Time-based rolling statistics of ``col`` per series.

    Adds ``{prefix}_{stat}`` columns (prefix defaults to ``col``).  ``shift``
    is 0 or 1 (pandas ``.shift(1)`` after the rolling call).

    ``method="frame"`` (default) puts a frame together from two parts that
    only grow (see above): O(rows), no differences, exact zero std on flat
    frames.  ``method="sums"`` takes differences of running sums, O(rows),
    with centred values (float error far below the 4th decimal for telemetry
    magnitudes) and exact zero std on flat frames; it copies fewer rows and
    covers mean, std, sum, count.
    """
    if shift not in (0, 1):
        raise ValueError("shift must be 0 or 1")
    W = duration_us(window)
    prefix = prefix or col
    x = with_epoch(df, ts)
    names = [f"{prefix}_{s}" for s in stats]
    if not tile_us:
        wl = Window.partitionBy(*keys).orderBy(T)
        if method == "sums":
            x = _sums_prepare(x, keys, col)
            ex = _sums_exprs(keys, col, W, min_periods, stats)
            x = x.withColumns({f"_raw_{n}": ex[s] for n, s in zip(names, stats)}).drop("_c", "_xc", "_nc")
        else:
            if shift:
                # rows lie by series from here on, which blocks of a series need not shuffle again
                x = x.withColumn("_pos", F.row_number().over(wl))
                wl = Window.partitionBy(*keys).orderBy("_pos")
            x = _frame_stats(_frame_copies(x, W, True), keys, col, min_periods, names, stats).drop("_blk")
        if shift:
            x = x.withColumns({n: F.lag(f"_raw_{n}").over(wl) for n in names})
        else:
            x = x.withColumns({n: F.col(f"_raw_{n}") for n in names})
        return x.drop("_pos", *[f"_raw_{n}" for n in names])
    return _rolling_tiled(x, keys, col, W, max(int(tile_us), W), min_periods, shift, stats, names, method)


def _rolling_tiled(x, keys, col, W, B, min_periods, shift, stats, names, method="frame"):
    if method == "sums":
        home = F.floor(F.col(T) / F.lit(B)).cast("bigint")
        reach = F.floor((F.col(T) + F.lit(W - 1)) / F.lit(B)).cast("bigint")
        x = (x.withColumn("_home", home)
             .withColumn("_blk", F.explode(F.sequence(F.col("_home"), reach))))
        x = _sums_prepare(x, [*keys, "_blk"], col)
        ex = _sums_exprs([*keys, "_blk"], col, W, min_periods, stats)
        x = x.withColumns({f"_raw_{n}": ex[s] for n, s in zip(names, stats)}).drop("_c", "_xc", "_nc")
        x = x.filter(F.col("_blk") == F.col("_home")).drop("_home")
    else:                                                    # blocks of length W, whatever the tile
        x = _frame_stats(_frame_copies(x, W, False), keys, col, min_periods, names, stats)
    raw = [f"_raw_{n}" for n in names]
    if not shift:
        return x.withColumns({n: F.col(r) for n, r in zip(names, raw)}).drop(*raw, "_blk")
    wl = Window.partitionBy(*keys, "_blk").orderBy(T)
    # last row statistics of every non-empty block -> carried to the next one.
    # The struct takes every column so that this branch prunes nothing: its
    # exchange of the replicated rows is then identical to the main branch's
    # and Spark reuses it (one scan, one shuffle of the raw rows).
    last = (x.groupBy(*keys, "_blk")
            .agg(F.max_by(F.struct(*[F.col(c) for c in x.columns]), F.col(T)).alias("_last")))
    last = last.select(*keys, "_blk", F.struct(*[F.col(f"_last.{r}").alias(r) for r in raw]).alias("_last"))
    x = x.withColumns({f"_lag_{n}": F.lag(r).over(wl) for n, r in zip(names, raw)}) \
         .withColumn("_first_in_blk", F.lag(T).over(wl).isNull())
    wb = Window.partitionBy(*keys).orderBy("_blk")
    carry = last.select(*keys, "_blk", F.lag("_last").over(wb).alias("_carry"))
    x = join_null_safe(x, carry, [*keys, "_blk"])
    x = x.withColumns({n: F.when(F.col("_first_in_blk"), F.col(f"_carry.{r}")).otherwise(F.col(f"_lag_{n}"))
                       for n, r in zip(names, raw)})
    return x.drop(*raw, *[f"_lag_{n}" for n in names], "_first_in_blk", "_carry", "_blk")


def rolling_zscore(df: DataFrame, keys: list[str], col: str, window, *, sigma: float = 3.0,
                   min_periods: int = 5, ts: str = "ts", tile_us: int | None = None,
                   out: str | None = None, method: str = "frame") -> DataFrame:
    """``((s - mean_prev) / (std_prev + 1e-8)) / sigma``; rows without a score dropped."""
    out = out or col
    x = rolling_stats(df, keys, col, window, min_periods=min_periods, shift=1,
                      stats=("mean", "std"), ts=ts, prefix="_z", tile_us=tile_us, method=method)
    z = ((F.col(col) - F.col("_z_mean")) / (F.col("_z_std") + F.lit(1e-8))) / F.lit(float(sigma))
    return x.withColumn(out, z).filter(F.col(out).isNotNull()).drop("_z_mean", "_z_std", T)


def lag_features(df: DataFrame, keys: list[str], col: str, lags, *, ts: str = "ts",
                 prefix: str = "lag") -> DataFrame:
    """``lag{k}`` columns for every k in ``lags`` (one window pass)."""
    w = Window.partitionBy(*keys).orderBy(ts)
    return df.withColumns({f"{prefix}{int(k)}": F.lag(col, int(k)).over(w) for k in lags})


def lagged_rolling_mean(df: DataFrame, keys: list[str], col: str, lag: int, window_size: int,
                        *, ts: str = "ts", out: str | None = None) -> DataFrame:
    """Mean of ``window_size`` values ending ``lag`` rows back, min 1 sample."""
    out = out or f"rolling_mean_lag{lag}_window_size{window_size}"
    w = Window.partitionBy(*keys).orderBy(ts).rowsBetween(-(lag + window_size - 1), -lag)
    return df.withColumn(out, F.avg(col).over(w))


def previous_row(df: DataFrame, keys: list[str], cols: list[str], *, ts: str = "ts",
                 block_us: int | None = None, prefix: str = "prev_") -> DataFrame:
    """Value(s) of the previous row of the series (``lag(…, 1)``), optionally tiled.

    With ``block_us`` the lag runs inside (series, time block) partitions and
    the first row of a block takes the last row of the previous non-empty
    block from a one-row-per-block table - no task ever holds a whole series.
    """
    if not block_us:
        w = Window.partitionBy(*keys).orderBy(ts)
        return df.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in cols})
    x = df.withColumn("_pblk", F.floor(epoch_us(ts) / F.lit(block_us)).cast("bigint"))
    w = Window.partitionBy(*keys, "_pblk").orderBy(ts)
    x = x.withColumns({f"_lag_{c}": F.lag(c).over(w) for c in cols}) \
         .withColumn("_pfirst", F.row_number().over(w) == 1)
    last = x.groupBy(*keys, "_pblk").agg(F.max_by(F.struct(*[F.col(c) for c in x.columns]), F.col(ts)).alias("_plast"))
    last = last.select(*keys, "_pblk", F.struct(*[F.col(f"_plast.{c}").alias(c) for c in cols]).alias("_plast"))
    carry = last.select(*keys, "_pblk", F.lag("_plast").over(Window.partitionBy(*keys).orderBy("_pblk")).alias("_pcarry"))
    x = join_null_safe(x, carry, [*keys, "_pblk"])
    x = x.withColumns({f"{prefix}{c}": F.when(F.col("_pfirst"), F.col(f"_pcarry.{c}")).otherwise(F.col(f"_lag_{c}"))
                       for c in cols})
    return x.drop("_pblk", "_pfirst", "_pcarry", *[f"_lag_{c}" for c in cols])


def next_row(df: DataFrame, keys: list[str], cols: list[str], *, order: str, block: int, prefix: str = "next_") -> DataFrame:
    """Value(s) of the next row of the series in blocks of ``block`` units of the integer column ``order``.

    ``lead`` runs inside (series, block); the last row of a block takes the first row of the next non-empty
    block from a one-row-per-block table, so no task holds a whole series."""
    x = df.withColumn("_nblk", F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    w = Window.partitionBy(*keys, "_nblk").orderBy(order)
    x = x.withColumns({f"_lead_{c}": F.lead(c).over(w) for c in cols}).withColumn("_nlast", F.lead(order).over(w).isNull())
    first = x.groupBy(*keys, "_nblk").agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("_nfirst"))
    carry = first.select(*keys, "_nblk", F.lead("_nfirst").over(Window.partitionBy(*keys).orderBy("_nblk")).alias("_ncarry"))
    x = join_null_safe(x, carry, [*keys, "_nblk"])
    x = x.withColumns({f"{prefix}{c}": F.when(F.col("_nlast"), F.col(f"_ncarry.{c}")).otherwise(F.col(f"_lead_{c}")) for c in cols})
    return x.drop("_nblk", "_nlast", "_ncarry", *[f"_lead_{c}" for c in cols])


def diff(df: DataFrame, keys: list[str], col: str, *, ts: str = "ts", out: str | None = None,
         block_us: int | None = None) -> DataFrame:
    """Step to the previous row (tiled with ``block_us``)."""
    x = previous_row(df, keys, [col], ts=ts, block_us=block_us, prefix="_prev_")
    return x.withColumn(out or f"{col}_diff", F.col(col) - F.col(f"_prev_{col}")).drop(f"_prev_{col}")


def regular_smoothed_diff(reg: DataFrame, keys: list[str], col: str = "value", *, frac: float = 0.02, idx: str = "idx",
                          out: str | None = None) -> DataFrame:
    """W6 on a regular series (0-based ``idx``, no nulls), without a window over a series.

    The step of a rolling mean over k points is ``(x[i] - x[i-k]) / k``: one equi-join on the position; the first k
    points take the first step there is."""
    out = out or f"{col}_smoothed_diff"
    n = reg.groupBy(*keys).agg(F.greatest(F.floor(F.count(F.lit(1)) * F.lit(frac)), F.lit(1)).cast("bigint").alias("_k"))
    x = join_null_safe(reg, n, keys, "inner")
    back = x.select(*keys, (F.col(idx) + F.col("_k")).alias(idx), F.col(col).alias("_back"))
    x = join_null_safe(x, back, [*keys, idx])
    step = (F.col(col) - F.col("_back")) / F.col("_k")
    first = x.where(F.col(idx) == F.col("_k")).select(*keys, step.alias("_first"))
    x = join_null_safe(x, first, keys)
    return x.withColumn(out, F.coalesce(step, F.col("_first"))).drop("_k", "_back", "_first")


def smoothed_diff(df: DataFrame, keys: list[str], col: str, *, frac: float = 0.02,
                  ts: str = "ts", out: str | None = None) -> DataFrame:
    """Row rolling mean over ``int(frac * n)`` rows (n = series length),
    first difference, then back fill.

    The rolling length differs per series, so the frame is expressed as a
    running-sum difference: sum over the last k rows = S(i) - S(i-k), with
    S the running sum and ``S(i-k)`` read by ``lag`` with a per-row offset -
    emulated by a self join on the row index (all equi-joins, no per-series
    Python).  pandas ``rolling(k)`` needs k full rows (min_periods = k).
    """
    out = out or f"{col}_smoothed_diff"
    w = Window.partitionBy(*keys).orderBy(ts)
    x = (df.withColumn("_i", F.row_number().over(w))
         .withColumn("_S", F.sum(col).over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))))
    x = x.withColumn("_k", F.greatest(F.floor(F.col("_n") * F.lit(frac)), F.lit(1)).cast("bigint"))
    ref = x.select(*keys, (F.col("_i") + F.col("_k")).alias("_i"), F.col("_S").alias("_S_back"))
    x = join_null_safe(x, ref, [*keys, "_i"])
    kk = F.col("_k")
    mean_k = F.when(F.col("_i") == kk, F.col("_S") / kk) \
              .when(F.col("_i") > kk, (F.col("_S") - F.col("_S_back")) / kk)
    x = x.withColumn("_m", mean_k)
    x = x.withColumn(out, F.col("_m") - F.lag("_m").over(w))
    x = fill_back(x, keys, out, ts=ts)
    return x.drop("_i", "_S", "_n", "_k", "_S_back", "_m")


def fill_back(df: DataFrame, keys: list[str], col: str, *, ts: str = "ts") -> DataFrame:
    # growing frame over descending time (incremental), not (current, unbounded following)
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(w))
