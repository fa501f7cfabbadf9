"""Series preparation and features.

Every series is brought to a regular grid at its own frequency (T4 + T1 +
T3); after that a point's position is arithmetic - ``idx = (t - t0) / freq``
- so no operator needs a global row number over a series.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbitlens.functions.time import SEC, epoch_us, from_epoch_us
from orbitlens.operators.joins import is_small
from orbitlens.operators.resample import infer_frequency
from orbitlens.operators.stats import expand_gaps

# Fixed values of the preparation rules: lags of the position features must
# stay below 90 days; at most 2000 backtest fractions.
MAX_POS_LAG_SECONDS = 3600 * 24 * 30 * 3
MAX_FRAC = 2000


def _small_join(big: DataFrame, small: DataFrame, on, max_rows: int = 1_000_000) -> DataFrame:
    """Join a per-series table (one row per series).

    No hint and no eager size probe: the per-series side is the output of
    an aggregation, so adaptive execution knows its exact size once that
    stage has run and turns the join into a broadcast only when it is below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond that it stays
    a shuffle join.  (``max_rows`` is kept for callers; the bound is the
    engine's runtime check.)
    """
    from orbitlens.operators.windows import join_null_safe
    return join_null_safe(big, small, list(on) if not isinstance(on, str) else [on], how="inner")


def regular_series(df: DataFrame, keys: list[str], *, ts: str = "ts", value: str = "value",
                   freq=None, freq_table: DataFrame | None = None, block_us: int | None = 7 * 86_400_000_000) -> DataFrame:
    """T4 + T1 + T3 at each series' own frequency.

    Output: keys, ts, value, freq_s, idx (0-based grid position).  The
    frequency inference on raw points is tiled by ``block_us``; ``freq_table``
    (keys, freq_s) replaces it, for series whose model fixes the frequency.
    """
    fr = freq_table.select(*keys, "freq_s") if freq_table is not None else infer_frequency(df, keys, ts=ts, requested=freq, block_us=block_us)
    x = _small_join(df.filter(F.col(value).isNotNull()), fr, keys)
    step = F.col("freq_s") * SEC
    x = x.withColumn("_step", step).withColumn("_b", F.floor(epoch_us(ts) / step).cast("bigint") * step)
    firsts = x.groupBy(*keys, "freq_s", "_step", "_b").agg(F.min_by(F.col(value), F.col(ts)).alias(value))
    # freq_s/_step are constant per series: carried as keys of the gap expansion
    dense = expand_gaps(firsts, [*keys, "freq_s", "_step"], "_step", [value], fill_from_next=(value,), block=block_us)
    dense = _small_join(dense, firsts.groupBy(*keys).agg(F.min("_b").alias("_t0")), keys)
    idx = F.call_function("div", F.col("_b") - F.col("_t0"), F.col("_step"))
    return dense.select(*keys, from_epoch_us("_b").alias(ts), value, "freq_s", idx.alias("idx"))


def series_sizing(reg: DataFrame, keys: list[str]) -> DataFrame:
    """M1 sizing per series from its regular length n:
    borne = n/4, window = int(borne*0.2) (2 and no position lags below 2),
    lags_pos = [1,2,3]*window below 90 days, frac = min(2000, n/100),
    n_windows = max(2, int(0.6*frac))."""
    g = reg.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("freq_s").alias("freq_s"))
    borne = F.floor(F.col("n") / 4)
    w_raw = F.floor(borne * 2 / 10)
    g = g.withColumn("borne", borne.cast("bigint")).withColumn("_w", w_raw.cast("bigint"))
    window = F.when(F.col("_w") < 2, F.lit(2)).otherwise(F.col("_w")).cast("bigint")
    pos = F.when(F.col("_w") < 2, F.array().cast("array<bigint>")).otherwise(
        F.filter(F.array(*[F.col("_w") * k for k in (1, 2, 3)]),
                 lambda lag: lag < F.lit(MAX_POS_LAG_SECONDS) / F.col("freq_s")))
    frac = F.least(F.lit(MAX_FRAC), F.floor(F.col("n") / 100)).cast("bigint")
    g = g.withColumn("window_size", window).withColumn("lags_pos", pos).withColumn("frac", frac)
    g = g.withColumn("n_windows", F.greatest(F.lit(2), F.floor(F.col("frac") * 6 / 10)).cast("bigint"))
    return g.drop("_w")


def fourier_features(reg: DataFrame, season, *, idx: str = "idx") -> DataFrame:
    """``sin1_<season>``, ``cos1_<season>`` = sin/cos(2*pi*idx/season).

    ``season`` is an int or a column name (per-series season); the column
    names use the int when one is given, else ``sin1``/``cos1``.
    """
    s = F.lit(float(season)) if isinstance(season, (int, float)) else F.col(season).cast("double")
    suffix = f"_{int(season)}" if isinstance(season, (int, float)) else ""
    ang = F.lit(2 * math.pi) * F.col(idx) / s
    return reg.withColumn(f"sin1{suffix}", F.sin(ang)).withColumn(f"cos1{suffix}", F.cos(ang))


def autocorrelation(reg: DataFrame, keys: list[str], max_lag: int | None = None, *, value: str = "value",
                    idx: str = "idx", first_fraction: float = 1.0, block: int | None = None) -> DataFrame:
    """M2: ACF of each regular series for all its lags 0..n-1 (or up to ``max_lag``).

    acf_k = sum_i z_i z_(i+k) / sum_i z_i^2, z = value - mean (statsmodels' non-adjusted estimator), from the
    power spectrum of the padded series (``spectrum``: three shuffles of the series, n log n products).  A
    constant series has none.  ``first_fraction`` keeps the first part of every series (the lag search takes
    the first quarter); ``block`` is the number of points of one group.
    """
    from orbitlens.forecast import spectrum as SP
    blocks = SP.series_blocks(reg, keys, value=value, idx=idx, first_fraction=first_fraction)
    acf = SP.autocorrelation_of(blocks, keys, block or SP.BLOCK)
    if max_lag is not None:
        acf = acf.where(F.col("place") <= max_lag)
    return acf.select(*keys, F.col("place").alias("lag"), F.col("y").alias("acf"))


def periodogram(reg: DataFrame, keys: list[str], n_freq: int | None = None, *, value: str = "value",
                idx: str = "idx", first_fraction: float = 1.0, block: int | None = None) -> DataFrame:
    """M4 spectrum: |DFT_k| at all positive frequencies k = 1 .. (n-1)/2 of each regular series (or up to
    ``n_freq``), n the length after ``first_fraction``; see ``spectrum`` for the layout."""
    from orbitlens.forecast import spectrum as SP
    blocks = SP.series_blocks(reg, keys, value=value, idx=idx, first_fraction=first_fraction)
    spec = SP.spectrum_of(blocks, keys, block or SP.BLOCK)
    if n_freq is not None:
        spec = spec.where(F.col("place") <= n_freq)
    return spec.select(*keys, F.col("place").alias("k"), "n", F.col("y").alias("magnitude"))


def future_frame(reg: DataFrame, keys: list[str], horizon, *, ts: str = "ts",
                 value: str = "value") -> DataFrame:
    """``horizon`` future timestamps per series (int or per-series column)
    with target 0, appended to the history (U1)."""
    last = reg.groupBy(*keys).agg(F.max(ts).alias("_last"), F.first("freq_s").alias("freq_s"),
                                  F.max("idx").alias("_last_idx"))
    h = F.lit(int(horizon)) if isinstance(horizon, int) else F.col(horizon)
    fut = last.select(*keys, "_last", "freq_s", "_last_idx",
                      F.explode(F.sequence(F.lit(1), h.cast("int"))).alias("_i"))
    fut = fut.select(*keys, F.timestamp_add("SECOND", F.col("_i") * F.col("freq_s"), F.col("_last")).alias(ts),
                     F.lit(0.0).alias(value), "freq_s", (F.col("_last_idx") + F.col("_i")).alias("idx"))
    return reg.select(*keys, ts, value, "freq_s", "idx").unionByName(fut)


def restamp_index(reg: DataFrame, keys: list[str], *, ts: str = "ts", idx: str = "idx",
                  start: str = "2000-01-01 00:00:00") -> DataFrame:
    """Replace time by a synthetic regular grid from 2000-01-01."""
    base = F.lit(start).cast("timestamp_ntz")
    return reg.withColumn(ts, F.timestamp_add("SECOND", F.col(idx) * F.col("freq_s"), base))


def build_features(reg: DataFrame, keys: list[str], lags, *, window_lags=(), window_size: int = 2,
                   season: int | None = None, value: str = "value", idx: str = "idx",
                   exogenous: DataFrame | None = None, drop_missing: bool = True) -> DataFrame:
    """M7: lag columns (W4), lagged rolling means (W5), Fourier terms (X6) and
    exogenous columns (joined on series + ts); rows with missing lags dropped.

    On the regular grid a lag is the value ``k`` positions back, i.e. an
    equi-join on ``idx - k`` would do; one window pass computes all of them.
    """
    w = Window.partitionBy(*keys).orderBy(idx)
    x = reg.withColumns({f"lag{int(k)}": F.lag(value, int(k)).over(w) for k in lags})
    for lag in window_lags:
        fr = w.rowsBetween(-(lag + window_size - 1), -lag)
        x = x.withColumn(f"rolling_mean_lag{lag}_window_size{window_size}", F.avg(value).over(fr))
    if season:
        x = fourier_features(x, season, idx=idx)
    if exogenous is not None:
        from orbitlens.operators.windows import join_null_safe
        x = join_null_safe(x, exogenous, [*keys, "ts"])
    feats = [f"lag{int(k)}" for k in lags]
    return x.na.drop("any", subset=feats) if drop_missing and feats else x


def attach_static_features(feat: DataFrame, static: DataFrame, keys: list[str]) -> DataFrame:
    """Per-series constant columns (one row per series) joined to every
    row; they are model inputs but never part of the exogenous series read
    for the forecast horizon.  The planner broadcasts the per-series table
    when its size is below the threshold."""
    from orbitlens.operators.windows import join_null_safe
    return join_null_safe(feat, static, keys)


def horizon_lengths(registry: DataFrame) -> DataFrame:
    """Prediction length = min_lag * freq, history needed = max_lag * freq (seconds)."""
    return registry.withColumn("prediction_length_s", F.col("min_lag") * F.col("freq_s")) \
                   .withColumn("length_needed_s", F.col("max_lag") * F.col("freq_s"))
