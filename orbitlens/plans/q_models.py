"""Registered queries: detectors and models without an SQL form (rows-only
check by the driver; properties are pinned in tests/)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlens.functions.output import round_doubles
from orbitlens.operators.forest import isolation_forest_anomaly
from orbitlens.operators.stats import drop_open_bucket
from orbitlens.plans import pipelines as P
from orbitlens.plans.catalog import KEYS, hourly_stats, register, tele
from orbitlens.plans.q_basic import NOW, derived_marks


@register("isolation_forest_hourly")
def q_isolation_forest_hourly(spark, sf_dir):
    """P5 second branch: closed hourly statistics -> D3 with one forest over all
    ten statistics as features (rows with a NULL statistic dropped), 3 D
    window, min 1; the score is named after the first column."""
    from orbitlens.operators.stats import STAT_NAMES
    st = drop_open_bucket(hourly_stats(spark, sf_dir), KEYS) \
        .withColumn("count", F.col("count").cast("double"))
    r = isolation_forest_anomaly(st, KEYS, STAT_NAMES, window="3D", min_periods=1, ts="bucket_end",
                                 base_name="stats", materialize_input=True)
    return round_doubles(r)


@register("isolation_forest_pipeline")
def q_isolation_forest_pipeline(spark, sf_dir):
    """Read with a 6-day lookback -> D3 on raw points (3 D window, min 1) -> rows after the mark."""
    r = P.isolation_forest_job(tele(spark, sf_dir), derived_marks(spark, sf_dir, "isolation_forest", "iso"),
                               KEYS, NOW)
    return round_doubles(r)


# ---------------------------------------------------------------- forecasting
from orbitlens.forecast import features as FT  # noqa: E402
from orbitlens.forecast import lagmodel as LM  # noqa: E402
from orbitlens.forecast import models as MD  # noqa: E402
from orbitlens.forecast import seasonality as SE  # noqa: E402
from orbitlens.functions.output import q_sql  # noqa: E402
from orbitlens.operators.windows import join_null_safe  # noqa: E402
from orbitlens.plans import lagsql as L  # noqa: E402
from orbitlens.plans import sqlparts as S  # noqa: E402
from orbitlens.plans.q_forecast import PK, REG_SQL, reg_of  # noqa: E402


REC = f"WITH RECURSIVE {S.TELE}, {REG_SQL}"


def _lag_text(c: str = "lags"):
    return F.array_join(F.transform(c, lambda v: v.cast("string")), ",")


@register("acf_peaks", sql=f"WITH {S.TELE}, {REG_SQL}, {L.QUARTER_SQL}, {L.ACF_SQL} SELECT metric, satellite, lag, rank FROM acf_lags")
def q_acf_peaks(spark, sf_dir):
    """M3 + L2: the search for lags, five prominent peaks among all lags of every series' first quarter."""
    acf = FT.autocorrelation(reg_of(spark, sf_dir), KEYS, first_fraction=0.25)
    return SE.acf_peak_lags(acf, KEYS, nlags=5)


@register("fft_periods", sql=f"""{REC}, {L.QUARTER_SQL}, {L.FFT_SQL} SELECT metric, satellite, lag, round FROM fft_lags""")
def q_fft_periods(spark, sf_dir):
    """M4 + M5: spectral periods of the first quarter, four rounds with the zero-phase filter between them."""
    return SE.fft_period_lags(_reg_materialized(spark, sf_dir), KEYS)


@register("select_lags", sql=f"""{REC}, {L.QUARTER_SQL}, {L.ACF_SQL}, {L.FFT_SQL}, {L.SIZING_SQL}, {L.SELECT_SQL}
SELECT metric, satellite, freq_s, window_size, min_lag, max_lag, array_to_string(lags, ',') AS lags FROM chosen""")
def q_select_lags(spark, sf_dir):
    """M6 + U2: lag set per series from ACF and FFT candidates and the sizing rule."""
    sel = P.lag_search(_reg_materialized(spark, sf_dir), KEYS)
    return sel.select(*KEYS, "freq_s", "window_size", "min_lag", "max_lag", _lag_text().alias("lags"))


@register("season", sql=f"""WITH {S.TELE}, {REG_SQL}, {L.SEASON_SQL} SELECT metric, satellite, season FROM season""")
def q_season(spark, sf_dir):
    """M1: season of every whole series from the autocorrelation of its smoothed difference."""
    return P.season_search(_reg_materialized(spark, sf_dir), KEYS)


def _three_lags(reg):
    """Lags 11, 24 and 30 + the satellite's number, a horizon of 6 and 5 backtest windows: a plan whose solution SQL can write out."""
    own = reg.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("center"), F.min(LM.grid_number()).alias("a0"))
    lags = F.array(F.lit(11), F.lit(24), 30 + F.substring("satellite", 4, 10).cast("int")).cast("array<long>")
    return own.select(*KEYS, "n", "a0", "center", lags.alias("lags"), F.array().cast("array<long>").alias("lags_pos"), F.lit(2).cast("long").alias("window_size"),
                      F.lit(1).cast("long").alias("season"), F.lit(6).cast("long").alias("h"), F.lit(5).cast("long").alias("windows")).where("n > 100")


def _three(prefix: str, src: str, group: str, where: str = "true") -> str:
    """CTE ``{prefix}`` (b0 .. b3): least squares on x1, x2, x3 from centred moments, by determinants."""
    return f"""
{prefix}_m AS (SELECT {group}, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, var_pop(x1) AS a, covar_pop(x1, x2) AS b, covar_pop(x1, x3) AS c,
  var_pop(x2) AS d, covar_pop(x2, x3) AS e, var_pop(x3) AS f, covar_pop(x1, y) AS p, covar_pop(x2, y) AS q, covar_pop(x3, y) AS r FROM {src} WHERE {where} GROUP BY ALL),
{prefix}_d AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM {prefix}_m),
{prefix}_c AS (SELECT *, (p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / det AS b1,
  (a * (q * f - e * r) - p * (b * f - c * e) + c * (b * r - c * q)) / det AS b2,
  (a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - c * d)) / det AS b3 FROM {prefix}_d),
{prefix} AS MATERIALIZED (SELECT *, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0 FROM {prefix}_c)"""


THREE_SQL = f"""
ct AS (SELECT metric, satellite, count(*) AS n, avg(value) AS center, 30 + substr(satellite, 4)::BIGINT AS far, max(idx) AS li, max(ts) AS lt, max(freq_s) AS fs
       FROM reg GROUP BY ALL HAVING count(*) > 100),
cv AS MATERIALIZED (SELECT r.metric, r.satellite, r.idx, r.value - ct.center AS y FROM reg r JOIN ct ON {L.same('ct', 'r')}),
la AS (SELECT *, lag(y, 11) OVER ({PK} ORDER BY idx) AS x1, lag(y, 24) OVER ({PK} ORDER BY idx) AS x2 FROM cv),
fx AS MATERIALIZED (SELECT l.*, b.y AS x3, ct.n, (l.idx - (ct.n - 30)) // 6 AS win, (l.idx - (ct.n - 30)) % 6 + 1 AS step
       FROM la l JOIN ct ON {L.same('ct', 'l')} JOIN cv b ON {L.same('b', 'l')} AND b.idx = l.idx - ct.far),
{_three('whole', 'fx', 'metric, satellite')},
upto AS (SELECT f.*, w.w FROM fx f JOIN (SELECT range AS w FROM range(0, 5)) w ON f.idx < f.n - 30 + 6 * w.w),
{_three('past', 'upto', 'metric, satellite, w')},
miss AS (SELECT f.metric, f.satellite, f.step, quantile_cont(abs(f.y - (b0 + b1 * x1 + b2 * x2 + b3 * x3)), 0.99) AS q
         FROM fx f JOIN past p ON {L.same('p', 'f')} AND p.w = f.win WHERE f.idx >= f.n - 30 GROUP BY ALL),
band AS MATERIALIZED (SELECT metric, satellite, step, max(q) OVER ({PK} ORDER BY step) AS q FROM miss)"""


@register("lag_models", sql=f"""WITH {S.TELE}, {REG_SQL}, {THREE_SQL}
SELECT w.metric, w.satellite, 'lag11,lag24,lag' || ct.far AS features, {q_sql('b0')} AS b0, {q_sql('b1')} AS b1, {q_sql('b2')} AS b2, {q_sql('b3')} AS b3,
       b.step, {q_sql('b.q')} AS band FROM whole w JOIN ct ON {L.same('ct', 'w')} JOIN band b ON {L.same('b', 'w')}""")
def q_lag_models(spark, sf_dir):
    """M9 + M11: one fit of all series, each on its own lags, with rolling-origin bands per step."""
    reg = _reg_materialized(spark, sf_dir)
    m = LM.fit_lagged(reg, _three_lags(reg), KEYS)
    return round_doubles(m.select(*KEYS, F.array_join("features", ",").alias("features"), *[F.col("coef")[i].alias(f"b{i}") for i in range(4)],
                                  F.posexplode("bands").alias("step", "band")).withColumn("step", (F.col("step") + 1).cast("long")))


def _step_sql(i: int) -> str:
    """Steps of block ``i`` of eleven from what the blocks before it know."""
    old = "k0" if i == 1 else f"k{i - 1}"
    return f"""
k{i} AS MATERIALIZED (SELECT * FROM {old} UNION ALL
  SELECT w.metric, w.satellite, w.step, any_value(b0) + any_value(b1) * max(p.y) FILTER (p.step = w.step - 11) + any_value(b2) * max(p.y) FILTER (p.step = w.step - 24)
         + any_value(b3) * max(p.y) FILTER (p.step = w.step - far)
  FROM (SELECT w.*, ct.far, unnest(range({11 * i - 10}, {min(11 * i, 24) + 1})) AS step FROM whole w JOIN ct ON {L.same('ct', 'w')}) w
  JOIN {old} p ON {L.same('p', 'w')} GROUP BY w.metric, w.satellite, w.step)"""


@register("lag_forecast", sql=f"""WITH {S.TELE}, {REG_SQL}, {THREE_SQL},
k0 AS MATERIALIZED (SELECT cv.metric, cv.satellite, cv.idx - ct.li AS step, y FROM cv JOIN ct ON {L.same('ct', 'cv')} WHERE cv.idx > ct.li - 40),
{",".join(_step_sql(i) for i in (1, 2, 3))}
SELECT k.metric, k.satellite, k.step, make_timestamp(epoch_us(ct.lt) + k.step * ct.fs * 1000000) AS ts, {q_sql('k.y + ct.center')} AS yhat,
       {q_sql('k.y + ct.center - b.q')} AS lo, {q_sql('k.y + ct.center + b.q')} AS hi
FROM k3 k JOIN ct ON {L.same('ct', 'k')} JOIN band b ON {L.same('b', 'k')} AND b.step = least(k.step, 6) WHERE k.step > 0""")
def q_lag_forecast(spark, sf_dir):
    """24 steps from the models of ``lag_models``, in blocks of the smallest lag, with their bands."""
    reg = _reg_materialized(spark, sf_dir)
    models = LM.fit_lagged(reg, _three_lags(reg), KEYS).checkpoint()
    return round_doubles(LM.forecast_lagged(reg, models, KEYS, 24))


@register("linear_trend", sql=f"""
WITH {S.TELE}, {REG_SQL}
SELECT metric, satellite, {q_sql('regr_slope(value, idx::DOUBLE)')} AS slope,
       {q_sql('regr_intercept(value, idx::DOUBLE)')} AS intercept FROM reg GROUP BY ALL
""")
def q_linear_trend(spark, sf_dir):
    return round_doubles(MD.linear_trend(reg_of(spark, sf_dir), KEYS))


def _trend_residuals(spark, sf_dir, h=12, windows=5):
    reg = reg_of(spark, sf_dir)
    tr = MD.linear_trend(reg, KEYS)
    n = reg.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    x = join_null_safe(join_null_safe(reg, tr, KEYS, "inner"), n, KEYS, "inner").filter(F.col("idx") >= F.col("_n") - h * windows)
    return x.select(*KEYS, ((F.col("idx") - (F.col("_n") - h * windows)) % h + 1).alias("step"),
                    (F.col("value") - (F.col("intercept") + F.col("slope") * F.col("idx"))).alias("residual"))


@register("conformal_interval", sql=f"""
WITH {S.TELE}, {REG_SQL},
tr AS (SELECT metric, satellite, regr_slope(value, idx::DOUBLE) AS b, regr_intercept(value, idx::DOUBLE) AS a,
              count(*) AS n FROM reg GROUP BY ALL),
r AS (SELECT g.metric, g.satellite, (g.idx - (tr.n - 60)) % 12 + 1 AS step, g.value - (tr.a + tr.b * g.idx) AS residual
      FROM reg g JOIN tr ON g.metric = tr.metric AND g.satellite = tr.satellite WHERE g.idx >= tr.n - 60)
SELECT metric, satellite, step, {q_sql('quantile_cont(abs(residual), 0.99)')} AS q FROM r GROUP BY ALL
""")
def q_conformal_interval(spark, sf_dir):
    return round_doubles(MD.conformal_quantiles(_trend_residuals(spark, sf_dir), KEYS))


def derived_registry(spark, sf_dir):
    """A model registry derived from the data: three model versions per series
    dated on its first three days."""
    ft = tele(spark, sf_dir).groupBy(*KEYS).agg(F.to_date(F.min("ts")).alias("d0"))
    x = ft.select(*KEYS, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("v"), "d0")
    return x.select(F.col("metric").alias("target"), F.lit("").alias("exogenous"), "satellite",
                    F.date_add("d0", F.col("v")).alias("date"),
                    F.concat_ws("/", F.lit("models"), "metric", "satellite", F.col("v").cast("string")).alias("path"),
                    (F.lit(600) * (F.col("v") + 1)).alias("freq_s"), (F.col("v") + 6).alias("min_lag"),
                    (F.col("v") * 10 + 24).alias("max_lag"))


REGISTRY_SQL = f"""{S.TELE},
d AS (SELECT metric, satellite, CAST(min(ts) AS DATE) AS d0 FROM tele GROUP BY ALL),
reg0 AS (SELECT metric AS target, '' AS exogenous, satellite, CAST(d0 + v AS DATE) AS date,
         'models/' || metric || '/' || satellite || '/' || CAST(v AS VARCHAR) AS path,
         600 * (v + 1) AS freq_s, v + 6 AS min_lag, v * 10 + 24 AS max_lag
         FROM d CROSS JOIN (SELECT unnest([0, 1, 2]) AS v) r)"""


@register("model_registry_lookup", sql=f"""
WITH {REGISTRY_SQL}
SELECT target, exogenous, satellite, arg_max(path, date) AS path, CAST(max(date) AS TIMESTAMP) AS date FROM reg0 GROUP BY ALL
""")
def q_model_registry_lookup(spark, sf_dir):
    r = MD.lookup_models(derived_registry(spark, sf_dir), ["target", "exogenous", "satellite"])
    return r.withColumn("date", F.col("date").cast("timestamp_ntz"))


LAGS = [12, 24]


def _reg_materialized(spark, sf_dir):
    """The regular series feeds features, fit, forecast tail and residuals:
    written once with a reliable checkpoint instead of recomputed per use."""
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(spark)
    return reg_of(spark, sf_dir).checkpoint()


def _linear_fc(spark, sf_dir, horizon=36):
    reg = _reg_materialized(spark, sf_dir)
    feats = FT.build_features(reg, KEYS, LAGS)
    cols = [f"lag{k}" for k in LAGS]
    coefs = MD.fit_linear(feats, KEYS, cols)
    fc = MD.forecast_recursive(reg, KEYS, LAGS, horizon,
                               lambda f: MD.predict_linear(f, coefs, KEYS, cols))
    res = MD.predict_linear(feats, coefs, KEYS, cols)
    n = res.groupBy(*KEYS).agg(F.max("idx").alias("_mx"))
    res = join_null_safe(res, n, KEYS, "inner").filter(F.col("idx") > F.col("_mx") - 60) \
             .select(*KEYS, ((F.col("_mx") - F.col("idx")) % 12 + 1).alias("_s"),
                     (F.col("value") - F.col("yhat")).alias("residual"))
    q = MD.conformal_quantiles(res.withColumnRenamed("_s", "step"), KEYS)
    fc = fc.withColumn("step", (F.col("step") - 1) % 12 + 1).withColumnRenamed("step", "step")
    return MD.apply_intervals(fc, q, KEYS)


#: least squares on two lags from centred moments, then three blocks of twelve steps
LINEAR_FC_SQL = f"""
ft AS (SELECT *, lag(value, 12) OVER ({PK} ORDER BY idx) AS x1, lag(value, 24) OVER ({PK} ORDER BY idx) AS x2 FROM reg),
fu AS (SELECT * FROM ft WHERE x1 IS NOT NULL AND x2 IS NOT NULL),
mo AS (SELECT metric, satellite, var_pop(x1) AS c11, var_pop(x2) AS c22, covar_pop(x1, x2) AS c12,
              covar_pop(x1, value) AS c1y, covar_pop(x2, value) AS c2y, avg(value) AS my, avg(x1) AS m1, avg(x2) AS m2
       FROM fu GROUP BY ALL),
b12 AS (SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1,
                  (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2 FROM mo),
en AS (SELECT metric, satellite, max(idx) AS li, max(ts) AS lt, max(freq_s) AS fs FROM reg GROUP BY ALL),
co AS (SELECT b.metric, b.satellite, my - b1 * m1 - b2 * m2 AS b0, b1, b2, li, lt, fs
       FROM b12 b JOIN en ON en.metric = b.metric AND en.satellite = b.satellite),
known AS (SELECT r.metric, r.satellite, r.idx - co.li AS step, r.value AS yhat
          FROM reg r JOIN co ON co.metric = r.metric AND co.satellite = r.satellite WHERE r.idx > co.li - 24),
{{blocks}},
fc AS (SELECT * FROM k3 WHERE step > 0),
re AS (SELECT f.metric, f.satellite, (co.li - f.idx) % 12 + 1 AS cls,
              quantile_cont(abs(f.value - (co.b0 + co.b1 * f.x1 + co.b2 * f.x2)), 0.99) AS q
       FROM fu f JOIN co ON co.metric = f.metric AND co.satellite = f.satellite WHERE f.idx > co.li - 60 GROUP BY ALL),
lin AS (SELECT fc.metric, fc.satellite, fc.step, make_timestamp(epoch_us(co.lt) + fc.step * co.fs * 1000000) AS ts, fc.yhat,
               fc.yhat - re.q AS lo_99, fc.yhat + re.q AS hi_99
        FROM fc JOIN co ON co.metric = fc.metric AND co.satellite = fc.satellite
        LEFT JOIN re ON re.metric = fc.metric AND re.satellite = fc.satellite AND re.cls = (fc.step - 1) % 12 + 1)"""


def _block_sql(i: int) -> str:
    """Steps of block ``i`` (1, 2, 3) from what the block before it knows."""
    old = "known" if i == 1 else f"k{i - 1}"
    return f"""
k{i} AS (SELECT * FROM {old} UNION ALL
       SELECT a.metric, a.satellite, a.step + 12, co.b0 + co.b1 * a.yhat + co.b2 * z.yhat
       FROM {old} a JOIN {old} z ON z.metric = a.metric AND z.satellite = a.satellite AND z.step = a.step - 12
       JOIN co ON co.metric = a.metric AND co.satellite = a.satellite WHERE a.step > {12 * (i - 2)})"""


LINEAR_FC_SQL = LINEAR_FC_SQL.replace("{blocks}", ",".join(_block_sql(i) for i in (1, 2, 3)))


@register("linear_forecast", sql=f"""
WITH {S.TELE}, {REG_SQL}, {LINEAR_FC_SQL}
SELECT metric, satellite, ts, {q_sql('yhat')} AS yhat, {q_sql('lo_99')} AS lo_99, {q_sql('hi_99')} AS hi_99 FROM lin
""")
def q_linear_forecast(spark, sf_dir):
    """Regular series -> lag features -> per-series OLS -> 36-step recursive
    forecast in blocks of 12 -> 99 % conformal band."""
    return round_doubles(_linear_fc(spark, sf_dir).select(*KEYS, "ts", "yhat", "lo_99", "hi_99"))


@register("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    """M8: one GBT over all series (series as an ordered target statistic) with the operator's own settings, next 12 steps."""
    reg = _reg_materialized(spark, sf_dir)
    feats = FT.build_features(reg, KEYS, LAGS)
    cols = [f"lag{k}" for k in LAGS]
    model = MD.fit_gbt(feats, KEYS, cols)
    levels = MD.series_levels(feats, KEYS).checkpoint()
    fc = MD.forecast_recursive(reg, KEYS, LAGS, 12, lambda f: MD.predict_gbt(model, f, KEYS, levels))
    return round_doubles(fc.select(*KEYS, "ts", "yhat"))


@register("predict_after_checkpoint", sql=f"""
WITH {S.TELE}, {REG_SQL}, {LINEAR_FC_SQL}
SELECT metric, satellite, ts, {q_sql('yhat')} AS prediction, {q_sql('lo_99')} AS "LB", {q_sql('hi_99')} AS "UB"
FROM lin WHERE step BETWEEN 2 AND 24
""")
def q_predict_after_checkpoint(spark, sf_dir):
    """P8 tail (M18): forecast rows after each series' mark, named columns."""
    fc = _linear_fc(spark, sf_dir, horizon=24)
    marks = fc.groupBy(*KEYS).agg(F.min("ts").alias("ts"))
    out = MD.forecast_after_checkpoint(fc.select(*KEYS, "ts", "yhat", "lo_99", "hi_99"), marks, KEYS,
                                       names={"yhat": "prediction", "lo_99": "LB", "hi_99": "UB"})
    return round_doubles(out)


@register("one_class_svm")
def q_one_class_svm(spark, sf_dir):
    """Read -> one-class detector (RBF via random Fourier features, nu 0.1)
    on every series -> rows after the mark."""
    from orbitlens.operators.ocsvm import one_class_svm_anomaly
    r = one_class_svm_anomaly(tele(spark, sf_dir), KEYS, ["value"], nu=0.1, after="2024-01-15 00:00:00")
    return round_doubles(r)


PRED_NOW = "2024-01-31 00:00:00"


def _train(spark, sf_dir, model="linear", now=NOW):
    from orbitlens.streaming.telemetry import scratch_path
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(spark)
    return P.train_job(tele(spark, sf_dir), None, KEYS, now, model_dir=scratch_path(spark, "models"),
                       model=model)


#: the registry that a training run writes
TRAINED_SQL = f"""WITH RECURSIVE tele AS (SELECT * FROM (SELECT event_type AS metric, 'SAT' || CAST(user_id % 3 AS VARCHAR) AS satellite, ts, value FROM events)
  WHERE ts <= TIMESTAMP '{NOW}'), {REG_SQL}, {L.QUARTER_SQL}, {L.ACF_SQL}, {L.FFT_SQL}, {L.SIZING_SQL}, {L.SELECT_SQL}, {L.SEASON_SQL}"""
TRAINED_FROM = f"""FROM chosen c LEFT JOIN season s ON {L.same('s', 'c')}
WHERE n >= 50 AND len(lags) > 0 AND n - list_max(lags) > len(lags) + len(lags_pos) + 4"""


@register("train_pipeline", sql=TRAINED_SQL + """
SELECT c.metric AS target, c.satellite, freq_s, min_lag, max_lag, window_size, coalesce(season, 1) AS season,
  array_to_string(list_concat(list_transform(lags, lambda v: 'lag' || v),
    list_transform(lags_pos, lambda v: 'rolling_mean_lag' || v || '_window_size' || window_size),
    CASE WHEN coalesce(season, 1) > 1 THEN ['sin1_' || season, 'cos1_' || season] ELSE []::VARCHAR[] END), ',') AS features,
  array_to_string(lags, ',') AS series_lags
""" + TRAINED_FROM)
def q_train_pipeline(spark, sf_dir):
    """Season and lag search, one model per series on its own lags, registry rows."""
    r = _train(spark, sf_dir)
    return r.select("target", "satellite", "freq_s", "min_lag", "max_lag", "window_size", "season",
                    F.array_join("features", ",").alias("features"), _lag_text("series_lags").alias("series_lags"))


@register("horizon_lengths", sql=TRAINED_SQL + """
SELECT c.metric AS target, c.satellite, min_lag * freq_s AS prediction_length_s, max_lag * freq_s AS length_needed_s
""" + TRAINED_FROM)
def q_horizon_lengths(spark, sf_dir):
    """M15 on the registry that a training run wrote."""
    return FT.horizon_lengths(_train(spark, sf_dir)).select("target", "satellite", "prediction_length_s", "length_needed_s")


@register("predict_pipeline")
def q_predict_pipeline(spark, sf_dir):
    """Models from P7 -> context -> recursive forecast with backtest bands -> rows after the mark."""
    registry = _train(spark, sf_dir, now=PRED_NOW).checkpoint()
    marks = tele(spark, sf_dir).groupBy(*KEYS).agg(F.max("ts").alias("ts"))
    return round_doubles(P.predict_job(tele(spark, sf_dir), registry, marks, KEYS, PRED_NOW, horizon=24))


@register("trend_forecast_merge", sql=f"""
WITH {S.TELE}, {REG_SQL},
tr AS (SELECT metric, satellite, regr_slope(value, idx::DOUBLE) AS b, regr_intercept(value, idx::DOUBLE) AS a,
              max(ts) AS last, min(freq_s) AS freq_s, max(idx) AS li FROM reg GROUP BY ALL),
fu AS (SELECT metric, satellite, last + to_seconds(i * freq_s) AS ts, a + b * (li + i) AS yhat
       FROM tr CROSS JOIN range(1, 13) r(i) WHERE i <= 6),
m AS (SELECT coalesce(h.metric, f.metric) AS metric, coalesce(h.satellite, f.satellite) AS satellite,
             coalesce(h.ts, f.ts) AS ts, h.value AS y, f.yhat
      FROM reg h FULL OUTER JOIN fu f ON h.metric = f.metric AND h.satellite = f.satellite AND h.ts = f.ts)
SELECT metric, satellite, ts, {q_sql('coalesce(yhat, y)')} AS y, yhat IS NOT NULL AS is_forecast FROM m
""")
def q_trend_forecast_merge(spark, sf_dir):
    """M13 + L3 + J2 + J3 + U1: 12 future steps, the first 6 kept, predicted by
    the linear trend, merged into the history, the target filled from them."""
    from orbitlens.operators.joins import fill_target_with_forecast, merge_outer
    reg = reg_of(spark, sf_dir)
    tr = MD.linear_trend(reg, KEYS)
    fut = FT.future_frame(reg, KEYS, 12).join(
        reg.groupBy(*KEYS).agg(F.max("idx").alias("_li")), on=KEYS).filter(F.col("idx") > F.col("_li"))
    fut = MD.limit_horizon(fut, KEYS, 6)
    fc = fut.join(tr, on=KEYS).select(*KEYS, "ts", (F.col("intercept") + F.col("slope") * F.col("idx")).alias("yhat"))
    m = merge_outer(reg.select(*KEYS, "ts", F.col("value").alias("y")), fc, KEYS)
    m = fill_target_with_forecast(m, y="y", yhat="yhat")
    return round_doubles(m.select(*KEYS, "ts", "y", F.col("yhat").isNotNull().alias("is_forecast")))


@register("static_features", sql=f"""
WITH {S.TELE}, {REG_SQL},
st AS (SELECT metric, satellite, CAST(substr(satellite, 4) AS BIGINT) AS sat_no, count(*) AS n_points
       FROM tele GROUP BY ALL)
SELECT r.metric, r.satellite, r.ts, {q_sql('r.value')} AS value, st.sat_no, st.n_points
FROM reg r LEFT JOIN st ON r.metric = st.metric AND r.satellite = st.satellite
""")
def q_static_features(spark, sf_dir):
    """Static per-series columns (derived: satellite number, raw point
    count) attached to the regular series."""
    t = tele(spark, sf_dir)
    st = t.groupBy(*KEYS).agg(F.substring("satellite", 4, 10).cast("bigint").alias("sat_no"),
                              F.count(F.lit(1)).alias("n_points"))
    r = FT.attach_static_features(reg_of(spark, sf_dir).select(*KEYS, "ts", "value"), st, KEYS)
    return round_doubles(r)
