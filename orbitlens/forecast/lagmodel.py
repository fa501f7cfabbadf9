"""Linear models on every series' own lags, with backtest bands.

A series is predicted from its values at its own lags, rolling means that end at its
position lags, the sine and cosine of its season, and exogenous values of the same
time.  All series are fitted in one plan, whatever their lag sets.

How it runs
-----------
* A regular series is cut into blocks of consecutive points.  The rows of a target
  block need the blocks that its lags reach, so a block is sent to the targets that
  some lag of its series brings it to; rolling means come from prefix sums, of which
  a block carries the sum before it.
* A target block returns one matrix Z'Z of its rows (features and target), the sums
  of a series' blocks are its normal equations, solved by Cholesky.
* Backtest: the last ``windows`` windows of ``h`` steps are predicted in turn by the
  model of the rows before them only.  The blocks' matrices are summed from the
  start, so each block begins with the sum of what lies before it and adds its own
  windows one by one.  The bands are the level's quantile of the absolute errors per
  step, and never narrow with the step.
* A forecast runs in blocks of the smallest lag: features are values at offsets, so
  a block is one join of (step, offset) with the known values.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbitlens.forecast.seasonality import _types
from orbitlens.forecast.spectrum import CURVE, _batch, _head
from orbitlens.functions.time import SEC, epoch_us, from_epoch_us
from orbitlens.operators.windows import join_null_safe

#: what a model knows of its series
PLAN = ["n", "a0", "center", "lags", "lags_pos", "window_size", "season", "h", "windows"]
PLAN_TYPES = ("n long, a0 long, center double, lags array<long>, lags_pos array<long>, window_size long, season long, "
              "h long, windows long")
LEVEL = 99


def grid_number(ts: str = "ts") -> Column:
    """Number of a regular point since the epoch: the same in training and prediction."""
    return F.call_function("div", epoch_us(ts), F.col("freq_s") * SEC)


def feature_names(lags, lags_pos, window_size, season, exogenous) -> list[str]:
    """Names of a model's features, in the order of its coefficients after the intercept."""
    return ([f"lag{k}" for k in lags] + [f"rolling_mean_lag{k}_window_size{window_size}" for k in lags_pos]
            + ([f"sin1_{season}", f"cos1_{season}"] if season > 1 else []) + list(exogenous))


def model_plan(reg: DataFrame, selected: DataFrame, sizing: DataFrame, keys: list[str], season: DataFrame | None = None) -> DataFrame:
    """Keys, freq_s, min_lag, max_lag and PLAN of every series that can be trained.

    ``selected``: ``seasonality.select_lags``; ``sizing``: ``features.series_sizing``; ``season``: keys, season (none: 1).
    h = min(min_lag, n / frac); as many windows as the series has rows for, ``n_windows`` at most.  A series without
    lags, or with fewer rows than features, has no plan."""
    first = reg.groupBy(*keys).agg(F.min(grid_number()).alias("a0"), F.avg("value").alias("center"))
    p = join_null_safe(selected, sizing.select(*keys, "n", "frac", "n_windows"), keys, "inner")
    p = join_null_safe(p, first, keys, "inner")
    if season is not None:
        p = join_null_safe(p, season.select(*keys, F.col("season").cast("long").alias("season")), keys)
    else:
        p = p.withColumn("season", F.lit(1).cast("long"))
    p = p.withColumn("season", F.coalesce("season", F.lit(1)))
    rows = F.col("n") - F.array_max("lags")
    width = F.size("lags") + F.size("lags_pos") + 4
    h = F.greatest(F.least(F.col("min_lag"), F.expr("n div greatest(frac, 1)")), F.lit(1))
    p = p.where((F.size("lags") > 0) & (rows > width)).withColumn("h", h.cast("long"))
    return p.withColumn("windows", F.greatest(F.least(F.col("n_windows"), F.floor((rows - width) / F.col("h"))), F.lit(0)).cast("long")).select(
        *keys, "freq_s", "min_lag", "max_lag", *PLAN)


# ------------------------------------------------------------------ blocks and rows
def _spread(plan: dict) -> tuple[int, int]:
    """(anchor, size): target block b holds the rows anchor + b * size and on; backtest windows never straddle blocks."""
    h, w = plan["h"], plan["windows"]
    return plan["n"] - h * w, max(1, CURVE // h) * h


def _offsets(plan: dict) -> list[int]:
    pos, w = plan["lags_pos"], plan["window_size"]
    return [0, *plan["lags"], *pos, *[k + w for k in pos]]


def _scatter(keys: list[str]):
    """A block of points for every target block whose rows need it."""
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for r in range(t.num_rows):
                plan = {c: t[c][r].as_py() for c in PLAN}
                anchor, size = _spread(plan)
                blk, n = t["blk"][r].as_py(), plan["n"]
                lo = blk * CURVE
                hi = min(lo + CURVE, n) - 1
                home, to = set(), set()
                for o in _offsets(plan):
                    a, z = max(lo + o, max(plan["lags"])), min(hi + o, n - 1)
                    if a <= z:
                        b = range((a - anchor) // size, (z - anchor) // size + 1)
                        to.update(b)
                        if o == 0:
                            home.update(b)
                to = sorted(to)
                if not to:
                    continue
                x, w, e = (np.ascontiguousarray(t[c][r].values.to_numpy(zero_copy_only=False)).tobytes() for c in ("x", "w", "e"))
                yield _batch(_head(t, [*keys, *PLAN], r), {
                    "target": pa.array(to, pa.int64()), "blk": pa.array([blk] * len(to), pa.int64()), "before": pa.array([t["before"][r].as_py()] * len(to)),
                    "x": pa.array([x] * len(to), pa.binary()), "w": pa.array([w if b in home else None for b in to], pa.binary()),
                    "e": pa.array([e if b in home else None for b in to], pa.binary())})
    return run


def _rows(table: pa.Table, exogenous: int):
    """(plan, first row number, Z with the target last, weights) of a target block's rows."""
    plan = {c: table[c][0].as_py() for c in PLAN}
    anchor, size = _spread(plan)
    t0 = max(anchor + table["target"][0].as_py() * size, max(plan["lags"]))
    t1 = min(anchor + (table["target"][0].as_py() + 1) * size, plan["n"])
    blk = table["blk"].to_numpy()
    order = np.argsort(blk)
    blk = blk[order]
    x = np.zeros((len(blk), CURVE))
    weight, ex = np.zeros((len(blk), CURVE)), np.zeros((len(blk), exogenous, CURVE))
    for i, j in enumerate(order.tolist()):
        v = np.frombuffer(table["x"][j].as_py())
        x[i, :len(v)] = v
        if table["w"][j].is_valid:
            weight[i, :len(v)] = np.frombuffer(table["w"][j].as_py())
            ex[i, :, :len(v)] = np.frombuffer(table["e"][j].as_py()).reshape(len(v), exogenous).T
    total = np.cumsum(x, axis=1) + table["before"].to_numpy()[order][:, None]
    t = np.arange(t0, t1)

    def at(values, place):
        return values[np.searchsorted(blk, place // CURVE), place % CURVE]

    def upto(place):                                     # sum of the values up to ``place``
        out = np.zeros(len(place))
        known = place >= 0
        out[known] = at(total, place[known])
        return out

    cols = [np.ones(len(t))] + [at(x, t - k) for k in plan["lags"]]
    w = plan["window_size"]
    cols += [(upto(t - k) - upto(t - k - w)) / np.minimum(w, t - k + 1) for k in plan["lags_pos"]]
    if plan["season"] > 1:
        angle = 2 * math.pi * ((plan["a0"] + t) % plan["season"]) / plan["season"]
        cols += [np.sin(angle), np.cos(angle)]
    cols += [at(ex[:, i], t) for i in range(exogenous)]
    return plan, t0, np.column_stack([*cols, at(x, t)]), at(weight, t)


def solve(gram: np.ndarray) -> np.ndarray:
    """Coefficients from Z'Z (the target last): Cholesky, or the least-norm solution where columns depend on each other."""
    a, b = gram[:-1, :-1], gram[:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
    s = a / np.outer(scale, scale)
    try:
        low = np.linalg.cholesky(s)
        if np.diag(low).min() > 1e-6:
            y = np.linalg.solve(low, b / scale)
            return np.linalg.solve(low.T, y) / scale
    except np.linalg.LinAlgError:
        pass
    return np.linalg.lstsq(s, b / scale, rcond=1e-10)[0] / scale


def _grams(keys: list[str], exogenous: int):
    def run(table: pa.Table) -> pa.Table:
        _, _, z, w = _rows(table, exogenous)
        gram = (z * w[:, None]).T @ z
        return pa.Table.from_batches([_batch(_head(table, [*keys, *PLAN, "target"]), {"rows": pa.array([float(w.sum())]), "gram": pa.array([gram.tobytes()], pa.binary())})])
    return run


def _sum(keys: list[str]):
    """Running sums over a series' blocks: what lies before each backtest block, and everything (target null)."""
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["target"].to_numpy())
        total, rows, target, sums, count = 0.0, 0.0, [], [], []
        for i in order.tolist():
            b = table["target"][i].as_py()
            if b >= 0:
                if np.ndim(total):
                    target.append(b), sums.append(total.tobytes()), count.append(rows)
            total = total + np.frombuffer(table["gram"][i].as_py())
            rows += table["rows"][i].as_py()
        target.append(None), sums.append(total.tobytes()), count.append(rows)
        return pa.Table.from_batches([_batch(_head(table, [*keys, *PLAN]), {"target": pa.array(target, pa.int64()), "gram": pa.array(sums, pa.binary()),
                                                                           "rows": pa.array(count)})])
    return run


def _coefficients(keys: list[str]):
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for r in range(t.num_rows):
                g = np.frombuffer(t["gram"][r].as_py())
                k = math.isqrt(len(g))
                yield _batch(_head(t, [*keys, *PLAN], r), {"coef": pa.array([solve(g.reshape(k, k)).tolist()], pa.list_(pa.float64())), "rows": t["rows"].combine_chunks()[r:r + 1]})
    return run


def _backtest(keys: list[str], exogenous: int):
    def run(table: pa.Table, before: pa.Table) -> pa.Table:
        step, err, head = [], [], None
        if table.num_rows and before.num_rows:
            head = _head(table, keys)
            plan, t0, z, w = _rows(table, exogenous)
            gram = np.frombuffer(before["gram_"][0].as_py()).reshape(z.shape[1], -1).copy()
            for a in range(0, len(z), plan["h"]):
                part, weight = z[a:a + plan["h"]], w[a:a + plan["h"]]
                miss = part[:, -1] - part[:, :-1] @ solve(gram)
                used = np.flatnonzero(weight > 0)
                step += (used + 1).tolist()
                err += np.abs(miss[used]).tolist()
                gram += (part * weight[:, None]).T @ part
        head = head or {k: (None, table.schema.field(k).type) for k in keys}
        return pa.Table.from_batches([_batch(head, {"step": pa.array(step, pa.int64()), "error": pa.array(err, pa.float64())})])
    return run


def fit_lagged(reg: DataFrame, plan: DataFrame, keys: list[str], *, exogenous: list[str] = (), weight: str | None = None,
               level: int = LEVEL) -> DataFrame:
    """One model per series of ``plan``: keys, PLAN, exogenous, features, coef (intercept first, on centred values),
    rows, bands (array: half-width at step 1 .. h; null without windows).

    ``reg``: regular series (keys, ts, value, freq_s, idx) with the columns ``exogenous``; ``weight``: a column that
    counts each row so many times (0: left out), see ``filters.interval_counts``."""
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(reg.sparkSession)
    ex = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exogenous]).cast("array<double>")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    x = join_null_safe(reg.select(*keys, "idx", "value", w.alias("_w"), ex.alias("_e")), plan.select(*keys, *PLAN), keys, "inner")
    point = F.struct("idx", (F.col("value") - F.col("center")).alias("v"), "_w", "_e")
    x = (x.groupBy(*keys, *PLAN, F.expr(f"idx div {CURVE}").alias("blk")).agg(F.array_sort(F.collect_list(point)).alias("p"))    # CURVE points at most
         .select(*keys, *PLAN, "blk", F.transform("p", lambda e: e["v"]).alias("x"), F.transform("p", lambda e: e["_w"]).alias("w"),
                 F.flatten(F.transform("p", lambda e: e["_e"])).alias("e")))
    x = x.withColumn("s", F.aggregate("x", F.lit(0.0), lambda a, b: a + b))
    x = x.withColumn("before", F.coalesce(F.sum("s").over(Window.partitionBy(*keys).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    types = _types(reg, keys) + PLAN_TYPES
    k = len(exogenous)
    sent = x.drop("s").mapInArrow(_scatter(keys), f"{types}, target long, blk long, before double, x binary, w binary, e binary").checkpoint()
    grams = sent.groupBy(*keys, "target").applyInArrow(_grams(keys, k), f"{types}, target long, rows double, gram binary")
    sums = grams.groupBy(*keys).applyInArrow(_sum(keys), f"{types}, target long, gram binary, rows double").checkpoint()
    fitted = sums.where("target is null").select(*keys, *PLAN, "gram", "rows").mapInArrow(_coefficients(keys), f"{types}, coef array<double>, rows double")
    # a series without enough rows before a window has no band from it
    starts = sums.where("target is not null").select(*[F.col(c).alias(f"{c}_") for c in (*keys, "target", "gram")])
    errors = (sent.where("target >= 0").groupBy(*keys, "target").cogroup(starts.groupBy(*[f"{c}_" for c in (*keys, "target")]))
              .applyInArrow(_backtest(keys, k), f"{_types(reg, keys)}step long, error double"))
    q = errors.groupBy(*keys, "step").agg(F.percentile("error", level / 100.0).alias("q"))
    q = q.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("step", "q"))).alias("s"))
    widest = F.transform("s", lambda e, i: F.array_max(F.transform(F.slice("s", F.lit(1), i + 1), lambda d: d["q"])))
    bands = q.select(*keys, widest.alias("bands"))
    names = F.concat(F.transform("lags", lambda v: F.concat(F.lit("lag"), v.cast("string"))),
                     F.transform("lags_pos", lambda v: F.concat(F.lit("rolling_mean_lag"), v.cast("string"), F.lit("_window_size"), F.col("window_size").cast("string"))),
                     F.when(F.col("season") > 1, F.array(F.concat(F.lit("sin1_"), "season"), F.concat(F.lit("cos1_"), "season"))).otherwise(F.array().cast("array<string>")),
                     F.array(*[F.lit(c) for c in exogenous]).cast("array<string>"))
    listed = F.array(*[F.lit(c) for c in exogenous]).cast("array<string>")
    return (join_null_safe(fitted, bands, keys).withColumn("exogenous", listed).withColumn("features", names)
            .select(*keys, *PLAN, "exogenous", "features", "coef", "rows", "bands"))


# ------------------------------------------------------------------ forecast
def forecast_lagged(hist: DataFrame, models: DataFrame, keys: list[str], horizon: int, *, exogenous: DataFrame | None = None,
                    value: str = "value") -> DataFrame:
    """Keys, ts, step, yhat, lo, hi for ``horizon`` steps after every series' last point.

    ``hist``: regular points (keys, ts, value, freq_s), at least max_lag + window_size of each series; ``models``:
    rows of ``fit_lagged``; ``exogenous``: keys, ts, name, value of the models' exogenous series at the steps' times
    (missing: 0).  Steps beyond the bands' take the last band.  Blocks of the smallest lag of all series."""
    from orbitlens.session import checkpoint_dir
    checkpoint_dir(hist.sparkSession)
    h = join_null_safe(hist.select(*keys, grid_number().alias("a"), F.col(value).alias("value"), "freq_s"), models.select(*keys, "center"), keys, "inner")
    h = h.select(*keys, "a", (F.col("value") - F.col("center")).alias("v"), "freq_s").checkpoint()
    ends = h.groupBy(*keys).agg(F.max("a").alias("last"), F.first("freq_s").alias("freq_s"))
    m = join_null_safe(models, ends, keys, "inner").checkpoint()
    least = m.agg(F.min(F.array_min("lags"))).first()[0]                 # one scalar
    empty = F.struct(F.lit(0).cast("long").alias("off"), F.lit(0.0).alias("c"), F.lit(False).alias("sum"))
    coef = lambda i: F.element_at("coef", (i + 2).cast("int"))  # noqa: E731  after the intercept
    lag = F.transform("lags", lambda k, i: F.struct(k.alias("off"), coef(i).alias("c"), F.lit(False).alias("sum")))
    mean = F.flatten(F.transform("lags_pos", lambda k, i: F.array(
        F.struct(k.alias("off"), (coef(i + F.size("lags")) / F.col("window_size")).alias("c"), F.lit(True).alias("sum")),
        F.struct((k + F.col("window_size")).alias("off"), (-coef(i + F.size("lags")) / F.col("window_size")).alias("c"), F.lit(True).alias("sum")))))
    terms = m.select(*keys, "last", F.explode(F.concat(lag, mean, F.filter(F.array(empty), lambda e: F.lit(False)))).alias("t")).select(
        *keys, "last", "t.off", "t.c", "t.sum").checkpoint()
    at = F.size("lags") + F.size("lags_pos")
    angle = F.lit(2 * math.pi) * (F.pmod(F.col("a"), F.col("season")) / F.col("season"))
    base = F.element_at("coef", 1) + F.when(F.col("season") > 1, F.element_at("coef", at + 2) * F.sin(angle) + F.element_at("coef", at + 3) * F.cos(angle)).otherwise(0.0)
    # what the history answers, for all steps in one pass over it; only answers that lie ahead wait for their block
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    run = h.select(*keys, "a", "v").withColumn("c_sum", F.sum("v").over(Window.partitionBy(*keys).orderBy("a")))    # the context only
    asked = terms.select("*", steps).withColumn("a", F.col("last") + F.col("step") - F.col("off"))
    answers = join_null_safe(asked, run, [*keys, "a"]).checkpoint() if least and horizon > 0 else None
    whole = h.groupBy(*keys).agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("whole")).checkpoint()
    ahead, out, done = None, None, 0
    while least and done < horizon:
        b = min(int(least), horizon - done)
        steps = F.explode(F.sequence(F.lit(done + 1), F.lit(done + b))).alias("step")
        found = answers.where(F.col("step").between(done + 1, done + b))
        if ahead is not None:                                        # at most ``horizon`` rows of a series
            new = join_null_safe(ahead, whole, keys, "inner").select(
                *keys, "a", F.col("v").alias("new_v"),
                (F.col("whole") + F.coalesce(F.sum("v").over(Window.partitionBy(*keys).orderBy("a")), F.lit(0.0))).alias("new_sum"))
            found = join_null_safe(found, new, [*keys, "a"])
            found = found.withColumns({"v": F.coalesce("v", "new_v"), "c_sum": F.coalesce("c_sum", "new_sum")})
        part = F.col("c") * F.when(F.col("sum"), F.coalesce("c_sum", F.lit(0.0))).otherwise(F.col("v"))
        found = found.groupBy(*keys, "step").agg(F.when(F.count(part) == F.count(F.lit(1)), F.sum(part)).alias("y"))
        fixed = m.select("*", steps).withColumn("a", F.col("last") + F.col("step")).withColumn("base", base)
        fixed = join_null_safe(fixed, found, [*keys, "step"], "inner")
        if exogenous is not None:
            e = exogenous.select(*keys, "ts", "name", F.col("value").alias("e"))
            named = fixed.select(*keys, "step", from_epoch_us(F.col("a") * F.col("freq_s") * SEC).alias("ts"), "coef", "exogenous",
                                 F.posexplode("exogenous").alias("i", "name"))
            named = join_null_safe(named, e, [*keys, "ts", "name"], "inner")
            add = named.groupBy(*keys, "step").agg(F.sum(F.element_at("coef", F.size("coef") - F.size("exogenous") + F.col("i") + 1) * F.col("e")).alias("add"))
            fixed = join_null_safe(fixed, add, [*keys, "step"]).withColumn("base", F.col("base") + F.coalesce("add", F.lit(0.0)))
        now = fixed.select(*keys, "a", F.col("step").cast("long").alias("step"), (F.col("base") + F.col("y")).alias("v"), "center", "freq_s", "bands").checkpoint()
        out = now if out is None else out.unionByName(now)
        ahead = now.select(*keys, "a", "v") if ahead is None else ahead.unionByName(now.select(*keys, "a", "v"))
        done += b
    if out is None:
        out = m.select(*keys, F.col("last").alias("a"), F.lit(0).cast("long").alias("step"), F.lit(0.0).alias("v"), "center", "freq_s", "bands").limit(0)
    yhat = F.col("v") + F.col("center")
    band = F.element_at("bands", F.least(F.col("step"), F.size("bands")).cast("int"))
    band = F.when(F.size("bands") > 0, band)
    return out.select(*keys, from_epoch_us(F.col("a") * F.col("freq_s") * SEC).alias("ts"), "step", yhat.alias("yhat"),
                      (yhat - band).alias("lo"), (yhat + band).alias("hi"))
