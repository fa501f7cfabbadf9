"""Daily bounds report (D6 / P10): the table part of the reference's report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.functions.time import DAY, duration_us, epoch_us, floor_us, from_epoch_us
from orbitlens.operators.detect import flag_out_of_bounds
from orbitlens.operators.resample import fill_gaps
from orbitlens.operators.stats import rmse, smape


def daily_bounds_report(df: DataFrame, keys: list[str], now, *, every="10s", ts: str = "ts", y: str = "y",
                        yhat: str = "yhat", lb: str = "lb", ub: str = "ub",
                        span_us: int = DAY, block_buckets: int = 4096) -> DataFrame:
    """Last ``span`` before ``now`` on a grid of ``every``: the first value of each step (T1), gaps filled backward, then
    forward, in all four series; values outside [lb, ub] are flagged (F8); then per series the number of anomalies
    (A10), SMAPE (A11) and RMSE (A12) of y against yhat.  Filling runs in blocks of ``block_buckets`` steps."""
    from orbitlens.operators.stats import expand_gaps
    from orbitlens.sources.telemetry import _ts_lit
    now_us, step, cols = epoch_us(_ts_lit(now)), duration_us(every), [y, yhat, lb, ub]
    w = df.filter((F.col(ts) >= from_epoch_us(now_us - F.lit(span_us))) & (F.col(ts) <= from_epoch_us(now_us)))
    firsts = (w.select(*keys, ts, *cols).withColumn("_b", floor_us(epoch_us(ts), step)).groupBy(*keys, "_b")
              .agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in cols]))
    firsts = fill_gaps(firsts.withColumn("_bt", from_epoch_us("_b")), keys, cols, ts="_bt", block_us=step * block_buckets).drop("_bt")
    # every present step has a value now, so an empty one takes the next present step's
    w = expand_gaps(firsts, keys, step, cols, fill_from_next=cols, block=step * block_buckets)
    w = w.withColumn("anomaly", flag_out_of_bounds(y, lb, ub))
    return w.groupBy(*keys).agg(F.count("anomaly").alias("anomaly_count"),
                                smape(F.col(y), F.col(yhat)).alias("smape"),
                                rmse(F.col(y), F.col(yhat)).alias("rmse"))
