"""SQL text used by the DuckDB checks of the registered queries.

Each registered Spark query has an equivalent written as plain SQL over the
same parquet tables; these are the shared pieces.
"""

from __future__ import annotations

from orbitlens.functions.output import q_sql
from orbitlens.functions.time import DAY, HOUR, MIN

# The test-data telemetry mapping: metric = event_type, satellite = SAT + user_id % 3.
TELE = ("tele AS (SELECT event_type AS metric, 'SAT' || CAST(user_id % 3 AS VARCHAR) AS satellite, "
        "ts, value FROM events)")

KEYS = "metric, satellite"


def stats_ctes(step_us: int = HOUR, src: str = "tele", name: str = "stats", KEYS: str = KEYS) -> str:
    """CTEs computing bucket statistics (label = right edge, empty buckets kept)."""
    return f"""
{name}_b AS (SELECT {KEYS}, ts, value, (epoch_us(ts) // {step_us}) * {step_us} AS b
            FROM {src}),
{name}_d AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY {KEYS}, b ORDER BY ts, value)) AS d FROM {name}_b),
{name}_a AS (SELECT {KEYS}, b, avg(value) AS mean, count(value) AS cnt, median(value) AS median,
            stddev_samp(value) AS std,
            CASE WHEN count(value) >= 3 THEN coalesce(skewness(value), 0) END AS skew,
            min(value) AS mn, max(value) AS mx, sum(value * value) / count(*) AS energy,
            CASE WHEN count(value) >= 4 THEN coalesce(kurtosis(value), 0) END AS kurt,
            max(d) AS max_diff
            FROM {name}_d GROUP BY {KEYS}, b),
{name}_bounds AS (SELECT {KEYS}, min(b) AS lo, max(b) AS hi FROM {name}_a GROUP BY {KEYS}),
{name}_grid AS (SELECT {KEYS}, unnest(range(lo, hi + 1, {step_us})) AS b FROM {name}_bounds),
{name} AS (SELECT {", ".join("g." + k.strip() for k in KEYS.split(","))}, make_timestamp(g.b + {step_us}) AS bucket_end,
            a.mean, coalesce(a.cnt, 0) AS "count", a.median, a.std, a.skew, a.mn AS "min", a.mx AS "max",
            a.energy, a.kurt, a.max_diff
           FROM {name}_grid g LEFT JOIN {name}_a a ON {" AND ".join(f"g.{k.strip()} = a.{k.strip()}" for k in KEYS.split(","))} AND g.b = a.b)
"""


STAT_COLS = ["mean", "count", "median", "std", "skew", "min", "max", "energy", "kurt", "max_diff"]


def rounded(cols, exclude=()) -> str:
    return ", ".join(f'"{c}"' if c in exclude else f'{q_sql(chr(34) + c + chr(34))} AS "{c}"' for c in cols)


def shifted_rolling_cte(name: str, src: str, col: str, window_us: int, min_periods: int,
                        stats=("mean",), tcol: str = "t", prefix: str | None = None) -> str:
    """Two CTEs: pandas rolling(window, min_periods) on ``col``, then shift(1)."""
    prefix = prefix or col
    w = (f"(PARTITION BY {KEYS} ORDER BY {tcol} RANGE BETWEEN {window_us - 1} PRECEDING AND CURRENT ROW)")
    fn = {"mean": "avg", "std": "stddev_samp"}
    raw = ", ".join(f"CASE WHEN count({col}) OVER {w} >= {min_periods} THEN {fn[s]}({col}) OVER {w} END AS {prefix}_{s}_raw"
                    for s in stats)
    lagged = ", ".join(f"lag({prefix}_{s}_raw) OVER (PARTITION BY {KEYS} ORDER BY {tcol}) AS {prefix}_{s}"
                       for s in stats)
    return f"{name}_raw AS (SELECT *, {raw} FROM {src}),\n{name} AS (SELECT *, {lagged} FROM {name}_raw)"


def ma_sql(src: str, ts: str, cols, window_us: int, min_periods: int, sigma: float,
           delta: float, bounds: bool = True) -> str:
    """SQL for D1 over a source CTE ``src`` with a time column ``ts``."""
    ctes = [f"ma_t AS (SELECT *, epoch_us({ts}) AS t FROM {src})"]
    prev = "ma_t"
    for i, c in enumerate(cols):
        ctes.append(shifted_rolling_cte(f"ma_m{i}", prev, f'"{c}"', window_us, min_periods, ("mean",),
                                        prefix=f"m{i}"))
        ctes.append(f'ma_r{i}x AS (SELECT *, abs("{c}" - m{i}_mean) AS r{i} FROM ma_m{i})')
        ctes.append(shifted_rolling_cte(f"ma_r{i}", f"ma_r{i}x", f"r{i}", window_us, min_periods,
                                        ("mean", "std"), prefix=f"rr{i}"))
        prev = f"ma_r{i}"
    sel = {}
    for i, c in enumerate(cols):
        score = f"((r{i} - rr{i}_mean - {delta}) / (rr{i}_std + 1e-8)) / {float(sigma)}"
        sel[(c, "_ma_anomaly_score")] = score
        sel[(c, "_ma_anomaly")] = f'CASE WHEN {score} > 1 THEN "{c}" END'
        sel[(c, "_ma_upper_bound")] = f"{float(sigma)} * (rr{i}_std + 1e-8) + rr{i}_mean + m{i}_mean + {delta}"
        sel[(c, "_ma_lower_bound")] = f"-{float(sigma)} * (rr{i}_std + 1e-8) - rr{i}_mean + m{i}_mean - {delta}"
    exts = ["_ma_anomaly_score", "_ma_anomaly"] + (["_ma_upper_bound", "_ma_lower_bound"] if bounds else [])
    cols_sql = ", ".join(f'{q_sql(sel[(c, e)])} AS "{c}{e}"' for e in exts for c in cols)
    return ",\n".join(ctes), f"SELECT {KEYS}, {ts}, {cols_sql} FROM {prev}"


__all__ = ["TELE", "KEYS", "stats_ctes", "STAT_COLS", "rounded", "ma_sql", "DAY", "HOUR", "MIN"]
