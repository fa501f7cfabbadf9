"""SQL of the lag search, the seasonal search and the lag models, for the DuckDB checks.

Plain definitions over whole curves: direct sums for autocorrelation and spectrum,
windows for peaks and prominences, a fold for the spacing, recursive tables for the
zero-phase filter, refits from scratch for the backtest.
"""

from __future__ import annotations

PK = "PARTITION BY metric, satellite"
SAME = "{a}.metric = {b}.metric AND {a}.satellite = {b}.satellite"


def same(a: str, b: str) -> str:
    return SAME.format(a=a, b=b)


def acf_sql(name: str, src: str, value: str = "value", where: str = "true") -> str:
    """CTE ``name`` (lag, v): all lags of ``src``."""
    return f"""
{name}_z AS MATERIALIZED (SELECT metric, satellite, idx, {value} - avg({value}) OVER ({PK}) AS z FROM {src} WHERE {where}),
{name}_s AS MATERIALIZED (SELECT a.metric, a.satellite, b.idx - a.idx AS lag, sum(a.z * b.z) AS s
  FROM {name}_z a JOIN {name}_z b ON {same('a', 'b')} AND b.idx >= a.idx GROUP BY ALL),
{name} AS MATERIALIZED (SELECT p.metric, p.satellite, p.lag, p.s / c.s AS v FROM {name}_s p JOIN {name}_s c ON {same('p', 'c')} AND c.lag = 0 WHERE c.s > 0)"""


def tops_sql(name: str, curve: str, place: str, value: str) -> str:
    """CTE ``name`` (lag, v): peaks of a curve; a run of equal values counts as one, at its middle."""
    return f"""
{name}_0 AS (SELECT metric, satellite, {place} AS lag, {value} AS v,
             coalesce(({value} <> lag({value}) OVER ({PK} ORDER BY {place}))::INT, 1) AS fresh FROM {curve}),
{name}_1 AS (SELECT *, sum(fresh) OVER ({PK} ORDER BY lag) AS run FROM {name}_0),
{name}_2 AS (SELECT metric, satellite, run, min(lag) AS a, max(lag) AS z, min(v) AS v FROM {name}_1 GROUP BY ALL),
{name}_3 AS (SELECT *, lag(v) OVER ({PK} ORDER BY run) AS before, lead(v) OVER ({PK} ORDER BY run) AS after FROM {name}_2),
{name} AS MATERIALIZED (SELECT metric, satellite, ((a + z) // 2)::BIGINT AS lag, v FROM {name}_3 WHERE before < v AND after < v)"""


def spaced_sql(name: str, tops: str, distance: str) -> str:
    """CTE ``name`` (lag): higher peaks first, those closer than ``distance`` (a column or number) to a kept one go."""
    return f"""
{name}_l AS (SELECT metric, satellite, any_value({distance}) AS d, list([lag] ORDER BY v DESC, lag DESC) AS l FROM {tops} GROUP BY metric, satellite),
{name} AS MATERIALIZED (SELECT metric, satellite, unnest(list_reduce(list_prepend([]::BIGINT[], l), lambda kept, p:
  CASE WHEN len(list_filter(kept, lambda q: abs(q - p[1]) < d)) > 0 THEN kept ELSE list_concat(kept, p) END)) AS lag FROM {name}_l)"""


def prominence_sql(name: str, peaks: str, curve: str) -> str:
    """CTE ``name`` (peaks plus ``{name}_p``): height above the higher of the two lowest values up to the next higher one."""
    return f"""
{name}_e AS (SELECT p.metric, p.satellite, p.lag, p.v, max(c.lag) FILTER (c.lag < p.lag AND c.v > p.v) AS lo, min(c.lag) FILTER (c.lag > p.lag AND c.v > p.v) AS hi
  FROM {peaks} p JOIN {curve} c ON {same('c', 'p')} GROUP BY ALL),
{name} AS MATERIALIZED (SELECT e.metric, e.satellite, e.lag, any_value(e.v) AS v, any_value(e.v) - greatest(
    min(c.v) FILTER (c.lag <= e.lag AND c.lag > coalesce(e.lo, -1)), min(c.v) FILTER (c.lag >= e.lag AND c.lag < coalesce(e.hi, 1e18))) AS {name}_p
  FROM {name}_e e JOIN {curve} c ON {same('c', 'e')} GROUP BY e.metric, e.satellite, e.lag)"""


def acf_lags_sql(name: str, acf: str, nlags: int) -> str:
    """CTE ``name`` (lag, rank): the search over an autocorrelation."""
    return f"""
{name}_c AS MATERIALIZED (SELECT *, floor(count(*) OVER ({PK}) * 0.05)::BIGINT AS start FROM {acf}),
{name}_t AS MATERIALIZED (SELECT * FROM {name}_c WHERE lag >= start),
{tops_sql(f'{name}_top', f'{name}_t', 'lag', 'v')},
{name}_far AS (SELECT t.*, greatest(s.start // 5, 1) AS d FROM {name}_top t JOIN (SELECT DISTINCT metric, satellite, start FROM {name}_c) s ON {same('s', 't')}),
{spaced_sql(f'{name}_sp', f'{name}_far', 'd')},
{name}_kept AS MATERIALIZED (SELECT t.* FROM {name}_top t JOIN {name}_sp s ON {same('s', 't')} AND s.lag = t.lag),
{prominence_sql(f'{name}_own', f'{name}_kept', f'{name}_t')},
{name}_good AS MATERIALIZED (SELECT metric, satellite, lag, v FROM {name}_own WHERE {name}_own_p >= 0.01),
{prominence_sql(f'{name}_whole', f'{name}_good', acf)},
{name}_placed AS (SELECT *, row_number() OVER ({PK} ORDER BY lag) AS place, count(*) OVER ({PK}) AS m FROM {name}_whole),
{name}_many AS (SELECT metric, satellite, lag, row_number() OVER ({PK} ORDER BY {name}_whole_p DESC, lag DESC) AS rank
                FROM {name}_placed WHERE m > {nlags} AND place > 4),
{name} AS MATERIALIZED (SELECT metric, satellite, lag, place AS rank FROM {name}_placed WHERE m <= {nlags}
          UNION ALL SELECT * FROM {name}_many WHERE rank <= {nlags})"""


def spectrum_sql(name: str, src: str) -> str:
    """CTE ``name`` (k, y, n): magnitudes at all positive frequencies of ``src`` (idx, v, n)."""
    return f"""
{name}_k AS (SELECT x.metric, x.satellite, x.n, k.k, sum(v * cos(2 * pi() * ((k.k * idx) % n) / n)) AS re, sum(v * sin(2 * pi() * ((k.k * idx) % n) / n)) AS im
  FROM {src} x JOIN (SELECT range AS k FROM range(1, (SELECT max(n) FROM {src}))) k ON k.k <= (x.n - 1) // 2 GROUP BY ALL),
{name} AS MATERIALIZED (SELECT metric, satellite, n, k, sqrt(re * re + im * im) AS y FROM {name}_k)"""


def _period_sql(r: int) -> str:
    return f"""
{spectrum_sql(f'sp{r}', f'x{r}')},
{tops_sql(f'tp{r}', f'sp{r}', 'k', 'y')},
hi{r} AS (SELECT t.*, 5 AS d FROM tp{r} t JOIN (SELECT metric, satellite, max(y) AS top FROM sp{r} GROUP BY ALL) m ON {same('m', 't')} WHERE t.v >= m.top / 10),
{spaced_sql(f'ks{r}', f'hi{r}', 'd')},
pd{r} AS MATERIALIZED (SELECT k.metric, k.satellite, any_value(x.n) AS n, any_value(x.n) // max(k.lag) AS period
  FROM ks{r} k JOIN (SELECT DISTINCT metric, satellite, n FROM x{r}) x ON {same('x', 'k')} GROUP BY k.metric, k.satellite
  HAVING any_value(x.n) // max(k.lag) <= any_value(x.n) / 10)"""


def _pass_sql(out: str, src: str, coef: str, back: bool) -> str:
    """Recursive CTE ``out`` (idx, v): two second-order sections over ``src`` from the steady state of its first value."""
    end, step = ("max", "- 1") if back else ("min", "+ 1")
    return f"""
{out}_r AS (SELECT c.metric, c.satellite, e.idx, 0.0::DOUBLE AS v,
    (2 * g - a1 * g1) * e.v + (g - a2 * g1) * e.v AS s1, (g - a2 * g1) * e.v AS s2,
    (2 - b1 * g2) * g1 * e.v + (1 - b2 * g2) * g1 * e.v AS t1, (1 - b2 * g2) * g1 * e.v AS t2, true AS fresh
  FROM {coef} c JOIN (SELECT metric, satellite, arg_{end}(v, idx) AS v, {end}(idx) AS idx FROM {src} GROUP BY metric, satellite) e ON {same('e', 'c')}
  UNION ALL
  SELECT metric, satellite, idx, o2 AS v, 2 * g * x - a1 * o1 + s2, g * x - a2 * o1, 2 * o1 - b1 * o2 + t2, o1 - b2 * o2, false
  FROM (SELECT r.metric, r.satellite, e.idx, e.v AS x, g * e.v + s1 AS o1, g * e.v + s1 + t1 AS o2, s2, t2, g, a1, a2, b1, b2
        FROM {out}_r r JOIN {coef} c ON {same('c', 'r')} JOIN {src} e ON {same('e', 'r')}
         AND e.idx = CASE WHEN r.fresh THEN r.idx ELSE r.idx {step} END) q),
{out} AS MATERIALIZED (SELECT metric, satellite, idx, v FROM {out}_r WHERE NOT fresh)"""


def _filter_sql(r: int) -> str:
    """CTE x{r + 1}: x{r} of the series with a period, low-passed at 1 / period of the highest frequency."""
    den = lambda t: f"((4 - w * cos({t})) ** 2 + (w * sin({t})) ** 2)"
    num = lambda t: f"((4 + w * cos({t})) ** 2 + (w * sin({t})) ** 2)"
    a, b = "(pi() * 5 / 8)", "(pi() * 7 / 8)"
    return f"""
cw{r} AS (SELECT *, 4 * tan(pi() / period / 2) AS w FROM pd{r} WHERE n > 15),
cp{r} AS (SELECT metric, satellite, n, w ** 4 / ({den(a)} * {den(b)}) AS g, -2 * (16 - w * w) / {den(a)} AS a1, {num(a)} / {den(a)} AS a2,
          -2 * (16 - w * w) / {den(b)} AS b1, {num(b)} / {den(b)} AS b2 FROM cw{r}),
co{r} AS MATERIALIZED (SELECT *, 4 * g / (1 + a1 + a2) AS g1, 4 / (1 + b1 + b2) AS g2 FROM cp{r}),
ed{r} AS (SELECT x.metric, x.satellite, x.n, max(v) FILTER (idx = 0) AS v0, max(v) FILTER (idx = x.n - 1) AS vn FROM x{r} x JOIN co{r} c ON {same('c', 'x')} GROUP BY ALL),
ex{r} AS MATERIALIZED (SELECT x.metric, x.satellite, x.idx, x.v FROM x{r} x JOIN co{r} c ON {same('c', 'x')}
  UNION ALL SELECT x.metric, x.satellite, -x.idx, 2 * e.v0 - x.v FROM x{r} x JOIN ed{r} e ON {same('e', 'x')} WHERE x.idx BETWEEN 1 AND 15
  UNION ALL SELECT x.metric, x.satellite, 2 * (x.n - 1) - x.idx, 2 * e.vn - x.v FROM x{r} x JOIN ed{r} e ON {same('e', 'x')} WHERE x.idx BETWEEN x.n - 16 AND x.n - 2),
{_pass_sql(f'fw{r}', f'ex{r}', f'co{r}', False)},
{_pass_sql(f'bw{r}', f'fw{r}', f'co{r}', True)},
x{r + 1} AS MATERIALIZED (SELECT b.metric, b.satellite, b.idx, b.v, c.n FROM bw{r} b JOIN co{r} c ON {same('c', 'b')} WHERE b.idx BETWEEN 0 AND c.n - 1)"""


QUARTER_SQL = f"""
nq AS MATERIALIZED (SELECT metric, satellite, count(*) // 4 AS n FROM reg GROUP BY ALL),
x1 AS MATERIALIZED (SELECT r.metric, r.satellite, r.idx, r.value AS v, nq.n FROM reg r JOIN nq ON {same('r', 'nq')} WHERE r.idx < nq.n)"""

FFT_SQL = ",\n".join([x for r in (1, 2, 3) for x in (_period_sql(r), _filter_sql(r))] + [_period_sql(4)]) + """,
fft_lags AS MATERIALIZED (""" + " UNION ALL ".join(f"SELECT metric, satellite, period AS lag, {r}::BIGINT AS round FROM pd{r}" for r in (1, 2, 3, 4)) + ")"

ACF_SQL = acf_sql("qacf", "x1", "v") + ",\n" + acf_lags_sql("acf_lags", "qacf", 5)

SIZING_SQL = """
sz0 AS (SELECT metric, satellite, count(*) AS n, min(freq_s) AS freq_s, ((count(*) // 4) * 2) // 10 AS w FROM reg GROUP BY metric, satellite),
sz AS MATERIALIZED (SELECT metric, satellite, n, freq_s, CASE WHEN w < 2 THEN 2 ELSE w END AS window_size,
  CASE WHEN w < 2 THEN []::BIGINT[] ELSE list_filter([w, 2 * w, 3 * w], lambda l: l < 7776000 / freq_s) END AS lags_pos,
  least(2000, n // 100) AS frac, greatest(2, (least(2000, n // 100) * 6) // 10) AS n_windows FROM sz0)"""

SELECT_SQL = f"""
found AS (SELECT metric, satellite, list(DISTINCT lag) AS l FROM (SELECT metric, satellite, lag FROM acf_lags UNION ALL SELECT metric, satellite, lag FROM fft_lags)
          WHERE lag NOT IN (1, 2, 3) GROUP BY metric, satellite),
both0 AS (SELECT s.*, list_concat(coalesce(f.l, []::BIGINT[]), s.lags_pos) AS base FROM sz s LEFT JOIN found f ON {same('f', 's')}),
sel AS MATERIALIZED (SELECT *, list_sort(list_distinct(list_filter(flatten(list_transform(base, lambda v: [v - 1, v, v + 1])), lambda v: v > 10))) AS lags FROM both0),
chosen AS MATERIALIZED (SELECT metric, satellite, n, freq_s, window_size, lags_pos, frac, n_windows, lags,
  CASE WHEN len(lags) > 0 THEN least(list_min(lags), window_size // 2) ELSE window_size // 2 END AS min_lag,
  greatest(coalesce(list_max(lags), 0), coalesce(list_max(lags_pos), 0) + window_size) AS max_lag FROM sel)"""

SEASON_SQL = f"""
sk AS (SELECT metric, satellite, greatest(floor(count(*) * 0.02), 1)::BIGINT AS k FROM reg GROUP BY metric, satellite),
sd0 AS (SELECT r.metric, r.satellite, r.idx, sk.k, (r.value - b.value) / sk.k AS d FROM reg r JOIN sk ON {same('sk', 'r')}
        LEFT JOIN reg b ON {same('b', 'r')} AND b.idx = r.idx - sk.k),
sd AS MATERIALIZED (SELECT metric, satellite, idx, coalesce(d, max(d) FILTER (idx = k) OVER ({PK})) AS d FROM sd0),
{acf_sql('sacf', 'sd', 'd', 'd IS NOT NULL')},
{acf_lags_sql('season_lags', 'sacf', 6)},
season AS MATERIALIZED (SELECT metric, satellite, lag AS season FROM season_lags WHERE rank = 1)"""
