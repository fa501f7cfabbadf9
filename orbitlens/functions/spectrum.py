"""Spectrum traces and constellations (X1-X5) as column expressions.

A spectrum record holds ``powers ARRAY<DOUBLE>`` (dB) or its compact form
``trace STRING`` (two upper-case hex digits per bin, scaled to 0..255 by the
record's own min / max) plus frequency metadata.  All functions are
higher-order array expressions evaluated inside whole-stage codegen; no
per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trace_min_max(powers) -> tuple[Column, Column]:
    """min and max of the powers, times 100 (the stored ``min_val``/``max_val``)."""
    p = _c(powers)
    return F.array_min(p) * 100, F.array_max(p) * 100


def encode_trace(powers) -> Column:
    """Powers -> hex trace.

    byte = round_half_even((p*100 - min) * 255 / (max - min)); a flat trace
    (max = min) encodes to all zero bytes (the reference divides by zero).
    The row's min / max are bound once (a one-element array of a struct fed
    to an outer lambda) instead of being re-evaluated for every bin.
    """
    p = _c(powers)
    mn, mx = trace_min_max(p)
    bounds = F.array(F.struct(mn.alias("mn"), (mx - mn).alias("rng")))

    def encode(b):
        def byte(x):
            v = F.when(b["rng"] == 0, F.lit(0)).otherwise(
                F.bround((x * 100 - b["mn"]) * 255 / b["rng"], 0).cast("int"))
            return F.lpad(F.upper(F.hex(v)), 2, "0")
        return F.array_join(F.transform(p, byte), "")

    return F.element_at(F.transform(bounds, encode), 1)


def decode_trace(trace, min_val, max_val) -> Column:
    """Hex trace -> powers = (min + byte * (max - min) / 255) / 100.

    The trace's two-digit groups and the row's min / max are bound once per
    row (one-element struct array fed to an outer lambda), so an upstream
    expression producing them is not re-evaluated per bin.
    """
    t, mn, mx = _c(trace), _c(min_val), _c(max_val)
    bound = F.array(F.struct(F.regexp_extract_all(t, F.lit("([0-9A-Fa-f]{2})"), 1).alias("pairs"),
                             mn.alias("mn"), (mx - mn).alias("rng")))

    def decode(b):
        vals = F.transform(b["pairs"], lambda h: (b["mn"] + F.conv(h, 16, 10).cast("double") * b["rng"] / 255) / 100)
        return F.when(F.size(b["pairs"]) > 0, vals)

    return F.element_at(F.transform(bound, decode), 1)


def explode_spectrum(df: DataFrame, *, powers: str = "powers", start: str = "start_frequency",
                     stop: str = "stop_frequency", keep=()) -> DataFrame:
    """One row per bin; frequency (MHz) = linspace(start, stop, n)[i] / 1e6.

    As numpy's linspace, the last bin is exactly ``stop`` and n = 1 gives
    ``start``.
    """
    x = df.select(*keep, start, stop, F.size(powers).alias("_n"),
                  F.posexplode(powers).alias("bin", "amplitude"))
    step = (F.col(stop) - F.col(start)) / (F.col("_n") - 1)
    f = (F.when(F.col("_n") == 1, F.col(start))
         .when(F.col("bin") == F.col("_n") - 1, F.col(stop))
         .otherwise(F.col(start) + F.col("bin") * step))
    return x.select(*keep, "bin", (f / 1e6).alias("frequency_mhz"), "amplitude")


def trace_display_params(min_val, max_val) -> tuple[Column, Column]:
    """``ref_level = ceil(max/10)``, ``scale = ceil((ref_level - min)/10)``."""
    ref = F.ceil(_c(max_val) / 10).cast("double")
    return ref, F.ceil((ref - _c(min_val)) / 10).cast("double")


def pair_iq(values) -> Column:
    """Build IQ samples STRUCT<re, im> from consecutive pairs of a numeric array."""
    v = _c(values)
    n = F.floor(F.size(v) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1),
                       lambda i: F.struct(F.element_at(v, i * 2 + 1).cast("double").alias("re"),
                                          F.element_at(v, i * 2 + 2).cast("double").alias("im")))


def explode_constellation(df: DataFrame, *, iq: str = "constellation", keep=()) -> DataFrame:
    """Point count and one row per IQ point; y = real part, x = imaginary
    part (as the reference lays them out)."""
    x = df.select(*keep, F.size(iq).alias("num_pts_constellation"),
                  F.posexplode(iq).alias("point", "_p"))
    return x.select(*keep, "num_pts_constellation", "point",
                    F.col("_p.re").alias("constellation_y"), F.col("_p.im").alias("constellation_x"))
