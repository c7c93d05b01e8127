"""Column expressions.  All built-in Spark functions: they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """pandas treats NaN as missing; Spark treats NaN > 60 as true.  Normalise on ingest."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def trunc_ntz(ts, grain: str = "hour") -> Column:
    """Truncate a TIMESTAMP_NTZ to hour/day, independent of the session time zone."""
    ts = col_(ts)
    if grain == "hour":
        return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    if grain == "day":
        return F.to_date(ts).cast("timestamp_ntz")
    raise ValueError(f"unknown grain {grain!r}")


def grain_step(grain: str) -> str:
    return {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY"}[grain]


def clip(c, lo: float | None, hi: float | None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (least/greatest would skip a NULL argument)."""
    c = col_(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def lenient_double(c) -> Column:
    """Bad numbers become NULL (ANSI mode would raise)."""
    return col_(c).try_cast("double")


def lenient_timestamp(c) -> Column:
    """Bad timestamps become NULL."""
    return col_(c).try_cast("timestamp_ntz")


def risk_band(score) -> Column:
    # fixed values: UI rule of thumb, > 0.05 "look", > 0.10 "sustained"
    s = col_(score)
    return F.when(s > 0.10, "sustained").when(s > 0.05, "look").otherwise("normal")


def risk_percent(score) -> Column:
    return F.round(col_(score) * 100, 1)


def reason_rule(latency_p95, limit: float = 60.0) -> Column:
    # fixed values: "high latency" when p95 > 60 ms, else "capacity pressure" (missing p95 counts as 0)
    return F.when(F.coalesce(col_(latency_p95), F.lit(0.0)) > limit, "high latency").otherwise("capacity pressure")


def fault_domain(prb, sinr, rsrp, loss, jitter, prb_max: float = 85.0, sinr_min: float = 0.0,
                 rsrp_min: float = -110.0, loss_max: float = 1.0, jitter_max: float = 30.0) -> Column:
    """Failing dimension: capacity (high PRB), radio quality (low SINR / poor RSRP), transport (loss / jitter)."""
    return (F.when(col_(prb) > prb_max, "capacity")
            .when((col_(sinr) < sinr_min) | (col_(rsrp) < rsrp_min), "radio quality")
            .when((col_(loss) > loss_max) | (col_(jitter) > jitter_max), "transport")
            .otherwise("none"))


def opposite_endpoint(src, dst, cell) -> Column:
    return F.when(col_(src) == cell, col_(dst)).otherwise(col_(src))


def minmax_scaled(c, lo: Column, hi: Column) -> Column:
    """(c - lo) / (hi - lo), 0 when the set is constant."""
    c = col_(c)
    return F.when(hi == lo, F.lit(0.0)).otherwise((c - lo) / (hi - lo))
