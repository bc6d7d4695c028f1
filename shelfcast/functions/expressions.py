"""Column expressions (scalar functions F1-F19).  All are built-in Spark expressions, so
they stay inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (ELASTIC_BELOW, NO_EVENT, STOCKOUT_HIGH_BELOW,
                      STOCKOUT_MEDIUM_BELOW)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (pandas ``/ x.replace(0, nan)``; ANSI-safe)."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def nan_to_null(c) -> Column:
    """Source-edge conversion: Spark keeps NaN apart from NULL; the operators use NULL."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


# ---- calendar (F1-F7) --------------------------------------------------------------

def event_or_none(c) -> Column:
    return F.coalesce(col(c), F.lit(NO_EVENT))


def has_event(name1, name2) -> Column:
    return ((col(name1) != NO_EVENT) | (col(name2) != NO_EVENT)).cast("int")


def day_of_week(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(d))


def week_of_year(d) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(col(d))


def is_weekend(d) -> Column:
    return (F.weekday(col(d)) >= 5).cast("int")


def is_month_start(d) -> Column:
    return (F.dayofmonth(col(d)) == 1).cast("int")


def is_month_end(d) -> Column:
    return (col(d) == F.last_day(col(d))).cast("int")


def state_flag(state, flag_by_state: dict[str, str], available: list[str]) -> Column:
    """Flag of the row's own state (F8): ``flags[state]`` with 0 for states without a
    flag column, or when the flag column is missing."""
    present = [(s, c) for s, c in flag_by_state.items() if c in available]
    if not present:
        return F.lit(0)
    lookup = F.create_map(*[x for s, c in present for x in (F.lit(s), F.col(c).cast("int"))])
    return F.coalesce(lookup[col(state)], F.lit(0))


# ---- indices and transforms ---------------------------------------------------------

def day_key_index(d) -> Column:
    """'d_31' -> 31."""
    return F.regexp_replace(col(d), "^d_", "").cast("int")


def clip0(c) -> Column:
    """max(0, c) that keeps NULL as NULL (``greatest`` would skip it)."""
    c = col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(0.0)))


def softplus(c) -> Column:
    c = col(c)
    # log(1 + e^x) = max(x, 0) + log1p(e^-|x|): no overflow for large |x|
    return F.greatest(c, F.lit(0.0)) + F.log1p(F.exp(-F.abs(c)))


def inverse_softplus(c) -> Column:
    c = col(c)
    # log(e^y - 1) = y + log(1 - e^-y); for large y this tends to y
    return c + F.log(-F.expm1(-c))


def pinball(y, yhat, q: float) -> Column:
    """Pinball loss of one error."""
    e = col(y) - col(yhat)
    return F.when(e >= 0, F.lit(q) * e).otherwise(F.lit(q - 1.0) * e)


def demand_multiplier(tau, delta_p) -> Column:
    """max(0, 1 + tau * dP) with NULL when tau or dP is NULL."""
    if isinstance(delta_p, (Column, str)):
        dp = col(delta_p)
    else:
        dp = F.lit(float(delta_p))
    tau = col(tau)
    return F.when(tau.isNull() | dp.isNull(), F.lit(None)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) + tau * dp))


def stockout_risk(min_downside) -> Column:
    m = col(min_downside)
    return (F.when(m < STOCKOUT_HIGH_BELOW, F.lit("High"))
             .when(m < STOCKOUT_MEDIUM_BELOW, F.lit("Medium"))
             .otherwise(F.lit("Low")))


def elasticity_label(tau) -> Column:
    return F.when(col(tau) < ELASTIC_BELOW, F.lit("Highly Elastic")).otherwise(F.lit("Inelastic"))


def quantile_name(q: float) -> str:
    """Column name of a quantile: 0.1 -> 'p10' (rounded, so 0.29 -> 'p29')."""
    return f"p{int(round(q * 100))}"


def fold_of(*keys, n_folds: int = 3) -> Column:
    """Deterministic fold from the first 8 hex digits of md5(key1|key2|...)."""
    h = F.md5(F.concat_ws("|", *[col(k) for k in keys]))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % n_folds).cast("int")
