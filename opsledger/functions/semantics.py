"""Column helpers that pin down null, division, rounding and clamping rules.

Rules kept throughout the library:

* aggregate each fact to the target grain before joining;
* rates are recomputed from summed numerators and denominators;
* undefined stays null (zero denominators, unanswered surveys), never 0.

Spark 4 runs with ANSI mode on, where ``x / 0`` raises.  Every division in the
library goes through :func:`ratio`, which returns null instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, null when the denominator is 0 or null."""
    den = col(denominator)
    return F.try_divide(col(numerator).cast("double"), F.when(den != 0, den))


def clamp(value: str | Column, low: float, high: float) -> Column:
    """Clip into [low, high] but keep nulls null (greatest/least skip nulls)."""
    v = col(value)
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(low)), F.lit(high)))


def clip_lower(value: str | Column, low: float = 0.0) -> Column:
    v = col(value)
    return F.when(v.isNotNull(), F.greatest(v, F.lit(low)))


def zero_if_null(value: str | Column) -> Column:
    return F.coalesce(col(value), F.lit(0))


def null_sum(*terms: str | Column) -> Column:
    """Row-wise sum that treats a null term as 0 (pandas ``sum(axis=1)``)."""
    out = F.lit(0.0)
    for t in terms:
        out = out + F.coalesce(col(t).cast("double"), F.lit(0.0))
    return out


def invalid_if_unknown(rule: Column) -> Column:
    """Rule masks treat an undecidable (null) test as a failure."""
    return F.coalesce(rule, F.lit(True))


def not_in(value: str | Column, allowed: Sequence) -> Column:
    """``value NOT IN allowed`` where a null value counts as not allowed."""
    return ~F.coalesce(col(value).isin(list(allowed)), F.lit(False))


def month_text(date: str | Column) -> Column:
    return F.date_format(col(date), "yyyy-MM")


def days_in_month(date: str | Column) -> Column:
    return F.dayofmonth(F.last_day(col(date)))


def weekday(date: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(date))


def daypart(hour: str | Column) -> Column:
    return F.when(col(hour) < 16, F.lit("Lunch")).otherwise(F.lit("Dinner"))


def first_match(cases: Iterable[tuple[Column, object]], default: object) -> Column:
    """Ordered rule list: the first true condition wins (``np.select``)."""
    out = None
    for cond, value in cases:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def cents(value: str | Column) -> Column:
    """Money as an exact integer number of cents."""
    return F.round(col(value) * 100).cast("long")


def money_sum(value: str | Column) -> Column:
    """Exact sum of cent amounts: add integer cents, convert once.

    Integer addition is associative, so the total does not depend on the
    partitioning or the merge order of partial aggregates."""
    return F.sum(cents(value)) / F.lit(100.0)


def snap(value: str | Column, places: int = 6) -> Column:
    """Round to ``places`` decimals as round(x * 10^p) / 10^p (one IEEE multiply,
    so every engine snaps float noise to the same double)."""
    scale = float(10**places)
    return F.round(col(value) * F.lit(scale)) / F.lit(scale)


def exact_avg(value: str | Column, places: int = 6) -> Column:
    """Mean of values snapped to ``places`` decimals, summed as integers."""
    scale = float(10**places)
    v = col(value)
    return F.sum(F.round(v * F.lit(scale)).cast("long")) / F.lit(scale) / F.count(v)


def checked_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    validate: str = "many_to_one",
) -> DataFrame:
    """Join and assert the declared key cardinality of the right side.

    ``validate`` is ``many_to_one`` or ``one_to_one``.  The uniqueness check is
    an aggregate over the right side only (one small job); it raises before the
    join result is used, like pandas ``merge(validate=...)``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    sides = [right] if validate == "many_to_one" else [left, right]
    for side in sides:
        dup = side.groupBy(*keys).count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"join keys {keys} are not unique ({validate})")
    return left.join(right, keys, how)


def unique_on(dim: DataFrame, on: str | list[str]) -> DataFrame:
    """The dimension itself, but a repeated key fails the job that reads it.

    The guard is part of the plan: one aggregate over the dimension, no job of its own and no pass
    over the facts, and every retry checks again. The raised error sits in the key columns, which
    a join always evaluates, so it can't be pruned."""
    keys = [on] if isinstance(on, str) else list(on)
    rest = [c for c in dim.columns if c not in keys]
    held = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest) if rest else F.lit(1)).alias("_rest"))
    types = dict(dim.dtypes)

    def checked(key: str) -> Column:
        says = F.concat(F.lit(f"join keys {keys} are not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
        return F.when(F.col("_n") > 1, F.raise_error(says).cast(types[key])).otherwise(F.col(key)).alias(key)

    return held.select(*(checked(k) if k in keys else F.col("_rest")[k].alias(k) for k in dim.columns))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (no job is run)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - Connect sessions have no _jdf
        return 1 << 62


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint only when the optimizer's size estimate is under ``max_bytes``.

    Beyond the bound the join stays a shuffle join (AQE may still convert it
    at runtime from real statistics).
    """
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round double columns, widen integers to bigint (stable output schema)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("double", "float"):
            # round(x * 10^d) / 10^d: the scaling is one IEEE multiply, so every
            # engine rounds the same binary value (no decimal-string ties)
            scale = float(10**digits)
            out.append(
                (F.round(F.col(f.name) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)).alias(f.name)
            )
        elif t in ("integer", "short", "byte"):
            out.append(F.col(f.name).cast("long").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
