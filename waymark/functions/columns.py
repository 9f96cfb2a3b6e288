"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.spec import ENTITY, ITEM


def pair_key(entity: str = ENTITY, item: str = ITEM) -> Column:
    """Text key of an (entity, item) pair; a missing item leaves the entity alone."""
    return F.concat_ws("_", F.col(entity), F.col(item))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def rate(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den where den is positive, else the default."""
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def null_if(value: Column, sentinel) -> Column:
    return F.nullif(value, F.lit(sentinel))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def unit_clip(value: Column) -> Column:
    """Value limited to [0, 1]; null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def at_least(score: Column, cut: float) -> Column:
    return (score >= F.lit(cut)).cast("int")


def year_of(yyyymmdd: Column) -> Column:
    return F.substring(yyyymmdd.cast("string"), 1, 4)


def steps(value: Column, limits: list[tuple[float, str]], last: str) -> Column:
    """Label of the first limit the value does not exceed, else the last label."""
    (first_limit, first_label), *rest = limits
    out = F.when(value <= first_limit, F.lit(first_label))
    for limit, label in rest:
        out = out.when(value <= limit, F.lit(label))
    return out.otherwise(F.lit(last))


def duration_bucket(value: Column) -> Column:
    return (
        F.when(value <= 5, F.lit("short"))
        .when((value >= 6) & (value <= 7), F.lit("mid"))
        .otherwise(F.lit("long"))
    )


def value_bucket(value: Column) -> Column:
    return steps(value, [(5, "low"), (10, "mid")], "high")


def known_level(value: Column, levels: list) -> Column:
    """The value where it is a known level, else null."""
    return F.when(value.isin(levels), value)
