"""Risk-score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinrisk.config import TIER_HIGH, TIER_MEDIUM


def tier(p: Column) -> Column:
    """High at >= 0.7, Medium at >= 0.4, else Low (NULL stays NULL)."""
    return (F.when(p >= TIER_HIGH, "High").when(p >= TIER_MEDIUM, "Medium")
            .when(p.isNotNull(), "Low"))


def sql_tier(expr: str) -> str:
    return (f"(CASE WHEN {expr} >= {TIER_HIGH} THEN 'High' WHEN {expr} >= {TIER_MEDIUM} THEN 'Medium' "
            f"WHEN {expr} IS NOT NULL THEN 'Low' END)")


def clip01(c: Column) -> Column:
    """Clamp to [0, 1]; NULL stays NULL (``greatest`` alone would turn it into 0)."""
    return F.when(c.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), c)))


def sql_clip01(expr: str) -> str:
    return f"(CASE WHEN ({expr}) IS NOT NULL THEN least(CAST(1.0 AS DOUBLE), greatest(CAST(0.0 AS DOUBLE), {expr})) END)"


def round_dec(c: Column, places: int) -> Column:
    """Round through ``decimal(18,10)`` (HALF_UP on the decimal value), so a
    double that prints as a tie rounds the same way in every engine."""
    return F.round(c.cast("decimal(18,10)"), places).cast("double")


def sql_round_dec(expr: str, places: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18, 10)), {places}) AS DOUBLE)"
