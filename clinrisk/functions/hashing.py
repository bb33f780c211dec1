"""Deterministic, partition-independent pseudo-random draws.

A draw is a pure function of (seed, tag, row id): the md5 digest of the three
joined by ``|`` is cut into four 32-bit words, and word ``k`` maps to the open
interval (0, 1) as ``(word + 0.5) / 2**32``.  Unlike ``rand(seed)`` the value
does not depend on partitioning or task order, so a recomputed task (executor
loss) or a re-run on another cluster yields the same data, and the same
expression can be written in plain SQL for an independent check.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinrisk.config import SEED

_TWO_32 = float(2 ** 32)
TWO_PI = 2.0 * math.pi


def digest(tag: str, row_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), F.lit(tag), row_id.cast("string")))


def uniform(tag: str, row_id: Column, k: int = 0) -> Column:
    """Uniform (0, 1) draw ``k`` (0..3) of ``tag`` for ``row_id``.

    Draws of one tag share one digest; whole-stage codegen evaluates the
    common md5 sub-expression once per row.
    """
    if not 0 <= k <= 3:
        raise ValueError("k must be in 0..3")
    word = F.conv(F.substring(digest(tag, row_id), 8 * k + 1, 8), 16, 10).cast("bigint")
    return (word.cast("double") + F.lit(0.5)) / F.lit(_TWO_32)


def gauss(tag: str, row_id: Column, pair: int, mean: Column | float, sd: Column | float) -> Column:
    """Normal draw via Box-Muller from uniforms ``2*pair`` and ``2*pair+1`` of ``tag``."""
    u1 = uniform(tag, row_id, 2 * pair)
    u2 = uniform(tag, row_id, 2 * pair + 1)
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(TWO_PI) * u2)
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    sd = sd if isinstance(sd, Column) else F.lit(sd)
    return mean + sd * z


def randint(tag: str, row_id: Column, k: int, lo: int, hi: int) -> Column:
    """Integer in [lo, hi] (both inclusive) from draw ``k``."""
    return (F.lit(lo) + F.floor(uniform(tag, row_id, k) * F.lit(float(hi - lo + 1)))).cast("bigint")


# SQL spelling of the same draws, for the independent DuckDB check.

def sql_uniform(tag: str, row_id_sql: str, k: int = 0) -> str:
    return (f"((('0x' || substr(md5(concat_ws('|', '{SEED}', '{tag}', CAST({row_id_sql} AS VARCHAR))), "
            f"{8 * k + 1}, 8))::BIGINT + 0.5) / {_TWO_32!r})")


def sql_gauss(tag: str, row_id_sql: str, pair: int, mean_sql: str, sd_sql: str) -> str:
    u1 = sql_uniform(tag, row_id_sql, 2 * pair)
    u2 = sql_uniform(tag, row_id_sql, 2 * pair + 1)
    return f"({mean_sql} + {sd_sql} * (sqrt(-2.0 * ln({u1})) * cos({TWO_PI!r} * {u2})))"


def sql_randint(tag: str, row_id_sql: str, k: int, lo: int, hi: int) -> str:
    return f"CAST({lo} + floor({sql_uniform(tag, row_id_sql, k)} * {float(hi - lo + 1)!r}) AS BIGINT)"
