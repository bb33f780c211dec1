"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKENS = r"(\p{L}+|[^\p{L}]+)"


def title_case(c: Column) -> Column:
    """Title case as Python's ``str.title``: capitalise the first letter of
    every run of letters, lower-case the rest (``o'BRIEN-smith`` ->
    ``O'Brien-Smith``).  ``initcap`` only splits on white space, so it would
    give ``O'brien-smith``.  Implemented with a regex tokeniser and a
    higher-order ``transform``; no Python UDF."""
    tokens = F.regexp_extract_all(c, F.lit(_TOKENS), 1)
    fixed = F.transform(
        tokens,
        lambda t: F.when(t.rlike(r"^\p{L}"),
                         F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30))))
        .otherwise(t))
    return F.when(c.isNotNull(), F.array_join(fixed, ""))


def sql_title_case(expr: str) -> str:
    return (f"CASE WHEN {expr} IS NOT NULL THEN array_to_string(list_transform("
            f"regexp_extract_all({expr}, '{_TOKENS}'), "
            f"lambda t: CASE WHEN regexp_matches(t, '^\\p{{L}}') THEN upper(substr(t, 1, 1)) || lower(substr(t, 2)) "
            f"ELSE t END), '') END")


def money_text(c: Column) -> Column:
    """Amount rounded to cents and printed like Python's ``str(float)``
    (``100.0``, ``12345.6``, ``12345.67``) for magnitudes below 1e16."""
    return F.regexp_replace(F.format_string("%.2f", F.round(c, 2)), "0$", "")


def sql_money_text(expr: str) -> str:
    return f"regexp_replace(printf('%.2f', round({expr}, 2)), '0$', '')"


def py_float_text(c: Column) -> Column:
    """A double as Python prints a pandas float cell: shortest repr, ``nan`` for NULL."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def sql_py_float_text(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'nan')"
