"""Dictionary lookups as literal maps (no join for a handful of entries)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def lookup(mapping: dict, key: Column, default: str | None = None) -> Column:
    """``mapping[key]``; a miss (or NULL key) gives ``default`` (NULL if none)."""
    hit = F.when(key.isNotNull(), F.try_element_at(literal_map(mapping), key))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def sql_lookup(mapping: dict, expr: str, default: str | None = None) -> str:
    arms = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"(CASE {arms}{tail} END)"
