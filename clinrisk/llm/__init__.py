"""Operators for large-scale training-data preparation.

Each ``opN_*`` module holds one operator with a general interface and the thin
query that applies it to a whole driver table.  ``registry`` lists the queries
and their DuckDB SQL.  Nothing outside this subpackage imports it.
"""
