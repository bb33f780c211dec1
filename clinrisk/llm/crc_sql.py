"""crc32 in DuckDB SQL, which has no such function."""

from __future__ import annotations

#: A CTE whose one row ``t`` is the table of the reflected polynomial, by its rule.
CRC = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc32(text: str) -> str:
    """The unsigned crc32 of the UTF-8 of a text with code points under 0x800; ``t`` must be in scope."""
    code = "unicode(ch)::BIGINT"
    octets = (f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN {code} < 128 THEN [{code}] "
              f"ELSE [192 + ({code} >> 6), 128 + ({code} & 63)] END))")
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
