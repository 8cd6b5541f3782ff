"""Pieces of DuckDB SQL that several operators' queries are checked with."""

from __future__ import annotations


def _nibble_table() -> list[int]:
    """What four zero bits do to each remainder of the CRC-32 polynomial."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32(text: str) -> str:
    """An expression for the unsigned CRC-32 of a text's UTF-8 bytes, four bits at a time."""
    # Half bytes, the lower one of each byte first, behind the start value.
    digit = f"strpos('0123456789ABCDEF', substr(hex({text}), xor(i, 1) + 1, 1)) - 1"
    halves = f"list_transform(range(2 * strlen({text})), lambda i: CAST({digit} AS BIGINT))"
    step = f"xor({_nibble_table()}[(xor(c, h) & 15) + 1], c >> 4)"
    return f"CASE WHEN {text} IS NOT NULL THEN xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {halves}), lambda c, h: {step}), 4294967295) END"
