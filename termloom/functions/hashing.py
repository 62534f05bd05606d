"""Row keys and reproducible random draws.

A draw is an MD5 of (seed, key, salt), so it depends on the row alone: not on the order of the
rows, the number of partitions or a retried task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

DRAW_DIGITS = 32
SLOT_DIGITS = 8


def row_key(columns: Sequence[Column]) -> Column:
    """Digest of whole rows.

    The size of each value goes in front of it, so no two rows share a text. Sizes are in bytes:
    those are known without reading the value.
    """
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.octet_length(text).cast("string"), F.lit("N")))
        parts.append(F.coalesce(text, F.lit("")))
    return F.md5(F.concat_ws("|", *parts))


def draw(seed: int, key: Column, *salt: Column) -> Column:
    """32 hexadecimal digits, uniform over keys; a NULL key is an error, as such rows would share one draw."""
    known = F.coalesce(key.cast("string"), F.raise_error("a NULL key has no draw").cast("string"))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), known, *(s.cast("string") for s in salt)))


def slot(drawn: Column, slots: Column) -> Column:
    """Map a draw to one of ``slots`` equal ranges, keeping the order of the draws."""
    head = F.conv(F.substring(drawn, 1, SLOT_DIGITS), 16, 10).cast("bigint")
    return F.shiftright(head * slots.cast("bigint"), 4 * SLOT_DIGITS).cast("int")
