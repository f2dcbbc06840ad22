"""Printed sizes, shares and divisions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unit names by base (fixed values).
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]
COUNT_UNITS = ["", "тыс", "млн", "млрд", "трлн", "птлн"]


def readable_size(value: Column, base: int = 1024) -> Column:
    """``1.5 MB``: two decimals at most, sign kept, ``0 B`` for zero and NULL."""
    units = BYTE_UNITS if base == 1024 else COUNT_UNITS
    size = F.abs(F.coalesce(value.cast("double"), F.lit(0.0)))
    number, unit = size, F.lit(units[0])
    for power in range(1, len(units)):
        reached = size >= float(base) ** power
        number = F.when(reached, size / (float(base) ** power)).otherwise(number)
        unit = F.when(reached, F.lit(units[power])).otherwise(unit)
    digits = F.when(size > 0, F.bround(number, 2).cast("string")).otherwise("0")
    return F.rtrim(F.concat(F.when(value < 0, F.lit("-")).otherwise(""), digits, F.lit(" "), unit))


def size_bytes(text: str | int | None) -> int | None:
    """``"100 MB"`` or a number of bytes; empty means no bound."""
    if text is None or str(text).strip() in ("", "None"):
        return None
    number, _, unit = str(text).strip().partition(" ")
    power = BYTE_UNITS.index(unit.strip().upper()) if unit.strip() else 0
    return int(float(number) * 1024 ** power)


def share(part: Column, total: Column) -> Column:
    """Whole percent, halves to the even side; NULL for an empty total."""
    return F.when(total != 0, F.bround(part * F.lit(100.0).cast("double") / total, 0)).cast("bigint")


def ceil_div(value: Column, by: Column) -> Column:
    return F.ceil(value / F.nullif(by, F.lit(0))).cast("bigint")
