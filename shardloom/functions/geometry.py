"""Columns over dimensions, sizes and offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def align16(n: Column) -> Column:
    return (F.floor((n + 15) / 16) * 16).cast("long")


def ceil_div(a: Column, b: Column) -> Column:
    return F.floor((a + b - 1) / b).cast("long")


def halvings_within(w: Column, h: Column, cap_w: Column, cap_h: Column) -> Column:
    """Least k with w >> k <= cap_w and h >> k <= cap_h."""
    return F.element_at(F.filter(F.sequence(F.lit(0), F.lit(31)), lambda k: (F.call_function("shiftright", w, k) <= cap_w) & (F.call_function("shiftright", h, k) <= cap_h)), 1)


def preset_dims(preset: Column, w: Column, h: Column, rw: Column, rh: Column) -> tuple[Column, Column]:
    """Level-0 dimensions: the master's, or halved until they fit the reference (``low``) or twice it (``default``)."""
    times = F.when(preset == "low", 1).when(preset == "default", 2).when(preset != "bonkers", F.raise_error(F.concat(F.lit("unknown preset: "), preset)).cast("int"))
    k = F.when((preset == "bonkers") | rw.isNull(), F.lit(0)).otherwise(halvings_within(w, h, rw * times, rh * times))
    return F.greatest(F.lit(1), F.call_function("shiftright", w, k)), F.greatest(F.lit(1), F.call_function("shiftright", h, k))


def level_count(w: Column, h: Column) -> Column:
    """Levels of a full chain down to 1 x 1."""
    return F.length(F.bin(F.greatest(w, h)))


def block_bytes(w: Column, h: Column, bw: Column, bh: Column, size: Column) -> Column:
    """Bytes of a block-compressed level."""
    return ceil_div(w, bw) * ceil_div(h, bh) * size


def level_dim(x: Column, level: Column) -> Column:
    return F.greatest(F.lit(1), F.call_function("shiftright", x, level))
