"""Column checks and rendering shared by the stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """df, or a ValueError that lists what it lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def as_int(c: Column, default: int | None = None) -> Column:
    """Whole-number text as a long; anything else, "1.0" included, is the default."""
    text = F.trim(c.cast("string"))
    return F.coalesce(F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long")), F.lit(default).cast("long"))


def parse_int(c: Column, default: int | None = None) -> Column:
    """Numeric text as a long, cut towards zero ("1.0" is 1)."""
    return F.coalesce(F.trim(c.cast("string")).try_cast("double").cast("long"), F.lit(default).cast("long"))


def as_float(c: Column, default: float | None = None) -> Column:
    return F.coalesce(F.trim(c.cast("string")).try_cast("double"), F.lit(default).cast("double"))


def render_na(df: DataFrame) -> DataFrame:
    """All columns as text for a sink: null as NA, NaN as nan."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")).alias(c) for c in df.columns])


def decimals(c: Column, places: int) -> Column:
    """Fixed decimals as text, as sinks write them."""
    return F.format_string(f"%.{places}f", c)
