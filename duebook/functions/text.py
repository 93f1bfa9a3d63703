"""Text functions that lose no character."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_padded(text: Column, width: int) -> Column:
    """Zeros in front up to ``width``; a longer text stays whole (``lpad`` alone would cut it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
