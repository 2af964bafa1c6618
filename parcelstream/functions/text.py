"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_name(c) -> Column:
    """Keep the first character, replace every following one by ``*``.
    Null stays null, the empty string stays empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.substring(c, 1, 1), F.regexp_replace(F.substring(c, F.lit(2), F.length(c)), ".", "*"))
