"""Reproducible draws from hashed keys, the same on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashed(*parts) -> Column:
    """Hex digest of the parts joined by ``|``."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def uniform(*parts) -> Column:
    """A number in [0, 1) drawn from the parts."""
    word = F.conv(F.substring(hashed(*parts), 1, 8), 16, 10).cast("bigint").cast("double")
    return word / F.lit(4294967296.0)


def hash_cell(digest: Column, digits: int) -> Column:
    """Leading digits of a digest: 16**digits cells of about equal size, in digest order."""
    return F.substring(digest, 1, digits)
