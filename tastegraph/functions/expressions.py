"""Scalar expressions used across operators.

All of them are plain ``pyspark.sql.functions`` compositions, so they stay in
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_digit(ts) -> Column:
    """Hundreds digit of a unix timestamp: ``(ts div 100) mod 10`` with *floor*
    division, so negative timestamps behave like Python (−150 → 8)."""
    return F.pmod(F.floor(_c(ts) / F.lit(100)), F.lit(10)).cast("int")


def epoch_seconds(ts: str) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ column (given by
    name), independent of the session time zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")


def safe_ratio(num, denom) -> Column:
    """``num / denom`` or 0.0 when the denominator is 0 (or NULL).  ANSI mode
    makes a plain division by zero raise, so use ``try_divide``."""
    return F.coalesce(F.try_divide(_c(num), _c(denom)), F.lit(0.0))


def ascii_only(text) -> Column:
    """Drop every non-ASCII character (display form of a title)."""
    return F.regexp_replace(_c(text), r"[^\x00-\x7F]", "")


def hash_unit(seed, *cols) -> Column:
    """A deterministic, engine-independent pseudo-random number in [0, 2^32)
    from the md5 of ``seed|c1|c2...``.  Used for seeded sampling and splits:
    the same rows get the same value under any partitioning."""
    parts = [F.lit(str(seed))] + [_c(c).cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def parse_delimited(line, sep: str, names: list[str], types: list[str]) -> list[Column]:
    """strip → split → cast of a delimited text line (extra trailing fields are
    ignored).  ``try_cast`` turns a malformed field into NULL instead of failing
    the whole job under ANSI mode."""
    parts = F.split(F.trim(_c(line)), sep_pattern(sep))
    return [F.trim(F.get(parts, F.lit(i))).try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]


def sep_pattern(sep: str) -> str:
    """A literal separator as a (Java) regular expression for ``split``."""
    return re.escape(sep)
