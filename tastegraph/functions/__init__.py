"""Scalar column expressions (all built-in Spark functions, codegen friendly)."""

from tastegraph.functions.expressions import (
    ascii_only,
    epoch_seconds,
    hash_unit,
    parse_delimited,
    safe_ratio,
    split_digit,
)

__all__ = ["ascii_only", "epoch_seconds", "hash_unit", "parse_delimited", "safe_ratio", "split_digit"]
