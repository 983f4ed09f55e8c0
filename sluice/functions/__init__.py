"""Column expressions: labels, percentages, hash buckets."""

from sluice.functions.columns import (
    CONVERTED, NOT_CONVERTED, class_name, conversion_label, hash_bucket, percent,
)

__all__ = ["CONVERTED", "NOT_CONVERTED", "class_name", "conversion_label", "hash_bucket",
           "percent"]
