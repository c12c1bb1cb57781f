"""Scalar column expressions (rates, shares, labels, text rules)."""

from arearisk.functions.expr import (  # noqa: F401
    capitalize_label, case_class_upper, concat_fields, count_nonempty, floor_fraction,
    hsum, idiv, is_int_text, label_count_pct0, label_name_count_pct, lenient_int,
    nonempty, normalize_int_key, ordinal_street_name, rate_per_1000, ratio_rounded,
    safe_ratio, share_pct, strict_int, trim_field, upper_label,
)
