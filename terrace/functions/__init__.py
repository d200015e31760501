"""Scalar column builders."""

from terrace.functions.columns import (  # noqa: F401
    all_true,
    bound_key,
    date_key,
    factor_case,
    is_false,
    lower_in,
    money,
    parse_date_key,
    rounded,
)
