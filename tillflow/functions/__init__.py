from .channels import CHANNEL_PREFIXES, FUNNEL_SOURCES, PAGE_MEDIUMS, PAGE_SOURCES, map_channel
from .dates import date_steps, month_start, next_month_start, parse_datetime
from .scalars import (exact_sum, greatest_strict, json_either, json_scalar, least_strict, regex_group, safe_divide,
                      typed_null)

__all__ = [
    "CHANNEL_PREFIXES", "FUNNEL_SOURCES", "PAGE_MEDIUMS", "PAGE_SOURCES", "map_channel",
    "date_steps", "month_start", "next_month_start", "parse_datetime",
    "exact_sum", "greatest_strict", "json_either", "json_scalar", "least_strict", "regex_group", "safe_divide", "typed_null",
]
