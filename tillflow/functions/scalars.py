"""Scalar helpers whose NULL and error rules differ from Spark's built-ins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """``num / den``, NULL when the divisor is zero or either side is NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def _any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def greatest_strict(*cols: Column | str) -> Column:
    """``greatest`` that is NULL as soon as one input is NULL."""
    cs = [_col(c) for c in cols]
    return F.when(~_any_null(cs), F.greatest(*cs))


def least_strict(*cols: Column | str) -> Column:
    """``least`` that is NULL as soon as one input is NULL."""
    cs = [_col(c) for c in cols]
    return F.when(~_any_null(cs), F.least(*cs))


def json_is_scalar(text: Column, path: str) -> Column:
    """Whether the value at ``path`` is a text, number or boolean, by its JSON type; NULL where there is none.

    A text that the typed parser rejects, such as one with a repeated key, is judged by the first letter of its value.
    """
    parsed = F.try_parse_json(text)
    kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    nested = F.when(parsed.isNotNull(), kind.rlike("^(OBJECT|ARRAY)")).otherwise(F.get_json_object(text, path).rlike(r"^[{\[]"))
    return ~nested


def json_scalar(col: Column | str, path: str) -> Column:
    """Text of a scalar JSON value; NULL when the path is missing or holds an object or array."""
    return F.when(json_is_scalar(_col(col), path), F.get_json_object(_col(col), path))


def json_either(col: Column | str, field: str) -> Column:
    """A field of a JSON object, or of the first element when the text is an array of objects."""
    return F.coalesce(json_scalar(col, f"$.{field}"), json_scalar(col, f"$[0].{field}"))


def regex_group(col: Column | str, pattern: str, group: int = 1) -> Column:
    """One capture group, NULL when the pattern does not match."""
    found = F.regexp_extract(_col(col), pattern, group)
    return F.when(found != "", found)


def exact_sum(c: Column | str, digits: int = 6) -> Column:
    """Sum of a double, each value rounded to ``digits`` decimals and added as an integer.

    The result does not depend on the order of additions, so later tests for equality or zero are stable. Meant for
    sums per entity: the total must stay below 9.2e18 / 10^digits.
    """
    scale = float(10 ** digits)
    return F.sum(F.rint(_col(c) * scale).cast("long")) / scale


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)
