"""Typed columns out of JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.scalars import json_is_scalar


def _schema(paths: list[tuple[str, ...]]) -> StructType:
    """Struct of texts that holds every path."""
    heads = dict.fromkeys(p[0] for p in paths)
    return StructType([StructField(h, _schema(inner) if (inner := [p[1:] for p in paths if p[0] == h and len(p) > 1])
                                   else StringType()) for h in heads])


def flatten_json(df: DataFrame, col: str, fields: Mapping[str, str | tuple[str, str]], or_first_element: bool = True,
                 strict: bool = False) -> DataFrame:
    """Add one typed column per field; the text is parsed once for all of them.

    ``fields`` maps a column to its type, or to (dotted path, type). With ``or_first_element`` the text may be an object
    or an array whose first element holds the fields; otherwise an array has no fields. Only scalar values count: a path
    that leads to an object or array gives NULL. Text that does not fit its type gives NULL, or an error when ``strict``.
    """
    specs = {name: (tuple(spec[0].split(".")), spec[1]) if isinstance(spec, tuple) else ((name,), spec)
             for name, spec in fields.items()}
    schema, text = _schema([path for path, _ in specs.values()]), F.col(col)
    is_array = F.ltrim(text).startswith("[")
    record = F.when(~is_array, F.from_json(text, schema))
    if or_first_element:
        record = F.when(is_array, F.get(F.from_json(text, ArrayType(schema)), F.lit(0))).otherwise(F.from_json(text, schema))
    parsed = df.withColumn("_json", record).withColumn("_in_array", is_array)
    out = {}
    for name, (path, kind) in specs.items():
        value, inner = F.col(".".join(["_json", *[f"`{p}`" for p in path]])), "".join(f"['{p}']" for p in path)
        # only a value that begins like an object or array needs its JSON type
        scalar = F.when(F.col("_in_array"), json_is_scalar(text, f"$[0]{inner}")).otherwise(json_is_scalar(text, f"${inner}"))
        kept = F.when(~value.rlike(r"^[{\[]") | scalar, value)
        out[name] = kept.cast(kind) if strict else kept.try_cast(kind)
    return parsed.withColumns(out).drop("_json", "_in_array")


def map_of_entries(df: DataFrame, keys, key: str, value: str, out: str) -> DataFrame:
    """Key-value rows to one map per group; NULL keys are ignored, repeated keys keep their largest value."""
    entries = (df.groupBy(*keys, key).agg(F.max(value).alias(value)))
    pairs = F.array_sort(F.collect_list(F.when(F.col(key).isNotNull(), F.struct(key, value))))
    return entries.groupBy(*keys).agg(F.map_from_entries(pairs).alias(out))
