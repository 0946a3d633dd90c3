"""JSON texts as VARIANT columns: parsed once at a table's edge, read by path afterwards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def parse_columns(df: DataFrame, cols: Sequence[str], suffix: str = "_v") -> DataFrame:
    """Add the VARIANT of every text column; text that is no JSON, or an object with a repeated key, gives NULL.

    Staged or written as parquet, the columns keep the parsed form, and jobs that read them parse nothing.
    """
    return df.withColumns({c + suffix: F.try_parse_json(F.col(c)) for c in cols})


def bad_json(df: DataFrame, col: str, suffix: str = "_v") -> DataFrame:
    """The rows whose text is there but was no JSON, for a report. ``df`` comes from :func:`parse_columns`."""
    return df.filter(F.col(col).isNotNull() & F.col(col + suffix).isNull())


def is_scalar(value: Column) -> Column:
    """Whether a variant is a text, number or boolean; NULL for NULL and for JSON null."""
    kind = F.schema_of_variant(value)
    return F.when(kind != "VOID", ~(kind.startswith("OBJECT") | kind.startswith("ARRAY")))


def _path(path: str) -> str:
    # keys in quotes, so that blanks and other signs in a key are part of it
    return "".join(f'["{p}"]' for p in path.split("."))


def variant_fields(df: DataFrame, col: str, fields: Mapping[str, str | tuple[str, str]], or_first_element: bool = True, strict: bool = False) -> DataFrame:
    """Add one typed column per field of the VARIANT column ``col``.

    ``fields`` maps a column to its type, or to (dotted path, type). With ``or_first_element`` the value may be an object or an array whose first
    element holds the fields; else an array has no fields. Only scalars count: a path to an object, an array or nothing gives NULL. A scalar
    is read as its text and cast, so ``"12"`` and ``12`` are the same number; what does not fit gives NULL, or an error when ``strict``.
    """
    record = F.col(col)
    if or_first_element:
        # an array gives its first element, an object has none
        record = F.coalesce(F.try_variant_get(record, "$[0]", "variant"), record)
    held = df.withColumn("_record", record)
    specs = {name: spec if isinstance(spec, tuple) else (name, spec) for name, spec in fields.items()}
    values = {name: F.try_variant_get("_record", "$" + _path(path), "variant") for name, (path, _) in specs.items()}
    held = held.withColumn("_values", F.struct(*[v.alias(name) for name, v in values.items()]))
    held = held.withColumn("_texts", F.struct(*[F.try_variant_get(F.col(f"_values.`{name}`"), "$", "string").alias(name) for name in specs]))
    out = {}
    for name, (_, kind) in specs.items():
        text = F.col(f"_texts.`{name}`")
        # only a value that begins like an object or array needs its type looked at
        kept = F.when(~F.substring(text, 1, 1).isin("{", "[") | is_scalar(F.col(f"_values.`{name}`")), text)
        out[name] = kept.cast(kind) if strict else kept.try_cast(kind)
    return held.withColumns(out).drop("_record", "_values", "_texts")


def flatten_variant(df: DataFrame, col: str, fields: Mapping[str, str | tuple[str, str]], or_first_element: bool = True, strict: bool = False) -> DataFrame:
    """:func:`variant_fields` of a text column that is parsed here, once per row, and not kept."""
    parsed = parse_columns(df, [col], suffix="_parsed")
    return variant_fields(parsed, f"{col}_parsed", fields, or_first_element, strict).drop(f"{col}_parsed")
