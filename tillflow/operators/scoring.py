"""Hook for a caller's model: score rows in Arrow batches with per-row error capture."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def score_rows(df: DataFrame, id_col: str, payload: Sequence[str], required: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType,
               missing_error: str = "missing input", unique: bool = False) -> DataFrame:
    """One row per id: the id, its ``payload``, the columns that ``fn`` returns and an ``error`` text.

    ``fn`` gets a batch and returns a frame of the same rows in the same order. Rows with an empty ``required`` column are not passed on. If a batch
    fails, its rows are tried one by one, and a row that fails keeps the reason. With ``unique`` ids nothing is shuffled; else a repeated id is
    scored once, with its smallest payload.
    """
    rows = df.select(id_col, *payload)
    if not unique:
        rows = rows.groupBy(id_col).agg(F.min(F.struct(*payload)).alias("_p")).select(id_col, *[F.col("_p")[c].alias(c) for c in payload])
    names = [f.name for f in schema.fields]
    out_schema = StructType([*rows.schema.fields, *schema.fields, StructField("error", StringType())])

    def tried(part: pd.DataFrame) -> pd.DataFrame:
        try:
            return fn(part)[names].reset_index(drop=True).assign(error=None)
        except Exception as exc:  # the row keeps the reason
            if len(part) == 1:
                return pd.DataFrame([{**dict.fromkeys(names), "error": str(exc)}])
            return pd.concat([tried(part.iloc[[i]]) for i in range(len(part))], ignore_index=True)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            given = batch[required].notna() & (batch[required] != "")
            out = batch.assign(**dict.fromkeys(names), error=missing_error).astype({n: object for n in [*names, "error"]})
            if given.any():
                scored = tried(batch[given].reset_index(drop=True))
                scored.index = batch.index[given]
                out.loc[given, [*names, "error"]] = scored[[*names, "error"]].astype(object)
            yield out[[f.name for f in out_schema.fields]]

    return rows.mapInPandas(score, out_schema)
