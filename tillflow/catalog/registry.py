"""Registry of checked queries.

Both sides of a check show dates as text and doubles rounded to the same declared digits, so the comparison does not
hang on client types or on the order of additions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import tuned
from ..sources.writers import scratch_path
from ..testbed import tables as shop_tables
from ..testbed.tables import ShopTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# the same queries without the comparison's rounding and date text, for timing
PLAIN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# SQL of the hubs, shared by the twins of the jobs built on them
HUBS: dict[str, str] = {}

DATE, STAMP = "%Y-%m-%d", "%Y-%m-%d %H:%M:%S.%f"


def _shown(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    shown = []
    for field in df.schema.fields:
        kind, c = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), digits.get(field.name, 6)) + F.lit(0.0)
        shown.append(c.alias(field.name))
    return df.select(*shown)


def query(name: str, sql: str | None = None, dates: str = "", stamps: str = "", r0: str = "", r2: str = "", r4: str = "",
          r6: str = "", ints: str = "", early: Callable[[ShopTables, Callable[[DataFrame], DataFrame]], DataFrame] | None = None):
    """Register ``fn(shop) -> DataFrame`` and the DuckDB text that must give the same rows.

    The keyword lists name result columns: dates, timestamps, doubles by rounding digits, and 64-bit integers. ``early(shop, show)`` is the
    same query for a job that repeats its values over many rows: it shows them itself, before they are repeated.
    """
    digits = {c: n for n, cols in ((0, r0), (2, r2), (4, r4), (6, r6)) for c in cols.split()}

    def register(fn: Callable[[ShopTables], DataFrame]):
        def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ShopTables(tuned(spark), sf_dir))

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if early is not None:
                return early(ShopTables(tuned(spark), sf_dir), lambda df: _shown(df, digits))
            return _shown(plain(spark, sf_dir), digits)
        run.__name__ = name
        assert name not in QUERIES, name
        QUERIES[name], PLAIN[name] = run, plain
        if sql is not None:
            shown = [f"strftime({c}, '{DATE}') as {c}" for c in dates.split()]
            shown += [f"strftime({c}, '{STAMP}') as {c}" for c in stamps.split()]
            shown += [f"round({c}::double, {n}) + 0.0::double as {c}" for c, n in digits.items()]
            shown += [f"{c}::bigint as {c}" for c in ints.split()]
            text = f"select * replace ({', '.join(shown)}) from ({sql}) as result" if shown else sql
            ORACLES[name] = shop_tables.duckdb_text(shop_tables.with_tables(text, {**shop_tables.SQL, **HUBS}))
        return fn
    return register


def scratch(shop: ShopTables, label: str) -> str:
    """A new folder for queries that write and read back."""
    return scratch_path(shop.spark, label)
