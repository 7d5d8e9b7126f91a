"""Column profile (C12): per table and column, the data type, ordinal
position and row / non-null / distinct counts.

The original lists ``information_schema.columns`` (catalog, schema, table,
column, data type) through a warehouse client.  Here the names and types
come from each DataFrame's schema and the counts from one pass over each table
and one shuffle for all of them; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saletrace.sources.io import constant_relation


COUNTS = ("row_count", "non_null_count", "distinct_count")
LISTING = ("table_catalog string, table_schema string, table_name string, column_name string, "
           "data_type string, ordinal_position int")


def _cells(df: DataFrame, number: int) -> DataFrame:
    """``t, o, known, h1, h2``: a narrow row per value, with its 128-bit hash
    (two of 64 bits); the values themselves are not carried."""
    cells = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        # a map has no hash of its own
        v = F.to_json(F.struct(c.alias("v"))) if "map<" in f.dataType.simpleString() else c
        cells.append(F.struct(F.lit(i + 1).alias("o"), c.isNotNull().alias("known"),
                              F.xxhash64(F.lit(1), v).alias("h1"), F.xxhash64(v, F.lit(2)).alias("h2")))
    return (df.select(F.explode(F.array(*cells)).alias("c"))
            .select(F.lit(number).alias("t"), "c.*"))


def _counts(tables: Sequence[DataFrame], exact: bool) -> DataFrame:
    """``t, o`` and the three counts, of all tables together: every table is
    scanned once, and equal values are counted before the one shuffle."""
    cells = reduce(DataFrame.unionByName, [_cells(df, i) for i, df in enumerate(tables)])
    known = F.col("known")
    if not exact:
        return cells.groupBy("t", "o").agg(
            F.count(F.lit(1)).alias("row_count"), F.count(F.when(known, F.lit(1))).alias("non_null_count"),
            F.approx_count_distinct(F.when(known, F.col("h1"))).alias("distinct_count"))
    values = cells.groupBy("t", "o", "known", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("t", "o").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(known, F.col("n"))).alias("non_null_count"),
        F.count(F.when(known, F.lit(1))).alias("distinct_count"))


def profile_table(name: str, df: DataFrame, exact: bool = True, catalog: str = "",
                  schema: str = "") -> DataFrame:
    """One row per column of ``df``: ``(table_catalog, table_schema,
    table_name, column_name, data_type, ordinal_position, row_count,
    non_null_count, distinct_count)``.  Distinct values are told apart by a
    128-bit hash; ``exact=False`` estimates their number by HyperLogLog."""
    return _profiles([(catalog, schema, name, df)], exact, False, True)


def column_listing(name: str, df: DataFrame, catalog: str = "", schema: str = "") -> DataFrame:
    """Catalog, schema, table, column, data type and position from the schema
    alone: no pass over the data."""
    rows = [(catalog, schema, name, f.name, f.dataType.simpleString(), i + 1)
            for i, f in enumerate(df.schema.fields)]
    return constant_relation(df.sparkSession, rows, LISTING)


def _profiles(tables: Sequence[tuple[str, str, str, DataFrame]], exact: bool, sort: bool,
              counts: bool) -> DataFrame:
    if not tables:
        raise ValueError("no table to profile")
    tables = sorted(tables, key=lambda t: t[:3])
    spark = tables[0][3].sparkSession
    listing = [(c, s, n, f.name, f.dataType.simpleString(), i + 1, at)
               for at, (c, s, n, df) in enumerate(tables) for i, f in enumerate(df.schema.fields)]
    out = constant_relation(spark, listing, LISTING + ", _t int")
    if counts:
        found = _counts([df for *_, df in tables if df.columns], exact).select(
            F.col("t").alias("_at"), F.col("o").alias("_o"), *COUNTS)
        out = out.join(found, (F.col("_t") == F.col("_at")) & (F.col("ordinal_position") == F.col("_o")),
                       "left").select(*out.columns, *[
                           F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS])
    out = out.drop("_t")
    if not sort:
        return out
    # one row per column of a table: few, whatever the tables hold
    w = Window.orderBy("table_catalog", "table_schema", "table_name", "ordinal_position")
    return out.withColumn("pos", F.row_number().over(w)).orderBy("pos")


def profile_columns(tables: Mapping[str, DataFrame], table_filter: Sequence[str] | None = None,
                    exact: bool = True, sort: bool = False, counts: bool = True,
                    catalog: str = "", schema: str = "") -> DataFrame:
    """Profile of every column of the given tables (C12), optionally only
    the tables named in ``table_filter``; ordered by table and ordinal, and
    numbered (``pos``), when ``sort``.  ``counts=False`` lists names, types
    and ordinals only (the original's metadata listing), without reading any
    data."""
    return _profiles([(catalog, schema, n, df) for n, df in tables.items()
                      if table_filter is None or n in set(table_filter)], exact, sort, counts)


def profile_catalog(spark: SparkSession, catalog: str | None = None, schema: str | None = None,
                    tables: Sequence[str] | None = None, counts: bool = True,
                    exact: bool = True, sort: bool = True) -> DataFrame:
    """``_profiles`` over the tables of a Spark catalog: all its schemas, or
    the one named, and optionally only ``tables``, as the filters of the
    original's listing.  Session views are listed under the schema ``''``, so
    a view and a table of one name are two rows.  Only names come to the
    driver."""
    catalog = catalog or spark.catalog.currentCatalog()
    found: dict[tuple[str, str], DataFrame] = {}
    schemas = [schema] if schema is not None else [d.name for d in spark.catalog.listDatabases()]
    for name in schemas:
        for t in spark.catalog.listTables(f"`{catalog}`.`{name}`" if name else None):
            if tables is not None and t.name not in tables:
                continue
            if t.isTemporary or not t.namespace:
                if schema in (None, ""):
                    found[("", t.name)] = spark.table(f"`{t.name}`")
            elif name:
                found[(name, t.name)] = spark.table(f"`{catalog}`.`{name}`.`{t.name}`")
    return _profiles([(catalog if s else "", s, n, df) for (s, n), df in found.items()],
                     exact, sort, counts)
