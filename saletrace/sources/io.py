"""Reading inputs, constant relations, and writing snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A constant relation built from Python rows is bounded by construction; it
# is broadcast only under this row count, above it Spark's size-based join
# selection decides.
MAX_BROADCAST_LOOKUP_ROWS = 10_000


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a parquet dataset by path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_tables(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for ``base/name.parquet`` (or catalog tables
    ``base.name`` when ``base`` has no slash)."""
    if "/" in base:
        return {n: spark.read.parquet(f"{base.rstrip('/')}/{n}.parquet") for n in names}
    return {n: spark.table(f"{base}.{n}") for n in names}


def constant_relation(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """``VALUES ... AS t(a, b)`` as a JVM-side relation (literals inlined
    into the plan, no Python worker).  ``schema``: ``"a string, b int"``."""
    fields = [f.strip().split(None, 1) for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields)])
               for r in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])
    return spark.range(1).select(F.inline(F.array(*structs)))


def lookup(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant relation, broadcast when its row count is under
    ``MAX_BROADCAST_LOOKUP_ROWS`` (its size is bounded by construction)."""
    df = constant_relation(spark, rows, schema)
    return F.broadcast(df) if len(rows) <= MAX_BROADCAST_LOOKUP_ROWS else df


def write_snapshot(df: DataFrame, path: str, run_id: str | None = None,
                   sort_within: Sequence[str] | None = None) -> str:
    """Materialise a result (``CREATE OR REPLACE TABLE ... AS``).

    Each run writes its own folder ``path/run_id=<id>`` so a later step and a
    comparison between runs read immutable snapshots, and a job never
    overwrites what it reads.  Returns the folder written.
    """
    target = f"{path.rstrip('/')}/run_id={run_id}" if run_id is not None else path
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out.write.mode("overwrite").parquet(target)
    return target


def read_snapshot(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    target = f"{path.rstrip('/')}/run_id={run_id}" if run_id is not None else path
    return spark.read.parquet(target)
