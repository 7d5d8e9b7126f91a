"""Runs of the match as versions, and their comparison bucket by bucket.

A run is the distinct (line, group) rows, written as a version bucketed by the
line (``sources.versions``) with, beside it, the counts that each bucket gives
when it is compared with itself.  ``compare_versions`` joins two runs on their
common buckets, without a shuffle of either.  ``compare_changed`` reads only
the buckets whose digests differ; every other bucket holds the same rows in
both runs, so its stored counts stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saletrace.operators.compare import (
    contributions, counted, grouped_sides, joined_sides, summed_report)
from saletrace.sources.versions import (
    BUCKETS, Version, bucket, current_version, digests, open_version, publish_version, read_files,
    stage_version)


def write_run(df: DataFrame, root: str, run: str, key: str = "oli_id", group: str = "family",
              buckets: int = BUCKETS) -> Version:
    """Write the (key, group) rows of a run and publish them.  They are dealt
    into their buckets before the DISTINCT: one shuffle serves both."""
    spark = df.sparkSession
    v = stage_version(df.select(key, group).repartition(buckets, key).distinct(), root, run, key, buckets)
    rows = open_version(spark, v)
    same = grouped_sides(rows, key, group).withColumn("_gn", F.col("_go"))
    own = contributions(same.withColumn("bucket", bucket("_k", buckets)), "bucket")
    counted(own, "bucket").coalesce(1).write.parquet(v.side("self"))
    publish_version(spark, root, run, v)
    return v


def _pair(spark: SparkSession, root: str, old: str, new: str) -> tuple[Version, Version]:
    a, b = current_version(spark, root, old), current_version(spark, root, new)
    if (a.key, a.buckets, a.schema) != (b.key, b.buckets, b.schema):
        raise ValueError("the runs differ in key, bucket count or schema")
    return a, b


def compare_versions(spark: SparkSession, root: str, old: str, new: str, group: str = "family",
                     count_col: str = "unique_oli_count") -> DataFrame:
    """``compare_snapshots`` of two runs, joined bucket by bucket."""
    a, b = _pair(spark, root, old, new)
    sides = joined_sides(grouped_sides(open_version(spark, a), a.key, group),
                         grouped_sides(open_version(spark, b), b.key, group))
    return summed_report(counted(contributions(sides)), group, count_col)


def changed_buckets(spark: SparkSession, a: Version, b: Version) -> tuple[list[str], list[str]]:
    """The files of either run whose buckets differ (at most one per bucket)."""
    mine = digests(spark, a).select("bucket", F.struct("n", "d1", "d2").alias("da"),
                                    F.col("file").alias("fa"))
    theirs = digests(spark, b).select("bucket", F.struct("n", "d1", "d2").alias("db"),
                                      F.col("file").alias("fb"))
    rows = (mine.join(theirs, "bucket", "full_outer").where(~F.col("da").eqNullSafe(F.col("db")))
            .select("fa", "fb").collect())
    return [r.fa for r in rows if r.fa], [r.fb for r in rows if r.fb]


def compare_changed(spark: SparkSession, root: str, old: str, new: str, group: str = "family",
                    count_col: str = "unique_oli_count") -> DataFrame:
    """``compare_snapshots`` of two runs, reading changed buckets only."""
    a, b = _pair(spark, root, old, new)
    fa, fb = changed_buckets(spark, a, b)
    sides = joined_sides(grouped_sides(read_files(spark, a, fa), a.key, group),
                         grouped_sides(read_files(spark, b, fb), b.key, group))
    print_of = ["bucket", "n", "d1", "d2"]
    alike = digests(spark, a).select(*print_of).join(digests(spark, b).select(*print_of), print_of)
    kept = (spark.read.parquet(a.side("self")).join(alike.select("bucket"), "bucket", "left_semi")
            .drop("bucket"))
    return summed_report(counted(contributions(sides)).unionByName(kept), group, count_col)


