"""Versions of a table: bucketed, immutable, published by one atomic rename.

``write_version`` writes the rows to a folder of its own, in hash buckets of a
key with one file each, then a digest of every bucket, and last renames a small
pointer file over the old one.  A reader sees the old version whole until then
and the new one whole after; a write that fails leaves the old pointer and only
an unreferenced folder (``create or replace`` without a gap).  The rename is
atomic on HDFS and local folders; an object store needs one whose file systems
rename single files atomically.

``read_version`` opens the folder as an external bucketed table, so joins and
aggregations of two versions on the key need no shuffle if their bucket counts
agree.  Old folders stay for the readers that hold them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256


@dataclass(frozen=True)
class Version:
    data: str
    key: str
    buckets: int
    schema: str

    def side(self, name: str) -> str:
        """The folder of a table stored beside the data."""
        return f"{self.data}-{name}"


def bucket(key: str, buckets: int) -> Column:
    """The bucket of a row: Spark's own bucketing function."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _row_hash(columns: Sequence[str], salt: int) -> Column:
    # a null is skipped by the hash, so it is told apart by a flag
    return F.xxhash64(F.lit(salt), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def _table(spark: SparkSession, v: Version) -> str:
    name = "saletrace_" + v.data.rsplit("-", 1)[1]
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                           for f in T.StructType.fromJson(json.loads(v.schema)).fields)
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{v.key}`) "
                  f"SORTED BY (`{v.key}`) INTO {v.buckets} BUCKETS LOCATION '{v.data}'")
    return name


def _pointer(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/current/{name}.json"


def _publish(spark: SparkSession, target: str, text: str) -> None:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dst, src = path(target), path(f"{target}.{uuid.uuid4().hex}")
    fs = dst.getFileSystem(conf)
    fs.mkdirs(dst.getParent())
    out = fs.create(src)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), conf)
    context.rename(fs.makeQualified(src), fs.makeQualified(dst), how)


def stage_version(df: DataFrame, root: str, name: str, key: str, buckets: int = BUCKETS) -> Version:
    """Write the rows and the bucket digests; nothing is visible yet."""
    spark, tag = df.sparkSession, uuid.uuid4().hex
    v = Version(f"{root.rstrip('/')}/data/{name}-{tag}", key, buckets, df.schema.json())
    table = f"saletrace_{tag}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", v.data).saveAsTable(table))
    rows = spark.read.schema(df.schema).parquet(v.data)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    digests = (rows.groupBy(bucket(key, buckets).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("_file").alias("file"),
                    F.bit_xor(_row_hash(df.columns, 1)).alias("d1"),
                    F.bit_xor(_row_hash(df.columns, 2)).alias("d2")))
    digests.coalesce(1).write.parquet(v.side("digests"))
    return v


def publish_version(spark: SparkSession, root: str, name: str, v: Version) -> None:
    """Make a staged version the current one of ``name``."""
    _publish(spark, _pointer(root, name), json.dumps(asdict(v)))


def write_version(df: DataFrame, root: str, name: str, key: str, buckets: int = BUCKETS) -> Version:
    """``CREATE OR REPLACE`` of version ``name`` under ``root``.  Rows are
    digested as a set: give distinct rows where digests are compared."""
    v = stage_version(df, root, name, key, buckets)
    publish_version(df.sparkSession, root, name, v)
    return v


def current_version(spark: SparkSession, root: str, name: str) -> Version:
    text = spark.read.text(_pointer(root, name), wholetext=True).first()
    return Version(**json.loads(text[0]))


def read_version(spark: SparkSession, root: str, name: str) -> DataFrame:
    return open_version(spark, current_version(spark, root, name))


def open_version(spark: SparkSession, v: Version) -> DataFrame:
    return spark.table(_table(spark, v))


def digests(spark: SparkSession, v: Version) -> DataFrame:
    """``bucket, n, file, d1, d2``: at most a row per bucket."""
    return spark.read.parquet(v.side("digests"))


def read_files(spark: SparkSession, v: Version, files: Sequence[str]) -> DataFrame:
    """The rows of some of a version's bucket files."""
    schema = T.StructType.fromJson(json.loads(v.schema))
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)
