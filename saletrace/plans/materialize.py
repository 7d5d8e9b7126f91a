"""Writing an intermediate that later steps read more than once.

Spark recomputes a DataFrame in every branch that uses it.  For the line
facts (a five-way join over line-scale tables) and the enriched assets (an
n-way union plus three joins) that would repeat the whole upstream plan.
``materialize`` writes the DataFrame as Parquet under the shared checkpoint
folder the cluster names in ``spark.checkpoint.dir`` and returns a DataFrame
reading it back:

* the lineage is cut, and the files live on shared storage, so losing an
  executor does not lose the intermediate;
* Parquet is columnar, so each later scan still reads only the columns it
  needs and pushes its filters down; it is compressed by zstd, as it is written
  once and read a few times;
* the folder is deleted when the application ends.

Where the session names no such folder, nothing is written and the DataFrame
stays lazy.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from saletrace.session import checkpoint_dir


def new_folder(spark: SparkSession, base: str, name: str) -> str:
    """A fresh folder under ``base``, deleted when the application ends."""
    path = f"{base.rstrip('/')}/saletrace/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def run_folder(spark: SparkSession) -> str:
    """Where a run's declared snapshots go: the checkpoint folder; a
    single-process session (tests) that names none gets a temporary one."""
    base = checkpoint_dir(spark)
    if base:
        return base
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    return "file://" + tempfile.mkdtemp(prefix="saletrace-run-")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the checkpoint folder and read back, or ``df`` itself
    where the session names none."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if not base:
        return df
    path = new_folder(spark, base, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    # the schema is known: no footer-reading job to infer it again
    return spark.read.schema(df.schema).parquet(path)
