"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()


#: rows that a Python worker is handed at once; Spark's default of 10,000 long
#: texts, and what an operator makes of them, would be held together
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the executors' Python workers through
    Spark (``addPyFile``), once per application, and bound the batches that
    workers are handed (unless the session has set its own bound)."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="saletrace-"), "saletrace_modules.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the
    context's checkpoint folder.  Only a single-process session
    (``local[...]``, as in tests) that names none gets a temporary one."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith(("local[", "local")) or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="saletrace-llm-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under :func:`shared_dir`, deleted when the application
    ends."""
    path = f"{shared_dir(spark)}/saletrace-llm/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, as ``id`` (bigint) and
    ``text`` (null becomes empty); any others, and their names, are left
    behind."""
    return docs.select(docs[id_col].cast("bigint").alias("id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def slices(array: pa.Array, size: int = 512) -> Iterator[list]:
    """The values of an Arrow array, ``size`` at a time: a worker holds the
    Python objects of one slice, not of a whole batch."""
    for at in range(0, len(array), size):
        yield array.slice(at, size).to_pylist()


def fold(column: Column, n: int) -> Column:
    """crc32 of a value's text, modulo ``n`` (null stays null)."""
    return F.crc32(column.cast("string").cast("binary")) % n


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Each row of ``docs`` as one struct ``row``, beside ``columns``: names
    of its own columns cannot clash with an operator's."""
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    return docs.select(row.alias("row"), *[v.alias(k) for k, v in columns.items()])


def unpacked(rows: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``docs`` back from ``row``; ``replaced`` by name."""
    own = [replaced.get(c, F.col(f"row.c{i}")).alias(c) for i, c in enumerate(docs.columns)]
    return rows.select(*own)
