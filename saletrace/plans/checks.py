"""Plan checks: what a physical plan must not contain at scale."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# nodes that mean quadratic work, driver-side collection of a join side, or
# Python in the hot path
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF",
             "ExistingRDD")


def physical_plan(df: DataFrame) -> str:
    """The physical plan text (the initial plan when AQE is on)."""
    return df._jdf.queryExecution().executedPlan().toString()


def plan_problems(df: DataFrame) -> list[str]:
    text = physical_plan(df)
    return [n for n in FORBIDDEN if re.search(rf"\b{n}\b", text)]


def count_nodes(df: DataFrame, node: str) -> int:
    return len(re.findall(rf"\b{node}\b", physical_plan(df)))


def read_schemas(df: DataFrame) -> list[str]:
    """``ReadSchema`` of every parquet scan in the plan."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", physical_plan(df))
