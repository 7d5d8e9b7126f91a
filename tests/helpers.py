"""Small-table builders for unit tests."""

import datetime as dt

from saletrace.operators.assets import ASSET_SCHEMA, ENRICH_COLUMNS
from saletrace.operators.facts import FACT_COLUMNS

FACT_TYPES = {"enabled_ol": "boolean", "enabled_ql": "boolean", "quantity": "double",
              "acv": "double", "close_date": "date"}
ASSET_TYPES = dict(ASSET_SCHEMA) | {c: "string" for c in ENRICH_COLUMNS}


def facts_df(spark, rows):
    """``rows``: dicts with any of FACT_COLUMNS; the rest are NULL."""
    schema = ", ".join(f"{c} {FACT_TYPES.get(c, 'string')}" for c in FACT_COLUMNS)
    data = [tuple(r.get(c) for c in FACT_COLUMNS) for r in rows]
    return spark.createDataFrame(data, schema)


def assets_df(spark, rows):
    cols = list(ASSET_TYPES)
    schema = ", ".join(f"{c} {t}" for c, t in ASSET_TYPES.items())
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, schema)


def d(s):
    return dt.date.fromisoformat(s)
