"""Provisioned assets: unify differently shaped sources (C1), derive
decommission host keys (C3), enrich with account, deployment link and
decommission key (C2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saletrace.functions.hosts import dotted_prefix, first_label
from saletrace.operators.skew import sliced_join

# canonical asset columns and their types, in output order
ASSET_SCHEMA: tuple[tuple[str, str], ...] = (
    ("asset_id", "string"),
    ("enabled", "boolean"),
    ("used_for", "string"),
    ("install_status", "string"),
    ("source_account_id", "string"),
    ("model_id", "string"),
    ("class_name", "string"),
    ("created_at", "timestamp_ntz"),
    ("updated_at", "timestamp_ntz"),
    ("start_date", "date"),
    ("resource_key", "string"),
)
ASSET_COLUMNS = tuple(n for n, _ in ASSET_SCHEMA)
ENRICH_COLUMNS = ("account_id", "deployment_asset_id", "deployment_id",
                  "deployment_code", "decom_resource")


@dataclass(frozen=True)
class AssetSource:
    """One asset table and how its columns map onto ``ASSET_SCHEMA``.

    ``columns`` maps a canonical name to the source column; a canonical name
    left out becomes a typed NULL.  The resource key comes either from a
    host name (``host_column``: its first label) or from a column that
    already holds the key (``columns['resource_key']``).
    """

    df: DataFrame
    columns: Mapping[str, str]
    host_column: str | None = None


def _canonical(src: AssetSource) -> DataFrame:
    cols = []
    for name, typ in ASSET_SCHEMA:
        if name == "resource_key" and src.host_column is not None:
            expr = first_label(F.col(src.host_column))
        elif name in src.columns:
            expr = F.col(src.columns[name])
        else:
            expr = F.lit(None)
        cols.append(expr.cast(typ).alias(name))
    id_col = F.col(src.columns["asset_id"])
    # filter on the source column so the predicate reaches the scan
    return src.df.where(id_col.isNotNull()).select(*cols)


def unify_sources(sources: Sequence[AssetSource]) -> DataFrame:
    """Union n asset tables into the canonical asset table (C1).

    Rows without an asset id are dropped at each source.  The union is by
    name after each branch is projected onto the canonical schema, so no
    shuffle happens here: each branch is a narrow scan→filter→project.
    """
    if not sources:
        raise ValueError("unify_sources needs at least one source")
    return reduce(DataFrame.unionByName, (_canonical(s) for s in sources))


def host_keys(decom_host: DataFrame, app_col: str = "app_hostname",
              site_col: str = "site_hostname") -> DataFrame:
    """Decommission host keys (C3): the dotted prefix of the app host name,
    else of the site host name; DISTINCT over the three columns."""
    app = dotted_prefix(F.col(app_col))
    site = dotted_prefix(F.col(site_col))
    return (decom_host
            .select(app.alias("app_key"), site.alias("site_key"),
                    F.coalesce(app, site).alias("resource_key"))
            .distinct())


def enrich_assets(assets: DataFrame, master_account: DataFrame, deployment: DataFrame,
                  decom_keys: DataFrame | None = None,
                  dedupe_decom: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Attach account id, deployment link and decommission key (C2).

    Three left joins, as the original: ``master_account(source_account_id,
    account_id)``, ``deployment(id, asset_id, product_code)``, and the
    ``host_keys`` output on ``resource_key``.  The decommission keys are
    DISTINCT over three columns but joined on one, so an asset can fan out;
    that is kept unless ``dedupe_decom`` (one row per key).

    Rows without the join key are dropped from the right sides before their
    shuffles, and assets without it are spread by their id: a query that reads
    few columns shuffles no others.  With ``hot_rows``, account ids
    and resource keys of over that many assets are found by a sketch and sliced
    (``operators.skew``), which reads the assets' keys once more.  Small sides
    are broadcast by Spark from their measured size.
    """
    acct = master_account.select(
        F.col("source_account_id").alias("_m_src"), F.col("account_id"))
    dep = deployment.where(F.col("asset_id").isNotNull()).select(
        F.col("asset_id").alias("deployment_asset_id"),
        F.col("id").alias("deployment_id"),
        F.col("product_code").alias("deployment_code"))
    by = ["asset_id"] if hot_rows is None else None
    out = (sliced_join(assets, acct, [("source_account_id", "_m_src")], "left", hot_rows, deal_by=by)
           .join(dep, F.col("asset_id") == F.col("deployment_asset_id"), "left"))
    if decom_keys is None:
        out = out.withColumn("decom_resource", F.lit(None).cast("string"))
    else:
        keys = decom_keys.select(F.col("resource_key").alias("decom_resource"))
        keys = keys.where(F.col("decom_resource").isNotNull())
        if dedupe_decom:
            keys = keys.distinct()
        out = sliced_join(out, keys, [("resource_key", "decom_resource")], "left", hot_rows, deal_by=by)
    return out.select(*ASSET_COLUMNS, *ENRICH_COLUMNS)
