"""Line status dataset (C8) with its two rollups: decommission events per
asset (C9a) and reversal incidents per line (C9b)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saletrace.functions.logic import decision_list, flag01, is_true
from saletrace.operators.skew import sliced_join
from saletrace.params import DECOM_SOURCE_LABELS, STATUS_LABELS, StatusRules


def decom_rollup(events: DataFrame, rules: StatusRules = StatusRules()) -> DataFrame:
    """``(asset_id, decom_date, decom_count)``: earliest decommission and the
    number of matching events per asset (C9a).  Partially aggregated before
    the shuffle, so a hot asset costs one row per map task."""
    return (events
            .where((F.col("acct_product_match") == rules.decom_match_value)
                   & F.col("asset_id").isNotNull())
            .groupBy("asset_id")
            .agg(F.min("decommissioned_at").alias("decom_date"),
                 F.count(F.lit(1)).alias("decom_count")))


def merge_decoms(stored: DataFrame, batch: DataFrame,
                 rules: StatusRules = StatusRules()) -> DataFrame:
    """The rollup of all events so far from the ``stored`` one and a ``batch``
    of new events (C9a): least date and count are partial states that merge, so
    only the batch is aggregated.  A stored table bucketed by ``asset_id``
    (``sources.versions``) is not shuffled."""
    fresh = decom_rollup(batch, rules).select(
        F.col("asset_id").alias("_id"), F.col("decom_date").alias("_date"),
        F.col("decom_count").alias("_count"))
    zero = F.lit(0).cast("bigint")
    return (stored.join(fresh, F.col("asset_id") == F.col("_id"), "full_outer")
            .select(F.coalesce("asset_id", "_id").alias("asset_id"),
                    F.least("decom_date", "_date").alias("decom_date"),
                    (F.coalesce("decom_count", zero) + F.coalesce("_count", zero))
                    .alias("decom_count")))


def reversal_rollup(lines: DataFrame, rebook: DataFrame, quote: DataFrame,
                    rules: StatusRules = StatusRules()) -> DataFrame:
    """``(oli_id, incident_count, incident_number, processed_as)`` (C9b).

    A line is linked to a reversal incident directly through its
    opportunity, or through a quote of its opportunity.  The original joins
    on ``equality OR EXISTS(...)``, which Spark cannot plan; both paths
    resolve to an opportunity id, so they are rewritten as one union of
    (opportunity, incident) pairs — small, incident-sized — joined to the
    lines by an equi join.  The union and duplicated quotes may repeat a
    pair, so pairs are made distinct before they meet the lines.
    """
    rr = rebook.where(F.col("booking_type") == rules.reversal_booking)
    direct = (rr.where(F.col("link_type") == rules.opportunity_link)
              .select(F.col("linked_id").alias("_rr_opp"), "incident_number", "processed_as"))
    q = quote.select(F.col("id").alias("_q_id"), F.col("opportunity_id").alias("_rr_opp"))
    via_quote = (rr.where(F.col("link_type") == rules.quote_link)
                 .join(q, F.col("linked_id") == F.col("_q_id"))
                 .select("_rr_opp", "incident_number", "processed_as"))
    incidents = direct.unionByName(via_quote).distinct()
    return (lines.select("oli_id", F.col("opp_id").alias("_l_opp"))
            .join(incidents, F.col("_l_opp") == F.col("_rr_opp"))
            .groupBy("oli_id")
            .agg(F.countDistinct("incident_number").alias("incident_count"),
                 F.max("incident_number").alias("incident_number"),
                 F.max("processed_as").alias("processed_as")))


def status_rules(r: StatusRules) -> list[tuple[Column, str]]:
    """The ordered decision list of the line status (first true wins)."""
    booked = is_true(F.col("oli_enabled"))
    not_booked = ~booked
    dep = F.col("prov_id").isNotNull()
    no_dep = F.col("prov_id").isNull()
    st = F.col("install_status")
    use = F.lower(F.col("used_for"))
    active = st == r.active_status
    prod = use == r.production_use
    enabled = F.col("asset_enabled") == F.lit(True)
    has_asset = F.col("asset_id").isNotNull()
    conds = [
        (F.col("net_acv") < 0) | (F.col("quantity") < 0),
        booked & dep & active & prod & enabled,
        booked & dep & active & prod & (is_true(F.col("asset_enabled")) != F.lit(True)),
        booked & dep & active & (use == r.staging_use),
        booked & dep & active,
        booked & dep & (st == r.deprovisioned_status),
        booked & dep & has_asset & st.isNull(),
        booked & no_dep & active & prod & enabled,
        booked & no_dep & active & prod,
        booked & no_dep & active,
        booked & no_dep & (st == r.deprovisioned_status),
        booked & ~has_asset,
        not_booked & dep & active & prod & enabled,
        not_booked & no_dep & active & prod & enabled,
        not_booked & has_asset,
        not_booked & ~has_asset,
    ]
    return list(zip(conds, STATUS_LABELS[:-1]))


def line_status(line_asset: DataFrame, decom: DataFrame, reversals: DataFrame,
                rules: StatusRules = StatusRules(), hot_rows: int | None = None,
                columns: Sequence[Column] | None = None) -> DataFrame:
    """One row per input row (C8): identifiers, booking context, the
    17-label status, decommission and reversal columns, anomaly flags.

    ``decom`` is ``decom_rollup`` output (unique per asset) and
    ``reversals`` is ``reversal_rollup`` output (unique per line), so the
    two left joins keep the row count.  Lines without an asset cannot have a
    decommission: their NULL keys are spread, and with ``hot_rows`` assets and
    lines of over that many rows are sliced (``operators.skew``).

    Both joins shuffle whole rows.  Where the columns of ``line_asset`` are
    made from fewer source columns, give the source rows with ``asset_id`` and
    ``oli_id`` instead, and the column expressions as ``columns``: they are
    made after the joins, so that narrow rows are shuffled.
    """
    as_of = F.lit(rules.as_of).cast("date") if rules.as_of else F.current_date()
    d = decom.select(F.col("asset_id").alias("_d_asset"), "decom_date", "decom_count")
    rv = reversals.select(F.col("oli_id").alias("_r_oli"), "incident_number",
                          "incident_count", "processed_as")
    j = sliced_join(sliced_join(line_asset, d, [("asset_id", "_d_asset")], "left", hot_rows),
                    rv, [("oli_id", "_r_oli")], "left", hot_rows)
    if columns is not None:
        j = j.select(*columns, *d.columns, *rv.columns)

    booked = is_true(F.col("oli_enabled"))
    st = F.col("install_status")
    use = F.lower(F.col("used_for"))
    decommed = F.col("_d_asset").isNotNull()
    reversed_ = F.col("_r_oli").isNotNull()
    both, builder, rebook, none = DECOM_SOURCE_LABELS
    return j.select(
        "oli_id", "qli_id", "opp_id", "account_id", "product_code", "base_product_code",
        "family", "asset_id", "prov_id", "resource_key",
        "close_date", "net_acv", "quantity",
        F.col("sub_status").alias("subscription_status"), "subscription_type",
        "contract_id", "subscription_id", "transaction_type",
        F.col("join_path").alias("match_type"),
        "oli_enabled", "qli_enabled", "asset_enabled", "used_for", "install_status",
        "class_name", F.col("updated_at").alias("last_updated"),
        decision_list(status_rules(rules), STATUS_LABELS[-1]).alias("status"),
        flag01(decommed).alias("is_decommissioned"),
        "decom_date", "decom_count",
        flag01(reversed_).alias("is_reversed"),
        "incident_number", "incident_count", "processed_as",
        F.when(decommed & reversed_, F.lit(both)).when(decommed, F.lit(builder))
        .when(reversed_, F.lit(rebook)).otherwise(F.lit(none)).alias("decom_source"),
        flag01((decommed | reversed_) & (st == rules.active_status)
               & use.isin(rules.production_use, rules.staging_use)).alias("stale_after_decom"),
        F.when(decommed & (st == rules.active_status) & F.col("decom_date").isNotNull(),
               F.datediff(as_of, F.col("decom_date").cast("date")))
        .alias("days_stale_since_decom"),
        flag01((F.col("net_acv") < 0) & (st == rules.active_status))
        .alias("flag_negative_acv_active"),
        flag01(booked & F.col("asset_id").isNull()).alias("flag_booked_no_provision"),
        flag01(booked & (st == rules.deprovisioned_status)).alias("flag_booked_deprovisioned"),
        flag01(F.col("oli_enabled").isNotNull() & F.col("qli_enabled").isNotNull()
               & (F.col("oli_enabled") != F.col("qli_enabled"))).alias("flag_oli_qli_mismatch"),
        flag01((F.col("sub_status") == rules.cancelled_status) & (st == rules.active_status)
               & ~decommed & ~reversed_).alias("flag_cancelled_active_undecommed"),
        F.lit(0).alias("flag_account_mismatch"),
        flag01((decommed | reversed_) & booked).alias("flag_decommed_still_enabled"),
    )
