"""Line facts (C4): joined, filtered and flagged sold line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saletrace.params import REVERSAL_LABEL, FactRules

FACT_COLUMNS = (
    "opp_id", "oli_id", "enabled_ol", "enabled_ql", "qli_id", "quantity", "acv",
    "transaction_type", "opp_type", "account_id", "close_date", "product_code",
    "base_product_code", "family", "reversal_opp",
)


def base_product_codes(product: DataFrame) -> DataFrame:
    """``SELECT DISTINCT id, product_code FROM product``, renamed for the
    self-lookup product → base product."""
    return (product.select(F.col("id").alias("base_id"),
                           F.col("product_code").alias("base_product_code"))
            .distinct())


def linked_ids(reversal: DataFrame, link_type: str, marker: str) -> DataFrame:
    """Distinct ids of one link type, with a non-null marker column for a
    left-join membership test."""
    return (reversal.where(F.col("link_type") == link_type)
            .select(F.col("linked_id").alias(f"_{marker}_id"))
            .distinct()
            .withColumn(f"_{marker}", F.lit(True)))


def reversal_marks(reversal: DataFrame, link_types: tuple[str, ...]) -> DataFrame:
    """``(_linked, _marks)``: each id with a link of one of ``link_types``, and
    an array saying for each type whether it has one.  One column, so that the
    lookups by either type read the same shuffled table."""
    return (reversal.where(F.col("link_type").isin(list(link_types)) & F.col("linked_id").isNotNull())
            .groupBy(F.col("linked_id").alias("_linked"))
            .agg(*[F.max(F.col("link_type") == t).alias(f"_m{i}") for i, t in enumerate(link_types)])
            .select("_linked", F.array(*[F.col(f"_m{i}") for i in range(len(link_types))])
                    .alias("_marks")))


def line_facts(opportunity: DataFrame, line_item: DataFrame, quote_line: DataFrame,
               quote: DataFrame, product: DataFrame, reversal: DataFrame,
               rules: FactRules) -> DataFrame:
    """Sold line items that pass the won/date/primary/charge/class/family
    filters, with product codes, base product code and a reversal flag.

    Inputs (canonical): ``opportunity(id, account_id, stage_name, type,
    close_date)``, ``line_item(id, opportunity_id, quote_line_id, product_id,
    quantity, acv, enabled)``, ``quote_line(id, quote_id, charge_type,
    enabled, transaction_type)``, ``quote(id, is_primary)``, ``product(id,
    product_code, base_product_id, revenue_class, family)``,
    ``reversal(link_type, linked_id)``.

    The original writes left joins whose WHERE rejects NULLs on the right,
    so they are inner joins; they are written as such, filters first: by
    opportunity, by quote line, then by product, so that the line items are
    cut down before their rows grow.  The two reversal lookups reuse the
    partitioning of the join before them.  The reversals are read once for
    both.

    Whether the filtered product dimension is broadcast to the line items is
    Spark's choice by its measured size; nothing runs while this is built.
    """
    cut = F.lit(rules.closed_after).cast("date")
    opp = (opportunity
           .where((F.col("stage_name") == rules.won_stage)
                  & (F.col("close_date").cast("date") > cut))
           .select(F.col("id").alias("opp_id"), F.col("type").alias("opp_type"),
                   "account_id", F.col("close_date").cast("date").alias("close_date")))
    prod = (product
            .where(F.col("base_product_id").isNotNull()
                   & (F.col("revenue_class") == rules.revenue_class)
                   & F.col("family").isin(list(rules.families)))
            .select(F.col("id").alias("_p_id"), "product_code", "base_product_id", "family")
            .join(base_product_codes(product), F.col("base_product_id") == F.col("base_id"), "left")
            .drop("base_id", "base_product_id"))
    primary = (quote.where(F.col("is_primary") == rules.primary_flag)
               .select(F.col("id").alias("_q_id")))
    ql = (quote_line.where(F.col("charge_type") == rules.charge_type)
          .select(F.col("id").alias("qli_id"), F.col("quote_id").alias("_ql_quote"),
                  F.col("enabled").alias("enabled_ql"), "transaction_type")
          .join(primary, F.col("_ql_quote") == F.col("_q_id"))
          .drop("_ql_quote", "_q_id"))
    li = line_item.select(
        F.col("id").alias("oli_id"), F.col("opportunity_id").alias("_li_opp"),
        F.col("quote_line_id").alias("_li_ql"), F.col("product_id").alias("_li_prod"),
        "quantity", "acv", F.col("enabled").alias("enabled_ol"))

    marks = reversal_marks(reversal, (rules.quote_line_link, rules.opportunity_link))

    def marked(by: str) -> DataFrame:
        return marks.select(F.col("_linked").alias(f"_{by}_linked"), F.col("_marks").alias(f"_{by}_marks"))

    # a lookup becomes its flag before the next shuffle, and columns that the
    # result does not have are left behind
    facts = (li
             .join(opp, F.col("_li_opp") == F.col("opp_id"))
             .join(marked("o"), F.col("opp_id") == F.col("_o_linked"), "left")
             .withColumn("_by_opp", F.coalesce(F.col("_o_marks")[1], F.lit(False)))
             .drop("_li_opp", "_o_linked", "_o_marks")
             .join(ql, F.col("_li_ql") == F.col("qli_id"))
             .join(marked("q"), F.col("qli_id") == F.col("_q_linked"), "left")
             .withColumn("_reversed", F.col("_by_opp") | F.coalesce(F.col("_q_marks")[0], F.lit(False)))
             .drop("_li_ql", "_by_opp", "_q_linked", "_q_marks")
             .join(prod, F.col("_li_prod") == F.col("_p_id")))
    return facts.select(
        "opp_id", "oli_id", "enabled_ol", "enabled_ql", "qli_id", "quantity", "acv",
        "transaction_type", "opp_type", "account_id", "close_date", "product_code",
        "base_product_code", "family",
        F.when(F.col("_reversed"), F.lit(REVERSAL_LABEL)).alias("reversal_opp"))
