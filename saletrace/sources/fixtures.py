"""Canonical input tables derived from the driver's TPC-H-like tables.

The original pipeline reads CRM and asset-inventory tables that are not
public.  These derivations give tables of the same shape from ``orders``,
``lineitem``, ``part``, ``customer`` and ``events`` by integer arithmetic on
keys (rules in FIXTURES.md §2).  Every row of the driver table gives a row:
what an operator is to drop carries a NULL key, an unmatched flag or another
link type, and the operator drops it.  Accounts are the customers, so they
grow with the data.  All are narrow projections except the two DISTINCTs the
rules ask for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saletrace.operators.assets import AssetSource
from saletrace.operators.matching import LOOKED_UP, Tier
from saletrace.params import ClassifyRules, FactRules, Lookups, PeriodRules, StatusRules
from saletrace.sources.io import lookup, read_tables

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

# ---------------------------------------------------------------------------
# FIXED VALUES of the test fixtures (FIXTURES.md §2)
# ---------------------------------------------------------------------------
FIXTURE_FAMILIES = ("SMALL", "MEDIUM", "LARGE", "STANDARD", "ECONOMY", "PROMO")
FIXTURE_CLASS_FAMILY = (("click", "SMALL"), ("click", "MEDIUM"), ("view", "LARGE"),
                        ("signup", "STANDARD"), ("purchase", "ECONOMY"))
FIXTURE_FAMILY_SHORT = (("ECONOMY", "ECON"), ("STANDARD", "STD"), ("MEDIUM", "MED"),
                        ("LARGE", "LRG"))
FIXTURE_FACT_RULES = FactRules(families=FIXTURE_FAMILIES, won_stage="closed_won",
                               closed_after="1996-12-31")
FIXTURE_CLASSIFY_RULES = ClassifyRules(always_provisioned=("PROMO",),
                                       provisioned_after=("ECON",),
                                       provisioned_after_date="1999-01-01")
FIXTURE_STATUS_RULES = StatusRules(as_of="2024-03-01")
FIXTURE_PERIOD_RULES = PeriodRules(from_period="2001 | Q1", to_period="2001 | Q2",
                                   base_year=2001)
FIXTURE_LOOKUPS = Lookups(class_family=FIXTURE_CLASS_FAMILY, family_short=FIXTURE_FAMILY_SHORT)
# five match rules of another deployment
FIXTURE_TIERS = (
    Tier("code_enabled", ("account_id", "base_product_code"), ("asset_account_id", "deployment_code"),
         asset_where="deployment_asset_id IS NOT NULL AND asset_enabled", line_where="enabled_ol"),
    Tier("code", ("account_id", "base_product_code"), ("asset_account_id", "deployment_code"),
         asset_where="deployment_asset_id IS NOT NULL"),
    Tier("family_active", ("account_id", "family"), ("asset_account_id", LOOKED_UP),
         asset_where="install_status = '1'"),
    Tier("family", ("account_id", "family"), ("asset_account_id", LOOKED_UP)),
    Tier("account_error", ("account_id",), ("asset_account_id",),
         asset_where="class_name = 'error'", line_where="quantity < 0"),
)
# run comparison: the old run holds lines closed before, the new run from; in
# the new run lines over this quantity have another family, and those under
# the other one have a second family as well
RUN_MOVED_OVER, RUN_MOVED_TO = 40.0, "STANDARD"
RUN_DOUBLED_UNDER, RUN_DOUBLED_AS = 3.0, "PROMO"
OLD_RUN_BEFORE = "2001-01-01"
NEW_RUN_FROM = "1998-01-01"
# ARR periods: (label, factor, l_partkey % 3 value that is left out)
ARR_PERIODS = (("2001 | Q1", "1.00", 0), ("2001 | Q2", "1.25", 1), ("2000 | Q4", "0.50", 2))
ACCOUNT_LINK_PREFIX = "https://crm.example.com/x/"
# ---------------------------------------------------------------------------


def k(prefix: str, c: Column) -> Column:
    """``prefix || CAST(c AS STRING)``."""
    return F.concat(F.lit(prefix), c.cast("string"))


def _lid(order: Column | None = None) -> Column:
    order = F.col("l_orderkey").cast("string") if order is None else order
    return F.concat_ws("-", F.concat(F.lit("L"), order), F.col("l_linenumber").cast("string"),
                       F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))


def _neg_quantity(c: Column) -> Column:
    return F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), -c).otherwise(c)


class _LazyTables(dict):
    """``{name: DataFrame}`` that opens a driver table on first use, so a
    query lists and reads footers only of the tables it touches."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = read_tables(self._spark, self._dir, [name])[name]
        self[name] = df
        return df

    def all(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in DRIVER_TABLES}


@dataclass
class Fixtures:
    """Lazily derived canonical tables over one scale-factor folder."""

    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        self.t = _LazyTables(self.spark, self.sf_dir)

    # ---- sales side --------------------------------------------------------
    def opportunity(self) -> DataFrame:
        o = self.t["orders"]
        key = F.col("o_orderkey")
        typ = (F.when(key % 97 == 0, F.lit(None).cast("string"))
               .when(key % 3 == 0, "Renewal").when(key % 3 == 1, "New").otherwise("Upsell"))
        return o.select(k("O", key).alias("id"),
                        k("A", F.col("o_custkey")).alias("account_id"),
                        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed_won")
                        .alias("stage_name"),
                        typ.alias("type"),
                        F.col("o_orderdate").cast("date").alias("close_date"))

    def line_item(self, dealt: bool = False) -> DataFrame:
        # DISTINCT over the derived rows.  Every derived column is an
        # injective function of (order, line, part, supplier, signed
        # quantity, price), so the numeric tuple is de-duplicated first and
        # the other string ids are built after: same rows, cheaper hashing.
        # ``dealt``: the rows are shuffled by opportunity, which also serves the
        # DISTINCT (equal rows have equal opportunities) and a join by it; the
        # id is made of the shuffled number again.
        opp = k("O", F.col("l_orderkey"))
        li = (self.t["lineitem"]
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      _neg_quantity(F.col("l_quantity")).alias("quantity"),
                      F.col("l_extendedprice").alias("acv")))
        li = (li.repartition(opp) if dealt else li).select(
            opp.alias("opportunity_id"), "l_linenumber", "l_partkey", "l_suppkey", "quantity", "acv").distinct()
        lid = _lid(F.expr("substring(opportunity_id, 2)"))
        return li.select(
            lid.alias("id"), "opportunity_id",
            F.when(F.col("l_suppkey") % 29 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("Q"), lid)).alias("quote_line_id"),
            k("P", F.col("l_partkey")).alias("product_id"),
            "quantity", "acv",
            (F.col("l_suppkey") % 2 == 0).alias("enabled"))

    def quote(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.t["orders"].select(
            k("T", key).alias("id"), k("O", key).alias("opportunity_id"),
            F.when(key % 10 == 0, "false").otherwise("true").alias("is_primary"))

    def quote_line(self, dealt: bool = False) -> DataFrame:
        # DISTINCT over the derived rows, de-duplicated on the numeric source
        # columns they are an injective function of; ``dealt``: shuffled by
        # quote (see line_item)
        quote = k("T", F.col("l_orderkey"))
        ql = self.t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
        ql = (ql.repartition(quote) if dealt else ql).select(
            quote.alias("quote_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").distinct()
        return ql.select(
            F.concat(F.lit("Q"), _lid(F.expr("substring(quote_id, 2)"))).alias("id"), "quote_id",
            F.when(F.col("l_linenumber") % 4 == 0, "One-Time").otherwise("Recurring")
            .alias("charge_type"),
            (F.col("l_partkey") % 2 == 0).alias("enabled"),
            F.col("l_returnflag").alias("transaction_type"))

    def product(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.t["part"].select(
            k("P", key).alias("id"), F.col("p_brand").alias("product_code"),
            F.when(key % 10 == 0, F.lit(None).cast("string"))
            .otherwise(k("P", key - key % 10)).alias("base_product_id"),
            F.when(F.col("p_size") % 9 == 0, "Perpetual").otherwise("SaaS").alias("revenue_class"),
            F.col("p_type").alias("family"))

    def reversal(self) -> DataFrame:
        """Every order and every line, under a link type: the two that mark a
        reversal, or one that no operator looks for."""
        by_opp = self.t["orders"].select(
            F.when(F.col("o_orderkey") % 13 == 0, "Opportunity").otherwise("Account")
            .alias("link_type"), k("O", F.col("o_orderkey")).alias("linked_id"))
        by_quote_line = self.t["lineitem"].select(
            F.when(F.col("l_partkey") % 31 == 0, "Quote").otherwise("Contract").alias("link_type"),
            F.concat(F.lit("Q"), _lid()).alias("linked_id"))
        return by_opp.unionByName(by_quote_line)

    # ---- asset side ----------------------------------------------------------
    def _asset_events(self) -> DataFrame:
        eid = F.col("event_id")
        group = (eid - eid % 4) / 4  # four assets share a host
        host = F.concat(k("h", group.cast("bigint")),
                        F.when(eid % 17 == 0, F.lit("")).otherwise(F.lit(".example.com")))
        return self.t["events"].select(
            "event_type", (eid % 2 == 0).alias("even"),
            F.when(eid % 101 != 0, k("V", eid)).alias("sys_id"),
            F.when(eid % 13 == 0, F.lit(None).cast("boolean")).otherwise(eid % 2 == 0)
            .alias("enabled_flag"),
            F.when(eid % 4 == 1, "Staging").when(eid % 4 == 3, "Development")
            .otherwise("Production").alias("used_for"),
            F.when(eid % 5 == 3, "4").when(eid % 5 == 4, F.lit(None).cast("string"))
            .otherwise("1").alias("install_status"),
            k("S", F.col("user_id") * 10 + eid % 10).alias("account_value"),
            k("M", eid % 11).alias("model_value"),
            F.col("event_type").alias("sys_class_name"),
            F.col("ts").alias("created_on"), F.col("ts").alias("updated_on"),
            F.col("ts").cast("date").alias("start_on"),
            host.alias("fqdn"), k("h", group.cast("bigint")).alias("resource_key_value"))

    def asset_sources(self) -> list[AssetSource]:
        """Seven differently shaped asset tables by event type (and, for two
        of them, parity): four carry a host name, three a ready resource key;
        one has no model."""
        ev = self._asset_events()

        def src(rows: Column, prefix: str, with_model: bool, host: bool) -> AssetSource:
            names = {"sys_id": "asset_id", "enabled_flag": "enabled", "used_for": "used_for",
                     "install_status": "install_status", "account_value": "source_account_id",
                     "sys_class_name": "class_name", "created_on": "created_at",
                     "updated_on": "updated_at", "start_on": "start_date"}
            if with_model:
                names["model_value"] = "model_id"
            raw_cols = [F.col(c).alias(prefix + c) for c in names]
            if host:
                raw_cols.append(F.col("fqdn").alias(prefix + "fqdn"))
            else:
                raw_cols.append(F.col("resource_key_value").alias(prefix + "resource_key"))
                names["resource_key"] = "resource_key"
            df = ev.where(rows).select(*raw_cols)
            mapping = {canon: prefix + raw for raw, canon in names.items()}
            return AssetSource(df, mapping, host_column=(prefix + "fqdn") if host else None)

        kind, even = F.col("event_type"), F.col("even")
        return [src((kind == "click") & even, "pw_", True, True),
                src((kind == "click") & ~even, "cr_", True, True),
                src(kind == "view", "pm_", True, True),
                src(kind == "signup", "ra_", True, True),
                src((kind == "purchase") & even, "u_", True, False),
                src(kind == "error", "ip_", False, False),
                src((kind == "purchase") & ~even, "um_", True, False)]

    def master_account(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.t["customer"].select(k("S", c).alias("source_account_id"),
                                         k("A", c).alias("account_id"))

    def deployment(self) -> DataFrame:
        """One per event; two of three are linked to no asset."""
        eid = F.col("event_id")
        return self.t["events"].select(
            k("D", eid).alias("id"), F.when(eid % 3 == 0, k("V", eid)).alias("asset_id"),
            k("Brand#", eid % 25 + 1).alias("product_code"))

    def decom_host(self) -> DataFrame:
        """One per event; most name no dotted host, so give no key."""
        eid = F.col("event_id")
        gone = eid % 53 == 0
        host = lambda n: k("h", ((eid - eid % n) / n).cast("bigint"))
        return self.t["events"].select(
            F.when(gone & (eid % 2 == 0), F.concat(host(4), F.lit(".app.example.com")))
            .otherwise("nohost").alias("app_hostname"),
            F.when(gone & (eid % 5 != 0), F.concat(host(8), F.lit(".site.example.com")))
            .alias("site_hostname"))

    def class_family(self) -> DataFrame:
        return lookup(self.spark, FIXTURE_CLASS_FAMILY, "class_name string, family string")

    def family_short(self) -> DataFrame:
        return lookup(self.spark, FIXTURE_FAMILY_SHORT, "family string, short_name string")

    # ---- inputs of the status dataset ---------------------------------------
    def line_asset(self) -> DataFrame:
        """One row per line item with the asset whose event id equals the
        order key (left join), shaped like the status step's input."""
        return self.line_asset_sources().select(*self.line_asset_columns())

    def line_asset_sources(self) -> DataFrame:
        """The joined source columns that ``line_asset_columns`` reads, with
        the ids that other tables are joined by.  Events meet the orders, the
        fewer rows, and the lines come out dealt by opportunity."""
        li = self.t["lineitem"].select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity",
            "l_extendedprice", k("O", F.col("l_orderkey")).alias("opp_id"))
        p = self.t["part"].select("p_partkey", "p_brand", "p_type")
        o = self.t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
        ev = self.t["events"].select("event_id", "event_type", "ts")
        oe = (o.join(ev, F.col("event_id") == F.col("o_orderkey"), "left")
              .withColumn("_o_opp", k("O", F.col("o_orderkey"))))
        j = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
             .join(oe, F.col("opp_id") == F.col("_o_opp")))
        return j.drop("p_partkey", "o_orderkey", "_o_opp").withColumns(
            {"oli_id": _lid(), "asset_id": k("V", F.col("event_id"))})

    def line_asset_columns(self) -> list[Column]:
        eid = F.col("event_id")
        has = eid.isNotNull()
        s = F.lit(None).cast("string")
        return [
            F.col("oli_id"),
            F.concat(F.lit("Q"), _lid()).alias("qli_id"),
            k("O", F.col("l_orderkey")).alias("opp_id"),
            k("A", F.col("o_custkey")).alias("account_id"),
            F.col("p_brand").alias("product_code"),
            s.alias("base_product_code"),
            F.col("p_type").alias("family"),
            F.col("asset_id"),
            F.when(eid % 3 == 0, k("D", eid)).alias("prov_id"),
            F.when(has, k("h", eid % 500)).alias("resource_key"),
            F.col("o_orderdate").cast("date").alias("close_date"),
            _neg_quantity(F.col("l_extendedprice")).alias("net_acv"),
            F.col("l_quantity").alias("quantity"),
            F.when(F.col("l_partkey") % 6 == 0, "Cancelled").otherwise("Active").alias("sub_status"),
            s.alias("subscription_type"), s.alias("contract_id"), s.alias("subscription_id"),
            F.col("l_returnflag").alias("transaction_type"),
            F.when(has, F.lit("event_order")).alias("join_path"),
            F.when(F.col("l_suppkey") % 11 == 0, F.lit(None).cast("boolean"))
            .otherwise(F.col("l_suppkey") % 2 == 0).alias("oli_enabled"),
            (F.col("l_partkey") % 2 == 0).alias("qli_enabled"),
            F.when(has & (eid % 13 != 0), eid % 2 == 0).alias("asset_enabled"),
            F.when(has, F.when(eid % 4 == 1, "Staging").when(eid % 4 == 3, "Development")
                   .otherwise("Production")).alias("used_for"),
            F.when(has, F.when(eid % 5 == 3, "4").when(eid % 5 == 4, s).otherwise("1"))
            .alias("install_status"),
            F.col("event_type").alias("class_name"),
            F.col("ts").alias("updated_at")]

    def decom_event(self) -> DataFrame:
        """One per event; the match flag is set on few, and some have no
        asset."""
        eid = F.col("event_id")
        return self.t["events"].select(
            F.when(eid % 59 != 0, k("V", eid - eid % 3)).alias("asset_id"),
            F.col("ts").alias("decommissioned_at"),
            F.when(eid % 53 < 2, 1).otherwise(0).alias("acct_product_match"))

    def reverse_rebook(self) -> DataFrame:
        """One opportunity row and one quote row per order; few are
        reversals."""
        o = self.t["orders"]
        key = F.col("o_orderkey")
        by_opp = o.select(
            F.lit("Opportunity").alias("link_type"), k("O", key).alias("linked_id"),
            F.when(key % 26 == 0, "Reversal").when(key % 13 == 0, "Rebook").otherwise("Amendment")
            .alias("booking_type"),
            k("INC", key).alias("incident_number"), F.lit("credit").alias("processed_as"))
        by_quote = o.select(
            F.lit("Quote").alias("link_type"), k("T", key).alias("linked_id"),
            F.when(key % 17 == 0, "Reversal").otherwise("Amendment").alias("booking_type"),
            k("INQ", key).alias("incident_number"), F.lit("manual").alias("processed_as"))
        return by_opp.unionByName(by_quote)

    # ---- revenue by period ----------------------------------------------------
    def arr_quarter(self) -> DataFrame:
        li, o, c, p = self.t["lineitem"], self.t["orders"], self.t["customer"], self.t["part"]
        # the customer is joined to the orders, the fewer rows: lines are
        # shuffled by part and by opportunity only, as numbers, and come out
        # dealt by opportunity, which serves an aggregate by it
        opp = k("O", F.col("l_orderkey"))
        oc = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
              .withColumn("_o_opp", k("O", F.col("o_orderkey"))))
        j = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
             .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "p_type")
             .repartition(opp).withColumn("opp_id", opp)
             .join(oc, F.col("opp_id") == F.col("_o_opp")))
        fs = self.family_short()
        j = j.join(fs, F.col("p_type") == fs["family"], "left")
        periods = F.array(*[F.struct(F.lit(lbl).alias("yq"), F.lit(fac).alias("factor"),
                                     F.lit(skip).alias("skip"))
                            for lbl, fac, skip in ARR_PERIODS])
        j = j.withColumn("_p", F.explode(periods)).where(F.col("l_partkey") % 3 != F.col("_p.skip"))
        amount = (F.col("l_extendedprice").cast("decimal(18,2)")
                  * F.col("_p.factor").cast("decimal(3,2)")).cast("decimal(18,2)")
        text, form = amount.cast("string"), F.col("l_suppkey") % 20
        return j.select(
            F.col("c_name").alias("account_name"),
            F.concat(F.lit(ACCOUNT_LINK_PREFIX), k("A", F.col("c_custkey"))).alias("account_link"),
            "opp_id",
            _lid().alias("oli_id"),
            F.coalesce(F.col("short_name"), F.col("p_type")).alias("family_short"),
            F.col("o_orderdate").cast("date").alias("close_date"),
            # plain, more decimals, an exponent, 20 digits, no number
            F.when(form == 0, F.concat(text, F.lit("678"))).when(form == 1, F.concat(text, F.lit("e2")))
            .when(form == 2, F.concat(F.lit("12345678901234567890"), F.lit(".5")))
            .when(form == 3, F.lit("n/a")).otherwise(text).alias("arr_text"),
            F.col("_p.yq").alias("year_quarter"))
