"""Hand-made unit tables for the cases the derived data does not contain."""

from helpers import d, facts_df
from pyspark.sql import functions as F

from saletrace.operators.assets import AssetSource, enrich_assets, host_keys, unify_sources
from saletrace.operators.classify import classify_lines
from saletrace.operators.compare import compare_snapshots, rank_segments
from saletrace.operators.exclusion import exclude_not_in
from saletrace.operators.period import period_change
from saletrace.operators.profile import profile_columns
from saletrace.operators.rollups import account_rollup
from saletrace.operators.status import decom_rollup, line_status, reversal_rollup
from saletrace.params import ClassifyRules, PeriodRules, StatusRules


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, str(v)) for v in t))


def test_host_keys_rules(spark):
    df = spark.createDataFrame(
        [("a1.app.x", "s1.site.x"), ("nohost", "s2.site.x"), (".lead", None), ("nohost", None),
         ("a1.app.x", "s1.site.x")], "app_hostname string, site_hostname string")
    got = rows(host_keys(df), "app_key", "site_key", "resource_key")
    # dot-less -> NULL, leading dot -> '', app preferred, DISTINCT
    assert ("", None, "") in got and (None, "s2", "s2") in got and len(got) == 4


def test_unify_sources_shapes(spark):
    a = spark.createDataFrame([("x1", "h1.example.com", "S1"), (None, "h2.example.com", "S1"),
                               ("x3", "bare", "S2")], "sid string, host string, acct string")
    b = spark.createDataFrame([("y1", "key9", "S3")], "u_id string, u_key string, u_acct string")
    out = unify_sources([
        AssetSource(a, {"asset_id": "sid", "source_account_id": "acct"}, host_column="host"),
        AssetSource(b, {"asset_id": "u_id", "source_account_id": "u_acct",
                        "resource_key": "u_key"}),
    ])
    assert rows(out, "asset_id", "resource_key") == [("x1", "h1"), ("x3", "bare"), ("y1", "key9")]
    assert dict(out.dtypes)["model_id"] == "string"
    assert dict(out.dtypes)["start_date"] == "date"


def test_enrich_fan_out_kept_unless_deduped(spark):
    assets = unify_sources([AssetSource(
        spark.createDataFrame([("v1", "S1", "k1")], "i string, s string, k string"),
        {"asset_id": "i", "source_account_id": "s", "resource_key": "k"})])
    acct = spark.createDataFrame([("S1", "A1")], "source_account_id string, account_id string")
    dep = spark.createDataFrame([], "id string, asset_id string, product_code string")
    keys = spark.createDataFrame([("k1", "x", "k1"), ("k1", "y", "k1")],
                                 "app_key string, site_key string, resource_key string")
    assert enrich_assets(assets, acct, dep, keys).count() == 2
    assert enrich_assets(assets, acct, dep, keys, dedupe_decom=True).count() == 1


def test_classify_filters_and_precedence(spark):
    m = facts_df(spark, [
        {"oli_id": "L1", "opp_type": "New", "quantity": 0.1},           # exactly 0.1: ignored
        {"oli_id": "L2", "opp_type": None, "quantity": 5.0},            # NULL type: ignored
        {"oli_id": "L3", "opp_type": "New", "quantity": 1.0, "reversal_opp": "reversal"},
        {"oli_id": "L4", "opp_type": "New", "quantity": 1.0, "family": "XPROMOX"},
        {"oli_id": "L5", "opp_type": "New", "quantity": -2.0},          # neither
    ])
    extra = (m.withColumn("asset_enabled", F.lit(None).cast("boolean"))
             .withColumn("install_status", F.lit(None).cast("string"))
             .withColumn("used_for", F.lit(None).cast("string"))
             .withColumn("decom_resource", F.when(F.col("oli_id") == "L4", "k")
                         .otherwise(F.lit(None).cast("string")))
             .withColumn("match_type", F.lit("deployment_id_family_acct")))
    extra = extra.withColumn("match_type", F.when(F.col("oli_id") == "L5", "no_match")
                             .otherwise(F.col("match_type")))
    got = rows(classify_lines(extra, ClassifyRules(always_provisioned=("PROMO",))),
               "oli_id", "decom_rr", "provisioned")
    # L4 is both overridden and decommissioned: decommission wins
    assert got == [("L3", 1, None), ("L4", 1, None)]


def test_compare_null_and_double_family(spark):
    old = spark.createDataFrame([("a", "F1"), ("a", "F2"), (None, "F1"), ("b", "F1")],
                                "oli_id string, family string")
    new = spark.createDataFrame([("a", "F1"), ("c", "F2")], "oli_id string, family string")
    got = {(r["family"], r["segment"]): r["unique_oli_count"]
           for r in compare_snapshots(old, new).collect()}
    assert got[("overall", "in_both")] == 2        # 'a' twice: two families on the old side
    assert got[("overall", "total_old")] == 2      # distinct non-null ids
    assert got[("overall", "new_only")] == 2       # 'c' and the old NULL id
    assert got[("overall", "old_only")] == 1
    empty = spark.createDataFrame([], "oli_id string, family string")
    got2 = {(r["family"], r["segment"]): r["unique_oli_count"]
            for r in compare_snapshots(empty, new).collect()}
    assert got2[("overall", "total_old")] == 0
    ranked = rank_segments(compare_snapshots(old, new)).collect()
    assert [r["pos"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert ranked[0]["segment"] == "total_old"


def test_reversal_rollup_paths_and_duplicates(spark):
    lines = spark.createDataFrame([("L1", "O1"), ("L1", "O1"), ("L2", "O2")],
                                  "oli_id string, opp_id string")
    rebook = spark.createDataFrame(
        [("Opportunity", "O1", "Reversal", "INC1", "credit"),
         ("Quote", "T1", "Reversal", "INQ1", "manual"),
         ("Opportunity", "O2", "Rebook", "INC2", "credit")],
        "link_type string, linked_id string, booking_type string, incident_number string, "
        "processed_as string")
    quote = spark.createDataFrame([("T1", "O1"), ("T1", "O1")], "id string, opportunity_id string")
    got = rows(reversal_rollup(lines, rebook, quote), "oli_id", "incident_count",
               "incident_number", "processed_as")
    assert got == [("L1", 2, "INQ1", "manual")]


def _line_asset(spark, rows_):
    cols = ["oli_id", "qli_id", "opp_id", "account_id", "product_code", "base_product_code",
            "family", "asset_id", "prov_id", "resource_key", "close_date", "net_acv", "quantity",
            "sub_status", "subscription_type", "contract_id", "subscription_id",
            "transaction_type", "join_path", "oli_enabled", "qli_enabled", "asset_enabled",
            "used_for", "install_status", "class_name", "updated_at"]
    types = {"close_date": "date", "net_acv": "double", "quantity": "double",
             "oli_enabled": "boolean", "qli_enabled": "boolean", "asset_enabled": "boolean",
             "updated_at": "timestamp_ntz"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in cols)
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows_], schema)


def test_line_status_labels_and_row_count(spark):
    la = _line_asset(spark, [
        {"oli_id": "L1", "net_acv": -1.0, "quantity": 1.0},
        {"oli_id": "L2", "net_acv": 1.0, "quantity": 1.0, "oli_enabled": True, "asset_id": "V1",
         "prov_id": None, "install_status": None},                          # unknown
        {"oli_id": "L3", "net_acv": 1.0, "quantity": 1.0, "oli_enabled": True, "asset_id": "V2",
         "prov_id": "D2", "install_status": "1", "used_for": "Production",
         "asset_enabled": True, "sub_status": "Cancelled"},
        {"oli_id": "L4", "net_acv": 1.0, "quantity": 1.0, "oli_enabled": None},
    ])
    ev = spark.createDataFrame([("V2", d("2024-01-01"), 1), ("V2", d("2023-12-01"), 1)],
                               "asset_id string, decommissioned_at date, acct_product_match int")
    rv = spark.createDataFrame([], "oli_id string, incident_number string, incident_count bigint, "
                                   "processed_as string")
    r = StatusRules(as_of="2024-03-01")
    out = line_status(la, decom_rollup(ev, r), rv, r)
    got = {x["oli_id"]: x for x in out.collect()}
    assert len(got) == 4 and out.count() == 4
    assert got["L1"]["status"] == "negative_oli"
    assert got["L2"]["status"] == "unknown"
    assert got["L3"]["status"] == "pf_booked_sfdc_snow_active_production"
    assert got["L3"]["decom_count"] == 2 and got["L3"]["days_stale_since_decom"] == 91
    assert got["L3"]["decom_source"] == "builder"
    assert got["L3"]["flag_cancelled_active_undecommed"] == 0
    assert got["L4"]["status"] == "not_pf_booked_unmatched"


def _arr(spark, rows_):
    return spark.createDataFrame(rows_, "account_name string, account_link string, opp_id string, "
                                        "oli_id string, family_short string, close_date date, "
                                        "arr_text string, year_quarter string")


def test_period_change_edge_cases(spark):
    arr = _arr(spark, [
        ("n", "https://x/y/A1", "O1", "L1", "F", d("2020-05-01"), "100.00", "P1"),
        ("n", "https://x/y/A1", "O1", "L1", "F", d("2020-05-01"), "150.00", "P2"),
        ("n", "https://x/y/A1/", "O2", "L2", "F", d("2026-02-01"), "10.00", "P1"),  # base year
        ("n", "https://x/y/A1", "O3", "L3", "F", None, "7.00", "P1"),               # NULL date
        ("n", "https://x/y/A1", "O4", "L4", "F", d("2020-01-01"), "1,234", "P2"),   # not a number
    ])
    roll = spark.createDataFrame([("A1", "F", "", "L1")], "account_id string, family string, "
                                 "decom_rr_olis string, provision_olis string")
    rules = PeriodRules(from_period="P1", to_period="P2", base_year=2026, attach_lists=True)
    got = {r["oli_id"]: r for r in period_change(arr, roll, rules).collect()}
    assert got["L1"]["arr_diff"] == 50.0 and got["L1"]["max_q"] == 2
    assert got["L1"]["decom_rr_olis"] == "" and got["L1"]["provision_olis"] == "L1"
    assert got["L2"]["account_id"] == "" and got["L2"]["arr_diff"] == 10.0
    assert got["L3"]["arr_diff"] == 7.0
    assert got["L4"]["arr_diff"] is None
    zero = {r["oli_id"]: r["arr_diff"] for r in period_change(
        arr, roll, PeriodRules(from_period="P1", to_period="P2", base_year=2026,
                               new_deal="zero")).collect()}
    assert zero["L2"] == 0.0


def test_period_swap_flips_sign(spark):
    arr = _arr(spark, [
        ("n", "l/A1", "O1", f"L{i}", "F", d("2020-05-01"), f"{10 * i}.00", q)
        for i in range(1, 6) for q in ("P1", "P2") if (i + len(q)) % 3])
    roll = spark.createDataFrame([], "account_id string, family string, decom_rr_olis string, "
                                     "provision_olis string")
    fwd = {r["oli_id"]: r["arr_diff"] for r in period_change(
        arr, roll, PeriodRules(from_period="P1", to_period="P2", base_year=2026)).collect()}
    back = {r["oli_id"]: r["arr_diff"] for r in period_change(
        arr, roll, PeriodRules(from_period="P2", to_period="P1", base_year=2026)).collect()}
    assert fwd == {k: -v for k, v in back.items()}


def test_account_rollup_strings(spark):
    m = facts_df(spark, [
        {"oli_id": "L2", "account_id": "A1", "family": "LONG", "opp_type": "New",
         "close_date": d("2020-01-02")},
        {"oli_id": "L1", "account_id": "A1", "family": "LONG", "opp_type": "New",
         "close_date": d("2020-01-01")},
        {"oli_id": "L1", "account_id": "A1", "family": "LONG", "opp_type": "New",
         "close_date": d("2020-01-01")},
        {"oli_id": "L3", "account_id": "A1", "family": "LONG", "opp_type": "Renewal"},
    ])
    cl = spark.createDataFrame([("L1", 1, None), ("L2", None, 1), ("L3", 1, None)],
                               "oli_id string, decom_rr int, provisioned int")
    fs = spark.createDataFrame([("LONG", "SH")], "family string, short_name string")
    got = account_rollup(m, cl, fs).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["family"], r["decom_rr_olis"], r["provision_olis"], r["close_dates"]) == \
        ("SH", "L1", "L2", "2020-01-01, 2020-01-02")


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    plain = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert exclude_not_in(left, with_null, "k").count() == 0
    assert rows(exclude_not_in(left, plain, "k"), "k") == [(2,)]
    assert exclude_not_in(left, empty, "k").count() == 3


def test_read_by_name_or_path(spark, tmp_path):
    from saletrace.sources.io import read_table, read_tables

    df = spark.createDataFrame([(1,), (2,)], "n int")
    df.write.parquet(str(tmp_path / "probe_t.parquet"))
    spark.sql("CREATE DATABASE IF NOT EXISTS read_probe_db")
    df.write.mode("overwrite").saveAsTable("read_probe_db.probe_t")
    try:
        assert read_table(spark, "read_probe_db.probe_t").count() == 2
        assert read_table(spark, str(tmp_path / "probe_t.parquet")).count() == 2
        for base in ("read_probe_db", str(tmp_path)):
            assert read_tables(spark, base, ["probe_t"])["probe_t"].agg({"n": "sum"}).first()[0] == 3
    finally:
        spark.sql("DROP DATABASE read_probe_db CASCADE")


def test_profile_counts(spark):
    a = spark.createDataFrame([(1, "x"), (1, None), (2, "y")], "n int, s string")
    got = {r["column_name"]: r for r in profile_columns({"a": a, "b": a}, ["a"]).collect()}
    assert set(got) == {"n", "s"}
    assert (got["n"]["row_count"], got["n"]["non_null_count"], got["n"]["distinct_count"]) == (3, 3, 2)
    assert (got["s"]["non_null_count"], got["s"]["distinct_count"], got["s"]["ordinal_position"]) == (2, 2, 2)
    assert got["s"]["data_type"] == "string"


def test_account_rollup_long_form_has_same_content(spark):
    m = facts_df(spark, [
        {"oli_id": f"L{i}", "account_id": f"A{i % 2}", "family": "LONG", "opp_type": "New",
         "close_date": d(f"2020-01-0{1 + i % 3}")} for i in range(8)])
    cl = spark.createDataFrame([(f"L{i}", 1 if i % 3 == 0 else None, 1 if i % 3 == 1 else None)
                                for i in range(8)], "oli_id string, decom_rr int, provisioned int")
    fs = spark.createDataFrame([("LONG", "SH")], "family string, short_name string")
    strings = {(r["account_id"], r["family"]): r for r in account_rollup(m, cl, fs).collect()}
    long = account_rollup(m, cl, fs, as_strings=False).collect()
    for (acct, fam), r in strings.items():
        for lst in ("decom_rr_olis", "provision_olis", "close_dates"):
            vals = sorted(x["value"] for x in long
                          if (x["account_id"], x["family"], x["list"]) == (acct, fam, lst))
            assert ", ".join(vals) == r[lst]


def test_profile_listing_and_catalog(spark):
    from saletrace.operators.profile import profile_catalog

    a = spark.createDataFrame([(1, "x"), (2, None)], "n int, s string")
    listing = profile_columns({"a": a}, counts=False, sort=True).collect()
    assert [(r["column_name"], r["data_type"], r["ordinal_position"]) for r in listing] == \
        [("n", "int", 1), ("s", "string", 2)]
    a.createOrReplaceTempView("profile_probe_a")
    got = {r["column_name"]: r for r in profile_catalog(spark, tables=["profile_probe_a"]).collect()}
    assert got["s"]["non_null_count"] == 1 and got["n"]["distinct_count"] == 2
    spark.catalog.dropTempView("profile_probe_a")


def test_period_rejects_counts_bad_amounts(spark):
    from saletrace.operators.period import period_rejects

    arr = _arr(spark, [
        ("n", "l/A1", "O1", "L1", "F", d("2020-05-01"), "1,234", "P1"),
        ("n", "l/A1", "O1", "L2", "F", d("2020-05-01"), "12.50", "P1"),
        ("n", "l/A1", "O1", "L3", "F", d("2020-05-01"), None, "P2"),
        ("n", "l/A1", "O1", "L4", "F", d("2020-05-01"), "x", "P9"),
    ])
    got = {r["year_quarter"]: (r["n_rows"], r["n_rejected"])
           for r in period_rejects(arr, PeriodRules(from_period="P1", to_period="P2")).collect()}
    assert got == {"P1": (2, 1), "P2": (1, 0)}


def test_period_amounts_are_not_rounded_or_lost(spark):
    """More decimals, exponents and many digits keep their value."""
    texts = {"L1": "12.345", "L2": "0.004", "L3": "12345678901234567890", "L4": "1.5e17",
             "L5": "-7.25", "L6": "n/a"}
    arr = _arr(spark, [("n", "l/A1", "O", k, "F", d("2020-05-01"), v, "P2") for k, v in texts.items()])
    got = {r["oli_id"]: r["arr_diff"] for r in period_change(
        arr, None, PeriodRules(from_period="P1", to_period="P2")).collect()}
    assert got == {"L1": 12.345, "L2": 0.004, "L3": 12345678901234567890.0, "L4": 1.5e17,
                   "L5": -7.25, "L6": None}


def test_positions_are_the_same_written_or_not(spark):
    from saletrace.operators.ordering import with_position
    from saletrace.plans.materialize import materialize

    df = spark.range(0, 997).select((F.col("id") * 7919 % 997).alias("k"), (F.col("id") % 5).alias("g"))
    order = (F.col("g").desc(), F.col("k"))
    one = with_position(df, order).orderBy("pos").collect()
    spread = with_position(df, order, lambda x: materialize(x, "ordered")).orderBy("pos").collect()
    assert one == spread and [r["pos"] for r in spread] == list(range(1, 998))


def test_catalog_profile_keeps_a_view_and_a_table_of_one_name(spark):
    from saletrace.operators.profile import profile_catalog

    spark.sql("CREATE DATABASE IF NOT EXISTS profile_probe_db")
    spark.createDataFrame([(1,), (2,)], "n int").write.mode("overwrite").saveAsTable(
        "profile_probe_db.probe_b")
    spark.createDataFrame([("x",)], "s string").createOrReplaceTempView("probe_b")
    try:
        got = [(r["table_schema"], r["column_name"], r["row_count"])
               for r in profile_catalog(spark, tables=["probe_b"]).collect()]
        assert got == [("", "s", 1), ("profile_probe_db", "n", 2)]
        only = profile_catalog(spark, schema="profile_probe_db", tables=["probe_b"], counts=False)
        assert [(r["table_schema"], r["pos"]) for r in only.collect()] == [("profile_probe_db", 1)]
    finally:
        spark.catalog.dropTempView("probe_b")
        spark.sql("DROP DATABASE profile_probe_db CASCADE")
