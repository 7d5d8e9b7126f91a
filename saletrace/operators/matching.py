"""Tiered match (C5): every line item against its candidate assets.

The tiers are data.  A :class:`Tier` names the key expressions of either side,
which must be equal, a predicate on the asset, a predicate on the line, and
whether one asset key goes through a lookup (asset class to families).  A
line id takes the best tier for which it has at least one candidate asset, and
keeps *all* pairs of that tier; a line id without any gets one row per fact
row with the label of no match.  Exclusion is per line id, not per row.

The original's cascade is :func:`default_tiers`:

1. ``deployment_id_product_code_acct``: asset has a deployment, same
   account, deployment product code = base product code of the line;
2. ``deployment_id_family_acct``: asset has a deployment, same account,
   (asset class, line family) in the class→family lookup;
3. ``account_family``: same account, (class, family) in the lookup;
4. ``no_match``.

Plan, instead of the literal cascade (each tier re-reading facts and assets,
and a NULL-aware anti join per earlier tier):

* tiers with the same key expressions are one *kind* (the last two above);
* every asset row is expanded once into its keys, an array with one entry per
  kind (and per looked-up value); an entry says for which tiers it counts;
* ``key_summaries`` groups the entries by key values, with map-side partial
  aggregation, so a hot account shrinks to one row per key before any shuffle.
  One array per key holds, for every tier, its asset rows and whether any is
  live or decommissioned.  All kinds read the same wide table, whose shuffle
  Spark reuses: the assets are read once whatever the number of tiers;
* each fact row looks up one key per kind (left joins, NULL keys spread) and
  gets its own best tier; the line's best tier is the minimum over its rows, a
  partially aggregated ``min`` per line id (a window would hold all rows of a hot
  line id in one task).  It differs from a row's own only for lines whose rows
  have several tiers: these lines alone are joined back, and Spark broadcasts
  them if they are few, so the rows need no shuffle by line;
* ``match_summary`` stops there: which rows match, in which tier, with how
  many assets and of which state.  Counts, comparisons and rollups need no
  more, so they never build a pair.  What aggregates by line reads
  ``row_matches``, each row with its own tier, and takes the least tier in the
  same aggregate: no minimum and no join of its own;
* ``tiered_match`` goes on to the pairs, **only for the winning tier**, in a
  single inner join on the key values; pairs of losing tiers are never built,
  and the pair set is never shuffled again;
* where all keys begin with the same one (the account) and steps can be
  written, the facts meet the assets there once: the key's assets, a list of at
  most ``LIST_ROWS``, come to the row, which finds its tier and its assets in
  it.  No lookup per kind, no second shuffle of either side for the pairs.  A
  first key with more assets than that takes the lookups and the join above.

The annotated facts are read twice (the minimum and its join), and for pairs
the expanded assets too, so callers pass ``materialize_with``
(``plans.materialize.materialize``).  Building a plan runs no job besides the
writes that it does.

Line ids must not be NULL; the original's ``NOT IN`` would empty every
later tier after one NULL id.  NULL ids are grouped together here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saletrace.operators.assets import ASSET_SCHEMA
from saletrace.operators.facts import FACT_COLUMNS
from saletrace.operators.skew import only_copy, sliced_join
from saletrace.params import TIER_LABELS, ClassifyRules

# asset side of a matched row: (output name, canonical enriched-asset column, type)
PAIR_ASSET_COLUMNS: tuple[tuple[str, str, str], ...] = (
    ("asset_id", "asset_id", "string"),
    ("asset_account_id", "account_id", "string"),
    ("deployment_asset_id", "deployment_asset_id", "string"),
    ("deployment_id", "deployment_id", "string"),
    ("deployment_code", "deployment_code", "string"),
    ("decom_resource", "decom_resource", "string"),
    ("asset_enabled", "enabled", "boolean"),
    ("used_for", "used_for", "string"),
    ("install_status", "install_status", "string"),
    ("class_name", "class_name", "string"),
    ("model_id", "model_id", "string"),
    ("resource_key", "resource_key", "string"),
    ("created_at", "created_at", dict(ASSET_SCHEMA)["created_at"]),
    ("updated_at", "updated_at", dict(ASSET_SCHEMA)["updated_at"]),
    ("start_date", "start_date", "date"),
)
# FIXED VALUES: output order of the match table, line columns as the original
# lists them, then the asset columns, then the tier label
MATCHED_COLUMNS = (
    "oli_id", "opp_id", "qli_id", "account_id", "base_product_code", "family", "product_code",
    "enabled_ol", "enabled_ql", "transaction_type", "opp_type", "close_date", "quantity", "acv",
    "reversal_opp",
) + tuple(n for n, _, _ in PAIR_ASSET_COLUMNS) + ("match_type",)
#: stands for an asset key that the class→family lookup gives
LOOKED_UP = "<family of the class>"
#: asset rows of one first key that are joined as a list; more are joined as rows
LIST_ROWS = 128


@dataclass(frozen=True)
class Tier:
    """One match rule.  ``line`` and ``asset`` are SQL expressions over the
    fact columns and over the asset columns of ``PAIR_ASSET_COLUMNS``, equal
    pair by pair (compared as strings; NULL equals nothing).  One asset key
    may be ``LOOKED_UP``: each family that the lookup gives the asset's
    class.  ``asset_where`` and ``line_where`` restrict one side."""

    label: str
    line: tuple[str, ...]
    asset: tuple[str, ...]
    asset_where: str | None = None
    line_where: str | None = None


def default_tiers() -> tuple[Tier, ...]:
    """The original's three matching tiers, best first."""
    account, linked = "asset_account_id", "deployment_asset_id IS NOT NULL"
    return (
        Tier(TIER_LABELS[0], ("account_id", "base_product_code"), (account, "deployment_code"), linked),
        Tier(TIER_LABELS[1], ("account_id", "family"), (account, LOOKED_UP), linked),
        Tier(TIER_LABELS[2], ("account_id", "family"), (account, LOOKED_UP)),
    )


@dataclass(frozen=True)
class _Plan:
    """Tiers compiled: their kinds (distinct keys), and each tier's kind."""

    tiers: tuple[Tier, ...]
    kinds: tuple[tuple[tuple[str, ...], tuple[str, ...]], ...]
    width: int

    def kind(self, tier: Tier) -> int:
        return self.kinds.index((tier.line, tier.asset))

    def columns(self, prefix: str) -> list[str]:
        return [f"{prefix}{i}" for i in range(self.width)]


def _compile(tiers: Sequence[Tier]) -> _Plan:
    if not tiers:
        raise ValueError("no tier")
    for t in tiers:
        if len(t.line) != len(t.asset) or not t.line:
            raise ValueError(f"tier {t.label!r}: as many line keys as asset keys, and at least one")
        if t.asset.count(LOOKED_UP) > 1:
            raise ValueError(f"tier {t.label!r}: one looked-up key at most")
    if len({t.label for t in tiers}) < len(tiers):
        raise ValueError("two tiers of one label")
    kinds = tuple(dict.fromkeys((t.line, t.asset) for t in tiers))
    return _Plan(tuple(tiers), kinds, max(len(t.line) for t in tiers))


def _asset_side(assets: DataFrame) -> DataFrame:
    return assets.select(*[F.col(src).alias(out) for out, src, _ in PAIR_ASSET_COLUMNS])


def _padded(keys: list[Column], width: int) -> list[Column]:
    """Keys as strings, ``width`` of them (shorter ones end in empty strings)."""
    return [k.cast("string") for k in keys] + [F.lit("")] * (width - len(keys))


def _entry(asset_keys: tuple[str, ...], counts: Column, names: list[str]
           ) -> Callable[[Column], Column]:
    """The key entry of an asset, given the looked-up value (if any)."""
    def entry(value: Column) -> Column:
        keys = _padded([value if e == LOOKED_UP else F.expr(e) for e in asset_keys], len(names))
        return F.struct(*[k.alias(n) for k, n in zip(keys, names)], counts.alias("_for"))
    return entry


def keyed_assets(assets: DataFrame, class_family: DataFrame,
                 tiers: Sequence[Tier] | None = None) -> DataFrame:
    """A row per asset and match key: the asset columns, the key ``_k0...`` and
    ``_for``, an array of one boolean per tier (does the key count for it)."""
    plan = _compile(tiers or default_tiers())
    a = _asset_side(assets)
    if any(LOOKED_UP in asset for _, asset in plan.kinds):
        # one row per class: the join adds no rows
        families = class_family.groupBy(F.col("class_name").alias("_lk_class")).agg(
            F.collect_list("family").alias("_families"))
        a = a.join(F.broadcast(families), F.col("class_name") == F.col("_lk_class"), "left")
    names = plan.columns("_k")
    entries = []
    for kind in plan.kinds:
        counts = F.array(*[
            (F.coalesce(F.expr(t.asset_where), F.lit(False)) if t.asset_where else F.lit(True))
            if (t.line, t.asset) == kind else F.lit(False) for t in plan.tiers])

        entry = _entry(kind[1], counts, names)
        if LOOKED_UP in kind[1]:
            entries.append(F.transform(F.coalesce("_families", F.array().cast("array<string>")), entry))
        else:
            entries.append(F.array(entry(F.lit(None))))
    some = F.filter(F.concat(*entries), lambda e: F.exists(e["_for"], lambda x: x) & _all_known(
        [e[n] for n in names]))
    return (a.withColumn("_key", F.explode(some))
            .select(*[n for n, _, _ in PAIR_ASSET_COLUMNS], "_key.*"))


def _all_known(columns: list[Column]) -> Column:
    out = columns[0].isNotNull()
    for c in columns[1:]:
        out = out & c.isNotNull()
    return out


def is_live(rules: ClassifyRules) -> Column:
    """An enabled, active asset in a live use (NULL where unknown)."""
    return ((F.col("asset_enabled") == F.lit(True))
            & (F.col("install_status") == rules.active_status)
            & F.col("used_for").isin(list(rules.live_uses)))


def key_summaries(keyed: DataFrame, rules: ClassifyRules = ClassifyRules(),
                  tiers: Sequence[Tier] | None = None) -> DataFrame:
    """Distinct keys ``_k0...`` with ``_stats``, an array of one struct per
    tier: the asset rows it gives (``n``), and whether any of them is live
    (``live``) or has a decommission key (``gone``).  Grouped by the ``_copy``
    of ``sliced_join`` as well, so its join needs no second shuffle of them."""
    plan = _compile(tiers or default_tiers())
    live = F.coalesce(is_live(rules), F.lit(False))
    gone = F.col("decom_resource").isNotNull()
    rows = keyed.select(*plan.columns("_k"), "_for", live.alias("_live"), gone.alias("_gone"))
    sums, stats = [], []
    for i in range(len(plan.tiers)):
        counts = F.col("_for")[i]
        sums += [F.count(F.when(counts, F.lit(1))).alias(f"_n{i}"),
                 F.max(counts & F.col("_live")).alias(f"_l{i}"),
                 F.max(counts & F.col("_gone")).alias(f"_g{i}")]
        stats.append(F.struct(F.col(f"_n{i}").alias("n"), F.col(f"_l{i}").alias("live"),
                              F.col(f"_g{i}").alias("gone")))
    return rows.groupBy(only_copy(plan.columns("_k")).alias("_copy"), *plan.columns("_k")).agg(*sums).select(
        "_copy", *plan.columns("_k"), F.array(*stats).alias("_stats"))


def _probing(facts: DataFrame, plan: _Plan, columns: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """The ``columns`` of the facts with their keys and the line predicates
    ``_w1...``, and the column that holds each key.  They come first: what they
    read need not travel.  Kinds share their keys, and a key that is one of
    ``columns`` travels as that."""
    types, own = dict(facts.dtypes), {}
    for line, _ in plan.kinds:
        for e in line:
            as_is = e in columns and types.get(e) == "string"
            own.setdefault(e, e if as_is else f"_q{len(own)}")
    keyed = [F.expr(e).cast("string").alias(c) for e, c in own.items() if e != c]
    if any(len(line) < plan.width for line, _ in plan.kinds):
        keyed.append(F.lit("").alias("_q_pad"))
    where = [F.coalesce(F.expr(t.line_where), F.lit(False)).alias(f"_w{at}")
             for at, t in enumerate(plan.tiers, 1) if t.line_where]
    return facts.select(*columns, *keyed, *where), own


def row_tiers(facts: DataFrame, keys: DataFrame, columns: Sequence[str] = FACT_COLUMNS,
              tiers: Sequence[Tier] | None = None, hot_rows: int | None = None) -> DataFrame:
    """The ``columns`` of each fact row with ``_row_tier`` (the row's own best
    tier, from 1, one past the last for none) and ``_n, _any_live, _any_gone``:
    how many assets that tier gives, and of which state.  ``keys``:
    ``key_summaries``.  Only ``columns`` and what the tiers read are shuffled.

    Rows with a NULL key are spread in the lookups; with ``hot_rows``, keys
    of over that many facts are sliced as well (``operators.skew``)."""
    plan = _compile(tiers or default_tiers())
    f, own = _probing(facts, plan, columns)
    for i, (line, _) in enumerate(plan.kinds):
        right = [f"_r{i}_{j}" for j in range(plan.width)]
        left = [own[e] for e in line] + ["_q_pad"] * (plan.width - len(line))
        side = keys.select("_copy", *[F.col(k).alias(r) for k, r in zip(plan.columns("_k"), right)], "_stats")
        f = sliced_join(f, side, list(zip(left, right)), "left", hot_rows)
        # the best tier of this kind, and what it says: the statistics of the
        # other tiers need not travel
        tier, said = F.lit(None).cast("int"), dict.fromkeys(("n", "live", "gone"), F.lit(None))
        for at in range(len(plan.tiers), 0, -1):
            t = plan.tiers[at - 1]
            if plan.kind(t) != i:
                continue
            stat = F.col("_stats")[at - 1]
            hit = F.coalesce(stat["n"] > 0, F.lit(False))
            if t.line_where:
                hit = hit & F.col(f"_w{at}")
            tier = F.when(hit, F.lit(at)).otherwise(tier)
            said = {n: F.when(hit, stat[n]).otherwise(c) for n, c in said.items()}
        f = f.withColumns({f"_t{i}": tier, **{f"_{n}{i}": c for n, c in said.items()}}).drop("_stats", *right)
    kinds = range(len(plan.kinds))
    best = F.least(*[F.col(f"_t{i}") for i in kinds], F.lit(len(plan.tiers) + 1))

    def of_best(name: str) -> Column:
        return F.coalesce(*[F.when(F.col(f"_t{i}") == best, F.col(f"_{name}{i}")) for i in kinds])
    return f.select(*columns, best.alias("_row_tier"), of_best("n").alias("_n"),
                    of_best("live").alias("_any_live"), of_best("gone").alias("_any_gone"))


def _line_keys(id_col: str) -> tuple[Column, Column]:
    """NULL ids are one line."""
    return F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(id_col).isNull()


def mixed_lines(rows: DataFrame, id_col: str = "oli_id") -> DataFrame:
    """The lines whose rows differ in ``_row_tier``, with the least of them
    (``_best``): a partially aggregated minimum, not a window, which would hold
    every row of a line in one task.  All rows of any other line have the
    line's best tier."""
    own, none = _line_keys(id_col)
    return (rows.groupBy(own.alias("_b_id"), none.alias("_b_null"))
            .agg(F.min("_row_tier").alias("_best"), F.max("_row_tier").alias("_worst"))
            .where(F.col("_best") < F.col("_worst")).drop("_worst"))


def best_tiers(facts: DataFrame, keys: DataFrame, id_col: str = "oli_id",
               tiers: Sequence[Tier] | None = None, hot_rows: int | None = None,
               materialize_with: Callable[[DataFrame], DataFrame] | None = None,
               columns: Sequence[str] = FACT_COLUMNS,
               materialize_lines_with: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``row_tiers`` with ``_best``, the line's best tier over all its rows.

    Only ``mixed_lines`` are joined to the rows.  Written by
    ``materialize_lines_with``, they have a known size, so the rows are shuffled
    by line only if the mixed lines are too many to broadcast."""
    f = (materialize_with or (lambda df: df))(row_tiers(facts, keys, columns, tiers, hot_rows))
    return _with_best(f, (materialize_lines_with or (lambda df: df))(mixed_lines(f, id_col)), id_col)


def _with_best(rows: DataFrame, mixed: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with ``_best``, from the ``mixed_lines`` or their own tier."""
    own, none = _line_keys(id_col)
    return (rows.join(mixed, (own == F.col("_b_id")) & (none == F.col("_b_null")), "left")
            .drop("_b_id", "_b_null").withColumn("_best", F.coalesce("_best", "_row_tier")))


def _tier_label(tiers: Sequence[Tier], no_match: str, tier: str = "_best") -> Column:
    return F.element_at(F.array(*[F.lit(t.label) for t in tiers], F.lit(no_match)), F.col(tier))


def row_matches(facts: DataFrame, assets: DataFrame, class_family: DataFrame,
                rules: ClassifyRules = ClassifyRules(), tiers: Sequence[Tier] | None = None,
                no_match: str = TIER_LABELS[-1], columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """The ``columns`` of every fact row with its own best tier ``_row_tier``
    and what that gives: ``match_type``, ``any_live``, ``any_decom``.  The rows
    of ``match_summary`` are those whose tier is the least of their line;
    aggregates by line (``classify.classify_rows``, ``compare.compare_cuts``)
    find it as they go, so the rows are shuffled by line once."""
    tiers = tuple(tiers or default_tiers())
    f = row_tiers(facts, key_summaries(keyed_assets(assets, class_family, tiers), rules, tiers), columns, tiers)
    return f.select(*columns, "_row_tier", _tier_label(tiers, no_match, "_row_tier").alias("match_type"),
                    F.coalesce("_any_live", F.lit(False)).alias("any_live"),
                    F.coalesce("_any_gone", F.lit(False)).alias("any_decom"))


def match_summary(facts: DataFrame, assets: DataFrame, class_family: DataFrame,
                  id_col: str = "oli_id", rules: ClassifyRules = ClassifyRules(),
                  tiers: Sequence[Tier] | None = None, no_match: str = TIER_LABELS[-1],
                  materialize_with: Callable[[DataFrame], DataFrame] | None = None,
                  columns: Sequence[str] = FACT_COLUMNS,
                  materialize_lines_with: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The fact rows that have a row in the match, with ``match_type``,
    ``n_rows`` (how many they have there: pairs, or one if unmatched),
    ``any_live`` and ``any_decom`` (over the assets they are paired with).
    The match itself, without its pairs: every join is on a distinct key, so
    the result has at most a row per fact.

    ``columns``: the fact columns wanted, ``id_col`` among them.  The annotated
    facts are written, which no optimizer prunes: name what is read later."""
    tiers = tuple(tiers or default_tiers())
    f = best_tiers(facts, key_summaries(keyed_assets(assets, class_family, tiers), rules, tiers),
                   id_col, tiers, materialize_with=materialize_with, columns=columns,
                   materialize_lines_with=materialize_lines_with)
    return (f.where(F.col("_row_tier") == F.col("_best"))
            .select(*columns, _tier_label(tiers, no_match).alias("match_type"),
                    F.coalesce("_n", F.lit(1)).cast("bigint").alias("n_rows"),
                    F.coalesce("_any_live", F.lit(False)).alias("any_live"),
                    F.coalesce("_any_gone", F.lit(False)).alias("any_decom")))


def _salted(probe: DataFrame, keyed: DataFrame, width: int,
            hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Slice the keys of the pair join that have over ``hot_rows`` rows on
    either side.

    The larger side of such a key is dealt by a hash over as many slices as
    bring each under ``hot_rows``, the smaller one is repeated once per slice,
    so every (line, asset) pair still meets exactly once.  Slices follow the
    counted rows; there are at most (rows of both sides / ``hot_rows``) hot
    keys, so they enter the plan as one map, by a scalar subquery, and neither
    side is shuffled to find its slices.  Keys are told apart by a hash; two
    of one hash are counted and sliced together.
    """
    def key(df: DataFrame, prefix: str) -> Column:
        names = [f"{prefix}{i}" for i in range(width)]
        return F.when(_all_known([F.col(n) for n in names]), F.xxhash64(*names))

    def counted(df: DataFrame, prefix: str, count: str) -> DataFrame:
        h = f"{prefix}_h"
        return df.groupBy(key(df, prefix).alias(h)).agg(F.count(F.lit(1)).alias(count))

    larger = F.greatest("_rows", "_q_rows")
    hot = (counted(keyed, "_k", "_rows").join(counted(probe, "_p", "_q_rows"), F.col("_k_h") == F.col("_p_h"))
           .where(larger > hot_rows)
           .select("_k_h", F.struct(F.ceil(larger / hot_rows).cast("int").alias("slices"),
                                    (F.col("_rows") >= F.col("_q_rows")).alias("deal_assets")).alias("_s")))
    # one group of all hot keys, if there is any
    hot = hot.groupBy(F.pmod("_k_h", F.lit(1))).agg(
        F.map_from_entries(F.collect_list(F.struct("_k_h", "_s"))).alias("_m")).select("_m").scalar()

    def sliced(df: DataFrame, prefix: str, deals: Callable[[Column], Column], by: str) -> DataFrame:
        s = F.col("_hot")
        dealt = F.array(F.pmod(F.xxhash64(by), s["slices"]).cast("int"))
        salts = (F.when(s.isNull(), F.array(F.lit(0))).when(deals(s["deal_assets"]), dealt)
                 .otherwise(F.sequence(F.lit(0), s["slices"] - 1)))
        return (df.withColumn("_m", hot).withColumn("_hot", F.try_element_at("_m", key(df, prefix)))
                .withColumn(f"{prefix}_salt", F.explode(salts)).drop("_m", "_hot"))

    return (sliced(probe, "_p", lambda a: ~a, "oli_id"), sliced(keyed, "_k", lambda a: a, "asset_id"))


def crowded_keys(keyed: DataFrame, most: int) -> DataFrame:
    """The first keys (``_crowd``) with over ``most`` rows of ``keyed_assets``."""
    return (keyed.groupBy(F.col("_k0").alias("_crowd")).agg(F.count(F.lit(1)).alias("_rows"))
            .where(F.col("_rows") > most).select("_crowd"))


def listed_matches(facts: DataFrame, keyed: DataFrame, crowded: DataFrame, plan: _Plan,
                   columns: Sequence[str]) -> DataFrame:
    """The ``columns`` of each fact row with ``_row_tier`` and ``_hits``, the
    asset columns of every pair that the row has in that tier.  Rows of a
    crowded first key are marked (``_many``) and have neither.

    The assets of a first key come as one list, dealt with the facts by that
    key: kinds differ in later keys only, which are compared in the list."""
    shown, later = [n for n, _, _ in PAIR_ASSET_COLUMNS], plan.columns("_k")[1:]
    f, own = _probing(facts, plan, columns)
    first = own[plan.kinds[0][0][0]]
    f = (f.join(crowded, F.col(first) == F.col("_crowd"), "left")
         .withColumn("_many", F.col("_crowd").isNotNull()).drop("_crowd"))
    few = (keyed.join(crowded, F.col("_k0") == F.col("_crowd"), "left_anti")
           .withColumn("_copy", only_copy(["_k0"])).repartition("_copy", "_k0"))
    lists = few.groupBy("_copy", "_k0").agg(
        F.collect_list(F.struct(*shown, *later, "_for")).alias("_assets"))
    f = sliced_join(f, lists, [(first, "_k0")], "left", None, spread=F.col("_many"))

    def best(x: Column) -> Column:
        """The best tier in which the row meets an asset of its list."""
        said = []
        for at, t in enumerate(plan.tiers, 1):
            hit = x["_for"][at - 1]
            if t.line_where:
                hit = hit & F.col(f"_w{at}")
            keys = [F.col(own[e]) for e in t.line[1:]]
            for k, q in zip(later, keys + [F.lit("")] * (len(later) - len(keys))):
                hit = hit & (x[k] == q)
            said.append(F.when(hit, F.lit(at)))
        return F.coalesce(*said)
    f = f.withColumn("_met", F.filter(
        F.transform("_assets", lambda x: F.struct(best(x).alias("tier"), x.alias("asset"))),
        lambda m: m["tier"].isNotNull()))
    f = f.withColumn("_row_tier", F.when(~F.col("_many"), F.coalesce(
        F.array_min(F.transform("_met", lambda m: m["tier"])), F.lit(len(plan.tiers) + 1))))
    # what meets the row in its tier has no better one
    hits = F.transform(F.filter("_met", lambda m: m["tier"] == F.col("_row_tier")),
                       lambda m: F.struct(*[m["asset"][n].alias(n) for n in shown]))
    return f.select(*columns, "_many", "_row_tier", hits.alias("_hits"))


def _joined_pairs(f: DataFrame, keyed: DataFrame, plan: _Plan, no_match: str,
                  hot_key_rows: int | None) -> DataFrame:
    """The pairs and unmatched rows of the rows ``f`` that have their line's
    best tier, by a join on the keys."""
    # named by the row's own tier, which the scan of the written facts filters
    best, none = F.col("_row_tier"), len(plan.tiers) + 1

    def probe_key(j: int) -> Column:
        out = F.lit(None).cast("string")
        for at, t in enumerate(plan.tiers, 1):
            out = F.when(best == at, _padded([F.expr(e) for e in t.line], plan.width)[j]).otherwise(out)
        return out

    probe = f.where(best < none).select(
        *FACT_COLUMNS, "_row_tier", *[probe_key(j).alias(f"_p{j}") for j in range(plan.width)])
    cond = F.element_at(F.col("_for"), best)
    for j in range(plan.width):
        cond = cond & (F.col(f"_p{j}") == F.col(f"_k{j}"))
    if hot_key_rows is not None:
        probe, keyed = _salted(probe, keyed, plan.width, hot_key_rows)
        cond = cond & (F.col("_p_salt") == F.col("_k_salt"))
    pairs = (probe.join(keyed, cond)
             .select(*[F.col(c) for c in FACT_COLUMNS],
                     *[F.col(n) for n, _, _ in PAIR_ASSET_COLUMNS],
                     _tier_label(plan.tiers, no_match, "_row_tier").alias("match_type")))
    nulls = [F.lit(None).cast(t).alias(n) for n, _, t in PAIR_ASSET_COLUMNS]
    unmatched = (f.where(best == none)
                 .select(*[F.col(c) for c in FACT_COLUMNS], *nulls,
                         F.lit(no_match).alias("match_type")))
    return pairs.unionByName(unmatched)


def tiered_match(facts: DataFrame, assets: DataFrame, class_family: DataFrame,
                 id_col: str = "oli_id",
                 materialize_with: Callable[[DataFrame], DataFrame] | None = None,
                 hot_key_rows: int | None = None, tiers: Sequence[Tier] | None = None,
                 no_match: str = TIER_LABELS[-1], list_rows: int = LIST_ROWS) -> DataFrame:
    """All pairs of each line's best tier, else one ``no_match`` row (C5).

    ``facts``: ``line_facts`` output.  ``assets``: ``enrich_assets`` output.
    ``class_family(class_name, family)``: the lookup.  ``tiers``: the match
    rules, best first (``default_tiers``).  Output: the 15 fact columns, the
    15 asset columns of ``PAIR_ASSET_COLUMNS`` and ``match_type``.

    A row whose own tier is not the line's best meets no asset in that (another
    row of the line matched better), so only the others go on: to the pair join,
    or, where no tier is met, straight to the result.

    ``materialize_with`` is applied to the expanded assets, the facts with their
    tier, and the ``mixed_lines``, each read more than once.  Where it is given
    and all keys of the tiers begin with the same one, the facts meet the assets
    by lists (``listed_matches``), but for first keys of over ``list_rows``
    asset rows; their facts are written once more, with their tier.  With
    ``hot_key_rows``, a key with more rows than that on either side of the pair
    join is sliced (see ``_salted``), independent of AQE's skew handling.  The
    result is the same by every way.
    """
    tiers = tuple(tiers or default_tiers())
    plan = _compile(tiers)
    keep = materialize_with or (lambda df: df)
    keyed = keep(keyed_assets(assets, class_family, tiers))
    columns = list(dict.fromkeys((*FACT_COLUMNS, id_col)))

    def with_tier(rows: DataFrame, keyed: DataFrame) -> DataFrame:
        return keep(row_tiers(rows, key_summaries(keyed, tiers=tiers), columns, tiers)
                    .select(*columns, "_row_tier"))

    def of_best(rows: DataFrame, mixed: DataFrame) -> DataFrame:
        return _with_best(rows, mixed, id_col).where(F.col("_row_tier") == F.col("_best"))
    if materialize_with is None or len({(line[0], asset[0]) for line, asset in plan.kinds}) > 1:
        f = with_tier(facts, keyed)
        out = _joined_pairs(of_best(f, keep(mixed_lines(f, id_col))), keyed, plan, no_match, hot_key_rows)
        return out.select(*MATCHED_COLUMNS)
    crowded = keep(crowded_keys(keyed, list_rows))
    met = keep(listed_matches(facts, keyed, crowded, plan, columns))
    listed = met.where(~F.col("_many"))
    many = keyed.join(crowded, F.col("_k0") == F.col("_crowd"), "left_semi")
    joined = with_tier(met.where("_many").select(*columns), many)
    tier_of = [id_col, "_row_tier"]
    mixed = keep(mixed_lines(listed.select(*tier_of).unionByName(joined.select(*tier_of)), id_col))
    pairs = (of_best(listed, mixed).withColumn("_hit", F.explode_outer("_hits"))
             .select(*FACT_COLUMNS, *[F.col(f"_hit.{n}").alias(n) for n, _, _ in PAIR_ASSET_COLUMNS],
                     _tier_label(tiers, no_match, "_row_tier").alias("match_type")))
    out = pairs.unionByName(_joined_pairs(of_best(joined, mixed), many, plan, no_match, hot_key_rows))
    return out.select(*MATCHED_COLUMNS)
