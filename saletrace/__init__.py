"""saletrace: reconcile sold line items with provisioned assets on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
built-in expressions, joins and aggregations; business literals are
parameters (``saletrace.params``).  Nothing is collected to the driver.
"""

from saletrace.operators import (  # noqa: F401
    AssetSource,
    account_rollup,
    classify_lines,
    compare_snapshots,
    decom_rollup,
    enrich_assets,
    exclude_not_in,
    host_keys,
    line_facts,
    line_status,
    period_change,
    profile_columns,
    rank_segments,
    reversal_rollup,
    segments,
    tiered_match,
    unify_sources,
)
from saletrace.params import (  # noqa: F401
    TIER_LABELS,
    ClassifyRules,
    FactRules,
    Lookups,
    PeriodRules,
    StatusRules,
)
