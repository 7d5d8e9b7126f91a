"""Composite operators, each ``DataFrame -> DataFrame``."""

from saletrace.operators.assets import (  # noqa: F401
    AssetSource, enrich_assets, host_keys, unify_sources)
from saletrace.operators.classify import classify_lines, classify_summary  # noqa: F401
from saletrace.operators.compare import compare_snapshots, rank_segments, segments  # noqa: F401
from saletrace.operators.exclusion import exclude_not_in  # noqa: F401
from saletrace.operators.facts import line_facts  # noqa: F401
from saletrace.operators.matching import best_tiers, match_summary, tiered_match  # noqa: F401
from saletrace.operators.ordering import with_position  # noqa: F401
from saletrace.operators.period import period_change  # noqa: F401
from saletrace.operators.profile import profile_columns, profile_table  # noqa: F401
from saletrace.operators.rollups import account_rollup  # noqa: F401
from saletrace.operators.status import decom_rollup, line_status, reversal_rollup  # noqa: F401
