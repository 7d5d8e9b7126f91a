"""Parameters of the operators.

Business literals (stage names, cut-off dates, status codes, period labels)
are parameters with the defaults of the original pipeline.  Product-specific
lists (the families sold, the class→family mapping, short display names)
have no default: every deployment supplies its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES: output labels that downstream reports filter on.  They must
# equal the original pipeline's labels for results to line up.
# ---------------------------------------------------------------------------
# match tiers, best first, then the label for a line without any match
TIER_LABELS = (
    "deployment_id_product_code_acct",
    "deployment_id_family_acct",
    "account_family",
    "no_match",
)
# line status decision list, in the order the conditions are tested
STATUS_LABELS = (
    "negative_oli",
    "pf_booked_sfdc_snow_active_production",
    "pf_booked_sfdc_snow_active_production_not_pf_enabled",
    "pf_booked_sfdc_snow_active_staging",
    "pf_booked_sfdc_snow_active_other",
    "pf_booked_sfdc_snow_deprovisioned",
    "pf_booked_sfdc_no_snow_record",
    "pf_booked_snow_only_active_production",
    "pf_booked_snow_only_active_production_not_pf_enabled",
    "pf_booked_snow_only_active_other",
    "pf_booked_snow_only_deprovisioned",
    "pf_booked_unmatched",
    "not_pf_booked_sfdc_snow_active_production",
    "not_pf_booked_snow_only_active_production",
    "not_pf_booked_has_provision",
    "not_pf_booked_unmatched",
    "unknown",
)
# decommission source labels: both, decommission feed only, reversal only, none
DECOM_SOURCE_LABELS = ("both", "builder", "reverse_rebook", "none")
# snapshot comparison: segment names in report order, and the total row label
SEGMENT_ORDER = ("total_old", "total_new", "in_both", "old_only", "new_only")
OVERALL_LABEL = "overall"
# value marking a reversed line in line facts
REVERSAL_LABEL = "reversal"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FactRules:
    """Which sold line items enter the matching (line facts)."""

    families: tuple[str, ...]
    won_stage: str = "8 - Closed Won"
    closed_after: str = "2022-12-31"
    primary_flag: str = "true"
    charge_type: str = "Recurring"
    revenue_class: str = "SaaS"
    opportunity_link: str = "Opportunity"
    quote_line_link: str = "Quote"


@dataclass(frozen=True)
class ClassifyRules:
    """Line classification (decommissioned/reversed, provisioned)."""

    excluded_opp_type: str = "Renewal"
    excluded_quantity: float = 0.1
    active_status: str = "1"
    live_uses: tuple[str, ...] = ("Staging", "Production")
    linked_tier_marker: str = "deployment"
    # families (substring match) always counted as provisioned
    always_provisioned: tuple[str, ...] = ()
    # families (substring match) counted as provisioned when closed after the date
    provisioned_after: tuple[str, ...] = ()
    provisioned_after_date: str = "2025-01-01"


@dataclass(frozen=True)
class StatusRules:
    """Line status and anomaly flags; ``as_of`` None means the current date."""

    as_of: str | None = None
    active_status: str = "1"
    deprovisioned_status: str = "4"
    production_use: str = "production"
    staging_use: str = "staging"
    cancelled_status: str = "Cancelled"
    decom_match_value: int = 1
    reversal_booking: str = "Reversal"
    opportunity_link: str = "Opportunity"
    quote_link: str = "Quote"


@dataclass(frozen=True)
class PeriodRules:
    """Signed revenue change between two period labels."""

    from_period: str = "2026 | Q1"
    to_period: str = "2026 | Q2"
    base_year: int = 2026
    # "keep": a from-period deal closed in the base year is added as is (the
    # original code); "zero": it contributes nothing.
    new_deal: str = "keep"
    excluded_opp_type: str = "Renewal"
    # double, as the original casts; a wide decimal sums exactly, but turns
    # texts it cannot hold into NULL (counted by ``period_rejects``)
    amount_type: str = "double"
    sort: bool = True
    # attach the account rollup's id lists to every row, as the original's
    # report does.  One row then holds a whole account's list, and the report
    # repeats it on every line: the long rollup, joined at reading time on
    # (account_id, family), has the same content and grows with the data.
    attach_lists: bool = False


@dataclass(frozen=True)
class Lookups:
    """Constant relations: (class_name, family) and (family, short_name)."""

    class_family: tuple[tuple[str, str], ...] = field(default_factory=tuple)
    family_short: tuple[tuple[str, str], ...] = field(default_factory=tuple)
