"""Column expressions shared by the operators (all Spark built-ins)."""

from saletrace.functions.hosts import dotted_prefix, first_label  # noqa: F401
from saletrace.functions.logic import (  # noqa: F401
    contains_any,
    decision_list,
    flag01,
    is_true,
    ordinal,
    sorted_join,
)
