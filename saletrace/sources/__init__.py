"""Inputs and outputs: table reads, constant relations, snapshots, and the
fixture derivation from the driver's tables."""

from saletrace.sources.io import (  # noqa: F401
    lookup, read_snapshot, read_table, read_tables, write_snapshot)
