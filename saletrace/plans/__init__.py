"""Composed plans: the end-to-end run, the query catalogue used by the
driver and the benchmark, the SQL oracles, and plan checks."""
