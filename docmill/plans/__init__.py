"""Shared dataflow plans: session set-up, lineage cuts, prefix sums."""
