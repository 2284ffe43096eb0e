"""Rollup plans, serving queries, retention."""
