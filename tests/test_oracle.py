"""Registered queries against DuckDB on the smallest sample.

A selection covering every module; ``LOGPULSE_ALL_QUERIES=1`` runs them all (as does
``oracle_check.py``, at any scale).
"""

from __future__ import annotations

import os
import re

import pytest

from logpulse.oracle import ORACLE
from logpulse.registry import QUERIES

from conftest import SF_DIR
from oracle_check import compare, connect

SELECTED = (
    "p_normalized_events", "p1_f1_bad_rows", "f1_split_counts_by_mode", "p16_f3_dead_letter_table",
    "p18_failed_batch_envelopes", "p20_dead_letter_messages", "p21_stable_event_ids",
    "f8_error_fan_out", "a15_latest_per_event", "a2_created_stored_1m", "a4_ingest_lag_1m",
    "a5_stage_latency_service_1m", "a10_a14_merged_partials", "st12_shared_states_traffic_1m",
    "q2_error_rate_10s", "q9_j1_health", "q14_o3_top_services", "q17_dlq_counts",
    "f9_alerting_log_lines", "j3_batches_to_recover", "a19_offset_lag_totals",
    "j5_threshold_breaches", "a20_batch_timing_summary", "st13_st14_alerts", "st15_capacity_levels",
    "f1_strict_hostile_texts", "st3_watermark_with_bad_clocks", "k11_expired_folders",
    "st12_rollup_switched_off_and_on", "k4_replayed_dead_letters", "a11_merged_sketches",
    "a5_stage_latency_service_1m_sketch", "q10_stage_p95_1m_sketch", "k5_st10_refused_batch", "st12_streamed_traffic_1m", "k3_k4_s4_streamed_dead_letters",
)
NAMES = sorted(QUERIES) if os.environ.get("LOGPULSE_ALL_QUERIES") else SELECTED


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert compare(result, duck, ORACLE[name]) is None
    else:
        assert result.count() > 0


def test_registry_is_complete():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)
    ids = {i for name in QUERIES for i in re.findall(r"(?:^|_)([a-z]{1,2}\d+)(?=_)", name)}
    wanted = {f"a{n}" for n in range(1, 22)} | {f"q{n}" for n in range(1, 18)}
    wanted |= {f"f{n}" for n in range(1, 10)} | {f"j{n}" for n in range(1, 6)}
    assert wanted <= ids, wanted - ids


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
