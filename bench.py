"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

* ``ingest_*``: topic files -> parse -> normalise -> event table and all rollups, one batch;
* ``ingest_backfill``: the same by the backfill job, rollups from the stored columns;
* ``microbatch_*``: the same as a stream of 20,000-row batches (mean seconds per batch);
* ``serve_*``: serving queries over the rollups stored by the ingest run;
* the rest: registered queries computed from the raw rows.

Each is run once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from logpulse import testbed as tb
from logpulse.config import SinkSettings, StreamSettings
from logpulse.operators.normalize import normalize_events, payload_fields
from logpulse.operators.parse import good_events, parse_events
from logpulse.plans import catalog, serve
from logpulse.registry import QUERIES
from logpulse.schema import BROKER_ROW, names
from logpulse.session import scratch_dir, tune
from logpulse.sources.broker import topic_stream, topic_table
from logpulse.sources.tables import read_table
from logpulse.streaming.delivery import Delivery
from logpulse.streaming.ingest import backfill
from logpulse.streaming.microbatch import MicroBatch, start
from logpulse.streaming.rollup_store import RollupStore
from logpulse.streaming.targets import ParquetTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REGISTERED = (
    "p_normalized_events",
    "a7_traffic_10s",
    "a8_stage_latency_10s",
    "a15_latest_per_event",
    "st12_shared_states_lag_1m",
    "q2_error_rate_10s",
    "q9_j1_health",
    "q14_o3_top_services",
)
BATCH_ROWS = 20_000
ROLLUP_COLUMNS = (
    "event_timestamp", "kafka_received_at", "spark_received_at", "event_id", "service",
    "status_code",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, repeats: int = 3) -> float:
    run()
    seconds = []
    for _ in range(repeats):
        began = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - began)
    return statistics.median(seconds)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("logpulse-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    took: dict[str, float] = {}
    root = scratch_dir(spark, "bench")

    # The topic as files: what a broker would hand out, so writing it is not timed.
    sent = tb.broker_rows(tb.events(spark, SF_DIR)).select(*names(BROKER_ROW))
    rows = sent.count()
    batches = max(1, round(rows / BATCH_ROWS))
    sent.repartition(batches * int(CPUS)).write.parquet(f"{root}/topics/logs.all/first")
    source = StreamSettings(files_root=f"{root}/topics")

    def store(at: str) -> RollupStore:
        return RollupStore(f"{at}/rollups", catalog.EVENT_ROLLUPS)

    def each(at: str) -> MicroBatch:
        table = ParquetTable(f"{at}/event_log", "kafka_received_at", ("service", "event_id"))
        return MicroBatch(
            Delivery(table, SinkSettings(fail_on_error=True)),
            stream="event_log",
            table="event_log",
            then=[store(at)],
        )

    def ingest() -> None:
        parsed = parse_events(topic_table(spark, source, "logs.all"))
        each(f"{root}/batch")(normalize_events(good_events(parsed)), 0)

    def rollups_only() -> None:
        parsed = parse_events(
            topic_table(spark, source, "logs.all"), fields=payload_fields(ROLLUP_COLUMNS)
        )
        log = normalize_events(good_events(parsed), columns=ROLLUP_COLUMNS).withColumns(
            {"spark_processed_at": F.current_timestamp(), "stored_at": F.current_timestamp()}
        )
        consume(catalog.EVENT_STATES.states(log))

    took["ingest_table_and_rollups"] = timed(ingest)
    took["ingest_rollups_only"] = timed(rollups_only)
    took["ingest_backfill"] = timed(
        lambda: backfill(
            topic_table(spark, source, "logs.all"), f"{root}/backfill", "all", dead_letters=False
        )
    )

    # Micro-batches.
    spans = []

    def span(batch):
        def run(df, batch_id):
            began = time.perf_counter()
            batch(df, batch_id)
            spans.append(time.perf_counter() - began)

        return run

    parsed = parse_events(
        topic_stream(spark, source, "logs.all", files_per_trigger=int(CPUS))
    )
    start(
        normalize_events(good_events(parsed)),
        span(each(f"{root}/stream")),
        f"{root}/checkpoint",
        once=True,
    ).awaitTermination()
    took["microbatch_mean_total"] = statistics.mean(spans)

    # Serving, from what the ingest run stored.
    kept = store(f"{root}/batch")
    stored = read_table(spark, f"{root}/batch/event_log")
    dlq = catalog.DLQ_1M.states(
        tb.dead_letters(tb.broker_rows(tb.events(spark, SF_DIR)))
    )
    dlq.write.parquet(f"{root}/dlq")
    dlq = spark.read.parquet(f"{root}/dlq")
    newest = stored.agg(F.max("kafka_received_at")).first()[0]
    now = F.lit(newest)

    def states(name):
        return kept.rollup(spark, name)

    def recent(name, minutes=5):
        return kept.rollup(spark, name, since=newest - timedelta(minutes=minutes))

    def p95(minutes=10, by=("bucket",)):
        return serve.stage_p95(recent("latency_service_1m", minutes), catalog.LATENCY_1M, by)

    def health():
        return serve.health(
            serve.latest_traffic(recent("traffic_1m")),
            serve.latest_bucket(p95(5)),
            serve.freshness(serve.last_minutes(stored, now, 10, at="kafka_received_at"), now),
            serve.dlq_rate(serve.last_minutes(dlq, now, 5), recent("traffic_1m")),
        )

    serving = {
        "serve_q1_eps_10s": lambda: serve.eps_10s(states("traffic_10s")),
        "serve_q2_error_rate_10s": lambda: serve.error_rate_10s(states("traffic_10s")),
        "serve_q3_e2e_p95_10s": lambda: serve.e2e_p95(
            serve.stage_p95_10s(states("latency_stage_10s"))
        ),
        "serve_q4_stage_p95_10s": lambda: serve.stage_p95_10s(states("latency_stage_10s")),
        "serve_q5_latest_traffic": lambda: serve.latest_traffic(recent("traffic_1m")),
        "serve_q6_latest_stage_p95": lambda: serve.latest_bucket(p95(5)),
        "serve_q7_freshness": lambda: serve.freshness(
            serve.last_minutes(stored, now, 10, at="kafka_received_at"), now
        ),
        "serve_q8_dlq_rate": lambda: serve.dlq_rate(
            serve.last_minutes(dlq, now, 5), recent("traffic_1m")
        ),
        "serve_q9_health": health,
        "serve_q10_stage_p95_1m": p95,
        "serve_q11_sink_p95_1m": lambda: serve.sink_p95(p95()),
        "serve_q12_ingest_p95_1m": lambda: serve.ingest_p95(p95()),
        "serve_q13_eps_1m": lambda: serve.eps_1m(recent("traffic_1m", 10)),
        "serve_q14_top_services": lambda: serve.top_services(p95(10, ("service",))),
        "serve_q15_mean_lag": lambda: serve.mean_lag_ms(recent("lag_1m")),
        "serve_q16_created_stored": lambda: serve.created_stored_ratio(states("created_stored_1m")),
        "serve_q17_dlq_counts": lambda: serve.dlq_counts(dlq),
    }
    for name, query in serving.items():
        took[name] = timed(lambda query=query: consume(query()))
    for name in REGISTERED:
        took[name] = timed(lambda name=name: consume(QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in took.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": rows,
                "ingest_rows_per_sec": round(rows / took["ingest_table_and_rollups"]),
                "rollup_rows_per_sec": round(rows / took["ingest_rollups_only"]),
                "microbatches": len(spans),
                "microbatch_seconds": [round(s, 3) for s in spans],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
