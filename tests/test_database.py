"""JDBC sink, scan and guard against an in-memory database."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from logpulse.config import SinkSettings
from logpulse.sources.database import identifier, scan
from logpulse.streaming.batch import Batch
from logpulse.streaming.delivery import Delivery, Outcome
from logpulse.streaming.guard import GuardMissing, JdbcCommitLog
from logpulse.streaming import targets
from logpulse.streaming.targets import JdbcTable, StagedJdbcTable


@pytest.fixture
def sink(spark):
    return SinkSettings(
        url=f"jdbc:derby:memory:{uuid.uuid4().hex};create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        batchsize=500,
        write_partitions=2,
        guard_table="stream_batch_guard",
        retry_max=1,
        fail_on_error=True,
    )


@pytest.fixture
def guard(spark, sink):
    """The guard table, with columns a query can compare (text is CLOB by default)."""
    empty = spark.createDataFrame(
        [], "stream_name STRING, target_table STRING, query_id STRING, batch_id BIGINT, "
        "committed_at TIMESTAMP",
    )
    types = "stream_name VARCHAR(64), target_table VARCHAR(64), query_id VARCHAR(64)"
    empty.write.format("jdbc").options(**sink.jdbc_options("stream_batch_guard")).option(
        "createTableColumnTypes", types
    ).save()
    return JdbcCommitLog(sink, "stream_batch_guard")


def count(spark, sink, table):
    return scan(spark, sink, f"SELECT count(*) AS cnt FROM {identifier(table)}").first()[0]


def test_append_and_pushed_down_count(spark, sink):
    rows = spark.range(100).select(F.col("id"), F.current_timestamp().alias("at"))
    deliver = Delivery(JdbcTable(sink, "events"), sink)
    assert deliver(rows, Batch("s", "events", 0)) is Outcome.WRITTEN
    assert deliver(rows, Batch("s", "events", 1)) is Outcome.WRITTEN
    assert count(spark, sink, "events") == 200


def test_guard_makes_replays_harmless(spark, sink, guard):
    rows = spark.range(10).toDF("id")
    deliver = Delivery(JdbcTable(sink, "events"), sink, guard=guard)
    batch = Batch("it's", "events", 3, "q")
    assert deliver(rows, batch) is Outcome.WRITTEN
    assert deliver(rows, batch) is Outcome.SKIPPED
    assert deliver(rows, Batch("it's", "events", 3, "other")) is Outcome.WRITTEN
    assert count(spark, sink, "events") == 20


def test_guard_table_missing(spark, sink):
    log = JdbcCommitLog(sink, "stream_batch_guard")
    with pytest.raises(GuardMissing):
        log.seen(spark, Batch("s", "t", 0))
    deliver = Delivery(JdbcTable(sink, "events"), sink, guard=log)
    assert deliver(spark.range(3).toDF("id"), Batch("s", "events", 0)) is Outcome.WRITTEN
    assert deliver.guard is None


def test_other_guard_errors_raise(spark, sink):
    broken = JdbcCommitLog(SinkSettings(url="jdbc:nothing:x"), "stream_batch_guard")
    with pytest.raises(Exception) as error:
        broken.seen(spark, Batch("s", "t", 0))
    assert not isinstance(error.value, GuardMissing)


def test_names_and_literals():
    assert identifier("db.table_1") == "db.table_1"
    for bad in ("t; drop table x", "", "1t", "a b"):
        with pytest.raises(ValueError):
            identifier(bad)


def dies_at(rows, n):
    return rows.selectExpr(f"if(id = {n}, CAST(raise_error('executor lost') AS BIGINT), id) AS id", "name")


def test_staged_batches_are_whole_and_counted_once(spark, sink):
    table = StagedJdbcTable(sink, "events")
    rows = spark.range(0, 1000, 1, 8).selectExpr("id", "concat('n', id) AS name")
    batch = Batch("s", "events", 0, "it's")
    with pytest.raises(Exception, match="executor lost"):
        table.write(dies_at(rows, 999), batch)
    assert count(spark, sink, "events") == 0 and not table.is_moved(spark, batch)
    for _ in range(2):  # the second delivery is recognised
        table.write(rows, batch)
        assert count(spark, sink, "events") == 1000
        assert count(spark, sink, "events_staging") == 0
    table.write(rows, Batch("s", "events", 1, "it's"))
    table.write(rows.limit(0), Batch("s", "events", 2, "it's"))
    assert count(spark, sink, "events") == 2000
    assert sorted(r[0] for r in scan(spark, sink, 'SELECT DISTINCT "id" FROM events').collect()) == list(range(1000))


def test_a_move_that_fails_leaves_all_as_it_was(spark, sink, monkeypatch):
    table, rows = StagedJdbcTable(sink, "events"), spark.range(10).selectExpr("id", "'x' AS name")
    table.write(rows, Batch("s", "events", 0))
    whole = targets.execute

    def broken(spark, settings, *statements):
        whole(spark, settings, *statements[:2], "DELETE FROM no_such_table")

    with monkeypatch.context() as patch:
        patch.setattr(targets, "execute", broken)
        with pytest.raises(Exception):
            table.write(rows, Batch("s", "events", 1))
    assert count(spark, sink, "events") == 10 and count(spark, sink, "events_staging") == 10
    assert Delivery(table, sink)(rows, Batch("s", "events", 1)) is Outcome.WRITTEN
    assert count(spark, sink, "events") == 20 and count(spark, sink, "events_staging") == 0


def test_a_task_that_ran_twice_fails_the_attempt(spark, sink):
    table, rows = StagedJdbcTable(sink, "events"), spark.range(0, 10, 1, 1).selectExpr("id", "'x' AS name")
    table.write(rows, Batch("s", "events", 0))
    same = rows.selectExpr("*", "'b' AS staged_batch", "'a' AS staged_attempt", "id AS staged_row")
    table._append(same, table.staging)
    with pytest.raises(Exception, match="(?i)duplicate"):
        table._append(same, table.staging)
