from __future__ import annotations

import sys
from datetime import datetime, timedelta

import pytest
from conftest import same_rows, values
from pyspark.sql import functions as F

from tripmill.functions import surrogate_key
from tripmill.functions.keys import TRIP_KEY
from tripmill.operators.enrich import core_submissions, core_trips, fact_trips
from tripmill.operators.quality import quality_filter, quarantine
from tripmill.operators.staging import stage_trips
from tripmill.plans.trip_build import BY_DAY, FACT_ORDER
from tripmill.sinks.landing import TARGET_FILE_BYTES, LandingPlan
from tripmill.sources import read_events_stream, read_table
from tripmill.streaming import (
    fold_deltas,
    read_counts,
    split_late,
    stream_counts,
    stream_dedup,
    stream_deltas,
    stream_insert_new,
    stream_split,
    stream_stage,
    stream_to_table,
    stream_upsert,
    trips_per_minute,
)

trips, upserts = (sys.modules[f"tripmill.{name}"] for name in ("streaming.trips", "sinks.upsert"))
START = datetime(2024, 1, 5, 8)


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("events", "table", "checkpoint")}


def at(minutes: int, **changes) -> dict:
    start = START + timedelta(minutes=minutes)
    return {"pickup_datetime": start, "dropoff_datetime": start + timedelta(minutes=9), **changes}


def send(df, paths) -> None:
    df.write.mode("append").json(paths["events"])


def run(spark, stream, paths):
    stream_to_table(stream, paths["table"], paths["checkpoint"])
    return read_table(spark, paths["table"], stream.schema)


def test_stream_split_equals_batch_split(spark, lake, paths):
    rows = lake(at(0), at(1, passenger_count=9), at(2, total_amount=-1.0))
    send(rows, paths)
    clean, broken = stream_stage(read_events_stream(spark, paths["events"]))
    assert same_rows(run(spark, clean, paths), quality_filter(stage_trips(rows)))
    other = {**paths, "table": paths["table"] + "2", "checkpoint": paths["checkpoint"] + "2"}
    assert same_rows(run(spark, broken, other), quarantine(stage_trips(rows)))


def test_restarted_stream_takes_only_new_files(spark, lake, paths):
    clean, _ = stream_stage(read_events_stream_of(spark, lake, paths, at(0)))
    run(spark, clean, paths)
    send(lake(at(1)), paths)
    assert run(spark, clean, paths).count() == 2
    assert run(spark, clean, paths).count() == 2


def read_events_stream_of(spark, lake, paths, *rows):
    send(lake(*rows), paths)
    return read_events_stream(spark, paths["events"])


def test_stream_fact_equals_full_load(spark, lake, zones, paths):
    batches = [
        [at(0, total_amount=1.0), at(5, vendorid=2)],
        [at(0, total_amount=2.0, dropoff_datetime=START + timedelta(minutes=4)), at(7)],
        [at(5, vendorid=2, dropoff_datetime=START + timedelta(minutes=50), total_amount=3.0)],
    ]

    def transform(batch):
        return BY_DAY.add_to(fact_trips(core_trips(batch, zones)))

    for rows in batches:
        send(lake(*rows), paths)
        clean, _ = stream_stage(read_events_stream(spark, paths["events"]))
        stream_upsert(
            clean, transform, paths["table"], paths["checkpoint"],
            "trip_id", BY_DAY.columns, FACT_ORDER,
        )
    everything = stage_trips(lake(*[row for rows in batches for row in rows]))
    expected = transform(everything)
    assert same_rows(read_table(spark, paths["table"], expected.schema), expected)


def test_repeated_submissions_are_dropped_across_batches(spark, lake, paths):
    stream = stage_trips(read_events_stream_of(spark, lake, paths, at(0), at(0), at(1)))
    unique = stream_dedup(stream.withColumn("trip_id", surrogate_key(*TRIP_KEY)), ["trip_id"])
    assert run(spark, unique, paths).count() == 2
    send(lake(at(1, total_amount=9.0), at(2)), paths)
    assert run(spark, unique, paths).count() == 3


def test_windows_are_emitted_once_closed(spark, lake, paths):
    rows = lake(at(0), at(0, vendorid=2), at(1), at(30))
    send(rows, paths)
    stream = read_events_stream(spark, paths["events"])
    counts = run(spark, trips_per_minute(stream, by=["cab_type"], delay="10 minutes"), paths)
    batch = trips_per_minute(rows, by=["cab_type"])
    closed = batch.where(batch.window_end <= START + timedelta(minutes=20))
    assert same_rows(counts, closed)
    assert values(counts, "trips") == [1, 2]


def one_file_a_batch(spark, lake, paths):
    """Four files, the latest trips first, so that a watermark would drop the others."""
    for start in (5000, 3000, 1000, 0):
        send(lake(at(start), at(start), at(start + 1, vendorid=2)).coalesce(1), paths)
    rows = lake(*[r for s in (0, 1000, 3000, 5000) for r in (at(s), at(s), at(s + 1, vendorid=2))])
    return rows, read_events_stream(spark, paths["events"], max_files_per_trigger=1)


def test_window_counts_do_not_depend_on_batches(spark, lake, paths):
    rows, stream = one_file_a_batch(spark, lake, paths)
    stream_counts(stream, paths["table"], paths["checkpoint"], by=["cab_type"])
    got = read_counts(spark, paths["table"], ["cab_type"])
    assert same_rows(got, trips_per_minute(rows, by=["cab_type"]))
    closed = read_counts(spark, paths["table"], ["cab_type"], START + timedelta(minutes=10))
    assert values(closed, "trips") == [1, 2]


def test_new_keys_are_inserted_however_late(spark, lake, paths):
    _, stream = one_file_a_batch(spark, lake, paths)
    keyed = BY_DAY.add_to(stage_trips(stream).withColumn("trip_id", surrogate_key(*TRIP_KEY)))
    stream_insert_new(keyed, paths["table"], paths["checkpoint"], "trip_id", BY_DAY.columns)
    stored = read_table(spark, paths["table"], keyed.schema)
    assert stored.count() == stored.select("trip_id").distinct().count() == 8


def test_split_stream_stores_every_row(spark, lake, paths):
    rows, stream = one_file_a_batch(spark, lake, paths)
    late = paths["table"] + "-late"
    stream_split(stream, paths["table"], late, paths["checkpoint"], "25 DAYS")
    both = [read_table(spark, p, rows.schema) for p in (paths["table"], late)]
    assert all(not side.isEmpty() for side in both)
    assert same_rows(rows, both[0].unionByName(both[1]))


def test_folded_deltas_equal_full_load(spark, lake, zones, paths):
    rows, stream = one_file_a_batch(spark, lake, paths)

    def transform(batch):
        return BY_DAY.add_to(fact_trips(core_trips(stage_trips(batch), zones)))

    expected = transform(rows)
    deltas = paths["table"] + "-deltas"
    stream_deltas(stream, transform, deltas, paths["checkpoint"])
    fold_deltas(spark, deltas, expected.schema, paths["table"], "trip_id", BY_DAY.columns, FACT_ORDER)
    assert same_rows(read_table(spark, paths["table"], expected.schema), expected)
    assert fold_deltas(spark, deltas, expected.schema, paths["table"], "trip_id", BY_DAY.columns, FACT_ORDER) == 0


@pytest.mark.parametrize("files, dealt", [(8, [2, 3]), (1, [5, 6])])
def test_gathered_deltas_are_folded_where_they_are_read(spark, lake, zones, paths, monkeypatch, files, dealt):
    """Only rows whose key is there twice are dealt by partition again, unless many batches were stored."""
    monkeypatch.setattr(trips, "MAX_FILES_A_PARTITION", files)
    monkeypatch.setattr(upserts, "MAX_FILES_A_PARTITION", 8)
    landed, real = [], upserts.land

    def land(df, *args, **kwargs):
        landed.append(df.count())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(upserts, "land", land)
    rounds = [
        [[at(0), at(5, vendorid=2), at(9)], [at(0, total_amount=2.0), at(7), at(5, vendorid=2, total_amount=3.0)], [at(11)]],
        [[at(0, dropoff_datetime=START + timedelta(minutes=50)), at(21)], [at(7, total_amount=8.0), at(9, total_amount=0.5), at(22), at(23)]],
    ]
    deltas, sent = paths["table"] + "-deltas", []
    for k, files_sent in enumerate(rounds):
        for rows in files_sent:
            send(lake(*rows).coalesce(1), paths)
            sent += rows
        stream, _ = stream_stage(read_events_stream(spark, paths["events"], max_files_per_trigger=1))
        stream_deltas(
            stream, lambda batch: BY_DAY.add_to(fact_trips(core_submissions(BY_DAY.gather(batch), zones))),
            deltas, paths["checkpoint"], LandingPlan(None, TARGET_FILE_BYTES, together=True),
        )
        expected = BY_DAY.add_to(fact_trips(core_trips(stage_trips(lake(*sent)), zones)))
        fold_deltas(spark, deltas, expected.schema, paths["table"], "trip_id", BY_DAY.columns, FACT_ORDER, gathered=True)
        assert same_rows(read_table(spark, paths["table"], expected.schema), expected)
        # of the second round three keys are stored already
        assert landed.pop() == dealt[k]
    assert not landed


def test_gathered_rows_lie_together(spark, lake, zones, paths):
    """A batch's rows are brought together before anything is derived from them."""
    rows = stage_trips(lake(*[at(60 * 24 * (k % 5), vendorid=k % 2 + 1, total_amount=float(k + 1)) for k in range(60)])).repartition(6)
    fact = BY_DAY.add_to(fact_trips(core_submissions(BY_DAY.gather(rows), zones)))
    tasks = fact.select("pickup_date", F.spark_partition_id().alias("task")).distinct()
    assert tasks.count() == tasks.select("pickup_date").distinct().count() == 5
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "trip_id" not in plan[plan.index("Rebalance"):]


def test_late_rows_go_aside(lake):
    rows = lake(
        at(0, ingestion_ts=START + timedelta(hours=1)),
        at(0, ingestion_ts=START + timedelta(hours=3)),
        at(0, ingestion_ts=None),
    )
    in_time, late = split_late(rows, "2 HOURS")
    assert (in_time.count(), late.count()) == (1, 2)
    assert same_rows(rows, in_time.unionByName(late))


def test_event_files_are_bounded_and_compressed(spark, monkeypatch):
    """More events give more files, not bigger ones, and still few micro-batches."""
    from conftest import SF_DIR

    from tripmill.registry import fixtures, queries

    monkeypatch.setattr(fixtures, "_kept", {})
    monkeypatch.setattr(queries, "EVENTS_PER_FILE", 400)
    files = spark.read.text(queries.trip_events(spark, SF_DIR)).inputFiles()
    events = fixtures.table(spark, SF_DIR, "lineitem").count()
    assert len(files) >= events // 400 > queries.MICRO_BATCHES
    assert all(f.endswith(".gz") for f in files)
    batches = []
    stream = queries._event_stream(spark, SF_DIR).select("vendorid").writeStream.trigger(availableNow=True)
    stream.foreachBatch(lambda batch, _: batches.append(batch.count())).start().awaitTermination()
    assert sum(batches) == events and 1 < len(batches) <= queries.MICRO_BATCHES
