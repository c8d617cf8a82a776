from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

from conftest import plan_text, same_rows
from pyspark.sql import functions as F

from tripmill.functions.keys import TRIP_KEY
from tripmill.operators.checks import freshness, in_set, not_null, relationship, run_checks, unique
from tripmill.operators.drift import checksums, differing_leaves, row_drift
from tripmill.operators.duplicates import duplicate_report, maybe_repeated, submission_statistics
from tripmill.sinks import land
from tripmill.sources import read_table
from tripmill.streaming.trips import first_of_each, fold_new

SCHEMA = "id int, at timestamp_ntz, kind string, value double, day date"


def table(spark, rows):
    full = [(i, at, kind, value, at.date() if at else None) for i, at, kind, value in rows]
    return spark.createDataFrame(full, SCHEMA)


def hours(n):
    return [(k, datetime(2024, 1, 1) + timedelta(hours=5 * k), "a" if k % 2 else None, float(k)) for k in range(n)]


def test_rows_that_differ_are_named_where_counts_and_sums_agree(spark, tmp_path):
    rows = hours(60) + [hours(60)[7]] * 2 + [(900, None, "x", 1.0)]
    changed = list(rows)
    changed[3], changed[4] = (3, rows[3][1], "a", 4.0), (4, rows[4][1], None, 3.0)  # the values swapped
    changed.remove(rows[7])
    changed.append((7, rows[7][1], "b", 7.0))
    changed[changed.index((900, None, "x", 1.0))] = (900, None, None, 1.0)
    paths = [str(tmp_path / n) for n in ("a", "b")]
    for path, content in zip(paths, (rows, changed), strict=True):
        land(table(spark, content), path, ["day"])
    source, target = (read_table(spark, p, table(spark, []).schema) for p in paths)
    got = row_drift(source, target, ["id"], "at", ["day"])
    found = Counter()
    for r in got.collect():
        found[r.side, r.id, r.kind, r.value] += r.copies
    assert found == {
        ("source", 3, "a", 3.0): 1, ("target", 3, "a", 4.0): 1, ("source", 4, None, 4.0): 1, ("target", 4, None, 3.0): 1,
        ("source", 7, "a", 7.0): 1, ("target", 7, "b", 7.0): 1, ("source", 900, "x", 1.0): 1, ("target", 900, None, 1.0): 1,
    }
    # the second reading opens the days of the differences, and no others
    plan = plan_text(got)
    pruned = [line for line in plan.split("\n") if "PartitionFilters" in line and "value:double" in line]
    assert pruned and all("2024-01-01" in p for p in pruned)
    days = set(differing_leaves(*[checksums(t, ["id"], "at", t.columns, ["day"]) for t in (source, target)]).select("leaf_day").toPandas()["leaf_day"])
    assert len(days) == 3
    assert row_drift(source, source, ["id"], "at", ["day"]).count() == 0
    assert same_rows(row_drift(source, target, ["id"], "at"), got)


def test_checksums_ignore_order_and_see_nulls(spark):
    rows = hours(30)
    a, b = table(spark, rows), table(spark, rows[::-1]).repartition(5)
    leaves = [checksums(t, ["id"], "at", t.columns) for t in (a, b)]
    assert same_rows(*leaves) and differing_leaves(*leaves).count() == 0
    swapped = spark.createDataFrame([(1, None)], "x int, y int"), spark.createDataFrame([(None, 1)], "x int, y int")
    sums = [checksums(t.withColumn("at", F.lit("2024-01-01").cast("timestamp_ntz")), ["at"], "at", ["x", "y"]) for t in swapped]
    assert differing_leaves(*sums).count() == 1


def test_a_suite_scans_each_model_once_and_shuffles_once(spark, tmp_path):
    rows = [(k, k % 7, "a" if k % 3 else None, datetime(2024, 1, 1 + k % 9)) for k in range(50)] + [(3, 99, "z", None)]
    spark.createDataFrame(rows, "id int, ref int, kind string, at timestamp_ntz").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(k,) for k in range(6)], "key bigint").write.parquet(str(tmp_path / "p"))
    frames = {"t": spark.read.parquet(str(tmp_path / "t")), "p": spark.read.parquet(str(tmp_path / "p"))}
    suite = {
        "t": [unique("id"), unique("id,kind"), relationship("ref", "p", "key"), *not_null("kind", "id"), in_set("kind", ["a"]),
              freshness("at", timedelta(days=2)), freshness("at", timedelta(days=1))],
        "p": [unique("key"), *not_null("key")],
    }
    got = run_checks(frames, suite, now=datetime(2024, 1, 11, 1))
    plan = plan_text(run_checks(frames, suite, now=datetime(2024, 1, 11, 1)))
    # ids 3, and (3, ...) only where kind is known; 6 and 99 have no parent
    assert [r.failures for r in got.collect()] == [1, 0, 8, 17, 0, 1, 1, 1, 0, 0]
    assert plan.count("FileScan") == 3  # t, p, and p once more as the parent
    assert plan.count("hashpartitioning(check#") == 2 and plan.count("Exchange") == 3
    empty = run_checks({k: v.limit(0) for k, v in frames.items()}, suite, now=datetime(2024, 1, 11))
    assert [r.failures for r in empty.collect()] == [0, 0, 0, 0, 0, 0, 1, 1, 0, 0]


def test_single_submissions_are_dropped_before_anything_wide_is_shuffled(spark, staged):
    singles = [{"pulocationid": 1000 + k} for k in range(400)]
    repeated = [{"pulocationid": k, "total_amount": float(v)} for k in range(5) for v in range(3)]
    trips = staged(*singles, *repeated, {"vendorid": None}, {"vendorid": None})
    statistics = submission_statistics(trips)
    kept = maybe_repeated(trips, statistics, TRIP_KEY)
    assert 15 <= kept.count() <= 20
    report = duplicate_report(trips)
    assert report.count() == 15 and set(report.toPandas()["submission_count"]) == {3}
    # the trips meet the broadcast bitmaps below the shuffle by key
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(duplicate_report(trips))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin") and plan.count("BroadcastExchange") == 1
    assert "bitmap_construct_agg" in plan


def test_folds_append_each_key_once(spark, tmp_path):
    deltas, path = str(tmp_path / "deltas"), str(tmp_path / "table")
    schema = "key string, kind string, n int"
    batches = [[("a", "x", 1), ("a", "x", 2), ("b", "y", 1)], [("b", "y", 2), ("c", "x", 1)], [("a", "x", 9), ("d", None, 1)], [("d", None, 5)]]

    def write(numbers):
        for k in numbers:
            batch = first_of_each("key")(spark.createDataFrame(batches[k], schema))
            batch.withColumn("micro_batch", F.lit(k).cast("bigint")).write.mode("append").partitionBy("micro_batch").parquet(deltas)

    kind = spark.createDataFrame([], schema).schema
    write([0, 1])
    assert fold_new(spark, deltas, kind, path, "key", ["kind"]) == 3
    write([0, 1, 2, 3])  # the first two again, as after an interrupted fold
    assert fold_new(spark, deltas, kind, path, "key", ["kind"]) == 1
    assert fold_new(spark, deltas, kind, path, "key", ["kind"]) == 0
    got = {r.key: (r.kind, r.n) for r in read_table(spark, path, kind).collect()}
    assert got == {"a": ("x", 2), "b": ("y", 1), "c": ("x", 1), "d": (None, 1)}
