from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import same_rows, values
from pyspark.sql import functions as F

from tripmill.operators.ledger import read_ledger, store_reset
from tripmill.plans import backfill as backfill_plan
from tripmill.plans.backfill import backfill, split_own_day
from tripmill.plans.trip_build import BY_DAY
from tripmill.registry import queries
from tripmill.schemas import LAKE_TRIPS, SLICE_REQUESTS
from tripmill.sinks import land, landing, plan_write, promote, register_view
from tripmill.sources import (
    landed_days,
    read_aligned,
    read_slice,
    read_slices,
    read_table,
    slice_path,
    slice_volume,
)

LINEAGE = ["ingestion_ts", "batch_id", "source_file", "migration_batch_id", "engine_type"]


def january(day: int, hour: int = 8) -> datetime:
    return datetime(2024, 1, day, hour)


def trips_on(lake, *days: int, **changes):
    return lake(
        *[
            {
                "pickup_datetime": january(d),
                "dropoff_datetime": january(d, 9),
                "total_amount": float(d),
                **changes,
            }
            for d in days
        ]
    )


def write_source(df, root: str) -> None:
    """Source slices: no cab type or lineage in the files, days as folders."""
    pickup = F.col("pickup_datetime")
    df.drop(*LINEAGE, "trip_type").withColumns(
        {"year": F.year(pickup), "month": F.month(pickup), "day": F.dayofmonth(pickup)}
    ).write.mode("append").partitionBy("cab_type", "year", "month", "day").parquet(root)


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("source", "table", "ledger", "rejects")}



@pytest.fixture
def lake_table(spark):
    schema = BY_DAY.add_to(spark.createDataFrame([], LAKE_TRIPS)).schema
    return lambda path: read_table(spark, path, schema)


def test_slices_select_folders_by_padded_or_plain_numbers(spark, lake, paths):
    write_source(trips_on(lake, 1, 2, 12), paths["source"])
    write_source(trips_on(lake, 2, cab_type="green"), paths["source"])
    root = paths["source"]
    assert read_slice(spark, root, "yellow", "2024").count() == 3
    assert read_slice(spark, root, "yellow", "2024", "01").count() == 3
    assert read_slice(spark, root, "yellow", 2024, 1, "02").count() == 1
    assert read_slices(spark, root, ["yellow", "green"], 2024, 1, 2).count() == 2
    with pytest.raises(ValueError, match="month"):
        read_slice(spark, root, "yellow", 2024, None, 2)


def test_slices_prune_folders_and_fill_missing_columns(spark, lake, paths):
    write_source(trips_on(lake, 1, 2), paths["source"])
    df = read_slice(spark, paths["source"], "yellow", 2024, 1, 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cab_type" in plan
    assert df.first()["trip_type"] is None
    assert all("/day=2/" in f or "/day=02/" in f for f in df.inputFiles())


def test_slice_path():
    assert slice_path("s3://b/t/", "green", "2024", "06") == "s3://b/t/cab_type=green/year=2024/month=6/"
    assert slice_path("r", "green", 2024).endswith("year=2024/")


def test_volume_counts_bytes_and_files(spark, lake, paths):
    write_source(trips_on(lake, 1, 2), paths["source"])
    rows = slice_volume(spark, paths["source"], ("cab_type", "year", "month", "day")).collect()
    assert sorted(r["day"] for r in rows) == [1, 2]
    assert all(r["bytes"] > 0 and r["files"] >= 1 for r in rows)


def test_landing_again_replaces_only_the_partitions_it_brings(spark, lake, paths, lake_table):
    table = paths["table"]
    assert land(BY_DAY.add_to(trips_on(lake, 1, 2, 2)), table, BY_DAY.columns) == 3
    assert land(BY_DAY.add_to(trips_on(lake, 2, total_amount=99.0)), table, BY_DAY.columns) == 1
    assert values(lake_table(table), "total_amount") == [1.0, 99.0]


def test_one_cab_type_does_not_remove_another(lake, paths, lake_table):
    table = paths["table"]
    land(BY_DAY.add_to(trips_on(lake, 1)), table, BY_DAY.columns)
    land(BY_DAY.add_to(trips_on(lake, 1, cab_type="green")), table, BY_DAY.columns)
    assert values(lake_table(table), "cab_type") == ["green", "yellow"]


def test_write_plan_follows_volume():
    gib = 1 << 30
    assert plan_write(10 * gib, target_file_bytes=gib // 4).tasks == 40
    assert plan_write(10).tasks == 1
    assert plan_write().tasks is None
    assert plan_write(10 * gib, source_files=20).clustered
    assert not plan_write(10 * gib, source_files=2000).clustered


def test_clustered_source_lands_without_shuffle_and_small_files_with(lake):
    from tripmill.sinks.landing import spread

    df = BY_DAY.add_to(trips_on(lake, 1))
    big = spread(df, BY_DAY.columns, plan_write(10 << 30, source_files=20))
    small = spread(df, BY_DAY.columns, plan_write(10 << 20, source_files=200))
    assert "Exchange" not in big._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in small._jdf.queryExecution().executedPlan().toString()


def test_derived_columns_are_not_shuffled_before_landing(spark, tmp_path):
    from tripmill.registry import fixtures
    from tripmill.sinks.landing import spread

    tables = {
        "lineitem": "(1,1,1,1,5.0,9000.0,0.1,0.1,'A','O'),(1,2,2,2,6.0,9100.0,0.1,0.1,'N','F'),(2,3,9,1,6.0,1.0,0.1,0.1,'R','F')"
        " AS t(l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus)",
        "orders": "(1,7,timestamp_ntz'1997-03-01 00:00:00'),(2,7,NULL) AS t(o_orderkey,o_custkey,o_orderdate)",
        "customer": "(7,3) AS t(c_custkey,c_nationkey)",
        "supplier": "(1,4),(2,5),(9,NULL) AS t(s_suppkey,s_nationkey)",
    }
    for name, rows in tables.items():
        spark.sql(f"SELECT * FROM VALUES {rows}").write.parquet(str(tmp_path / f"{name}.parquet"))
    trips = fixtures.lake_trips(spark, str(tmp_path), together=True)
    assert same_rows(trips, fixtures.lake_trips(spark, str(tmp_path)))
    plan = queries.TOGETHER
    assert spread(trips, ["cab_type"], plan) is trips
    text = trips._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("RebalancePartitions")
    assert "tip_amount" in above and "tip_amount" not in below
    assert land(trips, str(tmp_path / "out"), ["cab_type"], plan) == 3


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """One cab type holds most rows: AQE splits it, the others stay whole."""
    rows = spark.range(0, 400_000, numPartitions=16).selectExpr(
        "IF(id % 10 < 8, 'yellow', 'green') AS cab_type", "id", "md5(CAST(id AS STRING)) AS pad"
    )
    path = str(tmp_path / "hot")
    assert land(rows, path, ["cab_type"], plan_write(target_file_bytes=1 << 20)) == 400_000
    files = [f for f in spark.read.parquet(path).inputFiles()]
    assert sum("cab_type=yellow" in f for f in files) > 3
    assert spark.read.parquet(path).count() == 400_000


def test_promotion_replaces_a_window_including_vanished_days(spark, lake, paths, lake_table):
    stage, production = paths["source"], paths["table"]
    land(BY_DAY.add_to(trips_on(lake, 1, 2, 3)), production, BY_DAY.columns)
    land(BY_DAY.add_to(trips_on(lake, 2, 9, total_amount=50.0)), stage, BY_DAY.columns)
    window = F.col("pickup_date").between(date(2024, 1, 2), date(2024, 1, 5))
    schema = lake_table(production).schema
    assert promote(spark, stage, production, schema, BY_DAY.columns, window) == 1
    assert values(lake_table(production), "total_amount") == [1.0, 50.0]
    promote(spark, stage, production, schema, BY_DAY.columns, window)
    assert values(lake_table(production), "total_amount") == [1.0, 50.0]


def test_views_follow_their_source(spark, lake, paths, lake_table):
    land(BY_DAY.add_to(trips_on(lake, 1)), paths["table"], BY_DAY.columns)
    register_view(lake_table(paths["table"]), "tripmill_test_lake")
    assert spark.sql("SELECT count(*) FROM tripmill_test_lake").first()[0] == 1


def test_split_by_own_day_keeps_every_row(lake):
    rows = lake({}, {"pickup_datetime": january(9)}, {"pickup_datetime": None}).withColumn(
        "folder_day", F.lit("2024-01-05").cast("date")
    )
    inside, outside = split_own_day(rows)
    assert (inside.count(), outside.count()) == (1, 2)
    assert same_rows(rows.drop("folder_day"), inside.unionByName(outside))


def test_a_day_is_the_same_whatever_else_is_pending(spark, lake, paths, lake_table):
    """A trip of day 2 lies in the folder of day 1; landing day 2 alone must not change day 2."""
    write_source(trips_on(lake, 1, 2), paths["source"])
    stray = trips_on(lake, 2, total_amount=77.0)
    day_one = f"{paths['source']}/cab_type=yellow/year=2024/month=1/day=1"
    stray.drop(*LINEAGE, "trip_type", "cab_type").write.mode("append").parquet(day_one)
    first = run(spark, paths, month="01")
    assert (first.rows, first.rejected) == (2, 1)
    requests = spark.createDataFrame([("yellow", "2024", "01", "02")], SLICE_REQUESTS)
    store_reset(spark, paths["ledger"], requests, at=datetime(2024, 2, 3))
    again = run(spark, paths, month="01", now=datetime(2024, 2, 4))
    assert (again.rows, again.rejected) == (1, 0)
    assert values(lake_table(paths["table"]), "total_amount") == [1.0, 2.0]


def test_slices_of_different_types_are_aligned(spark, lake, paths):
    root = paths["source"]
    plain = trips_on(lake, 1).drop(*LINEAGE, "trip_type")
    for day, kind in ((1, "double"), (2, "int")):
        rows = plain.drop("cab_type").withColumn("passenger_count", F.col("passenger_count").cast(kind))
        rows.write.parquet(f"{root}/cab_type=yellow/year=2024/month=01/day={day}")
    got = read_aligned(spark, root, ["yellow"], 2024, 1)
    assert got.schema["passenger_count"].dataType.simpleString() == "bigint"
    assert values(got, "folder_day") == [date(2024, 1, 1), date(2024, 1, 2)]
    plain.drop("cab_type", "total_amount").write.parquet(f"{root}/cab_type=yellow/year=2024/month=01/day=3")
    with pytest.raises(ValueError, match="total_amount"):
        read_aligned(spark, root, ["yellow"], 2024, 1)
    assert read_aligned(spark, root, ["green"], 2024, 1).count() == 0


def test_promotion_drops_partitions_with_odd_names(spark, tmp_path):
    stage, production = str(tmp_path / "s"), str(tmp_path / "p")
    schema = "id int, kind string"
    land(spark.createDataFrame([(1, "a:b"), (2, None), (3, "c")], schema), production, ["kind"])
    land(spark.createDataFrame([(4, "c")], schema), stage, ["kind"])
    assert promote(spark, stage, production, spark.createDataFrame([], schema).schema, ["kind"], F.lit(True)) == 1
    assert [tuple(r) for r in spark.read.schema(schema).parquet(production).collect()] == [(4, "c")]


def run(spark, paths, **changes):
    options = {"cab_type": "yellow", "year": "2024", "now": datetime(2024, 2, 1), **changes}
    return backfill(spark, **paths, **options)


def test_day_then_month_lands_every_day_once(spark, lake, paths, lake_table):
    write_source(trips_on(lake, 1, 2, 3), paths["source"])
    first = run(spark, paths, month="01", day="02")
    assert (first.outcome, first.days, first.rows) == ("landed", 1, 1)
    month = run(spark, paths, month="01", now=datetime(2024, 2, 2))
    assert (month.days, month.rows) == (2, 2)
    table = lake_table(paths["table"])
    assert values(table, "total_amount") == [1.0, 2.0, 3.0]
    assert values(table.where("total_amount = 2"), "ingestion_ts") == [datetime(2024, 2, 1)]
    files = values(table, "source_file")
    assert [f.rsplit("year=2024/", 1)[1] for f in files] == ["month=1/", "month=1/", "month=1/day=2/"]


def test_days_without_source_stay_pending(spark, lake, paths):
    write_source(trips_on(lake, 1), paths["source"])
    assert run(spark, paths, month="01").days == 1
    assert run(spark, paths, month="01").outcome == "empty"
    write_source(trips_on(lake, 2), paths["source"])
    assert run(spark, paths, month="01").days == 1
    assert run(spark, paths, month="01", day="01").outcome == "nothing_pending"


def test_stray_rows_are_rejected_not_lost(spark, lake, paths, lake_table):
    write_source(trips_on(lake, 1, 2), paths["source"])
    stray = trips_on(lake, 20, total_amount=77.0)
    day_one = f"{paths['source']}/cab_type=yellow/year=2024/month=1/day=1"
    stray.drop(*LINEAGE, "trip_type", "cab_type").write.mode("append").parquet(day_one)
    report = run(spark, paths, month="01", batch_id="b7")
    assert (report.rows, report.rejected) == (2, 1)
    rejects = spark.read.parquet(paths["rejects"])
    assert [(r["total_amount"], r["batch_id"]) for r in rejects.collect()] == [(77.0, "b7")]
    assert values(lake_table(paths["table"]), "total_amount") == [1.0, 2.0]


def reset(spark, paths, day: str, at=datetime(2024, 2, 3)):
    requests = spark.createDataFrame([("yellow", "2024", "01", day)], SLICE_REQUESTS)
    store_reset(spark, paths["ledger"], requests, at=at)


def test_a_day_that_became_empty_keeps_no_old_row(spark, lake, paths, lake_table):
    write_source(trips_on(lake, 1, 2, 3), paths["source"])
    run(spark, paths, month="01")
    reset(spark, paths, "02")
    folder = f"{paths['source']}/cab_type=yellow/year=2024/month=1/day=2"
    trips_on(lake, 3, total_amount=77.0).drop(*LINEAGE, "trip_type", "cab_type").write.mode("overwrite").parquet(folder)
    report = run(spark, paths, month="01", now=datetime(2024, 2, 4))
    assert (report.days, report.rows, report.rejected) == (1, 0, 1)
    assert values(lake_table(paths["table"]), "total_amount") == [1.0, 3.0]


def test_an_interrupted_replacement_loses_nothing(spark, lake, paths, lake_table, monkeypatch):
    """Rows of an emptied day go only after the new data is committed, and the day stays pending."""
    write_source(trips_on(lake, 1, 2), paths["source"])
    run(spark, paths, month="01")
    reset(spark, paths, "01")
    reset(spark, paths, "02")
    folder = f"{paths['source']}/cab_type=yellow/year=2024/month=1/day=2"
    trips_on(lake, 9).drop(*LINEAGE, "trip_type", "cab_type").write.mode("overwrite").parquet(folder)

    def broken(*_args, **_options):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(landing, "_drop_partitions", broken)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, paths, month="01", now=datetime(2024, 2, 4))
    assert values(lake_table(paths["table"]), "total_amount") == [1.0, 2.0]
    assert run(spark, paths, month="01", now=datetime(2024, 2, 5)).days == 2
    assert values(lake_table(paths["table"]), "total_amount") == [1.0]


def test_rejects_of_a_day_are_replaced_with_it(spark, lake, paths):
    write_source(trips_on(lake, 1, 2), paths["source"])
    day_one = f"{paths['source']}/cab_type=yellow/year=2024/month=1/day=1"
    stray = trips_on(lake, 20, total_amount=77.0).drop(*LINEAGE, "trip_type", "cab_type")
    stray.write.mode("append").parquet(day_one)
    assert run(spark, paths, month="01", batch_id="first").rejected == 1
    reset(spark, paths, "01")
    assert run(spark, paths, month="01", batch_id="second", now=datetime(2024, 2, 4)).rejected == 1
    rejects = spark.read.parquet(paths["rejects"])
    assert [(r["total_amount"], r["batch_id"]) for r in rejects.collect()] == [(77.0, "second")]
    # once the folder is in order, no reject of it is left
    reset(spark, paths, "01", at=datetime(2024, 2, 5))
    trips_on(lake, 1).drop(*LINEAGE, "trip_type", "cab_type").write.mode("overwrite").parquet(day_one)
    report = run(spark, paths, month="01", now=datetime(2024, 2, 6))
    assert (report.days, report.rejected) == (1, 0)
    assert read_table(spark, paths["rejects"], rejects.schema).count() == 0


def test_a_fault_in_a_landed_folder_does_not_block_another_day(spark, lake, paths, lake_table):
    write_source(trips_on(lake, 1, 2), paths["source"])
    run(spark, paths, month="01")
    day_one = f"{paths['source']}/cab_type=yellow/year=2024/month=1/day=1"
    trips_on(lake, 1).drop(*LINEAGE, "trip_type", "cab_type", "fare_amount").write.mode("overwrite").parquet(day_one)
    write_source(trips_on(lake, 3), paths["source"])
    assert run(spark, paths, month="01", now=datetime(2024, 2, 4)).rows == 1
    assert values(lake_table(paths["table"]), "total_amount") == [1.0, 2.0, 3.0]


def test_two_types_in_one_folder(spark, lake, paths):
    folder = f"{paths['source']}/cab_type=yellow/year=2024/month=01/day=1"
    plain = trips_on(lake, 1).drop(*LINEAGE, "trip_type", "cab_type")
    for kind in ("double", "int", "string"):
        plain.withColumn("passenger_count", F.col("passenger_count").cast(kind)).write.mode("append").parquet(folder)
    got = read_aligned(spark, paths["source"], ["yellow"], 2024, 1)
    assert values(got, "passenger_count") == [2, 2, 2]
    assert set(values(got, "folder_day")) == {date(2024, 1, 1)}


def test_a_failed_landing_is_recorded_and_can_be_repeated(spark, lake, paths, monkeypatch):
    write_source(trips_on(lake, 1), paths["source"])

    def broken(*_args, **_options):
        raise RuntimeError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(backfill_plan, "land", broken)
        with pytest.raises(RuntimeError, match="disk full"):
            run(spark, paths, month="01", day="01")
    assert values(read_ledger(spark, paths["ledger"]), "status") == ["FAILED"]
    assert run(spark, paths, month="01", day="01", now=datetime(2024, 2, 2)).rows == 1
    assert values(read_ledger(spark, paths["ledger"]), "status") == ["FAILED", "LANDED"]


def test_reset_days_land_again(spark, lake, paths):
    write_source(trips_on(lake, 1), paths["source"])
    run(spark, paths, month="01")
    requests = spark.createDataFrame([("yellow", "2024", "01", "01")], SLICE_REQUESTS)
    store_reset(spark, paths["ledger"], requests, at=datetime(2024, 2, 3))
    assert run(spark, paths, month="01", now=datetime(2024, 2, 4)).days == 1


def test_unknown_cab_types_are_refused(spark, paths):
    with pytest.raises(ValueError, match="rickshaw"):
        run(spark, paths, cab_type="rickshaw")


def test_landed_days_come_from_the_folders(spark, lake, paths):
    land(BY_DAY.add_to(trips_on(lake, 1, 3)), paths["table"], BY_DAY.columns)
    days = landed_days(spark, paths["table"])
    assert values(days, "day") == [date(2024, 1, 1), date(2024, 1, 1) + timedelta(days=2)]


def test_copies_of_the_lake_are_landed_where_they_are_read(spark, tmp_path, monkeypatch):
    """The lake has the partitions of its copies, so only its own landing may shuffle."""
    day = "TIMESTAMP_NTZ '1997-03-05 00:00:00' + INTERVAL '1' DAY * (id * 40)"
    tables = {
        "lineitem": "id AS l_orderkey, id + 5 AS l_partkey, id % 2 AS l_suppkey, CAST(id % 5 + 1 AS INT) AS l_linenumber, 5D AS l_quantity,"
        " 3000D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax, CASE id % 2 WHEN 0 THEN 'A' ELSE 'N' END AS l_returnflag, 'O' AS l_linestatus",
        "orders": f"id AS o_orderkey, id AS o_custkey, {day} AS o_orderdate",
        "customer": "id AS c_custkey, 1 AS c_nationkey",
        "supplier": "id AS s_suppkey, 2 AS s_nationkey",
    }
    for name, columns in tables.items():
        spark.range(12).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    shuffled = []

    def watched(df, path, partition_by, plan=None, **more):
        if not (plan and plan.clustered):
            shuffled.append(path.rsplit("/", 1)[1].split("-")[0])
        return land(df, path, partition_by, plan, **more)

    monkeypatch.setattr(queries, "land", watched)
    monkeypatch.setattr(landing, "land", watched)
    assert queries.REGISTRY["promote_roundtrip"](spark, str(tmp_path)).count() == 12
    queries.REGISTRY["drift_rows"](spark, str(tmp_path)).collect()
    assert shuffled == ["lake"]
