"""Folders, published tables, the long view."""

import pytest
from pyspark.sql import functions as F

from dayledger.operators.combine import base_plus_delta, union_counts, unified_long
from dayledger.operators.report import load_report
from dayledger.schemas import DELAYS, RAW_WEATHER, UNIFIED, WEATHER, schema_as_text
from dayledger.sinks.folders import PARQUET_OPTIONS, write_folder
from dayledger.sinks.publish import NoRowsError, publish_table
from dayledger.sinks.views import create_temp_view, create_view
from dayledger.sources.tables import read_folder, read_table


@pytest.fixture
def delays(spark):
    return spark.createDataFrame(
        [("2025-06-01", 'A, "B"', 10.0, 2, 5.0), ("2025-06-02", None, 3.0, 1, 3.0)],
        "date string, station_name string, total_delay_minutes double, train_count int, "
        "avg_delay_minutes double",
    ).withColumn("date", F.col("date").cast("date"))


@pytest.fixture
def weather(spark):
    return spark.createDataFrame(
        [("2025-06-01", "A", 47.4979129, 19.0, 36.0, 61.0, 0.5, 1, 1, 0)],
        "date string, station_name string, latitude double, longitude double, "
        "temperature_mean_c double, wind_gust_max_kmh double, precipitation_sum_mm double, "
        "extreme_temperature int, extreme_wind int, extreme_precipitation int",
    )


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _files(path):
    return [p for p in path.iterdir() if p.name.startswith("part-")]


@pytest.mark.parametrize("files, expected", [(None, 2), (1, 1), ("auto", 1)])
def test_csv_round_trip(spark, tmp_path, delays, files, expected):
    path = tmp_path / "out"
    rows = write_folder(delays.repartition(2, "date"), str(path), "csv", files)
    assert rows == 2
    assert len(_files(path)) <= expected
    assert bag(read_folder(spark, str(path), "csv", DELAYS)) == bag(delays)
    header = _files(path)[0].read_text().splitlines()[0]
    assert header == ",".join(DELAYS.names)


def test_clustered_files_cover_few_days(spark, tmp_path):
    """Days of a third of all rows and of few rows; large days are cut into several files."""
    import pyarrow.parquet as pq

    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 6)
    rows = spark.range(0, 200000, 1, 8).select(
        F.date_add(F.lit("2025-06-01").cast("date"), day.cast("int")).alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "1m")
    try:
        n = write_folder(rows, str(tmp_path / "out"), "parquet", cluster_by=("date",))
    finally:
        spark.conf.set(advisory, before)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert n == 200000 and back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    tables = [pq.read_table(f, columns=["date"]).column(0) for f in _files(tmp_path / "out")]
    assert len(tables) > 6
    assert max(len(column) for column in tables) < 200000 / 6
    assert max(len(set(column.to_pylist())) for column in tables) <= 2


def test_csv_empty_text_reads_back_as_null(spark, tmp_path, delays):
    empty = delays.withColumn("station_name", F.lit(""))
    write_folder(empty, str(tmp_path / "out"), "csv")
    back = read_folder(spark, str(tmp_path / "out"), "csv", DELAYS)
    assert {r["station_name"] for r in back.collect()} == {None}


def test_float_through_text(spark, tmp_path, weather):
    raw = weather.select(*[F.col(f.name).cast(f.dataType) for f in RAW_WEATHER.fields])
    write_folder(raw, str(tmp_path / "out"), "csv")
    back = read_folder(spark, str(tmp_path / "out"), "csv", schema_as_text(RAW_WEATHER))
    merged = base_plus_delta(back, back, WEATHER)
    assert merged.schema == WEATHER
    assert [r["latitude"] for r in merged.collect()] == [47.497913, 47.497913]


def test_parquet_options_reach_the_file(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(20000).select(F.lit("same").alias("s"))
    encodings = {}
    for name, options in (("off", PARQUET_OPTIONS), ("default", {})):
        write_folder(df, str(tmp_path / name), "parquet", 1, **options)
        column = pq.ParquetFile(_files(tmp_path / name)[0]).metadata.row_group(0).column(0)
        encodings[name] = set(column.encodings)
    assert not any("DICTIONARY" in e for e in encodings["off"])
    assert any("DICTIONARY" in e for e in encodings["default"])


def test_base_plus_delta_keeps_duplicates(delays):
    merged = base_plus_delta(delays, delays, DELAYS)
    assert bag(merged) == sorted(bag(delays) * 2, key=str)
    assert tuple(union_counts(delays, delays).first()) == (2, 2, 4)


def test_base_plus_delta_checks_columns(spark, delays):
    swapped = delays.select(*reversed(delays.columns))
    with pytest.raises(ValueError, match="order"):
        base_plus_delta(delays, swapped, DELAYS)
    with pytest.raises(ValueError, match="columns"):
        base_plus_delta(delays, delays.drop("train_count"), DELAYS)
    other = delays.withColumnRenamed("total_delay_minutes", "minutes")
    assert bag(base_plus_delta(delays, other, DELAYS, by_position=True)) == bag(
        base_plus_delta(delays, delays, DELAYS)
    )


def test_text_and_int_inputs_meet(spark, delays):
    text = delays.select(*[F.col(c).cast("string") for c in delays.columns])
    bad = text.withColumn("train_count", F.lit("abc"))
    counts = [r["train_count"] for r in base_plus_delta(delays, bad, DELAYS).collect()]
    assert sorted(counts, key=str) == [1, 2, None, None]


def test_publish_replaces_the_table_it_reads(spark, tmp_path, delays):
    root = str(tmp_path / "published")
    assert publish_table(delays, "p_delays", root, "csv", read_schema=DELAYS) == 2
    assert bag(read_table(spark, "p_delays", "default")) == bag(delays)
    doubled = spark.table("p_delays").union(spark.table("p_delays"))
    assert publish_table(doubled, "p_delays", root, "csv", read_schema=DELAYS) == 4
    assert bag(spark.table("p_delays")) == sorted(bag(delays) * 2, key=str)


def test_published_columns_may_change(spark, tmp_path, delays):
    root = str(tmp_path / "published")
    publish_table(delays, "p_columns", root, "parquet")
    publish_table(delays.drop("train_count"), "p_columns", root, "parquet")
    assert bag(spark.table("p_columns")) == bag(delays.drop("train_count"))


def test_a_view_is_not_replaced_by_a_table(spark, tmp_path, delays):
    root = tmp_path / "published"
    publish_table(delays, "p_under", str(root / "a"), "parquet")
    spark.sql("CREATE OR REPLACE VIEW p_view AS SELECT * FROM p_under")
    with pytest.raises(ValueError, match="p_view is a view"):
        publish_table(delays, "p_view", str(root / "b"), "parquet")
    assert not (root / "b").exists()


def test_failed_or_empty_run_leaves_the_table(spark, tmp_path, delays):
    root = str(tmp_path / "published")
    publish_table(delays, "p_kept", root, "parquet")
    with pytest.raises(NoRowsError):
        publish_table(delays.limit(0), "p_kept", root, "parquet", require_rows=True)
    failing = delays.withColumn("station_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        publish_table(failing, "p_kept", root, "parquet")
    assert bag(spark.table("p_kept")) == bag(delays)


def test_partitioned_table_finds_its_partitions(spark, tmp_path, delays):
    root = str(tmp_path / "it's published")
    for rows in (delays, delays.limit(1)):
        n = publish_table(rows, "p_days", root, "parquet", "auto", partition_by=("date",))
        assert n == rows.count()
        assert bag(spark.table("p_days").select(*DELAYS.names)) == bag(rows)
    plan = spark.table("p_days").where("date = date'2025-06-01'")._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(date" in plan.executedPlan().toString()


def _expected_long(delays, weather):
    arms = [("delay", r["date"], r["station_name"], None, None, None,
             r["total_delay_minutes"], r["train_count"], r["avg_delay_minutes"])
            for r in delays.collect()]
    arms += [("weather", r["date"], r["station_name"], r["extreme_temperature"],
              r["extreme_wind"], r["extreme_precipitation"], None, None, None)
             for r in weather.collect()]
    return sorted(arms, key=str)


def test_long_table_and_temp_view(spark, delays, weather):
    weather = weather.withColumn("date", F.col("date").cast("date"))
    long = unified_long(delays, weather)
    assert [(f.name, f.dataType) for f in long.schema] == [(f.name, f.dataType) for f in UNIFIED]
    assert bag(long) == _expected_long(delays, weather)
    create_temp_view("long_temp", delays, weather)
    assert bag(spark.table("long_temp")) == _expected_long(delays, weather)


def test_stored_view_follows_its_tables(spark, tmp_path, delays, weather):
    root = str(tmp_path)
    weather = base_plus_delta(weather, weather, WEATHER)
    publish_table(delays, "v_delays", root, "csv", read_schema=DELAYS)
    publish_table(weather, "v_weather", root, "parquet")
    create_view(spark, "v_long", "v_delays", "v_weather")
    assert dict(spark.table("v_long").dtypes) == {f.name: f.dataType.simpleString() for f in UNIFIED}
    assert bag(spark.table("v_long")) == _expected_long(delays, weather)
    publish_table(delays.union(delays), "v_delays", root, "csv", read_schema=DELAYS)
    create_view(spark, "v_long", "v_delays", "v_weather")
    assert bag(spark.table("v_long")) == _expected_long(delays.union(delays), weather)


def test_view_filter_drops_the_other_arm_and_unused_columns(spark, delays, weather):
    weather = weather.withColumn("date", F.col("date").cast("date"))
    only = unified_long(delays, weather).where("data_type = 'delay'")
    plan = only._jdf.queryExecution().optimizedPlan().toString()
    assert "weather" not in plan and "extreme_wind#" not in plan.split("LogicalRDD")[-1]


def test_report(spark, weather):
    more = weather.union(weather.withColumn("date", F.lit("2025-06-02")))
    more = more.union(weather.withColumn("date", F.lit(None).cast("string")))
    row = load_report(more).first()
    assert tuple(row) == (3, 2, 1, 3, 3, 0)
    near = load_report(more, approximate=True).first()
    assert near["unique_dates"] == 2


@pytest.mark.parametrize("step", ["write_version", "define_table"])
def test_a_failing_step_leaves_the_published_table(spark, tmp_path, delays, monkeypatch, step):
    from dayledger.sinks import publish

    spark.sql("DROP TABLE IF EXISTS step_table")
    publish_table(delays, "step_table", str(tmp_path), "csv")
    before = bag(spark.table("step_table"))

    def lost(*arguments, **options):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(publish, step, lost)
        with pytest.raises(OSError, match="lost"):
            publish_table(delays.drop("train_count"), "step_table", str(tmp_path), "csv")
    assert bag(spark.table("step_table")) == before
    # Other partitions: the new table is complete before it takes the name.
    rows = delays.where("station_name is not null")
    publish_table(rows, "step_table", str(tmp_path), "parquet", partition_by=("date",))
    assert spark.table("step_table").count() == 1
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("step_table_")] == []


@pytest.mark.parametrize("step", ["write_version", "define_table", "publish_union"])
def test_a_failing_step_leaves_the_view_over_base_and_delta(
    spark, tmp_path, delays, monkeypatch, step
):
    from dayledger.plans import rebuild

    names = {"base": "s_base", "delta": "s_delta", "target": "s_all", "changed_only": True}
    spark.sql("DROP VIEW IF EXISTS s_all")
    for name in ("s_base", "s_delta"):
        publish_table(delays, name, str(tmp_path / name), "csv")
    root = str(tmp_path / "published")
    assert rebuild.rebuild_delays(spark, root, **names) == 4
    before = bag(spark.table("s_all"))
    publish_table(delays.limit(1), "s_base", str(tmp_path / "s_base"), "csv")
    there = {t.name for t in spark.catalog.listTables()}

    def lost(*arguments, **options):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(rebuild, step, lost)
        with pytest.raises(OSError, match="lost"):
            rebuild.rebuild_delays(spark, root, **names)
    assert bag(spark.table("s_all")) == before
    assert {t.name for t in spark.catalog.listTables()} == there
    assert rebuild.rebuild_delays(spark, root, **names) == 3
    assert spark.table("s_all").count() == 3


def test_names_are_found_without_regard_to_case(spark, delays):
    base = delays.withColumnRenamed("date", "Date")
    merged = base_plus_delta(base, delays, DELAYS)
    assert merged.columns == DELAYS.names and merged.count() == 4
