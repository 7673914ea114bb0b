"""Session settings and the working folder."""

from types import SimpleNamespace

import pytest

from dayledger import session


def _stub(master, folder):
    settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/w/house"}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_working_folder_is_new_and_below_the_shared_one():
    stub = _stub("yarn", "s3a://bucket/shared/")
    first, second = session.working_folder(stub), session.working_folder(stub)
    assert first != second
    assert first.startswith("s3a://bucket/shared/dayledger-")


def test_a_local_session_works_in_its_warehouse_where_the_setting_is_missing():
    local = session.working_folder(_stub("local[2]", None))
    assert local.startswith("file:/w/house/_working/dayledger-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.working_folder(_stub("yarn", None))


def test_written_rows_have_no_lineage(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) as text")
    back = session.written(df)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect()) == sorted(df.collect())
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan


def test_settings_given_by_the_caller_win(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
