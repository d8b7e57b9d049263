import os

import pytest

from tests.conftest import rows
from tidewell.session import materialize, pin_session, scratch_dir, shared_root, with_conf


def test_scratch_is_below_the_folder_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark).startswith(base)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(shared_root(spark))


def test_materialize_cuts_the_lineage(spark, plan_of):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice").where("id > 3")
    kept = materialize(df, "unit")
    assert rows(kept) == rows(df)
    assert "Range" not in plan_of(kept) and "FileScan parquet" in plan_of(kept)


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class sparkContext:
        applicationId = "app-cluster"
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class conf:
        get = staticmethod(lambda key, default=None: default)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Cluster())


def test_pinned_settings(spark):
    pin_session(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.ui.enabled") == "false"
    assert os.path.isdir(shared_root(spark))


def test_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ValueError):
        with with_conf(spark, spark__sql__shuffle__partitions=3):
            assert spark.conf.get(key) == "3"
            raise ValueError
    assert spark.conf.get(key) == before
