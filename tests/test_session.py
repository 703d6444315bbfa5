"""Session helpers: cluster sizing and the shared checkpoint folder."""

from __future__ import annotations

import pytest

from ledgerlens.session import apply_unset, cluster_conf, is_local, scratch_dir, shared_dir


def test_cluster_conf_sizes_shuffles_for_the_fact():
    small, big = cluster_conf(10 * 2**30), cluster_conf(100 * 2**40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    reducers = int(big["spark.sql.shuffle.partitions"])
    maps = 100 * 2**40 / int(big["spark.sql.files.maxPartitionBytes"])
    assert 10_000 < reducers <= 30_000 and maps <= 50_000
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) <= 4 * 2**30
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_apply_unset_keeps_launch_settings(spark):
    key = "spark.sql.files.maxPartitionBytes"
    saved, before = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        apply_unset(spark, {key: "512m", "spark.sql.shuffle.partitions": "5000"})
        assert spark.conf.get(key) == "512m"                                # not given at launch
        assert spark.conf.get("spark.sql.shuffle.partitions") == before  # given at launch
    finally:
        spark.conf.set(key, saved)


def test_a_cluster_without_a_shared_folder_raises():
    class Unset:
        master = "spark://host:7077"

        def get(self, key, default=None):
            return default

        def getConf(self):
            return self

        def getCheckpointDir(self):
            return None

    session = Unset()
    session.conf = session.sparkContext = session
    with pytest.raises(RuntimeError):
        shared_dir(session)
    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[2,1,1024]")


def test_scratch_folders_live_under_the_checkpoint_dir(spark):
    root = shared_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b
