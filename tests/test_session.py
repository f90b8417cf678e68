from types import SimpleNamespace

import pytest

from docloom import session as s
from docloom.sources.tables import read_parquet


def fake_session(master, configured=None):
    folder = {"set": None}
    context = SimpleNamespace(
        master=master,
        getConf=lambda: SimpleNamespace(get=lambda key: None),
        getCheckpointDir=lambda: folder["set"],
        setCheckpointDir=lambda path: folder.update(set=path),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured))


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert s.shared_dir(spark) == configured
    assert s.work_dir(spark, "x").startswith(configured + "/docloom-x-")
    assert s.work_dir(spark, "x") != s.work_dir(spark, "x")
    assert s.shared_dir(fake_session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        s.shared_dir(fake_session("yarn"))


def test_local_session_without_setting_uses_one_temporary_folder():
    local = fake_session("local[2]")
    assert s.shared_dir(local) == s.shared_dir(local)


def test_small_tables_are_dealt_out_and_large_ones_left_alone(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(few)
    spark.range(100).repartition(16).write.option("maxRecordsPerFile", 1).parquet(many)
    assert read_parquet(spark, few, spread=True).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4m")
    try:
        scanned = read_parquet(spark, many).rdd.getNumPartitions()
        assert scanned >= 4 * spark.sparkContext.defaultParallelism
        assert read_parquet(spark, many, spread=True).rdd.getNumPartitions() == scanned
    finally:
        spark.conf.set(size, before)
