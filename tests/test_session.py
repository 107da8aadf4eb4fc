from ledgerline.session import scale_conf


def test_scale_conf_grows_with_input():
    small = scale_conf(10 * 1024**3)
    big = scale_conf(100 * 1024**4)
    assert int(small["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 200
    mid = scale_conf(10 * 1024**4)
    # 256 MB a partition at any size
    assert int(mid["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 40961
    assert int(big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 409601
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"


def test_apply_scale_conf_sets_sql_settings(spark):
    from ledgerline.session import apply_scale_conf

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        applied = apply_scale_conf(spark, 10 * 1024**4)
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "40961"
        assert all(k.startswith("spark.sql.") for k in applied)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")


def test_platform_session_keeps_the_master(spark):
    from ledgerline.session import SCALE_CONF, platform_session

    same = platform_session()
    assert same.sparkContext.master == spark.sparkContext.master
    assert same.conf.get("spark.sql.adaptive.enabled") == SCALE_CONF["spark.sql.adaptive.enabled"]


def test_input_bytes_counts_all_files(spark):
    import os

    from ledgerline.sources.tables import input_bytes
    from tests.conftest import SF_SMALL

    assert input_bytes(spark, SF_SMALL) == sum(e.stat().st_size for e in os.scandir(SF_SMALL))
