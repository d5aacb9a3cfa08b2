"""Session helpers: partition sizing from input size, checkpoint folder."""

from conftest import SF01

from featureflow import session as S


def test_scale_conf_sizes_partitions():
    conf = S.scale_conf(10 * (256 << 20))
    assert conf["spark.sql.shuffle.partitions"] == "10"
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert S.scale_conf(1)["spark.sql.shuffle.partitions"] == "1"
    # 100 TB hits the cap; partitions grow past the target instead
    assert S.scale_conf(100 * 10**12)["spark.sql.shuffle.partitions"] == str(S.MAX_SHUFFLE_PARTITIONS)


def test_input_bytes_reads_metadata(spark):
    n = S.input_bytes(spark, [f"{SF01}/embeddings.parquet", f"{SF01}/missing.parquet"])
    assert n > 0
    assert S.input_bytes(spark, SF01) >= n


def test_size_for_input_keeps_explicit_settings(spark):
    # the test session sets spark.sql.shuffle.partitions explicitly: it is left alone
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = S.size_for_input(spark, SF01)
    assert "spark.sql.shuffle.partitions" not in applied
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    for k in applied:
        spark.conf.unset(k)


def test_checkpoint_dir_is_set(spark):
    assert S.checkpoint_dir(spark)
