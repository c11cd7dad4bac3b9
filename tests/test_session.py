"""Session helpers: runtime settings, cluster sizing, checkpoint folder."""

from __future__ import annotations

from cohortkit.session import RUNTIME_CONF, checkpoint_dir, cluster_conf, tune
from cohortkit.sources.sinks import stage_root


def test_tune_sets_runtime_conf(spark):
    tune(spark)
    for key, value in RUNTIME_CONF.items():
        assert spark.conf.get(key) == value


def test_cluster_conf_sizes_and_caps():
    small = cluster_conf(10 * 1024**3)
    assert small["spark.sql.shuffle.partitions"] == "200"
    mid = cluster_conf(2 * 1024**4)
    assert mid["spark.sql.shuffle.partitions"] == str(2 * 1024**4 // (256 * 1024**2))
    huge = cluster_conf(100 * 1024**4)
    assert huge["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * 1024**2))
    capped = cluster_conf(100 * 1024**4, max_shuffle_partitions=32768)
    assert capped["spark.sql.shuffle.partitions"] == "32768"
    assert huge["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)


def test_checkpoint_folder_from_session_or_fallback(spark, tmp_path):
    # the session's folder (spark.checkpoint.dir, or one set earlier) wins; the
    # fallback is used only when there is none
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = checkpoint_dir(spark, fallback=str(tmp_path / "ckpt"))
    assert folder == (named or str(tmp_path / "ckpt")) or (not named and folder)
    assert checkpoint_dir(spark, fallback=str(tmp_path / "other")) in (folder, spark.sparkContext.getCheckpointDir())
    assert stage_root(spark).endswith("/cohortkit_tables")
    assert stage_root(spark, str(tmp_path / "given")) == str(tmp_path / "given")
