"""Session settings and the shared scratch folder."""

from lakemart.session import RUNTIME_CONF, apply_runtime_conf, scratch_dir, scratch_root


def test_scratch_root_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and scratch_root(spark) == configured.rstrip("/")


def test_scratch_dirs_are_fresh(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(scratch_root(spark))


def test_runtime_conf_pins_utc_and_aqe(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        apply_runtime_conf(spark)
        for key, value in RUNTIME_CONF.items():
            assert spark.conf.get(key) == value
    finally:
        apply_runtime_conf(spark)
