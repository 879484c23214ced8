"""Session helpers: shared checkpoint folder, unique scratch paths, sizing."""

from strata import session as S


def test_checkpoint_dir_read_from_session(spark):
    root = S.ensure_checkpoint_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    a, b = S.scratch_path(spark, "x"), S.scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_scale_conf_sizes_partitions():
    tb = 1024 ** 4
    conf = S.scale_conf(100 * tb, total_cores=8000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts == 100 * tb // (256 * 1024 ** 2)  # no cap: each stays at 256 MB
    small = S.scale_conf(10 * 1024 ** 3, total_cores=800)
    assert int(small["spark.sql.shuffle.partitions"]) == 1600   # 2 x cores floor
    assert small["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * 1024 ** 2)


def test_session_without_any_checkpoint_setting(tmp_path):
    """A machine whose Spark defaults name no folder (an own process with an empty configuration)."""
    import os
    import subprocess
    import sys
    code = ("from strata.session import build_session, ensure_checkpoint_dir, scratch_path\n"
            "s = build_session('t', master='local[1]', shuffle_partitions=1)\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "root = ensure_checkpoint_dir(s)\n"
            "assert root == ensure_checkpoint_dir(s) == s.sparkContext.getCheckpointDir()\n"
            "p = scratch_path(s, 'x')\n"
            "s.range(3).write.parquet(p)\n"
            "assert s.read.parquet(p).count() == 3 and s.range(5).checkpoint().count() == 5\n"
            "print('fine')\n")
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_SUBMIT")}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env |= {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]
