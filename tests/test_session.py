"""The checkpoint folder comes from the session; materialized tables land under it."""

from scorewright.session import checkpoint_dir, cluster_conf, ensure_checkpoint_dir, materialize


def test_checkpoint_dir_is_read_from_the_session(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before and ensure_checkpoint_dir(spark) == before == checkpoint_dir(spark)


def test_materialize_writes_under_the_checkpoint_dir(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    out = materialize(df, "probe")
    norm = lambda p: "/" + p.replace("file:", "").lstrip("/")
    base = norm(spark.sparkContext.getCheckpointDir())
    assert all(norm(f).startswith(base) for f in out.inputFiles())
    assert sorted(r["x"] for r in out.collect()) == list(range(10))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan  # lineage cut: the plan scans the written table


def test_cluster_conf_sizes():
    conf = cluster_conf(1000, 8)
    assert conf["spark.sql.shuffle.partitions"] == "16000"
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 128 * 1024 * 1024
