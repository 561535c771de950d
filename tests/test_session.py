from geolake.session import checkpoint_dir, cluster_conf, materialize


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(100 * 2 ** 40, 8000)            # 100 TB over 8000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 << 20)
    small = cluster_conf(10 << 20, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64


def test_materialize_cuts_lineage_in_checkpoint_dir(spark):
    assert checkpoint_dir(spark)
    df = spark.range(100).selectExpr("id", "id * 2 AS v")
    m = materialize(df)
    assert sorted(r.v for r in m.collect()) == [2 * i for i in range(100)]
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan                            # reads the checkpoint, not the source


def test_release_deletes_the_files(spark):
    import os
    from geolake.session import release
    m = materialize(spark.range(5).toDF("id"))
    path = m._staged_at.removeprefix("file:")
    assert os.path.isdir(path)
    release(m)
    assert not os.path.exists(path)


def test_cluster_without_checkpoint_folder_is_an_error():
    import types

    import pytest
    sc = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                               getConf=lambda: types.SimpleNamespace(get=lambda *a: None))
    fake = types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        checkpoint_dir(fake)
