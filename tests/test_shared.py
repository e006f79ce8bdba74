"""Where loop state and written tables go."""

import pytest

from edgeflow.operators import bfs_distances, pagerank
from edgeflow.plans import settled, shared


def test_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared.new_folder(spark, "x"), shared.new_folder(spark, "x")
    assert first != second and first.startswith(f"{root}/edgeflow-")


def test_a_cluster_without_shared_folder_is_refused():
    class Nothing:
        def __init__(self, **attributes):
            self.__dict__.update(attributes)

    quiet = lambda *_: None
    is_cluster = Nothing(sc=lambda: Nothing(isLocal=lambda: False))
    context = Nothing(getConf=lambda: Nothing(get=quiet), getCheckpointDir=quiet, _jsc=is_cluster)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared._root(Nothing(conf=Nothing(get=quiet), sparkContext=context))


def test_rounds(spark):
    rounds = shared.Rounds(spark, "test", "id bigint")
    rounds.write(0, spark.range(2))
    rounds.write(1, spark.range(2).where("id > 5"))
    assert rounds.read(1).isEmpty()
    assert sorted(tuple(r) for r in rounds.all().collect()) == [(0, 0), (1, 0)]


def test_keep_writes_once(spark):
    kept = shared.keep(spark.range(3), "kept")
    assert kept.count() == 3 and "Scan parquet" in kept._jdf.queryExecution().toString()


def test_drop_written(spark, monkeypatch):
    import os

    monkeypatch.setattr(shared, "_session_folders", {})
    kept = shared.keep(spark.range(3), "kept")
    folder = shared._session_folder(spark)
    assert os.path.isdir(folder) and kept.count() == 3
    shared.drop_written(spark)
    assert not os.path.exists(folder)
    assert shared._session_folder(spark) != folder


@pytest.mark.parametrize("rows, expected", [(0, 4), (8_000_000, 4), (16_000_001, 5), (10**13, 2_500_000)])
def test_cached_partitions_go_with_the_rows(spark, rows, expected):
    assert shared.partitions(spark, rows) == expected


def test_loops_over_many_edges_keep_small_partitions(spark, monkeypatch):
    monkeypatch.setattr(shared, "PARTITION_ROWS", 20)
    G = spark.range(200).selectExpr("id AS src", "(id + 1) % 200 AS dst")
    kept = settled(G, "src", size=G.count())
    try:
        assert kept.rdd.getNumPartitions() == 10
    finally:
        kept.unpersist()
    assert {(r.id, r.dist) for r in bfs_distances(G, [0]).collect()} == {(i, i) for i in range(200)}
    ranks = pagerank(G, iters=2).where("round = 2").collect()
    assert len(ranks) == 200 and all(abs(r.pr - 1 / 200) < 1e-9 for r in ranks)
