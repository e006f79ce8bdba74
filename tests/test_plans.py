"""The physical plans that make the operators scale."""

import re

import pytest

import edgeflow as ef
from conftest import sf
from edgeflow.operators import triangles
from edgeflow.plans import Rounds, hot_keys, plan_text
from edgeflow.queries import QUERIES
from edgeflow.tables import graph


@pytest.fixture
def G(spark):
    return graph(spark, sf("0.001"), "supplies")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def tree(df):
    return plan_text(df, "simple")


def test_count_combines_before_the_shuffle(G):
    plan = tree(ef.follower_count(G))
    assert re.search(r"HashAggregate.*\n.*Exchange hashpartitioning.*\n.*HashAggregate.*partial_count", plan)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_limit_reaches_the_scan(G):
    plan = tree(ef.filter_max_id(G, 5))
    assert "LessThan(l_partkey,5)" in plan and "LessThan(l_suppkey,5)" in plan


@pytest.mark.parametrize(
    "strategy, join",
    [
        ("shuffle_merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
        ("broadcast", "BroadcastHashJoin"),
    ],
)
def test_join_strategies(G, strategy, join):
    plan = tree(ef.closed_walks(G, strategy))
    assert plan.count(join) == 2
    others = {"SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin"} - {join}
    assert not any(other in plan for other in others)


def test_large_tables_are_not_broadcast(G, monkeypatch):
    monkeypatch.setattr(triangles, "BROADCAST_ROWS", 10)
    assert tree(ef.closed_walks(G, "broadcast")).count("SortMergeJoin") == 2


def nodes(df):
    """Operators of the physical plan, without those inside cached tables and subqueries."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    found, left = [], [plan]
    while left:
        node = left.pop()
        below = node.children()
        left += [below.apply(i) for i in range(below.size())]
        found.append((node.nodeName(), [below.apply(i).nodeName() for i in range(below.size())]))
    return found


@pytest.mark.parametrize(
    "run",
    [
        # two shuffles each: the state, and what the vertices receive
        lambda G, slice_rows: ef.bfs_distances(G, [2, 3], 2, slice_rows),
        lambda G, slice_rows: ef.pagerank(G, iters=2, slice_rows=slice_rows),
    ],
    ids=["bfs", "pagerank"],
)
@pytest.mark.parametrize("slice_rows", [5, 1_000_000])
def test_rounds_leave_the_edges_in_place(G, no_broadcast, monkeypatch, run, slice_rows):
    plans, write = {}, Rounds.write

    def spy(self, number, df):
        plans[number] = nodes(df)
        return write(self, number, df)

    monkeypatch.setattr(Rounds, "write", spy)
    run(G, slice_rows)
    names = [name for name, _ in plans[2]]
    assert names.count("Exchange") == 2
    assert "SortMergeJoin" in names and "InMemoryTableScan" in names
    assert not any(name == "Sort" and "InMemoryTableScan" in below for name, below in plans[2])


def test_chain_rounds_shuffle_the_sums_only(spark, no_broadcast, monkeypatch):
    plans, write = {}, Rounds.write

    def spy(self, number, df):
        plans[number] = [name for name, _ in nodes(df)]
        return write(self, number, df)

    monkeypatch.setattr(Rounds, "write", spy)
    ef.chain_pagerank(*ef.chain_graph(spark, 5), iters=2)
    assert plans[2].count("Exchange") == 1


def test_no_python_and_no_cross_join(spark):
    lazy = [
        "follower_count", "follower_count_grouped", "follower_count_all", "two_paths", "triangle_rows",
        "triangle_count_preagg", "closed_two_paths_semi", "successor_lookup", "adjacency_lists",
        "in_out_neighbour_lists", "expand_neighbours", "rank_contributions", "kmeans_assign",
    ]
    for name in lazy:
        plan = tree(QUERIES[name](spark, sf("0.001")))
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ScalaUDF"):
            assert operator not in plan, (name, operator)


def test_two_paths_take_more_tasks_with_more_paths(edges_from, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(triangles, "TASK_ROWS", 500)
    monkeypatch.setattr(triangles, "SIDE_ROWS", 10)
    # 10,000 paths through one vertex, which one task would join
    G = edges_from([(i, 1_000) for i in range(100)] + [(1_000, 2_000 + i) for i in range(100)])
    found = ef.two_paths(G)
    per_task = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 10_000 and max(r["count"] for r in per_task) <= 1_000


def test_hot_keys_are_few_and_sliced(spark, monkeypatch):
    from edgeflow.plans import hot

    monkeypatch.setattr(hot, "HOT_KEYS", 10)
    sizes = spark.createDataFrame([(i, 5) for i in range(100)] + [(100, 500)], "id bigint, n bigint")
    found = {r.id: r.slices for r in hot.hot_keys(sizes, 1).collect()}
    # 1,000 rows over at most 10 hot keys: a key is hot above 101 rows
    assert found == {100: 5}


def test_hot_vertex_spreads_over_tasks(edges_from):
    from pyspark.sql import functions as F

    from edgeflow.plans import with_slice

    G = edges_from([(1, i) for i in range(1000)] + [(2, 1)])
    sizes = ef.follower_count(ef.reverse_edges(G))
    sliced = with_slice(G, "src", hot_keys(sizes, 100), "dst")
    counts = sliced.where("src = 1").groupBy("slice").agg(F.count("*").alias("n")).collect()
    assert len(counts) == 10 and max(r.n for r in counts) < 200
