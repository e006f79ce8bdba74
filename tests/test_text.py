"""Text sources and sinks."""

import pytest

import edgeflow as ef


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


@pytest.fixture
def malformed(tmp_path):
    (tmp_path / "edges.csv").write_text("1,2\n 3 , 4 \nx,5\n6\n7,8,9\n")
    return str(tmp_path / "edges.csv")


def test_edges_permissive(spark, malformed):
    assert rows(ef.read_edges(spark, malformed)) == [(1, 2), (3, 4), (7, 8)]
    assert rows(ef.read_edges(spark, malformed, max_id=5)) == [(1, 2), (3, 4)]
    assert rows(ef.read_edges_text(spark, malformed)) == [(1, 2), (3, 4), (7, 8)]


def test_edges_strict(spark, malformed):
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        ef.read_edges(spark, malformed, mode="FAILFAST").collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|no edge"):
        ef.read_edges_text(spark, malformed, strict=True).collect()


def test_edges_folder_and_glob(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"part{i}.csv").write_text(f"{i},{i + 1}\n")
    assert rows(ef.read_edges(spark, str(tmp_path))) == [(1, 2), (2, 3)]
    assert rows(ef.read_edges_text(spark, str(tmp_path / "*2.csv"))) == [(2, 3)]


def test_nodes(spark, tmp_path):
    (tmp_path / "nodes.csv").write_text("1\n 2  3\n\n4\t5\nx\n")
    assert rows(ef.read_nodes(spark, str(tmp_path))) == [(1,), (2,), (3,), (4,), (5,)]


def test_seeds_below_a_folder(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one").write_text("10\t\n20\tx\n")
    (tmp_path / "two").write_text("30\n")
    assert rows(ef.read_centroid_seeds(spark, str(tmp_path))) == [(10,), (20,), (30,)]


def test_tagged_union(micro, micro_nodes):
    tagged = ef.tagged_union(node=micro_nodes, edge=micro.selectExpr("dst AS id"))
    assert tagged.groupBy("tag").count().orderBy("tag").collect() == [("edge", 11), ("node", 8)]


def test_delimited(spark, tmp_path):
    df = spark.createDataFrame([(1, 2), (3, None)], "a bigint, b bigint")
    for name, sep, expected in [
        ("comma", ",", ["1,2", "3,"]), ("dash", "-", ["1-2", "3-"]), ("none", "", ["12", "3"]),
    ]:
        ef.write_delimited(df, str(tmp_path / name), sep)
        assert lines(spark, str(tmp_path / name)) == expected


def test_tuples_named_and_summary(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, 0.0)], "a bigint, b double")
    ef.write_tuples(df, str(tmp_path / "tuples"))
    assert lines(spark, str(tmp_path / "tuples")) == ["(1,2.5)", "(2,0.0)"]
    ef.write_named({"centroid": df.select("a"), "cluster": df}, str(tmp_path / "named"))
    assert lines(spark, str(tmp_path / "named/cluster")) == ["1\t2.5", "2\t0.0"]
    one = spark.createDataFrame([(3, 4)], "s1 int, s2 int")
    labels = {"s1": "Longest shortest Src1 path", "s2": "Longest shortest Scr2 path"}
    ef.write_summary(one, str(tmp_path / "summary"), **labels)
    assert lines(spark, str(tmp_path / "summary")) == [
        "Longest shortest Scr2 path :4", "Longest shortest Src1 path :3",
    ]


def test_counts_round_trip(spark, micro, tmp_path):
    counts = ef.follower_count(micro)
    ef.write_delimited(counts, str(tmp_path / "counts"), "\t")
    assert rows(ef.read_counts(spark, str(tmp_path / "counts"))) == rows(counts)


def test_vertex_lines(spark, micro, tmp_path):
    states = ef.initial_states(ef.adjacency_lists(micro), 2, 3)
    path = str(tmp_path / "states")
    ef.write_adjacency(states, path)
    assert lines(spark, path)[:3] == [
        "1-2:2147483647:0:2147483647:0", "2-3,4:0:1:2147483647:0", "3-1,4:2147483647:0:0:1",
    ]
    assert rows(ef.read_adjacency(spark, path)) == rows(states)


def test_vertex_line_without_neighbours(spark):
    lines = spark.createDataFrame([("9-:1:1:2147483647:0",), ("-4-7:0:1:3:0",), ("5&6",)], "value string")
    assert sorted(map(tuple, ef.parse_adjacency(lines).collect()), key=lambda r: r[0]) == [
        (-4, [7], 0, True, 3, False), (9, [], 1, True, None, False),
    ]
