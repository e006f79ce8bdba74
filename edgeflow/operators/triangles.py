"""Paths of length two and directed 3-cycles, counted as a bag (parallel edges and loops count).

A closed walk a→b→c→a is looked for at its lowest vertex in the order (degree, id) only: the pairs
of neighbours tried at a vertex all have at least its degree, so there are at most sqrt(2E) of them
and a hub never pairs its followers with the vertices it follows; all pairs tried are of the order
of E^1.5 at worst. The other rotations of the walk follow by symmetry, so nothing is left out.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from edgeflow.functions import record
from edgeflow.operators.edges import weighted
from edgeflow.plans.hot import HOT_KEYS, SLICE_ROWS, hot_keys, join_on_vertex, slice_copies, with_slice
from edgeflow.plans.shared import keep, partitions
from edgeflow.schema import exact

STRATEGIES = ("auto", "broadcast", "shuffle_merge", "shuffle_hash", "preagg")

# Edges a replicated join may ship to every executor; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000

# Rows or paths that a task of `two_paths` groups, and rows of a side of a slice.
TASK_ROWS = 1_000_000
SIDE_ROWS = 1000


def _side(df, strategy):
    """Ask for the physical join of `strategy` with `df` as its build side."""
    hints = {"shuffle_merge": "merge", "shuffle_hash": "shuffle_hash", "broadcast": "broadcast"}
    return df.hint(hints[strategy]) if strategy in hints else df


def _checked(edges, strategy):
    """The strategy to use: a table too large to broadcast is joined by shuffle."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == "broadcast" and edges.count() > BROADCAST_ROWS:
        return "shuffle_merge"
    return strategy


def two_paths(G, strategy="auto", slice_rows=SLICE_ROWS):
    """Pairs joined by a path of length two, with the number of such paths: (f1, u2, n).

    Their number is known from the degrees and sets the number of tasks, so that a task has about
    TASK_ROWS paths. The in-edges and out-edges of a middle vertex with many paths are cut into slices
    of SIDE_ROWS at most and every in-slice meets every out-slice by itself.
    """
    strategy = _checked(G, strategy)
    spark = G.sparkSession
    size = G.count()
    # parallel edges meet in tasks of bounded size, not in one map for each split of the input
    E = weighted(G.repartition(partitions(spark, size, TASK_ROWS), "src", "dst"))
    ends = F.array(
        record(id=F.col("src"), n_in=F.lit(0), n_out=F.lit(1)), record(id=F.col("dst"), n_in=F.lit(1), n_out=F.lit(0))
    )
    degrees = E.select(F.inline(ends)).groupBy("id").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
    degrees = keep(degrees, "two-path-degrees")
    share = size // HOT_KEYS + 1
    side, most = max(min(slice_rows, SIDE_ROWS), share), max(slice_rows, share)
    pairs = exact("n_in") * exact("n_out")
    hot = degrees.where((pairs > side * side) | (F.greatest("n_in", "n_out") > most))
    total = degrees.agg(F.sum(pairs)).first()[0] or 0
    tasks = partitions(spark, int(total) + 2 * size, TASK_ROWS)
    sliced = not hot.isEmpty()

    def slices(n):
        limit = F.lit(side)
        number = F.call_function("div", F.col(n) + limit - 1, limit)
        return hot.select("id", F.greatest(number, F.lit(1)).cast("int").alias("slices")) if sliced else None

    hot_in, hot_out = slices("n_in"), slices("n_out")
    keys = ["mid", "i", "j"] if sliced else ["mid"]
    first = E.select(F.col("src").alias("f1"), F.col("dst").alias("mid"), F.col("w").alias("w1"))
    second = E.select(F.col("src").alias("mid"), F.col("dst").alias("u2"), F.col("w").alias("w2"))
    first = slice_copies(with_slice(first, "mid", hot_in, "f1", name="i"), "mid", hot_out, name="j")
    second = slice_copies(with_slice(second, "mid", hot_out, "u2", name="j"), "mid", hot_in, name="i")
    if strategy != "broadcast":
        second = second.repartition(tasks, *keys)
    paths = first.repartition(tasks, *keys).join(_side(second, strategy), keys)
    # hardly any path of a task is like another: they are added up after the shuffle only
    paths = paths.select("f1", "u2", "w1", "w2").repartition(tasks, "f1", "u2")
    return paths.groupBy("f1", "u2").agg(exact(F.sum(exact("w1") * exact("w2"))).alias("n"))


def _ordered_edges(G, slice_rows):
    """Distinct edges with the order of their ends and the loop at their source, written once.

    (src, dst, w, up, loop): `up` when dst is above src; NULL for a loop itself.
    """
    is_loop = F.col("src") == F.col("dst")
    one = F.when(is_loop, 0).otherwise(1)
    ends = G.select(
        F.inline(
            F.array(
                record(id=F.col("src"), one=one, loop=F.when(is_loop, 1)),
                record(id=F.col("dst"), one=one, loop=F.lit(None).cast("int")),
            )
        )
    )
    facts = keep(
        ends.groupBy("id").agg(F.sum("one").alias("n"), F.sum("loop").alias("loop")), "vertex-facts"
    )
    hot = hot_keys(facts.select("id", "n"), slice_rows)
    at_src = facts.select(F.col("id").alias("src"), F.col("n").alias("n_src"), "loop")
    at_dst = facts.select(F.col("id").alias("dst"), F.col("n").alias("n_dst"))
    known = join_on_vertex(weighted(G), "src", at_src, hot, "dst")
    known = join_on_vertex(known, "dst", at_dst, hot, "src")
    above = F.struct(F.col("n_dst"), F.col("dst")) > F.struct(F.col("n_src"), F.col("src"))
    ordered = known.select("src", "dst", "w", F.when(~is_loop, above).alias("up"), "loop")
    return keep(ordered, "ordered-edges")


def _wedges(ordered, strategy):
    """Paths x→v→y that an edge y→x would close: (x, v, y, w1, w2), one per closed walk at most.

    Either v is below x and below y and x ≠ y, or the first step is the loop at v = x.
    """
    into = ordered.where(~F.col("up")).select(
        F.col("dst").alias("v"), F.col("src").alias("x"), F.col("w").alias("w1")
    )
    out = ordered.where(F.col("up")).select(
        F.col("src").alias("v"), F.col("dst").alias("y"), F.col("w").alias("w2")
    )
    plain = into.join(_side(out, strategy), "v").where(F.col("x") != F.col("y"))
    looped = ordered.where(F.col("loop").isNotNull()).select(
        F.col("src").alias("v"), F.col("src").alias("x"), F.col("loop").alias("w1"),
        F.col("dst").alias("y"), F.col("w").alias("w2"),
    )
    return plain.unionByName(looped).select("x", "v", "y", "w1", "w2")


def _closing(ordered):
    return ordered.select(F.col("dst").alias("x"), F.col("src").alias("y"), F.col("w").alias("w3"))


def _rotations():
    """Distinct starting points of a closed walk: one if it stays at a vertex, else three."""
    return F.when(F.col("x") == F.col("y"), F.lit(1)).otherwise(F.lit(3))


def closed_walks(G, strategy="auto", slice_rows=SLICE_ROWS):
    """Closed walks x→v→y→x up to rotation: (x, v, y, w1, w2, w3, rotations)."""
    ordered = _ordered_edges(G, slice_rows)
    strategy = _checked(ordered, strategy)
    walks = _wedges(ordered, strategy).join(_side(_closing(ordered), strategy), ["x", "y"])
    return walks.withColumn("rotations", _rotations())


def triangle_rows(G, strategy="auto", slice_rows=SLICE_ROWS):
    """Two-paths with their closing edge: (f1, u2, f3, u3, n), f3 = u2 and u3 = f1."""
    walks = closed_walks(G, strategy, slice_rows)
    n = (exact("w1") * exact("w2") * exact("w3")).alias("n")
    rotated = F.array(
        record(f1=F.col("x"), u2=F.col("y")),
        record(f1=F.col("v"), u2=F.col("x")),
        record(f1=F.col("y"), u2=F.col("v")),
    )
    rows = walks.select(n, F.inline(F.slice(rotated, F.lit(1), F.col("rotations"))))
    grouped = rows.groupBy("f1", "u2").agg(exact(F.sum("n")).alias("n"))
    return grouped.select("f1", "u2", F.col("u2").alias("f3"), F.col("f1").alias("u3"), "n")


def _closed_sums(G, slice_rows):
    """Closed walks added up per closing edge: (x, y, s12, s1_s2, w3).

    The paths are added up per open pair before they meet the closing edges.
    """
    ordered = _ordered_edges(G, slice_rows)
    summed = _wedges(ordered, "preagg").groupBy("x", "y").agg(
        F.sum(exact("w1") * exact("w2")).alias("s12"),
        F.sum(exact("w1") + exact("w2")).alias("s1_s2"),
    )
    return summed.join(_closing(ordered), ["x", "y"])


def _total(column, name):
    return exact(F.coalesce(F.sum(column), F.lit(0))).alias(name)


def triangle_count(G, strategy="preagg", slice_rows=SLICE_ROWS):
    """Closed walks of length three, and a third of them rounded down: (closed_walks, triangles).

    "preagg" adds the open pairs up before it closes them; the others meet the closing edges row by
    row: "shuffle_merge", "shuffle_hash" and "broadcast" with that physical join, "auto" with the one
    Spark picks. "broadcast" shuffles beyond BROADCAST_ROWS distinct edges.
    """
    if strategy == "preagg":
        closed = _closed_sums(G, slice_rows)
        total = _total(exact("s12") * exact("w3") * _rotations(), "closed_walks")
    else:
        closed = closed_walks(G, strategy, slice_rows)
        n = exact("w1") * exact("w2") * exact("w3")
        total = _total(n * F.col("rotations"), "closed_walks")
    return _with_triangles(closed.agg(total))


def closed_two_paths(G, slice_rows=SLICE_ROWS):
    """Two-paths that some edge closes, however many do: (two_paths_closed, triangles)."""
    closed = _closed_sums(G, slice_rows)
    stays = F.col("x") == F.col("y")
    other_rotations = F.when(stays, exact(F.lit(0))).otherwise(exact("w3") * exact("s1_s2"))
    return _with_triangles(closed.agg(_total(exact("s12") + other_rotations, "two_paths_closed")))


def _with_triangles(total):
    n = F.col(total.columns[0])
    return total.withColumn("triangles", exact((n - n % 3) / 3))


def successor_lookup(G, slice_rows=SLICE_ROWS):
    """Follow one successor per vertex, the largest id: (kept, dead_end, closed, triangles).

    An edge f→u is kept when u has no successor (dead end) or the successor of u's successor is f
    (closed).
    """
    followed = G.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(followed, slice_rows)
    successor = G.groupBy(F.col("src").alias("id")).agg(F.max("dst").alias("next"))
    after = successor.select(F.col("id").alias("next"), F.col("next").alias("next2"))
    chain = join_on_vertex(successor, "next", after, hot, "id", how="left")
    ends = chain.select(F.col("id").alias("dst"), "next", "next2")
    looked_up = join_on_vertex(weighted(G), "dst", ends, hot, "src", how="left")

    def edges_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("w"))), F.lit(0).cast("bigint"))

    dead_end = edges_where(F.col("next").isNull())
    closed = edges_where(F.col("next2") == F.col("src"))
    return looked_up.agg(
        (dead_end + closed).alias("kept"),
        dead_end.alias("dead_end"),
        closed.alias("closed"),
        F.call_function("div", dead_end + closed, F.lit(3)).alias("triangles"),
    )


def counted(df, **totals):
    """`df` with counters that fill while it is written: (df, Observation)."""
    counters = Observation()
    return df.observe(counters, *[column.alias(name) for name, column in totals.items()]), counters
