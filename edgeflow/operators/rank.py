"""PageRank."""

from pyspark.sql import functions as F

from edgeflow.operators.degree import follower_count_all
from edgeflow.operators.edges import reverse_edges, send_state, weighted
from edgeflow.plans.hot import SLICE_ROWS, found_once, hot_keys, settled, slice_copies, slice_keys
from edgeflow.plans.shared import Rounds


def rank_contributions(G, ranks, slice_rows=SLICE_ROWS):
    """What each vertex receives when every edge carries its source's rank: (id, pr)."""
    sent = send_state(G, ranks, slice_rows)
    return sent.groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("w") * F.col("pr")).alias("pr"))


def with_default_zero(ids, received):
    """Every vertex of `ids` with what it received, 0.0 if nothing: (id, pr)."""
    return ids.join(received, "id", "left").select("id", F.coalesce("pr", F.lit(0.0)).alias("pr"))


def top_k(df, by, k=100, tie="id"):
    """The k rows with the largest `by`; the smaller `tie` comes first among equals."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def chain_pagerank(edges, ranks, n=None, sink=0, iters=10):
    """Undamped PageRank on edges with one successor per vertex: the ranks after each round.

    `sink` takes in what flows to it and each round hands it back in equal parts to the vertices
    that have an edge; it holds no rank itself afterwards. Rank sent to a vertex without an edge is
    lost. `n` is the number of parts, by default the number of edges. Returns (round, id, pr),
    rounds 1 … iters.

    The state keeps each vertex beside its successor, so a round is one aggregate over the state and
    one join with the vertices, which stay partitioned by id.
    """
    edges = settled(edges.select(F.col("src").alias("id"), "dst"), "id", size=edges.count())
    rounds = Rounds(edges.sparkSession, "chain-pagerank", "id bigint, dst bigint, pr double")
    try:
        n = edges.count() if n is None else n
        current = rounds.write(0, edges.join(ranks.select("id", "pr"), "id", "left"))
        for number in range(1, iters + 1):
            received = current.groupBy(F.col("dst").alias("id")).agg(F.sum("pr").alias("got"))
            delta = current.where(F.col("dst") == sink).agg(F.sum("pr").alias("delta")).scalar()
            back = F.coalesce(delta, F.lit(0.0)) / F.lit(float(max(n, 1)))
            pr = F.coalesce("got", F.lit(0.0)) + F.when(F.col("id") == sink, 0.0).otherwise(back)
            current = rounds.write(
                number, edges.join(received, "id", "left").select("id", "dst", pr.alias("pr"))
            )
    finally:
        edges.unpersist()
    return rounds.all().where(F.col("round") > 0).select("id", "pr", "round")


def pagerank(G, damping=1.0, iters=10, slice_rows=SLICE_ROWS):
    """PageRank on any graph: the ranks after each round, (round, id, pr), rounds 0 … iters.

    A vertex shares its rank over its out-edges (parallel edges count); the rank of vertices without
    out-edges is spread over all vertices, so the total stays 1. Edges and vertices keep their
    partitioning over all rounds: a round shuffles the ranks and the summed contributions only.
    """
    spark = G.sparkSession
    out = follower_count_all(reverse_edges(G), G.select(F.col("dst").alias("id")))
    size = G.count()
    points = settled(out.withColumnRenamed("n", "n_out"), "id", size=2 * size)
    hot = found_once(hot_keys(points.select("id", F.col("n_out").alias("n")), slice_rows))
    edges = settled(weighted(G), "src", hot, "dst", size)
    rounds = Rounds(spark, "pagerank", "id bigint, n_out bigint, pr double")
    try:
        n = points.count()
        if n == 0:
            return rounds.write(0, points.withColumn("pr", F.lit(0.0))).select(
                "id", "pr", F.lit(0).alias("round")
            )
        current = rounds.write(0, points.withColumn("pr", F.lit(1.0 / n)))
        for number in range(1, iters + 1):
            share = (F.col("pr") / F.col("n_out")).alias("share")
            sent = current.where(F.col("n_out") > 0).select(F.col("id").alias("src"), share)
            received = (
                edges.join(slice_copies(sent, "src", hot), slice_keys("src", hot))
                .groupBy(F.col("dst").alias("id"))
                .agg(F.sum(F.col("w") * F.col("share")).alias("got"))
            )
            stuck = current.where(F.col("n_out") == 0).agg(F.sum("pr").alias("stuck")).scalar()
            spread_back = F.coalesce(stuck, F.lit(0.0)) / F.lit(float(n))
            pr = F.lit((1.0 - damping) / n) + F.lit(float(damping)) * (
                F.coalesce("got", F.lit(0.0)) + spread_back
            )
            current = rounds.write(
                number, points.join(received, "id", "left").select("id", "n_out", pr.alias("pr"))
            )
    finally:
        edges.unpersist()
        points.unpersist()
        if hot is not None:
            hot.unpersist()
    return rounds.all().select("id", "pr", "round")


class ResidualRanks:
    """`ranks` (id, pr), and what each round found: `trace`, a list of (round, active vertices, rank not yet given out)."""

    def __init__(self, ranks, trace):
        self.ranks, self.trace = ranks, trace


def pagerank_residual(G, damping=0.85, tolerance=1e-6, restart=None, max_rounds=None, slice_rows=SLICE_ROWS):
    """PageRank to a tolerance: the sum of all errors of the ranks is at most `tolerance`. `ResidualRanks`.

    Walks start anew, with the probability 1 − damping, at the vertices `restart` (ids; those that no edge
    touches do not count) or at any vertex. Every vertex holds rank and residual, what came in and was not
    given on. Only active vertices, whose residual is above an equal share of what may be left, take theirs into their rank
    and send the damped part on; that of vertices without out-edges goes where walks start. The
    residuals sum up to (1 − damping) times the error, so the loop ends on a proven bound, or after
    `max_rounds` without one.
    """
    if not 0 <= damping < 1:
        raise ValueError("damping is at least 0 and below 1")
    spark = G.sparkSession
    out = follower_count_all(reverse_edges(G), G.select(F.col("dst").alias("id")))
    size = G.count()
    points = settled(out.withColumnRenamed("n", "n_out"), "id", size=2 * size)
    hot = found_once(hot_keys(points.select("id", F.col("n_out").alias("n")), slice_rows))
    edges = settled(weighted(G), "src", hot, "dst", size)
    rounds = Rounds(spark, "residual-rank", "id bigint, n_out bigint, home double, pr double, residual double")
    try:
        starts = F.lit(True) if restart is None else F.col("id").isin(*restart)
        n, homes = points.agg(F.count(F.lit(1)), F.count_if(starts)).first()
        if n and not homes:
            raise ValueError("no restart vertex has an edge")
        home = F.when(starts, 1.0 / max(homes, 1)).otherwise(0.0)
        first = points.select("id", "n_out", home.alias("home"), F.lit(0.0).alias("pr"))
        current, number, trace = rounds.write(0, first.withColumn("residual", F.col("home") * (1.0 - damping))), 0, []
        left = tolerance * (1.0 - damping)
        active = F.col("residual") > left / max(n, 1)
        while True:
            stuck = F.sum(F.when(active & (F.col("n_out") == 0), F.col("residual")))
            counted = current.agg(F.count_if(active), F.coalesce(F.sum("residual"), F.lit(0.0)), F.coalesce(stuck, F.lit(0.0)))
            senders, residual, lost = counted.first()
            trace.append((number, senders, residual))
            if residual <= left or not senders or number == max_rounds:
                return ResidualRanks(current.select("id", "pr"), trace)
            number += 1
            share = (F.col("residual") * damping / F.col("n_out")).alias("share")
            sent = current.where(active & (F.col("n_out") > 0)).select(F.col("id").alias("src"), share)
            received = (
                edges.join(slice_copies(sent, "src", hot), slice_keys("src", hot))
                .groupBy(F.col("dst").alias("id"))
                .agg(F.sum(F.col("w") * F.col("share")).alias("got"))
            )
            kept = F.when(active, 0.0).otherwise(F.col("residual"))
            taken = F.when(active, F.col("residual")).otherwise(0.0)
            current = rounds.write(number, current.join(received, "id", "left").select(
                "id", "n_out", "home", (F.col("pr") + taken).alias("pr"),
                (kept + F.coalesce("got", F.lit(0.0)) + F.col("home") * (damping * lost)).alias("residual"),
            ))
    finally:
        edges.unpersist()
        points.unpersist()
        if hot is not None:
            hot.unpersist()


def last_round(ranks, iters):
    return ranks.where(F.col("round") == iters).select("id", "pr")


def rank_trace(ranks):
    """Total rank after each round: (round, total)."""
    return ranks.groupBy("round").agg(F.sum("pr").alias("total"))
