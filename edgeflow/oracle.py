"""The same questions as plain SQL over the given tables, for a check in another engine.

Loops are unrolled into common table expressions, one set per round.
"""

from edgeflow.plans import HOT_KEYS
from edgeflow.queries import (
    DAMPING, K, MANY_SOURCES, MAX_ID, PR_ROUNDS, RESTART, RESTART_DAMPING, SOURCES,
)
from edgeflow.tables import EDGE_COLUMNS

MAX_PASSES = 11
MAX_LIST = 10_000


def _edges(name):
    src, dst = EDGE_COLUMNS[name]
    return (
        f"g AS MATERIALIZED (SELECT {src} AS src, {dst} AS dst FROM lineitem "
        f"WHERE {src} IS NOT NULL AND {dst} IS NOT NULL)"
    )


def _over(name, *parts):
    """WITH g as the named graph, then further expressions; the last part is the query."""
    *expressions, final = parts
    return "WITH " + ", ".join([_edges(name), *expressions]) + " " + final


def _text(expression, name):
    return f"CAST(CAST({expression} AS HUGEINT) AS VARCHAR) AS {name}"


def _grid(expression, name, bits=36):
    return f"round(({expression}) * {2**bits}.0::DOUBLE) / {2**bits}.0::DOUBLE AS {name}"


COUNTS = "c AS MATERIALIZED (SELECT dst AS id, count(*) AS n FROM g GROUP BY dst)"
WEIGHTED = "e AS MATERIALIZED (SELECT src, dst, count(*) AS w FROM g GROUP BY src, dst)"
VERTICES = "v AS MATERIALIZED (SELECT src AS id FROM g UNION SELECT dst FROM g)"

# Every path f1→mid→u2 and the edge u2→f1 that closes it, over distinct edges with their numbers.
CLOSED = (
    "closed AS MATERIALIZED (SELECT a.src AS f1, b.dst AS u2, a.w AS w1, b.w AS w2, z.w AS w3 "
    "FROM e a JOIN e b ON a.dst = b.src JOIN e z ON z.src = b.dst AND z.dst = a.src)"
)
WALKS = "CAST(w1 AS HUGEINT) * w2 * w3"


def _triangles(name, where=""):
    expressions = [WEIGHTED, CLOSED]
    if where:
        expressions[0] = WEIGHTED.replace("FROM g", f"FROM g WHERE {where}")
    total = f"coalesce(sum({WALKS}), 0)"
    return _over(
        name, *expressions,
        f"SELECT {_text(total, 'closed_walks')}, {_text(f'{total} // 3', 'triangles')} FROM closed",
    )


# fixed values: a prime modulus and a generator of its multiplicative group
MODULUS, MULTIPLIER = 2147483647, 48271


def _listed(rows):
    """Rows (id, other, w, …) with the part of the list they belong to; long lists come in several parts."""
    limit = f"greatest({MAX_LIST}, count(*) OVER () // {HOT_KEYS} + 1)"
    mixed = f"(({MODULUS} + other % {MODULUS}) % {MODULUS} * {MULTIPLIER}) % {MODULUS}"
    return (
        f"listed AS MATERIALIZED (SELECT *, CASE WHEN n > most THEN {mixed} % ((n + most - 1) // most) ELSE 0 END::INT AS part "
        f"FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n, {limit} AS most FROM ({rows})))"
    )


def _adjacency():
    return _over(
        "purchases", WEIGHTED, _listed("SELECT src AS id, dst AS other, w FROM e"),
        "SELECT id, part, string_agg(other || ':' || w, ',' ORDER BY other) AS nbrs FROM listed GROUP BY id, part",
    )


def _in_out():
    ends = "SELECT src AS id, dst AS other, w, true AS out FROM e UNION ALL SELECT dst, src, w, false FROM e"
    lists = ", ".join(
        f"coalesce(string_agg(other || ':' || w, ',' ORDER BY other) FILTER ({condition}), '') AS {name}"
        for name, condition in (("ins", "NOT out"), ("outs", "out"))
    )
    return _over("purchases", WEIGHTED, _listed(ends), f"SELECT id, part, {lists} FROM listed GROUP BY id, part")


def _hops(name, sources, final, *expressions, steps="SELECT DISTINCT src, dst FROM g"):
    """Distances r(source, id, dist) from vertices that some edge touches; it ends where nothing is new."""
    return "WITH RECURSIVE " + ", ".join([
        _edges(name), f"d AS MATERIALIZED ({steps})", "v AS MATERIALIZED (SELECT src AS id FROM d UNION SELECT dst FROM d)",
        f"r(source, id, dist) USING KEY (source, id) AS (SELECT id, id, 0 FROM v WHERE {sources} "
        "UNION SELECT r.source, d.dst, min(r.dist) + 1 FROM r JOIN d ON d.src = r.id "
        "LEFT JOIN recurring.r AS o ON o.source = r.source AND o.id = d.dst WHERE o.id IS NULL GROUP BY r.source, d.dst)",
        *expressions,
    ]) + " " + final


def _bfs(final):
    sources = f"id IN ({', '.join(map(str, SOURCES))})"
    return _hops("purchases", sources, final, "dist AS MATERIALIZED (SELECT source, id, dist FROM r)")


def _many(final):
    return _hops(
        "purchases", f"id >= {MANY_SOURCES.start} AND id < {MANY_SOURCES.stop}", final,
        "c AS MATERIALIZED (SELECT source, dist, count(*) AS n FROM r GROUP BY source, dist)",
    )


def _extent():
    both = "SELECT src, dst FROM g WHERE src <> dst UNION SELECT dst, src FROM g WHERE src <> dst"
    return _hops(
        "supplies", "true",
        "SELECT component, count(*) AS vertices, max(ecc) AS diameter, min(ecc) AS radius FROM e GROUP BY component",
        "e AS (SELECT source, max(dist) AS ecc, min(id) AS component FROM r GROUP BY source)", steps=both,
    )


CHAIN = [
    "ids AS MATERIALIZED (SELECT p_partkey + 1 AS id FROM part)",
    "ch AS MATERIALIZED (SELECT id AS src, CASE WHEN id % 3 = 0 THEN 0 ELSE id + 1 END AS dst FROM ids)",
    "p0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM ids) AS pr FROM ids "
    "UNION ALL SELECT 0, 0.0::DOUBLE)",
]


def _chain(final):
    rounds = []
    for i in range(1, PR_ROUNDS + 1):
        rounds += [
            f"c{i} AS MATERIALIZED (SELECT ch.dst AS id, sum(p.pr) AS pr FROM ch "
            f"JOIN p{i - 1} p ON p.id = ch.src GROUP BY ch.dst)",
            f"p{i} AS MATERIALIZED (SELECT ch.src AS id, coalesce(c.pr, 0.0) + CASE WHEN ch.src = 0 "
            f"THEN 0.0 ELSE coalesce((SELECT pr FROM c{i} WHERE id = 0), 0.0) "
            f"/ (SELECT count(*) FROM ch) END AS pr FROM ch LEFT JOIN c{i} c ON c.id = ch.src)",
        ]
    return "WITH " + ", ".join(CHAIN + rounds) + " " + final


def _pagerank(name, damping):
    rounds = [
        WEIGHTED, VERTICES,
        "o AS MATERIALIZED (SELECT v.id, coalesce(s.n, 0) AS n_out FROM v LEFT JOIN "
        "(SELECT src, count(*) AS n FROM g GROUP BY src) s ON s.src = v.id)",
        "p0 AS MATERIALIZED (SELECT id, n_out, 1.0::DOUBLE / (SELECT count(*) FROM v) AS pr FROM o)",
    ]
    for i in range(1, PR_ROUNDS + 1):
        rounds += [
            f"c{i} AS MATERIALIZED (SELECT e.dst AS id, sum(e.w * p.pr / p.n_out) AS pr "
            f"FROM e JOIN p{i - 1} p ON p.id = e.src GROUP BY e.dst)",
            f"p{i} AS MATERIALIZED (SELECT o.id, o.n_out, "
            f"(1.0::DOUBLE - {damping}) / (SELECT count(*) FROM v) + {damping}::DOUBLE * "
            f"(coalesce(c.pr, 0.0) + coalesce((SELECT sum(pr) FROM p{i - 1} WHERE n_out = 0), 0.0) "
            f"/ (SELECT count(*) FROM v)) AS pr FROM o LEFT JOIN c{i} c ON c.id = o.id)",
        ]
    return _over(name, *rounds, f"SELECT id, {_grid('pr', 'pr')} FROM p{PR_ROUNDS}")


def _restarted(name):
    """Power iteration until the damped part has no digits left."""
    rounds = [
        WEIGHTED, VERTICES,
        "o AS MATERIALIZED (SELECT v.id, coalesce(s.n, 0) AS n_out FROM v LEFT JOIN "
        "(SELECT src, count(*) AS n FROM g GROUP BY src) s ON s.src = v.id)",
        f"h AS MATERIALIZED (SELECT id, n_out, CASE WHEN id IN ({', '.join(map(str, RESTART))}) THEN 1.0::DOUBLE / "
        f"(SELECT count(*) FROM v WHERE id IN ({', '.join(map(str, RESTART))})) ELSE 0.0 END AS home FROM o)",
        "p0 AS MATERIALIZED (SELECT id, n_out, home, home AS pr FROM h)",
    ]
    last = 32
    for i in range(1, last + 1):
        rounds += [
            f"c{i} AS MATERIALIZED (SELECT e.dst AS id, sum(e.w * p.pr / p.n_out) AS pr "
            f"FROM e JOIN p{i - 1} p ON p.id = e.src GROUP BY e.dst)",
            f"p{i} AS MATERIALIZED (SELECT h.id, h.n_out, h.home, (1.0::DOUBLE - {RESTART_DAMPING}) * h.home + "
            f"{RESTART_DAMPING}::DOUBLE * (coalesce(c.pr, 0.0) + h.home * coalesce("
            f"(SELECT sum(pr) FROM p{i - 1} WHERE n_out = 0), 0.0)) AS pr FROM h LEFT JOIN c{i} c ON c.id = h.id)",
        ]
    return _over(name, *rounds, f"SELECT id, {_grid('pr', 'pr', 18)} FROM p{last}")


SEEDS = (
    f"k1 AS MATERIALIZED (SELECT DISTINCT lo + (hi - lo) * i // {K - 1} AS centroid FROM "
    f"(SELECT min(n) AS lo, max(n) AS hi FROM c), range({K}) t(i))"
)


def _near(table, centroids, columns):
    return (
        f"SELECT {columns}, min({{'d': abs(n - k.centroid), 'c': k.centroid}}).c AS old "
        f"FROM {table}, {centroids} k GROUP BY {columns}"
    )


def _kmeans(final, passes=MAX_PASSES):
    expressions = [COUNTS, "h AS MATERIALIZED (SELECT n, count(*) AS users FROM c GROUP BY n)", SEEDS]
    for i in range(1, passes + 1):
        expressions += [
            f"a{i} AS MATERIALIZED ({_near('h', f'k{i}', 'n, users')})",
            f"s{i} AS MATERIALIZED (SELECT old, CAST(sum(n * users) // sum(users) AS BIGINT) AS centroid, "
            f"CAST(sum(users) AS BIGINT) AS members, sum((n - old) * (n - old) * users) AS sse "
            f"FROM a{i} GROUP BY old)",
            f"k{i + 1} AS MATERIALIZED (SELECT DISTINCT centroid FROM s{i})",
        ]
    trace = " UNION ALL ".join(
        f"SELECT {i} AS pass, sum(sse) AS sse, count(*) FILTER (WHERE old <> centroid) AS changed FROM s{i}"
        for i in range(1, passes + 1)
    )
    expressions.append(f"t AS MATERIALIZED ({trace})")
    return _over("purchases", *expressions, final)


MEMBERS = (
    f"SELECT x.id, x.n, s.centroid FROM ({_near('c', f'k{MAX_PASSES}', 'id, n')}) x "
    f"JOIN s{MAX_PASSES} s ON s.old = x.old"
)


def _separated():
    pieces = {"comma": "','", "dash": "'-'", "tab": "chr(9)", "none": "''"}
    return " UNION ALL ".join(
        f"SELECT id || {piece} || n AS line, '{name}' AS tag, 1 AS one FROM c"
        for name, piece in pieces.items()
    )


def _bag(columns, table):
    return f"SELECT {columns}, count(*) AS n FROM {table} GROUP BY {columns}"


def _start(source):
    return (
        f"CASE WHEN src = {source} THEN 0 END AS d{SOURCES.index(source) + 1}, "
        f"src = {source} AS active{SOURCES.index(source) + 1}"
    )


def _first_hop():
    columns = ", ".join(f"d_{s}" for s in SOURCES)
    start = ", ".join(f"CASE WHEN id = {s} THEN 0 END AS d_{s}" for s in SOURCES)
    hop = ", ".join(f"d_{s} + 1" for s in SOURCES)
    return _over(
        "purchases", VERTICES,
        f"st AS MATERIALIZED (SELECT id, {start} FROM v)",
        f"m AS (SELECT id, {columns} FROM st UNION ALL SELECT g.dst, {hop} FROM g JOIN st ON st.id = g.src)",
        _bag(f"id, {columns}", "m"),
    )


def _successor():
    return _over(
        "purchases",
        "s AS MATERIALIZED (SELECT src AS id, max(dst) AS next FROM g GROUP BY src)",
        "x AS (SELECT g.src, a.next, b.next AS next2 FROM g LEFT JOIN s a ON a.id = g.dst "
        "LEFT JOIN s b ON b.id = a.next)",
        "t AS (SELECT count(*) FILTER (WHERE next IS NULL) AS dead_end, "
        "count(*) FILTER (WHERE next2 = src) AS closed FROM x)",
        "SELECT dead_end + closed AS kept, dead_end, closed, (dead_end + closed) // 3 AS triangles FROM t",
    )


def oracle_sql():
    distances = ", ".join(f"min(dist) FILTER (WHERE source = {s}) AS d_{s}" for s in SOURCES)
    sql = {
        "scan_edges_csv": _over("purchases", _bag("src, dst", "g")),
        "scan_edges_text": _over("supplies", _bag("src, dst", "g")),
        "scan_nodes_text": "SELECT o_orderkey AS id, count(*) AS n FROM orders GROUP BY o_orderkey",
        "tagged_inputs": _over(
            "purchases",
            "u AS (SELECT o_orderkey AS id, 'node' AS tag FROM orders UNION ALL SELECT dst, 'edge' FROM g)",
            _bag("id, tag", "u"),
        ),
        "scan_centroid_seeds": _over(
            "purchases", COUNTS, SEEDS,
            "SELECT centroid FROM k1 UNION ALL SELECT centroid + 1 FROM k1",
        ),
        "roundtrip_tsv_counts": _over("purchases", COUNTS, "SELECT id, n FROM c"),
        "adjacency_text_roundtrip": _over(
            "purchases", WEIGHTED,
            "SELECT src AS id, string_agg(dst::VARCHAR, ',' ORDER BY dst) AS nbrs, "
            + ", ".join(_start(s) for s in SOURCES) + " FROM e GROUP BY src",
        ),
        "chain_graph_edges": "WITH " + ", ".join(CHAIN) + " SELECT src, dst FROM ch",
        "chain_graph_ranks": "WITH " + ", ".join(CHAIN) + f" SELECT id, {_grid('pr', 'pr')} FROM p0",
        "sink_tuple_text": _over("purchases", COUNTS, "SELECT '(' || id || ',' || n || ')' AS line FROM c"),
        "sink_delimited_text": _over("purchases", COUNTS, f"l AS ({_separated()})", _bag("line, tag", "l")),
        "sink_named_outputs": _kmeans(
            f"SELECT line, tag, count(*) AS n FROM (SELECT centroid::VARCHAR AS line, 'centroid' AS tag "
            f"FROM s{MAX_PASSES} UNION ALL SELECT centroid || chr(9) || n, 'cluster' FROM ({MEMBERS})) "
            "GROUP BY line, tag"
        ),
        "sink_summary_line": "SELECT 'Number of triangles :' || triangles AS line FROM ("
        + _triangles("supplies") + ")",
        "filter_max_id": _over(
            "purchases", _bag("src, dst", f"(SELECT * FROM g WHERE src < {MAX_ID} AND dst < {MAX_ID})")
        ),
        "reverse_edges": _over("purchases", _bag("src, dst", "(SELECT dst AS src, src AS dst FROM g)")),
        "edge_endpoints": _over(
            "purchases",
            "u AS (SELECT src AS id, dst AS other, 'out' AS dir FROM g UNION ALL SELECT dst, src, 'in' FROM g)",
            _bag("id, other, dir", "u"),
        ),
        "distinct_sources": _over("purchases", "SELECT DISTINCT src AS id FROM g"),
        "expand_neighbours": _first_hop(),
        "adjacency_lists": _adjacency(),
        "in_out_neighbour_lists": _in_out(),
        "follower_count": _over("purchases", COUNTS, "SELECT id, n FROM c"),
        "follower_count_grouped": _over("purchases", COUNTS, "SELECT id, n FROM c"),
        "follower_count_all": _over(
            "purchases",
            "u AS (SELECT o_orderkey AS id, 0 AS one FROM orders UNION ALL SELECT dst, 1 FROM g)",
            "SELECT id, CAST(sum(one) AS BIGINT) AS n FROM u GROUP BY id",
        ),
        "degree_histogram": _over("purchases", COUNTS, "SELECT n, count(*) AS users FROM c GROUP BY n"),
        "two_path_cardinality": _over(
            "purchases", f"SELECT {_text('count(*)', 'two_paths')} FROM g a JOIN g b ON a.dst = b.src"
        ),
        "two_paths": _over(
            "purchases",
            f"SELECT a.src AS f1, b.dst AS u2, {_text('count(*)', 'n')} "
            "FROM g a JOIN g b ON a.dst = b.src GROUP BY a.src, b.dst",
        ),
        "triangle_rows": _over(
            "supplies", WEIGHTED, CLOSED,
            f"SELECT f1, u2, u2 AS f3, f1 AS u3, {_text(f'sum({WALKS})', 'n')} FROM closed GROUP BY f1, u2",
        ),
        "triangle_count_max_id": _triangles("purchases", f"src < {MAX_ID} AND dst < {MAX_ID}"),
        "closed_two_paths_semi": _over(
            "supplies",
            "p AS (SELECT a.src AS f1, b.dst AS u2, count(*) AS n FROM g a JOIN g b ON a.dst = b.src "
            "GROUP BY a.src, b.dst)",
            "t AS (SELECT coalesce(sum(n), 0) AS n FROM p WHERE EXISTS "
            "(SELECT 1 FROM g WHERE g.src = p.u2 AND g.dst = p.f1))",
            f"SELECT {_text('n', 'two_paths_closed')}, {_text('n // 3', 'triangles')} FROM t",
        ),
        "successor_lookup": _successor(),
        "two_path_metrics": _over(
            "supplies", WEIGHTED, CLOSED, VERTICES,
            f"SELECT (SELECT CAST(count(*) AS VARCHAR) FROM g a JOIN g b ON a.dst = b.src) AS two_paths, "
            f"(SELECT count(*) FROM v) AS vertices, {_text(f'sum({WALKS})', 'closed')} FROM closed",
        ),
        "rank_contributions": _chain(f"SELECT id, {_grid('pr', 'pr')} FROM c1"),
        "left_outer_default_zero": _chain(
            f"SELECT ch.src AS id, {_grid('coalesce(c.pr, 0.0)', 'pr')} FROM ch LEFT JOIN c1 c ON c.id = ch.src"
        ),
        "pagerank_chain": _chain(f"SELECT id, {_grid('pr', 'pr')} FROM p{PR_ROUNDS}"),
        "pagerank_chain_trace": _chain(
            " UNION ALL ".join(
                f"SELECT {i} AS round, {_grid('sum(pr)', 'total', 30)} FROM p{i}"
                for i in range(1, PR_ROUNDS + 1)
            )
        ),
        "pagerank_chain_top100": _chain(
            f"SELECT id, {_grid('pr', 'pr')} FROM p{PR_ROUNDS} ORDER BY 2 DESC, id LIMIT 100"
        ),
        "pagerank_edges": _pagerank("purchases", 1.0),
        "pagerank_edges_damped": _pagerank("supplies", DAMPING),
        "pagerank_residual": _restarted("supplies"),
        "bfs_distances": _bfs("SELECT source, id, dist FROM dist"),
        "bfs_distances_wide": _bfs(
            f"SELECT id, {distances} FROM "
            "(SELECT v.id, dist.source, dist.dist FROM v LEFT JOIN dist ON dist.id = v.id) GROUP BY id"
        ),
        "eccentricity": _bfs("SELECT source, max(dist) AS dist FROM dist GROUP BY source"),
        "diameter_estimate": _bfs("SELECT max(dist) AS diameter FROM dist"),
        "farthest_vertex": _bfs(
            "SELECT source, min(id) AS id, dist FROM dist d WHERE dist = "
            "(SELECT max(dist) FROM dist m WHERE m.source = d.source) GROUP BY source, dist"
        ),
        "many_source_distances": _many("SELECT source, id, dist FROM r"),
        "neighbourhood_sizes": _many("SELECT source, dist, n FROM c"),
        "closeness_centrality": _many(
            "SELECT source, CAST(coalesce(sum(n) FILTER (WHERE dist > 0), 0) AS BIGINT) AS reached, "
            "CAST(coalesce(sum(n * dist), 0) AS BIGINT) AS farness, "
            "coalesce(sum(n) FILTER (WHERE dist > 0) / nullif(sum(n * dist), 0)::DOUBLE, 0.0::DOUBLE) AS closeness "
            "FROM c GROUP BY source"
        ),
        "exact_extent": _extent(),
        "kmeans_seeds": _over("purchases", COUNTS, SEEDS, "SELECT centroid FROM k1"),
        "kmeans_assign": _over(
            "purchases", COUNTS, SEEDS,
            f"SELECT id, n, old AS centroid FROM ({_near('c', 'k1', 'id, n')})",
        ),
        "kmeans_pass_stats": _kmeans(f"SELECT old, centroid, members, {_text('sse', 'sse')} FROM s1", 1),
        "kmeans_centroids": _kmeans(
            f"SELECT old, centroid, members, {_text('sse', 'sse')} FROM s{MAX_PASSES}"
        ),
        "kmeans_sse_trace": _kmeans(
            f"SELECT pass, {_text('sse', 'sse')}, changed FROM t WHERE pass <= coalesce("
            f"(SELECT min(pass) FROM t WHERE pass > 1 AND changed = 0), {MAX_PASSES})"
        ),
        "kmeans_members": _kmeans(MEMBERS),
    }
    for strategy in ("auto", "broadcast", "shuffle_merge", "shuffle_hash", "preagg"):
        sql[f"triangle_count_{strategy}"] = _triangles("supplies")
    return sql
