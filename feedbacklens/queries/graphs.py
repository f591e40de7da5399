"""Queries over concept similarity: pairs, duplicates, graph, communities, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, moves, similarity
from . import fixtures as X

QUERIES = {}
ORACLE = {}

THRESHOLD = 0.3
MAX_CONCEPTS = 5


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def concepts(spark, sf):
    """Embeddings as concept vectors; length is that of the document with the same id."""
    lengths = X.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    return (
        X.table(spark, sf, "embeddings")
        .select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
        .join(lengths, "id", "left")
        .withColumn("length", F.coalesce("n_chars", "id")).drop("n_chars")
    )


def edges(spark, sf):
    from ..session import cut

    return cut(similarity.nearest_neighbour_graph(concepts(spark, sf)))


SIM_SQL = """
item AS (SELECT e.label, e.vec_id AS id, CAST(e.embedding AS DOUBLE[]) AS vec,
                coalesce(d.n_chars, e.vec_id) AS length
         FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id),
cell AS (SELECT a.label, a.id AS i, b.id AS j, a.length AS li, b.length AS lj,
                CASE WHEN a.id = b.id THEN 0.0
                     ELSE round(list_cosine_similarity(a.vec, b.vec), 9) END AS cs
         FROM item a JOIN item b ON a.label = b.label)"""


@query(f"WITH {SIM_SQL} SELECT label, i, j, round(cs, 6) AS cs FROM cell WHERE i <> j AND cs > {THRESHOLD}")
def similar_pairs(spark, sf):
    return similarity.similar_pairs(concepts(spark, sf), THRESHOLD).withColumn(
        "cs", F.round("cs", 6))


def _dedupe_sql(tie: str) -> str:
    return f"""WITH {SIM_SQL} SELECT label, id, length FROM item WHERE id NOT IN (
  SELECT i FROM cell WHERE i <> j AND cs > {THRESHOLD} AND (li < lj OR (li = lj AND {tie})))"""


@query(_dedupe_sql("j < i"))
def dedupe_first(spark, sf):
    return similarity.dedupe_concepts(concepts(spark, sf), THRESHOLD).drop("vec")


@query(_dedupe_sql("true"))
def dedupe_both(spark, sf):
    return similarity.dedupe_concepts(concepts(spark, sf), THRESHOLD, tie="both").drop("vec")


GRAPH_SQL = SIM_SQL + """,
middle AS (SELECT label, median(cs) AS m FROM cell GROUP BY label),
best AS (SELECT label, i, max(cs) AS score FROM cell GROUP BY label, i),
edge AS (
  SELECT b.label, b.i AS src, min(c.j) AS dst, b.score
  FROM best b JOIN middle m ON m.label = b.label AND b.score >= m.m
  JOIN cell c ON c.label = b.label AND c.i = b.i AND c.cs = b.score
  GROUP BY b.label, b.i, b.score)"""


@query(f"WITH {GRAPH_SQL} SELECT label, src, dst, round(score, 6) AS score FROM edge")
def nn_graph(spark, sf):
    return edges(spark, sf).withColumn("score", F.round("score", 6))


@query(f"""WITH {GRAPH_SQL} SELECT label, dst, count(*) AS sources, round(sum(score), 6) AS total,
       arg_max(src, struct_pack(s := score, n := -src)) AS strongest FROM edge GROUP BY label, dst""")
def neighbour_indegree(spark, sf):
    return similarity.in_degree(edges(spark, sf)).withColumn("total", F.round("total", 6))


PART_SQL = GRAPH_SQL + """,
node AS (SELECT label, src AS node FROM edge UNION SELECT label, dst FROM edge),
link AS (SELECT label, src AS a, dst AS b FROM edge UNION SELECT label, dst, src FROM edge),
reach AS (SELECT label, node, node AS root FROM node
          UNION SELECT r.label, l.b, r.root FROM reach r JOIN link l ON l.label = r.label AND l.a = r.node),
part AS (SELECT label, node, min(root) AS component FROM reach GROUP BY label, node)"""


@query(f"WITH RECURSIVE {PART_SQL} SELECT label, node, component FROM part")
def components(spark, sf):
    return graph.components(edges(spark, sf))


LEVELS = 5  # more than the data need; a level that moves nothing changes nothing
_HASH = f"(({{}} % {moves.NODES}) * {moves.SPREAD} + {{}}) % {moves.RANGE}"
_HIGH = f"[{_HASH.format('{0}', 0)}, {{0}}]"


def _pressed(rows: str) -> str:
    return f"""
  SELECT r.*, t.sum_to, t.lead_to, h.sum_home, h.lead_home, r.degree * (t.sum_to + h.sum_home - 2 * r.degree) AS pressure
  FROM {rows} r
  JOIN (SELECT label, too, sum(degree)::HUGEINT AS sum_to, arg_max(node, struct_pack(g := gain, n := -node)) AS lead_to
        FROM {rows} GROUP BY ALL) t ON t.label = r.label AND t.too = r.too
  JOIN (SELECT label, home, sum(degree)::HUGEINT AS sum_home, arg_max(node, struct_pack(g := gain, n := -node)) AS lead_home
        FROM {rows} GROUP BY ALL) h ON h.label = r.label AND h.home = r.home"""


def _level_sql(k: int) -> str:
    """One level: colours, then steps (sweep by sweep, colour by colour), then the next level's graph."""
    return f""",
colour{k}(label, node, colour) AS (
  SELECT label, node, NULL::BIGINT FROM node{k}
  UNION ALL
  SELECT x.label, x.node, CASE WHEN x.colour IS NOT NULL THEN x.colour WHEN coalesce(s.waits, false) THEN NULL
    ELSE list_min(list_filter(range(0, len(coalesce(s.taken, [])) + 1), lambda c: NOT list_contains(coalesce(s.taken, []), c))) END
  FROM colour{k} x LEFT JOIN (
    SELECT l.label, l.a, bool_or(y.colour IS NULL AND {_HIGH.format("y.node")} > {_HIGH.format("l.a")}) AS waits,
           list(DISTINCT y.colour) FILTER (WHERE y.colour IS NOT NULL) AS taken
    FROM both{k} l JOIN colour{k} y ON y.label = l.label AND y.node = l.b GROUP BY ALL) s
    ON s.label = x.label AND s.a = x.node
  WHERE x.colour IS NULL OR EXISTS (SELECT 1 FROM colour{k} WHERE colour IS NULL)),
painted{k} AS MATERIALIZED (
  SELECT n.*, max(c.colour) AS colour, max(max(c.colour)) OVER () + 1 AS colours
  FROM node{k} n JOIN colour{k} c ON c.label = n.label AND c.node = n.node GROUP BY ALL),
step{k}(label, node, degree, total, colour, colours, home, t, idle) AS (
  SELECT label, node, degree, total, colour, colours, node, 0::BIGINT, 0::BIGINT FROM painted{k}
  UNION ALL (
  WITH mass AS (SELECT label, home, sum(degree)::HUGEINT AS mass FROM step{k} GROUP BY ALL),
  near AS (
    SELECT x.label, x.node, x.degree, x.total, x.home, y.home AS too, x.t, x.colours, sum(l.weight)::HUGEINT AS near
    FROM step{k} x JOIN both{k} l ON l.label = x.label AND l.a = x.node AND x.colour = x.t % x.colours
    JOIN step{k} y ON y.label = l.label AND y.node = l.b GROUP BY ALL),
  gained AS (
    SELECT n.*, n.total * (n.near - coalesce(o.near, 0)) - n.degree * (m.mass - h.mass + n.degree) AS gain
    FROM near n LEFT JOIN near o ON o.label = n.label AND o.node = n.node AND o.too = o.home
    JOIN mass m ON m.label = n.label AND m.home = n.too JOIN mass h ON h.label = n.label AND h.home = n.home
    WHERE n.too <> n.home),
  wish AS (SELECT * FROM gained WHERE gain > 0
           QUALIFY row_number() OVER (PARTITION BY label, node ORDER BY gain DESC, too) = 1),
  pressed AS ({_pressed("wish")}),
  drawn AS (
    SELECT label, node, degree, home, too, gain, lead_to = node AND lead_home = node AS leads FROM pressed
    WHERE (lead_to = node AND lead_home = node) OR
      {_HASH.format("node", f"40503 * (t // colours + 1) + {9176 * k}")} * (least(pressure // gain, {moves.CROWD}) + 1) < {moves.RANGE}),
  again AS ({_pressed("drawn")}),
  let AS (SELECT label, node, too FROM again WHERE leads OR gain > pressure)
  SELECT s.label, s.node, s.degree, s.total, s.colour, s.colours, coalesce(l.too, s.home), s.t + 1,
         CASE WHEN EXISTS (SELECT 1 FROM let) THEN 0 ELSE s.idle + 1 END
  FROM step{k} s LEFT JOIN let l ON l.label = s.label AND l.node = s.node WHERE s.idle < s.colours AND s.t < {moves.SWEEPS} * s.colours)),
moved{k} AS MATERIALIZED (SELECT label, node, degree, total, home FROM step{k} WHERE t = (SELECT max(t) FROM step{k})),
place{k + 1} AS MATERIALIZED (
  SELECT p.label, p.node, m.home FROM place{k} p JOIN moved{k} m ON m.label = p.label AND m.node = p.home),
node{k + 1} AS MATERIALIZED (
  SELECT label, home AS node, sum(degree)::HUGEINT AS degree, any_value(total) AS total FROM moved{k} GROUP BY label, home),
both{k + 1} AS MATERIALIZED (
  SELECT b.label, x.home AS a, y.home AS b, sum(b.weight)::HUGEINT AS weight FROM both{k} b
  JOIN moved{k} x ON x.label = b.label AND x.node = b.a JOIN moved{k} y ON y.label = b.label AND y.node = b.b
  WHERE x.home <> y.home GROUP BY ALL)"""


MOVE_SQL = GRAPH_SQL + f""",
link AS (
  SELECT label, a, b, weight FROM (
    SELECT label, least(src, dst) AS a, greatest(src, dst) AS b, CAST(round(max(score) * {moves.WEIGHT}) AS HUGEINT) AS weight
    FROM edge WHERE score > 0 AND src <> dst GROUP BY ALL) WHERE weight > 0),
both0 AS MATERIALIZED (SELECT * FROM link UNION ALL SELECT label, b, a, weight FROM link),
node0 AS MATERIALIZED (
  SELECT label, a AS node, sum(weight)::HUGEINT AS degree, (sum(sum(weight)) OVER (PARTITION BY label))::HUGEINT AS total
  FROM both0 GROUP BY label, a),
place0 AS (SELECT label, node, node AS home FROM node0)""" + "".join(map(_level_sql, range(LEVELS))) + f""",
placed AS (
  SELECT n.label, n.node, coalesce(h.home, n.node) AS home
  FROM (SELECT label, src AS node FROM edge UNION SELECT label, dst FROM edge) n
  LEFT JOIN place{LEVELS} h ON h.label = n.label AND h.node = n.node)"""


@query(f"""WITH RECURSIVE {MOVE_SQL}
SELECT label, node, min(node) OVER (PARTITION BY label, home) AS community FROM placed""")
def communities(spark, sf):
    return graph.communities(edges(spark, sf))


NUDGE = 1e-9  # many ranks are short decimals that end in 5: so that all of them are rounded up


def shown(name):
    return F.round(F.col(name) + NUDGE, 6)


STEPS = 250  # what a longer iteration could change is below 0.85 ** 250 of the mass
RANKS = f""",
inner_edge AS (SELECT e.label, p.component AS community, e.src, e.dst, e.score FROM edge e
  JOIN part p ON p.label = e.label AND p.node = e.src
  JOIN part q ON q.label = e.label AND q.node = e.dst AND q.component = p.component WHERE e.src <> e.dst),
vertex AS MATERIALIZED (SELECT label, community, node, count(*) OVER (PARTITION BY label, community) AS n,
                  node NOT IN (SELECT src FROM inner_edge i WHERE i.label = v.label AND score > 0) AS dangling
  FROM (SELECT label, community, src AS node FROM inner_edge
        UNION SELECT label, community, dst FROM inner_edge) v),
walk(label, community, node, n, dangling, rank, step) AS (
  SELECT label, community, node, n, dangling, 1.0::DOUBLE / n, 0 FROM vertex
  UNION ALL
  SELECT v.label, v.community, v.node, v.n, v.dangling,
         0.85::DOUBLE * (coalesce(f.flow, 0) + d.loose / v.n) + (1.0::DOUBLE - 0.85) / v.n, v.step + 1
  FROM walk v
  JOIN (SELECT label, community, sum(CASE WHEN dangling THEN rank ELSE 0 END) AS loose
        FROM walk GROUP BY label, community) d
    ON d.label = v.label AND d.community = v.community
  LEFT JOIN (SELECT e.label, e.community, e.dst, sum(r.rank) AS flow FROM inner_edge e
             JOIN walk r ON r.label = e.label AND r.community = e.community AND r.node = e.src
             WHERE e.score > 0 GROUP BY e.label, e.community, e.dst) f
    ON f.label = v.label AND f.community = v.community AND f.dst = v.node
  WHERE v.step < {STEPS}),
ranked AS MATERIALIZED (SELECT label, community, node, rank FROM walk WHERE step = {STEPS})"""
RANK_SQL = PART_SQL + RANKS


@query(f"WITH RECURSIVE {RANK_SQL} SELECT label, community, node, round(rank + {NUDGE}, 6) AS rank FROM ranked")
def pagerank(spark, sf):
    found = edges(spark, sf)
    members = graph.communities(found, method="components")
    return graph.pagerank(graph.inner_edges(found, members)).withColumn("rank", shown("rank"))


CHOICE = f""",
community AS (SELECT label, component AS community, count(*) AS size, min(node) AS first
              FROM part GROUP BY label, component),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY size DESC, community) AS place
         FROM community) WHERE place <= {MAX_CONCEPTS}),
top AS (SELECT label, community,
               arg_max(struct_pack(node := node, rank := rank), struct_pack(r := round(rank + 1e-12, 9), n := -node)) AS t
        FROM ranked GROUP BY label, community),
scored AS (SELECT k.label, k.community, k.size, coalesce(t.t.node, k.first) AS node,
                  coalesce(t.t.rank, 1.0) AS rank
           FROM kept k LEFT JOIN top t ON t.label = k.label AND t.community = k.community)
SELECT label, community, size, node, round(rank + {NUDGE}, 6) AS rank,
       round((size + rank) / max(size + rank) OVER (PARTITION BY label) + {NUDGE}, 6) AS score FROM scored"""


@query(f"WITH RECURSIVE {RANK_SQL}{CHOICE}")
def ranked_concepts(spark, sf):
    chosen = graph.rank_concepts(edges(spark, sf), MAX_CONCEPTS, method="components")
    return chosen.withColumn("rank", shown("rank")).withColumn("score", shown("score"))


@query(f"""WITH RECURSIVE {MOVE_SQL},
part AS (SELECT label, node, min(node) OVER (PARTITION BY label, home) AS component FROM placed)
{RANKS}{CHOICE}""")
def ranked_communities(spark, sf):
    chosen = graph.rank_concepts(edges(spark, sf), MAX_CONCEPTS)
    return chosen.withColumn("rank", shown("rank")).withColumn("score", shown("score"))
