"""A decision tree grown and walked in DuckDB SQL, for the checks: no value comes from the Spark side."""

from __future__ import annotations

from corpusloom.functions import vocab
from corpusloom.operators.features import TOKEN_FEATURES
from corpusloom.operators.trees import MAX_BINS, WEIGHT_UNIT
from corpusloom.plans.token_sql import listed

CLASSES = range(len(vocab.SPAN_LABELS))


def _listed_features(entity: str = "is_ent") -> str:
    return ", ".join(f"{entity if c == 'is_ent' else c}::DOUBLE" for c in TOKEN_FEATURES)


def _binned(entity: str = "is_ent") -> str:
    parts = [f"len([x FOR x IN e[{i}] IF x < {entity if c == 'is_ent' else c}])" for i, c in enumerate(TOKEN_FEATURES, 1)]
    return f"[{', '.join(parts)}]"


def _quality(name: str) -> str:
    squares = " + ".join(f"{name}{c} * {name}{c}" for c in CLASSES)
    return f"coalesce(({squares}) / nullif({' + '.join(f'{name}{c}' for c in CLASSES)}, 0), 0)"


def tree_sql(depth: int, leaf: int, balance: int) -> str:
    """CTEs from ``feats`` to ``parted`` (tokens with their part and bins) and ``predicted`` (bins and the code of their label).

    The levels follow each other as queries: sums of weights by node, feature, bin and class, running
    sums over bins, the purest split of every node, and the rows below it.
    """
    kinds = ", ".join(f"sum(s) FILTER (y = {c}) AS a{c}" for c in CLASSES)
    sums = ", ".join(f"coalesce(a{c}, 0) AS a{c}" for c in CLASSES)
    running = ", ".join(f"sum(a{c}) OVER w AS l{c}" for c in CLASSES)
    totals = ", ".join(f"sum(a{c}) OVER n AS t{c}" for c in CLASSES)
    right = ", ".join(f"t{c} - l{c} AS r{c}" for c in CLASSES)
    text = f"""
  keyed AS MATERIALIZED (SELECT *, message_id || '#' || token_idx AS token_id, CAST(is_ent = 1 AND ent_type IN ({listed(vocab.SCORING_ENTITY_TYPES)}) AS INT)
      AS scored_ent FROM feats),
  halves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY bio_enc ORDER BY md5('42|' || token_id))
      <= (count(*) OVER (PARTITION BY bio_enc) * 75 + 50) // 100 AS train FROM keyed),
  vals AS (SELECT f, v, count(*) AS n FROM (SELECT unnest(x) AS v, generate_subscripts(x, 1) AS f FROM (
      SELECT [{_listed_features()}] AS x FROM halves WHERE train)) GROUP BY ALL),
  placed AS (SELECT f, v, row_number() OVER u AS i, count(*) OVER (PARTITION BY f) AS many, sum(n) OVER (PARTITION BY f) AS every,
      sum(n) OVER u - n AS before FROM vals WINDOW u AS (PARTITION BY f ORDER BY v ROWS UNBOUNDED PRECEDING)),
  edged AS (SELECT f, max(v) AS edge FROM placed GROUP BY f, CASE WHEN many <= {MAX_BINS} THEN i ELSE before * {MAX_BINS} // every END
      QUALIFY row_number() OVER (PARTITION BY f ORDER BY max(v) DESC) > 1),
  edges AS MATERIALIZED (SELECT list(own ORDER BY f) AS e FROM (
      SELECT f, coalesce(list(edge ORDER BY edge) FILTER (edge IS NOT NULL), []) AS own
      FROM range(1, {len(TOKEN_FEATURES) + 1}) r(f) LEFT JOIN edged USING (f) GROUP BY f)),
  parted AS MATERIALIZED (SELECT message_id, token_idx, token, pos, dep, bio_enc, train, {_binned()} AS b, {_binned('scored_ent')} AS scored_b
      FROM halves, edges),
  counted AS (SELECT b, bio_enc AS y, count_if(train) AS n FROM parted GROUP BY ALL UNION ALL
      SELECT DISTINCT scored_b, 0, 0 FROM parted),
  classes AS (SELECT y, sum(n) OVER ()::DOUBLE / (count(*) OVER () * n)::DOUBLE AS w FROM (
      SELECT y, sum(n) AS n FROM counted GROUP BY y HAVING sum(n) > 0)),
  cells AS MATERIALIZED (SELECT row_number() OVER () AS id, b, y, n, n * coalesce(floor({' * '.join(['w'] * balance or ['1'])} * {WEIGHT_UNIT} + 0.5), 0) AS s
      FROM (SELECT b, y, sum(n) AS n FROM counted GROUP BY b, y) LEFT JOIN classes USING (y)),
  wide AS MATERIALIZED (SELECT id, y, n, s, unnest(b) AS b, generate_subscripts(b, 1) AS f FROM cells WHERE n > 0),
  at0 AS MATERIALIZED (SELECT id, b, 1::BIGINT AS node, true AS going FROM cells)"""
    for k in range(depth):
        text += f""",
  h{k} AS (SELECT node, f, w.b, {kinds}, sum(n) AS n FROM wide w JOIN at{k} a USING (id) WHERE going GROUP BY node, f, w.b),
  r{k} AS (SELECT node, f, b, {running}, {totals}, sum(n) OVER w AS ln, sum(n) OVER n AS tn FROM (SELECT node, f, b, n, {sums} FROM h{k})
      WINDOW w AS (PARTITION BY node, f ORDER BY b ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY node, f)),
  s{k} AS MATERIALIZED (SELECT node, f, b AS cut FROM (SELECT *, {_quality('l')} + {_quality('r')} AS score, {_quality('t')} AS base FROM (
        SELECT *, {right} FROM r{k} WHERE ln >= {leaf} AND tn - ln >= {leaf} AND ln < tn))
      WHERE score > base * (1 + 1e-12) QUALIFY row_number() OVER (PARTITION BY node ORDER BY score DESC, f, b) = 1),
  at{k + 1} AS MATERIALIZED (SELECT id, a.b, CASE WHEN cut IS NULL THEN node ELSE 2 * node + (a.b[s.f] > cut)::INT END AS node,
      going AND cut IS NOT NULL AS going FROM at{k} a LEFT JOIN s{k} s USING (node))"""
    return text + f""",
  leaves AS (SELECT node, y FROM (SELECT node, y, sum(s) AS s FROM cells JOIN at{depth} USING (id) WHERE n > 0 GROUP BY node, y)
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY s DESC, y) = 1),
  predicted AS MATERIALIZED (SELECT DISTINCT a.b, y AS p FROM at{depth} a JOIN leaves USING (node))"""
