"""Plain SQL for the registered queries, for checking them in another engine."""

from __future__ import annotations

from bazaargraph.plans.queries import NODE, PREFIX, PRODUCT, REPLAY_AFTER, START_EDGES

EVENTS = """
ev AS (
  SELECT e.ts AS "timestamp", 'usr_' || e.user_id AS user_id, n.n_name AS user_city,
         'prod_' || e.k AS product_id, p.p_type AS product_cat,
         'sel_' || (e.k % 7) AS seller_id,
         CASE e.event_type WHEN 'view' THEN 'AIME' WHEN 'click' THEN 'VOUT'
              WHEN 'purchase' THEN 'ACHAT' ELSE e.event_type END AS action_type,
         e.value AS price,
         CAST(date_diff('day', DATE '1970-01-01', CAST(e.ts AS DATE)) AS BIGINT) AS epoch_id
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
        FROM events) e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN part p ON p.p_partkey = e.k
)"""

EDGES = (
    EVENTS
    + """,
ed AS (
  SELECT user_id AS src, product_id AS dst, action_type AS relationship, "timestamp",
         CASE WHEN action_type = 'like' THEN 0.0 ELSE price END AS price, epoch_id
  FROM ev
)"""
)


def _state(source: str) -> str:
    return f"""
  SELECT src, dst,
         CAST(count(*) FILTER (WHERE relationship = 'AIME')
            + 5 * count(*) FILTER (WHERE relationship = 'VOUT')
            + 20 * count(*) FILTER (WHERE relationship = 'ACHAT') AS DOUBLE) AS score,
         max("timestamp") AS last_interaction,
         count(*) FILTER (WHERE relationship = 'AIME') AS "AIME",
         count(*) FILTER (WHERE relationship = 'VOUT') AS "VOUT",
         count(*) FILTER (WHERE relationship = 'ACHAT') AS "ACHAT"
  FROM {source}
  WHERE relationship IN ('AIME', 'VOUT', 'ACHAT')
  GROUP BY src, dst"""


VERTICES = """,
vt AS (
  SELECT id, CASE min(r) WHEN 0 THEN 'USER' WHEN 1 THEN 'PROD' ELSE 'SEL' END AS type
  FROM (SELECT user_id AS id, 0 AS r FROM ev
        UNION ALL SELECT product_id, 1 FROM ev
        UNION ALL SELECT seller_id, 2 FROM ev)
  GROUP BY id
)"""

GRAPH = EDGES + f",\nst AS ({_state('ed')})" + VERTICES

STRONGEST = "score DESC, last_interaction DESC NULLS LAST, src, dst"

WEAKEST = "score, src, dst"

BEST = f",\nbest AS (SELECT * FROM st ORDER BY {STRONGEST} LIMIT 100)"

ENDS = ",\nbest_ids AS (SELECT src AS id FROM best UNION SELECT dst FROM best)"

BEST_IDS = BEST + ENDS

START_IDS = (
    f",\nbest AS (SELECT * FROM st ORDER BY {STRONGEST} LIMIT {START_EDGES})" + ENDS
)

POPULAR = """,
popular AS (
  SELECT dst AS id FROM st GROUP BY dst ORDER BY count(*) DESC, dst LIMIT 5
)"""

TOUCHES = {
    "out": "src IN (SELECT id FROM {ids})",
    "in": "dst IN (SELECT id FROM {ids})",
    "both": "(src IN (SELECT id FROM {ids}) OR dst IN (SELECT id FROM {ids}))",
}

FAR = {
    "out": "SELECT dst AS id FROM {edges}",
    "in": "SELECT src AS id FROM {edges}",
    "both": "SELECT src AS id FROM {edges} UNION SELECT dst FROM {edges}",
}


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _walk(seeds: str, hops: int, direction: str = "both", min_score: float = 0) -> str:
    """CTEs of a walk, hop by hop: ``got`` are its edges, ``seen`` all nodes it met."""
    out = f",\npool AS (SELECT * FROM st WHERE score >= {min_score})"
    out += f",\nseen0 AS ({seeds}),\nfront0 AS (SELECT id FROM seen0)"
    for h in range(hops):
        touches = TOUCHES[direction].format(ids=f"front{h}")
        far = FAR[direction].format(edges=f"inc{h}")
        out += f",\ninc{h} AS (SELECT * FROM pool WHERE {touches})"
        out += (
            f",\nfront{h + 1} AS (SELECT id FROM ({far})"
            f" WHERE id NOT IN (SELECT id FROM seen{h}))"
        )
        out += (
            f",\nseen{h + 1} AS (SELECT id FROM seen{h} UNION SELECT id FROM front{h + 1})"
        )
    edges = " UNION ".join(f"SELECT * FROM inc{h}" for h in range(hops))
    return out + f",\ngot AS ({edges}),\nseen AS (SELECT id FROM seen{hops})"


def _node(
    hops: int, direction: str = "both", min_score: float = 0, node: str = NODE
) -> str:
    seed = f"SELECT id FROM vt WHERE id = '{node}'"
    return GRAPH + _walk(seed, hops, direction, min_score)


def _ego_edges(limit: int | None = None, **walk) -> str:
    cap = "" if limit is None else f" ORDER BY {STRONGEST} LIMIT {limit}"
    return _with(_node(**walk), f"SELECT * FROM got{cap}")


def _ego_vertices(**walk) -> str:
    return _with(_node(**walk), "SELECT * FROM vt WHERE id IN (SELECT id FROM seen)")


def _context(
    hops: int,
    limit: int | None = None,
    min_score: float = 0,
    first: str = STRONGEST,
) -> str:
    """``ctx``: what is kept around the first edge of an order."""
    chosen = f",\nchosen AS (SELECT * FROM st ORDER BY {first} LIMIT 1)"
    seeds = "SELECT src AS id FROM chosen UNION SELECT dst FROM chosen"
    cap = "" if limit is None else f" ORDER BY pin DESC, {STRONGEST} LIMIT {limit}"
    kept = f""",
merged AS (SELECT * FROM got UNION SELECT * FROM chosen),
ranked AS (
  SELECT m.*, CASE WHEN m.src = c.src AND m.dst = c.dst THEN 1 ELSE 0 END AS pin
  FROM merged m, chosen c
),
ctx AS (SELECT * FROM ranked{cap})"""
    return GRAPH + chosen + _walk(seeds, hops, "both", min_score) + kept


CONTEXT_EDGES = (
    'SELECT src, dst, score, last_interaction, "AIME", "VOUT", "ACHAT" FROM ctx'
)
CONTEXT_VERTICES = (
    "SELECT * FROM vt WHERE id IN (SELECT src FROM ctx UNION SELECT dst FROM ctx)"
)

# One hop around every vertex: each edge belongs to both of its ends.
EACH_NODE = """,
each AS (
  SELECT v.id AS seed_id, s.* FROM vt v JOIN st s ON s.src = v.id
  UNION
  SELECT v.id AS seed_id, s.* FROM vt v JOIN st s ON s.dst = v.id
)"""

# Two hops around each popular product.
# Edges at a seed's neighbours. The best one of those at a node is enough, as any of a seed's
# best edges is the best one of the neighbour where it lies.
EACH_NODE_TWICE = f""",
near AS (
  SELECT seed_id, src AS id FROM each UNION SELECT seed_id, dst FROM each
  UNION SELECT id, id FROM vt),
strongest AS (
  SELECT seed_id AS id, src, dst FROM each
  QUALIFY row_number() OVER (PARTITION BY seed_id ORDER BY {STRONGEST}) = 1),
twice AS (
  SELECT DISTINCT n.seed_id, s.* FROM near n JOIN strongest b USING (id)
  JOIN st s ON s.src = b.src AND s.dst = b.dst)"""

EACH_POPULAR = """,
hop1 AS (
  SELECT p.id AS seed_id, s.src, s.dst FROM popular p JOIN st s ON p.id IN (s.src, s.dst)
),
near AS (
  SELECT id AS seed_id, id FROM popular
  UNION SELECT seed_id, src FROM hop1 UNION SELECT seed_id, dst FROM hop1
),
each AS (
  SELECT n.seed_id, s.* FROM near n JOIN st s ON s.src = n.id
  UNION
  SELECT n.seed_id, s.* FROM near n JOIN st s ON s.dst = n.id
)"""

MIX = """
  count(*) AS nb_events,
  count(*) FILTER (WHERE action_type = 'AIME') AS "nb_AIME",
  count(*) FILTER (WHERE action_type = 'VOUT') AS "nb_VOUT",
  count(*) FILTER (WHERE action_type = 'ACHAT') AS "nb_ACHAT",
  count(*) FILTER (WHERE action_type = 'AIME') / greatest(count(*), 1) AS "share_AIME",
  count(*) FILTER (WHERE action_type = 'VOUT') / greatest(count(*), 1) AS "share_VOUT",
  count(*) FILTER (WHERE action_type = 'ACHAT') / greatest(count(*), 1) AS "share_ACHAT",
  100 * count(*) FILTER (WHERE action_type = 'ACHAT') / greatest(count(*), 1)
    AS conversion_rate
FROM ev"""


def _windows(unit: str) -> str:
    return _with(
        EVENTS,
        f"""SELECT date_trunc('{unit}', "timestamp") AS window_start,
  date_trunc('{unit}', "timestamp") + INTERVAL 1 {unit} AS window_end,
  action_type, count(*) AS nb_events,
  CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS chiffre_affaires
FROM ev WHERE "timestamp" IS NOT NULL GROUP BY ALL""",
    )


ISO = "'%Y-%m-%dT%H:%M:%S.%f'"


def _event_json(seller: str = "seller_id", time: str | None = None) -> str:
    """Event as JSON text; NULL fields are left out."""
    time = time or f"strftime(\"timestamp\", {ISO}) || 'Z'"
    fields = [
        f"""'"timestamp":"' || {time} || '"'""",
        """'"user_id":"' || user_id || '"'""",
        """'"product_id":"' || product_id || '"'""",
        f"""'"seller_id":"' || {seller} || '"'""",
        """'"action_type":"' || action_type || '"'""",
        """'"price":' || CAST(price AS VARCHAR)""",
    ]
    return "'{' || concat_ws(',', " + ", ".join(fields) + ") || '}'"


MIXED = (
    EVENTS
    + f""",
sent AS (
  SELECT {_event_json(
      seller="CASE WHEN action_type <> 'error' THEN seller_id END",
      time="CASE WHEN action_type = 'signup' THEN 'soon'"
           f" ELSE strftime(\"timestamp\", {ISO}) || 'Z' END",
  )} AS raw,
         CASE action_type WHEN 'error' THEN 'missing_id' WHEN 'signup' THEN 'bad_timestamp'
         END AS defect
  FROM ev
)"""
)

RAW = (
    EDGES
    + """,
raw AS (
  SELECT DISTINCT src, dst, relationship,
         CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS "timestamp", epoch_id
  FROM ed
)"""
)

# The mapped action never has NULL parts, so the text can be put together directly.
EDGE_DATA = f"""'{{"src":"' || src || '","dst":"' || dst || '","score":'
  || CAST(score AS VARCHAR) || ',"last_interaction":"' || strftime(last_interaction, {ISO})
  || '","AIME":' || "AIME" || ',"VOUT":' || "VOUT" || ',"ACHAT":' || "ACHAT" || '}}'"""

STATE = _with(GRAPH, "SELECT * FROM st")
ALL_VERTICES = _with(EVENTS + VERTICES, "SELECT * FROM vt")
LAST_TYPE = """
SELECT id, arg_max(CASE r WHEN 0 THEN 'USER' WHEN 1 THEN 'PROD' ELSE 'SEL' END,
                   epoch_id * 4 - r) AS type
FROM roles GROUP BY id"""


def _incident(direction: str) -> str:
    touches = TOUCHES[direction].format(ids="best_ids")
    return _with(GRAPH + START_IDS, f"SELECT * FROM st WHERE {touches}")


def _next_frontier(direction: str) -> str:
    touches = TOUCHES[direction].format(ids="best_ids")
    incident = f",\ninc AS (SELECT * FROM st WHERE {touches})"
    far = FAR[direction].format(edges="inc")
    return _with(
        GRAPH + START_IDS + incident,
        f"SELECT DISTINCT id FROM ({far}) WHERE id NOT IN (SELECT id FROM best_ids)",
    )


ORACLE: dict[str, str] = {
    "events_decoded": _with(EVENTS, "SELECT * EXCLUDE (epoch_id) FROM ev"),
    "quarantined_messages": _with(
        MIXED,
        "SELECT raw, defect FROM sent WHERE defect IS NOT NULL"
        " UNION ALL SELECT text, 'bad_json' FROM documents",
    ),
    "accepted_messages": _with(
        EVENTS,
        """SELECT CASE WHEN action_type <> 'signup' THEN "timestamp" END AS "timestamp",
  user_id, CAST(NULL AS VARCHAR) AS user_city, product_id,
  CAST(NULL AS VARCHAR) AS product_cat, seller_id, action_type, price
FROM ev WHERE action_type <> 'error'""",
    ),
    "graph_vertices": ALL_VERTICES,
    "graph_edges": _with(EDGES, "SELECT * EXCLUDE (epoch_id) FROM ed"),
    "graph_edges_free_purchases": _with(
        EDGES,
        "SELECT * EXCLUDE (epoch_id) REPLACE"
        " (CASE WHEN relationship = 'ACHAT' THEN 0.0 ELSE price END AS price) FROM ed",
    ),
    "edge_state": STATE,
    "vertex_state": ALL_VERTICES,
    "vertex_state_mixed_roles": _with(
        EVENTS
        + """,
roles AS (
  SELECT user_city AS id, 0 AS r, epoch_id FROM ev
  UNION ALL SELECT CASE WHEN action_type = 'ACHAT' THEN product_cat ELSE user_city END,
                   1, epoch_id FROM ev
  UNION ALL SELECT product_cat, 2, epoch_id FROM ev
)""",
        LAST_TYPE,
    ),
    "strong_edges": _with(GRAPH, "SELECT * FROM st WHERE score >= 20"),
    "best_edges": _with(GRAPH + BEST, "SELECT * FROM best"),
    "best_edge_vertices": _with(
        GRAPH + BEST_IDS, "SELECT * FROM vt WHERE id IN (SELECT id FROM best_ids)"
    ),
    "edge_endpoints": _with(GRAPH, "SELECT src AS id FROM st UNION SELECT dst FROM st"),
    "incident_out": _incident("out"),
    "incident_in": _incident("in"),
    "incident_both": _incident("both"),
    "next_frontier_out": _next_frontier("out"),
    "next_frontier_in": _next_frontier("in"),
    "next_frontier_both": _next_frontier("both"),
    "node_ego_edges_h1": _ego_edges(hops=1),
    "node_ego_vertices_h1": _ego_vertices(hops=1),
    "node_ego_edges_h2": _ego_edges(hops=2),
    "node_ego_vertices_h2": _ego_vertices(hops=2),
    "node_ego_edges_h3": _ego_edges(hops=3),
    "node_ego_vertices_h0": _with(GRAPH, f"SELECT * FROM vt WHERE id = '{NODE}'"),
    "node_ego_out": _ego_edges(hops=2, direction="out"),
    "node_ego_in": _ego_edges(node=PRODUCT, hops=2, direction="in"),
    "node_ego_min_score": _ego_edges(hops=2, min_score=20),
    "node_ego_capped": _ego_edges(limit=25, hops=2),
    "node_ego_capped_vertices": _ego_vertices(hops=2),
    "popular_products_ego": _with(
        GRAPH + POPULAR, "SELECT * FROM st WHERE dst IN (SELECT id FROM popular)"
    ),
    "multi_seed_ego": _with(GRAPH + EACH_NODE, "SELECT * FROM each"),
    "multi_seed_ego_vertices": _with(
        GRAPH + EACH_NODE,
        """SELECT r.seed_id, v.* FROM (
  SELECT seed_id, src AS id FROM each UNION SELECT seed_id, dst FROM each
  UNION SELECT id, id FROM vt) r JOIN vt v ON v.id = r.id""",
    ),
    "multi_seed_ego_top3": _with(
        GRAPH + EACH_NODE,
        f"SELECT * FROM each QUALIFY row_number() OVER"
        f" (PARTITION BY seed_id ORDER BY {STRONGEST}) <= 3",
    ),
    "multi_seed_ego_h2": _with(GRAPH + POPULAR + EACH_POPULAR, "SELECT * FROM each"),
    "multi_seed_ego_h2_best": _with(
        GRAPH + EACH_NODE + EACH_NODE_TWICE,
        f"SELECT * FROM twice QUALIFY row_number() OVER"
        f" (PARTITION BY seed_id ORDER BY {STRONGEST}) = 1",
    ),
    "edge_context_edges": _with(_context(1), CONTEXT_EDGES),
    "edge_context_vertices": _with(_context(1), CONTEXT_VERTICES),
    "edge_context_h2": _with(_context(2, min_score=20), CONTEXT_EDGES),
    "edge_context_capped": _with(_context(1, limit=10), CONTEXT_EDGES),
    "edge_context_capped_vertices": _with(_context(1, limit=10), CONTEXT_VERTICES),
    "edge_context_weakest": _with(_context(1, limit=10, first=WEAKEST), CONTEXT_EDGES),
    "edge_context_weakest_vertices": _with(
        _context(1, limit=10, first=WEAKEST), CONTEXT_VERTICES
    ),
    "edge_context_below_min_score": _with(
        _context(2, min_score=40, first=WEAKEST), CONTEXT_EDGES
    ),
    "id_search": _with(
        EVENTS + VERTICES,
        f"SELECT * FROM vt WHERE starts_with(lower(id), '{PREFIX.strip().lower()}')"
        " ORDER BY id LIMIT 20",
    ),
    "graph_stats": _with(
        GRAPH,
        """SELECT (SELECT count(*) FROM vt) AS vertices, (SELECT count(*) FROM st) AS edges,
  CAST(1 AS BIGINT) AS batch_count, CAST(0 AS BIGINT) AS last_epoch_id""",
    ),
    "in_degrees": _with(EDGES, 'SELECT dst AS id, count(*) AS "inDegree" FROM ed GROUP BY dst'),
    "popular_products": _with(
        EDGES,
        'SELECT dst AS id, count(*) AS "inDegree" FROM ed GROUP BY dst'
        " ORDER BY count(*) DESC, dst LIMIT 5",
    ),
    "window_revenue": _windows("minute"),
    "window_revenue_hourly": _windows("hour"),
    "action_mix": _with(EVENTS, "SELECT" + MIX),
    "action_mix_by_city": _with(EVENTS, f"SELECT user_city,{MIX} GROUP BY user_city"),
    "action_mix_by_category": _with(EVENTS, f"SELECT product_cat,{MIX} GROUP BY product_cat"),
    "catalogue_conflicts": _with(
        EVENTS,
        """SELECT product_id, count(DISTINCT product_cat) AS nb_categories,
  count(DISTINCT seller_id) AS nb_sellers, count(DISTINCT price) AS nb_prices
FROM ev GROUP BY product_id
HAVING count(DISTINCT product_cat) > 1 OR count(DISTINCT seller_id) > 1
    OR count(DISTINCT price) > 1""",
    ),
    "unknown_actions": _with(
        EVENTS,
        """SELECT action_type, count(*) AS nb_events FROM ev
WHERE action_type IS NULL OR action_type NOT IN ('AIME', 'VOUT', 'ACHAT')
GROUP BY action_type""",
    ),
    "raw_edges_aligned": _with(
        EDGES, "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS price) FROM ed"
    ),
    "raw_replay_edges": _with(
        RAW + f",\nreplayed AS (SELECT * FROM raw WHERE epoch_id > {REPLAY_AFTER})"
        f",\nst AS ({_state('replayed')})",
        "SELECT * FROM st",
    ),
    "raw_ranges_replay_edges": _with(
        RAW + f",\nreplayed AS (SELECT * FROM raw WHERE epoch_id > {REPLAY_AFTER})"
        f",\nst AS ({_state('replayed')})",
        "SELECT * FROM st",
    ),
    "raw_replay_vertices": _with(
        EVENTS
        + f""",
roles AS (
  SELECT user_id AS id, 0 AS r, epoch_id FROM ev WHERE epoch_id > {REPLAY_AFTER}
  UNION ALL SELECT product_id, 1, epoch_id FROM ev WHERE epoch_id > {REPLAY_AFTER}
  UNION ALL SELECT seller_id, 2, epoch_id FROM ev WHERE epoch_id > {REPLAY_AFTER}
),
typed AS ({LAST_TYPE})""",
        """SELECT t.id, t.type, max(r.epoch_id) AS epoch_id
FROM typed t JOIN roles r ON r.id = t.id GROUP BY t.id, t.type""",
    ),
    "raw_edges_distinct": _with(
        EDGES,
        """SELECT src, dst, relationship,
  CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS "timestamp",
  min(price) AS price, epoch_id
FROM ed GROUP BY ALL""",
    ),
    "merged_state": STATE,
    "snapshot_edges": STATE,
    "snapshot_vertices": ALL_VERTICES,
    "node_link_nodes": _with(
        EVENTS + VERTICES, "SELECT id, coalesce(nullif(type, ''), id) AS label, type FROM vt"
    ),
    "node_link_links": _with(
        GRAPH,
        f"""SELECT src || '__' || dst AS id, src AS source, dst AS target, score,
  {EDGE_DATA} AS data, "AIME", "VOUT", "ACHAT" FROM st""",
    ),
    "node_link_files": _with(
        GRAPH, "SELECT src || '__' || dst AS id, src AS source, dst AS target, score FROM st"
    ),
    "keyed_records": _with(
        EVENTS,
        "SELECT action_type AS key, "
        + _event_json(time=f'strftime("timestamp", {ISO})')
        + " AS value FROM ev",
    ),
    "keyed_vertices": _with(
        EVENTS + VERTICES,
        """SELECT id AS key, '{"id":"' || id || '","type":"' || type || '"}' AS value FROM vt""",
    ),
    "keyed_edges": _with(
        EDGES,
        f"""SELECT src AS key, '{{"src":"' || src || '","dst":"' || dst
  || '","relationship":"' || relationship || '","timestamp":"'
  || strftime("timestamp", {ISO}) || '","price":' || CAST(price AS VARCHAR) || '}}' AS value
FROM ed""",
    ),
    "state_after_snapshot": STATE,
    "snapshot_other_weights": STATE,
    "rebuilt_state": STATE,
    "bucketed_edges": STATE,
    "bucketed_vertices": ALL_VERTICES,
    "bucketed_snapshot": STATE,
    "bucketed_reverse_edges": STATE,
    "bucketed_stats": _with(
        GRAPH,
        """SELECT (SELECT count(*) FROM vt) AS vertices, (SELECT count(*) FROM st) AS edges,
  CAST(3 AS BIGINT) AS batch_count, CAST(2 AS BIGINT) AS last_epoch_id""",
    ),
    "bucketed_best_edges": _with(GRAPH + BEST, "SELECT * FROM best"),
    "bucketed_search": _with(
        EVENTS + VERTICES,
        f"SELECT * FROM vt WHERE starts_with(lower(id), '{PREFIX.strip().lower()}')"
        " ORDER BY id LIMIT 20",
    ),
    "bucketed_ego_h2": _ego_edges(hops=2),
    "bucketed_ego_in": _ego_edges(node=PRODUCT, hops=2, direction="in"),
    "stream_graph_state": STATE,
    "stream_window_revenue": _windows("minute"),
    "stream_window_table": _windows("minute"),
    "stream_both": STATE,
    "stream_fold_store": STATE,
}
