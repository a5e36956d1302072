"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from fanwrite.llm.clusters import CLUSTERS, ROUNDS, SIZE
from fanwrite.llm.sharding import SHARDS, SLOTS

_SHARD_ROWS = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SHARDS))

# The shards' preference orders, then one recursive step per turn: the shard
# whose turn it is takes the first free slot of its order.
OP3_SHARDING = f"""
WITH RECURSIVE shards(i, shard) AS (VALUES {_SHARD_ROWS}),
orders AS (
  SELECT i, j, (('0x' || left(md5(shard || ':offset'), 8))::BIGINT % {SLOTS}
                + j * (('0x' || left(md5(shard || ':skip'), 8))::BIGINT % {SLOTS - 1} + 1)) % {SLOTS} AS slot
  FROM shards, range({SLOTS}) r(j)
),
lists AS (SELECT i, list(slot ORDER BY j) AS slots FROM orders GROUP BY i),
fill(turn, owners) AS (
  SELECT 0, list_transform(range({SLOTS}), lambda x: -1)
  UNION ALL
  SELECT turn + 1,
         owners[:pick] || [turn % {len(SHARDS)}] || owners[pick + 2:]
  FROM (SELECT turn, owners, list_filter(slots, lambda s: owners[s + 1] < 0)[1] AS pick
        FROM fill JOIN lists ON i = turn % {len(SHARDS)} WHERE turn < {SLOTS})
),
filled AS (SELECT unnest(owners) AS i, unnest(range({SLOTS})) AS slot FROM fill WHERE turn = {SLOTS})
SELECT d.doc_id, f.slot::INT AS slot, s.shard
FROM documents d
LEFT JOIN filled f ON f.slot = ('0x' || left(md5(d.doc_id::VARCHAR), 8))::BIGINT % {SLOTS}
LEFT JOIN shards s ON s.i = f.i
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Every pair of documents that share a shingle, then reachability.
OP4_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL) p
  JOIN sizes n ON n.doc_id = p.a JOIN sizes m ON m.doc_id = p.b
  WHERE 100 * p.c >= 80 * (n.n + m.n - p.c)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.other
  FROM reach r JOIN (SELECT a AS doc, b AS other FROM links UNION ALL SELECT b, a FROM links) l ON l.doc = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, l.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""

# Every window of a document against every window of an item.
OP7_DECONTAM = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
),
places AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
),
met AS (SELECT p.r, p.i, p.size, v.item_id FROM places p JOIN windows v ON v.s = p.s AND v.size = p.size),
hit AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM met) GROUP BY r),
found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
       sha256(coalesce(f.list, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (r) LEFT JOIN found f USING (r)
"""



def _clusters_sql(rounds: int, clusters: int, size: int) -> str:
    """Every vector against every centroid, round by round."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT v, sha256('3:' || vec_id) AS h FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {clusters})
)""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, k.v, c, list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM kept k, c{i} m QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(n.v, m.v) AS v
  FROM c{i} m LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v
    FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, {size + 1}) p(i) GROUP BY c, i) GROUP BY c
  ) n USING (c)
)""")
    ctes = ",\n".join(parts)
    return f"""WITH {ctes}
SELECT k.vec_id, a.c::INT AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (r) JOIN c{rounds} m ON m.c = a.c
"""


# Every document that shares a term with an item, scored whole.
OP13_LEXICAL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS w FROM documents
),
lengths AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
stats AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
postings AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM postings, stats GROUP BY term, big_n
),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL
),
scores AS (
  SELECT a.item_id, p.r, sum(a.times * w.weight * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * l.n * s.big_n) // s.big_l))))::BIGINT AS score
  FROM asked a JOIN postings p USING (term) JOIN weights w USING (term) JOIN lengths l USING (r), stats s GROUP BY a.item_id, p.r
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores JOIN lengths USING (r) WHERE score > 0 QUALIFY rank <= 10
"""

OP12_CLUSTERS = _clusters_sql(ROUNDS, CLUSTERS, SIZE)

ORACLE_SQL = {"op3_sharding": OP3_SHARDING, "op4_jaccard": OP4_JACCARD, "op7_decontam": OP7_DECONTAM, "op12_clusters": OP12_CLUSTERS, "op13_lexical": OP13_LEXICAL}
