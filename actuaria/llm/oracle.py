"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

SQL: dict[str, str] = {}

SQL["op1_topk_search"] = """
WITH finite AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM finite a, finite b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL["op8_repeated_passages"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), spots AS (
  SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM spots
), recurring AS (
  SELECT g FROM windows GROUP BY g HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows WHERE g IN (SELECT g FROM recurring)
), gone AS (
  SELECT r, list(p) AS ps FROM covered GROUP BY r
), words AS (
  SELECT r, p, w[p] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM docs)
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN covered USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

SQL["op10_decontamination"] = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), grams AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), sizes AS (
  SELECT DISTINCT n FROM grams
), windows AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
), hits AS (
  SELECT r, i, n, item FROM windows JOIN grams USING (n, g)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
  FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

_SIDES = "string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos)", "string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos)"

# one tree: nodes (g, pos, n, h) of all levels of a group, and each node's siblings
_TREE = """
  {name}_nodes AS (
    SELECT g, 0 AS level, pos, n, h FROM {leaves}
    UNION ALL
    SELECT g, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
    FROM {name}_nodes WHERE n > 1 GROUP BY g, level, pos // 16, n
  ), {name}_sides AS (
    SELECT a.g, a.level, a.pos, coalesce({left}, '') AS l, coalesce({right}, '') AS r
    FROM {name}_nodes a JOIN {name}_nodes b ON a.g = b.g AND a.level = b.level AND a.pos // 16 = b.pos // 16
    WHERE a.n > 1 GROUP BY a.g, a.level, a.pos
  ), {name}_tops AS (SELECT g, h FROM {name}_nodes WHERE n = 1)"""

# the fold of a row's value through one tree: (row, level, value, proof so far)
_FOLD = """
  {name} AS (
    SELECT row, g, pos, 0 AS level, value, proof FROM {start}
    UNION ALL
    SELECT f.row, f.g, f.pos // 16, f.level + 1, sha256(s.l || f.value || s.r), f.proof || s.l || s.r
    FROM {name} f JOIN {tree}_sides s ON f.g = s.g AND f.level = s.level AND f.pos = s.pos
  ), {name}_end AS (SELECT row, g, arg_max(value, level) AS value, arg_max(proof, level) AS proof FROM {name} GROUP BY row, g)"""


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || "
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32 of a decimal text: each byte, then eight steps (-1)
_CRC32 = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda x: [ord(x), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"""

SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_LEAF}{_field("text")}) AS h,
    CASE WHEN {_CRC32} % 5 = 0 THEN {_LEAF}{_field(_LOWERED)}) END AS tampered FROM documents
  ), leaves AS (
    SELECT row_number() OVER () AS row, doc_id, g, h, tampered,
      row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM docs
  ), {_TREE.format(name="low", leaves="leaves", left=_SIDES[0], right=_SIDES[1])},
  subroots AS (
    SELECT '' AS g, g AS of, h, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM low_tops
  ), {_TREE.format(name="top", leaves="subroots", left=_SIDES[0], right=_SIDES[1])},
  first AS (SELECT row, g, pos, coalesce(tampered, h) AS value, '' AS proof FROM leaves),
  {_FOLD.format(name="climb", start="first", tree="low")},
  second AS (SELECT e.row, '' AS g, s.pos, e.value, e.proof FROM climb_end e JOIN subroots s ON e.g = s.of),
  {_FOLD.format(name="last", start="second", tree="top")}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256,
  e.value AS folded_root, e.value = t.h AS verified
FROM leaves l JOIN low_tops s ON l.g = s.g JOIN top_tops t ON true JOIN last_end e ON e.row = l.row
"""


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds of assignment (``a``) and new centroids (``c``) over the kept vectors, unrolled."""
    parts = ["""kept AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS cluster, q FROM kept
  WHERE vec_id IS NOT NULL ORDER BY cluster LIMIT {k}
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT v.row, v.vec_id, v.q, min({{'d': list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))),
                     'c': c.cluster}}) AS best FROM kept v, c{i} c GROUP BY v.row, v.vec_id, v.q
)""")
        if i < rounds:
            parts.append(f"""m{i} AS (
  SELECT best.c AS cluster, p, sum(q[p]) AS s, count(*) AS n
  FROM (SELECT best, q, unnest(range(1, 65)) AS p FROM a{i}) GROUP BY best.c, p
), c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS q FROM m{i} GROUP BY cluster
  ) m USING (cluster)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.best.c = c.cluster
"""


SQL["op11_centroid_clusters"] = _clusters_sql()
