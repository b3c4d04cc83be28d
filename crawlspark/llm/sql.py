"""DuckDB SQL with the same result as the queries that SQL can state."""

#: Word shingles of whole texts, equal sets as one node, links from 0.8 on, and their closure.
SIMILAR_DOCUMENTS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\r\f\x0B]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM words),
nodes AS (SELECT s, min(doc_id) AS id, count(*) AS copies, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT id, n, copies, unnest(s) AS token FROM nodes),
links AS (
  SELECT a.id AS a, b.id AS b, any_value(b.copies) AS copies
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.id <> b.id
  GROUP BY a.id, b.id
  HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (SELECT id, id FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS id, min(b) AS class_id FROM reach GROUP BY a),
counts AS (SELECT a AS id, sum(copies) AS links FROM links GROUP BY a)
SELECT s.doc_id, coalesce(c.class_id, s.doc_id) AS class_id,
  CAST(coalesce(k.links, 0) + coalesce(n.copies, 1) - 1 AS BIGINT) AS n_links
FROM sets s LEFT JOIN nodes n ON s.s = n.s LEFT JOIN classes c ON n.id = c.id LEFT JOIN counts k ON n.id = k.id
"""

#: Cosine over all pairs of equal label, and the closure of the links.
NEAR_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM usable UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
  coalesce(component_id, v.vec_id) AS component_id,
  coalesce(v.vec_id = coalesce(component_id, v.vec_id), true) AS kept
FROM embeddings v LEFT JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""


def _shared_out(level: int, levels: list[str], permille: int) -> str:
    """Common table expressions that give the nodes of one level their budgets."""
    path, parent = ", ".join(levels[: level + 1]), ", ".join(levels[:level])
    part = f"PARTITION BY {parent}" if parent else ""
    source = (
        f"c{level} JOIN n{level - 1} USING ({parent})"
        if parent
        else f"c0, (SELECT (sum(n) * {permille}) // 1000 AS budget FROM rows)"
    )
    return f"""
c{level} AS (SELECT {path}, sum(capacity) AS capacity, any_value({levels[level]}_weight) AS weight
  FROM leaves GROUP BY {path}),
r{level} AS (SELECT *, coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM {source}
  WINDOW w AS ({part} ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {levels[level]})),
f{level} AS (SELECT *, capacity * weight_left <= (budget - taken) * weight AS filled FROM r{level}),
b{level} AS (SELECT *,
    budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({part}) AS rest,
    sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({part}) AS open_weight,
    sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({part} ORDER BY filled, {levels[level]}) AS upto
  FROM f{level}),
n{level} AS (SELECT {path}, CASE WHEN filled THEN capacity
    ELSE (rest * upto) // open_weight - (rest * (upto - weight)) // open_weight END AS budget FROM b{level})"""


def mixed_sources(domain: str, weights: dict[str, dict[str, int]], permille: int, max_epochs: int, seed: int) -> str:
    """SQL of a mix; ``domain`` is the SQL of a row's domain."""
    levels = ["domain", "lang", "source"]
    by_name = {
        level: " ".join(["CASE", *(f"WHEN {level} = '{k}' THEN {v}" for k, v in weights.get(level, {}).items()), "ELSE 1 END"])
        if weights.get(level)
        else "1"
        for level in levels
    }
    named = ", ".join(f"{by_name[level]} AS {level}_weight" for level in levels)
    steps = ",".join(_shared_out(i, levels, permille) for i in range(3))
    return rf"""
WITH rows AS (
  SELECT doc_id, coalesce({domain}, 'unknown') AS domain, coalesce(lang, 'unknown') AS lang,
    coalesce(source, 'unknown') AS source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\f\x0B]+'), lambda x: x <> '')) AS n
  FROM documents),
sums AS (SELECT domain, lang, source, sum(n) AS supply FROM rows GROUP BY ALL),
leaves AS (SELECT *, supply * {max_epochs} AS capacity FROM (SELECT *, {named} FROM sums)
  WHERE domain_weight > 0 AND lang_weight > 0 AND source_weight > 0 AND supply > 0),{steps},
quotas AS (SELECT domain, lang, source, supply, budget // supply AS epochs, budget % supply AS rest
  FROM leaves JOIN n2 USING (domain, lang, source)),
drawn AS (SELECT rows.*, epochs, rest, CAST(concat('0x', substr(md5(concat('{seed}:', epochs + 1, ':', doc_id)), 1, 15)) AS BIGINT) AS d
  FROM rows JOIN quotas USING (domain, lang, source) WHERE n > 0),
ahead AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY d
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM drawn),
taken AS (
  SELECT doc_id, domain, lang, source, unnest(range(1, CAST(epochs AS BIGINT) + 1)) AS epoch, n, n AS take FROM ahead
  UNION ALL
  SELECT doc_id, domain, lang, source, CAST(epochs AS BIGINT) + 1, n, least(n, rest - before) FROM ahead WHERE before < rest)
SELECT doc_id, domain, lang, source, epoch, CAST(n AS BIGINT) AS n_tokens, CAST(take AS BIGINT) AS take_tokens FROM taken
"""

#: Shares and prices term by term.
SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT lang, source, r, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
o AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, CAST(coalesce(o.n, 0) AS HUGEINT) AS n
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT c.lang, c.source, term, n, 1 + 1000000000 * (n + 1) // (s.total + v.v) AS p,
    1 + 1000000000 * (lang_n + 1) // (v.total + v.v) AS q
  FROM c JOIN s ON c.lang = s.lang AND c.source = s.source JOIN v ON c.lang = v.lang),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM y WHERE part = 'pair' OR rank <= 200"""


def centroid_clusters(k: int, rounds: int) -> str:
    """Rounds of assignment and floored means, one row per vector, centroid and dimension."""
    steps = []
    for number in range(rounds + 1):
        steps.append(f"""
d{number} AS (SELECT e.vec_id, c.cluster, sum((e.x - c.x) * (e.x - c.x)) AS d
  FROM e JOIN c{number} c ON e.place = c.place GROUP BY e.vec_id, c.cluster),
a{number} AS (SELECT vec_id, min((d, cluster)) AS best FROM d{number} GROUP BY vec_id)""")
        if number < rounds:
            steps.append(f"""
s{number} AS (SELECT a.best[2] AS cluster, e.place, sum(e.x) AS total, count(*) AS n
  FROM a{number} a JOIN e ON a.vec_id = e.vec_id GROUP BY 1, 2),
c{number + 1} AS (SELECT c.cluster, c.place, CASE WHEN s.n IS NULL THEN c.x ELSE (s.total - ((s.total % s.n) + s.n) % s.n) // s.n END AS x
  FROM c{number} c LEFT JOIN s{number} s ON c.cluster = s.cluster AND c.place = s.place)""")
    return f"""
WITH v AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64),
e AS (SELECT vec_id, unnest(range(64)) AS place, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS HUGEINT) AS x FROM v),
f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM v QUALIFY cluster < {k}),
c0 AS (SELECT f.cluster, e.place, e.x FROM f JOIN e ON f.vec_id = e.vec_id),
{",".join(steps)},
h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance,
  CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
  centroid_sha256
FROM a{rounds} JOIN h ON best[2] = h.cluster"""
