"""DuckDB statements that give the same rows as the registered queries, where SQL can express them."""

OP1 = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
gram AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS g
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM item WHERE len(w) > 0)),
place AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS s FROM doc WHERE len(w) > 0),
found AS (
    SELECT p.doc_id, p.s, g.n, g.item_id
    FROM (SELECT p.doc_id, p.s, k.n, list_slice(p.w, p.s, p.s + k.n - 1) AS g
          FROM place p, (SELECT DISTINCT n FROM gram) k WHERE p.s + k.n - 1 <= len(p.w)) p
    JOIN gram g ON g.n = p.n AND g.g = p.g),
hit AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS k FROM found) GROUP BY doc_id),
ids AS (
    SELECT doc_id, count(*) AS n, sha256(string_agg(i, ',' ORDER BY i)) AS h
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
       coalesce(ids.h, sha256('')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

OP5 = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
part AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM page),
first AS (SELECT payload_digest, min(page_id) AS first FROM part WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM part LEFT JOIN first USING (payload_digest)
"""

OP10 = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
    SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + 49), ' ')) AS h
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM doc WHERE len(w) >= 50)),
least AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
late AS (SELECT DISTINCT doc_id, s FROM win JOIN least USING (h) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 49)) AS k FROM late),
kept AS (
    SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.k) AS kept
    FROM (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS k FROM doc WHERE len(w) > 0) p
    LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.k = p.k
    WHERE gone.k IS NULL GROUP BY p.doc_id),
number AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(number.n, 0) AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN number USING (doc_id)
"""

_VECTORS = """
part AS (
    SELECT * FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
    WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

OP11 = f"""
WITH RECURSIVE {_VECTORS},
sized AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS size FROM part WHERE len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.98),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
number AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, least.b) AS component_id, e.vec_id = least(e.vec_id, least.b) AS kept
FROM embeddings e LEFT JOIN least ON e.vec_id = least.a LEFT JOIN number ON e.vec_id = number.a
"""

OP12 = f"""
WITH {_VECTORS},
whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(v, lambda x: floor(256 * x)) AS v FROM part),
score AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM score WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN score USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""


def _levels(name: str, keys: str, start: str, levels: int = 8) -> str:
    """Tables {name}0, {name}1, ...: the nodes of each level, with their siblings to either side."""
    inside = f"PARTITION BY {keys}, r // 8 ORDER BY r ROWS BETWEEN"
    out = [f"{name}0 AS ({start})"]
    for k in range(levels):
        out.append(f"""{name}s{k} AS (
    SELECT *, coalesce(string_agg(h, '') OVER ({inside} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(h, '') OVER ({inside} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}{k}),
{name}{k + 1} AS (
    SELECT {keys}, r // 8 AS r, n, CASE WHEN n > {8**k} THEN sha256(string_agg(h, '' ORDER BY r)) ELSE max(h) END AS h
    FROM {name}{k} GROUP BY {keys}, r // 8, n)""")
    return ",\n".join(out)


def _folds(name: str, key: str, rank: str, start: str, levels: int = 8) -> str:
    """Tables {name}f0, {name}f1, ...: the rows of `start` with their hash and siblings folded up to each level."""
    out = [f"{name}f0 AS ({start})"]
    for k in range(levels):
        up = f"n > {8**k}"
        out.append(f"""{name}f{k + 1} AS (
    SELECT f.* REPLACE (CASE WHEN {up} THEN sha256(before || f.fold || after) ELSE f.fold END AS fold,
                        CASE WHEN {up} THEN f.proof || before || after ELSE f.proof END AS proof)
    FROM {name}f{k} f JOIN {name}s{k} s ON s.{key} = f.{key} AND s.r = f.{rank} // {8**k})""")
    return ",\n".join(out)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _leaf(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


OP13 = f"""
WITH tab AS (
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
        FROM range(256) x(i))),
doc AS (
    SELECT *, CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                        lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 3 = 0
                   THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') ELSE text END AS changed
    FROM documents, tab),
leaf AS (SELECT doc_id, coalesce('1' || lang, '0') AS l, {_leaf("text")} AS leaf, {_leaf("changed")} AS changed FROM doc),
place AS (
    SELECT *, row_number() OVER (PARTITION BY l ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY l) AS n FROM leaf),
{_levels("d", "l", "SELECT l, r, n, leaf AS h FROM place")},
top AS (SELECT l, h, 0 AS one, row_number() OVER (ORDER BY l) - 1 AS r, count(*) OVER () AS n FROM d8),
{_levels("t", "one", "SELECT one, r, n, h FROM top")},
{_folds("d", "l", "r", "SELECT doc_id, leaf, l, r, changed AS fold, '' AS proof FROM place")},
{_folds("t", "one", "at", "SELECT d.doc_id, d.leaf, top.h AS subroot, 0 AS one, top.r AS at, d.fold, d.proof FROM df8 d JOIN top USING (l)")}
SELECT f.doc_id, f.leaf, f.subroot, t8.h AS root, sha256(f.proof) AS proof_sha256, f.fold AS folded_root, f.fold = t8.h AS verified
FROM tf8 f, t8
"""
