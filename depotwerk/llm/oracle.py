"""The same results in SQL, where SQL can express them."""

ORACLE = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
        FROM t JOIN g USING (text_sha256)""",
    "op2_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
            WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s
        QUALIFY rank <= 10""",
}

ORACLE["op9_near_dedup"] = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    s AS (
        SELECT doc_id, CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
        FROM w),
    e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
    l AS MATERIALIZED (
        SELECT x.doc_id AS a, y.doc_id AS b
        FROM e x JOIN e y ON x.t = y.t AND x.doc_id <> y.doc_id
        GROUP BY x.doc_id, y.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
    r(id, found) AS (
        SELECT doc_id, doc_id FROM s
        UNION
        SELECT r.id, l.b FROM r JOIN l ON l.a = r.found)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, g.component_id, s.doc_id = g.component_id AS kept
    FROM s JOIN (SELECT id, min(found) AS component_id FROM r GROUP BY id) g ON g.id = s.doc_id"""


def _centroid_sql(rounds: int) -> str:
    """Rounds of the clustering, one pair of steps after another."""
    steps = ["""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS u, vec_id, e
            FROM (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
                  FROM embeddings
                  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)),
        c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INTEGER) AS c, e
            FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, e FROM v ORDER BY h, e LIMIT 16))"""]
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT u, min(d) AS d, arg_min(c, (d, c)) AS c
            FROM (SELECT v.u, c{i}.c, list_inner_product(x, x) AS d
                  FROM v, c{i}, (SELECT [v.e[i] - c{i}.e[i] FOR i IN range(1, 65)] AS x))
            GROUP BY u)""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (
            SELECT c, list(floor(x) ORDER BY j) AS e
            FROM (SELECT c, j, sum(x) / count(*) AS x
                  FROM (SELECT a{i}.c, unnest(v.e) AS x, unnest(range(64)) AS j FROM a{i} JOIN v USING (u))
                  GROUP BY c, j)
            GROUP BY c),
        c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} USING (c))""")
    return "WITH" + ",".join(steps) + f"""
        SELECT v.vec_id, a{rounds}.c AS cluster, CAST(a{rounds}.d AS BIGINT) AS distance,
            CAST(sum(a{rounds}.d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
            CAST(sum(a{rounds}.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string([CAST(x AS BIGINT) FOR x IN c{rounds}.e], ',')) AS centroid_sha256
        FROM v JOIN a{rounds} USING (u) JOIN c{rounds} USING (c)"""


ORACLE["op11_centroids"] = _centroid_sql(3)

ORACLE["op12_decontamination"] = r"""
    WITH i AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    d AS MATERIALIZED (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    win AS MATERIALIZED (
        SELECT DISTINCT item_id, len(x) AS k, array_to_string(x, ' ') AS t
        FROM (SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
                  ELSE [w[j:j + 9] FOR j IN range(1, len(w) - 8)] END) AS x FROM i)),
    k AS (SELECT DISTINCT k FROM win),
    p AS (SELECT doc_id, w, k.k, unnest(range(1, len(w) - k.k + 2)) AS p FROM d, k),
    hit AS MATERIALIZED (
        SELECT DISTINCT o.doc_id, o.p, o.k, win.item_id
        FROM (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS t FROM p) o JOIN win ON o.t = win.t AND o.k = win.k),
    h AS (
        SELECT doc_id, count(DISTINCT j) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + k)) AS j FROM (SELECT DISTINCT doc_id, p, k FROM hit)) GROUP BY doc_id),
    n AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
        sha256(coalesce(n.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)"""

ORACLE["op13_fill_middle"] = r"""
    WITH t AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
            sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
        FROM documents),
    g AS (
        SELECT doc_id, text, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x,
            CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y, CAST('0x' || h[25:32] AS BIGINT) % 100 AS spm
        FROM t),
    f AS (
        SELECT doc_id, text, n,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                WHEN spm < 50 THEN 'spm' ELSE 'psm' END AS form,
            array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
            array_to_string(u[greatest(x, y) + 1:n], '') AS s
        FROM g)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
            ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM f"""
