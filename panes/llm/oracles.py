"""DuckDB SQL for the queries that SQL can express (same column names)."""

from __future__ import annotations

#: Every row of a damaged conversation gets one edit: an insertion is in no cheapest repair, as leaving out its
#: neighbour instead costs less.  So the least (cost, audit) of each state follows row by row.
_REPAIR = r"""
    WITH RECURSIVE keyed AS (
             SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(
                            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                        lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))),
                        4294967295) % 20 AS kind
             FROM conversations),
         damaged AS (
             SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
             FROM keyed, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
         ordered AS (
             SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                    trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS initial FROM damaged),
         audited AS MATERIALIZED (
             SELECT conv_id, turn, role, text, i, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before,
                    CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                         WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ordered),
         facts AS (
             SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
             FROM audited GROUP BY conv_id),
         steps AS (
             SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(c := CAST(0 AS BIGINT), a := '') AS none,
                    struct_pack(c := CAST(1000000000 AS BIGINT), a := '') AS s, struct_pack(c := CAST(1000000000 AS BIGINT), a := '') AS u,
                    struct_pack(c := CAST(1000000000 AS BIGINT), a := '') AS a FROM facts
             UNION ALL
             SELECT p.conv_id, r.i, DELETE(none),
                    CASE WHEN KEPT AND initial = 's' THEN least(DELETE(s), KEEP(none)) ELSE DELETE(s) END,
                    CASE WHEN KEPT AND initial = 'u' THEN least(DELETE(u), KEEP(none), KEEP(s), KEEP(a), GIVE(none), GIVE(s), GIVE(a))
                         WHEN KEPT THEN least(DELETE(u), GIVE(none), GIVE(s), GIVE(a)) ELSE DELETE(u) END,
                    CASE WHEN KEPT AND initial = 'a' THEN least(DELETE(a), KEEP(u), GIVE(u)) WHEN KEPT THEN least(DELETE(a), GIVE(u)) ELSE DELETE(a) END
             FROM steps p JOIN audited r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1),
         best AS (
             SELECT f.*, least(p.none, p.a).c AS cost, least(p.none, p.a).a AS audit
             FROM facts f JOIN steps p ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.i),
         left_rows AS (
             SELECT r.conv_id, r.i, r.role, r.text, r.initial, substr(b.audit, CAST(r.i AS INTEGER), 1) AS edit,
                    row_number() OVER (PARTITION BY r.conv_id ORDER BY r.i) AS place,
                    first_value(initial = 's' AND substr(b.audit, CAST(r.i AS INTEGER), 1) = 'K') OVER (PARTITION BY r.conv_id ORDER BY r.i) AS headed
             FROM audited r JOIN best b ON r.conv_id IS NOT DISTINCT FROM b.conv_id WHERE substr(b.audit, CAST(r.i AS INTEGER), 1) <> 'D'),
         repaired AS (
             SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place + CAST(headed AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                        || ':' || text, chr(10) ORDER BY i) AS lines FROM left_rows GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
         LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""


def _repair() -> str:
    sql = _REPAIR.replace("KEPT", "fault NOT IN ('blank', 'duplicate')")
    for name, cost, letter in (("DELETE", "2", "D"), ("KEEP", "if(fault = 'truncated', 5, 0)", "K"), ("GIVE", "if(fault = 'truncated', 6, 1)", "R")):
        for state in ("none", "s", "u", "a"):
            sql = sql.replace(f"{name}({state})", f"struct_pack(c := p.{state}.c + {cost}, a := p.{state}.a || '{letter}')")
    return sql


_ROUNDS = 5


def _clustering() -> str:
    """Rounds of clustering one after another, all distances computed anew in each."""
    parts = ["""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, x AS c FROM kept ORDER BY sha256('2:' || vec_id) LIMIT 40)"""]
    for i in range(_ROUNDS + 1):
        parts.append(f"""
        a{i} AS MATERIALIZED (
            SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min(struct_pack(
                       d := CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), k := k)) AS best
            FROM kept, c{i} GROUP BY r)""")
        if i < _ROUNDS:
            parts.append(f"""
        s{i} AS MATERIALIZED (
            SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c
            FROM (SELECT k, j, sum(v) AS s, count(*) AS n
                  FROM (SELECT best.k AS k, unnest(x) AS v, unnest(range(64)) AS j FROM a{i}) GROUP BY k, j) GROUP BY k),
        c{i + 1} AS MATERIALIZED (
            SELECT c{i}.k AS k, list_transform(coalesce(s{i}.c, c{i}.c), lambda v: CAST(v AS BIGINT)) AS c FROM c{i} LEFT JOIN s{i} ON c{i}.k = s{i}.k)""")
    return "WITH" + ",".join(parts) + f"""
        SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{_ROUNDS} JOIN c{_ROUNDS} ON best.k = c{_ROUNDS}.k"""


LLM_ORACLE_SQL: dict[str, str] = {
    "op11_hirschberg_repair": _repair(),
    "op13_incremental_distances": _clustering(),
    # Every pair of documents that share a shingle, counted.
    "op2_hyperminhash": r"""
        WITH RECURSIVE w AS (
                 SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
             sets AS MATERIALIZED (
                 SELECT r, doc_id, CASE WHEN len(words) < 2 THEN words
                        ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles FROM w),
             s AS (SELECT r, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
             shared AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
                        FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY a.r, b.r),
             links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * c >= 80 * (na + nb - c)),
             reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
             first AS (SELECT reach.a AS r, min(sets.doc_id) AS component_id FROM reach JOIN sets ON reach.b = sets.r GROUP BY reach.a)
        SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN first ON sets.r = first.r
    """,
    "op3_digest_index": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
             k AS (SELECT *, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
    """,
    "op6_line_runs": r"""
        WITH documents_with_row AS (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents),
             l AS (SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents_with_row),
             k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
             f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
             g AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
        FROM g GROUP BY r
    """,
    "op7_grid_order_join": r"""
        WITH RECURSIVE e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
             good AS (SELECT vec_id, label, x, sqrt(list_inner_product(x, x)) AS norm FROM e
                      WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0
                        AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
                        AND len(list_filter(x, lambda v: v <> 0)) > 0),
             links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b
                       ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
                      AND list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.98),
             reach AS (SELECT vec_id AS u, vec_id AS v FROM e UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
             c AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u),
             n AS (SELECT u AS vec_id, count(*) AS n_links FROM links GROUP BY u)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
    """,
    "op8_warc_dictionary": r"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
             k AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
                          max(page_id) OVER (PARTITION BY payload) AS response FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
        FROM k
    """,
}
