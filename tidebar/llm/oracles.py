"""DuckDB SQL for the queries of this subpackage whose results SQL can express.

The others rest on a trained model, a hash that DuckDB lacks, a tokenizer or a
keyed permutation; tests hold them against brute force.
"""

from .conversation_trie import FAMILY, HEADS
from .decontaminate import SHARE, WINDOW
from .secrets import RULES
from .topk import K, SCALE
from .vector_codes import ENTRIES, PARTS, ROUNDS
from .vector_codes import SCALE as FINE



def _spans(rule, n: int) -> str:
    """(doc_id, row, start, kind, stop) of a rule's matches: pieces between matches and matches add up to places."""
    p = rule.pattern.replace("'", "''")
    return f"""SELECT r, start, {n} AS kind, start + size AS stop FROM (SELECT r, sum(gap + size) OVER (PARTITION BY r ORDER BY i) - size AS start, size, counted FROM (SELECT r, i, length(gaps[i]) AS gap, length(whole[i]) AS size, length(part[i]) AS counted
        FROM (SELECT r, regexp_extract_all(t, '{p}') AS whole, regexp_extract_all(t, '{p}', {rule.group}) AS part, regexp_split_to_array(t, '{p}') AS gaps FROM d), unnest(range(1, len(whole) + 1)) AS u(i))) WHERE counted >= {rule.least}"""


_LISTED = "string_agg(CASE kind {} END || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind)".format(" ".join(f"WHEN {n} THEN '{r.kind}'" for n, r in enumerate(RULES)))

_OP2 = f"""WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents), s AS MATERIALIZED ({' UNION ALL '.join(_spans(rule, n) for n, rule in enumerate(RULES))}),
    g AS (SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c, {_LISTED} FILTER (kind < 3) AS base, {_LISTED} AS every FROM s GROUP BY r)
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans FROM d LEFT JOIN g ON g.r = d.r"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP7 = f"""WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents), b AS MATERIALIZED (SELECT item_id, {_WORDS} AS w, least({WINDOW}, len({_WORDS})) AS n FROM benchmark),
    bw AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM b, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE n > 0),
    dw AS (SELECT r, i, m.n, array_to_string(w[i : i + m.n - 1], ' ') AS k FROM d, (SELECT DISTINCT n FROM bw) m, unnest(range(1, len(w) - m.n + 2)) AS u(i)),
    h AS MATERIALIZED (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.k = dw.k),
    x AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, i, n FROM h), unnest(range(i, i + n)) AS u(p) GROUP BY r),
    y AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM (SELECT DISTINCT r, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN x ON x.r = d.r LEFT JOIN y ON y.r = d.r"""

_OP9 = f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 20 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= {K}"""

def _assigned(n: int) -> str:
    """a{n}: the nearest entry of codebooks c{n} for each part, as struct(distance, entry), which ties to the lower index."""
    return f"a{n} AS MATERIALIZED (SELECT r, p.part, min(struct_pack(d := list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x), e := c.e)) AS b FROM p JOIN c{n} c ON c.part = p.part GROUP BY r, p.part)"


def _moved(n: int) -> str:
    """c{n}: codebooks c{n - 1} with the means, rounded down, of what is nearest to each entry."""
    mean = "CAST((s - ((s % n + n) % n)) // n AS DOUBLE)"
    return f"""c{n} AS MATERIALIZED (SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM c{n - 1} c LEFT JOIN (SELECT part, e, list({mean} ORDER BY i) AS x FROM (SELECT a.part, a.b.e AS e, i, CAST(sum(CAST(p.x[i] AS HUGEINT)) AS HUGEINT) AS s, count(*) AS n
        FROM a{n - 1} a JOIN p ON p.r = a.r AND p.part = a.part, unnest(range(1, len(p.x) + 1)) AS u(i) GROUP BY ALL) GROUP BY part, e) m ON m.part = c.part AND m.e = c.e)"""


_OP11 = f"""WITH f AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({FINE} * CAST(x AS DOUBLE))) AS q FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT CAST(ceil(max(len(q)) / {PARTS}) AS BIGINT) AS size FROM f),
    p AS MATERIALIZED (SELECT r, part, list_resize(q, size * {PARTS}, 0.0)[part * size + 1 : (part + 1) * size] AS x FROM f, s, unnest(range({PARTS})) AS u(part)),
    c0 AS MATERIALIZED (SELECT part, e, x FROM (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS e FROM f) JOIN p USING (r) WHERE e < {ENTRIES}),
    {', '.join(f'{_assigned(n)}, {_moved(n + 1)}' for n in range(ROUNDS))}, {_assigned(ROUNDS)},
    k AS (SELECT sha256(string_agg(CAST(CAST(x[i] AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, i)) AS books FROM c{ROUNDS}, unnest(range(1, len(x) + 1)) AS u(i)),
    o AS (SELECT r, string_agg(printf('%02x', b.e), '' ORDER BY part) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, books AS codebooks_sha256 FROM f JOIN o USING (r), k"""

#: A turn's hash, of whose order turns of one number are.
_TURN = "sha256(CAST(length({0}) AS VARCHAR) || ':' || {0} || {1})"

_OP12 = f"""WITH RECURSIVE tb(i, k, c) AS (SELECT range, 0, range FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM tb WHERE k < 8),
    m AS MATERIALIZED (SELECT conv_id, {_TURN.format("coalesce(role, '')", "coalesce(text, '')")} AS x, strlen(coalesce(text, '')) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN.format("coalesce(role, '')", "coalesce(text, '')")}) AS i FROM conversations WHERE conv_id IS NOT NULL),
    z AS MATERIALIZED (SELECT conv_id, count(*) AS n FROM m GROUP BY conv_id),
    cr(conv_id, s, k, c) AS (SELECT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM z UNION ALL SELECT conv_id, s, cr.k + 1, xor(tb.c, cr.c >> 8) FROM cr JOIN tb ON tb.k = 8 AND tb.i = xor(cr.c & 255, ascii(substr(s, cr.k + 1, 1))) WHERE cr.k < length(s)),
    h AS (SELECT z.conv_id, n, z.conv_id - z.conv_id % {FAMILY} AS b, xor(c, 4294967295) % {HEADS} AS h FROM z JOIN cr ON cr.conv_id = z.conv_id AND k = length(s)),
    g AS MATERIALIZED (SELECT h.conv_id, h.b, h.h, least(h.h, coalesce(z.n, 0)) AS k FROM h LEFT JOIN z ON z.conv_id = h.b),
    r AS (SELECT g.conv_id, m.i AS d, x, bytes FROM g JOIN m ON m.conv_id = g.b AND m.i <= g.h UNION ALL SELECT g.conv_id, m.i - g.h + g.k, x, bytes FROM g JOIN m ON m.conv_id = g.conv_id AND m.i > g.h),
    p AS MATERIALIZED (SELECT conv_id, d, bytes, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY d) AS k FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM g),
    e AS (SELECT conv_id, max(d) AS last FROM p GROUP BY conv_id),
    v AS MATERIALIZED (SELECT k, d, min(p.conv_id) AS c, count(*) AS n, (count(*) - 1) * max(bytes) AS own, coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (last = d), '') AS ends FROM p JOIN e ON e.conv_id = p.conv_id GROUP BY k, d),
    w AS (SELECT left(k, length(k) - 64) AS k, count(*) AS kids FROM v WHERE d > 0 GROUP BY 1),
    u AS MATERIALIZED (SELECT v.*, coalesce(kids, 0) AS kids FROM v LEFT JOIN w ON w.k = v.k),
    s AS (SELECT p.k, count(*) FILTER (kids = 0) AS leaves, sum(own) AS saved FROM u JOIN p ON p.conv_id = u.c AND p.d <= u.d GROUP BY p.k)
    SELECT u.c AS conv_id, CAST(u.d AS BIGINT) AS depth, a.c AS parent_conv_id, u.n AS n_convs, u.kids AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(u.ends) AS ends_sha256 FROM u JOIN s ON s.k = u.k LEFT JOIN u a ON a.d = u.d - 1 AND a.k = left(u.k, length(u.k) - 64)"""

SQL: dict[str, str] = {
    "op2_secret_scans": " ".join(_OP2.split("\n")),
    "op7_benchmark_decontamination": " ".join(_OP7.split("\n")),
    "op9_exact_top_k": " ".join(_OP9.split("\n")),
    "op11_vector_codes": " ".join(_OP11.split("\n")),
    "op12_conversation_trie": " ".join(_OP12.split("\n")),
}
