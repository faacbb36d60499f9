"""Expected results as DuckDB SQL, where SQL can express them."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

def _clusters(k: int = 8, rounds: int = 10, seed: int = 3, dimensions: int = 64) -> str:
    """Rounds of exact k-means written out one after the other."""
    parts = [
        f"""points AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS INTEGER) AS j, v AS c FROM points
            ORDER BY j LIMIT {k}
        )""",
    ]
    for t in range(rounds + 1):
        parts.append(
            f"""a{t} AS MATERIALIZED (
            SELECT r, min(struct_pack(d := list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), j := j)) AS near
            FROM points, c{t} GROUP BY r
        )"""
        )
        if t < rounds:
            parts.append(
                f"""c{t + 1} AS MATERIALIZED (
            WITH sums AS (
                SELECT near.j AS j, p, sum(v[p]) AS s, count(*) AS n
                FROM a{t} JOIN points USING (r), generate_series(1, {dimensions}) AS g(p) GROUP BY ALL
            ), means AS (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS m FROM sums GROUP BY j)
            SELECT j, coalesce(m, c) AS c FROM c{t} LEFT JOIN means USING (j)
        )"""
            )
    return "WITH " + ", ".join(parts) + f"""
        SELECT vec_id, near.j AS cluster, CAST(near.d AS BIGINT) AS distance,
               CAST(sum(near.d) OVER (PARTITION BY near.j) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN points USING (r) JOIN c{rounds} ON near.j = c{rounds}.j"""


def _encoded(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_encoded(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# DuckDB has no crc32: the usual table-free rule over the bytes of an id, bit by bit.
_CRC32 = """list_reduce(list_prepend(4294967295, list_transform(generate_series(1, length(CAST(doc_id AS VARCHAR))),
            lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
            lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""

_MERKLE = f"""
        WITH RECURSIVE rows AS MATERIALIZED (
            SELECT row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
                   row_number() OVER () AS r, lang, doc_id, leaf, other
            FROM (
                SELECT *, {_leaf('n_chars')} AS leaf,
                       CASE WHEN coalesce(xor({_CRC32}, 4294967295) % 7 = 0, false) THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS other
                FROM documents
            )
        ), up AS (
            SELECT lang, 0 AS level, i, n, leaf AS h FROM rows
            UNION ALL
            SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(following, ''))
            FROM (SELECT *, lead(h) OVER (PARTITION BY lang ORDER BY i) AS following FROM up WHERE n > 1) WHERE i % 2 = 0
        ), kept AS MATERIALIZED (SELECT * FROM up),
        subroots AS MATERIALIZED (
            SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j, count(*) OVER () AS trees
            FROM kept WHERE n = 1
        ), top AS (
            SELECT 0 AS level, j AS i, trees AS n, subroot AS h FROM subroots
            UNION ALL
            SELECT level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(following, ''))
            FROM (SELECT *, lead(h) OVER (ORDER BY i) AS following FROM top WHERE n > 1) WHERE i % 2 = 0
        ), top_kept AS MATERIALIZED (SELECT * FROM top),
        steps AS MATERIALIZED (
            SELECT r, g.place AS step, (rows.i >> g.place) % 2 = 1 AS on_left, s.h AS sibling
            FROM rows JOIN subroots ON rows.lang IS NOT DISTINCT FROM subroots.lang, generate_series(0, height - 1) AS g(place)
            LEFT JOIN kept AS s ON s.lang IS NOT DISTINCT FROM rows.lang AND s.level = g.place AND s.i = xor(rows.i >> g.place, 1)
            UNION ALL
            SELECT r, height + g.place, (j >> g.place) % 2 = 1, s.h
            FROM rows JOIN subroots ON rows.lang IS NOT DISTINCT FROM subroots.lang,
                 generate_series(0, (SELECT max(level) FROM top_kept) - 1) AS g(place)
            LEFT JOIN top_kept AS s ON s.level = g.place AND s.i = xor(j >> g.place, 1)
        ), proofs AS (
            SELECT r, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY step)) AS proof_sha256, count(*) AS length FROM steps GROUP BY r
        ), fold AS (
            SELECT r, 0 AS step, other AS h FROM rows
            UNION ALL
            SELECT r, step + 1, sha256(CASE WHEN on_left THEN coalesce(sibling, '') || h ELSE h || coalesce(sibling, '') END)
            FROM fold JOIN steps USING (r, step)
        )
        SELECT doc_id, leaf, subroot, (SELECT h FROM top_kept WHERE n = 1) AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
               h AS folded_root, h = (SELECT h FROM top_kept WHERE n = 1) AS verified
        FROM rows JOIN subroots ON rows.lang IS NOT DISTINCT FROM subroots.lang LEFT JOIN proofs USING (r)
             JOIN fold ON fold.r = rows.r AND fold.step = coalesce(length, 0)"""


ORACLE: dict[str, str] = {
    "op2_decontaminate": f"""
        WITH items AS (
            SELECT item_id, {_WORDS} AS words FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(13, len(words)) AS length,
                   array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS win
            FROM items, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS t(i) WHERE len(words) > 0
        ), texts AS (
            SELECT doc_id, {_WORDS} AS words FROM documents
        ), lengths AS (SELECT DISTINCT length FROM windows),
        places AS (
            SELECT doc_id, i, length, array_to_string(words[i : i + length - 1], ' ') AS win
            FROM texts, lengths, unnest(generate_series(1, len(words) - length + 1)) AS t(i) WHERE len(words) >= length
        ), hits AS (
            SELECT doc_id, i, length, item_id FROM places JOIN windows USING (length, win)
        ), hit_words AS (
            SELECT doc_id, count(DISTINCT w) AS n_hit
            FROM hits, unnest(generate_series(i, i + length - 1)) AS t(w) GROUP BY doc_id
        ), hit_items AS (
            SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM texts LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op3_mix_sources": """
        WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        sums AS (SELECT sum(n) AS total, sum(pow(CAST(n AS DOUBLE), 0.5)) AS weight FROM sizes),
        rates AS (SELECT source, pow(CAST(n AS DOUBLE), 0.5) / weight * total / n AS rate FROM sizes, sums),
        drawn AS (
            SELECT doc_id, source, rate,
                   CAST('0x' || substr(md5('mix:' || doc_id || ':1'), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
            FROM documents JOIN rates USING (source)
        ), steps AS (
            SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
            FROM rates, generate_series(0, 199) AS t(k)
        ), counted AS (
            SELECT doc_id, drawn.source, count(*) AS n_copies
            FROM drawn JOIN steps ON steps.source = drawn.source AND p <= u GROUP BY doc_id, drawn.source
        )
        SELECT doc_id, source, CAST(n_copies AS INTEGER) AS n_copies, CAST(i AS INTEGER) AS copy_no,
               md5('mix order:' || doc_id || ':' || i) AS shuffle_key
        FROM counted, unnest(generate_series(1, n_copies)) AS t(i)""",
    "op10_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        ), keyed AS (
            SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{_UPPER}', '{_LOWER}') AS key
            FROM lines
        ), repeated AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), judged AS (
            SELECT doc_id, pos, line, last IS NOT NULL AND last <> doc_id AS lost FROM keyed LEFT JOIN repeated USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op11_shallot_clusters": _clusters(),
    "op12_content_sort": """
        WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS content FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(content) AS text_sha256
        FROM texts WINDOW w AS (PARTITION BY content ORDER BY doc_id NULLS LAST)""",
    "op13_merkle_manifest": _MERKLE,
}
