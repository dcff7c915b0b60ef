"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

#: Space, tab, line feed, vertical tab, form feed, carriage return.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {
    "op7_line_dedup": f"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        exploded AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM docs),
        keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_UPPER}, {_LOWER}) AS k FROM exploded),
        shared AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
            GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
            SELECT doc_id, pos, line, shared.k IS NOT NULL AND doc_id <> keeper AS gone
            FROM keyed LEFT JOIN shared USING (k))
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op5_quality_cascade": """
        WITH parts AS (
            SELECT doc_id, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM documents),
        windows AS (
            SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM parts)),
        repeated AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id),
        counts AS (
            SELECT parts.doc_id, words, lines, len(words)::BIGINT AS n_words,
                length(array_to_string(words, ''))::BIGINT AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(covered.n, 0)::BIGINT AS n_repeat_words
            FROM parts LEFT JOIN covered USING (doc_id)),
        judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed
            AND word_chars BETWEEN 2 * n_words AND 12 * n_words
            AND 10 * n_symbols <= n_words
            AND 2 * n_dup_lines <= len(lines)
            AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]'))) <= 9 * len(lines)
            AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) <= 3 * len(lines)
            AND 10 * len(list_filter(words, lambda x: regexp_matches(x, '\\p{L}'))) >= 8 * n_words
            AND 2 * len(list_filter(words, lambda x: x = upper(x) AND x <> lower(x))) <= n_words AS kept
        FROM judged""",
    "op10_benchmark_decontamination": """
        WITH folded AS (
            SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
            UNION ALL
            SELECT 'b', item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
        pieces AS (
            SELECT id, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i, words FROM folded
            WHERE kind = 'b' AND len(words) > 0),
        windows AS (SELECT DISTINCT id, words[i : i + 9] AS w, len(words[i : i + 9]) AS n FROM pieces),
        sizes AS (SELECT DISTINCT n FROM windows),
        places AS (
            SELECT id AS doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS i
            FROM folded, sizes WHERE kind = 'd' AND len(words) >= n),
        found AS (
            SELECT p.doc_id, p.i, p.n, b.id AS item_id
            FROM places p JOIN windows b ON p.n = b.n AND p.words[p.i : p.i + p.n - 1] = b.w),
        hit AS (
            SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id),
        pieces_of AS (
            SELECT doc_id, unnest(pieces) AS piece, unnest(range(len(pieces))) AS k FROM (
                SELECT doc_id, string_split(regexp_replace(text, '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]', ' ', 'g'), ' ') AS pieces
                FROM documents WHERE doc_id IN (SELECT doc_id FROM found))),
        begun AS (
            SELECT doc_id, piece, k, sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY k) - length(piece) - 1 AS start
            FROM pieces_of),
        placed AS (
            SELECT doc_id, start, start + length(piece) AS stop, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS pos
            FROM begun WHERE piece <> ''),
        runs AS (
            SELECT doc_id, min(start) AS start, max(stop) AS stop FROM (
                SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run
                FROM placed JOIN (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS pos FROM found) USING (doc_id, pos))
            GROUP BY doc_id, run),
        spans AS (
            SELECT doc_id, string_agg(start::BIGINT || '-' || stop::BIGINT, ',' ORDER BY start) AS spans FROM runs GROUP BY doc_id)
        SELECT f.id AS doc_id, coalesce(spans, '') AS spans, len(f.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM folded f LEFT JOIN hit ON hit.doc_id = f.id LEFT JOIN items ON items.doc_id = f.id
            LEFT JOIN spans ON spans.doc_id = f.id
        WHERE f.kind = 'd'""",
    "op12_substring_dedup": """
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        windows AS (
            SELECT doc_id, i, words[i : i + 19] AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs)),
        again AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows)
            WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM again),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
            FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
        SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
            sha256(coalesce(text, '')) AS kept_sha256
        FROM docs d LEFT JOIN kept USING (doc_id)""",
    # A beginning is spelled by the MD5 of each turn's role and text, 64 characters a turn.
    "op13_conversation_prefix_trie": """
        WITH own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (
                    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (
            SELECT conv_id, conv_id - conv_id % 5 AS source, xor(list_reduce(
                    [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                    lambda crc, byte: list_reduce(
                        [xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                        lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS head
            FROM (SELECT DISTINCT conv_id FROM own)),
        turns AS (
            SELECT ids.conv_id, 0 AS step, place, role, text
            FROM ids JOIN own ON own.conv_id = ids.source AND place <= head
            UNION ALL
            SELECT conv_id, 1, place, role, text FROM own JOIN ids USING (conv_id) WHERE place > head),
        begun AS (
            SELECT conv_id, row_number() OVER w AS depth,
                string_agg(md5(role) || md5(text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS path,
                octet_length(encode(text)) AS n_bytes
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY step, place)
            UNION ALL
            SELECT conv_id, 0, '', 0 FROM ids),
        nodes AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes
            FROM begun GROUP BY path, depth),
        children AS (
            SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        totals AS (
            SELECT left(path, 64 * above) AS path, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves,
                sum((n_convs - 1) * n_bytes) AS saved_tokens
            FROM (
                SELECT path, n_convs, n_bytes, n_children, unnest(range(0, depth + 1)) AS above
                FROM nodes LEFT JOIN children USING (path))
            GROUP BY 1),
        ends AS (
            SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
            FROM (SELECT conv_id, arg_max(path, depth) AS path FROM begun GROUP BY conv_id) GROUP BY path)
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
            coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
            saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
        FROM nodes n JOIN totals USING (path) LEFT JOIN children USING (path) LEFT JOIN ends USING (path)
            LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))""",
}
