"""DuckDB SQL for the registered queries that SQL can express."""

_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# CRC-32 of the decimal digits of an integer, bit by bit
_CRC = """xor(4294967295, list_reduce(
    flatten([[ascii(c) + 4294967296, 0, 0, 0, 0, 0, 0, 0, 0]
             FOR c IN string_split(CAST({0} AS VARCHAR), '')]),
    lambda crc, x: CASE WHEN x > 0 THEN xor(crc, x - 4294967296)
                        ELSE xor(crc >> 1, (crc & 1) * 3988292384) END, 4294967295))"""

ORACLE = {
    # levenshtein() counts bytes, as the operator does
    "op2_line_dedup": r"""
        WITH RECURSIVE cut AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (
            SELECT doc_id, pos, lines[pos] AS line
            FROM cut, unnest(range(1, len(lines) + 1)) AS t(pos)),
        firsts AS (
            SELECT line, min((doc_id, pos)) AS place, strlen(line) AS n
            FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line),
        links AS (
            SELECT a.place AS a, b.place AS b
            FROM firsts a JOIN firsts b
              ON a.place <> b.place AND a.n >= 20 AND b.n >= 20 AND abs(a.n - b.n) <= 2
              AND levenshtein(a.line, b.line) <= 2),
        reached AS (
            SELECT place, place AS other FROM firsts
            UNION
            SELECT reached.place, links.b FROM reached JOIN links ON reached.other = links.a),
        classes AS (SELECT place, min(other) AS keep FROM reached GROUP BY place),
        judged AS (
            SELECT doc_id, pos, l.line, f.place IS NOT NULL AND (doc_id, pos) <> f.place AS exact,
                   f.place IS NOT NULL AND (doc_id, pos) = f.place AND c.keep <> f.place AS near
            FROM lines l LEFT JOIN firsts f ON l.line = f.line
            LEFT JOIN classes c ON f.place = c.place)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (exact) AS n_exact,
               count(*) FILTER (near) AS n_near,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                               FILTER (NOT exact AND NOT near), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op3_decontamination": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size,
                   array_to_string(list_slice(w, pos, pos + least(len(w), 10) - 1), ' ') AS words
            FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(pos)
            WHERE len(w) > 0),
        runs AS (
            SELECT doc_id, pos, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS words
            FROM d, (SELECT DISTINCT size FROM windows) s,
                 unnest(range(1, len(w) - size + 2)) AS t(pos)),
        found AS (
            SELECT doc_id, item_id, pos, size FROM runs JOIN windows USING (size, words)),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM found, unnest(range(pos, pos + size)) AS t(p) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
            GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    # DuckDB has no base 32: the hexadecimal digits become bits, and every five a letter
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (
            SELECT page_id, strlen(h) AS n, sha1(h) AS hex,
                   min(page_id) OVER (PARTITION BY h) AS first FROM p),
        b AS (
            SELECT page_id, n, first, array_to_string([
                substr('0000000100100011010001010110011110001001101010111100110111101111',
                       4 * instr('0123456789abcdef', c) - 3, 4)
                FOR c IN string_split(hex, '')], '') AS bits FROM d)
        SELECT page_id, n AS payload_bytes,
               array_to_string([
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT)
                            + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
                            + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
                            + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
                            + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)
                   FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM b
    """,
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM d
    """,
    "op7_ngram_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, pos, pos + 4), ' ') AS gram
            FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(pos) WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
            WHERE common.n * 5 >= 4 * (x.n + y.n - common.n)),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a)
        SELECT doc_id, min(other) AS class_id,
               (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
        FROM reached GROUP BY doc_id
    """,
    "op8_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, pos, array_to_string(list_slice(w, pos, pos + 49), ' ') AS words
            FROM d, unnest(range(1, len(w) - 48)) AS t(pos)),
        firsts AS (SELECT words, min(doc_id) AS first FROM windows GROUP BY words),
        removed AS (
            SELECT DISTINCT doc_id, p
            FROM windows JOIN firsts USING (words), unnest(range(pos, pos + 50)) AS t(p)
            WHERE first < doc_id),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n
            FROM (SELECT doc_id, p, w[p] AS word
                  FROM d, unnest(range(1, len(w) + 1)) AS t(p)) ANTI JOIN removed
                  USING (doc_id, p)
            GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(words, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op10_preferences": r"""
        WITH replies AS (
            SELECT conv_id, max(turn) AS last, arg_max(text, turn) AS reply
            FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
        swaps AS (
            SELECT r.conv_id, r.last,
                   coalesce(n.reply, (SELECT arg_min(reply, conv_id) FROM replies)) AS other
            FROM replies r LEFT JOIN replies n ON n.conv_id = r.conv_id + 1),
        turns AS (
            SELECT conv_id, turn, replace(role, '<|', '< |') AS role,
                   replace(text, '<|', '< |') AS chosen,
                   replace(CASE WHEN turn = last AND role = 'assistant' THEN other ELSE text END,
                           '<|', '< |') AS rejected
            FROM conversations JOIN swaps USING (conv_id)),
        ends AS (
            SELECT conv_id, coalesce(min(turn) FILTER (chosen <> rejected), 1 << 60) AS stop
            FROM turns GROUP BY conv_id),
        said AS (
            SELECT *, '<|' || role || '|>' || chr(10) AS head,
                   chosen || '<|end|>' || chr(10) AS c, rejected || '<|end|>' || chr(10) AS r,
                   CASE WHEN role = 'assistant' THEN '+' ELSE '-' END AS sign
            FROM turns JOIN ends USING (conv_id))
        SELECT conv_id AS pair_id, CAST(0 AS BIGINT) AS part, count(*) FILTER (turn < stop) AS prompt_turns,
               coalesce(string_agg(head || c, '' ORDER BY turn) FILTER (turn < stop), '') AS prompt,
               coalesce(string_agg(head || c, '' ORDER BY turn) FILTER (turn >= stop), '')
                   AS chosen,
               coalesce(string_agg('-' || length(head) || ' ' || sign || length(c), ' '
                                   ORDER BY turn) FILTER (turn >= stop), '') AS chosen_mask,
               coalesce(string_agg(head || r, '' ORDER BY turn) FILTER (turn >= stop), '')
                   AS rejected,
               coalesce(string_agg('-' || length(head) || ' ' || sign || length(r), ' '
                                   ORDER BY turn) FILTER (turn >= stop), '') AS rejected_mask
        FROM said GROUP BY conv_id
    """,
    "op11_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                                 ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (SELECT conv_id, turns, {_CRC.format("conv_id")} % 9 AS h FROM turns),
        rebuilt AS (
            SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h),
                                          list_slice(c.turns, h + 1, len(c.turns))) AS seq
            FROM heads c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5),
        members AS (
            SELECT conv_id, depth, list_slice(seq, 1, depth) AS path, len(seq) = depth AS ended
            FROM rebuilt, unnest(range(0, len(seq) + 1)) AS t(depth)),
        nodes AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * CASE WHEN depth = 0 THEN 0
                                         ELSE strlen(path[depth].text) END AS saved,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                   FILTER (ended), '')) AS ends_sha256
            FROM members GROUP BY path, depth),
        children AS (
            SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n_children
            FROM nodes WHERE depth > 0 GROUP BY 1),
        below AS (
            SELECT list_slice(n.path, 1, d) AS path, sum(saved) AS saved_tokens,
                   count(*) FILTER (c.path IS NULL) AS n_leaves
            FROM nodes n LEFT JOIN children c ON n.path = c.path,
                 unnest(range(0, n.depth + 1)) AS t(d)
            GROUP BY 1)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
               coalesce(c.n_children, 0) AS n_children, b.n_leaves,
               CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN below b ON n.path = b.path LEFT JOIN children c ON n.path = c.path
        LEFT JOIN nodes p ON n.depth > 0 AND p.path = list_slice(n.path, 1, n.depth - 1)
    """,
    # windows that overlap or touch are one run of bytes
    "op12_suffix_array": r"""
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        windows AS (
            SELECT doc_id, pos, md5(b[pos:pos + 399]) AS hash
            FROM d, unnest(range(1, octet_length(b) - 398)) AS t(pos)),
        found AS (
            SELECT doc_id, pos FROM windows
            WHERE hash IN (SELECT hash FROM windows GROUP BY hash HAVING count(*) > 1)),
        marked AS (
            SELECT doc_id, pos,
                   coalesce(pos > 400 + lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), true) AS new
            FROM found),
        runs AS (
            SELECT doc_id, pos, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS run
            FROM marked),
        spans AS (
            SELECT doc_id, min(pos) AS first, max(pos) + 399 AS last FROM runs GROUP BY doc_id, run),
        listed AS (
            SELECT doc_id, count(*) AS n_spans, CAST(sum(last - first + 1) AS BIGINT) AS n_removed,
                   list_sort(list({'first': first, 'last': last})) AS spans
            FROM spans GROUP BY doc_id)
        SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(array_to_string([
                   hex(b[1 + CASE WHEN i = 0 THEN 0 ELSE spans[i].last END
                         :CASE WHEN i = n_spans THEN octet_length(b) ELSE spans[i + 1].first - 1 END])
                   FOR i IN range(0, n_spans + 1)], '')) END) AS kept_sha256
        FROM d LEFT JOIN listed USING (doc_id)
    """,
    "op13_periodic_runs": rf"""
        WITH d AS (
            SELECT doc_id, {_CRC.format("doc_id")} AS h,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        numbers AS (
            SELECT doc_id, h, w, len(w) AS n, (h // 10) AS g,
                   CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
        docs AS (
            SELECT doc_id, n,
                   CASE WHEN h % 10 = 0 AND n > 0 THEN [
                       w[1 + CASE WHEN i < a THEN i
                                  ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]
                       FOR i IN range(0, n)] ELSE w END AS w
            FROM numbers),
        words AS (SELECT doc_id, n, i, w[i + 1] AS word FROM docs, unnest(range(0, n)) AS t(i)),
        same AS (
            SELECT a.doc_id, a.i, b.i - a.i AS q
            FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.word = b.word
            WHERE a.i < b.i AND 4 * (b.i - a.i) <= a.n),
        islands AS (
            SELECT doc_id, q, i,
                   i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
        stretches AS (
            SELECT doc_id, q, min(i) AS start, count(*) + q AS length
            FROM islands GROUP BY doc_id, q, island
            HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS (
            SELECT doc_id, start, length, min(q) AS period
            FROM stretches GROUP BY doc_id, start, length),
        told AS (
            SELECT doc_id, count(*) AS n_runs,
                   first({{'start': start, 'length': length, 'period': period}}
                         ORDER BY length / period DESC, start, period) AS best,
                   string_agg(concat(start, ',', length, ',', period, chr(10)), ''
                              ORDER BY start, period) AS lines
            FROM runs GROUP BY doc_id),
        kept AS (
            SELECT words.doc_id, string_agg(word, ' ' ORDER BY i) AS text
            FROM words WHERE NOT EXISTS (
                SELECT 1 FROM runs WHERE runs.doc_id = words.doc_id
                AND i >= start + period AND i < start + length)
            GROUP BY words.doc_id)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length,
               best.period AS period, 1000 * best.length // best.period AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256,
               sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM docs LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
}
