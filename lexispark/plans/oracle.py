"""ANSI SQL that computes each registered query independently on the same
tables, for comparison."""

from __future__ import annotations

from collections.abc import Mapping

from lexispark.functions.normalize import PUNCTUATION, STOP_WORDS
from lexispark.plans import inputs


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip_punctuation(c: str) -> str:
    return f"translate({c}, {_quoted(PUNCTUATION)}, '')"


def _strip_digits(c: str) -> str:
    # Line ends are spelled out: here "." would match more of them.
    return rf"regexp_replace({c}, '[0-9]+[^\n\r\x{{85}}\x{{2028}}\x{{2029}}]*', '', 'g')"


def _remove_stop_words(c: str) -> str:
    for word in STOP_WORDS:
        c = f"replace({c}, ' {word} ', ' ')"
    return c


def _hyphens(c: str) -> str:
    return f"regexp_replace({c}, '-+', ' ', 'g')"


def _separators(c: str) -> str:
    for run in (" +", r"\n+", r"\t+", r"\r+"):
        c = f"regexp_replace({c}, '{run}', '#', 'g')"
    return f"regexp_replace({c}, '#+', '::', 'g')"


def _trim(c: str) -> str:
    return rf"regexp_replace({c}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _normalize(c: str) -> str:
    kept = _remove_stop_words(f"lower({_strip_digits(_strip_punctuation(c))})")
    return _trim(_separators(_hyphens(kept)))


def _tokens(source: str, keys: str, text: str, prefix: str = "") -> str:
    """CTEs ``norm``, ``tok`` (arrays), ``pos`` (all tokens) and ``words``
    (non-blank ones), named with ``prefix``."""
    return f"""
    {prefix}norm AS (SELECT {keys}, {_normalize(text)} AS n FROM {source}),
    {prefix}tok AS (SELECT {keys}, CASE WHEN n = '::' THEN CAST([] AS VARCHAR[])
        ELSE string_split(regexp_replace(n, '::$', ''), '::') END AS toks FROM {prefix}norm),
    {prefix}spread AS (SELECT {keys}, toks, unnest(range(1, len(toks) + 1)) AS i FROM {prefix}tok),
    {prefix}pos AS (SELECT {keys}, CAST(i AS INTEGER) AS pos, {_trim('toks[i]')} AS term
        FROM {prefix}spread),
    {prefix}words AS (SELECT * FROM {prefix}pos WHERE term <> '')"""


def _values(queries: Mapping[int, str]) -> str:
    rows = ", ".join(f"({key}, {_quoted(text)})" for key, text in queries.items())
    return f"(SELECT * FROM (VALUES {rows}) v(query_id, text))"


DOCS = _tokens("documents", "doc_id", "coalesce(text, '')")
TF = f"""{DOCS},
    tf AS (SELECT term, doc_id, count(*) AS tf,
        string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
        FROM words GROUP BY term, doc_id),
    df AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term)"""
RANK = f"""{TF},
    lens AS (SELECT doc_id, len(toks) AS doc_len FROM tok),
    ilens AS (SELECT doc_id, sum(tf) AS doc_len FROM tf GROUP BY doc_id),
    st AS (SELECT (SELECT count(*) FROM documents) AS n,
        (SELECT sum(doc_len) FROM lens) AS total,
        (SELECT count(*) FROM ilens) AS n_indexed,
        (SELECT sum(doc_len) FROM ilens) AS total_indexed)"""
BIWORDS = f"""{DOCS},
    pairs AS (SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS following
        FROM pos),
    biwords AS (SELECT doc_id, trim(term || ' ' || following) AS biword FROM pairs
        WHERE following IS NOT NULL AND term || following <> '')"""


def _bag(queries: str) -> str:
    return _tokens(queries, "query_id", "text", "q") + """,
    bag AS (SELECT query_id, term, count(*) AS qtf FROM qwords GROUP BY query_id, term)"""


RANK_BAG = _bag(_values(inputs.RANK_QUERIES))
BENCHMARK_BAG = _bag("(SELECT item_id AS query_id, text FROM benchmark)")
INTEGER_IDF = "log10(CAST(n // df AS DOUBLE))"
REAL_IDF = "log10(n / CAST(df AS DOUBLE))"


def _tf_idf(idf: str, bag: str = RANK_BAG) -> str:
    return f"""WITH {RANK}, {bag}
    SELECT query_id, doc_id, round(sum({idf} * tf * {idf} * qtf) / max(doc_len), 6) AS score
    FROM bag JOIN df USING (term) JOIN tf USING (term) JOIN lens USING (doc_id), st
    GROUP BY query_id, doc_id"""


def _bm25_factored(idf: str, average: str) -> str:
    return f"""WITH {RANK}, {RANK_BAG},
    idfs AS (SELECT query_id, sum({idf}) AS sum_idf FROM bag JOIN df USING (term), st
        GROUP BY query_id)
    SELECT query_id, doc_id, round(sum(3e0 * tf /
        (2e0 * (0.25e0 + 0.75e0 * doc_len / ({average})) + tf)) * max(sum_idf), 6) AS score
    FROM bag JOIN tf USING (term) JOIN lens USING (doc_id) JOIN idfs USING (query_id), st
    GROUP BY query_id, doc_id"""


def _bm25(bag: str) -> str:
    return f"""WITH {RANK}, {bag},
    exact AS (SELECT query_id, doc_id, sum(qtf * tf * 3e0 /
        (tf + 2e0 * (0.25e0 + 0.75e0 * doc_len / (total_indexed / CAST(n_indexed AS DOUBLE))))
        * log10((n_indexed - df + 0.5e0) / (df + 0.5e0))) AS score
    FROM bag JOIN df USING (term) JOIN tf USING (term) JOIN ilens USING (doc_id), st
    GROUP BY query_id, doc_id),
    scores AS (SELECT query_id, doc_id, round(score, 6) AS score FROM exact)"""


def _top_10(bag: str) -> str:
    return _bm25(bag) + """,
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id
        ORDER BY round(score, 12) DESC, doc_id) AS INTEGER) AS rank FROM exact)
    SELECT query_id, doc_id, round(score, 6) AS score, rank FROM ranked WHERE rank <= 10"""


def _operands(source: str) -> str:
    # OR separates clauses, AND the operands of a clause.
    return rf"""qs AS (SELECT query_id, string_split_regex(text, '\s+OR\s+') AS sides
        FROM {source}),
    sides AS (SELECT query_id, sides, unnest(range(0, len(sides))) AS side FROM qs),
    cut AS (SELECT query_id, side, string_split_regex(sides[side + 1], '\s+AND\s+') AS parts
        FROM sides),
    numbered AS (SELECT *, unnest(range(0, len(parts))) AS i FROM cut),
    operands AS (SELECT query_id, CAST(side AS INTEGER) AS clause, i AS number,
        parts[i + 1] AS operand FROM numbered)"""


def _evaluated(terms: str) -> str:
    """Documents that meet any clause of ``clauses``; ``terms`` is (doc_id, term)."""
    return f"""
    needed AS (SELECT query_id, clause, count(*) AS n_terms FROM clauses GROUP BY ALL),
    met AS (SELECT query_id, clause, doc_id, count(*) AS n_met
        FROM clauses JOIN {terms} USING (term) GROUP BY ALL)
    SELECT DISTINCT query_id, doc_id FROM met JOIN needed USING (query_id, clause)
    WHERE n_met = n_terms"""


BOOLEAN = f"""WITH {DOCS}, {_operands(_values(inputs.BOOLEAN_QUERIES))},
    {_tokens('operands', 'query_id, clause', 'operand', 'o')},
    clauses AS (SELECT DISTINCT query_id, clause, term FROM owords),
    docterms AS (SELECT DISTINCT doc_id, term FROM words),
    {_evaluated('docterms')}"""
def _phrases(queries: Mapping[int, str]) -> str:
    """Phrases of two words are biwords; longer ones are runs of non-blank tokens."""
    runs = " UNION ".join(f"""
        SELECT doc_id, array_to_string(toks[i:i + {n} - 1], ' ') AS term FROM spread
        WHERE i + {n} - 1 <= len(toks) AND len([t FOR t IN toks[i:i + {n} - 1] IF t = '']) = 0"""
                          for n in range(3, 6))
    return f"""WITH {BIWORDS}, {_operands(_values(queries))},
    {_tokens('operands', 'query_id, clause, number', 'operand', 'o')},
    clauses AS (SELECT DISTINCT query_id, clause, term FROM (
        SELECT query_id, clause, number, string_agg(term, ' ' ORDER BY pos) AS term
        FROM owords GROUP BY ALL)),
    docterms AS (SELECT doc_id, biword AS term FROM biwords UNION {runs}),
    {_evaluated('docterms')}"""


PHRASES = _phrases(inputs.PHRASE_QUERIES)
LONG_PHRASES = _phrases(inputs.LONG_PHRASE_QUERIES)


def _id_lists(ctes: str, rows: str, key: str, bits: int, columns: str) -> str:
    return f"""WITH {ctes},
    lists AS (SELECT {key}, doc_id >> {bits} AS segment,
        string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY doc_id) AS doc_ids
        FROM (SELECT DISTINCT {key}, doc_id FROM {rows}) GROUP BY {key}, doc_id >> {bits})
    SELECT {columns} FROM lists"""


def _dense_lists(ctes: str, rows: str, key: str) -> str:
    """Lists by the number of the document in the order of sparse ids."""
    return f"""WITH {ctes},
    numbers AS (SELECT doc_id, {inputs.SPARSE_ID} AS id,
        row_number() OVER (ORDER BY {inputs.SPARSE_ID}) - 1 AS doc_no FROM documents)
    SELECT {key}, doc_no >> 8 AS segment,
        string_agg(CAST(id AS VARCHAR), ' ' ORDER BY id) AS doc_ids
        FROM (SELECT DISTINCT {key}, doc_id FROM {rows}) JOIN numbers USING (doc_id)
        GROUP BY {key}, doc_no >> 8"""


def _positional(bits: int, columns: str) -> str:
    return f"""WITH {TF},
    lists AS (SELECT term, doc_id >> {bits} AS segment,
        string_agg(doc_id || ':' || positions || ';', '' ORDER BY doc_id) AS docs
        FROM tf GROUP BY term, doc_id >> {bits})
    SELECT {columns} FROM lists JOIN df USING (term)"""


def _words(columns: str) -> str:
    return f"WITH {DOCS} SELECT doc_id, {columns} FROM words"


def _step(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS text FROM documents"


_ARTICLE = inputs.ARTICLE_XML.format(
    date="CAST(CAST(date '2000-01-01' + CAST(doc_id % 1000 AS INT) AS DATE) AS VARCHAR)"
)
_LINES = "{0} || chr(9) || doc_ids AS value"
_CONTENT = f"trim(source) || ' ' || trim(lang) || ' ' || {_trim('text')}"
_LENGTHS = f"WITH {DOCS} SELECT doc_id, CAST(len(toks) AS INTEGER) AS doc_len FROM tok"
_CF = f"WITH {TF} SELECT term, cf FROM df"
_DF = f"WITH {TF} SELECT term, df FROM df"
_COUNT = "SELECT count(*) AS n_docs FROM documents"
_ONE_BAG = _bag(_values({1: inputs.ONE_QUERY}))

ORACLE: dict[str, str] = {
    # sources
    "zip_entries": f"SELECT doc_id || '.xml' AS name, {_ARTICLE} AS content FROM documents",
    "zip_entries_manifest": f"SELECT doc_id || '.xml' AS name, {_ARTICLE} AS content FROM documents",
    "zip_entries_truncated": f"""SELECT doc_id || '.xml' AS name, {_ARTICLE} AS content
        FROM documents WHERE doc_id NOT IN (
            SELECT max(doc_id) FROM documents GROUP BY doc_id // {inputs.ARCHIVE_DOCS})""",
    "article_documents": f"SELECT doc_id, {_CONTENT} AS content FROM documents",
    "article_dates": """SELECT doc_id, CAST(CAST(date '2000-01-01' +
        CAST(doc_id % 1000 AS INT) AS DATE) AS VARCHAR) AS doc_date FROM documents""",
    "positional_text_scan": f"""WITH {TF} SELECT term, df, doc_id, tf, positions
        FROM tf JOIN df USING (term)""",
    "inverted_text_scan": f"WITH {TF} SELECT doc_id, term FROM tf",
    "positional_text_scan_long_lines": f"""WITH {TF} SELECT term, df, doc_id, tf, positions
        FROM tf JOIN df USING (term)""",
    "inverted_text_scan_long_lines": f"WITH {TF} SELECT doc_id, term FROM tf",
    "doc_count_file": _COUNT,
    "doc_lengths_file": _LENGTHS,
    # normalizer steps
    "strip_punctuation": _step(_strip_punctuation("text")),
    "strip_digit_tails": _step(_strip_digits("text")),
    "lowercase": _step("lower(text)"),
    "remove_stop_words": _step(_remove_stop_words("lower(text)")),
    "hyphens_to_spaces": _step(_hyphens("text")),
    "collapse_separators": _step(_separators(_strip_punctuation("text"))),
    "normalized_text": f"SELECT doc_id, {_normalize('text')} AS normalized FROM documents",
    "split_tokens": f"""WITH {DOCS} SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens,
        array_to_string(toks, '|') AS tokens FROM tok""",
    "nonblank_tokens": f"""WITH {DOCS},
        joined AS (SELECT doc_id, count(*) AS n, string_agg(term, '|' ORDER BY pos) AS t
            FROM words GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens, coalesce(t, '') AS tokens
        FROM tok LEFT JOIN joined USING (doc_id)""",
    "query_tokens": f"WITH {BENCHMARK_BAG} SELECT query_id, pos, term FROM qwords",
    "boolean_operands": f"""WITH {_operands('''(SELECT item_id AS query_id, text ||
        CASE WHEN item_id % 2 = 0 THEN ' AND ' ELSE ' OR ' END || reverse(text) AS text
        FROM benchmark)''')} SELECT query_id, clause, operand FROM operands""",
    "same_term": _words("pos, term") + " WHERE term = 'leon'",
    # generators
    "term_explode": _words("term"),
    "positional_explode": _words("pos, term"),
    "bigram_explode": f"WITH {BIWORDS} SELECT doc_id, biword FROM biwords",
    "posting_frequencies": f"WITH {TF} SELECT term, doc_id, tf FROM tf",
    "query_bags": f"WITH {BENCHMARK_BAG} SELECT query_id, term, qtf FROM bag",
    # filters and joins
    "term_filter": f"""WITH {TF}, {RANK_BAG} SELECT term, doc_id, tf FROM tf
        WHERE term IN (SELECT term FROM bag)""",
    "term_match": f"""WITH {DOCS}, {RANK_BAG},
        lists AS (SELECT term, string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY doc_id) AS doc_ids
            FROM (SELECT DISTINCT term, doc_id FROM words) GROUP BY term, doc_id >> 16)
        SELECT query_id, pos, term, doc_ids FROM qwords JOIN lists USING (term)""",
    "term_lookup": f"""WITH {DOCS} SELECT term,
        string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY doc_id) AS doc_ids
        FROM (SELECT DISTINCT term, doc_id FROM words) WHERE term = 'leon'
        GROUP BY term, doc_id >> 16""",
    "doc_length_join": f"""WITH {RANK} SELECT term, doc_id, tf,
        CAST(doc_len AS INTEGER) AS doc_len FROM tf JOIN lens USING (doc_id)""",
    "corpus_scalar_join": f"""WITH {RANK}, {RANK_BAG} SELECT query_id, term, doc_id, n AS n_docs,
        CAST(total // n AS BIGINT) AS average_length FROM bag JOIN tf USING (term), st""",
    "query_weight_join": f"""WITH {TF}, {RANK_BAG}
        SELECT query_id, term, doc_id, tf, qtf FROM bag JOIN tf USING (term)""",
    # indexes and aggregates
    "inverted_index": _id_lists(DOCS, "words", "term", 16, "term, segment, doc_ids"),
    "inverted_index_segments": _id_lists(DOCS, "words", "term", 8, "term, segment, doc_ids"),
    "inverted_index_sparse_ids": _dense_lists(DOCS, "words", "term"),
    "biword_index_sparse_ids": _dense_lists(BIWORDS, "biwords", "biword"),
    "biword_index": _id_lists(BIWORDS, "biwords", "biword", 16, "biword, segment, doc_ids"),
    "positional_postings": f"WITH {TF} SELECT term, doc_id, tf, positions FROM tf",
    "positional_index": _positional(8, "term, segment, df, docs"),
    "collection_frequency": _CF,
    "document_count": _COUNT,
    "document_lengths": _LENGTHS,
    "average_length_integer": f"""WITH {RANK}
        SELECT CAST(total // n AS DOUBLE) AS average_length FROM st""",
    "average_length_real": f"""WITH {RANK}
        SELECT round(total / CAST(n AS DOUBLE), 6) AS average_length FROM st""",
    "indexed_lengths": f"""WITH {RANK}
        SELECT doc_id, CAST(doc_len AS BIGINT) AS doc_len FROM ilens""",
    "indexed_document_count": f"WITH {RANK} SELECT n_indexed AS n_docs FROM st",
    "indexed_average_length": f"""WITH {RANK} SELECT
        round(total_indexed / CAST(n_indexed AS DOUBLE), 6) AS average_length FROM st""",
    "total_term_frequency": _CF,
    "document_frequency": _DF,
    "score_sum": f"""WITH {TF}, {RANK_BAG} SELECT query_id, doc_id,
        CAST(sum(tf * qtf) AS BIGINT) AS score
        FROM bag JOIN tf USING (term) GROUP BY query_id, doc_id""",
    "idf_sum": f"""WITH {RANK}, {RANK_BAG} SELECT query_id,
        round(sum({INTEGER_IDF}), 6) AS sum_idf
        FROM bag JOIN df USING (term), st GROUP BY query_id""",
    # boolean retrieval
    "boolean_and": f"""WITH {DOCS} SELECT doc_id FROM words WHERE term = 'this'
        INTERSECT SELECT doc_id FROM words WHERE term = 'tion'""",
    "boolean_or": f"""WITH {DOCS} SELECT doc_id FROM words WHERE term = 'leon'
        UNION SELECT doc_id FROM words WHERE term = 'tion'""",
    "boolean_search": BOOLEAN,
    "phrase_search": PHRASES,
    "phrase_search_long": LONG_PHRASES,
    "phrase_search_long_stored_index": LONG_PHRASES,
    "boolean_search_text_index": BOOLEAN,
    "result_counts": f"""SELECT query_id, count(doc_id) AS n_hits
        FROM {_values(inputs.BOOLEAN_QUERIES)} q LEFT JOIN ({BOOLEAN}) USING (query_id)
        GROUP BY query_id""",
    "no_results": _bm25(_bag(_values({1: "zzzabsent zzznone"})))
    + " SELECT query_id, doc_id, score FROM scores",
    # ranking
    "tf_idf": _tf_idf(INTEGER_IDF),
    "tf_idf_real": _tf_idf(REAL_IDF),
    "bm25_factored": _bm25_factored(INTEGER_IDF, "total // n"),
    "bm25_factored_real": _bm25_factored(REAL_IDF, "total / CAST(n AS DOUBLE)"),
    "bm25": _bm25(RANK_BAG) + " SELECT query_id, doc_id, score FROM scores",
    "bm25_top10": _top_10(_ONE_BAG),
    "bm25_top10_batch": _top_10(BENCHMARK_BAG),
    "results_in_key_order": _tf_idf(INTEGER_IDF) + " ORDER BY query_id, CAST(doc_id AS VARCHAR)",
    "bm25_stored_index": _bm25(RANK_BAG) + " SELECT query_id, doc_id, score FROM scores",
    "bm25_top10_block_max": _top_10(_ONE_BAG),
    "bm25_top10_batch_block_max": _top_10(BENCHMARK_BAG),
    "boolean_search_bitmaps": BOOLEAN,
    "boolean_search_stored_index": BOOLEAN,
    "phrase_search_stored_index": PHRASES,
    "tf_idf_text_index": _tf_idf(INTEGER_IDF),
    "bm25_factored_text_index": _bm25_factored(INTEGER_IDF, "total // n"),
    "bm25_text_index": _bm25(RANK_BAG) + " SELECT query_id, doc_id, score FROM scores",
    # sinks
    "inverted_index_text": _id_lists(DOCS, "words", "term", 16, _LINES.format("term")),
    "biword_index_text": _id_lists(BIWORDS, "biwords", "biword", 16, _LINES.format("biword")),
    "positional_index_text": _positional(
        12, "term || ':' || df || ';' || docs || chr(9) AS value"
    ),
    "search_results_text": f"SELECT doc_id, score FROM ({_tf_idf(INTEGER_IDF, _ONE_BAG)})",
    "replaced_output": f"SELECT * FROM ({_LENGTHS}) WHERE doc_len > 100",
}
