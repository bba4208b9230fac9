"""The same queries as SQL over the same tables, written from the definitions."""

from __future__ import annotations

from gleanrank.workload.inputs import CRAWLS, DOMAIN
from gleanrank.workload.queries import PAGE_QUERY, QUERY


def _split(text: str) -> str:
    """Rows of raw tokens of a text expression."""
    plain = rf"replace(regexp_replace(lower({text}), '\\[a-z]', ' ', 'g'), '-', ' ')"
    return rf"unnest(regexp_split_to_array({plain}, '[ \t\n\r\f]+'))"


def _tokens(source: str, id_col: str, text_col: str) -> str:
    return (
        "SELECT doc_id, term FROM (SELECT doc_id, regexp_replace(raw, '[0-9[:punct:]]', '', 'g') AS term "
        f"FROM (SELECT {id_col} AS doc_id, {_split(text_col)} AS raw FROM {source})) WHERE term <> ''"
    )


def _terms(source: str, id_col: str, text_col: str = "text") -> str:
    """CTEs: every document, its tokens, counts, lengths, frequencies and the corpus statistics."""
    return f"""WITH docs AS (SELECT DISTINCT {id_col} AS doc_id FROM {source}),
tok AS ({_tokens(source, id_col, text_col)}),
tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM tok GROUP BY doc_id, term),
len AS (SELECT d.doc_id, CAST(count(t.term) AS BIGINT) AS doc_len
        FROM docs d LEFT JOIN tok t ON d.doc_id = t.doc_id GROUP BY d.doc_id),
df AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
stats AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, avg(doc_len) AS avg_len FROM len)"""


def _query(query: str) -> str:
    text = query.replace("'", "''")
    return f"""q AS (SELECT term, CAST(count(*) AS BIGINT) AS qtf
      FROM ({_tokens(f"(SELECT 0 AS doc_id, '{text}' AS text)", "doc_id", "text")}) GROUP BY term)"""


IDF = "ln((CAST(n_docs AS DOUBLE) - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1)"
TFDF_WEIGHT = "CAST(tf AS DOUBLE) / df"

TFDF_SCORES = """scores AS (SELECT docs.doc_id, round(coalesce(s.score, 0), 9) AS score
  FROM docs LEFT JOIN (
    SELECT tf.doc_id, sum((CAST(q.qtf AS DOUBLE) / df.df) * (CAST(tf.tf AS DOUBLE) / df.df)) AS score
    FROM tf JOIN df ON tf.term = df.term JOIN q ON tf.term = q.term GROUP BY tf.doc_id
  ) s ON docs.doc_id = s.doc_id)"""

BM25_SCORES = f"""scores AS (SELECT docs.doc_id, round(coalesce(s.score, 0), 6) AS score
  FROM docs LEFT JOIN (
    SELECT tf.doc_id, sum({IDF} * (tf.tf * 3.0::DOUBLE)
      / (tf.tf + 2.0::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len.doc_len / avg_len))) AS score
    FROM tf JOIN df ON tf.term = df.term JOIN q ON tf.term = q.term
      JOIN len ON tf.doc_id = len.doc_id CROSS JOIN stats
    GROUP BY tf.doc_id
  ) s ON docs.doc_id = s.doc_id)"""

DOCS = _terms("documents", "doc_id")
DOCS_AND_EMPTY = _terms("(SELECT doc_id, text FROM documents UNION ALL SELECT -1, '')", "doc_id")
PAGES = _terms("pages", "page_id", "html")
TFDF = f"{DOCS}, {_query(QUERY)}, {TFDF_SCORES}"
BM25 = f"{DOCS}, {_query(QUERY)}, {BM25_SCORES}"


def _top(scores: str, n: int) -> str:
    return (
        f"{scores}, top AS (SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, score "
        f"FROM scores ORDER BY score DESC, doc_id LIMIT {n})"
    )


def _top_with_source(scores: str) -> str:
    return (
        f"{_top(scores, 10)} SELECT rank, top.doc_id, lang, source, score "
        "FROM top LEFT JOIN documents d ON top.doc_id = d.doc_id"
    )


IN_CRAWLS = ", ".join(f"'{crawl}'" for crawl in CRAWLS)
HOST = "lower(regexp_extract(url, '^https?://([^/:?#]+)', 1))"
OF_DOMAIN = f"({HOST} = '{DOMAIN}' OR {HOST} LIKE '%.{DOMAIN}')"

CRAWL = f"""WITH p AS (SELECT page_id, html,
    CASE WHEN page_id % 5 = 0 THEN url || '?ref={DOMAIN}' ELSE url END AS url,
    'crawl-data/main/segments/' || (page_id // 10 % 2) || '/warc/' || CASE WHEN page_id // 10 = 4 THEN 'part 2'
    ELSE 'part-' || (page_id // 10 // 2) END || CASE WHEN page_id // 10 = 6 THEN '.warc' ELSE '.warc.gz' END AS filename,
    regexp_extract(html, '<title>([^<]*)</title>', 1) AS raw_title FROM pages),
captures AS (SELECT page_id AS pos,
    CASE WHEN page_id % 2 = 0 THEN '{CRAWLS[1]}' ELSE '{CRAWLS[0]}' END AS crawl, url,
    CASE WHEN page_id % 7 = 0 THEN '404' ELSE '200' END AS status, filename FROM p),
records AS (SELECT page_id, filename, url, trim(raw_title) AS title,
    regexp_replace(raw_title || chr(10) || html, '\\n+$', '') AS body FROM p),
fields AS (SELECT page_id, filename, url, title, replace(body, chr(10), ' ') AS text FROM records)"""

POSTINGS = "FROM tf JOIN len ON tf.doc_id = len.doc_id"

ORACLE: dict[str, str] = {
    "token_counts": f"{DOCS} SELECT doc_id, doc_len AS n_tokens FROM len",
    "distinct_terms": f"{DOCS} SELECT DISTINCT doc_id, term FROM tok",
    "doc_freq": f"{DOCS} SELECT term, CAST(count(DISTINCT doc_id) AS BIGINT) AS df FROM tok GROUP BY term",
    "term_freq": f"{DOCS} SELECT doc_id, term, tf FROM tf",
    "doc_length": f"{DOCS} SELECT doc_id, doc_len FROM len",
    "corpus_stats": f"{DOCS} SELECT n_docs, round(avg_len, 6) AS avg_len FROM stats",
    "merged_documents":
        f"{_terms('conversations', 'conv_id')} SELECT tf.doc_id, term, tf, doc_len {POSTINGS}",
    "tfdf_postings":
        f"{DOCS} SELECT doc_id, tf.term, tf, round({TFDF_WEIGHT}, 9) AS weight FROM tf JOIN df ON tf.term = df.term",
    "doc_vectors":
        f"{DOCS_AND_EMPTY} SELECT len.doc_id, doc_len, coalesce(string_agg(term || '=' || tf, ' ' ORDER BY term), '') "
        "AS vector FROM len LEFT JOIN tf ON tf.doc_id = len.doc_id GROUP BY len.doc_id, doc_len",
    "doc_vectors_tfdf":
        f"{DOCS_AND_EMPTY} SELECT len.doc_id, doc_len, coalesce(string_agg(tf.term || '=' || "
        f"CAST(round({TFDF_WEIGHT} * 1e6::DOUBLE) AS BIGINT), ' ' ORDER BY tf.term), '') AS vector "
        "FROM len LEFT JOIN (tf JOIN df ON tf.term = df.term) ON tf.doc_id = len.doc_id GROUP BY len.doc_id, doc_len",
    "bm25_idf": f"{DOCS} SELECT term, df, round({IDF}, 6) AS idf FROM df CROSS JOIN stats",
    "query_weights_tfdf":
        f"{DOCS}, {_query(QUERY)} SELECT q.term, round(CAST(qtf AS DOUBLE) / df, 9) AS weight "
        "FROM q JOIN df ON q.term = df.term",
    "query_weights_bm25":
        f"{DOCS}, {_query(QUERY)} SELECT q.term, round({IDF}, 6) AS weight "
        "FROM q JOIN df ON q.term = df.term CROSS JOIN stats",
    "score_tfdf_all": f"{TFDF} SELECT doc_id, score FROM scores",
    "score_bm25_all": f"{BM25} SELECT doc_id, score FROM scores",
    "search_tfdf_top10": _top_with_source(TFDF),
    "search_bm25_top10": _top_with_source(BM25),
    "search_unknown_words":
        "SELECT row_number() OVER (ORDER BY doc_id) AS rank, doc_id, CAST(0 AS DOUBLE) AS score "
        "FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 3)",
    "search_pages_top10":
        f"{_top(f'{PAGES}, {_query(PAGE_QUERY)}, {BM25_SCORES}', 10)} SELECT rank, "
        "'Id: ' || doc_id || '    Title: ' || trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) "
        "|| '    URL: ' || url || '   Score: ' || score AS line FROM top JOIN pages ON doc_id = page_id",
    "index_titles":
        f"{_top(f'{PAGES}, {_query(PAGE_QUERY)}, {BM25_SCORES}', 10)} SELECT rank, doc_id, "
        "trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, url, score FROM top JOIN pages ON doc_id = page_id",
    "ranked_all": f"{BM25} SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores",
    "ranking_table": f"{TFDF} SELECT score, doc_id FROM scores",
    "index_df": f"{DOCS} SELECT term, df FROM df",
    "index_postings":
        f"{DOCS} SELECT tf.doc_id, tf.term, tf, doc_len, round({TFDF_WEIGHT}, 9) AS weight "
        f"{POSTINGS} JOIN df ON tf.term = df.term",
    "index_stats": f"{DOCS} SELECT n_docs, round(avg_len, 6) AS avg_len FROM stats",
    "index_scores_tfdf":
        f"{TFDF} SELECT doc_id, score FROM scores WHERE doc_id IN "
        "(SELECT doc_id FROM tf WHERE term IN (SELECT term FROM q))",
    "index_roundtrip_search": _top_with_source(BM25),
    "index_roundtrip_tfdf": f"{_top(TFDF, 10)} SELECT rank, doc_id, score FROM top",
    "captures_by_domain":
        f"{CRAWL} SELECT pos, crawl, url, status, filename FROM captures WHERE {OF_DOMAIN} AND crawl IN ({IN_CRAWLS})",
    "captures_per_crawl":
        f"{CRAWL} SELECT crawl, CAST(count(*) AS BIGINT) AS n_captures FROM captures WHERE {OF_DOMAIN} GROUP BY crawl",
    "rejected_captures": f"{CRAWL} SELECT pos, status, filename FROM captures WHERE status <> '200'",
    "wet_locations":
        f"{CRAWL} SELECT 'https://data.commoncrawl.org/' || replace(replace(filename, '/warc/', '/wet/'), "
        "'.warc.gz', '.warc.wet.gz') AS wet, "
        "regexp_extract(filename, '/warc/([^/]*warc[.])gz$', 1) AS name, "
        "CAST(min(pos) AS BIGINT) AS wet_pos FROM captures GROUP BY filename",
    "wet_scan": f"{CRAWL} SELECT url AS uri, body FROM records",
    "domain_records":
        f"{CRAWL} SELECT CASE WHEN page_id % 3 = 0 THEN 'extract-0' ELSE 'extract-' || (page_id % 4) END AS file, "
        f"url AS uri, body FROM records WHERE contains(url, '{DOMAIN}')",
    "domain_records_strict": f"{CRAWL} SELECT page_id, url AS uri FROM records WHERE {OF_DOMAIN}",
    "record_fields": f"{CRAWL} SELECT page_id, url, title, text FROM fields",
    "sequential_ids":
        "SELECT page_id, id, (id - 1) // 200 AS batch FROM (SELECT page_id, row_number() OVER (ORDER BY "
        "CASE WHEN page_id % 3 = 0 THEN 11 ELSE page_id % 13 END, page_id) AS id FROM pages)",
    "corpus_roundtrip":
        "SELECT page_id AS id, url, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, "
        "html AS text FROM pages",
    "corpus_arrays":
        "SELECT page_id AS id, url, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, "
        "html AS text FROM pages",
    "search_sizes":
        f"{BM25} SELECT n::INT AS n, zeros, least(n, count(*) FILTER (zeros OR score > 0))::BIGINT AS hits "
        "FROM scores, (SELECT unnest([0, 1, 1000]) AS n), (SELECT unnest([true, false]) AS zeros) GROUP BY n, zeros",
    "extract_roundtrip": f"{CRAWL} SELECT url, title, text FROM fields",
    "extract_order": f"{CRAWL} SELECT row_number() OVER (ORDER BY page_id) AS id, url, title FROM fields",
    "domain_corpus":
        f"""{CRAWL}, wets AS (SELECT filename, min(pos) AS wet_pos FROM captures
  WHERE {OF_DOMAIN} AND crawl IN ({IN_CRAWLS}) GROUP BY filename),
numbered AS (SELECT row_number() OVER (ORDER BY wet_pos, page_id) AS id, url, title, text
  FROM fields JOIN wets ON fields.filename = wets.filename WHERE contains(url, '{DOMAIN}'))
SELECT id, url, title, text, (id - 1) // 200 AS batch FROM numbered""",
}
