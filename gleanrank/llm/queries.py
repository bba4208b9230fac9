"""Each numbered operator as a query over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanrank.llm.decontaminate import benchmark_leaks
from gleanrank.llm.embedding_forest import near_vectors
from gleanrank.llm.filter_audit import audit_documents
from gleanrank.llm.license_scan import scan_licences
from gleanrank.llm.mixing import mix_sources
from gleanrank.llm.parity_join import similar_sets
from gleanrank.llm.sentence_spans import remove_repeated_spans
from gleanrank.llm.sentencepiece_table import encode_pieces
from gleanrank.llm.spelling import spelling_variants, word_counts
from gleanrank.llm.token_files import token_digests, write_tokens
from gleanrank.llm.toxicity import score_toxicity
from gleanrank.llm.url_filter import filter_urls, host_of
from gleanrank.llm.warc import read_pages, write_pages
from gleanrank.session import new_scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Rules of the URL query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
# Hosts whose pages make up the list of blocked URLs.
LISTED_HOSTS = "(^|[.])(ads-track|spam-farm|casino-win|adult-x|cheap-pills|free-bets)[.]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    listed = pages.filter(host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return filter_urls(pages, rules, listed)


def op2_source_mix(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark, sf_dir):
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_token_files(spark, sf_dir):
    path = new_scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_digests(spark, path)


def op7_ngram_jaccard_join(spark, sf_dir):
    return similar_sets(table(spark, sf_dir, "documents"))[0]


def op8_licence_scan(spark, sf_dir):
    return scan_licences(table(spark, sf_dir, "documents"))


def op9_sentence_spans(spark, sf_dir):
    return remove_repeated_spans(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    path = new_scratch(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    return read_pages(spark, path)


def op11_spelling_variants(spark, sf_dir):
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), typo_every=31))


def op12_filter_audit(spark, sf_dir):
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_sentencepiece(spark, sf_dir):
    told = encode_pieces(table(spark, sf_dir, "documents"), PIECES, decoded=True)
    return told.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_source_mix, op3_toxicity, op4_decontamination, op5_embedding_near_dedup, op6_token_files, op7_ngram_jaccard_join,
        op8_licence_scan, op9_sentence_spans, op10_warc, op11_spelling_variants, op12_filter_audit, op13_sentencepiece,
    )
}

_QUERY = r"^[^?#]*\?([^#]*)"
_AFTER = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"

ORACLE: dict[str, str] = {
    "op1_url_filter": f"""
        WITH cut AS (SELECT page_id, coalesce({_AFTER}, '') AS rest FROM pages),
        parts AS (
            SELECT page_id, rest,
                translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                array_to_string(list_filter(string_split(regexp_extract(rest, '{_QUERY}', 1), '&'),
                    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')), '&') AS query
            FROM cut),
        canon AS (
            SELECT page_id, host, path, CASE WHEN host = '' AND path = '' AND query = '' THEN '' ELSE
                regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '')
                || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical
            FROM parts),
        listed AS (
            SELECT DISTINCT canonical FROM canon
            WHERE regexp_matches(host, '{LISTED_HOSTS}')),
        ruled AS (
            SELECT page_id, host, path, canonical,
                CASE
                    WHEN '.' || host LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
                    WHEN '.' || host LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
                    WHEN '.' || host LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
                    WHEN '.' || host LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
                    WHEN '.' || host LIKE '%.org' AND path LIKE '/%' THEN 'org/'
                END AS rule
            FROM canon)
        SELECT page_id, host, path, rule,
            CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN canonical <> '' AND canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict,
            canonical <> '' AND canonical IN (SELECT canonical FROM listed) AS listed
        FROM ruled""",
    "op10_warc": """
        WITH bodies AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (
            SELECT payload_digest, min(page_id) AS first FROM bodies WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, b.payload_digest,
            CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM bodies b LEFT JOIN firsts f ON b.payload_digest = f.payload_digest""",
    # Bytes of a text from its hexadecimal digits, then crc32 by its table.
    "op11_spelling_variants": """
        WITH RECURSIVE entries AS (
            SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t
            FROM range(256) r(i)),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            WHERE length(run) >= 7 GROUP BY 1, 2),
        hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h
            FROM (SELECT run, n, hex(encode(doc_id::VARCHAR || ':' || run)) AS h FROM runs), entries),
        words AS (
            SELECT word, sum(n)::BIGINT AS n FROM (
                SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
                FROM hashed)
            WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
        cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, max(n) AS form_n, min_by(other, struct_pack(a := -n, b := encode(other))) AS form
            FROM near GROUP BY 1),
        told AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
                CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
            FROM words w LEFT JOIN best b ON w.word = b.word),
        chains AS (
            SELECT word, word AS reached, 0 AS step FROM told
            UNION ALL SELECT c.word, f.form, step + 1 FROM chains c JOIN told f ON c.reached = f.word WHERE f.form IS NOT NULL),
        ends AS (SELECT word, max_by(reached, step) AS root FROM chains GROUP BY 1)
        SELECT t.word, form, root, n, n_near, form_n FROM told t JOIN ends e ON t.word = e.word""",
    # Every order over the counts of each source and set of failing filters.
    "op12_filter_audit": r"""
        WITH read AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
        failing AS (
            SELECT part, (len(words) < 200)::INT AS a, (100 * len(list_distinct(words)) < 50 * len(words))::INT AS b,
                (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text))::INT AS c,
                regexp_matches(text, '[#$%&*|]')::INT AS d, (min(doc_id) OVER (PARTITION BY text) < doc_id)::INT AS e,
                coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic
            FROM read LEFT JOIN marks USING (doc_id)),
        kinds AS (
            SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL),
        letters AS (SELECT unnest(range(5)) AS i),
        orders AS (
            SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM letters p, letters q, letters r, letters s, letters t
            WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
        steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
        counted AS (
            SELECT part, o, step, n, good, toxic, fails[o[step] + 1] = 1 AS own,
                list_sum(list_transform(o[1:step - 1], lambda i: fails[i + 1])) > 0 AS before, list_sum(fails) = 1 AS only_one
            FROM kinds, steps),
        told AS (
            SELECT part, o, step, sum(CASE WHEN before OR own THEN 0 ELSE n END) AS kept,
                sum(CASE WHEN own AND before IS NOT TRUE THEN n ELSE 0 END) AS removed, sum(CASE WHEN own AND before THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN own AND only_one THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN own AND before IS NOT TRUE THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN own AND before IS NOT TRUE THEN toxic ELSE 0 END) AS toxic_lost
            FROM counted GROUP BY ALL)
        SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i + 1, 1)), '') AS filter_order, step::INT AS step,
            kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
            good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
            sum(removed) OVER (PARTITION BY part, o[step])::BIGINT AS shapley
        FROM told""",
}
