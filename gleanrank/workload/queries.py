"""Every operator as a query over the given tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanrank.functions.scoring import bm25_idf
from gleanrank.functions.text import tokenize
from gleanrank.operators import captures as cap
from gleanrank.operators import ranking, records as rec, terms
from gleanrank.operators.numbering import batch_of, number_rows
from gleanrank.plans.corpus import build_corpus, record_order
from gleanrank.plans.extract import extract_domain
from gleanrank.plans.index import build_index
from gleanrank.plans.search import document_scores, index_scores, search, search_documents
from gleanrank.session import materialize, new_scratch
from gleanrank.sinks.tables import write_capture_index, write_corpus, write_extracts, write_ranking, write_rejects
from gleanrank.sources.records import read_extract_table, read_extracts, read_wet
from gleanrank.sources.tables import read_capture_index, read_corpus, read_df, read_postings, read_ranking, read_stats
from gleanrank.workload import inputs
from gleanrank.workload.inputs import CRAWLS, DOMAIN, table

# A repeated term, frequent terms, a hyphen and a term that no document has.
QUERY = "the que und-der THE, zzzz of la"
PAGE_QUERY = "the article-que und"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.texts(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id")


def page_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.texts(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", F.trim(inputs.page_title()).alias("title"),
        F.col("html").alias("text"),
    )


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the documents table has in the place of titles and urls."""
    return table(spark, sf_dir, "documents", "doc_id", "lang", "source").withColumnRenamed("doc_id", "id")


def rounded(scores: DataFrame, digits: int) -> DataFrame:
    return scores.withColumn("score", F.round("score", digits))


# --- terms ---------------------------------------------------------------------------------------

def token_counts(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select(F.col("id").alias("doc_id"), F.size(tokenize(F.col("text"))).cast("bigint").alias("n_tokens"))


def distinct_terms(spark, sf_dir):
    return terms.distinct_terms(documents(spark, sf_dir))


def doc_freq(spark, sf_dir):
    return terms.doc_freq(terms.distinct_terms(documents(spark, sf_dir)))


def term_freq(spark, sf_dir):
    return terms.term_freq(documents(spark, sf_dir))


def doc_length(spark, sf_dir):
    return terms.doc_lengths(documents(spark, sf_dir))


def corpus_stats(spark, sf_dir):
    stats = terms.corpus_stats(terms.doc_lengths(documents(spark, sf_dir)))
    return stats.select("n_docs", F.round("avg_len", 6).alias("avg_len"))


def _postings(docs: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Merged (tf, lengths), both from one stored pass over the texts."""
    rows = materialize(terms.row_postings(docs, id_col, "text"), "rows")
    once, again, lengths = terms.split_repeated(rows, rows.filter("head").select("doc_id", "doc_len"))
    tf = once.filter("term is not null").select("doc_id", "term", "tf")
    return tf if again is None else materialize(tf.unionByName(terms.merge_term_freq(again)), "tf"), lengths


def _weighted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(TF/DF weighted terms, lengths)."""
    tf, lengths = _postings(docs)
    return terms.with_tfdf_weight(tf, materialize(terms.doc_freq(tf), "df")), lengths


def merged_documents(spark, sf_dir):
    turns = inputs.texts(spark, sf_dir, "conversations", "conv_id", "text")
    tf, lengths = _postings(turns, "conv_id")
    return terms.with_lengths(tf, lengths).select("doc_id", "term", "tf", "doc_len")


def tfdf_postings(spark, sf_dir):
    weighted, _ = _weighted(documents(spark, sf_dir))
    return weighted.select("doc_id", "term", "tf", F.round("weight", 9).alias("weight"))


def _with_empty(docs: DataFrame) -> DataFrame:
    """The documents and one without a text, whose id is -1."""
    empty = docs.sparkSession.createDataFrame([(-1, "")], "id bigint, text string")
    return docs.select("id", "text").union(empty)


def doc_vectors(spark, sf_dir):
    tokens = terms.with_tokens(_with_empty(documents(spark, sf_dir)))
    counts = materialize(terms.count_in_row(tokens), "rows")
    once, again, lengths = terms.split_repeated(counts, counts.select("doc_id", "doc_len"))
    vectors = terms.row_vectors(once)
    if again is not None:
        others = lengths.join(once.select(F.col("doc_id").alias("_id")), F.expr("doc_id <=> _id"), "left_anti")
        tf = terms.merge_term_freq(again.select("doc_id", F.inline("_runs")))
        vectors = vectors.unionByName(terms.doc_vectors(tf, others, value="tf"))
    entries = F.transform(
        F.sort_array(F.map_entries("vector")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return vectors.select("doc_id", "doc_len", F.array_join(entries, " ").alias("vector"))


def doc_vectors_tfdf(spark, sf_dir):
    weighted, lengths = _weighted(_with_empty(documents(spark, sf_dir)))
    entries = F.transform(
        F.sort_array(F.map_entries("vector")),
        lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 1e6).cast("bigint").cast("string")),
    )
    return terms.doc_vectors(weighted, lengths).select("doc_id", "doc_len", F.array_join(entries, " ").alias("vector"))


# --- query weights, scores, ranking --------------------------------------------------------------

def bm25_idf_table(spark, sf_dir):
    # One stored pass over the texts; frequencies and statistics need no counts of terms.
    tokens = terms.with_tokens(documents(spark, sf_dir))
    rows = materialize(tokens.select(
        "doc_id", F.size("tokens").cast("bigint").alias("doc_len"), F.array_distinct("tokens").alias("terms")
    ), "terms")
    pairs = rows.select("doc_id", F.explode("terms").alias("term")).distinct()
    df, stats = terms.doc_freq(pairs), terms.corpus_stats(terms.merge_lengths(rows.select("doc_id", "doc_len")))
    return df.crossJoin(F.broadcast(stats)).select(
        "term", "df", F.round(bm25_idf(F.col("n_docs"), F.col("df")), 6).alias("idf")
    )


def _query_df(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Document frequencies of the query's terms only: other terms are dropped before the shuffle."""
    names = [row["term"] for row in wanted.collect()]
    return terms.doc_freq(terms.distinct_terms(docs).filter(F.col("term").isin(names)))


def query_weights_tfdf(spark, sf_dir):
    wanted = ranking.query_terms(spark, QUERY)
    weights = ranking.query_weights(wanted, _query_df(documents(spark, sf_dir), wanted), "tfdf")
    return weights.select("term", F.round("weight", 9).alias("weight"))


def query_weights_bm25(spark, sf_dir):
    docs = documents(spark, sf_dir)
    wanted = ranking.query_terms(spark, QUERY)
    stats = terms.corpus_stats(terms.doc_lengths(docs))
    weights = ranking.query_weights(wanted, _query_df(docs, wanted), "bm25", stats)
    return weights.select("term", F.round("weight", 6).alias("weight"))


def score_tfdf_all(spark, sf_dir):
    return rounded(document_scores(documents(spark, sf_dir), QUERY, "tfdf"), 9)


def score_bm25_all(spark, sf_dir):
    return rounded(document_scores(documents(spark, sf_dir), QUERY, "bm25"), 6)


def _top10(spark, sf_dir, model, digits):
    scores = rounded(document_scores(documents(spark, sf_dir), QUERY, model), digits)
    source = _sources(spark, sf_dir)
    return ranking.attach_titles(ranking.top_k(scores, 10), source, ["lang", "source"])


def search_tfdf_top10(spark, sf_dir):
    return _top10(spark, sf_dir, "tfdf", 9)


def search_bm25_top10(spark, sf_dir):
    return _top10(spark, sf_dir, "bm25", 6)


def search_unknown_words(spark, sf_dir):
    return search_documents(documents(spark, sf_dir), "zzzz 42", 3, "bm25")


def search_pages_top10(spark, sf_dir):
    corpus = page_corpus(spark, sf_dir)
    scores = rounded(document_scores(corpus, PAGE_QUERY, "bm25"), 6)
    return ranking.format_results(ranking.attach_titles(ranking.top_k(scores, 10), corpus))


def index_titles(spark, sf_dir):
    index = new_scratch(spark, "index-titles")
    build_index(page_corpus(spark, sf_dir), index, "bm25")
    return rounded(search(spark, index, PAGE_QUERY, 10, "bm25", titles=True), 6)


def ranked_all(spark, sf_dir):
    return ranking.rank_all(rounded(document_scores(documents(spark, sf_dir), QUERY, "bm25"), 6))


def ranking_table(spark, sf_dir):
    path = new_scratch(spark, "ranking")
    write_ranking(rounded(document_scores(documents(spark, sf_dir), QUERY, "tfdf"), 9), path)
    return read_ranking(spark, path)


# --- stored index --------------------------------------------------------------------------------

def _index(spark, sf_dir, model):
    index = new_scratch(spark, f"index-{model}")
    build_index(documents(spark, sf_dir), index, model)
    return index


def index_df(spark, sf_dir):
    return read_df(spark, _index(spark, sf_dir, "bm25"))


def index_postings(spark, sf_dir):
    return read_postings(spark, _index(spark, sf_dir, "tfdf"), "tfdf").withColumn("weight", F.round("weight", 9))


def index_stats(spark, sf_dir):
    stats = read_stats(spark, _index(spark, sf_dir, "bm25"))
    return stats.select("n_docs", F.round("avg_len", 6).alias("avg_len"))


def index_scores_tfdf(spark, sf_dir):
    return rounded(index_scores(spark, _index(spark, sf_dir, "tfdf"), QUERY, "tfdf"), 9)


def index_roundtrip_search(spark, sf_dir):
    hits = search(spark, _index(spark, sf_dir, "bm25"), QUERY, 10, "bm25")
    source = _sources(spark, sf_dir)
    return rounded(ranking.attach_titles(hits, source, ["lang", "source"]), 6)


def index_roundtrip_tfdf(spark, sf_dir):
    return rounded(search(spark, _index(spark, sf_dir, "tfdf"), QUERY, 10, "tfdf"), 9)


# --- crawl side ----------------------------------------------------------------------------------

def _captures(spark, sf_dir):
    return inputs.captures(table(spark, sf_dir, "pages"))


def captures_by_domain(spark, sf_dir):
    path = new_scratch(spark, "captures")
    write_capture_index(_captures(spark, sf_dir), path)
    return cap.index_captures(read_capture_index(spark, path), DOMAIN, CRAWLS)


def captures_per_crawl(spark, sf_dir):
    hits = cap.index_captures(_captures(spark, sf_dir), DOMAIN)
    return hits.groupBy("crawl").agg(F.count(F.lit(1)).alias("n_captures"))


def rejected_captures(spark, sf_dir):
    path = new_scratch(spark, "rejects")
    write_rejects(cap.rejected_captures(_captures(spark, sf_dir)), path)
    return spark.read.parquet(path)


def wet_locations(spark, sf_dir):
    return cap.wet_locations(_captures(spark, sf_dir))


def wet_scan(spark, sf_dir):
    root = inputs.write_archives(table(spark, sf_dir, "pages"))
    scanned = read_wet(spark, f"{root}/crawl-data/main/segments/*/wet/*")
    return scanned.select("uri", "body")


def domain_records(spark, sf_dir):
    found = rec.assemble_records(rec.segment_lines(
        inputs.record_lines(table(spark, sf_dir, "pages")), word=DOMAIN))
    return rec.filter_domain(found, DOMAIN).select("file", "uri", "body")


def domain_records_strict(spark, sf_dir):
    found = rec.parse_records(inputs.records(table(spark, sf_dir, "pages")))
    return rec.filter_domain(found, DOMAIN, strict=True).select("page_id", "uri")


def record_fields(spark, sf_dir):
    return rec.record_fields(rec.parse_records(inputs.records(table(spark, sf_dir, "pages"))))


def sequential_ids(spark, sf_dir):
    number = F.when(F.col("page_id") % 3 == 0, 11).otherwise(F.col("page_id") % 13)
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit("Results-Multi"), number.cast("string"), F.lit(".txt")).alias("file"),
        F.lit(0).alias("block"), F.col("page_id").alias("pos"),
    )
    numbered = number_rows(pages, record_order(pages), name="id")
    return numbered.select("page_id", "id", batch_of(F.col("id"), 200).alias("batch"))


def corpus_roundtrip(spark, sf_dir):
    path = new_scratch(spark, "corpus")
    docs = page_corpus(spark, sf_dir).withColumn("batch", batch_of(F.col("id"), 200, start=0))
    write_corpus(docs, path)
    return read_corpus(spark, path)


def corpus_arrays(spark, sf_dir):
    """Documents of JSON files that each hold one array."""
    path = new_scratch(spark, "corpus-arrays")
    docs = page_corpus(spark, sf_dir).withColumn("batch", batch_of(F.col("id"), 200, start=0))
    entry = F.struct(F.col("id").cast("string").alias("id"), "url", "title", "text")
    arrays = docs.groupBy("batch").agg(F.to_json(F.collect_list(entry)).alias("value"))
    arrays.write.partitionBy("batch").text(path)
    return read_corpus(spark, path, multi_line=True).select("id", "url", "title", "text")


def search_sizes(spark, sf_dir):
    """Number of hits for the least and the largest lists that can be asked for, with and without documents of score 0."""
    docs, rows = documents(spark, sf_dir), None
    for n in (0, 1, 1000):
        for zeros in (True, False):
            hits = search_documents(docs, QUERY, n, "bm25", include_zero=zeros)
            told = hits.agg(F.lit(n).alias("n"), F.lit(zeros).alias("zeros"), F.count(F.lit(1)).alias("hits"))
            rows = told if rows is None else rows.union(told)
    return rows


def extract_roundtrip(spark, sf_dir):
    path = new_scratch(spark, "extracts")
    found = rec.parse_records(inputs.records(table(spark, sf_dir, "pages")))
    write_extracts(
        found.select(
            F.lit("pages").alias("file"), F.lit(0).alias("block"), F.col("page_id").alias("pos"), "uri",
            "header", "body", batch_of(F.col("page_id"), 50, start=0).alias("batch"),
        ),
        path, format="text",
    )
    return rec.record_fields(read_extracts(spark, path).select("uri", "body"))


def extract_order(spark, sf_dir):
    path = new_scratch(spark, "extracts")
    found = rec.parse_records(inputs.records(table(spark, sf_dir, "pages")))
    write_extracts(
        found.select(
            F.lit("pages").alias("file"), F.lit(0).alias("block"), F.col("page_id").alias("pos"), "uri",
            "header", "body", batch_of(F.col("page_id"), 10, start=0).alias("batch"),
        ),
        path, format="text",
    )
    return build_corpus(read_extracts(spark, path)).select("id", "url", "title")


def domain_corpus(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    root = inputs.write_archives(pages)
    out = new_scratch(spark, "domain")
    extract_domain(spark, inputs.captures(pages), root, DOMAIN, out, CRAWLS)
    return build_corpus(read_extract_table(spark, out))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        token_counts, distinct_terms, doc_freq, term_freq, doc_length, corpus_stats, merged_documents,
        tfdf_postings, doc_vectors, doc_vectors_tfdf, query_weights_tfdf, query_weights_bm25,
        score_tfdf_all, score_bm25_all, search_tfdf_top10, search_bm25_top10, search_unknown_words,
        search_pages_top10, ranked_all, ranking_table, index_df, index_postings, index_stats,
        index_scores_tfdf, index_roundtrip_search, index_roundtrip_tfdf, captures_by_domain,
        captures_per_crawl, rejected_captures, wet_locations, wet_scan, domain_records,
        domain_records_strict, record_fields, sequential_ids, corpus_roundtrip, extract_roundtrip,
        domain_corpus, extract_order, index_titles, corpus_arrays, search_sizes,
    )
} | {"bm25_idf": bm25_idf_table}
