import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gleanrank.functions.scoring import bm25_term
from gleanrank.operators import ranking
from gleanrank.operators.ranking import pad_with_zeros, query_terms
from gleanrank.plans.index import build_index
from gleanrank.plans.search import document_scores, search, search_documents
from gleanrank.sources.tables import read_df, read_lengths, read_postings, read_stats

TEXTS = {1: "red fox", 2: "red fox", 3: "blue whale blue sea", 4: "", 5: "red red red whale", 6: "state of the art fox"}


def expected_scores(query, model):
    words = {d: t.split() for d, t in TEXTS.items()}
    n, avg = len(words), sum(map(len, words.values())) / len(words)
    df = {}
    for tokens in words.values():
        for t in set(tokens):
            df[t] = df.get(t, 0) + 1
    asked = query.lower().split()
    scores = {}
    for d, tokens in words.items():
        total = 0.0
        for t in sorted(set(asked)):
            if t not in df:
                continue
            tf = tokens.count(t)
            if model == "tfdf":
                total += asked.count(t) / df[t] * tf / df[t]
            else:
                idf = math.log((n - df[t] + 0.5) / (df[t] + 0.5) + 1)
                total += idf * tf * 3 / (tf + 2 * (1 - 0.75 + 0.75 * len(tokens) / avg))
        scores[d] = total
    return scores


@pytest.fixture(scope="module", params=["tfdf", "bm25"])
def index(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / request.param)
    docs = spark.createDataFrame(list(TEXTS.items()), "id bigint, text string")
    build_index(docs, path, request.param)
    return request.param, path


@pytest.mark.parametrize("query", ["red", "red whale red zzzz", "fox sea"])
@pytest.mark.parametrize("model", ["tfdf", "bm25"])
def test_scores_of_documents(spark, docs, query, model):
    got = {r.doc_id: r.score for r in document_scores(docs, query, model).collect()}
    assert got == pytest.approx(expected_scores(query, model))


@pytest.mark.parametrize("query", ["red", "red whale red zzzz", "fox sea"])
def test_index_search_equals_definition(spark, index, query):
    model, path = index
    expected = sorted(expected_scores(query, model).items(), key=lambda x: (-round(x[1], 9), x[0]))
    hits = search(spark, path, query, 6, model).orderBy("rank").collect()
    assert [(h.rank, h.doc_id) for h in hits] == [(i + 1, d) for i, (d, _) in enumerate(expected)]
    assert [h.score for h in hits] == pytest.approx([s for _, s in expected])
    positive = search(spark, path, query, 6, model, include_zero=False).collect()
    assert {h.doc_id for h in positive} == {d for d, s in expected if s > 0}


def test_tie_goes_to_the_lower_id(spark, index):
    model, path = index
    hits = search(spark, path, "red fox", 1000, model).orderBy("rank").collect()
    order = [h.doc_id for h in hits]
    assert order.index(1) + 1 == order.index(2)
    assert len(hits) == len(TEXTS)


def test_only_unknown_words(spark, index):
    model, path = index
    hits = search(spark, path, "zzzz", 3, model).orderBy("rank").collect()
    assert [(h.doc_id, h.score) for h in hits] == [(1, 0.0), (2, 0.0), (3, 0.0)]
    assert search(spark, path, "zzzz", 3, model, include_zero=False).count() == 0


def test_query_without_any_term(spark, docs, index):
    model, path = index
    assert [r.doc_id for r in search(spark, path, "42 !", 2, model).orderBy("rank").collect()] == [1, 2]
    assert [r.doc_id for r in search_documents(docs, "42 !", 2, model).orderBy("rank").collect()] == [1, 2]


@pytest.mark.parametrize("n", [-1, 1001])
def test_n_out_of_range(spark, docs, index, n):
    with pytest.raises(ValueError):
        search(spark, index[1], "red", n, index[0])
    with pytest.raises(ValueError):
        search_documents(docs, "red", n)


def test_n_zero(spark, docs, index):
    assert search(spark, index[1], "red", 0, index[0]).count() == 0
    assert search_documents(docs, "red", 0).count() == 0


def test_unknown_model(spark, docs):
    with pytest.raises(ValueError):
        document_scores(docs, "red", "cosine")


def test_index_refuses_existing_output_and_missing_input(spark, docs, index, tmp_path):
    with pytest.raises(FileExistsError):
        build_index(docs, index[1], index[0])
    with pytest.raises(AnalysisException):
        search(spark, str(tmp_path / "nothing"), "red", 3)


def test_index_tables(spark, index):
    model, path = index
    df = {r.term: r.df for r in read_df(spark, path).collect()}
    postings = read_postings(spark, path, model).collect()
    assert df["red"] == 3 and df["fox"] == 3 and df["sea"] == 1
    assert {t: sum(1 for p in postings if p.term == t) for t in df} == df
    assert {r.doc_id: r.doc_len for r in read_lengths(spark, path).collect()}[4] == 0
    assert read_stats(spark, path).first().n_docs == 6
    if model == "tfdf":
        assert all(p.weight == p.tf / df[p.term] for p in postings)


def test_index_merges_equal_ids(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a b a"), (1, "b c"), (2, "c"), (2, "")], "id bigint, text string")
    path = str(tmp_path / "merged")
    build_index(rows, path, "bm25")
    got = {(r.doc_id, r.term): (r.tf, r.doc_len) for r in read_postings(spark, path, "bm25").collect()}
    assert got == {(1, "a"): (2, 5), (1, "b"): (2, 5), (1, "c"): (1, 5), (2, "c"): (1, 1)}
    assert read_stats(spark, path).first().n_docs == 2
    direct = {r.doc_id: r.score for r in document_scores(rows, "b c", "bm25").collect()}
    stored = {r.doc_id: r.score for r in search(spark, path, "b c", 5, "bm25").collect()}
    assert stored == pytest.approx(direct)


def test_empty_corpus(spark, tmp_path):
    rows = spark.createDataFrame([], "id bigint, text string")
    for model in ("tfdf", "bm25"):
        path = str(tmp_path / model)
        build_index(rows, path, model)
        assert search(spark, path, "red", 3, model).count() == 0
        assert document_scores(rows, "red", model).count() == 0


def test_ranking_does_not_depend_on_partitions(spark, docs):
    rankings = [
        [r.doc_id for r in search_documents(docs.repartition(p), "red whale", 6).orderBy("rank").collect()]
        for p in (1, 3, 8)
    ]
    assert rankings[0] == rankings[1] == rankings[2]


def test_whole_ranking_is_written_best_first(spark, index, tmp_path):
    model, path = index
    out = str(tmp_path / "ranking")
    hits = search(spark, path, "red whale", 5, model, ranking=out)
    plain = search(spark, path, "red whale", 5, model)
    assert hits.orderBy("rank").collect() == plain.orderBy("rank").collect()
    rows = spark.read.parquet(out).withColumn("_f", F.col("_metadata.file_path")).orderBy("_f").collect()
    assert len(rows) == 6
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    with pytest.raises(AnalysisException):
        search(spark, path, "red", 2, model, ranking=out)


def test_query_words_are_cleaned_like_documents(spark):
    got = {r.term: r.qtf for r in query_terms(spark, "The state-of THE art! 42").collect()}
    assert got == {"the": 2, "state": 1, "of": 1, "art": 1}


def test_repeated_query_words(spark, docs):
    once = {r.doc_id: r.score for r in document_scores(docs, "red", "bm25").collect()}
    twice = {r.doc_id: r.score for r in document_scores(docs, "red red", "bm25").collect()}
    assert once == twice
    once = {r.doc_id: r.score for r in document_scores(docs, "red", "tfdf").collect()}
    twice = {r.doc_id: r.score for r in document_scores(docs, "red red", "tfdf").collect()}
    assert twice == pytest.approx({d: 2 * s for d, s in once.items()})


def test_bm25_grows_with_tf(spark):
    scores = spark.range(1, 20).select(
        bm25_term(F.lit(1.5), F.col("id"), F.lit(30), F.lit(20.0)).alias("s")
    ).collect()
    values = [r.s for r in scores]
    assert values == sorted(values) and len(set(values)) == len(values)


def test_missing_title_keeps_the_hit(spark, index):
    model, path = index
    corpus = spark.createDataFrame(
        [(1, "http://one/", "One", "red fox"), (5, "http://five/", "Five", "x")],
        "id bigint, url string, title string, text string",
    )
    hits = search(spark, path, "red", 3, model, corpus=corpus).orderBy("rank").collect()
    assert [(h.doc_id, h.title, h.url) for h in hits] == sorted(
        [(5, "Five", "http://five/"), (1, "One", "http://one/"), (2, None, None)],
        key=lambda x: [h.doc_id for h in hits].index(x[0]),
    )
    lines = [r.line for r in ranking.format_results(
        search(spark, path, "red", 3, model, corpus=corpus)).orderBy("rank").collect()]
    assert any(line.startswith("Id: 1    Title: One    URL: http://one/   Score: ") for line in lines)
    assert any(line.startswith("Id: 2    Title: null    URL: null   Score: ") for line in lines)


def test_rank_all_numbers_every_document(spark, docs):
    rows = ranking.rank_all(document_scores(docs, "red", "bm25")).collect()
    ordered = sorted(rows, key=lambda r: (-r.score, r.doc_id))
    assert [r.rank for r in ordered] == [1, 2, 3, 4, 5, 6]


def test_padding_takes_lowest_ids(spark):
    best = spark.createDataFrame([(7, 2.0), (2, 1.0)], "doc_id bigint, score double")
    lengths = spark.range(1, 9).select(F.col("id").alias("doc_id"), F.lit(1).cast("bigint").alias("doc_len"))
    rows = pad_with_zeros(best, lengths, 5).collect()
    assert sorted(map(tuple, rows)) == [(1, 0.0), (2, 1.0), (3, 0.0), (4, 0.0), (7, 2.0)]
    assert sorted(map(tuple, pad_with_zeros(best, lengths, 2).collect())) == [(2, 1.0), (7, 2.0)]
