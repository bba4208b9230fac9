import re
import string

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gleanrank.functions.text import normalize, tokenize
from gleanrank.operators import terms


def tokens_of(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r["t"] for r in rows.select("i", tokenize(F.col("text")).alias("t")).orderBy("i").collect()]


CASES = [
    ("state-of-the-art", ["state", "of", "the", "art"]),
    ("foo.bar x_1 covid19", ["foobar", "x", "covid"]),
    ("a\\nb", ["a", "b"]),
    ("--- 42 !!", []),
    ("« été »", ["«", "été", "»"]),
    ("a b", ["a b"]),
    ("a\x0bb", ["a\x0bb"]),
    ("One\ttwo\nthree\rfour\ffive", ["one", "two", "three", "four", "five"]),
    ("", []),
    (None, []),
    (string.punctuation + "x" + string.digits, ["x"]),
    ("it's “quoted”", ["its", "“quoted”"]),
    ("A\\Nb", ["a", "b"]),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_tokenizer_cases(spark, text, expected):
    assert tokens_of(spark, text) == [expected]


def test_normalize_replaces_in_order(spark):
    row = spark.range(1).select(normalize(F.lit("A-B\\tC")).alias("x")).first()
    assert row["x"] == "a b c"


def by_definition(text):
    """Split first, then clean each token."""
    plain = re.sub(r"\\[a-z]", " ", text.lower()).replace("-", " ")
    table = str.maketrans("", "", string.digits + string.punctuation)
    return [t for t in (raw.translate(table) for raw in re.split("[ \t\n\r\f]+", plain)) if t]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aBz09 -_.\\\t\n\r\f\"'é«» \x0b", max_size=40), min_size=20, max_size=20))
def test_tokenizer_against_definition(spark, texts):
    assert tokens_of(spark, *texts) == [by_definition(t) for t in texts]


def test_counts_lengths_and_frequencies_agree(spark, docs):
    for unique in (False, True):
        tf = {(r.doc_id, r.term): r.tf for r in terms.term_freq(docs, unique_ids=unique).collect()}
        assert tf[(5, "red")] == 3 and tf[(3, "blue")] == 2 and (6, "stateoftheart") not in tf
        lengths = {r.doc_id: r.doc_len for r in terms.doc_lengths(docs, unique_ids=unique).collect()}
        assert lengths == {1: 2, 2: 2, 3: 4, 4: 0, 5: 4, 6: 5}
        for doc_id, length in lengths.items():
            assert length == sum(n for (d, _), n in tf.items() if d == doc_id)
        df = {r.term: r.df for r in terms.doc_freq(terms.distinct_terms(docs, unique_ids=unique)).collect()}
        assert df == {t: sum(1 for (_, u) in tf if u == t) for (_, t) in tf}


def test_row_postings_keep_empty_documents(spark, docs):
    rows = terms.row_postings(docs).collect()
    heads = [r.doc_id for r in rows if r["head"]]
    assert sorted(heads) == [1, 2, 3, 4, 5, 6]
    assert [(r.term, r.tf, r.doc_len) for r in rows if r.doc_id == 4] == [(None, None, 0)]


def test_stats_count_empty_documents(spark, docs):
    stats = terms.corpus_stats(terms.doc_lengths(docs)).first()
    assert stats.n_docs == 6 and stats.avg_len == pytest.approx(17 / 6)


def test_equal_ids_are_merged(spark):
    rows = spark.createDataFrame([(1, "a b a"), (1, "b c"), (2, "c")], "id bigint, text string")
    merged = terms.with_lengths(terms.term_freq(rows), terms.doc_lengths(rows))
    got = {(r.doc_id, r.term): (r.tf, r.doc_len) for r in merged.collect()}
    assert got == {(1, "a"): (2, 5), (1, "b"): (2, 5), (1, "c"): (1, 5), (2, "c"): (1, 1)}
    df = {r.term: r.df for r in terms.doc_freq(terms.distinct_terms(rows)).collect()}
    assert df == {"a": 1, "b": 1, "c": 2}


def test_vectors_hold_each_term_once(spark, docs):
    tf = terms.term_freq(docs)
    weighted = terms.with_tfdf_weight(tf, terms.doc_freq(tf))
    lengths = terms.doc_lengths(docs)
    whole = {r.doc_id: r for r in terms.doc_vectors(weighted, lengths).collect()}
    assert set(whole) == {1, 2, 3, 4, 5, 6} and all(r.part == 0 for r in whole.values())
    assert whole[4].vector == {} and whole[4].doc_len == 0
    assert whole[5].vector == {"red": pytest.approx(3 / 3), "whale": pytest.approx(1 / 2)}
    split = terms.doc_vectors(weighted, lengths, parts=3).collect()
    assert sorted((r.doc_id, r.part) for r in split) == [(d, p) for d in range(1, 7) for p in range(3)]
    together = {}
    for r in split:
        assert not together.get(r.doc_id, {}).keys() & r.vector.keys()
        together.setdefault(r.doc_id, {}).update(r.vector)
    assert together == {d: r.vector for d, r in whole.items()}
