"""Operators that split hot groups: same results as the plain form, and plans without a bottleneck."""

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gleanrank.operators.captures import index_captures
from gleanrank.operators.joins import join_counted, join_frequent
from gleanrank.operators.numbering import batch_of, number_rows
from gleanrank.operators.records import assemble_records, segment_lines
from gleanrank.plans.index import build_index
from gleanrank.plans.search import document_scores, index_scores, search
from gleanrank.session import scratch_root
from gleanrank.sources.tables import read_captures


def test_join_counted_equals_plain_join(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.col("id").alias("v"),
    )
    keys = rows.groupBy("k").agg(F.count("*").alias("n"))
    plain = sorted(map(tuple, rows.join(keys, "k").select("k", "v", "n").collect()))
    for limit in (10, 100, 10_000):
        dealt = join_counted(rows, keys, "k", "n", spread_by="v", min_rows_per_slice=limit)
        assert dealt.columns == ["k", "v", "n"]
        assert sorted(map(tuple, dealt.collect())) == plain


def test_join_counted_drops_unknown_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    keys = spark.createDataFrame([("a", 1)], "k string, n bigint")
    assert [tuple(r) for r in join_counted(rows, keys, "k", "n", "v").collect()] == [("a", 1, 1)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_are_dense_and_in_order(spark, partitions):
    rows = spark.range(2000).repartition(partitions).select(
        F.when(F.col("id") % 3 == 0, 9).otherwise(F.col("id") % 11).alias("file"),
        F.col("id").alias("pos"),
    )
    got = number_rows(rows, [F.desc("file"), "pos"], start=5).collect()
    expected = sorted(((r.file, r.pos) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r.file, r.pos) for r in sorted(got, key=lambda r: r.id)] == expected
    assert sorted(r.id for r in got) == list(range(5, 2005))


def test_numbering_no_rows(spark):
    assert number_rows(spark.range(0), ["id"], name="n").count() == 0


def test_batches(spark):
    rows = spark.range(1, 8).select(batch_of(F.col("id"), 3).alias("b")).collect()
    assert [r.b for r in rows] == [0, 0, 0, 1, 1, 1, 2]
    with pytest.raises(ValueError):
        batch_of(F.col("id"), 0)


def cut(lines):
    """Record starts by definition: two lines above each target-URI line."""
    starts = [i - 2 for i, line in enumerate(lines) if line.startswith("WARC-Target-URI")]
    return {(s, p): lines[p] for s, e in zip(starts, starts[1:] + [len(lines)]) for p in range(s, e)}


@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 1000])
def test_segments_across_chunks(spark, chunk):
    lines = ["", "-----#"]
    for k in range(7):
        lines += ["WARC/1.0", "WARC-Type: conversion", f"WARC-Target-URI: http://h{k}/", "X: 1", "", f"title {k}"]
        lines += [f"line {j}" for j in range(k * 3)]
    df = spark.createDataFrame(
        [(f, p, line) for f in ("x", "y") for p, line in enumerate(lines)], "file string, pos bigint, line string"
    ).repartition(5)
    segments = segment_lines(df, chunk=chunk)
    for f in ("x", "y"):
        got = {(r.rec, r.pos): r.line for r in segments.collect() if r.file == f}
        assert got == cut(lines)
    records = assemble_records(segments).filter("file = 'x'").orderBy("pos").collect()
    assert [r.uri for r in records] == [f"http://h{k}/" for k in range(7)]
    assert records[2].body == "title 2\n" + "\n".join(f"line {j}" for j in range(6))


def test_search_without_index_reads_texts_once(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    scores = document_scores(stored, "red whale", "bm25")
    scores.collect()
    executed = scores._jdf.queryExecution().executedPlan().toString()
    final = executed.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert "BatchEvalPython" not in final and "ArrowEvalPython" not in final
    assert final.count("FileScan parquet") == 1


def test_index_search_pushes_terms_to_the_scan(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    build_index(docs, path, "bm25")
    plan = index_scores(spark, path, "red whale", "bm25")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term, [red,whale])" in plan or "PushedFilters: [In(term, [whale,red])" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_padding_skips_the_length_table_when_enough_match(spark, docs, tmp_path):
    path = str(tmp_path / "index")
    build_index(docs, path, "bm25")
    hits = search(spark, path, "red", 3, "bm25")
    assert hits.count() == 3
    hits.collect()
    final = hits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "/docs" not in final


def test_captures_push_the_crawl_to_the_scan(spark, tmp_path):
    rows = spark.createDataFrame([("1", "http://a.com/", "200", "f")], "crawl string, url string, status string, filename string")
    rows.write.parquet(str(tmp_path / "captures"))
    hits = index_captures(read_captures(spark, str(tmp_path / "captures")), "a.com", ["1", "2"])
    assert "In(crawl, [1,2])" in hits._jdf.queryExecution().executedPlan().toString()
    assert hits.count() == 1


def test_ranges_cover_the_whole_order_key(spark):
    scores = spark.range(100).select(F.col("id").alias("doc_id"), F.lit(0.0).alias("score"))
    placed = scores.repartitionByRange(4, F.desc("score"), F.col("doc_id"))
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 60


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError):
        scratch_root(Session())


def test_index_build_drops_its_scratch_tables(spark, docs, tmp_path):
    before = set(Path(scratch_root(spark)).glob("*"))
    build_index(docs, str(tmp_path / "index"), "tfdf")
    assert set(Path(scratch_root(spark)).glob("*")) <= before


def test_lines_are_read_and_dealt_out_once(spark, tmp_path):
    rows = [(f, p, f"WARC-Target-URI: http://h{p}/" if p % 7 == 2 else f"line {p}") for f in "xy" for p in range(200)]
    spark.createDataFrame(rows, "file string, pos bigint, line string").write.parquet(str(tmp_path / "lines"))
    segments = segment_lines(spark.read.parquet(str(tmp_path / "lines")), chunk=20)
    assert segments.count() == 2 * 200
    segments.collect()
    final = segments._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_index_build_moves_postings_once(spark, docs, tmp_path, monkeypatch):
    """No join on the way to the sorted layout, under either model."""
    plans = []
    monkeypatch.setattr("gleanrank.sinks.tables.write_sorted", lambda df, path, *rest: plans.append((path, df)))
    from gleanrank.operators.terms import row_postings
    from gleanrank.sinks.tables import write_postings

    row_postings(docs).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows")).filter("term is not null")
    write_postings(rows, str(tmp_path / "index"), 10)
    (_, written), = plans
    assert "Exchange" not in written._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("model", ["tfdf", "bm25"])
def test_stopped_build_leaves_no_index(spark, docs, tmp_path, monkeypatch, model):
    import gleanrank.plans.index as plan

    path = str(tmp_path / "index")
    write = plan.write_postings
    monkeypatch.setattr(plan, "write_postings", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        build_index(docs, path, model)
    assert not list(tmp_path.glob("*"))
    with pytest.raises(AnalysisException):
        search(spark, path, "red", 3, model)
    monkeypatch.setattr(plan, "write_postings", write)
    build_index(docs, path, model)
    assert search(spark, path, "red", 3, model).count() == 3
    with pytest.raises(FileExistsError):
        build_index(docs, path, model)


def test_unfinished_index_is_not_searched(spark, docs, tmp_path):
    path = tmp_path / "index"
    build_index(docs, str(path), "tfdf")
    (path / "built").rename(tmp_path / "elsewhere")
    with pytest.raises(AnalysisException):
        search(spark, str(path), "red", 3, "tfdf")


def test_files_of_sorted_rows_are_bounded(spark, tmp_path):
    """60 million rows, as far as the writer knows: no task sorts more than 5 million of them."""
    from gleanrank.sinks.tables import write_sorted

    write_sorted(spark.range(2000), str(tmp_path / "sorted"), ["id"], 60_000_000)
    assert len(list((tmp_path / "sorted").glob("part-*"))) >= 12


@pytest.mark.parametrize("most", [0, 1, 10, 1000])
def test_join_frequent_equals_plain_join(spark, most):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"), F.col("id").alias("v"),
    )
    keys = rows.groupBy("k").agg(F.count("*").alias("n")).filter("k is null or k <> 'k7'")
    plain = sorted(map(tuple, rows.join(keys, "k").select("k", "v", "n").collect()))
    joined = join_frequent(rows, keys, "k", "n", max_hot_keys=most)
    assert joined.columns == ["k", "v", "n"] and sorted(map(tuple, joined.collect())) == plain


def test_rows_of_frequent_keys_do_not_move(spark, tmp_path):
    """Only the 100 rows of rare keys are shuffled, and 10 keys."""
    spark.range(10_000).select(
        F.when(F.col("id") >= 100, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 10).cast("string"))).alias("k"), "id"
    ).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    rows.groupBy("k").agg(F.count("*").alias("n")).write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = join_frequent(rows, keys, "k", "n", max_hot_keys=1)
        assert joined.count() == 10_000
        moved = joined.filter("k <> 'hot'")
        assert moved.count() == 100
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2 and "LeftAnti, BuildRight" in plan


def test_counts_of_repeated_and_null_ids_are_merged(spark):
    from gleanrank.operators import terms
    from gleanrank.workload import queries

    docs = spark.createDataFrame(
        [(1, "a b a"), (1, "b c"), (2, "c c"), (3, ""), (3, ""), (4, None), (None, "x x"), (None, "x y")], "id bigint, text string"
    )
    tf, lengths = queries._postings(docs)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, tf.collect())) == sorted(map(key, terms.term_freq(docs).collect()))
    assert sorted(map(key, lengths.collect())) == sorted(map(key, terms.doc_lengths(docs).collect()))


def test_documents_that_occur_once_make_vectors_without_a_shuffle(spark, tmp_path, monkeypatch):
    from gleanrank.workload import queries

    def of(rows):
        monkeypatch.setattr(queries, "documents", lambda *_: spark.createDataFrame(rows, "id bigint, text string").coalesce(2))
        return queries.doc_vectors(spark, "")

    once = of([(1, "b a b"), (2, "")])
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, once.collect())) == [(-1, 0, ""), (1, 3, "a=1 b=2"), (2, 0, "")]
    again = of([(1, "b a b"), (2, ""), (1, "c a"), (3, "z")])
    assert sorted(map(tuple, again.collect())) == [(-1, 0, ""), (1, 5, "a=2 b=2 c=1"), (2, 0, ""), (3, 1, "z=1")]
    null = of([(None, "z"), (3, "z")])
    assert sorted(map(str, null.collect())) == sorted(map(str, of([(None, "z"), (3, "z"), (3, "")]).collect()))
