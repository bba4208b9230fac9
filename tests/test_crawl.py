import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanrank import build_corpus, build_index, extract_domain, search
from gleanrank.functions.web import ARCHIVE_HOST, extract_number, host, in_domain, wet_name, wet_url
from gleanrank.operators.captures import index_captures, rejected_captures
from gleanrank.operators.records import filter_domain, record_fields
from gleanrank.sources.records import read_extract_table, read_extracts, read_wet
from gleanrank.session import scratch_root
from gleanrank.sinks.tables import write_capture_index
from gleanrank.sources.tables import read_capture_index, read_captures, read_corpus

WARCINFO = "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 2022-10-01T00:00:00Z\r\n\r\nSoftware-Info: x\r\n\r\n\r\n"


def record(url, body, language=True):
    headers = ["WARC/1.0", "WARC-Type: conversion", f"WARC-Target-URI: {url}", "WARC-Date: 2022-10-01T00:00:00Z",
               "WARC-Record-ID: <urn:uuid:1>", "WARC-Refers-To: <urn:uuid:2>", "WARC-Block-Digest: sha1:x"]
    if language:
        headers.append("WARC-Identified-Content-Language: eng")
    headers += ["Content-Type: text/plain", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(headers) + body.replace("\n", "\r\n") + "\r\n\r\n"


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_location_and_name(spark):
    path = "crawl-data/CC-MAIN-2022-40/segments/1664030/warc/CC-MAIN-2022-00017.warc.gz"
    url = ARCHIVE_HOST + "/crawl-data/CC-MAIN-2022-40/segments/1664030/wet/CC-MAIN-2022-00017.warc.wet.gz"
    assert value(spark, wet_url(F.lit(path))) == url
    assert value(spark, wet_name(F.lit(url))) == "CC-MAIN-2022-00017.warc."
    assert value(spark, wet_url(F.lit(path), "/mnt/x/")).startswith("/mnt/x/crawl-data/")


@pytest.mark.parametrize("url,expected", [
    ("https://example.com/", True), ("http://a.b.EXAMPLE.com:8080/x", True), ("https://notexample.com/", False),
    ("https://x.org/?ref=example.com", False), ("https://user@example.com/", True), ("https://example.com.x.org", False),
    ("example.com/x", False), ("https://example.com?x=1", True),
])
def test_domain(spark, url, expected):
    assert value(spark, in_domain(F.lit(url), "example.com")) is expected


def test_host_of_nothing(spark):
    assert value(spark, host(F.lit("no url"))) == ""


@pytest.mark.parametrize("path,expected", [
    ("/x/CC-Multi9.txt", 9), ("/x/CC-Multi10.txt", 10), ("/x/CC-Multi-1.txt", -1), ("/x/other.txt", None),
])
def test_extract_number(spark, path, expected):
    assert value(spark, extract_number(F.lit(path))) == expected


@pytest.mark.parametrize("kind", ["plain", "gzip", "members"])
def test_wet_records(spark, tmp_path, kind):
    texts = [WARCINFO, record("http://a/1", "Title one\nSee WARC/1.0 here\n\nlast"),
             record("http://a/2", "Two\nx", language=False), record("http://a/3", ""), record("http://a/4", "end\n")]
    if kind == "plain":
        path = tmp_path / "a.warc.wet"
        path.write_bytes("".join(texts).encode())
    else:
        path = tmp_path / "a.warc.wet.gz"
        parts = texts if kind == "members" else ["".join(texts)]
        path.write_bytes(b"".join(gzip.compress(p.encode()) for p in parts))
    rows = read_wet(spark, str(path)).orderBy("block", "pos").collect()
    assert [r.uri for r in rows] == [f"http://a/{k}" for k in (1, 2, 3, 4)]
    fields = record_fields(read_wet(spark, [str(path)])).orderBy("block", "pos").collect()
    assert [(f.title, f.text) for f in fields] == [
        ("Title one", "Title one See WARC/1.0 here  last"), ("Two", "Two x"), ("", ""), ("end", "end"),
    ]


@pytest.mark.parametrize("kind", ["plain", "gzip"])
def test_either_newline_in_one_read(spark, tmp_path, kind):
    for number, end in enumerate(["\r\n", "\n", "\n", "\r\n"]):
        text = WARCINFO + "".join(record(f"http://a/{number}/{k}", f"t{k}\n\nlast") for k in range(3))
        data = text.replace("\r\n", end).encode()
        name = f"{number}.warc.wet" + (".gz" if kind == "gzip" else "")
        (tmp_path / name).write_bytes(gzip.compress(data) if kind == "gzip" else data)
    rows = read_wet(spark, str(tmp_path)).collect()
    assert sorted((r.uri, r.body) for r in rows) == [
        (f"http://a/{n}/{k}", f"t{k}\n\nlast") for n in range(4) for k in range(3)]


def test_same_names_odd_names_and_plain_archives(spark, tmp_path):
    """Equal names in two segments, a space, a percent sign, a plus, and an uncompressed archive: each record once."""
    files = ["s1/warc/f.warc.gz", "s2/warc/f.warc.gz", "s1/warc/x y.warc.gz", "s1/warc/x%20y.warc.gz",
             "s2/warc/a+b.warc.gz", "s2/warc/x.arc"]
    rows = []
    for n, file in enumerate(files):
        wet = tmp_path / "data" / "a" / "b" / "c" / file.replace("/warc/", "/wet/").replace("warc.gz", "warc.wet.gz")
        wet.parent.mkdir(parents=True, exist_ok=True)
        data = record(f"https://example.com/{n}", "A").encode()
        wet.write_bytes(gzip.compress(data) if file.endswith(".gz") else data)
        rows.append(("1", f"https://example.com/{n}", "200", f"a/b/c/{file}"))
    captures = spark.createDataFrame(rows, "crawl string, url string, status string, filename string")
    out = str(tmp_path / "out")
    extract_domain(spark, captures, str(tmp_path / "data"), "example.com", out)
    assert sorted(r.uri for r in read_extract_table(spark, out).collect()) == [
        f"https://example.com/{n}" for n in range(len(files))]


def test_split_plain_archive_keeps_every_record(spark, tmp_path):
    path = tmp_path / "big.warc.wet"
    path.write_text("".join(record(f"http://a/{k}", f"title {k}\n" + "word " * (k % 50)) for k in range(3000)), newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "37111")
    try:
        rows = read_wet(spark, str(path)).orderBy("block", "pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({r.block for r in rows}) > 5
    assert [r.uri for r in rows] == [f"http://a/{k}" for k in range(3000)]


def test_domain_filter(spark):
    rows = spark.createDataFrame(
        [("https://x.org/?ref=example.com",), ("https://a.example.com/",), ("https://y.org",)], "uri string"
    )
    assert {r.uri for r in filter_domain(rows, "example.com").collect()} == {
        "https://x.org/?ref=example.com", "https://a.example.com/"}
    assert [r.uri for r in filter_domain(rows, "example.com", strict=True).collect()] == ["https://a.example.com/"]


def test_captures(spark, tmp_path):
    rows = [{"crawl": c, "url": u, "status": s, "filename": f"a/b/c/d/warc/{i}.warc.gz"} for i, (c, u, s) in enumerate([
        ("1", "http://example.com/", "200"), ("2", "http://www.example.com/", "404"), ("3", "http://example.com/", "200"),
        ("1", "http://other.com/", "200")])]
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, rows)))
    captures = read_captures(spark, str(tmp_path / "c.json"), "json")
    assert index_captures(captures, "example.com", ["1", "2"]).count() == 2
    assert index_captures(captures, "example.com").count() == 3
    rejected = rejected_captures(captures.withColumn("pos", F.lit(7)))
    assert [tuple(r) for r in rejected.collect()] == [(7, "404", "a/b/c/d/warc/1.warc.gz")]


def test_extract_files_in_number_order(spark, tmp_path):
    for number in (100, 9, 10):
        folder = tmp_path / f"d{number % 2}"
        folder.mkdir(exist_ok=True)
        text = "\n-----#\n" + "".join(record(f"http://h/{number}/{k}", f"t{number}-{k}\nb") for k in range(3))
        (folder / f"CC-Multi{number}.txt").write_text(text.replace("\r\n", "\n"))
        (folder / "notes.log").write_text("WARC-Target-URI: no")
    docs = build_corpus(read_extracts(spark, str(tmp_path)), str(tmp_path / "out"), batch_size=4, batch_folders=True)
    rows = docs.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 10))
    assert [r.title for r in rows] == [f"t{n}-{k}" for n in (9, 10, 100) for k in range(3)]
    assert [r.batch for r in rows] == [0, 0, 0, 0, 1, 1, 1, 1, 2]
    again = read_corpus(spark, str(tmp_path / "out")).orderBy("id").collect()
    assert [(r.id, r.url, r.title, r.text) for r in again] == [(r.id, r.url, r.title, r.text) for r in rows]
    assert (tmp_path / "out" / "batch=2").is_dir()


def test_corpus_forms(spark, tmp_path):
    docs = [{"id": "1", "url": "http://a/", "title": "A \"q\"", "text": "x, \"url\": y"},
            {"id": "2", "url": "http://title/", "title": "é", "text": "l1\nl2"}]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "sub").mkdir()
    (tmp_path / "lines" / "sub" / "b.txt").write_text("\n".join(json.dumps(d) for d in docs))
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "a.json").write_text(json.dumps(docs, indent=4))
    expected = [(int(d["id"]), d["url"], d["title"], d["text"]) for d in docs]
    assert [tuple(r) for r in read_corpus(spark, str(tmp_path / "lines")).orderBy("id").collect()] == expected
    array = read_corpus(spark, str(tmp_path / "array"), multi_line=True)
    assert [tuple(r) for r in array.orderBy("id").collect()] == expected


def test_broken_corpus_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"id": "1", "url": "u", "title": "t", "text": "x"}\n\n{"id": "2", "te\n')
    with pytest.raises(Exception):
        read_corpus(spark, str(tmp_path)).collect()
    kept = read_corpus(spark, str(tmp_path), mode="DROPMALFORMED").collect()
    assert [r.id for r in kept] == [1]


@pytest.mark.parametrize("format", ["parquet", "text"])
def test_from_archives_to_search(spark, tmp_path, format):
    wet = tmp_path / "data" / "crawl-data" / "c" / "segments" / "0" / "wet"
    wet.mkdir(parents=True)
    for k in range(3):
        body = WARCINFO + record(f"https://blog.example.com/{k}", f"Post {k}\nred fox number {'whale ' * k}")
        body += record(f"https://other.org/{k}", "Other\nred") + record(f"https://x.org/?r=example.com/{k}", "Ref\nsea")
        (wet / f"f{k}.warc.wet.gz").write_bytes(gzip.compress(body.encode()))
    captures = spark.createDataFrame(
        [("2022-40", f"https://blog.example.com/{k}", "200" if k else "404",
          f"crawl-data/c/segments/0/warc/f{k}.warc.gz") for k in (2, 1, 0, 1)]
        + [("2022-33", "https://other.org/", "200", "crawl-data/c/segments/0/warc/missing.warc.gz")],
        "crawl string, url string, status string, filename string",
    )
    out, rejects = str(tmp_path / "extracts"), str(tmp_path / "rejects")
    extract_domain(spark, captures, str(tmp_path / "data"), "example.com", out, ["2022-40", "2022-33"],
                   rejects=rejects, batch_size=2, format=format)
    assert [tuple(r) for r in spark.read.parquet(rejects).select("pos", "status", "filename").collect()] == [
        (0, "404", "crawl-data/c/segments/0/warc/f0.warc.gz")]
    records = read_extract_table(spark, out) if format == "parquet" else read_extracts(spark, out)
    assert records.count() == 6
    corpus_path, index = str(tmp_path / "corpus"), str(tmp_path / "index")
    build_corpus(records, corpus_path)
    corpus = read_corpus(spark, corpus_path)
    ids = {r.title + r.url[-1]: r.id for r in corpus.collect()}
    assert sorted(ids.values()) == [1, 2, 3, 4, 5, 6]
    assert ids["Post 00"] < ids["Ref0"] < ids["Post 11"] < ids["Post 22"]
    build_index(corpus, index, "bm25")
    hits = search(spark, index, "Whale", 2, "bm25", corpus=corpus).orderBy("rank").collect()
    assert [(h.title, h.url) for h in hits] == [
        ("Post 2", "https://blog.example.com/2"), ("Post 1", "https://blog.example.com/1")]


def test_extract_only_ok_and_strict(spark, tmp_path):
    wet = tmp_path / "data" / "a" / "b" / "c" / "wet"
    wet.mkdir(parents=True)
    (tmp_path / "data" / "a" / "b" / "c" / "d").mkdir()
    wet = tmp_path / "data" / "a" / "b" / "c" / "d" / "wet"
    wet.mkdir()
    (wet / "f.warc.wet.gz").write_bytes(gzip.compress(
        (record("https://example.com/", "A") + record("https://x.org/?example.com", "B")).encode()))
    captures = spark.createDataFrame(
        [("1", "https://example.com/", "200", "a/b/c/d/warc/f.warc.gz"),
         ("1", "https://example.com/2", "500", "a/b/c/d/warc/gone.warc.gz")],
        "crawl string, url string, status string, filename string")
    out = str(tmp_path / "out")
    extract_domain(spark, captures, str(tmp_path / "data"), "example.com", out, strict=True, only_ok=True)
    assert [r.uri for r in read_extract_table(spark, out).collect()] == ["https://example.com/"]
    none = str(tmp_path / "none")
    extract_domain(spark, captures, str(tmp_path / "data"), "nowhere.org", none)


def extract_folder(folder, files=12, records=300):
    for number in range(files):
        text = "".join(record(f"http://h/{number}/{k}", f"t{number}-{k}\n" + "word " * (k % 40)) for k in range(records))
        (folder / f"CC-Multi{number}.txt").write_text(text.replace("\r\n", "\n"))


@pytest.mark.parametrize("splits", [("4", "128m"), ("40", "128m"), ("4", "20000")])
def test_ids_do_not_depend_on_splits(spark, tmp_path, splits):
    """Numbering and reading under different split settings: every record once, with the same ids."""
    extract_folder(tmp_path)
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes")
    old = [spark.conf.get(n, None) for n in names]

    def split(*values):
        for name, value in zip(names, values):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)

    try:
        split(*splits)
        records = read_extracts(spark, str(tmp_path))
        docs = build_corpus(records)
        # What reads the result may be split in another way.
        split("40" if splits[0] == "4" else "4", "1m")
        rows = docs.orderBy("id").collect()
    finally:
        split(*old)
    assert [r.id for r in rows] == list(range(1, 3601))
    assert [r.url for r in rows] == [f"http://h/{n}/{k}" for n in range(12) for k in range(300)]
    assert all(r.text == " ".join([r.title] + ["word"] * (int(r.url.rpartition("/")[2]) % 40) + [""] * (r.text[-1] == " ")) for r in rows)


def test_corpus_build_drops_its_scratch_tables(spark, tmp_path):
    extract_folder(tmp_path, 2, 5)
    before = set(Path(scratch_root(spark)).glob("*"))
    docs = build_corpus(read_extracts(spark, str(tmp_path)), str(tmp_path / "corpus"))
    assert docs.count() == 10 and docs.columns == ["id", "url", "title", "text", "batch"]
    assert set(Path(scratch_root(spark)).glob("*")) <= before


@pytest.mark.parametrize("kind", ["plain", "gzip"])
def test_any_version_in_one_read(spark, tmp_path, kind):
    for number, (version, end) in enumerate([("1.0", "\n"), ("1.1", "\r\n"), ("1.1", "\n"), ("0.18", "\r\n")]):
        text = WARCINFO + "".join(record(f"http://a/{number}/{k}", f"t{k}\n\nlast") for k in range(5))
        data = text.replace("\r\n", end).replace("WARC/1.0", f"WARC/{version}").encode()
        name = f"{number}.warc.wet" + (".gz" if kind == "gzip" else "")
        (tmp_path / name).write_bytes(gzip.compress(data) if kind == "gzip" else data)
    rows = read_wet(spark, str(tmp_path)).collect()
    assert sorted((r.uri, r.body) for r in rows) == [(f"http://a/{n}/{k}", "t%d\n\nlast" % k) for n in range(4) for k in range(5)]
    assert all(r.header.startswith("WARC-Type: conversion") for r in rows)


@pytest.mark.parametrize("word", [None, "a.org"])
def test_lines_that_begin_with_the_version_token(spark, tmp_path, word):
    """A body that looks like a record's start at a line, once and several times in a row, stays whole."""
    bodies = ["t\nWARC/1.0 is a format\nend", "u\nWARC/ x\n\nWARC/1.1 y\nWARC/\nlast", "WARC/9", "plain", "v\nWARC/1.0"]
    data = WARCINFO + "".join(record(f"http://{'a' if k % 2 == 0 or k == 1 else 'b'}.org/{k}", b) for k, b in enumerate(bodies))
    (tmp_path / "a.warc.wet.gz").write_bytes(gzip.compress(data.encode()))
    rows = read_wet(spark, str(tmp_path), word).orderBy("pos").collect()
    assert [r.body for r in rows] == [b for k, b in enumerate(bodies) if word is None or k != 3]
    assert len(read_wet(spark, str(tmp_path), rejoin=False).collect()) == len(bodies)


def test_file_without_a_record(spark, tmp_path):
    (tmp_path / "a.warc.wet").write_text("no archive\nat all\n")
    (tmp_path / "b.warc.wet").write_text(record("http://a/", "x"), newline="")
    with pytest.raises(ValueError, match="a.warc.wet"):
        read_wet(spark, str(tmp_path))


@pytest.mark.parametrize("format", ["parquet", "text"])
def test_same_extract_twice(spark, tmp_path, format):
    wet = tmp_path / "data" / "a" / "b" / "c" / "d" / "wet"
    wet.mkdir(parents=True)
    (wet / "f.warc.wet.gz").write_bytes(gzip.compress(
        (record("https://example.com/", "A") + record("https://x.net/", "B")).encode()))
    captures = spark.createDataFrame(
        [("1", u, "404", "a/b/c/d/warc/f.warc.gz") for u in ("https://example.com/", "https://x.net/")],
        "crawl string, url string, status string, filename string")
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    for domain in ("example.com", "x.net", "example.com"):
        extract_domain(spark, captures, str(tmp_path / "data"), domain, out, rejects=rejects, format=format)
    rows = (read_extract_table(spark, out) if format == "parquet" else read_extracts(spark, out)).collect()
    assert sorted((r.uri, r.body) for r in rows) == [("https://example.com/", "A"), ("https://x.net/", "B")]
    assert spark.read.parquet(rejects).count() == 2


def test_capture_index(spark, tmp_path):
    """A domain is a range of keys that the reader gets; the same captures as by testing URLs."""
    urls = ["http://example.com/", "https://a.b.EXAMPLE.com:80/x", "http://example.com.org/", "http://notexample.com/", "http://example.co/",
            "http://u@www.example.com?x", "http://com/", "no url", None, "http://example-com/", "http://example.com-x/"]
    rows = [(i, str(i % 2), u, "200", f"f{i}") for i, u in enumerate(urls * 3)]
    captures = spark.createDataFrame(rows, "pos bigint, crawl string, url string, status string, filename string")
    path = str(tmp_path / "index")
    write_capture_index(captures, path)
    hits = index_captures(read_capture_index(spark, path), "example.com", ["0", "1"])
    assert hits.columns == captures.columns
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, index_captures(captures, "example.com").collect()))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = index_captures(read_capture_index(spark, path), "example.com")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(host_key,com.example.)" in plan and "LessThan(host_key,com.example/)" in plan
    with pytest.raises(Exception):
        write_capture_index(captures, path)
    write_capture_index(captures.drop("pos"), str(tmp_path / "numbered"))
    assert sorted(r.pos for r in read_capture_index(spark, str(tmp_path / "numbered")).collect()) == list(range(len(rows)))
