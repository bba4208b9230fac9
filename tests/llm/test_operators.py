"""Each operator against brute force, on small tables with the awkward cases its docstring defines."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanrank.llm import decontaminate, embedding_forest, license_scan, mixing, parity_join, sentence_spans
from gleanrank.llm import token_files, toxicity, url_filter, warc
from gleanrank.llm.graph import components
from gleanrank.llm.queries import TOKENIZER, URL_RULES
from gleanrank.session import new_scratch

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    """(id, text) rows as documents, with columns whose names the operators use themselves."""
    frame = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], DOCS)
    clash = {n: F.lit("x") for n in ("size", "row", "key", "node", "s", "v", "copies", "leaks", "id", "label")}
    return frame.withColumns(clash)


def prose(seed, n, words=400):
    return " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, words, n))


# ---- graph ---------------------------------------------------------------------------------------------------


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 7), (8, 7), (6, 6), (None, 3), (1, 5)] + [(100 + i, 101 + i) for i in range(30)]
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {**{i: 1 for i in range(1, 6)}, **{i: 7 for i in (7, 8, 9)}, **{i: 100 for i in range(100, 131)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---- 1 URL filter --------------------------------------------------------------------------------------------


URLS = [
    (1, "https://a.Example.ORG/es/x?q#f"), (2, "http://example.org/en/123"), (3, "http://example.org/en/2"),
    (4, "http://x.com/fr/"), (5, "http://x.com/de/1"), (6, "http://notexample.org"), (7, None), (8, "no scheme"),
    (9, "https://www.bad.net/p/?utm_source=a&k=1#z"), (10, "http://bad.net/p?k=1"), (11, "http://bad.net/p?k=2"),
    (1, "https://a.Example.ORG/es/x?q#f"), (None, "http://example.org/en/1"), (12, "://"), (13, "http://org/"),
]


@pytest.mark.parametrize("max_blocks", [1, 1 << 17])
def test_url_filter(spark, max_blocks):
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in URLS], "page_id bigint, url string, host string, rule string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([("http://bad.net/p/?k=1",), (None,), ("http://bad.net/p/?k=1",)], "url string")
    many = listed.union(spark.range(3000).select(F.concat(F.lit("http://l.net/"), F.col("id").cast("string"))))
    got = url_filter.filter_urls(pages, rules, many, max_blocks=max_blocks).collect()
    expected = []
    for page, url in URLS:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        bad = page in (9, 10)
        rule, verdict = max(fits)[2:] if fits else (None, "block" if bad else "allow")
        expected.append((page, host, path, rule, verdict, bad))
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, got)) == order(expected)
    assert url_filter.filter_urls(pages.limit(0), rules, many).count() == 0
    nothing = url_filter.filter_urls(pages, rules.limit(0), listed.limit(0)).collect()
    assert {r.verdict for r in nothing} == {"allow"}


# ---- 2 mixing ------------------------------------------------------------------------------------------------


def test_mixing(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))) or None, ["a", "b", "c", None][min(3, int(rng.integers(0, 9)) // 2)]) for i in range(1500)]
    rows += [(7, "same row here", "b")] * 3 + [(None, "no id\tat\nall", "z"), (2000, "", "empty")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("x"))
    got = mixing.mix_sources(docs).toPandas()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        for s in over or free:
            target[s] = 3.0 * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free -= over or free
    for source, part in got.groupby("source", dropna=False):
        source = None if source is None or source != source else source
        assert part.target.iloc[0] == pytest.approx(target[source])
        assert (part.source_size == sizes[source]).all()
        assert abs(part.taken.sum() - target[source]) <= 30
    assert (got.taken == got["size"] * got.copies).all() and got.copies.max() <= 3
    # Other partitions, and joins that the planner picks.
    again = mixing.mix_sources(docs.repartition(7), max_broadcast_sources=0).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(str, again[key].values.tolist())) == sorted(map(str, got[key].values.tolist()))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == got.copies.sum()
    assert mixing.mix_sources(docs.limit(0)).count() == 0


# ---- 3 toxicity ----------------------------------------------------------------------------------------------


def test_toxicity(spark):
    rows = [(i, prose(i, 80) + (f" vequ{i % 7}ance idiot vequ{i % 5}ment" if i % 4 == 0 else "")) for i in range(1200)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(1000)] + [(3, 1, None), (5, 1, 7), (None, 1, 1)]
    extra = [(5000, None), (5001, ""), (None, "idiot"), (5002, "idiot " * 9000), (5000, None)]
    docs = documents(spark, rows + extra)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.score_toxicity(docs, marks).toPandas()
    assert len(got) == len(rows) + len(extra) and got.score.between(0, 1).all()
    known = got[got.doc_id.notna() & (got.doc_id < 1200)]
    held = np.array([zlib.crc32(str(int(i)).encode()) % 3 == 1 for i in known.doc_id])
    assert (known.held_out == held).all()
    truth = known.doc_id % 4 == 0
    assert ((known.predicted == 1) == truth)[held].mean() > 0.97
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert got[got.doc_id == 5002].predicted.iloc[0] == 1 and (got[got.doc_id.isin([5000, 5001])].predicted == 0).all()
    kept = toxicity.without_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == (got.predicted == 0).sum()
    assert set(toxicity.score_toxicity(docs, marks.limit(0)).toPandas().predicted) == {0}
    assert toxicity.score_toxicity(docs.limit(0), marks).count() == 0


def test_rare_spellings_are_kept(spark):
    """Every sequence of the sample is in the model, with its count, even those met once."""
    rows = [(i, f"plain words {prose(i, 20)}" + (f" zk{chr(97 + i % 26)}{chr(97 + i // 26)}q" if i % 2 else "")) for i in range(400)]
    marks = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    drawn = {r.id for r in toxicity._labelled(marks, 25_000, False).collect()}
    model = toxicity.train(documents(spark, rows), marks)
    for level in model.levels[toxicity.SHARED - 1 :]:
        words = sorted({w for i, t in rows if i in drawn for w in t.split()})
        grams = toxicity._grams(*toxicity._symbols(words), level.order)
        assert np.isin(grams[0], level.grams).all() and np.isin(grams[1], level.contexts).all()
    rare = [w for i, t in rows if i in drawn and i % 2 for w in t.split()[-1:]]
    assert len(rare) == len(set(rare)) and (model._differences(rare) > 1).all()


def kneser_ney(by_class, corpus):
    """Log-likelihood of words in each class by plain counting: `by_class` and `corpus` are counters of words."""
    def tables(words, orders):
        pad = "\x01" * (toxicity.ORDER - 1)
        raw = {o: Counter() for o in (*orders, orders[-1] + 1)}
        for w, n in words.items():
            text = pad + w + "\x02"
            for o in raw:
                for i in range(len(pad), len(text)):
                    raw[o][text[i - o + 1 : i + 1]] += n
        out = {}
        for o in orders:
            if o == toxicity.ORDER:
                out[o] = raw[o]
                continue
            out[o] = Counter()
            for g in raw[o + 1]:
                out[o][g[1:]] += raw[o][g[1:]] if g[1] == "\x01" else 1
            out[o] = Counter({g: raw[o][g] if g[0] == "\x01" else n for g, n in out[o].items()})
        return out

    classes = [tables(c, range(toxicity.SHARED + 1, toxicity.ORDER + 1)) for c in by_class]
    shared = tables(corpus, range(1, toxicity.SHARED + 1))

    def p(counts, order, text, i):
        if order == 1:
            return shared[1][text[i]] / sum(shared[1].values()) if text[i] in shared[1] else toxicity.UNSEEN
        table = (shared if order <= toxicity.SHARED else counts)[order]
        gram, context = text[i - order + 1 : i + 1], text[i - order + 1 : i]
        of = [n for g, n in table.items() if g[:-1] == context]
        below = p(counts, order - 1, text, i)
        if not of:
            return below
        d = toxicity.DISCOUNT
        return max(table[gram] - d, 0) / sum(of) + (1 - sum(max(n - d, 0) for n in of) / sum(of)) * below

    def of_word(w):
        text = "\x01" * (toxicity.ORDER - 1) + w + "\x02"
        return [sum(np.log(p(c, toxicity.ORDER, text, i)) for i in range(toxicity.ORDER - 1, len(text))) for c in classes]
    return of_word


def test_levels_are_kneser_ney(spark):
    rng = np.random.default_rng(33)
    spell = lambda: "".join(rng.choice(list("abcdé"), rng.integers(1, 9)))
    corpus = [spell() for _ in range(120)]
    toxic, ordinary = Counter(corpus[:40] * 2 + corpus[:5]), Counter(corpus[30:80])
    rows = [(w, toxic[w], ordinary[w]) for w in {*toxic, *ordinary}]
    texts = spark.createDataFrame([(" ".join(corpus),), (" ".join(corpus[:60]),), (None,)], "text string").repartition(3)
    levels, single, share = toxicity.language_levels(spark.createDataFrame(rows, "word string, toxic long, ordinary long").repartition(3), texts)
    model = toxicity.Model(levels, single, share, np.zeros(4))
    of_word = kneser_ney([toxic, ordinary], Counter(corpus + corpus[:60]))
    words = sorted({*corpus[:80], *[spell() for _ in range(40)]})
    words = [w for w in words if set(zip("\x01" + w, w)) <= {p for c in corpus[:80] for p in zip("\x01" + c, c)}]
    got = model.of_words(words)
    for w, (a, b) in zip(words, got):
        # Levels of the corpus whose context no sampled word has are left out, for both classes alike.
        assert a - b == pytest.approx(of_word(w)[0] - of_word(w)[1], rel=1e-4, abs=1e-4)
        if w in toxic or w in ordinary:
            assert [a, b] == pytest.approx(of_word(w), rel=1e-4)


# ---- 4 decontamination ---------------------------------------------------------------------------------------


def test_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = (list(map(int, rng.integers(0, 6, rng.integers(0, 30)))) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == table[-1, -1]


def test_decontamination(spark):
    items = {i: prose(1000 + i, 30, 5000) for i in range(40)}
    items[40] = prose(2000, 150, 5000)
    marks = [(i, t) for i, t in items.items()] + [(41, None), (42, ""), (3, items[3])]
    rows, planted = [], set()
    for i in range(200):
        text = prose(i, 300, 5000)
        if i % 5 == 0:
            words = items[i // 5].split()
            if i % 10 == 0:
                words = [w for k, w in enumerate(words) if k % 7 != 3]  # one word in seven is gone
            cut = 40 + i
            text = " ".join(text.split()[:cut] + words + text.split()[cut:])
            planted.add((i, i // 5))
        rows.append((i, text))
    rows += [(900, None), (901, ""), (902, items[40]), (903, "A: " + items[7].upper())]
    planted |= {(902, 40), (903, 7)}
    docs, bench = documents(spark, rows), spark.createDataFrame(marks, "item_id bigint, text string").withColumn("places", F.lit(1))
    got = decontaminate.benchmark_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and len(got) == len(planted)
    blocks = decontaminate.benchmark_leaks(docs, bench, block_passages=9).collect()
    assert {(r.doc_id, r.item_id) for r in blocks} == planted
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len({d for d, _ in planted})
    assert decontaminate.benchmark_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.benchmark_leaks(docs.limit(0), bench).count() == 0


def test_short_passages_of_a_large_block(spark):
    """Many more passages than the rank, shorter than a window: each is found, also with a word in six gone."""
    rng = np.random.default_rng(44)
    items = {i: prose(3000 + i, int(rng.integers(4, 30)), 3000) for i in range(1500)}
    rows, planted = [], set()
    for i in range(200):
        words, item = prose(i, 250, 3000).split(), items[i].split()
        if i % 2 and len(item) >= 12:
            item = [w for k, w in enumerate(item) if k % 6 != 3]
        at = int(rng.integers(0, 250))
        rows.append((i, " ".join(words[:at] + item + words[at:])))
        planted.add((i, i))
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_leaks(documents(spark, rows), bench).collect()}
    assert planted <= got and len(got) <= len(planted) + 2


def test_common_words_are_no_leak(spark):
    """Items of words that every document has count where they stand word by word, and nowhere else."""
    rows, planted = [], set()
    items = {i: prose(5000 + i, 18, 60) for i in range(20)}
    for i in range(400):
        words = prose(i, 400, 60).split()
        if i % 8 == 0:
            words[50:50] = items[i // 8 % 20].split()
            planted.add((i, i // 8 % 20))
        rows.append((i, " ".join(words)))
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_leaks(documents(spark, rows), bench).collect()}
    assert got == planted


def test_paraphrases_need_their_answer(spark):
    """With four words in ten replaced, an item is found by cosine if its answer stands in the same stretch."""
    rng = np.random.default_rng(77)
    items = {i: prose(8000 + i, 40, 4000) for i in range(60)}
    rows, planted = [(1000 + i, prose(i, 300, 4000)) for i in range(300)], set()
    for i, text in items.items():
        words = text.split()
        keep = words[:30] if i % 2 else words
        kept = [w if j >= 30 or rng.random() < 0.62 else f"other{rng.integers(0, 10**6)}" for j, w in enumerate(keep)]
        far = [] if i % 2 == 0 else prose(9000 + i, 200, 4000).split() + words[30:]
        rows.append((i, " ".join(prose(i + 500, 70, 4000).split() + kept + far)))
        if i % 2 == 0:
            planted.add((i, i))
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = decontaminate.benchmark_leaks(documents(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} <= planted and len(got) >= 0.9 * len(planted)
    assert all(r.cosine >= 0.4 and r.answer for r in got)


def test_latent_basis(spark):
    rng = np.random.default_rng(3)
    table = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 40))
    rows = spark.createDataFrame([(list(range(40)), r.tolist()) for r in table], "places array<long>, vals array<double>")
    basis = decontaminate.latent_basis(rows, 40, 60, rank=5)
    assert np.allclose(table @ basis @ basis.T, table) and np.allclose(basis.T @ basis, np.eye(5))


# ---- 5 vectors -----------------------------------------------------------------------------------------------


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_forest, "LEAF", 60)
    monkeypatch.setattr(embedding_forest, "BLOCK", 50)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((120, 16))
    vectors = np.concatenate([base, base[:60] + 0.12 * rng.standard_normal((60, 16)), np.repeat(base[:1], 130, 0) + 0.02 * rng.standard_normal((130, 16))])
    rows = [(i, v.tolist(), i % 5) for i, v in enumerate(vectors)]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, [float("inf")] * 16, 0), (904, base[3].tolist(), 1),
           (905, (base[3] * 1e200).tolist(), 1), (None, base[3].tolist(), 1), (906, [1.0, None] + [0.0] * 14, 0), (907, [1.0], 0), (5, vectors[5].tolist(), 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1))
    got = embedding_forest.near_vectors(frame).toPandas()
    assert len(got) == len(rows) + len(odd)
    usable = {i: np.array(v) / np.abs(v).max() for i, v, _ in [*rows, odd[4], odd[5]]}
    usable = {i: v / np.linalg.norm(v) for i, v in usable.items()}
    ids = sorted(usable)
    near = np.stack([usable[i] for i in ids])
    near = near @ near.T >= 0.9
    links = dict(zip(ids, near.sum(axis=1) - 1))
    component = {i: i for i in ids}
    for _ in ids:
        component = {i: min(component[ids[j]] for j in np.flatnonzero(near[k])) for k, i in enumerate(ids)}
    found = got[got.vec_id.isin(ids)]
    assert found.n_links.sum() >= 0.9 * sum(links[i] for i in found.vec_id)
    assert all(n <= links[i] for i, n in zip(found.vec_id, found.n_links))
    assert np.mean([component[i] == c for i, c in zip(found.vec_id, found.component_id)]) > 0.9
    rest = got[got.vec_id.isin([900, 901, 902, 903, 906, 907])]
    assert (rest.n_links == 0).all() and (rest.component_id == rest.vec_id).all() and rest.kept.all()
    assert got[got.vec_id.isna()].component_id.isna().all()
    assert embedding_forest.near_vectors(frame.limit(0)).count() == 0


def test_links_near_the_threshold_are_found(spark):
    """Pairs of cosine 0.90 to 0.92 among other vectors, with the operator's own leaves and spill; copies count in full."""
    rng = np.random.default_rng(55)
    base = rng.standard_normal((6000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal((1500, 64))
    other -= (other * base[:1500]).sum(axis=1, keepdims=True) * base[:1500]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.9005, 0.92, (1500, 1))
    vectors = np.concatenate([base, cosine * base[:1500] + np.sqrt(1 - cosine**2) * other, np.repeat(base[:1], 700, 0)])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = embedding_forest.near_vectors(frame).toPandas().set_index("vec_id").sort_index()
    assert (got.component_id[6001:7500].to_numpy() == np.arange(1, 1500)).mean() >= 0.99
    same = [0, *range(7500, 8200)]
    linked = int(got.component_id[6000] == 0)
    assert (got.n_links[same] == 700 + linked).all() and (got.component_id[same] == 0).all() and got.kept[same].sum() == 1
    assert got.n_links[6000] == 701 * linked


def test_links_at_the_threshold_are_found(spark):
    """Cosines of exactly 9 / 10, between whole numbers and in other scales, and the nearest ones below it."""
    b = np.array([9, 4, 1, 1, 1, 0.0])
    vectors = [k * np.roll(v, r) for r in range(6) for k in (1, 7, 2.0**-600, 3 * 2.0**500) for v in (np.eye(6)[0], b)]
    below = [np.eye(6)[0], np.array([9 - 1e-14, 4, 1, 1, 1, 0])]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, [*v.tolist(), 0.0]) for i, v in enumerate(below)]
    got = embedding_forest.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).toPandas()
    assert (got.n_links[got.vec_id < 1000] == 7).all() and (got.n_links[got.vec_id >= 1000] == 0).all()
    assert (got.component_id[got.vec_id < 1000] == got.vec_id[got.vec_id < 1000] // 8 * 8).all()


# ---- 6 token files -------------------------------------------------------------------------------------------


TEXTS = [None, "", "a  b   c\n\n\n d \n e \t f  ", "x <|endoftext|> y", " \x1c a\x85b   c 's 't I'm 12 34² é",
         "word, (word) word! don't can't 你好 مرحبا", "\n\nlead", "tail \n", "z " * 20_000]


def test_token_files(spark):
    from tokenizers import Tokenizer

    rows = [(i, prose(i, int(n), 90) + ".") for i, n in enumerate(np.random.default_rng(6).integers(1, 300, 400))]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (7, "again"), (7, "again")]
    docs = documents(spark, rows)
    path = new_scratch(spark, "tokens")
    token_files.write_tokens(docs, path, TOKENIZER, partitions=4)
    got = token_files.token_digests(spark, path).toPandas().sort_values("start")
    told = Tokenizer.from_file(TOKENIZER)
    ids = [(i, np.array(told.encode(t or "", add_special_tokens=False).ids + [0], "<u4")) for i, t in rows]
    expected = sorted((-1 if i is None else i, len(a), zlib.crc32(a.tobytes())) for i, a in ids)
    order = got.doc_id.fillna(-1).astype(int)
    assert sorted(zip(order, got.n_tokens, got.ids_crc32)) == expected
    assert list(order) == sorted(order)
    assert list(got.start) == [0, *np.cumsum(got.n_tokens)[:-1]]
    one = token_files.read_document(spark, path, 1008)
    assert len(one) == 1 and one[0].tolist() == dict(ids)[1008].tolist()
    assert token_files.read_document(spark, path, 5555) == []
    image = bytes(spark.read.parquet(f"{path}/blocks").first().image)
    with pytest.raises(ValueError):
        list(token_files.read_image(image, b"another dictionary"))
    empty = new_scratch(spark, "tokens")
    token_files.write_tokens(docs.limit(0), empty, TOKENIZER)
    assert token_files.token_digests(spark, empty).count() == 0


def test_white_space_of_all_kinds():
    from tokenizers import Tokenizer

    told, encoder = Tokenizer.from_file(TOKENIZER), token_files.Encoder(TOKENIZER)
    signs = list(" \n\n  \t\r\v\f\x1c\x1f\x85\xa0\u1680\u2003\u2028\u2029\u202f\u3000") + ["word", "a", ".", "7", "'s", "é"]
    rng = np.random.default_rng(66)
    texts = ["".join(rng.choice(signs, int(rng.integers(1, 12)))) for _ in range(30_000)]
    texts += ["word.\n\xa0\xa0next", "word.\n\xa0 next", "word\n\xa0", "word\n\xa0\nnext"]
    for start in range(0, len(texts), 1000):
        part = texts[start : start + 1000]
        whole = [e.ids for e in told.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(part)] == whole


# ---- 7 Jaccard join ------------------------------------------------------------------------------------------


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def linked(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(i for i in sets if sets[i])
    component = {i: i for i in sets}
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = component[a], component[b]
                component = {k: min(x, y) if v in (x, y) else v for k, v in component.items()}
    return sets, component


def test_jaccard_join(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "BLOCK", 20)
    rng = np.random.default_rng(7)
    rows, passage = [], prose(99, 50)
    for i in range(40):
        words = prose(i, int(rng.integers(3, 260)), 50_000).split()
        rows.append((i, " ".join(words)))
        for k in range(4):
            changed = list(words)
            for at in rng.integers(0, len(words), int(len(words) * rng.choice([0, 0.005, 0.02, 0.03, 0.1]))):
                changed[at] = f"new{rng.integers(1 << 30)}"
            rows.append((100 + 10 * i + k, " ".join(changed)))
    rows += [(1000 + i, passage + " " + prose(500 + i, int(rng.integers(1, 60)), 50_000)) for i in range(70)]
    rows += [(2000, None), (2001, ""), (2002, "A b\tC"), (2003, "a B c"), (2004, "a b c d e f"), (None, passage), (2005, " \n"), (2003, "a B c")]
    got = parity_join.similar_sets(documents(spark, rows))[0].collect()
    sets, component = linked(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), component[r.doc_id])
    assert parity_join.similar_sets(documents(spark, rows).limit(0))[0].count() == 0


def test_near_duplicates_without_good_ids(spark):
    import corpus_pipeline

    a, b, c, d = (prose(7000 + k, 60, 50_000) for k in range(4))
    rows = [(None, a), (None, a), (1, b), (None, b), (5, c), (5, d), (6, d), (9, ""), (None, None)]
    docs = documents(spark, rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    expected = [(None, a), (1, b), (5, c), (5, d), (9, ""), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_sketch_keys_meet():
    rng = np.random.default_rng(8)
    for size in [4, 5, 9, 20, 63, 64, 100, 333, 1500]:
        for _ in range(40):
            one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            gone = int(rng.integers(0, size * 20 // 100 + 1))
            other = np.unique(np.r_[one[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, size // 8 + 1))).astype(np.uint64)])
            common = len(np.intersect1d(one, other))
            if len(one) != len(other) or common < len(one):
                if 100 * common >= 80 * (len(one) + len(other) - common):
                    assert len(np.intersect1d(parity_join.sketch_keys(one, 80), parity_join.sketch_keys(other, 80)))


# ---- 8 licences ----------------------------------------------------------------------------------------------


def test_licences(spark):
    rows = [(i, "\n".join(prose(10 * i + k, 12, 3000) for k in range(4))) for i in range(300)]
    told = {300: "apache-2.0", 301: "mit", 302: "gpl-3.0", 303: "cc-by-nc-4.0"}
    rows += [(i, f"{prose(i, 30)}\n{license_scan.TEMPLATES[f][0]}\n{prose(i + 50, 30)}") for i, f in told.items()]
    rows += [(304, license_scan.TEMPLATES["mit"][0] + "\n" + license_scan.TEMPLATES["apache-2.0"][0]), (305, None), (306, ""), (307, "word " * 5000),
             (308, prose(1, 300) + " " + license_scan.TEMPLATES["apache-2.0"][1] + " " + prose(2, 300)), (None, license_scan.TEMPLATES["mit"][0]), (301, rows[-3][1])]
    got = license_scan.scan_licences(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].licence == f for i, f in told.items())
    assert by[304].families == "apache-2.0,mit" and by[304].licence == "several"
    assert by[308].licence == "apache-2.0" and by[None].licence == "mit"
    assert {by[i].licence for i in (305, 306, 307)} == {"none"}
    assert sum(by[i].licence != "none" for i in range(300)) <= 1
    assert license_scan.scan_licences(documents(spark, rows[:50])).count() == 50
    assert license_scan.scan_licences(documents(spark, rows).limit(0)).count() == 0


# Wordings that the templates do not have, by the families that may be reported for them.
WORDINGS = [
    ("gpl-3.0", "This package is distributed under the GNU General Public License, version 3 or later."),
    ("gpl-2.0", "This package is distributed under the GNU General Public License, version 2 or later."),
    ("gpl-2.0", "modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2"),
    ("lgpl-2.1", "You can redistribute it under the terms of the GNU Lesser General Public License, version 2.1."),
    ("lgpl-3.0", "Distributed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "It is free software under the terms of the GNU Affero General Public License, version 3."),
    ("apache-2.0", "The code is available under the Apache License, Version 2.0."),
    ("apache-1.1", "The code is licensed under the Apache Software License, Version 1.1."),
    ("cc-by-4.0", "The text is available under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "The text is available under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "The text is available under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (None, "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    (None, "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc0-1.0", "These data are dedicated to the public domain under CC0 1.0."),
    ("isc", "This tool is released under the ISC License."),
    ("mpl-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
    (None, "This file is subject to the terms of the Mozilla Public License, version 1.1."),
    ("epl-2.0", "Made available under the terms of the Eclipse Public License 2.0."),
    (None, "Made available under the terms of the Eclipse Public License 1.0."),
    ("bsd-3-clause", "This is released under the BSD 3-Clause License."),
    ("bsd-2-clause", "This is released under the BSD 2-Clause License."),
    ("mit", "This is licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and\nassociated documentation files"),
    ("gpl-3.0", "This program is free software: you can redistribute it\nand/or modify it under the terms of the GNU General\nPublic License as published by the Free Software\nFoundation, either version 3 of the License."),
    ("gpl-2.0", "This program is free software; you can redistribute it\r\nand/or modify it under the terms of the GNU General\r\nPublic License as published by the Free Software\r\nFoundation; either version 2 of the License."),
]


def test_related_licences_are_told_apart(spark):
    """Other wordings, wrapped ones among them: never another family, and nearly always the right one."""
    rows = [(1000 + i, "\n\n".join(prose(10 * i + k, 12, 3000) for k in range(4))) for i in range(300)]
    rows += [(i, f"{prose(i, 30)}\n\n{text}\n\n{prose(i + 50, 30)}") for i, (_, text) in enumerate(WORDINGS)]
    by = {r.doc_id: r.licence for r in license_scan.scan_licences(documents(spark, rows)).collect()}
    wrong = [(by[i], text) for i, (family, text) in enumerate(WORDINGS) if by[i] not in (family, "unknown", "none")]
    assert not wrong
    assert sum(by[i] == family for i, (family, _) in enumerate(WORDINGS) if family) >= 18
    assert sum(by[1000 + i] != "none" for i in range(300)) <= 1


# ---- 9 sentence spans ----------------------------------------------------------------------------------------


def test_sentence_spans(spark):
    passage = " ".join(f"{prose(k, 9)}." for k in range(7))
    rows = [(i, " ".join(f"{prose(1000 * i + k, 8, 9000)}." for k in range(12))) for i in range(60)]
    for i in range(0, 60, 6):
        text = rows[i][1].split(". ")
        rows[i] = (i, ". ".join(text[:5]) + ". " + passage + " " + ". ".join(text[5:]))
    rows += [(100, None), (101, ""), (102, "One line.\n" * 30), (103, rows[3][1]), (None, passage), (104, prose(5, 400, 90)), (105, "x " + prose(5, 400, 90)), (0, rows[0][1])]
    got = {(r.doc_id, r.text): r for r in sentence_spans.remove_repeated_spans(documents(spark, rows)).collect()}
    first, cover = {}, {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = [tuple(text[a:b].lower().split()) for a, b in sentence_spans.sentences_of(text)]
        for a, b in sentence_spans.runs_of([len(w) for w in words]):
            at = first.setdefault(tuple(words[a : b + 1]), (i, a, b))
            if at[:2] != (i, a):
                cover.setdefault(i, set()).update(range(max(a, at[2] + 1) if at[0] == i else a, b + 1))
    assert len(got) == len({r for r in rows})
    for (i, _), r in got.items():
        assert set(r.removed) == cover.get(i, set())
    by = {i: r for (i, _), r in got.items()}
    assert by[103].text == "" and by[103].first_docs == [3]
    for i in range(6, 60, 6):
        assert passage not in by[i].text and 0 in by[i].first_docs and by[i].text.startswith(rows[i][1][:20])
    assert by[1].text == rows[1][1] and by[1].removed == []
    assert sentence_spans.remove_repeated_spans(documents(spark, rows).limit(0)).count() == 0


def test_short_and_unspaced_sentences(spark):
    """Repeated passages of 3 to 11 one-token sentences, of two long ones, and of three of one word each."""
    rng = np.random.default_rng(9)
    chinese = lambda n: "".join(chr(int(c)) for c in rng.integers(0x4E00, 0x9000, n)) + "。"
    rows, passages = [], {}
    for k, n in enumerate([3, 4, 8, 11, 2]):
        passages[k] = "".join(chinese(40 if n == 2 else 9) for _ in range(n))
    passages[5] = "Alpha. Beta. Gamma. "
    for k, passage in passages.items():
        rows += [(10 * k + j, chinese(12) + passage + chinese(12)) for j in range(2)]
    got = {r.doc_id: r for r in sentence_spans.remove_repeated_spans(documents(spark, rows)).collect()}
    for k, passage in passages.items():
        first, second = rows[2 * k][1], rows[2 * k + 1][1]
        assert got[10 * k].text == first and got[10 * k].removed == []
        assert got[10 * k + 1].text == second.replace(passage, "") and got[10 * k + 1].first_docs == [10 * k]


# ---- 10 WARC -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc(spark, compression):
    long = "<p>\r\n\r\nWARC/1.1\r\n" + "é" * 200
    rows = [(3, "http://a/", long), (1, "http://b/", long), (2, None, long), (4, "u\r\nx: y", None), (5, "u", ""), (6, "u", "short"), (7, "v", "short"),
            (None, "w", long), (8, "z", "k" * 300_000), (1, "http://b/", long), (None, "n", "lone " * 50)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    path = new_scratch(spark, "warc")
    warc.write_pages(pages, path, compression)
    got = warc.read_pages(spark, path).collect()
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = html == long and page != 1
        expected.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    revisits = warc.read_warc(spark, path, payload=False).filter("record_type = 'revisit'")
    assert revisits.count() == 3 and revisits.filter("payload is not null").count() == 0
    target = warc.read_warc(spark, path).filter("target_uri like 'http://%' and record_id = '<urn:page:1>'").collect()
    assert len(target) == 2 and all(bytes(r.payload) == long.encode() for r in target)
    empty = new_scratch(spark, "warc")
    warc.write_pages(pages.limit(0), empty, compression)
    assert warc.read_pages(spark, empty).count() == 0


def test_foreign_archives(tmp_path):
    """Members without a length field, a record header longer than the first read, and LF lines."""
    import gzip

    records = [warc.record_bytes([("WARC-Type", t), ("WARC-Record-ID", f"<{i}>"), ("X-Long", "y" * n)], b"block %d" % i)
               for i, (t, n) in enumerate([("warcinfo", 5), ("response", 40_000), ("revisit", 1)])]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc").write_bytes(b"WARC/1.0\nWARC-Type: response\nContent-Length: 3\n\nabc\n\n")
    import pyarrow as pa

    for name in ("a.warc.gz", "a.warc"):
        with pa.OSFile(str(tmp_path / name)) as file:
            assert [p for _, _, p in warc.read_records(file)] == [b"block 0", b"block 1", b"block 2"]
        with pa.OSFile(str(tmp_path / name)) as file:
            wanted = list(warc.read_records(file, lambda h: h["warc-type"] != "response", payload=False))
            assert [h["warc-record-id"] for _, h, _ in wanted] == ["<0>", "<2>"]
    with pa.OSFile(str(tmp_path / "b.warc")) as file:
        assert [p for _, _, p in warc.read_records(file)] == [b"abc"]


@pytest.mark.parametrize("compression", ["gzip", "foreign gzip", "none"])
def test_long_records_are_read_in_linear_time(compression):
    """Records of many MB, wanted and not: each byte is handled a bounded number of times."""
    import gzip
    import io

    body = np.random.default_rng(1).integers(0, 256, 24 << 20, dtype=np.uint8).tobytes()
    pack = {"gzip": warc.gzip_member, "foreign gzip": lambda d: gzip.compress(d, 1), "none": lambda d: d}[compression]
    records = [warc.record_bytes([("WARC-Type", kind), ("WARC-Record-ID", f"<{kind}>")], block) for kind, block in
               (("a", b"x"), ("long", body), ("long", body), ("b", b"y" * 100_000))]
    data = b"".join(map(pack, records))
    began = time.process_time()
    told = [(h["warc-type"], p) for _, h, p in warc.read_records(io.BytesIO(data))]
    assert told == [("a", b"x"), ("long", body), ("long", body), ("b", b"y" * 100_000)]
    assert [h["warc-type"] for _, h, _ in warc.read_records(io.BytesIO(data), lambda h: h["warc-type"] != "long")] == ["a", "b"]
    assert time.process_time() - began < 5


def test_jobs_do_not_share_temporary_folders(spark, tmp_path):
    writers = [warc.WarcWriter({"path": str(tmp_path)}) for _ in range(2)]
    row = {"record_type": "response", "record_id": "<urn:page:1>", "target_uri": None, "date": "2024-01-01T00:00:00Z",
           "refers_to": None, "payload_digest": None, "payload_length": 1, "payload": b"x"}
    messages = [w.write(iter([pa.RecordBatch.from_pylist([row])])) for w in writers]
    writers[0].abort([])
    writers[1].commit([messages[1]])
    assert [p.name for p in tmp_path.iterdir()] == list(messages[1].files)
