"""Spelling variants, filter audits and SentencePiece ids against brute force and the library."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanrank.llm import filter_audit, sentencepiece_table, spelling
from gleanrank.llm.queries import PIECES

DOCS = "doc_id bigint, text string, source string"
CLASHING = ("part", "digest", "words", "value", "key", "kind", "n", "step", "first", "row", "word", "ids", "removed", "rows")


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumns({n: F.lit("x") for n in CLASHING})


# ---- 11 spelling variants ------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form, told = {}, {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        told[w] = (form[w], root, words[w], len(near[w]), None if form[w] is None else words[form[w]])
    return told


def got_variants(table):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in table.collect()}


@pytest.mark.parametrize("letters", ["ab", "aé中", "abcdefgh"])
def test_spelling_variants(spark, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(0, 7))): 10 ** rng.randrange(0, 6) for _ in range(150)}
    # Chains of forms, ties, and runs of equal characters.
    words |= {"aaaaaaa": 1, "aaaaaaaa": 10, "aaaaaaaaa": 100, "aaaaaaaab": 1000, "baaaaaaab": 10_000, "aaaaaaac": 100, "😀aaaaaaa": 1}
    got = got_variants(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long").withColumn("key", F.lit(1))))
    assert got == variants(words)


def test_spelling_batches(spark):
    """Keys that reach over the end of a batch are still scanned whole."""
    words = {"".join(p): 1 + i for i, p in enumerate(itertools.product("abc", repeat=4))}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = got_variants(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)
    assert got == variants(words)


def test_word_counts(spark):
    rng = random.Random(3)
    letters = "ABab×éÉzÿ÷"
    rows = [(i, " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(200)), "s") for i in range(40)]
    rows += [(100, None, "s"), (101, "", None), (None, "Réponses Réponses ŁańcuchŁańcuch", "s"), (1, rows[1][1], "s"), (102, "longword " * 20_000, "s")]
    expected = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            expected[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    expected = {w: n for w, n in expected.items() if len(w) >= 7 and n >= 2}
    docs = documents(spark, rows)
    assert dict(spelling.word_counts(docs, typo_every=31).collect()) == expected
    assert spelling.spelling_variants(spelling.word_counts(docs.limit(0))).count() == 0


# ---- 12 filter audit -----------------------------------------------------------------------------------------


def brute_audit(rows, names, marks):
    """`rows` are (part, set of failing filters, {mark: bool})."""
    told, values = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations(names):
            left = own
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                values[part, name] += len(gone)
                told[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in r[1] for r in own) - len(gone), sum(r[1] == {name} for r in own),
                    *(sum(r[2][m] for r in gone) for m in marks), name,
                ]
    return {k: (*v[:-1], values[k[0], v[-1]]) for k, v in told.items()}


def test_audit_of_any_filters(spark):
    rng = random.Random(12)
    names, marks = ["long", "x", "tag"], ["m"]
    rows = [(rng.choice(["a", "b", None]), {n for n in names if rng.random() < 0.4}, {"m": rng.random() < 0.3}) for _ in range(300)]
    # Conditions that are null do not hold.
    flat = [(p, *(True if n in f else rng.choice([None, False]) for n in names), m["m"] or None) for p, f, m in rows]
    table = spark.createDataFrame(flat, "part string, long boolean, x boolean, tag boolean, m boolean").withColumn("removed", F.lit(1))
    audit = filter_audit.audit_filters(table, F.col("part"), {n: F.col(n) for n in names}, {"m": F.col("m")})
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.m_lost, r.shapley) for r in audit.collect()}
    assert got == brute_audit(rows, names, marks)
    with pytest.raises(ValueError):
        filter_audit.audit_filters(table, F.col("part"), {}, {})


def test_audit_of_documents(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choice(words[: rng.choice([20, 500])]) for _ in range(rng.choice([3, 199, 200, 260]))) for _ in range(40)]
    texts += [t + " " + s for t, s in zip(texts, ["#", "A" * 30, "|x", "É" * 50, "", " b", "\x0b", "\x85"] * 5)]
    rows = [(i, t, rng.choice(["s", "t", "", None])) for i, t in enumerate(texts + texts[:30])]
    rows += [(500, None, "s"), (501, "", "s"), (502, None, None), (None, texts[0], "s"), (None, "", "t"), (3, texts[3], "s"), (3, texts[3], "s"), (503, "Word " * 50_000, "t")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 100, 2)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 1)]
    first, flagged = {}, []
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {n for n, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search("[#$%&*|]", t)),
            i is not None and i > first.get(t, i),
        )) if bad}
        flagged.append((part or "", fails, {
            "good": any(a == i and q == 1 for a, q, _ in labels if a is not None), "toxic": any(a == i and x == 1 for a, _, x in labels if a is not None),
        }))
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("part", F.lit(1))
    audit = filter_audit.audit_documents(docs, marks)
    got = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in audit.collect()
    }
    assert got == brute_audit(flagged, "ABCDE", ["good", "toxic"])
    assert len(got) == 3 * 600
    assert filter_audit.audit_documents(docs.limit(0), marks).count() == 0
    assert filter_audit.audit_documents(docs, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


# ---- 13 SentencePiece ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_table.PieceTable(PIECES)


def own_ids(table, text):
    return np.frombuffer(table.encode(text), "<u4").tolist()


def test_ids_of_odd_texts(pieces):
    """Pieces in random order, rare characters, runs of spaces and of few letters."""
    rng = random.Random(13)
    vocabulary = [p.replace("▁", " ") for p in pieces.ids]
    odd = lambda: chr(rng.choice([9, 10, 13, 32, 0x85, 0xA0, 0x2581, rng.randrange(1, 0x300), rng.randrange(0x300, 0xD7FF), rng.randrange(0x10000, 0x1FFFF)]))
    texts = ["".join(rng.choice(vocabulary) if rng.random() < 0.7 else odd() for _ in range(rng.randrange(0, 12))) for _ in range(8000)]
    texts += ["".join(rng.choice("aeionrst "[: rng.randrange(1, 10)]) for _ in range(rng.randrange(0, 40))) for _ in range(8000)]
    texts += [" " * n + tail for n in range(70) for tail in ("", "a", "the\n", "x")] + ["<s></s><unk><0x0A>", "x" * 5000, "the " * 5000]
    for t in texts:
        ids = pieces.model.encode(t, add_bos=True, add_eos=True)
        assert own_ids(pieces, t) == ids, repr(t)
        assert pieces.decode(pieces.encode(t)) == pieces.model.decode(ids)


def test_last_token_of_every_prefix(pieces):
    """The table holds, for each prefix, the token that its own encoding ends in."""
    for text in ("▁internationalisation▁of▁the▁unhappily▁coded", "▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁▁abababab", "▁x中́é"):
        last = pieces.last_tokens(text)
        for end in range(1, len(text) + 1):
            assert (last[end] or text[end - 1]) == pieces.merged(list(text[:end]))[-1]


def test_cache_of_parts(pieces, monkeypatch):
    monkeypatch.setattr(sentencepiece_table, "_CACHE", 5)
    monkeypatch.setattr(sentencepiece_table, "_CACHED_LENGTH", 6)
    text = "Many different words, some of extraordinary length, and many again. " * 3
    assert own_ids(pieces, text) == pieces.model.encode(text, add_bos=True, add_eos=True)
    assert pieces.encode(text) == pieces.encode(text + "")


def test_pieces_of_documents(spark, pieces):
    rows = [(1, "Plain words.", "s"), (2, None, "s"), (3, "", None), (None, " lead and  trail ", "s"), (1, "Plain words.", "s"), (1, "Other", "s"),
            (4, "long text with wörds and 中文\n" * 30_000, "s")]
    told = sentencepiece_table.decode_pieces(sentencepiece_table.encode_pieces(documents(spark, rows), PIECES), PIECES)
    got = sorted(((r.doc_id, hashlib.sha256(r.ids).hexdigest(), r.text) for r in told.collect()), key=str)
    expected = []
    for i, text, _ in rows:
        ids = pieces.model.encode(text or "", add_bos=True, add_eos=True)
        expected.append((i, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), pieces.model.decode(ids)))
    assert got == sorted(expected, key=str)
    at_once = sentencepiece_table.encode_pieces(documents(spark, rows), PIECES, decoded=True).collect()
    assert sorted(((r.doc_id, hashlib.sha256(r.ids).hexdigest(), r.text) for r in at_once), key=str) == got
    assert sentencepiece_table.encode_pieces(documents(spark, rows).limit(0), PIECES).count() == 0


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        sentencepiece_table.PieceTable(str(tmp_path / "no.model"))
