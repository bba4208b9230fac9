"""SentencePiece ids by a table of last tokens, and texts back from ids (method 13).

Byte-pair encoding merges neighbouring symbols, best score first, leftmost of equal ones. What it makes of a text can be
found without merging. Two tokens are compatible if merging the characters of both together gives just these two, and a
sequence of tokens is the encoding of its text if every two neighbours are compatible. So the encoding of each prefix
of a text ends in a token that is unique: of the tokens that end there, as an automaton over the vocabulary tells, the
one that is compatible with the last token of the prefix before it. One pass over the text stores it for each prefix; the
ids are then read backwards from the last entry.

No token crosses a place where two characters meet that stand together in no piece of the vocabulary, so texts are cut
at such places and the parts encoded alone; each worker process remembers the parts that it has met. Most of a text is cut in
front of spaces and at newlines by one regular expression, and words met for the first time at the other places.

Normalization is the identity with a space in front and spaces as U+2581, as the model says; a model of another kind, or
another algorithm than byte-pair encoding, is refused.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanrank.llm.words import batches, bound_batches, worker_state

SPACE = "▁"
#: Parts of texts that a worker process remembers in each of two generations, and the longest of them; the rest is encoded
#: each time it is met.
_CACHE, _CACHED_LENGTH = 150_000, 64
#: Where parts may end: Latin letters, and ASCII signs and digits.
_LETTERS, _SIGNS = "A-Za-z\u00c0-\u024f", re.escape(string.punctuation + string.digits)


class PieceTable:
    """The vocabulary of a model, and what is needed to encode with it."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as told

        self.model = SentencePieceProcessor(model_file=path)
        kind = told.ModelProto()
        with open(path, "rb") as file:
            kind.ParseFromString(file.read())
        rules, piece = kind.normalizer_spec, told.ModelProto.SentencePiece
        plain = (
            kind.trainer_spec.model_type == told.TrainerSpec.BPE and kind.trainer_spec.byte_fallback
            and not rules.precompiled_charsmap and not rules.normalization_rule_tsv and rules.add_dummy_prefix
            and rules.escape_whitespaces and not rules.remove_extra_whitespaces
            and not kind.trainer_spec.treat_whitespace_as_suffix
            and all(p.type in (piece.NORMAL, piece.UNKNOWN, piece.CONTROL, piece.BYTE) for p in kind.pieces)
        )
        if not plain:
            raise ValueError("not a byte-pair model with byte fallback and plain normalization")
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()
        self.ids = {p.piece: i for i, p in enumerate(kind.pieces) if p.type == piece.NORMAL}
        self.score = {p.piece: p.score for p in kind.pieces if p.type == piece.NORMAL}
        self.bytes = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.met = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}  # characters that stand together
        self.alone = "\n" not in "".join(self.met)
        # Spaces begin a part, unless some piece has one behind another character. So do ASCII signs behind Latin letters, and
        # letters behind signs, unless a piece joins them.
        inner = any(SPACE in pair[1] and pair[0] != SPACE for pair in self.met)
        kind = lambda c: _LETTERS if re.match(f"[{_LETTERS}]", c) else _SIGNS if re.match(f"[{_SIGNS}]", c) else c
        joined = any({*map(kind, pair)} == {_LETTERS, _SIGNS} for pair in self.met)
        line = "\n" if self.alone else ""
        one = lambda a, b: f"{SPACE}*[{a}]+(?=[{b}{SPACE}{line}]|\\Z)"
        kinds = [] if joined else [one(_LETTERS, _SIGNS), one(_SIGNS, _LETTERS)]
        kinds += [f"{SPACE}*[^{SPACE}{line}]+", f"{SPACE}+", *line]
        self.parts = None if inner else re.compile("|".join(kinds))
        self.histories: dict[str, tuple[tuple[str, ...], tuple[str, ...], bool]] = {}
        self.automaton = ahocorasick.Automaton()
        self.whole = {p for p in self.ids if len(p) > 1 and self._history(p)[2]}
        # With each token, the tokens before it that are known to be compatible, or not.
        self.before: dict[str, dict[str, bool]] = {p: {} for p in self.whole}
        self.tested = 0
        for p, before in self.before.items():
            self.automaton.add_word(p, (p, len(p), before))
        self.automaton.make_automaton()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges. For short sequences: the vocabulary's own pieces, and pairs of them."""
        symbols, score = list(symbols), self.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                value = score.get(symbols[i] + symbols[i + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, i
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _history(self, token: str) -> tuple[tuple[str, ...], tuple[str, ...], bool]:
        """The first symbols and the last symbols that a token has had while it was merged, and whether it gets whole."""
        if token not in self.histories:
            firsts, lasts, symbols, score = [token[0]], [token[-1]], list(token), self.score
            while len(symbols) > 1:
                values = [(score[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in score]
                if not values:
                    break
                at = -max(values)[1]
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
            self.histories[token] = tuple(dict.fromkeys(firsts)), tuple(dict.fromkeys(lasts)), len(symbols) == 1
        return self.histories[token]

    def compatible(self, one: str, other: str) -> bool:
        """Whether merging the characters of both tokens gives these two."""
        if one[-1] + other[0] not in self.met:
            return True
        score = self.score
        # Without a merge across the border both come to be as they do alone.
        across = any(a + b in score for a in self._history(one)[1] for b in self._history(other)[0])
        return not across or self.merged([*one, *other]) == [one, other]

    def _test(self, one: str, other: str, known: dict[str, bool]) -> bool:
        if self.tested >= 2 * _CACHE:
            self.tested = 0
            for told in self.before.values():
                told.clear()
        self.tested += 1
        known[one] = self.compatible(one, other)
        return known[one]

    def last_tokens(self, text: str) -> list[str | None]:
        """The last token of the encoding of each prefix of a text; None stands for its last character alone."""
        found: list[str | None] = [None] * (len(text) + 1)
        for end, (token, length, known) in self.automaton.iter(text):
            end += 1
            if found[end] is None:
                start = end - length
                if start:
                    before = found[start] or text[start - 1]
                    fits = known.get(before)
                    if not (self._test(before, token, known) if fits is None else fits):
                        continue
                found[end] = token
        return found

    def tokens(self, text: str) -> list[str]:
        """The tokens of a text, recovered backwards from the last tokens of its prefixes."""
        if len(text) == 1 or text in self.whole:
            return [text]
        found, at, out = self.last_tokens(text), len(text), []
        while at:
            token = found[at] or text[at - 1]
            out.append(token)
            at -= len(token)
        return out[::-1]

    def _token_ids(self, token: str) -> list[int]:
        got = self.ids.get(token)
        return [self.bytes[b] for b in token.encode("utf-8", "surrogatepass")] if got is None else [got]

    def _part(self, part: str) -> bytes:
        """Ids of a part of a text, cut where characters meet that stand together in no piece."""
        met, ids, start = self.met, [], 0
        cuts = [i for i, pair in enumerate(zip(part, part[1:]), 1) if "".join(pair) not in met]
        for cut in (*cuts, len(part)):
            for token in self.tokens(part[start:cut]):
                ids += self._token_ids(token)
            start = cut
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Little-endian u32 ids of a text, with the ids of its begin and end."""
        head, tail = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        if not text:
            return head + tail
        whole = SPACE + text.replace(" ", SPACE)
        parts = self.parts.findall(whole) if self.parts else [whole]
        if len(self.known) >= _CACHE:
            # Parts that were met again since the last change are kept, the others forgotten.
            self.older, self.known = self.known, {}
        known, older, now = self.known, self.older, {}
        for part in set(parts):
            ids = known.get(part)
            if ids is None:
                ids = older.get(part) or self._part(part)
                if len(part) <= _CACHED_LENGTH:
                    known[part] = ids
            now[part] = ids
        return b"".join([head, *map(now.__getitem__, parts), tail])

    def decode(self, ids: bytes) -> str:
        """The text of little-endian u32 ids, as the model's own decoder gives it."""
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


def worker_table(path: str) -> PieceTable:
    """The table of this worker process: made once and kept while no other operator's tasks come."""
    return worker_state(f"pieces {path}", lambda: PieceTable(path))


def encode_pieces(docs: DataFrame, model_path: str, id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of every whole text as little-endian u32 bytes, those of begin and end included.

    With `decoded` a column `text` has what the ids decode to, in the same pass.

    Defined cases: null and empty texts have the ids of begin and end alone; rows that share an id, or have a null one,
    are encoded each for itself; an empty table gives an empty result. Other columns are ignored.
    """
    bound_batches(docs.sparkSession)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(model_path)
        for batch in batches(source):
            ids = [table.encode(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array(map(table.decode, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"][: len(columns)])

    told = "doc_id long, ids binary" + (", text string" if decoded else "")
    return docs.select(F.col(id).cast("long"), F.col(text).cast("string")).mapInArrow(run, told)


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, text): the text of each row of (doc_id, ids); null ids have a null text."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(model_path)
        for batch in batches(source):
            texts = [None if i is None else table.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
