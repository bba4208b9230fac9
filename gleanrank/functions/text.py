"""The one definition of what a term is, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the tokenizer contract: what turns into a space, what separates tokens, and what
# is deleted from a token (ASCII digits and the 32 ASCII punctuation signs).
TO_SPACE = r"\\[a-z]|-"
SEPARATORS = r"[ \t\n\r\f]+"
DELETED = r"[0-9\p{Punct}]"


def normalize(text: Column) -> Column:
    """Lowercase; a backslash with its letter, and every hyphen, becomes a space."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), TO_SPACE, " ")


def tokenize(text: Column) -> Column:
    """Array of clean, non-empty tokens in text order.

    Deleted signs and separators have no character in common, so deleting in the whole text and then
    splitting gives the tokens of splitting first and cleaning each token, with one regular-expression
    pass per document instead of one per token.
    """
    pieces = F.split(F.regexp_replace(normalize(text), DELETED, ""), SEPARATORS)
    return F.filter(pieces, lambda token: token != "")


def run_starts(ordered: str) -> Column:
    """Positions in a sorted array column where a run of equal values starts."""
    marks = F.transform(ordered, lambda token, i: F.when((i == 0) | (token != F.get(ordered, i - 1)), i))
    return F.filter(marks, lambda i: i.isNotNull())


def run_lengths(ordered: str, starts: str) -> Column:
    """Array of (term, tf) structs from a sorted array column and its run starts."""
    return F.transform(
        starts,
        lambda i, k: F.struct(
            F.get(ordered, i).alias("term"),
            (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - i).cast("bigint").alias("tf"),
        ),
    )
