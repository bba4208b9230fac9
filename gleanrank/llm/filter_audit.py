"""What each filter of a chain removes, in every order of the chain (method 12). Only DataFrame functions.

Filters are players of a removal game: the worth v(S) of a coalition S is the number of rows that at least one filter
in S fails. A pass over the rows reduces them to counts for each part and set of failing filters; one fold over the
coalitions of a part then computes the game's potential after Hart and Mas-Colell,

    P(S) = (v(S) + sum of P(S without i) over the filters i of S) / |S|,   P(empty) = 0,

and a filter's Shapley value is P(all) - P(all without it). All numbers are kept times n!, so that they are whole. What
a step of an order removes is the difference of two coalitions, the filters so far with and without the last one.

Counting merges on the map side, at most 2 ** n rows for each part and task meet, and each part's table is one row of
short arrays, so a part that holds most rows is no hot key. Copies are found by a join on a digest of the text; its
side with one row for each digest is made by an aggregate, and adaptive execution splits the frequent digests of the other.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from gleanrank.session import materialize

#: All orders are listed: 7 filters have 5,040.
MOST_FILTERS = 7
#: Fixed pattern of a word, and the signs of filter D.
WORD = r"[^\x20\x09-\x0D]+"
ODD_SIGNS = "[#$%&*|]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def coalition_counts(rows: DataFrame, part: Column, fails: Mapping[str, Column], marks: Mapping[str, Column]) -> DataFrame:
    """(part, rows, removed, and an array for each mark): `removed[S]` rows of a part that a filter in S fails.

    S has bit i for the filter at place i of `fails`; the arrays of `marks` count the removed rows for which the mark
    holds. Conditions that are null do not hold.
    """
    n = len(fails)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters, not {n}")
    held = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    mask = sum((held(c) * (1 << i) for i, c in enumerate(fails.values())), F.lit(0).cast("long"))
    told = rows.select(part.alias("part"), mask.alias("mask"), *[held(c).alias(f"of_{k}") for k, c in marks.items()])
    kinds = told.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"of_{k}").alias(f"of_{k}") for k in marks])
    # Each coalition that shares a filter with the mask removes its rows.
    hit = lambda s: F.col("mask").bitwiseAND(F.lit(s)) != 0
    removed = lambda c: F.array(*[F.coalesce(F.sum(F.when(hit(s), F.col(c))), F.lit(0)) for s in range(1 << n)])
    return kinds.groupBy("part").agg(
        F.sum("n").alias("rows"), removed("n").alias("removed"), *[removed(f"of_{k}").alias(k) for k in marks]
    )


def potentials(worth: Column, n: int) -> Column:
    """Potentials of all coalitions of `n` filters, times n!, by a fold over the coalitions in the order of their bits."""
    scale = math.factorial(n)

    def add(known: Column, s: Column) -> Column:
        parts = [F.when(s.bitwiseAND(1 << i) != 0, F.get(known, s - (1 << i))).otherwise(F.lit(0)) for i in range(n)]
        total = F.get(worth, s) * scale + sum(parts[1:], parts[0])
        # Every coalition's potential is a sum of whole numbers over 1 to n, so n! times it is whole.
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(s).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), F.array(F.lit(0).cast("long")), add)


def audit_filters(rows: DataFrame, part: Column, fails: Mapping[str, Column], marks: Mapping[str, Column]) -> DataFrame:
    """One row for each part, order of the filters, and step of that order.

    (part, filter_order, step, kept, removed, redundant, unique_fails, one `<mark>_lost` for each mark, shapley).
    `fails` names the filters and says which rows fail them, `marks` the rows to be counted among those removed;
    `filter_order` joins the names. `shapley` is the filter's Shapley value times the number of orders: the sum of
    what it removes in all of them.

    Defined cases: a part that is null is a part of its own; conditions that are null do not hold; rows that are
    repeated count each time; an empty table gives an empty result; names of other columns do not matter.
    """
    names, n = list(fails), len(fails)
    full = (1 << n) - 1
    counts = materialize(coalition_counts(rows, part, fails, marks), "filter-coalitions")
    games = counts.withColumn("potential", potentials(F.col("removed"), n))
    orders = F.explode(F.array(*[F.array(*map(F.lit, order)) for order in itertools.permutations(range(n))]))
    steps = games.withColumn("order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    bits = lambda length: F.aggregate(
        F.slice("order", F.lit(1), length), F.lit(0), lambda s, i: s.bitwiseOR(F.call_function("shiftleft", F.lit(1), i))
    )
    steps = steps.withColumn("before", bits(F.col("step") - 1)).withColumn("after", bits(F.col("step")))
    own = F.col("after") - F.col("before")
    gain = lambda c: F.get(c, F.col("after")) - F.get(c, F.col("before"))
    # The grand coalition less the one without this filter.
    last = lambda c: F.get(c, F.lit(full)) - F.get(c, F.lit(full) - own)
    return steps.select(
        "part", F.array_join(F.transform("order", lambda i: F.get(F.array(*map(F.lit, names)), i)), "").alias("filter_order"),
        "step", (F.col("rows") - F.get("removed", F.col("after"))).alias("kept"), gain("removed").alias("removed"),
        (F.get("removed", own) - gain("removed")).alias("redundant"), last("removed").alias("unique_fails"),
        *[gain(k).alias(f"{k}_lost") for k in marks], last("potential").alias("shapley"),
    )


def document_failures(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, A, B, C, D, E): which of five quality filters each document fails, from its whole text.

    A: under 200 words; B: fewer than half of the words differ; C: more than 2 % capitals A-Z; D: one of the signs
    `#$%&*|`; E: the text of a document of a smaller id.

    Defined cases: a null text is empty, and so fails A, not B to D, and E behind another empty one; a null id is
    neither smaller nor larger than another; rows that share an id are not copies of each other; a null part is "".
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    read = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), value.alias("value"))
    # The words are a column of their own, so that they are cut once for both counts.
    cut = read.withColumn("words", F.regexp_extract_all("value", F.lit(WORD), 0))
    words, capitals = F.size("words"), F.length("value") - F.length(F.translate("value", _CAPITALS, ""))
    told = materialize(
        cut.select(
            "doc_id", "part", F.sha2("value", 256).alias("digest"), (words < 200).alias("A"),
            (100 * F.size(F.array_distinct("words")) < 50 * words).alias("B"), (100 * capitals > 2 * F.length("value")).alias("C"),
            F.col("value").rlike(ODD_SIGNS).alias("D"),
        ),
        "filter-failures",
    )
    copied = told.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # Stored, so that the join deals out both its sides and adaptive execution can split frequent digests.
    copied = materialize(copied.filter("first < last").select("digest", "first"), "filter-copies")
    return told.join(copied, "digest", "left").select(
        "doc_id", "part", "A", "B", "C", "D", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E")
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit_filters` of the five filters over `docs` by source, with the labels' good and toxic rows as marks.

    Labels of an id that occurs more than once hold if one of them does; null labels do not.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = document_failures(docs).join(known, "doc_id", "left")
    fails = {name: F.col(name) for name in "ABCDE"}
    return audit_filters(rows, F.col("part"), fails, {"good": F.col("good") == 1, "toxic": F.col("toxic") == 1})
