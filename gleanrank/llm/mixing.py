"""Mixing sources to target weights by Pareto order sampling (method 2).

Only DataFrame functions. Targets are shared out by weight, and what a source cannot hold (more than
`max_copies` times its words) is shared again until none is above its bound. A document of a source that keeps
r of its words, and whose measure g is above or below the source's mean, is to be taken

    e = r (1 + tilt (g - mean g))     times, tilt at most 1 and at most max_copies / r - 1,

so that the expected words of a source are its target and no document is expected more than `max_copies`
times. floor(e) copies are certain. The rest p = e - floor(e) is an inclusion probability: documents are put
into the order of (random odds) / (odds of p), and one more copy goes to the first of them as long as the target is
not exceeded. The size of the sample is counted in words, which is what the target is in. As documents are
large, a gap remains; the one document left that fills it best, if any makes it smaller, is added.

No source is sorted as a whole. The order value is cut into 1,024 parts and these again into 1,024: sums of the
parts say in which of them the target is reached, and only the documents of that one part of a part are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from gleanrank.operators.numbering import number_rows
from gleanrank.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
PARTS = 1024


def count_words(text: Column) -> Column:
    """Number of words of a text; 0 for a null."""
    # Every word ends at a space or at the end; all that is no space is one sign.
    marks = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\u000b\u000c\r", "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], max_copies: int = 3) -> DataFrame:
    """(source, source_size, target) for (source, source_size) with one row for each source.

    Sources are ordered by code point, null last, and weigh `weights` in turn. The total of all sizes is shared.
    Each round of the sharing is one aggregation of this table; the driver sees two sums.
    """
    numbered = number_rows(
        sizes, [F.col("source").isNull().asc(), F.col("source").asc()], name="place"
    )
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    base = materialize(
        numbered.select("source", "source_size", turn.alias("weight"), (F.col("source_size") * max_copies).alias("bound")),
        "mix-sources",
    )
    total = base.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("weight") * level >= F.col("bound")
        held, open_weight = base.agg(
            F.sum(F.when(full, F.col("bound"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        raised = (total - (held or 0)) / open_weight if open_weight else level
        if not raised > level * (1 + 1e-12):
            break
        level = raised
    return base.select(
        "source", "source_size", F.least(F.col("bound").cast("double"), F.col("weight") * level).alias("target")
    )


def _reached(rows: DataFrame, wanted: DataFrame, part: str) -> DataFrame:
    """(s, part, before): for each source s the part in which the words in order reach `wanted`."""
    sums = rows.groupBy("s", part).agg(F.sum("size").alias("words"))
    # At most PARTS rows of each source come together here.
    running = F.sum("words").over(Window.partitionBy("s").orderBy(part))
    return (
        sums.withColumn("upto", running).join(wanted, "s")
        .filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("words") < F.col("need")))
        .select("s", F.col(part).alias("cut_" + part), (F.col("upto") - F.col("words")).alias("before_" + part))
    )


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_copies: int = 3, tilt: float = 0.5,
                seed: int = 20, max_broadcast_sources: int = 100_000) -> DataFrame:
    """One row for each row of `docs`: (doc_id, source, size, source_size, target, copies, taken, tie).

    Tables with one row for each source are broadcast up to `max_broadcast_sources` sources, so that no source's
    documents gather in one task; beyond that the planner picks the joins.

    `size` is the number of words, `taken` = size * copies, `tie` a hash of the text.

    Defined cases: a null source is a source of its own, last in order; null and empty texts have size 0 and
    copies 0; a source without words has target 0; rows that share a doc_id are documents of their own,
    told apart by their text; of exact repeated rows, which rank equal, as many are taken as reach the
    target; an empty table gives an empty result. Other columns are ignored. Equal input gives an equal
    set of rows, whatever the partitions.
    """
    text = F.col("text").cast("string")
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    slim = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            key.alias("s"), count_words(text).alias("size"), F.xxhash64(text).alias("tie"),
        ),
        "mix-sizes",
    )
    # The measure favours documents of some length; it lies in [0, 1).
    measure = F.col("size") / (F.col("size") + F.lit(200.0))
    sums = materialize(
        slim.groupBy("source", "s").agg(
            F.sum("size").alias("source_size"), F.sum(measure * F.col("size")).alias("measured")
        ),
        "mix-sums",
    )
    few = sums.count() <= max_broadcast_sources
    per_source = lambda table: F.broadcast(table) if few else table
    shared = source_targets(sums.select("source", "source_size"), weights, max_copies)
    shared = shared.select(F.col("source").alias("_source"), "target")
    has_words = F.col("source_size") > 0
    sources = sums.join(shared, F.col("source").eqNullSafe(F.col("_source"))).select(
        "s", "source_size", "target",
        F.when(has_words, F.col("target") / F.col("source_size")).otherwise(0.0).alias("share"),
        F.when(has_words, F.col("measured") / F.col("source_size")).otherwise(0.0).alias("mean"),
    )
    room = F.greatest(F.lit(0.0), max_copies / F.col("share") - 1)
    sources = materialize(
        sources.withColumn("tilt", F.when(F.col("share") > 0, F.least(F.lit(float(tilt)), room)).otherwise(0.0)),
        "mix-targets",
    )

    expected = F.least(F.lit(float(max_copies)), F.col("share") * (1 + F.col("tilt") * (measure - F.col("mean"))))
    # The small addition takes an expectation that is whole but for rounding as whole.
    whole = F.when(F.col("size") > 0, F.floor(F.col("expected") + 1e-9)).otherwise(0).cast("int")
    rest = F.greatest(F.lit(0.0), F.col("expected") - F.col("whole"))
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("tie")), 11)
    ranked = (
        slim.join(per_source(sources.select("s", "share", "tilt", "mean")), "s")
        .withColumn("expected", expected).withColumn("whole", whole).withColumn("rest", rest)
        .withColumn("u", (bits + 0.5) / F.lit(float(1 << 53)))
    )
    # v = q / (1 + q) for the order value q = odds(u) / odds(rest).
    high, low = F.col("u") * (1 - F.col("rest")), F.col("rest") * (1 - F.col("u"))
    drawable = (F.col("rest") > 1e-9) & (F.col("size") > 0) & (F.col("whole") < max_copies)
    ranked = ranked.withColumn("v", F.when(drawable, high / (high + low)))
    cell = F.least(F.floor(F.col("v") * (PARTS * PARTS)), F.lit(PARTS * PARTS - 1)).cast("long")
    ranked = materialize(
        ranked.select("doc_id", "source", "s", "size", "tie", "whole", "v", cell.alias("cell"), F.monotonically_increasing_id().alias("row")), "mix-ranked"
    ).withColumn("part", F.shiftright("cell", 10)).withColumn("sub", F.col("cell").bitwiseAND(PARTS - 1))

    drawn = ranked.filter("v is not null")
    held = ranked.groupBy("s").agg(
        F.sum(F.col("whole") * F.col("size")).alias("certain"),
        F.sum(F.when(F.col("v").isNotNull(), F.col("size"))).alias("drawable"),
    )
    need = materialize(
        sources.join(held, "s").select(
            "s", "source_size", "target", (F.col("target") - F.col("certain")).alias("need"), "drawable"
        ),
        "mix-needs",
    )
    first = _reached(drawn, need.select("s", "need"), "part")
    inner = drawn.join(per_source(first), "s").filter("part = cut_part")
    second = _reached(inner, need.join(first, "s").select("s", (F.col("need") - F.col("before_part")).alias("need")), "sub")
    cuts = materialize(
        need.join(first.join(second, "s"), "s", "left").withColumn(
            "cut_cell", F.col("cut_part") * PARTS + F.col("cut_sub")
        ),
        "mix-cuts",
    )
    placed = ranked.join(per_source(cuts), "s")
    is_end = F.coalesce(F.col("cell") == F.col("cut_cell"), F.lit(False))
    # Without a cut, what may be drawn falls short of the need (all of it is taken) or nothing is needed.
    inside = F.when(F.col("cut_cell").isNull(), F.col("drawable") <= F.col("need")).otherwise(
        F.col("cell") < F.col("cut_cell")
    )
    # Only the documents of one part of a part of each source are sorted.
    order = Window.partitionBy("s").orderBy("v", "doc_id", "tie", "row").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before_part") + F.col("before_sub") + F.sum("size").over(order)
    ends = placed.filter(is_end).withColumn("more", upto <= F.col("need"))
    others = placed.filter(~is_end).withColumn("more", F.coalesce(F.col("v").isNotNull() & inside, F.lit(False)))
    drawn = others.unionByName(ends).withColumn("copies", F.col("whole") + F.col("more").cast("int"))
    drawn = materialize(
        drawn.select("doc_id", "source", "s", "size", "source_size", "target", "copies", "tie", "v", "more", "row"), "mix-drawn"
    )
    gaps = drawn.groupBy("s").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    miss = F.abs(F.col("gap") - F.col("size"))
    fill = (
        drawn.filter("v is not null and not more").join(per_source(gaps), "s").filter(miss < F.col("gap"))
        .groupBy("s").agg(F.min(F.struct(miss.alias("miss"), "v", "doc_id", "tie", "row")).getField("row").alias("fill"))
    )
    copies = F.col("copies") + F.coalesce((F.col("row") == F.col("fill")).cast("int"), F.lit(0))
    return drawn.join(per_source(fill), "s", "left").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"), "tie",
    )


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_copies: int = 3,
                    tilt: float = 0.5, seed: int = 20) -> DataFrame:
    """The mix itself: the rows of `docs`, all columns, each as often as `mix_sources` takes it."""
    name = lambda tie: F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(tie))
    taken = mix_sources(docs, weights, max_copies, tilt, seed).withColumn(
        "name", F.concat_ws("|", name(F.col("tie")), "source")
    )
    # Repeated rows share a name: their copies are dealt evenly over them.
    totals = taken.groupBy("name").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).filter("copies > 0")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.concat_ws("|", name(F.xxhash64(F.col("text").cast("string"))), F.col("source").cast("string")).alias("name"),
    )
    joined = packed.join(totals, "name")
    single = joined.filter("rows = 1").select("row", F.col("copies").cast("int").alias("n"))
    nth = F.row_number().over(Window.partitionBy("name").orderBy("name"))
    several = joined.filter("rows > 1").withColumn("nth", nth).select(
        "row", F.expr("cast(copies div rows + if(nth <= copies % rows, 1, 0) as int)").alias("n")
    )
    return single.union(several).select("row", F.explode(F.array_repeat(F.lit(0), F.col("n")))).select("row.*")
