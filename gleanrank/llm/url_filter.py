"""URL filter: a blocked Bloom filter in front of an exact join (method 1). Only DataFrame functions.

Two kinds of entries are held in one filter. Rules are (host, path, verdict) and fit a host with all its
subdomains and every path that starts with theirs; listed URLs are compared in canonical form. Each page tests one
candidate for each shape of a rule (number of host labels, length of the path) and its own canonical URL. Most
pages pass no test and are settled in their row, without a shuffle. The others meet the entries in an exact
join, so a false positive of the filter costs a lookup and changes nothing.

The filter is an array of 64-bit words, eight to a block. A key's hash picks the block and one bit in each of its
words, so a test touches one block. It has about `bits_per_key` bits for each key, up to `max_blocks` blocks: with
more keys than that holds, more candidates reach the exact join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from gleanrank.session import materialize

WORDS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that only say where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for a null and without ://."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty for a null and without ://."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without a leading www., path without a final slash, and the query without tracking parameters.

    Empty for a null and without ://. Scheme and fragment do not count; parameters keep their order.
    """
    host, path = F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(TRACKING) & (p != "")), "&")
    told = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(F.instr(url, "://") > 0, told).otherwise("")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask_bit(key: Column, word: int) -> Column:
    """Place, 0 to 63, of the key's bit in a word of its block."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("bit"), key), 6 * word).bitwiseAND(63).cast("int")


def bloom_words(keys: DataFrame, blocks: int) -> DataFrame:
    """One row, one column: the array of the filter's words, WORDS x `blocks` of them, for the column `key`."""
    spark = keys.sparkSession
    bits = F.array(*[
        F.struct((_block(F.col("key"), blocks) * WORDS + w).alias("place"), _mask_bit(F.col("key"), w).alias("bit"))
        for w in range(WORDS)
    ])
    words = (
        keys.select(F.explode(bits).alias("b"))
        .groupBy(F.col("b.place").alias("place")).agg(F.bit_or(F.expr("shiftleft(1L, b.bit)")).alias("word"))
    )
    places = spark.range(WORDS * blocks).select(F.col("id").cast("int").alias("place"))
    full = places.join(words, "place", "left").select("place", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    # As many rows as the filter has words come together here, which max_blocks bounds.
    return full.agg(F.array_sort(F.collect_list(F.struct("place", "word"))).getField("word").alias("words"))


def _may_hold(words: Column, key: Column, blocks: int) -> Column:
    first = _block(key, blocks) * WORDS
    tests = [
        F.call_function("shiftrightunsigned", F.element_at(words, first + (w + 1)), _mask_bit(key, w)).bitwiseAND(1) == 1
        for w in range(WORDS)
    ]
    every = tests[0]
    for test in tests[1:]:
        every = every & test
    return every


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url", bits_per_key: int = 16,
                max_blocks: int = 1 << 17, max_broadcast_rows: int = 100_000) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) for every row of `pages`.

    `rules`: (host, path, verdict), distinct; `listed`: (url), those blocked where no rule fits. The longest rule
    wins, of equally long ones the one with the longer host. Where none fits, `rule` is null and the
    verdict is block for a listed URL and allow for any other.

    Defined cases: a null url, or one without ://, has an empty host and path, fits no rule and is never
    listed; empty rules and an empty list allow everything; rows that share a page_id, and rows with a
    null one, are judged each for itself; null and repeated listed URLs count once or not at all. Other
    columns are ignored. Rules are sent to every task if they are at most `max_broadcast_rows`.
    """
    known = rules.select("host", "path", "verdict").filter("host is not null and path is not null").dropDuplicates(["host", "path"])
    rule = F.concat("host", "path")
    entries = materialize(
        known.select(
            F.concat(F.lit("r "), rule).alias("key"), rule.alias("rule"), "verdict", F.length("host").alias("host_length"),
            F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"),
        ),
        "url-rules",
    )
    list_keys = materialize(
        listed.select(canonical_url(F.col("url").cast("string")).alias("url")).filter("url <> ''").distinct()
        .select(F.concat(F.lit("u "), "url").alias("key")),
        "url-list",
    )
    n_rules, n_listed = entries.count(), list_keys.count()
    wanted = max(1, (n_rules + n_listed) * bits_per_key // (64 * WORDS))
    blocks = min(max_blocks, 1 << math.ceil(math.log2(wanted)))
    words = materialize(bloom_words(entries.select("key").union(list_keys), blocks), "url-filter").scalar()
    # Different shapes: label counts times path lengths at most, whatever the number of rules.
    shapes = [tuple(r) for r in entries.select("labels", "chars").distinct().orderBy("labels", "chars").collect()]

    link = F.col(url).cast("string")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(link).alias("host"), path_of(link).alias("path"),
        canonical_url(link).alias("canonical"),
    )
    dots = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit("")))
    candidates = [
        (
            (F.col("host") != "") & (dots + 1 >= labels) & (F.length("path") >= chars),
            F.concat(F.lit("r "), F.substring_index("host", ".", -labels), F.substring("path", 1, chars)),
        )
        for labels, chars in shapes
    ] + [(F.col("canonical") != "", F.concat(F.lit("u "), "canonical"))]
    hits = F.array_compact(F.array(*[
        F.when(fits & _may_hold(words, key, blocks), key) for fits, key in candidates
    ]))
    tested = base.withColumn("hits", hits).drop("canonical")

    settled = tested.filter(F.size("hits") == 0).select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"),
        F.lit(False).alias("listed"),
    )
    possible = tested.filter(F.size("hits") > 0).withColumn("row", F.monotonically_increasing_id())
    hits = possible.select("row", "page_id", "host", "path", F.explode("hits").alias("key"))
    exact = entries.select("key", "rule", F.col("verdict").alias("told"), "host_length")
    if n_rules <= max_broadcast_rows:
        exact = F.broadcast(exact)
    of_list = list_keys.withColumn("listed", F.lit(True))
    joined = hits.join(exact, "key", "left").join(of_list, "key", "left")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(
        F.length("rule").alias("length"), "host_length", "rule", "told"
    ))).alias("best")
    judged = joined.groupBy("row", "page_id", "host", "path").agg(
        best, F.coalesce(F.max("listed"), F.lit(False)).alias("listed")
    )
    verdict = F.when(F.col("best").isNotNull(), F.col("best.told")).otherwise(
        F.when(F.col("listed"), "block").otherwise("allow")
    )
    return settled.union(
        judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"), "listed")
    )
