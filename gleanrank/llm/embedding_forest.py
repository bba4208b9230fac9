"""Near-duplicate vectors by a forest of random-projection trees (method 5).

Each tree splits all vectors by the sign of (projection on a random direction - threshold), again and again,
until its leaves are small. Vectors within a margin of a threshold go to both sides (spill), so that a close pair is
rarely parted; several trees make it rarer still. Within a leaf all pairs are compared in double precision.

Splits are recursive in stages. A stage fits, for each node that is still too large, a small tree of up to
`2 ** STAGE_DEPTH` leaves on a bounded sample of the node's vectors, and sends all its vectors down that tree. With
more vectors more stages follow; nothing but one node's small tree is ever held at once, and none is fitted on
more than `sample` vectors. A node whose vectors a stage cannot part (near copies of each other) stays as it is;
such leaves are compared in blocks of pairs of `BLOCK` vectors, each block pair a task of its own.

Equal vectors are one class before anything else; only its first vector goes down the trees, with the number of its
copies. Leaves are chosen in single precision, links in double: cosines so near the threshold that rounding may decide
are taken again from the vectors as given, and rounded to double once.

Pairs are not written out. A leaf counts a linked pair only if it is the first of the leaves that the two share,
which the list of leaves that each vector carries tells, so the counts add up to exact numbers of links; and it
gives each vector's link to the least vector it links with in the leaf, enough to join components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanrank.llm.graph import components
from gleanrank.llm.words import bound_batches, mix
from gleanrank.session import Scratch, drop_scratch, materialize

LEAF, BLOCK, STAGE_DEPTH = 400, 2000, 10
# Far more than the rounding error of a product of two unit vectors.
SLACK = 1e-9
MOST_STAGES = 8


def usable(vectors: list) -> np.ndarray:
    """Which vectors can link: not null, not zero, and all components finite numbers."""
    return np.array([
        v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) for v in vectors
    ], bool)


def scaled_rows(vectors: list) -> np.ndarray:
    """The vectors times powers of two, so that squares stay in range; nothing is rounded."""
    table = np.array(vectors, np.float64)
    return np.ldexp(table, -np.frexp(np.abs(table).max(axis=1, keepdims=True))[1]) + 0.0


def cosines(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows of `table`, made in extended precision and rounded to double at the end."""
    out, step = np.empty(len(a)), max(1, 1_000_000 // table.shape[1])
    for at in range(0, len(a), step):
        x, y = (table[rows[at : at + step]].astype(np.longdouble) for rows in (a, b))
        out[at : at + step] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    return out


def unit_rows(vectors: list | np.ndarray) -> np.ndarray:
    table = np.array(vectors, np.float64)
    table /= np.abs(table).max(axis=1, keepdims=True)
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def _direction(node: int, at: int, width: int) -> np.ndarray:
    """The random direction of a split: it follows from the node and the place in its tree."""
    u = np.random.default_rng([node & 0x7FFFFFFFFFFFFFFF, at]).standard_normal(width)
    return u / np.linalg.norm(u)


def _fit(node: int, table: np.ndarray, rows: int, margin: float) -> list[tuple[int, float]]:
    """(place, threshold) of the splits of a small tree; children of place p are 2p + 1 and 2p + 2."""
    splits, scale = [], rows / max(1, len(table))
    waiting = [(0, 0, np.arange(len(table)))]
    while waiting:
        place, depth, members = waiting.pop()
        if len(members) * scale <= LEAF or depth == STAGE_DEPTH or len(members) < 8:
            continue
        projected = table[members] @ _direction(node, place, table.shape[1])
        cut = float(np.median(projected))
        left, right = members[projected <= cut + margin], members[projected > cut - margin]
        if max(len(left), len(right)) > 0.9 * len(members):
            # Near copies of each other: a split would only make two nodes of the same size.
            continue
        splits.append((place, cut))
        waiting += [(2 * place + 1, depth + 1, left), (2 * place + 2, depth + 1, right)]
    return splits


def _descend(node: int, table: np.ndarray, splits: dict[int, float], margin: float) -> list[tuple[np.ndarray, int]]:
    """(rows, place) of the leaves that the rows of `table` fall into; a row within a margin is in both."""
    out, waiting = [], [(0, np.arange(len(table)))]
    while waiting:
        place, members = waiting.pop()
        if place not in splits:
            out.append((members, place))
            continue
        projected = table[members] @ _direction(node, place, table.shape[1])
        waiting.append((2 * place + 1, members[projected <= splits[place] + margin]))
        waiting.append((2 * place + 2, members[projected > splits[place] - margin]))
    return [(m, p) for m, p in out if len(m)]


def _matrix(column, kind: str = "<f8") -> np.ndarray:
    """The vectors of a column of little-endian doubles, or of floats of another kind."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        vectors = batch.column(1).to_pylist()
        ok = np.flatnonzero(usable(vectors))
        by_width: dict[int, list[int]] = {}
        for i in ok:
            by_width.setdefault(len(vectors[i]), []).append(int(i))
        for width, rows in sorted(by_width.items()):
            scaled = scaled_rows([vectors[i] for i in rows])
            unit, scaled = (pa.array([v.astype("<f8").tobytes() for v in table], pa.binary()) for table in (unit_rows(scaled), scaled))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array([width] * len(rows), pa.int32()), unit, scaled],
                ["id", "width", "unit", "scaled"],
            )


def _with_short(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the unit vector in single precision, enough to choose leaves by, to (id, width, copies, unit, scaled)."""
    for batch in source:
        short = [np.frombuffer(u, "<f8").astype("<f4").tobytes() for u in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(short, pa.binary())], [*batch.schema.names, "short"])


def _margin(reach: float, table: np.ndarray) -> float:
    """Margin of the splits of a node, whose vectors are all of one length."""
    return reach / float(np.sqrt(table.shape[1]))


def _fits(reach: float):
    def run(table: pa.Table) -> pa.Table:
        node, rows = table.column("node")[0].as_py(), table.column("rows")[0].as_py()
        # Least id order makes the sample independent of how rows arrive.
        table = table.sort_by("id")
        vectors = _matrix(table.column("short"), "<f4")
        splits = _fit(node, vectors, rows, _margin(reach, vectors))
        return pa.table({
            "node": pa.array([node], pa.int64()), "places": pa.array([[p for p, _ in splits]], pa.list_(pa.int64())),
            "cuts": pa.array([[c for _, c in splits]], pa.list_(pa.float64())),
        })
    return run


def _descends(reach: float):
    """Vectors of one slice of a node, and the node's splits -> (id, new node)."""
    def run(vectors: pa.Table, fitted: pa.Table) -> pa.Table:
        out_ids, out_nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if len(vectors) and len(fitted):
            node, ids = fitted.column("node")[0].as_py(), vectors.column("id").to_numpy()
            splits = dict(zip(fitted.column("places")[0].as_py(), fitted.column("cuts")[0].as_py()))
            table = _matrix(vectors.column("short"), "<f4")
            for members, place in _descend(node, table, splits, _margin(reach, table)):
                new = mix(np.array([node], np.int64).view(np.uint64) + mix(np.uint64([place + 1])))
                out_ids.append(ids[members])
                out_nodes.append(np.full(len(members), new.view(np.int64)[0]))
        return pa.table({"id": np.concatenate(out_ids), "node": np.concatenate(out_nodes)})
    return run


def _earlier(leaves, leaf: int) -> np.ndarray:
    """A row of bits for each list of leaves: one for each leaf below `leaf` that more than one of them holds."""
    held = leaves.combine_chunks()
    value, row = held.flatten().to_numpy(), np.repeat(np.arange(len(held)), held.value_lengths().to_numpy())
    kept = value < leaf
    _, place, many = np.unique(value[kept], return_inverse=True, return_counts=True)
    row, number = row[kept], np.cumsum(many > 1) - 1
    row, bit = row[many[place] > 1], number[place[many[place] > 1]]
    bits = np.zeros((len(held), 1 + int((many > 1).sum()) // 64), np.uint64)
    np.bitwise_or.at(bits, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    return bits


def _leaf_links(threshold: float):
    """Links within one leaf, or between two blocks of one: (id, copies linked that count here, least linked id)."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, scaled = table.column("id").to_numpy(), _matrix(table.column("scaled"))
        units = unit_rows(scaled)
        leaf, copies = table.column("node")[0].as_py(), table.column("copies").to_numpy()
        first, second = (np.array(table.column(c).to_pylist(), bool) for c in ("first", "second"))
        count, least, bits = np.zeros(len(ids), np.int64), ids.copy(), None
        one_block = first & second
        for start in range(0, len(ids), 500):
            rows = np.arange(start, min(start + 500, len(ids)))
            cosine = units[rows] @ units.T
            # Each pair once: the first of the rows has to be of the first block, the other of the second.
            pair = (first[rows][:, None] & second[None, :] & ~one_block[rows][:, None]) | (
                one_block[rows][:, None] & one_block[None, :] & (rows[:, None] < np.arange(len(ids))[None, :])
            )
            i, j = np.nonzero((cosine >= threshold - SLACK) & pair)
            sure, i = cosine[i, j] >= threshold + SLACK, rows[i]
            sure[~sure] = cosines(scaled, i[~sure], j[~sure]) >= threshold
            i, j = i[sure], j[sure]
            for part in range(0, len(i), 200_000):
                a, b = i[part : part + 200_000], j[part : part + 200_000]
                np.minimum.at(least, a, ids[b])
                np.minimum.at(least, b, ids[a])
                # The pair counts in the least leaf that both have.
                bits = _earlier(table.column("leaves"), leaf) if bits is None else bits
                earlier = (bits[a] & bits[b]).any(axis=1)
                np.add.at(count, a[~earlier], copies[b[~earlier]])
                np.add.at(count, b[~earlier], copies[a[~earlier]])
        keep = (count > 0) | (least < ids)
        return pa.table({"id": ids[keep], "links": count[keep], "least": least[keep]})
    return run


def _leaves(units: DataFrame, trees: int, sample: int, reach: float) -> DataFrame:
    """(id, node): the leaves of every vector in every tree, `units` being (id, width, short)."""
    spark = units.sparkSession
    root = F.explode(F.array(*[F.xxhash64(F.lit(f"tree {t}"), F.col("width")) for t in range(trees)]))
    scope, done = Scratch(spark, "forest-stage"), []
    nodes = scope.keep(units.select("id", root.alias("node")), "nodes")
    for _ in range(MOST_STAGES):
        sizes = scope.keep(nodes.groupBy("node").agg(F.count("*").alias("rows")), "sizes")
        large = sizes.filter(F.col("rows") > LEAF)
        if large.isEmpty():
            break
        # About `sample` vectors of each node, by hash; twice as many are never reached but by chance.
        drawn = nodes.join(large, "node").filter(
            F.pmod(F.xxhash64("node", "id"), F.lit(1 << 40)) < F.least(F.lit(1.0), sample / F.col("rows")) * (1 << 40)
        )
        splits = drawn.join(units.select("id", "short"), "id").groupBy("node").applyInArrow(
            _fits(reach), "node long, places array<long>, cuts array<double>"
        ).filter(F.size("places") > 0)
        # A node's vectors go down its splits in slices of about `sample`: the splits travel once for each slice.
        fitted = scope.keep(
            splits.join(large, "node").withColumn("slices", F.ceil(F.col("rows") / sample).cast("int")), "splits"
        )
        done.append(materialize(nodes.join(fitted.select("node"), "node", "left_anti").select("id", "node"), "forest-leaves"))
        sliced = nodes.join(fitted.select("node", "slices"), "node").select(
            "id", "node", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice")
        )
        vectors = sliced.join(units.select("id", "short"), "id").groupBy("node", "slice")
        each = fitted.select("node", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "places", "cuts")
        down = vectors.cogroup(each.groupBy("node", "slice")).applyInArrow(_descends(reach), "id long, node long")
        following = Scratch(spark, "forest-stage")
        nodes = following.keep(down.distinct(), "nodes")
        drop_scratch(spark, scope.path)
        scope = following
        if nodes.isEmpty():
            break
    done.append(materialize(nodes, "forest-leaves"))
    drop_scratch(spark, scope.path)
    every = done[0]
    for part in done[1:]:
        every = every.union(part)
    return every


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                 trees: int = 6, sample: int = 20_000, spill: float = 0.3) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors`.

    Vectors link if their cosine is at least `threshold`. Two unit vectors of that cosine lie at a distance of
    sqrt(2 - 2 threshold); the margin of a split is `spill` times the root mean square of its projection.

    Defined cases: vectors that are null, zero, or hold a null or a component that is not finite link with
    nothing; so do vectors of different lengths with each other. Equal vectors under different ids link. A row
    with a null id links with nothing and has a null component. Rows that share an id are one vector, the
    first usable one by its bytes counts, and the result has a row for each. Other columns are ignored.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    source = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    with Scratch(spark, "forest") as scope:
        units = scope.keep(
            source.filter("id is not null and v is not null")
            .mapInArrow(_unit_rows, "id long, width int, unit binary, scaled binary")
            .groupBy("id").agg(F.min(F.struct("width", "unit", "scaled")).alias("u")).select("id", "u.*"),
            "units",
        )
        # Equal vectors are one class from here on, its least id stands for it and `copies` counts it.
        classes = scope.keep(
            units.groupBy("width", "unit").agg(F.count("*").alias("copies"), F.min(F.struct("id", "scaled")).alias("u"))
            .select("u.id", "width", "copies", "unit", "u.scaled")
            .mapInArrow(_with_short, "id long, width int, copies long, unit binary, scaled binary, short binary"), "classes",
        )
        several = classes.filter("copies > 1").select("width", "unit", F.col("id").alias("class"))
        members = materialize(units.join(several, ["width", "unit"]).select("id", "class"), "vector-classes")
        reach = spill * float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        leaves = scope.keep(_leaves(classes, trees, sample, reach).distinct(), "leaves")
        held = leaves.groupBy("id").agg(F.array_sort(F.collect_set("node")).alias("leaves"))  # a few leaves of each tree
        vectors_held = scope.keep(classes.select("id", "copies", "scaled").join(held, "id"), "vectors")
        blocks = leaves.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        dealt = leaves.join(blocks, "node").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        )
        lower, upper = F.least("own", "other"), F.greatest("own", "other")
        dealt = dealt.select(
            "id", "node", lower.alias("lower"), upper.alias("upper"), (F.col("own") == lower).alias("first"),
            (F.col("own") == upper).alias("second"),
        ).join(vectors_held, "id")
        found = scope.keep(
            dealt.groupBy("node", "lower", "upper").applyInArrow(_leaf_links(threshold), "id long, links long, least long"),
            "links",
        )
        counts = found.groupBy("id").agg(F.sum("links").alias("links"))
        comps = components(found.filter("least < id").select("id", "least"))
        per_class = materialize(
            classes.select("id", "copies").join(counts, "id", "left").join(comps.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component")
            .filter("n_links > 0"),
            "vector-links",
        )
    of_class = source.select("id").join(members, "id", "left").select("id", F.coalesce("class", "id").alias("class"))
    component = F.coalesce("component", "class")
    return of_class.join(per_class, "class", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
