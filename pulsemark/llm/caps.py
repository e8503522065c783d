"""Near-duplicate vectors by spherical-cap filters.

Filters are directions of a structured product code: the space, turned at random, is cut into ``PARTS`` subspaces of
equal size, each with as many random unit directions, and every combination of one direction per subspace is a filter.
A vector belongs to every filter whose inner product with it exceeds a threshold. Both follow from the number of different
vectors of a label: so many directions, rounded up to a power of two, that a random vector which belongs to ``WANTED``
filters meets about ``LIST`` others in each. What a vector is compared with then stays about the same however many rows a
label has, and the chance that two vectors of cosine 0.98 share no filter stays far below a hundredth. List decoding finds just those:
directions of each subspace are tried from the best down, and a branch ends where the best of the remaining subspaces
cannot reach the threshold. A vector whose filters are fewer than ``LEAST`` lowers its own threshold until they are not,
so no vector is left without partners to meet.

Vectors of one label that share a filter meet there, in blocks of bounded size, and are compared by cosine in double
precision. A pair counts in the first filter both have. Equal vectors of a label are one class and never meet: a class
carries its number of rows. What a block yields are counts of links per class and links that connect the linked ones,
not all pairs, so a dense group costs no more rows than it has members.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without a label, link with
nothing; vectors of different lengths are never compared; a null id is never a component's id, and its row is kept if
its component has no id at all; rows that share an id are rows of their own, of one component.
"""

from __future__ import annotations

import functools
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .blocks import block_pairs
from .columns import stored
from .graph import components

PARTS = 2
LEAST_CODE = 8
WANTED = 14  # filters of a random vector
LIST = 32  # random vectors in a filter
LEAST = 10
COSINE = 0.98
SEED = 11


def code_size(rows: int) -> int:
    """Directions per subspace for a label of so many different vectors."""
    directions = (rows * WANTED / LIST) ** (1 / PARTS)
    return 1 << max(LEAST_CODE.bit_length() - 1, int(np.ceil(np.log2(max(directions, 1)))))


def threshold(directions: int) -> float:
    """In standard deviations of a random vector's inner product with a filter."""
    return NormalDist().inv_cdf(1 - WANTED / directions ** PARTS)


@functools.lru_cache(maxsize=32)
def code(size: int, directions: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and the directions of each subspace, for vectors of ``size`` components."""
    rng = np.random.default_rng([SEED, size, directions])
    turn, _ = np.linalg.qr(rng.standard_normal((size, size)))
    parts = [rng.standard_normal((directions, len(own))) for own in np.array_split(np.arange(size), PARTS)]
    return turn, [p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12) for p in parts]


def decode(units: np.ndarray, directions: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter) of every filter that each unit vector exceeds its threshold in, in order."""
    size = units.shape[1]
    turn, parts = code(size, directions)
    turned = units @ turn
    pieces = np.array_split(np.arange(size), PARTS)
    products = [turned[:, own] @ p.T / np.sqrt(PARTS) for own, p in zip(pieces, parts, strict=True)]
    best = [p.max(1) for p in products]
    limit = np.full(len(units), threshold(directions) / np.sqrt(size))
    todo = np.arange(len(units))
    vectors, filters = [], []
    while len(todo):
        row, name, total = todo, np.zeros(len(todo), np.int64), np.zeros(len(todo))
        for i, product in enumerate(products):
            rest = sum(best[i + 1:]) if i + 1 < PARTS else np.zeros(len(units))
            sums = total[:, None] + product[row]
            at, direction = np.nonzero(sums + rest[row][:, None] >= limit[row][:, None])
            row, name, total = row[at], name[at] * directions + direction, sums[at, direction]
        found = np.bincount(row, minlength=len(units))
        short = (found < min(LEAST, directions ** PARTS)) & (np.bincount(todo, minlength=len(units)) > 0)
        keep = ~short[row]
        vectors.append(row[keep])
        filters.append(name[keep])
        todo = np.flatnonzero(short)
        limit[todo] -= 0.25 / np.sqrt(size)
    vectors, filters = np.concatenate([*vectors, np.zeros(0, np.int64)]), np.concatenate([*filters, np.zeros(0, np.int64)])
    order = np.lexsort((filters, vectors))
    return vectors[order], filters[order]


def classes(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, node): node names the label and the vector's components; null where nothing can link."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        doubles, lambda x: x != 0)
    usable = F.col(label).isNotNull() & F.coalesce(sound, F.lit(False))
    value = F.transform(doubles, lambda x: x + F.lit(0.0))  # -0.0 as 0.0
    name = F.unhex(F.sha2(F.concat_ws(",", F.col(label).cast("string"), F.transform(value, lambda x: x.cast("string"))), 256))
    return vectors.select(F.col(key).alias("id"), F.col(label).cast("string").alias("label"), value.alias("vector"),
                          F.when(usable, name).alias("node"))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)  # neither under- nor overflows
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def filtered(found: DataFrame) -> DataFrame:
    """One row per class and filter of it: label, size, filter, node, rows, vector, filters (all of the class).

    Vectors travel as single precision where that loses nothing.
    """

    def run(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            codes = batch.column("code").to_numpy()
            for size, directions in np.unique(np.stack([sizes, codes]), axis=1).T.tolist():
                own_rows = np.flatnonzero((sizes == size) & (codes == directions))
                for at in range(0, len(own_rows), 512):
                    part = batch.take(pa.array(own_rows[at:at + 512]))
                    matrix = part.column("vector").flatten().to_numpy().reshape(-1, size).astype(float)
                    row, name = decode(_unit(matrix), directions)
                    with np.errstate(over="ignore"):
                        single = matrix.astype(np.float32)
                    exact = (single == matrix).all()
                    first = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int64)
                    own = tx.binaries(name.astype(np.int32), first)
                    at_row = pa.array(row)
                    yield pa.RecordBatch.from_arrays([
                        part.column("label").take(at_row), pa.array(np.full(len(row), size)), pa.array(name),
                        part.column("node").take(at_row), part.column("rows").take(at_row),
                        tx.fixed_binary(single if exact else matrix).take(at_row), own.take(at_row),
                    ], ["label", "size", "filter", "node", "rows", "vector", "filters"])

    return found.select("label", "node", "rows", "vector", "code").mapInArrow(
        run, "label string, size bigint, filter bigint, node binary, rows bigint, vector binary, filters binary")


def _first_shared(filters: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.array([np.intersect1d(filters[x], filters[y], assume_unique=True)[0] for x, y in zip(a, b, strict=True)])


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the links are enough to connect what all of them connect."""
    parent, chosen = list(range(n)), []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[x] = y
            chosen.append(i)
    return np.array(chosen, np.int64)


def _compare(cosine: float):
    def compare(rows: pa.Table, side: np.ndarray | None):
        n = rows.num_rows
        size = rows.column("size")[0].as_py()
        matrix = np.stack([np.frombuffer(v, np.float32 if len(v) == 4 * size else float) for v in rows.column("vector").to_pylist()]).astype(float)
        units, here = _unit(matrix), rows.column("filter")[0].as_py()
        filters = [np.frombuffer(f, np.int32) for f in rows.column("filters").to_pylist()]
        left = np.arange(n) if side is None else np.flatnonzero(side)
        right = np.arange(n) if side is None else np.flatnonzero(~side)
        number = rows.column("rows").to_numpy()
        links, spans = np.zeros(n, np.int64), []
        for at in range(0, len(left), 256):
            own = left[at:at + 256]
            # a little below, then exactly, as sums may differ in the last bit
            close = units[own] @ units[right].T >= cosine - 1e-9
            if side is None:
                close &= own[:, None] < right
            i, j = np.nonzero(close)
            a, b = own[i], right[j]
            if not len(a):
                continue
            exact = (matrix[a] * matrix[b]).sum(1) / (np.sqrt((matrix[a] ** 2).sum(1)) * np.sqrt((matrix[b] ** 2).sum(1)))
            # squares that leave the range of doubles: by unit vectors
            exact = np.where(np.isfinite(exact), exact, (units[a] * units[b]).sum(1))
            a, b = a[exact >= cosine], b[exact >= cosine]
            if len(a):
                counts = _first_shared(filters, a, b) == here
                a, b = a[counts], b[counts]
            if len(a):
                np.add.at(links, a, number[b])
                np.add.at(links, b, number[a])
                some = _spanning(a, b, n)
                spans.append((a[some], b[some]))
        if not spans:
            return None
        nodes = rows.column("node").combine_chunks() if isinstance(rows.column("node"), pa.ChunkedArray) else rows.column("node")
        a, b = np.concatenate([s[0] for s in spans]), np.concatenate([s[1] for s in spans])
        some = _spanning(a, b, n)
        linked = np.flatnonzero(links)
        none = pa.nulls(len(linked), pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([nodes.take(pa.array(linked)), nodes.take(pa.array(a[some]))]),
            pa.concat_arrays([none, nodes.take(pa.array(b[some]))]),
            pa.array(np.concatenate([links[linked], np.zeros(len(some), np.int64)])),
        ], ["a", "b", "links"])

    return compare


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept (key = component_id)."""
    rows = stored(classes(vectors, key, vector, label), "cap-rows")
    some = rows.where(F.col("node").isNotNull())
    found = stored(some.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("rows"), F.min("label").alias("label"),
                                            F.min("vector").alias("vector")), "cap-classes")
    sizes = found.groupBy("label").agg(F.count("*").alias("n"))
    directions = F.pow(F.lit(2.0), F.greatest(F.lit(LEAST_CODE.bit_length() - 1), F.ceil(F.log2(F.col("n") * (WANTED / LIST)) / PARTS)))
    coded = found.join(sizes.select("label", directions.cast("int").alias("code")), "label")
    spread = stored(filtered(coded.repartition("node")), "cap-filters")
    made = stored(block_pairs(spread, ["label", "size", "filter"], "node", _compare(cosine), "a binary, b binary, links bigint"),
                  "cap-links")
    counts = made.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    tree = components(made.where("b is not null"))
    rooted = found.select("node", "id", "rows").join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").join(counts, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    out = some.select("id", "node").join(named, "node").select("id", "n_links", "component_id").unionByName(
        rows.where(F.col("node").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
