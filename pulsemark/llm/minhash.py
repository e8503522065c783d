"""Near-duplicate texts: MinHash signatures, an inverted join on their coordinates, and exact confirmation.

A text is its set of word shingles. Texts of one set are one class, so copies never meet in a join. Every class posts
itself under (coordinate, value) tokens of its signature. Two classes that agree in at least ``matches`` of the
coordinates must share one of their ``coordinates - matches + 1`` rarest tokens, so only that prefix is posted, and the
lists of common tokens are skipped where rarer ones do. Rarity comes from a table of ``COUNTERS`` counters over all
classes; any order would be right, as long as it is one order for all. Pairs that agree often enough are confirmed on
their full sets.

Links are used for components only, so they are sought twice. First every class is compared with the likeliest leader of
its lists, the class whose tokens are the most common: in a group of near copies that is the text they were made from, so
a large group is tied together by as many links as it has members. Then all pairs of a list that lie in different
components are compared, in blocks of bounded size: by their signatures first, and those that agree on their full sets,
where the block is. Only links that join components leave it, so no link that matters is lost and none is written out
for each pair of a group.

Defined results: null texts and texts without words have no shingles and link with nothing; rows of a null id take part,
never as a component's id; rows that share an id each keep their own set. Other columns pass through ``deduplicated``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .blocks import block_pairs
from .columns import fresh, stored
from .graph import components

COORDINATES = 32
COUNTERS = 1 << 18
_SLICE = 1 << 18  # bytes of text at a time: hashes take many times their room
_FILTER_WORDS = 1 << 15  # 64-bit words of the filter that spares most texts a second look
_RNG = np.random.Generator(np.random.PCG64(20))
_A = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def least_matches(percent: int) -> int:
    """Coordinates that a pair of just this similarity agrees in, but for about one pair in 3,000."""
    j = percent / 100
    return max(1, math.floor(COORDINATES * j - 3.4 * math.sqrt(COORDINATES * j * (1 - j))))


def shingle_sets(part: tx.Slice, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, one after the other, and where each row's begin."""
    data = tx.LOWER[part.data]
    found = tx.words(data, part.offsets)
    made, first = tx.shingles(tx.word_hashes(data, found), found.first, k)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((made, row))
    made, row = made[order], row[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (row[1:] != row[:-1])
    made, row = made[new], row[new]
    return made, np.searchsorted(row, np.arange(len(first))).astype(np.int64)


def _per_row(ufunc, values: np.ndarray, first: np.ndarray, out: np.ndarray) -> np.ndarray:
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = ufunc.reduceat(values, first[some])
    return out


def set_keys(made: np.ndarray, first: np.ndarray) -> pa.Array:
    """Sixteen bytes that stand for a set; null for an empty one."""
    rows = len(first) - 1
    halves = np.zeros((rows, 2), np.uint64)
    for i, salt in enumerate((0x51ED270B, 0xA0761D64)):
        _per_row(np.add, tx.mix(made ^ np.uint64(salt)), first, halves[:, i])
    keys = tx.fixed_binary(halves)
    empty = pa.array(np.diff(first) == 0)
    return pc.if_else(empty, pa.scalar(None, pa.binary()), keys)


def signatures(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """One row per row of ``docs``: id, n (size of the set), node (its key), sig, seen (hash of the text)."""

    def signed(batches):
        for part in tx.slices(batches, limit=_SLICE):
            made, first = shingle_sets(part, k)
            sig = np.zeros((part.rows.num_rows, COORDINATES), np.uint32)
            for i in range(COORDINATES):
                _per_row(np.minimum, ((made * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32), first, sig[:, i])
            yield pa.RecordBatch.from_arrays(
                [part.rows.column("id"), pa.array(np.diff(first)), set_keys(made, first), tx.fixed_binary(sig),
                 part.rows.column("seen")], ["id", "n", "node", "sig", "seen"])

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("seen"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(signed, f"id {kind}, n bigint, node binary, sig binary, seen bigint")


def _sig(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint32).reshape(-1, COORDINATES)


def _tokens(sig: np.ndarray) -> np.ndarray:
    return tx.mix(sig.astype(np.uint64) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)))


def rarity(classes: DataFrame) -> np.ndarray:
    """How many classes hold a token of each of the ``COUNTERS`` counters."""

    def counted(batches):
        for batch in batches:
            slots = (_tokens(_sig(batch.column("sig"))) % np.uint64(COUNTERS)).ravel().astype(np.int64)
            at, n = np.unique(slots, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["slot", "n"])

    sums = classes.select("sig").mapInArrow(counted, "slot bigint, n bigint").groupBy("slot").agg(
        F.sum("n").alias("n")).toArrow()
    table = np.zeros(COUNTERS, np.int64)
    table[np.asarray(sums.column("slot"))] = np.asarray(sums.column("n"))
    return table


def _prefixes(sig: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` rarest tokens of each signature, in the one order that all signatures share."""
    tokens = _tokens(sig)
    order = np.lexsort((tokens, common[(tokens % np.uint64(COUNTERS)).astype(np.int64)]), axis=1)
    return np.take_along_axis(tokens, order[:, :length], axis=1)


def postings(classes: DataFrame, length: int, common: np.ndarray) -> DataFrame:
    """(token, node, fame) for the prefix of every class; fame grows with how common all its tokens are."""
    shared = classes.sparkSession.sparkContext.broadcast(common)

    def posted(batches):
        for batch in batches:
            sig = _sig(batch.column("sig"))
            chosen = _prefixes(sig, shared.value, length)
            fame = np.log(shared.value[(_tokens(sig) % np.uint64(COUNTERS)).astype(np.int64)] + 1.0).sum(1)
            nodes = batch.column("node").take(pa.array(np.repeat(np.arange(len(chosen)), length)))
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(chosen.ravel().copy())), nodes,
                                              pa.array(np.repeat(fame, length))], ["token", "node", "fame"])

    return classes.select("node", "sig").mapInArrow(posted, "token bigint, node binary, fame double")


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, text: str, k: int) -> DataFrame:
    """(node, shingles) for the given nodes.

    Texts that may hold one of the sets are told by a filter of fixed size; only their sets are made and joined.
    """
    wanted = classes.join(nodes, "node").select(F.pmod("seen", F.lit(_FILTER_WORDS * 64)).alias("bit"))
    marks = wanted.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    table = np.zeros(_FILTER_WORDS, np.int64)
    table[np.asarray(marks.column("word"), np.int64)] = np.asarray(marks.column("bits"), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def made(batches):
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            some = (shared.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)
            for part in tx.slices(iter([batch.filter(pa.array(some.astype(bool)))]), limit=_SLICE):
                values, first = shingle_sets(part, k)
                yield pa.RecordBatch.from_arrays([set_keys(values, first), tx.binaries(values, first)], ["node", "shingles"])

    texts = docs.select(F.col(text).alias("text"), F.pmod(F.xxhash64(text), F.lit(_FILTER_WORDS * 64)).alias("bit"))
    sets = texts.mapInArrow(made, "node binary, shingles binary").join(nodes, "node", "left_semi")
    return stored(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "minhash-sets")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = full_sets(nodes, classes, docs, text, k)

    def similar(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    return stored(both.select("a", "b", "left", "right").mapInArrow(similar, "a binary, b binary"), "minhash-links")


def _agreements(matches: int):
    def kept(batches):
        for batch in batches:
            same = (_sig(batch.column("sa")) == _sig(batch.column("sb"))).sum(1)
            some = pa.array(same >= matches)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same)], ["a", "b", "same"]).filter(some)

    return kept


class _Block:
    """The rows of one group: which pairs of different components agree, this list being the first they share."""

    def __init__(self, rows: pa.Table, side: np.ndarray | None, common: np.ndarray, length: int):
        self.sig, self.n = _sig(rows.column("sig")), rows.column("n").to_numpy()
        self.nodes = rows.column("node").combine_chunks() if isinstance(rows.column("node"), pa.ChunkedArray) else rows.column("node")
        roots = np.array(rows.column("root").to_pylist(), dtype=object)
        self.roots = np.unique(roots, return_inverse=True)[1]
        self.token = np.int64(rows.column("token")[0].as_py()).view(np.uint64)
        self.prefixes = _prefixes(self.sig, common, length)
        self.left = np.arange(len(self.n)) if side is None else np.flatnonzero(side)
        self.right = np.arange(len(self.n)) if side is None else np.flatnonzero(~side)
        self.within = side is None

    def candidates(self, matches: int, percent: int):
        """Pairs (x, y, agreements), some rows at a time."""
        for at in range(0, len(self.left), 64):
            own, n = self.left[at:at + 64], self.n
            fits = (self.roots[own][:, None] != self.roots[self.right]) & (
                np.minimum(n[own][:, None], n[self.right]) * 100 >= np.maximum(n[own][:, None], n[self.right]) * percent)
            if self.within:
                fits &= own[:, None] < self.right
            i, j = np.nonzero(fits)
            for lo in range(0, len(i), 1 << 14):
                x, y = own[i[lo:lo + (1 << 14)]], self.right[j[lo:lo + (1 << 14)]]
                same = (self.sig[x] == self.sig[y]).sum(1)
                x, y, same = x[same >= matches], y[same >= matches], same[same >= matches]
                if not len(x):
                    continue
                shared = (self.prefixes[x][:, :, None] == self.prefixes[y][:, None, :]).any(2).argmax(1)
                here = self.prefixes[x, shared] == self.token
                if here.any():
                    yield x[here], y[here], same[here]


def links(classes: DataFrame, docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes, enough of them to give every component."""
    matches = least_matches(percent)
    length = COORDINATES - matches + 1
    common = rarity(classes)
    posts = postings(classes, length, common)
    shared = posts.groupBy("token").agg(F.count("*").alias("_n"), F.max(F.struct("fame", "node"))["node"].alias("first")).where("_n > 1")
    lists = stored(posts.join(shared, "token").select("token", "node", "first"), "minhash-lists")
    facts = classes.select("node", "sig", "n")
    near = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    led = (
        lists.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
        .join(facts.select(F.col("node").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na")), "a")
        .join(facts.select(F.col("node").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb")), "b")
        .where(near).select("a", "b", "sa", "sb").mapInArrow(_agreements(matches), "a binary, b binary, same bigint")
        .groupBy("b").agg(F.max(F.struct("same", "a"))["a"].alias("a")).select("a", "b")
    )
    first = confirmed(stored(led, "minhash-led"), classes, docs, text, k, percent)
    tree = stored(components(first), "minhash-first")

    # lists whose members are not yet of one component: all pairs of different components
    rooted = lists.select("token", "node").join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = rooted.groupBy("token").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo != _hi")
    rest = rooted.join(split.select("token"), "token", "left_semi").join(facts, "node")
    order = docs.sparkSession.sparkContext.broadcast(common)

    def partnered(rows: pa.Table, side: np.ndarray | None):
        block, some = _Block(rows, side, order.value, length), np.zeros(rows.num_rows, bool)
        for x, y, _ in block.candidates(matches, percent):
            some[x] = True
            some[y] = True
        return pa.RecordBatch.from_arrays([rows.column(c).combine_chunks() if isinstance(rows.column(c), pa.ChunkedArray)
                                           else rows.column(c) for c in ("token", "node", "root")],
                                          ["token", "node", "root"]).filter(pa.array(some))

    open_ = stored(block_pairs(rest, ["token"], "node", partnered, "token bigint, node binary, root binary").distinct(),
                   "minhash-open")
    sets = full_sets(open_.select("node").distinct(), classes, docs, text, k)

    def joining(rows: pa.Table, side: np.ndarray | None):
        block = _Block(rows, side, order.value, length)
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles")]
        parent = list(range(int(block.roots.max()) + 1))

        def top(r):
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        a, b = [], []
        for x, y, same in block.candidates(matches, percent):
            for own in np.unique(x):
                partners = y[x == own][np.argsort(-same[x == own], kind="stable")]
                mine = sets[own]
                for at in range(0, len(partners), 64):
                    some = [p for p in partners[at:at + 64].tolist() if top(block.roots[p]) != top(block.roots[own])]
                    if not some:
                        continue
                    sizes = np.array([len(sets[p]) for p in some])
                    flat = np.concatenate([sets[p] for p in some])
                    hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
                    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
                    for p in np.array(some)[100 * both >= percent * (len(mine) + sizes - both)].tolist():
                        r, q = top(block.roots[own]), top(block.roots[p])
                        if r != q:
                            parent[r] = q
                            a.append(own)
                            b.append(p)
        if not a:
            return None
        return pa.RecordBatch.from_arrays([block.nodes.take(pa.array(a)), block.nodes.take(pa.array(b))], ["a", "b"])

    full = open_.join(facts, "node").join(sets, "node")
    more = stored(block_pairs(full, ["token"], "node", joining, "a binary, b binary", block=256), "minhash-links")
    return first.unionByName(more)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (smallest id reachable), kept (key = component_id)."""
    rows = stored(signatures(docs, key, text, k), "minhash-signatures")
    some = rows.where(F.col("node").isNotNull())
    classes = stored(some.groupBy("node").agg(F.min("id").alias("id"), F.min("sig").alias("sig"), F.min("n").alias("n"),
                                              F.min("seen").alias("seen")), "minhash-classes")
    tree = components(links(classes, docs, text, k, percent))
    rooted = classes.select("node", "id").join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    out = some.select("id", "n", "node").join(named, "node", "left").select("id", "n", "component_id").unionByName(
        rows.where(F.col("node").isNull()).select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: of the smallest id, a missing one last.

    Rows are told apart by id and text, so texts that share an id, or have none, are judged each on its own. Of rows that
    agree in both one stays, whatever else they hold. Rows without words are in no group and all stay.
    """
    own, words = fresh(docs, "_row"), fresh(docs, "_words")
    keyed = docs.withColumn(own, F.struct(F.col(key).isNull().alias("missing"), F.col(key).alias("id"), F.xxhash64(key, text).alias("a"),
                                          F.xxhash64(F.lit(5), text, key).alias("b")))
    found = near_duplicates(keyed, own, text, k, percent).where("kept").select(own, (F.col("n_shingles") > 0).alias(words)).distinct()
    stays = stored(keyed.join(found, own), "minhash-kept")
    return stays.where(words).dropDuplicates([own]).unionByName(stays.where(~F.col(words))).drop(own, words)
