"""Benchmark passages in documents: SimHash fingerprints of item-sized windows, found by multi-index Hamming search.

Words are runs of letters and digits, lower-cased; a shingle is five words (a shorter item is one shingle) and weighs as
often as it occurs. For every item length, each window of that many words is a candidate. Windows that hold too few
shingles of any item to be similar are passed over: a table of bits, as large for any number of items, tells which
shingles may belong to one, and similarity S needs S of them at the least. The rest get a fingerprint of 64 bits, and
every item within ``RADIUS`` bits is found: fingerprints are cut into ``PIECES`` of 8 bits, of which one must agree but
for one bit if ``RADIUS`` bits differ in all, so an item is indexed under every piece and its one-bit neighbours. Pairs
near ``SIMILARITY`` may differ in more bits, so a window is also paired with every item of its size of which it holds one
of the rarest shingles: so many that a similar window cannot lack them all. Found pairs are verified by their weighted
Jaccard similarity, and the best window of each document and item is kept; none that is similar enough is missed.

A document of fewer words than an item is one window as a whole: a copy of the item that lost some words. As it may have
a fifth fewer shingles, fingerprints do not decide; the shingles it shares with each longer item are counted instead.

Items go into the index ``SLICE`` at a time, each slice in its own pass over the documents, so what is broadcast is
bounded however many there are. Documents are read where they lie; only found pairs are shuffled.

Defined results: null and empty texts and items match nothing; equal items are matched each; ids may be null or repeated
(a repeated document yields its pairs once); items of one length and best windows of equal similarity go to the first
word; other columns pass through ``clean``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .columns import fresh, stored

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
PIECES = 8
SLICE = 20_000
_BITS = 22  # of the table of shingles
_VOTES = (np.arange(256)[:, None] >> np.arange(8)) & 1


class Index(NamedTuple):
    ids: list
    words: np.ndarray  # number of words of each item
    prints: np.ndarray  # fingerprints
    first: np.ndarray  # where each item's shingles begin
    shingles: np.ndarray  # sorted distinct shingles of each item
    weights: np.ndarray  # how often each occurs
    table: np.ndarray  # bits of the shingles of all items
    heads: np.ndarray  # per piece and value where its items begin
    members: np.ndarray
    posted: np.ndarray  # the shingles of all items in order,
    owner: np.ndarray  # the item of each,
    times: np.ndarray  # and how often it occurs there
    rare: dict[int, tuple[np.ndarray, np.ndarray]]  # by size in words: the rarest shingles of its items in order, and the item of each


def fingerprint(shingles: np.ndarray) -> int:
    """Bit by bit the majority of the shingles' hashes, each as often as it occurs."""
    return int(windows_prints(shingles, np.array([0]), len(shingles))[0])


def windows_prints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of shingles[start:start + size]."""
    out = np.zeros(len(starts), np.uint64)
    data = tx.mix(shingles ^ np.uint64(0x5851F42D)).view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        votes = np.zeros((len(shingles) + 1, 8), np.int32)
        np.cumsum(_VOTES[data[:, byte]], axis=0, out=votes[1:])
        ahead = 2 * (votes[starts + size] - votes[starts]) > size
        out |= (ahead @ (1 << np.arange(8))).astype(np.uint64) << np.uint64(8 * byte)
    return out


def _pieces(prints: np.ndarray) -> np.ndarray:
    return prints.view(np.uint8).reshape(-1, PIECES)


def build(ids: list, texts: list[str | None]) -> Index:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    kept, words, prints, sets, weights = [], [], [], [], []
    at = 0
    for part in tx.slices(iter([batch])):
        data = tx.LOWER[part.data]
        found = tx.words(data, part.offsets, tx.ALNUM)
        made, first = tx.shingles(tx.word_hashes(data, found), found.first, SHINGLE)
        for i in range(part.rows.num_rows):
            own = made[first[i]:first[i + 1]]
            if len(own):
                distinct, times = np.unique(own, return_counts=True)
                kept.append(ids[at + i])
                words.append(int(found.first[i + 1] - found.first[i]))
                prints.append(fingerprint(own))
                sets.append(distinct)
                weights.append(times)
        at += part.rows.num_rows
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    table = np.zeros(1 << _BITS, bool)
    table[(flat >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    prints = np.array(prints, np.uint64)
    slots, items = [], []
    for piece in range(PIECES):
        values = _pieces(prints)[:, piece].astype(np.int64)
        for change in (0, *(1 << np.arange(8))):
            slots.append(piece << 8 | (values ^ int(change)))
            items.append(np.arange(len(prints)))
    slots, items = np.concatenate([*slots, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*items, np.zeros(0, np.int64)])
    order = np.argsort(slots, kind="stable")
    heads = np.searchsorted(slots[order], np.arange((PIECES << 8) + 1))
    sizes = [len(s) for s in sets]
    weights = np.concatenate([*weights, np.zeros(0, np.int64)]).astype(np.int64)
    by = np.argsort(flat, kind="stable")
    held = np.searchsorted(flat[by], flat, "right") - np.searchsorted(flat[by], flat)  # items that hold it
    ends = np.cumsum(sizes)
    picked: dict[int, list] = {}
    for i, end in enumerate(ends.tolist()):
        own = slice(end - sizes[i], end)
        rarest = np.lexsort((flat[own], held[own]))
        # of n shingles, windows of n more share 2 n S / (1 + S) at the least
        n = int(weights[own].sum())
        missing = n - int(np.ceil(2 * n * SIMILARITY / (1 + SIMILARITY) - 1e-9))
        few = rarest[:int(np.searchsorted(np.cumsum(weights[own][rarest]), missing + 1)) + 1]
        picked.setdefault(words[i], []).append((flat[own][few], np.full(len(few), i)))
    rare = {}
    for size, parts in picked.items():
        shingles, items_of = (np.concatenate(x) for x in zip(*parts, strict=True))
        by_shingle = np.argsort(shingles, kind="stable")
        rare[size] = shingles[by_shingle], items_of[by_shingle]
    return Index(kept, np.array(words, np.int64), prints, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), flat, weights, table,
                 heads, items[order].astype(np.int64), flat[by], np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[by],
                 weights[by].astype(np.int32), rare)


def near_items(index: Index, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of every item of ``size`` words within the radius, each once."""
    slots = _pieces(prints).astype(np.int64) | np.arange(PIECES) << 8
    n = index.heads[slots + 1] - index.heads[slots]
    window = np.repeat(np.repeat(np.arange(len(prints)), PIECES), n.ravel())
    starts = np.repeat(index.heads[slots].ravel(), n.ravel())
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(n.ravel()) - n.ravel(), n.ravel())
    item = index.members[starts + nth]
    fits = index.words[item] == size
    window, item = window[fits], item[fits]
    fits = np.bitwise_count(prints[window] ^ index.prints[item]) <= RADIUS
    pairs = np.unique(window[fits] * max(len(index.ids), 1) + item[fits])
    return pairs // max(len(index.ids), 1), pairs % max(len(index.ids), 1)


def sharing_items(index: Index, made: np.ndarray, place: np.ndarray, span: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of every item of ``size`` words of whose rarest shingles made[place:place + span] holds one, each once."""
    shingles, items = index.rare.get(size, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    low, high = (np.searchsorted(shingles, made, side) for side in ("left", "right"))
    spots = np.flatnonzero(high > low)
    n = (high - low)[spots]
    spot = np.repeat(spots, n)
    item = items[np.arange(n.sum()) + np.repeat(low[spots] - np.cumsum(n) + n, n)]
    low, high = np.searchsorted(place, spot - span + 1), np.searchsorted(place, spot, "right")
    n = high - low
    window = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
    pairs = np.unique(window * max(len(index.ids), 1) + np.repeat(item, n))
    return pairs // max(len(index.ids), 1), pairs % max(len(index.ids), 1)


def similarity(index: Index, item: int, window: np.ndarray) -> float:
    """Weighted Jaccard: the smaller weight of each shingle against the larger."""
    own, times = np.unique(window, return_counts=True)
    theirs = slice(index.first[item], index.first[item + 1])
    _, i, j = np.intersect1d(own, index.shingles[theirs], assume_unique=True, return_indices=True)
    both = int(np.minimum(times[i], index.weights[theirs][j]).sum())
    return both / (int(times.sum()) + int(index.weights[theirs].sum()) - both)


def longer_items(index: Index, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, similarity) of every item of more shingles than the document ``made`` that is similar enough to all of it."""
    own, times = np.unique(made, return_counts=True)
    low, high = (np.searchsorted(index.posted, own, side) for side in ("left", "right"))
    n = high - low
    at = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
    shared = np.minimum(np.repeat(times, n), index.times[at])
    item, place = np.unique(index.owner[at], return_inverse=True)
    both = np.bincount(place, shared, len(item))
    theirs = index.words[item] - SHINGLE + 1
    s = both / (len(made) + theirs - both)
    fits = (theirs > len(made)) & (s >= SIMILARITY)
    return item[fits], s[fits]


def matches(index: Index, part: tx.Slice) -> list[tuple[int, int, int, int, float]]:
    """(row, item, first word, words, similarity) of each row's best window for each item that is similar enough."""
    data = tx.LOWER[part.data]
    found = tx.words(data, part.offsets, tx.ALNUM)
    hashes = tx.word_hashes(data, found)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for k in sorted({min(int(w), SHINGLE) for w in index.words}):
        # items of fewer than five words are one shingle, met by windows of just so many words
        made, first = tx.shingles(hashes, found.first, k)
        long = np.diff(found.first) >= k
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        hit = index.table[(made >> np.uint64(64 - _BITS)).astype(np.int64)]
        hits, at_hits = np.concatenate([[0], np.cumsum(hit)]), np.flatnonzero(hit)
        for size in sorted({int(w) for w in index.words if (w >= SHINGLE if k == SHINGLE else w == k)}):
            span = size - k + 1
            # so few shingles may be missing that the first hit lies this near to the window's start
            starts = np.unique(at_hits[:, None] - np.arange(int(span * (1 - SIMILARITY) + 1e-9) + 1))
            starts = starts[(starts >= 0) & (starts <= len(made) - span)]
            starts = starts[hits[starts + span] - hits[starts] >= SIMILARITY * span - 1e-9]
            starts = starts[(row[starts] == row[starts + span - 1]) & long[row[starts]]]
            if not len(starts):
                continue
            # fingerprints only over the stretches that hold candidates
            need = np.zeros(len(made) + 1, np.int64)
            np.add.at(need, starts, 1)
            np.add.at(need, starts + span, -1)
            used = np.flatnonzero(np.cumsum(need)[:-1])
            place = np.searchsorted(used, starts)
            near = near_items(index, windows_prints(made[used], place, span), size)
            window, item = np.unique(np.concatenate([near, sharing_items(index, made[used], place, span, size)], axis=1), axis=1)
            for w, i in zip(window.tolist(), item.tolist(), strict=True):
                at = int(starts[w])
                s = similarity(index, i, made[at:at + span])
                if s >= SIMILARITY:
                    r = int(row[at])
                    seen = (-s, int(at - first[r]), size)
                    best[r, i] = min(best.get((r, i), seen), seen)
        if k == SHINGLE:
            n = np.diff(first)
            # nearly all shingles of such a document must be shared, and the longest item must have more
            whole = long & (n < index.words.max() - k + 1) & (hits[first[1:]] - hits[first[:-1]] >= SIMILARITY * n)
            for r in np.flatnonzero(whole).tolist():
                for i, s in zip(*(x.tolist() for x in longer_items(index, made[first[r]:first[r + 1]])), strict=True):
                    best[r, i] = (-s, 0, int(n[r]) + k - 1)
    return [(r, i, at, size, -s) for (r, i), (s, at, size) in sorted(best.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """(key, item, similarity, first_word, words), one row per document and item that is found in it."""
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    items = stored(items.distinct(), "benchmark-items")
    slices = max(1, -(-items.count() // SLICE))
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    out = None
    for nth in range(2 * slices if slices > 1 else 1):
        own = items if slices == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(2 * slices)) == nth)
        got = own.orderBy("item", "text").toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(build(got.column("item").to_pylist(), got.column("text").to_pylist()))
        arrow_item = got.schema.field("item").type

        def found(batches, shared=shared, arrow_item=arrow_item):
            index = shared.value
            for part in tx.slices(batches):
                hit = matches(index, part)
                if hit:
                    r, i, at, size, s = zip(*hit, strict=True)
                    yield pa.RecordBatch.from_arrays([
                        part.rows.column("id").take(pa.array(r)), pa.array([index.ids[j] for j in i], arrow_item),
                        pa.array(s, pa.float64()), pa.array(at, pa.int64()), pa.array(size, pa.int64()),
                    ], ["id", "item", "similarity", "first_word", "words"])

        one = rows.mapInArrow(found, f"id {kind}, item {item_kind}, similarity double, first_word bigint, words bigint")
        out = one if out is None else out.unionByName(one)
    best = F.max_by(F.struct("similarity", "first_word", "words"), F.struct("similarity", -F.col("first_word"), -F.col("words")))
    return out.groupBy("id", "item").agg(best.alias("_b")).select(
        F.col("id").alias(key), F.col("item").alias(item), "_b.similarity", "_b.first_word", "_b.words")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, be their id shared with others or missing."""
    own = fresh(docs, "_row")
    keyed = docs.withColumn(own, F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(5), text).alias("b")))
    found = contaminated(keyed, benchmark, own, text).select(own).distinct()
    return keyed.join(found, own, "left_anti").drop(own)
