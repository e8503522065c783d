"""Exact removal of repeated passages by a logarithmic family of sparse suffix arrays.

A byte goes if it lies in a string of ``SPAN`` bytes that also starts somewhere else. Of the ``SPAN - SEED + 1`` suffixes
that start in such a string and begin with ``SEED`` of its bytes, the one whose beginning hashes lowest is sampled; the
choice depends on the string alone, so wherever it occurs its sampled suffix does, too. About one suffix in seventy is.

*Index.* Documents come in batches. The sampled suffixes of a batch form its level, ordered by a hash of their first
``SEED`` bytes, as only runs of suffixes with equal beginnings matter. A new batch is scanned together with all levels;
what begins like another suffix is a hit. Before a level is added, equal-sized levels merge into one of twice the size,
so there are as many levels as the logarithm of the number of batches, and a suffix is rewritten as often.

*Matches.* A hit's context is all that a repeated string around it can hold: the ``SPAN - SEED`` bytes on either side.
Where all contexts of a beginning are equal, all strings around it are repeated. Elsewhere its suffixes are put into
suffix order, and the parts before them likewise; the lengths of the common prefixes of neighbours then tell for every
string around a hit whether it occurs twice. Beginnings with more than ``RUN`` unequal contexts, a short passage in very
many documents, are settled by counting the hashes of their strings instead, which Spark spreads over all tasks.

Texts are read where they lie; only those with hits are shuffled. Hashes have 64 bits; contexts below ``RUN`` are
compared byte by byte.

Defined results: null texts are empty; texts shorter than ``SPAN`` bytes keep everything; a row that is repeated with its
id and text is removed whole if it is long enough; ids may be null; other columns pass through ``trimmed``. Where removal
cuts a character in two, ``trimmed`` drops what is left of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .blocks import groups
from .columns import fresh, stored

SPAN = 200
SEED = 64
SIDE = SPAN - SEED
BATCHES = 4
RUN = 20_000
_FILTER_WORDS = 1 << 15
_PLACE_BITS = 24


def sampled(part: tx.Slice) -> tuple[np.ndarray, ...]:
    """Row, place in the row, hash of the beginning, and the first and last start of the strings each suffix stands for."""
    n = len(part.data)
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if n < SPAN:
        return none
    sums = tx.prefix_sums(part.data)
    at = np.arange(n - SEED + 1)
    hashes = tx.substring_hashes(sums, at, at + SEED)
    bits = np.uint64(max(_PLACE_BITS, int(n).bit_length()))
    ranked = (hashes >> bits << bits) | at.astype(np.uint64)
    width = SIDE + 1
    padded = np.full(-(-len(ranked) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(ranked)] = ranked
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n - SPAN + 1], ahead[SIDE:SIDE + n - SPAN + 1])
    # strings that lie within one row
    start = np.arange(n - SPAN + 1)
    row = np.repeat(np.arange(part.rows.num_rows), np.diff(part.offsets))[:n - SPAN + 1]
    inside = start + SPAN <= part.offsets[row + 1]
    start, row = start[inside], row[inside]
    place = (least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    if not len(start):
        return none
    heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    last = np.concatenate([heads[1:], [len(start)]]) - 1
    base = part.offsets[row[heads]]
    return row[heads], place[heads] - base, hashes[place[heads]], start[heads] - base, start[last] - base


def row_id(key: str, text: str):
    return F.xxhash64(key, text, F.col(key).isNull(), F.col(text).isNull())


def suffixes(rows: DataFrame) -> DataFrame:
    """(seed, row, at) of the sampled suffixes of ``rows`` (row, text)."""

    def run(batches):
        for part in tx.slices(batches):
            row, place, seed, _, _ = sampled(part)
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(seed.astype(np.uint64))), part.rows.column("row").take(pa.array(row)),
                                              pa.array(place.astype(np.int32))], ["seed", "row", "at"])

    return rows.select("row", "text").mapInArrow(run, "seed bigint, row bigint, at int")


class Levels:
    """The index family: levels of sampled suffixes, at most two of a size."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    def _merge(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels.pop(), self.levels.pop()
            both = a.unionByName(b).repartition("seed").sortWithinPartitions("seed")
            self.levels.append((size + 1, stored(both, "suffix-level")))

    def add(self, batch: DataFrame) -> DataFrame:
        """Takes a batch of suffixes in; all suffixes, its own and earlier ones, that begin like another and are new to that."""
        self._merge()
        new = stored(batch.repartition("seed").sortWithinPartitions("seed"), "suffix-level")
        every = new.withColumn("new", F.lit(True))
        for _, level in self.levels:
            every = every.unionByName(level.withColumn("new", F.lit(False)))
        shared = every.groupBy("seed").agg(F.count("*").alias("_n"), F.max("new").alias("_new")).where("_n > 1 and _new")
        self.levels.append((0, new))
        return stored(every.join(shared.select("seed"), "seed", "left_semi").drop("new"), "suffix-hits")


def _contexts(texts: DataFrame, wanted: str) -> DataFrame:
    """(seed, row, at, low, high, context) for the hits of each text; with ``before`` and ``after`` as bytes if wanted.

    low and high are the first and last start of the strings that the suffix stands for. ``wanted`` names the rows'
    column of chosen places.
    """

    def run(batches):
        for part in tx.slices(batches):
            chosen = part.rows.column(wanted)
            row, place, seed, low, high = sampled(part)
            if not len(row):
                continue
            picked = np.asarray(chosen.flatten(), np.int64)
            owner = np.repeat(np.arange(len(chosen)), np.asarray(pc.fill_null(pc.list_value_length(chosen), 0)))
            some = np.isin(row << 40 | place, owner << 40 | picked)
            row, place, seed, low, high = (x[some] for x in (row, place, seed, low, high))
            begin, end = part.offsets[row], part.offsets[row + 1]
            at = begin + place
            left, right = np.maximum(at - SIDE, begin), np.minimum(at + SPAN, end)
            sums = tx.prefix_sums(part.data)
            context = tx.mix(tx.substring_hashes(sums, left, right) ^ ((at - left) << 20 | (right - at)).astype(np.uint64))
            raw = part.data.tobytes()
            spans = list(zip(left.tolist(), at.tolist(), right.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array(tx.signed(seed.astype(np.uint64))), part.rows.column("row").take(pa.array(row)), pa.array(place.astype(np.int32)),
                pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(tx.signed(context)),
                pa.array([raw[b:m][::-1] for b, m, _ in spans] if wanted == "open" else pa.nulls(len(row), pa.binary()), pa.binary()),
                pa.array([raw[m + SEED:e] for _, m, e in spans] if wanted == "open" else pa.nulls(len(row), pa.binary()), pa.binary()),
            ], ["seed", "row", "at", "low", "high", "context", "before", "after"])

    return texts.select("row", "text", wanted).mapInArrow(
        run, "seed bigint, row bigint, at int, low int, high int, context bigint, before binary, after binary")


def _order(values: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order within each group, and the common prefix of each with the one before it (-1 where a group begins)."""
    ranks = group.tolist()
    order = sorted(range(len(values)), key=lambda i: (ranks[i], values[i]))
    size = np.array([len(values[i]) for i in order])
    flat = np.zeros((len(order), SIDE), np.uint8)
    cells = np.repeat(np.arange(len(order)) * SIDE, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    flat.ravel()[cells] = np.frombuffer(b"".join(values[i] for i in order), np.uint8)
    common = np.full(len(order), -1)
    differ = flat[1:] != flat[:-1]
    first = np.where(differ.any(1), differ.argmax(1), SIDE)
    common[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
    heads = np.asarray(order)
    common[1:][group[heads[1:]] != group[heads[:-1]]] = -1
    return heads, common


def repeated_strings(seed: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, before: list[bytes],
                     after: list[bytes]) -> np.ndarray:
    """(rows, SIDE + 1): whether the string that starts so many bytes before the suffix occurs twice among its group."""
    group = np.unique(seed, return_inverse=True)[1]
    ahead, ahead_common = _order(after, group)
    back, back_common = _order(before, group)
    out = np.zeros((len(seed), SIDE + 1), bool)
    names_a, names_b = np.empty(len(seed), np.int64), np.empty(len(seed), np.int64)
    for before_n in range(SIDE + 1):
        some = np.flatnonzero((place - before_n >= low) & (place - before_n <= high))
        if len(some) < 2:
            continue
        names_a[ahead] = np.cumsum(ahead_common < SIDE - before_n)
        names_b[back] = np.cumsum(back_common < before_n)
        name = names_a[some] * (len(seed) + 1) + names_b[some]
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        twice = np.zeros(len(some), bool)
        twice[1:] |= same
        twice[:-1] |= same
        out[some[order[twice]], before_n] = True
    return out


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of a boolean matrix."""
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return row, first, last - 1


def _settle(batches: Iterator[pa.RecordBatch]):
    """Suffixes sorted by ``_group`` (their beginning): (row, start, end) of the repeated strings."""
    for table in groups(batches):
        place, low, high = (table.column(c).to_numpy().astype(np.int64) for c in ("at", "low", "high"))
        hit = repeated_strings(table.column("_group").to_numpy(), place, low, high, table.column("before").to_pylist(),
                               table.column("after").to_pylist())
        own, first, last = _runs(hit)
        yield pa.RecordBatch.from_arrays([pa.array(table.column("row").to_numpy()[own]), pa.array(place[own] - last),
                                          pa.array(place[own] - first + SPAN)], ["row", "start", "end"])


def _strings(texts: DataFrame) -> DataFrame:
    """(row, start, name) of every string around the suffixes in ``many``."""

    def run(batches):
        for part in tx.slices(batches):
            chosen = part.rows.column("many")
            row, place, _, low, high = sampled(part)
            if not len(row):
                continue
            owner = np.repeat(np.arange(len(chosen)), np.asarray(pc.fill_null(pc.list_value_length(chosen), 0)))
            some = np.isin(row << 40 | place, owner << 40 | np.asarray(chosen.flatten(), np.int64))
            row, low, high = row[some], low[some], high[some]
            n = high - low + 1
            start = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            row = np.repeat(row, n)
            at = part.offsets[row] + start
            name = tx.substring_hashes(tx.prefix_sums(part.data), at, at + SPAN)
            yield pa.RecordBatch.from_arrays([part.rows.column("row").take(pa.array(row)), pa.array(start), pa.array(tx.signed(name))],
                                             ["row", "start", "name"])

    return texts.select("row", "text", "many").mapInArrow(run, "row bigint, start bigint, name bigint")


def repeated(docs: DataFrame, key: str, text: str, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """Texts that may hold repeated strings (row, text), and their repeated stretches (row, start, end) in bytes."""
    rows = docs.select(row_id(key, text).alias("row"), F.col(text).alias("text"))
    index, hits = Levels(), None
    for nth in range(batches):
        own = rows.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == nth)
        found = index.add(suffixes(own))
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy("row").agg(F.collect_set("at").alias("hits"))
    marks = hits.groupBy(F.shiftright(F.pmod("row", F.lit(_FILTER_WORDS * 64)), 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(row & 63 as int))")).alias("bits")).toArrow()
    table = np.zeros(_FILTER_WORDS, np.int64)
    table[np.asarray(marks.column("word"), np.int64)] = np.asarray(marks.column("bits"), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def likely(batches):
        for batch in batches:
            bit = batch.column("row").to_numpy() % (_FILTER_WORDS * 64)
            some = (shared.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(some.astype(bool)))

    # one of several equal rows will do: they are dealt with below
    near = rows.mapInArrow(likely, rows.schema).join(hits, "row").dropDuplicates(["row"])
    texts = stored(near, "suffix-texts")
    known = stored(_contexts(texts, "hits").drop("before", "after"), "suffix-contexts")
    alike = rows.groupBy("row").agg(F.count("*").alias("times")).where("times > 1")
    seeds = known.groupBy("seed").agg(F.count("*").alias("n"), F.min("context").alias("least"), F.max("context").alias("most")).where("n > 1")
    judged = known.join(seeds, "seed")
    whole = judged.where("least = most").select("row", F.col("low").cast("long").alias("start"), (F.col("high").cast("long") + SPAN).alias("end"))
    open_ = judged.where("least != most").groupBy("row").agg(
        F.collect_list(F.when(F.col("n") <= RUN, F.col("at"))).alias("open"), F.collect_list(F.when(F.col("n") > RUN, F.col("at"))).alias("many"))
    left = stored(texts.drop("hits").join(open_, "row"), "suffix-open")
    near = _contexts(left.where(F.size("open") > 0), "open").select(F.col("seed").alias("_group"), "row", "at", "low", "high", "before", "after")
    settled = near.repartition("_group").sortWithinPartitions("_group").mapInArrow(_settle, "row bigint, start bigint, end bigint")
    strings = _strings(left.where(F.size("many") > 0))
    twice = strings.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    counted = strings.join(twice, "name", "left_semi").select("row", "start", (F.col("start") + SPAN).alias("end"))
    full = texts.join(alike, "row", "left_semi").where(F.octet_length("text") >= SPAN).select(
        "row", F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end"))
    return texts.select("row", "text"), whole.unionByName(settled).unionByName(counted).unionByName(full)


def _union(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _keep(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for start, end in spans:
        parts.append(raw[at:start])
        at = end
    return b"".join([*parts, raw[at:]])


def _spans(stretches: DataFrame) -> DataFrame:
    """Per row the stretches of its text, as many as its length allows."""
    return stretches.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def trim(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``."""
    texts, stretches = repeated(docs, key, text, batches)

    def cut(batches):
        for part in tx.slices(batches):
            removed, runs, kept = [], [], []
            for raw, spans in zip(part.rows.column("text").to_pylist(), part.rows.column("spans").to_pylist(), strict=True):
                data = (raw or "").encode()
                own = _union([s["start"] for s in spans], [s["end"] for s in spans])
                removed.append(sum(e - s for s, e in own))
                runs.append(len(own))
                kept.append(hashlib.sha256(_keep(data, own)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.rows.column("row"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                                              pa.array(kept, pa.string())], ["row", "_removed", "_spans", "_kept"])

    made = texts.join(_spans(stretches), "row").mapInArrow(cut, "row bigint, _removed bigint, _spans bigint, _kept string")
    every = docs.select(F.col(key), row_id(key, text).alias("row"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                        F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("_whole"))
    return every.join(made, "row", "left").select(
        key, "n_bytes", F.coalesce("_removed", F.lit(0)).alias("n_removed"), F.coalesce("_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("_kept", "_whole").alias("kept_sha256"))


def trimmed(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """``docs`` without the repeated bytes of their texts."""
    _, stretches = repeated(docs, key, text, batches)
    names, row, cuts = docs.columns, fresh(docs, "_row"), fresh(docs, "_spans")

    def cut(batches):
        for part in tx.slices(batches, text):
            made = [raw if raw is None or not spans else
                    _keep(raw.encode(), _union([s["start"] for s in spans], [s["end"] for s in spans])).decode("utf-8", "ignore")
                    for raw, spans in zip(part.rows.column(text).to_pylist(), part.rows.column(cuts).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(made, part.rows.column(text).type) if n == text else part.rows.column(n)
                                              for n in names], names)

    keyed = docs.withColumn(row, row_id(key, text)).join(
        _spans(stretches).select(F.col("row").alias(row), F.col("spans").alias(cuts)), row, "left")
    return keyed.drop(row).mapInArrow(cut, docs.schema)
