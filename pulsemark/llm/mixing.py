"""Mixing sources to target weights by balanced sampling (cube method).

Every row of a source has the same expected number of copies, target / source size: a whole part that is always taken
and a fraction. The fractions are moved, three rows at a time, along the direction that changes neither the number of
rows nor the number of tokens expected, until one of them is 0 or 1 (flight). A block of rows thus ends with at most ``KEEP + 2`` rows undecided: two of the
flight and ``KEEP`` left out of it. These are gathered per source and flown again, level by level, until one block per
source is left. There the last rows are settled by trying all cases (landing); so many of them are kept for it that
some case hits the tokens almost exactly. A source of any size is cut into blocks by a hash of the row, so no task holds
a source. The random choices come from that hash as well, so reruns agree.

Defined results: null or empty texts have size 0 and are balanced by number only; a null source is a source of its own,
last in order; a source whose rows are all of size 0 takes nothing; repeated rows and null ids are rows like any other
and may be chosen differently; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import fresh, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all tokens
CAP = 2  # times a source's own size
BLOCK = 4096
KEEP = 12  # rows of a block that are left to the landing


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(key: str, text: str) -> Column:
    return F.xxhash64(key, text, F.col(key).isNull(), F.col(text).isNull())


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, with each source's ``target``.

    Sources in code point order, null last, take ``weights`` in turn. A source gets min(cap * size, level * weight) with
    the one level that uses up ``share`` of all sizes, which is where resharing the excess again and again ends. Levels
    are tried where a source reaches its cap, so two ordered sums over the sources suffice.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    listed = sizes.withColumn("_nth", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_nth") % len(weights) + 1).cast("int"))
    listed = listed.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(cap))
    full = Window.orderBy(F.col("_cap") / F.col("_w"), "_nth")
    every = Window.partitionBy(F.lit(0))
    listed = (
        listed.withColumn("_capped", F.sum("_cap").over(full.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_open", F.sum("_w").over(full.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_total", F.sum("source_size").over(every) * float(share))
        .withColumn("_level", (F.col("_total") - F.coalesce("_capped", F.lit(0.0))) / F.col("_open"))
    )
    # the first source, in order of caps, that its level does not fill
    level = F.min(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"),
                         F.struct(F.col("_cap") / F.col("_w"), "_nth", "_level"))).over(every)["_level"]
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least("_cap", level * F.col("_w")))
    return listed.select(*sizes.columns, "_nth", target.alias("target"))


def flight(p: np.ndarray, x: np.ndarray, coin: np.ndarray, keep: int = KEEP) -> np.ndarray:
    """Moves the fractions ``p`` of one block to 0 or 1, keeping sum(p) and sum(p * x), but for two and ``keep`` others."""
    p = np.where(p < 1e-9, 0.0, np.where(p > 1 - 1e-9, 1.0, p)).tolist()
    sizes = x.tolist()
    coins = coin.tolist()
    open_ = []
    order = sorted((i for i in range(len(p)) if 0 < p[i] < 1), key=lambda i: (coins[i], i))
    for i in sorted(order[keep:], key=lambda i: (-sizes[i], coins[i], i)):
        open_.append(i)
        if len(open_) < 3:
            continue
        a, b, c = open_
        # the direction orthogonal to (1, 1, 1) and to the sizes
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for k, j in enumerate(open_):
            if u[k] > 0:
                up, down = min(up, (1 - p[j]) / u[k]), min(down, p[j] / u[k])
            elif u[k] < 0:
                up, down = min(up, p[j] / -u[k]), min(down, (1 - p[j]) / -u[k])
        step = up if coins[i] * (up + down) < down else -down
        left = []
        for k, j in enumerate(open_):
            p[j] += step * u[k]
            if 1e-9 < p[j] < 1 - 1e-9:
                left.append(j)
            else:
                p[j] = float(round(p[j]))
        open_ = left[:2] if len(left) > 2 else left
        if len(left) > 2:  # rounding left all three open: the nearest to an end is taken there
            near = min(left, key=lambda j: min(p[j], 1 - p[j]))
            p[near] = float(round(p[near]))
            open_ = [j for j in left if j != near]
    return np.asarray(p, dtype=float)


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Settles the few fractions left: tokens as near their expectation as can be, with the number of rows within 1."""
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    cases = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    tokens = np.abs(cases @ x[left] - p[left] @ x[left])
    number = np.abs(cases.sum(1) - p[left].sum())
    p = p.copy()
    p[left] = cases[np.lexsort((number, np.round(tokens, 6), number > 1))[0]]
    return p


def _blocks(settle: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]):
    """Rows sorted by block arrive in batches; a block is settled as soon as its last row is there."""

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            block = held.column("_block").to_numpy()
            cut = int(np.searchsorted(block, block[-1])) if len(block) else 0
            if cut:
                yield from _settled(held.slice(0, cut), settle)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from _settled(held, settle)

    return run


def _settled(rows: pa.Table, settle) -> list[pa.RecordBatch]:
    block = rows.column("_block").to_numpy()
    p, x, coin = (rows.column(c).to_numpy() for c in ("_p", "size", "_coin"))
    edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
    done = [settle(p[a:b], x[a:b].astype(float), coin[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    out = rows.set_column(rows.schema.get_field_index("_p"), "_p", pa.array(np.concatenate(done)))
    return out.combine_chunks().to_batches()


def _fly(rows: DataFrame, blocks: Column, settle) -> DataFrame:
    """One level: rows of a source share ``blocks`` blocks, dealt by their hash."""
    dealt = rows.withColumn("_block", F.xxhash64("_nth", F.pmod("_hash", blocks)))
    dealt = dealt.repartition("_block").sortWithinPartitions("_block", "_hash")
    return dealt.mapInArrow(_blocks(settle), dealt.schema).drop("_block")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """One row per document: key, size, source_size, target, copies (how often it is taken), _hash (see ``row_hash``)."""
    rows = stored(docs.select(F.col(key).alias("_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                              row_hash(key, text).alias("_hash")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    plan = stored(targets(sizes, weights, share, cap), "mix-targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    dealt = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "_id", "size", "source_size", "target", "_rows", "_nth", "_hash", F.floor(expected).alias("_whole"),
        (expected - F.floor(expected)).alias("_p"),
        (F.pmod(F.xxhash64("_hash", F.lit(7)), F.lit(1 << 53)).cast("double") / float(1 << 53)).alias("_coin"),
    )
    fly = lambda p, x, coin: flight(p, x, coin)
    level = stored(_fly(dealt, F.ceil(F.col("_rows") / block), fly), "mix-flight")
    settled = [level.where("_p in (0, 1)")]
    while True:
        left = level.where("_p not in (0, 1)")
        counts = left.groupBy("_nth").agg(F.count("*").alias("_left"))
        most = counts.agg(F.max("_left")).first()[0]
        if most is None:
            break
        joined = left.drop("_rows").join(counts, "_nth").withColumnRenamed("_left", "_rows").select(level.columns)
        last = most <= block
        end = (lambda p, x, coin: landing(flight(p, x, coin), x)) if last else fly
        level = stored(_fly(joined, F.ceil(F.col("_rows") / block), end), "mix-flight")
        settled.append(level if last else level.where("_p in (0, 1)"))
        if last:
            break
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select(F.col("_id").alias(key), "size", "source_size", "target",
                      (F.col("_whole") + F.col("_p")).cast("long").alias("copies"), "_hash")


def mixed(docs: DataFrame, key: str = "doc_id", **parameters) -> DataFrame:
    """``docs`` with each row as often as it is taken, dropped where that is never.

    Rows of one id and text share what they are given together.
    """
    row, nth, copy = (fresh(docs, c) for c in ("_row", "_nth", "_copy"))
    names = {c: fresh(docs, c) for c in ("_id", "_hash", "_copies", "_alike")}
    taken = mix(docs, key, **parameters).groupBy(F.col(key).alias(names["_id"]), F.col("_hash").alias(names["_hash"])).agg(
        F.sum("copies").alias(names["_copies"]), F.count("*").alias(names["_alike"])).where(F.col(names["_copies"]) > 0)
    keyed = docs.withColumn(row, row_hash(key, parameters.get("text", "text")))
    same = (F.col(row) == F.col(names["_hash"])) & F.col(key).eqNullSafe(F.col(names["_id"]))
    copies, alike = F.col(names["_copies"]), F.col(names["_alike"])
    each = F.floor(copies / alike) + (F.col(nth) <= copies % alike).cast("long")
    return (keyed.join(taken, same).withColumn(nth, F.row_number().over(Window.partitionBy(row).orderBy(row)))
            .where(each > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), each)).alias(copy)).drop(copy))
