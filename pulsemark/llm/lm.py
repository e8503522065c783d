"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax, and an exact unigram base.

Tokens are the lower-cased words of a text and one end. Output units are the most frequent tokens, one unit each, and
``SHARED`` units among which all other tokens are dealt by hash; a token's probability within a shared unit is its
smoothed count there. Units are sorted by frequency into classes: P(token | history) = P(class | history) * P(unit |
class, history) * P(token | unit). Both softmaxes add rows of weights for hashed features of the history: the previous
token, the previous two, and the one before the previous (a skip). Weights start at the unigram distribution. Under it
all histories predict alike, so the first update needs no softmax: counts of (row, outcome) over most of the training
texts give an iterative-scaling step in closed form, ``SCALING`` of the log of observed over expected. Each of the
``ROUNDS`` updates after it takes the gradient over its share of the texts left, and one damped diagonal Newton step.
Spark sums both block by block, in the order of the tasks. Every training token is used once.

Counts are exact and cover all training texts. The ``HEAD`` most frequent tokens are broadcast with their counts, a
table of fixed size; occurrences of all others are joined with the table of counts. Tokens are told apart by a 64-bit
hash: with V different tokens, the chance that any two meet is V * V / 2^65.

Defined results: a null or empty text is one end; repeated rows count as often as they occur and each get their score;
null ids are scored like others; without training texts every probability is that of one unknown token, 1.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .columns import stored

CLASSES = 32
UNITS = 32  # of a class
SHARED = 256
OWN = CLASSES * UNITS - SHARED
HEAD = 1 << 17
ROUNDS = 2
COUNTED = 10  # shares of the training texts that are counted; a round takes one
SCALING, SPARSE = 0.7, 60.0  # part of the log ratio; a row's prior observations
CLASS_ROWS = 1 << 15
UNIT_ROWS = 1 << 16
BLOCK_ROWS = 512
SALTS = 8  # most sums of a block, each of that many tasks at least
TASK_TOKENS = 1 << 21  # of a task that makes tables; its counts stay exact in single precision
STEP = 16_384  # tokens scored at a time
PRIOR = 200.0  # drawn towards 0 as by so many observations
END = np.uint64(0xE1D5A3C79B2F8641)
_BEGIN = np.uint64(0x6C62272E07BB0142)


class Model(NamedTuple):
    head: np.ndarray  # sorted tokens
    counts: np.ndarray  # of the head's tokens
    units: np.ndarray  # unit of each of the head's tokens
    shared: np.ndarray  # unit of each shared slot
    spread: np.ndarray  # per unit log10 of what counts + 1 are divided by; 0 for a token's own unit
    own: np.ndarray  # per unit whether it is one token's
    class_bias: np.ndarray
    unit_bias: np.ndarray  # (CLASSES, UNITS)
    class_rows: np.ndarray  # (CLASS_ROWS, CLASSES)
    unit_rows: np.ndarray  # (UNIT_ROWS, UNITS); each class has rows of its own
    begin: np.ndarray  # first of the rows of each class, one more than classes
    tokens: int  # N
    distinct: int  # V


def tokens(part: tx.Slice) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of each row, one after the other, and where each row's begin; every row ends with ``END``."""
    data = tx.LOWER[part.data]
    found = tx.words(data, part.offsets)
    first = found.first + np.arange(len(found.first))
    out = np.empty(first[-1], np.uint64)
    out[first[1:] - 1] = END
    inner = np.ones(len(out), bool)
    inner[first[1:] - 1] = False
    out[inner] = tx.word_hashes(data, found)
    return out, first.astype(np.int64)


def count(docs: DataFrame) -> DataFrame:
    """(token, c) over the column ``text`` of ``docs``."""

    def counted(batches):
        for part in tx.slices(batches):
            token, n = np.unique(tokens(part)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(token)), pa.array(n)], ["token", "c"])

    return docs.select("text").mapInArrow(counted, "token bigint, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def _slot(token: np.ndarray) -> np.ndarray:
    return (token % np.uint64(SHARED)).astype(np.int64)


def start(counts: DataFrame) -> Model:
    """The units and the unigram weights."""
    total = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    top = counts.orderBy(F.desc("c"), "token").limit(HEAD).toArrow()
    token = np.asarray(top.column("token"), np.int64).view(np.uint64)
    c = np.asarray(top.column("c"), np.int64)
    own = min(OWN, len(token))
    # what the shared slots hold: everything but the tokens with a unit of their own
    held = counts.groupBy(F.expr(f"cast(cast(pmod(cast(token as decimal(20,0)), {SHARED}) as int) as bigint)").alias("slot")).agg(
        F.sum("c").alias("n"), F.count("*").alias("v")).toArrow()
    n, v = np.zeros(SHARED, np.int64), np.zeros(SHARED, np.int64)
    n[np.asarray(held.column("slot"), np.int64)] = np.asarray(held.column("n"), np.int64)
    v[np.asarray(held.column("slot"), np.int64)] = np.asarray(held.column("v"), np.int64)
    np.subtract.at(n, _slot(token[:own]), c[:own])
    np.subtract.at(v, _slot(token[:own]), 1)
    mass = np.concatenate([c[:own], np.zeros(OWN - own, np.int64), n + v + 1]).astype(float)
    order = np.argsort(-mass, kind="stable")
    unit = np.empty(len(order), np.int64)
    unit[order] = np.arange(len(order))
    spread, single = np.zeros(len(order)), np.zeros(len(order), bool)
    spread[unit[OWN:]] = np.log10(n + v + 1)
    single[unit[:OWN]] = True
    share = (mass[order] + 0.01).reshape(CLASSES, UNITS)
    by = np.argsort(token)
    units = np.where(np.arange(len(token)) < own, unit[np.minimum(np.arange(len(token)), OWN - 1)], unit[OWN + _slot(token)])
    return Model(token[by], c[by], units[by], unit[OWN:], spread, single, np.log(share.sum(1) / share.sum()).astype(np.float32),
                 np.log(share / share.sum(1, keepdims=True)).astype(np.float32), np.zeros((CLASS_ROWS, CLASSES), np.float32),
                 np.zeros((UNIT_ROWS, UNITS), np.float32), _begin(share.sum(1)), int(total[1]), int(total[0]))


def _begin(mass: np.ndarray) -> np.ndarray:
    """Deals the unit rows among classes: half of them evenly, half by how often a class occurs."""
    part = 0.5 / CLASSES + 0.5 * mass / mass.sum()
    return np.concatenate([[0], np.floor(np.cumsum(part)[:-1] * UNIT_ROWS), [UNIT_ROWS]]).astype(np.int64)


def look_up(model: Model, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token its place in the head, or -1, and its unit."""
    if not len(model.head):
        return np.full(len(token), -1), model.shared[_slot(token)]
    at = np.minimum(np.searchsorted(model.head, token), len(model.head) - 1)
    known = model.head[at] == token
    return np.where(known, at, -1), np.where(known, model.units[at], model.shared[_slot(token)])


def histories(token: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Hashes of the three features of every token's history."""
    nth = np.arange(len(token)) - np.repeat(first[:-1], np.diff(first))
    one, two = np.roll(token, 1), np.roll(token, 2)
    one[nth < 1] = _BEGIN
    two[nth < 2] = _BEGIN
    return [tx.mix(one), tx.mix(one * np.uint64(3) ^ tx.mix(two)), tx.mix(two ^ np.uint64(0x5BD1E995))]


def _rows(model: Model, features: list[np.ndarray], group: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    classes = [(f % np.uint64(CLASS_ROWS)).astype(np.int64) for f in features]
    size = np.diff(model.begin).astype(np.uint64)[group]
    units = [model.begin[group] + ((f >> np.uint64(16)) % size).astype(np.int64) for f in features]
    return classes, units


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def _steps(model: Model, token: np.ndarray, first: np.ndarray, unit: np.ndarray):
    """Some tokens at a time: what they are, their rows, and both softmaxes."""
    features = histories(token, first)
    for at in range(0, len(token), STEP):
        part = slice(at, at + STEP)
        group, inner = unit[part] // UNITS, unit[part] % UNITS
        classes, units = _rows(model, [f[part] for f in features], group)
        p = _softmax(model.class_bias + sum(model.class_rows[r] for r in classes))
        q = _softmax(model.unit_bias[group] + sum(model.unit_rows[r] for r in units))
        yield part, group, inner, classes, units, p, q


def _add_rows(table: np.ndarray, seen: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    table[rows[heads]] += np.add.reduceat(values[order], heads, axis=0)
    seen[rows[heads]] += np.diff(np.concatenate([heads, [len(rows)]]))


def _counted(model: Model, batches):
    """Per row how often each outcome follows its histories, for all rows of a task."""
    tables = _tables()
    for part in tx.slices(batches):
        token, first = tokens(part)
        _, unit = look_up(model, token)
        group, inner = unit // UNITS, unit % UNITS
        for rows, table, outcome in zip(_rows(model, histories(token, first), group), tables, (group, inner), strict=True):
            for r in rows:
                np.add.at(table.reshape(-1), r * table.shape[1] + outcome, np.float32(1))
    for table in tables:
        table[:, -1] = table[:, :-1].sum(1)
    yield from _blocks(tables)


def _gradient(model: Model, batches):
    """The gradient of all rows of a task, and how often each row was seen."""
    tables = _tables()
    for part in tx.slices(batches):
        token, first = tokens(part)
        _, unit = look_up(model, token)
        for _, group, inner, classes, units, p, q in _steps(model, token, first, unit):
            at = np.arange(len(group))
            p *= -1
            q *= -1
            p[at, group] += 1
            q[at, inner] += 1
            for table, rows, error in ((tables[0], classes, p), (tables[1], units, q)):
                for r in rows:
                    _add_rows(table[:, :-1], table[:, -1], r, error)
    yield from _blocks(tables)


def _tables(kind=np.float32) -> list[np.ndarray]:
    return [np.zeros((CLASS_ROWS, CLASSES + 1), kind), np.zeros((UNIT_ROWS, UNITS + 1), kind)]


def _blocks(tables: list[np.ndarray]):
    """The blocks of rows that a task has touched."""
    for which, table in enumerate(tables):
        for block in range(len(table) // BLOCK_ROWS):
            part = table[block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS]
            if part[:, -1].any():
                yield which << 16 | block, np.ascontiguousarray(part)


def _summed(batches):
    """Blocks sorted by ``_group`` added up as they come, one at a time."""
    at, total = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([total.astype(np.float32).tobytes()])], ["_group", "slope"])

    for batch in batches:
        for group, blob in zip(batch.column("_group").to_pylist(), batch.column("slope"), strict=True):
            if group != at:
                if at is not None:
                    yield done()
                at, total = group, 0.0
            total = total + np.frombuffer(blob.as_buffer(), np.float32).astype(float)
    if at is not None:
        yield done()


def _tasks(spark: SparkSession, expected: int) -> int:
    """Tasks for about so many tokens: as many as run at once, more where there is more to read."""
    return max(spark.sparkContext.defaultParallelism, -(-expected // TASK_TOKENS))


def _sum(docs: DataFrame, model: Model, of, part_of: float = 1.0) -> list[np.ndarray]:
    """The tables that ``of`` makes of every task's texts, added up in the order of the tasks.

    A task hands on tables of nearly the same size however few its texts, so partitions of few tokens are read together;
    ``docs`` hold ``part_of`` the training tokens.
    """
    tasks = _tasks(docs.sparkSession, int(model.tokens * part_of))
    salts = min(SALTS, max(1, tasks // SALTS))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def made(batches):
        for block, part in of(shared.value, batches):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part.tobytes()])], ["block", "slope"])

    part = F.spark_partition_id()
    few = docs.select("text").coalesce(tasks)
    rows = few.mapInArrow(made, "block bigint, slope binary").withColumn("_part", part)
    rows = rows.withColumn("_group", F.col("block") * salts + F.pmod("_part", F.lit(salts)))
    rows = rows.repartition("_group").sortWithinPartitions("_group", "_part").select("_group", "slope")
    got = rows.mapInArrow(_summed, "_group bigint, slope binary").orderBy("_group").toArrow()
    tables = _tables(float)
    for group, blob in zip(got.column("_group").to_pylist(), got.column("slope"), strict=True):
        which, block = (group // salts) >> 16, (group // salts) & 0xFFFF
        part = np.frombuffer(blob.as_buffer(), np.float32).reshape(BLOCK_ROWS, -1)
        tables[which][block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS] += part
    shared.unpersist()
    return tables


def scaled(counts: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Weights of rows (counts per outcome, and in all) against the probabilities ``expected`` without history."""
    seen = (counts[:, :-1] + SPARSE * expected) / (counts[:, -1:] + SPARSE)
    return (SCALING * np.log(seen / expected)).astype(np.float32)


def train(docs: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """``model`` after the counted update and ``rounds`` gradient ones; each reads its own share of ``docs``."""
    share = F.pmod(F.xxhash64("text"), F.lit(COUNTED + rounds))
    plain = np.exp(model.class_bias), np.exp(model.unit_bias)[np.repeat(np.arange(CLASSES), np.diff(model.begin))]
    counts = _sum(docs.where(share < COUNTED), model, _counted, COUNTED / (COUNTED + rounds))
    model = model._replace(class_rows=scaled(counts[0], plain[0]), unit_rows=scaled(counts[1], plain[1]))
    for nth in range(rounds):
        slopes = _sum(docs.where(share == COUNTED + nth), model, _gradient, 1 / (COUNTED + rounds))
        new = []
        for old, slope, flat in zip((model.class_rows, model.unit_rows), slopes, plain, strict=True):
            step = slope[:, :-1] / (slope[:, -1:] * np.maximum(flat * (1 - flat), 1e-3) * 3 + PRIOR)
            new.append((old + np.clip(step, -1, 1)).astype(np.float32))
        model = model._replace(class_rows=new[0], unit_rows=new[1])
    return model


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, n_tokens, n_known, base_score, score), one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        model = shared.value
        logs = np.log10(model.counts + 1.0)
        for part in tx.slices(batches):
            token, first = tokens(part)
            place, unit = look_up(model, token)
            known = place >= 0
            seen = np.where(known, logs[place] if len(logs) else 0.0, 0.0)
            given = np.empty(len(token))
            for piece, group, inner, _, _, p, q in _steps(model, token, first, unit):
                at = np.arange(len(group))
                given[piece] = np.log10(p[at, group].astype(float)) + np.log10(q[at, inner].astype(float))
            given += np.where(model.own[unit], 0.0, seen - model.spread[unit])
            per_row = [np.add.reduceat(x, first[:-1]) for x in (seen, given, known.astype(np.int64))]
            rest = np.flatnonzero(~known)
            ends = np.searchsorted(rest, first).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.rows.column("row"), part.rows.column("id"), pa.array(np.diff(first)), pa.array(per_row[2]),
                pa.array(per_row[0]), pa.array(per_row[1]),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(tx.signed(token[rest]))),
            ], ["row", "id", "n_tokens", "head_known", "head_base", "head_score", "rest"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    made = stored(rows.mapInArrow(scored, f"row bigint, id {kind}, n_tokens bigint, head_known bigint, head_base double, "
                                          "head_score double, rest array<bigint>"), "lm-rows")
    rare = made.select("row", F.explode("rest").alias("token")).join(counts, "token").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1.0)).alias("_logs"), F.count("*").alias("_known"))
    norm = float(np.log10(model.tokens + model.distinct + 1))
    zero: Column = F.lit(0.0)
    return made.drop("rest").join(rare, "row", "left").select(
        "row", F.col("id").alias(key), "n_tokens", (F.col("head_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        (F.col("head_base") + F.coalesce("_logs", zero) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("head_score") + F.coalesce("_logs", zero)).alias("score"))


def fit_and_score(learned: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> tuple[DataFrame, Model]:
    """Counts and model from ``learned``, scores for ``docs``."""
    own = learned.select(F.col(text).alias("text"))
    counts = stored(count(own), "lm-counts")
    model = train(own, start(counts), rounds)
    return score(docs, model, counts, key, text), model
