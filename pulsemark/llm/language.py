"""Language of every word of a text: a linear-chain conditional random field.

A word's score for a language is the sum of learned weights of hashed features: its first and last one, two and three
bytes (affixes), its trigrams, and itself (the lexicon of the training texts). Learned transitions tie neighbours
together, so a foreign word in a sentence does not break it, but a passage in another language is labelled as such.
Chains run over the words that hold a letter and are cut after ``CHAIN`` words; all chains of a slice of texts go
through the forward and backward pass side by side. A text's language is the one that its words' marginals favour most,
its score their mean.

Weights and transitions are learned by gradient ascent on the likelihood over at most ``per_language`` texts of every
language that occurs, taken in hash order, every word carrying its text's language; the passes over them are Spark tasks
that return the gradient of their part in blocks of features, which Spark sums, and the driver holds weights only. Chains
are scored ``CELLS`` words times languages at a time. The weights take 0.26 MB per language in each worker.

Defined results: null texts and texts without a letter are ``und`` with score 0; rows without a language teach nothing;
without any, every text is ``und``. Equal marginals go to the first language by name. Ids may be null or repeated and
other columns pass through ``predict``, where those of the results' names are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .columns import lowest_hashes_by, stored
from .lm import _summed

BITS = 15
BUCKETS = 1 << BITS
CHAIN = 64
PER_LANGUAGE = 400
CELLS = 1 << 21
BLOCK_BYTES = 1 << 20
LABELS = 16  # languages whose trigram weights are gathered at a time
ROUNDS = 12
_AFFIXES = 6

# ASCII letters and all bytes of longer characters
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Model(NamedTuple):
    languages: list[str]
    grams: np.ndarray  # (BUCKETS, languages): trigrams
    rest: np.ndarray  # (BUCKETS, languages): affixes and lexicon
    moves: np.ndarray  # (languages, languages): transitions, logarithms


class Chains(NamedTuple):
    row: np.ndarray  # row of each word
    grams: np.ndarray  # trigram bucket at each byte
    starts: np.ndarray  # per word, for summing over its trigrams
    lengths: np.ndarray
    rest: np.ndarray  # (words, affixes + 1) buckets
    place: np.ndarray  # per word its cell in the grid of chains
    shape: tuple[int, int]  # chains, CHAIN


def chains(part: tx.Slice) -> Chains | None:
    """The words that hold a letter, with their features, laid out in chains."""
    data = tx.LOWER[part.data]
    found = tx.words(data, part.offsets)
    if not len(found.starts):
        return None
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    some = letters[found.ends] > letters[found.starts]
    starts, ends, row = found.starts[some], found.ends[some], found.row[some]
    if not len(starts):
        return None
    b = data.astype(np.uint32)
    padded = np.concatenate([b, np.zeros(2, np.uint32)])
    three = padded[:-2] | padded[1:-1] << np.uint32(8) | padded[2:] << np.uint32(16)
    grams = ((three * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
    size = ends - starts
    columns = []
    for n in (1, 2, 3):
        width = np.minimum(size, n)
        for salt, at in ((n, starts), (n + 3, ends - width)):
            key = np.zeros(len(starts), np.uint32)
            for j in range(n):
                key = key << np.uint32(8) | np.where(j < width, b[np.minimum(at + j, len(b) - 1)], 0).astype(np.uint32)
            columns.append(((key + np.uint32(salt << 26)) * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS))
    columns.append(tx.substring_hashes(tx.prefix_sums(data), starts, ends) >> np.uint64(64 - BITS))
    first = np.searchsorted(row, np.arange(part.rows.num_rows + 1))
    nth = np.arange(len(row)) - first[row]
    per_row = -(-np.diff(first) // CHAIN)
    chain = (np.cumsum(per_row) - per_row)[row] + nth // CHAIN
    return Chains(row, grams, starts, np.maximum(size - 2, 0), np.stack([c.astype(np.int64) for c in columns], 1),
                  chain * CHAIN + nth % CHAIN, (int(per_row.sum()), CHAIN))


def _gram_words(own: Chains) -> tuple[np.ndarray, np.ndarray]:
    """The position of every trigram of a word, and its word."""
    word = np.repeat(np.arange(len(own.row)), own.lengths)
    at = np.arange(len(word)) - np.repeat(np.cumsum(own.lengths) - own.lengths, own.lengths) + own.starts[word]
    return at, word


def emissions(own: Chains, model: Model) -> np.ndarray:
    out = model.rest[own.rest[:, 0]].astype(float)
    for j in range(1, own.rest.shape[1]):
        out += model.rest[own.rest[:, j]]
    at, word = _gram_words(own)
    for label in range(0, out.shape[1], LABELS):
        weights = model.grams[own.grams[at], label:label + LABELS]
        for j in range(weights.shape[1]):
            out[:, label + j] += np.bincount(word, weights[:, j], len(out))
    return out


def _limit(k: int) -> int:
    """Bytes of text at a time: rows times languages are held for them."""
    return max(tx.SLICE_BYTES * 64 // max(k, 64), 1)


def pieces(own: Chains, k: int):
    """The chains in groups of about ``CELLS`` words times languages, with the place of their words among all."""
    step = max(1, CELLS // (CHAIN * k))
    for at in range(0, own.shape[0], step):
        to = min(at + step, own.shape[0])
        a, b = np.searchsorted(own.place, [at * CHAIN, to * CHAIN]).tolist()
        yield slice(a, b), Chains(own.row[a:b], own.grams, own.starts[a:b], own.lengths[a:b], own.rest[a:b],
                                  own.place[a:b] - at * CHAIN, (to - at, CHAIN))


def forward_backward(scores: np.ndarray, own: Chains, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each word, expected transitions, and the log-likelihood's normaliser."""
    k = scores.shape[1]
    grid = np.zeros((own.shape[0] * own.shape[1], k))
    there = np.zeros(own.shape[0] * own.shape[1], bool)
    top = scores.max(1, keepdims=True)
    grid[own.place] = np.exp(scores - top)
    there[own.place] = True
    grid, there = grid.reshape(*own.shape, k), there.reshape(own.shape)
    step = np.exp(moves)
    ahead = np.zeros((CHAIN, own.shape[0], k))
    scale = np.ones((CHAIN, own.shape[0]))
    for t in range(CHAIN):
        live = there[:, t]
        if not live.any():
            break
        now = grid[live, t] if t == 0 else (ahead[t - 1, live] @ step) * grid[live, t]
        total = now.sum(1)
        ahead[t, live] = now / total[:, None]
        scale[t, live] = total
    back = np.ones((CHAIN, own.shape[0], k))
    pairs = np.zeros((k, k))
    for t in range(CHAIN - 2, -1, -1):
        live = there[:, t + 1]
        if not live.any():
            continue
        after = grid[live, t + 1] * back[t + 1, live] / scale[t + 1, live, None]
        back[t, live] = after @ step.T
        pairs += (ahead[t, live].T @ after) * step
    marginals = (ahead * back).transpose(1, 0, 2).reshape(-1, k)[own.place]
    norm = float(np.log(scale.T[there]).sum() + top.sum())
    return marginals / marginals.sum(1, keepdims=True), pairs, norm


def _add_gradient(part: tx.Slice, label: np.ndarray, model: Model, slope: np.ndarray) -> int:
    """Adds the gradient of a slice to ``slope``, rows of trigrams, of the rest and of transitions; returns its words."""
    own = chains(part)
    if own is None:
        return 0
    k = len(model.languages)
    for _, some in pieces(own, k):
        marginals, pairs, _ = forward_backward(emissions(some, model), some, model.moves)
        truth = label[some.row]
        error = -marginals
        error[np.arange(len(truth)), truth] += 1
        at, word = _gram_words(some)
        for buckets, which, base in ((some.grams[at], word, 0),
                                     (some.rest.ravel(), np.repeat(np.arange(len(truth)), some.rest.shape[1]), BUCKETS)):
            used, place = np.unique(buckets, return_inverse=True)
            for j in range(k):
                slope[base + used, j] += np.bincount(place, error[which, j], len(used))
        moves = -pairs
        inner = some.place[1:] % CHAIN != 0  # a word and the one before it, in one chain
        np.add.at(moves, (truth[:-1][inner], truth[1:][inner]), 1)
        slope[2 * BUCKETS:] += moves
    return len(own.row)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """Learn from the ``text`` and the non-null ``lang`` of ``docs``."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    texts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(texts)
    k = len(names)
    weights = np.zeros((2 * BUCKETS + k, k), np.float32)
    model = Model(names, weights[:BUCKETS], weights[BUCKETS:2 * BUCKETS], weights[2 * BUCKETS:])
    if k < 2:
        return model
    spark, hashed = docs.sparkSession, known.withColumn("order", F.xxhash64("text"))
    sample = lowest_hashes_by(hashed, "lang", "order", per_language, texts, "text")
    sample = stored(sample.repartition(max(2, min(16, k * 2)), "order"), "language-sample")
    rows = max(1, BLOCK_BYTES // (4 * k))  # of a block
    steps = np.full(weights.shape, 1e-6)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def ascend(batches, shared=shared):
            model = shared.value
            number = {n: i for i, n in enumerate(model.languages)}
            slope, words = np.zeros((2 * BUCKETS + k, k), np.float32), 0
            for part in tx.slices(batches, limit=_limit(k)):
                words += _add_gradient(part, np.array([number[n] for n in part.rows.column("lang").to_pylist()]), model, slope)
            if words:
                yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([np.array([words], np.float32).tobytes()])], ["_group", "slope"])
                for block in range(-(-len(slope) // rows)):
                    own = slope[block * rows:(block + 1) * rows]
                    if own.any():
                        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([own.tobytes()])], ["_group", "slope"])

        made = sample.select("text", "lang").mapInArrow(ascend, "_group bigint, slope binary")
        made = made.repartition("_group").sortWithinPartitions("_group", "slope")
        got = made.mapInArrow(_summed, "_group bigint, slope binary").toArrow()
        shared.unpersist()
        slopes = dict(zip(got.column("_group").to_pylist(), (np.frombuffer(b.as_buffer(), np.float32) for b in got.column("slope")), strict=True))
        if -1 not in slopes:
            return model
        words = float(slopes.pop(-1)[0])
        for block, slope in slopes.items():
            part = slice(block * rows, min((block + 1) * rows, len(weights)))
            cut = slope.reshape(-1, k).astype(float) / words
            steps[part] += cut * cut
            rate = np.where(np.arange(part.start, part.stop) < 2 * BUCKETS, 0.3, 0.5)[:, None]
            weights[part] += rate * cut / np.sqrt(steps[part])
    return model


def label_rows(part: tx.Slice, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of the favoured language (-1: none) and the mean of its marginals."""
    best, score = np.full(part.rows.num_rows, -1), np.zeros(part.rows.num_rows)
    own = chains(part) if model.languages else None
    if own is None:
        return best, score
    sums = np.zeros((len(best), len(model.languages)))
    for _, some in pieces(own, len(model.languages)):
        marginals, _, _ = forward_backward(emissions(some, model), some, model.moves)
        low, high = some.row[0], some.row[-1] + 1
        for j in range(len(model.languages)):
            sums[low:high, j] += np.bincount(some.row - low, marginals[:, j], high - low)
    n = np.bincount(own.row, minlength=len(best))
    best = np.where(n > 0, sums.argmax(1), -1)
    return best, np.where(n > 0, np.clip(sums.max(1) / np.maximum(n, 1), 0, 1), 0.0)


def predict(docs: DataFrame, model: Model, text: str = "text", to: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the favoured language and its mean marginal."""
    docs = docs.drop(to, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches):
        model = shared.value
        names = np.array([*model.languages, "und"], dtype=object)
        for part in tx.slices(batches, text, _limit(len(model.languages))):
            best, value = label_rows(part, model)
            yield pa.RecordBatch.from_arrays([*part.rows.columns, pa.array(names[best], pa.string()), pa.array(value)],
                                             [*part.rows.schema.names, to, score])

    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    schema = T.StructType([*docs.schema.fields, T.StructField(to, T.StringType()), T.StructField(score, T.DoubleType())])
    made = docs.mapInArrow(predicted, schema)
    return made.withColumn(score, F.when(lettered, F.col(score)).otherwise(F.lit(0.0))).withColumn(
        to, F.when(lettered, F.col(to)).otherwise(F.lit("und")))


def words(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, nth, word, lang_pred, score): every word that holds a letter, labelled on its own."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def labelled(batches):
        model = shared.value
        for part in tx.slices(batches):
            own = chains(part) if model.languages else None
            if own is None:
                continue
            best, value = np.zeros(len(own.row), np.int64), np.zeros(len(own.row))
            for at, some in pieces(own, len(model.languages)):
                marginals, _, _ = forward_backward(emissions(some, model), some, model.moves)
                best[at], value[at] = marginals.argmax(1), marginals.max(1)
            found = tx.words(part.data, part.offsets)
            end = found.ends[np.searchsorted(found.starts, own.starts)]
            raw = part.data.tobytes()
            made = [raw[s:e].decode("utf-8", "replace") for s, e in zip(own.starts.tolist(), end.tolist(), strict=True)]
            nth = np.searchsorted(found.starts, own.starts) - found.first[own.row]
            yield pa.RecordBatch.from_arrays([
                part.rows.column("id").take(pa.array(own.row)), pa.array(nth), pa.array(made),
                pa.array([model.languages[b] for b in best]), pa.array(value),
            ], ["id", "nth", "word", "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    made = rows.mapInArrow(labelled, f"id {kind}, nth bigint, word string, lang_pred string, score double")
    return made.withColumnRenamed("id", key)
