"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of 4 to 7 bytes of the lower-cased whole text, hashed to ``BUCKETS``. A feature's
value is its log-count ratio between the two labels, drawn towards 0 by ``ERRORS`` standard errors, so that n-grams
seen by chance with one label drop out; a logistic regression weighs the rest. Both are learned on a sample of at most
``per_label`` labelled texts of each label that are in the table learned from, taken in hash order of the id. Its n-grams are counted by Spark, and the driver gets
one row per bucket at most. Scoring goes over every row where it lies, without a shuffle.

Defined results: a null or empty text has no feature and gets the intercept's score; ids are returned as they are, null
and repeated ones too; a row repeated with two labels counts as its larger one; without rows of both labels every score
is the share of the label seen, or 0. Other columns of the input pass through ``score`` untouched; one of
the name of the result is replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .columns import sampled, stored

BITS = 18
BUCKETS = 1 << BITS
PER_LABEL = 4000
ERRORS = 3.0
ORDERS = (4, 5, 6, 7)
_SHIFT = np.uint32(32 - BITS)


class Model(NamedTuple):
    weights: np.ndarray  # float32, BUCKETS: log-count ratio times learned weight
    intercept: float


def _grams(data: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Bucket of the n-gram that starts at each byte, for each n of ``ORDERS``."""
    b = tx.LOWER[data].astype(np.uint32)
    out, h = [], b
    for n in range(2, ORDERS[-1] + 1):
        if len(b) < n:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint32(13))) * np.uint32(0x85EBCA77) + b[n - 1:] * np.uint32(0x9E3779B1)
        if n in ORDERS:
            out.append((n, (h * np.uint32(0xC2B2AE3D)) >> _SHIFT))
    return out


def _text_counts(part: tx.Slice, chosen: np.ndarray) -> np.ndarray:
    """Per bucket the number of ``chosen`` rows that hold it."""
    grams, counts, seen = _grams(part.data), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, bool)
    for start, end in zip(part.offsets[:-1][chosen].tolist(), part.offsets[1:][chosen].tolist(), strict=True):
        for n, ids in grams:
            seen[ids[start:max(start, end - n + 1)]] = True
        counts += seen
        seen[:] = False
    return counts


def _distinct(part: tx.Slice, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of the distinct features of each row, of the ``wanted`` buckets."""
    keys = []
    for n, ids in _grams(part.data):
        at = np.flatnonzero(wanted[ids])
        row = np.searchsorted(part.offsets, at, side="right") - 1
        whole = at + n <= part.offsets[row + 1]
        keys.append(row[whole] << BITS | ids[at[whole]])
    found = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)])).astype(np.int64)
    return found >> BITS, found & (BUCKETS - 1)


def log_count_ratio(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Per bucket, from the number of texts of each label that hold it; 0 where it is within the error."""
    ratio = np.log((ones + 1) / (ones.sum() + BUCKETS)) - np.log((zeros + 1) / (zeros.sum() + BUCKETS))
    error = ERRORS * np.sqrt(1 / (ones + 1) + 1 / (zeros + 1))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - error, 0)


def _fit(row: np.ndarray, bucket: np.ndarray, labels: np.ndarray, ratio: np.ndarray, rounds: int) -> Model:
    n = len(labels)
    if not n or labels.min() == labels.max():
        share = min(max(float(labels.mean()) if n else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    values = ratio[bucket]
    norm = np.sqrt(np.bincount(row, values * values, n)).max() or 1.0
    values = values / norm
    # both labels count alike, however unequal their numbers in the sample
    share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    weight, bias, step_w, step_b = np.full(BUCKETS, 1.0), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(rounds):
        margin = np.bincount(row, values * weight[bucket], n) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) * share / n
        slope = np.bincount(bucket, values * error[row], BUCKETS)
        step_w += slope * slope
        step_b += error.sum() ** 2
        weight -= 0.5 * slope / np.sqrt(step_w)
        bias -= 0.5 * error.sum() / np.sqrt(step_b)
    return Model((ratio * weight / norm).astype(np.float32), float(bias))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
        per_label: int = PER_LABEL, rounds: int = 150) -> Model:
    """Learn from ``docs`` whose ``key`` has a ``label`` of 0 or 1 in ``labels``."""
    rows = stored(sampled(docs, labels, key, text, label, per_label).select("text", "_label", F.xxhash64("_key", "text").alias("_row")),
                  "toxicity-sample")

    def counted(batches):
        for part in tx.slices(batches):
            positive = np.asarray(part.rows.column("_label")) == 1
            ones, zeros = _text_counts(part, positive), _text_counts(part, ~positive)
            at = np.flatnonzero(ones + zeros)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ones[at]), pa.array(zeros[at])], ["b", "p", "q"])

    counts = rows.mapInArrow(counted, "b bigint, p bigint, q bigint").groupBy("b").agg(
        F.sum("p").alias("p"), F.sum("q").alias("q")).toArrow()
    ones, zeros = np.zeros(BUCKETS), np.zeros(BUCKETS)
    ones[np.asarray(counts.column("b"))] = np.asarray(counts.column("p"))
    zeros[np.asarray(counts.column("b"))] = np.asarray(counts.column("q"))
    ratio = log_count_ratio(ones, zeros)

    def features(batches):
        for part in tx.slices(batches):
            row, bucket = _distinct(part, ratio != 0)
            first = np.searchsorted(row, np.arange(part.rows.num_rows + 1))
            yield pa.RecordBatch.from_arrays([part.rows.column("_row"), part.rows.column("_label"),
                                              tx.binaries(bucket.astype(np.int32), first)], ["_row", "_label", "found"])

    found = rows.mapInArrow(features, "_row bigint, _label int, found binary").orderBy("_row").toArrow()
    sets = [np.frombuffer(s, np.int32) for s in found.column("found").to_pylist()]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    labelled = np.asarray(found.column("_label").to_pylist(), dtype=float)
    return _fit(row, np.concatenate([*sets, np.zeros(0, np.int32)]).astype(np.int64), labelled, ratio, rounds)


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with a column ``to``: how likely label 1 is, from 0 to 1."""
    docs = docs.drop(to)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        weights, intercept = shared.value
        wanted = weights != 0
        for part in tx.slices(batches, text):
            row, bucket = _distinct(part, wanted)
            margin = np.bincount(row, weights[bucket].astype(float), part.rows.num_rows) + intercept
            value = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            yield pa.RecordBatch.from_arrays([*part.rows.columns, pa.array(value)], [*part.rows.schema.names, to])

    schema = T.StructType([*docs.schema.fields, T.StructField(to, T.DoubleType())])
    return docs.mapInArrow(scored, schema)
