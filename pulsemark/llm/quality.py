"""Quality: a document classifier's evidence combined with what its site and path are known for.

The classifier reads the shape of the whole text (kinds of characters, lengths of words and lines, repetition), cut into
bins, and is a logistic regression fitted on at most ``PER_LABEL`` labelled texts of each label. A second set of as many
labelled texts turns its margin into evidence: how much likelier each bin of margins is among good texts than among bad
ones.

Sites are judged by all their documents. Every document counts as much as the classifier, with the global prior, takes it
for good; a known label counts in its place. A host's rate is a beta posterior around the global rate, a path's around
its host's, and how strongly sparse ones are drawn in is estimated from the spread between hosts, and between paths of a
host (method of moments). A document's own count is taken out of its host and path before they judge it. Its posterior
is the path's rate moved by its evidence.

Counts per host and path are partial aggregates, so a host with a third of all documents is no single task's work, and
joins back to the documents can be split. Only a few sums and the bounded classifier reach the driver.

Defined results: null and empty texts are one shape like any other; a null host or path is a site of its own; of labels
that repeat an id, the larger counts; ids may be null (never labelled) or repeated; without labels of both kinds the
evidence is 0 and every rate is the share of good labels, or one half. Other columns do not pass through.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .columns import labelled, sampled, stored

PER_LABEL = 2000
BINS = 12
SHAPES = ("length", "upper", "digit", "symbol", "space", "wide", "word_length", "word_spread", "lines", "line_repeats",
          "word_repeats")
_KIND = np.full(256, 3)  # 0 lower, 1 upper, 2 digit, 3 symbol, 4 space, 5 wide
_KIND[0x61:0x7B] = 0
_KIND[0x41:0x5B] = 1
_KIND[0x30:0x3A] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 4
_KIND[0x80:] = 5
_LINE = np.ones(256, bool)
_LINE[[0x0A, 0x0D]] = False


class Model(NamedTuple):
    edges: np.ndarray  # (shapes, BINS - 1)
    weights: np.ndarray  # (shapes, BINS)
    intercept: float
    margins: np.ndarray  # edges of the bins of margins
    evidence: np.ndarray  # log Bayes factor of each


def _repeats(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of a row's items that repeat an earlier one."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, row))
    again = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.bincount(row[order][1:][again], minlength=len(n)) / np.maximum(n, 1)


def shapes(part: tx.Slice) -> np.ndarray:
    """(rows, shapes)"""
    rows, n = part.rows.num_rows, np.diff(part.offsets)
    row = np.repeat(np.arange(rows), n)
    kinds = np.bincount(row * 6 + _KIND[part.data], minlength=6 * rows).reshape(rows, 6) / np.maximum(n, 1)[:, None]
    found = tx.words(part.data, part.offsets)
    count = np.diff(found.first)
    length = (found.ends - found.starts).astype(float)
    mean = np.bincount(found.row, length, rows) / np.maximum(count, 1)
    square = np.bincount(found.row, length * length, rows) / np.maximum(count, 1)
    lines = tx.words(part.data, part.offsets, _LINE)
    return np.stack([
        np.log1p(n), kinds[:, 1], kinds[:, 2], kinds[:, 3], kinds[:, 4], kinds[:, 5], mean,
        np.sqrt(np.maximum(square - mean * mean, 0)), np.diff(lines.first) / np.maximum(count, 1),
        _repeats(tx.word_hashes(part.data, lines), lines.first), _repeats(tx.word_hashes(part.data, found), found.first),
    ], 1)


def _binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, v, side="right") for e, v in zip(edges, values.T, strict=True)], 1)


def _margin(bins: np.ndarray, weights: np.ndarray, intercept: float) -> np.ndarray:
    return weights[np.arange(bins.shape[1]), bins].sum(1) + intercept


def _learn(values: np.ndarray, labels: np.ndarray, train: np.ndarray, rounds: int = 300) -> Model:
    shape = (len(SHAPES), BINS)
    blank = Model(np.zeros((len(SHAPES), BINS - 1)), np.zeros(shape), 0.0, np.zeros(0), np.zeros(1))
    if len({*labels[train]}) < 2 or len({*labels[~train]}) < 2:
        return blank
    edges = np.quantile(values[train], np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    bins, y = _binned(values[train], edges), labels[train]
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    flat = (np.arange(shape[0]) * BINS + bins).ravel()
    weights, bias, seen, seen_b = np.zeros(shape), 0.0, np.full(shape, 1e-8), 1e-8
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-_margin(bins, weights, bias))) - y) * share / len(y)
        slope = np.bincount(flat, np.repeat(error, shape[0]), shape[0] * BINS).reshape(shape) + 1e-4 * weights
        seen += slope * slope
        seen_b += error.sum() ** 2
        weights -= 0.3 * slope / np.sqrt(seen)
        bias -= 0.3 * error.sum() / np.sqrt(seen_b)
    margin, y = _margin(_binned(values[~train], edges), weights, bias), labels[~train]
    margins = np.unique(np.quantile(margin, np.linspace(0, 1, 21)[1:-1]))
    at = np.searchsorted(margins, margin, side="right")
    good, bad = np.bincount(at[y == 1], minlength=len(margins) + 1), np.bincount(at[y == 0], minlength=len(margins) + 1)
    evidence = np.log((good + 0.5) / (good.sum() + 0.5 * len(good))) - np.log((bad + 0.5) / (bad.sum() + 0.5 * len(bad)))
    return Model(edges, weights, float(bias), margins, np.maximum.accumulate(evidence))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        per_label: int = PER_LABEL) -> Model:
    rows = sampled(docs, labels, key, text, label, 2 * per_label).select("text", "_label", F.xxhash64("_key").alias("_order"))

    def shaped(batches):
        for part in tx.slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.rows.column("_label"), part.rows.column("_order"), tx.fixed_binary(shapes(part))], ["label", "order", "shape"])

    got = rows.mapInArrow(shaped, "label int, order bigint, shape binary").orderBy("order", "shape").toArrow()
    values = np.frombuffer(b"".join(got.column("shape").to_pylist()), float).reshape(-1, len(SHAPES))
    order = np.asarray(got.column("order").to_pylist(), np.int64)
    return _learn(values, np.asarray(got.column("label").to_pylist(), np.int64), order % 2 == 0)


def evidence(docs: DataFrame, model: Model, key: str, host: Column, path: Column, text: str = "text") -> DataFrame:
    """(id, host, path, evidence)"""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        m = shared.value
        for part in tx.slices(batches):
            margin = _margin(_binned(shapes(part), m.edges), m.weights, m.intercept)
            value = m.evidence[np.searchsorted(m.margins, margin, side="right")]
            yield pa.RecordBatch.from_arrays([*(part.rows.column(c) for c in ("id", "host", "path")), pa.array(value)],
                                             ["id", "host", "path", "evidence"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(judged, f"id {kind}, host string, path string, evidence double")


def strength(sites: DataFrame, rate: Column) -> float:
    """How many documents the prior of a site weighs, from sites (n, k): their spread around ``rate`` beyond chance.

    With variance v = m (1 - m) / (1 + s) between sites of rate m, the weighted squares of k / n - m have the expectation
    m (1 - m) (1 + (n - 1) / (1 + s)) / n.
    """
    m = rate
    chance = m * (1 - m)
    some = sites.where("n >= 2").agg(
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - m, 2)), F.sum(chance), F.sum(chance * (F.col("n") - 1))).first()
    if some[0] is None or not some[2]:
        return 1e6
    between = (some[0] - some[1]) / some[2]
    return float(np.clip(1 / np.clip(between, 1e-6, 1.0) - 1, 0.5, 1e6))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def posteriors(docs: DataFrame, labels: DataFrame, model: Model, host: Column, path: Column, key: str = "doc_id",
               text: str = "text", label: str = "quality") -> DataFrame:
    """(key, host, path, evidence, host_rate, path_rate, score), one row per row of ``docs``."""
    known = labelled(docs, labels, key, label)
    share = known.agg(F.avg("_label"), F.count("*")).first()
    prior = float(np.clip(((share[0] or 0.0) * share[1] + 1) / (share[1] + 2), 1e-3, 1 - 1e-3))
    soft = 1 / (1 + F.exp(-(F.col("evidence") + float(np.log(prior / (1 - prior))))))
    judged = evidence(docs, model, key, host, path, text)
    rows = stored(judged.join(known, judged["id"] == known["_key"], "left").withColumn(
        "k", F.coalesce(F.col("_label").cast("double"), soft)).drop("_key", "_label"), "quality-evidence")
    paths = stored(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("k").alias("k")), "quality-paths")
    hosts = paths.groupBy(F.col("host").alias("_host")).agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
    total = hosts.agg(F.coalesce(F.sum("hk"), F.lit(0.0)), F.coalesce(F.sum("hn"), F.lit(0))).first()
    rate = float(np.clip((total[0] + prior) / (total[1] + 1), 1e-4, 1 - 1e-4))
    between_hosts = strength(hosts.select(F.col("hn").alias("n"), F.col("hk").alias("k")), F.lit(rate))
    tree = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
    drawn = (F.col("hk") + between_hosts * rate) / (F.col("hn") + between_hosts)
    between_paths = strength(tree.where("n < hn"), drawn)
    sites = tree.select("_host", F.col("path").alias("_path"), "n", F.col("k").alias("pk"), "hn", "hk")
    both = rows.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    host_rate = (F.col("hk") - F.col("k") + between_hosts * rate) / (F.col("hn") - 1 + between_hosts)
    path_rate = (F.col("pk") - F.col("k") + between_paths * F.col("host_rate")) / (F.col("n") - 1 + between_paths)
    inside = lambda p: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return both.withColumn("host_rate", inside(host_rate)).withColumn("path_rate", inside(path_rate)).select(
        F.col("id").alias(key), "host", "path", "evidence", "host_rate", "path_rate",
        (1 / (1 + F.exp(-(_logit(F.col("path_rate")) + F.col("evidence"))))).alias("score"))


def url_host(url: str) -> Column:
    """Host of an address, for tables that have one."""
    return F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(url: str) -> Column:
    """First part of an address's path."""
    return F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^/?#]*)", 1)
