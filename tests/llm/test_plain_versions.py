"""Operators without SQL against plain Python that follows their definition."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemark.llm import pii, quality, toxicity

DOCS = "doc_id bigint, text string"


def grams(text):
    """Distinct buckets of the n-grams of a text's lower-cased bytes, one n-gram at a time."""
    b = bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())
    out = set()
    for n in toxicity.ORDERS:
        for i in range(len(b) - n + 1):
            h = b[i]
            for x in b[i + 1:i + n]:
                h = ((h ^ (h >> 13)) * 0x85EBCA77 + x * 0x9E3779B1) % (1 << 32)
            out.add(((h * 0xC2B2AE3D) % (1 << 32)) >> (32 - toxicity.BITS))
    return out


def some_texts(seed, n=60):
    rng = random.Random(seed)
    words = ["you", "Fool", "go", "AWAY", "é", "nice", "day", "0", "\n"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(n)] + [None, "", "abc", "abcd"]


def test_toxicity_scores_one_text_at_a_time(spark):
    rng = np.random.default_rng(5)
    model = toxicity.Model((rng.standard_normal(toxicity.BUCKETS) * (rng.random(toxicity.BUCKETS) < 0.7)).astype(np.float32), -0.3)
    texts = some_texts(1)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3), model).collect()}
    for i, text in enumerate(texts):
        margin = model.intercept + sum(float(model.weights[b]) for b in grams(text))
        assert math.isclose(got[i], 1 / (1 + math.exp(-margin)), rel_tol=1e-6), text


def test_toxicity_learns_the_ratios_of_the_counted_features(spark):
    texts = some_texts(2, 120)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(2)
    marks = {i: int(i % 3 == 0) for i in range(0, 90)}
    labels = spark.createDataFrame(list(marks.items()), "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    ones, zeros = np.zeros(toxicity.BUCKETS), np.zeros(toxicity.BUCKETS)
    for i, mark in marks.items():
        for b in grams(texts[i]):
            (ones if mark else zeros)[b] += 1
    n1, n0 = ones.sum() + toxicity.BUCKETS, zeros.sum() + toxicity.BUCKETS
    for b in np.flatnonzero(ones + zeros).tolist():
        ratio = math.log((ones[b] + 1) / n1) - math.log((zeros[b] + 1) / n0)
        error = toxicity.ERRORS * math.sqrt(1 / (ones[b] + 1) + 1 / (zeros[b] + 1))
        # a feature that chance explains has no weight
        assert (model.weights[b] == 0) if abs(ratio) <= error else True
    assert np.flatnonzero(model.weights[(ones + zeros) == 0]).size == 0


def spread(sites, rate):
    """How many documents a prior weighs, from (n, k) and the rate of each."""
    top = chance = left = 0.0
    for (n, k), m in zip(sites, rate, strict=True):
        if n >= 2:
            top += n * (k / n - m) ** 2
            chance += m * (1 - m)
            left += m * (1 - m) * (n - 1)
    if not left:
        return 1e6
    return min(max(1 / min(max((top - chance) / left, 1e-6), 1.0) - 1, 0.5), 1e6)


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_posteriors_recomputed_document_by_document(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(240):
        host = rng.choice(["a", "a", "a", "b", "c", None, f"rare{i}"])
        text = "Some words, and then more of them.\n" * rng.randrange(1, 6) if rng.random() < 0.6 else "### " * rng.randrange(1, 40)
        rows.append((i, text, host, rng.choice(["x", "y", None])))
    marks = {i: int(len(rows[i][1]) % 2) for i in range(0, 200, 3)}
    docs = spark.createDataFrame(rows, DOCS + ", source string, lang string").repartition(3)
    labels = spark.createDataFrame([*marks.items(), (10_000, 1)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    made = {r["doc_id"]: r for r in quality.posteriors(docs, labels, model, F.col("source"), F.col("lang")).collect()}
    share = sum(marks.values()) / len(marks)
    prior = min(max((share * len(marks) + 1) / (len(marks) + 2), 1e-3), 1 - 1e-3)
    k, hosts, paths = {}, {}, {}
    for i, _, host, path in rows:
        k[i] = marks.get(i, 1 / (1 + math.exp(-(made[i]["evidence"] + math.log(prior / (1 - prior))))))
        for held, name in ((hosts, host), (paths, (host, path))):
            n, total = held.get(name, (0, 0.0))
            held[name] = n + 1, total + k[i]
    rate = min(max((sum(t for _, t in hosts.values()) + prior) / (len(rows) + 1), 1e-4), 1 - 1e-4)
    s_host = spread(hosts.values(), [rate] * len(hosts))
    drawn = {h: (t + s_host * rate) / (n + s_host) for h, (n, t) in hosts.items()}
    inner = [(v, drawn[h]) for (h, _), v in paths.items() if v[0] < hosts[h][0]]
    s_path = spread([v for v, _ in inner], [m for _, m in inner])
    for i, _, host, path in rows:
        (hn, ht), (pn, pt) = hosts[host], paths[host, path]
        clip = lambda p: min(max(p, 1e-6), 1 - 1e-6)
        host_rate = (ht - k[i] + s_host * rate) / (hn - 1 + s_host)
        path_rate = (pt - k[i] + s_path * clip(host_rate)) / (pn - 1 + s_path)
        odds = math.log(clip(path_rate) / (1 - clip(path_rate))) + made[i]["evidence"]
        got = made[i]
        assert math.isclose(got["host_rate"], clip(host_rate), rel_tol=1e-6)
        assert math.isclose(got["path_rate"], clip(path_rate), rel_tol=1e-6)
        assert math.isclose(got["score"], 1 / (1 + math.exp(-odds)), rel_tol=1e-6)


# the base patterns as the operator's contract states them
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for nth, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            fine = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append((m.start(), nth, kind, m.end()))
    return sorted(out)


def test_pii_digest_holds_the_base_spans(spark):
    rng = random.Random(6)
    pieces = ["a.b@c.de", "x@y", "10.0.0.255", "1.2.3.4.5", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123456-78",
              "+1", "é", "DE89 3704 0044 0532 0130 00", "tel", " ", "\n", "@", ".", "5500000000000004", "😀"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(9))) for _ in range(300)] + [None, ""]
    got = {r["doc_id"]: r for r in pii.digest(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(2)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = base_spans(text)
        named = [f"{kind}:{start}:{end}" for start, _, kind, end in want]
        assert [got[i][f"n_{kind}"] for kind in PATTERNS] == [sum(w[2] == kind for w in want) for kind in PATTERNS]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(got[i]["spans"].split(","))
