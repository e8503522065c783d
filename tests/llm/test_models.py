from __future__ import annotations

import collections
import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from pulsemark.llm import language, lm, quality, toxicity
from pulsemark.llm.columns import fold, lowest_hashes, lowest_hashes_by, table

DATA = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_texts(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    model = toxicity.fit(docs.where(fold("doc_id", 5) != 0), labels)
    found = toxicity.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(fold("doc_id", 5) == 0).collect()
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in found)
    assert len(found) > 50 and right / len(found) > 0.9
    assert all(0 <= r["score"] <= 1 for r in found)


def test_toxicity_of_odd_rows(odd, none, labels):
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model)
    assert got.columns == [*[c for c in odd.columns if c != "score"], "score"] and got.count() == 9
    empty = {r["score"] for r in got.collect() if not (r["text"] or "").strip()}
    assert len(empty) == 1
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_log_count_ratio_drops_what_chance_explains():
    ones, zeros = np.zeros(toxicity.BUCKETS), np.zeros(toxicity.BUCKETS)
    ones[:3], zeros[:3] = (200, 3, 100), (0, 0, 100)
    ratio = toxicity.log_count_ratio(ones, zeros)
    assert ratio[0] > 0 and ratio[1] == 0 == ratio[2]


def test_language_on_held_out_texts(spark):
    docs = table(spark, DATA, "documents")
    model = language.fit(docs.where(fold("doc_id", 4) != 2), per_language=60, rounds=8)
    rows = language.predict(docs.where(fold("doc_id", 4) == 2), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97
    mixed = spark.createDataFrame([(1, rows[0]["text"][:300] + " "
                                    + next(r["text"] for r in rows if r["lang"] != rows[0]["lang"])[:300])], "doc_id bigint, text string")
    assert len({r["lang_pred"] for r in language.words(mixed, model).collect()}) > 1


def test_every_language_is_learned(spark, monkeypatch):
    """More than 64, the rarest of few texts, also in many small pieces and blocks."""
    rng = random.Random(12)
    own = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 8))) for _ in range(12)] for _ in range(80)]
    docs = [(d, " ".join(rng.choice(own[lang]) for _ in range(rng.choice([10, 70, 150]))), f"l{lang:02}")
            for d, lang in enumerate(x for x in range(80) for _ in range(9 if x < 70 else 5))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(3)
    for cells, block in ((language.CELLS, language.BLOCK_BYTES), (80 * 64 * 5, 1 << 18)):
        monkeypatch.setattr(language, "CELLS", cells)
        monkeypatch.setattr(language, "BLOCK_BYTES", block)
        model = language.fit(frame, per_language=4, rounds=3)
        assert model.languages == [f"l{i:02}" for i in range(80)]
        rows = language.predict(frame, model).collect()
        assert len(rows) == len(docs)
        for rare in (False, True):
            some = [r for r in rows if (r["lang"] >= "l64") == rare]
            assert sum(r["lang_pred"] == r["lang"] for r in some) / len(some) > 0.95


def test_lowest_hashes_by_group_are_those_of_each(spark):
    rows = spark.range(5000).select("id", F.concat(F.lit("g"), F.col("id") % 7 % 4).alias("g"), F.xxhash64("id").alias("h"))
    sizes = {r["g"]: r["count"] for r in rows.groupBy("g").count().collect()}
    for limit in (50, 2000):
        got = lowest_hashes_by(rows, "g", "h", limit, sizes, "id")
        assert got.columns == rows.columns
        want = {r["id"] for g, n in sizes.items() for r in lowest_hashes(rows.where(F.col("g") == g), "h", limit, n, "id").collect()}
        assert {r["id"] for r in got.collect()} == want


def test_lowest_hashes_are_those_of_a_full_sort(spark):
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    want = [r["id"] for r in rows.orderBy("h").limit(200).collect()]
    assert [r["id"] for r in lowest_hashes(rows, "h", 200, 5000, "id").collect()] == want
    assert lowest_hashes(rows, "h", 9000, 5000, "id").count() == 5000 and lowest_hashes(rows.limit(0), "h", 5, 0).count() == 0


def test_language_of_odd_rows(spark, odd, none):
    model = language.fit(odd, rounds=2)
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(odd, model).select("doc_id", "lang_pred", "score").collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (6, "und", 0.0)} <= got
    assert all(p in ("en", "de", "fr", "und") for _, p, _ in got)
    digits = spark.createDataFrame([(1, "12 34.5")], "doc_id bigint, text string")
    assert language.predict(digits, model).first()["lang_pred"] == "und"
    assert language.predict(none, language.fit(none)).count() == 0


def test_forward_backward_agrees_with_all_paths():
    rng = np.random.default_rng(2)
    scores, moves = rng.standard_normal((5, 3)), rng.standard_normal((3, 3))
    own = language.Chains(np.zeros(5, int), None, None, None, None, np.arange(5), (1, language.CHAIN))
    marginals, pairs, norm = language.forward_backward(scores, own, moves)
    total, by, moved = 0.0, np.zeros((5, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=5):
        weight = math.exp(sum(scores[t, s] for t, s in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for t, s in enumerate(path):
            by[t, s] += weight
        for a, b in zip(path, path[1:]):
            moved[a, b] += weight
    assert np.allclose(marginals, by / total) and np.allclose(pairs, moved / total) and np.isclose(norm, math.log(total))


def brute_base(texts, learned):
    end = object()
    tokens = [(t or "").encode().lower().split() + [end] for t in texts]
    counts = collections.Counter(t for own, use in zip(tokens, learned) if use for t in own)
    n, v = sum(counts.values()), len(counts)
    return n, [(len(own), sum(counts[t] > 0 for t in own), sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)) for own in tokens]


def test_lm_base_is_exact_also_beyond_the_head(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 1024)
    rng = random.Random(1)
    texts = [" ".join(f"T{int(rng.paretovariate(0.4)) % 4000}" for _ in range(rng.randrange(80))) for _ in range(120)] + [None, "", "\t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got, model = lm.fit_and_score(docs.where("doc_id % 3 != 0"), docs)
    n, want = brute_base(texts, [i % 3 != 0 for i in range(len(texts))])
    assert model.tokens == n
    rows = {r["doc_id"]: r for r in got.collect()}
    for i, (tokens, known, base) in enumerate(want):
        assert (rows[i]["n_tokens"], rows[i]["n_known"]) == (tokens, known)
        assert math.isclose(rows[i]["base_score"], base, rel_tol=1e-9)


def test_lm_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(4)
    # every word but for some tells the next
    texts = []
    for _ in range(600):
        w = rng.randrange(50)
        own = []
        for _ in range(60):
            own.append(f"w{w}")
            w = (w * 7 + 3) % 50 if rng.random() < 0.8 else rng.randrange(50)
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    got, _ = lm.fit_and_score(docs.where("doc_id % 4 != 0"), docs)
    held = got.where("doc_id % 4 = 0").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] / held[2] > held[1] / held[2] + 0.2


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    model = lm.Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.arange(lm.OWN, 1024), np.zeros(1024),
                     np.zeros(1024, bool), rng.standard_normal(lm.CLASSES).astype(np.float32),
                     rng.standard_normal((lm.CLASSES, lm.UNITS)).astype(np.float32),
                     rng.standard_normal((lm.CLASS_ROWS, lm.CLASSES)).astype(np.float32),
                     rng.standard_normal((lm.UNIT_ROWS, lm.UNITS)).astype(np.float32), lm._begin(np.ones(lm.CLASSES)), 0, 0)
    total = 0.0
    for unit in range(1024):  # one history, every unit as what comes next
        token = np.array([5, 9, 11], np.uint64)
        *_, (part, group, inner, _, _, p, q) = lm._steps(model, token, np.array([0, 3]), np.array([0, 1, unit]))
        total += p[2, group[2]] * q[2, inner[2]]
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_lm_of_odd_rows(odd, none):
    got, _ = lm.fit_and_score(odd, odd)
    rows = got.collect()
    assert len(rows) == 9 and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 6)} == {1}
    empty, model = lm.fit_and_score(none, odd)
    assert model.tokens == 0 and all(r["base_score"] == 0 and r["n_known"] == 0 for r in empty.collect())
    assert lm.fit_and_score(odd, none)[0].count() == 0


def test_quality_rates_are_drawn_towards_host_and_all(spark):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    model = quality.fit(docs, labels)
    made = quality.posteriors(docs, labels, model, F.col("source"), F.col("lang")).join(labels, "doc_id").collect()
    right = sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in made)
    assert len(made) == labels.count() and right / len(made) > 0.9
    assert all(0 < r["host_rate"] < 1 and 0 < r["path_rate"] < 1 for r in made)


def test_a_bad_host_pulls_its_documents_down(spark):
    rows = [(i, "plain words in a plain text", "good" if i < 200 else "bad" if i < 400 else "rare", "p") for i in range(401)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(0, 400, 2)], "doc_id bigint, quality int, toxic int")
    blank = quality.Model(np.zeros((len(quality.SHAPES), quality.BINS - 1)), np.zeros((len(quality.SHAPES), quality.BINS)), 0.0,
                          np.zeros(0), np.zeros(1))
    made = quality.posteriors(docs, labels, blank, F.col("source"), F.col("lang"))
    by = {r["host"]: r["s"] for r in made.where("doc_id % 2 = 1 or doc_id = 400").groupBy("host").agg(F.avg("score").alias("s")).collect()}
    assert by["bad"] < by["rare"] < by["good"] and by["bad"] < 0.4 and by["good"] > 0.6


def test_quality_of_odd_rows(odd, none, labels):
    model = quality.fit(odd, labels)
    assert quality.posteriors(odd, labels, model, F.col("source"), F.col("lang")).count() == 9
    assert quality.posteriors(none, labels, quality.fit(none, labels), F.col("source"), F.col("lang")).count() == 0


def test_addresses(spark):
    rows = spark.createDataFrame([("https://M.Example.org/en/825?page=2",), ("http://a.b#x",), (None,)], "url string")
    got = [tuple(r) for r in rows.select(quality.url_host("url"), quality.url_path("url")).collect()]
    assert got == [("m.example.org", "en"), ("a.b", ""), (None, None)]


def test_lm_partitions_of_few_tokens_share_tables(spark):
    """A task's tables have nearly the same size however few its texts: 64 small partitions do not make 64 of them."""
    docs = spark.createDataFrame([(f"a b c{i}",) for i in range(200)], "text string").repartition(64)

    def rows(model, batches):
        part = np.zeros((lm.BLOCK_ROWS, lm.CLASSES + 1), np.float32)
        part[0, :2] = 1, sum(batch.num_rows for batch in batches)
        yield 0, part

    found = lm._sum(docs, lm.start(lm.count(docs)), rows)[0][0]
    assert found[0] <= spark.sparkContext.defaultParallelism and found[1] == 200
    assert lm._tasks(spark, 1000 * lm.TASK_TOKENS) == 1000
