from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from pulsemark.llm import caps, minhash, suffixes
from pulsemark.llm.graph import components


def joined(n, links):
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 90)] + [(100, 101), (101, 102), (102, 100), (110, 110)]
    links += [(rng.randrange(120, 200), rng.randrange(120, 200)) for _ in range(60)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    want = joined(200, links)
    assert {r["node"]: r["root"] for r in got.collect()} == {x: want[x] for a, b in links if a != b for x in (a, b)}


def brute_sets(texts, k):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    return out


def near_texts(seed, groups=25, size=6):
    """Groups of near copies around the threshold, exact copies, and texts on their own."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, size)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own).upper() if rng.random() < 0.3 else "  ".join(own))
    return [*texts, *texts[:5], None, "", " \n", "one", "ONE", "one two"]


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_minhash_agrees_with_all_pairs(spark, k, percent):
    texts = near_texts(k)
    sets = brute_sets(texts, k)
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = joined(len(sets), links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, k=k, percent=percent).collect()}
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in range(len(sets))] == [
        (len(s), want[i], want[i] == i) for i, s in enumerate(sets)]
    kept = {r["doc_id"] for r in minhash.deduplicated(docs, k=k, percent=percent).collect()}
    assert kept == {i for i, w in enumerate(want) if w == i}


def test_a_large_group_of_near_copies_and_stragglers(spark):
    """Copies of one text, each with edits of its own: most are near the text, not near each other."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base)]
    for i in range(220):
        own = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            own[rng.randrange(60)] = f"x{i}y{rng.randrange(9)}"
        texts.append(" ".join(own))
    sets = brute_sets(texts, 3)
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = joined(len(sets), links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, k=3, percent=85).collect()}
    assert [got[i] for i in range(len(sets))] == want
    assert 1 < len(set(want)) < len(want)


def test_minhash_of_odd_rows(odd, none):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == 9
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] == 5} == {(5, 5, True)}
    assert [r["n_shingles"] for r in got if r["doc_id"] in (1, 2, 6)] == [0, 0, 0]
    kept = minhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "5", "6", "7", "None", "None"]
    assert minhash.near_duplicates(none).count() == 0 == minhash.deduplicated(none).count()


def test_rows_that_share_an_id_are_judged_on_their_own(spark):
    """Unrelated texts of one id both stay, whatever the order; of near copies without an id one stays."""
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, one, 0), (1, two, 1), (2, one + " end", 2), (None, two + " end", 3), (None, "x y", 4), (None, "x y", 5),
            (3, None, 6), (3, None, 7), (3, "", 8), (1, one, 9)]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int").repartition(parts)
        kept = sorted((str(r["doc_id"]), str(r["text"])) for r in minhash.deduplicated(docs).select("doc_id", "text").collect())
        assert kept == sorted([("1", one), ("1", two), ("None", "x y"), ("3", "None"), ("3", "None"), ("3", "")])


def brute_links(rows, cosine=0.98):
    ok = [v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine:
                    links.append((j, i))
    return links


def test_caps_find_nearly_every_link_and_no_other(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(60):
        base = rng.standard_normal(64)
        for _ in range(rng.integers(1, 7)):
            rows.append((base + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.2, 0.3])).astype(np.float32).tolist())
    rows += rows[:10] + [None, [], [0.0] * 64, [float("nan")] * 64, [None] * 64, [float("inf")] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v, None if i % 17 == 0 else i // 90) for i, v in enumerate(rows)]
    links = brute_links(rows)
    got = caps.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"))
    got = {r["vec_id"]: r for r in got.collect()}
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert sum(count) > 100
    assert all(got[i]["n_links"] <= count[i] for i in range(len(rows)))
    assert sum(got[i]["n_links"] for i in range(len(rows))) >= 0.99 * count.sum()
    want = joined(len(rows), links)
    assert np.mean([got[i]["component_id"] == want[i] for i in range(len(rows))]) > 0.99
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in range(len(rows)))


def test_caps_of_nothing_and_of_rows_without_id(spark):
    kind = "vec_id bigint, embedding array<float>, label int, node string, rows int"
    assert caps.near_duplicates(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, [1.0, 0.0], 1, "n", 3), (None, [1.0, 0.0], 1, "n", 3), (3, [2.0, 0.0], 1, "n", 3), (None, None, 1, "n", 3)]
    got = caps.near_duplicates(spark.createDataFrame(rows, kind)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == [
        ("3", 2, "3", True), ("None", 0, "None", True), ("None", 2, "3", False), ("None", 2, "3", False)]


def test_decoding_lists_every_filter_above_the_threshold():
    rng = np.random.default_rng(1)
    units = rng.standard_normal((40, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for directions in (8, 64):
        row, name = caps.decode(units, directions)
        turn, (one, two) = caps.code(16, directions)
        turned = units @ turn
        every = ((turned[:, :8] @ one.T)[:, :, None] + (turned[:, 8:] @ two.T)[:, None, :]).reshape(40, -1) / np.sqrt(2)
        for i in range(40):
            own = set(name[row == i].tolist())
            above = set(np.flatnonzero(every[i] >= caps.threshold(directions) / 4).tolist())
            assert above <= own and (len(above) >= caps.LEAST) <= (above == own) and len(own) >= caps.LEAST


@pytest.mark.parametrize("size, n", [(64, 500), (64, 4000), (64, 20_000), (16, 4000), (256, 2000)])
def test_compared_pairs_and_recall_as_rows_grow(size, n):
    """What a vector is compared with does not grow with the rows; pairs just above the threshold still meet."""
    rng = np.random.default_rng(size + n)
    units = rng.standard_normal((n, size))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    directions = caps.code_size(n)
    row, name = caps.decode(units, directions)
    lists = np.bincount(name)
    assert (lists * (lists - 1.0)).sum() / n < 4 * caps.WANTED * caps.LIST
    # partners at a cosine of 0.98 to 0.981
    some = units[:400]
    off = rng.standard_normal(some.shape)
    off -= (off * some).sum(1, keepdims=True) * some
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cosine = rng.uniform(0.98, 0.981, (400, 1))
    other, its = caps.decode(cosine * some + np.sqrt(1 - cosine ** 2) * off, directions)
    met = [bool(set(name[row == i]) & set(its[other == i])) for i in range(400)]
    assert np.mean(met) >= 0.99


def brute_trim(texts, span=suffixes.SPAN):
    raw, seen = [(t or "").encode() for t in texts], {}
    for i, b in enumerate(raw):
        for s in range(len(b) - span + 1):
            seen.setdefault(b[s:s + span], []).append((i, s))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        for i, s in places if len(places) > 1 else ():
            gone[i][s:s + span] = b"\1" * span
    out = []
    for b, g in zip(raw, gone):
        kept = bytes(x for x, y in zip(b, g) if not y)
        out.append((len(b), sum(g), sum(g[i] and not (i and g[i - 1]) for i in range(len(g))), hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abcdefgh éü") for _ in range(n))
    shared = [letters(n) for n in (150, 190, 199, 200, 201, 230, 320, 700)]
    texts = []
    for _ in range(60):
        text = letters(rng.randrange(0, 300))
        for _ in range(rng.randrange(0, 4)):
            own = rng.choice(shared)
            cut = rng.randrange(0, 40)
            text += own[cut:] + letters(rng.randrange(0, 60))
        texts.append(text)
    return [*texts, texts[3], texts[4] + "x", "ab" * 400, "a" * 450, "a" * 199, "a" * 200, None, "", "z" * 201]


@pytest.mark.parametrize("run", [suffixes.RUN, 3])
def test_suffixes_agree_with_all_strings(spark, monkeypatch, run):
    """Also with nearly every beginning settled by counting."""
    monkeypatch.setattr(suffixes, "RUN", run)
    texts = passages(run)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.trim(docs).collect()}
    want = brute_trim(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[1] for w in want) > 1000


def test_suffixes_of_odd_rows(spark, odd, none):
    got = suffixes.trim(odd).collect()
    assert len(got) == 9 and {r["n_removed"] for r in got if r["doc_id"] in (1, 2, 5, 6)} == {0}
    assert suffixes.trim(none).count() == 0
    cut = suffixes.trimmed(odd)
    assert cut.columns == odd.columns and cut.count() == 9
    twice = spark.createDataFrame([(1, "q" * 100 + "r" * 150)] * 2 + [(None, "s" * 10)], "doc_id bigint, text string")
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in suffixes.trim(twice).collect()) == [("1", 250), ("1", 250), ("None", 0)]
    assert sorted(r["text"] for r in suffixes.trimmed(twice).collect()) == ["", "", "s" * 10]


def test_levels_merge_like_a_counter(spark):
    index = suffixes.Levels()
    sizes = []
    for i in range(5):
        index.add(spark.createDataFrame([(i, i, 0), (9, 100 + i, 0)], "seed bigint, row bigint, at int"))
        sizes.append([s for s, _ in index.levels])
    assert sizes == [[0], [0, 0], [1, 0], [1, 0, 0], [2, 0]]
