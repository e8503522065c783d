from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from pulsemark.llm import text as tx


def parts(texts, limit=1 << 20):
    return list(tx.slices(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]), limit=limit))


def test_slices_cover_all_rows_in_order():
    texts = ["a" * n for n in (5, 0, 100, 3, 3)] + [None]
    got = [t for p in parts(texts, 10) for t in p.rows.column("text").to_pylist()]
    assert got == texts
    assert all(len(p.data) <= 10 or p.rows.num_rows == 1 for p in parts(texts, 10))


def test_words_and_shingles_are_those_of_each_text():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\té") for _ in range(rng.randrange(40))) for _ in range(300)] + [None, ""]
    for part in parts(texts, 200):
        found = tx.words(part.data, part.offsets)
        hashes = tx.word_hashes(part.data, found)
        made, first = tx.shingles(hashes, found.first, 3)
        seen = {}
        for i, text in enumerate(part.rows.column("text").to_pylist()):
            want = (text or "").encode().split()
            raw = part.data.tobytes()
            own = [raw[s:e] for s, e in zip(found.starts, found.ends)][found.first[i]:found.first[i + 1]]
            assert own == want
            grams = [tuple(want[j:j + 3]) for j in range(max(1, len(want) - 2))] if want else []
            assert len(grams) == first[i + 1] - first[i]
            for gram, h in zip(grams, made[first[i]:first[i + 1]].tolist()):
                assert seen.setdefault(gram, h) == h
        assert len(set(seen.values())) == len(seen)


def test_substring_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"abcabcab", np.uint8)
    sums = tx.prefix_sums(data)
    a, b, c = tx.substring_hashes(sums, np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert a == b != c
