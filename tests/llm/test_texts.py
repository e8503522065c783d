from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from pulsemark.llm import contamination, mixing, pii, toxicity
from pulsemark.llm.columns import sampled, table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def check_digit(text):
    total = 0
    for i, d in enumerate(reversed(digits(text))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute_spans(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and check_digit(m[0])]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


def test_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a1@.-+ (_2255") for _ in range(rng.randrange(60)))
        assert [s[:3] for s in pii.find(text) if s.kind in pii.BASE] == brute_spans(text), text


def test_checksums_and_context():
    assert [s.kind for s in pii.find("IBAN GB82 WEST 1234 5698 7654 32 please")] == ["iban"]
    assert pii.find("IBAN GB82 WEST 1234 5698 7654 33 please") == []
    assert [s.kind for s in pii.find("my social security number is 123-45-6789")] == ["ssn"]
    assert pii.find("part 123-45-6789") == [] == pii.find("social security 000-45-6789")
    near, far = pii.find("my card is 4111 1111 1111 1111"), pii.find("order version 4111 1111 1111 1111")
    assert near[0].score > far[0].score and far[0].kind == "card"


def test_ibans_end_where_they_should():
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"
    for iban in (de, gb, no, de.replace(" ", "")):
        for before in ("", "IBAN ", "AB12 CDEF GHIJ KLMN ", "DE89 3704 ", "(", "X1 "):
            for after in ("", " BIC COBADEFFXXX", " US account", " I am", " AND 12 MORE WORDS THAN AN ACCOUNT NUMBER HAS", ", US", " A1b", "\n12"):
                text = f"{before}{iban}{after}"
                assert [text[s.start:s.end] for s in pii.find(text) if s.kind == "iban"] == [iban], text
                assert pii.redact(text, [s for s in pii.find(text) if s.kind == "iban"]) == f"{before}[IBAN]{after}"
    text = f"{de} {gb} {no} {de}"
    assert [text[s.start:s.end] for s in pii.find(text) if s.kind == "iban"] == [de, gb, no, de]
    other = next(x for x in (f"ZZ{n:02} ABCD 1234 5678 9" for n in range(2, 99)) if pii.mod97(x))  # a country without a known length
    assert [s[1:3] for s in pii.find(f"{other} OR SO") if s.kind == "iban"] == [(0, len(other))]
    assert not [s for s in pii.find("DE89370400440532013000a DE8937040044053201300 0x") if s.kind == "iban"]


def test_redaction_joins_overlapping_spans():
    text = "mail a.b@c.de or +1 4111111111111 11 end"
    spans = [pii.Span("email", 5, 13, 1), pii.Span("phone", 17, 33, 1), pii.Span("card", 20, 36, 1)]
    assert pii.redact(text, spans) == "mail [EMAIL] or [PHONE] end"
    assert pii.redact("plain", []) == "plain"


def test_very_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "+1" * 100_000, "1." * 100_000, "A" * 300_000, "1 " * 150_000):
        pii.find(text)


def test_pii_of_odd_rows(odd, none):
    assert pii.digest(odd).count() == 9 and pii.spans(odd).count() == 9 and pii.spans(odd, to="score", keep_text=False).count() == 9
    assert pii.redacted(odd, length="n_chars").collect() == odd.collect()
    assert pii.digest(none).count() == 0 == pii.redacted(none).count()


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Resharing step by step."""
    left, open_, target = share * sum(sizes.values()), set(sizes), {}
    weight = {s: weights[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_targets_are_those_of_resharing(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = {**{f"s{i}": rng.choice([0, 10, 500, 10_000]) + rng.randrange(50) for i in range(rng.randrange(1, 12))}, None: 77, "Ü": 5}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_flight_keeps_both_sums_and_leaves_few():
    rng = np.random.default_rng(5)
    p, x, coin = rng.random(700), rng.integers(0, 4000, 700).astype(float), rng.random(700)
    done = mixing.flight(p, x, coin)
    assert np.isclose(done.sum(), p.sum()) and np.isclose(done @ x, p @ x)
    assert ((done > 0) & (done < 1)).sum() <= mixing.KEEP + 2 and ((done >= 0) & (done <= 1)).all()
    landed = mixing.landing(done, x)
    assert set(landed.tolist()) <= {0.0, 1.0} and abs(landed @ x - p @ x) < 50 and abs(landed.sum() - p.sum()) <= 1.001


def test_flight_takes_each_row_as_often_as_it_should():
    p, x = np.array([0.25] * 40), np.arange(40.0)
    taken = np.mean([mixing.landing(mixing.flight(p, x, c, keep=0), x) for c in np.random.default_rng(6).random((400, 40))], axis=0)
    assert abs(taken.mean() - 0.25) < 0.02 and taken.max() < 0.5


@pytest.mark.parametrize("block", [mixing.BLOCK, 40])
def test_every_source_comes_near_its_target(spark, block):
    """Also level by level, with small blocks."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    rows = mixing.mix(docs, block=block).collect()
    assert rows and all(0 <= r["copies"] <= 2 for r in rows)
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[r["source_size"]] += r["copies"] * r["size"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - target[s]) < 0.01 * target[s] for s in target)


def test_mixing_of_odd_rows_and_reruns(odd, none):
    first, again = mixing.mix(odd).collect(), mixing.mix(odd.repartition(4)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again)) and len(first) == 9
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r["copies"] for r in first)
    assert mixing.mix(none).count() == 0 == mixing.mixed(none).count()


def words(text):
    return [w for w in re.split(rb"[^a-z0-9\x80-\xff]+", (text or "").encode().lower()) if w]


def weighed(own):
    return collections.Counter(tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))) if own else collections.Counter()


def brute_matches(docs, items):
    """Best similarity of any window of each item's length."""
    out = {}
    for d, text in docs:
        own = words(text)
        for i, item in items:
            want = words(item)
            goal = weighed(want)
            for at in range(len(own) - len(want) + 1) if want else ():
                have = weighed(own[at:at + len(want)])
                both = sum((have & goal).values())
                s = both / (sum(have.values()) + sum(goal.values()) - both)
                if s >= contamination.SIMILARITY:
                    out[d, i] = max(out.get((d, i), 0), s)
    return out


def test_contamination_agrees_with_all_windows(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 9, 30, 30, 61])))) for i in range(30)]
    items += [(30, None), (31, ""), (32, items[5][1]), (33, "so so so so so so so so so")]
    docs = []
    for d in range(150):
        own = [word() for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(3)):
            passage = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randrange(3)):
                if passage:
                    passage[rng.randrange(len(passage))] = word()
            own[rng.randrange(len(own) + 1):0] = passage
        docs.append((d, (", " if d % 2 else " ").join(own).upper()))
    docs += [(150, None), (151, ""), (152, docs[3][1]), (153, "So so. so so so so so so so so so")]
    want = brute_matches(docs, items)
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (contamination.SLICE, 10):  # one slice of items, and several
        monkeypatch.setattr(contamination, "SLICE", size)
        got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contamination.contaminated(left, right).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    kept = {r["doc_id"] for r in contamination.clean(left, right).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def brute_whole(docs, items):
    """Similarity of documents as they are to items of more words."""
    out = {}
    for d, text in docs:
        have = weighed(words(text))
        for i, item in items:
            goal = weighed(words(item))
            both = sum((have & goal).values())
            if len(words(text)) < len(words(item)) and both:
                s = both / (sum(have.values()) + sum(goal.values()) - both)
                if s >= contamination.SIMILARITY:
                    out[d, i] = s
    return out


def test_documents_shorter_than_the_item_are_compared_whole(spark, monkeypatch):
    rng = random.Random(11)
    texts = [[f"v{rng.randrange(300)}" for _ in range(n)] for n in (59, 59, 6, 9, 30, 200, 5, 3)] + [["so"] * 40]
    texts.append([*texts[1][:-1], "other"])  # items that share most of their shingles
    items = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(90, None)]
    docs = []
    for t in texts:
        for cut in range(0, len(t) // 4 + 2):
            for own in (t[cut:], t[:len(t) - cut], t[cut // 2:len(t) - cut + cut // 2], [*t[:9], *t[9 + cut:]]):
                docs.append((len(docs), ", ".join(own).title()))
    want = brute_matches(docs, items)
    short = brute_whole(docs, items)
    assert not set(want) & set(short) and short[4, 0] == 54 / 55 and min(short.values()) == 0.8
    want |= short
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    right = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (contamination.SLICE, 4):
        monkeypatch.setattr(contamination, "SLICE", size)
        got = {(r["doc_id"], r["item_id"]): r for r in contamination.contaminated(left, right).collect()}
        assert got.keys() == want.keys() and all(abs(got[k]["similarity"] - want[k]) < 1e-9 for k in want)
        assert all(got[k]["first_word"] == 0 and got[k]["words"] == len(words(docs[k[0]][1])) for k in short)
    kept = {r["doc_id"] for r in contamination.clean(left, right).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_every_fingerprint_within_the_radius_is_found():
    rng = random.Random(7)
    texts = [" ".join(f"q{rng.randrange(10_000)}" for _ in range(20)) for _ in range(50)]
    index = contamination.build(list(range(50)), texts)
    prints = []
    for i in range(50):
        flips = rng.sample(range(64), contamination.RADIUS)
        prints.append(int(index.prints[i]) ^ sum(1 << b for b in flips))
    window, item = contamination.near_items(index, np.array(prints, np.uint64), 20)
    assert {(i, i) for i in range(50)} <= set(zip(window.tolist(), item.tolist()))


def test_no_window_near_the_least_similarity_is_missed():
    """Whatever its fingerprint: some of these differ from their item's by more than the radius."""
    rng = random.Random(13)
    texts = [[f"q{rng.randrange(5000)}" for _ in range(49)] for _ in range(120)]
    index = contamination.build(list(range(len(texts))), [" ".join(t) for t in texts])
    docs = []
    for t in texts * 5:
        changed = list(t)
        changed[rng.choice([0, 1, 47, 48])] = "other"  # few shingles hold it
        changed[rng.choice([2, 3, 45, 46])] = "another"
        docs.append(" ".join(changed))
    batch = contamination.pa.RecordBatch.from_arrays([contamination.pa.array(docs)], ["text"])
    far, got = 0, {}
    at = 0
    for part in contamination.tx.slices(iter([batch])):
        got |= {(at + r, i): s for r, i, _, _, s in contamination.matches(index, part)}
        at += part.rows.num_rows
    want = {}
    for d, text in enumerate(docs):
        want |= {(d, d % 120): s for s in brute_matches([(0, text)], [(0, " ".join(texts[d % 120]))]).values()}
        print_ = contamination.build([0], [text]).prints[0]
        far += (d, d % 120) in want and int(np.bitwise_count(print_ ^ index.prints[d % 120])) > contamination.RADIUS
    assert far and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_contamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "same text twice", 3), (None, None, 4), (3, "w1x w2x w3x w4x w5x w6x", 5)],
                                  "item_id bigint, text string, row int")
    got = contamination.contaminated(odd, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(5, 1), (4, 3)}
    kept = contamination.clean(odd, items)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "6", "7", "None", "None"]
    assert contamination.contaminated(none, items).count() == 0 == contamination.contaminated(odd, items.limit(0)).count()


def test_pipeline_on_a_small_table(spark):
    """Each stage against its operator's plain version, on what the stage before it left."""
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    columns = docs.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, folder)
        left[name] = docs.collect()
        assert docs.columns == columns
        if name == "toxicity":
            model = toxicity.fit(spark.createDataFrame(before, docs.schema), table(spark, folder, "labels"))
            scored = toxicity.score(spark.createDataFrame(before, docs.schema), model).where("score < 0.5")
            assert {r["doc_id"] for r in scored.collect()} == {r["doc_id"] for r in left[name]}
        elif name == "near_dedup":
            sets = {r["doc_id"]: frozenset(zip(*[r["text"].encode().lower().split()[i:] for i in range(5)])) for r in before}
            kept = {r["doc_id"] for r in left[name]}
            for a in sets:
                linked = [b for b in sets if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
                assert not linked or a not in kept or all(b not in kept for b in linked)
            assert kept <= set(sets)
        elif name == "decontamination":
            found = brute_matches([(r["doc_id"], r["text"]) for r in before],
                                  [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()])
            assert {r["doc_id"] for r in left[name]} == {r["doc_id"] for r in before} - {d for d, _ in found}
        elif name == "pii":
            clean = {r["doc_id"]: r for r in left[name]}
            assert all(not brute_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in clean.values())
            assert all(clean[r["doc_id"]]["text"] == r["text"] for r in before if not brute_spans(r["text"]))
        else:
            copies = collections.Counter(r["doc_id"] for r in left[name])
            assert set(copies) <= {r["doc_id"] for r in before} and max(copies.values()) <= 2
            size = {r["doc_id"]: len(r["text"].split()) for r in before}
            total = sum(size[d] * n for d, n in copies.items())
            assert abs(total - 1.5 * sum(size.values())) < 0.03 * total
        docs = spark.createDataFrame(left[name], docs.schema)


def test_pipeline_of_odd_rows(odd, none, spark, tmp_path, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing in common")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, none):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == odd.columns
            docs.count()


def test_rows_are_cleaned_by_their_text_not_by_their_id(spark):
    """A contaminated row goes without an id too; a clean one stays though its id is that of a contaminated one."""
    item = " ".join(f"q{i}" for i in range(30))
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(1, f"before {item} after", "a"), (1, "a clean text of its own", "b"), (None, item, "c"), (None, "clean as well", "d"),
            (None, None, "e"), (2, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, a string").repartition(3)
    got = contamination.clean(docs, benchmark)
    assert got.columns == docs.columns and sorted(r["a"] for r in got.collect()) == ["b", "d", "e", "f"]


def test_labels_of_absent_texts_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50, 60)] + [(50, "second"), (None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 if i % 2 else 0) for i in range(60)] + [(51, 0), (None, 1)], "doc_id bigint, toxic int")
    got = sampled(docs, labels, "doc_id", "text", "toxic", 4).collect()
    ones, zeros = ([r["_key"] for r in got if r["_label"] == v] for v in (1, 0))
    assert len(ones) == len(zeros) == 4 and all(k >= 50 and k % 2 for k in ones) and all(k >= 50 and k % 2 == 0 for k in zeros)
    assert len({r["_key"] for r in got}) == 8
