from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsemark.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string"
ODD = ["", " ", "  ", "   ", "a", " a", "a ", "a  ", "\n", "a\nb", "\t x", "▁", "▁▁a", "a▁b ▁ c", "é ü 中文 字", "😀😀 👩‍👩‍👧",
       "a\x00b \x01", "<s> </s> <unk> <0x41>", "x" * 300, " " * 200 + "y", "　   z", "é", "﻿q", None]


def library(texts):
    processor = pieces.loaded(MODEL)
    ids = [processor.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    return [(i, processor.decode(i)) for i in ids]


def ours(spark, texts, parts=3):
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(parts)
    made = {r["doc_id"]: r for r in pieces.encoded(rows, MODEL).collect()}
    assert sorted(made) == list(range(len(texts)))
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in made.values())
    return [(np.frombuffer(made[i]["ids"], "<u4").tolist(), made[i]["decoded"]) for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\nab.é1"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_marked_words_carry_every_text(texts):
    raw = [t.encode() for t in texts]
    words, first = pieces.marked_words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    words = words.to_pylist()
    for i, t in enumerate(texts):
        own = words[first[i]:first[i + 1]]
        assert b"".join(own).decode() == ((" " + t).replace(pieces.MARK, " ") if t else "")
        ids = np.frombuffer(b"".join(pieces._segment(MODEL, own)), "<u4").tolist()
        assert ids == pieces.loaded(MODEL).encode(t)


def test_texts_agree_with_the_library(spark, monkeypatch):
    rng = random.Random(4)
    syllables = ["ba", "Ko", "ti", "é", "1", ".", "的", "ing", "\n"]
    texts = ODD + ["".join(rng.choice([*syllables, " ", " ", "  "]) for _ in range(rng.randrange(200))) for _ in range(150)]
    texts += ["the same text again and again"] * 200 + [" ".join(f"w{rng.randrange(5000)}" for _ in range(40_000)), "z" * 50_000]
    want = library(texts)
    assert ours(spark, texts) == want
    monkeypatch.setattr(pieces, "BUCKETS", 3)
    assert ours(spark, texts, 1) == want


def test_each_word_of_a_bucket_is_segmented_once(monkeypatch):
    asked = []
    segment = pieces._segment
    monkeypatch.setattr(pieces, "_segment", lambda model, words: asked.extend(words) or segment(model, words))

    def rows(name):
        own = [b" the", b" cat"]
        body = pieces._packed(np.array([4, 4]))
        return name, 5, 2, len(body).to_bytes(8, "little") + body + pieces.pa.compress(b"".join(own), codec="zstd", asbytes=True)

    made = list(pieces._segmented(iter([pieces._sent([rows(1), rows(2)]), pieces._sent([rows(3)])]), MODEL))
    assert asked == [b" the", b" cat"] and len(made) == 3


def test_odd_rows(spark, odd, none):
    made = pieces.encoded(odd, MODEL).collect()
    assert len(made) == odd.count() and pieces.encoded(none, MODEL).count() == 0
    want = sorted((str(r["doc_id"]), ids, text) for r, (ids, text) in
                  zip(odd.collect(), library([r["text"] for r in odd.collect()]), strict=True))
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in made) == want


def test_models_that_cannot_be_cut_are_refused(monkeypatch):
    from sentencepiece import sentencepiece_model_pb2

    def changed(change):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(pieces.loaded(MODEL).serialized_model_proto())
        change(proto)

        class Fake:
            def serialized_model_proto(self):
                return proto.SerializeToString()

        monkeypatch.setitem(pieces._LOADED, "other", Fake())
        pieces.check_model("other")

    changed(lambda p: None)
    for change in (lambda p: setattr(p.pieces[400], "piece", "of▁the"), lambda p: setattr(p.normalizer_spec, "remove_extra_whitespaces", True)):
        with pytest.raises(ValueError, match="model"):
            changed(change)


def test_query_digests(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op12_pieces"](spark, folder).collect()
    assert len(got) == len(texts)
    want = dict(zip(texts, library(texts.values()), strict=True))
    for r in got:
        ids, text = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
