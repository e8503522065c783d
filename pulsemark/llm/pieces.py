"""SentencePiece encoding and decoding by a table of distinct marked words.

Where no piece of the model holds a white-space marker behind another character, no merge crosses the start of a run of
markers. A text then falls into marked words (markers and what follows them), and its ids are those of its words in order.

One scan codes each slice of texts as numbers of its distinct words. The words go to buckets by their hash, each slice's
once; a bucket segments every distinct word once, whatever number of slices have it, and sends the ids back to the slices.
There the numbers are replaced by ids, text by text, and the library decodes them. Numbers and words travel compressed; no text does. A word that makes
up a third of all positions is one entry per slice. A task holds one slice of about ``SLICE_BYTES`` (or one longer text),
or the distinct words of a bucket.

Null texts are empty; an empty text has its begin and end id only, and decodes to an empty text. Rows of equal or null ids
stay rows of their own. Other columns are not read. A model whose pieces cross markers, or that changes characters before
it segments, is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from .text import prefix_sums, slices, substring_hashes

MARK = "▁"
SLICE_BYTES = 16 << 20
BUCKETS = 64  # at least; more when the table has more than 8 partitions a bucket
_LOADED: dict[str, sentencepiece.SentencePieceProcessor] = {}
SENT = "slice bigint, bucket int, size bigint, body binary"
_SENT = pa.schema([("slice", pa.int64()), ("bucket", pa.int32()), ("size", pa.int64()), ("body", pa.binary())])
GIVEN_BYTES = 8 << 20  # of ids in one batch of results


def loaded(model: str) -> sentencepiece.SentencePieceProcessor:
    if model not in _LOADED:
        _LOADED[model] = sentencepiece.SentencePieceProcessor(model_file=model)
    return _LOADED[model]


def check_model(model: str) -> None:
    """Raises ValueError unless texts may be cut before every run of markers."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(loaded(model).serialized_model_proto())
    how = proto.normalizer_spec
    if how.precompiled_charsmap or how.remove_extra_whitespaces or not (how.add_dummy_prefix and how.escape_whitespaces):
        raise ValueError("the model changes texts before it segments them")
    if proto.trainer_spec.treat_whitespace_as_suffix or any(
            p.type in (1, 4) and re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces):
        raise ValueError("the model has pieces that cross a white-space marker")


def _compressed(body: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=9).compress(body, asbytes=True)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte (all lowest bytes first), compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _compressed(planes.tobytes())


def _unpacked(body: bytes | pa.Buffer, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(body, 4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def marked_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The marked words of each text, and per text the number of its first one (one more than texts).

    A word's first marker is left out; every text begins with one that is not written in it.
    """
    sizes = np.diff(offsets)
    full = sizes > 0
    # each text behind a blank of its own, and blanks for markers
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    text = pc.replace_substring(text, MARK.encode(), b" ")
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2], np.uint8)[at[0]:at[-1]] if data.size else np.zeros(0, np.uint8)
    at = at - at[0]
    raw = np.insert(raw, at[:-1][full], 0x20)
    at = at + np.concatenate([[0], np.cumsum(full)])
    blank = raw == 0x20
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[at[:-1][full]] = True
    begins = np.flatnonzero(begins)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [
        None, pa.py_buffer(np.append(begins, len(raw)).astype(np.int64)), pa.py_buffer(raw)])
    return words, np.searchsorted(begins, at)


def _coded(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per slice one row of word numbers (bucket -1) and a row of its distinct words for every bucket."""
    nth = 0
    for part in slices(batches, "text", SLICE_BYTES):
        name = (TaskContext.get().partitionId() << 32) + nth
        nth += 1
        words, first = marked_words(part.data, part.offsets)
        coded = words.dictionary_encode()
        numbers, distinct = coded.indices.to_numpy(), coded.dictionary
        at = np.frombuffer(distinct.buffers()[1], np.int64)[:len(distinct) + 1]
        raw = np.frombuffer(distinct.buffers()[2], np.uint8)[:at[-1]] if len(distinct) else np.zeros(0, np.uint8)
        hashes = substring_hashes(prefix_sums(raw), at[:-1], at[1:])
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        # the most frequent words of a slice get the smallest numbers
        rank = np.argsort(-np.bincount(numbers, minlength=len(distinct)), kind="stable")
        new = np.empty(len(rank), np.int64)
        new[rank] = np.arange(len(rank))
        bucket = bucket[rank]
        order = np.argsort(bucket, kind="stable")
        sink = pa.BufferOutputStream()
        keys = pa.RecordBatch.from_arrays([part.rows.column("id")], ["id"])
        with pa.ipc.new_stream(sink, keys.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(keys)
        counts = np.diff(first)
        parts = [_packed(counts), _packed(new[numbers]), _packed(bucket), sink.getvalue().to_pybytes()]
        head = np.array([len(counts), len(numbers), len(bucket), *map(len, parts)], "<i8").tobytes()
        rows = [(name, -1, len(bucket), head + b"".join(parts))]
        words_of = distinct.take(pa.array(rank[order]))
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            own = words_of.slice(edges[b], edges[b + 1] - edges[b])
            lengths = pc.binary_length(own).to_numpy()
            flat = b"".join(own.to_pylist())
            body = _packed(lengths)
            rows.append((name, b, len(own), len(body).to_bytes(8, "little") + body + _compressed(flat)))
        yield _sent(rows)


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SENT, strict=True)], schema=_SENT)


def _received(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bytes]]:
    for i in range(batch.num_rows):
        yield tuple(batch.column(c)[i].as_py() for c in range(4))


def _words_of(body: bytes, n: int) -> list[bytes]:
    size = int.from_bytes(body[:8], "little")
    ends = np.cumsum(_unpacked(body[8:8 + size], n).astype(np.int64))
    flat = pa.decompress(body[8 + size:], int(ends[-1]), codec="zstd", asbytes=True)
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _segment(model: str, words: list[bytes]) -> list[bytes]:
    """The ids of each marked word, as little-endian 32-bit numbers; the library puts the first marker in front itself."""
    processor = loaded(model)
    alone = processor.piece_to_id(MARK)
    # a word without anything behind its first marker is that marker's piece
    made = processor.encode([w[1:].decode() for w in words], num_threads=1)
    return [np.array(ids if len(w) > 1 else [alone], "<u4").tobytes() for w, ids in zip(words, made, strict=True)]


def _segmented(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket, one after the other: ids in place of words, every distinct word segmented once."""
    at, known = None, {}
    for batch in batches:
        for name, bucket, n, body in _received(batch):
            if bucket >= 0:
                if bucket != at:
                    at, known = bucket, {}
                words = _words_of(body, n)
                new = [w for w in words if w not in known]
                known.update(zip(new, _segment(model, new), strict=True))
                found = [known[w] for w in words]
                sizes, ids = _packed(np.array([len(f) // 4 for f in found])), np.frombuffer(b"".join(found), "<u4")
                body = np.array([len(sizes), len(ids)], "<i8").tobytes() + sizes + _packed(ids)
            yield _sent([(name, bucket, n, body)])


def _texts(content: bytes, buckets: dict[int, tuple[int, bytes]], begin: int, end: int) -> Iterator[tuple[pa.Scalar, np.ndarray]]:
    """The id and ids of each text of one slice, from its word numbers and the ids of its words."""
    n_rows, n_words, n_distinct, *sizes = np.frombuffer(content[:56], "<i8").tolist()
    cuts = np.cumsum([56, *sizes]).tolist()
    counts, numbers, bucket = (_unpacked(content[a:b], n) for a, b, n in zip(cuts[:3], cuts[1:4], (n_rows, n_words, n_distinct), strict=True))
    keys = pa.ipc.open_stream(content[cuts[3]:]).read_next_batch().column(0)
    lengths, flat = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
    for b in sorted(buckets):
        n, body = buckets[b]
        sent, total = np.frombuffer(body[:16], "<i8").tolist()
        lengths.append(_unpacked(body[16:16 + sent], n))
        flat.append(_unpacked(body[16 + sent:], total))
    # words lie by bucket, then by number
    order, flat = np.argsort(bucket, kind="stable"), np.concatenate(flat)
    length, start = np.zeros(n_distinct, np.int64), np.zeros(n_distinct, np.int64)
    length[order] = np.concatenate(lengths)
    start[order] = np.cumsum(length[order]) - length[order]
    at = 0
    for key, count in zip(keys, counts.tolist(), strict=True):
        own = numbers[at:at + count]
        at += count
        ends = np.cumsum(length[own])
        ids = np.empty(int(ends[-1]) + 2 if count else 2, "<u4")
        ids[0], ids[-1] = begin, end
        if count:
            ids[1:-1] = flat[np.repeat(start[own] - ends + length[own], length[own]) + np.arange(ends[-1])]
        yield key, ids


def _joined(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[tuple[pa.Scalar, np.ndarray]]:
    """Texts of slice after slice; a slice's word numbers come first, the ids of its words follow by bucket."""
    processor = loaded(model)
    ends = processor.bos_id(), processor.eos_id()
    at, content, buckets = None, b"", {}
    for batch in batches:
        for name, bucket, n, body in _received(batch):
            if name != at and at is not None:
                yield from _texts(content, buckets, *ends)
            if name != at:
                at, buckets = name, {}
            if bucket < 0:
                content = body
            else:
                buckets[bucket] = n, body
    if at is not None:
        yield from _texts(content, buckets, *ends)


def encoded(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every text.

    ``ids`` are little-endian unsigned 32-bit numbers, begin and end included; ``decoded`` is the library's text of them.
    """
    check_model(model)
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    buckets = max(BUCKETS, rows.rdd.getNumPartitions() // 8)
    sent = rows.mapInArrow(lambda batches: _coded(batches, buckets), SENT)
    # words are dealt by bucket; word numbers only pass through
    dealt = F.when(F.col("bucket") < 0, F.col("slice")).otherwise(F.col("bucket"))
    sent = sent.repartition(F.col("bucket") < 0, dealt).sortWithinPartitions("bucket").mapInArrow(lambda batches: _segmented(batches, model), SENT)

    def given(texts):
        keys, ids = zip(*texts, strict=True)
        decoded = loaded(model).decode([i.tolist() for i in ids], num_threads=1)
        return pa.RecordBatch.from_arrays([
            pa.array([k.as_py() for k in keys], keys[0].type), pa.array([len(i) for i in ids], pa.int64()),
            pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(decoded, pa.string())], [doc_id, "n_tokens", "ids", "decoded"])

    def run(batches):
        held, size = [], 0
        for one in _joined(batches, model):
            held.append(one)
            size += one[1].nbytes
            if size > GIVEN_BYTES:
                yield given(held)
                held, size = [], 0
        if held:
            yield given(held)

    kind = docs.schema[doc_id].dataType.simpleString()
    return sent.repartition("slice").sortWithinPartitions("slice", "bucket").mapInArrow(
        run, f"`{doc_id}` {kind}, n_tokens bigint, ids binary, decoded string")
