"""Removal of byte strings that an earlier document has, by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document
with a smaller doc_id.  Shards must see all occurrences of such a string, so texts
are cut by content: of the ``K``-byte strings inside a window of ``LENGTH`` bytes the
one with the least hash is the window's anchor.  Equal windows have equal anchors;
the windows of one anchor occurrence form a segment, and segments are dealt by
their anchor's hash.

1. Anchors are counted, as 32-bit numbers in buckets; anchors that one document
   alone holds are left out from then on.  Which are shared is told by a bit filter
   of fixed size (``FILTER_BITS``); a wrong bit costs work, never a result.
2. Segments of shared anchors are written with their place; of equal segments in a
   batch of work, one carries its bytes.
3. Shards sort the suffixes of their distinct segments by induced sorting and
   compare neighbours by permuted common prefixes: windows that share ``LENGTH``
   bytes form a class, whose smallest doc_id is the class's first document.
4. Places meet the answers by segment; windows of later documents become spans,
   and spans are cut from the text.

Defined results: null text is empty; texts shorter than ``LENGTH`` lose nothing; a
row without doc_id is in no order, it neither loses bytes nor makes others lose
them; rows that repeat a doc_id do not count as earlier for each other; an empty
table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import slices, staged, text_of, tidied
from voltframe.llm.induced import common_prefixes, suffix_array, words_at

LENGTH = 50
K = 16
#: Bytes of text that are scanned at once; longer texts are scanned in overlapping pieces.
BLOCK_BYTES = 4_000_000
#: Bits of the filter of shared anchors (16 MB); it is sent to every executor.
FILTER_BITS = 1 << 27
#: Bytes of distinct segments that one shard is meant to sort.
SHARD_BYTES = 2_000_000
#: Bytes of segments that a task holds while it packs them by shard.
PACK_BYTES = 64_000_000
_PLACE = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def segments(block: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window, end of the last window and content hash of each segment of a block.

    ``ends`` are the ends of the texts in the block; no window crosses one.
    """
    none = np.empty(0, np.int64)
    if len(block) < LENGTH:
        return none.view(np.uint64), none, none, none
    words = words_at(block)
    grams = words[:-K + 1] * np.uint64(0x9E3779B97F4A7C15)
    grams ^= grams >> np.uint64(32)
    grams += words[8:len(words) - 7] * np.uint64(0xC2B2AE3D27D4EB4F)
    grams = _mixed(grams) * np.uint64(0x9E3779B97F4A7C15)
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)  # the leftmost of equals
    span, left = 1, LENGTH - K + 1
    while span * 2 <= left:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if left > span:
        least = np.minimum(least[:span - left], least[left - span:])
    crossing = np.zeros(len(least) + 1, np.int32)
    starts = np.concatenate(([0], ends[:-1]))
    np.add.at(crossing, np.minimum(np.maximum(ends - LENGTH + 1, starts), len(least)), 1)
    np.add.at(crossing, np.minimum(ends, len(least)), -1)
    window = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
    if not len(window):
        return none.view(np.uint64), none, none, none
    anchor = (least[window] & _PLACE).astype(np.int64)
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new, [len(window)])) - 1
    a, b = window[first], window[last] + LENGTH
    # A polynomial over mixed words tells segments apart; its value does not depend on the place.
    base = np.uint64(0x9E3779B97F4A7C55)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(words) - 1, base))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(words * base) * powers)))
    back = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(words) - 1, inverse))))
    content = _mixed((sums[b - 7] - sums[a]) * back[a] + (b - a).astype(np.uint64))
    return grams[anchor[first]], a, b, content.view(np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, text ends, row numbers and offsets in the text of blocks of a batch's texts."""
    texts, ends, rows, offsets, size = [], [], [], [], 0
    for row, value in enumerate(batch.column(batch.num_columns - 1)):
        raw = value.as_py().encode()
        for at in range(0, max(1, len(raw) - LENGTH + 1), BLOCK_BYTES):
            piece = raw[at:at + BLOCK_BYTES + LENGTH - 1]
            texts.append(piece)
            size += len(piece)
            ends.append(size)
            rows.append(row)
            offsets.append(at)
            if size >= BLOCK_BYTES:
                yield np.frombuffer(b"".join(texts), np.uint8), np.array(ends), np.array(rows), np.array(offsets)
                texts, ends, rows, offsets, size = [], [], [], [], 0
    if texts:
        yield np.frombuffer(b"".join(texts), np.uint8), np.array(ends), np.array(rows), np.array(offsets)


def _bucket(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = _mixed(anchors)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), mixed.astype(np.uint32)


def _count(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, shared, anchors): packed anchors of a block that one or several of its documents have."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for block, ends, rows, _ in _blocks(batch):
            anchor, a, _, _ = segments(block, ends)
            doc = ids[rows[np.searchsorted(ends, a, side="right")]]
            bucket, short = _bucket(anchor, buckets)
            order = np.lexsort((doc, short, bucket))
            bucket, short, doc = bucket[order], short[order], doc[order]
            first = np.flatnonzero(np.concatenate(([True], (short[1:] != short[:-1]) | (bucket[1:] != bucket[:-1])))) \
                if len(short) else np.empty(0, np.int64)
            if not len(first):
                continue
            last = np.append(first[1:], len(short)) - 1
            shared = doc[first] != doc[last]
            bucket, short = bucket[first], short[first]
            out = []
            for flag in (False, True):
                b, s = bucket[shared == flag], short[shared == flag]
                cuts = np.flatnonzero(b[1:] != b[:-1]) + 1
                out += [(int(b[x]), flag, s[x:y].tobytes()) for x, y in
                        zip(np.concatenate(([0], cuts)), np.append(cuts, len(b))) if y > x]
            yield pa.record_batch([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out]),
                                   pa.array([r[2] for r in out], pa.binary())], names=["bucket", "shared", "anchors"])


def _slice_bits(buckets: int) -> int:
    return max(64, FILTER_BITS // buckets)


def _two_bits(short: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    wide = _mixed(short.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (wide % np.uint64(bits)).astype(np.int64), ((wide >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


def _shared(buckets: int, table: pa.Table) -> pa.Table:
    """The filter's slice of one bucket."""
    several = np.concatenate([np.empty(0, np.uint32), *(np.frombuffer(x.as_py(), np.uint32) for x, f in
                                                        zip(table["anchors"], table["shared"]) if f.as_py())])
    single = np.concatenate([np.empty(0, np.uint32), *(np.frombuffer(x.as_py(), np.uint32) for x in table["anchors"])])
    single.sort()
    again = single[1:][single[1:] == single[:-1]]
    bits = _slice_bits(buckets)
    held = np.zeros(bits, bool)
    for places in _two_bits(np.concatenate((several, again)), bits):
        held[places] = True
    return pa.table({"bucket": table["bucket"].slice(0, 1), "bits": pa.array([np.packbits(held).tobytes()])})


def _heads(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))


def _places(held, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of segments with shared anchors; the earliest of equal segments in a block carries the bytes."""
    filters, bits = held.value, _slice_bits(buckets)
    stride = (bits + 7) // 8
    for batch in batches:
        ids, keys = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for block, ends, rows, offsets in _blocks(batch):
            anchor, a, b, content = segments(block, ends)
            bucket, short = _bucket(anchor, buckets)
            keep = np.ones(len(anchor), bool)
            for place in _two_bits(short, bits):
                keep &= (filters[bucket * stride + (place >> 3)] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
            if not keep.any():
                continue
            anchor, a, b, content = anchor[keep], a[keep], b[keep], content[keep]
            piece = np.searchsorted(ends, a, side="right")
            doc, key = ids[rows[piece]], keys[rows[piece]]
            at = a - np.concatenate(([0], ends))[piece] + offsets[piece]
            order = np.lexsort((doc, content))
            heads = _heads(content[order])
            first, last = np.zeros(len(order), bool), np.zeros(len(order), np.int64)
            first[order[heads]] = True
            last[order[heads]] = doc[order[np.append(heads[1:], len(order)) - 1]]
            raw = block.tobytes()
            own = [raw[x:y] if f else None for x, y, f in zip(a.tolist(), b.tolist(), first.tolist())]
            yield pa.record_batch(
                [pa.array(content), pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(at, pa.int64()),
                 pa.array(anchor.view(np.int64), mask=~first), pa.array(last, mask=~first), pa.array(own, pa.binary())],
                names=["content", "doc_id", "row", "at", "anchor", "last_doc", "segment"])


def first_documents(parts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each window of each part, the smallest of ``docs`` whose part has the same bytes."""
    sizes = np.array([len(p) for p in parts], np.int64)
    text = np.frombuffer(b"".join(parts), np.uint8)
    owner = np.repeat(np.arange(len(parts)), sizes)
    ends = np.cumsum(sizes)
    words = words_at(text)
    order = suffix_array(text, words, LENGTH)
    whole = np.arange(len(text)) + LENGTH <= ends[owner]  # windows that end inside their part
    shared = common_prefixes(order, words, LENGTH)
    # Classes are runs of the order; windows that leave their part stand in no class's minimum.
    head = ~shared[order]
    run = np.cumsum(head) - 1
    doc = np.where(whole, docs[owner], np.iinfo(np.int64).max)[order]
    least = np.minimum.reduceat(doc, np.flatnonzero(head))
    first = np.empty(len(text), np.int64)
    first[order] = least[run]
    return [first[e - s:e - LENGTH + 1] for s, e in zip(sizes, ends)]


def _pack(shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with their hash, first and last document, packed by shard; equal segments once."""
    import zstandard
    packer = zstandard.ZstdCompressor(level=3)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        content, doc, anchor = (table[k].to_numpy() for k in ("content", "doc_id", "anchor"))
        last = table["last_doc"].to_numpy().copy()
        order = np.lexsort((doc, content))
        heads = _heads(content[order])
        last[order[heads]] = np.maximum.reduceat(last[order], heads)
        order = order[heads]
        shard = (_mixed(anchor[order].view(np.uint64)) % np.uint64(shards)).astype(np.int64)
        order, shard = order[np.argsort(shard, kind="stable")], np.sort(shard)
        segment = table["segment"].combine_chunks()
        starts = np.frombuffer(segment.buffers()[1], np.int32)[segment.offset:segment.offset + len(segment) + 1]
        raw = segment.buffers()[2].to_pybytes()
        cuts = np.flatnonzero(shard[1:] != shard[:-1]) + 1
        out = []
        for x, y in zip(np.concatenate(([0], cuts)), np.append(cuts, len(order))):
            own = order[x:y]
            out.append((int(shard[x]), len(own), packer.compress(b"".join([
                content[own].tobytes(), doc[own].tobytes(), last[own].tobytes(), (starts[own + 1] - starts[own]).astype(np.int64).tobytes(),
                *(raw[p:q] for p, q in zip(starts[own].tolist(), starts[own + 1].tolist()))]))))
        return pa.record_batch([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                pa.array([r[2] for r in out], pa.binary())], names=["shard", "n", "packed"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield packed(held)
            held, size = [], 0
    if any(b.num_rows for b in held):
        yield packed(held)


def _unpack(n: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(data)
    content, doc, last, sizes = (np.frombuffer(raw, np.int64, n, 8 * n * k) for k in range(4))
    ends = 32 * n + np.cumsum(sizes)
    return content, doc, last, [raw[e - s:e] for e, s in zip(ends.tolist(), sizes.tolist())]


def _classes(table: pa.Table) -> pa.Table:
    """(content, from_window, to_window, first_doc) of one shard's distinct segments, where a later document has them."""
    blobs = [_unpack(n.as_py(), p.as_py()) for n, p in zip(table["n"], table["packed"])]
    content, doc, last = (np.concatenate([b[k] for b in blobs]) for k in (0, 1, 2))
    segments_ = [s for b in blobs for s in b[3]]
    order = np.lexsort((doc, content))
    heads = _heads(content[order])
    first = order[heads]
    head = np.repeat(first, np.diff(np.append(heads, len(order))))
    if any(segments_[k] != segments_[h] for k, h in zip(order, head)):
        raise RuntimeError("two different segments share a 64-bit hash")
    last = np.maximum.reduceat(last[order], heads)
    windows = first_documents([segments_[k] for k in first], doc[first])
    sizes = np.array([len(w) for w in windows], np.int64)
    flat, owner = np.concatenate(windows), np.repeat(np.arange(len(windows)), sizes)
    begins = np.cumsum(sizes) - sizes
    run = np.flatnonzero(np.concatenate(([True], (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1]))))
    run_end = np.append(run[1:], len(flat)) - 1
    # A run that no document after its first has takes nothing from anyone.
    later = flat[run] < last[owner[run]]
    run, run_end = run[later], run_end[later]
    of = owner[run]
    return pa.table([pa.array(content[first][of]), pa.array((run - begins[of]).astype(np.int32)),
                     pa.array((run_end - begins[of]).astype(np.int32)), pa.array(flat[run])],
                    names=["content", "from_window", "to_window", "first_doc"])


def _merged(spans: list[int]) -> list[tuple[int, int]]:
    """Disjoint spans, ascending, from spans whose start and end are the halves of a number."""
    out: list[tuple[int, int]] = []
    for span in sorted(spans):
        a, b = span >> 32, span & 0xFFFFFFFF
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for doc_id, text, spans in zip(*batch.columns):
            raw = text.as_py().encode()
            runs = _merged(spans.as_py() or [])
            kept, at = [], 0
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            out.append((doc_id.as_py(), len(raw), len(raw) - len(kept), len(runs), kept))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [*[pa.int64()] * 4, pa.binary()]
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, row, spans): byte spans to remove of each row that loses any, start and end as halves of a long."""
    spark = docs.sparkSession
    rows = _keyed(docs).where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = (rows.select("doc_id", "text")
              .mapInArrow(lambda it: _count(buckets, it), "bucket bigint, shared boolean, anchors binary")
              .groupBy("bucket").applyInArrow(lambda t: _shared(buckets, t), "bucket bigint, bits binary"))
    stride = (_slice_bits(buckets) + 7) // 8
    filters = np.zeros(buckets * stride, np.uint8)
    for bucket, bits in slices.collect():  # FILTER_BITS in all, whatever the corpus
        filters[bucket * stride:bucket * stride + len(bits)] = np.frombuffer(bits, np.uint8)
    held = spark.sparkContext.broadcast(filters)
    places = staged(rows.select("doc_id", "row", "text").mapInArrow(
        lambda it: tidied(_places(held, buckets, it)),
        "content bigint, doc_id bigint, row bigint, at bigint, anchor bigint, last_doc bigint, segment binary"),
        "suffix-places")
    held.unpersist()
    own = places.where("segment is not null")
    size = own.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    packed = own.select("content", "doc_id", "anchor", "last_doc", "segment").mapInArrow(
        lambda it: tidied(_pack(shards, it)), "shard bigint, n bigint, packed binary")
    classes = staged(packed.groupBy("shard").applyInArrow(
        _classes, "content bigint, from_window int, to_window int, first_doc bigint"), "suffix-classes")
    # Both sides are written tables: a segment that very many documents have is a skewed join, which Spark splits.
    start, end = F.col("at") + F.col("from_window"), F.col("at") + F.col("to_window") + LENGTH
    found = (places.select("content", "doc_id", "row", "at").join(classes, "content").where("first_doc < doc_id")
             .select("doc_id", "row", F.shiftleft(start, 32).bitwiseOR(end).alias("span")))
    return found.groupBy("doc_id", "row").agg(F.collect_list("span").alias("spans"))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, which together with doc_id tells rows apart: 64 bits among rows of one doc_id."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    return rows.withColumn("row", F.xxhash64("doc_id", "text"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes that stay (``kept``) of every row."""
    joined = _keyed(docs).join(staged(spans(docs), "suffix-spans"), ["doc_id", "row"], "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        lambda it: tidied(_cut(it)), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """The counts of :func:`remove_repeats` and the digest of the bytes that stay."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                       F.sha2("kept", 256).alias("kept_sha256"))
