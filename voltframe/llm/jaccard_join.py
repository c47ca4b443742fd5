"""Exact Jaccard join of word n-grams with set-relation skipping.

A document is the set of its word n-grams, as 64-bit hashes.  Documents with the
same set are one set from then on, known by 64 bits of a digest (64 more bits
are compared, and a clash raises an error).

*Candidates.*  All n-grams have one order, rare ones first: by how often their words
would meet by chance, or by a table of n-gram counts where it says more (both of fixed
size; any order is exact, a good one is fast).  Two linked sets share one of their
first n-grams, as many as the smaller partner of a link may lack, plus one.  So each
set is listed under those.  Two sets of one list whose sizes can link are a candidate;
it is dropped if their sketches (how many n-grams fall into each cell of a hash) differ
by more than linked sets may.  Lists longer than ``LIST_SETS`` are tied unverified, as
long as sizes hang together.  Ties make coarse groups.

*Links.*  A coarse group is compared at once, a large one class by class in blocks of
``BLOCK_SETS`` and pairs of blocks.  Inside a block the index lists of n-grams are
kept by position: a set looks up its prefix and skips the blocks of a list whose
positions cannot reach the overlap any more.  If nothing is found, it has no
links.  Otherwise its overlaps with all other sets are derived from the answers of
the set before it: only lists of n-grams in which the two differ are read.

Equal sets are one inside a batch before they are shuffled.  All links are verified on whole sets;
links between different texts are counted, copies share one set.

Defined results: null text, or text without words, is an empty set, linked with
nothing; shorter texts than an n-gram are one n-gram; rows without doc_id take part
under the other ids of their group (a group without any has a null
``component_id``); rows that repeat a doc_id with the same set are one document,
with different sets each set keeps its row; empty tables give empty results; only
doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import WORD_PATTERN, broadcast_if_small, free_name, release, staged, text_of, tidied
from voltframe.llm.components import components

#: Sets of a block of a coarse group that one task compares, and their n-grams: long sets make smaller blocks.
BLOCK_SETS = 600
BLOCK_GRAMS = 1 << 21
#: Rows whose shingles and signatures are made side by side, and their n-grams.
SLICE_ROWS = 2048
SLICE_GRAMS = 1 << 18
#: N-grams of a comparison after which a task returns its freed memory.
TIDY_GRAMS = 1 << 17
#: Cells of the table of n-gram counts (16 MB, sent to every executor), and parts in which it is added up.
CELLS = 1 << 22
CELL_SLICES = 64
#: Cells of the table of word counts, in slices of the same width.
WORD_CELLS = 1 << 20
#: Sets under one n-gram up to which every two of them are a candidate.
LIST_SETS = 200
#: Cells of the smallest sketch, and the n-grams a cell of larger ones has at most on average.
SKETCH_CELLS = 32
SKETCH_GRAMS = 8
#: Bits of a list's key that hold the size.
SIZE_BITS = 24


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``p / q``."""

    p: int
    q: int

    @property
    def least_size(self) -> int:
        """Smaller sets only link with equal ones."""
        return -(-self.p // (self.q - self.p))

    def classes(self, largest: int) -> np.ndarray:
        """Starts of the size classes up to one beyond ``largest``."""
        starts = [self.least_size, self.least_size + 1]
        while starts[-1] <= largest:
            starts.append(self.q * (starts[-1] - 1) // self.p + 1)
        return np.array([*starts, self.q * (starts[-1] - 1) // self.p + 1], np.int64)

    def overlap(self, a: int, b: int | np.ndarray) -> int | np.ndarray:
        """Fewest common n-grams of linked sets of these sizes."""
        return -(-self.p * (a + b) // (self.q + self.p))

    def prefix(self, size: int) -> int:
        """How many of a set's first n-grams must be looked at: one more than a link lets it lack."""
        return size + self.p * -size // self.q + 1


def with_words(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the 64-bit hashes of each text's words."""
    lower = F.translate(F.col("_text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = F.regexp_extract_all(lower, F.lit(WORD_PATTERN), F.lit(0))
    return docs.select(*keep, text_of("text").alias("_text")).select(
        *keep, F.transform(own, lambda w: F.xxhash64(w)).alias("words"))


def with_shingles(docs: DataFrame, words: int, *keep: str) -> DataFrame:
    rows = with_words(docs, *keep)
    kinds = "".join(f"{c} {kind}, " for c, kind in rows.dtypes[:-1])
    return rows.mapInArrow(lambda it: _shingled(words, it), f"{kinds}grams array<bigint>")


def _chained(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: int, join) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of texts that follow one another, from ``join(so far, next word)``, and where each text's begin."""
    sizes = ends - starts
    counts = np.where(sizes >= words, sizes - words + 1, (sizes > 0).astype(np.int64))
    at = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(at[-1], hashes.dtype)
    acc = hashes
    for k in range(1, words + 1):
        if k < words:  # texts of so few words are one n-gram
            few = np.flatnonzero(sizes == k)
            out[at[few]] = acc[starts[few]]
            acc = join(acc[:-1], hashes[k:]) if len(acc) > 1 else acc[:0]
    many = np.flatnonzero(sizes >= words)
    out[_ranges(at[many], at[many + 1])] = acc[_ranges(starts[many], ends[many] - words + 1)]
    return out, at


def _shingled(words: int, batches: Iterator[pa.RecordBatch], tally: np.ndarray | None = None,
              known: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Hashes of n-grams in place of those of words, in the last column.

    ``tally`` gets the words counted by cell.  With ``known``, levels of words by
    cell, a last column has each n-gram's level: how likely its words meet by chance.
    """
    for batch in batches:
        batch = pa.record_batch([*batch.columns], names=[*batch.schema.names[:-1], "words"])
        for part in _few(iter([batch]), batch.num_columns - 1, SLICE_GRAMS):
            column = part.column(part.num_columns - 1)
            bounds = column.offsets.to_numpy().astype(np.int64)
            # A slice's values are those of the whole batch.
            hashes = column.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].view(np.uint64)
            bounds -= bounds[0]
            if tally is not None:
                np.add.at(tally, _word_cells(hashes), np.uint32(1))
            grams, at = _chained(_mix(hashes), bounds[:-1], bounds[1:], words,
                                 lambda a, b: _mix(a * np.uint64(0x9E3779B97F4A7C15) + b))
            offsets = pa.array(at, pa.int32())
            columns = [*part.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(grams.view(np.int64)))]
            names = [*part.schema.names[:-1], "grams"]
            if known is not None:
                levels, _ = _chained(known[_word_cells(hashes)], bounds[:-1], bounds[1:], words, np.add)
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(levels)))
                names.append("levels")
            yield pa.record_batch(columns, names=names)


def _few(batches: Iterator[pa.RecordBatch], column: int, grams: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most SLICE_ROWS rows with at most so many n-grams, or of one row."""
    for batch in batches:
        ends = batch.column(column).offsets.to_numpy()[1:]
        at = 0
        while at < batch.num_rows:
            before = batch.column(column).offsets[at].as_py()
            upto = min(max(int(np.searchsorted(ends, before + grams, side="right")), at + 1), at + SLICE_ROWS)
            yield batch.slice(at, upto - at)
            at = min(upto, batch.num_rows)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Ascending distinct hashes of each row."""
    starts = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(starts[:-1], starts[1:]):
        yield np.unique(values[a:b])


def _identity(grams: np.ndarray) -> tuple[int, int]:
    digest = hashlib.md5(grams.tobytes()).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _cells(mixed: np.ndarray) -> np.ndarray:
    return (mixed & np.uint64(CELLS - 1)).astype(np.int64)


def _word_cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(WORD_CELLS - 1)).astype(np.int64)


def _sketch(grams: np.ndarray) -> bytes:
    """How many n-grams fall into each cell, 255 at most; a power of two of cells, so that sketches can be folded."""
    cells = SKETCH_CELLS
    while cells * SKETCH_GRAMS < len(grams):
        cells *= 2
    places = (_mix(grams.view(np.uint64)) >> np.uint64(32)) & np.uint64(cells - 1)
    return np.minimum(np.bincount(places.astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes()


def _folded(sketches: np.ndarray, cells: int) -> np.ndarray:
    """Rows of sketches as they would be with fewer cells."""
    sketches = sketches.astype(np.int16)
    while sketches.shape[1] > cells:
        half = sketches.shape[1] // 2
        sketches = np.minimum(sketches[:, :half] + sketches[:, half:], 255)
    return sketches


def _identify(batches: Iterator[pa.RecordBatch], sketched: bool = False) -> Iterator[pa.RecordBatch]:
    """Each row's set; at the end of a task its n-grams' counts by cell, in slices named by ``set_id``."""
    names = ["doc_id", "n_shingles", "set_id", "proof", "counts", *["sketch"] * sketched]
    counted = np.zeros(CELLS, np.uint32)
    for batch in _few(batches, 1, SLICE_GRAMS):
        sets = list(_sets(batch.column(1)))
        if not sets:
            continue
        np.add.at(counted, _cells(_mix(np.concatenate(sets).view(np.uint64))), np.uint32(1))
        columns = [pa.array(c, pa.int64()) for c in zip(*[(len(s), *_identity(s)) for s in sets])]
        sketches = [pa.array([_sketch(s) for s in sets], pa.binary())] if sketched else []
        yield pa.record_batch([batch.column(0), *columns, pa.nulls(len(sets), pa.binary()), *sketches], names=names)
    yield _sliced(counted, 0, names)


def _sliced(counted: np.ndarray, first: int, names: list[str]) -> pa.RecordBatch:
    """A task's counts in slices numbered from ``first``; the columns are those of ``_identify``."""
    parts = [(k, _packed(part)) for k, part in enumerate(np.split(counted, len(counted) * CELL_SLICES // CELLS), first)
             if part.any()]
    none = pa.nulls(len(parts), pa.int64())
    return pa.record_batch([none, none, pa.array([k for k, _ in parts], pa.int64()), none,
                            pa.array([data for _, data in parts], pa.binary()),
                            *[pa.nulls(len(parts), pa.binary())] * (len(names) - 5)], names=names)


def _known(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_identify`` with sketches, from hashes of words; the last slices count words by cell."""
    tally, names = np.zeros(WORD_CELLS, np.uint32), []
    for batch in _identify(_shingled(words, batches, tally), True):
        names = batch.schema.names
        yield batch
    yield _sliced(tally, CELL_SLICES, names)


def _packed(counts: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(counts.astype(np.uint32).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the counts of each slice; rows come dealt by slice and are added one by one."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, data in zip(*batch.columns):
            own = sums.setdefault(k.as_py(), np.zeros(CELLS // CELL_SLICES, np.uint64))
            own += _unpacked(data.as_py())
    limit = np.uint64((1 << 32) - 1)
    yield pa.record_batch([pa.array(list(sums), pa.int64()),
                           pa.array([_packed(np.minimum(x, limit)) for x in sums.values()], pa.binary())],
                          names=["slice", "counts"])


def _counts(known: DataFrame, cells: int = CELLS) -> np.ndarray:
    """The table of counts: CELLS numbers, whatever the corpus; those of words after them, if asked for."""
    parts = (known.where("counts is not null").select(F.col("set_id").alias("slice"), "counts")
             .repartition("slice").mapInArrow(_added, "slice bigint, counts binary"))
    table = np.zeros(cells, np.uint32)
    width = CELLS // CELL_SLICES
    for k, data in parts.where(F.col("slice") < cells // width).collect():  # a row a slice
        table[k * width:(k + 1) * width] = _unpacked(data)
    return table


def _levels(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What orders n-grams, made once so that all tasks have the same: eighths of the logarithm (base 2) of a frequency.

    By cell of n-grams, 0 where a count may be chance: cells hold many n-grams of
    a large corpus.  By cell of words, so that the sum over an n-gram is that of the
    number expected if words met by chance, up to a constant that is the same for all.
    """
    cells, words = counts[:CELLS].astype(np.float64), counts[CELLS:].astype(np.float64)
    usual = cells.mean()
    surely = np.maximum(cells - usual - 4 * np.sqrt(usual), 1)
    share = (words + 1) / (words.sum() + 1)
    return np.minimum(np.round(8 * np.log2(surely)), 255).astype(np.uint8), np.round(8 * np.log2(share)).astype(np.int16)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's set under its set_id."""
    for batch in batches:
        sets = list(_sets(batch.column(0)))
        yield pa.record_batch([pa.array([_identity(s)[0] for s in sets], pa.int64()),
                               pa.array(sets, pa.list_(pa.int64()))], names=["set_id", "grams"])


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def first_grams(grams: np.ndarray, threshold: Threshold, counts: np.ndarray,
                levels: np.ndarray | None = None) -> np.ndarray:
    """A set's first n-grams in the order of all n-grams: rarer ones first, then by their mixed bits.

    Rare is what has a small number in its cell of ``counts``, or, given the ``levels``
    of chance, a small one of these where the cell does not have a larger one.
    """
    mixed = _mix(grams.view(np.uint64))
    rank = counts[_cells(mixed)]
    if levels is not None:
        rank = np.where(rank > 0, np.maximum(rank.astype(np.int64), levels), levels)
    return grams[np.lexsort((mixed, rank))[:threshold.prefix(len(grams))]]


def _sign(threshold: Threshold, words: int, held, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, set_id) for each first n-gram: bits of its hash (a clash makes a candidate more) and the set's size."""
    counts, word_levels, tokens = held.value
    most = (1 << SIZE_BITS) - 1
    for batch in _shingled(words, batches, known=word_levels):
        bounds = batch.column(0).offsets.to_numpy()
        grams = batch.column(0).values.to_numpy(zero_copy_only=False)
        levels = batch.column(1).values.to_numpy(zero_copy_only=False).astype(np.int64) + tokens
        seen, keys, ids = set(), [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own, at = np.unique(grams[a:b], return_index=True)
            if len(own) < threshold.least_size or (name := _identity(own)[0]) in seen:
                continue
            seen.add(name)
            first = _mix(first_grams(own, threshold, counts, levels[a:b][at]).view(np.uint64))
            keys.append((first >> np.uint64(SIZE_BITS) << np.uint64(SIZE_BITS) | np.uint64(min(len(own), most))).view(np.int64))
            ids.append(np.full(len(first), name, np.int64))
        if keys:
            yield pa.record_batch([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], names=["key", "set_id"])


def _listed(threshold: Threshold, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, sure): candidates of short lists and ties of long ones, from rows ordered by key and set."""
    queue: deque = deque()
    ties = _share(threshold, iter(queue.popleft, None))  # takes a batch each time, and keeps the list's state
    none = np.empty(0, np.int64)
    key, owner, is_long = none, none, False  # of the list that may go on; a long one has been passed on so far

    def tied(key: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        size = pa.array(key & ((1 << SIZE_BITS) - 1))
        queue.append(pa.record_batch([pa.array(key >> SIZE_BITS), size, size, pa.array(owner)],
                                     names=["sign", "lo", "hi", "set_id"]))
        got = np.sort(np.stack([c.to_numpy() for c in next(ties).columns], 1), axis=1)
        return _edges(got, True)

    def short(key: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        sign, size = key >> SIZE_BITS, key & ((1 << SIZE_BITS) - 1)
        at, pairs = np.arange(len(key)), []
        for step in range(1, LIST_SETS):
            at = at[at + step < len(key)]
            at = at[(sign[at] == sign[at + step]) & (size[at + step] * threshold.p <= size[at] * threshold.q)]
            if not len(at):  # sizes ascend, so that later ones are out of reach too
                break
            pairs.append(np.stack([owner[at], owner[at + step]], 1))
        return _edges(np.sort(np.concatenate(pairs), axis=1) if pairs else np.empty((0, 2), np.int64), False)

    for batch in batches:
        key = np.concatenate((key, batch.column(0).to_numpy()))
        owner = np.concatenate((owner, batch.column(1).to_numpy()))
        if not len(key):
            continue
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))  # equal sets of other batches
        key, owner = key[new], owner[new]
        sign = key >> SIZE_BITS
        starts = np.flatnonzero(np.concatenate(([True], sign[1:] != sign[:-1])))
        sizes = np.diff(np.append(starts, len(sign)))
        many = np.repeat(sizes > LIST_SETS, sizes)
        many[:sizes[0]] |= is_long
        last = np.arange(len(sign)) >= starts[-1]
        is_long = bool(many[-1])
        ready = ~last | many
        if (ready & many).any():
            yield tied(key[ready & many], owner[ready & many])
        if (ready & ~many).any():
            yield short(key[ready & ~many], owner[ready & ~many])
        # Of a long list, its last row stays: it tells that the list goes on.
        keep = last & ~many
        keep[-1] = True
        key, owner = key[keep], owner[keep]
    if len(key) and not is_long:
        yield short(key, owner)


def _edges(pairs: np.ndarray, sure: bool) -> pa.RecordBatch:
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    pairs = pairs[np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))[:len(pairs)]]
    return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.full(len(pairs), sure))],
                           names=["u", "v", "sure"])


def _alike(threshold: Threshold, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates (u, v, their sizes and sketches) whose sketches do not rule a link out."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(at, SLICE_ROWS)
            a, b = (batch.column(k).to_numpy() for k in (2, 3))
            left, right = (batch.column(k).to_pylist() for k in (4, 5))
            lengths = np.array([(len(x), len(y)) for x, y in zip(left, right)], np.int64)
            differ = np.zeros(batch.num_rows, np.int64)
            for shape in np.unique(lengths, axis=0):
                own = np.flatnonzero((lengths == shape).all(axis=1))
                x, y = (_folded(np.frombuffer(b"".join(side[k] for k in own), np.uint8).reshape(len(own), -1), shape.min())
                        for side in (left, right))
                differ[own] = np.abs(x - y).sum(axis=1, dtype=np.int64)
            kept = np.flatnonzero(differ <= a + b - 2 * threshold.overlap(a, b))
            yield pa.record_batch([batch.column(k).take(pa.array(kept)) for k in (0, 1)], names=["u", "v"])


def _share(threshold: Threshold, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties of sets under one n-gram whose ranges of sizes hang together, from rows ordered by n-gram and size."""
    last_sign, last_hi, last_head = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sign, lo, hi, owner = (c.to_numpy() for c in batch.columns)
        new = np.concatenate(([sign[0] != last_sign], sign[1:] != sign[:-1]))
        hi = hi.copy()
        if not new[0]:
            hi[0] = max(hi[0], last_hi)
        above = np.cumsum(new) << 40  # the largest size so far under the same n-gram
        reach = np.maximum.accumulate(above + hi) - above
        before = np.concatenate(([last_hi], reach[:-1]))
        first = new | (lo * threshold.p > before * threshold.q)
        head = np.concatenate(([last_head], owner[first]))[np.cumsum(first)]
        edges = np.unique(np.stack([head, owner], 1)[head != owner], axis=0)
        last_sign, last_hi, last_head = sign[-1], reach[-1], head[-1]
        yield pa.record_batch([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["u", "v"])


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())


def block_links(sets: list[np.ndarray], threshold: Threshold) -> Iterator[tuple[int, np.ndarray]]:
    """For each set that has any, the later ones (by size) that it links with.  ``sets`` ascend by size."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    # Numbers of 32 bits, found set by set: a block of long sets has millions of n-grams.
    names = np.unique(np.concatenate(sets))
    codes, n_names = np.concatenate([np.searchsorted(names, s).astype(np.int32) for s in sets]), len(names)
    del names
    found = np.bincount(codes, minlength=n_names).astype(np.int32)
    members = owner[np.argsort(codes, kind="stable")]  # of each n-gram's list, ascending by size
    list_at = np.concatenate(([0], np.cumsum(found)))
    # Rare n-grams first; the prefix lists are ordered by position, so whole position blocks are skipped.
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    order = np.lexsort((codes, found[codes], owner)).astype(np.int32)
    position = (np.arange(len(codes)) - np.repeat(bounds[:-1], sizes)).astype(np.int32)
    needed = threshold.overlap(sizes, -(-sizes * threshold.p // threshold.q))
    in_prefix = position < np.repeat(sizes - needed + 1, sizes)
    p_code, p_owner, p_pos = codes[order][in_prefix], owner[order][in_prefix], position[in_prefix]
    by_position = np.lexsort((p_pos, p_code))
    p_code, p_list, p_pos = p_code[by_position], p_owner[by_position], p_pos[by_position]
    p_at = np.searchsorted(p_code, np.arange(n_names + 1))
    p_key = p_code.astype(np.int64) << 32 | p_pos
    del owner, position, in_prefix, p_code, p_pos, by_position
    last, answers = np.empty(0, np.int64), np.zeros(len(sets), np.int64)
    for x in range(len(sets) - 1):
        upper = int(np.searchsorted(sizes, sizes[x] * threshold.q // threshold.p, side="right"))
        if upper <= x + 1:
            continue
        own = codes[bounds[x]:bounds[x + 1]]
        prefix = codes[order][bounds[x]:bounds[x] + sizes[x] - needed[x] + 1]
        # Beyond this position a list's sets have too few n-grams left for the overlap.
        reach = (threshold.q - threshold.p) * int(sizes[x]) // threshold.p + 1
        ends = np.searchsorted(p_key, prefix.astype(np.int64) << 32 | reach, side="right")
        seen = p_list[_ranges(p_at[prefix], np.maximum(ends, p_at[prefix]))]
        if not ((seen > x) & (seen < upper)).any():
            continue
        fewer, more = np.setdiff1d(last, own, assume_unique=True), np.setdiff1d(own, last, assume_unique=True)
        if len(fewer) + len(more) >= len(own):  # nothing to gain from the set before
            fewer, more, answers = last[:0], own, np.zeros(len(sets), np.int64)
        for change, sign in ((fewer, -1), (more, 1)):
            if len(change):
                hit = members[_ranges(list_at[change], list_at[change + 1])]
                answers += sign * np.bincount(hit, minlength=len(sets))
        last = own
        later = np.arange(x + 1, upper)
        linked = later[answers[later] >= threshold.overlap(int(sizes[x]), sizes[later])]
        if len(linked):
            yield x, linked


def _link(threshold: Threshold, table: pa.Table) -> pa.Table:
    """Links of one block (or pair of blocks) of a coarse group.

    ``side`` is 0 or 1 for the two blocks of a pair; only links across count then.
    Visitors come from the class below, where links among themselves are counted.
    """
    sizes = table["n_shingles"].to_numpy()
    order = np.lexsort((table["set_id"].to_numpy(), sizes))
    ids, copies = table["set_id"].to_numpy()[order], table["copies"].to_numpy()[order]
    side, visits = table["side"].to_numpy()[order], table["visits"].to_numpy(zero_copy_only=False)[order]
    across = table["block_a"][0].as_py() != table["block_b"][0].as_py()
    column = table["grams"].combine_chunks()
    starts, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sets = [values[starts[k]:starts[k + 1]] for k in order]  # ascending and distinct, as _named() made them
    links = np.zeros(len(ids), np.int64)
    roots = np.arange(len(ids))

    def root(k: int) -> int:
        while roots[k] != k:
            roots[k] = roots[roots[k]]
            k = roots[k]
        return k

    for x, linked in block_links(sets, threshold):
        linked = linked[~(visits[linked] & visits[x])]
        if across:
            linked = linked[side[linked] != side[x]]
        links[x] += copies[linked].sum()
        links[linked] += copies[x]
        for y in linked:
            roots[root(int(y))] = root(x)
    some = np.flatnonzero(links)
    large = len(values) > TIDY_GRAMS
    del sets, values, column, table
    if large:
        release()
    return pa.table({"u": pa.array(ids[some]), "v": pa.array(ids[[root(int(k)) for k in some]], pa.int64()),
                     "n_links": pa.array(links[some])})


def _compared(docs: DataFrame, groups: DataFrame, threshold: Threshold, words: int) -> DataFrame:
    """(u, v, n_links): each set with links in a block, a set it hangs together with there, and their number."""
    largest = groups.agg(F.max("n_shingles")).first()[0] or 0
    starts = [int(x) for x in threshold.classes(largest)]
    # Position of the last class start that is not above the size.
    classes = F.size(F.filter(F.array(*map(F.lit, starts)), lambda s: s <= F.col("n_shingles")))
    # A group that one block holds is one class, without visitors.
    whole = groups.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("n_grams")) \
        .where((F.col("n") <= BLOCK_SETS) & (F.col("n_grams") <= BLOCK_GRAMS)).select("component", F.lit(True).alias("whole"))
    homes = staged(groups.join(whole, "component", "left").withColumn(
        "class", F.when(F.col("whole"), -1).otherwise(classes)), "jaccard-homes")
    placed = homes.withColumn("visits", F.lit(False)).unionAll(
        homes.where("whole is null").withColumn("class", F.col("class") + 1).withColumn("visits", F.lit(True)))
    counts = placed.groupBy("component", "class").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("visits")).alias("n_home"),
        F.sum("n_shingles").alias("n_grams")).where("n > 1 and n_home > 0")
    placed = placed.join(staged(counts, "jaccard-classes"), ["component", "class"])
    blocks = F.ceil(F.least(F.greatest(F.col("n") / BLOCK_SETS, F.col("n_grams") / BLOCK_GRAMS), F.col("n"))).cast("int")
    placed = (placed.withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    placed = staged(placed.select(
        "doc_id", "set_id", "n_shingles", "copies", "component", "class", "visits",
        F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"),
        (F.col("block") > F.col("other")).cast("int").alias("side")), "jaccard-blocks")
    ids = staged(placed.select("doc_id").where("doc_id is not null").distinct(), "jaccard-wanted")
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # An id does not tell which set a row has, and a set may have no id: the shingles are named again by their set.
    wanted = own.join(broadcast_if_small(ids), "doc_id").unionAll(own.where("doc_id is null"))
    grams = with_words(wanted).mapInArrow(
        lambda it: tidied(_named(_shingled(words, it))), "set_id bigint, grams array<bigint>") \
        .groupBy("set_id").agg(F.min("grams").alias("grams"))
    rows = placed.drop("doc_id").join(grams, "set_id")
    return rows.groupBy("component", "class", "block_a", "block_b").applyInArrow(
        lambda t: _link(threshold, t), "u bigint, v bigint, n_links bigint")


def join(docs: DataFrame, words: int = 3, threshold: Threshold = Threshold(9, 10)) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) and n_links (other documents linked directly)."""
    rows = with_words(docs, "doc_id").select(F.col("doc_id").cast("bigint").alias("doc_id"), "words")
    known = staged(rows.mapInArrow(
        lambda it: tidied(_known(words, it)),
        "doc_id bigint, n_shingles bigint, set_id bigint, proof bigint, counts binary, sketch binary"), "jaccard-sets")
    counts = _counts(known, CELLS + WORD_CELLS)
    tokens = int(round(8 * np.log2(float(counts[CELLS:].sum(dtype=np.float64)) + 1)))
    held = docs.sparkSession.sparkContext.broadcast((*_levels(counts), tokens))
    known = known.where("counts is null").drop("counts")
    sets = staged(known.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
        F.min("n_shingles").alias("n_shingles"), F.min("proof").alias("proof"), F.max("proof").alias("proof_too"),
        F.min("sketch").alias("sketch")), "jaccard-distinct")
    if sets.where("proof <> proof_too").limit(1).count():
        raise RuntimeError("two different sets share 64 bits of their digests")
    signed = rows.select("words").mapInArrow(
        lambda it: tidied(_sign(threshold, words, held, it)), "key bigint, set_id bigint")
    # One shuffle by n-gram; the order inside a task lets it stream, whatever an n-gram's rows.
    listed = signed.repartition(F.shiftright("key", SIZE_BITS)).sortWithinPartitions("key", "set_id").mapInArrow(
        lambda it: tidied(_listed(threshold, it)), "u bigint, v bigint, sure boolean")
    shared = staged(listed.groupBy("u", "v").agg(F.max("sure").alias("sure")), "jaccard-shared")
    held.unpersist()
    sketches = sets.select("set_id", F.col("n_shingles").alias("n"), "sketch")
    left, right = (sketches.toDF(*(f"{c}_{side}" for c in ("set", "n", "sketch"))) for side in "uv")
    alike = (shared.where("not sure").join(left, F.col("u") == F.col("set_u")).join(right, F.col("v") == F.col("set_v"))
             .select("u", "v", "n_u", "n_v", "sketch_u", "sketch_v")
             .mapInArrow(lambda it: tidied(_alike(threshold, it)), "u bigint, v bigint"))
    coarse = components(staged(alike.unionAll(shared.where("sure").select("u", "v")), "jaccard-ties"))
    groups = staged(sets.select("set_id", "doc_id", "copies", "n_shingles")
                    .join(coarse.withColumnRenamed("node", "set_id"), "set_id"), "jaccard-coarse")
    links = staged(_compared(docs, groups, threshold, words), "jaccard-links")
    grouped = components(links.select("u", "v"))
    counted = links.groupBy(F.col("u").alias("set_id")).agg(F.sum("n_links").alias("n_links"))
    together = (sets.select("set_id", "doc_id", "copies")
                .join(grouped.withColumnRenamed("node", "set_id"), "set_id", "left")
                .join(counted, "set_id", "left")
                .withColumn("component", F.coalesce("component", "set_id")))
    smallest = together.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answers = staged(together.join(smallest, "component").select(
        "set_id", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "jaccard-answers")
    # A set with very many copies makes a skewed join of plain shuffles, which Spark splits.
    return known.join(answers, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"))


def keep_one(docs: DataFrame, words: int = 5, threshold: Threshold = Threshold(4, 5)) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, and those without doc_id."""
    dropped = staged(join(docs, words, threshold).where("doc_id <> component_id").select("doc_id").distinct(),
                     "jaccard-dropped")
    dropped = dropped.withColumnRenamed("doc_id", free_name("dropped", docs.columns))
    return docs.join(broadcast_if_small(dropped), docs["doc_id"].cast("bigint") == dropped[dropped.columns[0]],
                     "left_anti")
