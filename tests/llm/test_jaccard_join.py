import random
import re
from itertools import combinations

import pytest

from voltframe.llm import jaccard_join
from voltframe.llm.components import components
from voltframe.llm.jaccard_join import Threshold

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words)} if 0 < len(words) < n else {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}


def brute(rows, n, p, q):
    docs = {d: shingles(t, n) for d, t in rows}
    group, links = {d: d for d in docs}, dict.fromkeys(docs, 0)

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for a, b in combinations(sorted(docs), 2):
        x, y = docs[a], docs[b]
        if x and y and q * len(x & y) >= p * len(x | y):
            links[a] += 1
            links[b] += 1
            x, y = sorted((root(a), root(b)))
            group[y] = x
    return sorted((d, len(docs[d]), root(d), links[d]) for d in docs)


def family(rng, n, words):
    rows = []
    for k in range(n):
        base = [f"f{k % 5}w{j}" for j in range(words + k % 5 * 7)]
        for _ in range(rng.randint(0, max(1, words // 25))):
            base[rng.randrange(len(base))] = f"e{rng.randint(0, 9)}"
        if rng.random() < 0.3:
            base += ["tail"] * rng.randint(1, 4)
        rows.append((k, " ".join(base)))
    return rows


@pytest.mark.parametrize("n,p,q,words,block", [(3, 9, 10, 60, 1500), (3, 9, 10, 140, 5), (5, 4, 5, 60, 1500),
                                                (2, 4, 5, 12, 4)])
def test_equals_brute_force(spark, documents, monkeypatch, n, p, q, words, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rows = family(random.Random(words), 80, words)
    rows += [(200, rows[3][1]), (201, rows[3][1].upper()), (202, None), (203, ""), (204, "One two"), (205, "one  TWO"),
             (206, "one"), (207, "é É"), (208, "word " * 500)]
    got = jaccard_join.join(documents(rows, extra=True), n, Threshold(p, q)).collect()
    assert sorted(map(tuple, got)) == brute(rows, n, p, q)


def test_edges(spark, documents):
    text = " ".join(f"w{k}" for k in range(30))
    docs = documents([(None, text), (4, text), (2, text), (2, text), (None, "lone words only here"), (9, "")])
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_join.join(docs).collect()), key=str)
    assert got == sorted([(None, 2), (4, 2), (2, 2), (2, 2), (None, None), (9, 9)], key=str)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["2", "2", "9", "None", "None"]
    assert jaccard_join.join(documents([])).count() == 0
    assert jaccard_join.keep_one(documents([])).count() == 0


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(k, k + 1) for k in range(100, 103)] + [(7, 7), (500, 500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 104)}, 500: 500}


def test_repeated_id_with_two_texts_and_a_set_without_id(spark, documents):
    def text(name, first="", last=""):
        words = [f"{name}{k}" for k in range(60)]
        words[:3] = [w + first for w in words[:3]]
        words[-3:] = [w + last for w in words[-3:]]
        return " ".join(words)

    rows = [(5, text("x")), (5, text("y")), (6, text("x", last="_")), (7, text("y", last="_")),
            # Only the row without an id lies between 20 and 21.
            (20, text("n")), (None, text("n", last="_")), (21, text("n", first="_", last="_"))]
    got = jaccard_join.join(documents(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["n_links"]) for r in got) == [
        (0, 20, 2), (5, 5, 1), (5, 5, 1), (6, 5, 1), (7, 5, 1), (20, 20, 1), (21, 20, 1)]


def test_keep_one_with_clashing_names(spark, documents):
    text = "one two three four five six seven eight nine ten " * 3
    df = documents([(1, text), (2, text), (3, "other words " * 9), (None, text), (4, None)], extra=True)
    got = jaccard_join.keep_one(df)
    assert got.columns == df.columns and sorted(map(str, (r.doc_id for r in got.collect()))) == ["1", "3", "4", "None"]


@pytest.mark.parametrize("p,q", [(4, 5), (9, 10), (2, 3)])
def test_linked_sets_share_a_first_gram(p, q):
    """Whatever the table of counts says, and at the very edge of a link."""
    import numpy as np
    threshold, rng = Threshold(p, q), np.random.default_rng(p)
    for size in [*range(threshold.least_size, 60), 333]:
        counts = rng.integers(0, 3, jaccard_join.CELLS).astype(np.uint32)
        a = np.unique(rng.integers(-2**62, 2**62, size))
        least = -(-p * len(a) // q)  # a subset of this size still links
        for b in (rng.choice(a, least, replace=False),
                  np.append(rng.choice(a, threshold.overlap(len(a), len(a)), replace=False),
                            rng.integers(-2**62, 2**62, len(a) - threshold.overlap(len(a), len(a))))):
            assert q * len(np.intersect1d(a, b)) >= p * len(np.union1d(a, b))
            first = [jaccard_join.first_grams(np.unique(x), threshold, counts) for x in (a, b)]
            assert len(np.intersect1d(*first))


def test_ties_hold_over_ranges_of_sizes_and_batches():
    """Sets of one n-gram are tied as long as sizes hang together, wherever a batch ends."""
    import numpy as np
    import pyarrow as pa
    rows = [(1, 10, 30, 100), (1, 12, 12, 101), (1, 33, 33, 102), (1, 60, 60, 103), (1, 62, 70, 104), (2, 62, 62, 105)]
    for size in (1, 2, 6):
        batches = [pa.record_batch([pa.array(c) for c in zip(*rows[k:k + size])], names=["sign", "lo", "hi", "set_id"])
                   for k in range(0, len(rows), size)]
        got = np.concatenate([np.stack([c.to_numpy() for c in b.columns], 1)
                              for b in jaccard_join._share(Threshold(9, 10), iter(batches))])
        assert sorted(map(tuple, got.tolist())) == [(100, 101), (100, 102), (103, 104)]


def test_table_of_counts_adds_up(spark, documents):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, "b c d e f"), (4, None)]
    known = jaccard_join.with_shingles(documents(rows), 3, "doc_id").repartition(3).mapInArrow(
        jaccard_join._identify, "doc_id bigint, n_shingles bigint, set_id bigint, proof bigint, counts binary")
    counts = jaccard_join._counts(known)
    assert sorted(counts[counts > 0].tolist()) == [1, 1, 2, 3] and len(counts) == jaccard_join.CELLS


def test_long_sets_make_smaller_blocks_and_slices(spark, documents, monkeypatch):
    import pyarrow as pa
    column = pa.array([[1, 2, 3], [4], [], list(range(20)), [5, 6], [7]], pa.list_(pa.int64()))
    batch = pa.record_batch([column], names=["grams"]).slice(1)
    got = list(jaccard_join._few(iter([batch]), 0, 4))
    assert [b.column(0).to_pylist() for b in got] == [[[4], []], [list(range(20))], [[5, 6], [7]]]
    monkeypatch.setattr(jaccard_join, "BLOCK_GRAMS", 300)
    monkeypatch.setattr(jaccard_join, "TIDY_GRAMS", 10)
    largest, link = [], jaccard_join._compared

    def spied(docs, groups, threshold, words):
        largest.append(groups.count())
        return link(docs, groups, threshold, words)

    monkeypatch.setattr(jaccard_join, "_compared", spied)
    rows = family(random.Random(3), 40, 140)
    assert sorted(map(tuple, jaccard_join.join(documents(rows), 3, Threshold(9, 10)).collect())) == brute(rows, 3, 9, 10)
    assert largest[0] * 140 > 4 * 300


def spy(monkeypatch, counted):
    """Records the rows of each written table by its tag."""
    def spied(df, tag, write=jaccard_join.staged):
        out = write(df, tag)
        counted.setdefault(tag, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "staged", spied)


def test_common_passages_do_not_make_coarse_groups(spark, documents, monkeypatch):
    """Each text shares half of its n-grams with the next, so no order of n-grams keeps them apart; none are linked."""
    parts = [" ".join(f"p{k}w{j}" for j in range(40)) for k in range(41)]
    rows = [(k, f"{parts[k]} {parts[k + 1]}") for k in range(40)]
    rows += [(100, rows[5][1] + " more"), (101, rows[5][1])]
    counted: dict = {}
    spy(monkeypatch, counted)
    got = sorted(map(tuple, jaccard_join.join(documents(rows), 3, Threshold(4, 5)).collect()))
    assert got == brute(rows, 3, 4, 5)
    assert counted["jaccard-shared"][0] >= 20 and counted["jaccard-coarse"] == [2]


@pytest.mark.parametrize("p,q", [(4, 5), (9, 10), (2, 3)])
def test_sketches_keep_every_link(p, q):
    """At the very edge of a link, also when the sketches have different numbers of cells or full ones."""
    import numpy as np
    import pyarrow as pa
    threshold, rng = Threshold(p, q), np.random.default_rng(q)
    names = ["u", "v", "n_u", "n_v", "sketch_u", "sketch_v"]
    rows, strange = [], []
    for size in [*range(threshold.least_size, 40), 255, 256, 257, 300, 1030, 5000]:
        a = np.unique(rng.integers(-2**62, 2**62, size))
        least = threshold.overlap(len(a), len(a))
        for b in (rng.choice(a, -(-p * len(a) // q), replace=False),
                  np.append(rng.choice(a, least, replace=False), rng.integers(-2**62, 2**62, len(a) - least))):
            b = np.unique(b)
            assert q * len(np.intersect1d(a, b)) >= p * len(np.union1d(a, b))
            rows.append((size, -size, len(a), len(b), jaccard_join._sketch(a), jaccard_join._sketch(b)))
        b = np.unique(rng.integers(-2**62, 2**62, size))
        strange.append((size, -size, len(a), len(b), jaccard_join._sketch(a), jaccard_join._sketch(b)))
    # More n-grams than a cell can count.
    full = bytes([255] * 32)
    rows.append((1, 2, 20000, 20000, full, bytes([255] * 64)))

    def kept(rows):
        batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=names)
        return sum(b.num_rows for b in jaccard_join._alike(threshold, iter([batch])))

    assert kept(rows) == len(rows)
    assert (p, q) == (2, 3) or kept([r for r in strange if r[0] >= 100]) == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_short_lists_give_pairs_and_long_ones_ties_wherever_a_batch_ends(monkeypatch, size):
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(jaccard_join, "LIST_SETS", 4)
    lists = {-5: [(100, 10), (101, 11), (102, 11), (103, 12)],  # 100 and 103 are too far apart
             3: [(k, 50) for k in range(200, 209)],
             4: [(200, 50)], 9: [(300, 20), (300, 20), (301, 20), (302, 40)]}
    rows = [(sign << jaccard_join.SIZE_BITS | n, owner) for sign, sets in lists.items() for owner, n in sets]
    batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[k:k + size])], names=["key", "set_id"])
               for k in range(0, len(rows), size)]
    got = {x for b in jaccard_join._listed(Threshold(9, 10), iter(batches)) for x in zip(*(c.to_pylist() for c in b.columns))}
    pairs = {(a, b) for k in (-5, 9) for a, n in lists[k] for b, m in lists[k] if a < b and m * 9 <= n * 10}
    assert {(u, v) for u, v, sure in got if not sure} == pairs and len(pairs) == 6
    ties = {(u, v) for u, v, sure in got if sure}
    assert ties == {(200, k) for k in range(201, 209)}


def test_one_block_for_a_small_group(spark, documents, monkeypatch):
    """Sets of a group that one block holds are sent once, whatever their classes of size."""
    rows = family(random.Random(5), 40, 100)
    counted: dict = {}
    spy(monkeypatch, counted)
    assert sorted(map(tuple, jaccard_join.join(documents(rows), 3, Threshold(9, 10)).collect())) == brute(rows, 3, 9, 10)
    assert 0 < counted["jaccard-blocks"][0] <= counted["jaccard-coarse"][0]
