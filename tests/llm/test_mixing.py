import pytest

from voltframe.llm import mixing


def fill(sizes):
    """Plain water filling by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_copies(spark, documents):
    rows = [(k, "w " * (k % 7 + 1), ["a", "b", "c", "d", None][min(k % 40, 4)]) for k in range(400)]
    got = mixing.mixture(documents(rows)).collect()
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = fill(sizes)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        rate = r["target"] / r["source_size"]
        assert r["copies"] in (int(rate), int(rate) + 1) and r["copies"] <= 3
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mixture(documents(rows[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_repeats_whole_rows(spark, documents, edge_rows):
    docs = documents(edge_rows, extra=True)
    taken = {}
    for r in mixing.mixture(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["copies"]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    seen = {}
    for r in mixed.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {k: v for k, v in taken.items() if v}


def test_empty(spark, documents):
    assert mixing.mixture(documents([])).count() == 0
    assert mixing.mix(documents([])).count() == 0
    only_empty = mixing.mixture(documents([(1, None), (2, "")])).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in only_empty] == [(0, 0.0, 0)] * 2
