import random

import numpy as np

from voltframe.llm import toxicity


def corpus(n):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(60)]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[rng.randint(0, 59)] = rng.choice(["insultone", "insulttwo"])
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    return rows, labels


def test_learns_and_rejects(spark, documents):
    rows, labels = corpus(600)
    docs = documents(rows + [(9000, None), (9001, ""), (9001, "")], extra=True)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_documents(docs, marks).collect()
    truth = {k: t for k, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(got) == 603 and len(held) > 60
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = toxicity.reject_toxic(docs, marks)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    assert left == {r["doc_id"] for r in got if not r["predicted"]}


def test_degenerate_labels(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["predicted"] for r in toxicity.score_documents(docs, marks).collect()} == {0}
    assert toxicity.score_documents(documents([]), marks).count() == 0


def test_pairs_count_together():
    # Neither term says anything alone; both together are toxic.
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 2, 2000), rng.integers(0, 2, 2000)
    machine = toxicity.Machine(-3.0, np.array([1, 2], np.int32), np.array([0, 0, 0], np.float32),
                               np.array([[2.5, 0, 0, 0], [2.5, 0, 0, 0], [0, 0, 0, 0]], np.float32))
    slots = [np.array([s for s, f in ((1, x), (2, y), (7, 1)) if f], np.int32) for x, y in zip(a, b)]
    starts = np.concatenate(([0], np.cumsum([len(s) for s in slots])))
    score = machine.scores(np.concatenate(slots), starts)
    assert ((score > 0.5) == (a & b).astype(bool)).all()


def test_reject_with_clashing_names(spark, documents):
    rows = [(k, "vile insult here" if k % 3 == 0 else f"a calm text {k % 11}") for k in range(400)]
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k, _ in rows], "doc_id bigint, quality int, toxic int")
    df = documents(rows, extra=True)
    got = toxicity.reject_toxic(df, labels)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [k for k, _ in rows if k % 3]


def test_fit_learns_a_pair_of_neutral_terms():
    """Label 1 where two terms are both there or both absent: each alone says nothing."""
    rng = np.random.default_rng(1)
    n, learned = 4000, 3000
    a, b = rng.integers(0, 2, n), rng.integers(0, 2, n)
    docs = [np.array([t for t, f in ((1, x), (2, y)) if f] + list(10 + rng.choice(1500, 20, replace=False)), np.int32)
            for x, y in zip(a, b)]
    labels = (a == b).astype(float)
    flat = lambda own: (np.concatenate(own), np.concatenate(([0], np.cumsum([len(d) for d in own]))))
    machine = toxicity.fit(*flat(docs[:learned]), labels[:learned], np.ones(learned))
    assert {1, 2} <= set(machine.slots.tolist())
    score = machine.scores(*flat(docs[learned:]))
    assert ((score >= 0.5) == (labels[learned:] == 1)).mean() > 0.99


def test_chance_alone_keeps_hardly_a_term():
    rng = np.random.default_rng(2)
    docs = [np.unique(rng.integers(0, 300, 40)).astype(np.int32) for _ in range(1500)]
    labels = (rng.random(1500) < 0.3).astype(float)
    machine = toxicity.fit(np.concatenate(docs), np.concatenate(([0], np.cumsum([len(d) for d in docs]))),
                           labels, np.ones(1500))
    assert len(machine.slots) <= 6


def test_scores_are_the_sum_over_all_pairs(spark, documents):
    """Plain evaluation of the formula: bias, weights, and every pair's inner product."""
    rows, labels = corpus(400)
    rows += [(9000, None), (9001, ""), (9002, "insultone " * 4000 + "w1 w2 w3 longerword"), rows[0]]
    docs = documents(rows, extra=True)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    machine = toxicity.train(docs, marks, toxicity.held_out_fold())
    place = {int(s): k for k, s in enumerate(machine.slots)}
    want = []
    for r in docs.select("doc_id", toxicity.terms(toxicity.text_of("text")).alias("slots")).collect():
        own = [place[s] for s in set(r.slots) if s in place]
        z = machine.bias + sum(float(machine.weights[k]) for k in own)
        for i, x in enumerate(own):
            for y in own[i + 1:]:
                z += sum(float(machine.factors[x, f]) * float(machine.factors[y, f]) for f in range(toxicity.FACTORS))
        want.append((r.doc_id, 1 / (1 + np.exp(-z))))
    got = [(r.doc_id, r.score) for r in toxicity.score(docs, machine).collect()]
    assert len(place) > 1 and len(got) == len(want) == 404
    for (i, x), (j, y) in zip(sorted(got), sorted(want)):
        assert i == j and abs(x - y) < 1e-5
