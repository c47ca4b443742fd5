import itertools
import math
import zlib

import numpy as np
import pytest

from voltframe.llm import language_id as lid
from voltframe.llm.common import read_table


def segmentations(unit, tokens):
    """All ways to cut ``unit`` into tokens, by trying every set of cuts."""
    n = len(unit)
    for cuts in itertools.product((0, 1), repeat=n - 1):
        at = [0, *[k + 1 for k, c in enumerate(cuts) if c], n]
        parts = [unit[a:b] for a, b in zip(at, at[1:])]
        if all(p in tokens for p in parts):
            yield parts


@pytest.fixture(scope="module")
def pieces():
    return lid.load_pieces(lid.vocabulary_path())


def vocabulary():
    import base64
    with open(lid.vocabulary_path(), "rb") as f:
        return [t for t in (base64.b64decode(x.split()[0]) for x in f if x.strip()) if not t.strip(lid._WORD_BYTES)]


UNITS = [b" the", b" a", b" ", b" straight", " él".encode(), " größe".encode(), "日本".encode(), b" zqxj", b" thing"]


def test_forward_sums_all_segmentations(pieces):
    tokens = {t: k for k, t in enumerate(vocabulary())}
    rng = np.random.default_rng(2)
    weight = rng.random((pieces.size, 2))
    model = lid.Model(["a", "b"], np.zeros(2), weight, lid.vocabulary_path())
    scores = lid.word_scores(model, UNITS)
    for row, unit in zip(scores, UNITS):
        for k in range(2):
            want = sum(math.prod(weight[tokens[p], k] for p in s) for s in segmentations(unit, tokens))
            assert row[k] == pytest.approx(math.log(want), rel=1e-12)


def test_expected_counts_are_posterior_shares(pieces):
    tokens = {t: k for k, t in enumerate(vocabulary())}
    counts = np.array([[k + 1, 0] for k in range(len(UNITS))])
    got = pieces.expected(UNITS, counts) / lid.GRAIN
    want = np.zeros((pieces.size, 2))
    for unit, (n, _) in zip(UNITS, counts):
        ways = [(s, pieces.size ** -len(s)) for s in segmentations(unit, tokens)]
        for s, w in ways:
            for p in s:
                want[tokens[p], 0] += n * w / sum(x for _, x in ways)
    assert np.abs(got - want).max() < 1e-3


def test_units():
    assert lid.units_of(b"the") == [b" the"]
    assert lid.units_of("ÉTÉ2été".encode()) == [" été".encode()] * 2
    long = lid.units_of(b"x" * 100)
    assert b"".join(long) == b" " + b"x" * 100 and max(map(len, long)) == lid.UNIT_BYTES
    words = lid.Words()
    assert len(words.numbers("The THE the! x-y 12  ".encode())) == 6 and len(words.number) == 4


def plain(rows, path):
    """Counts and scores word by word, with the same pieces."""
    pieces = lid.load_pieces(path)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0 if i is not None else True
    learn = [(t, lang) for i, t, lang in rows if not held(i) and t is not None and lang is not None]
    languages = sorted({x for _, x in learn})
    words = lambda t: [u for w in lid._LETTERS.findall(t.lower()) for u in lid.units_of(w.encode())]
    counts = np.zeros((pieces.size, len(languages)))
    for t, lang in learn:
        for u in words(t):
            counts[:, languages.index(lang)] += pieces.expected([u], np.ones((1, 1), int))[:, 0] / lid.GRAIN
    weight = (1 - lid.EVEN) * counts / np.maximum(counts.sum(0), 1e-9) + lid.EVEN / pieces.size
    prior = np.log([sum(x == y for _, y in learn) / len(learn) for x in languages])
    model = lid.Model(languages, prior, weight, path)
    out = []
    for i, t, _ in rows:
        own = words(t or "")
        if not own:
            out.append((i, held(i), "und", 0.0))
            continue
        z = lid.word_scores(model, own).sum(0) + prior
        p = np.exp(z - z.max())
        out.append((i, held(i), languages[int(z.argmax())], float((p / p.sum()).max())))
    return out


ROWS = [(1, "the house and the dog", "en"), (2, "das haus und der hund", "de"), (3, "la maison et le chien", "fr"),
        (4, "der hund das", "de"), (6, "The Dog!", "en"), (7, "Größe und Straße", "de"), (8, None, "fr"), (9, "", "en"),
        (10, " \n 123 !?", "de"), (11, "le chat", None), (12, "dog " * 3000, "en"), (13, "x" * 5000, "de"),
        (14, "日本語 そして", "ja"), (15, "the dog", "en"), (15, "the dog", "en"), (None, "das haus", "de"),
        (17, "K Å İstanbul", "en")]


def test_equals_plain_version(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string")
    df = df.selectExpr("*", "1 AS held_out", "'x' AS lang_pred", "2 AS score", "3 AS piece", "4 AS grains")
    key = lambda r: (str(r[0]), r[2])
    got = sorted(map(tuple, lid.identify(df).collect()), key=key)
    want = sorted(plain(ROWS, lid.vocabulary_path()), key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-6)


def test_empty_table_and_nothing_to_learn(spark):
    schema = "doc_id bigint, text string, lang string"
    assert lid.identify(spark.createDataFrame([], schema)).collect() == []
    rows = lid.identify(spark.createDataFrame([(1, "the dog", None), (2, None, None)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 2


def test_held_out_accuracy_and_reruns(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    first = {r.doc_id: r for r in lid.identify(docs).collect()}
    again = {r.doc_id: r for r in lid.identify(docs.repartition(13)).collect()}
    assert first == again
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in first.values() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held) > 150
