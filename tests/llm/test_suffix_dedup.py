import hashlib
import random

import numpy as np
import pytest

from voltframe.llm import induced, suffix_dedup


def brute(docs):
    first = {}
    for d, x in docs:
        for k in range(len(x) - 49) if d is not None else ():
            first[x[k:k + 50]] = min(first.get(x[k:k + 50], d), d)
    out = []
    for d, x in docs:
        gone = bytearray(len(x))
        for k in range(len(x) - 49) if d is not None else ():
            if first[x[k:k + 50]] < d:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(c for c, f in zip(x, gone) if not f)
        runs = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(gone)))
        out.append((d, len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\0\xff", b"a"])
def test_suffix_array_equals_sorting(alphabet):
    rng = random.Random(3)
    for _ in range(100):
        raw = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 150)))
        text = np.frombuffer(raw, np.uint8)
        got = induced.suffix_array(text, induced.words_at(text), 1000)
        assert got.tolist() == sorted(range(len(raw)), key=lambda k: raw[k:])


def rows_with_repeats(rng):
    passages = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(40, 130))) for _ in range(6)]
    rows = []
    for k in range(60):
        text = "".join(rng.choice([rng.choice(passages), "".join(rng.choice("stuvwxyz ") for _ in range(40))])
                       for _ in range(rng.randint(0, 6)))
        rows.append((k * 3 % 61, text))
    rows += [(70, rows[5][1]), (71, rows[5][1]), (72, "=" * 400), (73, "=" * 300), (73, "=" * 120), (None, rows[5][1]),
             (74, None), (75, ""), (76, "short")]
    return rows


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_equals_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2_000)
    rows = rows_with_repeats(random.Random(8))
    got = suffix_dedup.digests(documents(rows, extra=True)).collect()
    assert sorted(map(tuple, got), key=str) == brute([(d, (t or "").encode()) for d, t in rows])


def test_edges(spark, documents, edge_rows):
    got = suffix_dedup.digests(documents(edge_rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute([(d, (t or "").encode()) for d, t in edge_rows])
    assert suffix_dedup.digests(documents([])).count() == 0
