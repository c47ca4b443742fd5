import hashlib
import random
from array import array

import pytest

from voltframe.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_vocabulary(bpe.vocabulary_path()))


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.vocabulary_path())


def ids(codec, text):
    got = array("I")
    got.frombytes(codec.encode(text))
    return list(got)


def test_equals_library_on_random_text(codec, lib):
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(0, 0x250), 0x300, 0x301, 0x3A3, 0x3C2, 0x1E9E, 0x2028, 0x3000, 0xFEFF, 0x1F600,
                             0x4E2D, 0x212B, 0xAC00, 0x1100, 0x1161, 0x85, 0xA0]]
    pool += [" "] * 60 + list("abcdefghijklmnop") * 15 + ["<|endoftext|>", "<|", "'s", "'re", "the", "ing"] * 3
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids(codec, text) == want, repr(text)
        assert codec.decode(codec.encode(text)) == lib.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 3000 + " x", "é" * 2000, "0" * 300, "", " \n", "it's we'll"])
def test_long_and_odd_texts(codec, lib, text):
    assert ids(codec, text) == lib.encode(text, add_special_tokens=False).ids


def test_cuts_are_pairs_of_no_token(codec):
    inner = [t.encode() for t in ("qx", "zq")]
    for raw in inner:
        cut = bool(codec.cuts(raw))
        assert cut == (raw[0] * 256 + raw[1] not in codec.final)


def test_query_rows(spark, documents, edge_rows, codec, lib):
    got = bpe.digests(documents(edge_rows, extra=True)).collect()
    assert len(got) == len(edge_rows)
    want = []
    for doc_id, text in edge_rows:
        own = lib.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(own), hashlib.sha256(array("I", own).tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(own, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digests(documents([])).count() == 0
