import hashlib
import random
import re

import numpy as np

from voltframe.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub(r"\D", "", m[0])
        if 14 <= len(digits) <= 19 and pii._luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text)
                  if 10 <= len(re.sub(r"\D", "", m[0])) <= 15]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    bits = ["a", "b.", "@", "@", ".", "-", "1", "2", "255", "4", "+", "+1", " ", "(", ")", "x@y.z",
            "4111111111111111", "1.2.3.4", "0", "é", "00000012", "%"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), repr(text)


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 50_000, "1." * 50_000, "+1" + " " * 100_000, "A " * 50_000):
        pii.candidates(text, pii.base_spans(text))


def test_query_rows(spark, documents, edge_rows):
    secret = 'token = "8ef5f278dec875d2b96fdf291615913d21aee5ca"'
    rows = edge_rows + [(k, f"word {secret[:-5]}{k:04d}\" then Dr. Anna Berg a.{k}@m.example.com +1 (115) 555-9688")
                        for k in range(20, 60)]
    got = pii.find(documents(rows, extra=True)).collect()
    assert len(got) == len(rows)
    texts = dict((i, t) for i, t in rows)
    for r in got:
        base = sorted(plain(texts[r["doc_id"]] or ""), key=lambda s: (s[1], pii.KINDS.index(s[0])))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r["spans"].split(","))
        assert r["n_email"] == sum(k == "email" for k, _, _ in base)
    added = {s.split(":")[0] for r in got for s in r["spans"].split(",") if s}
    assert "secret" in added
    assert pii.find(documents([])).count() == 0


def test_redaction_keeps_columns(spark, documents):
    docs = documents([(1, "mail a@b.cd now"), (2, None), (3, "plain")], extra=True)
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {1: "mail <email> now", 2: None, 3: "plain"}


def test_em_trusts_the_better_labeler():
    votes = np.array([[1, 1, 2], [0, 0, 2], [1, 1, 0], [0, 0, 1], [1, 0, 2]])
    posterior, right = pii.estimate(votes, np.array([100.0, 100, 30, 30, 3]))
    assert posterior[0] > 0.9 and posterior[1] < 0.1
    assert min(right[0]) > max(right[2])
