import re
from collections import Counter

from voltframe.llm import quality_rules, rule_ensemble

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    found, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if found[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


def test_statistics_and_base(spark, documents, edge_rows):
    rows = edge_rows + [(20, "a b a b a b a\nx\n\nx\n x"), (21, "#|<> p q r s p q r s\x0bt"), (22, "u v w " * 40),
                        (23, " ".join(f"w{k}" for k in range(120)))]
    got = quality_rules.judge(documents(rows, extra=True)).collect()
    have = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                   for r in got), key=str)
    assert have == sorted(((i, *brute(t)) for i, t in rows), key=str)
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        assert 0 <= r["good_probability"] <= 1
    assert quality_rules.judge(documents([])).count() == 0


def test_em_finds_the_unreliable_rule():
    # Two rules agree with a hidden class, the third votes at random.
    patterns = [((1, 1, 1), 400), ((1, 1, 0), 400), ((0, 0, 1), 100), ((0, 0, 0), 100), ((1, None, 0), 10)]
    share, right = quality_rules.fit(patterns)
    assert 0.7 < share < 0.9
    assert min(right[0]) > 0.9 and min(right[1]) > 0.9 and max(right[2]) < 0.65
    assert quality_rules.fit([])[0] == 0.8


def test_no_python_in_the_plan(spark, documents):
    plan = quality_rules.statistics(documents([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rule_ensemble_learns(spark, documents):
    good = [(k, " ".join(f"the w{k}x{j} and" for j in range(40 + k % 9))) for k in range(200)]
    bad = [(k, " ".join(f"w{k}x{j}%%% ###" for j in range(40 + k % 9))) for k in range(200, 400)]
    docs = documents(good + bad + [(1000, None), (1001, "")], extra=True)
    labels = spark.createDataFrame([(k, int(k < 200), 0) for k in range(400)] + [(None, 1, 0), (5, None, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in rule_ensemble.score_documents(docs, labels).collect()}
    held = [r for k, r in got.items() if k < 400 and r["held_out"]]
    assert len(held) > 50 and len(got) == 402
    assert sum(r["predicted"] == int(r["doc_id"] < 200) for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    none = rule_ensemble.score_documents(docs, labels.where("quality > 5")).collect()
    assert {r["score"] for r in none} == {0.5}
    one = rule_ensemble.score_documents(docs, labels.where("quality = 1")).collect()
    assert {r["predicted"] for r in one} == {1}
    assert rule_ensemble.score_documents(documents([]), labels).count() == 0
