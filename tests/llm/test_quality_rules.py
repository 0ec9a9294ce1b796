import random
import re
from collections import Counter

import numpy as np

from asofia.llm import quality_rules as R

from .helpers import DOCS, document_rows, documents, odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(WORD.search(line))
        seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    cover = set()
    for i, g in enumerate(zip(words, words[1:], words[2:])):
        if grams[g] > 1:
            cover |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_statistics():
    rnd = random.Random(1)
    texts = [t or "" for _, t, *_ in document_rows()] + ["a a a a", "a b c a b c", "\n\n a\n a\n", "x\x0by\x1cz w", "#*$%&|<> é 🙂", "one two"]
    texts += ["".join(rnd.choice(["a", "b", " ", "\n", "c ", "##"]) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    for t in texts:
        assert R.statistics(t)[:5] == brute(t), repr(t)


def labelled(n=900):
    rnd = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        bad = k % 5 == 0
        words = ["".join(rnd.choice("abcdefghij") for _ in range(6)) + (rnd.choice(["###", "", "$$$"]) if bad else "") for _ in range(rnd.randint(60, 90))]
        rows.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, 0 if bad else 1, 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = labelled()
    docs, known = documents(spark, rows), spark.createDataFrame(labels[:600], "doc_id long, quality int, toxic int")
    rules = R.fit(docs, known)
    assert rules
    got = {r.doc_id: r.kept for r in R.judge(odd(docs), rules, ["doc_id"]).collect()}
    truth = [(got[k], q == 1) for k, q, _ in labels[600:]]
    assert np.mean([a == b for a, b in truth]) > 0.95
    assert all(a for a, b in truth if b)  # no good document goes


def test_expression_equals_rules(spark):
    rows, labels = labelled(300)
    docs = documents(spark, rows)
    rules = R.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    for r in R.judge(docs, rules, ["doc_id"]).collect():
        x = {f: np.array([v]) for f, v in R.features({c: float(r[c]) for c in R.COUNTS + R.MORE}).items()}
        fired = next((k for k, rule in enumerate(rules, 1) if all(c.holds(x)[0] for c in rule)), 0)
        assert r.rule == fired and r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed and not fired)


def test_fit_is_bounded_and_awkward_labels(spark):
    rows, labels = labelled(300)
    labels += [(None, 0, 0), (1, None, 0), (2, 0, 1), (2, 1, 0), (99999, 0, 0)]
    docs, known = documents(spark, rows + document_rows()), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert R.fit(docs, known, max_rows=10) == R.fit(docs, known, max_rows=10)
    assert isinstance(R.fit(docs, known), list)
    assert R.fit(docs, known.limit(0)) == [] and R.fit(documents(spark, []), known) == []
    assert R.fit(docs, known.filter("quality = 1")) == []


def test_awkward_rows(spark):
    docs = odd(documents(spark))
    got = R.judge(docs, [], ["doc_id"]).collect()
    assert sorted(map(str, (tuple(r[c] for c in ("doc_id", *R.COUNTS)) for r in got))) == sorted(map(str, ((r.doc_id, *brute(r.text)) for r in docs.collect())))
    kept = R.keep_good(docs, [])
    assert kept.dtypes == docs.dtypes and 0 < kept.count() < docs.count()
    assert R.judge(spark.createDataFrame([], DOCS), [], ["doc_id"]).collect() == [] and R.keep_good(spark.createDataFrame([], DOCS), []).collect() == []
