import random

import numpy as np
from pyspark.sql import functions as F

from blockfuse.llm import toxicity as tx


def corpus(n=600):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 6)))
    docs, labels = [], []
    for i in range(n):
        t = [word() for _ in range(rnd.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(2):
                t.insert(rnd.randrange(len(t) + 1), rnd.choice(["Zork!", "quux", "zimpel" + word()]))
        docs.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs + [(9000, None), (9001, ""), (None, "quux")], "doc_id long, text string").selectExpr("*", "1 as toxic")
    out = tx.toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 80
    assert sum((r.score >= 0.3) == truth[r.doc_id] for r in held) / len(held) > 0.97
    by = {r.doc_id: r for r in out}
    assert by[9000].score == by[9001].score == 0 and not by[None].held_out and by[None].predicted == 1
    text = dict(docs)
    for r in out:
        if r.doc_id in truth and truth[r.doc_id] and r.spans:
            found = {text[r.doc_id][s.start : s.end].lower() for s in r.spans}
            assert any(w.startswith(("zork", "quux", "zimpel")) for x in found for w in x.split())


def test_marginals_equal_plain_forward_backward():
    rnd = random.Random(1)
    chain = tx.Chain({b"bad": 2.0, b"stem*": 1.0}, -3.0, np.array([[0.7, -0.4], [0.2, 0.9]]), np.array([0.1, -0.5]))
    for _ in range(40):
        words = [rnd.choice([b"bad", b"stemmed", b"x", b"y", b"z", b"w"]) for _ in range(rnd.randint(1, 30))]
        want = tx.plain_marginals(chain, words)
        assert all(abs(want[i] - p) < 1e-9 for i, p in chain.marginals(words))


def test_without_labels(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    out = tx.toxicity(d, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert [(r.score, r.predicted) for r in out] == [(0.0, 0)]


def test_held_out_rule(spark):
    import zlib

    got = spark.range(50).select("id", tx.held_out(F.col("id"))).collect()
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in got)
