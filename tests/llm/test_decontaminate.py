import hashlib
import random

from blockfuse.llm import decontaminate as dc


def brute(docs, items, window=13):
    grams = [(i, w) for i, t in items for w in set(dc.windows_of((t or "").encode(), window))]
    out = []
    for d, t in docs:
        words = dc.words((t or "").encode())
        hit, ids = set(), set()
        for item, w in grams:
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    ids.add(item)
        names = ",".join(sorted(str(i) for i in ids if i is not None))
        n = sum(i is not None for i in ids)
        out.append((d, len(words), len(hit), n, hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(4)
    word = lambda: rnd.choice(["ab", "cd", "Ef", "é", "x1", "y", "z"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([13, 14, 30, 5, 1, 20, 13])]
    items += [(7, ""), (8, None), (9, "..."), (None, "nul item of words"), (2, "second text of item two")]
    docs = []
    for i in range(60):
        t = [word() for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.6:
            t[rnd.randint(0, len(t)) : 0] = rnd.choice(items[:7])[1].split()
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(t)))
    return docs + [(100, None), (101, ""), (None, items[0][1]), (3, items[1][1]), (5, "AB-CD"), (102, "w " * 5000 + items[2][1])], items


def run(spark, docs, items, **more):
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as terms", "1 as seg")
    b = spark.createDataFrame(items, "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in dc.contamination(a, b, **more).select(*cols).collect()), key=str)


def test_contamination_equals_brute_force(spark):
    docs, items = corpus()
    assert run(spark, docs, items) == brute(docs, items)


def test_small_segments_and_query_blocks(spark, monkeypatch):
    docs, items = corpus()
    index = dc.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), "doc_id", "text", 100)
    assert index.count() > 10
    bench = spark.createDataFrame(items, "item_id long, text string")
    def hit(**more):
        rows = dc.matches(index, bench, "item_id", "text", **more).selectExpr("seg", "ord", "item_id", "explode(spans) s").collect()
        return {(r.seg, r.ord, r.item_id, k) for r in rows for k in range(r.s.s, r.s.e)}

    assert hit(block_windows=5) == hit() != set()
    monkeypatch.setattr(dc, "BLOCK_WINDOWS", 3)  # items go on in the next block
    assert run(spark, docs, items) == brute(docs, items)


def test_minimal_spans_equal_the_plain_rule(spark):
    rnd = random.Random(3)
    docs = [(k, " ".join(rnd.choices("abcd", k=30))) for k in range(20)]
    index = dc.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), "doc_id", "text")
    items = spark.createDataFrame([(9, "a b a")], "item_id long, text string")
    got = {(docs[r.ord][0], s.s, s.e) for r in dc.matches(index, items, "item_id", "text", slop=3).collect() for s in r.spans}
    want = set()
    for d, t in docs:
        w = t.split()
        spans = [(i, j) for i in range(30) for j in range(i + 3, min(30, i + 6) + 1) if w[i:j].count("a") >= 2 and w[i:j].count("b") >= 1]
        least = [x for x in spans if not any(y != x and x[0] <= y[0] and y[1] <= x[1] for y in spans)]
        merged = []
        for x, y in sorted(least):
            if merged and x <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(y, merged[-1][1]))
            else:
                merged.append((x, y))
        want |= {(d, x, y) for x, y in merged}
    assert got == want


def test_proximity_in_any_order(spark):
    docs = [(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha beta x x x gamma"), (4, "alpha beta")]
    index = dc.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), "doc_id", "text")
    items = spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string")
    got = dc.matches(index, items, "item_id", "text", slop=2).orderBy("ord").collect()
    assert [(r.ord, [(s.s, s.e) for s in r.spans]) for r in got] == [(0, [(0, 5)]), (1, [(0, 3)])]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a")], []) == [(1, 1, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
