import math
import random

from pyspark.sql import functions as F

from blockfuse.llm import mixing


def filled(sizes, weights=(5, 2, 1), share=1.5, times=2):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        part = {s: total * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if part[s] > times * sizes[s]]
        if not over:
            return out | part
        for s in over:
            out[s] = times * sizes[s]
            total -= out[s]
            open_.discard(s)
    return out


def corpus(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        source = rnd.choices(["a", "b", "c", "é", "z", None, "tiny"], [60, 20, 20, 20, 5, 5, 1])[0]
        rows.append((i, "w " * rnd.randint(0, 40), source))
    return rows + [(n, None, "a"), (n + 1, "", "empty"), (n + 1, "x y", "b"), (None, "p q r", "c"), (None, "p q r", "c")]


def test_targets_and_what_is_taken(spark):
    rows = corpus(5)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = filled(sizes)
    by_target = {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        key = (r.source_size, round(r.target, 6))
        by_target[key] = by_target.get(key, 0) + r.taken
    assert {(sizes[s], round(t, 6)) for s, t in want.items()} == set(by_target)
    for (_, target), taken in by_target.items():
        assert abs(taken - target) <= 80 + 1e-6
    assert sum(by_target.values()) <= sum(want.values()) + 1e-6


def test_reruns_agree_and_queue_order(spark):
    rows = corpus(6)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    a = sorted(map(str, mixing.mix(df).collect()))
    assert a == sorted(map(str, mixing.mix(df.repartition(7).withColumn("size", F.lit(3))).collect()))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0 and mixing.mix_rows(empty).count() == 0


def queued(rows, seed=mixing.SEED, times=2):
    """What the queue takes of (doc_id, text, source), by sorting all copies."""
    import hashlib

    md5 = lambda x: hashlib.md5(x.encode()).digest()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal, copies = filled(sizes), []
    for source in sizes:
        mine = [(md5(("" if d is None else str(d)) + ":" + seed), len((t or "").split()), md5(t or ""), k) for k, (d, t, s) in enumerate(rows) if s == source]
        for *key, k in mine:
            upto = sum(m[1] for m in mine if list(m[:3]) <= key)
            copies += [((upto + e * sizes[source]) / goal[source], key[1], k) for e in range(times) if key[1] and goal[source] > 0]
    taken, left, copies = {}, sum(goal.values()), sorted(copies)
    while copies:
        group = [c for c in copies if c[0] == copies[0][0]]
        left -= sum(c[1] for c in group)
        if left < 0:
            break
        for _, size, k in group:
            taken[k] = taken.get(k, 0) + size
        copies = copies[len(group) :]
    return [(d, len((t or "").split()), sizes[s], round(float(goal[s]), 6), taken.get(k, 0)) for k, (d, t, s) in enumerate(rows)]


def test_equals_the_queue_in_memory(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_ROWS", 16)
    monkeypatch.setattr(mixing, "_SLICES", 8)
    rows = corpus(7, 150)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted(map(str, ((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got.collect()))) == sorted(map(str, queued(rows)))


def test_rows_in_place_with_one_id_without_id_and_clashing_columns(spark):
    rows = [(1, "w " * 3, "a"), (1, "w " * 400, "a"), (None, "p q r", "c"), (None, "x " * 50, "c"), (2, None, None), (3, "long " * 200_000, "b")]
    wide = [(*r, 7.5, "keep") for r in rows]
    out = mixing.mix_rows(spark.createDataFrame(wide, "doc_id long, text string, source string, size double, key string"))
    assert out.columns == ["doc_id", "text", "source", "key", "size", "source_size", "target", "taken"]
    got = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, queued(rows)))


def test_word_count(spark):
    texts = ["", " a\tb\n", "a b\x0bc", "é", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t")))
    assert [r[0] for r in df.collect()] == [0, 2, 3, 1, 0]
    assert math.isclose(sum(filled({"a": 10, "b": 10}).values()), 30)
