import random

import numpy as np

from blockfuse.llm import linededup as ld


def brute(rows, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    ident = lambda d: ld._NO_ID if d is None else d
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(ident(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = lambda x: len(holders.get(key(x), ())) > 1 and ident(d) > min(holders[key(x)])  # noqa: B023, E731
        kept = [x for x in lines if not gone(x)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(7)
    pool = [f"Line number {i} of all" for i in range(30)] + ["short", "", "éééééééééé", "  Line number 3 of all\t", "LINE NUMBER 4 OF ALL"]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randint(0, 8)) + [f"own line {i} here"] * (i % 3))) for i in range(80)]
    return rows + [(200, None), (201, ""), (None, pool[0]), (None, pool[1]), (5, pool[2]), (5, pool[2]), (300, "very long line " * 9000)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as n_lines", "'k' as key")
    out = ld.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    return sorted((tuple(r) for r in out.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def test_equals_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_full_filters_small_chunks_and_slices_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ld, "BITS_PER_KEY", 0)  # 64 bits a filter
    monkeypatch.setattr(ld, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(ld, "CHUNK", 16)
    monkeypatch.setattr(ld, "SLICE_KEYS", 8)
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_filters_never_forget_a_repeat():
    rnd = np.random.default_rng(3)
    chunks = [np.unique(rnd.integers(0, 3000, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(6)]
    both = [rnd.random(len(c)) < 0.1 for c in chunks]
    once, twice = ld.slice_filters(list(zip(chunks, both)))
    hashes, counts = np.unique(np.concatenate(chunks), return_counts=True)
    assert ld._has(once, hashes).all() and ld._has(twice, hashes[counts > 1]).all()
    assert all(ld._has(twice, c[b]).all() for c, b in zip(chunks, both))
    single = np.setdiff1d(hashes[counts == 1], np.concatenate([c[b] for c, b in zip(chunks, both)]))
    assert ld._has(twice, single).mean() < 0.1


def test_empty_table(spark):
    assert run(spark, []) == []
