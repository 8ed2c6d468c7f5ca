import itertools
import random

import pytest

from blockfuse.llm import graph, jaccard
from blockfuse.llm.graph import components


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            first[root(i)] = min(first.get(root(i), d), d)
    return sorted((str(d), len(sets[i]), first.get(root(i))) for i, (d, _) in enumerate(rows))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((str(r[0]), r[1], r[2]) for r in jaccard.near_duplicates(df).collect())


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefgh", k=4))
    passage = [word() for _ in range(40)]
    bases = [[word() for _ in range(rnd.randint(30, 90))] for _ in range(6)]
    texts = []
    for _ in range(140):
        kind = rnd.random()
        if kind < 0.6:  # edited copies: some link only through others
            t = list(rnd.choice(bases))
            for _ in range(rnd.randint(0, 4)):
                t[rnd.randrange(len(t))] = word()
        elif kind < 0.85:  # one passage in many documents, around the threshold
            t = [word() for _ in range(rnd.randint(0, 16))] + passage + [word() for _ in range(rnd.randint(0, 8))]
        else:
            t = [word() for _ in range(rnd.randint(0, 30))]
        texts.append(" ".join(t))
    texts += ["", None, "  \n", "one two", "ONE two", "one two three", texts[0], texts[0]]
    rnd.shuffle(texts)
    return list(enumerate(texts, start=1))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("more", [{"SALT_ROWS": 4}, {"OPEN_PAIRS": 0, "TILE": 8, "NEAREST": 1}])
def test_long_lists_rounds_salts_and_tiles(spark, monkeypatch, more):
    for name, value in ({"SMALL": 2} | more).items():
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(3)
    assert run(spark, rows) == brute(rows)


def test_words_and_signatures():
    """Words of letters whose polynomials meet (Thue-Morse and its complement) are told apart; parities bound differences."""
    import numpy as np

    a = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    b = "".join("ba"[bin(k).count("1") % 2] for k in range(2048))
    one, two, three = jaccard.shingle_sets([a.encode(), b.encode(), a.upper().encode()])
    assert one != two and (one == three).all()
    rnd = np.random.default_rng(1)
    for n, m, both in ((50, 60, 30), (3000, 2500, 2400), (1, 1, 0), (100, 5000, 100)):
        s = np.unique(rnd.integers(0, 1 << 63, n + m - both).astype(np.uint64) * np.uint64(2))
        x, y = (np.frombuffer(jaccard.signature(z), np.uint64) for z in (s[:n], s[n - both :]))
        width = min(len(x), len(y))
        apart = int(np.bitwise_count(jaccard._folded(x, width) ^ jaccard._folded(y, width)).sum())
        assert apart <= n + m - 2 * both
        assert (jaccard._folded(x, 1) == jaccard._folded(jaccard._folded(x, 2), 1)).all()


def test_null_ids_ties_empty_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (7, text), (7, text), (3, text + " more"), (9, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    wide = spark.createDataFrame([(1, text, 5, "x")], "doc_id long, text string, cls long, component string")
    assert [tuple(r) for r in jaccard.near_duplicates(wide).collect()] == [(1, 26, 1)]


@pytest.mark.parametrize("local", [0, 1 << 17])
def test_components_of_paths_and_stars(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL_EDGES", local)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 300: 300, 301: 300}
