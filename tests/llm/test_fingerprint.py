import hashlib
import random

from blockfuse.llm import fingerprint as fp


def corpus():
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    rows = [(i * 3 % 101, " ".join(rnd.choices(vocab, k=rnd.randint(0, 80)))) for i in range(60)]
    return rows + [(500, None), (501, ""), (502, "Éa " * 4000), (600, rows[0][1]), (601, rows[0][1])]


def test_study(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k", "2 as part")
    got = {r.doc_id: r for r in fp.edited_study(df, low=0.0, high=0.5).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        assert got[d].n_chars == len(t)
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), d
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        if edited == t:
            assert got[d].near_edited == 1 and got[d].fingerprint == got[d].edited_fingerprint
    assert got[600].fingerprint == got[601].fingerprint == got[rows[0][0]].fingerprint
    assert got[500].fingerprint == got[501].fingerprint
    near = sum(r.near_edited for r in got.values()) / len(got)
    assert near > 2 * sum(r.near_next for r in got.values()) / len(got)


def test_lexicon_band(spark):
    rows = [("a b c",), ("a b",), ("a",), ("a d",)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "t string").select(fp.terms(F.col("t")).alias("terms"))
    both = set(fp.lexicon(df, low=0.4, high=0.6))
    want = spark.range(1).select(F.xxhash64(F.lit("b"))).first()[0]
    assert both == {want}


def test_empty_and_single(spark):
    assert fp.edited_study(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    (r,) = fp.edited_study(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    twins = fp.edited_study(spark.createDataFrame([(1, "abc"), (1, "abc"), (None, "xyz")], "doc_id long, text string")).collect()
    assert len(twins) == 3


def bodies(df, **more):
    return {r.doc_id: r.fingerprint.split("/")[0] for r in fp.fingerprints(df, **more).collect()}


def test_only_terms_of_the_band_enter_signatures(spark):
    shared = " ".join(f"s{i}" for i in range(6000))
    rows = [(i, shared + "".join(f" own{i}x{j}" for j in range(2000))) for i in range(4)] + [(i, f"other{i}") for i in range(4, 8)]
    got = bodies(spark.createDataFrame(rows, "doc_id long, text string"), high=0.5)
    assert len({got[i] for i in range(4)}) == 1 and set(got[0]) != set("-.")
    assert all(set(got[i]) == set("-.") for i in range(4, 8))


def test_a_lexicon_too_large_to_broadcast(spark, monkeypatch):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    want = sorted(map(tuple, fp.edited_study(df, low=0.0, high=0.5).collect()), key=str)
    monkeypatch.setattr(fp, "LEXICON_BYTES", 0)
    assert sorted(map(tuple, fp.edited_study(df, low=0.0, high=0.5).collect()), key=str) == want


def test_every_term_of_the_band_is_kept(spark):
    rows = [(i, " ".join(f"t{j}" for j in range(i // 2 * 3000, i // 2 * 3000 + 3000))) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(fp.lexicon(df.select(fp.terms(df.text).alias("terms")), high=0.5)) == 12000


def test_next_rows_over_many_ranges_with_ties_and_without_ids(spark):
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 60), "".join(rnd.choices("abc", k=rnd.randint(0, 30)))) for _ in range(120)]
    rows += [(None, f"none {i}" * rnd.randint(1, 9)) for i in range(40)] + [(7, "same")] * 3
    df = spark.createDataFrame(rows, "id long, text string")
    hashes = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] if r[0] is not None else "", hashes[r[1]]))
    want = sorted(zip(order, order[1:] + order[:1]), key=str)
    for size in (40, 1 << 30):
        got = [((r.id, r.text), r.next_text) for r in fp.with_next(df, size).collect()]
        assert sorted(map(str, got)) == sorted(str((a, b[1])) for a, b in want)


def test_signatures_equal_plain_python(spark):
    import xxhash

    rows = [(i, t or "") for i, t in corpus()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    low, high = 0.02, 0.3
    member = {r.member: r.subsets for r in fp.members(df.select(fp.terms(df.text).alias("terms")), low, high).collect()}
    long = lambda w: int.from_bytes(xxhash.xxh64(w.encode(), seed=42).digest(), "big", signed=True)
    sets = {i: {long(w) for w in t.lower().split()} for i, t in rows}
    seen = [h for s in sets.values() for h in s]
    assert set(member) == {h for h in set(seen) if max(2, low * len(rows)) <= seen.count(h) <= max(2, high * len(rows))}
    drawn = [sum(1 for b in member.values() if b >> (k * fp.PER_LEVEL) & (1 << fp.PER_LEVEL) - 1) for k in range(len(fp.RATES))]
    assert all(a >= b for a, b in zip(drawn, drawn[1:]))
    got = bodies(df, low=low, high=high)
    for i, s in sets.items():
        want = []
        for j in range(len(fp.RATES) * fp.PER_LEVEL):
            x = 0
            for h in s:
                if member.get(h, 0) >> j & 1:
                    x ^= h & (1 << 64) - 1
            want.append(f"{x:016X}"[-8:] if x else "-")
        assert got[i] == ".".join(want)
