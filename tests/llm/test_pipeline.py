import random

import pytest
from test_jaccard import shingles
from test_mixing import queued

import corpus_pipeline
from blockfuse.llm import decontaminate, langid, linededup
from blockfuse.llm.common import materialize, with_row_numbers

SF = "/root/testdata/sf0.001"


def kept_by_near_duplicates(rows):
    """Of (doc_id, text, ...) one of each group of linked texts: the least id, null last, then the first row."""
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append((r[0] is None, r[0] or 0, i))
    return [rows[min(g)[2]] for g in groups.values()]


def contaminated(text, windows):
    words = decontaminate.words((text or "").encode())
    hit = {p for w in windows for k in range(len(words) - len(w) + 1) if tuple(words[k : k + len(w)]) == w for p in range(k, k + len(w))}
    return len(hit) > 0 and 20 * len(hit) >= len(words)


def kept_lines(rows):
    """Texts after line dedup, of (doc_id, text, ...); rows without id are one document that comes last."""
    ident = lambda d: linededup._NO_ID if d is None else d
    first = {}
    for d, t, *_ in rows:
        for k in linededup._keys((t or "").encode(), 10):
            first[k] = min(first.get(k, ident(d)), ident(d))
    lose = lambda d, x: (k := linededup.line_key(x.encode())) in first and ident(d) > first[k]
    return ["\n".join(x for x in (t or "").split("\n") if not lose(d, x)) for d, t, *_ in rows]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Texts of the smallest table, and rows without id, of one id, empty and very long, with columns of other stages' names."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path_factory.mktemp("sf")
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()[:150]
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    rnd = random.Random(1)
    base = {"lang": "en", "source": "web"}
    text = docs[3]["text"] + " " + " ".join(rnd.choices(docs[5]["text"].split(), k=40))
    more = [(None, text), (None, text), (None, text + " and more"), (7, "one id with two texts of its own"), (7, "another text under the same id here")]
    more += [(500, ""), (501, None), (502, " \n "), (503, "1234 5678"), (504, docs[9]["text"] * 200), (505, items[0]["text"]), (505, "clean text under an id that is not")]
    rows = [{k: r[k] for k in ("doc_id", "text", "lang", "source")} for r in docs] + [{"doc_id": d, "text": t} | base for d, t in more]
    for r in rows:
        r |= {"n_chars": len(r["text"] or ""), "taken": 1, "component_id": "x", "key": None}
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("taken", pa.int64()), ("component_id", pa.string()), ("key", pa.string())])
    half = len(rows) // 2
    for k, part in enumerate((rows[:half], rows[half:])):
        (folder / "documents.parquet").mkdir(exist_ok=True)
        pq.write_table(pa.Table.from_pylist(part, schema), folder / "documents.parquet" / f"{k}.parquet")
    pq.write_table(pq.read_table(f"{SF}/benchmark.parquet"), folder / "benchmark.parquet")
    return str(folder), [r["text"] for r in items]


def test_stages_equal_brute_force(spark, tables):
    sf, items = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {}
    plain = lambda df: [tuple(r)[:2] + (r.source,) for r in with_row_numbers(df, "n").orderBy("n").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        before, docs = plain(docs), materialize(out, f"test-{name}")
        seen[name] = before, plain(docs)
    same = lambda a, b: sorted(map(str, a)) == sorted(map(str, b))
    before, after = seen["language_id"]
    gone = list(before)
    for r in after:
        gone.remove(r)
    assert len(gone) >= 4 and all(len(langid.cells((t or "").encode())) == 0 for _, t, _ in gone)
    before, after = seen["line_dedup"]
    assert same([(d, t, s) for (d, _, s), t in zip(before, kept_lines(before))], after)
    assert docs.where("n_chars <> length(text)").count() == 0
    before, after = seen["near_duplicates"]
    assert same(kept_by_near_duplicates(before), after) and len(after) < len(before)
    before, after = seen["decontamination"]
    windows = {w for t in items for w in decontaminate.windows_of(t.encode())}
    assert same([r for r in before if not contaminated(r[1], windows)], after) and len(after) < len(before)
    before, after = seen["mix_sources"]
    want = [(d, s, n, taken) for (d, n, _, _, taken), (_, _, s) in zip(queued(before), before) if taken]
    assert same(want, [(r.doc_id, r.source, r.size, r.taken) for r in docs.collect()])
    assert docs.columns == [c for c in columns if c != "taken"] + ["size", "source_size", "target", "taken"]


def test_row_numbers(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    one, two = (dict((r["__n"], r["text"]) for r in with_row_numbers(df, "__n").collect()) for df in (docs, docs))
    assert one == two and len(one) == docs.count()
    made = with_row_numbers(docs.where("doc_id > 3"), "__n")
    assert made.select("__n").distinct().count() == made.count()


def test_empty_tables(spark, tables):
    docs = materialize(spark.read.parquet(f"{tables[0]}/documents.parquet").where("false"), "none")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables[0]).count() == 0


def test_run_gives_the_mix(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "text", "taken"} <= set(out.columns)
