import random

from blockfuse.llm import warc


def brute(rows):
    last = {}
    for p, _, h in rows:
        k = (h or "").encode()
        if p is not None:
            last[k] = max(last.get(k, p), p)
    out = []
    for p, _, h in rows:
        k = (h or "").encode()
        of = last.get(k)
        again = of is not None and p != of
        out.append((p, len(k), warc.digest(k), "revisit" if again else "response", of if again else None))
    return sorted(set(out), key=str)


def corpus():
    rnd = random.Random(5)
    rows = []
    for i in range(120):
        url = f"http://{rnd.choice('abc')}.example.{rnd.choice(['com', 'org'])}/p{rnd.randint(0, 60)}?q={i % 4}"
        rows.append((i, url, rnd.choice(["", None, "<p>one</p>", "<p>é</p>" * 50, f"<i>{i}</i>"])))
    return rows + [(500, None, "no url"), (501, "bad url\nwith line", "x"), (502, "http://a.b/", "long " * 40000), (None, "http://c.d/", "<p>one</p>")]


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as key", "2 as start")
    out = warc.round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_lookup_reads_payloads_and_large_directories_are_joined(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(df, chunk=2000)
    blocks, directory = warc.build_index(archives, block=5)
    assert directory.count() > 10
    urls = df.where("page_id in (3, 40, 502)").select("url")
    wanted = {r[0] for r in urls.collect()}
    for most in (200_000, 0):
        monkeypatch.setattr(warc, "MOST_DIRECTORY", most)
        got = warc.lookup(archives, blocks, directory, urls, payloads=True).collect()
        assert sorted(r.page_id for r in got) == sorted(p for p, u, _ in rows if u in wanted)
        assert all(bytes(r.payload).decode() == (dict((p, h) for p, _, h in rows)[r.page_id] or "") for r in got if r.record_type == "response")
    miss = spark.createDataFrame([("http://nowhere.example/",)], "url string")
    assert warc.lookup(archives, blocks, directory, miss).count() == 0


def test_exported_files(spark, tmp_path):
    rows = corpus()
    archives = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = [r for f in warc.export(archives, str(tmp_path)) for r in warc.read_file(f)]
    assert sorted((str(r["page_id"]), r["size"]) for r in found) == sorted((str(p), len((h or "").encode())) for p, _, h in rows)


def test_keys_and_empty(spark):
    assert warc.url_key("http://a.B.org/x?y") == "org,b,a)/x?y" and warc.url_key(None) == ")"
    assert run(spark, []) == []


def test_percent_encoded_newlines(spark):
    urls = ["http://a.b/x%0Ay", "http://a.b/x\ny", "http://a.b/x%250Ay", "http://a.b/x%25", "http://a.b/x"]
    rows = [(i, u, f"page {i}") for i, u in enumerate(urls)]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_and_rows_without_id(spark):
    rows = [(None, "http://a.b/1", "same"), (None, "http://a.b/2", "same"), (None, "http://a.b/3", "other"), (None, "http://a.b/3", "other")]
    rows += [(7, "http://a.b/7", "same"), (7, "http://a.b/7", "same"), (3, "http://a.b/3", "same"), (7, "http://a.b/8", "two payloads")]
    d = {h: warc.digest(h.encode()) for _, _, h in rows}
    want = [(p, len(h), d[h], *(("revisit", 7) if h == "same" and p != 7 else ("response", None))) for p, _, h in rows]
    assert run(spark, rows) == sorted(want, key=str)


def test_a_lookup_of_few_keys_reads_only_their_blocks_and_chunks(spark):
    rows = [(i, f"http://h{i:03d}.example/", f"page {i} " * 300) for i in range(200)]
    archives = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), chunk=400)
    blocks, directory = warc.build_index(archives, block=4)
    one = spark.createDataFrame([("http://h077.example/",)], "url string")
    found = warc.lookup(archives, blocks, directory, one, payloads=True)
    assert [(r.page_id, bytes(r.payload).decode()) for r in found.collect()] == [(77, "page 77 " * 300)]
    place = warc.locate(blocks, directory, one.selectExpr("'example,h077)/' as key"))
    plan = place._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(block" in plan or "In(block" in plan
    number = directory.where("first <= 'example,h077)/' and last >= 'example,h077)/'").select("block")
    chosen = warc._named(blocks, number, ["block"])
    assert chosen.count() == 1 < blocks.count()
    chosen.collect()
    scan = chosen._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    read = int(scan.metrics().get("numOutputRows").get().value())
    assert read < blocks.count() / 2  # pages of other rows are skipped
