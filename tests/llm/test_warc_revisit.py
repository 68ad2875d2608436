import random

from pyspark.sql import functions as F

from finsight.llm import warc_revisit as op

SCHEMA = "record_id long, url string, ts long, is_full boolean, etag string, last_modified string, headers map<string,string>, state string"


def brute(rows):
    """Each revisit against every full response of its URL."""
    out = []
    for rid, url, ts, full, etag, lm, headers, _ in rows:
        if full:
            continue
        earlier = [r for r in rows if r[3] and url is not None and r[1] == url and r[2] is not None and ts is not None and r[2] < ts]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        if best is None:
            state = "no_original"
        elif etag is None and lm is None:
            state = "unverified"
        elif etag is not None:
            strip = lambda x: None if x is None else x.removeprefix("W/")
            state = "resolved" if strip(etag) == strip(best[4]) else "mismatch"
        else:
            state = "resolved" if lm == best[5] else "mismatch"
        good = state in ("resolved", "unverified")
        merged = {**(best[6] or {}), **{k: v for k, v in (headers or {}).items() if k not in op.KEPT_FIELDS}} if good else None
        out.append((rid, ts, state, best[0] if good else None, merged))
    return sorted(out, key=repr)


def records(rng):
    rows = []
    for i in range(400):
        url = "x.com/hot" if rng.random() < 0.5 else rng.choice([None, *(f"x.com/{k}" for k in range(20))])
        full = rng.random() < 0.3
        headers = rng.choice([None, {"date": str(i)}, {"content-type": "t", "etag": f"e{i % 3}", "date": str(i)}])
        rows.append((i, url, rng.choice([None, *range(60)]), full, rng.choice([None, "e1", "W/e1", "e2"]),
                     rng.choice([None, "monday", "friday"]), headers, "clash"))
    return rows


def test_matches_brute_force(spark):
    rows = records(random.Random(1))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("url", F.concat(F.lit("http://"), F.col("url")))
    got = sorted([(r.record_id, r.ts, r.state, r.original_id, r.headers) for r in op.resolve(df).collect()], key=repr)
    key = lambda rs: sorted([(*r[:4], None if r[4] is None else tuple(sorted(r[4].items()))) for r in rs], key=repr)
    assert key(got) == key(brute(rows))


def test_empty_and_repeated(spark):
    assert op.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
    row = (1, "http://a.b/", 5, False, None, None, None, "s")
    got = op.resolve(spark.createDataFrame([(0, "http://a.b", 1, True, None, None, {"k": "v" * 100000}, "s"), row, row], SCHEMA)).collect()
    assert [(r.state, r.original_id, len(r.headers["k"])) for r in got] == [("unverified", 0, 100000)] * 2


def test_canonical_url(spark):
    same = ["http://www.A.com/p?b=2&a=1#frag", "https://a.com:443/p/?utm_source=x&a=1&b=2", "//a.com/p?a=1&b=2&"]
    df = spark.createDataFrame([(u,) for u in same], "u string")
    assert {r[0] for r in df.select(op.canonical_url(F.col("u"))).collect()} == {"a.com/p?a=1&b=2"}


def test_body_of_the_original(spark):
    rows = [(0, "http://a.b/", 1, True, "e", None, None, "s"), (1, "http://a.b/", 5, False, "e", None, None, "s")]
    found = op.attach_body(op.resolve(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame([(0, "text")], "record_id long, body string"))
    assert [(r.record_id, r.body) for r in found.collect()] == [(1, "text")]


def test_header_names_in_any_case(spark):
    rows = [({"Content-Type": "text/html", "ETag": "a", "Date": "1"}, {"CONTENT-TYPE": "x", "Content-Length": "0", "date": "2", "X-New": "n"}),
            ({"ETag": "a", "etag": "b"}, None), (None, {"Connection": "close", "A": "1"})]
    df = spark.createDataFrame(rows, "o map<string,string>, u map<string,string>")
    got = [r[0] for r in df.select(op.merged_headers(df["o"], df["u"])).collect()]
    assert got == [{"Content-Type": "text/html", "ETag": "a", "date": "2", "X-New": "n"}, {"ETag": "a", "etag": "b"}, {"A": "1"}]


def test_page_ids_of_any_size(spark):
    ids = [2 ** 62, 2 ** 63 - 1, -2 ** 63, 2 ** 60, -2 ** 62 + 3, None, 9]
    df = spark.createDataFrame([(i, "http://a/x", "h") for i in ids], "page_id long, url string, html string")
    records = op.captures_of(df).collect()
    named = [r.record_id for r in records if r.record_id is not None]
    assert len(set(named)) == len(named) and {72, 73, 74, 75, 76} <= set(named)
    assert op.report(df).count() == sum(not r.is_full for r in records)
