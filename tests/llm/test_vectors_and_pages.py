"""Vector, URL and archive operators: odd rows, empty tables, and brute force on small tables."""

import base64
import hashlib
import itertools

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lotledger.llm import common, components, link_trust, permutation_index, sorted_projection, warc_derivatives
from lotledger.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
SHAPE = "vec_id long, embedding array<double>, label int, n long, node long, score double, vec array<double>"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 1, 9, 9, 0.1, [1.0]) for i, e in rows], SHAPE)


ODD = [
    (50, [1.0, 0.0, 0.0]), (51, [1.0, 0.0, 0.0]), (52, [2.0, 0.0, 0.0]), (53, None), (54, []), (55, [0.0, 0.0, 0.0]),
    (56, [1.0, None, 0.0]), (57, [1.0, NAN, 0.0]), (58, [1.0, INF, 0.0]), (59, [0.95, 0.3, 0.0]), (None, [1.0, 0.0, 0.0]),
    (60, [0.0, 1.0]), (61, [0.0, 1.0]), (100, [0.0, 1.0, 0.0]), (100, [0.0, 1.0, 0.0]), (-50, [0.0, 0.9, 0.1]),
]


def test_nearest_odd_rows(spark):
    got = permutation_index.nearest(vectors(spark, ODD), F.col("vec_id") % 50 == 0, k=3, share=1.0).collect()
    by = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 6)) for r in got}
    assert by[50, 1] == (51, 1.0) and by[50, 2] == (52, 1.0) and by[50, 3][0] == 59
    assert by[100, 1][0] == -50 and by[-50, 1][0] == 100
    assert {r["query_id"] for r in got} == {50, 100, -50} and len(got) == 9
    assert permutation_index.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    alone = vectors(spark, [(50, [1.0, 2.0])])
    assert permutation_index.nearest(alone, F.col("vec_id") % 50 == 0).count() == 0


def brute_nearest(rows, k):
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=float)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i] / (norm * norm[i])
        s[i] = -9
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s))[:k]]
    return out


def test_nearest_recall(spark, sf=SF):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute_nearest(rows, 5)
    got = QUERIES["op3_permutation_index"](spark, sf).collect()
    assert {(r["query_id"], r["rank"]) for r in got} == set(itertools.product(want, range(1, 6)))
    found = {q: {r["vec_id"]: r["score"] for r in got if r["query_id"] == q} for q in want}
    hits = [v in found[q] for q, near in want.items() for v, _ in near]
    assert np.mean(hits) >= 0.95
    assert all(abs(found[q][v] - s) < 1e-12 for q, near in want.items() for v, s in near if v in found[q])


def test_gain_is_the_footrule(spark):
    rng = np.random.default_rng(0)
    length, n = 8, 20
    for _ in range(50):
        a, b = (rng.permutation(n)[:length] for _ in range(2))
        at = lambda order, p: int(np.flatnonzero(order == p)[0]) if p in order else length
        foot = sum(abs(at(a, p) - at(b, p)) for p in range(n))
        gain = sum(length - max(at(a, p), at(b, p)) for p in set(a) & set(b))
        assert foot == length * (length + 1) - 2 * gain


def brute_links(rows, cosine):
    good = {}
    for i, e in rows:
        if i is None or not e or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            continue
        good[i] = min(e, good.get(i, e))
    link = {i: set() for i in good}
    for a, b in itertools.combinations(good, 2):
        x, y = np.array(good[a]), np.array(good[b])
        if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
            link[a].add(b), link[b].add(a)
    out = {}
    for i in good:
        seen, open_ = {i}, [i]
        while open_:
            for j in link[open_.pop()] - seen:
                seen.add(j), open_.append(j)
        out[i] = len(link[i]), min(seen)
    return [(i, *out.get(i, (0, i)), i is None or out.get(i, (0, i))[1] == i) for i, _ in rows]


def test_near_vectors_odd_rows(spark):
    got = sorted_projection.near_duplicates(vectors(spark, ODD)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_links(ODD, 0.9), key=repr)
    assert sorted_projection.near_duplicates(vectors(spark, [])).count() == 0


def test_near_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sorted_projection, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    rows = [(i, list(map(float, rng.normal(size=16)))) for i in range(200)]
    rows += [(1000 + i, list(map(float, centre[i % 12] + rng.normal(size=16) * (0.02, 0.2, 0.3)[i % 3]))) for i in range(240)]
    rows += [(3000 + i, list(map(float, centre[0]))) for i in range(50)]
    got = sorted_projection.near_duplicates(vectors(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_links(rows, 0.9))


def test_window_goes_on_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(sorted_projection, "PIECE", 4)
    spread = [(i, [float(np.cos(i / 50)), float(np.sin(i / 50))]) for i in range(30)]
    df = spark.createDataFrame(spread, "node long, vec array<double>")
    codes = spark.createDataFrame([(0, i, i, i) for i in range(30)], "lot int, code long, node long, place long")
    got = {tuple(r) for r in sorted_projection.window_pairs(codes, df, 3, 0.9).collect()}
    assert got == {(i, j) for i in range(30) for j in range(i + 1, min(30, i + 4))}


def test_crowded_lots_are_compared_across_components(spark, monkeypatch):
    monkeypatch.setattr(sorted_projection, "BLOCK", 8)
    group = [(i, [1.0, i / 1000]) for i in range(40)]
    df = spark.createDataFrame(group + [(90, [1.0, 0.45]), (91, [0.0, 1.0])], "node long, vec array<double>")
    codes = df.selectExpr("0 as lot", "node as code", "node", "node as place")
    named = spark.createDataFrame([(i, 0) for i in range(40)], "node long, component long")
    got = [tuple(r) for r in sorted_projection.crowded_pairs(codes, df, named, 4, 32, 0.9).collect()]
    assert got and all(a < 40 and b == 90 for a, b in got)
    assert sorted_projection.crowded_pairs(codes, df, named, 4, 64, 0.9) is None


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    pairs += [(5000, i) for i in range(5001, 5200)] + [(7, 7), (None, 3), (3, None)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components.star_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: find(i) for i in parent} and len(got) == len(parent)
    assert components.star_components(spark.createDataFrame([], "a long, b long")).count() == 0


PAGES = "page_id long, url string, html string, host string, verdict string, block string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)


def rules(spark, rows):
    return spark.createDataFrame(rows, "rule_verdict string, rule_host string, rule_path string")


def test_urls_odd_rows(spark):
    rows = [
        (1, None, None), (2, "no scheme", "x"), (3, "http://", ""), (4, "HTTP://A.Example.COM", None), (None, "http://net", None),
        (5, "http://x.com?q=/en/", None), (6, "x://b.net/fr/a#f", None), (6, "x://b.net/fr/a#f", None), (7, "a://b://c/d", None),
        (8, "http://www.example.com/en/1", None), (9, "http://example.com/en/1", None), (10, "http://badexample.com/en/", None),
    ]
    got = link_trust.judge_pages(pages(spark, rows), rules(spark, [
        ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/fr/")]))
    by = {r["page_id"]: tuple(r)[1:] for r in got.collect()}
    assert got.count() == len(rows)
    assert by[1] == by[2] == ("", "", None, "allow") and by[3] == ("", "", None, "allow")
    assert by[4] == ("a.example.com", "", None, "allow") and by[5] == ("x.com", "", None, "allow")
    assert by[6] == ("b.net", "/fr/a", "net/fr/", "block") and by[7] == ("b:", "//c/d", None, "allow")
    assert by[8][2:] == ("www.example.com/en/", "allow") and by[9][2:] == ("example.com/en/", "block")
    assert by[10][2:] == ("com/", "allow")
    assert link_trust.judge_pages(pages(spark, []), rules(spark, [("allow", "com", "/")])).count() == 0
    assert {r["verdict"] for r in link_trust.judge_pages(pages(spark, rows), rules(spark, [])).collect()} == {"allow"}


def test_distrust_goes_against_links(spark):
    a = lambda *hosts: "".join(f'<a class=x href="https://{h}/p">t</a>' for h in hosts)
    rows = [
        (1, "http://bad.net/fr/1", a("good.com")), (2, "http://farm.org/1", a("bad.net", "bad.net", "BAD.net")),
        (3, "http://far.org/1", a("farm.org", "good.com", "good.com", "good.com")), (4, "http://good.com/1", a("praised.org")),
        (5, "http://praised.org/1", a("bad.net")), (6, "http://alone.org/1", "<a href='/own'>x</a>"),
    ]
    got = link_trust.judge_pages(pages(spark, rows), rules(spark, [("allow", "com", "/"), ("block", "net", "/fr/")]))
    verdict = {r["page_id"]: r["verdict"] for r in got.collect()}
    # bad.net shares its distrust among those who link to it; far.org gets all that farm.org has.
    edges = {(r["source"], r["target"]): r["links"] for r in link_trust.host_edges(pages(spark, rows)).collect()}
    assert edges["farm.org", "bad.net"] == 3 and ("alone.org", "alone.org") not in edges
    assert verdict == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}
    seeds = spark.createDataFrame([("bad.net", 0.0, 1.0), ("good.com", 1.0, 0.0)], "host string, trust double, distrust double")
    score = {r["host"]: r for r in link_trust.spread(link_trust.host_edges(pages(spark, rows)), seeds, 0.85, 16).collect()}
    # Dense iteration: shares go along links for trust, against them for distrust.
    hosts = sorted({h for edge in edges for h in edge} | {"bad.net", "good.com"})
    links = np.zeros((len(hosts), len(hosts)))
    for (source, target), n in edges.items():
        links[hosts.index(source), hosts.index(target)] = n
    for kind, start, matrix in (("trust", "good.com", links), ("distrust", "bad.net", links.T)):
        sums = matrix.sum(axis=1, keepdims=True)
        share = np.divide(matrix, sums, out=np.zeros_like(matrix), where=sums > 0)
        base = np.array([float(h == start) for h in hosts])
        now = base
        for _ in range(16):
            now = base + 0.85 * now @ share
        assert all(abs((score[h][kind] if h in score else 0.0) - v) < 1e-9 for h, v in zip(hosts, now))
        assert now.max() > 0.9
    # farm.org has three of the four links to bad.net, which meets its own distrust again in a cycle.
    assert abs(score["farm.org"]["distrust"] - 0.85 * 0.75 / (1 - 0.85**3 / 16)) < 2e-3


def test_archive_odd_rows(spark):
    rows = [
        (1, "http://a/1", "<p>One &amp; two</p><script>x<b></script><div>three<br>four</div>"), (1, "http://a/1", "<p>One &amp; two</p>"),
        (2, None, None), (3, "http://a/3", ""), (None, "http://a/4", "plain < text > é &amp;lt;"), (5, "http://a/5", "<p>" + "x " * 200_000),
    ]
    made = warc_derivatives.derivatives(
        warc_derivatives.responses_of_pages(pages(spark, rows), "2024-01-01T00:00:00Z"), ["page_id"]).collect()
    assert len(made) == 2 * len(rows)
    digest = lambda s: "sha1:" + base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    for r in made:
        assert r["block_digest"] == digest(r["block"]) and r["content_length"] == len(r["block"].encode())
        head, _, rest = r["record"].partition("\r\n\r\n")
        assert rest == r["block"] + "\r\n\r\n" and f"WARC-Refers-To: {r['refers_to']}" in head.split("\r\n")
        assert ("WARC-Target-URI" in head) == (r["target_uri"] is not None)
    text = {r["page_id"]: r["block"] for r in made if r["record_type"] == "conversion" and r["page_id"] != 1}
    first = [r["block"] for r in made if r["record_type"] == "conversion" and r["page_id"] == 1]
    assert sorted(first) == ["One & two", "One & two\nthree\nfour"]
    assert text[2] == "" and text[3] == "" and text[None] == "plain < text > é &lt;" and len(text[5]) == 399_999
    meta = next(r for r in made if r["page_id"] == 3 and r["record_type"] == "metadata")
    assert meta["block"].split("\r\n")[2:5] == ["source-http: HTTP/1.1 200 OK", "source-http: Content-Type: text/html; charset=utf-8", "source-http: Content-Length: 0"]
    assert meta["source_payload_digest"] == digest("")
    assert warc_derivatives.derivatives(warc_derivatives.responses_of_pages(pages(spark, []), "d"), []).count() == 0
    bare = spark.createDataFrame([("r", "u", "d", None), ("s", "u", "d", "HTTP/1.1 204 No Content\r\nX: y")], "record_id string, target_uri string, date string, block string")
    assert {r["block"] for r in warc_derivatives.derivatives(bare, []).collect() if r["record_type"] == "conversion"} == {""}


def plain(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = con.execute(ORACLE[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in r) for r in df.select(columns).collect()), key=repr) == want


def test_a_cluster_needs_a_shared_folder(spark):
    class Other:
        conf = type("C", (), {"get": staticmethod(lambda k, d: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})  # noqa: N815

    with pytest.raises(ValueError):
        common.shared_folder(Other, "x")
