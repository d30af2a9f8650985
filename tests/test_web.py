"""URL, HTML, crawl and scoring operators on hand-made rows."""

from urllib.parse import urljoin, urlparse, urlunparse

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from weftloom.functions import urls
from weftloom.operators import crawl, html, scoring
from weftloom.operators.ordering import number_rows, running_max

RELAXED = settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in frame.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


URLS = [
    "http://a.example/x/", "http://a.example", "http://a.example/", "HTTP://A.Example:8080/Path/?q=1#f",
    "https://a.example/p;x=1", "https://a.example/p;x/q;y?z", "https://a.example//", "https://u:p@a.example/a|b", "/only/path",
]


def test_normalize(spark):
    def by_library(url):
        p = urlparse(url)
        return urlunparse((p.scheme, p.netloc, p.path.rstrip("/") or "/", "", "", ""))

    assert column(spark, URLS[:-1], urls.normalize) == [by_library(u) for u in URLS[:-1]]


def test_parts(spark):
    assert column(spark, URLS, urls.host) == [urlparse(u).netloc for u in URLS]
    assert column(spark, ["http://h/a/b.jpg", "http://h/a/", "http://h", "http://h/x;p"], urls.base_name) == ["b.jpg", "a", "", "x"]


REFERENCES = [
    "http://other.example/x/../y", "//host.example/x", "/x", "x", "../x", "./x", "?q=2", "", "#top", "../../../x", "a/./b/../c",
    "/a/b/..", "/a/./", "..", ".", "x?y#z", "x?", "x#", "mailto:a@b.example", "HTTPS://Up.example/Q", "a//b", "/a//b", "\tx\n y", "http:rel", "HTTP:/abs", "https:rel",
]
BASES = ["http://h.example/d/e/f?q=1#r", "http://h.example", "https://h.example/d/", "http://h.example/d//e/f"]


def resolved(spark, pairs):
    frame = spark.createDataFrame([(i, b, r) for i, (b, r) in enumerate(pairs)], "i int, b string, r string")
    return [x.u for x in frame.select("i", urls.resolve(F.col("b"), F.col("r")).alias("u")).orderBy("i").collect()]


def test_resolve(spark):
    pairs = [(b, r) for b in BASES for r in REFERENCES]
    assert dict(zip(pairs, resolved(spark, pairs))) == {(b, r): urljoin(b, r) for b, r in pairs}


@RELAXED
@given(st.lists(st.lists(st.sampled_from(["a", "b", "..", ".", "", "/", "c.jpg", "?k=v"]), min_size=1, max_size=7), min_size=20, max_size=60))
def test_resolve_property(spark, parts):
    pairs = [("http://h.example/p/q/r", "/".join(p)) for p in parts]
    pairs = [(b, r) for b, r in pairs if not r.startswith("//") and "?" not in r.replace("?k=v", "", 1)]
    assert resolved(spark, pairs) == [urljoin(b, r) for b, r in pairs]


def test_href_filter(spark):
    hrefs = ["javascript:x", "mailto:a", "tel:1", "#a", "data:x", "JavaScript:x", "ftp://h/x", "/ok", "x"]
    assert column(spark, hrefs, urls.navigates) == [False] * 5 + [True] * 4
    assert column(spark, ["JavaScript:x", "ftp://h/x", "HTTP://h/x"], urls.is_web) == [False, False, True]


def test_image_names(spark):
    named = ["http://h/A.JPG", "http://h/a.jpeg?v=1", "http://h/a.webp", "http://h/a.gif", "http://h/a.jpgx", "http://h/a.png/b"]
    assert column(spark, named, urls.is_image) == [True, True, True, False, False, False]
    names = column(spark, ["http://h/x/a.b.jpg", "http://h/x/noext", "http://h/"], urls.target_name)
    assert names[0] == "a.b.jpg" and all(n.startswith("img_") and len(n) == 16 for n in names[1:]) and names[1] != names[2]


def test_srcset(spark):
    got = column(spark, ["a.jpg 1x, b.jpg 2x", "lone.jpg", "a.jpg 1x,", "http://h/a,b.jpg 2x", " ,, "], urls.srcset_urls)
    assert got == [["a.jpg", "b.jpg"], ["lone.jpg"], ["a.jpg"], ["http://h/a", "b.jpg"], []]


PAGE = """<html><!-- <img src="/comment.jpg"> <a href="/comment">x</a> --><script>var t='<img src="/script.jpg">';</script>
<IMG src=" /one.jpg " data-src="two.png" data-lazy-src="//cdn.example/three.webp" data-original="four.jpeg?w=1"
 data-image="five.JPG" data-full="six.jpg" alt="seven.jpg">
<img src="data:image/png;base64,x.jpg"><img src="/one.jpg" srcset="s1.jpg 1x, s2.jpg 2x"><img data-src="">
<picture><source srcset="s3.webp 480w, s4.gif 800w"></picture>
<a href=" /in?x=1#y ">a</a><a href='mailto:q'>b</a><a>c</a><a href=../up/>d</a><a href="http://else.example/&amp;z">e</a><a href="/in">f</a>"""


def test_html_extraction(spark):
    pages = spark.createDataFrame(
        [(1, "http://h.example/d/page", PAGE), (2, "http://h.example/", "plain"), (3, "http://h.example/", None)],
        "page_id long, url string, html string",
    )
    found = html.page_image_urls(pages)
    base = "http://h.example/d/"
    assert {r.image_url for r in found.collect()} == {
        "http://h.example/one.jpg", base + "two.png", "http://cdn.example/three.webp", base + "four.jpeg?w=1", base + "five.JPG",
        base + "six.jpg", base + "s1.jpg", base + "s2.jpg", base + "s3.webp",
    }
    assert found.count() == 9
    links = [r.link for r in html.page_links(pages).orderBy("pos").collect()]
    assert links == ["http://h.example/in", "http://h.example/up", "http://else.example/&z", "http://h.example/in"]
    counts = {r.page_id: r.candidates for r in html.links_per_page(pages, found).collect()}
    assert counts == {1: 9, 2: 0, 3: 0}


@pytest.mark.parametrize("broken", ["<![ foo", "<![[x]]>", "<![foo[ <b", "<![if x]>", "<![CDATA[ x ]]>"])
def test_malformed_pages_keep_their_links(spark, broken):
    pages = spark.createDataFrame([(1, "http://h.example/", f'<a href="/1">{broken}<p>.</p><a href="/2">')], "page_id long, url string, html string")
    assert [r.link for r in html.page_links(pages).orderBy("pos").collect()] == ["http://h.example/1", "http://h.example/2"]


def test_links_resolve_against_the_final_url(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.example/x", "http://b.example/y/z", '<a href="k">')], "page_id long, url string, final_url string, html string"
    )
    assert [(r.url, r.link) for r in html.page_links(pages).collect()] == [("http://a.example/x", "http://b.example/y/k")]


def test_internal_links_compare_host_and_port(spark):
    links = spark.createDataFrame([("http://a.example/1",), ("http://a.example:81/2",), ("http://b.example/3",)], "link string")
    seeds = spark.createDataFrame([("https://a.example/",)], "url string")
    assert [r.link for r in crawl.internal_links(links, seeds).collect()] == ["http://a.example/1"]


def test_robots(spark):
    rules = spark.createDataFrame(
        [("a", "rules", 0, False, "/p", 0.0), ("a", "rules", 1, True, "/p/q", 0.0), ("b", "rules", 0, True, "/p/q", 0.2),
         ("b", "rules", 1, False, "/p", 0.2), ("deny", "deny_all", 0, None, None, None), ("open", "allow_all", 0, None, None, 5.0),
         ("lost", "unread", 0, None, None, 5.0), ("c", "rules", 0, False, "/?s", 3.0), ("empty", "rules", 0, False, "", None)],
        "host string, policy string, pos int, allow boolean, prefix string, crawl_delay double",
    )
    asked = ["http://a/p/q", "http://b/p/q", "http://b/p", "http://b/", "http://deny/", "http://open/x", "http://lost/", "http://new/", "http://c?s=1", "http://empty/x"]
    targets = spark.createDataFrame([(u,) for u in asked], "url string")
    allowed = {r.url: r.allowed for r in crawl.robots_allowed(targets, rules).collect()}
    assert [allowed[u] for u in asked] == [False, True, False, True, False, True, False, True, False, True]
    waits = {r.url: (r.delay, r.crawl_wait, r.scrape_wait) for r in crawl.crawl_delays(targets, rules).collect()}
    assert waits["http://a/p/q"] == (1.0, 1.0, 1.0) and waits["http://b/p"] == (0.2, 1.0, 0.5)
    assert waits["http://c?s=1"] == (3.0, 3.0, 3.0) and waits["http://lost/"] == waits["http://new/"] == (1.0, 1.0, 1.0)


def test_many_rules_of_one_host(spark):
    rules = spark.range(100_000).selectExpr(
        "'h' as host", "'rules' as policy", "cast(id as int) as pos", "id % 3 = 0 as allow", "concat('/', hex(id % 70000)) as prefix", "cast(null as double) as crawl_delay"
    )
    targets = spark.range(2_000).selectExpr("concat('http://h/', hex(id * 97), '/x') as url", "id as host")
    listed = [(r.allow, r.prefix) for r in rules.orderBy("pos").collect()]
    position = {}
    for at, (allow, prefix) in enumerate(listed):
        position.setdefault(prefix, (at, allow))
    for r in crawl.robots_allowed(targets, rules).collect():
        local = r.url.removeprefix("http://h")
        hits = [position[local[:n]] for n in range(len(local) + 1) if local[:n] in position]
        assert r.allowed == (min(hits)[1] if hits else True)


def test_many_crawls_together(spark, monkeypatch):
    links = spark.range(3_000).selectExpr("concat('http://s', id % 50, '/', id) as url", "concat('http://s', (id + 50) % 50, '/', id + 50) as link")
    away = spark.range(50).selectExpr("concat('http://s', id, '/', id) as url", "concat('http://s', (id + 1) % 50, '/', id + 1) as link")
    seeds = spark.range(500).selectExpr("concat('k', id) as crawl", "concat('http://s', id % 50, '/', id) as url").unionByName(
        spark.createDataFrame([(None, "http://s3/3"), (None, "http://s4/4")], "crawl string, url string").selectExpr("coalesce(crawl, 'both') as crawl", "url")
    )
    sites = seeds.selectExpr("crawl", "regexp_extract(url, '//([^/]*)', 1) as host")
    written = []
    original = crawl.scratch_path
    monkeypatch.setattr(crawl, "scratch_path", lambda spark: written.append(original(spark)) or written[-1])
    found = crawl.crawl_reachable(seeds, links.unionByName(away), None, sites)
    rows = found.collect()
    got = {(r.crawl, r.url): r.depth for r in rows}
    assert len(got) == len(rows) == sum(60 - i // 50 + 1 for i in range(500)) + 2 * 61
    assert got["k499", "http://s49/2999"] == 50 and got["both", "http://s4/3004"] == 60
    rounds = {r.p for r in spark.read.parquet(written[0]).selectExpr("round as p").distinct().collect()}
    assert len(rounds) <= 62


@pytest.mark.parametrize("small", [0, 10_000])
def test_crawl_depths(spark, monkeypatch, small):
    monkeypatch.setattr(crawl, "SMALL_FRONTIER", small)
    edges = [(f"u{i}", f"u{i + 1}") for i in range(12)] + [("u1", "u0"), ("u2", "u9"), ("s2", "u12"), ("z", "q")]
    links = spark.createDataFrame(edges, "url string, link string")
    seeds = spark.createDataFrame([("u0",), ("s2",)], "url string")
    closed = spark.createDataFrame([("u10",)], "url string")
    depth = {"u0": 0, "s2": 0, "u1": 1, "u12": 1, "u2": 2, "u3": 3, "u9": 3, "u4": 4, "u10": 4, "u5": 5, "u6": 6, "u7": 7, "u8": 8}
    assert {r.url: r.depth for r in crawl.crawl_reachable(seeds, links, closed).collect()} == depth


def test_only_html_is_expanded(spark):
    pages = spark.createDataFrame([(1, "text/html; charset=utf-8"), (2, "image/png"), (3, None)], "page_id int, content_type string")
    assert [r.page_id for r in crawl.expandable(pages).collect()] == [1]


def test_download_acceptance(spark):
    sizes = [(200, 500, 500), (200, 499, 900), (200, 501, -1), (404, 900, 900), (200, -1, -1)]
    frame = spark.createDataFrame(sizes, "status int, width int, height int")
    assert crawl.accepted_downloads(frame).count() == 1


def names_loop(rows):
    taken, out = {}, {}
    for keyword, pos, name in sorted(rows, key=lambda r: r[1]):
        used = taken.setdefault(keyword, set())
        candidate, n = name, 1
        while candidate in used:
            stem, ext = name.rsplit(".", 1)
            candidate, n = f"{stem}_{n}.{ext}", n + 1
        used.add(candidate)
        out[(keyword, pos)] = candidate
    return out


@RELAXED
@given(st.lists(st.sampled_from(["a.jpg", "a_1.jpg", "a_2.jpg", "a_1_1.jpg", "b.x.png", "b.x_1.png"]), min_size=1, max_size=25))
def test_collision_names(spark, names):
    rows = [("k" if i % 5 else "j", i, n) for i, n in enumerate(names)]
    got = crawl.collision_names(spark.createDataFrame(rows, "keyword string, pos long, name string"))
    assert {(r.keyword, r.pos): r.stored_name for r in got.collect()} == names_loop(rows)


NAMES = ["a.jpg", "a_1.jpg", "a_2.jpg", "a_1_1.jpg", "b.x.png", "b.x_1.png"]


@RELAXED
@given(st.lists(st.sampled_from(NAMES), min_size=1, max_size=20), st.sets(st.sampled_from([*NAMES, "a_3.jpg", "a_5.jpg", "a_01.jpg", "b.x_3.png"])))
def test_names_of_earlier_runs_are_taken(spark, names, earlier):
    rows = [("k" if i % 5 else "j", i, n) for i, n in enumerate(names)]
    stored = spark.createDataFrame([("k", n) for n in earlier] * 2, "keyword string, name string")
    got = crawl.collision_names(spark.createDataFrame(rows, "keyword string, pos long, name string"), stored)
    want = names_loop([("k", i - len(earlier), n) for i, n in enumerate(sorted(earlier))] + rows)
    assert {(r.keyword, r.pos): r.stored_name for r in got.collect()} == {at: name for at, name in want.items() if at[1] >= 0}


def test_second_run_stores_no_name_twice(spark):
    arrivals = spark.createDataFrame([("k", i, "a.jpg") for i in range(4)], "keyword string, pos long, name string")
    first = crawl.collision_names(arrivals).select("keyword", F.col("stored_name").alias("name"))
    second = crawl.collision_names(arrivals, first)
    assert [r.stored_name for r in second.orderBy("pos").collect()] == ["a_4.jpg", "a_5.jpg", "a_6.jpg", "a_7.jpg"]


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_number_rows(spark, hot_rows):
    rows = [("hot" if i % 3 else ("n" if i % 2 else None), (i * 37) % 401, f"p{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "g string, v int, payload string").repartition(5)
    got = number_rows(frame, ["g"], [F.col("v").desc()], "n", hot_rows=hot_rows).collect()
    for group in {"hot", "n", None}:
        ordered = sorted((r for r in rows if r[0] == group), key=lambda r: -r[1])
        assert sorted((r.n, r.payload) for r in got if r.g == group) == [(i, r[2]) for i, r in enumerate(ordered, 1)]


def test_running_max(spark):
    values = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8]
    frame = spark.createDataFrame([("g", i + 1, v) for i, v in enumerate(values)], "g string, i int, v int")
    got = running_max(frame, ["g"], "i", "v", "m", slice_rows=3).orderBy("i").collect()
    assert [r.m for r in got] == [max(values[: i + 1]) for i in range(len(values))]


def test_score_replies(spark):
    urls_ = spark.createDataFrame([("k", i, f"u{i}") for i in range(7)], "keyword string, pos int, url string")
    batches = scoring.score_batches(urls_, 2)
    requests = {r.batch: r.request for r in scoring.score_requests(batches).collect()}
    assert requests == {0: "0. u0\n1. u1", 1: "0. u2\n1. u3", 2: "0. u4\n1. u5", 3: "0. u6"}
    replies = spark.createDataFrame(
        [("k", 0, '```json\n[{"url": "u0", "score": 0.6}, {"url": "u0", "score": 0.9}, {"url": "x", "score": 0.7}]\n```'),
         ("k", 1, "Sorry, no."), ("k", 2, '[{"url": "u4"}, {"url": "u5", "score": 0.6}]'), ("k", 3, None)],
        "keyword string, batch int, reply string",
    )
    scores = scoring.with_failed_batches(scoring.parse_score_replies(replies), batches)
    last = scoring.last_scores(scores, urls_)
    assert {(r.url, r.score, r.requested) for r in last.collect()} == {
        ("u0", 0.9, True), ("x", 0.7, False), ("u2", 0.0, True), ("u3", 0.0, True), ("u4", 0.0, True), ("u5", 0.6, True), ("u6", 0.0, True),
    }
    assert [(r.rank, r.url) for r in scoring.relevant_urls(last).orderBy("rank").collect()] == [(1, "u0"), (2, "x"), (3, "u5")]


def test_empty_reply_is_no_failure(spark):
    batches = spark.createDataFrame([("k", 0, 0, 0, "u")], "keyword string, batch int, place int, pos int, url string")
    replies = spark.createDataFrame([("k", 0, "[]")], "keyword string, batch int, reply string")
    assert scoring.with_failed_batches(scoring.parse_score_replies(replies), batches).count() == 0


def test_header_sizes():
    from weftloom.functions.headers import header_size

    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc4\x00\x03x\xff\xc2\x00\x11\x08\x01\x00\x02\x00\x03"
    assert header_size(jpeg) == (512, 256)
    for broken in (None, b"", b"\xff\xd8", jpeg[:12], b"\x89PNG\r\n\x1a\n", b"RIFF1234WEBPVP8 ", b"GIF89a" + bytes(30)):
        assert header_size(broken) == (-1, -1)
