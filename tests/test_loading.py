"""Sources, sinks, batch loading, ranking and reports on files the tests write."""

import json
import os
import struct
import subprocess
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from weftloom.functions.text import stem, suffix, three_decimals
from weftloom.operators import crawl, features, loader, ranking, reporting
from weftloom.plans import curate
from weftloom.sources import files, sinks
from weftloom.streaming.load import image_stream, stream_load

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def png(width, height, value=128):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    rows = b"".join(b"\0" + bytes([value]) * width for _ in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def put(root, keyword, name, data):
    folder = os.path.join(root, f"keyword={keyword}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as out:
        out.write(data)


def test_image_scans(spark, tmp_path):
    root = str(tmp_path)
    put(root, "k", "b.PNG", png(20, 10))
    put(root, "k", "a.png", png(500, 500, 7))
    put(root, "k", "notes.txt", b"x")
    put(root, "j", "c.jpeg", b"broken")
    listing = files.scan_images(spark, root)
    assert {(r.keyword, r.filename) for r in listing.collect()} == {("k", "a.png"), ("k", "b.PNG"), ("j", "c.jpeg")}
    ids = {(r.keyword, r.filename): r.image_id for r in files.with_image_ids(listing).collect()}
    assert ids == {("k", "a.png"): 1, ("k", "b.PNG"): 2, ("j", "c.jpeg"): 1} or ids[("k", "b.PNG")] == 1
    pixels = {r.filename: (r.height, r.width, r.channels) for r in files.scan_pixels(spark, root).collect()}
    assert pixels["a.png"] == (500, 500, 1) and pixels["b.PNG"] == (10, 20, 1) and pixels["c.jpeg"][0] == -1
    downloads = files.scan_pixels(spark, root).withColumn("status", F.lit(200))
    assert [r.filename for r in crawl.accepted_downloads(downloads).collect()] == ["a.png"]


def test_decoder_and_encoder_plug_in(spark):
    import numpy as np

    def decode(data):
        if data == b"bad":
            raise ValueError(data)
        return np.full((4, 5, 3), len(data))

    stored = spark.createDataFrame([("k", 1, bytearray(b"abc")), ("k", 2, bytearray(b"bad")), ("k", 3, None)],
                                   "keyword string, image_id long, image_bytes binary").where("image_id < 3 or true")
    rows = {r.image_id: r for r in features.decode_images(stored, lambda b: decode(b) if b != b"abc" else decode(b + b"d")).collect()}
    assert (rows[1].height, rows[1].width, rows[1].channels, set(rows[1].data)) == (4, 5, 3, {4})
    assert rows[2].height == rows[3].height == -1 and rows[2].data is None
    vectors = features.encode_images(stored, lambda batch: [None if b is None else [float(len(b))] for b in batch])
    assert {r.image_id: r.embedding for r in vectors.collect()} == {1: [3.0], 2: [3.0], 3: None}


def test_string_lists_and_manifests(spark, tmp_path):
    (tmp_path / "cache.json").write_text(json.dumps(["http://h/b", "http://h/a"], indent=2))
    listed = files.read_string_list(spark, str(tmp_path / "cache.json")).orderBy("pos").collect()
    assert [r.url for r in listed] == ["http://h/b", "http://h/a"]
    folder = tmp_path / "manifests"
    folder.mkdir()
    (folder / "k.json").write_text(json.dumps(
        {"keyword": "k", "uploaded": ["a.jpg"], "batch_count": 1, "total_count": 1, "last_updated": "2026-01-02T03:04:05.678901+00:00"}, indent=2))
    keywords = spark.createDataFrame([("k",), ("new",)], "keyword string")
    got = {r.keyword: r for r in files.read_manifests(spark, str(folder), keywords).collect()}
    assert got["k"].uploaded == ["a.jpg"] and got["k"].last_updated.microsecond == 678901
    assert (got["new"].uploaded, got["new"].batch_count, got["new"].total_count, got["new"].last_updated) == ([], 0, 0, None)


def test_first_row_of_a_name_wins(spark):
    rows = [("k", "a", 2, 0, b"late"), ("k", "a", 1, 5, b"first"), ("k", "a", 1, 9, b"x"), ("j", "a", 7, 0, b"other")]
    frame = spark.createDataFrame([(k, f, b, p, bytearray(d)) for k, f, b, p, d in rows],
                                  "keyword string, filename string, batch_id int, pos int, image_bytes binary")
    got = files.first_rows(frame, ["keyword", "filename"], ["batch_id", "pos"]).collect()
    assert {(r.keyword, bytes(r.image_bytes)) for r in got} == {("k", b"first"), ("j", b"other")}


def images(spark, names, keyword="k"):
    return spark.createDataFrame([(keyword, n, bytearray(n.encode())) for n in names], "keyword string, filename string, image_bytes binary")


def committed(spark, root):
    return {(r.filename, r.batch_id) for r in loader.read_ledger(spark, f"{root}/ledger").collect()}


def test_batches_continue_and_names_never_ship_twice(spark, tmp_path):
    root = str(tmp_path)
    load = lambda names: loader.load_batches(spark, images(spark, names), f"{root}/ledger", f"{root}/data", 2)
    load(["c.jpg", "a.jpg", "b.PNG", "skip.txt"])
    assert committed(spark, root) == {("a.jpg", 1), ("b.PNG", 1), ("c.jpg", 2)}
    load(["a.jpg", "d.webp", "0.jpeg", "e.jpg"])
    assert committed(spark, root) == {("a.jpg", 1), ("b.PNG", 1), ("c.jpg", 2), ("0.jpeg", 3), ("d.webp", 3), ("e.jpg", 4)}
    assert load(["a.jpg"]).count() == 0
    header = loader.manifest_header(loader.read_ledger(spark, f"{root}/ledger")).first()
    assert (header.batch_count, header.total_count) == (4, 6) and header.last_updated is not None
    names = loader.manifest_uploaded(loader.read_ledger(spark, f"{root}/ledger")).orderBy("batch_id").collect()
    assert [r.uploaded for r in names] == [["a.jpg", "b.PNG"], ["c.jpg"], ["0.jpeg", "d.webp"], ["e.jpg"]]
    shards = files.scan_shards(spark, f"{root}/data")
    assert shards.count() == 6 and "PartitionFilters: [isnotnull(keyword" in plan(shards.where("keyword = 'k'"))


def plan(frame):
    return frame._jdf.queryExecution().toString()


def test_failed_verification_leaves_rows_pending(spark):
    assigned = spark.createDataFrame([("k", n, b) for n, b in [("a", 1), ("b", 1), ("c", 2), ("d", 3)]] + [("j", "a", 1)],
                                     "keyword string, filename string, batch_id int")
    stored = spark.createDataFrame([("k", "a", 1), ("k", "b", 1), ("k", "x", 2), ("k", "c", 2), ("k", "d", 3), ("j", "a", 1), ("k", "old", 0)],
                                   "keyword string, filename string, batch_id int")
    verified = loader.verified_batches(assigned, stored)
    assert {(r.keyword, r.batch_id) for r in verified.collect()} == {("k", 1), ("k", 3), ("j", 1)}
    rows = loader.commit_rows(assigned, verified)
    assert {(r.keyword, r.filename) for r in rows.collect()} == {("k", "a"), ("k", "b"), ("k", "d"), ("j", "a")}


def test_reused_number_replaces_its_batch(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([("k", "a.jpg", 1), ("k", "b.jpg", 2)], "keyword string, filename string, batch_id int")
    again = spark.createDataFrame([("k", "c.jpg", 2)], "keyword string, filename string, batch_id int")
    stock = images(spark, ["a.jpg", "b.jpg", "c.jpg"])
    loader.write_batches(first, stock, root)
    loader.write_batches(again, stock, root)
    assert {(r.filename, r.batch_id) for r in files.scan_shards(spark, root).collect()} == {("a.jpg", 1), ("c.jpg", 2)}


def test_stream_arrivals_and_replay(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda checkpoint: stream_load(
        image_stream(spark, source), f"{root}/ledger", f"{root}/data", f"{root}/{checkpoint}", 2
    ).awaitTermination()
    for name in ("a.jpg", "b.jpg", "c.jpg"):
        put(source, "k", name, name.encode())
    run("c1")
    assert committed(spark, root) == {("a.jpg", 1), ("b.jpg", 1), ("c.jpg", 2)}
    put(source, "k", "d.png", b"d")
    put(source, "j", "a.jpg", b"j")
    run("c1")
    want = {("a.jpg", 1), ("b.jpg", 1), ("c.jpg", 2), ("d.png", 3)}
    assert committed(spark, root) == want and loader.read_ledger(spark, f"{root}/ledger").count() == 5
    run("c2")  # a lost checkpoint replays everything
    assert committed(spark, root) == want and loader.read_ledger(spark, f"{root}/ledger").count() == 5
    assert files.scan_shards(spark, f"{root}/data").count() == 5


def test_names_and_decimals(spark):
    frame = spark.createDataFrame([(0.6345,), (1.0005,), (0.5,), (None,)], "s double")
    assert [r.t for r in frame.select(three_decimals("s").alias("t")).collect()] == ["0.634", "1.000", "0.500", None]
    names = spark.createDataFrame([("a.b.JPG",), ("noext",), (".hidden",)], "n string")
    assert [(r.s, r.t) for r in names.select(suffix(F.col("n")).alias("s"), stem(F.col("n")).alias("t")).collect()] == [
        (".jpg", "a.b"), ("", "noext"), ("", ".hidden")]


def test_bands_and_verdicts(spark):
    scored = spark.createDataFrame(
        [("k", 1, 0.75), ("k", 2, 0.7499), ("k", 3, 0.5), ("k", 4, 0.4999), ("k", 5, None), ("k", 6, 0.75), ("k", 7, 0.6), ("k", 8, 0.55)],
        "keyword string, image_id long, score double",
    )
    banded = ranking.person_bands(scored)
    assert [r.band for r in banded.orderBy("image_id").collect()] == ["keep", "review", "review", "exclude", "exclude", "keep", "review", "review"]
    replies = spark.createDataFrame([("k", 2, "  yes."), ("k", 3, "No"), ("k", 7, "\n\tYES"), ("k", 1, "yes"), ("k", 8, None)],
                                    "keyword string, image_id long, reply string")
    outcome = ranking.with_outcome(banded, ranking.parse_verdicts(replies))
    counts = ranking.filter_counts(outcome).first()
    assert (counts.kept, counts.excluded, counts.reviewed) == (4, 4, 4)
    assert [(r.rank, r.image_id) for r in ranking.final_output(outcome).orderBy("rank").collect()] == [(1, 1), (2, 6), (3, 8), (4, 3)]
    keywords = spark.createDataFrame([("k",), ("empty",)], "keyword string")
    assert {r.keyword: r.images for r in ranking.run_summary(keywords, ranking.final_output(outcome)).collect()} == {"k": 4, "empty": 0}


def test_ranked_sink_drops_stale_ranks(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda k, n: spark.createDataFrame([(k, i, i) for i in range(1, n + 1)], "keyword string, rank int, image_id long")
    sinks.write_ranked(rows("a", 3).unionByName(rows("b", 2)), root)
    sinks.write_ranked(rows("a", 1), root)
    assert {r.keyword: r["count"] for r in spark.read.parquet(root).groupBy("keyword").count().collect()} == {"a": 1, "b": 2}


def test_report_pages_are_documents(spark, tmp_path):
    rows = [("k", i, 0.9 - i / 100, i) for i in range(1, 8)]
    named = ranking.with_output_names(spark.createDataFrame(rows, "keyword string, image_id long, score double, rank int"), ".webp")
    cards = reporting.report_cards(named)
    first = cards.orderBy("rank").first()
    assert (first.output_name, first.score_text, first.percent) == ("rank0001_sim0.890.webp", "0.890", 89)
    anchors = spark.createDataFrame([("k", "k.jpg"), ("none", "none.jpg")], "keyword string, anchor_path string")
    whole = {r.keyword: r.html for r in reporting.report_html(cards, anchors, 100).collect()}
    parts = reporting.report_html(cards, anchors, 3)
    assert parts.where("keyword = 'k'").count() == 3
    pages = [r.html for r in parts.where("keyword = 'k'").orderBy("part").collect()]
    assert all(p.startswith("<!DOCTYPE html>") and p.endswith("</table>\n") for p in [*pages, *whole.values()])
    assert [p.count("<tr><td>") for p in pages] == [3, 3, 1] and whole["k"].count("<tr><td>") == 7
    assert "images 4 to 6 of 7, page 2 of 3" in pages[1] and "of 0, page 1 of 1" in whole["none"]
    sinks.write_reports(parts, str(tmp_path))
    stored = spark.read.text(str(tmp_path), wholetext=True).where("keyword = 'k'").orderBy("part").collect()
    assert [r.value.strip() for r in stored] == [p.strip() for p in pages]


def test_stored_pages_to_scoring_requests(spark):
    pages = spark.createDataFrame(
        [(1, "http://h.example/", '<a href="/a">'), (2, "http://h.example/a", '<a href="/b/"><a href="/secret"><a href="http://x.example/">'),
         (3, "http://h.example/secret", '<a href="/hidden">')],
        "page_id long, url string, html string",
    )
    seeds = spark.createDataFrame([("http://h.example/",)], "url string")
    robots = spark.createDataFrame([("h.example", "rules", 0, False, "/secret", None)],
                                   "host string, policy string, pos int, allow boolean, prefix string, crawl_delay double")
    keywords = spark.createDataFrame([("k",)], "keyword string")
    request = curate.acquire(pages, seeds, robots, keywords).first().request
    assert request == "0. http://h.example/\n1. http://h.example/a\n2. http://h.example/b\n3. http://h.example/secret"


ROBOTS = "host string, policy string, pos int, allow boolean, prefix string, crawl_delay double"


def test_crawl_ends_at_what_is_forbidden_no_html_or_elsewhere(spark):
    pages = spark.createDataFrame(
        [(1, "http://h.example/", None, "text/html", '<a href="/a"><a href="/png"><a href="/moved"><a href="/no">'),
         (2, "http://h.example/a", None, "text/html", '<a href="/"><a href="/b">'), (3, "http://h.example/png", None, "image/png", '<a href="/x">'),
         (4, "http://h.example/moved", "http://h.example/new/place", "text/html", '<a href="here">'),
         (5, "http://h.example/no", None, "text/html", '<a href="/hidden">'), (6, "http://own.example/no/seed", None, "text/html", '<a href="/y">'),
         (7, "http://own.example/fine", None, "text/html", '<a href="/z">')],
        "page_id long, url string, final_url string, content_type string, html string",
    )
    seeds = spark.createDataFrame(
        [(None, "http://h.example/"), ("own", "http://own.example/no/seed"), ("own", "http://own.example/fine")], "keyword string, url string"
    )
    robots = spark.createDataFrame([(h, "rules", 0, False, p, None) for h, p in [("h.example", "/no"), ("own.example", "/no")]] +
                                   [("h.example", "rules", 1, False, "", None)], ROBOTS)
    keywords = spark.createDataFrame([("own",), ("k",), ("l",)], "keyword string")
    got = {r.keyword: [line.split(". ")[1].removeprefix("http://") for line in r.request.split("\n")] for r in curate.acquire(pages, seeds, robots, keywords).collect()}
    shared = ["h.example/", "h.example/a", "h.example/b", "h.example/moved", "h.example/new/here", "h.example/no", "h.example/png"]
    assert got == {"k": shared, "l": shared, "own": ["own.example/fine", "own.example/no/seed", "own.example/z"]}


def test_media_type(spark):
    starts = {b"\x89PNG\r\n\x1a\n123456": "image/png", b"RIFF\x01\x02\x03\x04WEBPVP8 ": "image/webp", b"\xff\xd8\xff": "image/jpeg", b"": "image/jpeg"}
    frame = spark.createDataFrame([(bytearray(k),) for k in starts], "content binary")
    assert [r[0] for r in frame.select(ranking.media_type(F.col("content"))).collect()] == list(starts.values())


def test_workers_get_the_package_from_the_driver(tmp_path):
    """A session handed in by a program that runs elsewhere, whose workers don't find the repository."""
    program = (
        "import sys; from pyspark.sql import SparkSession; s = SparkSession.builder.master('local[2]')"
        f".config('spark.checkpoint.dir', '{tmp_path}/shared').config('spark.ui.enabled', 'false').getOrCreate(); sys.path.insert(0, {ROOT!r}); "
        "import __spark_entry__ as e; print('rows', e.queries()['image_urls'](s, '/root/testdata/sf0.001').count()); s.stop()"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows " in out.stdout, out.stderr[-2000:]


def test_no_checkpoint_folder_off_a_local_master(spark, monkeypatch):
    from weftloom import session

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        session.checkpoint_root(Cluster)


def test_stream_load_reads_a_table_of_many_files(spark, tmp_path):
    from workloads import loading

    rows = [(i, "text" * (i % 5), "en", f"s{i % 2}", 4 * (i % 5)) for i in range(90)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda row: (row.keyword, row.batch_id, row.images, row.bytes)
    found = sorted(map(key, loading.stream_load(spark, str(tmp_path)).collect()))
    assert found == sorted(map(key, loading.batch_roundtrip(spark, str(tmp_path)).collect()))
    assert sum(images for _, _, images, _ in found) == 90
