"""Operators that compare documents or gather from all of them, and the pipeline."""

import math
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute
import corpus_pipeline
import oracle

import __spark_entry__ as registered
from weftloom.llm import bpe, jaccard_join, langid, lm, mixing, quality, queries, topk
from weftloom.llm.graph import components

SF = "/root/testdata/sf0.001"


def documents(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", f"s{i % 3}", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, node string")


def near_copies(seed=4):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(draw.choice([5, 30, 120, 300]))]
        if draw.random() < 0.5:
            base[3:3] = passage
        for _ in range(draw.choice([1, 2, 9])):
            own = list(base)
            for _ in range(draw.randint(0, 6)):
                own[draw.randrange(len(own))] = word()
            texts.append(" ".join(own))
    return texts


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (102, 101), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 9 ---


@pytest.mark.parametrize("seed", [4, 5])
def test_jaccard_join(spark, seed, monkeypatch):
    if seed == 5:  # frequent shingles are found, and joins are not broadcast
        monkeypatch.setattr(jaccard_join, "_HINT_COUNT", 3)
        monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    texts = near_copies(seed)
    texts += [None, "", " \n", "one two", "One  TWO", "a b c d e", "a b c d e", "w " * 40_000, "w " * 39_999, texts[0], texts[0].upper()]
    got = jaccard_join.jaccard_components(documents(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard_components(list(enumerate(texts)))


def test_jaccard_join_of_repeated_rows(spark):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [base, base + " x", " ".join(f"v{i}" for i in range(60)), base + " y"]
    rows = spark.createDataFrame([(min(i, 2), t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = jaccard_join.jaccard_components(rows.crossJoin(spark.range(3_000).select()))
    assert {tuple(r) for r in found.groupBy("doc_id", "component_id").count().collect()} == {(0, 0, 3_000), (1, 0, 3_000), (2, 0, 6_000)}


def test_jaccard_join_names_a_pair_seldom_more_than_once(spark, monkeypatch):
    def words_of(seed, number):
        return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**9, number)]

    shared = words_of(0, 1000)
    texts = [" ".join(shared + words_of(i, 500)) for i in range(1, 13)] + [" ".join(shared + words_of(i, 100)) for i in range(20, 24)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(7, " ".join(words_of(99, 1490))), (2, texts[3] + " end")]  # ids of several texts, of several sizes
    cross, made = jaccard_join._cross_pairs, []

    def counted(*args):
        pairs = cross(*args)
        alone = pairs.where("a not in (2, 7) and b not in (2, 7)")
        made.append((alone.count(), alone.distinct().count()))
        return pairs

    monkeypatch.setattr(jaccard_join, "_cross_pairs", counted)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").distinct().collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, {3: 2}.get(i, min(i, 12))) for i in range(16)]
    (all_rows, pairs), = made
    assert 30 <= pairs <= all_rows <= 10 * pairs  # they share some 250 shingles of the first block


def test_jaccard_join_edges(spark):
    text = "a b c d e f g"
    docs = documents(spark, [text, text, text, "other words are in this one", "other words are in this one"], [5, 5, None, 5, 9])
    got = sorted((r.doc_id or -1, r.component_id) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(-1, None), (5, 5), (5, 5), (5, 5), (9, 5)]
    assert jaccard_join.jaccard_components(docs.where("false")).count() == 0


def test_pairs_below_the_bound_are_given_up():
    draw = np.random.default_rng(1)
    left, right, truth = [], [], []
    for _ in range(300):
        n, m, shared = draw.integers(1, 80), draw.integers(1, 80), draw.integers(0, 80)
        values = np.unique(draw.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2))
        shared = min(shared, n, m)
        a, b = np.sort(values[:n]), np.sort(np.concatenate([values[:shared], values[n : n + m - shared]]))
        left.append(a)
        right.append(b)
        both = len(np.intersect1d(a, b))
        truth.append(100 * both >= 75 * (len(a) + len(b) - both))
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    assert jaccard_join.possible_pairs(left, right, *sizes).tolist() == truth
    quarter = [[x[x < np.uint64(1 << 62)] for x in side] for side in (left, right)]
    assert all(jaccard_join.possible_pairs(*quarter, *sizes)[np.array(truth)])


# --- 2 ---


def test_mixing_rates_and_distribution(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise("c").alias("source"),
        F.lit("t").alias("text"), F.lit(1).alias("rate"),
    )
    weights = spark.createDataFrame([("hot", 1.0), (None, 3.0), ("absent", 5.0)], "source string, weight double")
    got = mixing.mix(docs, weights, epochs=2.0)
    assert got.columns[:4] == docs.columns
    counts = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert "c" not in counts and abs(counts["hot"] - 10_000) < 500 and abs(counts[None] - 30_000) < 900
    copies = got.where("source = 'hot'").groupBy("doc_id").count().groupBy("count").count().collect()
    expected = {k: 6667 * math.exp(-1.5) * 1.5**k / math.factorial(k) for k in (1, 2, 3)}
    seen = {r[0]: r[1] for r in copies}
    assert all(abs(seen[k] - expected[k]) < 6 * math.sqrt(expected[k]) for k in expected)
    assert got.select("mix_key").distinct().count() == got.count()
    assert got.select("doc_id", "mix_copy").exceptAll(mixing.mix(docs, weights, epochs=2.0).select("doc_id", "mix_copy")).isEmpty()


def test_mixing_rows_without_an_id_of_their_own(spark):
    names = ["doc_id", "source", "steps", "_source", "mix_copy", "mix_key", "row", "identity", "number", "copies", "u"]
    rows = [(None if i % 2 else 7, "a" if i % 10 else "b", *["x"] * 9) for i in range(20_000)]
    docs = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    found = mixing.mix(docs.repartition(8), spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double"))
    found = found.toPandas()
    assert list(found.columns) == [*(n for n in names if n not in ("mix_copy", "mix_key")), "mix_copy", "mix_key"]
    for count in found.groupby("source").size():
        assert abs(count - 10_000) < 5 * 100
    assert found.mix_key.is_unique and set(found.steps) == {"x"}


def test_mixing_edges(spark, monkeypatch):
    docs = documents(spark, [None, "", "a", "a"], [1, 1, None, 2])
    usual = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "broadcast_if_small", lambda df: df)  # the salted join gives the same rows
    assert sorted(map(str, mixing.mix(docs).collect())) == usual
    assert mixing.mix(docs.where("false")).count() == 0
    rates = spark.createDataFrame([("a", 0.0), ("b", 900.0), (None, 1.0)], "source string, rate double")
    steps = {r.source: r.steps for r in mixing.distribution_table(rates).collect()}
    assert steps["a"][0] == 1 and abs(steps["b"][900] - 0.5) < 0.02 and abs(steps["b"][-1] - 1) < 1e-9
    assert steps[None][0] == pytest.approx(math.exp(-1))


# --- 7 ---


def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 30_000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 30_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80)
    extra = documents(spark, [None, "", "the", "the the the", "novel-word", "x " * 30_000], [-1, -2, -3, -3, -4, -5]).select("doc_id", "text")
    both = docs.unionByName(extra)
    rounded = lambda rows: sorted((a, b, c, round(d, 6)) for a, b, c, d in rows)
    got = [(r.doc_id, r.n_words, r.n_pairs_known, r.log10_score) for r in lm.score_documents(both).collect()]
    assert rounded(got) == rounded(brute.lm_scores([tuple(r) for r in both.collect()]))
    assert lm.score_documents(both.where("false")).count() == 0


# --- 10 ---


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_PART", 150)
    monkeypatch.setattr(topk, "QUERY_PART", 3)
    monkeypatch.setattr(topk, "BLOCK_CANDIDATES", 64)
    draw = random.Random(6)
    rows = [(i, [round(draw.gauss(0, 1), 2) for _ in range(20)]) for i in range(1000)]
    rows += [(i + 1000, rows[i][1]) for i in range(0, 1000, 50)]  # ties
    rows += [(5001, None), (5002, [1.0, None]), (5100, [float("nan")] * 20), (5200, [float("inf")] * 20), (None, [1.0] * 20), (6000, []), (6001, [2.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted(tuple(r) for r in topk.exact_top_k(frame, F.col("vec_id") % 100 == 0).collect())
    padded = [(i, v + [0.0] * (20 - len(v)) if v is not None and None not in v else v) for i, v in rows]
    assert got == brute.top_k(padded)
    assert topk.exact_top_k(frame.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    few = topk.exact_top_k(frame.where("vec_id in (100, 101, 102)"), F.col("vec_id") % 100 == 0).collect()
    assert [r.rank for r in few] == [1, 2]


@pytest.mark.parametrize("big", [1, 1 << 16])  # the second beyond doubles, within 64 bits
def test_top_k_of_several_vectors_of_an_id(spark, monkeypatch, big):
    monkeypatch.setattr(topk, "CANDIDATE_PART", 40)
    monkeypatch.setattr(topk, "QUERY_PART", 2)
    draw = random.Random(8)
    rows = [(i, [float(big * draw.randint(-9, 9)) for _ in range(6)]) for i in [*range(200), *range(0, 200, 5), *range(0, 200, 25), 100, 100]]
    rows += [rows[0], rows[7]]  # equal rows
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.exact_top_k(frame, F.col("vec_id") % 100 == 0).collect())
    whole, most, want = [(i, [int(1024 * x) for x in v]) for i, v in rows], (1 << 63) - 1, []
    for q in (0, 100):
        asked = [v for i, v in whole if i == q]
        best = [(max(sum(a * b for a, b in zip(v, c)) for v in asked), i) for i, c in whole if i != q]
        ranked = sorted(((max(-most, min(most, score)), i) for score, i in best), key=lambda x: (-x[0], x[1]))[:10]
        want += [(q, n, i, score) for n, (score, i) in enumerate(ranked, 1)]
    assert got == want


def test_top_k_beyond_doubles():
    ids, big = np.array([1, 2, 3]), np.array([[1 << 30, 1], [1 << 30, 2], [-(1 << 30), 0]])
    (query, found, scores), = topk.best_in_cell(ids, big, np.array([9]), np.array([[1 << 30, 1]]), 2)
    assert found.tolist() == [2, 1] and scores.tolist() == [(1 << 60) + 2, (1 << 60) + 1]


def test_top_k_prunes(monkeypatch):
    """With a good candidate in the first block, far ones are compacted away before their last dimensions."""
    draw = np.random.default_rng(3)
    vectors = draw.integers(-50, 50, (8192, 64))
    vectors[7, :16] = 1000
    queries = np.zeros((1, 64), np.int64)
    queries[0, :16] = 1000
    (_, found, scores), = topk.best_in_cell(np.arange(8192), vectors, np.array([-1]), queries, 1)
    assert found.tolist() == [7] and scores.tolist() == [16_000_000]


# --- registered queries and the pipeline ---


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.query.oracles))
def test_equals_sql(spark, con, name):
    assert oracle.difference(registered.queries()[name](spark, SF), con, queries.query.oracles[name]) is None


def test_one_query_for_each_operator():
    names = [n.split("_")[0] for n in registered.queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 11)) and "pipeline" in registered.queries()


def test_pipeline(spark, tmp_path):
    """The pipeline's rows by plain loops, with the operators' own models."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    copies = table.where("doc_id < 6").withColumn("doc_id", F.col("doc_id") + 5000)
    odd = spark.createDataFrame([(9001, None, None, None, 0), (9002, "", "en", "src0", 0), (9002, "12 34", "en", None, 5)], table.schema)
    table.unionByName(copies).unionByName(odd).withColumn("accepted", F.lit("clash")).withColumn("k", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = langid.train(docs)
    rows = [r for r in docs.collect()]
    fine = {r.doc_id for r in langid.predict(docs, model).where("accepted").collect()}
    rows = [r for r in rows if r.doc_id in fine]
    stats = quality.quality_rules(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in stats.where("kept").collect()}
    rows = [r for r in rows if r.doc_id in kept]
    groups = brute.jaccard_components([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if groups[r.doc_id][1] == r.doc_id]
    assert not {r.doc_id for r in rows} & {r.doc_id for r in copies.collect()}
    mixed = mixing.mix(spark.createDataFrame(rows, docs.schema)).collect()
    ranks, pattern = queries.byte_bpe_ranks()
    tool = bpe.ByteBpe(ranks, pattern)
    want = sorted((r.doc_id, brute.sha(next(tool.encode_many([r.text])))) for r in mixed)
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((r.doc_id, r.ids_sha256) for r in got.collect()) == want and len(want) > 50


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0 and (name == "byte_bpe" or out.columns == docs.columns)


def test_byte_bpe_stage_has_one_python_worker_for_each_task(spark):
    docs = spark.createDataFrame([(1, "a few words"), (2, None)], "doc_id long, text string")
    found = corpus_pipeline.byte_bpe(spark, docs, "")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert found.count() == 2
