"""Operators 11 to 13 against plain single-machine versions."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute

from weftloom.llm import collocations, queries, spelling, suffix_array, suffix_dedup

SF = "/root/testdata/sf0.001"
EDGES = [None, "", " \n\t ", "É", "é" * 300, "ab" * 30_000, "word " * 30_000, "y" * 50_000, "🎉\x00\x1c ö" * 90, "x" * 199, "x" * 200]


def frame(spark, texts, langs=None):
    rows = [(i if i % 7 else None, t, (langs or [None])[i % len(langs or [None])], "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, h1 string, key int")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# --- 11 ---


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_spelling_groups_of_documents(spark, documents):
    found = as_set(queries.op11_spelling_groups(spark, SF).select("word", "form", "root", "n", "n_near", "form_n"))
    assert found == brute.spelling_groups(brute.spelling_counts([(i, t) for i, _, t in documents]))
    assert any(w[1] for w in found) and any(w[4] > 1 for w in found)


@pytest.mark.parametrize("block_words", [7, 30_000])
def test_spelling_of_close_words(spark, monkeypatch, block_words):
    draw = random.Random(3)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(5, 7))) for _ in range(400)}
    words |= {"q" * n for n in range(1, 90)} | {"q" * 60 + x for x in "abÿ"} | {"a", "b", "ab", "ba", "÷×÷×÷×"}
    counts = {w: draw.choice([5, 5, 25, 125, 625]) for w in words}
    counted = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_set(spelling.spelling_groups(counted, block_words=block_words)) == brute.spelling_groups(counts)


def test_spelling_edges(spark):
    texts = EDGES + ["Straße ÉCOLE École naïveté"] * 5 + ["Ecole naivete naïvete écolé"] * 9
    found = as_set(spelling.spelling_groups(spelling.count_words(frame(spark, texts), 1, 1, 3)))
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    assert found == brute.spelling_groups(brute.spelling_counts(rows, 1, 1, 3))
    assert spelling.spelling_groups(spelling.count_words(frame(spark, []))).count() == 0


# --- 12 ---


@pytest.mark.parametrize("suffixes, chunk", [(3_000_000, 1_500_000), (50, 40)])
def test_collocations(spark, documents, monkeypatch, suffixes, chunk):
    monkeypatch.setattr("weftloom.llm.words.PIECE_BYTES", 64)
    texts = [t for _, _, t in documents[:60]] + [None, "", "A a, a a a a", "é b\té b\x0bé b", "to be or not to be " * 40, "in spite of " * 30, "x" * 300]
    langs = ["en", None, "und", "fr", "en"]
    docs = frame(spark, texts, langs)
    found = as_set(collocations.collocations(docs, 3, suffixes=suffixes, chunk_words=chunk))
    assert found == brute.collocations([(langs[i % 5], t) for i, t in enumerate(texts)], 3)
    assert collocations.collocations(docs.where("false")).count() == 0


def test_collocation_groups_keep_to_the_budget(spark, documents):
    docs = frame(spark, [t for _, _, t in documents[:60]])
    counted = collocations.count_words(docs)
    heavy, starts = collocations.plan_groups(counted, 200)
    total = sum(r.f for r in counted.collect())
    assert 0 < len(heavy) and total / 200 <= len(starts) <= 3 * total / 200


def test_scores_are_exact(spark):
    a, left, right = 10**13 - 7, 10**13, 10**13 - 3
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert row.select(collocations._score(row.a, row.l, row.r)).first()[0] == 1_000_000 * a * a // (left * right)


# --- 13 ---


def test_suffix_array():
    draw = random.Random(1)
    for _ in range(400):
        alphabet = draw.choice([b"a", b"ab", b"abc", bytes(range(256))])
        texts = [bytes(draw.choice(alphabet) for _ in range(draw.randint(1, draw.choice([3, 12, 40])))) for _ in range(draw.randint(1, 6))]
        symbols, _ = suffix_array.lay_out(texts + texts[: draw.randint(0, 2)])
        array = suffix_array.suffix_array(symbols)
        previous, shared = suffix_array.common_prefixes(symbols, array)
        closing = np.flatnonzero(symbols == 0)
        own = [symbols[i : closing[np.searchsorted(closing, i)]].tolist() for i in array]
        assert sorted(array.tolist()) == list(range(len(symbols))) and own == sorted(own)
        for j in range(1, len(own)):
            same = next((k for k, (x, y) in enumerate(zip(own[j - 1], own[j])) if x != y), min(len(own[j - 1]), len(own[j])))
            assert previous[array[j]] == array[j - 1] and shared[array[j]] == same


def removed(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_suffix_dedup_of_documents(spark, documents):
    found = removed(queries.op13_suffix_dedup(spark, SF))
    assert found == sorted(brute.remove_repeats([(i, t) for i, _, t in documents]), key=str)


@pytest.mark.parametrize("crowd, piece", [(3_000, 1 << 20), (4, 300)])
def test_suffix_dedup_edges(spark, documents, monkeypatch, crowd, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
    draw = random.Random(2)
    own = ["".join(draw.choice("abcdefg é") for _ in range(400)) for _ in range(40)]
    passage = "".join(draw.choice("hijklmn ü") for _ in range(230))
    texts = EDGES + [t[:150] + passage + t[150:] for t in own] + [own[0]] * 3 + [own[1] + own[2], own[1][10:] + passage[:199]]
    docs = frame(spark, texts)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    found = removed(suffix_dedup.remove_repeats(docs, crowd=crowd, shard_bytes=20_000))
    assert found == sorted(brute.remove_repeats(rows), key=str)
    assert suffix_dedup.remove_repeats(docs.where("false")).count() == 0
