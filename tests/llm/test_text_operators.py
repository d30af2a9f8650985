"""Operators on single documents: language, quality, licenses, tokens, chat."""

import math
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute
import public_tokenizers

from weftloom.llm import bpe, chat, langid, licenses, quality, template, token_counts, words

SF = "/root/testdata/sf0.001"
EDGES = [None, "", " \n\t ", "a b c a b c", "x x x x", "é b\n\né b\n x", "<unk> ▁a <|endoftext|>", "word " * 30_000, "y" * 50_000, "🎉\x00\x1c ö"]


def frame(spark, texts, **columns):
    schema = "doc_id long, text string, lang string, source string, n_words string, score string"
    rows = [(i, t, columns.get("lang"), columns.get("source"), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ranks, own


# --- words ---


@pytest.mark.parametrize("piece", [4, 64, 1 << 20])
def test_words_equal_regex(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    texts = [t for t in EDGES if t is None or len(t) < 1000] + ["Ab aB\x0bAB", "longer than four"]
    known = {}
    for row, hashes, spans in words.words_and_spans(pa.array(texts)):
        own = brute.words(texts[row])
        assert len(hashes) == len(own)
        for word, h, (first, last) in zip(own, hashes.tolist(), spans.tolist()):
            assert (texts[row] or "").encode()[first:last].decode() == word
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


# --- 1 ---


def test_rejection_of_unlearned_languages_and_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    learned = docs.where("lang <> 'fr'")
    model = langid.train(learned)
    draw = random.Random(5)
    letters = lambda alphabet: " ".join("".join(draw.choice(alphabet) for _ in range(draw.randint(2, 9))) for _ in range(60))
    strange = [letters("bcdfghjklmnpqrstvwxz") for _ in range(40)] + [letters("αβγδεζηικλμνξοπρστυφχω") for _ in range(40)]
    strange += [letters("人生而自由在尊严和权利上一律平等") for _ in range(20)] + [letters("abcdefghijklmnopqrstuvwxyz") for _ in range(40)]
    junk = spark.createDataFrame([(i, t) for i, t in enumerate(strange)], "doc_id long, text string")
    share = lambda df: langid.predict(df, model).agg(F.avg(F.col("accepted").cast("int"))).first()[0]
    assert share(learned.where(langid.held_out())) >= 0.95
    assert share(docs.where("lang = 'fr'")) <= 0.1
    assert share(junk) <= 0.1


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    judged = langid.predict(docs.withColumn("score", F.lit(1)), model, keep=("doc_id", "lang", "text"))
    fold = judged.where(langid.held_out()).select((F.col("lang") == F.col("lang_pred")).alias("right"), "score", "accepted").collect()
    assert len(fold) > 200 and np.mean([r.right for r in fold]) > 0.97
    assert all(0 <= r.score <= 1 for r in fold) and np.mean([r.accepted for r in fold]) > 0.97


def test_language_edges(spark):
    trained = langid.train(frame(spark, ["the one and only"] * 20, lang="en").unionByName(frame(spark, ["der die das und"] * 20, lang="de")))
    got = {r.doc_id: r for r in langid.predict(frame(spark, EDGES + ["123 !?"]), trained).collect()}
    assert len(got) == len(EDGES) + 1
    for i, text in enumerate([*EDGES, "123 !?"]):
        none = not any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred == "und") == none and (got[i].score == 0 and not got[i].accepted if none else 0 < got[i].score <= 1)
    empty = frame(spark, []).where("false")
    assert langid.predict(empty, trained).count() == 0
    unlearned = langid.predict(frame(spark, ["text"]), langid.train(empty)).first()
    assert unlearned.lang_pred == "und" and not unlearned.accepted


def test_language_pieces_change_nothing():
    texts = ["One word, then ANOTHER; and more", None, "ü" * 40, "a b"]
    whole, cut = (
        sorted((r, b) for rows, buckets in langid.subwords(texts, size) for r, b in zip(rows.tolist(), buckets.tolist())) for size in (500, 12)
    )
    assert [x for x in whole if x[0] != 2] == [x for x in cut if x[0] != 2]  # only a word longer than a piece is cut


# --- 3 ---


def test_base_statistics(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    extra = frame(spark, EDGES).select((-1 - F.col("doc_id")).alias("doc_id"), "text", "lang", "source")
    both = docs.unionByName(extra)
    want = {r.doc_id: brute.statistics(r.text) for r in both.collect()}
    got = quality.base_statistics(both).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_outliers_of_a_group_are_rejected(spark):
    draw = random.Random(1)
    clean = [" ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(120)) for _ in range(60)]
    junk = ["".join(f" {w}{draw.choice('###|$')}" for w in text.split()) for text in clean[:10]]
    docs = frame(spark, clean + junk + [None, ""], lang="en")
    got = {r.doc_id: r for r in quality.quality_rules(docs.unionByName(docs)).collect()}
    assert all(got[i].kept for i in range(60)) and not any(got[i].kept for i in range(60, 72))
    assert got[70].base_failed and got[71].base_failed and not got[60].base_failed
    assert quality.quality_rules(docs.where("false")).count() == 0


def test_repeated_words_alone_reject(spark):
    draw = random.Random(2)
    words = lambda n: ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 8))) for _ in range(n)]
    clean = [words(120) for _ in range(60)]
    repeating = [w[:27] + w[:27] + w[27:93] for w in clean[:5]]
    vocabulary = words(900)
    weights = [1 / (i + 1) for i in range(900)]
    long = [draw.choices(vocabulary, weights, k=n) for n in (5_000, 20_000)]  # phrases recur, as in long prose
    docs = frame(spark, [" ".join(t) for t in clean + repeating + long], lang="en")
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert all(got[i].n_repeat_words == 54 and got[i].n_dup_lines == 0 for i in range(60, 65))
    assert all(got[i].kept for i in range(60)) and not any(got[i].kept or got[i].base_failed for i in range(60, 65))
    assert got[66].n_repeat_words > 1_000 and got[65].kept and got[66].kept


def test_quality_rules_against_plain_estimates(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    plain = brute.outlier_distances([(r.doc_id, r.lang, r.source, r.text) for r in docs.collect()])
    assert {i for i, r in got.items() if not r.base_failed} == set(plain)
    # the operator finds halves among distance bins: estimates differ a little, verdicts only next to the limit
    clear = [i for i, d in plain.items() if not 0.6 < d / quality.CUTOFF < 1.6]
    assert len(clear) > 0.9 * len(plain)
    assert all(got[i].kept == (plain[i] <= quality.CUTOFF) for i in clear)
    assert any(plain[i] > quality.CUTOFF for i in clear)


# --- 4 ---


def test_band_settings_hold_their_promise():
    for jaccard in (0.16, 0.3, 0.6, 0.9):
        bands, rows = licenses.band_settings(jaccard)
        assert 1 - (1 - jaccard**rows) ** bands >= licenses.CERTAINTY and bands * rows <= 128
    with pytest.raises(ValueError):
        licenses.band_settings(0.001)


def test_notices_are_found_with_their_places(spark):
    draw = random.Random(2)
    filler = lambda n: " ".join("".join(draw.choice("xyzuv") for _ in range(5)) for _ in range(n))
    texts, want = [None, "", "Licensed", filler(5000)], set()
    for name, notice in licenses.NOTICES.items():
        for before in (0, 3, 17, 200):
            want.add((len(texts), name))
            texts.append(f"é {filler(before)}\n{notice.upper()}!\n{filler(before)}")
    texts.append(f"{filler(300_000)} {licenses.NOTICES['MIT']} {filler(10)}")
    want.add((len(texts) - 1, "MIT"))
    got = licenses.scan_licenses(frame(spark, texts)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert want <= found
    for doc_id, name in found - want:  # near relatives of a notice that is there
        assert any(d == doc_id and name.split("-")[0][-3:] == n.split("-")[0][-3:] for d, n in want), (doc_id, name)
    for r in got:
        if r.containment == 1 and (r.doc_id, r.license) in want:
            assert texts[r.doc_id][r.start : r.end].lower() == licenses.NOTICES[r.license].lower()
    assert licenses.scan_licenses(frame(spark, []).where("false")).count() == 0


USUAL_WORDINGS = [
    ("© 2021 Jane Doe. All rights reserved.", {"all-rights-reserved"}),
    ("Licensed under the MIT License", {"MIT"}),
    ("Distributed under the terms of the MIT license.", {"MIT"}),
    ("# SPDX-License-Identifier: MIT", {"MIT"}),
    ("It is available under the Apache 2.0 license.", {"Apache-2.0"}),
    ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
    ("Foo is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
     "Free Software Foundation; either version 2 of the License, or (at your option) any later version.", {"GPL-2.0"}),
    ("Bar is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", {"AGPL-3.0"}),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
    ("See https://creativecommons.org/licenses/by-nc/4.0/ for more", {"CC-BY-NC-4.0"}),
    ("Copyright (c) 2009, The Regents. All rights reserved. Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met: * Redistributions of source code must retain the above copyright notice, "
     "this list of conditions and the following disclaimer. * Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE "
     "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
     "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
     "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
     "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
     "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.", {"all-rights-reserved", "BSD-redistribution", "BSD-2-Clause"}),
    ("The rights of all are reserved here, and a license is under the table", set()),
]


def test_usual_wordings_are_found(spark):
    draw = random.Random(4)
    filler = lambda n: " ".join("".join(draw.choice("xyzuv") for _ in range(5)) for _ in range(n))
    texts = [f"{filler(n)}\n{text}\n{filler(n)}" for n in (0, 2, 3, 250) for text, _ in USUAL_WORDINGS]
    found = {i: set() for i in range(len(texts))}
    for r in licenses.scan_licenses(frame(spark, texts)).collect():
        found[r.doc_id].add(r.license)
    assert [found[i] for i in range(len(texts))] == [want for _ in range(4) for _, want in USUAL_WORDINGS]


def test_every_license_line_of_the_documents_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {"all-rights-reserved": "All rights reserved.", "MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0."}
    found = {(r.doc_id, r.license) for r in licenses.scan_licenses(docs).collect()}
    for name, line in lines.items():
        holding = {r.doc_id for r in docs.where(F.contains("text", F.lit(line))).collect()}
        assert holding and {(i, name) for i in holding} <= found


# --- 6 ---


def test_bpe_equals_tiktoken(encoder):
    ranks, own = encoder
    tool, draw = bpe.ByteBpe(ranks, public_tokenizers.PATTERN), random.Random(3)
    alphabet = "aé \n\t'sßzЖ中1²\u00a0\u2003\u200b\x1c\x85🎉<|endoftext|>▁\x00"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(2000)]
    texts += [t or "" for t in EDGES] + [f"a{chr(c)} b{chr(c) * 2}" for c in range(0x2100)]
    for text, ids in zip(texts, tool.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text)
        assert tool.decode(ids) == text.encode()


def test_bpe_on_tables(spark, encoder):
    ranks, own = encoder
    docs = frame(spark, EDGES)
    got = bpe.digests(bpe.decode(bpe.encode(docs.unionByName(docs), ranks, public_tokenizers.PATTERN), ranks)).collect()
    assert len(got) == 2 * len(EDGES)
    for r in got:
        text = EDGES[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(text))
    assert bpe.encode(docs.where("false"), ranks, public_tokenizers.PATTERN).count() == 0


# --- 8 ---


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, encoder, rule):
    ranks, own = encoder
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "text").limit(60)
    extra = frame(spark, [*EDGES, "\n\n\na\n", "one\n \n two"]).select((-1 - F.col("doc_id")).alias("doc_id"), "source", "lang", "text")
    both = docs.unionByName(extra)
    got = {(r.doc_id, r.field, r.section): r for r in token_counts.count_tokens(both, ranks, public_tokenizers.PATTERN, rule).collect()}
    seen = 0
    for r in both.collect():
        text = "".join(f"{v or ''}\n" for v in (r.source, r.lang)) + (r.text or "")
        own_sections = sorted(k for k in got if k[0] == r.doc_id)
        own_sections.sort(key=lambda k: (token_counts.FIELDS.index(k[1]), k[2]))
        spans = [(got[k].start, got[k].end) for k in own_sections]
        assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        count, crossing, at, raw = [0] * len(spans), [0] * len(spans), 0, text.encode()
        for token in own.encode_ordinary(text):
            size = len(own.decode_single_token_bytes(token))
            first, end = len(raw[:at].decode(errors="ignore")), len(raw[: at + size].decode(errors="replace"))
            at += size
            share = [max(0, min(end, b) - max(first, a)) for a, b in spans]
            place = next(i for i, s in enumerate(share) if s) if rule == "first" else share.index(max(share))
            count[place] += 1
            crossing[place] += sum(s > 0 for s in share) > 1
        assert [got[k].n_tokens for k in own_sections] == count and [got[k].n_crossing for k in own_sections] == crossing
        seen += len(own_sections)
    assert seen == len(got)
    assert token_counts.count_tokens(both.where("false"), ranks, public_tokenizers.PATTERN).count() == 0


# --- 5 ---


def render(source, **scope):
    return "".join(text for text, _ in template.compile_template(source)(scope))


def test_template_language():
    assert render("{{ 'a' + 1 + 2 }}|{{ 1 + 2 }}{# no #}") == "a12|3"
    assert render("{% for x in xs -%}  {{ loop.index }}{{ x.a }}{% if not loop.last %},{% endif %}{% endfor %}", xs=[{"a": "p"}, {"a": "q"}]) == "1p,2q"
    assert render("{% if a == 1 %}one{% elif a in xs or not a %}two{% else %}more{% endif %}", a=2, xs=[2]) == "two"
    assert render("{% set b = a | upper %}{{ b }}{{ c | default('}}') }}", a="x") == "X}}"
    assert render("{{ a.__class__ }}{{ a['upper'] }}{{ x.y.z }}", a="text") == ""
    for broken in ("{% for x in y %}", "{{ a b }}", "{{ f(1) }}", "{% import os %}", "{{ a | eval }}", "{{ 'a }}"):
        with pytest.raises(template.TemplateError):
            template.compile_template(broken)


def test_template_folding():
    folded = template.fold(template.parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{{ x }}"))
    assert folded == (template.Output(template.Literal("abcd")), template.Output(template.Name("x")))
    marked = list(template.compile_template("a{% generation %}{{ x }}{% endgeneration %}")({"x": "y"}))
    assert marked == [("a", False), ("y", True)]


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|im_end|>", "a<|im_end|>\n<|im_start|>", "\\n\n\\", "|<|<"])
def test_escapes_are_reversible(text):
    assert chat.unguard(chat.guard(text)) == text and "<|" not in chat.guard(text)
    assert chat.whole_lines(chat.one_line(text)) == text and "\n" not in chat.one_line(text) and "<|" not in chat.one_line(text)


def test_chat_round_trip(spark, monkeypatch):
    rows = [(1, 0, "user", "a\nb"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\n"), (1, 2, None, None), (1, 3, "assistant", "é🎉"),
            (2, 0, "sys\ntem<|", "x"), (2, None, "user", "first"), (2, 5, "user", "tie b"), (2, 5, "user", "tie a"), (None, 0, "user", "no id"), (3, 0, "assistant", "")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"<\\|{i}" * 50) for i in range(300)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    for part_chars in (1_000_000, 700):
        monkeypatch.setattr(chat, "PART_CHARS", part_chars)
        formatted = chat.format_conversations(turns)
        pieces = formatted.collect()
        assert (max(r.part for r in pieces) > 0) == (part_chars == 700)
        got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
        key = lambda r: tuple((x is not None, x) for x in r[1:])
        for conv in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == conv), key=key)
            loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
            assert got[conv].n_turns == len(own)
            assert got[conv].turns_sha256 == brute.sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
            assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), brute.sha(loss))
            assert got[conv].formatted_chars == sum(len(r.formatted) for r in pieces if r.conv_id == conv)
    assert chat.format_conversations(turns.where("false")).count() == 0
