"""Operator 7: stupid-backoff scores from n-gram counts of the whole corpus.

Counts and look-ups are joins on the hash of an n-gram, done with packed rows. Documents are dealt into chunks. Each chunk sends its
distinct words and word pairs, with their numbers, to hash buckets, one packed row for each bucket; there the rows of all chunks make up
that bucket's count table, and each is answered by the total counts of its n-grams. The answers meet the chunks
again, where they are summed up for each document. An n-gram crosses the network once for each chunk that has it, so a
very common word sends no more rows than there are chunks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftloom.llm import words
from weftloom.session import materialize

BACKOFF = 0.4
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 12 << 20  # of text for each chunk and bucket
REQUESTS = "chunk int, bucket int, grams binary, counts binary"
ANSWERS = "chunk int, bucket int, counts binary"
SCORES = "doc_id long, n_words long, n_pairs_known long, n_unigram long, partial double"


def _pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences, byte by byte, so that the many zero bytes lie together and compress."""
    gaps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    return np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack_counts(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


class _Chunk:
    """The n-grams of a chunk's documents: for each place the word and, but for a document's first, the pair with the word before."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        text = table.column("text")
        text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
        rows, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for row, own, _ in words.word_hashes(text, lower=True):
            rows.append(row)
            hashes.append(own)
        self.doc = np.concatenate(rows)
        self.word = np.concatenate(hashes)
        pairs = words.windows(self.word, 2)
        self.second = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1  # places that have a word before them
        self.pair = pairs[self.second - 1]
        self.ids = table.column("doc_id")

    def grams(self) -> np.ndarray:
        return np.concatenate([self.word, self.pair])


def _bounds(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of hashes begins and ends among sorted hashes."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])


def _requests(buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        grams, counts = np.unique(_Chunk(table).grams(), return_counts=True)
        bounds = _bounds(grams, buckets)
        used = np.flatnonzero(np.diff(bounds))
        parts = [slice(bounds[b], bounds[b + 1]) for b in used]
        return pa.table({
            "chunk": pa.array(np.full(len(used), key[0].as_py()), pa.int32()), "bucket": pa.array(used, pa.int32()),
            "grams": pa.array([_pack(grams[p]) for p in parts], pa.binary()),
            "counts": pa.array([_pack_counts(counts[p]) for p in parts], pa.binary()),
        })

    return run


def _answers(key: tuple, table: pa.Table) -> pa.Table:
    """Totals of a bucket's n-grams, in the order in which each chunk asked."""
    grams = [_unpack(x.as_py()) for x in table.column("grams")]
    counts = np.concatenate([_unpack_counts(x.as_py()) for x in table.column("counts")])
    distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(place, counts, len(distinct)).astype(np.int64)[place]
    cuts = np.cumsum([len(x) for x in grams])[:-1]
    return pa.table({
        "chunk": table.column("chunk"), "bucket": table.column("bucket"),
        "counts": pa.array([_pack_counts(x) for x in np.split(total, cuts)], pa.binary()),
    })


def _scores(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
    chunk = _Chunk(docs)
    n = len(docs)
    grams, place = np.unique(chunk.grams(), return_inverse=True)
    answers = answers.sort_by("bucket")
    total = np.concatenate([np.empty(0, np.int64), *(_unpack_counts(x.as_py()) for x in answers.column("counts"))])
    # a document's own n-grams don't speak for it
    owner = np.concatenate([chunk.doc, chunk.doc[chunk.second]]).astype(np.int64)
    distinct, own, times = np.unique(owner * max(1, len(grams)) + place, return_inverse=True, return_counts=True)
    others = total[place] - times[own]
    word, pair = others[: len(chunk.word)], others[len(chunk.word) :]
    known = pair > 0
    context = word[chunk.second - 1]
    with_pair = np.zeros(len(word), bool)
    with_pair[chunk.second[known]] = True
    score = np.zeros(len(word))
    score[chunk.second[known]] = np.log10(pair[known] / context[known])
    # otherwise the word's own share, of a denominator that is subtracted once it is known; an unseen word counts as one, backed off again
    single = np.log10(np.maximum(word, 1)) + np.where(word > 0, 0.0, math.log10(BACKOFF))
    first = np.ones(len(word), bool)
    first[chunk.second] = False
    score[~with_pair] = (single + np.where(first, 0.0, math.log10(BACKOFF)))[~with_pair]
    per_doc = lambda weights=None: np.bincount(chunk.doc, weights, n)
    return pa.table({
        "doc_id": chunk.ids, "n_words": pa.array(per_doc(), pa.int64()),
        "n_pairs_known": pa.array(per_doc(with_pair).astype(np.int64)), "n_unigram": pa.array(per_doc(~with_pair).astype(np.int64)),
        "partial": pa.array(per_doc(score)),
    })


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_pairs_known, log10_score, mean_log10)`` for every row of ``docs``.

    Words are runs of other than ASCII white space, A-Z in lower case. A word is scored by c(before, word) / c(before) if that pair occurs
    elsewhere, else by ``BACKOFF`` times c(word) / N, and if the word doesn't either, by BACKOFF^2 / N; a document's first
    word has no pair and one BACKOFF less. Counts c and N words are those of all documents, c without the document itself. Null and empty
    texts have no words, score 0 and mean null. Repeated rows speak for each other, as copies do; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks, buckets = max(-(-size // CHUNK_BYTES), 1), max(-(-size // BUCKET_BYTES), min(deal, 16))
    # by id and text, so that rows that share an id, or have none, are spread as well
    placed = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    requests = placed.groupBy("chunk").applyInArrow(_requests(buckets), REQUESTS)
    answers = requests.groupBy("bucket").applyInArrow(_answers, ANSWERS)
    scored = materialize(placed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scores, SCORES))
    total = scored.agg(F.sum("n_words").alias("_words"))  # one row
    log = F.col("partial") - F.when(F.col("n_unigram") > 0, F.col("n_unigram") * F.log10("_words")).otherwise(0.0)
    return scored.join(F.broadcast(total)).select(
        "doc_id", "n_words", "n_pairs_known", log.alias("log10_score"),
        (log / F.nullif(F.col("n_words"), F.lit(0))).alias("mean_log10"),
    )
