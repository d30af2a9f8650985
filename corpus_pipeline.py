"""A corpus pipeline of the operators in ``weftloom.llm``: filter, fold near copies, mix, encode.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``, whose columns are those of ``documents``, perhaps with more,
whatever their names. All but the last stage return those columns. Nulls, empty and very long texts, repeated
rows and empty tables have the results that the stages' operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftloom.llm import bpe, langid, mixing, quality
from weftloom.llm.batches import bounded_batches
from weftloom.llm.jaccard_join import jaccard_components
from weftloom.llm.queries import byte_bpe_ranks
from weftloom.session import broadcast_if_small, materialize
from workloads.base import Registry, table

query = Registry()


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected: texts without a letter, and those of no language with enough certainty."""
    bounded_batches(spark)
    model = langid.train(docs)
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])  # so that added columns can't clash
    judged = langid.predict(numbered, model, f"c{names.index('text')}", tuple(numbered.columns))
    return judged.where("accepted").select(*numbered.columns).toDF(*names)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected: texts that fail the base rule, and outliers of their language and source."""
    rows = docs.select("doc_id", "lang", "source", "text", F.struct(*docs.columns).alias("row"))
    judged = quality.quality_rules(rows, keep=("doc_id", "lang", "source", "row"))
    return judged.where("kept").select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one of the smallest id stays; of rows with one id, one."""
    bounded_batches(spark)
    found = materialize(jaccard_components(docs))
    removed = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(broadcast_if_small(removed), "doc_id", "left_anti")
    repeated = materialize(found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"))
    if not repeated.isEmpty():
        several = broadcast_if_small(repeated)
        once = kept.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(several, "doc_id", "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards even sources, in a global random order; some drop out by their number 0."""
    rows = docs.select("doc_id", "source", F.struct(*docs.columns).alias("row"))
    return mixing.mix(rows).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with digests of the ids and of the bytes that they decode to."""
    bounded_batches(spark)
    ranks, pattern = byte_bpe_ranks()
    encoded = materialize(bpe.encode(docs, ranks, pattern))  # else each task has two Python workers, which stay for a while
    decoded = bpe.decode(encoded, ranks)
    return bpe.digests(decoded, keep=("doc_id", "ids"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: A trained model, a similarity join and a tokenizer have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs


query(ORACLE_SQL, "pipeline")(run)
