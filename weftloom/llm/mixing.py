"""Operator 2: mix sources to target weights by Poisson replication and a global shuffle.

Each document is repeated a Poisson-distributed number of times, whose mean is its source's target volume over its
present volume. The number comes from inverting the distribution at a uniform number that a hash of the seed and the document's id
gives, so a run can be repeated, and lost tasks come out the same again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weftloom.session import broadcast_if_small, materialize

SEED = "mix-1"
EXPONENT = 0.5  # of a source's share, where no weights are given: evens the sources out
SALTS = 32


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) with 52 bits, from a hash of the parts' text joined by ':'."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("-")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def target_rates(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, size: Column | None = None) -> DataFrame:
    """``(source, rate)``: mean repetitions that bring each source to its weight.

    ``size`` is a document's volume, by default 1. The mix is ``epochs`` times as large as all of ``docs``. ``weights(source, weight)`` need not add
    up to 1; a source without a weight gets rate 0. Without weights, a source's weight is its share to the power
    ``EXPONENT``. A source whose documents have no volume at all is repeated once on average.
    """
    volumes = docs.groupBy("source").agg(F.sum(F.lit(1) if size is None else size).cast("double").alias("volume"))
    if weights is None:
        given = volumes.withColumn("weight", F.pow("volume", F.lit(EXPONENT)))
    else:
        known = weights.select(F.col("source").alias("_source"), F.greatest("weight", F.lit(0)).cast("double").alias("weight"))
        given = volumes.join(known, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").fillna(0.0, ["weight"])
    total = given.agg(F.sum("volume").alias("_volume"), F.sum("weight").alias("_weight"))  # one row
    rate = F.lit(epochs) * F.col("_volume") * F.col("weight") / F.nullif(F.col("_weight") * F.col("volume"), F.lit(0.0))
    usual = F.when(F.col("volume") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return given.join(F.broadcast(total)).select("source", F.coalesce(rate, usual).alias("rate"))


def distribution_table(rates: DataFrame) -> DataFrame:
    """``(source, steps)``: the cumulative Poisson probabilities of 0, 1, 2 ... of each source's rate.

    They are summed from logarithms, so that no rate is too large, up to where less than 2^-60 is left.
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 20).cast("int")
    ks = rates.withColumn("k", F.explode(F.sequence(F.lit(0), last)))
    order = W.partitionBy("source").orderBy("k")
    factorial = F.sum(F.ln(F.greatest("k", F.lit(1)))).over(order)
    power = F.when(F.col("rate") == 0, F.when(F.col("k") == 0, 0.0)).otherwise(F.col("k") * F.ln("rate") - F.col("rate") - factorial)
    chances = ks.withColumn("p", F.coalesce(F.exp(power), F.lit(0.0)))
    summed = chances.withColumn("upto", F.sum("p").over(order))
    return summed.groupBy("source").agg(F.sort_array(F.collect_list("upto")).alias("steps"))


def _numbered(docs: DataFrame, doc_id: str) -> DataFrame:
    """``docs`` as ``(row, source, id, number)``; rows without an id or with a repeated one have a number of their own.

    The numbers are written down, so that they stay the same when executors are lost.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "source", F.col(doc_id).cast("string").alias("id"))
    repeated = materialize(rows.where("id is not null").groupBy("id").count().where("count > 1").select("id"))
    plain, odd = rows.where("id is not null"), rows.where("id is null")
    if not repeated.isEmpty():
        several = broadcast_if_small(repeated)
        odd = odd.unionByName(plain.join(several, "id", "left_semi").select(*rows.columns))
        plain = plain.join(several, "id", "left_anti").select(*rows.columns)
    elif odd.isEmpty():
        return plain.withColumn("number", F.lit(None).cast("long"))
    odd = materialize(odd.withColumn("number", F.monotonically_increasing_id()))
    return plain.withColumn("number", F.lit(None).cast("long")).unionByName(odd)


def mix(
    docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, size: Column | None = None,
    seed: str = SEED, doc_id: str = "doc_id",
) -> DataFrame:
    """The repeated documents in a global random order: all columns of ``docs``, then ``mix_copy`` (from 1) and ``mix_key``.

    A document's number of copies is the least k whose cumulative probability exceeds its uniform number. The result
    is dealt out and sorted by ``mix_key``, a hash of seed, id and copy. Rows without an id, and those that share one, each get a number, which
    goes into both hashes: they are drawn and dealt one by one. Documents of a null source form a source of
    their own; an empty table gives no rows. Columns ``mix_copy`` and ``mix_key`` of ``docs`` are replaced, all other names may be used.
    """
    columns = [name for name in docs.columns if name not in ("mix_copy", "mix_key")]
    steps = materialize(distribution_table(target_rates(docs, weights, epochs, size)).withColumnRenamed("source", "_source"))
    rows = _numbered(docs.select(*columns), doc_id)
    identity = F.when(F.col("number").isNull(), F.col("id")).otherwise(F.concat_ws(":", F.lit("row"), "id", "number"))
    drawn = rows.select("row", "source", identity.alias("identity"))
    small = broadcast_if_small(steps)
    same = F.col("source").eqNullSafe(F.col("_source"))
    if small is steps:  # too many to broadcast; one source may still hold most rows, so both sides are salted
        small = steps.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same &= F.pmod(F.xxhash64("identity"), F.lit(SALTS)) == F.col("_at")
    u = uniform(F.lit(seed), "identity")
    copies = F.size(F.filter("steps", lambda p: p <= F.col("u")))
    counted = drawn.join(small, same).withColumn("u", u).withColumn("copies", copies).where("copies > 0")
    repeated = counted.select("row", "identity", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("mix_copy"))
    keyed = repeated.withColumn("mix_key", uniform(F.lit(seed), F.lit("order"), "identity", F.col("mix_copy").cast("string")))
    dealt = keyed.repartition("mix_key").sortWithinPartitions("mix_key", "identity", "mix_copy")
    return dealt.select("row.*", "mix_copy", "mix_key")
