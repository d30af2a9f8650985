"""Feature, duplicate, ranking and report queries over ``embeddings`` and ``documents``.

The published thresholds find nothing in these tables, so the queries name their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftloom.functions.vectors import as_double, cosine, l2_normalize, median_bits, pearson
from weftloom.operators import dedup, features, greedy, ranking, reporting, simjoin
from weftloom.operators.dedup import Layer
from weftloom.operators.simjoin import HammingIndex, StructureIndex, VectorIndex
from weftloom.params import CurationParams
from weftloom.plans import curate
from weftloom.session import materialize, scratch_path
from weftloom.sources import sinks
from weftloom.streaming import dedup as streaming_dedup
from workloads.base import (
    HIST_SQL, VECTORS_SQL, Registry, cosine_edges_sql, greedy_sql, texts, unit_sql, vectors,
)

query = Registry()

COSINE, BITS, BYTES = 0.3, 20, 0.98
BANDS = CurationParams(embedding_min=COSINE, rank_min=0.0, keep_min=0.2, review_min=0.05)

UNITS_SQL = VECTORS_SQL + "," + unit_sql("vectors", "units")
BITS_SQL = VECTORS_SQL + """,
flags AS (
  SELECT keyword, image_id, list_transform(v, lambda x: (x > (list_sort(v)[32] + list_sort(v)[33]) / 2)::INTEGER) AS f FROM vectors),
wide AS (SELECT keyword, image_id, list_reduce(f::HUGEINT[], lambda acc, x: acc * 2 + x) AS w FROM flags),
hashes AS MATERIALIZED (
  SELECT keyword, image_id, CASE WHEN w >= 9223372036854775808 THEN w - 18446744073709551616 ELSE w END::BIGINT AS bits FROM wide)"""
BIT_EDGES_SQL = """
bit_edges AS MATERIALIZED (
  SELECT x.keyword, x.image_id AS a, y.image_id AS b, bit_count(xor(x.bits, y.bits))::DOUBLE AS score
  FROM hashes x JOIN hashes y ON x.keyword = y.keyword AND x.image_id < y.image_id
  WHERE bit_count(xor(x.bits, y.bits)) <= 20)"""


def _hashed(spark, sf) -> DataFrame:
    return vectors(spark, sf).withColumn("bits", median_bits(as_double(F.col("embedding"))))


def _histograms(spark, sf) -> DataFrame:
    return features.byte_histograms(texts(spark, sf), "content")


def _some_anchors(spark, sf) -> DataFrame:
    """Anchors of the labels below 7 alone, for queries about keywords without one."""
    return _anchors(spark, sf).where("keyword < '7'")


def _anchors(spark, sf) -> DataFrame:
    """The first vector of each label is its anchor."""
    return vectors(spark, sf).groupBy("keyword").agg(F.min_by("embedding", "image_id").alias("embedding"))


def _candidates(spark, sf) -> DataFrame:
    """Vectors to rank: all but the anchors, which are not images of the corpus."""
    firsts = vectors(spark, sf).groupBy("keyword").agg(F.min("image_id").alias("image_id"))
    return vectors(spark, sf).join(firsts, ["keyword", "image_id"], "left_anti")


# --- features ---


@query(f"WITH {BITS_SQL} SELECT image_id, bits FROM hashes", "median_bits")
def median_bit_hash(spark, sf):
    return _hashed(spark, sf).select("image_id", "bits")


@query(f"WITH {HIST_SQL} SELECT image_id, bin, round(w, 6) AS weight FROM bins")
def byte_histogram(spark, sf):
    bins = features.binned_histogram(_histograms(spark, sf))
    return bins.select("image_id", "bin", F.round("weight", 6).alias("weight"))


@query(f"""
WITH {HIST_SQL}, {unit_sql('hists', 'u', True)}, firsts AS (SELECT keyword, arg_min(v, image_id) AS f FROM u GROUP BY 1)
SELECT image_id, round(list_dot_product(v, f), 6) AS correlation FROM u JOIN firsts USING (keyword)""")
def histogram_correlation(spark, sf):
    """Every document's histogram against that of the first document of its source."""
    hists = materialize(_histograms(spark, sf))
    firsts = hists.groupBy("keyword").agg(F.min_by("hist", "image_id").alias("first"))
    score = pearson(F.col("hist"), F.col("first"))
    return hists.join(firsts, "keyword").select("image_id", F.round(score, 6).alias("correlation"))


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (vec_id + 2)) AS v FROM embeddings),
u AS (SELECT vec_id, list_transform(v, lambda x: round(x / sqrt(list_dot_product(v, v)), 6)) AS v FROM v)
SELECT vec_id AS image_id, unnest(range(64))::INTEGER AS place, unnest(v) AS value FROM u""", "l2_normalize")
def l2_normalized(spark, sf):
    stretched = F.transform(as_double(F.col("embedding")), lambda x: x * (F.col("image_id") + 2))
    unit = vectors(spark, sf).select("image_id", F.posexplode(l2_normalize(stretched)).alias("place", "value"))
    return unit.withColumn("value", F.round("value", 6))


@query(f"""
WITH {UNITS_SQL}, anchors AS (SELECT keyword, arg_min(v, image_id) AS f FROM units GROUP BY 1)
SELECT image_id, round(list_dot_product(v, f), 6) AS score FROM units JOIN anchors USING (keyword)""")
def cosine_to_anchor(spark, sf):
    scored = ranking.score_against_anchor(vectors(spark, sf), _anchors(spark, sf))
    return scored.select("image_id", F.round("score", 6).alias("score"))


@query("""
WITH sized AS (
  SELECT doc_id AS image_id, encode(text) AS data, octet_length(encode(text)) AS n,
         greatest(ceil(sqrt(octet_length(encode(text)))), 1)::INTEGER AS width FROM documents),
shaped AS (SELECT *, greatest(ceil(n / width), 1)::INTEGER AS height FROM sized),
pixels AS (
  SELECT image_id, width, height, place // width AS y, place % width AS x, ('0x' || byte)::INTEGER AS value
  FROM (SELECT image_id, width, height, unnest(range(n)) AS place, unnest(regexp_extract_all(hex(data), '..')) AS byte FROM shaped)),
axes AS (
  SELECT DISTINCT size, area FROM (
    SELECT width AS size, height >= 32 AS area FROM shaped UNION ALL SELECT height, height >= 32 FROM shaped)),
centres AS (
  SELECT size, area, i, least(greatest((i + 0.5::DOUBLE) * size / 32 - 0.5::DOUBLE, 0), size - 1) AS centre FROM axes, range(32) t(i) WHERE NOT area),
spans AS (
  SELECT size, area, i, unnest(range(floor(i * size / 32)::INTEGER, least(ceil((i + 1) * size / 32)::INTEGER, size))) AS source
  FROM axes, range(32) t(i) WHERE area),
taps AS (
  SELECT size, area, i, floor(centre)::BIGINT AS source, 1 - (centre - floor(centre)) AS share FROM centres
  UNION ALL SELECT size, area, i, least(floor(centre)::BIGINT + 1, size - 1), centre - floor(centre) FROM centres
  UNION ALL SELECT size, area, i, source,
    (least((i + 1) * size / 32, source + 1) - greatest(i * size / 32, source)) * 32 / size FROM spans),
bases AS MATERIALIZED (
  SELECT size, area, source, k, sum(2 * cos(pi() * k * (2 * i + 1) / 64) * share) AS factor FROM taps, range(8) f(k) GROUP BY ALL),
lines AS (
  SELECT image_id, height, y, k AS l, sum(value * factor) AS value
  FROM pixels JOIN bases ON size = width AND area = (height >= 32) AND source = x GROUP BY ALL),
found AS (
  SELECT image_id, k, l, sum(value * factor) AS value
  FROM lines JOIN bases ON size = height AND area = (height >= 32) AND source = y GROUP BY ALL),
coefficients AS (
  SELECT s.image_id, k.k * 8 + l.l AS place, round(coalesce(f.value, 0), 6) AS value
  FROM shaped s CROSS JOIN range(8) k(k) CROSS JOIN range(8) l(l) LEFT JOIN found f ON f.image_id = s.image_id AND f.k = k.k AND f.l = l.l
  WHERE s.n IS NOT NULL),
middles AS (SELECT image_id, median(value) AS middle FROM coefficients GROUP BY 1),
wide AS (
  SELECT image_id, sum(CASE WHEN value > middle THEN 1::HUGEINT << (63 - place)::HUGEINT ELSE 0 END) AS w
  FROM coefficients JOIN middles USING (image_id) GROUP BY 1)
SELECT s.image_id, (CASE WHEN w >= 9223372036854775808 THEN w - 18446744073709551616 ELSE w END)::BIGINT AS bits
FROM shaped s LEFT JOIN wide USING (image_id)""")
def perceptual_hash(spark, sf):
    """Documents as gray images of one byte a pixel, resampled to 32 by 32; signs of the lowest cosine coefficients against their median."""
    pixels = features.bytes_as_pixels(texts(spark, sf), "content")
    return features.pixel_features(pixels, ("bits",)).select("image_id", "bits")


# --- similarity joins and first-wins resolution ---


def _rounded(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("score", F.round("score", 6))


PAIRS = "SELECT keyword, a, b, round(score, 6) AS score FROM"


@query(f"WITH {BITS_SQL}, {BIT_EDGES_SQL} {PAIRS} bit_edges")
def hamming_pairs(spark, sf):
    return _rounded(simjoin.similar_pairs(_hashed(spark, sf), HammingIndex(BITS)))


@query(f"WITH {HIST_SQL}, {unit_sql('hists', 'u', True)}, {cosine_edges_sql('u', 'e', '> 0.999')} {PAIRS} e")
def histogram_pairs(spark, sf):
    index = VectorIndex(0.999, "hist", centred=True)
    return _rounded(simjoin.similar_pairs(materialize(_histograms(spark, sf)), index))


@query(f"WITH {UNITS_SQL}, {cosine_edges_sql('units', 'e', f'> {COSINE}')} {PAIRS} e")
def cosine_pairs(spark, sf):
    return _rounded(simjoin.similar_pairs(vectors(spark, sf), VectorIndex(COSINE)))


@query()
def ssim_pairs(spark, sf):
    pixels = features.bytes_as_pixels(texts(spark, sf), "content")
    rasters = materialize(features.pixel_features(pixels, ("gray",), small=True))
    return _rounded(simjoin.similar_pairs(rasters, StructureIndex(0.8)))


FATE = "SELECT keyword, image_id, kept, removed_by FROM g"


@query(f"WITH RECURSIVE {UNITS_SQL}, {cosine_edges_sql('units', 'e', f'> {COSINE}')}, {greedy_sql('units', 'e', 'g')} {FATE}")
def greedy_dedup_cosine(spark, sf):
    return dedup.run_layer(vectors(spark, sf), Layer("embedding", VectorIndex(COSINE), "pass")).drop("layer")


@query(f"WITH RECURSIVE {BITS_SQL}, {BIT_EDGES_SQL}, {greedy_sql('hashes', 'bit_edges', 'g')} {FATE}")
def greedy_dedup_hamming(spark, sf):
    return dedup.run_layer(_hashed(spark, sf), Layer("hash", HammingIndex(BITS))).drop("layer")


@query(f"""
WITH RECURSIVE {HIST_SQL}, {unit_sql('hists', 'u', True)}, {cosine_edges_sql('u', 'e', f'> {BYTES}')},
{greedy_sql('hists', 'e', 'g')} {FATE}""")
def greedy_dedup_histogram(spark, sf):
    layer = Layer("histogram", VectorIndex(BYTES, "hist", centred=True), "flat")
    return dedup.run_layer(materialize(_histograms(spark, sf)), layer).drop("layer")


LETTERS_SQL = HIST_SQL + """,
folded AS (
  SELECT keyword, image_id, list_transform(range(1, 65), lambda i: v[i] + v[i + 64] + v[i + 128] + v[i + 192]) AS v FROM hists),
middles AS (SELECT keyword, image_id, v, list_sort(v) AS o FROM folded),
letter_flags AS (SELECT keyword, image_id, list_transform(v, lambda x: (x > (o[32] + o[33]) / 2)::INTEGER) AS f FROM middles),
letter_wide AS (SELECT keyword, image_id, list_reduce(f::HUGEINT[], lambda acc, x: acc * 2 + x) AS w FROM letter_flags),
letters AS MATERIALIZED (
  SELECT keyword, image_id, CASE WHEN w >= 9223372036854775808 THEN w - 18446744073709551616 ELSE w END::BIGINT AS bits FROM letter_wide),
letter_edges AS MATERIALIZED (
  SELECT x.keyword, x.image_id AS a, y.image_id AS b
  FROM letters x JOIN letters y ON x.keyword = y.keyword AND x.image_id < y.image_id
  WHERE bit_count(xor(x.bits, y.bits)) <= 8)"""


@query(f"WITH RECURSIVE {LETTERS_SQL}, {greedy_sql('letters', 'letter_edges', 'g')} {FATE}")
def greedy_dedup_letters(spark, sf):
    """Which bytes are frequent, as a hash of 64 places for all 256 values; near duplicates at the published distance 8."""
    folded = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: sum((F.get("hist", i + 64 * k) for k in (1, 2, 3)), F.get("hist", i)))
    bits = median_bits(folded)
    hashed = materialize(_histograms(spark, sf).select("keyword", "image_id", bits.alias("bits")))
    return dedup.run_layer(hashed, Layer("hash", HammingIndex(8))).drop("layer")


@query(f"""
WITH RECURSIVE {UNITS_SQL}, {cosine_edges_sql('units', 'e', f'> {COSINE}')}, {greedy_sql('units', 'e', 'g')}
SELECT keyword, 'embedding' AS layer, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS removed FROM g GROUP BY 1""")
def dedup_counts(spark, sf):
    decisions = dedup.run_layer(vectors(spark, sf), Layer("embedding", VectorIndex(COSINE), "pass"))
    return greedy.dedup_counts(decisions)


ARRIVAL = 1_000_000_000_000


@query(f"""
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT label::VARCHAR AS keyword, vec_id + vec_id % 4 * {ARRIVAL} AS image_id, embedding::DOUBLE[] AS v FROM embeddings),
{unit_sql('vectors', 'units')}, {cosine_edges_sql('units', 'e', f'> {COSINE}')}, {greedy_sql('units', 'e', 'g')}
SELECT keyword, image_id % {ARRIVAL} AS image_id, kept, removed_by % {ARRIVAL} AS removed_by FROM g""")
def stream_dedup_cosine(spark, sf):
    """Vectors arrive in four deliveries, ids of remainder 0 first; every delivery is resolved against what was kept of those before."""
    root = scratch_path(spark)
    items = vectors(spark, sf)
    for delivery in range(4):
        items.where(F.pmod("image_id", F.lit(4)) == delivery).write.mode("append").parquet(f"{root}/arrived")
        stream = spark.readStream.schema(items.schema).parquet(f"{root}/arrived")
        streaming_dedup.stream_dedup(stream, VectorIndex(COSINE), f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return streaming_dedup.decisions(spark, f"{root}/state")


@query(f"""
WITH RECURSIVE {UNITS_SQL}, {cosine_edges_sql('units', 'e', '> 0.2')}, {greedy_sql('units', 'e', 'g')}
SELECT removed_by, count(*) AS removed FROM g WHERE NOT kept GROUP BY 1""")
def removed_by(spark, sf):
    """How many images each kept one removed, from given edges."""
    items = vectors(spark, sf)
    decisions = greedy.greedy_dedup(items, simjoin.similar_pairs(items, VectorIndex(0.2)))
    return decisions.where("not kept").groupBy("removed_by").agg(F.count("*").alias("removed"))


@query(f"""
WITH RECURSIVE {UNITS_SQL}, {cosine_edges_sql('units', 'band', '> 0.2')},
e AS MATERIALIZED (SELECT * FROM band WHERE score > {COSINE}), {greedy_sql('units', 'e', 'g')}
SELECT p.keyword, p.a, p.b, 'review_' || p.a || '_vs_' || p.b || '_' || printf('%.3f', p.score) || '.jpg' AS output_name
FROM band p JOIN g ga ON ga.image_id = p.a AND ga.kept JOIN g gb ON gb.image_id = p.b
WHERE p.score <= {COSINE} AND (gb.removed_by IS NULL OR gb.removed_by > p.a)""")
def review_pairs(spark, sf):
    """Pairs below the removal threshold but above 0.2, by the review rule, with their file names."""
    items = vectors(spark, sf)
    band = simjoin.similar_pairs(items, VectorIndex(0.2)).where(F.col("score") <= COSINE)
    decisions = dedup.run_layer(items, Layer("embedding", VectorIndex(COSINE), "pass"))
    review = greedy.review_pairs(band, decisions).select(
        "keyword", "a", "b", "score", F.col("a").cast("string").alias("a_stem"), F.col("b").cast("string").alias("b_stem"),
        F.lit(".jpg").alias("suffix"),
    )
    return ranking.review_names(review).select("keyword", "a", "b", "output_name")


CASCADE_SQL = f"""{BITS_SQL}, {BIT_EDGES_SQL}, {greedy_sql('hashes', 'bit_edges', 'g1')},
n2 AS MATERIALIZED (SELECT keyword, image_id, v FROM vectors JOIN g1 USING (keyword, image_id) WHERE kept),
{unit_sql('n2', 'u2', True)}, {cosine_edges_sql('u2', 'e2', f'> {COSINE}')}, {greedy_sql('n2', 'e2', 'g2')},
n3 AS MATERIALIZED (SELECT keyword, image_id, v FROM vectors JOIN g2 USING (keyword, image_id) WHERE kept),
{unit_sql('n3', 'u3')}, {cosine_edges_sql('u3', 'e3', '> 0.2')}, {greedy_sql('n3', 'e3', 'g3')}"""


@query(f"""
WITH RECURSIVE {CASCADE_SQL}
SELECT 'hash' AS layer, keyword, image_id, kept, removed_by FROM g1
UNION ALL SELECT 'histogram', keyword, image_id, kept, removed_by FROM g2
UNION ALL SELECT 'embedding', keyword, image_id, kept, removed_by FROM g3""")
def dedup_cascade(spark, sf):
    """Three layers on the vectors: median bits, correlation, cosine; each on the survivors of the last."""
    items = materialize(_hashed(spark, sf))
    layers = [
        Layer("hash", HammingIndex(BITS)),
        Layer("histogram", VectorIndex(COSINE, "embedding", centred=True), "flat"),
        Layer("embedding", VectorIndex(0.2), "pass"),
    ]
    return dedup.deduplicate(items, layers)[1]


@query()
def image_dedup(spark, sf):
    """All four layers on documents as pixel images; small documents stand for the embeddings' vectors."""
    content = texts(spark, sf)
    pixels = features.pixel_features(features.bytes_as_pixels(content, "content"), small=True)
    items = materialize(pixels.withColumn("embedding", F.col("hist")))
    layers = dedup.standard_layers(CurationParams(embedding_min=0.999, histogram_min=0.999))
    survivors, _ = dedup.deduplicate(items, layers)
    return dedup.retained(items, survivors)


@query(f"""
WITH RECURSIVE {UNITS_SQL},
fine AS MATERIALIZED (SELECT * FROM units WHERE keyword <> '3' AND image_id % 10 <> 0),
{cosine_edges_sql('fine', 'e', f'> {COSINE}')}, {greedy_sql('fine', 'e', 'g')},
firsts AS MATERIALIZED (SELECT keyword, min(image_id) AS first FROM units GROUP BY 1),
normal AS MATERIALIZED (SELECT f.* FROM fine f JOIN firsts t USING (keyword) WHERE t.first % 10 <> 0 AND keyword <> '3'),
{unit_sql('normal', 'c', True)}, {cosine_edges_sql('c', 'ce', f'> {COSINE}')}, {greedy_sql('normal', 'ce', 'h')}
SELECT 'embedding' AS layer, keyword, image_id, kept, removed_by FROM g
UNION ALL SELECT 'embedding', keyword, image_id, TRUE, NULL FROM units WHERE keyword = '3'
UNION ALL SELECT 'histogram', keyword, image_id, kept, removed_by FROM h
UNION ALL SELECT 'histogram', keyword, image_id, image_id = first, CASE WHEN image_id <> first THEN first END
FROM units JOIN firsts USING (keyword) WHERE image_id NOT IN (SELECT image_id FROM normal)""")
def unreadable_policy(spark, sf):
    """Every tenth image and all of label 3 unreadable: dropped or passed through, and flat histograms."""
    broken = (F.col("keyword") == "3") | (F.pmod("image_id", F.lit(10)) == 0)
    items = materialize(vectors(spark, sf).withColumn("embedding", F.when(~broken, F.col("embedding"))))
    embedding = dedup.run_layer(items, Layer("embedding", VectorIndex(COSINE), "pass"))
    flat = dedup.run_layer(items, Layer("histogram", VectorIndex(COSINE, centred=True), "flat"))
    return embedding.unionByName(flat)


# --- ranking, bands, reports ---

ANCHORS_SQL = UNITS_SQL + """,
anchors AS MATERIALIZED (SELECT keyword, arg_min(v, image_id) AS f, min(image_id) AS anchor_id FROM units GROUP BY 1)"""
SOME_ANCHORS_SQL = ANCHORS_SQL.replace("FROM units GROUP BY", "FROM units WHERE keyword < '7' GROUP BY")
SCORED_SQL = ANCHORS_SQL + """,
scored AS MATERIALIZED (
  SELECT keyword, image_id, list_dot_product(v, f) AS score FROM units JOIN anchors USING (keyword) WHERE image_id <> anchor_id),
ranked AS MATERIALIZED (
  SELECT keyword, image_id, score, row_number() OVER (PARTITION BY keyword ORDER BY score DESC, image_id) AS rank
  FROM scored WHERE score >= 0.0),
banded AS MATERIALIZED (
  SELECT *, CASE WHEN score >= 0.2 THEN 'keep' WHEN score >= 0.05 THEN 'review' ELSE 'exclude' END AS band FROM ranked),
verdicts AS MATERIALIZED (
  SELECT keyword, image_id, CASE image_id % 5 WHEN 0 THEN 'yes' WHEN 1 THEN '  YES.' WHEN 2 THEN 'No'
         WHEN 3 THEN chr(10) || 'Yes, one' END AS reply FROM units),
parsed AS MATERIALIZED (
  SELECT *, coalesce(starts_with(upper(regexp_replace(reply, '^\\s+', '')), 'YES'), FALSE) AS has_person FROM verdicts),
outcome AS MATERIALIZED (
  SELECT b.*, band = 'keep' OR (band = 'review' AND NOT has_person) AS final FROM banded b JOIN parsed USING (keyword, image_id)),
final AS MATERIALIZED (
  SELECT keyword, image_id, score, row_number() OVER (PARTITION BY keyword ORDER BY score DESC, image_id) AS rank
  FROM outcome WHERE final)"""


def _ranked(spark, sf):
    scored = ranking.reference_sort(_candidates(spark, sf), _anchors(spark, sf), BANDS.rank_min)
    return ranking.with_ranks(materialize(scored))


def _verdicts(spark, sf):
    """A reply for every image, spelt in the ways models do; some gave none."""
    kind = F.pmod("image_id", F.lit(5))
    reply = (
        F.when(kind == 0, "yes").when(kind == 1, "  YES.").when(kind == 2, "No").when(kind == 3, "\nYes, one")
    )
    return ranking.parse_verdicts(vectors(spark, sf).select("keyword", "image_id", reply.alias("reply")))


def _outcome(spark, sf):
    banded = ranking.person_bands(_ranked(spark, sf), BANDS.keep_min, BANDS.review_min)
    return ranking.with_outcome(banded, _verdicts(spark, sf))


@query(f"WITH {SOME_ANCHORS_SQL} SELECT keyword, image_id, round(f[1], 6) AS anchor_first FROM units JOIN anchors USING (keyword)")
def anchor_lookup(spark, sf):
    found = ranking.anchor_lookup(vectors(spark, sf).drop("embedding"), _some_anchors(spark, sf))
    first = F.get(l2_normalize(as_double(F.col("anchor"))), F.lit(0))
    return found.select("keyword", "image_id", F.round(first, 6).alias("anchor_first"))


@query(f"WITH {SOME_ANCHORS_SQL} SELECT DISTINCT keyword FROM units WHERE keyword NOT IN (SELECT keyword FROM anchors)")
def keywords_without_anchor(spark, sf):
    keywords = vectors(spark, sf).select("keyword").distinct()
    return ranking.keywords_without_anchor(keywords, _some_anchors(spark, sf))


@query(f"WITH {SCORED_SQL} SELECT keyword, image_id, round(score, 6) AS score FROM ranked")
def reference_sort(spark, sf):
    scored = ranking.reference_sort(_candidates(spark, sf), _anchors(spark, sf), BANDS.rank_min)
    return _rounded(scored).select("keyword", "image_id", "score")


NAME_SQL = "'rank' || lpad(rank::VARCHAR, 4, '0') || '_sim' || printf('%.3f', score) || '.jpg'"


@query(f"WITH {SCORED_SQL} SELECT keyword, image_id, rank::INTEGER AS rank, {NAME_SQL} AS output_name FROM ranked")
def ranked_names(spark, sf):
    return ranking.with_output_names(_ranked(spark, sf)).select("keyword", "image_id", "rank", "output_name")


@query(f"WITH {SCORED_SQL} SELECT keyword, image_id, band FROM banded")
def person_bands(spark, sf):
    banded = ranking.person_bands(_ranked(spark, sf), BANDS.keep_min, BANDS.review_min)
    return banded.select("keyword", "image_id", "band")


@query(f"""
WITH {SCORED_SQL}
SELECT keyword, image_id,
       '{{"text":"Does this image contain a visible person? Respond only YES or NO.","image_url":"data:image/jpeg;base64,'
       || to_base64(encode('image ' || image_id)) || '"}}' AS request
FROM banded WHERE band = 'review'""")
def verdict_requests(spark, sf):
    banded = ranking.person_bands(_ranked(spark, sf), BANDS.keep_min, BANDS.review_min)
    stored = vectors(spark, sf).select(
        "keyword", "image_id", F.encode(F.concat(F.lit("image "), F.col("image_id")), "UTF-8").alias("image_bytes")
    )
    return ranking.verdict_requests(banded, stored)


@query(f"WITH {SCORED_SQL} SELECT keyword, image_id, has_person FROM parsed")
def verdict_parse(spark, sf):
    return _verdicts(spark, sf).select("keyword", "image_id", "has_person")


@query(f"WITH {SCORED_SQL} SELECT keyword, image_id, rank::INTEGER AS rank, {NAME_SQL} AS output_name FROM final")
def final_output(spark, sf):
    final = ranking.final_output(_outcome(spark, sf))
    return ranking.with_output_names(final).select("keyword", "image_id", "rank", "output_name")


@query(f"""
WITH {SCORED_SQL}
SELECT keyword, count(*) FILTER (final) AS kept, count(*) FILTER (NOT final) AS excluded,
       count(*) FILTER (band = 'review') AS reviewed FROM outcome GROUP BY 1""")
def filter_counts(spark, sf):
    return ranking.filter_counts(_outcome(spark, sf))


@query(f"""
WITH {SCORED_SQL}
SELECT k.keyword, (SELECT count(*) FROM final f WHERE f.keyword = k.keyword) AS images
FROM (SELECT DISTINCT keyword FROM units UNION SELECT DISTINCT source FROM documents) k""")
def run_summary(spark, sf):
    """Wanted are all labels and all document sources; the sources have no images."""
    labels = vectors(spark, sf).select("keyword")
    wanted = labels.unionByName(texts(spark, sf).select("keyword")).distinct()
    return ranking.run_summary(wanted, _outcome(spark, sf).where("final"))


@query(f"WITH {SCORED_SQL} SELECT keyword, image_id, rank::INTEGER AS rank FROM final WHERE rank <= 6")
def top_k_per_keyword(spark, sf):
    final = _outcome(spark, sf).where("final").select("keyword", "image_id", "score")
    return ranking.top_per_keyword(final).select("keyword", "image_id", "rank")


@query(f"""
WITH {SCORED_SQL}
SELECT keyword, rank::INTEGER AS rank, {NAME_SQL} AS output_name, printf('%.3f', score) AS score_text,
       trunc(score * 100)::INTEGER AS percent FROM ranked""")
def report_cards(spark, sf):
    return reporting.report_cards(ranking.with_output_names(_ranked(spark, sf)))


@query(f"WITH {SCORED_SQL} SELECT keyword, image_id, rank::INTEGER AS rank FROM ranked")
def ranked_sink(spark, sf):
    """Ranked images written by keyword, over an earlier and longer run, and read back."""
    root = scratch_path(spark)
    ranked = materialize(_ranked(spark, sf).select("keyword", "image_id", "rank"))
    sinks.write_ranked(ranked.unionByName(ranked.withColumn("rank", F.col("rank") + 10_000)), root)
    sinks.write_ranked(ranked, root)
    return spark.read.schema("image_id long, rank int, keyword string").parquet(root).select("keyword", "image_id", "rank")


ROW_SQL = f"""'<tr><td>' || rank || '<td><a href="' || {NAME_SQL} || '">' || {NAME_SQL} || '</a><td>' || printf('%.3f', score)
  || '<td>' || trunc(score * 100)::INTEGER || chr(10)"""


@query(f"""
WITH {SCORED_SQL},
bodies AS (SELECT keyword, ((rank - 1) // 20)::INTEGER AS part, string_agg({ROW_SQL}, '' ORDER BY rank) AS body FROM ranked GROUP BY 1, 2),
sizes AS (SELECT keyword, count(*) AS n, ((count(*) + 19) // 20)::INTEGER AS parts FROM ranked GROUP BY 1)
SELECT b.keyword, part,
       '{reporting.OPENING}' || b.keyword || '{reporting.STYLE}<table><caption>Keyword ' || b.keyword || ', ranked against <a href="' || b.keyword
       || '_no_person.jpg">its anchor</a>: images ' || (20 * part + 1) || ' to ' || least(20 * part + 20, n) || ' of ' || n || ', page '
       || (part + 1) || ' of ' || parts || '{reporting.COLUMNS}' || body || '{reporting.CLOSING}' AS html
FROM bodies b JOIN sizes USING (keyword)""")
def report_html(spark, sf):
    """Reports in pages of 20 images."""
    cards = materialize(report_cards(spark, sf))
    anchors = _anchors(spark, sf).select("keyword", F.concat("keyword", F.lit("_no_person.jpg")).alias("anchor_path"))
    return reporting.report_html(cards, anchors, 20)


@query(f"""
WITH RECURSIVE {ANCHORS_SQL},
corpus AS MATERIALIZED (SELECT * FROM units WHERE image_id NOT IN (SELECT anchor_id FROM anchors)),
{cosine_edges_sql('corpus', 'e', f'> {COSINE}')}, {greedy_sql('corpus', 'e', 'g')},
s AS (SELECT keyword, image_id, list_dot_product(v, f) AS score FROM units JOIN anchors USING (keyword) JOIN g USING (keyword, image_id) WHERE kept)
SELECT keyword, image_id, round(score, 6) AS score,
       row_number() OVER (PARTITION BY keyword ORDER BY score DESC, image_id)::INTEGER AS rank,
       CASE WHEN score >= 0.2 THEN 'keep' WHEN score >= 0.05 THEN 'review' ELSE 'exclude' END AS band
FROM s WHERE score >= 0.0""")
def curated(spark, sf):
    """The flagship: duplicates out, ranked against the anchors, banded."""
    layers = [Layer("embedding", VectorIndex(COSINE), "pass")]
    return _rounded(curate.curate(_candidates(spark, sf), _anchors(spark, sf), layers, BANDS))
