"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftloom.llm import bpe, chat, collocations, langid, licenses, lm, mixing, quality, spelling, suffix_dedup, token_counts
from weftloom.llm.batches import bounded_batches
from weftloom.llm.jaccard_join import jaccard_components
from weftloom.llm.topk import exact_top_k
from weftloom.session import materialize
from workloads.base import Registry, table as read_table

query = Registry()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return read_table(spark, sf, name)


def tokenizer_file(name: str) -> str:
    """A public vocabulary file; ``WEFTLOOM_TOKENIZERS`` names another folder for them."""
    folder = os.environ.get("WEFTLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe_ranks() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return bpe.read_ranks(tokenizer_file("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


_WORD = r"[^\x20\x09-\x0D]+"

# --- 1: language identification ---


@query()
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    predicted = langid.predict(docs, langid.train(docs))
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "accepted")


# --- 2: mixing ---

MIX_SQL = f"""
volumes AS (SELECT source, count(*)::DOUBLE AS volume FROM documents GROUP BY source),
rates AS MATERIALIZED (
  SELECT source, sum(volume) OVER () * pow(volume, {mixing.EXPONENT}) / (sum(pow(volume, {mixing.EXPONENT})) OVER () * volume) AS rate
  FROM volumes),
ks AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM rates),
logs AS (SELECT source, k, k * ln(rate) - rate - sum(ln(greatest(k, 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM ks),
sums AS (SELECT source, sum(exp(p)) OVER (PARTITION BY source ORDER BY k) AS upto FROM logs),
steps AS MATERIALIZED (SELECT source, list(upto) AS steps FROM sums GROUP BY source),
mixed AS MATERIALIZED (
  SELECT d.*, unnest(range(1, len(list_filter(steps, lambda p: p <= u)) + 1)) AS mix_copy
  FROM (SELECT *, ('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 13))::BIGINT::DOUBLE / {1 << 52} AS u FROM documents) d
  JOIN steps s ON d.source IS NOT DISTINCT FROM s.source)"""


@query(sql=f"""WITH {MIX_SQL}
SELECT doc_id, text, lang, source, n_chars, mix_copy::INTEGER AS mix_copy,
       ('0x' || substr(md5('{mixing.SEED}:order:' || doc_id || ':' || mix_copy), 1, 13))::BIGINT::DOUBLE / {1 << 52} AS mix_key
FROM mixed""")
def op2_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


# --- 3: quality rules ---

BASE_SQL = rf"""
split AS MATERIALIZED (
  SELECT *, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(words) - 1), lambda i: {{'i': i, 'w': words[i:i + 2]}}), recursive := true)
  FROM split WHERE len(words) >= 3),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS times FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM twice, range(3) r(d) WHERE times > 1 GROUP BY doc_id),
stats AS MATERIALIZED (
  SELECT s.doc_id, s.lang, s.source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id)"""


def _quality_ctes() -> str:
    steps = [f"fit0 AS MATERIALIZED ({quality.first_sql('points')})"] + [
        f"fit{i} AS MATERIALIZED ({quality.step_sql('points', f'fit{i - 1}')})" for i in range(1, quality.STEPS + 1)
    ]
    return ",\n".join([
        BASE_SQL,
        f"vectors AS MATERIALIZED ({quality.vectors_sql('stats')})",
        f"points AS MATERIALIZED ({quality.points_sql('vectors')})",
        *steps,
        f"chosen AS MATERIALIZED ({quality.chosen_sql('vectors', f'fit{quality.STEPS}')})",
        f"verdicts AS MATERIALIZED ({quality.verdict_sql('stats', 'chosen', 'p.*')})",
    ])


QUALITY_COLUMNS = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()


@query(sql=f"WITH {_quality_ctes()}\nSELECT {', '.join(QUALITY_COLUMNS)} FROM verdicts")
def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf, "documents")).select(*QUALITY_COLUMNS)


# --- 4: license scans ---


@query()
def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


# --- 5: chat formatting ---

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"

CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""


@query(sql=CHAT_SQL)
def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    fixed = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    return chat.read_back(chat.format_conversations(turns))


# --- 6: byte-level BPE ---


@query()
def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks, pattern = byte_bpe_ranks()
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf, "documents"), ranks, pattern), ranks))


# --- 7: language-model scores ---


@query()
def op7_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score_documents(table(spark, sf, "documents"))


# --- 8: token counts ---


@query()
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), *byte_bpe_ranks())


# --- 9: n-gram Jaccard join ---


@query()
def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(table(spark, sf, "documents"))


# --- 10: exact top-k search ---

TOP_K_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 10"""


@query(sql=TOP_K_SQL)
def op10_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return exact_top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


# --- 11: spelling variants ---


@query()
def op11_spelling_groups(spark: SparkSession, sf: str) -> DataFrame:
    counted = materialize(spelling.count_words(table(spark, sf, "documents"), drop_every=spelling.DROP_EVERY))
    return spelling.spelling_groups(counted)


# --- 12: collocations ---

COLLOCATIONS_SQL = rf"""
WITH pieces AS MATERIALIZED (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
grams AS (
  SELECT lang, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: array_to_string(words[i:i + 1], ' ')),
                                  list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')))) AS phrase
  FROM pieces),
f AS MATERIALIZED (
  SELECT lang, phrase, string_split(phrase, ' ') AS w, len(string_split(phrase, ' ')) AS size, count(*) AS a FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
candidates AS MATERIALIZED (SELECT * FROM f WHERE a >= {collocations.MIN_COUNT} AND size > 1),
cuts AS (
  SELECT c.*, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM candidates c, (VALUES (1), (2)) AS ks(k) WHERE k < size),
heads AS MATERIALIZED (SELECT c.*, h.a AS l FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head),
scored AS (
  SELECT c.*, t.a AS r, (1000000::HUGEINT * c.a * c.a // (l::HUGEINT * t.a))::BIGINT AS score
  FROM heads c JOIN f t ON t.lang = c.lang AND t.phrase = c.tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, inner_phrase, max(a) AS most
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inner_phrase FROM candidates WHERE size = 3)
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.inner_phrase = s.phrase
  WHERE g.most IS NULL OR 100 * g.most < {collocations.COVERED_PERCENT} * s.a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN sizes USING (lang)
WHERE rank <= {collocations.TOP}"""


@query(sql=COLLOCATIONS_SQL)
def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


# --- 13: suffix-array deduplication ---


@query()
def op13_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents"))
