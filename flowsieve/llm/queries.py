"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.llm import exact, language, licences, lm, mixing, near, packing, periods, repair, shards, substring, topk, toxicity, twins


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("probability", F.round("probability", 6))


def _raked_sql(rounds: int = 10, power: float = 0.7) -> str:
    """The rounds of the fitting, one common table expression per margin and round."""
    steps, last = [], "goals"
    for k in range(rounds):
        for margin in ("source", "lang", "topic"):
            steps.append(
                f"{margin}_{k} AS (SELECT * REPLACE (weight * goal_{margin} / sum(weight) OVER (PARTITION BY {margin})"
                f" AS weight) FROM {last})"
            )
            last = f"{margin}_{k}"
    goals = ", ".join(
        f"(SELECT power(sum(c.tokens), {power}) FROM cells c WHERE c.{m} = cells.{m}) / "
        f"(SELECT sum(t) FROM (SELECT power(sum(tokens), {power}) AS t FROM cells GROUP BY {m})) AS goal_{m}"
        for m in ("source", "lang", "topic")
    )
    return f"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '!! ') THEN 'shouting'
      WHEN contains(text, '*** ') OR contains(text, '%%% ') THEN 'noise' WHEN length(text) >= 10000 THEN 'long'
      ELSE 'prose' END AS topic,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
cells AS (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d WHERE n_tokens > 0 GROUP BY ALL),
goals AS (SELECT *, tokens / sum(tokens) OVER () AS weight, {goals} FROM cells),
{", ".join(steps)},
ratios AS (SELECT *, weight / tokens AS ratio FROM {last}),
scales AS (
  SELECT *, (0.5 * sum(tokens) OVER () - coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale
  FROM ratios WINDOW o AS (ORDER BY ratio DESC, source, lang, topic)),
chosen AS (SELECT arg_max(scale, ratio) AS scale FROM scales WHERE scale * ratio <= 1),
p AS (
  SELECT d.*, CASE WHEN n_tokens = 0 THEN 1.0
    ELSE least(1.0, ratio * coalesce((SELECT scale FROM chosen), CAST('inf' AS DOUBLE))) END AS p
  FROM d LEFT JOIN ratios USING (source, lang, topic))
SELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability,
  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) < p * 4294967296.0 AS sampled FROM p"""


def op2_exact_dedup(spark, sf_dir):
    return exact.content_sort(table(spark, sf_dir, "documents"), keep="largest")


OP2_SQL = """WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256 FROM d"""

def op3_substring_dedup(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


OP3_SQL = """WITH w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM documents)),
r AS (
  SELECT *, array_to_string(list(word) OVER ahead, ' ') AS run, count(*) OVER ahead AS n FROM w
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
f AS (
  SELECT doc_id, word, pos, n = 13 AND min(doc_id) OVER (PARTITION BY run, n) < doc_id AS hit FROM r),
c AS (
  SELECT doc_id, word, pos, bool_or(hit) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM documents d LEFT JOIN k USING (doc_id)"""


def word_tokenizer() -> str:
    """Path of the public tokenizer whose white space carries no tokens."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_pattern_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def piece_vocabulary() -> str:
    """Path of the public piece vocabulary with scores."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_lattice_score(spark, sf_dir):
    return lm.score_texts(table(spark, sf_dir, "documents"), piece_vocabulary())


def op8_near_dedup(spark, sf_dir):
    return near.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op9_maxscore(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


OP9_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s QUALIFY rank <= 5"""

def op10_licence_scan(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    return periods.periodic_runs(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark, sf_dir):
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_interleaved_shards(spark, sf_dir):
    placed = shards.interleaved(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_pattern_packing": op4_pattern_packing,
    "op5_language": op5_language,
    "op6_toxicity": op6_toxicity,
    "op7_lattice_score": op7_lattice_score,
    "op8_near_dedup": op8_near_dedup,
    "op9_maxscore": op9_maxscore,
    "op10_licence_scan": op10_licence_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_interleaved_shards": op13_interleaved_shards,
}
SQL: dict[str, str] = {
    "op1_source_mixing": _raked_sql(),
    "op2_exact_dedup": OP2_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op9_maxscore": OP9_SQL,
    "op11_periodic_runs": twins.RUNS,
    "op12_conversation_repair": twins.REPAIR,
    "op13_interleaved_shards": twins.SHARDS,
}
