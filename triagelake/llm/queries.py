"""One query per operator, over whole tables, and what SQL can say about their results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from triagelake.llm import (exact_dedup, language, manifest, mixing, near_dedup, packing, personal_data, quality_model, quality_rules,
                            substring_dedup, token_ids, toxicity, whitening)
from triagelake.llm.common import ship


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir), with_text=False).drop("kept_text")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(documents(spark, sf_dir))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=2)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(documents(spark, sf_dir))


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_ids(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(ship(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_substring_dedup, op3_toxicity, op4_language_id, op5_mixing, op6_quality_classifier,
                            op7_near_dedup, op8_quality_rules, op9_packing, op10_personal_data, op11_token_ids, op12_whitening, op13_manifest)}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op2_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS passage
            FROM split, unnest(range(1, len(words) - 48)) AS t(i)),
        late AS (
            SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY passage) AS first FROM windows) WHERE first < doc_id),
        gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS places FROM late GROUP BY doc_id),
        kept AS (
            SELECT s.doc_id, len(words) AS n_words, len(coalesce(places, [])) AS n_removed,
                   CASE WHEN places IS NULL THEN words ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END AS rest
            FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id)
        SELECT doc_id, n_words, n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept""",
    "op7_near_dedup": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        sets AS (
            SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
                   ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END)) AS shingles
            FROM split),
        classes AS (
            SELECT min(doc_id) AS id, shingles, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
        held AS (SELECT id, n, unnest(shingles) AS shingle FROM classes),
        shared AS (
            SELECT a.id AS a, b.id AS b, count(*) AS common, any_value(a.n) AS x, any_value(b.n) AS y
            FROM held a JOIN held b ON a.shingle = b.shingle AND a.id < b.id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.id, b.id),
        links AS (SELECT a, b FROM shared WHERE 100 * common >= 80 * (x + y - common)),
        ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(id, other) AS (
            SELECT id, id FROM classes UNION SELECT r.id, w.b FROM reach r JOIN ways w ON r.other = w.a),
        found AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
        SELECT s.doc_id, len(s.shingles) AS n_shingles, coalesce(f.component, s.doc_id) AS component_id,
               s.doc_id = coalesce(f.component, s.doc_id) AS kept
        FROM sets s LEFT JOIN classes c ON s.shingles = c.shingles LEFT JOIN found f ON c.id = f.id""",
}
