"""The dealt operators as queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import (
    bpe_fold, embedding_dedup, exact_dedup, packing, periodic_runs, quality_trees, secret_scan, sharding, shingle_join,
    suffix_dedup, target_resampling, toxicity, url_filter,
)
from ledgerline.llm.common import documents, whole_text

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The rules of the URL query, and patterns for what they leave open.
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_DEFINITION = "word_bpe_49k.json"


def query(name: str):
    def register(fn):
        REGISTRY[name] = fn
        return fn
    return register


@query("op1_sampled_splitters")
def op1(spark, folder):
    return sharding.shard_documents(documents(spark, folder), 16)


@query("op2_url_rules")
def op2(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return url_filter.judge_urls(pages, URL_RULES)


@query("op3_guess_cost")
def op3(spark, folder):
    found = secret_scan.scan_secrets(documents(spark, folder))
    return found.select("doc_id", *[c.alias(n) for n, c in secret_scan.span_columns().items()])


@query("op4_cross_polytope")
def op4(spark, folder):
    return embedding_dedup.near_duplicate_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query("op5_refined_dedup")
def op5(spark, folder):
    digest = F.sha2(whole_text(), 256).alias("text_sha256")
    return exact_dedup.exact_dedup(documents(spark, folder), carry=[digest])


@query("op6_byte_bpe")
def op6(spark, folder):
    docs = bpe_fold.fewer_tasks(documents(spark, folder))
    return bpe_fold.folded_digests(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


@query("op7_toxicity_chain")
def op7(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = documents(spark, folder).select("doc_id", "text")
    return toxicity.score_toxicity(docs, labels).select(
        "doc_id", F.round("p_low_quality", 6).alias("p_low_quality"), F.round("p_toxic", 6).alias("p_toxic"),
        F.col("rejected").alias("toxic"), (~F.col("rejected")).alias("kept"))


@query("op8_bucket_refinement")
def op8(spark, folder):
    return suffix_dedup.removal_digests(suffix_dedup.remove_repeats(documents(spark, folder)))


@query("op9_tiered_packing")
def op9(spark, folder):
    return packing.pack_documents(documents(spark, folder), public_tokenizers.path(WORD_DEFINITION))


@query("op10_shingle_join")
def op10(spark, folder):
    return shingle_join.jaccard_components(documents(spark, folder))


@query("op11_quality_trees")
def op11(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality_trees.judge_quality(documents(spark, folder), labels)
    return judged.withColumn("p_good", F.round("p_good", 6))


@query("op12_target_resampling")
def op12(spark, folder):
    return target_resampling.resample(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query("op13_periodic_runs")
def op13(spark, folder):
    found = periodic_runs.run_digests(documents(spark, folder), prepare=periodic_runs.repeat_tail)
    return found.drop("runs", "collapsed")


ORACLE_SQL: dict[str, str] = {
    "op2_url_rules": """
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM cut
        ), rules(rank, verdict, rule_host, rule_path) AS (VALUES
            (1, 'allow', 'org', '/'), (2, 'block', 'example.org', '/es/'),
            (3, 'block', 'example.org', '/en/1'), (4, 'allow', 'com', '/fr/'), (5, 'block', 'com', '/de/')
        ), fits AS (
            SELECT p.*, r.verdict, r.rule_host || r.rule_path AS rule,
                   row_number() OVER (PARTITION BY page_id
                       ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST, r.rank) AS place
            FROM parts p LEFT JOIN rules r
              ON (p.host = r.rule_host OR suffix(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
    """,
    "op5_refined_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_target_resampling": r"""
        WITH bits AS (
            SELECT list(list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8],
                        lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
            FROM (SELECT unnest(range(256)) AS n)
        ), texts AS (
            SELECT 'd' AS side, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
            UNION ALL
            SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            FROM benchmark
        ), words AS (
            SELECT side, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
        ), hashed AS (
            SELECT word, xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))),
                           lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
            FROM (SELECT DISTINCT word FROM words), bits
        ), counted AS (
            SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
            FROM words JOIN hashed USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
            FROM counted
        ), weights AS (
            SELECT doc_id, count(*) AS n_features, sum(gain) AS total
            FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(floor(total / n_features), 0)::BIGINT AS weight,
                   weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                 / 4294967296)))::BIGINT AS score
            FROM documents LEFT JOIN weights USING (doc_id)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                   count(*) FILTER (n_features >= 20) OVER () AS able
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
        FROM placed
    """,
}
