"""Registered queries of the thirteen operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwise.session import table

from . import chat_format, decontaminate, hard_negatives, html_extract, jaccard_join, language_id, lm_score, packing
from . import quality, ranked_search, secret_scan, substring_dedup, url_filter

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: First parts of hosts whose canonical URLs are listed.
LISTED = ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_extract.extract_main_text(pages)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def listed_urls(pages: DataFrame) -> DataFrame:
    """The block list: every URL of the table on a host with a listed label."""
    labels = F.split(url_filter.host_of(F.col("url")), r"\.")
    return pages.select("url").where(F.arrays_overlap(labels, F.array(*[F.lit(x) for x in LISTED])))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, listed_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in secret_scan.BASE],
                        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES = {f.__name__: f for f in (
    op1_html_extract, op2_url_filter, op3_jaccard_join, op4_chat_format, op5_quality_rules, op6_lm_score,
    op7_secret_scan, op8_decontaminate, op9_packing, op10_language_id, op11_ranked_search, op12_substring_dedup,
    op13_hard_negatives)}

_HOST = r"translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_LISTED = ", ".join(f"'{x}'" for x in LISTED)

ORACLE = {
    # the Bloom filter only saves joins: the verdict is plain membership of the canonical URL
    "op2_url_filter": rf"""
        WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
        k AS (SELECT *, CASE WHEN host <> '' THEN concat(regexp_replace(host, '^www\.', ''),
                                                         regexp_replace(path, '(\.html|/)$', '')) END AS key FROM p),
        listed AS (SELECT DISTINCT key FROM k WHERE list_has_any(string_split(host, '.'), [{_LISTED}])),
        rules(rule, verdict) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'),
            ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')),
        parts AS (SELECT *, split_part(rule, '/', 1) AS domain, substr(rule, strpos(rule, '/')) AS start FROM rules),
        keys AS (SELECT DISTINCT host, path FROM k),
        fits AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS said
                 FROM keys JOIN parts ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
                 GROUP BY host, path)
        SELECT page_id, k.host, k.path, rule,
               coalesce(said, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM k LEFT JOIN fits ON k.host = fits.host AND k.path = fits.path LEFT JOIN listed ON k.key = listed.key""",
    "op11_ranked_search": f"""
        WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
        i AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
        o AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
        t AS (SELECT doc_id, n, term, count(*) AS tf FROM o GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
              FROM t, s GROUP BY term, n_docs),
        g AS (SELECT doc_id, t.term,
                     w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS gain
              FROM t JOIN w ON t.term = w.term, s),
        r AS (SELECT item_id, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM i JOIN g ON i.term = g.term
              WHERE doc_id IS NOT NULL GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM r WHERE score > 0 QUALIFY rank <= 50""",
    # every window of 35 words is written out and counted: no anchors
    "op12_substring_dedup": r"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS no, doc_id,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        p AS (SELECT no, words, unnest(range(1, len(words) - 33)) AS pos FROM d WHERE len(words) >= 35),
        w AS (SELECT no, pos, count(*) OVER (PARTITION BY array_to_string(words[pos:pos + 34], ' ')) AS n FROM p),
        gone AS (SELECT no, list(DISTINCT i) AS gone FROM (SELECT no, unnest(range(pos, pos + 35)) AS i FROM w WHERE n > 1)
                 GROUP BY no)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
               sha256(coalesce(array_to_string(
                   list_filter(words, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' '), '')) AS kept_sha256
        FROM d LEFT JOIN gone ON d.no = gone.no""",
    "op13_hard_negatives": """
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                     CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
              FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT * FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, p.other_id AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id
                                       ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
               n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 80 * p.score <= 100 * n.score AND n.score <= p.score
        QUALIFY rank <= 5""",
}
