"""Thin queries over the operators that judge one text at a time."""

from __future__ import annotations

import public_tokenizers

from tessera.llm import bpe, html, langid, licenses, pii, quality


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op3_html_extraction(spark, sf_dir):
    """The main text of every page."""
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op4_license_scan(spark, sf_dir):
    """License texts in every document: matched coverage and spans."""
    return licenses.scan(_documents(spark, sf_dir))


def op5_bpe_codec(spark, sf_dir):
    """Ids and their decoding for every document, as digests."""
    return bpe.encode_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_rules(spark, sf_dir):
    """The ledger's base measures, the base verdict and the current policy's."""
    led = quality.apply_policy(quality.apply_policy(quality.ledger(_documents(spark, sf_dir))), "base", "base_kept")
    return led.selectExpr("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "NOT base_kept AS base_failed", "kept AND base_kept AS kept", "failed_bits")


def op9_language_id(spark, sf_dir):
    """The predicted language of every document."""
    return langid.identify(_documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op10_pii(spark, sf_dir):
    """Spans of personal data in every document."""
    return pii.scan(_documents(spark, sf_dir))


QUERIES = {
    "op3_html_extraction": op3_html_extraction,
    "op4_license_scan": op4_license_scan,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_quality_rules": op6_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_pii": op10_pii,
}

ORACLES = {
    "op3_html_extraction": r"""
WITH a AS (
    SELECT row_number() OVER () AS r, page_id, url, regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(?:p|h1|br|ul|li|div)>') AS x FROM pages
), parts AS (
    SELECT r, regexp_replace(unnest(x), '<[^>]*>', '', 'g') AS s, unnest(range(1, len(x) + 1)) AS i FROM a
), clean AS (
    SELECT r, i, trim(regexp_replace(replace(replace(replace(replace(s, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS s FROM parts
), texts AS (
    SELECT r, string_agg(s, chr(10) ORDER BY i) AS text FROM clean WHERE s <> '' GROUP BY r
)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM a LEFT JOIN texts USING (r)""",
    "op6_quality_rules": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), a AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, string_split(t, chr(10)) AS l, string_split(t, '') AS c FROM d
), windows AS (
    SELECT r, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM a WHERE len(w) >= 8)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS s(k) GROUP BY r
), lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup FROM (SELECT r, unnest(l) AS x FROM a) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
    SELECT a.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
        len(list_filter(c, lambda x: lower(x) <> x)) AS n_upper, len(list_filter(c, lambda x: lower(x) <> x OR (upper(x) <> x AND x <> 'ß'))) AS n_letters
    FROM a LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), f AS (
    SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
        + CASE WHEN 10 * n_upper > 7 * n_letters THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM f""",
}
