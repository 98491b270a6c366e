"""Thin queries over the operators that are built-in Spark functions alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import chat, urls

#: The contract's extra conversation and rules.
ODD_TEXT = r"\### Assistant: </turn> ok"
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def op1_chat_formatting(spark, sf_dir):
    """Digests of every conversation, read back from its formatted text."""
    messages = F.array(*(F.struct(F.lit(r).alias("role"), F.lit(ODD_TEXT).alias("content")) for r in ("user", "assistant")))
    odd = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.to_json(F.struct(F.lit("added").alias("source"), messages.alias("messages"))).alias("record"))
    formatted = chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"), odd)
    turns = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.parse(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = turns.select("conv_id", "formatted_chars", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), chat.loss_text(F.col("turns")).alias("loss"))
    return read.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op7_url_filters(spark, sf_dir):
    """The rule and verdict of every page's URL."""
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)


QUERIES = {"op1_chat_formatting": op1_chat_formatting, "op7_url_filters": op7_url_filters}

_ESCAPED = r"replace(replace(replace(replace({}, '\', '\0'), '<turn>', '\1'), '</turn>', '\2'), '### ', '\3')"

ORACLES = {
    "op1_chat_formatting": rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{ODD_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{ODD_TEXT}'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 19)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id""",
    "op7_url_filters": r"""
WITH rules(h, p, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
    SELECT row_number() OVER () AS r, page_id,
        CASE WHEN contains(url, '://') THEN translate(regexp_extract(url[position('://' IN url) + 3:], '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN contains(url, '://') THEN regexp_extract(url[position('://' IN url) + 3:], '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM pages
)
SELECT page_id, host, path, h || p AS rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, length(h) DESC) = 1""",
}
