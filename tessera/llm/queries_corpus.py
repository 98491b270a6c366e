"""Thin queries over the operators that relate documents to each other or to a benchmark."""

from __future__ import annotations

from tessera.llm import decontam, neardup


def op2_decontamination(spark, sf_dir):
    """Overlaps of documents with benchmark items."""
    return decontam.overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_near_duplicates(spark, sf_dir):
    """The near-duplicate component of every document."""
    return neardup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_decontamination": op2_decontamination, "op8_near_duplicates": op8_near_duplicates}

ORACLES = {
    "op8_near_duplicates": r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT doc_id, x FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS x FROM d)
), n AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(na.n) + any_value(nb.n) - count(*))
), both_ways AS MATERIALIZED (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
    SELECT doc_id AS v, doc_id AS c FROM documents
    UNION
    SELECT e.b, r.c FROM reach r JOIN both_ways e ON e.a = r.v
), comp AS (
    SELECT v, min(c) AS c FROM reach GROUP BY v
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, comp.c AS component_id, d.doc_id = comp.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp ON comp.v = d.doc_id""",
}
