"""Extraction queries: prompt rendering, valid route, review queue, route
counts and the keyed update of the metadata table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import extract as X
from tessera.operators.tables import update_by_key
from tessera.plans import fragments as Q
from tessera.plans.registry import register
from tessera.sources import standins
from tessera.sources.tables import table

# Fixed value: the reference's prompt template (v1), verbatim.
PROMPT_TEMPLATE = """You are a UI structure extractor for Android app screenshots.

Given the visible text from one screen's view hierarchy, return a single
JSON object with these fields:

- "title": a short string naming the screen (e.g. "Login", "Settings",
  "Search results"). Empty string if unclear.
- "elements": a list of {"type": string, "text": string} objects, one
  per salient interactive or informational element you can identify.
- "confidence": a number in [0.0, 1.0] expressing how confident you are
  in the extraction.

Visible text:
{hierarchy_text}

Respond with valid JSON only — no commentary, no Markdown fences.
"""


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.classify(standins.resp(spark, sf_dir))


def review_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.review_rows(classified(spark, sf_dir)).select("screen_id", "run_id", "reason", "raw_output", "source_fingerprint")


@register("prompt_render", f"""
SELECT doc_id, CAST(length(p) AS BIGINT) AS prompt_chars, sha256(p) AS prompt_sha256
FROM (SELECT doc_id, replace({_sql_lit(PROMPT_TEMPLATE)}, '{{hierarchy_text}}', text) AS p FROM documents)""")
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template fill (literal replace) for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    p = X.render_prompts(docs, PROMPT_TEMPLATE)
    return p.select("doc_id", F.length("prompt").cast("long").alias("prompt_chars"),
                    F.sha2("prompt", 256).alias("prompt_sha256"))


@register("extract_valid", f"""
WITH {Q.RESP}, {Q.ROUTED}
SELECT screen_id, run_id, title, n_elements, confidence, prompt_version, body, source_fingerprint
FROM valid JOIN resp USING (screen_id, run_id)""")
def extract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid route: JSON object, confidence as float (default 0.0)."""
    v = X.valid_rows(classified(spark, sf_dir))
    return v.select("screen_id", "run_id", "title", "n_elements", "confidence", "prompt_version", "body", "source_fingerprint")


@register("review_queue", f"""
WITH {Q.RESP}, {Q.ROUTED}
SELECT screen_id, run_id, reason, raw_output, source_fingerprint FROM review""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review route: reason by handler, own raw output cut at 2000 chars."""
    return review_frame(spark, sf_dir)


@register("extract_route_counts", f"""
WITH {Q.RESP}, {Q.ROUTED}
SELECT route, count(*) AS n FROM routed GROUP BY route""")
def extract_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing counters (extracted / review) per route."""
    return classified(spark, sf_dir).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@register("update_by_key", f"""
WITH {Q.META}, {Q.RESP}, {Q.ROUTED}
SELECT m.screen_id, m.run_id,
       CASE WHEN v.screen_id IS NOT NULL THEN v.confidence ELSE m.confidence END AS confidence,
       CASE WHEN v.screen_id IS NOT NULL THEN 'v1' ELSE m.prompt_version END AS prompt_version,
       (v.screen_id IS NOT NULL OR m.extraction_payload IS NOT NULL) AS has_payload,
       (v.screen_id IS NOT NULL) AS updated
FROM meta m LEFT JOIN valid v ON m.screen_id = v.screen_id AND m.run_id = v.run_id""")
def update_by_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed update of payload / prompt version / confidence where key and
    run match; other rows unchanged."""
    meta = standins.meta(spark, sf_dir)
    v = X.valid_rows(classified(spark, sf_dir)).select(
        "screen_id", "run_id", F.col("body").alias("extraction_payload"), "prompt_version", "confidence")
    out = update_by_key(meta, v, ["screen_id", "run_id"], ["extraction_payload", "prompt_version", "confidence"])
    return out.select("screen_id", "run_id", "confidence", "prompt_version",
                      F.col("extraction_payload").isNotNull().alias("has_payload"), "updated")


@register("extract_hard_cases", """
SELECT event_id AS screen_id, 'run' || (event_id % 3) AS run_id,
       CASE event_id % 8 WHEN 3 THEN 'valid' WHEN 5 THEN 'valid' WHEN 1 THEN 'malformed' WHEN 4 THEN 'call_error'
            WHEN 6 THEN 'confidence_type' ELSE 'confidence_value' END AS route,
       CASE event_id % 8 WHEN 3 THEN NULL WHEN 5 THEN NULL WHEN 1 THEN 'JSONDecodeError: malformed'
            WHEN 4 THEN 'OllamaError: call_error' WHEN 6 THEN 'OllamaError: confidence_type'
            ELSE 'JSONDecodeError: confidence_value' END AS reason,
       CASE event_id % 8 WHEN 3 THEN 0.5::DOUBLE WHEN 5 THEN 0.5::DOUBLE END AS confidence,
       CASE event_id % 8 WHEN 3 THEN '?' END AS title,
       CASE event_id % 8 WHEN 3 THEN '{"title": "\\ud800"}' WHEN 5 THEN '{"a": 1}' END AS body,
       sha256(CAST(event_id AS VARCHAR)) AS source_fingerprint
FROM events""")
def extract_hard_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Huge, non-finite and surrogate values, repeated keys and failed calls: each its own route."""
    c = X.classify(standins.resp_hard(spark, sf_dir), error_col="error")
    route = F.col("route")
    return c.select("screen_id", "run_id", "route",
                    F.when(route != "valid", F.concat(X.handler_of(route), F.lit(": "), route)).alias("reason"),
                    "confidence", "title", "body", "source_fingerprint")
