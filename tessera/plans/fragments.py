"""SQL building blocks of the oracles (DuckDB dialect), one per stand-in.

They restate, in plain SQL over the driver tables, how each stand-in is
built; the Spark side builds the same tables with DataFrame expressions in
``tessera.sources.standins``.
"""

META = """
meta AS (
  SELECT d.doc_id AS screen_id, d.source AS app_package, d.lang AS category,
         'screens/' || d.doc_id || '.png' AS png_path,
         'screens/' || d.doc_id || '.json' AS hierarchy_json_path,
         CASE WHEN l.quality IS NOT NULL
              THEN '{"title": "' || d.lang || '", "toxic": ' || l.toxic || '}' END AS extraction_payload,
         CASE WHEN l.quality IS NOT NULL THEN 'v1' END AS prompt_version,
         CASE WHEN l.quality = 1 THEN 0.9::DOUBLE WHEN l.quality = 0 THEN 0.3::DOUBLE END AS confidence,
         'run' || (d.doc_id % 3) AS run_id,
         sha256(d.text) AS source_fingerprint
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

EMB = """
emb AS (
  SELECT vec_id AS screen_id, 'hash-text' AS model_name, 'v1' AS model_version, 'text' AS embedding_kind,
         embedding AS vector, 'run' || (vec_id % 3) AS run_id, sha256('text:' || vec_id) AS source_fingerprint
  FROM embeddings
  UNION ALL
  SELECT vec_id, 'hash-image', 'v1', 'image', list_concat(embedding, embedding[1:16]), 'run' || (vec_id % 3), sha256('image:' || vec_id)
  FROM embeddings)"""

def emb_zero(label: int) -> str:
    """EMB with the image vectors of one embeddings label set to zero."""
    return f"""
emb AS (
  SELECT vec_id AS screen_id, 'hash-text' AS model_name, 'v1' AS model_version, 'text' AS embedding_kind,
         embedding AS vector, 'run' || (vec_id % 3) AS run_id, sha256('text:' || vec_id) AS source_fingerprint
  FROM embeddings
  UNION ALL
  SELECT vec_id, 'hash-image', 'v1', 'image',
         CASE WHEN label = {label} THEN list_transform(range(len(embedding) + 16), lambda i: 0.0::FLOAT) ELSE list_concat(embedding, embedding[1:16]) END,
         'run' || (vec_id % 3), sha256('image:' || vec_id)
  FROM embeddings)"""


META_RERUNS = """
meta_r AS (
  SELECT * FROM meta
  UNION ALL
  SELECT screen_id, app_package, category, png_path, hierarchy_json_path, extraction_payload, prompt_version,
         confidence, 'rerun' AS run_id, source_fingerprint FROM meta WHERE prompt_version IS NOT NULL)"""

EMB_RERUNS = """
emb_r AS (
  SELECT * FROM emb
  UNION ALL
  SELECT screen_id, model_name, model_version, embedding_kind, vector, 'rerun' AS run_id, source_fingerprint
  FROM emb WHERE screen_id IN (SELECT doc_id FROM labels))"""

RUNS = """
runs AS (
  SELECT 'run' || user_id AS run_id, 'dag-' || user_id AS dag_run_id,
         min(ts) AS started_at, max(ts) AS ended_at, CAST(count(*) * 15 AS INTEGER) AS limit_param
  FROM events GROUP BY user_id)"""

RESP = """
resp AS (
  SELECT event_id AS screen_id, 'run' || (event_id % 3) AS run_id,
         CASE event_id % 10
           WHEN 0 THEN core
           WHEN 1 THEN '```json' || chr(10) || core || ', "confidence": 0.8}' || chr(10) || '```'
           WHEN 2 THEN '[' || core || ', "confidence": 0.8}]'
           WHEN 3 THEN core || ', "confidence": null}'
           WHEN 4 THEN core || ', "confidence": "high"}'
           WHEN 5 THEN core || ', "confidence": "0.75"}'
           WHEN 6 THEN core || '}'
           WHEN 7 THEN core || ', "confidence": 0.9} Hope this helps!'
           ELSE core || ', "confidence": 0.9}' END AS raw_output,
         sha256(core) AS source_fingerprint, core || '}' AS body0
  FROM (SELECT event_id,
               '{"title": "' || event_type || '", "elements": [{"type": "prop", "text": "'
               || json_extract_string(props, '$.k') || '"}, {"type": "event", "text": "' || event_type || '"}]'
               AS core
        FROM events))"""


def centroids(kind: str, name: str = "cent") -> str:
    vec = "embedding" if kind == "text" else "list_concat(embedding, embedding[1:16])"
    return f"""
{name} AS (
  SELECT CAST(label AS BIGINT) AS query_id, list(x ORDER BY pos) AS qv
  FROM (SELECT label, pos, avg(x) AS x
        FROM (SELECT label, unnest(generate_series(1, len({vec}))) AS pos, unnest({vec}) AS x FROM embeddings)
        GROUP BY label, pos)
  GROUP BY label)"""


def dist(metric: str, a: str, b: str) -> str:
    """Distance between two DOUBLE[] expressions (ranked in full; queries round what they show)."""
    if metric == "cosine":
        e = (f"1 - list_dot_product({a}, {b}) / "
             f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))")
    elif metric == "l2":
        e = f"sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda t: (t[1] - t[2]) * (t[1] - t[2]))))"
    elif metric == "ip":
        e = f"-list_dot_product({a}, {b})"
    else:
        raise ValueError(metric)
    return e


# Response routing over RESP (DuckDB's json_valid rejects trailing text,
# like the reference's parser).
ROUTED = """
routed AS (
  SELECT screen_id, run_id, raw_output, source_fingerprint, body0,
    CASE WHEN NOT ok THEN 'malformed'
         WHEN jt <> 'OBJECT' THEN 'not_an_object'
         WHEN ct IS NULL THEN 'valid'
         WHEN ct = 'NULL' THEN 'confidence_type'
         WHEN ct IN ('OBJECT', 'ARRAY') THEN 'confidence_type'
         WHEN ct = 'VARCHAR' AND TRY_CAST(json_extract_string(raw_output, '$.confidence') AS DOUBLE) IS NULL
              THEN 'confidence_value'
         ELSE 'valid' END AS route,
    CASE WHEN ok AND jt = 'OBJECT' THEN
      CASE WHEN ct IS NULL THEN 0.0::DOUBLE
           WHEN ct = 'BOOLEAN' THEN CASE WHEN json_extract_string(raw_output, '$.confidence') = 'true'
                                         THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
           WHEN ct = 'VARCHAR' THEN TRY_CAST(json_extract_string(raw_output, '$.confidence') AS DOUBLE)
           WHEN ct IN ('DOUBLE', 'UBIGINT', 'BIGINT') THEN json_extract(raw_output, '$.confidence')::DOUBLE
      END END AS conf,
    CASE WHEN ok AND jt = 'OBJECT' THEN json_extract_string(raw_output, '$.title') END AS title0,
    CASE WHEN ok AND jt = 'OBJECT' THEN
      coalesce(CAST(json_array_length(raw_output, '$.elements') AS BIGINT), 0) END AS n_el
  FROM (SELECT *, CASE WHEN ok THEN json_type(raw_output) END AS jt,
               CASE WHEN ok AND json_type(raw_output) = 'OBJECT' THEN json_type(raw_output, '$.confidence') END AS ct
        FROM (SELECT *, coalesce(json_valid(raw_output), false) AS ok FROM resp))),
review AS (
  SELECT screen_id, run_id,
         CASE WHEN route IN ('malformed', 'confidence_value') THEN 'JSONDecodeError' ELSE 'OllamaError' END
           || ': ' || route AS reason,
         left(raw_output, 2000) AS raw_output, source_fingerprint
  FROM routed WHERE route <> 'valid'),
valid AS (
  SELECT screen_id, run_id, title0 AS title, n_el AS n_elements, conf AS confidence, 'v1' AS prompt_version, body0 AS body
  FROM routed WHERE route = 'valid')"""
