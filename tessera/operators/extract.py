"""Model-response extraction: prompt rendering, the (pluggable) model call,
and routing of raw responses into a valid frame and a review queue.

One rule decides the route of a response (``classify`` for tables, ``route_of`` for one).  A
response is valid when its text is exactly one JSON object and its
``confidence`` is missing (0.0) or stands for a finite number (a number, a
boolean, or text of a number).  Everything else goes to review:

=================  ================================================  =======
route              why                                               handler
=================  ================================================  =======
malformed          not exactly one JSON value (NaN and Infinity      first
                   literals are not JSON), or nested too deep
confidence_value   confidence is text that is no number, or no       first
                   finite double
not_an_object      JSON, but not an object                           second
confidence_type    confidence is null, an object or a list           second
call_error         the model call failed or ran out of time          second
=================  ================================================  =======

No response can stop the job: any other surprise is a ``malformed`` row.
Of repeated keys the last counts.  The review row keeps the row's own output
and its ``source_fingerprint``; ``detail`` says what was wrong, in full.
Review rows are keyed by (screen, run), so a retry does not duplicate them.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

# Fixed values (must equal the reference's).
PLACEHOLDER = "{hierarchy_text}"
PROMPT_VERSION = "v1"
RAW_OUTPUT_LIMIT = 2000
FIRST_HANDLER = "JSONDecodeError"
SECOND_HANDLER = "OllamaError"
DEFAULT_CONFIDENCE = 0.0
LOW_CONFIDENCE_HANDLER = "LowConfidence"   # extension, not a reference value

ROUTES_FIRST = ("malformed", "confidence_value")
ROUTES_SECOND = ("not_an_object", "confidence_type")


def render_prompts(df: DataFrame, template: str, text_col: str = "text") -> DataFrame:
    """Literal (not regex) replacement of the placeholder by the row's text.

    Extension: ``prompt_sha256`` pins the template by hash (lineage) instead
    of a hand-written version label."""
    return (df.withColumn("prompt", F.replace(F.lit(template), F.lit(PLACEHOLDER), F.col(text_col)))
            .withColumn("prompt_sha256", F.sha2(F.lit(template), 256)))


def _within(seconds: float | None, fn, arg):
    """``fn(arg)``, raising ``TimeoutError`` after ``seconds`` (None: no
    limit).  A call that overruns is abandoned, not killed: its thread ends
    when the model returns."""
    if seconds is None:
        return fn(arg)
    import concurrent.futures as cf

    pool = cf.ThreadPoolExecutor(max_workers=1)
    try:
        return pool.submit(fn, arg).result(timeout=seconds)
    except cf.TimeoutError:
        raise TimeoutError(f"model call exceeded {seconds:g} s") from None
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def _storable(text) -> str | None:
    """Text that UTF-8 can hold (lone surrogates become ``?``)."""
    return None if text is None else str(text).encode("utf-8", "replace").decode()


def call_model(df: DataFrame, model: Callable[[list[str]], list[str]], prompt_col: str = "prompt",
               key_cols: tuple[str, ...] = ("screen_id", "run_id"), timeout_s: float | None = None,
               request_rows: int = 1, tasks: int | None = None) -> DataFrame:
    """Apply a user model to every prompt.

    ``model(prompts) -> outputs`` is built by the caller (e.g. an HTTP
    client) and gets ``request_rows`` prompts at a time, ``timeout_s`` for
    each.  With one prompt a request (the default) every prompt is sent
    exactly once.  A larger request that fails, or whose answer has another
    length, answers none of its prompts: those, and no others, are sent again
    one by one.  What still fails or overruns is captured as ``error`` and
    routes to the review queue.  Prompts are dealt out evenly over ``tasks``
    partitions (the cluster's parallelism by default), because the call
    outweighs the shuffle of a prompt.  Persist the result before routing: a
    lazy plan read twice would call the model twice.
    """
    keys = list(key_cols)
    fields = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{fields}, raw_output string, error string"

    def ask(prompts: list[str]) -> list[tuple]:
        try:
            limit = None if timeout_s is None else timeout_s * len(prompts)
            answers = list(_within(limit, model, prompts))
            if len(answers) != len(prompts):
                raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
            return [(_storable(a), None) for a in answers]
        except Exception as exc:  # noqa: BLE001 — any failure is a row, never the job's end
            if len(prompts) > 1:
                return [one for p in prompts for one in ask([p])]
            return [(None, _storable(f"{type(exc).__name__}: {exc}"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prompts = [p or "" for p in batch.column("_prompt").to_pylist()]
            found = [one for k in range(0, len(prompts), request_rows) for one in ask(prompts[k:k + request_rows])]
            # keys stay in Arrow: a null among them must not change the others
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array([o for o, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())],
                [*keys, "raw_output", "error"])

    asked = df.select(*keys, F.col(prompt_col).alias("_prompt"))
    return asked.repartition(tasks or df.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, schema)


class _Refused(Exception):
    """A response for the review queue: (route, detail)."""


def _only_json(literal: str):
    raise ValueError(f"{literal} is not JSON")


def _confidence(value) -> float:
    """The number a confidence stands for."""
    if not isinstance(value, bool | int | float | str):
        raise _Refused("confidence_type", f"confidence is {'null' if value is None else type(value).__name__}")
    try:
        number = float(value)
    except (ValueError, OverflowError) as exc:
        raise _Refused("confidence_value", str(exc)) from None
    if not math.isfinite(number):
        raise _Refused("confidence_value", f"confidence is {number}")
    return number


def _fields(raw) -> tuple:
    """(confidence, title, n_elements, body) of a valid response."""
    if not isinstance(raw, str):
        raise _Refused("malformed", "no output")
    try:
        answer = json.loads(raw, parse_constant=_only_json)
    except (ValueError, RecursionError) as exc:
        raise _Refused("malformed", f"{type(exc).__name__}: {exc}") from None
    if not isinstance(answer, dict):
        raise _Refused("not_an_object", f"the output is a {type(answer).__name__}")
    confidence = _confidence(answer.pop("confidence", DEFAULT_CONFIDENCE))
    title, listed = answer.get("title"), answer.get("elements")
    shown = title if isinstance(title, str | None) else json.dumps(title)
    return confidence, _storable(shown), len(listed) if isinstance(listed, list) else 0, json.dumps(answer)


def route_of(raw) -> tuple:
    """(route, confidence, title, n_elements, body, detail) of one response, e.g. while trying a prompt;
    ``classify`` states the same rule for a table."""
    try:
        return ("valid", *_fields(raw), None)
    except _Refused as refused:
        route, detail = refused.args
    except Exception as exc:  # noqa: BLE001 — no response may stop the job
        route, detail = "malformed", f"{type(exc).__name__}: {exc}"
    return route, None, None, None, None, _storable(detail)


# text that stands for a number: digits with single underscores between them, as in ``route_of``
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = rf"(?U)^\s*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
# a "confidence" member whose value is no object or list
_MEMBER = r'"confidence"\s*:\s*(?:"(?:[^"\\]|\\.)*"|[^\s,}\]\["{]+)'


def _one_value(raw: Column) -> Column:
    """The response as a Variant, null unless its text is exactly one JSON value.

    The parser ignores what follows a value, so the text is parsed inside a list and inside an
    object: no text can close both early, and a second value would be a second entry."""
    listed = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    held = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    alone = held.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


def _without_confidence(raw: Column) -> Column:
    """Text of a valid response without its confidence.

    The members are cut out of the text; where that changed anything else (a member of the same
    name further down, an escaped name), the object is written anew from its other members."""
    text = F.trim(raw, F.lit(" \t\r\n"))
    cut = F.regexp_replace(F.regexp_replace(text, r",\s*" + _MEMBER, ""), r"^\{\s*" + _MEMBER + r"\s*,?\s*", "{")
    rest = F.to_json(F.map_filter(F.from_json(text, "map<string,variant>"), lambda k, _: k != "confidence"))
    return F.when(F.to_json(F.from_json(cut, "map<string,variant>")).eqNullSafe(rest), cut).otherwise(rest)


def classify(df: DataFrame, raw_col: str = "raw_output", error_col: str | None = None,
             min_confidence: float | None = None) -> DataFrame:
    """Add ``route`` / ``confidence`` / ``title`` / ``n_elements`` / ``body`` / ``detail``.

    The rule of ``route_of`` as Variant expressions: no Python stage, columns pass through untouched
    whatever their type, and what a query does not read is not computed.  ``body`` keeps the response's
    own text and order; a title that is no text is shown as JSON.  A call error (``error_col`` not
    null) routes to ``call_error``.  Of repeated keys the last counts, which the session setting made
    here allows."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    names = ["route", "confidence", "title", "n_elements", "body", "detail"]
    raw = F.col(raw_col)

    def with_columns(frame: DataFrame, **columns: Column) -> DataFrame:
        """Columns made once a row: a filter on a later column is not pushed below, where it would
        repeat the parse for every use of it."""
        return frame.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))

    carried = with_columns(df.select(*[F.col(f"`{c}`") for c in df.columns]), _v=_one_value(raw))
    given = F.try_variant_get("_v", "$.confidence", "variant")
    shaped = with_columns(carried, _shape=F.schema_of_variant(F.col("_v")), _kind=F.schema_of_variant(given), _text=F.try_variant_get("_v", "$.confidence", "string"))
    text = F.col("_text")
    number = (F.when(F.col("_kind") == "STRING", F.when(F.regexp_like(text, F.lit(_NUMBER)), F.replace(F.trim(text), F.lit("_")).try_cast("double")))
              .otherwise(F.try_variant_get("_v", "$.confidence", "double")))
    known = with_columns(shaped, _number=number)
    kind, number = F.col("_kind"), F.col("_number")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    route = (F.when(F.col("_v").isNull(), F.lit("malformed")).when(~F.startswith("_shape", F.lit("OBJECT")), F.lit("not_an_object"))
             .when(kind.isNull(), F.lit("valid")).when((kind == "VOID") | kind.rlike("^(OBJECT|ARRAY)"), F.lit("confidence_type"))
             .when(finite, F.lit("valid")).otherwise(F.lit("confidence_value")))
    detail = (F.when(F.col("route") == "malformed", F.when(raw.isNull(), F.lit("no output")).otherwise(F.concat(F.lit(f"{FIRST_HANDLER}: not exactly one JSON value: "), raw)))
              .when(F.col("route") == "not_an_object", F.concat(F.lit("the output is "), F.lower("_shape")))
              .when(F.col("route") != "valid", F.concat(F.lit("confidence is "), F.coalesce(text, F.lower("_kind")))))
    ok = F.col("route") == "valid"
    routed = with_columns(known.drop("route"), route=route)
    out = routed.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in names], "route",
        F.when(ok, F.when(kind.isNull(), F.lit(DEFAULT_CONFIDENCE)).otherwise(number)).alias("confidence"),
        F.when(ok, F.try_variant_get("_v", "$.title", "string")).alias("title"),
        F.when(ok, F.greatest(F.coalesce(F.size(F.try_variant_get("_v", "$.elements", "array<variant>")), F.lit(0)), F.lit(0)).cast("long")).alias("n_elements"),
        F.when(ok, F.when(kind.isNull(), F.trim(raw, F.lit(" \t\r\n"))).otherwise(_without_confidence(raw))).alias("body"),
        detail.alias("detail"))
    if error_col is not None:
        failed = F.col(error_col).isNotNull()
        out = (out.withColumn("route", F.when(failed, F.lit("call_error")).otherwise(F.col("route")))
               .withColumn("detail", F.when(failed, F.col(error_col)).otherwise(F.col("detail"))))
    return _low_confidence(out, min_confidence)


def _low_confidence(out: DataFrame, min_confidence: float | None) -> DataFrame:
    """Extension (off by default): valid rows under the threshold go to
    review as ``low_confidence``."""
    if min_confidence is None:
        return out
    low = (F.col("route") == "valid") & (F.col("confidence") < F.lit(float(min_confidence)))
    return out.withColumn("route", F.when(low, F.lit("low_confidence")).otherwise(F.col("route")))


def handler_of(route: Column) -> Column:
    return (F.when(route.isin(*ROUTES_FIRST), F.lit(FIRST_HANDLER))
            .when(route == "low_confidence", F.lit(LOW_CONFIDENCE_HANDLER))
            .when(route == "valid", F.lit(None).cast("string"))
            .otherwise(F.lit(SECOND_HANDLER)))


def valid_rows(classified: DataFrame) -> DataFrame:
    """Rows for the keyed update of the metadata table."""
    return (classified.where(F.col("route") == "valid")
            .withColumn("prompt_version", F.lit(PROMPT_VERSION)))


def review_rows(classified: DataFrame, raw_col: str = "raw_output", error_col: str | None = None) -> DataFrame:
    """Review-queue rows: reason ``<handler>: <route>``, output cut at 2000."""
    raw = F.col(raw_col)
    if error_col is not None:
        raw = F.coalesce(raw, F.col(error_col))
    return (classified.where(F.col("route") != "valid")
            .withColumn("reason", F.concat(handler_of(F.col("route")), F.lit(": "), F.col("route")))
            .withColumn("raw_output", F.left(raw, F.lit(RAW_OUTPUT_LIMIT))))


def extract_job(prompts: DataFrame, model: Callable[[list[str]], list[str]], *,
                key_cols: tuple[str, ...] = ("screen_id", "run_id"), min_confidence: float | None = None,
                timeout_s: float | None = None, request_rows: int = 1, tasks: int | None = None):
    """End-to-end extraction: call the model, persist the raw responses (so
    that no retry calls it again), route them once, persist the routed rows.
    Columns beyond ``key_cols`` named ``source_fingerprint`` travel along.
    Returns (valid rows, review rows, route counts)."""
    keys = [*key_cols, *(c for c in ("source_fingerprint",) if c in prompts.columns and c not in key_cols)]
    raw = materialize(call_model(prompts, model, key_cols=tuple(keys), timeout_s=timeout_s, request_rows=request_rows, tasks=tasks), "responses")
    routed = materialize(classify(raw, error_col="error", min_confidence=min_confidence), "routed")
    valid = valid_rows(routed).select(*keys, "confidence", "title", "n_elements", "body", "prompt_version")
    review = review_rows(routed, error_col="error").select(*keys, "reason", "raw_output", "detail")
    counts = routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    return valid, review, counts
