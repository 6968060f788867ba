import pytest
from pyspark.sql import functions as F

from tessera.operators import extract as X

CASES = [
    ('{"title": "a", "elements": [1, 2], "confidence": 0.9}', "valid", 0.9),
    ('{"title": "a"}', "valid", 0.0),                              # missing -> 0.0
    ('{"confidence": "0.75"}', "valid", 0.75),                     # numeric text
    ('{"confidence": true}', "valid", 1.0),                        # bool converts
    ('{"confidence": 1.7}', "valid", 1.7),                         # out of range kept
    ('{"confidence": -1}', "valid", -1.0),
    ('{"confidence": "high"}', "confidence_value", None),          # ValueError
    ('{"confidence": null}', "confidence_type", None),             # TypeError
    ('{"confidence": [1]}', "confidence_type", None),
    ('[{"confidence": 0.8}]', "not_an_object", None),              # AttributeError
    ('"text"', "not_an_object", None),
    ('{"a": 1} Hope this helps!', "malformed", None),             # trailing text
    ('{"a": 1},{"a": 2}', "malformed", None),
    ('{"a": 1}{"a": 2}', "malformed", None),
    ("", "malformed", None),
    ("```json\n{\"a\": 1}\n```", "malformed", None),
    ('{"title": "cut", "elements": [', "malformed", None),
]


@pytest.mark.parametrize("raw,route,conf", CASES)
def test_route_of(raw, route, conf):
    r = X.route_of(raw)
    assert r[0] == route
    if conf is not None:
        assert r[1] == pytest.approx(conf)


def test_no_response_stops_the_job(spark):
    hard = ['{"confidence": ' + "9" * 400 + "}", '{"confidence": NaN}', '{"confidence": "nan"}', '{"confidence": 1e999}', "[" * 100_000,
            '{"title": "\\ud800", "confidence": 0.1, "confidence": 0.6}', None]
    df = spark.createDataFrame([(i, "r", x) for i, x in enumerate(hard)], "screen_id long, run_id string, raw_output string")
    got = {r.screen_id: r for r in X.classify(df).collect()}
    assert [got[i].route for i in range(7)] == ["confidence_value", "malformed", "confidence_value", "confidence_value", "malformed", "valid", "malformed"]
    assert got[5].title == "?" and got[5].confidence == 0.6 and "NaN" in got[1].detail


def _frame(spark):
    rows = [(i, "run0", raw) for i, (raw, _, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "screen_id long, run_id string, raw_output string")


def test_routes_of_a_frame(spark):
    got = {r.screen_id: (r.route, r.confidence) for r in X.classify(_frame(spark)).collect()}
    for i, (_, route, conf) in enumerate(CASES):
        assert got[i][0] == route, i
        if conf is not None:
            assert got[i][1] == pytest.approx(conf)


def test_review_rows_reason_and_cut(spark):
    long_raw = "x" * 2001
    df = spark.createDataFrame([(1, "r", long_raw), (2, "r", '[1]'), (3, "r", '{"confidence": "hi"}')],
                               "screen_id long, run_id string, raw_output string")
    rev = {r.screen_id: r for r in X.review_rows(X.classify(df)).collect()}
    assert len(rev[1].raw_output) == 2000
    assert rev[1].reason == "JSONDecodeError: malformed"
    assert rev[2].reason == "OllamaError: not_an_object"
    assert rev[3].reason == "JSONDecodeError: confidence_value"


def test_call_model_captures_errors_and_routes(spark):
    df = spark.createDataFrame([(1, "r", "ok"), (2, "r", "boom")], "screen_id long, run_id string, prompt string")

    def model(prompts):
        if "boom" in prompts:
            raise RuntimeError("server down")
        return ['{"confidence": 0.5}' for _ in prompts]

    out = X.call_model(df, model)
    c = {r.screen_id: r for r in X.classify(out, error_col="error").collect()}
    assert c[1].route == "valid" and c[2].route == "call_error"
    assert "server down" in out.where("screen_id = 2").collect()[0].error


def test_render_prompts_is_literal(spark):
    df = spark.createDataFrame([("a$1\\b",)], "text string")
    p = X.render_prompts(df, "<{hierarchy_text}>").collect()[0].prompt
    assert p == "<a$1\\b>"


def test_low_confidence_route_is_opt_in(spark):
    df = spark.createDataFrame([(1, "r", '{"confidence": 0.2}'), (2, "r", '{"confidence": 0.9}')],
                               "screen_id long, run_id string, raw_output string")
    off = {r.screen_id: r.route for r in X.classify(df).collect()}
    assert off == {1: "valid", 2: "valid"}
    on = X.classify(df, min_confidence=0.5)
    assert {r.screen_id: r.route for r in on.collect()} == {1: "low_confidence", 2: "valid"}
    assert X.review_rows(on).collect()[0].reason == "LowConfidence: low_confidence"


def test_extract_job_calls_model_once_per_prompt(spark):
    from tessera.session import work_dir

    marker = work_dir(spark, "calls")
    df = spark.createDataFrame([(i, "r", f"p{i}") for i in range(6)], "screen_id long, run_id string, prompt string")

    def model(prompts):
        import os
        os.makedirs(marker, exist_ok=True)
        for p in prompts:
            open(os.path.join(marker, p), "a").write("x")
        return ['{"confidence": 0.9}' if p != "p3" else "nope" for p in prompts]

    valid, review, counts = X.extract_job(df, model)
    assert valid.count() == 5 and review.count() == 1
    assert {r.route: r.n for r in counts.collect()} == {"valid": 5, "malformed": 1}
    import os
    assert sorted(os.listdir(marker)) == [f"p{i}" for i in range(6)]
    assert all(open(os.path.join(marker, f)).read() == "x" for f in os.listdir(marker))


def test_call_model_timeout_routes_only_the_slow_prompt(spark):
    import time

    df = spark.createDataFrame([(1, "r", "fast"), (2, "r", "slow"), (3, "r", "fast")],
                               "screen_id long, run_id string, prompt string").coalesce(1)

    def model(prompts):
        if "slow" in prompts:
            time.sleep(3)
        return ['{"confidence": 0.5}' for _ in prompts]

    out = X.call_model(df, model, timeout_s=0.5)
    rows = {r.screen_id: r for r in out.collect()}
    assert rows[1].error is None and rows[3].error is None
    assert rows[2].error.startswith("TimeoutError") and rows[2].raw_output is None
    c = {r.screen_id: r.route for r in X.classify(out, error_col="error").collect()}
    assert c == {1: "valid", 2: "call_error", 3: "valid"}


def test_requests_are_small_and_only_failed_ones_are_sent_again(spark):
    from tessera.session import work_dir

    folder = work_dir(spark, "requests")
    df = spark.createDataFrame([(i, "r", f"p{i}") for i in range(9)], "screen_id long, run_id string, prompt string")

    def model(prompts):
        import os
        import uuid
        os.makedirs(folder, exist_ok=True)
        open(os.path.join(folder, uuid.uuid4().hex), "w").write(",".join(prompts))
        return ["{}"] * (len(prompts) if "p4" not in prompts or len(prompts) == 1 else 1)   # one answer short

    X.call_model(df, model, request_rows=3, tasks=1).write.format("noop").mode("overwrite").save()
    import os
    sent = sorted(open(os.path.join(folder, f)).read() for f in os.listdir(folder))
    assert len([s for s in sent if "," in s]) == 3 and all(len(s.split(",")) <= 3 for s in sent)
    again = [s for s in sent if "," not in s]
    assert len(again) == 3 and "p4" in again


def test_prompts_are_dealt_over_tasks(spark):
    df = spark.range(2000).select(F.col("id").alias("screen_id"), F.lit("r").alias("run_id"), F.lit("p").alias("prompt"))
    out = X.call_model(df.orderBy("screen_id"), lambda p: ["{}"] * len(p)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert out > 1


TRICKY = ['null', '{"a":1}]', '{"a":1}],[1', '{"a":1}}', '1,"w":2', '{"a":1},"w":2', ' {"a": 1}\n', "{'a': 1}", '{"a": 01}', '{"a": 1,}', '{"a": "\t"}', '{"a":1} ',
          '// c\n{"a":1}', '{"confidence": "1_0"}', '{"confidence": "1__0"}', '{"confidence": "5d"}', '{"confidence": "0x10"}', '{"confidence": " .5e1 "}', '{"confidence": "-Infinity"}',
          '{"confidence": "1e400"}', '{"confidence": 12345678901234567890123}', '{"confidence": false, "elements": {"a": 1}}', '{"elements": [1, [2], {}]}', '{"elements": null}', '""', "12", "true",
          '{"a": {"confidence": 0.2}}', '{"\\u0063onfidence": "0.5"}', "[]", "{}", '{"confidence": ""}', '{"confidence": "."}', '{"confidence": "5."}', '{"title": "é\U0001f600", "confidence": 1}']


def test_expressions_state_the_plain_rule(spark):
    df = spark.createDataFrame(list(enumerate([raw for raw, _, _ in CASES] + TRICKY)), "i int, raw_output string")
    for r in X.classify(df).collect():
        route, confidence, title, n, _, _ = X.route_of(r.raw_output)
        assert (r.route, r.confidence, r.n_elements, r.title) == (route, confidence, n, title), r.raw_output


def test_body_is_the_answer_without_its_confidence(spark):
    import json

    raws = ['{"title": "a", "confidence": 0.5, "z": [1, {"confidence": 3}]}', '{"confidence": "a,}\\"b", "x": 1}', '{"confidence": 1}', '{"confidence":1,"a":2,"confidence":2}',
            '{"\\u0063onfidence": 1, "b": "confidence"}', '{"a": {"confidence": 7}}', ' {"b": 1, "a": "\\ud800"} ', '{"confidence": true, "b": "x\\"confidence\\": 4"}']
    raws = [x.replace('"a,}\\"b"', '"0.5"') for x in raws]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw_output string")
    for r in X.classify(df).collect():
        want = json.loads(raws[r.i])
        want.pop("confidence", None)
        assert r.route == "valid" and json.loads(r.body) == want, raws[r.i]


def test_routing_has_no_python_stage_and_keeps_large_ids(spark):
    big = 1 << 60
    df = spark.createDataFrame([(big + 1, "r", "{}"), (None, "r", "{}"), (big + 3, None, "[1]")], "screen_id long, run_id string, raw_output string")
    out = X.classify(df)
    assert {(r.screen_id, r.route) for r in out.collect()} == {(big + 1, "valid"), (None, "valid"), (big + 3, "not_an_object")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan and "MapInArrow" not in plan


def test_call_model_keeps_large_ids_beside_null_ones(spark):
    big = 1 << 60
    df = spark.createDataFrame([(big + 1, "r", "a"), (None, "r", None), (big + 3, "r", "c")], "screen_id long, run_id string, prompt string").coalesce(1)
    got = {(r.screen_id, r.raw_output) for r in X.call_model(df, lambda ps: ps, tasks=1).collect()}
    assert got == {(big + 1, "a"), (None, ""), (big + 3, "c")}
