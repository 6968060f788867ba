import json

import pytest

from tessera.operators import hierarchy as H


def flat(spark, trees):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(trees)], "screen_id long, hierarchy_json string")
    return sorted(H.elements(df).collect(), key=lambda r: (r.screen_id, r.pos))


def node(cls=None, text=None, bounds=None, children=None):
    d = {}
    if cls is not None:
        d["class"] = cls
    if text is not None:
        d["text"] = text
    if bounds is not None:
        d["bounds"] = bounds
    if children is not None:
        d["children"] = children
    return d


def test_walk_pure_python_cases():
    assert H.walk({}) == []
    assert H.walk([1]) == []
    assert H.walk({"activity": {"root": None}}) == []
    # activity without root -> the tree itself is the root
    assert [e[1] for e in H.walk({"activity": {}, "class": "a.B"})] == ["B"]
    # activity null -> falls back to the tree (documented fix)
    assert [e[1] for e in H.walk({"activity": None, "class": "x.Y"})] == ["Y"]


@pytest.mark.parametrize("cls,expected", [("a.b.C", "C"), ("C", "C"), ("a.", ""), ("", None), (None, None)])
def test_class_name(cls, expected):
    els = H.walk(node(cls=cls, text="" if expected is None else None))
    if expected is None:
        assert els == []
    else:
        assert els[0][1] == expected


def test_children_shapes_and_preorder():
    tree = node("r.Root", "root", children=[
        node("a.A", "a", children={"not": "a list"}),
        None, 5,
        node("b.B", "b", children=[node("c.C", "c"), None]),
    ])
    assert [e[2] for e in H.walk(tree)] == ["root", "a", "b", "c"]
    assert [e[0] for e in H.walk(tree)] == [0, 1, 1, 2]


def test_bounds_and_text_rules():
    els = H.walk(node("x.T", " \t pad \n", children=[
        node("x.T", "three", bounds=[1, 2, 3]),
        node("x.T", "dec", bounds=[1.9, -2.7, 3, 4]),
        node("x.T", "numtext", bounds=["10", "20", 30, 40]),
        node("x.T", "badtext", bounds=["1.5", 2, 3, 4]),
        node("", "   "),
        node(None, 7),
    ]))
    by = {e[2]: tuple(e[3:]) for e in els}
    assert "pad" in by and by["three"] == (0, 0, 0, 0)
    assert by["dec"] == (1, -2, 3, 4)
    assert by["numtext"] == (10, 20, 30, 40)
    assert by["badtext"] == (0, 0, 0, 0)
    assert "7" in by                      # scalar text in string form
    assert "" not in by                   # blank text and empty class -> dropped


def test_elements_spark_bad_json_and_depth(spark):
    deep = node("c.N", "0")
    cur = deep
    for i in range(1, 120):
        child = node("c.N", str(i))
        cur["children"] = [child]
        cur = child
    rows = flat(spark, ["not json", "{}", "[1]", json.dumps(deep), json.dumps({"activity": {"root": deep}})])
    assert {r.screen_id for r in rows} == {3, 4}
    d3 = [r for r in rows if r.screen_id == 3]
    assert len(d3) == 120 and [r.depth for r in d3] == list(range(120))
    status = {r.screen_id: r.ok for r in H.tree_status(spark.createDataFrame(
        [(0, "not json"), (1, "{}")], "screen_id long, hierarchy_json string")).collect()}
    assert status == {0: False, 1: True}


def test_reading_order_is_stable(spark):
    tree = node("r.R", "", bounds=[0, 0, 1, 1], children=[
        node("t.T", "second", bounds=[0, 10, 1, 1]),
        node("t.T", "tie-first", bounds=[5, 5, 1, 1]),
        node("t.T", "tie-second", bounds=[5, 5, 1, 1]),
        node("t.T", "first", bounds=[9, 0, 1, 1]),
    ])
    df = spark.createDataFrame([(1, json.dumps(tree))], "screen_id long, hierarchy_json string")
    out = H.reading_order_text(H.elements(df)).collect()[0]
    assert out.text_rep == "first tie-first tie-second second"
    # shuffled input rows give the same text (metamorphic)
    df2 = spark.createDataFrame([(1, json.dumps(tree)), (2, json.dumps(tree))],
                                "screen_id long, hierarchy_json string").repartition(3)
    texts = {r.screen_id: r.text_rep for r in H.reading_order_text(H.elements(df2)).collect()}
    assert texts[1] == texts[2] == out.text_rep


def test_tree_without_text_gives_empty_string(spark):
    df = spark.createDataFrame([(1, json.dumps(node("a.B", "")))], "screen_id long, hierarchy_json string")
    r = H.reading_order_text(H.elements(df)).collect()[0]
    assert r.text_rep == "" and r.n_elements == 0


def test_first_elements_preview(spark):
    tree = node("r.R", "root", children=[node("t.T", str(i)) for i in range(15)])
    df = spark.createDataFrame([(1, json.dumps(tree)), (2, json.dumps(node("a.B", "x")))],
                               "screen_id long, hierarchy_json string")
    got = H.first_elements(H.elements(df), 10).collect()
    by = {}
    for r in got:
        by.setdefault(r.screen_id, []).append(r.pos)
    assert sorted(by[1]) == list(range(10)) and by[2] == [0]


def test_one_pass_text_equals_regrouped_elements(spark):
    trees = [json.dumps(node("r.R", "a", [0, 5, 1, 1], [node("t.T", "b", [3, 1, 1, 1]), node("t.T", "c", [1, 1, 1, 1]), node("t.T", "d", [1, 1, 1, 1])])),
             json.dumps(node("a.B", "")), "{}"]
    df = spark.createDataFrame(list(enumerate(trees)), "screen_id long, hierarchy_json string")
    one = {r.screen_id: (r.n_elements, r.text_rep) for r in H.screen_texts(df).collect()}
    two = {r.screen_id: (r.n_elements, r.text_rep) for r in H.reading_order_text(H.elements(df)).collect()}
    assert one == two | {2: (0, "")} and one[0] == (4, "c d b a")


def test_bad_records_and_strict_mode(spark):
    deep = '{"children": [' * 20_000 + "]}" * 20_000
    surrogate = '{"class": "a.B", "text": "x\\ud800y", "bounds": [1e999, 1, 1, 1]}'
    huge = '{"class": "a.B", "text": "big", "bounds": [1e30, 1, 1, 1]}'
    df = spark.createDataFrame([(1, "not json"), (2, deep), (3, None), (4, surrogate), (5, huge)], "screen_id long, hierarchy_json string")
    bad = {r.screen_id: (r.error, r.hierarchy_json) for r in H.bad_records(df).collect()}
    assert set(bad) == {1, 2, 3} and bad[1][1] == "not json" and len(bad[2][1]) == len(deep) and "JSONDecodeError" in bad[1][0]
    got = {r.screen_id: (r.text, r.x1) for r in H.elements(df).collect()}
    assert got == {4: ("x?y", 0), 5: ("big", 0)}
    with pytest.raises(Exception, match="screen 1"):
        H.elements(df.where("screen_id = 1"), strict=True).collect()
