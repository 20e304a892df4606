import json

from chronopitch.operators import drift

SCHEMA = "entry_id string, feed_id string, file_seq int, payload string, path string, kind string"


def table(spark, files):
    """files: (feed, seq, payload objects or texts); `path` and `kind` clash with the operator's own names."""
    rows = [(f"{f}-{s}-{i}", f, s, p if p is None or isinstance(p, str) else json.dumps(p), "p", "k") for f, s, ps in files for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, SCHEMA)


def changes(spark, files):
    return {tuple(r) for r in drift.schema_changes(table(spark, files)).collect()}


def test_each_kind_of_change(spark):
    before = [{"a": i, "b": {"x": 1.5 + i, "y": "s"}, "gone": [1], "t": 1, "n": None} for i in range(12)]
    after = [{"A": i, "b": {"x": 2.5 + i, "z": "s"}, "t": "1", "new": True, "n": None} for i in range(12)]
    got = changes(spark, [("f", 1, before), ("f", 2, after)])
    assert got == {
        ("f", 2, "renamed", "a", "A"), ("f", 2, "renamed", "b.y", "b.z"), ("f", 2, "removed", "gone", "gone"), ("f", 2, "retyped", "t", "t"), ("f", 2, "added", "new", "new"),
    }


def test_an_object_is_one_case_not_its_members(spark):
    got = changes(spark, [("f", 1, [{"o": {"p": i, "q": {"r": i}}, "w": 3} for i in range(9)]), ("f", 2, [{"w": {"value": 3, "origin": "x"}} for _ in range(9)])])
    assert got == {("f", 2, "removed", "o", "o"), ("f", 2, "retyped", "w", "w")}


def test_unlike_content_is_no_rename_and_numbers_are_told_apart(spark):
    got = changes(spark, [("f", 1, [{"age": 20 + i % 9, "v": 2} for i in range(30)]), ("f", 2, [{"crowd": 20_000 + 911 * i, "v": 2.5} for i in range(30)])])
    assert got == {("f", 2, "removed", "age", "age"), ("f", 2, "added", "crowd", "crowd"), ("f", 2, "retyped", "v", "v")}


def test_any_depth(spark):
    deep = lambda leaf: {"a": {"b": {"c": {"d": {"e": {leaf: 1}}}}}}
    got = changes(spark, [("f", 1, [deep("x")] * 9), ("f", 2, [{"a": {"b": {"c": {"d": {"e": {}}}}}}] * 9)])
    assert got == {("f", 2, "removed", "a.b.c.d.e.x", "a.b.c.d.e.x")}


def test_nulls_bad_payloads_gaps_and_repeats(spark):
    files = [("f", 1, [{"a": 1}, None, "", "{bad", "[1]"]), ("f", 3, [{"b": 1}]), (None, 1, [{"a": 1}]), ("g", 1, [{"a": None}]), ("g", 2, [{"a": 1}, {"a": 1}])]
    assert changes(spark, files) == set()  # f has no file 2; null is no type
    assert drift.unreadable_payloads(table(spark, files)).count() == 4
    assert drift.schema_changes(table(spark, []).limit(0)).count() == 0


def test_one_consistent_table(spark):
    files = [("f", 1, [{"price": 1.5 + i / 7, "ok": True, "seats": 5} for i in range(14)]), ("f", 2, [{"prices": 2.5 + i / 7, "ok": 1, "seats": "many" if i == 3 else "7"} for i in range(12)])]
    df = drift.consistent_table(table(spark, files))
    rows = {r["entry_id"]: r for r in df.collect()}
    assert len(rows) == 26 and dict(df.dtypes) | {"price": "double", "ok": "boolean", "seats": "bigint"} == dict(df.dtypes)
    assert rows["f-1-0"]["price"] == 1.5 and rows["f-2-0"]["price"] == 2.5
    assert [tuple(x) for x in rows["f-2-3"]["failed_casts"]] == [("seats", "string", "many")] and rows["f-2-3"]["seats"] is None
    assert rows["f-2-4"]["seats"] == 7 and rows["f-2-0"]["ok"] is True and not rows["f-2-0"]["failed_casts"]


def test_the_table_loses_nothing(spark):
    """Wrappers, arrays for single values, long whole numbers, names that clash, deep members: all are in a column or reported."""
    deep = {"a": {"b": {"c": {"d": {"e": {"x": 1}}}}}}
    plain = [{"n": i, "id": 10**17 + i, "big": 10**25 + i, "o": {"home": i}, "list": [i], "e.x": "t", **deep} for i in range(9)]
    odd = [
        {"n": {"value": 70, "origin": "feed"}, "id": "100000000000000009", "o": [1, 2], "list": "1;2", "entry_id": "mine"},
        {"n": [71], "o": "3-4"}, {"n": [7, 2], "N": 5}, {"n": {"worth": 1}, "big": "x", "failed_casts": None}, {}, None, "{bad",
    ]
    df = drift.consistent_table(table(spark, [("f", 1, plain), ("g", 1, odd)]))
    rows = {r["entry_id"]: r for r in df.collect()}
    assert len(rows) == 16
    first = rows["f-1-3"]
    assert first["n"] == 3 and first["id"] == 10**17 + 3 and first["o__home"] == 3 and first["list"] == ["3"] and first["a__b__c__d__e__x"] == 1
    failed = {k: [tuple(x) for x in r["failed_casts"]] for k, r in rows.items()}
    assert rows["g-1-0"]["n"] == 70 and rows["g-1-0"]["n__origin"] == "feed" and rows["g-1-0"]["id"] == 10**17 + 9 and rows["g-1-0"]["entry_id_"] == "mine"
    assert failed["g-1-0"] == [("list", "string", "1;2"), ("o", "array", "[1,2]")]
    assert rows["g-1-1"]["n"] == 71 and failed["g-1-1"] == [("o", "string", "3-4")]
    assert rows["g-1-2"]["n"] is None and failed["g-1-2"] == [("n", "array", "[7,2]")]
    assert first["big"] == 10**25 + 3 and rows["g-1-2"]["N_"] == 5
    assert failed["g-1-3"] == [("big", "string", "x"), ("n", "object", '{"worth":1}')] and rows["g-1-3"]["n__worth"] == 1
    assert failed["g-1-4"] == failed["g-1-5"] == failed["g-1-6"] == []
    assert drift.consistent_table(table(spark, []).limit(0)).count() == 0


def test_many_distinct_values_are_told_apart(spark):
    """Thousands of values a file: the same vocabulary is a rename, another one is none."""
    word = lambda i: "".join(chr(97 + int(d)) for d in f"{i:05}")
    before = [{"a": word(i), "w": i} for i in range(3000)]
    same = [{"b": word((i * 7) % 3000), "w": i} for i in range(3000)]
    other = [{"b": word(90_000 - i), "w": i} for i in range(3000)]
    stats = lambda rows: {(r["file_seq"], r["path"]): r.asDict() for r in drift.file_statistics(table(spark, [("f", 1, before), ("f", 2, rows)])).collect()}
    like = lambda s: drift._content_likeness(s[1, "a"], s[2, "b"])
    assert like(stats(same)) > 0.9 and like(stats(other)) < 0.6
