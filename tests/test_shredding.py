import json

from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.operators import shredding


def brute(value, path="", parent="$", name=None):
    """Objects in arrays, by plain recursion."""
    if isinstance(value, str) and name in shredding.TEXT_MEMBERS and value[:1] in ("[", "{") and value:
        try:
            value = json.loads(value)
        except ValueError:
            return
    if isinstance(value, dict):
        for k, x in value.items():
            yield from brute(x, f"{path}.{k}" if path else k, parent, k)
    elif isinstance(value, list):
        for i, x in enumerate(value):
            here = f"{path}[{i}]"
            if isinstance(x, dict):
                yield here, parent
                yield from brute(x, here, here)
            else:
                yield from brute(x, here, parent)


def shredded(records):
    out = set()
    for _, record, paths, parents, _ in shredding.tables(records):
        out |= {(int(r), p, q) for r, p, q in zip(record, paths, parents, strict=True)}
    return out


json_values = st.recursive(st.none() | st.booleans() | st.integers(0, 9) | st.sampled_from(["", "x", "[", '[{"a":1}]', '{"b":[{}]}']), lambda kids: st.lists(kids, max_size=4) | st.dictionaries(st.sampled_from(["a", "b", "args", "arguments"]), kids, max_size=3), max_leaves=25)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["a", "b", "args"]), json_values, max_size=3), max_size=4))
def test_levels_give_what_recursion_gives(records):
    want = {(i, p, q) for i, r in enumerate(records) for p, q in brute(json.loads(json.dumps(r)))}
    assert shredded(json.loads(json.dumps(records))) == want


def scalars(value, path="", name=None):
    """Every plain value with its escaped path, by plain recursion."""
    if isinstance(value, str) and name in shredding.TEXT_MEMBERS and value[:1] in ("[", "{"):
        try:
            value = json.loads(value)
        except ValueError:
            pass
    if isinstance(value, dict):
        for k, x in value.items():
            yield from scalars(x, f"{path}.{shredding.escaped(k)}" if path else shredding.escaped(k), k)
    elif isinstance(value, list):
        for i, x in enumerate(value):
            yield from scalars(x, f"{path}[{i}]")
    elif value is not None:
        yield path, value if isinstance(value, str) else json.dumps(value)


clashing = st.recursive(st.none() | st.booleans() | st.integers(0, 9) | st.sampled_from(["", "x", '{"b.c":1}']), lambda kids: st.lists(kids, max_size=3) | st.dictionaries(st.sampled_from(["a", "a.b", "b", "[0]", "\\", "args", "$value"]), kids, max_size=3), max_leaves=20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["a", "a.b", "b", "args"]), clashing, max_size=3), max_size=3))
def test_every_plain_value_has_one_place(records):
    want = sorted((i, p, v) for i, r in enumerate(records) for p, v in scalars(json.loads(json.dumps(r))))
    got, places = [], []
    for _, record, paths, _, members in shredding.tables(json.loads(json.dumps(records)), True):
        for r, path, found in zip(record.tolist(), paths, members, strict=True):
            plain = list(found) == ["$value"]
            places.append((r, path, plain))
            for name, v in found.items():
                if name == "$value" and plain and (r, path) not in {(i, p.rsplit(".", 1)[0]) for i, p, _ in want if p.endswith(".$value")}:
                    got.append((r, path, v))
                else:
                    got.append((r, name if path == "$" else f"{path}.{name}", v))
    assert sorted(got) == want
    assert len(set(places)) == len(places)


def test_deep_nesting():
    deep = {"a": []}
    at = deep["a"]
    for _ in range(400):
        at.append({"a": []})
        at = at[0]["a"]
    assert len(shredded([deep])) == 400


def test_items_wrapped_broken_repeated_and_null(spark):
    wrapped = json.dumps(json.dumps({"x": [{"y": [None, {}, {"z": 1}]}]}))
    rows = [("t", "u", "1", wrapped), ("t", "u", "1", json.dumps({"x": [{"y": [None, {}, {"z": 1}]}]}, indent=1)), ("t", "u", "2", "{broken"), (None, "u", "3", '{"x":[{}]}'), ("t", "u", "4", None), ("t", "u", "5", '"text"')]
    items = spark.createDataFrame([(*r, 9) for r in rows], "thread_id string, turn_id string, item_id string, item_json string, owner_key int")
    got = sorted(tuple(r) for r in shredding.flatten_items(items).select("owner_key", "child_path", "parent_path").collect())
    assert got == [("/u/3", "x[0]", "$"), ("t/u/1", "x[0]", "$"), ("t/u/1", "x[0].y[1]", "x[0]"), ("t/u/1", "x[0].y[2]", "x[0]")]
    assert shredding.flatten_items(items.limit(0)).count() == 0


def test_members_line_up_with_their_objects():
    records = [{"x": [{"n": 1, "in": {"k": "a"}}, None, {"n": None}, {"n": 2.5}]}]
    (found,) = [t for t in shredding.tables(records, True) if t[0] != "$"]
    assert found[0] == "x[]" and found[2] == ["x[0]", "x[2]", "x[3]"]
    assert found[4] == [{"n": "1", "in.k": "a"}, {}, {"n": "2.5"}]


def test_traces_with_nulls(spark):
    schema = "trace_id string, steps array<struct<type:string,tool_inputs:string>>, messages array<struct<role:string>>"
    rows = [("a", None, []), ("b", [None, ("tool", '[{"q":[{}]}]')], [("user",), None])]
    got = sorted(tuple(r)[1:] for r in shredding.flatten_traces(spark.createDataFrame(rows, schema)).collect())
    assert got == [("messages[0]", "$"), ("steps[1]", "$"), ("steps[1].tool_inputs[0]", "steps[1]"), ("steps[1].tool_inputs[0].q[0]", "steps[1].tool_inputs[0]")]
