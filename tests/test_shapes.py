import json

import pytest
from pyspark.sql import functions as F

from tidewell.functions import shapes

NODE = {"$defs": {"node": {"type": "object", "required": ["v"], "properties": {"v": {"type": "integer"}, "next": {"anyOf": [{"$ref": "#/$defs/node"}, {"type": "null"}]}}, "additionalProperties": False}}, "$ref": "#/$defs/node"}
SCHEMAS = [
    {"type": "integer", "minimum": 3}, {"type": ["string", "null"], "minLength": 2}, {"const": True}, {"const": 1}, {"enum": ["a", 1, None, False]}, {"type": "array", "items": {"type": "string", "minLength": 1}},
    {"type": "object", "required": ["a"], "properties": {"a": {"type": "array", "items": {"type": "integer"}}, "b": {"type": "string"}}, "additionalProperties": False},
    {"type": "object", "properties": {"a": {"const": 1}}}, {"anyOf": [{"type": "string"}, {"type": "integer", "minimum": 5}]}, {"oneOf": [{"type": "integer"}, {"type": "integer", "minimum": 5}, {"type": "boolean"}]}, NODE, {},
]
DOCUMENTS = [
    None, True, False, 0, 1, 3, 5, 10**25, -(10**25), 1.0, 2.5, "", "a", "ab", "中", [], ["a"], ["a", ""], [1, "x", None], {}, {"a": 1}, {"a": True}, {"a": [1, 2]}, {"a": [1, "x"], "b": 3, "c": 1}, {"b": "x"}, {"v": 1}, {"v": 1, "next": None},
    {"v": 1, "next": {"v": 2, "next": {"v": "x"}}}, {"v": 1, "next": {"v": 2, "next": {"v": 3}}}, {"v": 1, "more": 2}, [[1]], [{"a": 1}],
]


def fits(x, spec, root):
    """A plain validator."""
    if "$ref" in spec:
        return fits(x, root["$defs"][spec["$ref"].split("/")[-1]], root)
    for name, right in (("anyOf", lambda n: n > 0), ("oneOf", lambda n: n == 1)):
        if name in spec:
            return right(sum(fits(x, s, root) for s in spec[name]))
    name = {str: "string", type(None): "null", int: "integer", bool: "boolean", list: "array", dict: "object", float: "number"}[type(x)]
    types = spec.get("type", name)
    if name not in ([types] if isinstance(types, str) else types):
        return False
    if "const" in spec and (type(x) is not type(spec["const"]) or x != spec["const"]) or "enum" in spec and not any(type(x) is type(v) and x == v for v in spec["enum"]):
        return False
    if name == "string" and len(x) < spec.get("minLength", 0) or name == "integer" and x < spec.get("minimum", x):
        return False
    if name == "array" and "items" in spec:
        return all(fits(v, spec["items"], root) for v in x)
    if name == "object":
        own = spec.get("properties", {})
        return all(k in x for k in spec.get("required", [])) and not (spec.get("additionalProperties") is False and set(x) - set(own)) and all(fits(v, own[k], root) for k, v in x.items() if k in own)
    return True


def test_same_as_plain(spark):
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(DOCUMENTS)], "i int, j string").withColumn("v", F.parse_json("j"))
    rows = df.select("i", *[shapes.conforms(F.col("v"), s, 4).alias(f"s{n}") for n, s in enumerate(SCHEMAS)]).collect()
    for r in rows:
        assert [r[f"s{n}"] for n in range(len(SCHEMAS))] == [fits(DOCUMENTS[r.i], s, s) for s in SCHEMAS], DOCUMENTS[r.i]


def test_problems(spark):
    docs = [{"a": [1, "x"], "b": 3, "c": 1}, {}, {"v": 1}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(F.parse_json("j").alias("v"))
    assert [r[0] for r in df.select(shapes.problems(F.col("v"), SCHEMAS[6])).collect()] == [["$.c: additionalProperties", "$.a[1]: type", "$.b: type"], ["$.a: required"], ["$.a: required", "$.v: additionalProperties"]]
    assert spark.range(1).select(shapes.problems(F.lit(None).cast("variant"), {"type": "string"})).first()[0] == ["$: type"]
    deep = spark.range(1).select(F.parse_json(F.lit('{"v":1,"next":{"v":1,"next":{"v":1}}}')).alias("v"))
    assert deep.select(shapes.conforms(F.col("v"), NODE, 2)).first()[0] is False
    with pytest.raises(ValueError):
        shapes.problems(F.col("v"), {"pattern": "x"})
