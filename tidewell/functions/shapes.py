"""JSON documents against a JSON Schema, compiled into one expression over VARIANT.

The subset: type (one or several), const, enum, required, properties, additionalProperties (false), items, minLength,
minimum, anyOf, oneOf, and $ref into $defs. Nothing is collected or called from Python: a schema is a plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.facts import let

#: Fixed value: the type names of schemas, and how a variant names what it holds.
KINDS = {"string": "STRING", "null": "VOID", "integer": "BIGINT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT"}
KNOWN = {"$ref", "$defs", "$schema", "$id", "title", "description", "type", "const", "enum", "required", "properties", "additionalProperties", "items", "minLength", "minimum", "anyOf", "oneOf"}
NONE = "array<string>"


def kind_of(v: Column) -> Column:
    """STRING, BIGINT, .. of a variant; a missing one is VOID. Whole numbers beyond a long are BIGINT as well."""
    told = F.schema_of_variant(v)
    big = told.rlike(r"^DECIMAL\(\d+,0\)$") & (F.abs(F.try_variant_get(v, "$", "decimal(38,0)")) >= F.lit("9223372036854775808").cast("decimal(38,0)"))
    return F.when(v.isNull(), "VOID").when(big, "BIGINT").otherwise(F.regexp_extract(told, "^[A-Z]+", 0))


def problems(document: Column, schema: dict, depth: int = 12) -> Column:
    """What a document (VARIANT) violates, as array of "path: keyword"; empty if nothing. A null document is JSON's null. A
    schema that refers to itself is followed `depth` references deep; what lies deeper is a problem."""

    def unlike(spec: dict) -> None:
        if more := set(spec) - KNOWN:
            raise ValueError(f"keywords out of the subset: {sorted(more)}")

    def one(name: str, path: Column, wrong: Column) -> Column:
        return F.when(wrong, F.array(F.concat(path, F.lit(f": {name}")))).otherwise(F.array().cast(NONE))

    def same(v: Column, kind: Column, value: object) -> Column:
        if value is None:
            return kind == "VOID"
        if isinstance(value, bool):
            return (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(value))
        if isinstance(value, int):
            return (kind == "BIGINT") & (F.try_variant_get(v, "$", "decimal(38,0)") == F.lit(str(value)).cast("decimal(38,0)"))
        if isinstance(value, str):
            return (kind == "STRING") & (F.try_variant_get(v, "$", "string") == F.lit(value))
        raise ValueError("const and enum hold strings, integers, booleans and null")

    def check(v: Column, spec: dict, path: Column, left: int) -> Column:
        unlike(spec)
        if "$ref" in spec:
            if not left:
                return one("depth", path, F.lit(True))
            return check(v, schema["$defs"][spec["$ref"].rsplit("/", 1)[-1]], path, left - 1)
        for name in ("anyOf", "oneOf"):
            if name in spec:
                fits = [(F.size(check(v, choice, path, left)) == 0).cast("int") for choice in spec[name]]
                number = sum(fits[1:], fits[0])
                return one(name, path, number == 0 if name == "anyOf" else number != 1)

        def of_kind(kind: Column) -> Column:
            found = []
            if "type" in spec:
                kinds = spec["type"] if isinstance(spec["type"], list) else [spec["type"]]
                found.append(one("type", path, ~kind.isin([KINDS[k] for k in kinds])))
            for name in ("const", "enum"):
                if name in spec:
                    values = [spec["const"]] if name == "const" else spec["enum"]
                    fits = F.lit(False)
                    for value in values:
                        fits = fits | same(v, kind, value)
                    found.append(one(name, path, ~F.coalesce(fits, F.lit(False))))
            if "minLength" in spec:
                found.append(one("minLength", path, (kind == "STRING") & (F.char_length(F.try_variant_get(v, "$", "string")) < spec["minLength"])))
            if "minimum" in spec:
                found.append(one("minimum", path, (kind == "BIGINT") & (F.try_variant_get(v, "$", "decimal(38,0)") < F.lit(str(spec["minimum"])).cast("decimal(38,0)"))))
            if "items" in spec:
                each = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: check(x, spec["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), left))
                found.append(F.when(kind == "ARRAY", F.flatten(each)).otherwise(F.array().cast(NONE)))
            if {"required", "properties", "additionalProperties"} & set(spec):
                found.append(F.when(kind == "OBJECT", let(F.try_variant_get(v, "$", "map<string,variant>"), members)).otherwise(F.array().cast(NONE)))
            return F.concat(F.array().cast(NONE), *found)

        def members(m: Column) -> Column:
            properties, found = spec.get("properties", {}), []
            for name in spec.get("required", []):
                found.append(one("required", F.concat(path, F.lit(f".{name}")), ~F.map_contains_key(m, name)))
            if spec.get("additionalProperties") is False:
                extra = F.array_except(F.map_keys(m), F.array(*map(F.lit, properties)) if properties else F.array().cast(NONE))
                found.append(F.transform(F.sort_array(extra), lambda k: F.concat(path, F.lit("."), k, F.lit(": additionalProperties"))))
            for name, inner in properties.items():
                own = check(F.element_at(m, F.lit(name)), inner, F.concat(path, F.lit(f".{name}")), left)
                found.append(F.when(F.map_contains_key(m, name), own).otherwise(F.array().cast(NONE)))
            return F.concat(F.array().cast(NONE), *found)

        return let(kind_of(v), of_kind)

    return check(document, schema, F.lit("$"), depth)


def conforms(document: Column, schema: dict, depth: int = 12) -> Column:
    return F.size(problems(document, schema, depth)) == 0
