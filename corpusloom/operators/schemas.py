"""JSON Schema as column expressions over VARIANT values: nested rules become nested higher-order functions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keywords that say nothing about a value.
ANNOTATIONS = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples"}
KNOWN = ANNOTATIONS | {
    "$ref", "type", "enum", "const", "pattern", "minLength", "maxLength", "format", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "items", "minItems", "maxItems", "uniqueItems",
    "required", "properties", "additionalProperties", "minProperties", "maxProperties", "allOf", "anyOf", "oneOf", "not",
}
_NUMBER = r"^(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)"
_KINDS = {"string": "^STRING", "number": _NUMBER, "integer": _NUMBER, "boolean": "^BOOLEAN", "object": "^OBJECT<", "array": "^ARRAY<", "null": "^VOID"}
_FORMATS = {
    "date-time": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:[Zz]|[+-][0-9]{2}:[0-9]{2})$", lambda t: F.try_to_timestamp(F.upper(F.replace(t, F.lit(" "), F.lit("T")))).isNotNull()),
    "date": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", lambda t: t.try_cast("date").isNotNull()),
    "uri": (r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]*$", None),
}
ERRORS = "array<string>"
#: How often a reference may be followed within itself.
DEPTH = 4


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _number(x) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool)


class _Compiler:
    def __init__(self, root: dict, depth: int):
        self.root, self.depth = root, depth

    def target(self, ref: str) -> dict | bool:
        if not ref.startswith("#"):
            raise ValueError(f"a reference to another document: {ref}")
        found = self.root
        for part in [p.replace("~1", "/").replace("~0", "~") for p in ref[1:].split("/") if p]:
            if not isinstance(found, dict) or part not in found:
                raise ValueError(f"a reference to nothing: {ref}")
            found = found[part]
        return found

    def _within(self, schema: dict | bool, path: Column, refs: tuple[str, ...]):
        return lambda x: self.errors(schema, x, path, refs)

    def errors(self, schema: dict | bool, v: Column, path: Column, refs: tuple[str, ...] = ()) -> Column:
        """array<string> of what is broken in a value; of a missing one nothing."""
        none = F.array().cast(ERRORS)
        if schema is True or schema == {}:
            return none
        if schema is False:
            return F.when(v.isNotNull(), F.array(F.concat(path, F.lit(" forbidden")))).otherwise(none)
        if unknown := schema.keys() - KNOWN:
            raise ValueError(f"unknown keywords: {sorted(unknown)}")
        kind = F.schema_of_variant(v)
        is_ = lambda t: kind.rlike(_KINDS[t])
        number = F.when(is_("number"), F.try_variant_get(v, "$", "double"))
        text = F.when(is_("string"), F.try_variant_get(v, "$", "string"))
        items = F.when(is_("array"), F.try_variant_get(v, "$", "array<variant>"))
        entries = F.when(is_("object"), F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")))
        keys = F.transform(entries, lambda e: e["key"])
        same = lambda x: F.coalesce(number == float(x), F.lit(False)) if _number(x) else F.to_json(v) == json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        rules: list[tuple[str, Column]] = []
        rule = lambda name, bad: rules.append((name, bad))
        if "type" in schema:
            names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            whole = F.coalesce(number == F.floor(number), F.lit(False))
            fits = [is_(n) & whole if n == "integer" else is_(n) for n in names]
            rule("type", ~F.coalesce(F.greatest(*fits, F.lit(False)), F.lit(False)))
        if "enum" in schema:
            rule("enum", ~F.greatest(*[same(x) for x in schema["enum"]], F.lit(False)))
        if "const" in schema:
            rule("const", ~same(schema["const"]))
        if "pattern" in schema:
            rule("pattern", ~text.rlike(schema["pattern"]))
        if "format" in schema:
            if schema["format"] not in _FORMATS:
                raise ValueError(f"unknown format: {schema['format']}")
            shape, valid = _FORMATS[schema["format"]]
            rule("format", text.isNotNull() & (~text.rlike(shape) | (~valid(text) if valid else F.lit(False))))
        for name, size, less in (("Length", F.length(text), None), ("Items", F.size(items), items), ("Properties", F.size(entries), entries)):
            there = F.lit(True) if less is None else less.isNotNull()
            if f"min{name}" in schema:
                rule(f"min{name}", there & (size < schema[f"min{name}"]))
            if f"max{name}" in schema:
                rule(f"max{name}", there & (size > schema[f"max{name}"]))
        for name, bad in (("minimum", lambda x: number < x), ("maximum", lambda x: number > x), ("exclusiveMinimum", lambda x: number <= x), ("exclusiveMaximum", lambda x: number >= x)):
            if name in schema:
                rule(name, bad(schema[name]))
        if schema.get("uniqueItems"):
            canon = F.transform(items, lambda x: F.coalesce(F.when(F.schema_of_variant(x).rlike(_NUMBER), F.try_variant_get(x, "$", "double").cast("string")), F.to_json(x)))
            rule("uniqueItems", F.size(F.array_distinct(canon)) < F.size(canon))
        known = schema.get("properties", {})
        others = F.filter(entries, lambda e: ~F.coalesce(F.array_contains(F.array(*[F.lit(k) for k in known]).cast(ERRORS), e["key"]), F.lit(False)))
        if schema.get("additionalProperties") is False:
            rule("closed", F.size(others) > 0)
        for name in ("anyOf", "oneOf"):
            if name in schema:
                fit = sum(F.when(F.size(self.errors(s, v, path, refs)) == 0, 1).otherwise(0) for s in schema[name])
                rule(name, fit == 0 if name == "anyOf" else fit != 1)
        if "not" in schema:
            rule("not", F.size(self.errors(schema["not"], v, path, refs)) == 0)
        found = [F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.concat(path, F.lit(" " + name))) for name, bad in rules], F.lit(None).cast("string")))]
        if required := schema.get("required"):
            lacking = F.array_except(F.array(*[F.lit(k) for k in required]), keys)
            found.append(F.coalesce(F.transform(lacking, lambda k: F.concat(path, F.lit("."), k, F.lit(" required"))), none))
        for name, sub in known.items():
            if '"' in name:
                raise ValueError(f"a quote in a property's name: {name}")
            found.append(_let(F.try_variant_get(v, f'$["{name}"]', "variant"), self._within(sub, F.concat(path, F.lit(f".{name}")), refs)))
        if isinstance(sub := schema.get("additionalProperties", True), dict):
            found.append(F.coalesce(F.flatten(F.transform(others, lambda e: self.errors(sub, e["value"], F.concat(path, F.lit("."), e["key"]), refs))), none))
        if "items" in schema:
            found.append(F.coalesce(F.flatten(F.transform(items, lambda x, i: self.errors(schema["items"], x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), refs))), none))
        for s in schema.get("allOf", []):
            found.append(self.errors(s, v, path, refs))
        if ref := schema.get("$ref"):
            if refs.count(ref) >= self.depth:
                found.append(F.array(F.concat(path, F.lit(" depth"))))
            else:
                found.append(self.errors(self.target(ref), v, path, (*refs, ref)))
        return F.when(v.isNotNull(), F.concat(*found)).otherwise(none)


def compile_schema(schema: dict, value: Column, depth: int = DEPTH) -> Column:
    """array<string> of what a VARIANT column breaks of a JSON Schema (draft 2020-12): "<path> <keyword>" each.

    References go to places of the same document; one that leads back to itself is followed depth times, and a value that goes
    deeper still is an error ("depth"), never passed over. Raises on keywords, formats and references that aren't known. A missing value breaks nothing.
    Numbers are compared as doubles, and 3.0 is an integer.
    """
    return _Compiler(schema, depth).errors(schema, value, F.lit("$"))


def schema_checks(df: DataFrame, schema: dict, key: str, json: str, depth: int = DEPTH) -> DataFrame:
    """check, key, message for each rule of a schema that a JSON text column breaks, and for texts that aren't JSON. Null: not JSON."""
    v = df.select(F.col(key).cast("string").alias("key"), F.try_parse_json(json).alias("v"))
    found = F.when(F.col("v").isNull(), F.array(F.lit("not JSON"))).otherwise(compile_schema(schema, F.col("v"), depth))
    return v.select(F.lit("schema").alias("check"), "key", F.explode(found).alias("message"))
