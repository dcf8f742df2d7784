"""JSON schemas as Column expressions: one array of errors per value, inside the plan."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What says nothing about values. (`format` is a remark by default.)
REMARKS = {"$schema", "$id", "$defs", "title", "description", "format", "default", "examples"}
#: Rules that hold other rules against the same value.
_BRANCHES = {"allOf", "anyOf", "oneOf", "not", "if"}


def _get(v: Column, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(v, path, kind)


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests) if tests else F.lit(False)


@dataclass
class _Shape:
    """What is taken from a variant before rules look at it: the members of an object (`fields`), the items of an array (`item`), or nothing."""

    part: str = ""
    fields: dict[str, _Shape] = field(default_factory=dict)
    item: _Shape | None = None

    def ddl(self) -> str:
        members = ", ".join(f"`{n.replace('`', '``')}`: {s.ddl()}" for n, s in self.fields.items())
        return {"object": f"struct<{members or '_: boolean'}>", "array": f"array<{self.item.ddl() if self.item else 'variant'}>", "": "variant"}[self.part]


@dataclass
class _Value:
    """What rules ask of a variant `v`, of which a part has been taken if its shape has one. Nested values show by that what they
    are: schema_of_variant would read all that is below. `there`: whether it is there at all, for a member."""

    v: Column
    shape: _Shape
    part: Column | None = None
    k: Column | None = None
    there: Column | None = None

    @property
    def kind(self) -> Column:
        k = F.schema_of_variant(self.v) if self.k is None else self.k
        return F.when(self.part.isNotNull(), self.shape.part.upper()).otherwise(k) if self.shape.part else k

    def get(self, kind: str) -> Column:
        return _get(self.v, kind)

    @property
    def items(self) -> Column:
        return self.part if self.shape.part == "array" else self.get("array<variant>")

    def member(self, name: str) -> _Value:
        own = _get(self.v, "variant", f"$[{json.dumps(name)}]")
        if name not in self.shape.fields:
            return _Value(own, _Shape(), there=own.isNotNull())
        shape, x = self.shape.fields[name], self.part[name]
        return _Value(own, shape, x, there=x.isNotNull() | own.isNotNull()) if shape.part else _Value(x, shape, there=x.isNotNull())

    def is_a(self, kind: str) -> Column:
        """Whether the value has a JSON type; 1.0 is an integer."""
        if kind == self.shape.part:
            return self.part.isNotNull()
        if kind in ("object", "array"):
            return self.kind.startswith(kind.upper())
        if kind == "number":
            return F.substring(self.kind, 1, 3).isin("BIG", "DEC", "DOU", "FLO")
        if kind == "integer":
            return (self.kind == "BIGINT") | (self.is_a("number") & (self.get("double") == F.floor(self.get("double"))))
        return self.kind == {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}[kind]

    def equals(self, to) -> Column:
        """Whether it is a plain JSON value."""
        if to is None:
            return self.is_a("null")
        if isinstance(to, bool):
            return self.is_a("boolean") & (self.get("boolean") == F.lit(to))
        if isinstance(to, (int, float)):
            return self.is_a("number") & (self.get("double") == F.lit(float(to)))
        if isinstance(to, str):
            return self.is_a("string") & (self.get("string") == F.lit(to))
        raise ValueError(f"only plain values can be compared, not {to!r}")

    def listed(self, values: list) -> list[Column]:
        """Tests for equality with one of the values; texts are looked for together."""
        texts = [x for x in values if isinstance(x, str)]
        return [self.equals(x) for x in values if not isinstance(x, str)] + ([self.is_a("string") & self.get("string").isin(texts)] if texts else [])


@dataclass
class _Errors:
    """Tests that fail, with the numbers of their texts, and texts of errors below: numbers joined by commas, some of them empty."""

    own: list[tuple[Column, Column]] = field(default_factory=list)
    below: list[Column] = field(default_factory=list)

    def none(self) -> Column:
        fine = ~F.coalesce(_any([bad for bad, _ in self.own]), F.lit(False))
        return fine & (F.replace(F.concat_ws(",", *self.below), F.lit(",")) == "") if self.below else fine

    def when(self, test: Column) -> _Errors:
        return _Errors([(test & bad, n) for bad, n in self.own], [F.when(test, e) for e in self.below])

    def text(self) -> Column | None:
        """None if nothing can fail. Texts are put together for values with errors alone."""
        own = [F.when(_any([bad for bad, _ in self.own]), F.concat_ws(",", *(F.when(bad, n) for bad, n in self.own)))] if self.own else []
        return own[0] if own and not self.below else F.concat_ws(",", *own, *self.below) if self.below else None


class _Compiler:
    def __init__(self, root: dict):
        self.root = root
        self.texts: dict[str, int] = {}  # all that can be said is known beforehand

    def number(self, text: str) -> Column:
        return F.lit(str(self.texts.setdefault(text, len(self.texts) + 1)))

    def target(self, ref: str, open_refs: tuple[str, ...]) -> dict:
        at = self.root
        if not ref.startswith("#/"):
            raise ValueError(f"only references inside the schema are known, not {ref}")
        if ref in open_refs:
            raise ValueError(f"{ref} refers to itself; expressions have a fixed depth")
        for part in ref[2:].split("/"):
            at = at[part.replace("~1", "/").replace("~0", "~")]
        return at

    def alike(self, schema: dict, open_refs: tuple[str, ...]) -> list[tuple[dict, tuple[str, ...]]]:
        """The schema and all inside it that are about the same value, each with its open references."""
        inner = [s for k in ("allOf", "anyOf", "oneOf") for s in schema.get(k, [])] + [schema[k] for k in ("not", "if", "then", "else") if k in schema]
        out = [(schema, open_refs)] + [r for s in inner for r in self.alike(s, open_refs)]
        if "$ref" in schema:
            out += self.alike(self.target(schema["$ref"], open_refs), (*open_refs, schema["$ref"]))
        return out

    def shape(self, schemas: list[tuple[dict, tuple[str, ...]]], inside: bool = False) -> _Shape:
        """inside: of items, which have no path by which to see whether a nested member is missing or of another kind. Those that
        may well be missing stay variants there."""
        rules = [r for schema, refs in schemas for r in self.alike(schema, refs)]
        asked = {k for r, _ in rules for k in r} | {k for r, _ in rules for k in ([r["type"]] if isinstance(r.get("type"), str) else r.get("type", []))}
        parts = [part for part, of in (("object", {"object", "properties", "required", "additionalProperties"}), ("array", {"array", "items", "minItems", "maxItems"})) if asked & of]
        if parts == ["array"]:
            item = self.shape([(r["items"], refs) for r, refs in rules if "items" in r], True)
            return _Shape("array", item=item if item.part == "object" else None)
        if parts != ["object"]:
            return _Shape()
        needed = {n for r, _ in rules for n in r.get("required", [])}
        names = sorted({n for r, _ in rules for n in r.get("properties", {})} | needed)
        low = [n.lower() for n in names]  # those that differ in case alone can't be fields of one struct
        own = {n: [(r["properties"][n], refs) for r, refs in rules if n in r.get("properties", {})] for n in names if low.count(n.lower()) == 1}
        return _Shape("object", {n: _Shape() if inside and n not in needed else self.shape(x, inside) for n, x in own.items()})

    def errors(self, schema: dict, v: _Value, path: str, open_refs: tuple[str, ...] = ()) -> _Errors:
        """The errors of a value that is there."""
        found = _Errors()

        def add(more: _Errors, test: Column | None = None) -> None:
            more = more if test is None else more.when(test)
            found.own.extend(more.own)
            found.below.extend(more.below)

        def fail(rule: str, bad: Column) -> None:
            found.own.append((bad, self.number(f"{path or '$'}: {rule}")))

        def unless(rule: str, good: Column) -> None:  # null, which fails nothing, for a plain member that is not there; whether a nested one is, is asked if it is not as it should be
            fail(rule, ~good & v.there if v.shape.part and v.there is not None else ~good)

        def parts(sub: dict) -> _Errors:
            return self.errors(sub, v, path, open_refs)

        def name_of(n: str) -> str:
            return f"{path}.{n}".lstrip(".")

        def each(kind: str, values: Column, sub: dict, at: str, item: _Shape | None = None) -> None:
            add(self.each(values, sub, at, open_refs, item, v.get("array<variant>")), v.is_a(kind))

        def member(n: str, sub: dict) -> None:
            x = v.member(n)  # only objects have members
            bound = not x.shape.part and (self.shape([(sub, open_refs)]).part or _BRANCHES & {k for r, _ in self.alike(sub, open_refs) for k in r})
            if bound:
                add(self.each(F.array(x.v), sub, name_of(n), open_refs), x.there)
            else:
                add(self.errors(sub, x, name_of(n), open_refs))

        def required(names: list[str]) -> None:
            for n in names:
                found.own.append((v.is_a("object") & ~v.member(n).there, self.number(f"{name_of(n)}: required")))

        def branch(sub: dict) -> None:
            test = parts(sub).none()
            for keyword, when in (("then", test), ("else", ~test)):
                if keyword in schema:
                    add(parts(schema[keyword]), when)

        rules: dict[str, Callable] = {
            "$ref": lambda r: add(self.errors(self.target(r, open_refs), v, path, (*open_refs, r))),
            "type": lambda t: unless("type", _any([v.is_a(k) for k in ([t] if isinstance(t, str) else t)])),
            "enum": lambda values: unless("enum", _any(v.listed(values))),
            "const": lambda x: unless("const", v.equals(x)),
            "minimum": lambda x: fail("minimum", v.is_a("number") & (v.get("double") < x)),
            "maximum": lambda x: fail("maximum", v.is_a("number") & (v.get("double") > x)),
            "minLength": lambda x: fail("minLength", v.is_a("string") & (F.length(v.get("string")) < x)),
            "maxLength": lambda x: fail("maxLength", v.is_a("string") & (F.length(v.get("string")) > x)),
            "pattern": lambda x: fail("pattern", v.is_a("string") & ~v.get("string").rlike(x)),
            "minItems": lambda x: fail("minItems", v.is_a("array") & (F.size(v.items) < x)),
            "maxItems": lambda x: fail("maxItems", v.is_a("array") & (F.size(v.items) > x)),
            "required": required,
            "properties": lambda members: [member(n, s) for n, s in members.items()],
            "additionalProperties": lambda s: self.others(s, schema, v, path, fail, each),
            "items": lambda s: each("array", v.items, s, f"{path}[]", v.shape.item),
            "allOf": lambda subs: [add(parts(s)) for s in subs],
            "anyOf": lambda subs: unless("anyOf", _any([parts(s).none() for s in subs])),
            "oneOf": lambda subs: unless("oneOf", sum((parts(s).none().cast("int") for s in subs), F.lit(0)) == 1),
            "not": lambda sub: unless("not", ~parts(sub).none()),
            "if": branch,
        }
        for keyword, value in schema.items():
            if keyword in rules:
                rules[keyword](value)
            elif keyword not in REMARKS | {"then", "else"}:
                raise ValueError(f"unknown keyword {keyword!r} at {path or '$'}")
        return found

    def each(self, values: Column, schema: dict, path: str, open_refs: tuple[str, ...], item: _Shape | None = None, whole: Column | None = None) -> _Errors:
        """The errors of all values of an array. What rules look into is taken from each once, and so is its kind if several ask for it.
        item: the shape in which values have been taken already; whole: all of them as they are, for those that don't fit it."""
        made: list[Column | None] = []  # the lambda is built once

        def told(v: _Value) -> Column:
            made.append(self.errors(schema, v, path, open_refs).text())
            return F.lit("") if made[0] is None else made[0]

        if item:
            out = F.transform(values, lambda part, i: told(_Value(F.get(whole, i), item, part=part)))
            return _Errors([], [] if made[0] is None else [out])
        shape = self.shape([(schema, open_refs)])
        if shape.part:
            values = F.transform(values, lambda x: F.struct(x.alias("v"), _get(x, shape.ddl()).alias("part")))
            value = lambda b: _Value(b["v"], shape, part=b["part"])
        elif schema.keys() - REMARKS - {"type"}:
            values = F.transform(values, lambda x: F.struct(x.alias("v"), F.schema_of_variant(x).alias("k")))
            value = lambda b: _Value(b["v"], shape, k=b["k"])
        else:
            value = lambda b: _Value(b, shape)
        out = F.transform(values, lambda b: told(value(b)))
        return _Errors([], [] if made[0] is None else [out])

    def others(self, rule, schema: dict, v: _Value, path: str, fail, each) -> None:
        known = [F.lit(n) for n in schema.get("properties", {})]
        members = v.get("map<string,variant>")
        rest = F.map_filter(members, lambda k, _: ~k.isin(*known)) if known else members
        if rule is False:
            fail("additionalProperties", v.is_a("object") & (F.size(rest) > 0))
        elif isinstance(rule, dict):
            each("object", F.map_values(rest), rule, f"{path}.*".lstrip("."))


def errors(schema: dict, value: Column) -> Column:
    """The errors of a variant under a JSON schema: a sorted array of `path: rule`, each once; null for a null value.

    A path has [] for the items of an array and * for members that are not named. Known are the
    keywords of types, values, lengths, members, items, branches (allOf, anyOf, oneOf, not, if) and
    references inside the schema; any other keyword, and a schema that holds itself, raise when
    the expression is built. Nothing is collected: the result is a Column like any other.
    """
    compiler = _Compiler(schema)
    e = compiler.each(F.array(value), schema, "", ())
    texts = F.array(*map(F.lit, compiler.texts)).cast("array<string>")
    numbers = F.filter(F.split(F.concat_ws(",", *e.below), ","), lambda n: n != "")
    return F.when(value.isNotNull(), F.sort_array(F.array_distinct(F.transform(numbers, lambda n: F.element_at(texts, n.cast("int"))))))


def row_errors(rows: DataFrame, schema: dict) -> Column:
    """The errors of whole rows, as the JSON objects that they are written as: null columns are JSON nulls."""
    fields = [F.coalesce(F.to_variant_object(F.col(f"`{c}`")) if kind.startswith(("struct", "array", "map")) else F.col(f"`{c}`").cast("variant"), F.parse_json(F.lit("null"))).alias(c) for c, kind in rows.dtypes]
    return errors(schema, F.to_variant_object(F.struct(*fields)))
