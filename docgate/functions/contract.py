"""A message contract (a subset of JSON Schema) compiled to Spark SQL expressions.

Compilation happens once, on the driver, while the plan is built; nothing of the contract is
interpreted per row. A keyword outside the subset is an error at that point.

Rules apply to values of their kind only: lengths to strings, bounds to numbers, members to
objects, items to arrays. Numbers are compared as doubles; 1.0 is an integer, true is no number.
"""

from __future__ import annotations

import functools
import json
import math
import re
from dataclasses import dataclass
from pathlib import Path
from typing import IO

from docgate.functions.sqltext import quoted
from docgate.functions.strict_json import ROOT

# The file holds fixed values.
DEFAULT_CONTRACT = Path(__file__).resolve().parent.parent / "contract.json"
VIOLATION = "CONTRACT_VIOLATION"
NO_ERRORS = "CAST(array() AS ARRAY<STRUCT<path: STRING, code: STRING, message: STRING>>)"

_ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "format", "default", "examples"}
# Keyword -> (SQL of the kind test, of the measure, sign of a violation), with the names of a node.
_LIMITS = {
    "minLength": ("{kind} = 'STRING'", "length({text})", "<"),
    "maxLength": ("{kind} = 'STRING'", "length({text})", ">"),
    "minimum": ("{is_number}", "{number}", "<"),
    "maximum": ("{is_number}", "{number}", ">"),
    "exclusiveMinimum": ("{is_number}", "{number}", "<="),
    "exclusiveMaximum": ("{is_number}", "{number}", ">="),
    "minItems": ("{kind} LIKE 'ARRAY<%'", "size({items})", "<"),
    "maxItems": ("{kind} LIKE 'ARRAY<%'", "size({items})", ">"),
}
_KEYWORDS = (
    _ANNOTATIONS | set(_LIMITS)
    | {"type", "enum", "const", "pattern", "required", "properties", "additionalProperties", "items"}
)
# JSON type -> SQL test of the type name that Spark reports for a variant.
_TYPES = {
    "string": "{kind} = 'STRING'",
    "boolean": "{kind} = 'BOOLEAN'",
    "null": "{kind} = 'VOID'",
    "object": "{kind} LIKE 'OBJECT<%'",
    "array": "{kind} LIKE 'ARRAY<%'",
    "number": "{is_number}",
    "integer": "({is_number} AND {number} % 1D = 0D)",
}


@dataclass(frozen=True)
class Rule:
    """What one place of a message must be."""

    types: tuple[str, ...] = ()
    allowed: tuple[object, ...] | None = None
    pattern: str | None = None
    limits: tuple[tuple[str, float], ...] = ()
    required: tuple[str, ...] = ()
    closed: bool = False
    fields: tuple[tuple[str, Rule], ...] = ()
    items: Rule | None = None


@dataclass(frozen=True)
class Contract:
    root: Rule

    @classmethod
    def from_path(cls, path: str | Path = DEFAULT_CONTRACT) -> Contract:
        return _compiled(Path(path).read_text(encoding="utf-8"))

    @classmethod
    def from_stream(cls, stream: IO[str]) -> Contract:
        return _compiled(stream.read())


def _java_pattern(pattern: str) -> str:
    """The same pattern for Java: digits of any script, and ``$`` before one final newline."""
    escapes = set(re.findall(r"\\([A-Za-z0-9])", pattern))
    if escapes - {"d"}:
        raise ValueError(f"unsupported escape in contract pattern {pattern!r}")
    anchored = pattern.endswith("$") and not pattern.endswith("\\$")
    body = (pattern[:-1] if anchored else pattern).replace("\\d", "\\p{Nd}")
    return body + ("\\n?\\z" if anchored else "")


def _rule(spec: object, where: str) -> Rule:
    if not isinstance(spec, dict):
        raise ValueError(f"unsupported contract at {where}: {spec!r}")
    unknown = sorted(set(spec) - _KEYWORDS)
    if unknown:
        raise ValueError(f"unsupported contract keyword at {where}: {', '.join(unknown)}")
    types = spec.get("type", [])
    types = (types,) if isinstance(types, str) else tuple(types)
    if not set(types) <= set(_TYPES):
        raise ValueError(f"unsupported type {spec['type']!r} at {where}")
    allowed = tuple(spec["enum"]) if "enum" in spec else None
    if "const" in spec:
        if allowed is not None:
            raise ValueError(f"enum and const together are not supported, at {where}")
        allowed = (spec["const"],)
    if any(isinstance(v, (dict, list)) for v in allowed or ()):
        raise ValueError(f"only single values can be enumerated, at {where}")
    limits = tuple((k, float(spec[k])) for k in _LIMITS if k in spec)
    if not all(math.isfinite(bound) for _, bound in limits):
        raise ValueError(f"limits must be finite, at {where}")
    additional = spec.get("additionalProperties", True)
    if not isinstance(additional, bool):
        raise ValueError(f"additionalProperties must be true or false, at {where}")
    properties = spec.get("properties", {})
    return Rule(
        types,
        allowed,
        _java_pattern(spec["pattern"]) if "pattern" in spec else None,
        limits,
        tuple(spec.get("required", ())),
        not additional,
        tuple((key, _rule(properties[key], f"{where}.{key}")) for key in sorted(properties)),
        _rule(spec["items"], f"{where}[]") if "items" in spec else None,
    )


@functools.cache
def _compiled(text: str) -> Contract:
    spec = json.loads(text)
    root = _rule(spec, "$")
    if root.types != ("object",):
        raise ValueError("a contract must describe an object")
    return Contract(root)


def error_list(condition: str, path: str, code: str, message: str) -> str:
    """SQL of a one-error array where the condition holds, an empty one elsewhere.

    ``message`` is SQL text.
    """
    return _error_list(condition, quoted(path), code, message)


def _error_list(condition: str, path: str, code: str, message: str) -> str:
    item = f"named_struct('path', {path}, 'code', {quoted(code)}, 'message', {message})"
    return f"CASE WHEN {condition} THEN array({item}) ELSE {NO_ERRORS} END"


def _joined(errors: list[str]) -> str:
    return f"concat({', '.join(errors)})" if errors else NO_ERRORS


def _double(value: float) -> str:
    return f"{float(value)!r}D"


class _Columns:
    """SQL of the errors of a message, and the helper columns that it uses."""

    def __init__(self) -> None:
        self.helpers: list[str] = []

    def named(self, sql: str, inside: int) -> str:
        """The expression as a helper column; inside the items of an array it stays in place."""
        if inside:
            return sql
        self.helpers.append(f"{sql} AS _part{len(self.helpers)}")
        return f"_part{len(self.helpers) - 1}"

    def place(self, rule: Rule, value: str, path: str, inside: int) -> list[str]:
        """Errors of one place: its own first, then those of its members and items."""
        found: list[str] = []

        def add(condition: str, message: str) -> None:
            found.append(_error_list(condition, path, VIOLATION, quoted(message)))

        kind = self.named(f"schema_of_variant({value})", inside)
        sql = {
            "kind": kind,
            "is_number": f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL(%')",
            "number": f"try_variant_get({value}, '$', 'double')",
            "text": f"try_variant_get({value}, '$', 'string')",
            "items": f"try_variant_get({value}, '$', 'array<variant>')",
        }
        if rule.allowed is not None or rule.pattern is not None:
            sql["text"] = self.named(sql["text"], inside)
        if rule.types:
            names = " or ".join(f"'{t}'" for t in rule.types)
            right = " OR ".join(_TYPES[t].format(**sql) for t in rule.types)
            add(f"NOT ({right})", f"is not of type {names}")
        if rule.allowed is not None:
            equal = " OR ".join(_equal(v, sql) for v in rule.allowed) or "false"
            add(f"{kind} IS NOT NULL AND NOT ({equal})", "is not one of the allowed values")
        if rule.pattern is not None:
            unlike = f"{kind} = 'STRING' AND NOT {sql['text']} RLIKE {quoted(rule.pattern)}"
            add(unlike, "does not match the pattern")
        for keyword, bound in rule.limits:
            test, measure, sign = (part.format(**sql) for part in _LIMITS[keyword])
            add(f"{test} AND {measure} {sign} {_double(bound)}", f"violates {keyword}")
        if rule.required or rule.closed or rule.fields:
            members = self.named(f"try_variant_get({value}, '$', 'map<string,variant>')", inside)
            found += self.members(rule, members, path, inside)
        if rule.items is not None:
            item, at = f"_item{inside}", f"_at{inside}"
            nested = self.place(rule.items, item, f"concat({path}, '.', {at})", inside + 1)
            each = f"flatten(transform({sql['items']}, ({item}, {at}) -> {_joined(nested)}))"
            found.append(f"coalesce({each}, {NO_ERRORS})")
        return found

    def members(self, rule: Rule, members: str, path: str, inside: int) -> list[str]:
        """Errors of an object's members; ``members`` is NULL for what is no object."""
        found = []
        for key in rule.required:
            missing = f"NOT array_contains(map_keys({members}), {quoted(key)})"
            text = quoted(f"'{key}' is a required property")
            found.append(_error_list(missing, path, VIOLATION, text))
        if rule.closed:
            known = ", ".join(quoted(key) for key, _ in rule.fields)
            extra = self.named(
                f"array_sort(array_except(map_keys({members}), CAST(array({known}) AS ARRAY<STRING>)))",
                inside,
            )
            text = f"concat({quoted('additional properties not allowed: ')}, array_join({extra}, ', '))"
            found.append(_error_list(f"size({extra}) > 0", path, VIOLATION, text))
        for key, rule_of_key in rule.fields:
            member = self.named(f"try_element_at({members}, {quoted(key)})", inside)
            at = f"concat({path}, {quoted('.' + key)})"
            found += self.place(rule_of_key, member, at, inside)
        return found


def _equal(value: object, sql: dict[str, str]) -> str:
    """SQL test for one enumerated value."""
    if value is None:
        return f"{sql['kind']} = 'VOID'"
    if isinstance(value, bool):
        return f"({sql['kind']} = 'BOOLEAN' AND {sql['text']} = '{str(value).lower()}')"
    if isinstance(value, (int, float)):
        return f"({sql['is_number']} AND {sql['number']} = {_double(value)})"
    return f"({sql['kind']} = 'STRING' AND {sql['text']} = {quoted(value)})"


def contract_columns(contract: Contract) -> list[str]:
    """SQL of ``_members`` (top-level name -> variant) and ``_violations``, and of helper columns.

    The order of the errors is fixed: by path, and at one place type, values, limits, members.
    """
    columns = _Columns()
    listed = _joined(columns.members(contract.root, "_members", "'$'", 0))
    no_object = error_list("true", "$", VIOLATION, quoted("is not of type 'object'"))
    return [
        f"try_variant_get(_wrapped, {quoted(ROOT)}, 'map<string,variant>') AS _members",
        *columns.helpers,
        f"CASE WHEN _members IS NULL THEN {no_object} ELSE {listed} END AS _violations",
    ]
