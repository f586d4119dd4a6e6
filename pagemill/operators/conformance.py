"""Conformance of rows with a JSON Schema, compiled to column predicates."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.schema import DOCUMENT_RULES

_NUMBERS = (T.NumericType,)
_WHOLE = (T.IntegralType,)
_TEXT = (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)
# Column types that may hold values of a JSON type.
_TYPES = {
    "string": _TEXT, "integer": _NUMBERS, "number": _NUMBERS, "boolean": (T.BooleanType,),
    "object": (T.StructType, T.MapType), "array": (T.ArrayType,), "null": (T.NullType,)}
# URI with a scheme; RFC 3339 times and dates; what the other formats look like.
_FORMATS = {
    "uri": r"\A[A-Za-z][A-Za-z0-9+.\-]*:[^\s]*\z",
    "date-time": r"\A\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[Zz]|[+\-]\d{2}:\d{2})\z",
    "date": r"\A\d{4}-\d{2}-\d{2}\z",
    "email": r"\A[^@\s]+@[^@\s]+\z",
    "ipv4": r"\A(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?!\z)|\z)){4}\z",
    "uuid": r"\A[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\z",
}
Rule = tuple[str, Column]


def _type_rules(path: str, value: Column, kind: T.DataType, wanted: str | list[str]) -> list[Rule]:
    """A column either can hold the type, or no value in it can; whole numbers may stand in any number column."""
    names = [wanted] if isinstance(wanted, str) else wanted
    fits = [name for name in names if isinstance(kind, _TYPES[name])]
    if not fits:
        return [(f"type:{path}", value.isNotNull())]
    if fits == ["integer"] and not isinstance(kind, _WHOLE):
        return [(f"type:{path}", value != F.floor(value))]
    return []


def _bound_rules(path: str, value: Column, kind: T.DataType, rules: Mapping) -> list[Rule]:
    if not isinstance(kind, T.NumericType):
        return []
    found = []
    if "minimum" in rules and "maximum" in rules:
        found.append((f"range:{path}", ~value.between(rules["minimum"], rules["maximum"])))
    elif "minimum" in rules:
        found.append((f"minimum:{path}", value < rules["minimum"]))
    elif "maximum" in rules:
        found.append((f"maximum:{path}", value > rules["maximum"]))
    if "exclusiveMinimum" in rules:
        found.append((f"exclusiveMinimum:{path}", value <= rules["exclusiveMinimum"]))
    if "exclusiveMaximum" in rules:
        found.append((f"exclusiveMaximum:{path}", value >= rules["exclusiveMaximum"]))
    if "multipleOf" in rules:
        found.append((f"multipleOf:{path}", value % rules["multipleOf"] != 0))
    return found


def _text_rules(path: str, value: Column, kind: T.DataType, rules: Mapping) -> list[Rule]:
    if not isinstance(kind, T.StringType):
        return []
    found = []
    if rules.get("format") in _FORMATS:
        found.append((f"format:{path}", ~value.rlike(_FORMATS[rules["format"]])))
    if "pattern" in rules:
        found.append((f"pattern:{path}", ~value.rlike(rules["pattern"])))
    if "minLength" in rules:
        found.append((f"minLength:{path}", F.length(value) < rules["minLength"]))
    if "maxLength" in rules:
        found.append((f"maxLength:{path}", F.length(value) > rules["maxLength"]))
    return found


def _array_rules(path: str, value: Column, kind: T.DataType, rules: Mapping) -> list[Rule]:
    if not isinstance(kind, T.ArrayType):
        return []
    found = []
    if "minItems" in rules:
        found.append((f"minItems:{path}", F.size(value) < rules["minItems"]))
    if "maxItems" in rules:
        found.append((f"maxItems:{path}", F.size(value) > rules["maxItems"]))
    if rules.get("uniqueItems"):
        found.append((f"uniqueItems:{path}", F.size(F.array_distinct(value)) < F.size(value)))

    def any_item(test: Callable[[Column], Column]) -> Column:
        return F.exists(value, lambda item: F.coalesce(test(item), F.lit(False)))

    # A rule of the items is broken where it is broken for any of them.
    items = rules.get("items", {})
    for place, (name, _) in enumerate(_value_rules(f"{path}[]", F.lit(None).cast(kind.elementType), kind.elementType, items)):
        found.append((name, any_item(lambda item, at=place: _value_rules(f"{path}[]", item, kind.elementType, items)[at][1])))
    return found


def _value_rules(path: str, value: Column, kind: T.DataType, rules: Mapping) -> list[Rule]:
    """Rules on one value; a missing value breaks none of them."""
    found = _type_rules(path, value, kind, rules["type"]) if "type" in rules else []
    if "enum" in rules:
        found.append((f"enum:{path}", ~value.isin(*[v for v in rules["enum"] if v is not None])))
    if "const" in rules:
        found.append((f"enum:{path}", value != F.lit(rules["const"])))
    found += _text_rules(path, value, kind, rules) + _bound_rules(path, value, kind, rules) + _array_rules(path, value, kind, rules)
    if isinstance(kind, T.StructType):
        found += _object_rules(f"{path}.", kind, lambda name: value[name], rules, value.isNotNull())
    return found


def _object_rules(prefix: str, kind: T.StructType, field: Callable[[str], Column], rules: Mapping, present: Column) -> list[Rule]:
    """First what is missing, then the rules of every property that there is, in schema order."""
    types = {f.name: f.dataType for f in kind.fields}
    found = [(f"required:{prefix}{name}", present & field(name).isNull() if name in types else present) for name in rules.get("required", ())]
    for name, inner in rules.get("properties", {}).items():
        if name in types:
            found += _value_rules(f"{prefix}{name}", field(name), types[name], inner)
    if rules.get("additionalProperties") is False:
        found += [(f"additional:{prefix}{name}", field(name).isNotNull()) for name in types if name not in rules.get("properties", {})]
    return found


def compile_rules(docs: DataFrame, schema: Mapping = DOCUMENT_RULES) -> list[Rule]:
    """(rule name, column that is true where the rule is broken) of a JSON Schema for these rows.

    Covered are type, required, properties (nested too), enum, const, minimum, maximum, their exclusive forms,
    multipleOf, format, pattern, minLength, maxLength, items, minItems, maxItems, uniqueItems and
    additionalProperties. A missing and a null value are the same. Rows that could not be read as JSON at all
    (``_corrupt_record``) break the rule ``type``.
    """
    def field(name: str) -> Column:
        return F.col(f"`{name}`")

    columns = T.StructType([f for f in docs.schema.fields if f.name != "_corrupt_record"])
    rules = _object_rules("", columns, field, schema, F.lit(True))
    if "_corrupt_record" in docs.columns:
        rules.append(("type", F.col("_corrupt_record").isNotNull()))
    return [(name, F.coalesce(test, F.lit(False))) for name, test in rules]


def with_violations(docs: DataFrame, schema: Mapping = DOCUMENT_RULES) -> DataFrame:
    """Add ``violations``: names of the broken rules, in schema order."""
    rules = compile_rules(docs, schema)
    if not rules:
        return docs.withColumn("violations", F.array().cast("array<string>"))
    return docs.withColumn("violations", F.array_compact(
        F.array(*[F.when(test, F.lit(name)) for name, test in rules])))


def violation_summary(docs: DataFrame, schema: Mapping = DOCUMENT_RULES) -> DataFrame:
    """(rule, n) over all rows; counts are taken per column, without exploding rows."""
    rules = compile_rules(docs, schema)
    if not rules:
        return docs.sparkSession.createDataFrame([], "rule string, n long")
    counts = docs.groupBy().agg(*[F.count_if(test).alias(f"r{i}") for i, (_, test) in enumerate(rules)])
    return (counts.select(F.inline(F.array(*[
                F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n"))
                for i, (name, _) in enumerate(rules)])))
            .filter("n > 0"))
