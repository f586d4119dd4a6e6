"""Rules compiled from JSON Schemas."""

import json

import pytest
from pyspark.sql import functions as F

from pagemill.operators import conformance
from pagemill.schema import DOCUMENT, DOCUMENT_RULES

ORDER = {
    "type": "object", "required": ["id", "buyer", "lines"],
    "properties": {
        "id": {"type": "string", "pattern": "^[A-Z]{2}[0-9]+$", "minLength": 4, "maxLength": 8},
        "when": {"type": "string", "format": "date"},
        "buyer": {"type": "object", "required": ["mail"], "additionalProperties": False,
                  "properties": {"mail": {"type": "string", "format": "email"}, "age": {"type": "integer", "minimum": 18}}},
        "lines": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True,
                  "items": {"type": "object", "required": ["sku"],
                            "properties": {"sku": {"type": "string", "format": "uuid"}, "n": {"type": "number", "exclusiveMinimum": 0, "multipleOf": 2}}}},
        "kind": {"enum": ["a", "b"]}, "ip": {"type": "string", "format": "ipv4"}, "rate": {"type": "integer", "maximum": 9},
        "flag": {"type": ["boolean", "null"]}, "label": {"type": "integer"}, "tags": {"type": "array", "items": {"type": "string", "enum": ["x", "y"]}},
    },
}
TYPES = ("id string, `when` string, buyer struct<mail:string,age:int,extra:string>, lines array<struct<sku:string,n:double>>, "
         "kind string, ip string, rate double, flag boolean, label string, tags array<string>")
GOOD_SKU = "123e4567-e89b-12d3-a456-426614174000"
GOOD = ("AB12", "2025-01-31", ("a@b.c", 20, None), [(GOOD_SKU, 2.0)], "a", "10.0.0.255", 9.0, True, None, ["x", "y"])


def changed(**values):
    names = ["id", "when", "buyer", "lines", "kind", "ip", "rate", "flag", "label", "tags"]
    return tuple(values.get(n, v) for n, v in zip(names, GOOD))


@pytest.mark.parametrize("values, broken", [
    ({}, []),
    ({"id": None, "buyer": None, "lines": None}, ["required:id", "required:buyer", "required:lines"]),
    ({"id": "A1"}, ["pattern:id", "minLength:id"]), ({"id": "AB1234567"}, ["maxLength:id"]),
    ({"when": "31.1.2025"}, ["format:when"]), ({"when": None}, []),
    ({"buyer": (None, 17, "x")}, ["required:buyer.mail", "minimum:buyer.age", "additional:buyer.extra"]),
    ({"buyer": ("no mail", None, None)}, ["format:buyer.mail"]),
    ({"lines": []}, ["minItems:lines"]),
    ({"lines": [(GOOD_SKU, 2.0)] * 4}, ["maxItems:lines", "uniqueItems:lines"]),
    ({"lines": [(GOOD_SKU, 2.0), (None, 0.0), ("bad", 3.0)]},
     ["required:lines[].sku", "format:lines[].sku", "exclusiveMinimum:lines[].n", "multipleOf:lines[].n"]),
    ({"kind": "c"}, ["enum:kind"]), ({"ip": "256.1.1.1"}, ["format:ip"]), ({"ip": "1.2.3"}, ["format:ip"]),
    ({"rate": 9.5}, ["type:rate", "maximum:rate"]), ({"label": "text"}, ["type:label"]), ({"tags": ["x", "z", None]}, ["enum:tags[]"]),
])
def test_another_schema(spark, values, broken):
    row = conformance.with_violations(spark.createDataFrame([changed(**values)], TYPES), json.loads(json.dumps(ORDER))).first()
    assert row.violations == broken


def test_summary_of_another_schema(spark):
    rows = spark.createDataFrame([changed(), changed(kind="c"), changed(kind="d", ip="x")], TYPES)
    assert {r.rule: r.n for r in conformance.violation_summary(rows, ORDER).collect()} == {"enum:kind": 2, "format:ip": 1}
    assert conformance.violation_summary(rows, {"type": "object"}).count() == 0
    assert conformance.with_violations(rows, {}).first().violations == []


def test_document_rules_cover_every_field(spark):
    assert list(DOCUMENT_RULES["properties"]) == DOCUMENT.fieldNames() == DOCUMENT_RULES["required"]
    nothing = spark.createDataFrame([tuple([None] * len(DOCUMENT.fields))], DOCUMENT)
    assert conformance.with_violations(nothing).first().violations == [f"required:{n}" for n in DOCUMENT.fieldNames()]


def test_columns_with_dots_and_none(spark):
    rows = spark.range(1).select(F.lit(5).alias("a.b"))
    schema = {"required": ["a.b", "gone"], "properties": {"a.b": {"type": "integer", "maximum": 4}}}
    assert conformance.with_violations(rows, schema).first().violations == ["required:gone", "maximum:a.b"]
