"""The schema compiler against hand-checked documents, and every enumeration damaged once."""

import json

import pytest
from pyspark.sql import functions as F

from adloom.functions import vocab
from adloom.operators import document as D
from adloom.operators import quality as Q
from adloom.operators.schema import Schema, document_schema

WANTED = {
    "ad_id": "20260706143500000987",
    "metadata": {"status": "active", "adexpirystatus": "active", "adtimezone": "America/New_York", "admetroarea": "new-york-metro-area", "adactivedate": "2026-07-04", "adexpirydate": "2026-08-01",
                 "intent": "find", "category": "room", "role": "I am an individual"},
    "user": {"uid": "u2", "display_name": "A", "email": None, "phone": None, "is_verified": False, "role": "I am an individual", "business": None},
    "location": {"display": "Queens, NY", "city": "Queens", "state": "New York", "state_code": "NY", "country": "United States", "country_code": "US", "lat": None, "lng": None, "show_on_map": False},
    "details": {"title": "Looking for a room", "description": "Shared room.", "rent": {"amount": 0, "currency": "USD", "mode": "per_month", "is_negotiable": False, "deposit": 0},
                "amenities": [], "utilities": [], "furnishing": "unfurnished"},
    "privacy": {"show_address_on_map": False, "hide_phone_on_ad": True},
    "photos": [],
    "room_details": {"bath_type": "", "gender_preference": "any", "accommodates": ""},
    "seeker": {"age": 27, "gender": "male", "occupation": "professional", "languages": ["English", "Hindi"]},
    "search": {"status": "active", "intent": "find", "category": "room", "adexpirystatus": "active"},
}
OFFERED = {
    **{k: v for k, v in WANTED.items() if k not in ("room_details", "seeker")},
    "metadata": {**WANTED["metadata"], "intent": "list", "category": "property", "role": "I am the property owner"},
    "details": {**WANTED["details"], "amenities": ["car_park", "elevator"], "utilities": ["internet_wifi", "water", "electricity"]},
    "photos": ["https://cdn.example.com/1.jpg"],
    "property_details": {"property_type": "apartment", "accommodation_type": "", "square_feet": 950, "beds": 2, "baths": 1, "is_shared": False},
    "preferences": {"occupation": "professionals_only", "smoking": "no_smoking", "pets": "Any", "vegetarian": "Any", "age_range": "Any", "preferred_gender": "Any",
                    "couples_welcome": "Yes", "alcohol_allowed": "Yes", "languages": []},
}


@pytest.fixture(scope="module")
def doc_type(spark):
    return D.build_document(spark.range(1).withColumnRenamed("id", "ad_id")).schema["doc"].dataType


def wrong(spark, doc_type, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, j string").select("i", F.from_json("j", doc_type).alias("doc"))
    rows = df.select("i", Schema(document_schema()).violations(F.col("doc"), doc_type).alias("v")).orderBy("i").collect()
    return [[(x.path, x.rule) for x in r.v] for r in rows]


def changed(doc, path, value):
    head, _, rest = path.partition(".")
    return {**doc, head: changed(doc.get(head) or {}, rest, value) if rest else value}


def test_golden_documents_pass(spark, doc_type):
    assert wrong(spark, doc_type, [WANTED, OFFERED]) == [[], []]


ENUMS = [
    "metadata.status", "metadata.adexpirystatus", "metadata.intent", "metadata.category", "details.rent.mode", "details.amenities", "details.utilities", "details.furnishing", "property_details.property_type",
    "room_details.gender_preference", "preferences.occupation", "preferences.smoking", "preferences.pets", "preferences.vegetarian", "preferences.age_range", "preferences.preferred_gender",
    "preferences.couples_welcome", "preferences.alcohol_allowed", "preferences.languages", "seeker.gender", "seeker.occupation", "seeker.languages",
]


def test_every_enumeration_damaged_once(spark, doc_type):
    lists = ("details.amenities", "details.utilities", "preferences.languages", "seeker.languages")
    docs = []
    for path in ENUMS:
        base = WANTED if path.split(".")[0] in ("room_details", "seeker") else OFFERED
        docs.append(changed(base, path, ["English", "nonsense"] if path in lists else "nonsense"))
    got = wrong(spark, doc_type, docs)
    for path, found in zip(ENUMS, got):
        assert (path, "enum") in found and all(p == path for p, _ in found), (path, found)
    named = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, j string").select("i", F.from_json("j", doc_type).alias("doc"))
    assert [r.e for r in named.select("i", Q.validate_enums(F.col("doc")).alias("e")).orderBy("i").collect()] == [[p] for p in ENUMS]


def test_required_members_and_variants(spark, doc_type):
    docs = [
        changed(WANTED, "metadata.role", None), changed(WANTED, "metadata.admetroarea", None), {k: v for k, v in WANTED.items() if k != "privacy"},
        {k: v for k, v in WANTED.items() if k != "seeker"}, {**WANTED, "preferences": OFFERED["preferences"]}, {**OFFERED, "seeker": WANTED["seeker"]}, changed(WANTED, "user.uid", None), {},
    ]
    got = wrong(spark, doc_type, docs)
    assert got[0] == [("metadata.role", "required")] and got[1] == [] and got[2] == [("privacy", "required")]
    assert got[3] == [("seeker", "required")] and got[4] == [("", "not")] and got[5] == [("", "not")] and got[6] == []
    assert {p for p, r in got[7] if r == "required"} == {"ad_id", "metadata", "user", "location", "details", "privacy", "photos", "search"}


def test_keywords_of_the_compiler(spark):
    schema = {
        "type": "object", "required": ["a", "gone"],
        "properties": {"a": {"type": "integer"}, "s": {"type": "number"}, "n": {"type": "array", "items": {"type": "object", "required": ["k"], "properties": {"k": {"enum": ["x"]}}}}},
        "oneOf": [{"properties": {"a": {"const": 1}}}, {"properties": {"t": {"const": "one"}}}], "anyOf": [{"required": ["a"]}, {"required": ["t"]}],
        "if": {"properties": {"a": {"const": 2}}, "required": ["a"]}, "then": {"required": ["t"]}, "else": {"required": ["n"]},
    }
    rows = [(1, "no number", "two", [("x",), (None,)]), (1, None, "one", [("y",)]), (2, None, None, None), (None, None, None, [])]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, d struct<a int, s string, t string, n array<struct<k string>>>")
    got = [[(x.path, x.rule) for x in r.v] for r in df.select("i", Schema(schema).violations(F.col("d"), df.schema["d"].dataType).alias("v")).orderBy("i").collect()]
    assert got[0] == [("gone", "required"), ("s", "type"), ("n", "required")]
    assert got[1] == [("gone", "required"), ("n", "enum"), ("", "oneOf")]
    assert got[2] == [("gone", "required"), ("t", "required")]  # a left-out t keeps its const, so exactly one holds
    assert ("a", "required") in got[3] and ("", "anyOf") in got[3] and ("", "oneOf") in got[3]
    with pytest.raises(ValueError):
        Schema({"minimum": 3}).violations(F.col("d"), df.schema["d"].dataType)


def test_enumerations_are_those_of_the_vocabulary():
    assert set(document_schema()["$defs"]) == set(vocab.ENUMS)
