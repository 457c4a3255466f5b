"""Missing keys, empty lists, null elements and odd shapes of record fields."""

import json

import pytest
from pyspark.sql import functions as F

from citeloom.functions import records as R
from citeloom.operators.affiliations import explode_affiliations
from citeloom.sources.readers import read_envelope
from citeloom.sources.sinks import null_if_empty


def record(**attributes) -> str:
    return json.dumps({"id": "10.1/X", "attributes": attributes, "relationships": {"client": {"data": {"id": "a.b"}}}})


def typed(spark, *lines):
    rows = spark.createDataFrame([(t,) for t in lines], "value string")
    return R.record_columns(R.parse_records(rows))


def field(spark, name, **attributes):
    return typed(spark, record(**attributes)).first()[name]


@pytest.mark.parametrize(
    "titles,expected",
    [
        ([{"title": "a"}, {"title": "b "}], "a b"),
        ([{"title": "a"}, {"lang": "fr"}], ""),
        ([{"title": None}, {"title": "b"}], "b"),
        ([None, {}], ""),
        ([], ""),
        (None, ""),
    ],
)
def test_title(spark, titles, expected):
    assert field(spark, "title", titles=titles) == expected
    assert field(spark, "title") == ""


@pytest.mark.parametrize(
    "subjects,expected",
    [
        ([{"subject": "a"}, {"subject": "a"}, {"subject": "b", "subjectScheme": None}], [("a", "subject-datacite")]),
        ([{"subject": "FOS: Social", "subjectScheme": "Fields of Science and Technology (FOS)"}], [("ocial", "FOS-datacite")]),
        ([None, {"subject": None}], []),
        ([], []),
        (None, []),
    ],
)
def test_classifications(spark, subjects, expected):
    assert [tuple(c) for c in field(spark, "classifications", subjects=subjects)] == expected


def test_fos_option(spark):
    line = record(subjects=[{"subject": "FOS: Social", "subjectScheme": "Fields of Science and Technology (FOS)"}])
    rows = spark.createDataFrame([(line,)], "value string")
    assert R.record_columns(R.parse_records(rows), fix_fos=True).first().classifications[0].label == "Social"


@pytest.mark.parametrize(
    "descriptions,expected",
    [
        ([{"descriptionType": "Abstract", "description": "a"}, {"descriptionType": "Abstract", "description": " b "}], "a  b"),
        ([{"descriptionType": "Abstract", "description": 5}, {"descriptionType": "Abstract", "description": ""}], ""),
        ([{"description": "a"}, None], ""),
        (None, ""),
    ],
)
def test_abstract(spark, descriptions, expected):
    assert field(spark, "abstract_text", descriptions=descriptions) == expected


@pytest.mark.parametrize(
    "rights,expected",
    [
        ([{"rightsIdentifier": " CC "}, {"rightsIdentifier": "cc"}, {"rightsIdentifier": "a"}], ["a", "cc"]),
        ([{"rightsIdentifier": "cc"}, {"rights": "x"}], []),
        ([{"rightsIdentifier": None}], []),
        ([None], []),
    ],
)
def test_licenses(spark, rights, expected):
    assert field(spark, "licenses", rightsList=rights) == expected


def test_grants(spark):
    funding = [{"funderName": "NASA"}, {"awardNumber": "1", "funderName": ""}, {}, None]
    assert [tuple(g) for g in field(spark, "grants", fundingReferences=funding)] == [("NASA", None), (None, "1")]


@pytest.mark.parametrize(
    "year,expected,lookup",
    [(2020, 2020, 2020), ("2020", 2020, None), (" 2020 ", 2020, None), ("2020.0", None, None), ("x", None, None), (None, None, None), (0, None, None)],
)
def test_year(spark, year, expected, lookup):
    row = typed(spark, record(publicationYear=year)).first()
    assert (row.year, row.lookup_year) == (expected, lookup)


def test_publisher_shapes(spark):
    rows = typed(spark, record(publisher="figshare"), record(publisher={"name": "X"}), record(publisher=None), record())
    assert [(r.publisher_raw, r.publisher_text) for r in rows.collect()] == [("", "figshare"), ("X", None), ("", None), ("", None)]


@pytest.mark.parametrize(
    "formats,expected", [(["a", "b"], ["a", "b"]), ("a", ["a"]), ([], [""]), (None, [""])]
)
def test_formats(spark, formats, expected):
    assert field(spark, "format_raw", formats=formats) == expected


PERSON = {"name": "Name", "givenName": "Given", "familyName": "Family", "affiliation": [], "nameIdentifiers": []}


@pytest.mark.parametrize(
    "change,full,plain",
    [
        ({}, "Given Family", "Name"),
        ({"name": None}, "Given Family", "Given Family"),
        ({"name": "", "givenName": None}, "Family", "Family"),
        ({"name": "", "familyName": ""}, "Given", "Given"),
        ({"givenName": None, "familyName": None}, "Name", "Name"),
        ({"name": None, "givenName": None, "familyName": None}, None, ""),
    ],
)
def test_names(spark, change, full, plain):
    people = typed(spark, record(creators=[{**PERSON, **change}])).select(F.col("people")[0]["person"].alias("p"))
    row = people.select(R.full_name(F.col("p")).alias("full"), R.object_name(F.col("p")).alias("plain")).first()
    assert (row.full, row.plain) == (full, plain)


@pytest.mark.parametrize(
    "identifiers,expected",
    [
        ([{"nameIdentifierScheme": "ORCID", "nameIdentifier": "https://orcid.org/1"}, {"nameIdentifierScheme": "ORCID", "nameIdentifier": "2"}], "2"),
        ({"nameIdentifierScheme": "ORCID", "nameIdentifier": "x/3"}, "3"),
        ([{"nameIdentifierScheme": "orcid", "nameIdentifier": "4"}], None),
        ([{"nameIdentifierScheme": "ORCID", "nameIdentifier": 5}, None], None),
        (None, None),
    ],
)
def test_orcid(spark, identifiers, expected):
    rows = typed(spark, record(creators=[{**PERSON, "nameIdentifiers": identifiers}]))
    assert rows.select(R.authors(F.col("people"))[0]["orcid"].alias("o")).first().o == expected


@pytest.mark.parametrize(
    "affiliation,expected",
    [
        ({"name": "A B", "affiliationIdentifier": "https://ror.org/X", "affiliationIdentifierScheme": "ROR"}, "https://ror.org/x"),
        ({"name": "A B", "affiliationIdentifierScheme": "ROR"}, "a b"),
        ({"name": "A B", "affiliationIdentifier": None}, "a b"),
        ({"name": "A", "affiliationIdentifier": ""}, ""),
        ({}, ""),
        ("Plain Text", "plain text"),
    ],
)
def test_affiliation_string(spark, affiliation, expected):
    v = F.parse_json(F.lit(json.dumps(affiliation)))
    assert spark.range(1).select(R.affiliation_string(v).alias("x")).first().x == expected


def test_record_affiliations_keep_first_seen_order(spark):
    a, b = {"name": "A", "z": "1"}, {"name": "B"}
    people = [{**PERSON, "affiliation": [b, a]}, {**PERSON, "affiliation": [{"z": "1", "name": "A"}, "T", b]}]
    rows = typed(spark, record(creators=people)).select(F.to_json(R.record_affiliations(F.col("people"))).alias("x"))
    assert json.loads(rows.first().x) == [b, a, "T"]


def test_natural_key_needs_all_parts(spark):
    full = dict(titles=[{"title": "T"}], creators=[PERSON], publicationYear=2020, publisher={"name": "P"})
    assert field(spark, "natural_key", **full) == "T;Given Family;2020;P"
    for missing in full:
        assert field(spark, "natural_key", **{k: x for k, x in full.items() if k != missing}) is None


def test_broken_lines_and_records_without_id_go(spark):
    assert typed(spark, "{broken", "", '{"attributes":{}}', record()).count() == 1


def test_envelopes(spark, tmp_path):
    page = json.dumps({"data": [json.loads(record(creators=[PERSON])), json.loads(record(creators=[], contributors=None))]})
    (tmp_path / "a.ndjson").write_text(f"{page}\n   \n{{bad\n{page}\n")
    raw = read_envelope(spark, str(tmp_path / "a.ndjson"))
    assert raw.count() == 4
    rows = explode_affiliations(raw).collect()
    assert [(r.doi_id, r.name, r.affiliation, r.origin_file) for r in rows] == [("10.1/x", "Name", "", "a.ndjson")] * 2


def test_safe_get(spark):
    v = F.parse_json(F.lit('{"a":{"b":"x","n":0,"f":false,"e":"","l":[],"z":null}}'))
    paths = ["b", "n", "f", "e", "l", "z", "q"]
    row = spark.range(1).select(*[R.safe_get(v, f"$.a.{p}", "d").alias(p) for p in paths]).first()
    assert list(row) == ["x", "d", "d", "d", "d", "d", "d"]


def test_null_if_empty(spark):
    df = spark.sql(
        "SELECT named_struct('a', CAST(NULL AS STRING)) e, named_struct('a', 'a') f, 'g' g, '' b, array(CAST(NULL AS STRING)) h, "
        "array('i') i, CAST(array() AS array<string>) c, 0 z, false w, double('NaN') n"
    )
    row = null_if_empty(df).select(F.to_json(F.struct("*")).alias("x")).first().x
    assert json.loads(row) == {"f": {"a": "a"}, "g": "g", "h": [None], "i": ["i"], "z": 0, "w": False}
