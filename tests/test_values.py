"""Canonical values by hand-computed rows."""

import pytest
from pyspark.sql import functions as F

from citeloom.functions import values as V
from tests.conftest import value


@pytest.mark.parametrize(
    "text,mb,unit",
    [
        ("10 MB", 10.0, "mb"),
        ("1,024 bytes", 0.001024, "bytes"),
        ("1 byte", 1e-6, "byte"),
        ("2 Ko", 0.002, "ko"),
        ("3 GB", 3000.0, "gb"),
        ("1.5e3 mo", 1500.0, "mo"),
        (".5 kb", 0.0005, "kb"),
        ("7 pages", None, "page"),
        ("0 kb", 0.0, "kb"),
    ],
)
def test_parse_size(spark, text, mb, unit):
    found = value(spark, V.parse_size(F.lit(text)))
    assert found.mb == (mb if mb is None else pytest.approx(mb)) and found.unit == unit


@pytest.mark.parametrize("text", ["12d mb", "3 kbytes", "1 TB", "x", "", "nan mb", "1_000 kb", None])
def test_no_size(spark, text):
    assert value(spark, V.parse_size(F.lit(text).cast("string"))) is None


@pytest.mark.parametrize("text,mb", [("3 kbytes", 0.003), ("1 TB", 1e6), ("2 megabytes", 2.0), ("8 bytes", 8e-6)])
def test_fixed_units(spark, text, mb):
    assert value(spark, V.parse_size(F.lit(text), fix_units=True)).mb == pytest.approx(mb)


@pytest.mark.parametrize(
    "sizes,total,category",
    [
        (["0.5 mb"], 0.5, "< 1 Mo"),
        (["1 mb"], 1.0, "1 - 10 Mo"),
        (["10 mb"], 10.0, "1 - 10 Mo"),
        (["10 mb", "1 mb"], 11.0, "10 - 100 Mo"),
        (["1 gb"], 1000.0, "100Mo - 1 Go"),
        (["2 gb"], 2000.0, ">= 1 Go"),
        (["0 kb", "3 pages"], None, "N/A"),
        ([], None, "N/A"),
        (None, None, "N/A"),
    ],
)
def test_size_features(spark, sizes, total, category):
    column = F.lit(None).cast("array<string>") if sizes is None else F.array(*map(F.lit, sizes)).cast("array<string>")
    found = value(spark, V.size_features(column))
    assert (found.size_total_mb, found.size_cat, found.has_size) == (total, category, total is not None)


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "xml"),
        ("TIFF", "image"),
        ("x.tar.gz", "zip"),
        ("R code", "sas / stata / spss / R"),
        ("Foo", "foo"),
        ("", ""),
        (None, None),
    ],
)
def test_format(spark, raw, expected):
    assert value(spark, V.normalize_format(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "name,national",
    [
        ("INRA", True), ("INRAP", False), ("Université de lorraine", True), ("data-InDoRES", True), ("éfrance", False),
        ("L'ÉCOLE DES HAUTES ÉTUDES EN SCIENCES SOCIALES", True), (None, False), ("SUPAÉRO", True), ("Parisian", False),
    ],
)
def test_national_publisher(spark, name, national):
    assert value(spark, V.is_national_publisher(F.lit(name).cast("string"))) is national


@pytest.mark.parametrize(
    "doi,plain,dropped",
    [
        ("10.6084/m9.figshare.12.v1", None, True),
        ("10.1/abc.v2", "FigShare", True),
        ("10.1/abc.v2", None, False),
        ("10.1/abc.v", "figshare", False),
        ("10.1/abcv2", "figshare", False),
        ("V3", "4TU.ResearchData", True),
    ],
)
def test_version_copies(spark, doi, plain, dropped):
    assert value(spark, V.is_version_copy(F.lit(doi), F.lit(plain).cast("string"))) is dropped


@pytest.mark.parametrize("countries,national", [(["fr"], True), (["de", "gp"], True), (["FR"], False), ([], False)])
def test_national_country(spark, countries, national):
    column = F.array(*map(F.lit, countries)).cast("array<string>")
    assert value(spark, V.has_national_country(column)) is national
