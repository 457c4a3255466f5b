"""Text rules on hand-made and hard strings."""

import re
import string
import time
import unicodedata
from functools import lru_cache

import pytest
from pyspark.sql import functions as F, types as T

from citeloom.functions import text as X
from citeloom.functions.urls import url_signature
from tests.conftest import value

BLANKED = str.maketrans(string.punctuation, " " * 32)
HARD = [
    "École  Normale\tSupérieure\n", "CNRS—UMR 5558 (Lyon)", "a<b>$c", "ﬁn Œuvre ß ŁÓDŹ", "naïve café", "İstanbul Ⅷ ½",
    "中文字 mixed", "x​y z�", "éà", "O'Neil & l’été", "...", "", "_under score_", "Ω ω Ἀθῆναι", "привет МИР", "١٢٣ abc",
    "tab\there", "emoji 😀 ok", "C++ / C#", "ñandú--x",
]


@lru_cache(maxsize=1)
def wordpiece():
    """An independent tokenizer library's cleaning and splitting of texts."""
    tokenizers = pytest.importorskip("tokenizers")
    clean = tokenizers.normalizers.BertNormalizer(clean_text=True, handle_chinese_chars=True, strip_accents=True, lowercase=True)
    stripped = tokenizers.normalizers.Sequence([clean, tokenizers.normalizers.Strip()])
    return stripped, tokenizers.pre_tokenizers.Whitespace()


def wordpiece_normalize(text: str) -> str:
    """The same rule by that library."""
    normalizer, splitter = wordpiece()
    plain = re.sub(r"[\n<>$]", " ", normalizer.normalize_str(text))
    return " ".join(t for t, _ in splitter.pre_tokenize_str(plain))


def test_normalize_against_tokenizer(spark):
    rows = spark.createDataFrame([(t,) for t in HARD], "t string").select("t", X.normalize("t").alias("n")).collect()
    assert {r.t: r.n for r in rows} == {t: wordpiece_normalize(t) for t in HARD}


def test_normalize_whole_documents_against_tokenizer(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", X.normalize("text").alias("n")).collect()
    assert all(r.n == wordpiece_normalize(r.text) for r in rows)


def test_signs_above_the_first_plane_against_tokenizer(spark):
    signs = [0x1D402, 0x1D4DD, 0x1D7CE, 0x1F130, 0x1F1E6, 0x10400, 0x1109A, 0x1E921, 0x2F800, 0x2F9F4, *range(0x20000, 0x2CEB0, 997)]
    texts = [f"a{chr(point)}b" for point in signs]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.normalize("t").alias("n")).collect()
    assert {r.t: r.n for r in rows} == {t: wordpiece_normalize(t) for t in texts}


@pytest.fixture(scope="module")
def every_sign(spark):
    """``a{sign}b`` for every code point but the syllables that stay composed on purpose."""
    points = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343 AND id NOT BETWEEN 44032 AND 55203")
    sign = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    return points.select("id", F.concat(F.lit("a"), sign, F.lit("b")).alias("t"))


def test_every_sign_against_tokenizer(every_sign):
    rows = every_sign.select("id", X.normalize("t").alias("n")).toPandas()
    assert len(rows) == 0x110000 - 2048 - 11172
    different = [(hex(i), n) for i, n in zip(rows.id, rows.n) if n != wordpiece_normalize(f"a{chr(i)}b")]
    assert different == []


def wordpiece_key(text: str, joint: str) -> str:
    """The rule for keys by the tokenizer library: punctuation to blanks, then words."""
    normalizer, splitter = wordpiece()
    plain = normalizer.normalize_str(text).replace("\n", " ").translate(BLANKED)
    return joint.join(t for t, _ in splitter.pre_tokenize_str(plain))


def test_every_assigned_sign_in_keys(every_sign):
    rows = every_sign.select("id", X.normalize_key("t").alias("k"), X.normalize_key("t", remove_space=False).alias("s")).toPandas()
    rows = rows[[unicodedata.category(chr(i)) not in ("Cn", "Co") for i in rows.id]]
    want = [wordpiece_key(f"a{chr(i)}b", " ") for i in rows.id]
    assert [(w, s) for w, s in zip(want, rows.s) if w != s] == []
    assert [(w, k) for w, k in zip(want, rows.k) if w.replace(" ", "") != k] == []


@pytest.mark.parametrize("text", [
    "plain text_1 (a) <b>$", "É 😀 été—x \U00011100 ok", "ΟΔΟΣ ΣΑΣ", "e\u0301\u0301 \u08a0\u0898 x", "\ue000a\U000f0000b", "中é文\uf900x", "a\x00b\x85c\u2028d", "ொx கொ", "x" * 5000 + "é",
])
def test_mixed_texts_against_tokenizer(spark, text):
    assert value(spark, X.normalize(F.lit(text))) == wordpiece_normalize(text)
    assert value(spark, X.normalize_key(F.lit(text))) == wordpiece_key(text, "")


def test_every_sign_folds_to_ascii(spark):
    points = [p for p in range(0x80, 0x110000) if not 0xD800 <= p <= 0xDFFF and unicodedata.category(chr(p)) not in ("Cn", "Co")]
    points = [p for p in points if unicodedata.normalize("NFKD", chr(p)) != chr(p)]
    rows = spark.createDataFrame([(f"x{chr(p)}y",) for p in points], "t string").select("t", X.ascii_fold("t").alias("n"))
    expected = lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
    assert [(r.t, r.n) for r in rows.collect() if r.n != expected(r.t)] == []


def test_normalize_min_length(spark):
    assert value(spark, X.normalize(F.lit("ab abc 1 12 x345"), 2)) == "abc 1 12 x345"


@pytest.mark.parametrize(
    "text,expected", [("Jean-Luc  O'Neil 3", "jeanluconeil3"), (None, ""), ("a.b", "ab"), ("É.", "e")]
)
def test_normalize_key(spark, text, expected):
    assert value(spark, X.normalize_key(F.lit(text).cast("string"))) == expected


def test_fold_and_punctuation(spark):
    assert value(spark, X.ascii_fold(F.lit("Étude ﬁne № ½ Ω"))) == "etude fine no 12 "
    assert value(spark, X.delete_punctuation(F.lit("A" + string.punctuation + "b"))) == "a" + " " * 32 + "b"
    assert value(spark, X.strip_accents(F.lit("Ça où"))) == "Ca ou"
    assert value(spark, X.search_text(F.lit("L'étude qu’il d'abord"))) == "etude il abord"


def test_words(spark):
    kind = T._parse_datatype_string("struct<a:string,b:array<string>,c:map<string,string>,d:int,e:struct<f:string>>")
    row = spark.createDataFrame([(("x", ["y", None], {"k": "z"}, 5, None),)], T.StructType([T.StructField("v", kind)]))
    assert row.select(X.words("v", kind).alias("w")).first().w == "x y  z  "


@pytest.mark.parametrize(
    "text,expected",
    [
        ("https://doi.org/10.1234/AbC ", "10.1234/abc"),
        ("10.5%2Fx y", "10.5/x"),
        ("doi: none", None),
        ("see 10.1/a and 10.2/b", "10.1/a"),
        ("10.1\nx 10.2/b", "10.2/b"),
        (None, None),
    ],
)
def test_clean_doi(spark, text, expected):
    assert value(spark, X.clean_doi(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "uri,expected",
    [
        ("https://orcid.org/0000-0002-7285-027X", "0000-0002-7285-027X"),
        ("0000-0002-7285-027X", "0000-0002-7285-027X"),
        ("", ""),
        (None, ""),
    ],
)
def test_uri_tail(spark, uri, expected):
    assert value(spark, X.uri_tail(F.lit(uri).cast("string"))) == expected


def test_id_if_scheme(spark):
    assert value(spark, X.id_if_scheme(F.lit("a/b"), F.lit("ROR"), "ROR")) == "b"
    assert value(spark, X.id_if_scheme(F.lit("a/b"), F.lit("GRID"), "ROR")) is None
    assert value(spark, X.id_if_scheme(F.lit(None).cast("string"), F.lit("ROR"), "ROR")) == ""


@pytest.mark.parametrize(
    "text,expected", [("['a', 'b']", ["a", "b"]), ("[]", []), ("not a list", []), (None, []), ("[broken", [])]
)
def test_listify(spark, text, expected):
    assert value(spark, X.listify(F.lit(text).cast("string"))) == expected


def test_dedup_sort_and_keys(spark):
    assert value(spark, X.dedup_sort(F.array(F.lit("b"), F.lit(""), F.lit("a"), F.lit("b"), F.lit(None)))) == ["a", "b"]
    assert value(spark, X.file_key(F.lit("10.1/a:b*c"))) == "10.1_a-bc"
    assert value(spark, X.clean_id(F.lit(" 12.0 , B"))) == "12"


@pytest.mark.parametrize(
    "url,normalized,signatures",
    [
        (
            "https://www.Data.Example.fr/en/foo/index.html?x=1",
            "data.example.fr/foo",
            ["example.fr", "data.example.fr", "data.example.fr/foo"],
        ),
        ("ab//c", "ab/c", ["ab", "ab/c"]),
        ("http://a.b/enough/home/x", "a.b/enough/x", ["a.b", "a.b/enough", "a.b/enough/x"]),
        ("x", None, None),
        ("///", None, None),
        (None, None, None),
    ],
)
def test_url_signature(spark, url, normalized, signatures):
    found = value(spark, url_signature(F.lit(url).cast("string")))
    assert (found and found.normalized) == normalized
    assert (found and found.signatures) == signatures


def test_strip_is_linear_in_the_text(spark):
    blanks = " " * 200_000
    texts = ["a", "", " ", "\u00a0 a b\u2003\n", "\u1680", "a\n", "\n\na\nb", "\U0001f600 \t", f"a{blanks}b", f" a{blanks}b\t"]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "id int, t string")
    began = time.monotonic()
    got = [r.s for r in rows.select("id", X.strip("t").alias("s")).orderBy("id").collect()]
    assert got == [t.strip() for t in texts] + [None]
    assert time.monotonic() - began < 20  # every blank tried as the beginning of an end takes minutes
