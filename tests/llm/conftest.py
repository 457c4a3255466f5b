import pytest

# columns that the operators use inside, as extra columns of an input
CLASHES = (
    "id long, key string, hash string, bytes string, keep_id long, group_size long, kept boolean, row string, block int, comp long, "
    "tokens long, copies long, domain string, score double, label int, labelled long, start int, seed long, words string, u long, v long, "
    "prefix long, first long, class_id long, gone_id long, template int, w string, sha string, keep string"
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text, clashing columns."""
    long_text = " ".join(f"word{i % 977} the of" for i in range(40_000))
    prose = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [
        (1, prose, "en", "src1"),
        (2, prose, "en", "src1"),
        (2, prose, "en", "src1"),
        (3, prose.replace(" ", "\n "), None, None),
        (4, prose.replace("sixteen", "seventeen"), "en", "src2"),
        (5, None, "en", "src1"),
        (6, "", None, "src9"),
        (7, " \t\n", "de", "src2"),
        (8, "!!! ???", "de", "src3"),
        (9, long_text, "en", "src1"),
        (10, "short", "en", "src1"),
        (11, "日本語 のテキスト \U0001f600 ẞtraße", "ja", "src4"),
        (None, prose, None, "src1"),
        (None, None, None, None),
        (12, "a\x00b\x01 nul", "en", "src5"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for column in CLASHES.split(", "):
        name, kind = column.split()
        docs = docs.selectExpr("*", f"cast(null as {kind}) as {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]
