"""Whole jobs on small fixtures, against plain Python where SQL does not reach."""

import gzip
import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from citeloom.operators import affiliations as A, dedupe as D, harvest as H, lookups as L, registry as G, signals as S
from citeloom.plans.jobs import (
    catalogue_from_dump,
    save_affiliation_tables,
    save_catalogue,
    split_by_institution,
    with_batches,
)
from citeloom.session import cut_lineage, shared_folder, spread, temporary_cuts
from citeloom.sources.sinks import append_state
from citeloom.sources import readers
from citeloom.sources.readers import split_csv
from citeloom.streaming import streams
from suite.all_queries import QUERIES
from tests.conftest import plan_of


def person(name, affiliation=None, **more):
    listed = [] if affiliation is None else [{"name": affiliation}]
    return {"name": name, "affiliation": listed, "nameIdentifiers": [], **more}


def doi(number, title, publisher="Dryad", year=2020, creators=None, client="cern.zenodo", kind="Dataset", **attributes):
    return {
        "id": number,
        "attributes": {
            "titles": [{"title": title}],
            "publisher": {"name": publisher},
            "publicationYear": year,
            "creators": creators if creators is not None else [person("Doe, J", "CNRS, Lyon")],
            "contributors": [],
            "types": {"resourceTypeGeneral": kind},
            **attributes,
        },
        "relationships": {"client": {"data": {"id": client}}},
    }


def write_dump(root, files):
    for name, records in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "wt") as out:
            for r in records:
                out.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


@pytest.fixture()
def sides(spark):
    pubs = spark.createDataFrame(
        [("10.7/a", "fr", "https://ror.org/01|https://ror.org/02", "lyon", 1), ("10.7/b", "de", None, None, 2)],
        "doi string, country string, rors string, local_affiliations string, row_order int",
    )
    authors = spark.createDataFrame(
        [
            ("A1", "https://orcid.org/0000-1x", "Zoë Garçon", 9, [("FR",)], [(("https://ror.org/03",), [2012, 2020])]),
            ("A2", None, "Jean Wang", 9, [("FR",)], [(("https://ror.org/04",), [2020])]),
            ("A3", None, "Twin Name", 9, [("FR",)], [(("https://ror.org/05",), [2020])]),
            ("A4", None, "twin  name", 9, [("FR",)], [(("https://ror.org/06",), [2020])]),
            ("A5", None, "Far Away", 9, [("DE",)], [(("https://ror.org/07",), [2020])]),
        ],
        readers.AUTHOR_SCHEMA,
    )
    orgs = spark.createDataFrame([("https://ror.org/0AB", ((("2.1",),)), [((("FR"),),)])], readers.ORG_SCHEMA)
    return L.publication_lookup(pubs), L.author_lookup(readers.national_authors(authors)), L.national_orgs(orgs)


DUMP = {
    "updated_2024-01/part_0001.jsonl.gz": [
        doi("10.1/first", "Same"),
        doi("10.6084/m9.figshare.5.v1", "Copy"),
        doi("10.1/abroad", "Abroad", creators=[person("Doe, J", "Uni Wien")]),
        "{broken",
    ],
    "updated_2024-01/part_0000.jsonl.gz": [
        doi("10.1/second", "Same"),
        doi("10.1/part", "Part", relatedIdentifiers=[{"relationType": "IsPartOf", "relatedIdentifier": "10.1/x", "relatedIdentifierType": "DOI"}]),
        doi("10.1/shadowed", "Part"),
    ],
    "updated_2023-12/part_0000.jsonl.gz": [
        doi("10.1/older", "Same"),
        doi("10.1/image", "I", publisher="NAKALA", client="inist.huma", kind="Image", creators=[person("X")]),
        doi("10.1/image2", "I2", publisher="NAKALA", client="inist.huma", kind="Image"),
        doi(
            "10.1/linked", "L", creators=[person("X")],
            relatedIdentifiers=[{"relationType": "IsSupplementTo", "relatedIdentifier": "10.7/A", "relatedIdentifierType": "URL"}],
        ),
        doi("10.1/author", "N", creators=[person("Garçon, Zoë", givenName="Zoë", familyName="Garçon"), person("Jean Wang"), person("Twin Name"), person("Far Away")]),
        doi("10.1/orcid", "O", creators=[person("Q", nameIdentifiers={"nameIdentifierScheme": " Orcid", "nameIdentifier": "u/0000-1X"})]),
        doi("10.1/textyear", "Y", year="2020", creators=[person("Zoë Garçon")]),
        doi("10.1/ror", "R", creators=[person("Q", "Elsewhere", affiliationIdentifier="https://ror.org/0ab")]),
        doi("10.1/notitle", "", creators=[person("Q", "Ocean")]),
        doi("10.1/notitle2", "", creators=[person("Q", "Ocean")]),
    ],
}


def test_catalogue_from_dump(spark, tmp_path, sides):
    write_dump(tmp_path / "dump", DUMP)
    lists = spark.createDataFrame([("doi10.1/linked", ["lyon", "brest"]), ("doi10.1/ror", ["brest"])], "id string, local_affiliations array<string>")
    catalogue = catalogue_from_dump(spark, str(tmp_path / "dump"), S.lookup_table(*sides), lists=lists)
    rows = {r.doi: r for r in catalogue.collect()}
    assert set(rows) == {
        # the file of the highest name comes first, and the keys are forgotten after a 0000 file
        "10.1/first", "10.1/older", "10.1/image2", "10.1/linked", "10.1/author", "10.1/orcid", "10.1/ror", "10.1/notitle", "10.1/notitle2",
    }
    assert rows["10.1/linked"].fr_reasons == ["linked_article"] and rows["10.1/linked"].rors == ["01", "02"]
    assert rows["10.1/linked"].local_affiliations == ["lyon", "brest"]
    assert rows["10.1/author"].fr_reasons == ["french_author"] and rows["10.1/author"].rors == ["03"]
    assert [a.author.name for a in rows["10.1/author"].fr_authors_name] == ["zoe garcon"]
    assert rows["10.1/orcid"].fr_reasons == ["french_orcid"] and rows["10.1/orcid"].fr_authors_orcid[0].author.name == "Q"
    assert rows["10.1/ror"].fr_reasons == ["french_ror"] and rows["10.1/ror"].rors == ["0ab"]
    assert rows["10.1/notitle"].fr_reasons == ["affiliation_cea"] and rows["10.1/notitle"].natural_key is None

    save_catalogue(catalogue, str(tmp_path / "out"), names={"local_affiliations": "labels", "doi": "number"})
    written = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    linked = next(w for w in written if w["number"] == "10.1/linked")
    assert linked["fr_publications_linked"][0]["number"] == "10.7/a"
    assert linked["labels"] == ["lyon", "brest"] and "licenses" not in linked and linked["format_raw"] == [""]

    ids = spark.createDataFrame([("lyon",), ("brest",), ("caen",)], "institution string")
    split_by_institution(catalogue, ids, str(tmp_path / "split"))
    per = spark.read.json(str(tmp_path / "split/jsonl")).groupBy("institution").count().collect()
    assert {r.institution: r["count"] for r in per} == {"lyon": 1, "brest": 2}
    assert "methods" not in spark.read.csv(str(tmp_path / "split/csv"), header=True).columns


def test_author_name_forms(spark, sides):
    rows = spark.createDataFrame(
        [(1, "Garçon Zoë", None, None), (2, None, "Zoë", "Garçon"), (3, "Zoë Garçon", "Zoë", "Garçon"), (4, "Wang Jean", "Jean", "Wang")],
        "rec_id int, name string, givenName string, familyName string",
    )
    records = rows.select(
        "rec_id",
        F.array(F.struct(F.lit("creator").alias("role"), F.struct("name", "givenName", "familyName").alias("person"))).alias("people"),
        F.lit(2020).alias("lookup_year"),
        F.lit(None).cast("string").alias("publisher_text"),
    )
    found = S.author_name_signal(records, sides[1]).collect()
    assert sorted((r.rec_id, r.key) for r in found) == [(2, "zoe garcon"), (3, "zoe garcon")]


def test_keep_first_of_a_hot_key(spark):
    """A third of the rows share a key, a third have none."""
    rows = spark.range(0, 90_000, numPartitions=8).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE 'k' || id % 3000 END AS key", "id % 2 AS batch", "-id AS place"
    )
    kept = D.keep_first(rows, "key", ["batch"], ["place"], "id")
    assert plan_of(kept).count("WindowGroupLimit") == 2
    expected = {}
    for i in range(90_000):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 3000}"
        expected[(i % 2, key if key else i)] = i  # the highest id comes first
    assert {r.id for r in kept.collect()} == set(expected.values())


def test_group_limit_sends_one_row_per_task(spark):
    rows = spark.range(0, 80_000, numPartitions=8).selectExpr("id", "'hot' AS key")
    kept = D.keep_first(rows, "key", [], ["id"], "id")
    assert [r.id for r in kept.collect()] == [0]


def test_join_of_a_hot_probe_key(spark):
    """Probes of one much cited publication are never grouped by publication."""
    related = F.array(
        F.struct(
            F.lit("IsSupplementTo").alias("relationType"),
            F.expr("CASE WHEN id % 3 = 0 THEN '10.7/HOT' ELSE '10.7/' || id END").alias("relatedIdentifier"),
            F.lit("DOI").alias("relatedIdentifierType"),
        )
    )
    records = spark.range(30_000).select(F.col("id").alias("rec_id"), related.alias("related"))
    pubs = spark.sql("SELECT '10.7/hot' AS doi, array('1') AS rors, array('x') AS local_affiliations UNION ALL SELECT '10.7/1', array(), array()")
    for threshold in ("64MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            found = S.linked_publications(records, pubs)
            assert found.count() == 10_001
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def small_limits(spark):
    """Settings under which small data looks skewed."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, x in SKEW.items():
        spark.conf.set(k, x)
    yield
    for k, x in before.items():
        spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_hot_lookup_key_is_split(spark, small_limits):
    relation = F.array(
        F.struct(
            F.lit("IsSupplementTo").alias("relationType"),
            F.expr("CASE WHEN id % 3 = 0 THEN '10.7/HOT' ELSE '10.7/' || id END").alias("relatedIdentifier"),
            F.lit("DOI").alias("relatedIdentifierType"),
        )
    )
    records = spark.range(0, 150_000, numPartitions=8).select(F.col("id").alias("rec_id"), relation.alias("related"))
    pubs = spark.range(1000).selectExpr(
        "CASE id WHEN 0 THEN '10.7/hot' ELSE '10.7/' || id END AS doi", "array('1') AS rors", "array('x') AS local_affiliations"
    )
    found = S.linked_publications(records, pubs)
    assert len(found.collect()) == 50_000 + 999 - 333
    assert "SortMergeJoin(skew=true)" in plan_of(found)


def test_hot_missing_affiliation_is_split(spark, small_limits):
    detailed = spark.range(0, 150_000, numPartitions=8).selectExpr(
        "'10.1/' || id AS doi_id", "'f' || id AS doi_file_name", "'creators' AS type", "'n' AS name",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE 'p' || (id % 1000) END AS doi_publisher", "CAST(NULL AS STRING) AS doi_client_id",
        "CASE WHEN id % 3 = 0 THEN '' ELSE 'lab ' || (id % 1000) END AS affiliation", "'o' AS origin_file",
    )
    results = spark.createDataFrame([("ror", "lab 1", ["1"])], "match_type string, query string, results array<string>")
    merged = A.merge_affiliations(A.match_affiliations(A.consolidate(detailed), results), detailed).select("doi")
    assert len(merged.collect()) == 150_000
    assert "SortMergeJoin(skew=true)" in plan_of(merged)


def test_no_nested_loop_joins(spark, sf_dir):
    from suite.all_queries import QUERIES

    for name in ("catalogue", "merge_affiliations", "match_registry", "affiliation_detail", "register_jobs"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_scans_read_only_their_columns(spark, sf_dir):
    from suite.all_queries import QUERIES

    plan = QUERIES["most_frequent"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in plan


def test_file_batches(spark):
    names = [f"u{m}/p_{i}.jsonl.gz" for m in "ab" for i in ("0000", "0001", "10000")]
    files = spark.createDataFrame([(n,) for n in names], "file_path string")
    got = {r.file_path: r.batch for r in D.file_batches(files).collect()}
    batch, expected = 0, {}
    for n in sorted(names, reverse=True):
        expected[n] = batch
        batch += "0000.jsonl.gz" in n
    assert got == expected


def test_one_large_dump_file_is_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "BLOCK_LINES", 50)
    write_dump(tmp_path, {"dump/updated_1/all.jsonl.gz": [doi(f"10.1/{i}", "T") for i in range(1000)]})
    before = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    rows = readers.read_dump(spark, str(tmp_path / "dump"))
    assert rows.rdd.getNumPartitions() >= 8
    got = rows.select("id", "rec_id", "line_no").orderBy("line_no").collect()
    assert [r.id for r in got] == [f"10.1/{i}" for i in range(1000)] and len({r.rec_id for r in got}) == 1000
    assert got == rows.select("id", "rec_id", "line_no").orderBy("line_no").collect()
    for name, value in zip(("openCostInBytes", "maxPartitionBytes"), before):
        spark.conf.set(f"spark.sql.files.{name}", value)


def test_cut_lineage_and_spread(spark):
    df = spark.range(10, numPartitions=2).withColumn("v", F.parse_json(F.lit('{"a":1}')))
    cut = cut_lineage(df)
    assert cut.count() == 10 and "FileScan" in plan_of(cut)
    assert spread(df).rdd.getNumPartitions() == 2 and spread(df, 5).rdd.getNumPartitions() == 5
    assert shared_folder(spark) != shared_folder(spark)


def test_temporary_cuts_are_removed(spark):
    with temporary_cuts(spark):
        cut = cut_lineage(spark.range(3))
        folder = cut.inputFiles()[0].removeprefix("file:").replace("///", "/").rsplit("/", 1)[0]
        assert cut.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)


@pytest.mark.parametrize("root,folder", [("a dump", "updated 1"), ("50% of", "updated_é"), ("plain", "updated_ü %20")])
def test_dump_under_any_folder_name(spark, tmp_path, sides, root, folder):
    rows = [doi(f"10.1/{i}", f"T{i}", creators=[person("Q", "Ocean")]) for i in range(5)]
    write_dump(tmp_path / root, {f"{folder}/a.jsonl.gz": rows})
    catalogue = catalogue_from_dump(spark, str(tmp_path / root), S.lookup_table(*sides))
    assert {r.doi for r in catalogue.collect()} == {f"10.1/{i}" for i in range(5)}


def test_record_of_an_unlisted_file_stops_the_job(spark):
    batches = spark.createDataFrame([("a", 1, 0)], "file_path string, file_rank int, batch long")
    records = spark.createDataFrame([("a", 1), ("b", 2)], "file_path string, rec_id int")
    assert with_batches(records.where("rec_id = 1"), batches).count() == 1
    with pytest.raises(Exception, match="no batch for the file b"):
        with_batches(records, batches).collect()


def test_equal_list_names_in_two_folders(spark, tmp_path):
    for folder, text in (("a", "DOI;b\n10.1/a;1\n"), ("b", "x,doi\n1,10.1/b\n2,10.1/c\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "lyon.csv").write_text(text)
    found = readers.read_doi_lists(spark, str(tmp_path / "*"))
    assert sorted(r.doi for r in found.collect()) == ["10.1/a", "10.1/b", "10.1/c"]


def test_no_side_table_is_an_empty_lookup(spark):
    assert S.lookup_table().count() == 0


def test_state_rows_are_added_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id int, name string")
    for _ in range(2):
        append_state(rows, str(tmp_path / "state"), ["id"])
    held = spark.read.parquet(str(tmp_path / "state"))
    assert sorted((r.id or 0, r.name) for r in held.collect()) == [(0, "c"), (1, "a")]


def test_split_runs_the_job_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([("a", ["x"]), ("b", ["x", "y"])], "id string, local_affiliations array<string>")

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ids = spark.createDataFrame([("x",), ("y",)], "institution string")
    split_by_institution(rows.mapInArrow(counted, rows.schema), ids, str(tmp_path / "split"))
    assert seen.value == 2


def test_institution_lists(spark, tmp_path):
    (tmp_path / "lyon_caen.csv").write_text('a,My DOI\n1,https://doi.org/10.1/A\n"x,y","10.1%2Fb"\n3,\n4,10.\n')
    (tmp_path / "paris.csv").write_text("DOI;b\n10.1/a;1\n10.1/c;2,3\n")
    (tmp_path / "none.csv").write_text("a,b\n10.1/a,1\n")
    found = L.institution_lookup(readers.read_doi_lists(spark, str(tmp_path)))
    assert {r.id: r.local_affiliations for r in found.collect()} == {
        "doi10.1/a": ["caen", "lyon", "paris"], "doi10.1/b": ["caen", "lyon"], "doi10.1/c": ["paris"],
    }


def test_save_affiliation_tables(spark, tmp_path):
    page = {"data": [doi("10.1/A", "t", creators=[person("P", "Lab"), person("Q")]), doi("10.1/b", "t", creators=[])]}
    (tmp_path / "p.ndjson").write_text(json.dumps(page) + "\n" + json.dumps(page) + "\n")
    raw = readers.read_envelope(spark, str(tmp_path / "p.ndjson"))
    counts = save_affiliation_tables(raw, str(tmp_path / "out")).first()
    assert (counts.number_of_dois, counts.number_of_dois_with_null_attributes, counts.number_of_non_null_dois) == (4, 2, 2)
    assert spark.read.parquet(str(tmp_path / "out/detailed")).count() == 4
    consolidated = spark.read.parquet(str(tmp_path / "out/consolidated")).collect()
    assert sorted((r.doi_publisher, r.doi_client_id, r.affiliation) for r in consolidated) == [
        ("dryad", "cern.zenodo", ""), ("dryad", "cern.zenodo", "lab"),
    ]


def test_registry_files(spark, tmp_path):
    orgs = [
        {"id": "https://ror.org/0X", "admin": {"last_modified": {"schema_version": "2.1"}}, "locations": [{"geonames_details": {"country_code": c}}]}
        for c in ("FR", "DE", "gp")
    ]
    (tmp_path / "v2.json").write_text(json.dumps(orgs))
    (tmp_path / "v1.json").write_text(json.dumps([{"id": "x/old", "admin": {"last_modified": {"schema_version": "1"}}, "locations": orgs[0]["locations"]}]))
    assert [r.ror for r in L.national_orgs(readers.read_orgs(spark, str(tmp_path))).collect()] == ["0x"]

    repos = [{"id": f"r{i}", "name": "n", "url": u} for i, u in enumerate(["http://a.org/en", "https://www.a.org", None, "http://data.ifremer.fr"])]
    (tmp_path / "re").mkdir()
    (tmp_path / "re/r.json").write_text(json.dumps(repos))
    index = G.registry_index(readers.read_repositories(spark, str(tmp_path / "re")))
    assert {r.signature: r.entry.id for r in index.collect()} == {
        "a.org": "r1", "data.ifremer.fr": "r3", "campagnes.flotteoceanographique.fr": "r3",
    }


def test_excluded_names_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("key\nWang\nLi\n")
    assert readers.excluded_last_names(spark, str(tmp_path / "x.csv")) == ["Wang", "Li"]
    assert len(readers.excluded_last_names(spark)) == 189


def test_merge_matches_missing_keys(spark):
    schema = "doi_publisher string, doi_client_id string, affiliation string"
    matched = A.match_affiliations(
        spark.createDataFrame([(None, "inist.a", ""), ("p", None, "lab")], schema),
        spark.createDataFrame([("ror", "lab", ["1"]), ("country", "lab", ["fr"])], "match_type string, query string, results array<string>"),
    )
    detailed = spark.createDataFrame(
        [("10.1/a", "f", "creators", "n", "", "inist.a", None, "o"), ("10.1/b", "f", "creators", "n", "p", "", "lab", "o")],
        ", ".join(f"{c} string" for c in readers.AFFILIATION_COLUMNS),
    )
    rows = {r.doi: r for r in A.merge_affiliations(matched, detailed).collect()}
    assert set(rows) == {"10.1/a", "10.1/b"}
    assert rows["10.1/b"].ror == ["1"] and rows["10.1/b"].is_countries_fr and rows["10.1/a"].ror == []


def bucket_fixture(spark, n=3000):
    detailed = spark.range(0, n, numPartitions=8).selectExpr(
        "CASE WHEN id % 50 <> 7 THEN '10.1/' || id END AS doi_id", "CASE WHEN id % 50 <> 7 THEN 'f' || id END AS doi_file_name",
        "CASE WHEN id % 2 = 0 THEN 'creators' ELSE 'contributors' END AS type", "'n' AS name",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE 'p' || (id % 10) END AS doi_publisher", "CASE WHEN id % 4 = 0 THEN '' END AS doi_client_id",
        "CASE WHEN id % 3 = 0 THEN '' ELSE 'lab ' || (id % 100) END AS affiliation", "'o' AS origin_file",
    )
    results = spark.createDataFrame([("ror", "lab 1", ["1"]), ("country", "lab 1", ["fr"])], "match_type string, query string, results array<string>")
    matched = A.match_affiliations(A.consolidate(detailed), results)
    # keys that no detailed row has
    other = matched.limit(20).withColumn("affiliation", F.concat(F.coalesce("affiliation", F.lit("")), F.lit(" else")))
    return matched.union(other), detailed


def test_bucketed_merge_is_the_same(spark, tmp_path):
    matched, detailed = bucket_fixture(spark)
    matched, detailed = cut_lineage(matched), cut_lineage(detailed)
    A.bucket_detailed(detailed, "merge_same", str(tmp_path), 8)
    assert spark.table("merge_same_hot").count() >= 1
    got, want = A.merge_bucketed(matched, "merge_same"), A.merge_affiliations(matched, detailed)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 2900
    A.bucket_detailed(detailed.limit(0), "merge_none", str(tmp_path / "none"), 8)
    alone = A.merge_bucketed(matched, "merge_none")
    assert sorted(map(str, alone.collect())) == sorted(map(str, A.merge_affiliations(matched, detailed.limit(0)).collect()))


def test_bucketed_merge_reads_the_table_once_without_a_shuffle(spark, tmp_path, small_limits):
    matched, detailed = bucket_fixture(spark, 60_000)
    A.bucket_detailed(detailed, "merge_plan", str(tmp_path), 8)
    merged = A.merge_bucketed(cut_lineage(matched), "merge_plan")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("merge_plan[") == 1 and "SelectedBucketsCount: 8 out of 8" in plan
    side = plan[plan.index("SortMergeJoin") :].split("\n")
    at = next(i for i, line in enumerate(side) if "merge_plan[" in line)
    # between the join and the scan of its right side there is no exchange
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    above, level = [], depth(side[at])
    for line in reversed(side[:at]):
        if depth(line) < level:
            above, level = [*above, line], depth(line)
    assert "SortMergeJoin" in above[-1] and not [line for line in above if "Exchange" in line]
    # a third of the rows has one key, and no bucket has more than twice its share
    sizes = spark.table("merge_plan").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 7 and max(r["count"] for r in sizes) < 2.5 * 60_000 / 8


# ---------------------------------------------------------------- harvest


def test_file_batches_in_two_passes(spark):
    draw = random.Random(1)
    names = {f"u{draw.randrange(9)}/p_{draw.randrange(90)}{draw.randrange(9):04}.jsonl.gz" for _ in range(900)}
    files = spark.createDataFrame([(n,) for n in names] * 2, "file_path string")
    batch, expected = 0, {}
    for rank, n in enumerate(sorted(names, reverse=True), 1):
        expected[n] = (rank, batch)
        batch += "0000.jsonl.gz" in n
    assert batch > 0
    for partitions in (None, 1, 7, 40):
        rows = D.file_batches(files, partitions)
        assert {r.file_path: (r.file_rank, r.batch) for r in rows.collect()} == expected
        assert "SinglePartition" not in rows._jdf.queryExecution().executedPlan().toString()
    assert D.file_batches(files.limit(0)).count() == 0


@pytest.mark.parametrize("interval", ["minute", "bogus", "hour", "day", "week", "month"])
@pytest.mark.parametrize(
    "start,end",
    [
        (datetime(2024, 1, 31, 23, 0), datetime(2024, 2, 1, 0, 30)), (datetime(2024, 1, 15), datetime(2024, 3, 20)), (datetime(2024, 1, 1), datetime(2024, 1, 29)),
        (datetime(2024, 1, 31), datetime(2024, 3, 1)), (datetime(2024, 1, 1), datetime(2024, 1, 1)), (datetime(2024, 1, 2), datetime(2024, 1, 1)),
    ],
)
def test_calendar_is_the_same_as_slices(spark, interval, start, end):
    bounds = spark.createDataFrame([(start, end)], "start timestamp, end timestamp")
    got = H.calendar(bounds, interval).orderBy("slice_start").collect()
    assert got == H.time_slices(spark, start, end, interval).orderBy("slice_start").collect()
    assert H.calendar(bounds.selectExpr("null::timestamp AS start", "end"), interval).count() == 0


def test_spans_need_no_job(spark):
    times = [datetime(2024, 1, 1, h) for h in (1, 5, 9)]
    rows = spark.createDataFrame([(t, H.SLICE_PREFIX + "20240101050000") for t in times], "ts timestamp, name string")
    spark.sparkContext.setJobGroup("spans", "")
    span = rows.agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    limits = [span.select(name).scalar() for name in ("start", "end")]
    covered = H.slice_coverage(H.calendar(span, "hour"), rows.select("name").distinct(), *limits)
    inside = H.in_window(rows, "ts", F.timestamp_add("HOUR", F.lit(2), limits[0]), limits[1])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("spans")
    assert tuple(covered.first()) == (8, 1, 7, "error") and inside.count() == 2
    spark.sparkContext.setJobGroup("", "")


def test_csv_cells(spark):
    long = ";".join(f'"a;{i}";b' for i in range(100_000))
    lines = ['a,"b,c",d', '"x";"y;z" ; "",w', "", ",", '"10.1/a","',  'q""r,"s"",t"', "a\"b,c\"d,e", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*lines, long])], "i int, t string")
    got = {r.i: (r.c, r.s) for r in rows.select("i", split_csv(F.col("t"), ",").alias("c"), split_csv(F.col("t"), ";").alias("s")).collect()}
    assert got[0][0] == ["a", "b,c", "d"] and got[1][1] == ["x", "y;z", '",w']
    assert got[2][0] == [""] and got[3][0] == ["", ""] and got[5][0] == ['q""r', 's"",t'] and got[6][0] == ["a\"b,c\"d", "e"]
    assert got[7] == (None, None) and len(long) > 1_000_000
    assert got[8][1] == [x for i in range(100_000) for x in (f"a;{i}", "b")]


@pytest.mark.parametrize(
    "interval,count", [("minute", 90), ("bogus", 90), ("hour", 2), ("day", 1), ("week", 1), ("month", 1)]
)
def test_time_slices(spark, interval, count):
    start, end = datetime(2024, 1, 31, 23, 0), datetime(2024, 2, 1, 0, 30)
    rows = H.time_slices(spark, start, end, interval).orderBy("slice_start").collect()
    assert len(rows) == count and rows[0].slice_start == start and rows[-1].slice_end == end
    assert all(a.slice_end == b.slice_start for a, b in zip(rows, rows[1:]))


def test_month_slices(spark):
    rows = H.time_slices(spark, datetime(2024, 1, 15), datetime(2024, 3, 20), "month").orderBy("slice_start").collect()
    assert [r.slice_start for r in rows] == [datetime(2024, 1, 15), datetime(2024, 2, 15), datetime(2024, 3, 15)]


@pytest.mark.parametrize("found,missed,status", [(60, 0, "done"), (59, 1, "error"), (0, 60, "error")])
def test_coverage(spark, found, missed, status):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 1, 1)
    slices = H.time_slices(spark, start, end)
    names = slices.orderBy("slice_start").limit(found).select(H.slice_name("slice_start", "slice_end").alias("name"))
    other = spark.createDataFrame([("dcdump-20230101000000-x",), ("other-20240101000000",)], "name string")
    row = H.slice_coverage(slices, names.unionByName(other), start, end).first()
    assert (row.number_slices, row.number_missed, row.status) == (60, missed, status)


def test_state_tables(spark):
    day = datetime(2024, 1, 1)
    state = spark.createDataFrame(
        [(1, 0, 1, day, day, "done", "d", False, "hour"), (2, 0, 1, day, day, "error", "e", False, "day")], H.HARVEST_STATE
    )
    new = spark.createDataFrame(
        [(None, None, None, day, day, "in progress", d, False, "minute") for d in ("d", "e", "f")], H.HARVEST_STATE
    )
    accepted = {r.current_directory: r.slice_type for r in H.register_job(state, new).collect()}
    assert accepted == {"e": "day", "f": "minute"}
    assert H.register_job(state, new, force=True).count() == 3
    assert [r.id for r in H.query_state(state).collect()] == [1, 2]
    assert [r.id for r in H.query_state(state, {"status": "error", "start_date": day}).collect()] == [2]
    changed = H.update_state(state, {"status": "done", "number_missed": 4}, {"id": 2}).orderBy("id").collect()
    assert [(r.status, r.number_missed) for r in changed] == [("done", 0), ("done", 4)]
    for bad in ({"nope": 1}, {"status": 1}, {"id": "1"}, {"processed": 1}):
        with pytest.raises((ValueError, TypeError)):
            H.query_state(state, bad)
        with pytest.raises((ValueError, TypeError)):
            H.update_state(state, bad)


# ---------------------------------------------------------------- streams


def test_stream_reads_only_new_files(spark, tmp_path):
    write_dump(tmp_path, {"in/updated_1/a.jsonl.gz": [doi("10.1/a", "A")]})

    def run():
        raw = streams.stream_dump(spark, str(tmp_path / "in")).select("id")
        streams.run_available(raw, str(tmp_path / "cp"), format="parquet", path=str(tmp_path / "out"))
        return sorted(r.id for r in spark.read.schema("id string").parquet(str(tmp_path / "out")).collect())

    assert run() == ["10.1/a"]
    write_dump(tmp_path, {"in/updated_2/b.jsonl.gz": [doi("10.1/b", "B")]})
    assert run() == ["10.1/a", "10.1/b"] == run()


def test_stream_keep_first_across_batches(spark, tmp_path):
    source = tmp_path / "in"
    schema = "key string, place int, id int"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        first = streams.stream_keep_first_in_order(stream, "key", ["place"])
        streams.run_available(first, str(tmp_path / "cp"), foreach_batch=streams.batch_sink(str(tmp_path / "out")), mode="update")
        return sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run([("a", 2, 1), ("a", 1, 2), (None, 1, 3), (None, 1, 4)]) == [2, 3, 4]
    assert run([("a", 0, 5), ("b", 1, 6), ("b", 0, 7), (None, 0, 8)]) == [2, 3, 4, 7, 8]
    assert run([("b", 0, 9), ("a", 0, 10)]) == [2, 3, 4, 7, 8]
    assert run([("c", 5, 11)] + [("c", 5 + i, 20 + i) for i in range(1, 300)] + [("a", 0, 12)]) == [2, 3, 4, 7, 8, 11]


def test_retried_batch_writes_once(spark, tmp_path):
    sink = streams.batch_sink(str(tmp_path / "out"))
    first = spark.createDataFrame([("a", 1)], "key string, id int")
    second = spark.createDataFrame([("b", 3)], "key string, id int")
    sink(first, 0)
    sink(second, 1)
    sink(second, 1)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3]


def test_stream_counts_late_rows_and_open_slices(spark, tmp_path):
    source, schema = tmp_path / "in", "ts timestamp, id int"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        sink = streams.slice_count_sink(str(tmp_path / "out"), "ts", "1 hour")
        streams.run_available(stream, str(tmp_path / "cp"), foreach_batch=sink)
        rows = streams.read_slice_counts(spark, str(tmp_path / "out")).orderBy("slice_start").collect()
        return [(r.slice_start, r.n_rows) for r in rows]

    early, late = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 1)
    assert run([(early, 1), (late, 2)]) == [(early, 1), (late, 1)]
    assert run([(early, 3), (early, 4)]) == [(early, 3), (late, 1)]


def test_stream_closed_slices_leave_the_state(spark, tmp_path):
    source, out, schema = tmp_path / "in", str(tmp_path / "out"), "ts timestamp, id int"

    def run(*times):
        rows = [(t, 0) for t in times]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        counted = streams.stream_slice_counts(stream, "ts", "1 hour", "1 hour")
        streams.run_available(counted, str(tmp_path / "cp"), format="parquet", path=out)
        return sorted((r.slice_start.hour, r.n_rows) for r in spark.read.parquet(out).collect())

    at = lambda hour, minute=0: datetime(2024, 1, 1, hour, minute)
    assert run(at(1), at(1, 30), at(2)) == []
    assert run(at(2, 30), at(4)) == [(1, 2), (2, 2)]
    assert run(at(1), at(9)) == [(1, 2), (2, 2), (4, 1)]  # the late row is not counted here


def test_stream_keeps_rows_without_a_key(spark, tmp_path):
    source, schema = tmp_path / "in", "key string, ts timestamp"
    day = datetime(2024, 1, 1)

    def run(keys):
        spark.createDataFrame([(k, day) for k in keys], schema).write.mode("append").parquet(str(source))
        first = streams.stream_keep_first(spark.readStream.schema(schema).parquet(str(source)), "key", "ts", "30 days")
        streams.run_available(first, str(tmp_path / "cp"), format="parquet", path=str(tmp_path / "out"))
        return sorted(str(r.key) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())

    assert run(["a", "b", "a", None, None]) == ["None", "None", "a", "b"]
    assert run(["a", "c", None]) == ["None", "None", "None", "a", "b", "c"]


def test_probe_lookups_are_not_broadcast(spark):
    """A lookup is larger than the columns it is made from, by which Spark would judge its size."""
    records = spark.createDataFrame([(1, "A", 2015), (2, "B", 2015)], "rec_id long, orcid string, lookup_year int")
    person = F.struct(F.array(F.struct(F.lit("ORCID").alias("scheme"), F.col("orcid").alias("identifier"))).alias("ids"))
    probes = F.transform(
        F.array(person), lambda p, i: S._probe(S.ORCID, "author", p["ids"][0]["identifier"], F.col("lookup_year"), i, F.lit(0))
    )
    years = F.explode(F.sequence(F.lit(2013), F.lit(2020))).alias("year")
    authors = spark.createDataFrame([("A", ["r"])], "author_key string, rors array<string>").select("author_key", years, "rors")
    hits = S.probe_hits(records, probes, S.lookup_table(authors=authors))
    assert [(r.rec_id, r.key, r.year, r.rors) for r in hits.collect()] == [(1, "A", 2015, ["r"])]
    assert "BroadcastHashJoin" not in plan_of(hits) and "SortMergeJoin" in plan_of(hits)


@pytest.mark.parametrize("name", ["catalogue", "catalogue_details", "national_signals", "run_counters"])
def test_records_are_parsed_once(spark, sf_dir, name):
    assert "from_json" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
