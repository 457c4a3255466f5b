"""The pipeline: stage by stage against plain Python, and on odd input."""

import hashlib
import re

import pytest

import corpus_pipeline
from citeloom.llm import quality
from citeloom.llm.hashing import words_of
from tests.llm.test_pairs import plain_near_copies

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input and output of every stage, written and read back as the contract has it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", [r.asDict() for r in docs.collect()])]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, [r.asDict() for r in docs.collect()]))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in stages[1:]] == ["quality", "exact_dedup", "ngram_join", "decontaminate", "mixing"]
    for (_, before), (_, after) in zip(stages, stages[1:]):
        assert list(after[0])[:5] == COLUMNS and {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
        texts = {r["doc_id"]: r["text"] for r in before}
        assert all(texts[r["doc_id"]] == r["text"] for r in after)


def test_each_stage_against_plain_python(spark, sf_dir, stages):
    rows = {name: listed for name, listed in stages}
    ids = lambda name: {r["doc_id"] for r in rows[name]}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, model).collect()}
    assert ids("quality") == {i for i, s in scores.items() if s >= quality.LEAST_SCORE}

    first = {}
    for r in rows["quality"]:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")
        first[text] = min(r["doc_id"], first.get(text, r["doc_id"]))
    assert ids("exact_dedup") == set(first.values())

    classes = plain_near_copies([(r["doc_id"], r["text"]) for r in rows["exact_dedup"]])
    assert ids("ngram_join") == {i for i, c, _, _ in classes if i == c}

    items = [words_of(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    runs = {tuple(w[i : i + 10]) for w in items for i in range(len(w) - 9)}
    holds = lambda w: any(tuple(w[i : i + 10]) in runs for i in range(len(w) - 9))
    assert ids("decontaminate") == {r["doc_id"] for r in rows["ngram_join"] if not holds(words_of(r["text"]))}

    total = sum(len(r["text"].split()) for r in rows["decontaminate"])
    taken = sum(r["mix_tokens"] * r["copies"] for r in rows["mixing"])
    longest = max(len(r["text"].split()) for r in rows["decontaminate"])
    assert all(r["copies"] in (1, 2) for r in rows["mixing"]) and taken >= total // 2 - 80
    assert taken <= total // 2 + 80 * longest


def test_run_gives_the_rows_of_the_last_stage(spark, sf_dir, stages):
    digest = lambda listed: sorted(hashlib.md5(repr(sorted(r.items())).encode()).hexdigest() for r in listed)
    assert digest([r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]) == digest(stages[-1][1])


def test_odd_input_through_all_stages(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, sf_dir)
            assert after.schema.names == docs.schema.names
            docs = after.checkpoint()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() <= odd_docs.count()
