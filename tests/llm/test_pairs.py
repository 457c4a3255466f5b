"""N-gram join, its components, and decontamination against brute force."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import decontaminate, ngram_join
from citeloom.llm.components import components
from citeloom.llm.hashing import words_of
from citeloom.llm.queries import QUERIES


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def shingles(text, size=5):
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_near_copies(rows, threshold=0.8):
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[shingles(text)].append(doc_id)
    sets = [s for s in ids if s]
    held = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            held[x].append(n)
    common = defaultdict(int)
    for listed in held.values():
        for i, a in enumerate(listed):
            for b in listed[:i]:
                common[a, b] += 1
    groups, links = Sets(), defaultdict(int)
    for (a, b), n in common.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            groups.join(a, b)
    first = {}
    for n, s in enumerate(sets):
        root = groups.find(n)
        first[root] = min([first.get(root, 1 << 60), *(i for i in ids[s] if i is not None)])
    out = [(i, i, 0, 1) for i in ids.get(frozenset(), [])]
    for n, s in enumerate(sets):
        out += [(i, first[groups.find(n)], links[n], len(ids[s])) for i in ids[s]]
    return sorted(out, key=str)


def cloud(seed, n, words=120, edits=8):
    """Texts around one, each with some words replaced: similarities from low to 1."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for _ in range(draw.randrange(edits)):
            text[draw.randrange(words)] = f"x{draw.randrange(10_000)}"
        yield " ".join(text)


@pytest.mark.parametrize("block", [512, 16])
def test_near_copies_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = [t for seed in range(4) for t in cloud(seed, 45)] + ["a b c", "a b c", "A, b. C!", "d", "", None, "!!"]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.near_copies(docs).collect()), key=str)
    want = plain_near_copies(rows)
    assert len({g[1] for g in got}) < len(got) - 40
    assert got == want


@pytest.mark.parametrize("block,shingles_a_block", [(512, 1_000_000), (16, 1_000_000), (512, 900)])
def test_repeated_rows_are_one_document_for_links(spark, monkeypatch, block, shingles_a_block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles_a_block)
    near, other, far = list(cloud(1, 20)), list(cloud(2, 20)), list(cloud(3, 3, edits=1))
    rows = list(enumerate(near + other))
    rows += [rows[0]] * 400 + [rows[1]] * 300 + [rows[25]] * 3  # repeated rows
    rows += [(2, other[4]), (2, other[5]), (30, near[7]), (30, far[0]), (3, None), (3, "")]  # ids of several texts
    rows += [(None, near[3]), (None, far[0]), (900, far[0] + " more"), (None, "nobody has this text at all here")]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.near_copies(docs).collect()), key=str)
    want = [(i, None if c == 1 << 60 else c, n, m) for i, c, n, m in plain_near_copies(rows)]
    assert got == sorted(want, key=str) and max(g[2] for g in got) < 40


def test_near_copies_on_the_test_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op1_ngram_join"](spark, sf_dir).collect()), key=str)
    assert got == plain_near_copies(rows)


def test_matched_depth_reaches_the_target():
    for trees, target in ((64, 0.999), (16, 0.9), (8, 0.999)):
        depth = ngram_join.matched_depth(0.8, trees, 16, target)
        assert depth == 1 or ngram_join.expected_recall(0.8, depth, trees) >= target
        assert depth == 16 or ngram_join.expected_recall(0.8, depth + 1, trees) < target


def test_labels_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(0)
    agree = []
    for _ in range(60):
        shared = draw.integers(0, 2**63, 80, dtype=np.uint64)
        sets = [np.unique(np.concatenate([shared, draw.integers(0, 2**63, 10, dtype=np.uint64)])) for _ in range(2)]
        a, b = ngram_join.label_prefixes(sets, 64, 1)
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02


def test_near_copies_odd_input(odd_docs, no_docs):
    got = {(r.doc_id, r.class_id) for r in ngram_join.near_copies(odd_docs).collect()}
    assert got >= {(1, 1), (2, 1), (3, 1), (4, 1), (None, 1), (5, 5), (6, 6), (8, 8), (9, 9), (None, None)}
    assert ngram_join.near_copies(odd_docs).count() == odd_docs.count()
    kept = ngram_join.drop_near_copies(odd_docs)
    assert kept.schema.names == odd_docs.schema.names
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 10, 11, 12, 5, 6, 7, 8, 9, None, None]
    assert ngram_join.near_copies(no_docs).count() == 0 and ngram_join.drop_near_copies(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(1000, 1200)]
    edges += [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(260)] + [(7, 7)]
    draw.shuffle(edges)
    groups = Sets()
    for a, b in edges:
        if a != b:
            groups.join(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    least = {}
    for x in list(groups.up):
        least[groups.find(x)] = min(x, least.get(groups.find(x), x))
    assert got == {x: least[groups.find(x)] for x in groups.up}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("path", [(2, 3, 4, 5, 1), (3, 5, 2, 6, 4, 1), (4, 6, 2, 8, 5, 7, 3, 1)])
def test_components_of_one_path(spark, path):
    edges = spark.createDataFrame(list(zip(path, path[1:])), "u long, v long")
    assert sorted(tuple(r) for r in components(edges).collect()) == [(n, 1) for n in sorted(path)]


def test_only_texts_to_verify_pass_the_filter(spark):
    digest = F.unhex(F.md5(F.col("id").cast("string"))).alias("digest")
    rows = spark.range(20_000).select("id", digest)
    stands = rows.where("id % 10 = 0").select(F.col("digest").alias("of_digest"))
    passed = {r.id for r in ngram_join.maybe_among(rows, ngram_join.stand_filter(stands)).collect()}
    assert passed >= set(range(0, 20_000, 10)) and len(passed) < 2_200
    none = ngram_join.stand_filter(stands.limit(0))
    assert not ngram_join.maybe_among(rows, none).collect()


# ---------------------------------------------------------------- decontamination


def plain_overlaps(docs, items):
    """Documents and items with a stretch whose words agree, tried at every alignment."""
    out = set()
    for item, text in items:
        theirs = words_of(text)
        if len(theirs) < decontaminate.SHORTEST:
            continue
        stretch = min(decontaminate.STRETCH, len(theirs))
        for doc_id, doc in docs:
            ours = words_of(doc)
            for shift in range(-len(theirs), len(ours)):
                same = [0 <= shift + j < len(ours) and ours[shift + j] == w for j, w in enumerate(theirs)]
                if max(sum(same[j : j + stretch]) for j in range(len(same) - stretch + 1)) >= decontaminate.EQUAL * stretch:
                    out.add((doc_id, item))
    return out


def test_overlaps_against_brute_force(spark):
    draw = random.Random(2)
    prose = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    items = [(i, prose(n)) for i, n in enumerate([4, 5, 8, 12, 13, 20, 45, 60])]
    docs = []
    for i, words in items:
        for edits in (0, 1):
            hidden = list(words)
            for at in draw.sample(range(len(hidden)), edits):
                hidden[at] = "changed"
            docs.append((10 * i + edits, " ".join(prose(30) + hidden + prose(17)).upper()))
        docs.append((10 * i + 2, " ".join(words)))
        docs.append((10 * i + 3, " ".join(prose(9) + words[: len(words) // 2])))
    docs += [(500, " ".join(prose(400))), (501, None), (502, "")]
    items = [(i, " ".join(w)) for i, w in items] + [(90, None), (91, "")]
    found = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    # an item shorter than a window is met whole, so an edited one may be missed
    short = {i for i, t in items if len(words_of(t)) < decontaminate.SPAN}
    want = plain_overlaps(docs, items)
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= want and {x for x in want - got if x[1] not in short} == set() and len(got) > 20
    assert {(r.doc_id, r.start) for r in found if r.doc_id % 10 == 0} == {(10 * i, 30) for i in range(1, 8)}


def test_overlaps_with_as_many_edits_as_count(spark, monkeypatch):
    draw = random.Random(3)
    prose = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    items = [(n, prose(n)) for n in [*range(1, 14), 16, 20, 60]]
    docs = [prose(20) + [w if j % 5 else "changed" for j, w in enumerate(words)] + prose(20) for _, words in items]
    docs += [words[2:] for _, words in items] + [words[:-2] for _, words in items]
    for n, words in items:
        if n <= 13:
            for places in combinations(range(n), 2 if n > 9 else 1):
                docs.append(prose(5) + ["changed" if j in places else w for j, w in enumerate(words)] + prose(5))
        else:
            for _ in range(20):
                docs.append(prose(5) + ["changed" if draw.random() < 0.15 else w for w in words] + prose(5))
        docs.append(prose(5) + words + prose(5))
    docs = [(i, " ".join(words)) for i, words in enumerate(docs)]
    items = [(i, " ".join(words)) for i, words in items]
    monkeypatch.setattr(decontaminate, "SHORTEST", 1)
    found = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        shortest=1,
    )
    got, want = {(r.doc_id, r.item_id) for r in found.collect()}, plain_overlaps(docs, items)
    assert got == want and len(got) > 300


def test_masks_hit_a_stretch_with_any_two_words_changed():
    masks, n = decontaminate.masks_of(decontaminate.STRETCH), decontaminate.STRETCH
    places = [{at + i for i, c in enumerate(m) if c == "1"} for m in masks for at in range(n - len(m) + 1)]
    assert all(any(place.isdisjoint(pair) for place in places) for pair in combinations(range(n), 2))


def test_masks_ignore_any_one_word():
    assert {len(m) for m in decontaminate.MASKS} == {decontaminate.SPAN}
    assert all(any(m[i] == "0" for m in decontaminate.MASKS) for i in range(decontaminate.SPAN))


def test_items_alike_are_all_named(spark):
    draw = random.Random(4)
    prose = lambda n: [f"w{draw.randrange(3000)}" for _ in range(n)]
    prompt = prose(60)
    items = [(3, prose(9) + prompt), (5, prompt + prose(9)), (7, prompt), (9, prompt), (11, prose(40))]
    docs = [(1, prose(20) + prompt + prose(20)), (2, prose(50)), (4, prompt[20:40])]
    docs, items = ([(i, " ".join(words)) for i, words in rows] for rows in (docs, items))
    found = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == plain_overlaps(docs, items) == {(d, i) for d in (1, 4) for i in (3, 5, 7, 9)} and len(found) == len(got)
    # items of the same words are met alike
    assert len({(r.doc_id, r.start, r.equal, r.stretch, r.n_hits) for r in found if r.item_id in (7, 9)}) == 2


def test_decontamination_on_the_test_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    tens = lambda text: {tuple(w[j : j + 10]) for w in [words_of(text)] for j in range(len(w) - 9)}
    runs = {i: tens(text) for i, text in items}
    held = {(d, i) for d, own in ((d, tens(text)) for d, text in docs) for i, run in runs.items() if run & own}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontaminate"](spark, sf_dir).collect()}
    assert got == held and got


def test_decontamination_odd_input(spark, odd_docs, no_docs):
    prose = odd_docs.where("doc_id = 1").first().text
    tests = spark.createDataFrame([(1, prose), (None, None), (2, "too short"), (1, prose)], "item_id long, text string")
    clean = decontaminate.without_overlaps(odd_docs, tests)
    assert clean.schema.names == odd_docs.schema.names
    assert sorted((r.doc_id for r in clean.collect()), key=str) == [10, 11, 12, 5, 6, 7, 8, 9, None]
    assert decontaminate.without_overlaps(odd_docs, tests.limit(0)).count() == odd_docs.count()
    assert decontaminate.overlaps(no_docs, tests).count() == 0
