"""Periodic runs against a plain search of all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from citeloom.llm import periodic_runs as pr
from citeloom.llm.queries import QUERIES


def plain_runs(words, least=24, times=3):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, times * q) and j > i:
                part = words[i : i + length]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if plant and h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return (
        doc_id, len(runs), *(best or (None, None, None)), None if best is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def random_words(draw):
    letters = "ab" if draw.random() < 0.5 else "abcdefgh"
    out = []
    while len(out) < draw.randrange(1, 400):
        block = [draw.choice(letters) for _ in range(draw.choice([1, 2, 3, 5, 8, 9, 17, 33, 40, 70]))]
        out += block * draw.choice([1, 1, 2, 3, 4, 9, 30])
        if draw.random() < 0.3:
            out += out[-draw.randrange(1, len(out) + 1) :][:60] * draw.choice([1, 3, 4])
    return out


@pytest.mark.parametrize("seed", range(60))
def test_runs_against_plain(seed):
    draw = random.Random(seed)
    texts = [random_words(draw) for _ in range(4)] + [[]]
    numbers = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t], dtype=np.int64)
    found = pr.find_runs(words, np.array([len(t) for t in texts]))
    assert found == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("least,times", [(1, 3), (6, 3), (10, 4), (40, 5)])
def test_other_lengths(least, times):
    draw = random.Random(least)
    texts = [random_words(draw) for _ in range(12)]
    numbers = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t], dtype=np.int64)
    found = pr.find_runs(words, np.array([len(t) for t in texts]), least, times)
    assert found == [plain_runs(t, least, times) for t in texts]


def test_fibonacci_words_and_one_word_texts():
    a, b = "a", "ab"
    while len(b) < 2000:
        a, b = b, b + a
    texts = [list(b), ["x"] * 3000, ["x", "y"] * 700 + ["x"]]
    numbers = {"a": 0, "b": 1, "x": 2, "y": 3}
    words = np.array([numbers[w] for t in texts for w in t])
    found = pr.find_runs(words, np.array([len(t) for t in texts]))
    assert found == [plain_runs(t) for t in texts]
    assert found[1] == [(0, 3000, 1)] and found[2] == [(0, 1401, 2)]


def test_long_texts_take_no_pairs():
    # every gram of one million equal words occurs everywhere; 300 copies of a text of 3,000 words
    million = np.zeros(1_000_000, dtype=np.int64)
    block = np.random.default_rng(1).integers(0, 500, 3000)
    found = pr.find_runs(np.concatenate([million, np.tile(block, 300)]), np.array([1_000_000, 900_000]))
    assert found[0] == [(0, 1_000_000, 1)] and (0, 900_000, 3000) in found[1]


def test_query_against_plain(spark, tmp_path):
    draw = random.Random(5)
    rows = [(i, " ".join(random_words(draw)) if i % 3 else "\n\t a  b " * draw.randrange(20)) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, " x " * 40), (504, "é\x1cé " * 30), (None, "q " * 30), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(*r) for r in rows), key=str)


def test_whole_table_against_plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 6000")
    got = pr.run_digests(pr.periodic_runs(pr.with_repeats(docs))).collect()
    assert sorted(map(tuple, got)) == sorted(plain_row(r.doc_id, r.text) for r in docs.collect())


def test_odd_input(odd_docs, no_docs):
    assert pr.periodic_runs(odd_docs).count() == odd_docs.count()
    assert pr.periodic_runs(no_docs).count() == 0 and pr.with_repeats(no_docs).count() == 0
    assert pr.with_repeats(odd_docs).count() == odd_docs.count()
    empty = {r.collapsed for r in pr.periodic_runs(odd_docs).where("doc_id in (5, 6, 7)").collect()}
    assert empty == {""}
    with pytest.raises(ValueError):
        pr.periodic_runs(odd_docs, times=2)
