"""N-gram Jaccard join: prefixes and parity bits, components against brute force, frequent passages, odd inputs."""

import os
import random

import duckdb
import numpy as np
import pytest

from panelloom.llm import jaccard
from panelloom.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shingles(text, k=3):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {b" ".join(words)} if words else set()


def brute(docs, k=3, percent=90):
    """Every pair is compared."""
    sets = [(doc_id, shingles(t, k)) for doc_id, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(sets):
        groups.setdefault(find(i), []).append(doc_id)
    return sorted(((doc_id, len(s), min((x for x in groups[find(i)] if x is not None), default=None)) for i, (doc_id, s) in enumerate(sets)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, words, many):
    words = list(words)
    for _ in range(many):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = [f"e{rng.randrange(10**6)}"] * rng.randint(0, 2)
    return words


def test_parts():
    rng = np.random.default_rng(2)
    for _ in range(200):
        universe = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        a = np.unique(rng.choice(universe, rng.integers(1, 120)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.06], rng.choice(universe, rng.integers(0, 4))]))
        common = len(np.intersect1d(a, b))
        late = np.unique(rng.choice(universe, 40))
        counts = rng.integers(64, 99, len(late))
        if 100 * common >= 90 * (len(a) + len(b) - common) > 0:
            assert len(np.intersect1d(jaccard.prefix(a, 90, late, counts), jaccard.prefix(b, 90, late, counts)))
        assert np.bitwise_count(jaccard.parity(a) ^ jaccard.parity(b)).sum() <= len(a) + len(b) - 2 * common


def test_hashes_of_words(monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 50)
    rng = random.Random(6)
    words = ["a", "b", "ab", "ba", "É", "é", "\x1c", "x" * 63, "x" * 64, "x" * 65, "x" * 300, "x" * 299 + "y"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n ", "\t", "\x0b\x0c\r"]) for _ in range(rng.randint(0, 9))).strip(rng.choice([" ", "\x00"])).encode() for _ in range(300)]
    hashes, at = jaccard.hashed_words([*texts, b"", b"A  B"])
    lists = [t.split() for t in texts] + [[], [b"a", b"b"]]
    assert at.tolist() == np.cumsum([0, *map(len, lists)]).tolist()
    known = {}
    for word, h in zip([w for words in lists for w in words], hashes.tolist()):
        assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("frequent,block", [(64, 2048), (3, 2048), (3, 4), (10**6, 4)])
def test_components(spark, monkeypatch, frequent, block):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(frequent + block)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for base in range(25):
        words = [f"b{rng.randrange(4000)}" for _ in range(rng.randint(1, 120))] + passage * rng.randint(0, 1)
        for _ in range(rng.randint(1, 9)):
            docs.append((len(docs), " ".join(edited(rng, words, rng.choice([0, 0, 1, 2, 3])))))
    docs += [(1000 + i, " ".join(edited(rng, passage, 1))) for i in range(30)]  # a star of edits of one passage
    docs += [(2000 + i, "same text again and again") for i in range(5)]
    rng.shuffle(docs)
    assert found(jaccard.similar_documents(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_thresholds(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(edited(rng, words, rng.randint(0, 6)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for shingle, percent in ((1, 100), (5, 80), (2, 35)):
        assert found(jaccard.similar_documents(df, shingle=shingle, percent=percent)) == brute(docs, shingle, percent)


def test_odd_rows(spark):
    docs = [(5, "One two"), (4, "ONE  two"), (3, None), (2, ""), (1, " \n\t"), (6, "a b c " * 100_000), (7, "b c a " * 90_000), (8, "x" * 300_000), (9, "x" * 300_000),
            (10, "one two three"), (10, "one two three"), (None, "one two three"), (None, "alone in here"), (11, "É b c d"), (12, "é b c d"), (13, "one\x1ctwo")]
    more = ", n int, key string, prefix string, bits int, place int, node int, token int, component_id int"
    clash = spark.createDataFrame([(a, b, 1, "k", "p", 2, 3, 4, 5, 6) for a, b in docs], "doc_id long, text string" + more)
    assert found(jaccard.similar_documents(clash)) == brute(docs)
    assert jaccard.similar_documents(clash.limit(0)).collect() == []
    assert found(jaccard.similar_documents(clash.where("doc_id in (2, 3)"))) == [(2, 0, 2), (3, 0, 3)]
    with pytest.raises(ValueError):
        jaccard.similar_documents(clash, percent=0)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = found(QUERIES["op12_ngram_jaccard_join"](spark, SF))
    assert got == brute(docs)
    assert any(c != d for d, _, c in got)
