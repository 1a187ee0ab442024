"""Ranked search: range maxima and searches against brute force, ties, odd inputs, sets of queries."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelloom.llm import ranked

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=10):
    """Every document is scored for every item."""
    bags = [(doc_id, Counter(TERM.findall((t or "").encode().lower()))) for doc_id, t in docs]
    bags = [(doc_id, bag, sum(bag.values())) for doc_id, bag in bags if bag]
    n, total = len(bags), sum(size for _, _, size in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item_id, text in items:
        asked = Counter(TERM.findall((text or "").encode().lower()))
        scored = []
        for doc_id, bag, size in bags:
            m = 25 + 75 * size * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t, r in asked.items() if t in bag)
            if s > 0:
                scored.append((-s, math.inf if doc_id is None else doc_id))
        out += [(item_id, rank + 1, None if d == math.inf else d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def test_terms():
    text = "Ab-c_d É1 \x00ñÑ日本 `x`{y}\x7fz [Q]^"
    assert ranked.terms(text.encode()) == [t.lower() for t in TERM.findall(text.encode())]


def test_range_maxima():
    rng = np.random.default_rng(3)
    n = 300
    rows = [np.flatnonzero(rng.random(40) < rng.random()) for _ in range(n)]
    sizes = np.array([len(r) for r in rows])
    counts = rng.integers(1, 5, sizes.sum())
    index = ranked.Index(rng.integers(5, 90, n), sizes, np.concatenate(rows), counts, rng.integers(0, 900, 40), n, 9000)
    for lo, hi in zip(index.ends, index.ends[1:]):
        for _ in range(50):
            a, b = sorted(rng.integers(lo, hi + 1, 2))
            if a < b:
                at = index.largest(np.array([a]), np.array([b]))[0]
                assert a <= at < b and index.impact[at] == index.impact[a:b].max()


@pytest.mark.parametrize("postings,batch", [(1 << 20, 128), (64, 1), (64, 3)])
def test_search(spark, monkeypatch, postings, batch):
    monkeypatch.setattr(ranked, "POSTINGS", postings)
    monkeypatch.setattr(ranked, "BATCH", batch)
    rng = random.Random(postings + batch)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(words[int(30 * rng.random() ** 3)] for _ in range(n))
    docs = [(i, text(rng.randint(0, 30))) for i in range(400)]
    docs += [(i, docs[i][1]) for i in range(0, 400, 3)] + [(1000 + i, docs[7][1]) for i in range(40)]
    items = [(i, text(rng.randint(0, 25))) for i in range(30)]
    got = found(ranked.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items)


def test_sets_of_queries(spark):
    docs = [(i, f"a{i % 7} b{i % 5} c") for i in range(60)]
    items = [(i, f"a{i % 9} b{i % 4} c d") for i in range(40)]
    args = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(ranked.search(*args, query_bytes=100)) == found(ranked.search(*args)) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(1, "Alpha beta"), (2, None), (3, ""), (4, " \n-!"), (5, "beta " * 200_000), (6, "x" * 300_000), (7, "alpha beta"), (7, "alpha beta"), (None, "alpha beta"), (8, "日本 É")]
    items = [(1, "ALPHA alpha beta"), (2, None), (3, ""), (4, "?"), (5, "nothing"), (1, "ALPHA alpha beta"), (None, "É"), (6, "x" * 300_000)]
    more = ", item_id string, rank int, score double, n int, terms string, counts int, place int"
    clash = lambda rows, first: spark.createDataFrame([(a, b, "z", 1, 0.5, 1, "t", 2, 3) for a, b in rows], first + more)
    documents = clash(docs, "doc_id long, text string")
    asked = spark.createDataFrame([(a, b, 1, 2.0) for a, b in items], "item_id long, text string, doc_id int, score double")
    assert found(ranked.search(documents, asked)) == brute(docs, items)
    assert ranked.search(documents.limit(0), asked).collect() == [] == ranked.search(documents, asked.limit(0)).collect()
