"""Periodic runs: parts and the query against brute force, and odd inputs."""

import hashlib
import os
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from panelloom.llm import periodic
from panelloom.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, runs string, collapsed int, n int, g int"


def brute(words, least=6, times=4):
    """All stretches of every period, those with a smaller period left out."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q) and not any(
                    all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (4, 3), (9, 2)])
def test_parts(least, times):
    rng = random.Random(least)
    for _ in range(200):
        texts = []
        for _ in range(rng.randint(1, 6)):
            words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randint(0, 40))]
            at = rng.randint(0, len(words))
            words[at:at] = [b"%d" % rng.randrange(3) for _ in range(rng.randint(1, 5))] * rng.randint(1, 9)
            texts.append(words)
        for words, (found, rest) in zip(texts, periodic.analysed(texts, least, times)):
            want = brute(words, least, times)
            assert [tuple(map(int, r)) for r in found] == want
            assert rest == kept(words, want)


def test_squares_of_many_periods():
    a, b = [b"a"], [b"b"]
    for _ in range(9):
        a, b = a + b, a
    ((found, _),) = periodic.analysed([a], 2, 2)
    assert [tuple(map(int, r)) for r in found] == brute(a, 2, 2)


def test_odd_rows(spark):
    loop, long = "x y z " * 5 + "x", "ab " * 300_000
    docs = spark.createDataFrame([(1, loop), (2, None), (3, ""), (4, " \n\t\x0b"), (5, long), (6, "one two"), (7, loop), (7, loop), (None, "q " * 6), (8, "é é é\x1cé")],
                                 "doc_id bigint, text string").select("*", *[F.lit(1).cast(t).alias(c) for c, t in (("runs", "string"), ("collapsed", "int"), ("n", "int"), ("g", "int"))])
    got = sorted(((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs).collect()))
    assert got == [(0, [(0, 6, 1)], "q"), (1, [(0, 16, 3)], "x y z"), (2, [], ""), (3, [], ""), (4, [], ""), (5, [(0, 300_000, 1)], "ab"), (6, [], "one two"),
                   (7, [(0, 16, 3)], "x y z"), (7, [(0, 16, 3)], "x y z"), (8, [], "é é é\x1cé")]
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, times=1)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    want = []
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall():
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = fast(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want.append((doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(kept(words, found))).hexdigest()))
    assert sum(r[1] > 0 for r in want) > 10
    df = QUERIES["op11_periodic_runs"](spark, SF)
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def fast(words):
    """As `brute`; a period is only tried where the words repeat at that distance for long enough."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // 4 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < n - q:
            if not same[i]:
                i += 1
                continue
            j = i
            while j < n - q and same[j]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))
