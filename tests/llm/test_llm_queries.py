"""Every query over the whole small tables, against its SQL or a brute-force version."""

import base64
import collections
import glob
import hashlib
import math
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from panelloom.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return {k: t or "" for k, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want


def test_packing(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for k, t in docs.items()}
    got = rows(spark, "op2_best_fit_packing")
    check_packing(got, ids)


def check_packing(got, ids):
    pieces = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(np.array(own, dtype="<u4").tobytes()) == r.ids_crc32
    assert pieces.keys() == ids.keys()
    for k, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) == len(ids[k]) and all(r.length == 1024 for r in own[1:])
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, ids.values()))
    assert len(bins) <= math.ceil(total / 1024) * 1.02 + 1


def test_html(spark, duck):
    want = {}
    for k, source in duck.execute("SELECT page_id, html FROM pages").fetchall():
        import html as entities

        article = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
        want[k] = "\n".join(t for t in texts if t)
    got = {r.page_id: r for r in rows(spark, "op3_html_extraction")}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_bpe(spark, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows(spark, "op4_byte_level_bpe")}
    for k, text in docs.items():
        ids = encoding.encode_ordinary(text)
        packed = np.array(ids, dtype="<u4").tobytes()
        assert got[k] == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_language(spark, duck, docs):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = rows(spark, "op6_language_id")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_model(spark, docs):
    words = {k: t.encode().lower().split() for k, t in docs.items()}
    counts, ends = collections.Counter(), 0
    for k, own in words.items():
        if fold(k, 5) != 1:
            counts.update(own)
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    base = math.log10(total + 0.5 * (distinct + 1))
    better = tokens = 0
    for r in rows(spark, "op7_lm_scoring"):
        own = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(r.doc_id, 5) == 1, len(own) + 1, total)
        assert r.n_known == sum(counts[w] > 0 for w in own) + 1
        assert r.base_score == pytest.approx(sum(math.log10(counts[w] + 0.5) - base for w in own) + math.log10(ends + 0.5) - base, abs=1e-6)
        if r.held_out:
            better, tokens = better + r.score - r.base_score, tokens + r.n_tokens
    assert better / tokens > 0.1  # contexts help on unseen texts


def test_nearest(spark, duck):
    found = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids = np.array([r[0] for r in found])
    vectors = np.array([r[1] for r in found], dtype=np.float32).astype(np.float64)
    got = collections.defaultdict(list)
    for r in rows(spark, "op8_nearest_neighbours"):
        got[r.query_id].append(r)
    assert sorted(got) == ids[ids % 20 == 0].tolist()
    hits = 0
    for q, own in got.items():
        own.sort(key=lambda r: r["rank"])
        scores = vectors @ vectors[ids == q][0]
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        hits += len({ids[i] for i in best} & {r.vec_id for r in own})
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(r.score == pytest.approx(scores[ids == r.vec_id][0], abs=1e-12) for r in own)
    assert hits >= 0.9 * 20 * len(got)


def test_quality(spark, duck, docs):
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = rows(spark, "op9_quality_classifier")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """doc_id -> smallest doc_id reachable."""
    keys = sorted(prints)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in keys}


def test_near_duplicates(spark, docs):
    prints = {k: fingerprint(t) for k, t in docs.items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op10_simhash_near_dedup")}
    assert got == {k: (f"{prints[k]:016x}", c) for k, c in classes(prints).items()}


def test_pipeline(spark, docs):
    from panelloom.sources.sinks import stage

    now = spark.read.parquet(f"{SF}/documents.parquet")
    whole = [tuple(r) for r in now.collect()]
    steps = dict(corpus_pipeline.STAGES)
    kept = stage(steps["quality"](spark, now, SF))
    good = {r.doc_id for r in rows(spark, "op9_quality_classifier") if r.predicted}
    assert kept.columns == now.columns and {tuple(r) for r in kept.collect()} <= set(whole)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == good
    told = stage(steps["language"](spark, kept, SF))
    assert told.columns == now.columns and told.count() >= 0.98 * kept.count()
    single = stage(steps["near_duplicates"](spark, told, SF))
    of = classes({r.doc_id: fingerprint(docs[r.doc_id]) for r in told.select("doc_id").collect()})
    left = [r.doc_id for r in single.select("doc_id").collect()]
    assert single.columns == now.columns and len(left) == len(set(of.values())) and {of[k] for k in left} == set(of.values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*tokenizer.encode(docs[k], add_special_tokens=False).ids, 2] for k in left}
    check_packing(steps["packing"](spark, single, SF).collect(), ids)
    assert corpus_pipeline.run(spark, SF).count() == sum(1 for k in left for _ in range(0, len(ids[k]), 1024))
