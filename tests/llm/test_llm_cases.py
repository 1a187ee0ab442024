"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; parts against brute force."""

import collections
import itertools
import math
import random
import types

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelloom.llm import queries as llm_queries
from panelloom.llm import ann, boilerplate, bpe, components, langid, packing, quality, simhash, suffixtree, topk, urls
from panelloom.llm.common import held_out
from panelloom.llm.queries import RULES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fingerprint string, stats string, chunk int"


def documents(spark, texts, langs=None):
    """Documents with columns whose names clash with those that the operators make."""
    langs = langs or itertools.repeat("en")
    return spark.createDataFrame([(k, t, g, "s", 0, 0.5, "x", "y", 1) for (k, t), g in zip(texts, langs)], DOCS)


def odd(spark):
    return documents(spark, [(1, "One two three four five."), (2, None), (3, ""), (4, " \n\t "), (5, "word " * 40_000), (6, "x" * 200_000),
                             (None, "no id at all"), (7, "One two three four five."), (7, "One two three four five."), (8, "日本語 テスト é"), (9, "123 456 !!!")])


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def strange_texts():
    rng = random.Random(4)
    signs = [" ", "  ", "\n", "\t", "a", "B", "é", "'s", "1", "!", "\x1c", " ", "　", "the", "ß", "日", "\x85", "'", "<|endoftext|>"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(2000)] + ["", " lead", "trail ", "a" * 5000 + " " * 700 + "b", "\x00\x01"]


# urls

PAGES = "page_id bigint, url string, html string, host string, rule string, node string"


def test_url_cases(spark):
    pages = spark.createDataFrame([
        (1, "http://a.net/x", '<LINK href="https://b.org/y?a=1&amp;b=2" REL="canonical">'), (2, "http://b.org/y?a=1&b=2#f", ""),
        (3, "https://q.net/fr/z", "<meta http-equiv='refresh' content='0; url=//b.org/y?a=1&b=2'>"), (4, None, None), (5, "no scheme", "<link rel=canonical href=/x>"),
        (6, "http://www.example.com/en/1", '<link href="/fr/2" rel=canonical>'), (7, "http://EXAMPLE.com/en/1#x", '<link href="http://t.org" rel=canonical>'),
        (8, "http://t.org", None), (8, "http://t.org", None), (9, "http://www.example.com", None), (None, "http://sub.EXAMPLE.com/en/", None),
        (10, "http://notexample.com/en/", None), (11, "http://m.org/a/b", '<link rel=canonical href="c">'), (12, "http://m.org/a/c", '<meta http-equiv=refresh content="1;URL=http://x.net/es/1">'),
    ], "page_id bigint, url string, html string").select("*", *[F.lit("z").alias(c) for c in ("host", "rule", "node")])
    got = collections.defaultdict(list)
    for r in urls.judge(pages, RULES).collect():
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert dict(got) == {
        1: [("a.net", "/x", None, "block")], 2: [("b.org", "/y", None, "block")], 3: [("q.net", "/fr/z", "net/fr/", "block")], 4: [("", "", None, "allow")],
        5: [("", "", None, "allow")], 6: [("www.example.com", "/en/1", "www.example.com/en/", "allow")], 7: [("example.com", "/en/1", "example.com/en/", "block")],
        8: [("t.org", "", None, "block")] * 2, 9: [("www.example.com", "", None, "allow")], None: [("sub.example.com", "/en/", "example.com/en/", "block")],
        10: [("notexample.com", "/en/", "com/", "allow")], 11: [("m.org", "/a/b", None, "block")], 12: [("m.org", "/a/c", None, "block")]}


def test_url_redirects_and_precedence(spark):
    pages = spark.createDataFrame([(1, "http://free.org/1", None), (2, "http://www.example.com/en/5", None)], "page_id bigint, url string, html string")
    moved = spark.createDataFrame([("http://free.org/1", "http://old.org/"), ("http://old.org/", "http://example.com/en/"), ("http://example.com/en/", "http://www.example.com/en/5"),
                                   (None, "http://free.org/1")], "source string, target string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, RULES, moved).collect()}
    assert got == {1: "block", 2: "allow"}
    assert urls.judge(spark.createDataFrame([], PAGES), RULES).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)]
    edges += [(None, 3), (5, None), (7, 7), (1, 1)] + edges[:5]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: root(k) for k in list(parent)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# packing

def test_local_search_empties_bins():
    rng = random.Random(3)
    for _ in range(30):
        sizes = [rng.randint(1, 60) for _ in range(200)]
        scattered = [[i] for i in range(len(sizes))]
        found = packing.local_search(scattered, sizes, 100)
        assert sorted(i for b in found for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in found)
        assert sum(sum(sizes[i] for i in b) ** 2 for b in found) > sum(s * s for s in sizes)
        best = packing.pack(sizes, 100)
        assert math.ceil(sum(sizes) / 100) <= len(best) <= math.ceil(sum(sizes) / 100) + 1


def test_exchange_kinds():
    sizes = [60, 30, 40, 25, 10]
    assert packing._exchange([0], 40, [2], sizes) == (40, [2], [])  # a move
    assert packing._exchange([1, 0], 10, [2], sizes) == (10, [2], [1])  # one for one
    assert packing._exchange([1, 0], 10, [4, 3], sizes)[0] == 10  # a move of 10 fills it
    assert packing._exchange([1, 0], 5, [4, 3], sizes) == (5, [4, 3], [1])  # two for one


def test_no_exchange_is_left():
    """No move, swap or two-for-one between two bins of the result grows the sum of squared fills."""
    rng = random.Random(5)
    for low, high, n in ((1, 60, 60), (20, 45, 120), (34, 100, 80), (5, 5, 50)):
        sizes = [rng.randint(low, high) for _ in range(n)]
        found = packing.pack(sizes, 100)
        fills = [sum(sizes[i] for i in b) for b in found]
        assert sorted(i for b in found for i in b) == list(range(n)) and max(fills) <= 100
        for a, give in enumerate(found):
            for b, to in enumerate(found):
                if a == b or fills[a] > fills[b]:
                    continue
                sums = [sizes[y] for y in give]
                pairs = [sizes[y] + sizes[z] for y, z in itertools.combinations(give, 2)]
                growths = [*sums, *(y - sizes[x] for y in sums + pairs for x in to)]
                assert not any(0 < g <= 100 - fills[b] for g in growths)


@pytest.mark.parametrize("low, high", [(3, 3), (300, 500), (513, 1023)])
def test_whole_groups_are_searched_to_the_end(low, high):
    """A group of the largest size, with lengths all alike, with many bins that can give, with none that can."""
    rng = random.Random(7)
    sizes = [rng.randint(low, high) for _ in range(packing.GROUP)]
    first = packing.best_fit(sizes, 1024)
    found = packing.local_search(first, sizes, 1024)
    assert sorted(i for b in found for i in b) == list(range(packing.GROUP))
    assert max(sum(sizes[i] for i in b) for b in found) <= 1024
    assert len(found) < len(first) if low == 300 else len(found) == len(first)


def test_encoder(strange_texts):
    """The encoder by ranks gives the tokenizer's ids, around every kind of character."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True
    texts = strange_texts + [f"a{c}b {c} 1{c}{c}2  {c}x !{c}'s{c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000, 7)])]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    own = packing.Encoder(definition, public_tokenizers.PATTERN)
    assert own.tokenizer is None and own(texts) == want


def test_other_tokenizer():
    """A file of another kind is encoded by the tokenizer itself."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    own = packing.Encoder(definition, public_tokenizers.PATTERN)
    ids = Tokenizer.from_str(definition).encode("Two words", add_special_tokens=False).ids
    assert own.ranks is None and own(["Two words"]) == [np.array(ids, dtype="<u4").tobytes()]


def test_packing_cases(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(odd(spark), path, public_tokenizers.PATTERN, capacity=64).collect()
    by_doc = collections.Counter(r.doc_id for r in got)
    assert set(by_doc) == {1, 2, 3, 4, 5, 6, 7, 8, 9, None} and by_doc[7] == 2
    assert [(r.start, r.length) for r in got if r.doc_id == 2] == [(0, 1)]
    fills = collections.Counter()
    for r in got:
        fills[r.sequence_id] += r.length
    assert max(fills.values()) <= 64 and len(fills) <= math.ceil(sum(fills.values()) / 64) + 1
    assert packing.pack_documents(empty(spark), path, public_tokenizers.PATTERN).count() == 0


# byte-level BPE

def test_bpe_round_trip(strange_texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.read_ranks(path)
    own = bpe.Codec(tokens, public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    ids = own.encode(strange_texts)
    assert ids == [np.array(other.encode_ordinary(t), dtype="<u4").tobytes() for t in strange_texts]
    assert [own.decode(x).decode() for x in ids] == strange_texts


def test_bpe_cases(spark):
    got = {r.doc_id: r for r in bpe.encode_documents(odd(spark), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    assert bytes(got[2].ids) == bytes(got[3].ids) == b"" and bytes(got[5].decoded) == b"word " * 40_000 and bytes(got[6].decoded) == b"x" * 200_000
    assert bytes(got[None].decoded) == b"no id at all"
    assert bpe.encode_documents(empty(spark), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


# html

def page(body, **more):
    return f"<html><head><title>T</title></head><body>{body}</body></html>"


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain  words\n here", "plain words here"), ("<p>a<p>b", "a\nb"), ("<p>a<b>b</b>c</p>", "abc"), ("<p>a<br>b</p>", "a b"),
    ("<p>x &amp; y &lt;z&gt; &#233; &nbsp;q</p>", "x & y <z> é q"), ("<div>a<script>if (a<b) '</p>'</script>b</div>", "ab"),
    ("<article><h1>H</h1><p>P</p></article><p>outside</p>", "H\nP"), ("<article><p>P</p><aside>no</aside><div class='ad box'>no</div><p>Q</article>", "P\nQ"),
    ("<article><header><h1>H</h1></header><p>P</p></article><header>site</header>", "H\nP"), ("<main><p>m</p></main><footer>f</footer>", "m"),
    ("<article><p>P</p></article><section id=comments><article class=comment><p>no</p></article></section>", "P"),
    ("<!-- <p>x</p> --><p>y</p><!-- open", "y"), ("<form><p>f</p></form><p>g</p>", "g"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<p hidden>a</p><p>b</p>", "b"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<div class=cookie-notice><p>x</p></div><p>y &copy</p>", "y ©"), ("a < b and c > d", "a < b and c > d"),
    ("</p></div>t</span>", "t"), ("<p title='a>b'>t</p>", "t"), ("<p title='a>t</p>", "t"), ("<textarea><p>x</p></textarea>y", "y"), ("<b>a<p>b</p></b>c", "a\nb\nc"),
])
def test_html_cases(source, text):
    assert boilerplate.main_text(boilerplate.read_page(source), set(), set(), set()) == text


def test_html_depth():
    assert boilerplate.main_text(boilerplate.read_page("<div>" * 20_000 + "x"), set(), set(), set()) == "x"


def test_template_removal(spark):
    """Unmarked frames go where they recur on many pages of a host, and only there."""
    frame = "<div><p>Welcome to our site</p><p>{}</p></div>"
    rows = [(k, f"http://h.org/{k}", page(frame.format("Home Products Contact") + f"<div><p>Story number {k} tells of {k * 7}.</p></div>")) for k in range(40)]
    rows += [(100 + k, f"http://h.org/long/{k}", page(f"<article><p>Quoted everywhere.</p><p>Own words {k}</p></article><div>Unmarked frame</div>")) for k in range(15)]
    rows += [(200, "http://other.org/", page(frame.format("Home Products Contact") + "<div><p>Lone page</p></div>")), (201, None, page("<p>no url</p>")), (202, "http://h.org/n", None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, pages int")
    got = {r.page_id: r for r in boilerplate.extract(pages).collect()}
    assert all(got[k].text == f"Story number {k} tells of {k * 7}." for k in range(40))
    assert all(got[100 + k].text == f"Quoted everywhere.\nOwn words {k}" for k in range(15))
    assert got[200].text == "Welcome to our site\nHome Products Contact\nLone page"
    assert got[201].text == "no url" and (got[202].text, got[202].n_chars) == ("", 0)
    assert boilerplate.extract(spark.createDataFrame([], pages.schema)).count() == 0


def test_copies_are_no_template(spark):
    """A page that is copied keeps its text; frames still go, from copies too."""
    story, frame = "<h1>Title {0}</h1><p>The story of {0}.</p>", "<div><p>Unmarked frame</p></div>"
    rows, want = [], []
    for host, copies, others, ads in (("only.org", 24, 0, False), ("half.org", 25, 25, False), ("most.org", 30, 10, False), ("ads.org", 24, 20, True)):
        for kind in ("article", "section"):
            for k in range(copies + others):
                own = "copies" if k < copies else f"page {k}"
                ad = f"<div class=ad>Buy {k}</div>" if ads else ""
                rows.append((len(rows), f"http://{kind}.{host}/{k}", page(f"{frame if others else ''}{ad}<{kind}>{story.format(own)}</{kind}>")))
                want.append(f"Title {own}\nThe story of {own}.")
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in boilerplate.extract(pages).collect()}
    assert [got[k] for k in range(len(rows))] == want


def unmarked_site(rng, host, pages):
    """Pages whose menus, adverts, notes and comments are plain divs with other words on each page; (url, html, text)."""
    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(n))

    for k in range(pages):
        title, story = words(5), [words(rng.randint(8, 60)) for _ in range(rng.randint(2, 9))]
        menu = "".join(f"<div><a href='/{w}'>{w}</a></div>" for w in words(rng.randint(4, 7)).split())
        body = "".join(f"<div>{p}</div>" for p in [title, *story])
        source = page(f"<div><div>{menu}</div></div><div>{words(6)}</div><div>{body}</div><div>{words(4)}</div>")
        yield f"http://{host}/{k}", source.replace("<html>", f"<html lang='{'de en fr'.split()[k % 3]}'>"), "\n".join([title, *story])


def test_templates_alone_find_the_article(spark, monkeypatch):
    """No tag, class or article tells content here: skeletons that recur on the host do; without templates it fails."""
    rng = random.Random(11)
    rows = [r for n in (20, 100, 300) for r in unmarked_site(rng, f"h{n}.org", n)]
    few = list(unmarked_site(rng, "few.org", 5))
    copies = [rows[0]] * 15  # repeated rows of one page are one page
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows + few + copies)], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in boilerplate.extract(pages).collect()}
    assert len(got) == len(rows) + 20
    assert [got[i] for i in range(len(rows))] == [t for *_, t in rows]
    assert all(t in got[len(rows) + i] for i, (*_, t) in enumerate(few))  # too few pages to tell: nothing is lost
    assert all(got[len(rows) + 5 + i] == rows[0][2] for i in range(15))
    real = boilerplate.templates
    monkeypatch.setattr(boilerplate, "templates", lambda p: real(p.limit(0)))
    none = {r.page_id: r.text for r in boilerplate.extract(pages.where("page_id < 20")).collect()}
    assert not any(none[i] == rows[i][2] for i in range(20))


# top-k and neighbours

def vectors(spark, values):
    return spark.createDataFrame([(k, v, 1, 2.0) for k, v in values], "vec_id bigint, embedding array<double>, label int, score double")


def random_vectors(n, width=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(k, [float(x) for x in rng.normal(size=width).round(3)]) for k in range(n)]


def test_lists_read_exactly():
    rng = np.random.default_rng(0)
    block = rng.integers(-50, 50, (3000, 12))
    lists = topk.Lists(block)
    for q in rng.integers(-50, 50, (20, 12)):
        found, scores = lists.top(q, 5)
        full = block @ q
        assert sorted(found) == np.flatnonzero(full >= np.sort(full)[-5]).tolist() and (scores == full[found]).all()


def test_top_k_cases(spark):
    own = random_vectors(300)
    own += [(100, own[100][1]), (400, own[100][1]), (401, own[100][1]), (500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] * 8),
            (504, [0.0] * 8), (None, [0.0] * 8)]
    got = collections.defaultdict(list)
    for r in topk.exact_top_k(vectors(spark, own), block=64).collect():
        got[r.query_id].append((r["rank"], -r.score, r.vec_id))
    valid = [(k, [math.floor(1024 * x) for x in v]) for k, v in own if k is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = collections.defaultdict(list)
    for i, (q, v) in enumerate(valid):
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), k) for j, (k, w) in enumerate(valid) if j != i)[:10]
            want[q] += [(rank, s, k) for rank, (s, k) in enumerate(best, 1)]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert topk.exact_top_k(vectors(spark, [])).count() == 0
    assert topk.exact_top_k(vectors(spark, [(100, [1.0])])).count() == 0
    assert [(r.vec_id, r.score) for r in topk.exact_top_k(vectors(spark, [(100, [1.0]), (7, [2.0]), (3, [2.0])])).orderBy("rank").collect()] == [(3, 2 << 20), (7, 2 << 20)]


def test_neighbour_cases(spark):
    own = [(k, v) for k, v in random_vectors(60)] + [(20, [0.1] * 8), (61, [0.0] * 8), (62, None), (63, [None] * 8), (64, [float("inf")] * 8)]
    got = collections.Counter(r.query_id for r in ann.nearest(vectors(spark, own), k=5).collect())
    assert got == {0: 5, 20: 10, 40: 5}
    assert ann.nearest(vectors(spark, [])).count() == 0
    few = ann.nearest(vectors(spark, [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.1])])).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in few] == [(1, 1, 0.5), (2, 2, 0.5)]


def test_neighbours_of_unequal_norms(spark):
    rng = np.random.default_rng(8)
    own = [(k, [float(x) for x in rng.normal(size=16) * rng.uniform(0.2, 3)]) for k in range(3000)]
    block = np.array([v for _, v in own])
    hits = total = 0
    got = collections.defaultdict(set)
    for r in ann.nearest(vectors(spark, own), block=1000).collect():
        got[r.query_id].add(r.vec_id)
    for q, found in got.items():
        scores = block @ block[q]
        hits += len(found & set([i for i in np.argsort(-scores) if i != q][:20]))
        total += 20
    assert len(got) == 150 and hits >= 0.9 * total


@pytest.mark.parametrize("source", ["sf0.1", "noise"])
def test_recall_where_the_share_binds(spark, source):
    """Blocks in which the share, not the least number of verified rows, ends the search."""
    if source == "sf0.1":
        found = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
        every = 20
    else:
        every, noise = 82, np.random.default_rng(0).normal(size=(ann.BLOCK, 64))
        found = spark.createDataFrame([(k, v) for k, v in enumerate(noise.tolist())], "vec_id bigint, embedding array<double>")
    held = found.collect()
    block, ids = np.array([r.embedding for r in held]), np.array([r.vec_id for r in held])
    assert 16 * 21 < ann.SHARE * len(block)
    got = collections.defaultdict(set)
    for r in ann.nearest(found, every=every).collect():
        got[r.query_id].add(r.vec_id)
    assert sorted(got) == sorted(ids[ids % every == 0].tolist())
    hits = 0
    for q, own in got.items():
        scores = block @ block[ids == q][0]
        hits += len(own & set([ids[i] for i in np.argsort(-scores) if ids[i] != q][:20]))
    assert hits >= 0.92 * 20 * len(got)


# language ID

def naive_length(trees_of, text, classes):
    """Code length of a text by walking one language's contexts."""
    codes, bits = [classes[b] for b in text], 0.0
    for i, c in enumerate(codes):
        context = tuple(codes[max(0, i - 3) : i])
        while True:
            own = trees_of.get(context)
            if own:
                n, d = sum(own.values()), len(own)
                if c in own:
                    bits += math.log2((n + d) / own[c])
                    break
                bits += math.log2((n + d) / d)
            if not context:
                bits += 8
                break
            context = context[1:]
    return bits


def test_code_lengths(spark):
    texts = [("en", "the cat and the dog ate the hat. " * 4), ("en", "that then this"), ("fr", "le chat et le chien et la souris. " * 4), ("fr", "la")]
    found = langid.counted(spark.createDataFrame(texts, "lang string, text string")).toPandas()
    trees = langid.build(found["lang"].tolist(), found["gram"].to_numpy(), found["n"].to_numpy())
    own = {g: collections.defaultdict(collections.Counter) for g in ("en", "fr")}
    for lang, text in texts:
        codes = [trees.classes[b] for b in text.encode()]
        for i in range(3, len(codes)):
            for k in range(4):
                own[lang][tuple(codes[i - k : i])][codes[i]] += 1
    for text in (b"the hat", b"le chat", b"q", b"zz top", b"", "é the".encode()):
        if text:
            assert trees.code_lengths(text) == pytest.approx([naive_length(own[g], text, trees.classes) for g in ("en", "fr")], rel=1e-5)
    assert trees.predict(b"the dog")[0] == "en" and trees.predict(b"la souris")[0] == "fr"
    assert trees.predict(b"") == trees.predict(b"12 !") == ("und", 0.0)


def test_language_cases(spark):
    docs = documents(spark, [(k, "the cat and the dog " * 3) for k in range(20)] + [(100 + k, "le chat et le chien " * 3) for k in range(20)] + [(200, None), (201, ""), (202, "42"),
                     (None, "the dog"), (203, "the cat " * 200_000)], ["en"] * 20 + ["fr"] * 20 + ["en", None, "en", "en", "en"])
    got = {r.doc_id: r for r in langid.identify(docs, held_out(F.col("doc_id"), 5, 0)).collect()}
    assert {got[k].lang_pred for k in range(20)} == {"en"} and {got[100 + k].lang_pred for k in range(20)} == {"fr"}
    assert [got[k].lang_pred for k in (200, 201, 202, None, 203)] == ["und", "und", "und", "en", "en"] and got[None].held_out is False
    assert langid.identify(empty(spark), F.lit(False)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(False)).collect()} == {"und"}
    assert langid.identified(docs, F.lit(False)).count() == 42


def test_long_texts_teach(spark, monkeypatch):
    """A language of which all texts have 5 million characters and more, and counts that do not depend on pieces."""
    docs = documents(spark, [(k, "the cat and the dog " * 3) for k in range(5)] + [(9, "le chat et la souris " * 240_000), (10, "la souris et le chat")], ["en"] * 5 + ["fr", None])
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, F.lit(False)).collect()}
    assert got == {**dict.fromkeys(range(5), "en"), 9: "fr", 10: "fr"}
    texts = spark.createDataFrame([("en", "the cat ate " * 30), ("fr", "la"), ("fr", ""), ("fr", "le chat")], "lang string, text string")
    want = sorted(langid.counted(texts).collect())
    monkeypatch.setattr(langid, "PIECE", 5)
    assert sorted(langid.counted(texts).collect()) == want


def test_no_learned_language(spark):
    """Texts in none of the learned languages go; unseen texts in one of them stay."""
    rng = random.Random(6)
    en, fr = "the cat and dog ate a hat with some milk under this tree".split(), "le chat et la souris mange du pain avec une pomme sous arbre".split()
    def say(words, n): return " ".join(rng.choice(words) for _ in range(n))
    texts = [(k, say(en, rng.randint(20, 90))) for k in range(60)] + [(100 + k, say(fr, rng.randint(20, 90))) for k in range(60)]
    texts += [(200, "".join(rng.choice("qxzjkvwbyg ") for _ in range(400))), (201, say("jeg kjoper noen fisk pa torget hver lordag formiddag".split(), 60)),
              (202, say(en, 400)), (203, say(fr, 25))]
    docs = documents(spark, texts, ["en"] * 60 + ["fr"] * 60 + [None] * 4)
    kept = {r.doc_id for r in langid.identified(docs, F.col("doc_id") >= 200).collect()}
    assert kept == {*range(60), *range(100, 160), 202, 203}


def test_scores_beyond_exact_doubles_are_refused(spark):
    """Components whose products doubles do not hold raise instead of wrapping; the largest that fit are scored exactly."""
    fields = "vec_id bigint, embedding array<double>"
    for big in (2.0**60, 1e200, -1e200, 2.0**17):
        with pytest.raises(ValueError, match="2\\^53"):
            topk.exact_top_k(spark.createDataFrame([(0, [1.0, 2.0]), (1, [big, 0.0])], fields))
    got = topk.exact_top_k(spark.createDataFrame([(0, [2.0**16, 0.0]), (1, [2.0**16, 1.0])], fields)).collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 1, 2**52)]


# language model

def told_by_hand(texts, out, least, depth, bits):
    """log10 probabilities of texts by a suffix tree in dictionaries."""
    words = [(t or "").encode().lower().split() for t in texts]
    seen = collections.Counter(w for own, o in zip(words, out) if not o for w in own)
    ends = sum(not o for o in out)
    symbol = {w: w if n >= least else w[-1] for w, n in seen.items()}
    classes = collections.defaultdict(list)
    for w, n in seen.items():
        if symbol[w] != w:
            classes[symbol[w]].append(n)
    coded = [["", *[symbol.get(w, w[-1]) for w in own], ""] for own in words]
    following = collections.defaultdict(collections.Counter)
    for own, o in zip(coded, out):
        for i in range(1, len(own) if not o else 0):
            for k in range(min(i, depth) + 1):
                following[tuple(own[i - k : i])][own[i]] += 1
    size, states = 257 + sum(symbol[w] == w for w in seen), {}

    def state(context):
        return next((context[k:] for k in range(len(context)) if context[k:] in states), ())

    def p(context, x):
        own, below = following[context], p(state(context[1:]), x) if context else 1 / size
        return (own[x] + len(own) * below) / (sum(own.values()) + len(own)) if own else below

    for k in range(1, depth + 1):
        for context in [c for c in following if len(c) == k]:
            own, total = following[context], sum(following[context].values())
            if total >= least and sum(n * math.log2(n / total / p(state(context[1:]), x)) for x, n in own.items()) >= bits:
                states[context] = True
    scores = []
    for own, told in zip(words, coded):
        score = sum(math.log10(p(state(tuple(told[max(0, i - depth) : i])), told[i])) for i in range(1, len(told)))
        for w in own:
            if symbol.get(w) != w:
                c = classes[w[-1]]
                score += math.log10(seen[w] + 0.5) - math.log10(sum(c) + 0.5 * (len(c) + 1))
        scores.append(score)
    return scores, len(states), ends


@pytest.mark.parametrize("least, depth, bits", [(None, 3, 5.0), (4, 3, 2.0), (8, 2, 20.0), (2, 4, 0.5), (4, 3, 1e9)])
def test_suffix_tree_by_hand(spark, least, depth, bits):
    """Scores equal those of a tree in dictionaries, whatever the chunks; a test that asks too much leaves the root alone."""
    rng = random.Random(6)
    pool, texts = [f"w{k}{rng.choice('abc')}" for k in range(40)], [None, "", " ", "alone"]
    for _ in range(60):
        own = [rng.choice(pool)]
        for _ in range(rng.randint(0, 60)):
            own.append(pool[(pool.index(own[-1]) + rng.choice([1, 1, 1, 2, 7])) % 40] if rng.random() < 0.8 else rng.choice(pool))
        texts.append(" ".join(own))
    texts += texts[10:14]
    out = [k % 4 == 1 for k in range(len(texts))]
    n = sum(len((t or "").split()) + 1 for t, o in zip(texts, out) if not o)
    want, states, _ = told_by_hand(texts, out, least or math.sqrt(n), depth, bits)
    assert (states == 0) == (bits == 1e9)
    docs = documents(spark, list(enumerate(texts)))
    for parts in (1, 5):
        got = suffixtree.score_documents(docs.repartition(parts), F.col("doc_id") % 4 == 1, least=least, depth=depth, bits=bits).collect()
        assert sorted(r.doc_id for r in got) == list(range(len(texts))) and {r.train_tokens for r in got} == {n}
        for r in got:
            assert r.score == pytest.approx(want[r.doc_id], abs=1e-5)


def test_packed_arrays():
    for kind in ("<i4", "<i8", "<f4", "<u8"):
        for own in (np.zeros(0), np.arange(1000) * 7):
            assert (suffixtree.unpack(suffixtree.pack(own.astype(kind)), kind) == own).all()


def test_model_grows_with_the_corpus(spark):
    """The least count is the root of the training tokens, so words that a small corpus does not tell apart are told apart in a larger one."""
    rng = random.Random(3)
    better = []
    for many in (200, 3200):
        pool = [f"q{k}e" for k in range(250)]
        texts = []
        for _ in range(many):
            own = [rng.choice(pool)]
            for _ in range(40):
                own.append(pool[(pool.index(own[-1]) * 7 + 3) % 250] if rng.random() < 0.7 else rng.choice(pool))
            texts.append(" ".join(own))
        got = suffixtree.score_documents(documents(spark, list(enumerate(texts))), F.col("doc_id") % 5 == 1).where("held_out").agg(
            (F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).alias("better")).first()
        better.append(got.better)
    assert better[1] > better[0] + 0.1


def test_rare_words_and_contexts_count_in_a_large_corpus(spark):
    """A pair of words that training holds twice counts however large the corpus is; the root of its tokens left such words out."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(200)) for _ in range(100)] + ["a twice told tale"] * 2
    docs = documents(spark, list(enumerate([*texts, "b twice told tale", "b tale twice told"])))
    got = {r.doc_id: r.score for r in suffixtree.score_documents(docs, F.col("doc_id") >= len(texts), bits=llm_queries.BITS).collect()}
    assert llm_queries.LEAST == 2 and got[len(texts)] > got[len(texts) + 1] + 2


def test_split_contexts(spark, monkeypatch):
    """Contexts that are dealt out over buckets give the scores of those that are not."""
    rng = random.Random(9)
    docs = documents(spark, [(k, " ".join(rng.choice("abcdefghij") + rng.choice("xy") for _ in range(50))) for k in range(60)]).repartition(5)
    whole = {r.doc_id: r.score for r in suffixtree.score_documents(docs, F.col("doc_id") % 5 == 1, bits=5.0).collect()}
    monkeypatch.setattr(suffixtree, "SPLIT", 7)
    split = {r.doc_id: r.score for r in suffixtree.score_documents(docs, F.col("doc_id") % 5 == 1, bits=5.0).collect()}
    assert split == pytest.approx(whole, abs=1e-9)


def test_words_and_runs_take_a_row_per_chunk_and_bucket(spark, monkeypatch):
    """Tables of the language model have rows for chunks and their buckets; one row for every word of a chunk took most of the time outside Python."""
    held, stage = [], suffixtree.stage

    def counted(df):
        out = stage(df)
        held.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(suffixtree, "stage", counted)
    docs = documents(spark, [(k, " ".join(f"w{k}x{j}" for j in range(100))) for k in range(40)]).coalesce(1)
    assert suffixtree.score_documents(docs, F.col("doc_id") % 5 == 1).count() == 40
    assert len(held) == 3 + suffixtree.DEPTH and all(n <= 1 + suffixtree.CLASSES for _, n in held)


def test_words_of_texts():
    """Words are those between ASCII white space, whatever else a text holds, also in a part of a column."""
    texts = [None, "", " ", "a", " A  b\t", "\x0b\x1c\x1d a\x00b\x85 \xa0\u2003c ÄÖÅ\r\n", *(f"aA{chr(k)}Bb" for k in range(256))]
    for at in (0, 4):
        words, n = suffixtree._words(pa.array(texts).slice(at))
        want = [(t or "").encode().lower().split() for t in texts[at:]]
        assert n.tolist() == [len(x) for x in want] and words.cast(pa.binary()).to_pylist() == [w for x in want for w in x]
    broken = pa.array([b"A\xff\xc3 \x80B "], pa.binary()).view(pa.string())
    assert suffixtree._words(broken)[0].view(pa.binary()).to_pylist() == [b"a\xff\xc3", b"\x80b"]


@pytest.mark.parametrize("tokens, size", [(1, 1 << 20), (1_500_000, 1), (40, 1 << 20), (1_500_000, 1 << 20)])
def test_chunks_hold_all_texts(monkeypatch, tokens, size):
    """A chunk ends by tokens or by bytes; texts without words count too, and every word's training tokens are those of all chunks."""
    monkeypatch.setattr(suffixtree, "CHUNK", tokens)
    monkeypatch.setattr(suffixtree, "CHUNK_BYTES", size)
    monkeypatch.setattr(suffixtree, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 3)))
    texts = [None, "", "b a b", " a ", "c" * 300, *[f"w{k % 7} a" for k in range(30)], None]
    out = [None, True, *[k % 4 == 1 for k in range(len(texts) - 2)]]
    batches = [pa.record_batch({"doc_id": pa.array([k], pa.int64()), "held_out": pa.array([o], pa.bool_()), "text": pa.array([t], pa.string())}) for k, (t, o) in enumerate(zip(texts, out))]
    chunks = list(suffixtree._chunks(batches))
    assert [c.column("chunk")[0].as_py() for c in chunks] == [3 << 12 | k for k in range(len(chunks))]
    assert [k for c in chunks for k in c.column("doc_id")[0].as_py()] == list(range(len(texts)))
    assert (len(chunks) == 1) == (tokens == 1_500_000 and size > 1) and (len(chunks) == len(texts)) == (tokens == 1)
    sent = [(row["chunk"], row["bucket"], row) for c in suffixtree._dealt(chunks, 3) for row in c.to_pylist()]
    counts, symbols = collections.defaultdict(set), {}
    for bucket in {b for _, b, _ in sent}:
        group = pa.Table.from_pylist([row for _, b, row in sent if b == bucket])
        told = suffixtree._numbered(group, 2.0).to_pylist()
        for row, own in zip([r for r in told if r["chunk"] is not None], sorted((row for _, b, row in sent if b == bucket), key=lambda row: row["chunk"])):
            lengths = suffixtree.unpack(own["lengths"], "<i8")
            words = np.split(suffixtree.unpack(own["words"], "u1"), np.cumsum(lengths)[:-1])
            for w, c, x in zip(words, suffixtree.unpack(row["c"], "<i8").tolist(), suffixtree.unpack(row["symbol"], "<i8").tolist()):
                counts[w.tobytes()].add(c)
                assert symbols.setdefault(w.tobytes(), x) == x
    seen = collections.Counter(w for t, o in zip(texts, out) if not o for w in (t or "").encode().split())
    assert {w: {seen[w]} for w in counts} == counts and set(seen) <= set(counts)
    assert all((x < suffixtree.CLASSES and x == w[-1] + 1) if seen[w] < 2 else x >= suffixtree.CLASSES for w, x in symbols.items())
    assert len({x for x in symbols.values() if x >= suffixtree.CLASSES}) == sum(c >= 2 for c in seen.values())


def test_unique():
    for own in ([], [3], [5, 5, 1], [2**64 - 1, 2**64 - 2, 2**64 - 1, 2**64 - 2], [7, 2**63, 7, 0]):
        keys = np.array(own, dtype=np.uint64)
        for got, want in zip(suffixtree.unique(keys), np.unique(keys, return_index=True, return_inverse=True)):
            assert got.tolist() == want.tolist()


def test_language_model_cases(spark):
    got = {r.doc_id: r for r in suffixtree.score_documents(odd(spark), held_out(F.col("doc_id"), 5, 1)).collect()}
    assert got[2].n_tokens == got[3].n_tokens == got[4].n_tokens == 1 and got[5].n_tokens == 40_001 and got[None].held_out is False
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got.values())
    assert suffixtree.score_documents(empty(spark), F.lit(False)).count() == 0
    alone = suffixtree.score_documents(odd(spark), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 and math.isfinite(r.score) for r in alone)


def test_rare_words_share_their_symbol(spark):
    """Over all words that training knows, and one unknown, the probabilities of a next word sum to one."""
    docs = documents(spark, [(k, t) for k, t in enumerate(["a b a c a b", "a d b a", "b a a"])] + [(10, "a"), (11, "b"), (12, "c"), (13, "d"), (14, "")])
    out = F.col("doc_id") >= 10
    got = {r.doc_id: r for r in suffixtree.score_documents(docs, out, least=3).collect()}
    assert got[12].n_known == 2 and got[12].score < got[10].score


# quality

def test_isotonic():
    rng = np.random.default_rng(1)
    value, weight = rng.random(40), rng.integers(1, 5, 40).astype(float)
    fit = quality.isotonic(value, weight)
    assert (np.diff(fit) >= 0).all() and (fit * weight).sum() == pytest.approx((value * weight).sum())
    assert quality.isotonic(np.array([1.0, 0.0]), np.array([1.0, 3.0])).tolist() == [0.25, 0.25]


def test_quality_cases(spark):
    rng = random.Random(1)
    good = [(k, " ".join(rng.choice(["the", "sun", "rose", "over", "hills", "and"]) for _ in range(60)) + ".") for k in range(60)]
    bad = [(100 + k, " ".join(rng.choice(["$$$", "!!!", "##", "BUY", "%%%"]) for _ in range(60))) for k in range(60)]
    extra = [(200, None), (201, ""), (202, "word " * 100_000), (None, "the sun rose over hills.")]
    docs = documents(spark, good + bad + extra)
    labels = spark.createDataFrame([(k, 1, 0) for k, _ in good] + [(k, 0, 0) for k, _ in bad] + [(0, 1, 0), (1, None, 0), (None, 1, 0), (999, 1, 0)], "doc_id bigint, quality int, toxic int")
    held = held_out(F.col("doc_id"), 3, 1)
    got = {r.doc_id: r for r in quality.score_documents(docs, labels, held).collect()}
    assert len(got) == 124 and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[k].predicted == 1 for k, _ in good) and all(got[k].predicted == 0 for k, _ in bad)
    assert quality.score_documents(empty(spark), labels, held).count() == 0
    assert {r.score for r in quality.score_documents(docs, labels.where("false"), held).collect()} == {0.5}
    assert quality.accepted(docs, labels, held).columns == docs.columns


# SimHash

def test_golay_keys_find_all_errors():
    """Fingerprints that differ in at most 3 bits share a key, whatever the bits."""
    rng = np.random.default_rng(0)
    for errors in range(4):
        a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(1) | rng.integers(0, 2, 3000).astype(np.uint64)
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(64, errors, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(bit)
        (ra, ka), (rb, kb) = simhash.fuzzy_keys(a), simhash.fuzzy_keys(b)
        own = set(zip(ra.tolist(), ka.tolist()))
        assert {r for r, k in zip(rb.tolist(), kb.tolist()) if (r, k) in own} == set(range(len(a)))


def test_golay_code_is_perfect():
    upper, patterns, many = simhash._golay()
    assert sorted(set(many.tolist())) == [1, 6] and (many == 6).sum() == 1771
    nearest, _ = simhash.decode(np.arange(1 << 23))
    assert np.bincount(nearest[:, 0], minlength=4096).tolist() == [2048] * 4096


@pytest.mark.parametrize("block", [2048, 16])
def test_dense_groups_are_connected(spark, monkeypatch, block):
    """Groups of many prints within a few bits, cut into blocks or not, keep the components of all links."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(3)
    prints = []
    for _ in range(4):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(120):
            near = centre
            for bit in rng.choice(64, rng.integers(0, 4), replace=False):
                near ^= 1 << int(bit)
            prints.append(near)
    prints += [int(x) for x in rng.integers(0, 1 << 63, 100)] + [0, 0, (1 << 64) - 1]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r.node: r.component for r in components.components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"))).collect()}
    label = {p: p for p in signed}
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3 and label[signed[i]] != label[signed[j]]:
                old, new = label[signed[i]], label[signed[j]]
                label = {k: new if v == old else v for k, v in label.items()}
    want = collections.defaultdict(set)
    for k, v in label.items():
        want[v].add(k)
    found = collections.defaultdict(set)
    for k in signed:
        found[got.get(k, k)].add(k)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_near_duplicate_cases(spark):
    got = collections.defaultdict(list)
    for r in simhash.near_duplicates(odd(spark)).collect():
        got[r.doc_id].append((r.fingerprint, r.component_id))
    assert [got[k][0] for k in (2, 3, 4)] == [("0" * 16, 2)] * 3 and got[7] == [(got[1][0][0], 1)] * 2 and got[None][0][1] is None
    assert simhash.near_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp bigint"), 4)


def test_one_of_each_keeps_one_row(spark, tmp_path):
    odd(spark).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    left = simhash.one_of_each(docs)
    texts = collections.Counter(" ".join((r.text or "").split()) for r in left.collect())
    assert left.columns == docs.columns and max(texts.values()) == 1 and len(texts) == 7


def test_one_of_each_with_another_split(spark, tmp_path, monkeypatch):
    """The files are split in another way between the first scan of the documents and the last."""
    texts = [(k, f"document {k % 30} " + " ".join(f"w{(k % 30) * 97 + j}" for j in range(40))) for k in range(60)]
    documents(spark, texts).repartition(12, "doc_id").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    inner = simhash.near_duplicates

    def then_split(*args, **kwargs):
        out = inner(*args, **kwargs)
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        return out

    monkeypatch.setattr(simhash, "near_duplicates", then_split)
    try:
        left = collections.Counter(r.doc_id % 30 for r in simhash.one_of_each(spark.read.parquet(str(tmp_path / "d"))).collect())
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert docs.count() == 60 and left == dict.fromkeys(range(30), 1)


# stages of the pipeline on odd tables

def clashing(df):
    """Columns whose names the stages use or might use, in several cases."""
    for name in ("_bits", "_word", "_STATS", "_Place", "place", "word", "bits", "kept"):
        df = df.withColumn(name, F.lit("z"))
    return df


def test_stages_with_clashing_names_and_empty_tables(spark):
    docs, labels = clashing(odd(spark)), spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    held = F.col("doc_id") == 99
    stages = [lambda d: quality.accepted(d, labels, held), lambda d: langid.identified(d, held), simhash.one_of_each]
    for step in stages:
        out = step(docs)
        assert out.columns == docs.columns
        rows = out.collect()
        assert len(rows) <= 11 and all(r["_STATS"] == "z" for r in rows)
        assert step(docs.limit(0)).collect() == []
    assert quality.accepted(docs, labels.limit(0), held).count() == 11
    assert langid.identified(docs.withColumn("lang", F.lit(None).cast("string")), held).count() == 0


def test_letters():
    assert not any(map(langid.has_letter, ["", "½ ² ①", "12_3 !?", "Ⅷ ٣"])) and all(map(langid.has_letter, ["½a", "1 é", "日", "ʰ", "ǅ"]))
    trees = langid.build(["en"], np.array([1 << 32 | int.from_bytes(b"abcd", "big")]), np.array([5]))
    assert trees.predict("½ ² ①".encode()) == ("und", 0.0)
