"""Main text of web pages by site template removal.

A page is read into elements; every block element has a hash of its subtree (tags, attributes, texts).
Spark counts on how many pages of its host each hash stands; pages with the same main text are one page, so
that copies of an article do not make it a template.  A subtree that recurs on many pages of the host
belongs to the site's template and is deleted.  Menus and notices whose words change from page to page recur by their
shape: on pages without a marked article, a subtree goes if its skeleton (tags, attributes, place under the root, no texts) recurs on
most such pages of the host and its text is links or short, and it lies outside the element that holds the body.  Hosts with few pages give too few counts, so elements
that say by their tag, class, id or role that they are not content go as well; if an article is marked,
only what is left inside it is the text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.urls import host_of
from panelloom.sources.sinks import stage

MIN_PAGES = 5  # a template stands on at least so many pages of its host
MIN_SHARE = 0.01  # and on this share of them; so a host has at most (blocks of a page and its copies) / MIN_SHARE templates
WITHIN_PAGES, WITHIN_SHARE = 20, 0.5  # the same for subtrees inside an article, where copies and quotations recur too
BODY_PAGES, BODY_SHARE = 10, 0.1  # and for pages without a marked article
SHAPE_PAGES, SHAPE_SHARE = 10, 0.5  # the same for skeletons
LINKED, SHORT = 0.5, 0.25  # whose text is links by this share, or has this share of a page's text at most

# Element names of HTML and words that mark what is not content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul").split())
NO_CONTENT = frozenset((
    "aside button canvas datalist dialog footer form head iframe input map menu nav noembed noframes noscript object script search select style "
    "svg template textarea title xmp").split())
MARKS = frozenset((
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline colophon comment comments complementary contentinfo consent "
    "cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets").split())
# A start tag on the left closes an open element on the right, within the elements that bound the search.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
BOUNDS = frozenset("ul ol dl table select body html article main section div menu".split())
IN_PARAGRAPH = BLOCKS - {"body", "html", "head", "option", "optgroup", "legend", "caption", "tr", "td", "th", "tbody", "thead", "tfoot"}

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
END_OF = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
LABEL = re.compile(r"""\s(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NUMBER = re.compile(r"[0-9]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HIDDEN = re.compile(r"""\shidden(?=[\s=/]|\Z)|\saria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Page:
    """Elements in order of their start; events are a number (start), its complement (end) or a text."""

    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    hashes: list[int] = field(default_factory=list)
    holds: list[bool] = field(default_factory=list)  # an article or main element stands inside
    events: list[int | str] = field(default_factory=list)
    shapes: list[int] = field(default_factory=list)  # hashes of skeletons
    above: list[int] = field(default_factory=list)  # the block element around, or -1
    chars: list[int] = field(default_factory=list)  # of the text inside, without links
    linked: list[int] = field(default_factory=list)  # of links


def read_page(source: str) -> Page:
    """Elements and texts of a page, however malformed; what is never closed ends with the page."""
    page, stack, parts, at = Page(), [], [[]], 0

    def close(count: int) -> None:
        for _ in range(count):
            k = stack.pop()
            own = parts.pop()
            # 63 bits, so that the hash fits a signed long
            digest = xxhash.xxh64_intdigest("\0".join([page.tags[k], page.attributes[k], *own])) >> 1
            page.hashes[k] = digest
            parts[-1].append(str(digest))
            page.events.append(~k)

    def text(raw: str) -> None:
        if raw:
            page.events.append(raw)
            if short := " ".join(raw.split()):
                parts[-1].append(short)

    while (found := TAG.search(source, at)) is not None:
        text(source[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            for depth in range(1, len(stack) + 1):
                open_tag = page.tags[stack[-depth]]
                if open_tag == name:
                    close(depth)
                    break
                if name not in BLOCKS and open_tag in BLOCKS:  # an inline end tag does not close blocks
                    break
            continue
        if name in IN_PARAGRAPH or name in CLOSES:
            ends = CLOSES.get(name, frozenset())
            for depth in range(1, len(stack) + 1):
                open_tag = page.tags[stack[-depth]]
                if open_tag in ends or (open_tag == "p" and name in IN_PARAGRAPH):
                    close(depth)
                    break
                if open_tag in BOUNDS:
                    break
        k = len(page.tags)
        page.tags.append(name)
        page.attributes.append(" ".join((found[3] or found[6] or "").split()))
        page.hashes.append(0)
        page.holds.append(False)
        page.events.append(k)
        if name in ("article", "main"):
            for above in stack:
                page.holds[above] = True
        stack.append(k)
        parts.append([])
        if name in RAW:
            end = END_OF[name].search(source, at)
            stop = end.start() if end else len(source)
            parts[-1].append(source[at:stop])
            at = stop
        elif name in VOID or page.attributes[k].endswith("/"):
            close(1)
    text(source[at:])
    close(len(stack))
    return page


def measure(page: Page) -> Page:
    """Fill in skeletons and text lengths of block elements; a run of equal subtrees, as in a list, counts as one."""
    size = len(page.tags)
    page.shapes, page.above, page.chars, page.linked = [0] * size, [-1] * size, [0] * size, [0] * size
    stack: list[int] = []
    places, inside, unread, links = [0], [[]], 0, 0
    for event in page.events:
        if isinstance(event, str):
            if stack and not unread and (n := len(" ".join(event.split()))):
                (page.linked if links else page.chars)[stack[-1]] += n
            continue
        k = event if event >= 0 else ~event
        name = page.tags[k]
        if name == "a":
            links += 1 if event >= 0 else -1
        elif name in RAW or name == "head":
            unread += 1 if event >= 0 else -1
        if name not in BLOCKS:
            continue
        if event >= 0:
            page.above[k] = stack[-1] if stack else -1
            stack.append(k)
            # a language or class of the whole page does not tell its parts apart
            own = "" if name in ("html", "body") else NUMBER.sub("", page.attributes[k])
            places.append(xxhash.xxh64_intdigest(f"{places[-1]}\0{name}\0{own}"))
            inside.append([])
            continue
        stack.pop()
        own, place = inside.pop(), places.pop()
        digest = xxhash.xxh64_intdigest("\0".join([str(place), *own])) >> 1
        page.shapes[k] = digest
        if not inside[-1] or inside[-1][-1] != str(digest):
            inside[-1].append(str(digest))
        if stack:
            page.chars[stack[-1]] += page.chars[k]
            page.linked[stack[-1]] += page.linked[k]
    return page


def outside_body(page: Page) -> set[int]:
    """Block elements that neither hold the body of a measured page nor stand in it.

    The body is the innermost element, among those that hold blocks, with most of the text that is not links.
    """
    children: dict[int, list[int]] = {}
    for k, above in enumerate(page.above):
        if page.tags[k] in BLOCKS:
            children.setdefault(above, []).append(k)
    free: set[int] = set()
    held = children.get(-1, [])
    total = sum(page.chars[k] for k in held)
    while True:
        body = next((k for k in held if 2 * page.chars[k] > total and k in children), None)
        if body is None:
            break
        free.update(k for k in held if k != body)
        held, total = children[body], page.chars[body]
    todo = list(free)
    while todo:
        below = children.get(todo.pop(), [])
        free.update(below)
        todo.extend(below)
    return {k for k in free if page.tags[k] not in HEADINGS and page.tags[k] not in ("head", "html", "body")}


def no_content(page: Page, k: int, within: bool) -> bool:
    """Whether an element says of itself that it is not content; `within`: it stands inside an article."""
    name, attributes = page.tags[k], page.attributes[k]
    if name in ("html", "body", "article", "main") or page.holds[k]:
        return name in ("article", "main") and bool(attributes) and _marked(attributes)
    if name in NO_CONTENT or name == "header" and not within:
        return True
    return bool(attributes) and (_marked(attributes) or HIDDEN.search(" " + attributes) is not None)


def _marked(attributes: str) -> bool:
    return any(not MARKS.isdisjoint(WORD.findall((a or b or c).lower())) for a, b, c in LABEL.findall(" " + attributes))


def main_text(page: Page, common: set[int], body: set[int], within: set[int], shapes: set[int] | frozenset[int] = frozenset()) -> str:
    """Blocks that are left, one per line.

    `common`, `body` and `within` are hashes of templates: outside an article, on pages without one, inside one.  `shapes` are
    skeletons of templates, for pages without an article.
    """
    blocks: list[tuple[str, str]] = []
    current: list[str] = []
    scopes: list[tuple[str, int]] = []
    marked = [k for k, name in enumerate(page.tags) if name in ("article", "main")]
    outside = common if marked else body
    framed: set[int] = set()
    if shapes and not marked:
        measure(page)
        framed = {k for k in outside_body(page) if page.shapes[k] in shapes}
    skip = -1

    def flush() -> None:
        if current:
            if words := " ".join("".join(current).split()):
                names = {name for name, _ in scopes}
                blocks.append((words, "article" if "article" in names else "main" if "main" in names else ""))
            current.clear()

    for event in page.events:
        if isinstance(event, str):
            if skip < 0:
                current.append(entities.unescape(event) if "&" in event else event)
        elif event >= 0:
            if skip >= 0:
                continue
            name = page.tags[event]
            if name in BLOCKS:
                flush()
            elif name == "br":
                current.append(" ")
            known = page.hashes[event] in (within if scopes else outside)
            if event in framed or known and not page.holds[event] and name not in ("html", "body", "article", "main", "br") or no_content(page, event, bool(scopes)):
                skip = event
            elif name in ("article", "main"):
                scopes.append((name, event))
        else:
            k = ~event
            if skip >= 0:
                if k == skip:
                    skip = -1
                continue
            if page.tags[k] in BLOCKS:
                flush()
            if scopes and scopes[-1][1] == k:
                scopes.pop()
    flush()
    for scope in ("article", "main"):
        if any(s == scope for _, s in blocks):
            return "\n".join(words for words, s in blocks if s == scope)
    return "\n".join(words for words, _ in blocks)


def templates(pages: DataFrame) -> DataFrame:
    """(host, found, pages, shapes): per host the subtrees that recur, with the number of its pages that have them, and skeletons of templates.

    Rows whose text is the same before any template is deleted are one page, here and in `pages`.  Hashes are
    counted per host and subtree, partial counts first, so that a host of any size is spread over all
    tasks.  Only subtrees above MIN_SHARE and skeletons above SHAPE_SHARE are gathered per host, which bounds their number.
    """

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # hosts, hashes (None stands for the page itself), whether of a skeleton, texts' hashes, characters, those of links
            rows: tuple[list, ...] = ([], [], [], [], [], [])

            def add(found: dict, shape: bool, rows=rows) -> None:
                for out, values in zip(rows, ([host] * len(found), found, [shape] * len(found), [content] * len(found), *zip(*found.values()))):
                    out.extend(values)

            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = read_page(source or "")
                content = xxhash.xxh64_intdigest(main_text(page, set(), set(), set())) >> 1
                own = {page.hashes[k] for k, name in enumerate(page.tags) if name in BLOCKS and name not in ("html", "body", "head")}
                add({None: (0, 0), **dict.fromkeys(own, (0, 0))}, False)
                if not any(name in ("article", "main") for name in page.tags):
                    measure(page)
                    whole = [sum(n[k] for k, above in enumerate(page.above) if above < 0) for n in (page.chars, page.linked)]
                    add({None: tuple(whole), **{page.shapes[k]: (page.chars[k], page.linked[k]) for k in outside_body(page)}}, True)
            yield pa.record_batch([pa.array(x, t) for x, t in zip(rows, (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()))],
                                  names=["host", "hash", "shape", "content", "chars", "linked"])

    rows = pages.where("host <> ''").select("host", "html").mapInArrow(hashes, "host string, hash bigint, shape boolean, content bigint, chars bigint, linked bigint")
    once = rows.groupBy("host", "shape", "hash", "content").agg(F.max("chars").alias("chars"), F.max("linked").alias("linked"))
    counts = once.groupBy("host", "shape", "hash").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    counts = stage(counts.where((F.col("n") >= MIN_PAGES) | F.col("hash").isNull()))
    totals = counts.where("hash is null").select("host", "shape", F.col("n").alias("pages"), F.col("chars").alias("text"))
    each = counts.where("hash is not null").join(totals, ["host", "shape"])
    text = F.col("chars") + F.col("linked")
    frame = (F.col("linked") >= LINKED * text) | (F.col("chars") * F.col("pages") <= SHORT * F.col("text") * F.col("n"))
    wanted = F.when(F.col("shape"), (F.col("n") >= SHAPE_PAGES) & (F.col("n") >= SHAPE_SHARE * F.col("pages")) & frame).otherwise(F.col("n") >= MIN_SHARE * F.col("pages"))
    entry = F.struct("hash", F.col("n").cast("double").alias("n"))
    return each.where(wanted).groupBy("host").agg(
        F.collect_list(F.when(~F.col("shape"), entry)).alias("found"), F.max(F.when(~F.col("shape"), F.col("pages"))).cast("double").alias("pages"),
        F.collect_list(F.when(F.col("shape"), F.col("hash"))).alias("shapes"))


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every page.

    Null html counts as empty; a page without any text left has an empty one.  Character references are
    decoded, white space inside a block is one space.  A null url has no host, so no templates.  Repeated
    rows and other copies of a text count as one page and give a row each; other columns are ignored; an empty table gives
    no rows.
    """
    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"),
                        host_of(F.col(url)).alias("host"))
    joined = rows.join(stage(templates(rows)), "host", "left").select("page_id", "url", "html", "host", "found", "pages", "shapes")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[set[int], set[int], set[int], set[int]]] = {}
        for batch in batches:
            found, shapes, texts = batch.column(4), batch.column(6), []
            starts = found.offsets.to_numpy()
            every, n = found.values.field("hash").to_numpy(), found.values.field("n").to_numpy()
            for i, (source, host, total) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(5).to_pylist())):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    own, count = every[starts[i] : starts[i + 1]], n[starts[i] : starts[i + 1]]
                    total = total or 1.0
                    known[host] = (set(own.tolist()), set(own[(count >= BODY_PAGES) & (count >= BODY_SHARE * total)].tolist()),
                                   set(own[(count >= WITHIN_PAGES) & (count >= WITHIN_SHARE * total)].tolist()),
                                   set(shapes[i].as_py() or ()))
                texts.append(main_text(read_page(source or ""), *known[host]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
