"""Main text of web pages by the template that pages of a host share.

Tokens of a page are its containers, told apart by their path (tag with class or id),
and its blocks of text, told apart by path and words. Over the different pages of a
host, a token's occurrence vector says how often each page holds it. Tokens of equal
vectors form a class. A class is a template's if it has at least ``LEAST_TOKENS``
tokens, on at least ``LEAST_PAGES`` pages and half of the host's, if its tokens
come in one order on all pages, and if it lies in one gap of the class around it, the
same everywhere. Vectors are kept as sums of hashes, and order and nesting are worked
out page by page, so that a host's pages never meet in one task.

The containers of valid classes are the template's slots, its texts are boilerplate.
Where a page names its article, that part is extracted whole, as nothing of an article
may go. Elsewhere the template decides: all slots that hold more text than links, without
the boilerplate. Parts that are named as menus, notices, forms or comments never count.

Defined results: null html is an empty text. Pages without a host share the empty
host. A page without a named article on which all slots are empty gives all text that
is not in a marked part. Repeated pages count once for the template and are extracted each. Containers
deeper than ``DEEPEST`` share the path of the one at that depth; no text is lost by
that, and time grows with a page's length alone. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.url_reputation import split_url
from fleetgauge.session import stored

#: Fixed values of HTML: elements without content, raw text, elements not shown, and blocks.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title".split())
HIDDEN = set("template noscript iframe svg canvas object select".split())
BLOCKS = set(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
SIDE = set("nav header footer aside form head menu dialog button".split())
ITEMS = set("li dt dd td th tr option".split())
CONTAINERS = BLOCKS - ITEMS - set("p h1 h2 h3 h4 h5 h6".split())
NEVER_SIDE = set("html body main".split())
#: Names of a class or id, or all words of one, that mark a part as not the article's.
SIDE_WORDS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie "
    "cookies consent disqus footer header login menu modal nav navbar navigation newsletter notice "
    "notices notification pagination popup promo promoted related reply replies respond share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that may stand beside a marking word in one name.
BESIDE = set(
    "area bar block bottom box buttons container inner left links list main page posts right "
    "section site slot thread top unit wrap wrapper".split()
)
#: Names of the article itself; beside one of these, no other name marks a part.
MAIN_NAMES = set("main main-content maincontent article article-body entry-content post-content".split())
CONTENT_NAMES = MAIN_NAMES | set("content entry post story".split())

LEAST_PAGES = 3
LEAST_TOKENS = 2
DEEPEST = 40

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_NO_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>", re.S)
_CLOSE = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class Element(NamedTuple):
    tag: str
    path: str = ""
    depth: int = 0
    side: bool = False
    main: bool = False
    hidden: bool = False


class Block(NamedTuple):
    place: int
    path: str
    side: bool
    main: bool
    text: str
    links: int


def _marks(name: str) -> bool:
    words = [w for w in re.split(r"[_-]+", name) if w]
    return any(w in SIDE_WORDS for w in words) and all(w in SIDE_WORDS or w in BESIDE for w in words)


def _child(parent: Element, tag: str, attributes: str) -> Element:
    found = (n[2] or n[3] or n[4] or "" for n in _NAMED.finditer(attributes))
    names = sorted({w for value in found for w in value.lower().split()})
    side = tag in SIDE and not (tag == "header" and parent.main)
    if tag not in NEVER_SIDE and not CONTENT_NAMES.intersection(names):
        side = side or any(map(_marks, names))
    path, depth = parent.path, parent.depth
    if tag in CONTAINERS and depth < DEEPEST:
        path = f"{path}/{'.'.join([tag, *(n for n in names if not any(map(str.isdigit, n)))])}"
        depth += 1
    main = parent.main or tag in ("article", "main") or bool(MAIN_NAMES.intersection(names))
    return Element(tag, path, depth, parent.side or side, main, parent.hidden or tag in HIDDEN)


def read_page(page: str) -> tuple[list[Block], list[tuple[int, Element]]]:
    """Blocks of text and opened containers of a page, with their places in it."""
    blocks: list[Block] = []
    opened: list[tuple[int, Element]] = []
    stack = [Element("")]
    holds: Counter[str] = Counter()
    parts: list[str] = []
    links = 0
    place = 0
    lower = page.lower()
    closed = {tag: lower.rfind(f"</{tag}") for tag in HIDDEN}
    last = page.rfind(">")
    tags = _TAG

    def flush() -> None:
        nonlocal links, place
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            place += 1
            blocks.append(Block(place, stack[-1].path, stack[-1].side, stack[-1].main, text, links))
        parts.clear()
        links = 0

    def cut(at: int) -> None:
        holds.subtract(e.tag for e in stack[at:])
        del stack[at:]

    at = 0
    while at < len(page):
        if page[at] != "<" or at > last:
            end = page.find("<", at + 1)
            end = len(page) if end < 0 or at > last else end
            if not stack[-1].hidden:
                parts.append(page[at:end])
                links += end - at if holds["a"] > 0 else 0
            at = end
            continue
        if skipped := _NO_TAG.match(page, at):
            at = skipped.end()
            continue
        found = tags.match(page, at)
        if not found and (found := _PLAIN_TAG.match(page, at)):
            tags = _PLAIN_TAG  # a quote is left open: from here on, the next > ends a tag
        if not found:
            if not stack[-1].hidden:
                parts.append("<")
            at += 1
            continue
        at = found.end()
        closing, tag = bool(found[1]), found[2].lower()
        if tag in RAW and not closing:
            close = _CLOSE[tag].search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag in BLOCKS:
            flush()
        elif tag in VOID:
            parts.append(" ")
        if closing:
            if holds[tag] > 0:
                cut(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in VOID or found[3].endswith("/") or tag in HIDDEN and closed[tag] < at:
            continue
        if tag in BLOCKS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" or stack[i].tag == tag and tag in ITEMS:
                    cut(i)
                    break
                if stack[i].tag in CONTAINERS:
                    break
        stack.append(_child(stack[-1], tag, found[3]))
        holds[tag] += 1
        if tag in CONTAINERS:
            place += 1
            opened.append((place, stack[-1]))
    flush()
    return blocks, opened


def text_token(path: str, text: str) -> int:
    """A block's text at its path as a 64-bit number."""
    digest = hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "replace"), digest_size=8)
    return int.from_bytes(digest.digest(), "big", signed=True)


#: path is null where a token is a text.
TOKEN = pa.struct(
    [
        ("token", pa.int64()),
        ("path", pa.string()),
        ("side", pa.bool_()),
        ("n", pa.int32()),
        ("first", pa.int32()),
        ("last", pa.int32()),
        ("chars", pa.int64()),
        ("links", pa.int64()),
    ]
)
TOKENS = (
    "host string, key long, tokens array<struct<token: long, path: string, side: boolean, "
    "n: int, first: int, last: int, chars: long, links: long>>"
)


def page_tokens(page: str) -> list[dict]:
    """Tokens of a page with their counts and places; a container's are its own blocks' sizes."""
    blocks, opened = read_page(page)
    found: dict[int, dict] = {}

    def add(token: int, place: int, path: str | None, side: bool) -> None:
        entry = found.setdefault(
            token, dict(token=token, path=path, side=side, n=0, first=place, last=place, chars=0, links=0)
        )
        entry["n"] += 1
        entry["last"] = place

    for place, e in opened:
        add(text_token(e.path, ""), place, e.path, e.side)
    for b in blocks:
        container = found.get(text_token(b.path, ""))
        if container:
            container["chars"] += len(b.text)
            container["links"] += b.links
        add(text_token(b.path, b.text), b.place, None, b.side)
    return list(found.values())


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = [page_tokens(page or "") for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("key"), pa.array(tokens, pa.list_(TOKEN))],
            names=["host", "key", "tokens"],
        )


def places_of_classes(tokens: list[dict], classes: dict[int, int]) -> list[tuple[int, int, int, bool]]:
    """Each class on a page: the order of its tokens, the gap that it lies in, and whether it crosses one."""
    here = sorted((t["first"], t["last"], t["token"]) for t in tokens if t["token"] in classes)
    ends: dict[int, int] = {}
    order: dict[int, list[int]] = {}
    for _, last, token in here:
        of = classes[token]
        ends[of] = max(last, ends.get(of, last))
        order.setdefault(of, []).append(token)
    seen: Counter[int] = Counter()
    gaps: dict[int, int] = {}
    crossing: set[int] = set()
    around: list[int] = []
    for first, _, token in here:
        of = classes[token]
        while around and ends[around[-1]] < first:
            around.pop()
        if of not in seen:
            gaps[of] = hash((around[-1], seen[around[-1]])) if around else 0
            around.append(of)
        elif around[-1] != of:
            crossing.update(around[around.index(of) + 1 :])
        seen[of] += 1
    return [(of, hash(tuple(order[of])), gaps[of], of in crossing) for of in order]


CLASSES = "host string, vector long, order long, gap long, crosses boolean"


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("vector", pa.int64()), ("order", pa.int64()), ("gap", pa.int64()), ("crosses", pa.bool_())])
    for batch in batches:
        rows = []
        for host, tokens, members in zip(*(batch.column(c).to_pylist() for c in ("host", "tokens", "members"))):
            classes = {m["token"]: m["vector"] for m in members}
            rows += [(host, *place) for place in places_of_classes(tokens, classes)]
        columns = zip(*rows) if rows else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


#: Copies of each host's template, so that the pages of a large host are spread over as many tasks.
SALTS = 64


def _salted(pages: DataFrame) -> DataFrame:
    return pages.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int"))


def _copied(hosts: DataFrame) -> DataFrame:
    return hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def templates(pages: DataFrame) -> DataFrame:
    """host, the paths of its slots that hold text, and the boilerplate's tokens.

    A host's row holds tokens of at least half of its pages, so at most twice as many as
    a page has on average.
    """
    rows = pages.select("host", "key", "html").mapInArrow(_tokens, TOKENS).where("size(tokens) > 0")
    rows = stored(rows.dropDuplicates(["host", "key"]), "page-tokens")
    sizes = rows.groupBy("host").agg(F.count("*").alias("pages"))
    entry = F.xxhash64("key", "n").cast("decimal(20,0)")
    tokens = (
        rows.select("host", "key", F.inline("tokens"))
        .groupBy("host", "token")
        .agg(
            F.count("*").alias("support"),
            F.xxhash64(F.sum(entry)).alias("vector"),
            F.max("path").alias("path"),
            F.max("side").alias("side"),
            F.sum("chars").alias("chars"),
            F.sum("links").alias("links"),
        )
    )
    frequent = tokens.join(sizes, "host").where(f"support >= {LEAST_PAGES} AND 2 * support >= pages")
    frequent = stored(frequent.drop("pages", "support"), "page-classes")
    large = frequent.groupBy("host", "vector").count().where(f"count >= {LEAST_TOKENS}")
    frequent = frequent.join(large.drop("count"), ["host", "vector"])

    members = frequent.groupBy("host").agg(F.collect_list(F.struct("token", "vector")).alias("members"))
    valid = (
        _salted(rows)
        .join(_copied(members), ["host", "salt"])
        .select("host", "tokens", "members")
        .mapInArrow(_classes, CLASSES)
        .groupBy("host", "vector")
        .agg(
            (F.min("order") == F.max("order")).alias("ordered"),
            (F.min("gap") == F.max("gap")).alias("nested"),
            F.max("crosses").alias("crosses"),
        )
        .where("ordered AND nested AND NOT crosses")
        .select("host", "vector")
    )
    filled = ~F.col("side") & (F.col("chars") > 2 * F.col("links"))
    return (
        frequent.join(valid, ["host", "vector"])
        .groupBy("host")
        .agg(
            F.collect_set(F.when(filled, F.col("path"))).alias("slots"),
            F.collect_set(F.when(F.col("path").isNull(), F.col("token"))).alias("shared"),
        )
    )


def main_text(page: str | None, slots: list[str] | None, shared: list[int] | None) -> str:
    """Text of a page's named article, else of its slots, one line for each block."""
    kept = [b for b in read_page(page or "")[0] if not b.side]
    inside = [b for b in kept if b.main]
    if not inside and slots:
        held, boilerplate = set(slots), set(shared or ())
        inside = [b for b in kept if b.path in held and text_token(b.path, b.text) not in boilerplate]
    return "\n".join(b.text for b in inside or kept)


EXTRACTED = "page_id long, url string, text string"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("html", "slots", "shared"))
        texts = [main_text(*row) for row in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its length of every page."""
    rows = split_url(pages.select("page_id", "url", "html"))
    found = templates(rows.withColumn("key", F.xxhash64("html")))
    salted = _salted(rows.withColumn("key", F.xxhash64("page_id", "html")))
    joined = salted.join(_copied(found), ["host", "salt"], "left")
    texts = joined.select("page_id", "url", "html", "slots", "shared").mapInArrow(_extract, EXTRACTED)
    return texts.withColumn("n_chars", F.length("text").cast("long"))
