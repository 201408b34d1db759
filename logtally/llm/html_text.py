"""Main text of web pages by consensus of their host's pages.

First pass: each page is read into its containers and votes for the path of the innermost one that holds at least half of the
page's text, links and what is marked as no article left out; a path is the chain of tags and classes with all numbers made
alike. Votes are added up in Spark, and the path with most votes of each host wins, by text held and then by its hash where votes
are even. Second pass: each page is cut at its host's path, or at its own one if it hasn't got that, into the article and
what lies outside of it: whole containers, and single blocks of the containers around it. A container outside is left out where
its path is known for that on the host: it is on two different pages or more, and its texts are mostly links, or at most half
of them differ; a single block where another page has the same. All else is kept, in page order, so a page whose article goes
beyond the host's path keeps all of it.

Text is cut into blocks at block-level tags. References are decoded, white space in a block (line breaks too) becomes one
space, blocks without text go. Elements that never hold the article (navigation, headers and footers but for those of an article or
main element, forms, scripts, ...) or are named for it by class, id or role are left out with all that they enclose. A name
counts as a whole, numbers and words like ``list`` or ``left`` at its end aside. Broken markup is read on: a tag that isn't closed
ends with what encloses it, a closing tag without an opening one is ignored.

Null or empty html gives an empty text; a null url is a host of its own. Pages may be of any length. Repeated rows vote as often
as they occur, but copies of a page are one page where it is asked what pages repeat. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.tables import BROADCAST_IDS, look_up, saved

#: A container is voted for from this part of its page's text on.
LEAST_SHARE = 0.5

_TOKEN = re.compile(r"""<!--.*?-->|<!--.*|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""", re.DOTALL)
_NAMED = re.compile(r"""\b(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)

# Element names of the HTML standard, and names by which pages mark what isn't the article.
_RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title".split())
_NEVER = frozenset("head nav header footer aside form button select menu dialog svg math canvas object audio video".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = frozenset(
    "html body div section article main p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote "
    "pre figure figcaption address center fieldset details summary hgroup search".split()
)
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption summary caption address".split())
_CLOSES = {
    "p": ({"p"}, set()), "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_WHOLE = frozenset("html body main article".split())
_OWN_HEADS = frozenset("header footer".split())
_ENDINGS = frozenset("list box block section container wrapper wrap area left right top bottom inner outer item items panel module row bar".split())
_MARKS = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar aside ad ads advert adverts advertisement sponsor sponsored promo "
    "banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup comment comments disqus reply replies "
    "share sharing social related recommended breadcrumb breadcrumbs pagination widget contentinfo complementary "
    "related-posts related-articles related-links related-stories see-also read-more social-media social-links".split()
)


class Node:
    """An open or closed container: its path as a chain of hashes, and the blocks from ``first`` to before ``last``."""

    __slots__ = ("tag", "path", "depth", "first", "last", "out")

    def __init__(self, tag: str, path: int, depth: int, first: int, out: bool) -> None:
        self.tag, self.path, self.depth, self.first, self.last, self.out = tag, path, depth, first, first, out


def _is_mark(name: str) -> bool:
    """Whether a class name says by itself, or by the word it is made up around, that this is no part of an article."""
    words = [w for w in re.split("[^a-z]+", name) if w]
    if "-".join(words) in _MARKS:
        return True
    while len(words) > 1 and words[-1] in _ENDINGS:
        words.pop()
    return bool(words) and words[-1] in _MARKS


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """Tag with generalised class or id; whether the names mark it as no part of an article."""
    names, marked = "", False
    if attributes:
        found: dict[str, str] = {}
        for m in _NAMED.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        marked = "hidden" in found
        names = re.sub(r"\d+", "0", " ".join(sorted(found.get("class", "").lower().split())) or found.get("id", "").lower())
        if tag not in _WHOLE:
            marked |= any(_is_mark(w) for k in ("class", "id", "role") for w in found.get(k, "").lower().split())
    return f"{tag}.{names}", marked


def parse(html: str) -> tuple[list[str], list[int], list[Node]]:
    """Blocks outside of what never is article, how much of each is not in links, and all containers."""
    blocks: list[str] = []
    plain: list[int] = []
    root = Node("", 0, 0, 0, False)
    nodes, stack = [root], [root]
    text: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            if block := " ".join(entities.unescape("".join(text)).split()):
                blocks.append(block)
                plain.append(max(0, len(block) - linked))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        flush()
        while len(stack) > depth:
            stack.pop().last = len(blocks)

    at = 0
    while True:
        m = _TOKEN.search(html, at)
        end = m.start() if m else len(html)
        if end > at and not stack[-1].out:
            text.append(html[at:end])
            linked += (end - at) * bool(links)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in _RAW:
            if not m[1]:
                done = re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(html, at)
                at = done.end() if done else len(html)
            continue
        if tag == "br" or tag == "hr":
            text.append(" ") if tag == "br" else flush()
            continue
        if tag in _VOID:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in _BLOCKS or tag in _NEVER or tag == "span":
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if depth:
                    if tag == "span":
                        stack.pop() if depth == len(stack) - 1 else None
                    else:
                        close(depth)
                elif tag != "span":
                    flush()
            continue
        if tag == "a":
            links += 1
            continue
        label, marked = _label(tag, m[3])
        if tag not in _BLOCKS and tag not in _NEVER:
            if not marked or m[3].endswith("/"):
                continue
            tag = "span"  # an inline element that is marked
        elif tag in _NEVER and m[3].endswith("/"):
            continue
        if tag != "span":
            flush()
            own, until = _CLOSES.get(tag, (set(), set()))
            if tag in _BLOCKS and tag != "p" and stack[-1].tag == "p":
                own, until = own | {"p"}, until
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in own:
                    close(i)
                    break
                if stack[i].tag in until or stack[i].tag not in _LEAVES and stack[i].tag not in own | {"tr", "td", "th"}:
                    break
        above = stack[-1]
        path = xxhash.xxh3_64_intdigest(label.encode("utf-8", "replace"), seed=above.path)
        never = tag in _NEVER
        if never and tag in _OWN_HEADS and any(n.tag in ("article", "main") for n in stack):
            never = False
        node = Node(tag, path, above.depth + 1, len(blocks), above.out or marked or never)
        stack.append(node)
        if tag not in _LEAVES and tag != "span" and not node.out:
            nodes.append(node)
    close(0)
    return blocks, plain, nodes


def own_path(plain: list[int], nodes: list[Node], least: float = LEAST_SHARE) -> tuple[int, float] | None:
    """The path of the innermost container with so much of the page's text, and how much it holds; None without text."""
    before = [0]
    for n in plain:
        before.append(before[-1] + n)
    if not before[-1]:
        return None
    held: dict[int, int] = defaultdict(int)
    depth: dict[int, int] = {}
    for n in nodes:
        held[n.path] += before[n.last] - before[n.first]
        depth[n.path] = n.depth
    best = max((p for p, h in held.items() if h >= least * before[-1]), key=lambda p: (depth[p], held[p], p))
    return best, min(1.0, held[best] / before[-1])


def _signed(path: int) -> int:
    return path - 2**64 if path >= 2**63 else path


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        votes: dict[tuple[str, int], list[float]] = defaultdict(lambda: [0.0, 0])
        for host, html in zip(batch["host"], batch["html"], strict=True):
            _, plain, nodes = parse(html)
            if own := own_path(plain, nodes):
                votes[host, _signed(own[0])][0] += own[1]
                votes[host, _signed(own[0])][1] += 1
        yield pd.DataFrame([(h, p, s, n) for (h, p), (s, n) in votes.items()], columns=["host", "path", "score", "pages"])


class Piece(NamedTuple):
    """Blocks of the article (no path), or of a container, or one block of a container, outside of it."""

    path: int | None
    mark: int
    links: bool
    text: str


def cut(html: str, path: int | None) -> list[Piece]:
    """A page's text in order: what stands at the path, or else at the page's own one, and what lies outside."""
    blocks, plain, nodes = parse(html)
    if all(_signed(n.path) != path for n in nodes):
        own = own_path(plain, nodes)
        path = _signed(own[0]) if own else _signed(nodes[0].path)
    inside: list[tuple[int, int]] = []
    for n in nodes:
        if _signed(n.path) == path and n.first < n.last and (not inside or n.first >= inside[-1][1]):
            inside.append((n.first, n.last))
    if not inside:
        inside = [(0, len(blocks))]
    starts = [first for first, _ in inside]
    pieces: list[tuple[int, int, int | None]] = [(first, last, None) for first, last in inside]
    around: dict[int, int] = {}
    done = 0
    for n in nodes:
        if n.first == n.last:
            continue
        k = bisect_left(starts, n.first)
        if (k and n.last <= inside[k - 1][1]) or (k < len(inside) and inside[k][0] <= n.first and n.last <= inside[k][1]):
            continue  # in the article
        if k < len(inside) and inside[k][0] < n.last:
            for i in range(n.first, n.last):  # around it; the innermost one comes last
                around[i] = n.path
        elif n.first >= done:
            pieces.append((n.first, n.last, n.path))
            done = n.last
    taken = sorted((first, last) for first, last, _ in pieces)
    at = 0
    for first, last in [*taken, (len(blocks), len(blocks))]:
        # A single block is known by its text, for a container can have the article's headline beside what pages repeat.
        pieces += [(i, i + 1, xxhash.xxh3_64_intdigest(blocks[i].encode("utf-8", "surrogatepass"), seed=around.get(i, 0))) for i in range(at, first)]
        at = max(at, last)
    out = []
    for first, last, of in sorted(pieces, key=lambda x: x[:2]):
        text = "\n".join(blocks[first:last])
        if text:
            mark = _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))
            out.append(Piece(None if of is None else _signed(of), mark, 2 * sum(plain[first:last]) < len(text), text))
    return out


def article(html: str, path: int | None) -> str:
    """The text of a page by itself, all that lies outside of the path included."""
    return "\n".join(piece.text for piece in cut(html, path))


def _cut_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pieces = [cut(h, int(p) if p else None) for h, p in zip(batch["html"], batch["path"], strict=True)]
        rows = [[piece._asdict() for piece in page] for page in pieces]
        yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "host": batch["host"], "page": batch["page"], "pieces": rows})


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path and the number of pages that ask for it."""
    votes = pages.select("host", "html").mapInPandas(_votes, "host string, path long, score double, pages long")
    votes = votes.groupBy("host", "path").agg(F.sum(F.col("score").cast("decimal(38,9)")).alias("score"), F.sum("pages").alias("pages"))
    best = votes.groupBy("host").agg(F.max(F.struct("pages", "score", "path")).alias("best"), F.sum("pages").alias("asked"))
    return best.select("host", F.col("best.path").alias("path"), "asked")


def left_out(outside: DataFrame) -> DataFrame:
    """host, path, asked of what hosts repeat beside their articles; ``outside`` has a row per page and piece: host, path, mark, links."""
    texts = outside.groupBy("host", "path", "mark").agg(F.count("*").alias("n"), F.count_if("links").alias("links"))
    paths = texts.groupBy("host", "path").agg(F.sum("n").alias("asked"), F.count("*").alias("texts"), F.sum("links").alias("links"))
    return paths.where("asked >= 2 AND (2 * texts <= asked OR 2 * links > asked)").select("host", "path", "asked")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), "^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    paths = saved(winning_paths(pages), "paths")
    if paths.count() <= BROADCAST_IDS:
        found = pages.join(F.broadcast(paths.drop("asked")), "host", "left")
    else:
        found = look_up(pages, paths, ["host"], "asked")
    schema = "page_id long, url string, host string, page long, pieces array<struct<path:long, mark:long, links:boolean, text:string>>"
    # As text: pandas has whole numbers with nulls as floats, which would not hold every path.
    rows = found.select("page_id", "url", "html", F.xxhash64("html").alias("page"), "host", F.col("path").cast("string").alias("path")).mapInPandas(_cut_pages, schema)
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    outside = rows.where(F.exists("pieces", lambda p: p["path"].isNotNull())).select("row", "host", "page", F.posexplode("pieces").alias("place", "p"))
    outside = saved(outside.where("p.path IS NOT NULL").select("row", "place", "host", "page", "p.path", "p.mark", "p.links"), "outside")
    known = saved(left_out(outside.select("host", "path", "mark", "links", "page").distinct()), "left-out")
    if known.isEmpty():
        kept = rows.withColumn("gone", F.array().cast("array<int>"))
    else:
        gone = look_up(outside.select("row", "place", "host", "path"), known, ["host", "path"], "asked").where("asked IS NOT NULL")
        kept = rows.join(gone.groupBy("row").agg(F.collect_list("place").alias("gone")), "row", "left")
    stays = F.filter("pieces", lambda p, i: p["path"].isNull() | ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    text = F.array_join(F.transform(stays, lambda p: p["text"]), "\n")
    return kept.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
