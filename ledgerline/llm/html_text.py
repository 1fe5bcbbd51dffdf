"""Main text of web pages, by container paths that a host's pages agree on.

Every page is read into blocks of text and the containers that hold them. Menus, headers, footers, sidebars, notices,
adverts, forms, reader comments, scripts and styles are left out by their tags, roles, class and id words. Inside an
article a class counts only as a whole (``share-buttons``, not ``popular-science``). The rest of a page is scored: going
down from the body, its container is the deepest one that still holds all text that isn't a list of links. Pages vote
for generalised paths of tags and classes (without digits), one level further where a child has all headings and two
thirds of the text. Votes are counted per host in Spark, as are the pages that have text there. Paths with a tenth of a
host's votes win there, if a fifth of the pages that have them vote for them. On hosts with five pages or more each page
is read again by the winning paths: the one it voted for, else the one with most of its text. Paragraphs that stand
directly in the boxes around a winning path stay. Smaller hosts and pages without a winning path give their own container.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page
order by one space. A null or empty page has an empty text; pages without a host share the empty host; repeated rows
are pages of their own; an empty table gives an empty result; further columns are ignored. Time and memory of a page are
in proportion to its length, however deep it is nested: paths are 64-bit numbers, of which two of one host are equal by
chance once in 10 to the 19. Of paths with equally much text the more voted one counts, then the smaller number.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.urls import split_url
from ledgerline.session import pin

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark output q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("html body main article section div td center".split())
DROPPED = frozenset(
    "head nav aside form script style noscript template iframe svg math canvas object select button textarea dialog menu footer audio "
    "video map datalist title fieldset".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
# An open element of the first kind ends where one of the second begins.
IMPLIED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form note".split())
# Words of class and id that mark what isn't the article.
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
CLUTTER = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion nav navbar navigation "
    "menu menus sidebar aside widget widgets cookie cookies consent gdpr popup modal overlay newsletter subscribe signup sharing "
    "breadcrumb breadcrumbs pagination pager footer toolbar".split()
)
# These are subjects as well: they count only where the whole class is made of such words.
TOPICS = frozenset(
    "notice notices share social related recommended skip copyright tags alert alerts announcement disclaimer trending popular login "
    "discussion responses teaser teasers".split()
)
FILLERS = frozenset(
    "area articles bar block body box button buttons cloud container content count form group icon icons inner item items label left "
    "link links list main media message outer page panel placeholder post posts primary right row secondary section site slot small "
    "stories thread title to top bottom unit wrap wrapper".split()
)
TITLE_BARS = frozenset("header masthead topbar".split())
OWN_PARTS = frozenset("article post entry content story".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>""", re.S
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
LETTERS = re.compile(r"[a-z]+")
HEADINGS = frozenset(("h1", "h2", "h3"))
#: Share of the page's text that marks its one article or main element.
HALF = 0.5
#: A tenth of a host's votes wins. A path that under a fifth of the pages that have it vote for is passed over.
WINS, PASSED = 10, 5
#: Pages of a host below which each gives its own container.
PAGES = 5


@dataclass
class Page:
    """Containers (parent, path, tag) and blocks (container, text, plain, heading) in page order; plain is any text but links."""

    containers: list[tuple[int, int, str]] = field(default_factory=lambda: [(-1, 0, "")])
    blocks: list[tuple[int, str, bool, bool]] = field(default_factory=list)


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def is_clutter(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """Whether an element and all below it is left out."""
    if tag in DROPPED:
        return True
    if tag in ("html", "body"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    names = " ".join((attrs.get("class", ""), attrs.get("id", "")))
    classes = [[w for w in LETTERS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()) if len(w) > 1] for name in names.split()]
    if tag not in INLINE and any(is_whole(words, COMMENTS) for words in classes):
        return True
    if tag in ("main", "article"):
        return False
    if attrs.get("role", "").lower() in ROLES or any(is_whole(words, CLUTTER | TOPICS | COMMENTS) for words in classes):
        return True
    if in_article:
        return False
    found = {w for words in classes for before, w in zip(["", *words], words, strict=False) if before not in ("no", "has", "with", "without")}
    bar = tag == "header" or bool(found & TITLE_BARS)
    return bool(found & CLUTTER) or bar and not found & OWN_PARTS


def is_whole(words: list[str], kind: frozenset[str]) -> bool:
    """Whether a class says nothing but one of these words, with fillers around it."""
    return any(w in kind for w in words) and all(w in kind or w in FILLERS for w in words)


def path_number(above: int, label: str) -> int:
    """Number of the path that goes on from ``above`` with ``label``."""
    return int.from_bytes(blake2b(label.encode(), digest_size=8, key=above.to_bytes(8, "big", signed=True)).digest(), "big", signed=True)


def label(tag: str, attrs: dict[str, str]) -> str:
    """Tag and classes without digits, e.g. ``div.post``."""
    classes = {re.sub(r"[\W\d_]+", "-", c.lower()).strip("-") for c in attrs.get("class", "").split()[:3]} - {""}
    return ".".join([tag, *sorted(classes)])


def read_page(text: str) -> Page:
    """Blocks and containers of a page, clutter left out; unclosed and stray tags are taken as browsers do."""
    page = Page()
    open_: list[tuple[str, int, bool]] = []  # tag, container, in article
    height_of: list[int] = []  # heights of the elements of open_ that aren't inline
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    plain = False
    skipping = -1  # height of the stack where clutter began
    at, raw_end = 0, ""

    def add(piece: str) -> None:
        nonlocal plain
        pieces.append(piece)
        plain = plain or not opened["a"] and any(map(str.isalnum, entities.unescape(piece)))

    def end_block() -> None:
        nonlocal plain
        if pieces:
            body = " ".join(entities.unescape("".join(pieces)).split())
            if body:
                page.blocks.append((open_[-1][1] if open_ else 0, body, plain, any(opened[h] for h in HEADINGS)))
            pieces.clear()
        plain = False

    def close(height: int) -> None:
        nonlocal skipping
        if height_of and height_of[-1] >= height:
            end_block()
        for tag, _, _ in open_[height:]:
            opened[tag] -= 1
        del open_[height:]
        while height_of and height_of[-1] >= height:
            height_of.pop()
        if skipping >= height:
            skipping = -1

    for m in TOKEN.finditer(text):
        name = (m[2] or m[5] or "").lower()
        if raw_end:
            if not (name == raw_end and (m[1] or m[4])):
                continue
            raw_end, at = "", m.end()
            continue
        if m.start() < at:
            continue
        if skipping < 0 and m.start() > at:
            add(text[at : m.start()])
        at = m.end()
        if not name:
            continue
        if m[1] or m[4]:
            if name == "br" or name == "p" and not opened["p"]:
                end_block()
            elif opened[name]:
                close(next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name))
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(text, at)
            if skipping < 0 and name not in ("script", "style", "noscript"):
                end_block()
            if not end:
                at = len(text)
                break
            raw_end, at = name, end.start()
            continue
        if skipping < 0 and name not in INLINE:
            end_block()
        if name in VOID:
            continue
        if name in ENDS_PARAGRAPH:
            if height_of and open_[height_of[-1]][0] == "p":
                close(height_of[-1])
        elif any(opened[t] and name in ends for t, ends in IMPLIED.items()):
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] in ("ul", "ol", "dl", "table", "select"):
                    break
                if name in IMPLIED.get(open_[k][0], ()):
                    close(k)
                    break
        if (m[3] or m[6] or "").endswith("/") and name in ("svg", "math", "path", "use"):
            continue
        above, inside = (open_[-1][1], open_[-1][2]) if open_ else (0, False)
        attrs = attributes(m[3] or m[6]) if (m[3] or m[6] or "").strip(" /") else {}
        if skipping < 0 and is_clutter(name, attrs, inside):
            end_block()
            skipping = len(open_)
        if skipping < 0 and name in CONTAINERS:
            page.containers.append((above, path_number(page.containers[above][1], label(name, attrs)), name))
            above = len(page.containers) - 1
        opened[name] += 1
        if name not in INLINE:
            height_of.append(len(open_))
        open_.append((name, above, inside or name in ("article", "main")))
    if skipping < 0 and not raw_end and at < len(text):
        add(text[at:])
    end_block()
    return page


def weights(page: Page) -> tuple[list[int], list[int]]:
    """Characters of plain blocks, and headings, of every container with all that it holds."""
    n = len(page.containers)
    mass, heads = [0] * n, [0] * n
    for container, body, plain, heading in page.blocks:
        mass[container] += len(body) if plain else 0
        heads[container] += heading
    for k in range(n - 1, 0, -1):
        mass[page.containers[k][0]] += mass[k]
        heads[page.containers[k][0]] += heads[k]
    return mass, heads


def best_containers(page: Page) -> tuple[int, int]:
    """The page's own container and the one it votes for, both found going down from the root.

    The own one is the deepest with all plain text and all headings of the body, or the one article or main element with
    most of a page's text. The vote goes further, to a child that has all headings and two thirds of the text.
    """
    n = len(page.containers)
    mass, heads = weights(page)
    best: dict[int, int] = {}
    for k in range(n - 1, 0, -1):
        parent = page.containers[k][0]
        if mass[k] and (parent not in best or mass[k] >= mass[best[parent]]):
            best[parent] = k
    inside, marked = [False] * n, []
    for k, (parent, _, tag) in enumerate(page.containers):
        inside[k] = parent >= 0 and inside[parent]
        if not inside[k] and tag in ("article", "main"):
            inside[k] = True
            if mass[k]:
                marked.append(k)
    way: set[int] = set()
    if len(marked) == 1 and mass[marked[0]] >= HALF * mass[0]:
        k = marked[0]
        while k >= 0:
            way.add(k)
            k = page.containers[k][0]
    at, own = 0, -1
    while at in best and page.containers[at][2] not in ("article", "main"):
        child = best[at]
        apart = heads[child] < heads[at] and page.containers[at][2] not in ("", "html")
        if child not in way and (apart or mass[child] < mass[at]):
            own = at if own < 0 else own
            if apart or not heads[child] or 3 * mass[child] < 2 * mass[at]:
                break
        at = child
    return (at if own < 0 else own), at


def below(page: Page, chosen: set[int]) -> str:
    """Text of the blocks in the chosen containers, in all containers inside them, and directly in the boxes around them."""
    inside, around = [False] * len(page.containers), set()
    for k, (parent, _, _) in enumerate(page.containers):
        inside[k] = k in chosen or parent >= 0 and inside[parent]
    for k in chosen:
        at = page.containers[k][0] if page.containers[k][2] not in ("article", "main") else -1
        while at >= 0 and at not in around and page.containers[at][2] not in ("", "html", "body"):
            around.add(at)
            at = page.containers[at][0]
    return " ".join(body for container, body, plain, _ in page.blocks if inside[container] or plain and container in around)


def main_text(text: str, paths: list[int]) -> str:
    """Text of the page by the winning paths of its host, or of its own container where it has none of them."""
    page = read_page(text)
    own, vote = best_containers(page)
    mass, held = weights(page)[0], dict.fromkeys(paths, 0)
    for k, (_, path, _) in enumerate(page.containers):
        if path in held:
            held[path] += mass[k]
    path = page.containers[vote][1]
    if path not in held:
        path = max(held, key=held.__getitem__, default=path)
    if not held.get(path):
        return below(page, {own})
    return below(page, {k for k, c in enumerate(page.containers) if c[1] == path})


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: dict[tuple[str, int], list[int]] = {}
        for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if text:
                page = read_page(text)
                if page.blocks:
                    best, mass = page.containers[best_containers(page)[1]][1], weights(page)[0]
                    for path in {best, *(c[1] for c, m in zip(page.containers, mass, strict=True) if m)}:
                        count = votes.setdefault((host, path), [0, 0])
                        count[0] += path == best
                        count[1] += 1
        host, path = ([k[i] for k in votes] for i in (0, 1))
        cast, seen = ([v[i] for v in votes.values()] for i in (0, 1))
        yield pa.RecordBatch.from_pydict({"host": pa.array(host, pa.string()), "path": pa.array(path, pa.int64()), "votes": pa.array(cast, pa.int64()), "seen": pa.array(seen, pa.int64())})


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, paths: those that win there, the most voted first, of hosts with enough pages."""
    votes = pages.select(split_url(F.col("url"))[0].alias("host"), "html").mapInArrow(_votes, "host string, path bigint, votes bigint, seen bigint")
    counted = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("seen").alias("seen"))
    counted = pin(counted.where("votes > 0"), "path-votes")
    cast = counted.groupBy("host").agg(F.sum("votes").alias("cast")).where(F.col("cast") >= PAGES)
    won = counted.join(cast, "host").where((F.col("votes") * WINS >= F.col("cast")) & (F.col("votes") * PASSED >= F.col("seen")))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), F.col("path").alias("p"))))
    return won.groupBy("host").agg(ranked["p"].alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""
    winners = pin(winning_paths(pages), "winning-paths")
    hosted = pages.select("page_id", "url", "html", split_url(F.col("url"))[0].alias("host")).join(winners, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("html", "paths")), strict=True)
            texts = pa.array([main_text(text, paths or []) if text else "" for text, paths in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"])

    fields = {f.name: f for f in pages.schema.fields}
    schema = f"page_id {fields['page_id'].dataType.simpleString()}, url string, text string"
    return hosted.select("page_id", "url", "html", "paths").mapInArrow(run, schema)
