"""Main text of web pages by removing the template of each site.

Every page is parsed in its task into blocks of text, each with the hashes of the containers it
stands in. A container's hash covers its whole subtree. Spark counts on how many different pages of
the host each hash occurs; containers that recur on several are the site's template and go, with what
they hold. Pages with the same main part are one page, however often and under whatever address it
is met. What is left loses the parts that their markup itself declares to be no article
(navigation, forms, adverts, comments and so on), and text outside the article, if there is one.

Paragraphs, headings, the article itself and what is inside it are never taken for template: a
passage, list or table that many articles share is still part of each. On a page without article
markup that holds for the innermost container with more than half of the text, for what it stands
in, and for lists, tables and figures inside it.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import map_batches, staged, table

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_SPACE = re.compile(r"\s+")
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")

_words = lambda text: frozenset(text.split())
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style textarea title xmp iframe noembed noframes")
INLINE = _words("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                "span strike strong sub sup time tt u var wbr")
CONTAINERS = _words("div section ul ol dl table aside nav header footer form figure menu details fieldset center")
MAIN = _words("article main")
#: Containers that are part of the text around them.
CONTENT = _words("ul ol dl table figure")
#: Elements that never hold article text.
DROPPED = _words("head script style noscript template iframe object svg canvas audio video map math nav footer aside form button "
                 "select textarea input dialog menu noembed noframes")
ROLES = _words("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar")
#: Parts of class and id names that declare a box to be no article.
LABELS = _words("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside widget "
                "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc header masthead footer copyright cookie cookies "
                "consent gdpr notice notices alert popup modal overlay comment comments discussion disqus replies respond share "
                "sharing social newsletter subscribe signup login search related recommended")
COMMENTS = _words("comment comments discussion disqus replies respond")
#: A start tag on the left ends an open element on the right, unless an element after the bar is in between.
CLOSES_P = _words("address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                  "main menu nav ol p pre section table ul")
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
        "th": ("td th", "tr table"), "option": ("option", "select"), "tbody": ("thead tbody tfoot tr td th", "table"),
        "tfoot": ("thead tbody tfoot tr td th", "table"), "body": ("head", "html")}
ENDS = {k: (_words(a), _words(b)) for k, (a, b) in ENDS.items()}


class _Element:
    __slots__ = ("tag", "digest", "owner", "refused", "main", "number")

    def __init__(self, tag, attributes, parent):
        self.tag = tag
        self.number = None
        self.main = bool(parent and parent.main) or tag in MAIN
        # 2: no article whatever is inside; 1: unless an article begins inside, as in a box named after its neighbour.
        self.refused = 2 if tag in DROPPED else parent.refused if parent else 0
        names = ""
        if attributes:
            named = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
            names = f"{named.get('class', '')} {named.get('id', '')}"
            role = named.get("role", "").lower()
            self.main = self.main or role == "main"
            if tag in MAIN:
                labels = COMMENTS.intersection(names.lower().split())
            elif tag in ("body", "html"):
                labels = ()
            else:
                labels = LABELS.intersection(re.split(r"[^a-z]+", names.lower()))
                labels -= {"header", "banner"} if self.main else set()
            if role in ROLES or "hidden" in attributes.lower().split() or COMMENTS.intersection(labels):
                self.refused = 2
            elif labels:
                self.refused = max(1, self.refused)
        if self.refused == 1 and tag in MAIN:
            self.refused = 0
        if tag == "header" and not self.main:
            self.refused = 2
        self.digest = blake2b(f"<{tag} {names}>".encode(), digest_size=8)


def parse(html: str) -> tuple[list[tuple[str, int, bool, bool]], list[int | None], list[str], list[int]]:
    """Blocks (text, number of the innermost container or -1, refused by markup, in an article), and by number the containers' hashes, tags and outer containers.

    A container around an article has no hash. Every step looks at as many open elements as it ends, so
    pages of any nesting take time in proportion to their length.
    """
    blocks, hashes, tags, outer, parts = [], [], [], [], []
    stack, opened, numbered = [_Element("#page", "", None)], Counter(), []

    def close(depth):
        while len(stack) > depth:
            element = stack.pop()
            opened[element.tag] -= 1
            if numbered and numbered[-1] is element:
                numbered.pop()
            value = element.digest.digest()
            if element.number is not None:
                hashes[element.number] = int.from_bytes(value, "little", signed=True)
            stack[-1].digest.update(value)

    def block():
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            parts.clear()
            if text:
                top = stack[-1]
                blocks.append((text, numbered[-1].number if numbered else -1, top.refused > 0, top.main))

    def write(text):
        if text:
            text = unescape(text)
            stack[-1].digest.update(_SPACE.sub(" ", text).encode("utf-8", "replace"))
            if not (stack[-1].refused and stack[-1].tag in RAW):
                parts.append(text)

    at = 0
    while found := _TOKEN.search(html, at):
        write(html[at : found.start()])
        at = found.end()
        ending, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            block()
        if ending:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            continue
        if tag in CLOSES_P and opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                elif stack[i].tag not in INLINE:
                    break
        if tag in ENDS:
            ended, limits = ENDS[tag]
            depth, left = 0, sum(opened[t] for t in ended)
            for i in range(len(stack) - 1, 0, -1):
                if not left or stack[i].tag in limits:
                    break
                if stack[i].tag in ended:
                    depth, left = i, left - 1
            if depth:
                close(depth)
        if tag in VOID:
            stack[-1].digest.update(f"<{tag}>".encode())
            continue
        element = _Element(tag, attributes, stack[-1])
        if tag in CONTAINERS:
            if element.refused or not element.main:  # what an article holds is no template
                element.number = len(hashes)
                hashes.append(0)
                tags.append(tag)
                outer.append(numbered[-1].number if numbered else -1)
        elif tag in MAIN:  # what holds an article is no template
            for e in numbered:
                hashes[e.number] = None
                e.number = None
            numbered.clear()
        if attributes.rstrip().endswith("/") and tag in ("svg", "path", "math"):
            continue
        stack.append(element)
        opened[tag] += 1
        if element.number is not None:
            numbered.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            stop = end.start() if end else len(html)
            element.refused = 2
            stack[-1].digest.update(html[at:stop].encode("utf-8", "replace"))
            at = stop
    write(html[at:])
    block()
    close(1)
    return blocks, hashes, tags, outer


def _digest(texts: list[str]) -> int:
    return int.from_bytes(blake2b("\n".join(texts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def page_parts(blocks, hashes, tags, outer) -> tuple[list[int], int, int, int]:
    """Hashes of containers that may be template, how many of them count by the whole text, and the digests of whole text and body.

    The whole text is the article's, or else all that markup does not refuse. The body is the
    innermost container with more than half of it, if no article is marked; containers inside the
    body come last and count by its digest, so that copies of a page which differ elsewhere are one page there.
    """
    kept = [b for b in blocks if not b[2]]
    main = [b for b in kept if b[3]]
    whole = core = _digest([b[0] for b in main or kept])
    n, total = len(hashes), sum(len(b[0]) for b in kept)
    size, filled, used = [0] * n, [False] * n, [False] * n
    for text, at, refused, _ in blocks:
        if at >= 0:
            used[at] = True
            if not refused:
                size[at] += len(text)
                filled[at] = True
    for i in range(n - 1, -1, -1):  # a container comes after the ones around it
        if (above := outer[i]) >= 0:
            size[above] += size[i]
            filled[above] |= filled[i]
            used[above] |= used[i]
    body = -1 if main else max((i for i in range(n) if 2 * size[i] > total and hashes[i] is not None), default=-1)
    safe, inside = set(), set()
    if body >= 0:
        at = body
        while at >= 0:
            inside.add(hashes[at])
            safe.add(hashes[at])
            at = outer[at]
        below, content = [False] * n, [False] * n
        for i in range(body + 1, n):
            above = outer[i]
            below[i] = above >= 0 and (above == body or below[above])
            if below[i] and used[i]:
                content[i] = above != body and (content[above] or tags[above] in CONTENT)
                inside.add(hashes[i])
                if tags[i] in CONTENT or content[i] and filled[i]:
                    safe.add(hashes[i])
        core = _digest([b[0] for b in kept if b[1] == body or b[1] >= 0 and below[b[1]]])
    own = {hashes[i] for i in range(n) if used[i] and hashes[i] is not None} - safe
    outside = sorted(own - inside)
    return outside + sorted(own & inside), len(outside), whole, core


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found.group(1).lower() if found else ""


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_pages: int = 3) -> DataFrame:
    """page_id, url, text, n_chars, n_template of every row.

    A container is template where it recurs on ``least_pages`` pages of the host, of whatever size, pages
    with equal text counted once; ``n_template`` counts the blocks that went with it.
    Null or empty html has an empty text. Pages without a readable host count as one host. Every
    row has a result of its own; other columns are ignored.
    """

    import zstandard

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, blobs, found, parts = [], [], [], []
        pack = zstandard.ZstdCompressor(level=12).compress
        for own_url, own_html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            blocks, hashes, tags, outer = parse(own_html or "")
            own, *part = page_parts(blocks, hashes, tags, outer)
            place = {h: i for i, h in enumerate(own)}
            # Containers by their place in the page's list of hashes; a refused block is only counted, so its text stays here.
            named = [[(above, place.get(h, -1)) for above, h in zip(outer, hashes)],
                     [("" if refused else text, at, int(refused), int(main)) for text, at, refused, main in blocks]]
            hosts.append(host_of(own_url))
            blobs.append(pack(json.dumps(named, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")))
            found.append(own)
            parts.append(part)
        columns = [batch.column(3), batch.column(0), batch.column(1), pa.array(hosts), pa.array(blobs, pa.binary()), pa.array(found, pa.list_(pa.int64()))]
        columns += [pa.array([p[i] for p in parts], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, ["row", "page_id", "url", "host", "blocks", "hashes", "n_outside", "whole", "core"])

    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), F.monotonically_increasing_id().alias("row"))
    read_pages = staged(map_batches(rows, read, f"row bigint, page_id {kind}, url string, host string, blocks binary, hashes array<bigint>, "
                                          "n_outside bigint, whole bigint, core bigint"), "pages")

    # One number for the host and the container's hash.
    page = F.when(F.col("at") < F.col("n_outside"), F.col("whole")).otherwise(F.col("core"))
    each = read_pages.select("row", "host", "n_outside", "whole", "core", F.posexplode("hashes").alias("at", "hash"))
    each = each.select("row", "hash", F.xxhash64("host", "hash").alias("key"), page.alias("page"))
    template = each.groupBy("key").agg(F.countDistinct("page").alias("n")).filter(F.col("n") >= least_pages).select("key")
    gone = each.select("row", "hash", "key").join(template, "key").groupBy("row").agg(F.collect_set("hash").alias("gone"))
    rest = read_pages.select("row", "page_id", "url", "blocks", "hashes").join(gone, "row", "left")
    # Places in the page's list of the containers that go.
    places = F.transform(F.coalesce("gone", F.array().cast("array<bigint>")), lambda h: F.array_position("hashes", h) - 1)
    rest = rest.select("page_id", "url", "blocks", places.alias("gone"))

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        unpack = zstandard.ZstdDecompressor().decompress
        texts, template_blocks = [], []
        for blob, own in zip(batch.column(2), batch.column(3)):
            (containers, blocks), places = json.loads(unpack(blob.as_py()).decode("utf-8", "surrogatepass")), set(own.as_py() or ())
            away = []
            for above, place in containers:
                away.append(place in places or above >= 0 and away[above])
            left = [b for b in blocks if b[1] < 0 or not away[b[1]]]
            template_blocks.append(len(blocks) - len(left))
            only_main = any(b[3] and not b[2] for b in left)
            texts.append("\n".join(b[0] for b in left if not b[2] and (b[3] or not only_main)))
        columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(template_blocks, pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["page_id", "url", "text", "n_chars", "n_template"])

    return map_batches(rest, choose, f"page_id {kind}, url string, text string, n_chars bigint, n_template bigint")


def op1_main_text(spark, directory):
    return main_text(table(spark, directory, "pages"))
