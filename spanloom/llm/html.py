"""Main text of web pages by container paths that the pages of a host agree on.

1. Every page is parsed once; its containers are scored by the unlinked text of their blocks (in full
   for a block's parent, half for the grandparent), and the best one votes for its generalised
   path: tags with classes, digits taken out; a path goes by a digest.
2. Spark counts the votes by host; the path with the most wins (ties: the larger digest).
3. Every page is extracted again. Where its own best container is on the winning path, inside it or
   around it, nothing of either is lost; where it is elsewhere, all nodes on the winning path replace
   it, with the boxes that pages of the host keep beside that path. A page whose nodes on that path
   hold under half of its own best container's text keeps its own.

A page's own text is that of all articles (or main elements) on the best one's path; without such an
element it is all that is wanted in the page, but for boxes of links beside the best container.

Menus, adverts, forms, scripts, comments of readers and the like are left out by tag, role and the
words of class and id. A word says nothing with has, with, no, without, enabled, disabled, open or
closed at it, nor at a heading, nor in a name that goes on with a word of its own (related-work,
share-price), nor at an element around a main element or the page's least enclosed article or around
most of the page's unlinked text; words for comments of readers give way to a main element only. Words
for boxes of links must be borne out by links: where such a box holds a text that mostly isn't linked,
it stays. Forms and page headers (outside articles) count as so named. Inside an article or main
element, words that name sections of articles as well say nothing in ids and at text blocks.
Where words would leave nothing of a page, they aren't heeded.

Time and memory grow with a page's length alone, whatever its nesting and however broken its markup.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(?=[\s/>])")
# a tag without < or > in its attributes, which is seen at once; it reads up to the next < at most
_PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[\s/](?:[^\"'<>]|\"[^\"<>]*\"|'[^'<>]*')*)?)>")
_JUNK = re.compile(r"<[!?/a-zA-Z][^<>]*>")
_MARK = re.compile(r"[\"'>]")
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# HTML element names.
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in "script style noscript template iframe svg textarea select object".split()}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SKIP_TAGS = frozenset("nav aside footer button head title menu dialog audio video canvas map datalist".split())
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td".split())
_PAGE = frozenset(("#", "html", "body"))
_BARRIER = frozenset("table ul ol dl body html article main section div".split())
# Words of class, id and role that mark what isn't the article.
_SKIP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner bookmark breadcrumb breadcrumbs comment comments "
    "commentlist cookie cookies consent disqus discussion feedback footer gdpr login masthead menu modal nav navbar navigation navigationbar "
    "newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion rail recommend recommended "
    "recommendations related replies reply respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tagcloud teaser toolbar tooltip topbar widget complementary contentinfo alert".split()
)
# Those for boxes of links and the least text that speaks against one; for comments of readers, those that name sections of articles as well, words that may follow in
# an id without another meaning, and words that tell of a part instead of naming it.
_LINKS = frozenset("bookmark breadcrumb breadcrumbs menu nav navbar navigation navigationbar pager pagination recommend recommended recommendations related share sharing skip social tagcloud teaser".split())
_LINKS_AT_MOST = 200
_READERS = frozenset("comment comments commentlist disqus discussion feedback replies reply respond responses".split())
_SECTIONS = frozenset("alert discussion feedback navigation notification overlay promotion recommendations responses search social subscription teaser".split())
_PLACES = frozenset(
    "area article articles bar block body bottom box button buttons card col column container content feed footer form frame grid group header heading icon icons info inner "
    "item items js left link links list main media message module more news outer page panel policy post posts region results right root row section side site slot stories "
    "text this title top topics unit view wrap wrapper default desktop fixed inline large leaderboard list listing mobile native primary reading secondary "
    "slot small sticky stories thread threaded unit videos".split()
)
#: What a header may be of, if not of the page.
_OF_ARTICLE = frozenset("article card chapter content entry page post section story table".split())
_BEFORE, _AFTER = frozenset("has with no without".split()), frozenset("enabled disabled open closed".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


class _Node:
    __slots__ = ("chars", "label", "links", "main", "named", "parent", "path", "role", "score", "skip", "tag", "text", "within")

    def __init__(self, tag, parent, label, skip):
        self.tag, self.parent, self.label, self.skip, self.named, self.main = tag, parent, label, skip, frozenset(), False
        self.path = hashlib.blake2b(parent.path + label.encode("utf-8", "surrogatepass"), digest_size=16).digest() if parent else b""
        self.score, self.text, self.chars, self.role = 0.0, 0, 0, False
        self.within = parent is not None and (parent.within or parent.role)  # an article or main element
        self.links = False  # a box of links beside the best container

    def spelled(self) -> str:
        """The path as text."""
        labels, node = [], self
        while node is not None:
            labels.append(node.label)
            node = node.parent
        return "/".join(reversed(labels))


def _tokens(html: str):
    """(start, end, end tag or not, tag, attributes) of everything between < and >; tag is None for comments,
    declarations, what no element can be, and elements whose content isn't text (they end where they are closed)."""
    tag_ends = _TagEnds(html)
    at = html.find("<")
    while at >= 0:
        end = at + 1
        m = _PLAIN.match(html, at)
        if m or ((m := _TAG.match(html, at)) and tag_ends.after(m.end()) >= 0):
            end, tag = m.end() if m.re is _PLAIN else tag_ends.after(m.end()) + 1, m[2].lower()
            attrs = m[3] if m.re is _PLAIN else html[m.end() : end - 1]
            if tag in _RAW and not m[1]:
                closed = _RAW[tag].search(html, end)
                end, tag = closed.end() if closed else len(html), None
            yield at, end, bool(m[1]), tag, attrs
        elif html.startswith("<!--", at):
            stop = html.find("-->", at + 4)
            end = stop + 3 if stop >= 0 else len(html)
            yield at, end, False, None, ""
        elif m := _JUNK.match(html, at):
            end = m.end()
            yield at, end, False, None, ""
        elif html[at + 1 : at + 2] in tuple("!?/") or html[at + 1 : at + 2].isalpha():
            # a declaration or a broken tag: up to the next > if no other < comes before
            stop, other = tag_ends.greater_after(at), html.find("<", at + 1)
            if stop < 0 and other < 0:
                end = len(html)
            elif stop >= 0 and (other < 0 or stop < other or html[at + 1] in "!?/"):
                end = stop + 1
            if end > at + 1:
                yield at, end, False, None, ""
        at = html.find("<", end)


class _TagEnds:
    """Where tags end in a page, quotes heeded; found for all places at once when first asked."""

    def __init__(self, html: str):
        self.html, self.places = html, None

    def _scan(self) -> None:
        marks = [(m.start(), m[0]) for m in _MARK.finditer(self.html)]
        self.places, self.ends = [p for p, _ in marks], [-1] * (len(marks) + 1)
        self.greater = [p for p, c in marks if c == ">"]
        later = {'"': -1, "'": -1}
        for k in range(len(marks) - 1, -1, -1):  # from the k-th mark on, outside of quotes
            p, c = marks[k]
            self.ends[k] = p if c == ">" else self.ends[later[c] + 1] if later[c] >= 0 else -1
            if c != ">":
                later[c] = k

    def after(self, at: int) -> int:
        """The > that ends a tag whose attributes start at ``at``, or -1."""
        if self.places is None:
            self._scan()
        return self.ends[bisect_left(self.places, at)]

    def greater_after(self, at: int) -> int:
        if self.places is None:
            self._scan()
        i = bisect_left(self.greater, at)
        return self.greater[i] if i < len(self.greater) else -1


def _attrs(s: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(s)} if s else {}


def _unwanted(tag: str, a: dict[str, str]) -> bool:
    return (
        tag in _SKIP_TAGS or "hidden" in a or a.get("aria-hidden") == "true"
        or ("style" in a and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a["style"], re.I) is not None)
    )


def _named(tag: str, a: dict[str, str], within: bool) -> frozenset[str]:
    """The words of class, id and role that mark what isn't the article; ``within`` an article or main element or not."""
    if tag in _HEADINGS:
        return frozenset()
    out = {"form"} if tag == "form" else {"header"} if tag == "header" and not within else set()
    for key in ("class", "id", "role"):
        for name in a.get(key, "").split():
            w = [x.lower() for x in _WORDS.findall(name)]
            if not within and w and w[-1] == "header" and _OF_ARTICLE.isdisjoint(w):
                out.add("header")
            if _SKIP_WORDS.isdisjoint(w):
                continue
            found = {x for i, x in enumerate(w) if x in _SKIP_WORDS and not (i and w[i - 1] in _BEFORE) and not (i + 1 < len(w) and w[i + 1] in _AFTER)}
            last = max(i for i, x in enumerate(w) if x in _SKIP_WORDS)
            if not all(x in _PLACES or len(x) < 3 for x in w[last + 1 :]):
                continue
            out |= found - _SECTIONS if within and (key == "id" or tag in _BLOCKS) else found
    return frozenset(out)


def _heed_names(nodes: list[_Node], worths: list[tuple[_Node, int, int]]) -> None:
    """Skips what words of class, id and role mark, with all inside."""
    suspects = {n for n in nodes if n.named and not n.skip and n.tag not in ("html", "body", "article", "main")}
    if not suspects:
        return
    held: dict[_Node, int] = defaultdict(int)
    chars: dict[_Node, int] = defaultdict(int)
    for holder, worth, n in worths:
        held[holder] += worth
        chars[holder] += n
    for n in reversed(nodes):  # parents come before what they hold
        held[n.parent] += held[n]
        chars[n.parent] += chars[n]
    total = sum(worth for _, worth, _ in worths)
    spared = {n for n in suspects if 2 * held[n] > total and not n.named <= _READERS}
    spared |= {n for n in suspects if n.named <= _LINKS and held[n] > _LINKS_AT_MOST and 4 * held[n] > 3 * chars[n]}

    def spare(n, seen):
        """Spares the suspects around n, up to where that was done before."""
        while n is not None and n not in seen:
            seen.add(n)
            if n in suspects:
                spared.add(n)
            n = n.parent

    seen: set[_Node] = set()
    for n in nodes:
        if n.main and not n.skip:
            spare(n, seen)
    # of the articles in suspects, the least enclosed are spared, unless words for readers mark what is around
    around, articles = {None: (0, False)}, []
    for n in nodes:
        enclosed, readers = around.get(n.parent, (0, False))
        if n.role and not n.main and not n.skip and not n.named:
            articles.append((n, enclosed, readers))
        mine = n in suspects and n not in spared
        around[n] = (enclosed + mine, readers or (mine and n.named <= _READERS))
    least, seen = min((e for _, e, _ in articles), default=0), set()
    for n, enclosed, readers in articles:
        if enclosed == least and not readers:
            spare(n.parent, seen)
    marked = suspects - spared
    out = set()
    for n in nodes:
        if n in marked or n.parent in out:
            out.add(n)
    if any(worth and holder not in out for holder, worth, _ in worths):
        for n in out:
            n.skip = True


def parse(html: str) -> tuple[list[_Node], list[tuple[_Node, str]]]:
    """All nodes but inline ones, and the text blocks in page order with the node that holds each."""
    root = _Node("#", None, "", False)
    stack, nodes, blocks, worths = [root], [], [], []
    opened: dict[str, int] = defaultdict(int)
    buf: list[str] = []
    linked = [0, 0]  # characters inside links of the block at hand, depth of links

    def flush():
        if buf:
            text = " ".join(unescape("".join(buf)).split())
            buf.clear()
            if text:
                node = stack[-1]
                blocks.append((node, text))
                if not node.skip:
                    worths.append((node, max(0, len(text) - min(len(text), linked[0])), len(text)))
        linked[0] = 0

    def close(names, barrier=frozenset()):
        for n in names:
            if opened[n]:
                break
        else:
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                for n in stack[i:]:
                    opened[n.tag] -= 1
                del stack[i:]
                return
            if stack[i].tag in barrier:
                return

    def say(piece):
        buf.append(piece)
        if linked[1]:
            linked[0] += len(piece)

    at = 0
    for start, end, closing, tag, attrs in _tokens(html):
        if start > at:
            say(html[at:start])
        at = end
        if tag is None:
            continue
        if tag in _INLINE:
            if tag == "br":
                buf.append(" ")
            elif tag == "a":
                linked[1] = 0 if closing else 1
            continue
        flush()
        linked[1] = 0
        if closing:
            close((tag,), _BARRIER - {tag} if tag in ("p", "li", "td", "th", "tr") else frozenset())
            continue
        if tag in _CLOSES_P:
            close(("p",), _BARRIER)
        if tag in _SELF_CLOSING:
            close(_SELF_CLOSING[tag], _BARRIER)
        if tag in _VOID:
            continue
        a = _attrs(attrs)
        parent = stack[-1]
        label = ".".join([tag, *sorted(_DIGITS.sub("", a.get("class", "")).split())])
        node = _Node(tag, parent, label, parent.skip or _unwanted(tag, a))
        node.named = _named(tag, a, node.within) if a or tag in ("form", "header") else frozenset()
        node.main = tag == "main" or a.get("role") == "main" or a.get("itemprop") == "articleBody"
        node.role = node.main or tag == "article" or a.get("role") == "article"
        nodes.append(node)
        if not attrs.endswith("/"):
            stack.append(node)
            opened[tag] += 1
    if at < len(html):
        say(html[at:])
    flush()
    _heed_names(nodes, worths)
    for node, worth, chars in worths:
        if not node.skip:
            up = node if node.tag not in _BLOCKS else node.parent
            up.score += worth
            if up.parent is not None:
                up.parent.score += worth / 2
            node.text += worth
            node.chars += chars
    for node in reversed(nodes):  # parents come before what they hold
        node.parent.text += node.text
        node.parent.chars += node.chars
    return nodes, blocks


def best_container(nodes: list[_Node]) -> _Node | None:
    """The container with the highest score, or the article or main element around it, or else the
    highest one around it that adds a wanted sibling; marks the boxes of links beside it."""
    able = [n for n in nodes if n.score > 0 and not n.skip]
    if not able:
        return None
    top = max(able, key=lambda n: n.score)
    node, role, around = top, None, {}
    while node is not None:
        if node.role and (role is None or node.text > 1.5 * role.text):
            role = node
        node = node.parent
        around[node] = []
    if role is not None:
        return role
    for n in nodes:
        if n.parent in around and not n.skip:
            around[n.parent].append(n)
    node = top
    while node.parent is not None:
        beside, up = [n for n in around[node.parent] if n is not node], node.parent
        for n in beside:
            n.links = n.tag not in _BLOCKS and _mostly_links(n)
        bare = up.text - node.text - sum(n.text for n in beside)
        if up.tag not in _PAGE and (bare or any(n.text and not _mostly_links(n) for n in beside)):
            top = up
        node = up
    return top


def _mostly_links(node: _Node) -> bool:
    return 2 * node.text < node.chars


def _beside(nodes: list[_Node], best: _Node) -> set[bytes]:
    """Paths of the boxes that a page without an article keeps beside the part that holds its best container."""
    if best.role or best.tag in _PAGE:
        return set()
    part = best
    while part.parent.tag not in _PAGE:
        part = part.parent
    return {n.path for n in nodes if n.parent is part.parent and n is not part and not n.skip and n.text and not _mostly_links(n)}


def text_of(roots: set[_Node], nodes: list[_Node], blocks: list[tuple[_Node, str]]) -> str:
    """The blocks inside some nodes that aren't in unwanted parts, one a line."""
    inside = set(roots)
    for n in nodes:
        if n.parent in inside and not n.links:
            inside.add(n)
    return "\n".join(text for holder, text in blocks if holder in inside and not holder.skip)


def extract(html: str | None, path: bytes | None = None, beside: list[bytes] | None = None) -> tuple[str, str | None]:
    """(main text, path of its container as text) of a whole page, from the container with the digest
    ``path`` where the page has it, with the boxes whose paths are ``beside`` it on other pages."""
    nodes, blocks = parse(html or "")
    best = best_container(nodes)
    if best is None:  # no container: all wanted blocks
        return "\n".join(t for n, t in blocks if not n.skip), None
    own = {n for n in nodes if n.path == best.path and not n.skip} if best.role else {nodes[0].parent}
    voted = {n for n in nodes if n.path == path and not n.skip} if path else set()
    if not voted:
        return text_of(own, nodes, blocks), best.spelled()
    around, up = set(), best
    while up is not None:
        around.add(up)
        up = up.parent
    if around & voted:
        return text_of(own | voted, nodes, blocks), next(iter(voted)).spelled()
    within = {best}
    for n in nodes:
        if n.parent in within:
            within.add(n)
    if within & voted:
        return text_of(own | voted, nodes, blocks), best.spelled()
    if sum(n.text for n in voted) >= 0.5 * best.text:
        kept = set(beside or ())
        near = {n for n in nodes if n.path in kept and not n.skip}
        return text_of(voted | near, nodes, blocks), next(iter(voted)).spelled()
    return text_of(own, nodes, blocks), best.spelled()


def _votes(batches):
    for batch in batches:
        votes: dict[tuple, int] = defaultdict(int)
        for host, html in zip(batch.column(0), batch.column(1), strict=True):
            nodes = parse(html.as_py() or "")[0]
            best = best_container(nodes)
            if best is not None:
                for beside in (None, *_beside(nodes, best)):
                    votes[host.as_py(), best.path, beside] += 1
        hosts, paths, near = ([k[i] for k in votes] for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.binary()), pa.array(near, pa.binary()), pa.array(list(votes.values()), pa.int64())], ["host", "path", "near", "votes"]
        )


def _texts(batches):
    for batch in batches:
        got = [extract(h.as_py(), p.as_py(), b.as_py()) for h, p, b in zip(batch.column(2), batch.column(3), batch.column(4), strict=True)]
        text = [t for t, _ in got]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array([p for _, p in got], pa.string())],
            ["page_id", "url", "text", "n_chars", "container"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, beside) of each host of pages(url, html): the winning container path, and
    the paths of boxes kept beside it on a tenth of the pages that vote for it (so their number is
    bounded by ten times that on a page). Paths are digests; ties go to the larger one. Null or empty
    html casts no vote; pages without a host vote as one host named ""; an empty table gives none."""
    hosted = pages.select(_host().alias("host"), F.col("html").cast("string").alias("html"))
    counted = hosted.mapInArrow(_votes, "host string, path binary, near binary, votes long").groupBy("host", "path", "near").agg(F.sum("votes").alias("votes"))
    votes = materialize(counted, "host_votes")
    top = votes.where("near is null").groupBy("host").agg(F.max(F.struct("votes", "path")).alias("top")).select("host", "top.path", "top.votes")
    near = votes.where("near is not null").withColumnRenamed("votes", "n").join(top, ["host", "path"]).where("10 * n >= votes").groupBy("host").agg(F.collect_set("near").alias("beside"))
    return top.join(near, "host", "left")


def _host():
    return F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, container of every row of pages(page_id, url, html).

    Null or empty html gives an empty text; pages without a host (null or odd url) share one; ids may
    be null or repeat, each row is extracted; an empty table gives an empty result; other columns are
    not read.
    """
    paths = materialize(host_paths(pages), "host_paths").select("host", "path", "beside")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), _host().alias("host"))
    joined = rows.join(paths, "host", "left").select("page_id", "url", "html", "path", "beside")
    return joined.mapInArrow(_texts, "page_id long, url string, text string, n_chars long, container string")
