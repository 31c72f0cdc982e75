"""Main text of web pages, by consensus of a host's pages on where it is.

Each page scores its containers: the share of the page's running text that a container holds, times
the share of running text in what it holds. Boilerplate is told by element, role and class words.
A container goes by its generalised path, the tags and classes from the top with digits blotted
out, so pages of one template name the same place alike. Spark adds the scores of a host's
pages by path, and the path with the largest sum wins. Every page is then read again at its host's
winning path; a page that has no text there goes by its own best container.

The votes are integers summed before the shuffle, so a host with a third of all pages is a few rows
per task. Winners are one row per host: Spark broadcasts them when their stored size is small and
else joins them to the pages, where adaptive execution splits a large host.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import record_batch, sliced, stored, text_of

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article blockquote body center div main section table td".split())
CLOSES_P = BLOCKS - frozenset("body caption html legend optgroup option tbody td tfoot th thead tr".split())
#: An open element that a start tag ends, and where the search for it stops.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "optgroup")),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "a": (("a",), tuple(BLOCKS)),
}
SCOPE = frozenset("table td th caption template html".split())
TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption".split())

# Elements, roles and class words of what is not the article.
ASIDE_TAGS = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe map menu nav noscript object search select svg "
    "template video".split()
)
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adbox adslot adsense adunit advert adverts advertisement advertising advertorial banner banners breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr login masthead menu "
    "menus modal nav navbar navigation newsletter notice notices outbrain overlay pager pagination paywall popup promo "
    "promos promoted promotion recommended recommendations related replies reply respond search share shares sharing "
    "sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription taboola teaser teasers "
    "toolbar topbar tracking widget widgets".split()
)
TURNED = frozenset("has is no with without".split())
SITE_WORDS = frozenset("global page site top main".split())
ARTICLE_WORDS = frozenset("article content entry post story".split())

#: A container that is named after its content, and the whole body, count so much of their score.
NAMED, BODY = 1.25, 0.8

#: Votes are whole numbers, so their sum does not depend on the order of the rows.
VOTE = 1_000_000

#: Longest path kept as text; a longer one goes on from a hash of itself.
PATH = 400

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|</?([a-zA-Z][^\s/>]*)"
    r"((?>[^>\"'=]++|=\s*+\"[^\"]{0,65536}+\"|=\s*+'[^']{0,65536}+'|=|\"|')*+)>",
    re.DOTALL,
)
_ATTRIBUTES = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_ENDS = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE) for tag in RAW}


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTES.finditer(source)}


def _words(name: str) -> list[str]:
    return [word.lower() for word in _WORDS.findall(name)]


def is_aside(tag: str, given: dict[str, str], inside: bool) -> bool:
    """Whether an element is no part of an article; ``inside``: some ancestor is one."""
    if tag in ASIDE_TAGS or given.get("role", "").lower() in ASIDE_ROLES:
        return True
    style = given.get("style", "").replace(" ", "").lower()
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return True
    names = [_words(name) for name in [*given.get("class", "").split(), given.get("id", "")]]
    if tag == "header" or any("header" in words for words in names):
        site = any("header" in words and SITE_WORDS & {*words} for words in names)
        if site or not (inside or any(ARTICLE_WORDS & {*words} for words in names)):
            return True
    if tag in ("html", "body", "main"):
        return False
    return any(
        word in ASIDE_WORDS and not TURNED & {*words[:at]} for words in names for at, word in enumerate(words)
    )


def _step(tag: str, given: dict[str, str]) -> str:
    names = sorted({re.sub(r"\d+", "#", name) for name in given.get("class", "").split()})
    return ".".join([tag, *names])


class Page:
    """A page's containers, and its blocks of text in order.

    ``paths``, ``parents``, ``asides`` and ``tags`` are by node; node 0 is the page itself. ``blocks`` are (text, node,
    characters in links), of blocks outside of boilerplate; ``held`` are a node's own characters
    of running text, and of links and boilerplate.
    """

    def __init__(self, source: str) -> None:
        self.paths, self.parents, self.tags = [""], [-1], [""]
        self.asides, self.inside = [False], [False]
        self.named = [False]
        self.blocks: list[tuple[str, int, int]] = []
        self.held: dict[int, list[int]] = {}
        self.open = [0]
        self.in_head = False
        self.buffer: list[tuple[str, bool]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        while found := _MARKUP.search(source, at):
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            if found[1] is None:
                continue
            tag = found[1].lower()
            if found[0][1] == "/":
                self._end(tag)
                continue
            self._start(tag, found[2])
            if tag in RAW:
                end = _ENDS[tag].search(source, at)
                at = end.start() if end else len(source)
        if at < len(source):
            self._text(source[at:])
        self._flush()

    def _text(self, text: str) -> None:
        top = self.open[-1]
        if self.asides[top]:
            self._hold(top, 0, len(text))
        else:
            self.buffer.append((text, "a" in self._inline()))

    def _inline(self) -> list[str]:
        """Open elements above the innermost block."""
        names = []
        for node in reversed(self.open):
            if self.tags[node] in BLOCKS or not node:
                break
            names.append(self.tags[node])
        return names

    def _hold(self, node: int, good: int, bad: int) -> None:
        held = self.held.setdefault(node, [0, 0])
        held[0] += good
        held[1] += bad

    def _flush(self) -> None:
        """Ends the current block: white space becomes one space."""
        if not self.buffer:
            return
        text = " ".join(entities.unescape("".join(part for part, _ in self.buffer)).split())
        if text:
            linked = sum(len(part.strip()) for part, link in self.buffer if link)
            linked = min(linked, len(text))
            node = next(n for n in reversed(self.open) if self.tags[n] in BLOCKS or not n)
            self.blocks.append((text, node, linked))
            self._hold(node, len(text) - linked, linked)
        self.buffer.clear()

    def _close(self, names: tuple[str, ...], stops) -> None:
        """Closes the innermost open element of these names unless one of ``stops`` lies above it."""
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[depth]]
            if tag in names:
                if any(self.tags[node] in BLOCKS for node in self.open[depth:]):
                    self._flush()
                del self.open[depth:]
                return
            if tag in stops:
                return

    def _start(self, tag: str, source: str) -> None:
        if tag == "br":
            if self.buffer:
                self.buffer.append((" ", False))
            return
        if tag in BLOCKS:
            self._flush()
            if self.in_head and tag != "html":  # its end tag may be left out
                self._end("head")
        if tag in VOID:
            return
        self.in_head |= tag == "head"
        if tag in CLOSES_P:
            self._close(("p",), SCOPE)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        top = self.open[-1]
        given = attributes(source) if source.strip() else {}
        names = {word for name in (given.get("class", ""), given.get("id", ""), given.get("itemprop", "")) for word in _words(name)}
        path = f"{self.paths[top]}>{_step(tag, given)}"
        node = len(self.tags)
        self.paths.append(path if len(path) <= PATH else "#" + xxhash.xxh3_128_hexdigest(path))
        self.parents.append(top)
        self.tags.append(tag)
        self.asides.append(self.asides[top] or is_aside(tag, given, self.inside[top]))
        is_one = tag in ("article", "main") or given.get("role") in ("main", "article")
        self.named.append(tag != "body" and (is_one or bool(ARTICLE_WORDS & names)))
        self.inside.append(self.inside[top] or self.named[-1] and (is_one or bool(ARTICLE_WORDS & names - {"content"})))
        self.open.append(node)

    def _end(self, tag: str) -> None:
        self.in_head &= tag != "head"
        if tag in ("body", "html") or tag in VOID:
            if tag in BLOCKS:
                self._flush()
            return
        if tag not in BLOCKS:
            self._close((tag,), BLOCKS)
        elif tag in TABLE_PARTS:
            self._close((tag,), ("table",) if tag != "table" else ())
        else:
            self._close((tag,), SCOPE)

    def scores(self) -> dict[str, tuple[int, int]]:
        """(votes, depth) of each generalised container path with running text."""
        good, bad = [0] * len(self.tags), [0] * len(self.tags)
        for node, (own_good, own_bad) in self.held.items():
            good[node], bad[node] = own_good, own_bad
        for node in range(len(self.tags) - 1, 0, -1):  # parents come before their children
            good[self.parents[node]] += good[node]
            bad[self.parents[node]] += bad[node]
        depth = [0] * len(self.tags)
        for node in range(1, len(self.tags)):
            depth[node] = depth[self.parents[node]] + 1
        sums: dict[str, list] = {}
        for node, tag in enumerate(self.tags):
            if good[node] and not self.asides[node] and (tag in CONTAINERS or not node):
                weight = BODY if tag in ("body", "") else NAMED if self.named[node] else 1.0
                found = sums.setdefault(self.paths[node], [0, 0, depth[node], weight])
                found[0] += good[node]
                found[1] += bad[node]
        return {
            path: (round(VOTE * weight * g / good[0] * g / (g + b)), at) for path, (g, b, at, weight) in sums.items()
        }

    def text_at(self, path: str) -> str:
        """Blocks below the elements of this path, joined by line ends."""
        below = [False] * len(self.tags)
        for node in range(len(self.tags)):
            below[node] = self.paths[node] == path or (node > 0 and below[self.parents[node]])
        return "\n".join(text for text, node, _ in self.blocks if below[node])


def best_path(scores: dict[str, tuple[int, int]]) -> str | None:
    """Most votes, then the deepest, then the last by name; as hosts decide."""
    return max(scores, key=lambda path: (*scores[path], path.encode()), default=None)


def main_text(source: str, path: str | None = None) -> str:
    """The text at ``path``, or at the page's own best container where the path has none."""
    page = Page(source)
    found = page.text_at(path) if path is not None else ""
    if not found:
        own = best_path(page.scores())
        found = page.text_at(own) if own is not None else ""
    return found


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("depth", pa.int32()), ("votes", pa.int64())])
    for batch in sliced(batches, "html", 1 << 23):
        rows = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            rows.extend((host, path, at, votes) for path, (votes, at) in Page(source).scores().items())
        yield record_batch(schema, *([row[i] for row in rows] for i in range(4)))


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    for batch in sliced(batches, "html", 1 << 23):
        sources, paths = batch.column("html").to_pylist(), batch.column("path").to_pylist()
        texts = [main_text(source, path) for source, path in zip(sources, paths, strict=True)]
        yield record_batch(schema, batch.column("page_id"), batch.column("url"), texts, [len(text) for text in texts])


def host_of(url: Column) -> Column:
    """The host in lower case; null where a URL names none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the winning container path of each host; from (host, html) rows."""
    votes = pages.where("host is not null").select("host", "html").mapInArrow(
        _vote_batches, "host string, path string, depth int, votes long"
    )
    sums = votes.groupBy("host", "path").agg(F.max("depth").alias("depth"), F.sum("votes").alias("votes"))
    won = sums.groupBy("host").agg(F.max(F.struct("votes", "depth", "path")).alias("won"))
    return stored(won.select("host", "won.path"), "host_paths")


def main_texts(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Blocks are joined by one line end; inside a block white space is one space, and a line
    break element counts as white space. Defined cases: a null page is empty, and an empty page, or one
    without running text outside of boilerplate, has the empty text; a page whose URL names no host has no
    vote and goes by its own best container; null and repeated ids and repeated pages keep their
    own rows, and each repeated page votes; ties of votes go to the deeper path, then by its name;
    other columns of ``pages`` are not looked at.
    """
    rows = pages.select(
        pages[id].cast("long").alias("page_id"),
        pages[url].cast("string").alias("url"),
        text_of(pages, html).alias("html"),
        host_of(pages[url].cast("string")).alias("host"),
    )
    placed = rows.join(host_paths(rows), "host", "left").select("page_id", "url", "html", "path")
    return placed.mapInArrow(_text_batches, "page_id long, url string, text string, n_chars long")
