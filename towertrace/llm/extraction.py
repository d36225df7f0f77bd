"""Main text of HTML pages, with a suffix array over each host's pages.

A page is read into blocks.  Every piece of a block's text has a zone: the
page's main part (inside `article` or `main`, or else inside a container whose
class or id says so), page furniture (menus, footers, sidebars, notices,
adverts, forms, comments, by element, or by a class or id all of whose words
name furniture), a part that a class only hints at (`related-work`), or none.

All blocks outside the main part, and those that a class only hints at, make
up the page's token stream.  The
suffixes of a host's streams are cut at `min_tokens` tokens, which is all the
order of a suffix array is asked for here: equal neighbours start a passage
repeated on several pages.  Spark groups the cut suffixes instead of sorting
them, so equal ones meet without a range of them in one task.  Tokens covered by a passage that at least
`min_pages` different pages share are boilerplate.  A page with a main part
is that part, with the hinted blocks less the covered tokens; a page without
one is its remaining blocks, less the covered tokens, so unique runs stay.

The streams are first reduced to distinct ones, each with its number of
different main parts (copies of a page count once, or its article would look
like boilerplate), and a suffix to one row per stream, with a
partial step before the shuffle, so neither a host with a third of the pages
nor a footer on all of them gathers in one task.

Defined results
---------------
* Null or empty html, or html without text: the empty text.
* Unclosed and stray tags, cut-off tags and entities are read as browsers do
  in outline; nothing raises.
* A repeated page row is extracted each time and counts once as a stream.
* A null url has the empty host; its pages count as one host.
* An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut
from .urls import host_of

TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*)>"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z:-]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s"'>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is no text of the page.
RAW = {"script", "style", "template", "iframe", "textarea", "title"}
#: Elements without content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that end a block.
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
         "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot",
         "thead", "tr", "ul", "caption", "dialog"}
#: Elements that a start tag closes, up to the nearest of some containers.
CLOSES = {name: ("p", ("td", "th", "caption", "button", "table")) for name in BLOCK - {"tbody", "thead", "tfoot", "tr", "caption"}}
CLOSES |= {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",)), "tr": ("tr", ("table",)),
           "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "option": ("option", ("select",))}
#: Elements that an end tag inside them does not reach out of.
WALLS = ("td", "th", "caption", "table")
TABLE = {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}
#: Elements of page furniture; `header` only outside the main part.
FURNITURE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "label", "datalist"}
#: Words of a class, id or role that name page furniture.
FURNITURE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "alert", "alertdialog", "banner", "breadcrumb",
                   "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies",
                   "copyright", "dialog", "disclaimer", "disqus", "footer", "gdpr", "login", "menu", "modal", "nav", "navbar",
                   "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "promotion", "recommended",
                   "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor",
                   "sponsored", "subscribe", "subscription", "toolbar", "widget"}
#: The same, only outside the main part.
OUTER_WORDS = {"header", "masthead", "search", "top", "topbar"}
#: Words that stand beside a furniture word without changing what it names.
PLACE_WORDS = {"area", "articles", "bar", "block", "bottom", "box", "button", "buttons", "center", "col", "column", "container",
               "count", "desktop", "fixed", "form", "group", "icon", "icons", "inline", "inner", "item", "items", "left", "link",
               "links", "list", "mobile", "outer", "panel", "post", "posts", "primary", "right", "row", "secondary", "section",
               "site", "slot", "sticky", "stories", "thread", "title", "tools", "unit", "wrap", "wrapper"}
#: Words of a class that tells how a page is laid out, not what a part is.
LAYOUT_WORDS = {"has", "have", "hide", "is", "layout", "no", "not", "page", "with", "without"}
#: Words of a class or id of the container of the main text.
MAIN_WORDS = {"article", "content", "entry", "main", "post", "story"}
#: Elements of the running text: a class of theirs names no furniture in the main part.
RUNNING = {"blockquote", "q", "cite", "figure", "figcaption", "table", "tbody", "tr", "td", "th", "pre", "code", "math", "h1",
           "h2", "h3", "h4", "h5", "h6", "em", "strong", "b", "i"}

MAIN, HINTED, WEAK, OTHER, DROPPED = "main", "hinted", "weak", "other", "dropped"
#: Furniture by its class, and an article inside it, which is the main part of
#: a page that has no other.
ASIDE, INNER = "aside", "inner"


def names_furniture(token: str, outer: bool) -> str | None:
    """What a class, id or role says: `DROPPED` if all its words name
    furniture or a place, `HINTED` if one of them does, else None."""
    words = [w.lower() for w in WORD.findall(token)]
    known = FURNITURE_WORDS | OUTER_WORDS if outer else FURNITURE_WORDS
    hits = sum(w in known for w in words)
    if not hits or any(w in LAYOUT_WORDS for w in words):
        return None
    return DROPPED if all(w in known or w in PLACE_WORDS for w in words) else HINTED


class _Reader:
    """Reads one page into `blocks`, (zone, text) in page order.  Each open
    element is closed once and looked up by name, so the time is linear."""

    def __init__(self):
        self.open: list[list[str]] = []          # [element, zone inside it]
        self.at: dict[str, list[int]] = {}       # places of the open elements of a name
        self.deep: list[int] = []                # places of the open block elements
        self.pieces: list[tuple[str, str]] = []  # of the block that is being read
        self.blocks: list[tuple[str, str]] = []
        self.zone = OTHER

    def text(self, text: str) -> None:
        self.pieces.append((self.zone, text))

    def flush(self) -> None:
        zones: dict[str, list[str]] = {}
        for zone, text in self.pieces:
            zones.setdefault(zone, []).append(text)
        for zone, parts in zones.items():
            text = " ".join("".join(parts).split())
            if text:
                self.blocks.append((zone, text))
        self.pieces = []

    def _last(self, names) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def _close(self, place: int) -> None:
        """Close the open elements from `place` on."""
        while len(self.open) > place:
            name = self.open.pop()[0]
            if name:
                self.at[name].pop()
        while self.deep and self.deep[-1] >= place:
            self.deep.pop()
        self.zone = self.open[-1][1] if self.open else OTHER

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.flush()
        if name in CLOSES:
            closed, walls = CLOSES[name]
            for same in {closed, name if name in ("dt", "dd") else closed, "p" if name in BLOCK else closed,
                         "th" if name == "td" else "td" if name == "th" else closed}:
                if self.at.get(same) and self.at[same][-1] > self._last(CLOSES["p"][1] if same == "p" else walls):
                    self._close(self.at[same][-1])
        if name in ("br", "td", "th"):
            self.text(" ")
        if name in VOID:
            return
        self.at.setdefault(name, []).append(len(self.open))
        if name in BLOCK:
            self.deep.append(len(self.open))
        self.zone = self.zone_of(name, attributes, self.zone)
        self.open.append([name, self.zone])

    @staticmethod
    def zone_of(name: str, attributes: str, inside: str) -> str:
        if inside == DROPPED or name in FURNITURE or (name == "header" and inside in (OTHER, ASIDE)):
            return DROPPED
        tokens: list[str] = []
        role = ""
        for key, value in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "").lower()):
                return DROPPED
            if key in ("class", "id", "role"):
                tokens += value.split()
            if key == "role":
                role = value.strip().lower()
        if name == "main" or role == "main":
            return MAIN
        if name == "article":
            said = {names_furniture(t, False) for t in tokens if {"comment", "comments", "reply"} & {w.lower() for w in WORD.findall(t)}}
            return DROPPED if DROPPED in said else INNER if inside in (ASIDE, INNER) else MAIN
        if inside == ASIDE or name in ("html", "body"):
            return inside
        within = inside in (MAIN, WEAK, HINTED, INNER)
        if not (within and name in RUNNING):
            words = {w.lower() for t in tokens for w in WORD.findall(t)}
            outer = not within and not words & MAIN_WORDS
            said = {names_furniture(t, outer) for t in tokens}
            if DROPPED in said:
                return DROPPED if within else ASIDE
            if HINTED in said and inside in (MAIN, WEAK):
                return HINTED
            if inside == OTHER and name in ("div", "section", "td") and words & MAIN_WORDS:
                return WEAK
        return inside

    def end(self, name: str) -> None:
        place = self.at[name][-1] if self.at.get(name) else -1
        if place < 0 or (name not in TABLE and self._last(WALLS) > place):
            if name == "p":  # read as an empty paragraph
                self.flush()
            return
        if name in BLOCK:
            self.flush()
        if name not in BLOCK and name not in TABLE and self.deep and self.deep[-1] > place:
            # an inline element around blocks that are still open: it alone ends
            self.at[name].pop()
            self.open[place] = ["", self.open[place - 1][1] if place else OTHER]
            return
        self._close(place)


def read_blocks(html: str | None) -> list[tuple[str, str]]:
    """(zone, text) of the blocks of a page, in page order."""
    reader, at, html = _Reader(), 0, html or ""
    while True:
        found = TAG.search(html, at)
        if not found:
            break
        if found.start() > at:
            reader.text(unescape(html[at : found.start()]))
        at = found.end()
        close, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if close:
            reader.end(name)
        elif name in RAW:
            past = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = past.end() if past else len(html)
        else:
            reader.start(name, attributes)
            if attributes.endswith("/") and name not in VOID and name not in BLOCK:
                reader.end(name)
    if at < len(html):
        reader.text(unescape(html[at:]))
    reader.flush()
    return reader.blocks


def main_zones(zones: set[str]) -> tuple[str, ...]:
    """The zones that are the main part of a page with blocks in `zones`."""
    return (MAIN,) if MAIN in zones else (INNER,) if INNER in zones else (WEAK,) if WEAK in zones else ()


def _parsed(pages: DataFrame) -> DataFrame:
    """Per page: `main`, the texts of its main part by block number, and its
    other blocks as parallel arrays of tokens, block numbers and whether a
    token may stay."""
    fields = "page_id, url, host, places, main, tokens, blocks, stays"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: dict[str, list] = {k: [] for k in ("places", "main", "tokens", "blocks", "stays")}
                for html in part.column(3).to_pylist():
                    read = read_blocks(html)
                    main = main_zones({zone for zone, _ in read})
                    out["places"].append([k for k, (z, _) in enumerate(read) if z in main])
                    out["main"].append([t for z, t in read if z in main])
                    rest = [(k, z, w) for k, (z, t) in enumerate(read) if z not in main for w in t.split()]
                    out["tokens"].append([w for _, _, w in rest])
                    out["blocks"].append([k for k, _, _ in rest])
                    out["stays"].append([z == HINTED if main else z == OTHER for _, z, _ in rest])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(out["places"], pa.list_(pa.int32())), pa.array(out["main"], pa.list_(pa.string())),
                     pa.array(out["tokens"], pa.list_(pa.string())), pa.array(out["blocks"], pa.list_(pa.int32())),
                     pa.array(out["stays"], pa.list_(pa.bool_()))], names=fields.split(", "))

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html").mapInArrow(
        run, f"page_id {kind}, url string, host string, places array<int>, main array<string>, tokens array<string>, "
             "blocks array<int>, stays array<boolean>")


def covered_positions(streams: DataFrame, min_tokens: int = 8, min_pages: int = 3) -> DataFrame:
    """`streams (host, stream, tokens, n)`, distinct -> `(stream, starts)`:
    where passages of `min_tokens` tokens begin that at least `min_pages`
    pages of the host share, a stream standing for `n` different pages.

    Suffixes are cut at `min_tokens` tokens and reduced to one row per
    stream; equal ones, neighbours in a suffix array, are one passage.
    """
    at = F.sequence(F.lit(0), F.size("tokens") - min_tokens)
    suffixes = (streams.where(F.size("tokens") >= min_tokens)
                .select("host", "stream", "tokens", "n", F.explode(at).alias("start"))
                .select("host", "stream", "n", "start", F.array_join(F.slice("tokens", F.col("start") + 1, min_tokens), " ").alias("suffix")))
    suffixes = cut(suffixes, "host-suffixes")
    shared = cut(suffixes.select("host", "suffix", "stream", "n").distinct()
                 .groupBy("host", "suffix").agg(F.sum("n").alias("n")).where(F.col("n") >= min_pages)
                 .select("host", "suffix"), "host-shared")
    return suffixes.join(shared, ["host", "suffix"]).groupBy("stream").agg(F.collect_list("start").alias("starts"))


def extract(pages: DataFrame, min_tokens: int = 8, min_pages: int = 3) -> DataFrame:
    """`page_id, url, text, n_chars, n_covered` of every page; `n_covered`
    counts the tokens of its stream that are shared boilerplate."""
    parsed = cut(_parsed(pages).withColumn("stream", F.xxhash64("host", "tokens")), "pages-parsed")
    streams = (parsed.select("stream", "host", "tokens", F.xxhash64("main").alias("main")).distinct()
               .groupBy("stream", "host", "tokens").agg(F.count(F.lit(1)).alias("n")))
    covered = cut(covered_positions(streams, min_tokens, min_pages), "pages-covered")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for places, main, tokens, blocks, stays, starts in zip(*(batch.column(k).to_pylist() for k in range(2, 8))):
                hidden = {p for s in starts or () for p in range(s, s + min_tokens)}
                counts.append(len(hidden))
                kept = {k: [text] for k, text in zip(places, main)}
                for k, (token, block, may) in enumerate(zip(tokens, blocks, stays)):
                    if may and k not in hidden:
                        kept.setdefault(block, []).append(token)
                texts.append("\n\n".join(" ".join(kept[b]) for b in sorted(kept)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_covered"])

    return (parsed.join(covered, "stream", "left")
            .select("page_id", "url", "places", "main", "tokens", "blocks", "stays", "starts")
            .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint, n_covered bigint"))
