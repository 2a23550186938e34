"""Main text of HTML pages, by text-to-tag ratios of the lines that a streaming parser reports.

The standard library's parser sends events; block elements cut the page into lines. Each line has a text-to-tag
ratio (its characters by the tags it took), zero where its element can hold no article text (menus, forms,
scripts, adverts, comments, ...). The ratios are smoothed with a Gaussian, two clusters are cut apart by a
threshold, and the element that holds the lines of the upper cluster is the content region: the article
where the page names one, with the title and lead that the element around it has besides, else the deepest container
around all of that text. All of the region's readable lines are returned, short ones too.

Names of classes and ids, and forms, only say what is likely to be no article. Their text is read as well: where nothing of a sentence's length is
left without it, or where one of them holds the page's heading and nearly all of its text, and no article is named, that element
counts as any other. So a page with text outside real boilerplate always has a text.

Elements are numbered and know the one around them, so time and memory grow with the page, however deep its markup is.

Defined results: a null, empty or text-free page gives an empty string and zero characters. Open or crossed
elements are closed as a browser would close them. Each row is worked on alone, so repeated rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements by role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
SILENT = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea iframe object svg canvas "
    "audio video menu dialog math datalist map".split())
ARTICLES = frozenset(["article", "main"])
PIECES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption legend summary figcaption pre address".split())  # no containers of an article
SILENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Parts of class names and ids that mark an element around the article, not of it; and how such parts may begin.
SILENT_NAMES = frozenset(
    "ad ads adsense adslot adunit adbox alert alerts breadcrumb breadcrumbs comment comments commentlist consent copyright cta disclaimer "
    "discussion disqus footer gdpr login masthead menu modal nav navbar navigation notification overlay paginate pagination paywall popup "
    "privacy promo promoted promotion rail recommendations recommended related remark remarks replies reply respond responses share "
    "sharing sidebar signup skip subscribe toolbar topbar trending widget widgets".split())
NOT_SILENT = frozenset("commentary commentaries commentator commentators".split())
SILENT_BEGINNINGS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "social", "sponsor")
#: Names that do so unless the same class names the article too; the second ones only outside an article.
WEAK_NAMES = frozenset("banner hidden notice notices review reviews search teaser teasers warning".split())
OUTER_NAMES = frozenset("byline header".split())
OWN_NAMES = frozenset("article content entry main post story".split())
#: Elements that a start tag closes if they are open, up to the nearest element given second.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
             "option": ({"option"}, {"select"})}
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _named_silent(attrs: dict[str, str | None], in_article: bool) -> bool:
    """Whether role, state, class or id say that the element holds no article text."""
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    if (attrs.get("role") or "").lower() in SILENT_ROLES or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.I):
        return True
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        parts = [p.lower() for p in NAME_PARTS.findall(name)]
        if parts[:1] and parts[0] in ("has", "with", "no", "without", "js"):
            continue
        if SILENT_NAMES.intersection(parts) or any(p.startswith(SILENT_BEGINNINGS) for p in parts if p not in NOT_SILENT):
            return True
        weak = WEAK_NAMES if in_article else WEAK_NAMES | OUTER_NAMES
        if weak.intersection(parts) and not OWN_NAMES.intersection(parts):
            return True
    return False


class PageLines(HTMLParser):
    """Cuts a page into lines: (text, tags, links' characters, innermost element), surely silent elements left out.

    Elements are numbered from 1 as they open; 0 is the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []  # (tag, element's number)
        self.count: dict[str, int] = {}  # of open elements by tag
        self.parent = [0]
        self.near = [0]  # the article that each element is or lies in
        self.silent: dict[int, bool] = {}  # open silent elements; True where only a name or a form says so
        self.sure = 0  # of these, the others
        self.named: set[int] = set()  # elements that only a name or a form says to be silent
        self.articles: dict[int, int] = {}  # article elements and the article around each
        self.pieces: set[int] = set()
        self.headings: list[int] = []  # elements that are first headings
        self.lines: list[tuple[str, int, int, int]] = []
        self.text: list[str] = []
        self.tags = self.links = self.linked = 0  # tags of the line, open links, characters in links

    def cut(self) -> None:
        """Ends the line."""
        line = " ".join("".join(self.text).split())
        self.text.clear()
        if line:
            self.lines.append((line, self.tags, self.linked, self.open[-1][1] if self.open else 0))
            self.tags = self.linked = 0

    def put(self, tag: str, article: bool = False) -> int:
        """A new element within the open one."""
        around = self.open[-1][1] if self.open else 0
        made = len(self.parent)
        self.parent.append(around)
        self.near.append(made if article else self.near[around])
        self.open.append((tag, made))
        self.count[tag] = self.count.get(tag, 0) + 1
        return made

    def close_to(self, at: int) -> None:
        for tag, n in self.open[at:]:
            self.count[tag] -= 1
            self.sure -= self.silent.pop(n, True) is False
        del self.open[at:]

    def hush(self, n: int, by_name: bool) -> None:
        self.silent[n] = by_name
        self.sure += not by_name
        if by_name:
            self.named.add(n)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
            return
        if tag not in BLOCKS and tag not in SILENT:
            if tag in VOID:
                return
            self.links += tag == "a"
            named = dict(attrs)  # an inline element: only its silence counts
            if named and _named_silent(named, bool(self.articles)):
                made = self.put(tag)
                self.hush(made, True)
                self.pieces.add(made)
            return
        self.cut()
        if tag in BLOCKS:
            for i in range(len(self.open) - 1, -1, -1):  # a block ends an open paragraph
                if self.open[i][0] == "p":
                    self.close_to(i)
                    break
                if self.open[i][0] in BLOCKS:
                    break
        shut, until = CLOSED_BY.get(tag, ((), ()))
        at = None
        if any(self.count.get(t) for t in shut):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in until:
                    break
                if self.open[i][0] in shut:
                    at = i
        if at is not None:
            self.close_to(at)
        if tag in VOID:
            return
        if tag == "body" and self.count.get("head"):  # what the head has left open ends here
            self.close_to(next(i for i, (t, _) in enumerate(self.open) if t == "head"))
        named = dict(attrs)
        article = tag in ARTICLES or (named.get("role") or "").lower() in ("main", "article") or "articlebody" in (named.get("itemprop") or "").lower()
        around = self.near[self.open[-1][1]] if self.open else 0
        by_name = tag == "form" or tag not in SILENT and tag not in ("html", "body", "main") and _named_silent(named, bool(around))
        quiet = tag in SILENT and tag != "form" or tag == "header" and not around
        made = len(self.parent)
        if article and not quiet and not by_name:
            for n in [n for n, only_named in self.silent.items() if only_named]:  # a wrapper, after all
                del self.silent[n]
                self.named.discard(n)
            if not self.sure:
                self.articles[made] = around
        self.put(tag, made in self.articles)
        if quiet or by_name:
            self.hush(made, not quiet)
        if tag in PIECES:
            self.pieces.add(made)
        if tag == "h1" and not self.sure:
            self.headings.append(made)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "canvas", "iframe", "object", "math", "video", "audio"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a" and self.links:
            self.links -= 1
        if tag in BLOCKS or tag in SILENT:
            self.cut()
        if not self.count.get(tag):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.close_to(i)
                return

    def handle_data(self, data: str) -> None:
        if not self.sure:
            self.text.append(data)
            self.linked += len(data.strip()) if self.links else 0


def smooth(signal: np.ndarray, sigma: float) -> np.ndarray:
    """The signal after a Gaussian, edges weighted by what lies inside."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    pad = np.pad(signal, reach)
    return np.convolve(pad, kernel, "valid") / np.convolve(np.pad(np.ones(len(signal)), reach), kernel, "valid")


def threshold(values: np.ndarray) -> float:
    """The cut between two clusters: midway between their means, found by alternating."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values <= cut], values[values > cut]
        if not len(low) or not len(high):
            break
        moved = (float(low.mean()) + float(high.mean())) / 2
        if abs(moved - cut) < 1e-9:
            break
        cut = moved
    return cut


def readable(parser: PageLines, region_share: float, sentence: int) -> list[tuple[str, int, int, int]]:
    """The lines without those in elements that a name or a form silences, and with those of which it was no good sign.

    The tags of lines left out count for the next one.
    """
    parent, lifted = parser.parent, set[int]()
    weights = [len(text) if len(text) >= sentence and 2 * linked <= len(text) else 0 for text, _, linked, _ in parser.lines]
    held = [0] * len(parent)
    for weight, (_, _, _, n) in zip(weights, parser.lines):
        held[n] += weight
    for n in range(len(parent) - 1, 0, -1):  # an element is numbered before those in it
        held[parent[n]] += held[n]
    while True:
        silenced = [0] * len(parent)  # the outermost silent element around each
        for n in range(1, len(parent)):
            silenced[n] = silenced[parent[n]] or (n if n in parser.named and n not in lifted else 0)
        outermost = {silenced[n] for _, _, _, n in parser.lines} - {0}
        most = max(outermost, key=lambda n: (held[n], -n), default=0)
        whole = most and held[most] >= region_share * held[0] and any(silenced[h] == most for h in parser.headings)
        kept = held[0] > sum(held[n] for n in outermost)
        if not most or not held[most] or kept and (parser.articles or not whole):
            break
        # With it, silent elements that are wrappers within the wrapper.
        lifted |= {n for n in parser.named if silenced[n] == most and held[n] >= region_share * held[most]}
    lines, carried = [], 0
    for text, tags, linked, n in parser.lines:
        if silenced[n]:
            carried += tags
        else:
            lines.append((text, tags + carried, linked, n))
            carried = 0
    return lines


def main_text(page: str, sigma: float = 1.0, region_share: float = 0.8, article_share: float = 0.2, sentence: int = 80) -> str:
    """The page's article, its lines joined by a line break."""
    parser = PageLines()
    parser.feed(page)
    parser.close()
    parser.cut()
    lines = readable(parser, region_share, sentence)
    if not lines:
        return ""
    parent, articles = parser.parent, parser.articles
    ratios = smooth(np.array([len(text) / max(1, tags) for text, tags, _, _ in lines], float), sigma)
    cut = threshold(ratios)
    mass, met = [0] * len(parent), [False] * len(parent)
    for (text, _, _, n), ratio in zip(lines, ratios):
        mass[n] += len(text) if ratio >= min(cut, ratios.max()) else 0
        met[n] = True
    for n in range(len(parent) - 1, 0, -1):
        mass[parent[n]] += mass[n]
        met[parent[n]] |= met[n]
    held = {n: mass[n] for n in articles if met[n]}
    outer: set[int] = set()
    if held and max(held.values()) > 0:
        # An article within main is the finer region; teasers hold little next to the largest. Of main, what no article has.
        finest: dict[int, int] = {}  # the most that an article within each holds
        for n in sorted(held, reverse=True):
            if articles[n]:
                finest[articles[n]] = max(finest.get(articles[n], 0), held[n], finest.get(n, 0))
        coarse = {n for n, m in finest.items() if m >= region_share * held.get(n, 0)}
        inner = {n: m for n, m in held.items() if n not in coarse}
        least = article_share * max(inner.values())
        chosen = {n for n, m in inner.items() if m >= least}
        wider: set[int] = set()
        for n in chosen:
            while (n := articles[n]) and n not in wider:
                wider.add(n)
        outer = wider & coarse
    elif held:
        chosen = set(held)
    else:
        # Next to a very long paragraph, a line of a sentence's length is text still.
        upper = [0] * len(parent)
        for (text, _, linked, n), ratio in zip(lines, ratios):
            upper[n] += bool(ratio >= min(cut, ratios.max()) or len(text) >= sentence and 2 * linked <= len(text))
        for n in range(len(parent) - 1, 0, -1):
            upper[parent[n]] += upper[n]
        # Elements are numbered as they open: of those around all of it the last is the deepest.
        chosen = {max((n for n in range(1, len(parent)) if upper[n] == upper[0] and n not in parser.pieces), default=0)} - {0}
    within = [False] * len(parent)
    for n in range(1, len(parent)):
        within[n] = n in chosen or within[parent[n]]
    kept = []
    for (text, _, linked, n), ratio in zip(lines, ratios):
        inside = not chosen or within[n]
        if inside or parser.near[n] in outer:
            # Lists of links before and behind the text, where it is in no article, are menus.
            kept.append((text, (not held or not inside) and ratio < cut and 2 * linked > len(text)))
    menu = [m for _, m in kept]
    kept = kept[next((i for i, m in enumerate(menu) if not m), 0):len(kept) - next((i for i, m in enumerate(menu[::-1]) if not m), 0)]
    return "\n".join(text for text, _ in kept)


EXTRACTED = pa.struct([("text", pa.string()), ("n_chars", pa.int64())])


def article(html: Column) -> Column:
    """The main text of an HTML column and its code points, as a struct."""

    @F.arrow_udf("text string, n_chars bigint")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch]
            yield pa.StructArray.from_arrays(
                [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], fields=list(EXTRACTED))

    return extract(html)


def extract_pages(pages: DataFrame, html: str = "html", into: str = "article") -> DataFrame:
    """``pages`` with the struct of ``article`` as one more column."""
    return pages.withColumn(into, article(F.col(html)))
