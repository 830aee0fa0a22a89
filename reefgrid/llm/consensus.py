"""Main text of web pages by paths that the pages of a host agree on.

Each page scores its containers. The containers' generalised tag-class paths are
voted on per host, and every page is then read again through its host's winning
path, widened to what stands around it without noise; a page on which the path
holds nothing, or next to nothing, falls back on its own best container.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import slices, stored

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|object|select|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)[^>]*(?:>|\Z)",
    re.S | re.I,
)
#: A whole attribute, so that its value's words are no attributes.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: Elements that part blocks of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset(["hr"])
#: Elements that may hold a page's main text.
_CONTAINERS = frozenset("article body center div main section td".split())
#: Open elements that a new element of the same group ends.
_ENDED_BY = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}
#: For parts of lists and tables, the open elements that they end.
_ENDS = {tag: [t for t, enders in _ENDED_BY.items() if tag in enders] for tag in ("li", "dt", "dd", "tr", "td", "th")}
_LISTS = frozenset("ul ol menu dl table".split())
#: Elements and words of a class, id or role that mark what is not main text.
_NOISE_TAGS = frozenset("nav aside footer form menu dialog fieldset search".split())
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|adslot|advertorial|sponsor(?:ed|s)?|promo(?:tion|s)?|banners?|"
    r"sidebars?|aside|rail|menus?|nav|navbar|navigation|breadcrumbs?|topbar|toolbar|masthead|footer|foot|cookies?|consent|gdpr|notices?|"
    r"alerts?|warning|disclaimer|popups?|modal|overlay|newsletters?|subscribe|subscription|signup|login|search|share|sharing|social|"
    r"related|recommend(?:ed|ations?)?|comments?|commentlist|discussion|replies|reply|respond|disqus|widgets?|pagination|pager|"
    r"contentinfo|complementary|banner|skip|hidden|copyright)(?=$|[\s_-])",
    re.I,
)
#: What a layout has or lacks is not what its element is.
_LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-]\S*", re.I)
#: Noise words that also name parts of an article, where they are a section's id or mark a paragraph.
_TOPIC = re.compile(
    r"(?:^|(?<=[\s_-]))(?:notices?|alerts?|warning|disclaimer|search|navigation|share|sharing|social|related|recommend(?:ed|ations?)?|"
    r"discussion|promotion|advertising|consent|subscription|overlay|copyright)(?=$|[\s_-])", re.I)
#: Noise words of what readers add: it may outweigh the article.
_READERS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|discussion|replies|reply|respond|disqus)(?=$|[\s_-])", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_WELCOME = re.compile(r"(?:^|[\s_-])(?:article|articlebody|body|content|entry|main|post|story|text)(?=$|[\s_-])", re.I)
_DIGITS = re.compile(r"\d+")
#: Steps of a path that its name spells out (for reading only).
READABLE_STEPS = 12
#: A page's own container takes the place of its host's path if that holds less than this share of the other's text,
#: and the other at least so many characters.
LEAST_SHARE, TELLING_CHARS = 0.2, 200


class Page:
    """Blocks of text of a page, each with the chain of elements around it."""

    def __init__(self, source: str):
        self.steps: list[str] = [""]
        self.tags: list[str] = [""]
        self.parents: list[int] = [-1]
        self.noise: list[bool] = [False]
        self.named: list[str] = [""]  # names with a noise word
        self.inside: list[bool] = [False]  # within an article or main element
        self.welcome: list[bool] = [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of links
        self._read(source)
        self._judge()

    def _read(self, source: str) -> None:
        stack = [0]
        opened: Counter = Counter()  # elements of each tag on the stack: an end tag without a start is passed over at once
        parts: list[str] = []
        linked, in_link, at = 0, False, 0

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    self.blocks.append((stack[-1], text, min(linked, len(text))))
                parts.clear()
            linked = 0

        def close(depth: int) -> None:
            opened.subtract(self.tags[e] for e in stack[depth:])
            del stack[depth:]

        def add(text: str) -> None:
            nonlocal linked
            parts.append(text)
            if in_link:
                linked += len(text.strip())

        for match in _TOKEN.finditer(source):
            if match.start() > at:
                add(source[at : match.start()])
            at = match.end()
            tag = (match["tag"] or match["tag2"] or "").lower()
            if not tag:
                continue
            ends = bool(match["end"] or match["end2"])
            if tag == "a":
                in_link = not ends
                continue
            if tag == "br":
                parts.append(" ")
                continue
            if tag not in BLOCKS:
                continue
            flush()
            if ends:
                if opened[tag] > 0:
                    depth = len(stack) - 1
                    while self.tags[stack[depth]] != tag:
                        depth -= 1
                    close(depth)
                    in_link = False
                continue
            while len(stack) > 1 and tag in _ENDED_BY.get(self.tags[stack[-1]], ()):
                close(len(stack) - 1)
            if tag in _ENDS and any(opened[t] for t in _ENDS[tag]):
                for depth in range(len(stack) - 1, 0, -1):
                    open_ = self.tags[stack[depth]]
                    if open_ in _LISTS:
                        break
                    if tag in _ENDED_BY.get(open_, ()):
                        close(depth)
                        break
            if tag not in _VOID:
                stack.append(self._element(tag, match["attributes"] or "", stack[-1]))
                opened[tag] += 1
        if at < len(source):
            add(source[at:])
        flush()

    def _element(self, tag: str, attributes: str, parent: int) -> int:
        step, noise, named, welcome = tag, False, "", False
        if attributes.strip():
            found: dict[str, str] = {}
            for name, *values in _ATTRIBUTE.findall(attributes):
                found.setdefault(name.lower(), "".join(values))
            names = " ".join(found.get(a, "") for a in ("class", "id", "role"))
            classes = sorted(_DIGITS.sub("#", c) for c in found.get("class", "").split())
            step = ".".join([tag, *classes])
            if tag not in ("body", "html"):
                noise = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
                named = _noise_names(tag, found)
            welcome = bool(_WELCOME.search(names))
        inside = self.inside[parent]
        self.steps.append("" if tag in ("html", "body") else step)
        self.tags.append(tag)
        self.parents.append(parent)
        self.noise.append(self.noise[parent] or noise or tag in _NOISE_TAGS or (tag == "header" and not inside))
        self.named.append(named)
        self.inside.append(inside or tag in ("article", "main"))
        self.welcome.append(welcome)
        return len(self.tags) - 1

    def _judge(self) -> None:
        """Elements named with a noise word are noise, and all below them, unless they hold the page's main text.

        They hold it with a main element, with an article where none stands clear
        of noise, or with most of the page's text. What readers add is no main
        text by its size.
        """
        size = len(self.tags)
        flagged = [bool(n) for n in self.named]
        if not any(flagged):
            return
        weight, mains, articles = [0] * size, [0] * size, [0] * size
        for element, text, linked in self.blocks:
            if not self.noise[element]:
                weight[element] += len(text) - linked
        clear, apart = [True] * size, False  # clear of noise words; whether an article is
        for e in range(1, size):
            clear[e] = clear[self.parents[e]] and not flagged[e]
            if not self.noise[e]:
                mains[e] = self.tags[e] == "main"
                articles[e] = self.tags[e] == "article" and not flagged[e]
                apart = apart or (clear[e] and self.tags[e] == "article")
        for e in range(size - 1, 0, -1):
            for held in (weight, mains, articles):
                held[self.parents[e]] += held[e]
        for e in range(1, size):
            if flagged[e] and not self.noise[self.parents[e]]:
                holds = mains[e] or (articles[e] and not apart and (not mains[0] or self.inside[e]))
                most = 2 * weight[e] > weight[0] and not _READERS.search(self.named[e])
                self.noise[e] = self.noise[e] or not (holds or most)
            self.noise[e] = self.noise[e] or self.noise[self.parents[e]]

    def paths(self) -> list[str]:
        """The generalised steps to every container, html and body, which may be left out, being none: the innermost
        READABLE_STEPS as they are, and a chained hash of all of them, so that any depth tells paths apart."""
        out, chain, size = [""] * len(self.tags), [""] * len(self.tags), len(self.tags)
        for element in range(1, size):
            step, above = self.steps[element], chain[self.parents[element]]
            chain[element] = xxhash.xxh3_64_hexdigest(f"{above}/{step}") if step else above
            if self.tags[element] in _CONTAINERS and chain[element]:
                steps, up = [], element
                while up > 0 and len(steps) < READABLE_STEPS:
                    if self.steps[up]:
                        steps.append(self.steps[up])
                    up = self.parents[up]
                out[element] = "/".join(reversed(steps)) + "#" + chain[element]
        return out

    def scores(self) -> dict[int, float]:
        """Text that each container holds itself, and half of what its child containers hold."""
        held: dict[int, float] = {}
        for element, text, linked in self.blocks:
            if not self.noise[element]:
                held[element] = held.get(element, 0.0) + len(text) - 2.0 * linked
        out: dict[int, float] = {}
        for element in range(len(self.tags) - 1, 0, -1):  # parents come before their children
            if element in held:
                gain = held[element]
                if self.tags[element] in _CONTAINERS:
                    out[element] = gain
                    gain /= 2
                parent = self.parents[element]
                held[parent] = held.get(parent, 0.0) + gain
        for element in out:
            if self.tags[element] in ("article", "main"):
                out[element] *= 4
            elif self.welcome[element]:
                out[element] *= 2
        return out

    def votes(self) -> dict[str, int]:
        """Per mille of the best score that the page's good container paths reach."""
        by_path: dict[str, float] = {}
        paths = self.paths()
        for element, score in self.scores().items():
            path = paths[element]
            by_path[path] = by_path.get(path, 0.0) + score
        best = max(by_path.values(), default=0.0)
        return {p: round(1000 * s / best) for p, s in by_path.items() if p and best > 0 and s >= best / 2}

    def text(self, path: str | None) -> str:
        """Blocks within the elements of ``path``, widened; without such, or if the page's best container holds far more, within that, or all."""
        roots = set()
        if path:
            paths = self.paths()
            roots = {i for i, t in enumerate(self.tags) if t in _CONTAINERS and not self.noise[i] and paths[i] == path}
        scores = self.scores()
        inside = self._within(self._widened(roots))
        own = self._within(self._widened({max(scores, key=lambda e: (scores[e], -e))} if scores else {0}))
        found, most = self._held(inside), self._held(own)
        if not any(inside[e] and not self.noise[e] for e, _, _ in self.blocks) or most >= TELLING_CHARS and found < LEAST_SHARE * most:
            inside = own
        return "\n".join(t for e, t, _ in self.blocks if inside[e] and not self.noise[e])

    def _held(self, inside: list[bool]) -> int:
        """Characters of text, links left out, of the blocks that are no noise."""
        return sum(len(t) - linked for e, t, linked in self.blocks if inside[e] and not self.noise[e])

    def _widened(self, roots: set[int]) -> set[int]:
        """For each root, its article or main element if it is in one, and from there the outermost container that adds no noise."""
        noisy = [0] * len(self.tags)  # blocks of noise in each element
        for element, _, _ in self.blocks:
            noisy[element] += self.noise[element]
        for element in range(len(self.tags) - 1, 0, -1):
            noisy[self.parents[element]] += noisy[element]
        size = len(self.tags)
        main, widest = [0] * size, [0] * size  # the article or main element around each element, and where it widens to
        for e in range(1, size):  # parents come before their children
            up = self.parents[e]
            main[e] = e if self.tags[e] in ("article", "main") else main[up]
            # Whoever adds no noise goes where its parent goes; a parent that is no container passes on what lies above it.
            widest[e] = widest[up] if widest[up] and noisy[up] == noisy[e] else e if self.tags[e] in _CONTAINERS and self.tags[e] != "body" else 0
        out = set()
        for root in roots:
            start = main[root] or root
            out.add(widest[start] or start)
        return out

    def _within(self, roots: set[int]) -> list[bool]:
        """Whether each element is one of ``roots`` or within one."""
        out = [0 in roots]
        for element in range(1, len(self.tags)):
            out.append(element in roots or out[self.parents[element]])
        return out


def _noise_names(tag: str, found: dict[str, str]) -> str:
    """The names of an element whose class, id or role has a noise word; empty if none has."""
    if tag in _HEADINGS:
        return ""
    own, mark = _LAYOUT.sub("", " ".join(found.get(a, "") for a in ("class", "role"))), _LAYOUT.sub("", found.get("id", ""))
    if tag == "p":
        own = _TOPIC.sub("", own)
    if tag in ("p", "section"):
        mark = _TOPIC.sub("", mark)
    names = f"{own} {mark}"
    return names if _NOISE.search(names) else ""


def host_of(url: Column) -> Column:
    """Lower-cased host of an absolute address; empty for anything else."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        votes: dict[tuple[str, str], int] = {}
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for path, vote in Page(source or "").votes().items():
                votes[host, path] = votes.get((host, path), 0) + vote
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), pa.array(list(votes.values()), pa.int64())],
            ["host", "path", "votes"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [Page(source or "").text(path) for source, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), batch.column(3)],
            ["page_id", "url", "text", "n_chars", "path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: the container path with most votes among each host's pages; ties go to the later path name."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html")
    votes = rows.mapInArrow(_vote, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = votes.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best"))
    return best.select("host", F.col("best.path").alias("path"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars, path)`` of every page row.

    Text is the blocks of the main containers without menus, headers, footers,
    sidebars, notices, adverts, forms and comments; character references are
    decoded, white space within a block is one space, blocks are joined by line
    feeds. Null and empty pages have empty texts. Pages without a readable host
    vote together. Pages are read whole, in time that grows with their length alone,
    however deep or broken. Repeated rows give a row each; other columns are
    ignored; an empty table gives no rows.
    """
    paths = stored(host_paths(pages), "host-paths")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(paths, "host", "left")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return rows.select("page_id", "url", "html", "path").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, path string")
