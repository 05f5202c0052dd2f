"""Main text of web pages by a site style tree.

The pages of a host are merged by presentation: a node of the tree is a chain of block elements with
their classes, and holds, over all pages, how often each content occurs there. A node's content
importance is the entropy of these contents, set against what as many different pages could have:
what a site repeats (menus, imprints, rotating notices) has little, articles have much. A node's
presentation importance is none if its elements say that they are no article text. Branches without
importance are removed from each page; what is left is the page's text. What only class words speak
against stays where an article or main element is in it, where its content entropy is high, and where
a page would have no text without it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.storage import stored

# Elements and words as page authors use them.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style noscript template svg math object iframe canvas audio video".split())
ASIDE = set("nav footer aside form button select textarea dialog menu".split())
WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer form header login masthead menu modal nav navbar "
    "navigation newsletter notice notices popup promo promoted recommended related respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Class names of a layout or a state, such as has-sidebar and comments-open, do not name what an element is.
LAYOUT = re.compile(r"(?:has|no|with|without|category|tag)[-_].*|.*[-_](?:page|open|closed|enabled|disabled)")
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
ARTICLE = {"article", "main"}
#: A start tag ends these open elements, up to the nearest of the second group.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
SPACE = re.compile(r"\s+")


#: What is known where no element is open.
OUTSIDE = ("", 0, False, False, False, 0)


class PageBlocks(HTMLParser):
    """Text blocks of a page in order, each with a number for its chain of block elements.

    An open element keeps what is known of its chain, so a step costs the same at any depth.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Element, number of its chain, unseen, no article text, inside an article, innermost mark.
        self.stack: list[tuple[str, int, bool, bool, bool, int]] = []
        self.places: dict[str, list[int]] = {}  # where in the stack each element is open
        self.pieces: list[str] = []
        self.blocks: list[tuple[int, str, bool, bool, int]] = []  # chain, text, no article text, inside an article, innermost mark
        # Elements marked by their class words, by the mark around each (0: none), and those that are or hold
        # a main or another article, with all marks around these.
        self.around = [0]
        self.main = False
        self.held: dict[bool, set[int]] = {True: {0}, False: {0}}  # by whether a main element is meant

    def _break(self) -> None:
        text = SPACE.sub(" ", "".join(self.pieces)).strip()
        self.pieces = []
        _, chain, unseen, aside, article, mark = self.stack[-1] if self.stack else OUTSIDE
        if text and not unseen:
            self.blocks.append((chain, text, aside, article, mark))

    def _last(self, tags: Iterable[str]) -> int:
        """Where the innermost open element of some kinds is, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _close(self, to: int) -> None:
        for element, *_ in reversed(self.stack[to:]):
            self.places[element].pop()
        del self.stack[to:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.pieces.append(" ")
        if tag in INLINE or tag in VOID and tag != "hr":
            return
        self._break()
        if tag in VOID:
            return
        closes, within = ENDS.get(tag, ({"p"}, {"button", "table", "caption", "td", "th"}))
        if (to := self._last(closes)) > self._last(within):
            self._close(to)
        given = {k: v or "" for k, v in attrs}
        names = f"{given.get('class', '')} {given.get('id', '')}".lower()
        words = set(re.split(r"[^a-z]+", names))
        _, chain, unseen, aside, article, mark = self.stack[-1] if self.stack else OUTSIDE
        aside = aside or tag in ASIDE or tag == "header" and not article or given.get("role", "").lower() in ROLES
        aside = aside or "hidden" in given or given.get("aria-hidden") == "true"
        if tag not in ("html", "body") and words & WORDS and any(not LAYOUT.fullmatch(n) and WORDS & set(re.split(r"[^a-z]+", n)) for n in names.split()):
            self.around.append(mark)
            mark = len(self.around) - 1
        # An article inside an article is a comment or the like.
        if tag == "main" or tag == "article" and not self.places.get("article"):
            held = self.held[tag == "main" or bool(self.places.get("main"))]
            holder = mark
            while holder not in held:
                held.add(holder)
                holder = self.around[holder]
            self.main = self.main or tag == "main"
        style = ".".join([tag, *sorted(words - {""})])
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, _number(f"{chain}/{style}"), unseen or tag in UNSEEN, aside, article or tag in ARTICLE, mark))

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE and tag not in VOID and (to := self._last((tag,))) >= 0:
            self._break()
            self._close(to)

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)


def page_blocks(html: str | None) -> list[tuple[int, str, bool, bool, bool]]:
    """(number of the style chain, text, no article text, inside an article, class words against it) of every block with text."""
    parser = PageBlocks()
    parser.feed(html or "")
    parser.close()
    parser._break()
    held = parser.held[True] if parser.main else parser.held[False]
    return [(*block, mark not in held) for *block, mark in parser.blocks]


def _number(text: str) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(text.encode()), "little", signed=True)


def _contents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and style, the content that the page has there, and a name of all that the page has."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            hosts, names, styles, contents, spoken = [], [], [], [], []
            for host, html in zip(batch.column("host")[at : at + 256].to_pylist(), batch.column("html")[at : at + 256], strict=True):
                own: dict[int, list[str]] = {}
                against = set()
                for style, text, _, _, words in page_blocks(html.as_py()):
                    own.setdefault(style, []).append(text)
                    if words:
                        against.add(style)
                here = [(style, _number("\n".join(texts))) for style, texts in own.items()]
                hosts += [host] * len(here)
                names += [_number(str(here))] * len(here)
                styles += [style for style, _ in here]
                contents += [content for _, content in here]
                spoken += [style in against for style in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(names, pa.int64()), pa.array(styles, pa.int64()), pa.array(contents, pa.int64()), pa.array(spoken, pa.bool_())],
                names=["host", "page", "style", "content", "words"],
            )


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = []
            for html, low, high in zip(part.column("html"), part.column("low"), part.column("high"), strict=True):
                unimportant, important = set(low.as_py() or ()), set(high.as_py() or ())
                left = [b for b in page_blocks(html.as_py()) if not b[2] and (not unimportant or b[0] not in unimportant)]
                # Without other text, class words do not decide.
                left = [b for b in left if not b[4] or important and b[0] in important] or left
                inside = [b for b in left if b[3]]
                texts.append("\n".join(b[1] for b in inside or left))
            names = [n for n in part.schema.names if n not in ("html", "low", "high")]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "text"])


def style_importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, style, pages, words, importance): the merged style tree's nodes with text; words if class words speak against one.

    Copies of a page count once. Importance is the entropy of a node's contents over the pages that
    have it, divided by the logarithm of their number, or by the host's largest entropy if that is
    less; so a large host beside it makes no node less important. Rows are merged in the tasks first
    and dealt by page and content, so a hot host is spread over all of them.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(host.alias("host"), F.col(html_col).alias("html")).mapInArrow(_contents, "host string, page long, style long, content long, words boolean")
    counts = rows.distinct().groupBy("host", "style", "content").agg(F.count("*").alias("n"), F.max("words").alias("words"))
    # -sum(n/m log(n/m)) = log(m) - sum(n log n) / m
    nodes = counts.groupBy("host", "style").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"), F.max("words").alias("words"))
    nodes = stored(nodes.select("host", "style", "pages", "words", F.greatest(F.lit(0.0), F.log("pages") - F.col("s") / F.col("pages")).alias("entropy")), "style-nodes")
    most = nodes.groupBy("host").agg(F.max("entropy").alias("most"))
    possible = F.least(F.col("most"), F.log("pages"))
    share = F.when(possible > 0, F.col("entropy") / possible).otherwise(F.lit(1.0))
    return nodes.join(most, "host").select("host", "style", "pages", "words", share.alias("importance"))


def extract_text(
    pages: DataFrame, least_importance: float = 0.6, least_pages: int = 20, url_col: str = "url", html_col: str = "html", high_importance: float = 0.9,
) -> DataFrame:
    """The rows of `pages` without their html, with `text` and `n_chars`.

    Blocks are joined by a line feed, white space in a block is one space, character references are
    decoded. Where a page has article text inside an article or main element, that is its text; else
    all that is left. Nodes that less than `least_pages` different pages of a host have are judged by their
    presentation alone. A null or empty html gives an empty text, a null or odd url belongs to a host
    of its own name; copies of a page count as one page. Nodes of at least `high_importance` stay
    whatever their class words are. Columns of `pages` called text or n_chars are
    replaced.
    """
    pages = pages.drop("text", "n_chars")
    others = [c for c in pages.columns if c != html_col]
    low, high = F.col("importance") < least_importance, F.col("words") & (F.col("importance") >= high_importance)
    known = style_importance(pages, url_col, html_col).where((low | high) & (F.col("pages") >= least_pages))
    # One row per host: the styles of its templates, and of its texts with class words.
    known = known.groupBy(F.col("host").alias("known_host")).agg(F.collect_set(F.when(low, F.col("style"))).alias("low"), F.collect_set(F.when(high & ~low, F.col("style"))).alias("high"))
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    plain = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(html_col).alias("html"), host.alias("own_host"))
    joined = plain.join(known, plain.own_host == known.known_host, "left").select(*[f"c{i}" for i in range(len(others))], "html", "low", "high")
    schema = joined.drop("html", "low", "high").withColumn("text", F.lit("")).schema
    out = joined.mapInArrow(_texts, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "text", F.char_length("text").cast("long").alias("n_chars"))
