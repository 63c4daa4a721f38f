"""Main text of web pages by two-pass block rules.

A page is cut into blocks of text at block-level tags. The first pass judges each block by itself: link density, length
and the share of stop words of the page's language make it good, bad, nearly good or short. The second pass decides the last two from the
nearest decided blocks before and after them. Elements that say what they are (navigation, footers, forms,
adverts, notices, comments, by tag, role, class or id) are left out beforehand, and where a page marks its article, only blocks
inside it are judged and need no share of stop words there, so that lists, tables and foreign words of an article stay. Nor is
a share needed on a page that marks no article and whose long blocks show that it is in none of the languages listed here.

Elements whose end tag may be missing (paragraphs, items of lists, rows and cells of tables, the head) end where HTML ends them.
A class or id tells what an element is as a whole name or where the rest of its parts are plain words of place and shape
("main-nav", not "overflow-hidden" or "elementor-widget-container").

Each page is one row of a map; nothing is shuffled and memory is bounded by an Arrow batch.

Defined results: null, empty and markup-only pages give an empty text. White space (Unicode) inside a block becomes one
space, character references are decoded once, also those without a semicolon where HTML knows them. A page cut off in
a tag, comment, script or quoted attribute ends there. Repeated pages give repeated rows. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of four languages.
STOP_LISTS = [
    frozenset(words.split())
    for words in (
        """a about after all also an and are as at be been but by can for from had has have he her his if in into is it its more
        not of on one or other she so that the their there they this to was we were which who will with would you""",
        """aber als am an auch auf aus bei das dass dem den der des die durch ein eine einen einer er es für hat ich im ist mit nach
        nicht noch nur oder sich sie sind und von vor war werden wie wird zu zum zur über""",
        """au aux avec ce ces cette dans de des du elle en est et il ils la le les leur lui mais ne nous on ont ou par pas plus
        pour qu que qui sa se ses son sont sur un une vous""",
        """al como con del el ella entre era es esta este fue ha hay la las lo los más no o para pero por que se si sin sobre son su sus
        también un una y ya""",
    )
]
STOP_WORDS = frozenset().union(*STOP_LISTS)

# Names of HTML.
BLOCK_TAGS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th
    thead title tr ul""".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT_TAGS = frozenset(
    "head nav aside form footer menu dialog button select option datalist template svg math canvas object audio video map noscript".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
LEFT_OUT_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie
    cookies copyright disqus footer gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices
    overlay pager pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup
    social sponsor sponsored subscribe tagcloud toolbar widget widgets""".split()
)
#: Left out only as a whole name or as here; elsewhere it says when a thing is hidden.
HIDDEN = "hidden"
HIDDEN_NAMES = frozenset(["hidden", "is-hidden", "visually-hidden"])
#: Words of place and shape that may stand beside a name that is left out.
PLAIN_PARTS = frozenset(
    """above area article articles bar below block body bottom box btn button buttons container desktop dialog dfp email entry form
    global google group head header icon icons inner item items js left link links list main media mobile page panel post posts
    primary right secondary section site slot sticky stories sub text title top unit wrap wrapper""".split()
)
#: Left out only outside an article, where they head the site and not the text.
SITE_HEAD = "header"
MAIN_TAGS = frozenset(["article", "main"])
#: Classes of these say how the page looks, not what the element is.
PAGE_TAGS = frozenset(["html", "body", "article", "main"])
#: Elements whose end tag may be missing: the start tags that end them, and the elements that shield them from these.
TABLE_PARTS = frozenset("caption thead tbody tfoot".split())
ENDED_BY = {
    "p": BLOCK_TAGS,
    "li": frozenset(["li"]),
    **dict.fromkeys(("dt", "dd"), frozenset(["dt", "dd"])),
    **dict.fromkeys(("td", "th"), frozenset(["td", "th", "tr"]) | TABLE_PARTS),
    "tr": frozenset(["tr"]) | TABLE_PARTS,
    "caption": frozenset(["td", "th", "tr"]) | TABLE_PARTS,
    **dict.fromkeys(("thead", "tbody", "tfoot"), TABLE_PARTS),
}
SHIELDS = {
    **dict.fromkeys(("td", "th", "tr", *TABLE_PARTS), frozenset(["table"])),
    **dict.fromkeys(("dt", "dd"), frozenset(["dl", "table"])),
    "li": frozenset("ul ol menu dir table".split()),
    "p": frozenset("table caption td th button object template".split()),
}
HEAD_TAGS = frozenset("base basefont bgsound link meta noscript script style template title".split())

MAX_LINK_DENSITY = 0.2
MAX_MAIN_LINK_DENSITY = 0.5
SHORT_CHARS = 70
LONG_CHARS = 200
#: Fitted: with its article tags renamed, the pages table keeps more than 95 % of the article's blocks and gains none.
STOP_LOW = 0.08
STOP_HIGH = 0.10
#: Below this share of stop words in its long blocks a page is in a language that is not listed.
STOP_FOREIGN = 0.20
#: A long block with this share shows that it is not.
STOP_LISTED = 0.30

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |</?[a-zA-Z][^>]*+(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
LETTERS = re.compile(r"[^\W\d_]+")
WIDE = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
WIDE_CHARS = 3


@dataclass
class Block:
    text: str
    link_chars: int
    main: bool
    heading: bool
    label: str = ""

    @property
    def link_density(self) -> float:
        return min(self.link_chars / max(len(self.text), 1), 1.0)


def attributes(source: str) -> dict[str, str]:
    if "=" not in source and "hidden" not in source.lower():
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


def left_out(tag: str, source: str, in_main: bool) -> bool:
    """Whether an element says that it is not part of the article."""
    if tag in LEFT_OUT_TAGS or (tag == SITE_HEAD and not in_main):
        return True
    if tag in ("html", "body") or not source.strip():
        return False
    found = attributes(source)
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if found.get("role", "").lower() in LEFT_OUT_ROLES:
        return True
    if tag in MAIN_TAGS:  # a comment may be an article of its own, but "article has-sidebar" is none
        return any("comment" in found.get(key, "").lower() for key in ("class", "id", "itemprop", "itemtype"))
    names = f"{found.get('class', '')} {found.get('id', '')} {found.get('itemprop', '')}".split()
    return any(name_left_out(name, in_main) for name in names)


def name_left_out(name: str, in_main: bool) -> bool:
    if name.lower() in HIDDEN_NAMES:
        return True
    parts = [part.lower() for part in NAME_PART.findall(name) if len(part) > 1]
    if not parts or HIDDEN in parts or not all(part in LEFT_OUT_NAMES or part in PLAIN_PARTS for part in parts):
        return False
    return not LEFT_OUT_NAMES.isdisjoint(parts) or (parts[-1] == SITE_HEAD and not in_main)


class OpenElements:
    """The elements that are open, outermost first, with the places of each name, so that no step walks through them."""

    def __init__(self) -> None:
        self.entries: list[tuple[str, bool, bool]] = []  # tag, left out, in an article
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, entry: tuple[str, bool, bool]) -> None:
        self.places[entry[0]].append(len(self.entries))
        self.entries.append(entry)

    def cut(self, where: int) -> list[tuple[str, bool, bool]]:
        """Close the elements from a place on."""
        removed = self.entries[where:]
        del self.entries[where:]
        for name, _, _ in reversed(removed):
            self.places[name].pop()
        return removed

    def last(self, name: str) -> int:
        places = self.places.get(name)
        return places[-1] if places else -1

    def blank(self, where: int) -> None:
        """Close an element but none of those in it."""
        name, dropped, in_main = self.entries[where]
        self.places[name].pop()
        self.entries[where] = ("", dropped, in_main)
        insort(self.places[""], where)

    def closed_by(self, tag: str) -> int:
        """The element that an end tag closes, or -1: the last of that name, unless one that shields it is open within."""
        where = self.last(tag)
        return where if all(self.last(shield) <= where for shield in SHIELDS.get(tag, ())) else -1

    def ended_by(self, tag: str) -> int:
        """The first of the elements that a start tag ends without an end tag, or their number."""
        if self.entries and self.entries[-1][0] == "head" and tag not in HEAD_TAGS:
            return len(self.entries) - 1
        if tag == "body" and self.places.get("head"):
            return self.places["head"][0]
        cut = len(self.entries)
        if tag in BLOCK_TAGS:
            table = self.last("table")
            for name, enders in ENDED_BY.items():
                places = self.places.get(name)
                if places and tag in enders:
                    within = max(table, *(self.last(shield) for shield in SHIELDS[name]))
                    first = bisect_right(places, within)
                    if first < len(places):
                        cut = min(cut, places[first])
        return cut


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, without elements that are left out."""
    out: list[Block] = []
    opened = OpenElements()
    open_tags = opened.entries
    chunks: list[str] = []
    links = 0
    in_link = 0
    may_lack = 0  # open elements whose end tag may be missing
    heading = False

    def flush() -> None:
        nonlocal links, heading
        text = " ".join("".join(chunks).split())
        if text:
            out.append(Block(text, links, bool(open_tags) and open_tags[-1][2], heading))
        chunks.clear()
        links, heading = 0, False

    def say(text: str) -> None:
        nonlocal links
        if text and not (open_tags and open_tags[-1][1]):
            text = html.unescape(text)
            chunks.append(text)
            if in_link:
                links += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        token = TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        if token["tag"] is None:
            continue
        tag, closing = token["tag"].lower(), bool(token["end"])
        if tag in BLOCK_TAGS:
            flush()
            heading = tag in HEADINGS and not closing
        elif tag == "br":
            chunks.append(" ")
        if closing:
            where = opened.closed_by(tag)
            if where >= 0:
                removed = opened.cut(where)
                in_link -= sum(name == "a" for name, _, _ in removed)
                may_lack -= sum(name in ENDED_BY or name == "head" for name, _, _ in removed)
            continue
        if may_lack:
            ended = opened.cut(opened.ended_by(tag))
            may_lack -= sum(name in ENDED_BY or name == "head" for name, _, _ in ended)
            # a link goes on in the next block
            in_link -= sum(name == "a" and out_of for name, out_of, _ in ended)
            for entry in ended:
                if entry[0] == "a" and not entry[1]:
                    opened.push(entry)
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in VOID_TAGS:
            continue
        if tag == "a" and in_link:  # a link ends where the next one begins
            opened.blank(opened.last("a"))
            in_link -= 1
        dropped, in_main = open_tags[-1][1:] if open_tags else (False, False)
        dropped = dropped or left_out(tag, token["attrs"], in_main)
        in_main = in_main or (tag in MAIN_TAGS and not dropped)
        opened.push((tag, dropped, in_main))
        in_link += tag == "a"
        may_lack += tag in ENDED_BY or tag == "head"
    flush()
    return out


def stop_density(text: str, stop_words: frozenset = STOP_WORDS) -> float:
    words = LETTERS.findall(text.lower())
    return sum(word in stop_words for word in words) / max(len(words), 1)


def page_stop_words(blocks: list[Block]) -> frozenset:
    """The stop words of the page's language: of the list that has most of its words."""
    counts = Counter(word for b in blocks for word in LETTERS.findall(b.text.lower()) if word in STOP_WORDS)
    return max(STOP_LISTS, key=lambda words: sum(n for word, n in counts.items() if word in words))


def length_of(text: str) -> int:
    """Characters, of which those that stand for a syllable or a word count for several."""
    return len(text) + (WIDE_CHARS - 1) * len(WIDE.findall(text))


def is_foreign(blocks: list[Block]) -> bool:
    """Whether the long blocks of a page show none of the languages whose stop words are listed."""
    longs = [b.text for b in blocks if length_of(b.text) >= SHORT_CHARS and b.link_density <= MAX_LINK_DENSITY]
    return bool(longs) and stop_density(" ".join(longs)) < STOP_FOREIGN and all(stop_density(text) < STOP_LISTED for text in longs)


def judge(block: Block, foreign: bool = False, stop_words: frozenset = STOP_WORDS) -> str:
    """First pass: a block by itself, by the page's stop words; without any on a foreign page."""
    most = MAX_MAIN_LINK_DENSITY if block.main else MAX_LINK_DENSITY
    if block.link_density > most:
        return "bad"
    if (length_of(block.text) if foreign else len(block.text)) < SHORT_CHARS:
        return "bad" if block.link_chars and not block.main else "short"
    if foreign:
        return "good" if length_of(block.text) > LONG_CHARS else "near"
    density = stop_density(block.text, stop_words)
    if density >= STOP_HIGH:
        return "good" if len(block.text) > LONG_CHARS or block.main else "near"
    return "near" if density >= STOP_LOW or block.main else "bad"


def decide(blocks: list[Block], foreign: bool = False) -> None:
    """Second pass: undecided blocks take the label of the nearest decided one, the better of two equally near ones.

    Where nothing is decided on either side, an article's block is good and any other bad. Inside an article a block
    is bad only between bad ones. A page without a good block has its text in the nearly good ones, or else in the short ones
    without links.
    """
    stop_words = page_stop_words(blocks)
    for block in blocks:
        block.label = judge(block, foreign, stop_words)
    best = next((label for label in ("good", "near", "short") if any(b.label == label for b in blocks)), "")
    for block in blocks:
        if block.label == best and (best != "short" or not block.link_chars):
            block.label = "good"
    decided = [i for i, block in enumerate(blocks) if block.label in ("good", "bad")]
    before, following = None, 0
    for i, block in enumerate(blocks):
        if block.label in ("good", "bad"):
            before, following = i, following + 1
            continue
        after = decided[following] if following < len(decided) else None
        sides = [(abs(i - j), blocks[j].label) for j in (before, after) if j is not None]
        if block.main:
            bad = len(sides) == 2 and not block.heading and all(label == "bad" for _, label in sides)
            block.label = "was bad" if bad else "was good"
        elif not sides:
            block.label = "was bad"
        else:
            nearest = min(distance for distance, _ in sides)
            block.label = "was good" if any(d == nearest and label == "good" for d, label in sides) else "was bad"
    for block in blocks:
        block.label = block.label.removeprefix("was ")


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    main = [block for block in blocks if block.main]
    if main:
        blocks = main
    decide(blocks, foreign=not main and is_foreign(blocks))
    return "\n\n".join(block.text for block in blocks if block.label == "good")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
