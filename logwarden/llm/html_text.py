"""Main text of web pages by two-pass block rules.

The first pass labels blocks by length, stop-word density and link density, and by
what encloses them. The second gives short undecided blocks the label of their
nearest decided neighbours. On a page without a good block or an article,
short undecided sentences outside lists are its text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages.
STOP_WORDS = frozenset(
    # English
    "a about after all also an and any are as at be because been but by can could did do for from "
    "had has have he her his how i if in into is it its more my no not of on one or our out said she "
    "so some than that the their them then there these they this to up was we were what when which "
    "who will with would you your "
    # German
    "aber als am auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen "
    "einer er es für hat ich ihr im ist ja kann mehr mit nach nicht noch nur oder sich sie sind so "
    "über um und uns von vor war was wenn werden wie wir wird zu zum zur "
    # French
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me "
    "même ne nous on ou par pas plus pour que qui sa se ses son sur te tu un une vous y "
    # Spanish
    "al algo como con cuando del desde donde el ella ellos entre era es esta este esto ha hay la las lo "
    "los más me mi muy nos o para pero por porque que quien se sin sobre son su sus te tiene un una uno y ya"
    .split()
)
# The same for pages in other languages, by the first part of their lang attribute.
MORE_STOP_WORDS = {
    lang: frozenset(words.split()) for lang, words in {
        "it": "a ad ai al alla alle anche c che chi ci come con cui da dal dalla dei del della delle di dove e è ed era "
        "essere fu gli ha hanno i il in io l la le lo loro ma mi molto nei nel nella noi non o ogni per perché più "
        "quando quella quello questa questo se si sia sono su sua sul sulla suo tra un una uno voi",
        "pt": "a à ao aos as às até com como da das de do dos e é ela ele eles em entre era essa esse esta este eu foi "
        "há isso já mais mas me mesmo muito na não nas no nos o os ou para pela pelo por quando que quem se sem ser "
        "seu sua são também te tem um uma você",
        "nl": "aan al als bij dan dat de der deze die dit door een en er had heb hebben heeft het hij hoe hun ik in is "
        "je kan maar me meer met mijn na naar niet nog nu of om ons ook op over te tot uit van veel voor was wat we "
        "wel werd wij worden wordt zal ze zich zij zijn zo",
        "pl": "a aby albo ale bo być by był była było były co czy dla do gdy go i ich ja jak jako je jego jej jest jeszcze "
        "już kiedy który która które których lub ma może mu na nad nie niż o od on ona oraz po pod przed przez przy "
        "się są ta tak także tam te tego tej ten to tu tylko tym w we więc wszystko z za ze że",
        "sv": "att av de dem den det då där efter eller en ett för från ha hade han har hon hur i in inte jag kan man med "
        "men mer mot mycket ni nu när och om på sedan sig sin ska som så till under upp ut var vi vid vad är över",
        "ru": "а без бы был была были было быть в вам вас весь во вот все всё вы где да для до его ее её если есть ещё еще "
        "же за и из или им их к как когда кто ли мне мы на над не него нет ни но о об он она они от по под при с "
        "со так также то того тоже только ты у уже что чтобы эта эти это этот я",
        "uk": "а або але без би був була були було бути в ви від він вона вони все для до є же з за зі і із її їх його й "
        "коли ми на не ні ну о по при про та так також те ти то тому у це цей ці чи що щоб я як яка який які",
        "ar": "أن أو إلى إن التي الذي الذين عن على في قد كان كانت كل كما لا لم لن ما من مع منذ هذا هذه هو هي و ولا بين بعد "
        "قبل حتى ثم عند غير ذلك تلك أي إذا وقد وفي ومن وهو وهي",
        "tr": "ama bir biz bu bunu çok da daha de değil diye en gibi hem her için ile ise kadar ki mi mı ne o olan olarak "
        "olduğu ona onu sonra şu ve veya ya",
    }.items()
}
_LISTED = frozenset("en de fr es".split()) | MORE_STOP_WORDS.keys()
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]+)", re.I)
_SENTENCE = re.compile(r"[.!?…][\"'”’»)\]]*(?:\s|$)|[。！？؟۔।։።]")
# Elements by what they hold.
RAW_ELEMENTS = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
DROPPED_ELEMENTS = frozenset(
    "head nav header footer aside form dialog menu button select svg math canvas object audio video map".split()
)
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE_ELEMENTS = frozenset("article main".split())
LIST_ELEMENTS = frozenset("li dd dt td th option dl ol ul table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that name what surrounds an article.
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notification alert newsletter subscribe subscription signup "
    "popup modal overlay dialog sidebar aside menu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead comment comments reply replies respond disqus share sharing social "
    "related recommended widget toolbar pagination pager login search complementary contentinfo".split()
)
#: Of these, those that tell an article element to be a reader's comment.
COMMENT_NAMES = frozenset("comment comments reply replies respond".split())
# Parts of a name beside a listed word that leave it what it is.
NAME_PARTS = frozenset(
    "list lists area areas box container wrapper wrap section block inner outer content bar panel links link item "
    "items form button buttons icons left right top bottom main primary secondary site page post posts global".split()
)
# First parts of names that tell what an element has or lacks.
STATES = frozenset("with without no not has is hide show".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?![\w=-])", re.I)
_RIGHTS = re.compile(r"\W*(©|copyright\b|all rights reserved)", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(frozen=True)
class BlockRules:
    """A block shorter than ``short`` characters is undecided at first. Article elements decide if the prose
    outside them is at most ``teaser`` times as long as their text."""

    short: int = 70
    stop_density: float = 0.3
    link_density: float = 0.5
    teaser: float = 3.0


@dataclass
class Block:
    text: str
    link_chars: int
    in_article: bool
    dropped: bool
    heading: bool
    in_list: bool = False
    named: int = 0  # inside an element whose name is a listed word (2) or ends in one (1)
    good: bool | None = None


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text in order, white space made one blank, references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int]] = []  # element, inside what is dropped, inside an article, named
    open_count: Counter[str] = Counter()
    texts: list[str] = []
    links = [0]
    in_links, breaks = 0, 0

    def close_block() -> None:
        text = " ".join("".join(texts).split())
        if text:
            dropped, article, named = stack[-1][1:] if stack else (False, False, 0)
            heading = any(element[0] in HEADINGS for element in stack[-3:])
            in_list = any(open_count[tag] > 0 for tag in LIST_ELEMENTS)
            out.append(Block(text, links[0], article, dropped, heading, in_list, named))
        texts.clear()
        links[0] = 0

    def pop_to(tag: str) -> None:
        nonlocal in_links
        while stack:
            top = stack.pop()[0]
            open_count[top] -= 1
            in_links -= top == "a"
            if top == tag:
                return

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        upto = found.start() if found else size
        if upto > at:
            text = html.unescape(page[at:upto])
            texts.append(text)
            if in_links:
                links[0] += len(" ".join(text.split()))
            if not text.isspace():
                breaks = 0
        if not found:
            break
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        closing, tag, attributes = found[1] or found[4], name.lower(), found[3] or found[6] or ""
        if tag == "br":
            texts.append(" ")
            breaks += 1
            if breaks > 1:
                close_block()
            continue
        if closing:
            if tag in BLOCK_ELEMENTS:
                close_block()
            if open_count[tag] > 0:
                pop_to(tag)
            continue
        if tag in RAW_ELEMENTS:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in BLOCK_ELEMENTS:
            close_block()
            if open_count["p"] > 0 and tag not in ("body", "html"):
                pop_to("p")
        if tag in ("li", "dd", "dt", "td", "th", "tr", "option") and stack and stack[-1][0] == tag:
            pop_to(tag)
        if tag in VOID_ELEMENTS or attributes.endswith("/") and tag not in BLOCK_ELEMENTS:
            continue
        dropped, article, named = stack[-1][1:] if stack else (False, False, 0)
        drops = tag in DROPPED_ELEMENTS and not (tag == "header" and article)
        if tag in ARTICLE_ELEMENTS:
            article, named = True, named if named == 2 else 0
        if tag not in ("html", "body") and attributes:
            drops = drops or _hides(attributes)
            if tag not in ARTICLE_ELEMENTS:
                named = max(named, _names(attributes, article))
            elif _names(attributes, article, COMMENT_NAMES) == 2:
                named = max(named, 2)  # a reader's comment, unless nothing else is there
        stack.append((tag, dropped or drops, article, named))
        open_count[tag] += 1
        in_links += tag == "a"
    close_block()
    return out


def _hides(attributes: str) -> bool:
    if "hidden" in attributes and _BARE_HIDDEN.search(_QUOTED.sub("", attributes)):
        return True
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "style" and _HIDDEN.search(value):
            return True
        if name in ("hidden", "aria-hidden") and value.lower() != "false":
            return True
    return False


def _names(attributes: str, in_article: bool, words: frozenset[str] | None = None) -> int:
    """2 if a class, id or role is a listed word (beside ``NAME_PARTS``), 1 if it ends in one, else 0."""
    words = DROPPED_NAMES if words is None else words
    found = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id", "role"):
            continue
        for token in "".join(values).split():
            parts = [w.lower() for w in _NAME.findall(token)]
            listed = [w in words and not (w == "header" and in_article) for w in parts]
            if not any(listed) or parts[0] in STATES:
                continue
            if all(is_listed or w in NAME_PARTS for w, is_listed in zip(parts, listed, strict=True)):
                return 2
            found = max(found, int(listed[-1]))
    return found


def label_blocks(blocks: list[Block], rules: BlockRules, lang: str | None = None) -> None:
    """Sets ``good`` of every block by the two passes.

    Blocks in elements named by a listed word are dropped, but only short ones if the name just ends
    in one. If nothing is good then, articles in such elements count, then long blocks in them.
    ``lang`` is what the page says of its language.
    """
    long = 3 * rules.short
    is_prose = _prose_test(blocks, rules, lang)
    for spared in (
        lambda b: b.named == 1 and len(b.text) >= long,
        lambda b: b.named == 1 and len(b.text) >= long or b.named and b.in_article,
        lambda b: len(b.text) >= rules.short,
    ):
        for b in blocks:
            b.good = None
        _label(blocks, rules, [b.dropped or b.named > 0 and not spared(b) for b in blocks], is_prose)
        if any(b.good for b in blocks) or not any(b.named for b in blocks):
            return


def _prose_test(blocks: list[Block], rules: BlockRules, lang: str | None) -> Callable[[str], bool]:
    """Whether a long block outside an article is prose.

    By the stop words of the first four languages and of the page's own. If no long block passes, by those of
    the list that fits best; if none fits, a block with the end of a sentence is prose on pages in
    a language without a list or, without a lang attribute or in another script, of none that is known.
    """
    texts = [
        b.text for b in blocks
        if not b.dropped and not b.in_article and len(b.text) >= rules.short
        and b.link_chars <= rules.link_density * len(b.text)
    ]
    words = STOP_WORDS | MORE_STOP_WORDS.get(lang or "", frozenset())
    for known in (words, *(w for w in MORE_STOP_WORDS.values() if w is not words)):
        if any(stop_density(t, known) >= rules.stop_density for t in texts):
            return lambda text: stop_density(text, known) >= rules.stop_density
    if lang and lang not in _LISTED:
        return lambda text: bool(_SENTENCE.search(text))
    least = rules.stop_density / 2
    some = lang is not None or any(stop_density(t, k) >= least for t in texts for k in (words, *MORE_STOP_WORDS.values()))
    return lambda text: bool(_SENTENCE.search(text)) and (not some or _other_script(text))


def _other_script(text: str) -> bool:
    """Whether most letters are of no script that the stop words are written in."""
    letters = [c for c in text if c.isalpha()]
    listed = sum(c < "\u0530" or "\u0600" <= c <= "\u06ff" or "\u1e00" <= c <= "\u1eff" for c in letters)
    return 2 * listed < len(letters)


def _label(blocks: list[Block], rules: BlockRules, dropped: list[bool], is_prose: Callable[[str], bool]) -> None:
    linked = _linked(blocks, rules)
    open_ = [b for b, d, of_links in zip(blocks, dropped, linked, strict=True) if not d and not of_links]
    inside = sum(len(b.text) for b in open_ if b.in_article)
    outside = sum(len(b.text) for b in open_ if not b.in_article and len(b.text) >= rules.short and is_prose(b.text))
    # a teaser in an article element beside the story is not the article
    has_article = any(b.in_article and not d for b, d in zip(blocks, dropped, strict=True)) and (
        rules.teaser * inside >= outside
    )
    for b, is_dropped, of_links in zip(blocks, dropped, linked, strict=True):
        if is_dropped or (has_article and not b.in_article) or of_links:
            b.good = False
        elif len(b.text) >= rules.short:
            b.good = b.in_article or is_prose(b.text)
        elif not b.in_article and _RIGHTS.match(b.text):
            b.good = False
    if not any(b.good for b in blocks) and not has_article:
        # a page of short blocks: its sentences
        for b in blocks:
            if b.good is None:
                b.good = False if b.in_list else bool(_SENTENCE.search(b.text)) or None
    first = [b.good for b in blocks]
    before = _nearest(blocks, first, dropped, range(len(blocks)))
    after = _nearest(blocks, first, dropped, range(len(blocks) - 1, -1, -1))
    for i, b in enumerate(blocks):
        if b.good is not None:
            continue
        near = [x for x in (before[i], after[i]) if x is not None]
        if not near:
            b.good = b.in_article
        else:
            # of two neighbours as near, a heading follows the one behind it, all else the good one
            least = min(abs(i - j) for j in near)
            labels = [first[j] for j in near if abs(i - j) == least]
            b.good = labels[-1] if b.heading else any(labels)


def _linked(blocks: list[Block], rules: BlockRules) -> list[bool]:
    """Blocks of links. Inside an article neither a linked sentence is one nor an item of a list that is not all links."""
    out = [b.link_chars > rules.link_density * len(b.text) for b in blocks]
    at = 0
    while at < len(blocks):
        upto = at + 1
        if blocks[at].in_article and blocks[at].in_list:
            while upto < len(blocks) and blocks[upto].in_article and blocks[upto].in_list:
                upto += 1
            out[at:upto] = [all(out[at:upto])] * (upto - at)
        elif blocks[at].in_article and _SENTENCE.search(blocks[at].text):
            out[at] = False
        at = upto
    return out


def _nearest(blocks: list[Block], labels: list[bool | None], dropped: list[bool], order) -> list[int | None]:
    """For each block the decided one met last in ``order``, of those as much in an article.

    Inside an article, what is dropped and what is a block of links says nothing about its neighbours.
    """
    out: list[int | None] = [None] * len(blocks)
    met: dict[bool, int] = {}
    for i in order:
        out[i] = met.get(blocks[i].in_article)
        if labels[i] is not None and not (blocks[i].in_article and (dropped[i] or labels[i] is False)):
            met[blocks[i].in_article] = i
    return out


def stop_density(text: str, known: frozenset[str] = STOP_WORDS) -> float:
    words = re.findall(r"\w+", text.lower())
    return sum(w in known for w in words) / len(words) if words else 0.0


def main_text(page: str, rules: BlockRules | None = None) -> str:
    """The good blocks of a page, joined by line ends."""
    blocks = blocks_of(page)
    said = _LANG.search(page)
    label_blocks(blocks, rules or BlockRules(), said[1].lower() if said else None)
    return "\n".join(b.text for b in blocks if b.good)


def extract_text(pages: DataFrame, rules: BlockRules | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null and empty pages, and pages without an article's text, give an empty text. Whole pages
    are read, repeated rows each; an empty table gives none; other columns are not read.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h or "", rules) for h in batch["html"]]
            yield pd.DataFrame({
                "page_id": batch["page_id"], "url": batch["url"], "text": pd.Series(texts, dtype=object),
                "n_chars": [len(t) for t in texts],
            })

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInPandas(
        read, f"page_id {kind}, url string, text string, n_chars long"
    )
