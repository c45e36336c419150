"""Main text of web pages, with site templates removed.

1. A linear pass over each page's tags builds its block elements: text blocks, and a hash
   of every element's whole subtree (tag, class, text and children).  Elements that are
   boilerplate by their own tag, role or class are skipped with all they hold.
2. Spark counts among how many contents of its host each subtree hash occurs.  A page's content
   for a subtree is all text outside of it (of the article, if there is one), so copies of a
   page count as one, and a subtree that holds all of a page's text counts nowhere.  A subtree is a site template at `MIN_CONTENTS` contents.
3. Blocks inside a template subtree are deleted.  Paragraphs and headings of an article are
   content even if repeated, so in an article only larger elements count as templates.
4. Pages with an article keep the blocks in it, others all blocks left.

Contents are marked in `MASKS` masks of 64 bits per host and hash where pages are read, so a host
with a third of all pages sends no more than others.  Bits can only coincide, which lets exactly
`MIN_CONTENTS` contents be missed with a chance of 1e-4, never found where there are fewer.

Cases: null or empty html, or no text left: empty text; a page cut off inside a tag or comment
loses that tag only; unclosed elements end with their parents; repeated pages are one
content; a null or unreadable url counts as one host.  Pages are read whole, in time that grows with their length, whatever
the number of blocks and the depth of elements.  Other columns of the pages are left out of the result.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, landed

MIN_CONTENTS = 3
MASKS = 3

# HTML element names by what they do to text.
_WORDS = lambda text: frozenset(text.split())
INLINE = _WORDS("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp "
                "small span strike strong sub sup time tt u var wbr nobr center")
VOID = _WORDS("area base br col embed hr img input link meta param source track wbr")
RAW = _WORDS("script style textarea title noscript iframe noembed noframes xmp template")
SKIPPED = RAW | _WORDS("head nav aside footer form svg math canvas object audio video select button dialog menu fieldset")
LEAF = _WORDS("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd figcaption")
# Roles, and words of class and id names, that mark boilerplate.
ROLES = _WORDS("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar")
HINTS = _WORDS("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr "
               "notice popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation "
               "breadcrumb breadcrumbs comment comments disqus respond share sharing social related recommended footer "
               "masthead topbar widget pagination pager skip adsbygoogle")
# Words that make a class name speak of a layout (`content-with-sidebar`) and not of the element.
LAYOUT = _WORDS("with without has no")
# Start tags that end an open element of the same family.
CLOSES = {"li": _WORDS("li"), "dt": _WORDS("dt dd"), "dd": _WORDS("dt dd"), "tr": _WORDS("tr td th"),
          "td": _WORDS("td th"), "th": _WORDS("td th"), "option": _WORDS("option")}
_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[!?/][^>]*(?:>|\Z))""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z0-9]+")


class _Element:
    __slots__ = ("tag", "parent", "label", "parts", "skipped", "main", "low")

    def __init__(self, tag, parent, label, skipped, main):
        self.tag, self.parent, self.label, self.skipped, self.main = tag, parent, label, skipped, main
        self.parts: list = []
        self.low = 0


def _boilerplate(tag: str, attributes: str, in_main: bool) -> tuple[bool, str]:
    """Whether an element is boilerplate by itself; and its class."""
    if tag in SKIPPED:
        return True, ""
    if tag == "header" and not in_main:
        return True, ""
    if not attributes or tag in ("html", "body", "article", "main"):
        return False, ""
    label, bad = "", False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name == "role":
            bad = bad or value.strip() in ROLES
        else:
            label += value if name == "class" else ""
            names = [word for own in map(_NAME.findall, value.split()) if LAYOUT.isdisjoint(own) for word in own]
            bad = bad or not HINTS.isdisjoint(names) or ("header" in names and not in_main)
    return bad, label


def blocks(html: str | None) -> tuple[list[tuple[str, bool]], list[tuple[int, int, int]], dict[int, int]]:
    """A page's text blocks (text, in an article), its elements (hash, first block, block after the last), and the content outside of each hash.

    The blocks of an element follow each other, so an element is a span of them, however deep it lies.
    """
    if not html:
        return [], [], {}
    root = _Element("#page", None, "", False, False)
    elements, here, found, text = [root], root, [], []
    open_tags: Counter[str] = Counter()

    def leave(level):  # close all elements inside of `level`
        nonlocal here
        while here is not level:
            open_tags[here.tag] -= 1
            here = here.parent

    def flush():
        if text:
            value = " ".join("".join(text).split())
            text.clear()
            if value:
                here.parts.append(value)
                if not here.skipped:
                    found.append((value, here))

    at, size = 0, len(html)
    while at < size:
        low = html.find("<", at)
        if low < 0:
            low = size
        if low > at and not here.skipped:
            text.append(unescape(html[at:low]))
        elif low > at:
            text.append(html[at:low])
        if low == size:
            break
        match = _TAG.match(html, low)
        if match is None:
            match = _LOOSE.match(html, low)
            if match is None:  # a lone "<" is text
                text.append("<")
                at = low + 1
                continue
            if not match[4]:  # cut off inside a tag
                break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:  # an end tag
            if tag in INLINE:
                continue
            flush()
            if open_tags[tag]:
                level = here
                while level.tag != tag:
                    level = level.parent
                leave(level.parent)
            continue
        if tag in INLINE or tag == "br" or tag in VOID:
            if tag in ("br", "img", "input"):
                text.append(" ")
            elif tag == "hr":
                flush()
            continue
        flush()
        shut = CLOSES.get(tag)
        if here.tag == "p":  # a block ends an open paragraph
            leave(here.parent)
        if shut and any(open_tags[name] for name in shut):
            level = here
            while level is not None and level.tag not in shut and level.tag not in ("ul", "ol", "dl", "table", "select", "body"):
                level = level.parent
            if level is not None and level.tag in shut:
                leave(level.parent)
        if tag == "body" and open_tags["head"]:
            level = here
            while level.tag != "head":
                level = level.parent
            leave(level.parent)
        elif here.tag == "head" and tag not in ("html", "body") and tag not in RAW:
            leave(here.parent)
        bad, label = _boilerplate(tag, match[3] or "", here.main)
        own = _Element(tag, here, label, here.skipped or bad, here.main or tag in ("article", "main"))
        here.parts.append(own)
        elements.append(own)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else size
            close = html.find(">", at)
            at = close + 1 if close >= 0 else size
            continue
        here = own
        own.low = len(found)
        open_tags[tag] += 1
    flush()
    hashes: dict[int, int] = {}
    for own in reversed(elements):  # children come after their parents
        body = "\x01".join(p if isinstance(p, str) else f"\x02{hashes[id(p)]}" for p in own.parts)
        value = xxhash.xxh64_intdigest(f"{own.tag}\x00{own.label}\x00{body}".encode("utf-8", "surrogatepass"), 42)
        hashes[id(own)] = value - (1 << 64) if value >> 63 else value

    last: dict[int, int] = {}  # the block after each element's last one
    for at, (_, own) in enumerate(found):
        last[id(own)] = at + 1
    for own in reversed(elements[1:]):
        if id(own) in last:
            last[id(own.parent)] = max(last.get(id(own.parent), 0), last[id(own)])

    def counted(own: _Element) -> bool:
        return own.tag not in ("#page", "html", "body", "article", "main", "head") and not (own.main and own.tag in LEAF)

    spans = [(hashes[id(own)], own.low, last[id(own)]) for own in elements if id(own) in last and counted(own)]
    out = [(value, own.main) for value, own in found]
    return out, spans, contents(out, spans)


_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E687


def contents(found: list[tuple[str, bool]], spans: list[tuple[int, int, int]]) -> dict[int, int]:
    """For each hash of an element the hash of all text outside of its spans; of the article's, if there is one.

    Hashes of block sequences are polynomials modulo a prime, so that those of the stretches between a hash's spans
    come from prefix hashes and join without another look at the blocks: the time is that of the elements.
    """
    in_pool = [main for _, main in found]
    if not any(in_pool):
        in_pool = [True] * len(found)
    place, prefix, power = [0], [0], [1]
    for (text, _), chosen in zip(found, in_pool):
        place.append(place[-1] + chosen)
        if chosen:
            mark = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
            prefix.append((prefix[-1] * _BASE + mark + 1) % _PRIME)
            power.append(power[-1] * _BASE % _PRIME)
    size = place[-1]
    by_hash: dict[int, list[tuple[int, int]]] = {}
    for value, low, high in spans:
        by_hash.setdefault(value, []).append((place[low], place[high]))
    outside = {}
    for value, cut in by_hash.items():
        joined = length = at = 0
        for low, high in [*cut, (size, size)]:  # in page order; equal subtrees do not hold each other
            if low > at:
                joined = (joined * power[low - at] + prefix[low] - prefix[at] * power[low - at]) % _PRIME
                length += low - at
            at = max(at, high)
        if length:
            outside[value] = joined
    return outside


def without(texts: list[str], mains: list[bool], spans: list[tuple[int, int, int]], gone: set[int]) -> str:
    """The blocks outside of all elements whose hash is gone; of those in an article, if any is left."""
    cover = [0] * (len(texts) + 1)
    for value, low, high in spans:
        if value in gone:
            cover[low] += 1
            cover[high] -= 1
    left, depth = [], 0
    for text, main, step in zip(texts, mains, cover):
        depth += step
        if not depth:
            left.append((text, main))
    return "\n".join(text for text, main in [b for b in left if b[1]] or left)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def parsed(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """One row per page: uid, key, url, host, blocks, spans, hashes (with contents); written once, as it is read three times."""
    outside = T.StructType([T.StructField("hash", T.LongType()), T.StructField("content", T.LongType())])
    fields = [("texts", T.ArrayType(T.StringType())), ("mains", T.ArrayType(T.BooleanType())), ("span_hashes", T.ArrayType(T.LongType())),
              ("lows", T.ArrayType(T.IntegerType())), ("highs", T.ArrayType(T.IntegerType())), ("hashes", T.ArrayType(outside))]

    def start():
        def work(htmls):
            read = [blocks(value) for value in htmls]
            return {"texts": [[text for text, _ in found] for found, _, _ in read], "mains": [[main for _, main in found] for found, _, _ in read],
                    "span_hashes": [[s[0] for s in spans] for _, spans, _ in read], "lows": [[s[1] for s in spans] for _, spans, _ in read],
                    "highs": [[s[2] for s in spans] for _, spans, _ in read],
                    "hashes": [[{"hash": value, "content": content} for value, content in sorted(own.items())] for _, _, own in read]}
        return work

    rows = pages.select(F.col(f"`{key}`").alias("page"), F.col(f"`{url}`").alias("url"), host_of(F.col(f"`{url}`")).alias("host"),
                        F.col(f"`{html}`").alias("html"))
    rows = add_columns(rows, "html", fields, start).drop("html")
    return landed(rows.withColumn("uid", F.monotonically_increasing_id()), "pages")


def templates(pages: DataFrame, min_contents: int = MIN_CONTENTS) -> DataFrame:
    """(host, hash) of subtrees that recur among several contents of the host."""
    masks = [F.bit_or(F.expr(f"shiftleft(1L, cast(shiftright(x.content, {6 * at}) & 63 as int))")) for at in range(MASKS)]
    rows = pages.select("host", F.explode("hashes").alias("x")).groupBy("host", F.col("x.hash").alias("hash"))
    seen = rows.agg(*[mask.alias(f"m{at}") for at, mask in enumerate(masks)])
    return landed(seen.filter(F.greatest(*[F.bit_count(f"m{at}") for at in range(MASKS)]) >= min_contents).select("host", "hash"), "templates")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
              min_contents: int = MIN_CONTENTS) -> DataFrame:
    """One row per page: key, url and its main text."""
    rows = parsed(pages, key, url, html)
    found = templates(rows, min_contents)
    gone = (rows.select("uid", "host", F.explode("hashes.hash").alias("hash")).join(found, ["host", "hash"])
            .groupBy("uid").agg(F.collect_set("hash").alias("gone")))
    kept = rows.join(landed(gone, "gone"), "uid", "left").select("page", "url", "texts", "mains", "span_hashes", "lows", "highs", "gone")

    def start():
        def work(*columns):
            return {"text": [without(texts, mains, zip(hashes, lows, highs), set(out or ())) for texts, mains, hashes, lows, highs, out in zip(*columns)]}
        return work

    done = add_columns(kept, "texts", [("text", T.StringType())], start, also=("mains", "span_hashes", "lows", "highs", "gone"))
    return done.select(F.col("page").alias(key), F.col("url").alias(url), "text")


def report(pages: DataFrame) -> DataFrame:
    return main_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))
