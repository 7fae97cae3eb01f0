"""Main text of a web page by two-pass block rules.

A page is cut into blocks at block-level tags.  Pass 1 decides a block from its stop-word density, its length
and its link density, and from the element around it: menus, page headers, footers, sidebars, notices,
adverts, forms and reader comments are never main text, and inside an article only link density speaks against
a block.  A form or an element known by its class or id alone may also wrap the page: it is disregarded if it holds most
of the text and no other article stands outside it, and for the articles in it (for a name: if it holds at least half of
the article text); a <main> is disregarded by none.  Names of comments and adverts count for articles too, unless there
is no other long block.  Inside an article an id counts only if all its words are of comments, adverts, forms or layout, as ids
are made from headings there.  Short blocks stay open.  In pass 2 an open block takes the label of the nearest decided block of the
same region (on a tie: main if either is); a region without any decided block is main text if it is an article.  A
page left without main text gives all blocks that neither their element nor their links speak against.

Character references are decoded, white space inside a block becomes one space, and main blocks are joined by
one space.  Defined cases: null or empty html, and a page without main text, give ''; an unclosed element lasts to
the end of its parent; an unfinished last tag is dropped; an unfinished script, style or comment lasts to the end.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT, LONG = 70, 200  # characters
STOP_LOW, STOP_HIGH = 0.30, 0.32
MOST_LINKED = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?:svg|math)\b(?:[^>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*+/>|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|title|noframes)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead tr ul""".split())
_ARTICLE = frozenset(("article", "main"))
_NEVER = frozenset("nav footer aside menu dialog button head label".split())
_NEVER_ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
_NEVER_NAME = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu masthead
    footer sidebar cookie cookies consent gdpr notice banner popup modal overlay newsletter subscribe signup login comment
    comments disqus reply replies respond share sharing social related breadcrumb breadcrumbs pagination pager toolbar skip""".split())
_OWN_NAME = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo comment comments disqus
    reply replies respond""".split())
# inside an article, an id of these words only
_ID_NAME = _OWN_NAME | frozenset("newsletter subscribe signup login".split())
_ID_LAYOUT = frozenset("""form area list section box container wrapper wrap div block slot unit thread gpt google iframe banner leaderboard
    mpu rectangle skyscraper top bottom left right middle mid inline content sidebar header footer reader readers user users post
    article""".split())
WRAPS = {"form": 0.5, "name": 0.8}  # share of the page's text above which such an element wraps the page
# frequent function words of the languages served
STOP_WORDS = frozenset("""the of and to in a is that it for on with as was be by at this are from or an have not but had his they you which
    he were her she we there been their will would one all when who more if no out so what up about into than them can only
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird
    bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde
    le la les de des du et à un une est en que qui dans pour pas au sur par plus se ne ce il sont avec son ou aux elle mais comme
    nous vous leur sa été cette ses être on fait si tout même ont
    el la los las de del y en un una que es se no por con para su al lo como más o pero sus le ha me si sin sobre este ya entre
    cuando todo esta ser son dos también fue había era muy hasta desde está""".split())


def _names_extra(value: str) -> str:
    """What a class or id says: "name" for something beside the text (not "has-sidebar", "no-ads"), "own" for comments
    and adverts, or ""."""
    words = [w.lower() for w in _NAME.findall(value)]
    said = [w for k, w in enumerate(words)
            if w in _NEVER_NAME and (k == 0 or words[k - 1] not in ("has", "with", "no", "without", "non"))]
    return "own" if any(w in _OWN_NAME for w in said) else "name" if said else ""


def _id_in_article(value: str) -> bool:
    """Whether an id inside an article can mark comments, adverts or forms ("comment-form", not "ad-hoc-networks")."""
    words = [w.lower() for w in _NAME.findall(value)]
    return any(w in _ID_NAME for w in words) and all(w in _ID_NAME or w in _ID_LAYOUT for w in words)


def _settle(found: list[tuple], marks: list[tuple[str, int, int]]) -> list[tuple[str, bool, int, int]]:
    """The blocks, each with its final "never": marks of elements that wrap the page are disregarded.

    ``marks`` has kind, region and outer mark of each marked element, article and main (the first is the page); a block
    has the number of its innermost mark.
    """
    held, articles, by_region, plain = [0] * len(marks), [0] * len(marks), {}, 0
    own = [False] * len(marks)  # inside comments or adverts
    for k, (kind, _, outer) in enumerate(marks):
        own[k] = kind == "own" or kind != "main" and outer < k and own[outer]
    for text, never, region, linked, k in found:
        n = len(text)
        if not never and linked <= MOST_LINKED * n:
            held[k] += n
            by_region[region] = by_region.get(region, 0) + n
            articles[k] += n if region > 0 else 0
            plain += 0 if own[k] or n < SHORT else n
    for k in range(len(marks) - 1, 0, -1):
        held[marks[k][2]] += held[k]
        articles[marks[k][2]] += articles[k]
    state = [(False, False)] * len(marks)  # never for its own text, for an article in it
    for k, (kind, region, outer) in enumerate(marks):
        own_text, inner = state[outer]
        if kind == "article":
            state[k] = (inner, inner)
        elif kind in WRAPS or kind == "own":
            around = by_region.get(region, 0) - held[k] if region > 0 else 0
            wraps = kind in WRAPS and held[k] > WRAPS[kind] * held[0] and articles[0] == articles[k] + around
            clears = wraps or kind == "form" or (2 * articles[k] >= articles[0] if kind == "name" else not plain)
            state[k] = (own_text or not wraps, inner or not clears)
    return [(text, never or state[k][0], region, linked) for text, never, region, linked, k in found]


def blocks(html: str) -> list[tuple[str, bool, int, int]]:
    """(text, never, region, linked characters) of each block; region is positive inside an article."""
    out: list[tuple] = []
    marks = [("", 0, 0)]
    stack: list[tuple[str, bool, int, int]] = []  # tag, never, region, mark
    places: dict[str, list[int]] = {}  # of each open tag name in the stack
    open_blocks: list[int] = []
    words: list[str] = []
    linked = regions = 0
    state = (False, 0, 0)

    def close():
        nonlocal linked
        text = _SPACE.sub(" ", "".join(words)).strip()
        if text:
            out.append((text, *state[:2], linked, state[2]))
        words.clear()
        linked = 0

    def pop(to: int):
        nonlocal state
        for t in reversed(stack[to:]):
            places[t[0]].pop()
            if t[0] in _BLOCK:
                open_blocks.pop()
        del stack[to:]
        state = stack[-1][1:] if stack else (False, 0, 0)

    last = 0
    for m in _TOKEN.finditer(html):
        if m.start() > last:
            piece = entities.unescape(html[last:m.start()])
            words.append(piece)
            if places.get("a"):
                linked += len(piece)
        last = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        block = tag in _BLOCK
        if block:
            close()
        if m["end"]:
            at = places.get(tag)
            if at and (block or not open_blocks or open_blocks[-1] < at[-1]):  # an inline end tag does not reach out of a block
                pop(at[-1])
            continue
        if block and tag != "br" and open_blocks:  # an open paragraph ends here; a list item or cell ends its like
            inner = stack[open_blocks[-1]][0]
            if inner == "p" or inner == tag and tag in ("li", "td", "th", "tr", "dd", "dt"):
                pop(open_blocks[-1])
        if tag in _VOID:
            continue
        if tag == "body":  # ends a head left open
            pop(0)
        if tag == "a" and places.get("a"):
            pop(places["a"][-1])
        never, region, outer = state
        mark = "form" if tag == "form" else ""
        if tag in _NEVER or tag == "header" and region <= 0:
            never = True
        elif m["attrs"] and not never and tag not in ("html", "body"):
            for name, value in _ATTR.findall(m["attrs"]):
                value, name = value.strip("\"'"), name.lower()
                if name == "role":
                    never = never or value.lower() in _NEVER_ROLE
                    mark = mark or ("form" if value.lower() == "form" else "")
                elif name == "hidden" or name == "aria-hidden":
                    never = never or name == "hidden" or value.lower() == "true"
                elif tag not in _ARTICLE and (name != "id" or region <= 0 or _id_in_article(value)):
                    said = {_names_extra(x) for x in value.split()}
                    mark = "own" if "own" in said else mark or ("name" if "name" in said else "")
        if tag in _ARTICLE or mark and not never:
            marks.append((tag if tag in _ARTICLE else mark, region, outer))
            outer = len(marks) - 1
        if tag in _ARTICLE and region <= 0:
            regions += 1
            region = regions
        state = (never, region, outer)
        places.setdefault(tag, []).append(len(stack))
        if block:
            open_blocks.append(len(stack))
        stack.append((tag, *state))
    if last < len(html):
        words.append(entities.unescape(html[last:]))
        if places.get("a"):
            linked += len(words[-1])
    close()
    return _settle(out, marks)


def labels(found: list[tuple[str, bool, int, int]]) -> list[bool]:
    """Whether each block is main text."""
    said: list[bool | None] = []
    for text, never, region, linked in found:
        n = len(text)
        if never or linked > MOST_LINKED * n or text[0] == "©":
            said.append(False)
            continue
        tokens = text.lower().split()
        stops = sum(w.strip(".,;:!?") in STOP_WORDS for w in tokens) / len(tokens)
        if n < SHORT:
            said.append(None)
        elif region > 0:
            said.append(True)
        elif stops >= STOP_LOW:
            said.append(True if stops >= STOP_HIGH or n >= LONG else None)
        else:
            said.append(None if n < LONG else False)
    before: dict[tuple, tuple[int, bool]] = {}
    near: list[list[tuple[int, bool]]] = [[] for _ in found]
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        before.clear()
        for k in order:
            region = found[k][2]
            if said[k] is not None:
                if region <= 0 or said[k]:
                    before[region] = (k, said[k])
            elif region in before:
                near[k].append((abs(before[region][0] - k), before[region][1]))
    out = []
    for k, label in enumerate(said):
        if label is None:
            if near[k]:
                least = min(d for d, _ in near[k])
                label = any(x for d, x in near[k] if d == least)
            else:
                label = found[k][2] > 0
        out.append(label)
    if not any(out):
        out = [not b[1] and b[3] <= MOST_LINKED * len(b[0]) for b in found]
    return out


def main_text(html: str) -> str:
    found = blocks(html)
    return " ".join(b[0] for b, main in zip(found, labels(found)) if main)


def text_of(html: Column) -> Column:
    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(x) for x in pages.to_pylist()], pa.string())
    return run(F.coalesce(html, F.lit("")))


def block_table(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every block of every page: id, pos, text, main."""
    kind = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("main", T.BooleanType())]))

    @F.arrow_udf(kind)
    def run(html: pa.Array) -> pa.Array:
        every = []
        for x in html.to_pylist():
            found = blocks(x)
            every.append([{"text": b[0], "main": m} for b, m in zip(found, labels(found))])
        return pa.array(every, pa.list_(pa.struct([("text", pa.string()), ("main", pa.bool_())])))
    return (pages.select(F.col(id_col), F.posexplode(run(F.coalesce(F.col(html_col), F.lit("")))).alias("pos", "b"))
            .select(id_col, "pos", "b.text", "b.main"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: id, url, text, n_chars."""
    out = pages.select(F.col(id_col), F.col(url_col), text_of(F.col(html_col)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
