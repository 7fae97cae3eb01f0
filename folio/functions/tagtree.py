"""Table elements of malformed or nested HTML, as Columns: a fold over the tags with a stack of open elements.

``tree="observed"`` closes elements as the parser of the listing crawler does: an end tag closes the innermost open element of
its name and all opened since; one without an open partner does nothing; nothing else closes an element but the end
of the page.  ``tree="implied"`` adds the rules of HTML for tables: a cell ends at the next cell, row or section of its
table, a row at the next row or section, and end tags do not reach out of the innermost table.

The fold runs in two levels, chunks of tags and tags of a chunk, so that appending an element copies one chunk's
elements only and not all those of the page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.functions.util import let

CHUNK = 256  # tags

# Elements that never have content.
VOID = ["area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
        "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr"]
CELLS = ["td", "th"]
SECTIONS = ["thead", "tbody", "tfoot"]
WANTED = ["tr", "td", "th"]

_NAME_RE = r"^<(/?[A-Za-z][^\s/>]*)"
_OPEN = "struct<at:int,cells:int>"
_ELEMENT = "struct<at:int,name:string,end:int,first:int,last:int>"


def _is_in(c: Column, names: list[str]) -> Column:
    return F.coalesce(c.isin(*names), F.lit(False))


def _last(names: Column, wanted: list[str], above: Column) -> Column:
    """1-based place of the last of ``names`` that is wanted, or 0 if that is not above the place ``above``."""
    back = F.reverse(names)
    places = [F.array_position(back, w) for w in wanted]
    near = [F.when(p > 0, F.size(names) + 1 - p).otherwise(0) for p in places]
    best = F.greatest(*near) if len(near) > 1 else near[0]
    return F.when(best > above, best).otherwise(0).cast("int")


def _state(names, opens, cells, done, out) -> Column:
    return F.struct(names.alias("names"), opens.alias("opens"), cells.alias("cells"), done.alias("done"), out.alias("out"))


def _cut(s: Column, place: Column, at: Column) -> Column:
    """State after closing all from ``place`` on; their row and cell elements are given out."""
    keep = place - 1
    gone = F.slice(F.arrays_zip(s["names"].alias("n"), s["opens"].alias("o")), place, F.size(s["names"]) - keep)
    out = F.transform(F.filter(gone, lambda e: _is_in(e["n"], WANTED)), lambda e: F.struct(
        e["o"]["at"].alias("at"), e["n"].alias("name"), at.alias("end"), e["o"]["cells"].alias("first"),
        s["cells"].alias("last")))
    return _state(F.slice(s["names"], F.lit(1), keep), F.slice(s["opens"], F.lit(1), keep), s["cells"], keep == 0,
                  F.concat(s["out"], out))


def _push(s: Column, t: Column) -> Column:
    return _state(F.concat(s["names"], F.array(t["n"])),
                  F.concat(s["opens"], F.array(F.struct(t["at"].alias("at"), s["cells"].alias("cells")))),
                  s["cells"] + F.when(t["n"] == "td", 1).otherwise(0), s["done"], s["out"])


def _empty(s: Column, t: Column) -> Column:
    """A self-closed element: given out if wanted, never opened."""
    one = F.when(t["n"] == "td", 1).otherwise(0)
    element = F.struct(t["at"].alias("at"), t["n"].alias("name"), t["at"].alias("end"), s["cells"].alias("first"),
                       (s["cells"] + one).alias("last"))
    return F.when(_is_in(t["n"], WANTED), _state(s["names"], s["opens"], s["cells"] + one, s["done"],
                                                  F.concat(s["out"], F.array(element)))).otherwise(s)


def _step(tree: str):
    def run(s: Column, t: Column) -> Column:
        closing = F.startswith(t["n"], F.lit("/"))
        name = F.substr(t["n"], F.lit(2))

        def place(table: Column) -> Column:
            """Where the stack is cut: at the element that an end tag names, or that a start tag ends."""
            own = _last(s["names"], [name], F.when(_is_in(name, [*WANTED, *SECTIONS]), table).otherwise(0))
            if tree != "implied":
                return F.when(closing, own).otherwise(0)
            row = let(_last(s["names"], ["tr"], table), lambda r: F.when(r > 0, r).otherwise(_last(s["names"], CELLS, table)))
            return (F.when(closing, own).when(_is_in(t["n"], CELLS), _last(s["names"], CELLS, table))
                    .when(_is_in(t["n"], ["tr", *SECTIONS]), row).otherwise(0))

        def moved(p: Column) -> Column:
            return let(F.when(p > 0, _cut(s, p, t["at"])).otherwise(s), lambda e: (
                F.when(closing, e).when(_is_in(t["n"], VOID) | t["s"], _empty(e, t)).otherwise(_push(e, t))))

        table = _last(s["names"], ["table"], F.lit(0)) if tree == "implied" else F.lit(0)
        return F.when(s["done"] | (t["n"] == ""), s).otherwise(let(let(table, place), moved))
    return run


def tag_pieces(fragment: Column) -> Column:
    """struct<tags, pieces>: the tags of a fragment that begins with a tag, and each tag with the text after it."""
    tags = F.regexp_extract_all(fragment, F.lit(T.TAG_RE), 0)
    return let(tags, lambda t: let(F.split(fragment, T.TAG_RE, -1), lambda x: F.struct(
        t.alias("tags"), F.transform(t, lambda g, i: F.concat(g, F.element_at(x, i + 2))).alias("pieces"),
        F.transform(t, lambda g, i: F.element_at(x, i + 2)).alias("texts"))))


def table_elements(tags: Column, tree: str) -> Column:
    """Rows and cells of the table whose start tag is the first of ``tags``, in page order: struct<at, name, end, first,
    last>, with the places of the first and end tag and the number of td cells begun before and by the end."""
    info = F.transform(tags, lambda t, i: F.struct(
        F.lower(F.regexp_extract(t, _NAME_RE, 1)).alias("n"), i.alias("at"), F.endswith(t, F.lit("/>")).alias("s")))
    none = F.array().cast(f"array<{_ELEMENT}>")
    start = _state(F.array().cast("array<string>"), F.array().cast(f"array<{_OPEN}>"), F.lit(0), F.lit(False),
                   F.array().cast(f"array<array<{_ELEMENT}>>"))

    def chunk(all_tags: Column):
        def run(s: Column, c: Column) -> Column:
            own = F.slice(all_tags, c * CHUNK + 1, F.lit(CHUNK))
            inner = F.aggregate(own, _state(s["names"], s["opens"], s["cells"], s["done"], none), _step(tree))
            return let(F.when(s["done"], F.lit(None)).otherwise(inner), lambda e: F.when(e.isNull(), s).otherwise(_state(
                e["names"], e["opens"], e["cells"], e["done"], F.concat(s["out"], F.array(e["out"])))))
        return run

    def finish(n: Column):
        def run(s: Column) -> Column:
            rest = let(_state(s["names"], s["opens"], s["cells"], s["done"], none),
                       lambda e: F.when(F.size(e["names"]) > 0, _cut(e, F.lit(1), n)["out"]).otherwise(none))
            return F.array_sort(F.concat(F.flatten(s["out"]), rest))
        return run

    chunks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(tags) / CHUNK).cast("int") - 1, F.lit(0)))
    return let(info, lambda i: F.aggregate(chunks, start, chunk(i), finish(F.size(i))))


def inner_html(pieces: Column, texts: Column, e: Column) -> Column:
    """What an element holds, tags included."""
    inside = F.array_join(F.slice(pieces, e["at"] + 2, F.greatest(e["end"] - e["at"] - 1, F.lit(0))), "")
    return F.when(e["end"] <= e["at"], F.lit("")).otherwise(F.concat(F.element_at(texts, e["at"] + 1), inside))


def table_rows(fragment: Column, tree: str, cells: int) -> Column:
    """array<struct<tag, n, cells, heads>> of a table: each row's start tag, its number of td cells, the content of the first
    ``cells`` of them, and (first row only) of its th cells.  A row's cells are all those within it, also of inner tables."""
    def rows(p: Column):
        def run(es: Column) -> Column:
            def named(name: str) -> Column:
                return F.filter(es, lambda e: e["name"] == name)

            def row(r: Column, i: Column, tds: Column, ths: Column) -> Column:
                own = F.slice(tds, r["first"] + 1, F.least(r["last"] - r["first"], F.lit(cells)))
                heads = F.filter(ths, lambda h: (h["at"] > r["at"]) & (h["at"] < r["end"]))
                return F.struct(
                    F.element_at(p["tags"], r["at"] + 1).alias("tag"), (r["last"] - r["first"]).alias("n"),
                    F.transform(own, lambda e: inner_html(p["pieces"], p["texts"], e)).alias("cells"),
                    F.when(i == 0, F.transform(heads, lambda e: inner_html(p["pieces"], p["texts"], e)))
                    .otherwise(F.array().cast("array<string>")).alias("heads"))

            return let(named("td"), lambda tds: let(named("th"), lambda ths: F.transform(
                named("tr"), lambda r, i: row(r, i, tds, ths))))
        return let(table_elements(p["tags"], tree), run)
    return let(tag_pieces(fragment), rows)
