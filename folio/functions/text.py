"""Text Columns that reproduce the string semantics the listing extractor relies on.

All functions take and return Columns and stay inside Catalyst (regex and
higher-order functions); none is a Python UDF.  Three engines disagree on what
"whitespace" is, so the Python definition (``str.isspace``) is spelled out:
Java's Unicode ``\\s`` plus the separators U+001C..U+001F.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.util import col_of, let

# Python ``str.isspace`` as a Java character-class body (used with the (?U) flag).
PY_WS = r"\s\x1c-\x1f"

# Tags, comments and raw-text blocks as the HTML tokenizer sees them.
COMMENT_RE = r"(?s)<!--.*?(?:-->|\z)"
RAW_TEXT_RE = r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
# The rest of a tag up to its ">", which may also stand in a quoted value.
TAG_REST = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
TAG_RE = rf"<(?:/?[A-Za-z]{TAG_REST}|![^>]*|\?[^>]*)>"


def py_strip(c) -> Column:
    """``str.strip()``: remove leading/trailing Python whitespace (Spark ``trim`` only drops U+0020)."""
    return F.regexp_replace(col_of(c), rf"(?U)^[{PY_WS}]+|[{PY_WS}]+\z", "")


def collapse_ws(c) -> Column:
    """``re.sub(r'\\s*[\\n\\t\\r\\s+]\\s*', ' ', x)``: every whitespace run, and every ``+``, becomes one space."""
    return F.regexp_replace(col_of(c), rf"(?U)[{PY_WS}]*[{PY_WS}+][{PY_WS}]*", " ")


def strip_raw_blocks(c) -> Column:
    """Drop comments and <script>/<style> bodies: their text is never part of a cell's text."""
    return F.regexp_replace(F.regexp_replace(col_of(c), COMMENT_RE, ""), RAW_TEXT_RE, "")


def strip_tags(c) -> Column:
    return F.regexp_replace(col_of(c), TAG_RE, "")


# ---------------------------------------------------------------------------
# HTML character references
# ---------------------------------------------------------------------------
# The named references are the public HTML5 table shipped with the Python standard
# library; numeric references 128..159 are read as Windows-1252 bytes, as the
# HTML parser does.  Both tables are generated from the standard library.
_NAMED = {name.rstrip(";"): text for name, text in html.entities.html5.items()}
_CP1252 = {}
for _b in range(128, 160):
    try:
        _CP1252[_b] = bytes([_b]).decode("cp1252")
    except UnicodeDecodeError:
        pass


_MAPS: dict = {}


def _memo(name, build):
    """Build a literal map Column once per SparkContext (each literal is a JVM round trip)."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    if name not in _MAPS or _MAPS[name][0] is not sc:
        _MAPS[name] = (sc, build())
    return _MAPS[name][1]


def _named_map() -> Column:
    return _memo("named", _build_named_map)


def _build_named_map() -> Column:
    return F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")  # one literal, folded when planned


def _cp1252_map() -> Column:
    return _memo("cp1252", _build_cp1252_map)


def _build_cp1252_map() -> Column:
    items = []
    for k in sorted(_CP1252):
        items += [F.lit(k), F.lit(_CP1252[k])]
    return F.create_map(*items)


def chr_col(cp: Column) -> Column:
    """Code point (bigint) -> one-character string; invalid code points give U+FFFD."""
    valid = (cp >= 0) & (cp <= 0x10FFFF) & ~((cp >= 0xD800) & (cp <= 0xDFFF))
    as_str = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    return F.when(valid, F.coalesce(F.try_element_at(_cp1252_map(), cp.cast("int")), as_str)).otherwise(
        F.lit("�"))


_PIECE_RE = r"(?s)^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*)(;?)(.*)$"


def _decode_piece(p: Column) -> Column:
    ref = F.regexp_extract(p, _PIECE_RE, 1)
    rest = F.regexp_extract(p, _PIECE_RE, 3)
    is_dec = ref.rlike(r"^#[0-9]+$")
    is_hex = ref.rlike(r"^#[xX]")
    dec, hexa = F.regexp_replace(ref, "^#0*", "0"), F.regexp_replace(ref, "^#[xX]0*", "0")
    cp = F.when(is_dec, F.when(F.length(dec) > 8, F.lit(0x110000)).otherwise(dec.cast("bigint"))) \
        .when(is_hex, F.when(F.length(hexa) > 7, F.lit(0x110000)).otherwise(F.conv(hexa, 16, 10).cast("bigint")))
    named = F.try_element_at(_named_map(), ref)
    decoded = F.when(is_dec | is_hex, chr_col(cp)) \
        .otherwise(F.coalesce(named, F.concat(F.lit("&"), ref)))
    return F.when(ref == "", F.concat(F.lit("&"), p)).otherwise(F.concat(decoded, rest))


def html_unescape(c) -> Column:
    """Decode character references the way the HTML parser feeds text to the tree.

    Named references are looked up with or without ``;``; an unknown name keeps
    ``&name`` (its ``;`` is consumed); ``&#N;`` / ``&#xH;`` become the character.
    Strings without ``&`` skip the per-piece work.
    """
    def decoded(s: Column) -> Column:
        joined = F.array_join(
            F.transform(F.split(s, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(_decode_piece(p))), "")
        return F.when(F.instr(s, "&") == 0, s).otherwise(joined)
    return let(col_of(c), decoded)


def cell_text(c) -> Column:
    """Text of an HTML fragment: tags removed, references decoded (comments/scripts are removed earlier)."""
    return html_unescape(strip_tags(c))


def clean_cell(c) -> Column:
    """Listing-cell text: tag-free text -> whitespace/``+`` runs to one space -> strip."""
    return py_strip(collapse_ws(cell_text(c)))


def strip_parens(c) -> Column:
    """Remove from the first ``(`` to the last ``)`` (greedy), then strip."""
    return py_strip(F.regexp_replace(col_of(c), r"\(.*\)", ""))


# ---------------------------------------------------------------------------
# Python repr() of a str, as a Column
# ---------------------------------------------------------------------------
# Characters str.isprintable() rejects (space excepted), as a Java class body.
_NONPRINT = r"\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
_NEEDS_WORK = rf"[\\'{_NONPRINT}]"


def _repr_char(ch: Column, dq: Column) -> Column:
    cp = F.ascii(ch).cast("bigint")
    hexs = F.lower(F.hex(cp))
    return (F.when(ch == "\\", F.lit("\\\\"))
            .when((ch == "'") & ~dq, F.lit("\\'"))
            .when(ch == "\t", F.lit("\\t"))
            .when(ch == "\n", F.lit("\\n"))
            .when(ch == "\r", F.lit("\\r"))
            .when(ch.rlike(f"[{_NONPRINT}]"),
                  F.when(cp < 0x100, F.concat(F.lit("\\x"), F.lpad(hexs, 2, "0")))
                  .when(cp < 0x10000, F.concat(F.lit("\\u"), F.lpad(hexs, 4, "0")))
                  .otherwise(F.concat(F.lit("\\U"), F.lpad(hexs, 8, "0"))))
            .otherwise(ch))


def py_repr(c) -> Column:
    """``repr(s)`` for a Python str (``None`` for null).

    Quote is ``"`` when the text has ``'`` and no ``"``, else ``'``.  Plain
    strings (no quote, backslash or non-printable) take the fast path.
    """
    s = col_of(c)
    dq = (F.instr(s, "'") > 0) & (F.instr(s, '"') == 0)
    q = F.when(dq, F.lit('"')).otherwise(F.lit("'"))
    chars = F.regexp_extract_all(s, F.lit("(?s)."), 0)
    body = F.array_join(F.transform(chars, lambda ch: _repr_char(ch, dq)), "")
    slow = F.concat(q, body, q)
    fast = F.concat(F.lit("'"), s, F.lit("'"))
    return (F.when(s.isNull(), F.lit("None"))
            .when(~s.rlike(_NEEDS_WORK), fast)
            .otherwise(slow))
