"""Page tables from raw page files: one file a page, read as bytes and decoded by the charset that the page itself names.

The charset is that of a byte-order mark (UTF-8, UTF-16), else the first ``charset=`` of a ``<meta>`` tag in the first 1024 bytes,
else Windows-1252.  As HTML has it, ISO-8859-1, Latin-1 and ASCII are read as Windows-1252, and a page whose ``<meta>`` names
UTF-16 is UTF-8.  Bytes that are not valid UTF-8 become U+FFFD.  These charsets are decoded in Columns; a page in another one is
decoded by Python's codec in an Arrow UDF (only with ``other_charsets``, else it is read as Windows-1252).
"""

from __future__ import annotations

import codecs

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD_BYTES = 1024
# Labels by which pages name the charsets that are decoded in Columns.
UTF8_LABELS = ["utf-8", "utf8", "unicode-1-1-utf-8", "utf-16", "utf-16le", "utf-16be"]  # a meta tag that is legible is not UTF-16
LATIN_LABELS = ["windows-1252", "cp1252", "x-cp1252", "iso-8859-1", "iso8859-1", "latin1", "latin-1", "l1", "ascii", "us-ascii"]

_META_RE = r"""(?is)<meta\s[^>]*?charset\s*=\s*["']?\s*([^\s"'/>;]+)"""
_HIGH = [(b, bytes([b]).decode("cp1252", "replace")) for b in range(0x80, 0xA0)]
_C1 = "".join(chr(b) for b, c in _HIGH if c != "�")
_CP1252 = "".join(c for _, c in _HIGH if c != "�")


def page_charset(content: Column) -> Column:
    """Label of the charset of a page's bytes."""
    mark = F.hex(F.substring(content, 1, 3))
    head = F.decode(F.substring(content, 1, HEAD_BYTES), "ISO-8859-1")
    head = F.regexp_replace(head, r"(?s)<!--.*?(?:-->|\z)", "")
    named = F.lower(F.regexp_extract(head, _META_RE, 1))
    return (F.when(mark == "EFBBBF", "utf-8").when(F.startswith(mark, F.lit("FFFE")), "utf-16le")
            .when(F.startswith(mark, F.lit("FEFF")), "utf-16be").when(named.isin(UTF8_LABELS), "utf-8")
            .when((named == "") | named.isin(LATIN_LABELS), "windows-1252").otherwise(named))


def _codec(content: pa.Array, charset: pa.Array) -> pa.Array:
    out = []
    for raw, name in zip(content.to_pylist(), charset.to_pylist()):
        if raw is None:
            out.append(None)
            continue
        try:
            codecs.lookup(name)
            out.append(raw.decode(name, "replace"))
        except LookupError:
            out.append(raw.decode("cp1252", "replace"))
    return pa.array(out, pa.string())


def decode_page(content: Column, charset: Column, other_charsets: bool = False) -> Column:
    """Text of a page's bytes, without a byte-order mark."""
    latin = F.translate(F.decode(content, "ISO-8859-1"), _C1, _CP1252)
    utf8 = F.make_valid_utf8(content.cast("string"))
    even = F.substring(content, 1, F.octet_length(content) - F.octet_length(content) % 2)
    text = (F.when(charset == "utf-8", F.regexp_replace(utf8, r"^\x{FEFF}", ""))
            .when(charset == "utf-16le", F.regexp_replace(F.decode(even, "UTF-16LE"), r"^\x{FEFF}", ""))
            .when(charset == "utf-16be", F.regexp_replace(F.decode(even, "UTF-16BE"), r"^\x{FEFF}", "")))
    if not other_charsets:
        return F.coalesce(text, latin)
    python = F.arrow_udf(_codec, "string")
    unusual = ~charset.isin("utf-8", "utf-16le", "utf-16be", "windows-1252")
    return F.coalesce(text, F.when(charset == "windows-1252", latin), python(F.when(unusual, content), charset))


def scan_page_files(spark: SparkSession, path: str | list[str], pattern: str = "*", other_charsets: bool = False) -> DataFrame:
    """(path, charset, html) of all files under ``path`` (a folder or several) whose names match ``pattern``; Spark leaves out files of no bytes."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
             .select("path", "content"))
    files = files.withColumn("charset", page_charset(F.col("content")))
    return files.select("path", "charset", decode_page(F.col("content"), F.col("charset"), other_charsets).alias("html"))
