"""Record fingerprints.

A fingerprint is the SHA-256 hex digest of the UTF-8 text obtained by sorting
the (name, value) pairs by name and concatenating each pair rendered as the
Python tuple text ``('name', <repr(value)>)`` with no separator.  The repr is a
native Column (``py_repr``), so hashing never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import py_repr
from folio.functions.util import col_of

# The six fields of a listing record's version fingerprint.
VERSION_HASH_FIELDS = ["download_url", "pub_date", "change_date", "doc_num", "doc_name", "display_title"]


def _key_repr(name: str) -> str:
    return repr(name)


def value_repr(c, kind: str = "string") -> Column:
    """Python text of a value: quoted strings, ``True``/``False``, plain whole numbers, ``None``."""
    c = col_of(c)
    if kind == "string":
        return py_repr(c)
    if kind == "boolean":
        return F.when(c.isNull(), "None").when(c, "True").otherwise("False")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(c.cast("string"), F.lit("None"))
    raise TypeError(f"no fingerprint text for type {kind}")


def fingerprint_text(fields: dict, types: dict | None = None) -> Column:
    """The text that is hashed: ``('k1', v1)('k2', v2)...`` with keys sorted.

    ``types`` gives the Spark type (``simpleString``) of fields that are not strings."""
    parts = []
    for k in sorted(fields, key=str):
        parts += [F.lit(f"({_key_repr(k)}, "), value_repr(fields[k], (types or {}).get(k, "string")), F.lit(")")]
    return F.concat(*parts) if parts else F.lit("")


def fingerprint(fields: dict, types: dict | None = None) -> Column:
    """SHA-256 hex of ``fingerprint_text``; ``fields`` maps key name -> Column or column name."""
    return F.sha2(fingerprint_text(fields, types), 256)


def version_hash(raw_data) -> Column:
    """Fingerprint of a ``version_hash_raw_data`` struct Column."""
    s = col_of(raw_data)
    return fingerprint({k: s[k] for k in VERSION_HASH_FIELDS})
