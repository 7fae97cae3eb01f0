"""URL Columns: split, resolve (join), extension, network location, canonical form.

Resolution follows RFC 3986 §5 with the choices of the Python standard
library's ``urljoin`` (which the extracted records must match bit for bit):
leading C0/space characters are stripped and TAB/CR/LF deleted before
parsing; a reference with another scheme is returned untouched; a reference
with an authority keeps its dot segments; empty inner segments of a relative
path are dropped; ``..`` above the root is ignored; empty ``?``/``#`` are not
written back.  Spark's ``parse_url`` is not used for paths because it returns
NULL for any URI with characters outside RFC 2396 (for example spaces).
"""

from __future__ import annotations

import urllib.parse as _up

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.util import col_of, let, lit_or_col

# Scheme families, taken from the standard library so they cannot drift.
USES_RELATIVE = list(_up.uses_relative)
USES_NETLOC = list(_up.uses_netloc)
USES_PARAMS = list(_up.uses_params)

_SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_EMPTY_STR_ARRAY = "array<string>"


def _clean_input(u: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(u, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


# RFC 3986 appendix-B split with the standard library's scheme rule; every
# component is one regex over the cleaned input, so no expression is chained.
_SPLIT_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
_PARAMS_RE = r"(?s)^((?:.*/)?[^/;]*)(?:;([^/]*))?\z"


def split_url(u, default_scheme=None) -> Column:
    """``urlparse`` as a struct<scheme, netloc, path, params, query, fragment, bad>.

    ``bad`` is true where the standard parser raises (unbalanced ``[``/``]`` in
    the network location).
    """
    return let(_clean_input(col_of(u)), lambda raw: _split(raw, default_scheme))


def _split(raw: Column, default_scheme) -> Column:
    sch = F.regexp_extract(raw, _SPLIT_RE, 1)
    scheme = F.when(sch != "", F.lower(sch)).otherwise(
        F.lit("") if default_scheme is None else lit_or_col(default_scheme))
    has_net = F.regexp_extract(raw, _SPLIT_RE, 2) != ""
    netloc = F.regexp_extract(raw, _SPLIT_RE, 3)
    path0 = F.regexp_extract(raw, _SPLIT_RE, 4)
    split_params = (sch != "").__and__(F.lower(sch).isin(USES_PARAMS)) | (
        (sch == "") & (F.lit("") if default_scheme is None else lit_or_col(default_scheme)).isin(USES_PARAMS))
    path = F.when(split_params, F.regexp_extract(path0, _PARAMS_RE, 1)).otherwise(path0)
    params = F.when(split_params, F.regexp_extract(path0, _PARAMS_RE, 2)).otherwise(F.lit(""))
    bad = has_net & (netloc.contains("[") != netloc.contains("]"))
    return F.struct(scheme.alias("scheme"), netloc.alias("netloc"), path.alias("path"),
                    params.alias("params"), F.regexp_extract(raw, _SPLIT_RE, 5).alias("query"),
                    F.regexp_extract(raw, _SPLIT_RE, 6).alias("fragment"), bad.alias("bad"))


def unparse_url(scheme: Column, netloc: Column, path: Column, params: Column,
                query: Column, fragment: Column) -> Column:
    """``urlunparse``: empty query/fragment/params are not written."""
    p = F.concat(path, F.when(params != "", F.concat(F.lit(";"), params)).otherwise(F.lit("")))
    lead = (F.when(netloc != "",
                   F.concat(F.lit("//"), netloc,
                            F.when((p != "") & ~F.startswith(p, F.lit("/")), F.lit("/")).otherwise(F.lit(""))))
            .when(F.startswith(p, F.lit("//")), F.lit("//"))
            .when((scheme != "") & scheme.isin(USES_NETLOC) & ((p == "") | F.startswith(p, F.lit("/"))), F.lit("//"))
            .otherwise(F.lit("")))
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")), lead, p,
                    F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
                    F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")))


def _remove_dots(segments: Column) -> Column:
    folded = F.aggregate(
        segments, F.array().cast(_EMPTY_STR_ARRAY),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))))
    last = F.try_element_at(segments, F.lit(-1))
    return F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)


def _join(b: Column, r: Column, href_c: Column, base_c: Column) -> Column:
    scheme = r["scheme"]
    foreign = (scheme != b["scheme"]) | ~scheme.isin(USES_RELATIVE)
    own_net = scheme.isin(USES_NETLOC) & (r["netloc"] != "")
    netloc = F.when(scheme.isin(USES_NETLOC), b["netloc"]).otherwise(r["netloc"])
    empty_path = (r["path"] == "") & (r["params"] == "")
    keep_base = unparse_url(scheme, netloc, b["path"], b["params"],
                            F.when(r["query"] != "", r["query"]).otherwise(b["query"]), r["fragment"])
    rel_parts = F.split(r["path"], "/", -1)
    base_parts = F.split(b["path"], "/", -1)
    base_dir = F.when(F.try_element_at(base_parts, F.lit(-1)) != "",
                      F.slice(base_parts, 1, F.size(base_parts) - 1)).otherwise(base_parts)
    merged = let(F.concat(base_dir, rel_parts),
                 lambda m: F.filter(m, lambda s, i: (i == 0) | (i == F.size(m) - 1) | (s != "")))
    segments = F.when(F.startswith(r["path"], F.lit("/")), rel_parts).otherwise(merged)
    resolved = let(F.array_join(let(segments, _remove_dots), "/"),
                   lambda x: F.when(x == "", F.lit("/")).otherwise(x))
    general = unparse_url(scheme, netloc, resolved, r["params"], r["query"], r["fragment"])
    return (F.when(href_c == "", base_c)
            .when(r["bad"] | b["bad"], F.lit(None).cast("string"))
            .when(foreign, href_c)
            .when(own_net, unparse_url(scheme, r["netloc"], r["path"], r["params"], r["query"], r["fragment"]))
            .when(empty_path, keep_base)
            .otherwise(general))


def join_url(base, href) -> Column:
    """``urljoin(base, href)`` for Column/str base and Column href.

    Returns NULL where the standard library raises (see ``url_error``).
    """
    base_c = lit_or_col(base)
    href_c = col_of(href)
    out = let(F.struct(href_c.alias("h"), base_c.alias("base"), split_url(base_c).alias("b")),
              lambda v: let(F.struct(v["h"].alias("h"), v["base"].alias("base"), v["b"].alias("b"),
                                     split_url(v["h"], default_scheme=v["b"]["scheme"]).alias("r")),
                            lambda w: _join(w["b"], w["r"], w["h"], w["base"])))
    return F.when(base_c == "", href_c).otherwise(out)


def url_error(href) -> Column:
    """True where parsing ``href`` raises in the standard library (malformed IPv6 brackets)."""
    return split_url(col_of(href))["bad"]


def resolve_download_url(href, base: str = "https://www.esd.whs.mil") -> Column:
    """Resolve a listing link and percent-encode spaces only (``.replace(' ', '%20')``)."""
    return F.replace(join_url(base, href), F.lit(" "), F.lit("%20"))


def url_path(u) -> Column:
    return split_url(col_of(u))["path"]


def file_ext(u, unknown: str = "Unkown") -> Column:
    """Extension of the URL path: last dot of the last segment, leading-dot names have none.

    Dots removed, lower-cased; empty gives ``unknown`` (the misspelling is the
    reference's literal and part of every fingerprint of such rows).
    """
    from folio.functions.text import py_strip
    last = F.regexp_extract(url_path(u), r"[^/]*\z", 0)
    ext = F.regexp_extract(last, r"(?s)^.*[^.].*(\.[^.]*)\z", 1)
    return let(F.lower(F.replace(ext, F.lit("."), F.lit(""))),
               lambda raw: F.when(raw == "", F.lit(unknown)).otherwise(py_strip(raw)))


def netloc(u) -> Column:
    """``urlparse(u).netloc``: authority with case, userinfo and port kept."""
    return split_url(col_of(u))["netloc"]


def host(u) -> Column:
    """Lower-case host name: netloc without userinfo and port."""
    n = netloc(u)
    no_user = F.regexp_replace(n, r"^.*@", "")
    return F.lower(F.regexp_replace(no_user, r":[0-9]*\z", ""))


def in_domains(host_col, domains) -> Column:
    """Host equals an allowed domain or is a subdomain of one (offsite rule)."""
    h = F.lower(col_of(host_col))
    cond = F.lit(False)
    for d in domains:
        d = d.lower()
        cond = cond | (h == d) | F.endswith(h, F.lit("." + d))
    return cond


def host_suffixes(host_col) -> Column:
    """The host itself and every parent domain, longest first: a.b.c -> a.b.c, b.c, c."""
    labels = F.split(F.lower(col_of(host_col)), r"\.", -1)
    return let(labels, lambda x: F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(
        F.slice(x, i, F.size(x) - i + 1), ".")))


# ---------------------------------------------------------------------------
# Canonical form: percent escapes, internationalised hosts, default ports
# ---------------------------------------------------------------------------
_UNRESERVED = r"[A-Za-z0-9._~\-]"
_PATH_SAFE = r"[A-Za-z0-9._~\-!$&'()*+,;=:@/]"
_QUERY_SAFE = r"[A-Za-z0-9._~\-!$'()*+,;:@/?]"  # of a key or value: "&" and "=" separate them
# Ports that a scheme implies.
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}


def _escaped(c: Column) -> Column:
    """Percent escapes of a text's UTF-8 bytes."""
    return F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")


def normal_escapes(c, safe: str = _PATH_SAFE) -> Column:
    """Escapes of unreserved characters decoded, the others in upper case; characters outside ``safe`` escaped as UTF-8, a
    lone "%" too.  Texts of safe characters alone are returned as they are."""
    def token(t: Column) -> Column:
        byte = F.substr(t, F.lit(2))
        char = F.chr(F.conv(byte, 16, 10).cast("int"))
        decoded = F.when(F.conv(byte, 16, 10).cast("int") < 128, F.when(char.rlike(f"^{_UNRESERVED}$"), char))
        return (F.when(F.length(t) == 3, F.coalesce(decoded, F.upper(t)))
                .when(t.rlike(f"^{safe}$"), t).otherwise(_escaped(t)))
    x = col_of(c)
    tokens = F.regexp_extract_all(x, F.lit("(?s)%[0-9A-Fa-f]{2}|."), 0)
    return F.when(x.rlike(f"^{safe}*\\z"), x).otherwise(F.array_join(F.transform(tokens, token), ""))


def _adapted(delta: Column, points: Column, first: Column) -> Column:
    """Bias after a delta (RFC 3492 section 6.1); the loop of at most five rounds is a fold."""
    d0 = F.when(first, F.floor(delta / 700)).otherwise(F.floor(delta / 2))
    start = let(d0, lambda d: F.struct((d + F.floor(d / points)).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("k")))
    return let(start, lambda s: F.aggregate(
        F.sequence(F.lit(1), F.lit(8)), s,
        lambda a, _: F.when(a["d"] > 455, F.struct(F.floor(a["d"] / 35).cast("bigint").alias("d"), (a["k"] + 36).alias("k"))).otherwise(a),
        lambda a: (a["k"] + F.floor(36 * a["d"] / (a["d"] + 38))).cast("bigint")))


def _digits(delta: Column, bias: Column) -> Column:
    """A delta as a variable-length integer (RFC 3492 section 3.3)."""
    alphabet = F.lit("abcdefghijklmnopqrstuvwxyz0123456789")

    def digit(v: Column) -> Column:
        return F.substr(alphabet, (v + 1).cast("int"), F.lit(1))

    def step(a: Column, i: Column) -> Column:
        def more(t: Column) -> Column:
            return F.when(a["done"], a).when(a["q"] < t, F.struct(
                a["q"].alias("q"), F.lit(True).alias("done"), F.concat(a["out"], digit(a["q"])).alias("out"))).otherwise(F.struct(
                    F.floor((a["q"] - t) / (36 - t)).cast("bigint").alias("q"), F.lit(False).alias("done"),
                    F.concat(a["out"], digit(t + (a["q"] - t) % (36 - t))).alias("out")))
        return let(F.least(F.greatest(36 * i - bias, F.lit(1)), F.lit(26)).cast("bigint"), more)

    start = F.struct(delta.cast("bigint").alias("q"), F.lit(False).alias("done"), F.lit("").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(16)), start, step, lambda a: a["out"])


def punycode(label) -> Column:
    """A host label in ASCII: ``xn--`` and its Punycode form if it has other characters (RFC 3492), else as it is.

    A fold over the label's distinct code points beyond ASCII, in rising order, and for each over its characters."""
    def encoded(x: Column) -> Column:
        points = F.transform(F.regexp_extract_all(x, F.lit("(?s)."), 0), lambda ch: F.ascii(ch).cast("bigint"))

        def run(p: Column) -> Column:
            basic = F.filter(p, lambda c: c < 128)
            head = F.array_join(F.transform(basic, lambda c: F.chr(c.cast("int"))), "")
            b = F.size(basic).cast("bigint")
            start = F.struct(F.lit(128).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("delta"),
                             F.lit(72).cast("bigint").alias("bias"), b.alias("h"),
                             F.concat(head, F.when(b > 0, "-").otherwise("")).alias("out"))

            def level(a: Column, m: Column) -> Column:
                begun = F.struct(m.alias("n"), (a["delta"] + (m - a["n"]) * (a["h"] + 1)).alias("delta"), a["bias"].alias("bias"),
                                 a["h"].alias("h"), a["out"].alias("out"))

                def char(s: Column, c: Column) -> Column:
                    return (F.when(c < s["n"], F.struct(s["n"].alias("n"), (s["delta"] + 1).alias("delta"), s["bias"].alias("bias"),
                                                        s["h"].alias("h"), s["out"].alias("out")))
                            .when(c == s["n"], F.struct(
                                s["n"].alias("n"), F.lit(0).cast("bigint").alias("delta"),
                                _adapted(s["delta"], s["h"] + 1, s["h"] == b).alias("bias"), (s["h"] + 1).alias("h"),
                                F.concat(s["out"], _digits(s["delta"], s["bias"])).alias("out"))).otherwise(s))
                return let(F.aggregate(p, begun, char), lambda s: F.struct(
                    (s["n"] + 1).alias("n"), (s["delta"] + 1).alias("delta"), s["bias"].alias("bias"), s["h"].alias("h"), s["out"].alias("out")))
            high = F.array_sort(F.array_distinct(F.filter(p, lambda c: c >= 128)))
            return F.aggregate(high, start, level, lambda a: F.concat(F.lit("xn--"), a["out"]))
        return let(points, run)
    x = col_of(label)
    return F.when(x.rlike(r"^[\x00-\x7F]*\z"), x).otherwise(encoded(x))


def _canonical_netloc(scheme: Column, net: Column) -> Column:
    """Host in lower case and ASCII, without an empty or implied port; user information is kept."""
    user = F.regexp_extract(net, r"^(.*@)?", 1)
    port = F.regexp_extract(net, r":([0-9]*)\z", 1)
    name = F.lower(F.regexp_replace(F.regexp_replace(net, r"^.*@", ""), r":[0-9]*\z", ""))
    ascii_name = F.when(name.rlike(r"^[\x00-\x7F]*\z"), name).otherwise(
        F.array_join(F.transform(F.split(name, r"[.\x{3002}\x{FF0E}\x{FF61}]", -1), punycode), "."))
    implied = F.lit(False)
    for s, p in DEFAULT_PORTS.items():
        implied = implied | ((scheme == s) & (port == p))
    return F.concat(user, ascii_name, F.when((port == "") | implied, F.lit("")).otherwise(F.concat(F.lit(":"), port)))


def canonical_url(u) -> Column:
    """Request-dedup canonical form: scheme and host in lower case, host in Punycode, no default port, percent escapes
    normalised, fragment dropped, query arguments sorted by (key, value) with blank values kept."""
    return let(split_url(col_of(u)), _canonical)


def _canonical(s: Column) -> Column:
    args = F.filter(F.split(s["query"], "&", -1), lambda a: a != "")
    kv = F.transform(args, lambda a: F.struct(
        normal_escapes(F.substring_index(a, "=", 1), _QUERY_SAFE).alias("k"),
        normal_escapes(F.when(F.instr(a, "=") > 0, F.substr(a, F.instr(a, "=") + 1)).otherwise(F.lit("")), _QUERY_SAFE).alias("v")))
    sorted_q = F.array_join(F.transform(F.array_sort(kv), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    path = F.when(s["path"] == "", F.lit("/")).otherwise(normal_escapes(s["path"]))
    return unparse_url(s["scheme"], _canonical_netloc(s["scheme"], s["netloc"]), path, normal_escapes(s["params"]), sorted_q, F.lit(""))
