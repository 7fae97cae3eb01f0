"""Raw page files, canonical URLs, offsite joins and date texts against the standard library."""

import datetime
import random
import urllib.parse as up

import pytest
from pyspark.sql import functions as F

from folio.functions import urls as U
from folio.functions.dates import MONTHS, parse_date
from folio.operators import links as K
from folio.sources.pages import scan_page_files


@pytest.mark.parametrize("others", [False, True])
def test_page_files_in_many_charsets(spark, tmp_path, others):
    western = "<html><head>{}</head><p>café – “naïve” €5 œ</p>\r\n</html>"
    world = "<html><head>{}</head><p>日本 😀 ещё ñ</p></html>"
    files = {
        "bom8": (world.format("").encode("utf-8-sig"), world.format("")),
        "bom16le": (b"\xff\xfe" + world.format("").encode("utf-16-le"), world.format("")),
        "bom16be": (b"\xfe\xff" + world.format("").encode("utf-16-be"), world.format("")),
        "odd16": (b"\xff\xfe" + "ab".encode("utf-16-le") + b"\x41", "ab"),
        "meta8": ((m := world.format('<META charset="UTF-8">')).encode(), m),
        "http8": ((m := world.format("<meta http-equiv=content-type content='text/html; charset=utf-8'>")).encode(), m),
        "meta1252": ((m := western.format("<meta charset=iso-8859-1>")).encode("cp1252"), m),
        "none": ((m := western.format("<!-- <meta charset=utf-8> -->")).encode("cp1252"), m),
        "lies16": ((m := world.format("<meta charset=utf-16>")).encode(), m),
        "broken8": (b"<meta charset=utf-8>a\xff\xe2\x82b", "<meta charset=utf-8>a��b"),
        "far": ((m := western.format(" " * 1100 + "<meta charset=utf-8>")).encode("cp1252"), m),
        "mark": (b"\xef\xbb\xbf", ""),
    }
    if others:
        files["koi8"] = ((m := "<meta charset=koi8-r>ещё").encode("koi8-r"), m)
        files["unknown"] = (b"<meta charset=no-such>caf\xe9", "<meta charset=no-such>café")
    for name, (raw, _) in files.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.html").write_bytes(raw)
    got = {r.path.rsplit("/", 1)[-1][:-5]: r.html for r in scan_page_files(spark, str(tmp_path / "in"), "*.html", others).collect()}
    assert got == {n: t for n, (_, t) in files.items()}


def stdlib_canonical(u):
    p = up.urlparse(u)

    def escapes(x, safe):
        out = []
        i = 0
        while i < len(x):
            if x[i] == "%" and len(x) > i + 2 and all(c in "0123456789abcdefABCDEF" for c in x[i + 1:i + 3]):
                c = chr(int(x[i + 1:i + 3], 16))
                out.append(c if c.isascii() and (c.isalnum() or c in "-._~") else x[i:i + 3].upper())
                i += 3
            else:
                out.append(up.quote(x[i], safe=safe))
                i += 1
        return "".join(out)
    user, at, rest = p.netloc.rpartition("@")
    host, colon, port = rest.rpartition(":") if rest.rpartition(":")[2].isdigit() or rest.endswith(":") else (rest, "", "")
    labels = [x if x.isascii() else "xn--" + x.encode("punycode").decode() for x in host.lower().replace("。", ".").split(".")]
    if port == {"http": "80", "https": "443"}.get(p.scheme):
        port = ""
    args = sorted((escapes(k, "!$'()*+,;:@/?"), escapes(v, "!$'()*+,;:@/?")) for k, _, v in (a.partition("=") for a in p.query.split("&") if a))
    safe = "!$&'()*+,;=:@/"
    return up.urlunparse((p.scheme, user + at + ".".join(labels) + (":" + port if port else ""), escapes(p.path, safe) or "/",
                          escapes(p.params, safe), "&".join(f"{k}={v}" for k, v in args), ""))


def test_canonical_urls_equal_the_stdlib(spark):
    rng = random.Random(7)
    hosts = ["Example.COM", "bücher.example", "例え.テスト", "пример。рф", "a-ñ-b.EXAMPLE.org", "x" * 20 + "ü" * 10 + ".de", "10.0.0.1", "mañana", "ﬀ😀x.io",
             "egbpdaj6bu4bxfgehfvwxn.x", "ليهمابتكلموشعربي؟.eg", "他们为什么不说中文", "Pročprostěnemluvíčesky.cz"]
    parts = ["a", "B", "%7e", "%c3%a9", "é", "%2f", "%2F", "/", "/", " ", "%", "%4", "~", "日", "%zz", ";p", "+", "!", "(", '"', "<", "[", "%41", "."]
    keys = ["b", "a", "%61", "q q", "é", "", "z%3d"]
    urls = []
    for _ in range(800):
        port = rng.choice(["", "", ":80", ":443", ":8080", ":"])
        query = "&".join(rng.choice(keys) + rng.choice(["", "=", "=1", "=%7E", "=ü", "=x=y", "=a/b"]) for _ in range(rng.randrange(5)))
        urls.append(rng.choice(["http", "HTTPS", "https"]) + "://" + rng.choice(["", "", "Me@"]) + rng.choice(hosts) + port
                    + rng.choice(["", "/"]) * 1 + ("/" + "".join(rng.choice(parts) for _ in range(rng.randrange(8))) if rng.random() < 0.8 else "")
                    + ("?" + query if query else "") + rng.choice(["", "#frag%7e"]))
    got = spark.createDataFrame([(u,) for u in urls], "u string").repartition(4).select("u", U.canonical_url("u").alias("c")).collect()
    wrong = [(r.u, r.c, stdlib_canonical(r.u)) for r in got if r.c != stdlib_canonical(r.u)]
    assert not wrong, wrong[:3]


def test_canonical_links_meet(spark):
    same = ["HTTP://Bücher.example:80/%7euser/%c3%a9?b=2&a=%41#x", "http://xn--bcher-kva.example/~user/é?a=A&b=2"]
    df = spark.createDataFrame([(1, i, u) for i, u in enumerate(same)], "page_id int, link_pos int, link string")
    assert [(r.canonical, r.link_pos) for r in K.dedupe_links(df).collect()] == [("http://xn--bcher-kva.example/~user/%C3%A9?a=A&b=2", 0)]


def test_offsite_join_of_many_domains(spark):
    rng = random.Random(3)
    domains = [f"d{k}.example" for k in range(100_000)] + ["net", "Sub.D5.example", ".org.", ""]
    hosts = [rng.choice(["", "a.", "x.y.", "notd"]) + f"d{rng.randrange(200_000)}.example" for _ in range(1500)]
    hosts += ["net", "a.net", "anet", "deep.sub.d5.example", "ORG", "x.org:8080", "example", ""]
    links = spark.createDataFrame([(k, f"http://{h}/p") for k, h in enumerate(hosts)] + [(9999, None), (9998, "/no-host"), (1, "http://a.net/p"), (1, "http://a.net/p")],
                                  "k int, link string")
    table = K.domain_table(spark.createDataFrame([(d,) for d in domains], "domain string"))
    assert table.count() == 100_002  # sub.d5.example lies below d5.example
    out = K.offsite_filter_table(links, table)
    known = {d.lower().strip(".") for d in domains} - {""}

    def allowed(h):
        labels = h.lower().split(":")[0].split(".")
        return any(".".join(labels[i:]) in known for i in range(len(labels)))
    want = [k for k, h in enumerate(hosts) if allowed(h)] + [1, 1]
    assert sorted(r.k for r in out.collect()) == sorted(want)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "LeftSemi" in plan and "d7.example" not in plan and plan.count(" OR ") < 5
    few = ["net", "org", "d7.example"]
    assert sorted(r.k for r in K.offsite_filter(links, few).collect()) == sorted(r.k for r in K.offsite_filter_table(
        links, K.domain_table(spark.createDataFrame([(d,) for d in few], "domain string"))).collect())


def test_date_texts(spark):
    rng = random.Random(5)
    cases = []
    for _ in range(600):
        d = datetime.date(1970, 1, 1) + datetime.timedelta(days=rng.randrange(35000))
        name = MONTHS[d.month - 1]
        short = rng.choice([name, name[:3], name[:3] + ".", name[:3].upper(), name.title()])
        end = "th" if 10 <= d.day % 100 <= 20 else {1: "st", 2: "nd", 3: "rd"}.get(d.day % 10, "th")
        year = rng.choice([str(d.year), f"{d.year % 100:02d}"]) if d.year >= 1970 and d.year <= 2068 else str(d.year)
        forms = [f"{short} {d.day}, {year}", f"{short} {d.day}{end} {d.year}", f"{d.day} {short} {d.year}", f"{d.day}-{short.strip('.')}-{year}",
                 f"{d.month}/{d.day}/{year}", f"{d.month:02d}-{d.day:02d}-{d.year}", f"{d.day}.{d.month}.{year}", d.isoformat(),
                 d.strftime("%Y/%m/%d"), d.strftime("%Y%m%d"), d.strftime("%A, %B %d, %Y"), f"  {d.year} {short} {d.day} ", f"{d.isoformat()}T00:00:00"]
        if d.day > 12:
            forms.append(f"{d.day}/{d.month}/{d.year}")
        cases.append((rng.choice(forms), d.isoformat()))
    df = spark.createDataFrame(cases, "t string, d string").select("t", "d", F.date_format(parse_date("t"), "yyyy-MM-dd'T'HH:mm:ss").alias("p"))
    assert [r for r in df.collect() if r.p != r.d + "T00:00:00"] == []
    bad = ["", "n/a", "Feb 30 2020", "13/13/2020", "2020-13-01", "January 2020", "5", "1/2", "1/2/3/4", "Monday", "ma 3 2020", "1/5/2020 25:00",
           "2020-01-05 12:60", "January 5, 2020 (draft)", "00/00/0000", "20201301", "May May 2020", "12:30"]
    assert spark.createDataFrame([(b,) for b in bad], "t string").where(parse_date("t").isNotNull()).count() == 0
    assert [str(r[0]) for r in spark.createDataFrame([("1/5/2020 3:07 pm",)], "t string").select(
        parse_date("t"), parse_date("t", day_first=True)).collect()[0:1]] == ["2020-01-05 15:07:00"]
    assert str(spark.createDataFrame([("1/5/2020",)], "t string").select(parse_date("t", day_first=True)).first()[0]) == "2020-05-01 00:00:00"
