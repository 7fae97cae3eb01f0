"""Chat formatting, extraction, archives, tokens, language and URL operators: exact round trips and brute force."""

import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from folio.llm import bpe, chat, html_main, langid, token_files, url_rules, warc
from folio.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
PARTS = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "<s>", "</s>", "[/INST]", "<role>", "</role>", " ", "a", "\n", "é", "|"]


def some(rng, most=8):
    return "".join(rng.choices(PARTS, k=rng.randrange(most)))


def test_escape_is_reversible_and_hides_controls():
    rng = random.Random(1)
    for _ in range(3000):
        x = some(rng)
        y = chat.escape(x)
        assert chat.unescape(y) == x and not any(c in y for c in chat.CONTROLS)
        if not any(c.replace("\\", "") in x.replace("\\", "") for c in chat.CONTROLS):
            assert y == x


def test_chat_digests(spark):
    rng = random.Random(2)
    rows = [(c if c else None, t if rng.random() < .9 else None, rng.choice(["user", "assistant", "system", None, "</role>"]),
             rng.choice([None, some(rng), some(rng)]), "x") for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(99, 0, "assistant", "long " * 400000, "x")] + [(98, k, "user", "t", "x") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, last string")
    got = {r.conv_id: tuple(r) for r in chat.digests(chat.render(df)).collect()}
    convs = {}
    for c, t, r, x, _ in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    assert len(got) == len(convs)
    for c, v in convs.items():
        v.sort()
        turns = "".join(f"{m[3]}\n{m[5]}\n" for m in v)
        loss = "".join(m[5] for m in v if m[3] == "assistant")
        assert got[c][1:5] == (len(v), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.render(df.limit(0))).count() == 0


def test_templates_fold_and_stay_in_the_sandbox():
    tree = chat.fold(chat.parse("{% if true and not false %}a{% else %}b{% endif %}{{ 'c' + 'd' | upper }}"))
    assert tree == [("text", "acD")]
    t = chat.Template("<<{% for m in messages %}{% if loop.first %}F{% endif %}{{ m.text }}{% if not loop.last %},{% endif %}{% endfor %}>>")
    out = []
    for k in (1, 2):
        t.message({"m.text": str(k), "m.role": "", "m.turn": k, "loop.index": k, "loop.first": k == 1, "loop.last": k == 2}, out.append, None)
    assert "".join(out) == "F1,2"
    for bad in ("{{ m.__class__ }}", "{{ open('x') }}", "{{ m.text.upper }}", "{% if m.text %}", "{{ 'x' | eval }}", "{% import os %}",
                "{% generation %}{% endgeneration %}", "no loop", "{{ m.text }}{% for m in messages %}{% endfor %}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script><body class="with-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies to make the site better for you and for all of the others.</div>
<article><h1>Head &amp; line</h1><p>Short one.<p>The <b>first</b> of the  paragraphs is here,
and it has a lot of the words that are in all of the texts.<br>Tail&hellip;<form><input><p>Send us the news of the day in the mail</form>
<div id=ad-1>Buy now</div><p><a href=x>see also this</a></p></article><aside>The side has the text of the day and some of the others.</aside>
<section id="comments"><p>I think that this is the best of the articles that I have read in all of the years.</p></section>
<footer>&copy; the owners of the site</footer>"""


def test_main_text():
    assert html_main.main_text(PAGE) == ("Head & line Short one. The first of the paragraphs is here, and it has a lot of the words "
                                         "that are in all of the texts. Tail…")
    assert html_main.main_text("") == "" and html_main.main_text("<script>x") == "" and html_main.main_text("<nav>a</nav>") == ""
    assert html_main.main_text("<p>Alone &lt;here&gt; &a &amp") == "Alone <here> &a &"
    assert html_main.main_text("<p>a < b <!-- c --> d<a href='") == "a < b d"


def test_main_text_in_wrappers():
    part = "The {} part of the text is here, and it has a lot of the words that are in all of the texts of the day."
    a, b, c, d = (part.format(x) for x in ("first", "second", "third", "fourth"))
    body = f"<p>{a}</p><p>{b}</p>"
    for page in (f"<form id=aspnetForm><nav>Menu</nav><div>{body}</div><footer>foot</footer></form>",
                 f"<p>Skip</p><form role=form>{body}</form>" + f"<nav>{c}</nav>",
                 f"<form><article>{body}</article></form><p>{c[:40]}</p>",
                 f'<div class="content-sidebar-wrap">{body}</div>',
                 f'<div class="content-sidebar-wrap"><main>{body}</main><div class="sidebar">{c}</div></div>',
                 f'<div class="ad-free"><main>{body}</main></div>', f'<div class="ad-free"><article>{body}</article></div>',
                 f'<article>{body}<form>{c}</form></article><div class="related"><article>{d}</article></div>',
                 f'<div>{body}</div><ol id="comments"><li><article>{c}{d}{c}{d}</article></ol>',
                 f"<article>{body}</article><form>{c}</form>"):
        assert html_main.main_text(page).removeprefix("Skip ") == f"{a} {b}", page
    for name in ("related-work", "notice-period", "social-policy", "ad-hoc-networks"):
        assert html_main.main_text(f"<article><p>{a}</p><section id={name}><h2>Head</h2><p>{b}</p></section></article>") == f"{a} Head {b}"
    for name in ("comments", "comment-form", "div-gpt-ad-12", "newsletter-signup"):
        assert html_main.main_text(f"<article><p>{a}</p><div id={name}><p>{b}</p></div></article>") == a
    for raw in ('<svg class="a" />', "<svg/>", "<math href='/>' />", "<SVG a=\"b>c\"\n/>", "<svg a='/'><text>no</text></svg>"):
        assert html_main.main_text(f"<article>{raw}<p>{a}</p>{raw}<p>{b}</p></article>") == f"{a} {b}"
    assert html_main.main_text('<div class="share">' * 20000 + a) == a


def test_extract(spark):
    df = spark.createDataFrame([(1, None, PAGE, "x"), (None, "u", None, "x"), (3, "u", "<p>" + "word " * 50000, "x")], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_main.extract(df).collect()}
    assert got[1].text == html_main.main_text(PAGE) and got[None].text == "" and got[3].n_chars == 249999
    assert html_main.block_table(df).where("main").count() >= 4 and html_main.extract(df.limit(0)).count() == 0


def test_warc_round_trip(spark):
    big, rng = "é" * 700, random.Random(4)
    rows = [(k, f"http://h/{k}\n x" if k % 3 else None, rng.choice([None, "", "small", big, big + "x", "p" * 999, "q" * 1000]), "x") for k in range(60)]
    rows += [(None, "u", big, "x"), (60, "u", "z" * 3_000_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string")
    got = {r.page_id: tuple(r) for r in warc.round_trip(df, file_bytes=2000).collect()}
    most = {}
    for i, _, h, _ in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            most[b] = max(i, most.get(b, -1))
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        b = (h or "").encode()
        keep = most.get(b, i)
        assert got[i] == (i, len(b), hashlib.sha1(b).hexdigest(), "response" if keep == i else "revisit", None if keep == i else keep)
    read = warc.read_archives(warc.write_archives(df), payloads=True)
    want = {i: (h or "").encode() for i, _, h, _ in rows if most.get((h or "").encode(), i) == i}
    assert {r.id: bytes(r.payload) for r in read.where("record_type = 'response'").collect()} == want
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_damage_is_found():
    one = warc._record(1, "http://a", b"payload", hashlib.sha1(b"payload").digest(), None)
    assert [r["id"] for r in warc.records(io.BytesIO(one + one))] == ["1", "1"]
    plain = zlib.decompress(one, 31)
    for bad in (one[:-9], one + b"x", zlib.compress(plain.replace(b"payload\r", b"pAyload\r"), wbits=31), zlib.compress(plain + b"y", wbits=31)):
        with pytest.raises((warc.DamagedArchive, zlib.error)):
            list(warc.records(io.BytesIO(bad)))


def texts():
    rng = random.Random(6)
    alphabet = [chr(rng.randrange(1, 0x3000)) for _ in range(300)] + [chr(x) for x in range(1, 256)] + [
        "ß", "İ", "ΑΣ", "'s", "'LL", "<|startoftext|>", "<|endoftext|>", "<|", " ", "\n", "\x1c", "漢字", "한글", "̀", "hello", "The", "!!!"]
    return ["", "a" * 3000, "ab " * 2000] + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(800)]


def test_bpe_equals_the_library(spark):
    own = texts()
    t = tokenizers.Tokenizer.from_file(vocabulary())
    df = spark.createDataFrame([(k, x) for k, x in enumerate(own)] + [(-1, None)], "doc_id long, text string").repartition(3)
    ids = {r.doc_id: r.ids for r in bpe.encode(df, vocabulary()).collect()}
    v = bpe.Vocabulary(vocabulary())
    assert ids[-1] == []
    for k, (x, e) in enumerate(zip(own, t.encode_batch(own, add_special_tokens=False))):
        assert ids[k] == e.ids, x
        assert bpe.decode(ids[k], v) == t.decode(e.ids, skip_special_tokens=False)
    got = {r.doc_id: r for r in bpe.digests(bpe.encode(df, vocabulary()), vocabulary()).collect()}
    import numpy as np
    assert {r.doc_id: r for r in bpe.round_trip(df, vocabulary()).collect()} == got
    for k in ids:
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids[k], "<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(bpe.decode(ids[k], v).encode()).hexdigest() and got[k].n_tokens == len(ids[k])


def test_bpe_cache_limit_changes_nothing(monkeypatch):
    own = texts()[:200]
    v, c = bpe.coder(vocabulary())
    whole = c.encode(own)[0].tolist()
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    fresh = bpe.WordCoder(v.special, lambda words: bpe.merge_words(v, words))
    assert [k for x in own for k in fresh.encode([x])[0].tolist()] == whole


def test_range_coder_round_trip(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, np.int64), np.array([65535]), rng.integers(0, 1 << 16, 5000), np.tile(rng.integers(0, 300, 40), 90)):
        tree = token_files.Tree.of(ids)
        coded = token_files.encode_blocks(ids, tree)
        assert (token_files.decode_blocks(coded, len(ids), token_files.Tree.read(tree.table())) == ids).all()
    monkeypatch.setattr(token_files, "LANES", 3)
    monkeypatch.setattr(token_files, "BLOCK", 64)
    ids = rng.integers(0, 500, 1000)
    data = token_files.frame([4, None], [600, 400], ids)
    (docs, counts, back), = token_files.read_frames(io.BytesIO(data))
    assert docs == [4, None] and counts.tolist() == [600, 400] and (back == ids).all()
    for bad in (data[:-1], data[:30] + bytes([data[30] ^ 1]) + data[31:], data[:-5] + bytes([data[-5] ^ 64]) + data[-4:]):
        with pytest.raises((token_files.DamagedArchive, AssertionError)):
            (_, _, again), = token_files.read_frames(io.BytesIO(bad))
            assert (again == ids).all() is False


def test_token_files(spark):
    import numpy as np
    own = texts()[:120]
    rows = [(k * 7 % 121, x, "t") for k, x in enumerate(own)] + [(200, None, "t"), (None, "null id", "t"), (200, "again", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(4)
    t = tokenizers.Tokenizer.from_file(vocabulary())
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.round_trip(df, vocabulary()).collect())
    assert [d for _, d, _, _ in got] == sorted((d for d, _, _ in rows), key=lambda d: (d is not None, d))
    start, by = 0, {}
    for d, x, _ in rows:
        e = np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")
        by.setdefault(d, set()).add((len(e), zlib.crc32(e.tobytes())))
    for s, d, n, crc in got:
        assert s == start and (n, crc) in by[d]
        start += n
    assert token_files.round_trip(df.limit(0), vocabulary()).count() == 0


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(8)
    parts = {"en": ["the", "tion", "ing", "wh", "ly"], "de": ["sch", "ung", "ein", "ß", "ö"], "fr": ["eau", "é", "oi", "qu", "tre"]}
    rows = [(k, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(5, 60))), lang, "x")
            for k in range(600) for lang in [rng.choice(list(parts))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(4)


def test_language_held_out_accuracy(spark, spoken):
    model = langid.fit(spoken)
    assert model.langs == ["de", "en", "fr"]
    out, (pred, score, rejected) = langid.predict(spoken, model)
    rows = out.withColumn("h", langid.held_out(F.col("doc_id"))).where("h").collect()
    assert len(rows) > 100 and sum(r[pred] == r.lang for r in rows) >= 0.95 * len(rows)
    assert score != "score" and all(0 <= r[score] <= 1 for r in rows) and not any(r[rejected] for r in rows)
    odd = spark.createDataFrame([(1, None, None), (2, "", None), (3, "123 ...", "en"), (None, "the tion ing" * 9000, "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score > 0, r.rejected) for r in langid.predict(odd, model)[0].collect()}
    assert got[1] == got[2] == got[3] == ("und", False, True) and got[None] == ("en", True, False)
    kept = langid.keep_known(spoken)
    assert kept.columns == spoken.columns and kept.count() == 600


@pytest.mark.parametrize("known", [["en"], ["en", "fr"]])
def test_unlearned_language_is_rejected(spark, spoken, known):
    model = langid.fit(spoken.where(F.col("lang").isin(known)))
    assert model.langs == known
    junk = spark.createDataFrame([(-k, "xqz kjhg vbn zzk wpq " * k, "junk", "x") for k in range(1, 9)], spoken.schema)
    out, (_, _, rejected) = langid.predict(spoken.unionByName(junk), model)
    rows = out.collect()
    clean, other = [[r[rejected] for r in rows if (r.lang in known) == x] for x in (True, False)]
    assert not any(clean) and sum(other) >= 0.98 * len(other) and all(r[rejected] for r in rows if r.lang == "junk")


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.fit(df) is None and langid.keep_known(df).count() == 0 and langid.keep_known(df.limit(0)).count() == 0


def test_url_rules(spark):
    rng = random.Random(9)
    urls = [f"http://{rng.choice(['a', 'b'])}.example.net/{rng.choice(['en', 'de'])}/{k}?q={rng.choice('xyz')}" for k in range(400)]
    bad = ["q=x" in u and "/de/" in u for u in urls]
    seen = spark.createDataFrame(list(zip(urls, bad)), "url string, bad boolean")
    index = url_rules.mine(seen, min_count=5)
    best = {frozenset(r.antecedent) for r in index.collect()}
    assert frozenset({"p:de", "q:q=x"}) in best
    own = {u: set(url_rules_tokens(spark, u)) for u in urls[:40]}
    for r in index.collect():  # support and confidence by counting
        rows = [b for u, b in zip(urls[:40], bad) if set(r.antecedent) <= own[u]]
        assert not rows or sum(rows) / len(rows) > 0.5
    pages = [(k, u, "x") for k, u in enumerate(urls)] + [(-1, None, "x"), (-2, "none", "x"), (-3, "HTTP://Sub.Example.NET/en/a", "x"),
             (-4, "x://net", "x"), (-5, "x://a.net/", "x"), (-6, "s://fr.org/fr/?a#b", "x"), (-7, "s://example.com/de/1", "x"), (-7, "s://example.com/de/1", "x")]
    got = url_rules.judge(spark.createDataFrame(pages, "page_id long, url string, host string"), seen, min_count=5)
    rows = {r.page_id: r for r in got.collect()}
    assert got.count() == len(pages)
    assert [(rows[k].host, rows[k].path, rows[k].rule, rows[k].verdict) for k in range(-7, 0)] == [
        ("example.com", "/de/1", "example.com/de/", "block"), ("fr.org", "/fr/", "org/fr/", "allow"), ("a.net", "/", "net/", "block"),
        ("net", "", None, "allow"), ("sub.example.net", "/en/a", "example.net/en/", "allow"), ("", "", None, "allow"), ("", "", None, "allow")]
    for k, (u, b) in enumerate(zip(urls, bad)):
        assert rows[k].mined == b and rows[k].verdict == ("allow" if "/en/" in u else "block")
    assert url_rules.mine(seen.limit(0)) is None


def test_url_rules_of_rare_bad_hosts(spark):
    few = [(f"http://bad.example.com/x/{k}", True) for k in range(25)] + [(f"http://mix.example.com/{p}/{k}?q={q}", p == "s" and q == 1)
                                                                          for k in range(30) for p in "st" for q in (1, 2)]
    for n in (100, 20000):
        seen = spark.createDataFrame([(f"http://h{k % 97}.example.com/y/{k}", k % 500 == 0) for k in range(n)] + few, "url string, bad boolean")
        index = url_rules.mine(seen).collect()
        every = {u: set(url_rules_tokens(spark, u)) for u, _ in few}
        best = {frozenset(r.antecedent): r for r in index}
        assert frozenset({"h:bad.example.com"}) in best and frozenset({"p:s", "q:q=1"}) in best
        for r in index:  # rules that good URLs share are counted over all labelled rows
            own = [b for u, b in few if set(r.antecedent) <= every[u]]
            assert r.confidence == 1 and all(own) and round(r.support * (n + len(few))) == len(own) >= 20 and r.anchor in r.antecedent
        pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(few)], "page_id long, url string")
        assert {r.page_id: r.mined for r in url_rules.judge(pages, seen).collect()} == {k: b for k, (_, b) in enumerate(few)}
    assert url_rules.mine(seen.where("url LIKE '%bad.%'").limit(19)) is None


def url_rules_tokens(spark, url):
    return spark.range(1).select(url_rules.tokens(F.lit(url)).alias("t")).first().t


def test_blocks_of_unmatched_tags_take_linear_time():
    import time
    from folio.llm import html_main
    n = 100_000
    for page in ("<p>text" + "<span>" * n + "</b>" * n, "<div>" * n + "text" + "</ul>" * n, "<p>text" + "<i>" * n + "<hr>" * n,
                 "<a>" * n + "text" + "</a>" * n):
        begin = time.time()
        assert [b[0] for b in html_main.blocks(page)] == ["text"]
        assert time.time() - begin < 20


def rules_brute(rows, have, min_count, min_confidence):
    """All token sets with the support and confidence; URLs fit a rule if they hold one."""
    every = sorted({t for u, _ in rows for t in have[u]})
    out = []
    for mask in range(1, 1 << len(every)):
        ante = {t for i, t in enumerate(every) if mask >> i & 1}
        hit = [b for u, b in rows if ante <= have[u]]
        if sum(hit) >= min_count and sum(hit) / len(hit) >= min_confidence:
            out.append(ante)
    return out


def test_url_rules_against_enumeration(spark):
    rng = random.Random(4)
    for _ in range(3):
        urls = [f"http://{rng.choice('ab')}/{rng.choice(['x', 'x/y', 'z'])}" + rng.choice(["", "?m=1&n=2", "?m=1", "?n=2&m=1"]) for _ in range(60)]
        rows = [(u, rng.random() < (0.9 if "/x" in u and "m=1" in u else 0.2)) for u in urls]
        seen = spark.createDataFrame(rows, "url string, bad boolean")
        new = sorted({f"http://{h}/{p}{q}" for h in "abc" for p in ("x", "x/y", "z", "y") for q in ("", "?m=1", "?n=2", "?m=1&n=2", "?m=2")})
        have = {r.u: set(r.t) for r in spark.createDataFrame([(u,) for u in {*urls, *new}], "u string").select(
            "u", url_rules.tokens(F.col("u")).alias("t")).collect()}
        rules = rules_brute(rows, have, 4, 0.75)
        index = url_rules.mine(seen, min_count=4, min_confidence=0.75)
        hits = {r.u for r in url_rules.mined_hits(spark.createDataFrame([(u,) for u in have], "url string"), index).collect()}
        assert hits == {u for u in have if any(r <= have[u] for r in rules)} and 0 < len(hits) < len(have)


def test_url_rules_of_many_parameters(spark):
    import time
    query = "&".join(f"k{i}=v{i}" for i in range(12))
    rows = [(f"http://a.example/{'bad' if k < 30 else 'good'}/{k}?{query}", k < 30) for k in range(60)]
    rows += [(f"http://a.example/bad/p{k}", False) for k in range(60)]
    begin = time.time()
    index = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert time.time() - begin < 60
    best = sorted((sorted(map(len, r.any_of)), r.confidence) for r in index)  # with and without what every URL has
    assert best == [([1, 3, 24], 1.0), ([1, 24], 1.0)]


def test_token_files_are_below_the_entropy_of_counts():
    import io

    import numpy as np
    rng = np.random.default_rng(2)
    ids = np.zeros(60_000, np.int64)
    follow = rng.integers(0, 3000, (3000, 4))
    for k in range(1, len(ids)):  # an id is one of four after its predecessor, mostly
        ids[k] = follow[ids[k - 1], rng.integers(4)] if rng.random() < 0.8 else rng.zipf(1.4) % 3000
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    data = token_files.frame([1], [len(ids)], ids)
    assert 8 * len(data) / len(ids) < -(share * np.log2(share)).sum()
    (_, _, back), = token_files.read_frames(io.BytesIO(data))
    assert (back == ids).all()


def test_token_files_are_coded_in_microseconds():
    import time

    import numpy as np
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.3, 600_000) % 3000
    for k in (1, 2, 5):  # some ids follow their predecessors
        ids[k::7] = (ids[k - 1:-1:7] * 37 + k)[:len(ids[k::7])] % 3000
    begin = time.process_time()
    data = token_files.frame([1], [len(ids)], ids)
    (_, _, back), = token_files.read_frames(io.BytesIO(data))
    assert (back == ids).all() and time.process_time() - begin < 8e-6 * len(ids)
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    assert 8 * len(data) / len(ids) < -(share * np.log2(share)).sum()


def test_words_go_to_the_library_together():
    t = tokenizers.Tokenizer.from_file(vocabulary())
    own = ["a<|endoftext|>b  c", "<|startoftext|>", "", " \t\n", "x\x1cy\x85z\xa0w", "Ünïcode Straße eé ＡＢ 12 don't '</w></w> </w>", "漢字 が a", "a b\x0bc\x0cd\re"] * 3
    coder = token_files.library_coder(vocabulary())
    ids, offsets = coder.encode(own)
    assert [ids[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:])] == [t.encode(x, add_special_tokens=False).ids for x in own]
