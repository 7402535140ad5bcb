"""Operators on pages: archives, main text, URL filter."""
import base64
import hashlib
import html
import re
import struct
import timeit
import tracemalloc

import pytest
import zstandard

from featurejudge import session
from featurejudge.llm import extraction, queries, url_filter, warc
from featurejudge.llm.common import load

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return load(spark, SF, "pages").toPandas()


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_round_trip(spark, pages):
    got = queries.QUERIES["op1_warc"](spark, SF).toPandas().set_index("page_id")
    assert len(got) == len(pages)
    for r in pages.itertuples():
        data = r.html.encode()
        assert (got.payload_bytes[r.page_id], got.payload_digest[r.page_id]) == (len(data), sha(data))


def test_revisits_and_odd_pages(spark, tmp_path):
    rows = [(3, "http://a/\r\nx", "same"), (1, None, "same"), (2, "u", "same"), (5, "u", None), (4, "u", ""), (6, "u", "é" * 100_000),
            (None, "u", "same"), (7, "u", "P*M\x18\x00\x00\x00\x00 inside\r\n\r\n"), (7, "u", "P*M\x18\x00\x00\x00\x00 inside\r\n\r\n")]
    table = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, refers_to long, digest string")
    got = {}
    for r in warc.round_trip(table).collect():
        got.setdefault(r["page_id"], []).append((r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]))
    assert got[1] == [("response", None, 4, sha(b"same"))]
    assert got[2] == got[3] == got[None] == [("revisit", 1, 4, sha(b"same"))]
    assert got[4] == [("response", None, 0, sha(b""))] and got[5] == [("revisit", 4, 0, sha(b""))]
    assert got[6][0][2] == 200_000 and [x[0] for x in got[7]] == ["response"] * 2
    small = {r["page_id"]: r["record_type"] for r in warc.round_trip(table, min_bytes=5).collect()}
    assert small[2] == small[5] == "response"
    assert warc.round_trip(table.where("false")).count() == 0
    warc.write_archives(warc.plan_records(table), str(tmp_path / "w"))
    back = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert {bytes(r["payload"]) for r in back if r["payload"] is not None} == {(h or "").encode() for _, _, h in rows}


def archive(records, compressed_dictionary=False):
    out = list(warc.frames(iter(records)))
    if compressed_dictionary:
        data = zstandard.compress(out[0][8:])
        out[0] = struct.pack("<II", warc.DICT_MAGIC, len(data)) + data
    return out


def test_archive_format_and_damage():
    records = [warc.record("response", k, f"http://h/{k}", (f"<p>page {k} " * 40).encode(), sha((f"<p>page {k} " * 40).encode()), None)
               for k in range(60)]
    for packed in (False, True):
        parts = archive(records, packed)
        assert len(parts) == 61 and struct.unpack("<I", parts[0][:4])[0] == warc.DICT_MAGIC
        data = b"".join(parts)
        got = list(warc.read_archive(data))
        assert [r["page_id"] for r in got] == list(range(60)) and not any(r["error"] for r in got)
    with pytest.raises(zstandard.ZstdError):                   # the dictionary is needed
        zstandard.ZstdDecompressor().decompress(parts[1])
    cut = list(warc.read_archive(data[:-5]))
    assert cut[-1]["error"].startswith("frame") and len(cut) == 60
    plain = zstandard.ZstdCompressor()
    for bad, why in ((records[0][:-2], "content-length"), (records[0].replace(b"WARC/1.1", b"WARC/9"), "version"),
                     (records[0].replace(b"WARC-Date", b"X-Date"), "warc-date"), (records[0].replace(b"page 0", b"page 9", 1), "digest"),
                     (b"junk", "headers"), (records[0].replace(b"Content-Length: ", b"Content-Length: x"), "content-length")):
        mixed = list(warc.read_archive(plain.compress(bad) + plain.compress(records[1])))
        assert why in mixed[0]["error"] and mixed[1]["error"] is None
    assert list(warc.read_archive(b"")) == [] and "frame" in list(warc.read_archive(b"abc"))[0]["error"]


def test_reading_is_linear():
    def seconds(n):
        data = b"".join(warc.frames(warc.record("response", k, "http://h/", b"<p>%d " % k * 60, sha(b"<p>%d " % k * 60), None) for k in range(n)))
        best = min(timeit.repeat(lambda: sum(r["error"] is None for r in warc.read_archive(data)), number=1, repeat=3))
        assert sum(r["error"] is None for r in warc.read_archive(data)) == n
        return best
    small, large = seconds(4_000), seconds(16_000)
    assert large < 6 * small


def test_over_long_records_are_reported_not_held():
    good = warc.record("response", 1, "u", b"x", sha(b"x"), None)
    bomb = zstandard.ZstdCompressor().compressobj()                     # no content size in the header
    bomb = b"".join(bomb.compress(b"\0" * (1 << 20)) for _ in range(64)) + bomb.flush()
    known = zstandard.ZstdCompressor(write_content_size=True).compress(b"\0" * (2 << 20))
    data = zstandard.compress(good) + bomb + known + zstandard.compress(good)
    tracemalloc.start()
    got = list(warc.read_archive(data, max_record=1 << 20))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["error"] and "longer than 1048576" in r["error"] for r in got] == [None, True, True, None]
    assert peak < 16 << 20
    assert [r["offset"] for r in got] == [0, len(zstandard.compress(good)), len(data) - len(zstandard.compress(good)) - len(known),
                                         len(data) - len(zstandard.compress(good))]
    for cut in range(1, 40):                                            # cut anywhere: an error, never a crash
        assert list(warc.read_archive(data[:-cut], max_record=1 << 20))[-1]["error"].startswith("frame")


def test_archives_roll_and_go_with_the_scratch_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROLL_BYTES", 20_000)
    rows = [(k, f"http://h/{k}", hashlib.sha256(b"%d" % k).hexdigest() * 40) for k in range(1_000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.plan_records(table), str(tmp_path / "w"))
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert len(files) > 1 and all(f.read_bytes()[:4] == struct.pack("<I", warc.DICT_MAGIC) for f in files[:-1])
    back = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in back) == sorted((k, h) for k, _, h in rows)
    root = tmp_path.as_uri()
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda _: root)
    with session.scratch_tables(spark):
        assert warc.round_trip(table).count() == 1_000
        assert len(list((tmp_path / "warc").iterdir())) == 1
    assert not list((tmp_path / "warc").iterdir()) and not list((tmp_path / "tables").iterdir())



def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?p>|</?h1>|<br>", inner)]
    return "\n".join(x for x in blocks if x)


def test_main_text_of_given_pages(spark, pages):
    got = queries.QUERIES["op4_extraction"](spark, SF).toPandas().set_index("page_id")
    for r in pages.itertuples():
        assert got.text[r.page_id] == article(r.html) and got.n_chars[r.page_id] == len(got.text[r.page_id])


PAGE = """<!DOCTYPE html><HTML><head><title>Site title here</title><style>p{}</style><script>var a="</p><p>fake words here";</script></head>
<body class=page><header><a href=/>Home of all things</a></header><nav><ul><li>One<li>Two</ul></nav>
<div class="cookie-notice">We use cookies on this page, accept them all</div>
<div id=main><h1>Great &amp; small &lt;b&gt;</h1><p>First <b>bold</b>   words
of&nbsp;text that go on<p>Second block of words is unclosed <a href="x>y">with link</a>
<div class="ad">Buy this now, best price of all</div><ul><li>item one here</li><li>item two here</li></ul>
<form><label>Name</label><button>Send it now</button></form><p>Last words of the article text</p></div>
<div class="comments"><p>Reader says a lot of things here</p></div><aside>Related stories and more</aside>
<footer>&copy; 2024 by someone</footer></body>"""
TEXT = ("Great & small <b>\nFirst bold words of text that go on\nSecond block of words is unclosed with link\nitem one here\n"
        "item two here\nLast words of the article text")


def test_main_text_without_labels():
    assert extraction.extract(PAGE, {}) == TEXT
    for page in (None, "", "   ", "<p>", "<!-- never closed", "<script>only script", "<div class=ad>x</div>"):
        assert extraction.extract(page, {}) == ""
    assert extraction.extract("just words < and > signs", {}) == "just words < and > signs"
    assert extraction.best_region([-1, 2, -1, 2, -5, 3]) == (1, 4) and extraction.best_region([]) == (0, 0)
    long = "<p>" + "word " * 100_000
    assert extraction.extract(long, {}) == " ".join(["word"] * 100_000)


WORDS = "words of the article that go on for a while and then some more"


@pytest.mark.parametrize("attrs", ['class="a b c d e f sidebar"', 'class="col flex grid m-2 p-4 left-sidebar w-1"', 'id=main-nav class="z y x w v u"',
                                   'class="' + " ".join(f"u-{k}" for k in range(200)) + ' comments"', "class=form", 'role="search"'])
def test_boilerplate_by_any_of_its_words(attrs):
    page = f"<body><article><p>{WORDS}</p><div {attrs}><p>not this</p></div><p>{WORDS}</p></article><div {attrs}>nor this</div></body>"
    assert extraction.extract(page, {}) == f"{WORDS}\n{WORDS}"


@pytest.mark.parametrize("attrs", ['class="more"', 'class="tag"', 'class="meta-text"', 'class="text-more"', 'class="hidden-x"', 'class="long-form"',
                                   'class="' + " ".join(f"u-{k}" for k in range(200)) + '"'])
@pytest.mark.parametrize("name", ["p", "div", "figcaption"])
def test_article_text_under_common_words_stays(name, attrs):
    page = f"<body><article><p>{WORDS}</p><{name} {attrs}>and this {WORDS}</{name}><p>{WORDS}</p></article></body>"
    assert extraction.extract(page, {}) == f"{WORDS}\nand this {WORDS}\n{WORDS}"


def test_open_elements_cost_nothing():
    def seconds(n, tail):
        page = "<p>" + "<b>word " * n + tail * n
        return min(timeit.repeat(lambda: extraction.extract(page, {}), number=1, repeat=2))
    for tail in ("", "</i>", "<p>", "</b>"):
        assert seconds(16_000, tail) < 8 * seconds(4_000, tail) + 0.05


def test_weights_do_not_depend_on_the_number_of_kinds(spark, pages, monkeypatch):
    table = load(spark, SF, "pages", "page_id", "url", "html")
    every = extraction.fit(table)
    monkeypatch.setattr(extraction, "MAX_KINDS", 4)
    some = extraction.fit(table)
    assert len(some) == 4 and all(every[k] == w for k, w in some.items())


def test_main_text_odd_rows(spark):
    rows = [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (None, None, None, "x", 1), (2, "u", "", "x", 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extraction.main_text(table).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, len(TEXT), len(TEXT)]
    assert extraction.main_text(table.where("false")).count() == 0


def rule_by_hand(host, path):
    fits = [r for _, r in url_filter.RULES for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits, key=len, default=None)


def split_by_hand(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), re.match(r"[^?#]*", rest[len(host):])[0]


URLS = ["http://WWW.Example.COM/en/1", "https://example.com/en/x?y", "https://a.example.com/en/", "http://x.net/es/1#f", "http://net/fr/",
        "http://evilnet/es/1", "http://a.com", "http://a.com?x=/en/", "no scheme", "", None, "http://", "x://y://z/com/", "http://a.org/é/Ü",
        "http://a.org/" + "p/" * 5000]


def test_hosts_paths_rules(spark, pages):
    urls = [*pages["url"], *URLS, *URLS]
    table = spark.createDataFrame([(k, u, "v", 0.0) for k, u in enumerate(urls)], "page_id long, url string, verdict string, score double")
    got = url_filter.judge(table).collect()
    assert len(got) == len(urls)
    verdicts = {r: v for v, r in url_filter.RULES}
    for r in got:
        host, path = split_by_hand(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule_by_hand(host, path))
        assert r["verdict"] == verdicts[r["rule"]] if r["rule"] else r["verdict"] in ("allow", "block")
    assert url_filter.judge(table.where("false")).count() == 0
    alone = url_filter.judge(table.where("url IS NULL")).collect()
    assert {r["verdict"] for r in alone} == {"allow"}


def test_language_model_by_hand(spark):
    """Interpolated probabilities against a plain Python model."""
    import collections
    import math
    learn = {"allow": ["aab", "aac"], "block": ["abb"]}
    order = 2
    rows, counts = [], {x: collections.Counter() for x in learn}
    for side, texts in learn.items():
        for t in texts:
            t = "^" * order + t + "$"
            for i in range(order, len(t)):
                for k in range(order + 1):
                    counts[side][t[i - k:i + 1]] += 1
                rows.append((t[i - order:i + 1], int(side == "allow"), int(side == "block")))
    table = spark.createDataFrame(rows, "gram string, allow long, block long").groupBy("gram").sum("allow", "block").toDF("gram", "allow", "block")

    def p(side, gram):
        if not gram:
            return 1 / url_filter.ALPHABET
        same = {g: n for g, n in counts[side].items() if len(g) == len(gram) and g[:-1] == gram[:-1]}
        mass = sum(same.values()) + len(same)
        return (same.get(gram, 0) + len(same) * p(side, gram[1:])) / mass if mass else p(side, gram[1:])
    for r in url_filter.probabilities(table, order).collect():
        assert r["diff"] == pytest.approx(math.log(p("allow", r["gram"])) - math.log(p("block", r["gram"])))
