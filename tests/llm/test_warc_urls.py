import base64
import hashlib
import random

from pyspark.sql import functions as F

from tanimart.llm import url_filter, warc
from tanimart.llm.common import fresh_path
from tanimart.llm.queries import URL_RULES, op1_warc_index, op10_url_equivalence

SF = "/root/testdata/sf0.001"
PAGES = [
    (1, "http://www.example.org/a?x=1#f", "<p>one</p>"), (2, "https://Example.org:443/a", "<p>one</p>"), (3, None, None), (4, "", ""), (5, "no scheme", "été"),
    (6, "http://b.org", "<p>one</p>"), (6, "http://b.org", "<p>one</p>"), (None, "http://n.org/", "<p>one</p>"), (None, "http://n.org/", "only"), (7, "http://l.org/", "y" * 300_000),
    (8, "http://b.org", "z\r\n\r\nz"),
]


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def _pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("key", F.lit("clash")).withColumn("first", F.lit(1)).withColumn("sha", F.lit(2))


def test_keys_reverse_hosts():
    assert warc.reversed_host_key("http://www.Example.org:80/a?b#c") == "org,example,www)/a?b"
    assert warc.reversed_host_key("https://x.org:8080") == "org,x:8080)/"
    assert warc.reversed_host_key(None) == warc.reversed_host_key("") == ")"
    assert warc.reversed_host_key("plain") == ")plain"


def test_round_trip_through_archives_and_index(llm, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    pages, root = _pages(llm), fresh_path(llm, "warc-test")
    index = warc.build_index(warc.write_archives(pages, root), root)
    keys = llm.createDataFrame([(warc.reversed_host_key(u),) for _, u, _ in PAGES] + [("zz)absent",), (None,)], "key string")
    rows = warc.fetch(warc.lookup(keys, index, root), root).collect()
    want = []
    for i, u, h in PAGES:
        kind = ("revisit", 1) if h == "<p>one</p>" and i != 1 else ("revisit", 3) if i == 4 else ("response", None)
        want.append((i, u, len((h or "").encode()), _digest(h), *kind, (h or "").encode() if kind[1] is None else None))
    order = lambda x: tuple((v is None, v) if not isinstance(v, tuple) else v for v in x[:6])
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str), order
    one = llm.createDataFrame([("org,b)/",)], "key string")
    assert sorted(r.page_id for r in warc.lookup(one, index, root).collect()) == [6, 6, 8]


def test_small_payloads_are_responses(llm):
    pages, root = _pages(llm), fresh_path(llm, "warc-test")
    captures = warc.write_archives(pages, root, min_bytes=1000)
    assert {r.record_type for r in warc.fetch(captures, root).collect()} == {"response"}


def test_empty_table(llm):
    root = fresh_path(llm, "warc-test")
    none = _pages(llm).where("1 = 0")
    captures = warc.write_archives(none, root)
    index = warc.build_index(captures, root)
    keys = llm.createDataFrame([("x",)], "key string")
    assert warc.fetch(warc.lookup(keys, index, root), root).count() == 0


def test_query_returns_every_page(llm):
    pages = {r.page_id: r.html for r in llm.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op1_warc_index(llm, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i] or "", i)
    for r in rows:
        html = pages[r.page_id] or ""
        own = first[html]
        assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), _digest(html))
        assert (r.record_type, r.refers_to) == (("response", None) if own == r.page_id else ("revisit", own))


def _judge(spark, rows, rules, **more):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("component", F.lit("clash"))
    return {r.page_id: r for r in url_filter.judge(df, rules, **more).collect()}


def test_rules(llm):
    urls = ["http://Sub.Example.ORG/es/1", "http://example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/", "http://a.com/fr/x", "http://a.com/de/", "http://a.com/en/",
            "http://a.org", "http://a.org?x", None, "", "a.org/es/", "x://h#f/", "http://org/es/"]
    got = _judge(llm, [(i, u, None) for i, u in enumerate(urls)], URL_RULES)
    assert [got[i].rule for i in range(len(urls))] == ["example.org/es/", "example.org/en/1", "org/", "org/", "com/fr/", "com/de/", None, None, None, None, None, None, None, "org/"]
    assert [got[i].verdict for i in range(6)] == ["block", "block", "allow", "allow", "allow", "block"]
    assert (got[0].host, got[0].path, got[8].host, got[8].path, got[12].host, got[12].path) == ("sub.example.org", "/es/1", "a.org", "", "h", "")
    assert (got[9].host, got[9].path, got[9].verdict, got[11].host) == ("", "", "allow", "")


def test_rule_table_decides_as_the_list(llm, monkeypatch):
    """Many rules of one host, odd hosts, ties, repeated and null rules."""
    rng = random.Random(4)
    label = lambda: rng.choice(["a", "b", "com", "org", "", "é"])
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "".join(rng.choice("ab/é") for _ in range(rng.randrange(6)))
    rules = [(host(), rng.choice(["", path()]), rng.choice(["allow", "block"])) for _ in range(150)]
    rules += [("com", path(), "block") for _ in range(150)] + [("a.com", "/a", v) for v in ("block", "allow")] + rules[:9]
    rows = [(i, f"http://{host()}{path()}", None) for i in range(600)] + [(900, None, None), (901, "odd", None), (902, "http://", None)] * 2
    plain = lambda got: {i: (r.rule, r.verdict) for i, r in got.items()}
    want = plain(_judge(llm, rows, rules))
    assert len({rule for rule, _ in want.values()}) > 40
    table = llm.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    assert plain(_judge(llm, rows, table.withColumn("h", F.lit("clash")))) == want
    assert plain(_judge(llm, rows, table.where("1 = 0"))) == {i: (None, "allow") for i in want}
    assert _judge(llm, [], table) == {}
    monkeypatch.setattr(url_filter, "LITERAL_RULES", 3)
    assert plain(_judge(llm, rows, rules)) == want


def test_decisions_spread_over_redirects_and_canonical_links(llm):
    page = lambda to: f'<html><link rel="canonical" href="{to}"></html>'
    rows = [(1, "http://a.net/1", page("http://a.com/de/1")), (2, "http://a.com/de/1", None), (3, "http://b.net/1", '<meta http-equiv="refresh" content="0; url=http://a.net/1">'),
            (4, "http://c.net/", page("http://x.com/de/2")), (5, "http://c.net/#top", page("http://x.com/fr/2")), (6, "http://d.net/", None), (7, "http://x.com/de/2", None),
            (8, "https://www.a.net/1/?utm_source=q", None), (9, "http://x.com/fr/2", None), (10, "http://far.net/", None)]
    chain = llm.createDataFrame([("http://far.net/", "http://s1.net/"), ("http://s1.net/", "http://s2.net/"), ("http://s2.net/", "http://a.com/de/1"), (None, "http://q.net/")], "src string, dst string")
    got = {i: r.verdict for i, r in _judge(llm, rows, URL_RULES, redirects=chain).items()}
    # 4 and 5 are tied to an allowed and a blocked address: allow goes first; 7 keeps its own rule
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "block"}


def test_every_form_of_link_is_an_edge(llm):
    link, meta = '<link rel="canonical" href="%s">', '<meta http-equiv="refresh" content="%s">'
    base, forms = "http://h.net/d/e/p.html?q=1#f", [
        (link % "/de/1", "h.net/de/1"), (link % "//host.org/x", "host.org/x"), (link % "x.html", "h.net/d/e/x.html"), (link % "./x.html", "h.net/d/e/x.html"), (link % "../x/../y", "h.net/d/y"),
        (link % "../../../z", "h.net/z"), (link % "?a=2&amp;b=3", "h.net/d/e/p.html?a=2&b=3"), (link % "http://o.org/a?x=1&#38;y=2", "o.org/a?x=1&y=2"), (link % "http://o.org/&#xe9;&eacute;&amp;lt;&z", "o.org/éé&lt;&z"),
        ("<LINK HREF='/u' REL='alternate Canonical'/>", "h.net/u"), ("<link href=/u rel=canonical>", "h.net/u"), (link % " http://o.org/s ", "o.org/s"),
        (meta % "0; url=/r", "h.net/r"), ('<meta content="5;URL=next.html" http-equiv="Refresh">', "h.net/d/e/next.html"), (meta % "0;url='http://o.org/?a&amp;b'", "o.org?a&b"), (meta % "3, http://o.org/t", "o.org/t"),
        ("<meta content=0;url=//o.org/v http-equiv=refresh>", "o.org/v"), (meta % "0; url=http://o.org/w>", "o.org/w"),
        (link % "", None), (link % "#top", None), (link % "mailto:a@b.c", None), (link % "javascript:x()", None), (meta % "30", None), (meta % "0; url=", None), ('<link rel="stylesheet" href="/canonical.css">', None)]
    rows = [(i, base.replace("h.net", f"h{i}.net"), html) for i, (html, _) in enumerate(forms)]
    df = llm.createDataFrame([*rows, (90, None, link % "/a"), (91, "odd", link % "/a")], "page_id long, url string, html string")
    want = {(f"h{i}.net/d/e/p.html?q=1", to.replace("h.net", f"h{i}.net")) for i, (_, to) in enumerate(forms) if to}
    assert {(r.a, r.b) for r in url_filter.link_edges(df).collect()} == want
    rows = [(1, "http://a.net/x/1", link % "/de/1?a=1&amp;b=2"), (2, "https://a.net/de/1?b=2&a=1", None), (3, "http://c.net/", None), (4, "http://c.net/old", None)]
    moved = llm.createDataFrame([("http://c.net/old", "/")], "src string, dst string")
    got = _judge(llm, rows, [("a.net", "/de/", "block"), ("c.net", "/old", "block")], redirects=moved)
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block"}


def test_urls_empty_and_repeated(llm):
    assert _judge(llm, [], URL_RULES) == {}
    df = llm.createDataFrame([(1, "http://a.org/", None), (1, "http://a.org/", None), (None, None, None)], "page_id long, url string, html string")
    assert url_filter.judge(df, URL_RULES).count() == 3
    assert op10_url_equivalence(llm, SF).count() == llm.read.parquet(f"{SF}/pages.parquet").count()
