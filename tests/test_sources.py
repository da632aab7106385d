"""Payload scans, mappings, paging and registries."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.values import NOW
from feedlake import schemas
from feedlake.operators import mapping, paging
from feedlake.plans import collect
from feedlake.sources import payloads, registry


def sha1(s):
    return hashlib.sha1(s.encode()).hexdigest()


SAMPLE = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>Sample</title>
<item><title> Banks Curb Bets </title><link>https://example.com/a</link>
<description><![CDATA[<p>short <b>summary</b></p>]]></description>
<content:encoded><![CDATA[<p>FULL body text here</p>]]></content:encoded>
<pubDate>Fri, 12 Jun 2026 06:41:00 GMT</pubDate></item>
<item><title>No Link Item</title><description>plain</description>
<guid isPermaLink="false">urn:1</guid></item>
<item><title>Only Title</title></item>
<item><description>orphan body, no identity</description></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><entry>
<title>E1</title><link rel="enclosure" href="https://e/x.mp3"/><link href="https://e/1"/>
<id>tag:1</id><updated>2026-06-12T06:41:00+09:00</updated><summary>sum</summary></entry></feed>"""
NOT_FEEDS = {
    "html": "<!DOCTYPE html><html><head><title>Just a moment...</title></head><body>x</body></html>",
    "xhtml": "<html><body>Access denied</body></html>",
    "empty": "", "broken": "<rss><channel><item><title>x</title>", "text": "rate limited",
    "missing": None,
}


@pytest.fixture
def scan(spark):
    def run(bodies, status=200):
        rows = [(k, NOW, i, status, None, None, v) for i, (k, v) in enumerate(bodies.items())]
        return payloads.scan_feeds(spark.createDataFrame(rows, schemas.FEED_PAYLOAD))

    return run


@pytest.fixture
def feeds(spark, tmp_path):
    def load(*rows):
        path = tmp_path / "feeds.yaml"
        path.write_text(json.dumps({"feeds": list(rows)}), encoding="utf-8")
        return registry.load_feeds(spark, path)

    return load


def feed(feed_id="f", **more):
    return {"feed_id": feed_id, "url": "u", "source": "S", **more}


def test_rss_to_articles(scan, feeds):
    rows = payloads.feed_rows(scan({"f": SAMPLE}))
    items = {r["title"]: r for r in mapping.map_feed_rows(
        rows, feeds(feed(source="Src", asset_hint="us"))).collect()}
    assert set(items) == {"Banks Curb Bets", "No Link Item", "Only Title"}
    first = items["Banks Curb Bets"]
    assert first["item_id"] == sha1("https://example.com/a")
    assert first["body"] == "short summary" and first["source"] == "Src"
    assert first["published_at"] == datetime(2026, 6, 12, 6, 41)
    assert items["No Link Item"]["item_id"] == sha1("urn:1")
    assert items["No Link Item"]["url"] == ""
    assert items["Only Title"]["item_id"] == sha1("Only Title")
    dropped = mapping.feed_rows_without_basis(rows).collect()
    assert [(r["feed_id"], r["dropped"]) for r in dropped] == [("f", 1)]


@pytest.mark.parametrize("mode, body", [
    ("headline", ""), ("summary", "short summary"), ("full", "FULL body text here")])
def test_body_modes(scan, feeds, mode, body):
    items = mapping.map_feed_rows(
        payloads.feed_rows(scan({"f": SAMPLE})), feeds(feed(body_mode=mode)))
    assert items.filter("row_pos = 0").head()["body"] == body


def test_atom_rdf_and_loose_markup(scan, feeds):
    rdf = ("<rdf:RDF><channel/><item><title>R &nbsp;&amp; D</title><link>https://e/r?a=1&b=2</link>"
           "<dc:date>2026-06-12T06:41:00Z</dc:date></item></rdf:RDF>")
    guid = "<rss><channel><item><title>G</title><guid>https://e/g</guid></item></channel></rss>"
    rows = payloads.feed_rows(scan({"a": ATOM, "r": rdf, "g": guid}))
    items = {r["feed_id"]: r for r in mapping.map_feed_rows(
        rows, feeds(feed("a"), feed("r"), feed("g"))).collect()}
    assert items["a"]["url"] == "https://e/1" and items["a"]["body"] == "sum"
    assert items["a"]["published_at"] == datetime(2026, 6, 11, 21, 41)
    assert items["r"]["url"] == "https://e/r?a=1&b=2"
    assert items["r"]["published_at"] == datetime(2026, 6, 12, 6, 41)
    assert items["g"]["url"] == "https://e/g"


def test_not_a_feed_is_a_failure_and_an_empty_feed_is_not(scan):
    empties = {"rss0": '<rss version="2.0"><channel><title>E</title></channel></rss>',
               "atom0": '<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title></feed>',
               "rss1": "<rss><channel></channel></rss>"}
    got = {r["feed_id"]: (r["is_feed"], r["n"]) for r in scan({**NOT_FEEDS, **empties, "s": SAMPLE})
           .select("feed_id", "is_feed", F.size("entries").alias("n")).collect()}
    assert {k: got[k] for k in NOT_FEEDS} == {k: (False, 0) for k in NOT_FEEDS}
    assert {k: got[k] for k in empties} == {k: (True, 0) for k in empties}
    assert got["s"] == (True, 4)


def test_failed_response_gives_no_rows(scan):
    assert payloads.feed_rows(scan({"f": SAMPLE}, status=503)).count() == 0


def test_each_body_is_parsed_once(scan):
    plan = payloads.feed_rows(scan({"f": SAMPLE}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 2  # first reading and the repaired one


def test_responses_of_a_busy_source_stay_where_they_are(spark, scan, feeds):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        articles, _ = collect.feed_pass(scan({"f": SAMPLE}), feeds(feed()))
        assert len(articles.collect()) == 3
        plan = articles._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_search_scan(spark):
    good = {"items": [
        {"title": "&quot;A&quot; <b>증시</b>의", "originallink": "https://businessplus.kr/1",
         "link": "https://n.naver.com/1", "description": "<b>S</b>&amp;P",
         "pubDate": "Sun, 19 Jul 2026 18:50:00 +0900"},
        {"title": "B", "originallink": "", "link": " https://n.news.naver.com/2 "},
        {"title": "<b></b>", "originallink": "", "link": ""}]}
    rows = [("증시", NOW, 0, 200, json.dumps(good)), ("none", NOW, 1, 200, '{"items": null}'),
            ("bad", NOW, 2, 200, "<html>"), ("down", NOW, 3, 500, json.dumps(good))]
    scanned = payloads.scan_search(spark.createDataFrame(rows, schemas.SEARCH_PAYLOAD))
    assert {r["q"]: r["is_feed"] for r in scanned.collect()} == {
        "증시": True, "none": True, "bad": False, "down": True}
    searches = spark.createDataFrame([("증시", "kr", 0), ("none", "", 1)], schemas.SEARCH_REGISTRY)
    got = mapping.map_search_rows(payloads.search_rows(scanned), searches).orderBy("row_pos").collect()
    assert [(r["url"], r["title"], r["source"]) for r in got] == [
        ("https://businessplus.kr/1", '"A" 증시의', "businessplus.kr"),
        ("https://n.news.naver.com/2", "B", "네이버")]
    assert got[0]["body"] == "S&P" and got[0]["feed_id"] == "naver:증시"
    assert got[0]["published_at"] == datetime(2026, 7, 19, 9, 50)
    assert (got[0]["language"], got[0]["symbol"], got[0]["asset_hint"]) == ("ko", "", "kr")


def test_firehose_scan(spark):
    standard = [
        {"symbol": None, "publishedDate": "2026-07-18 22:45:00", "publisher": "", "site": "cnbc.com",
         "title": " T ", "text": "<p>hi <b>there</b></p>", "url": "https://e/1"},
        {"symbol": " AAPL ", "title": "", "url": ""},
        {"symbol": " AAPL ", "title": "only title", "url": ""}]
    article = [{"title": "M", "date": "2026-01-15 22:45:00", "content": "<p>Citigroup cut META</p>",
                "tickers": "NASDAQ:META", "link": "https://e/m", "site": ""}]
    rows = [("stock-latest", 0, NOW, 0, 200, json.dumps(standard)),
            ("fmp-articles", 0, NOW, 1, 200, json.dumps(article)),
            ("stock-latest", 1, NOW, 2, 200, "[]"), ("forex-latest", 0, NOW, 3, 200, "{oops")]
    scanned = payloads.scan_firehose(spark.createDataFrame(rows, schemas.FIREHOSE_PAYLOAD))
    assert [(r["n_rows"], r["is_feed"]) for r in scanned.orderBy("seq").collect()] == [
        (3, True), (1, True), (0, True), (0, False)]
    endpoints = spark.createDataFrame(
        [("stock-latest", 0), ("fmp-articles", 1)], schemas.FIREHOSE_REGISTRY)
    got = mapping.map_firehose_rows(payloads.firehose_rows(scanned), endpoints).orderBy(
        "feed_pos", "row_pos").collect()
    assert [(r["title"], r["source"], r["symbol"], r["body"]) for r in got] == [
        ("T", "cnbc.com", "", "hi there"), ("only title", "FMP", "AAPL", ""),
        ("M", "Financial Modeling Prep", "META", "Citigroup cut META")]
    assert got[0]["published_at"] == datetime(2026, 7, 19, 2, 45)
    assert got[1]["item_id"] == sha1("only title")
    assert got[2]["url"] == "https://e/m" and got[2]["feed_id"] == "fmp:fmp-articles"


def test_page_verdict(spark):
    rows = [("full", 0, 250), ("full", 1, 250), ("full", 2, 250),
            ("short", 0, 250), ("short", 1, 3), ("short", 2, 250),
            ("gap", 0, 250), ("gap", 2, 250), ("late", 1, 250), ("none", 0, 0)]
    pages = spark.createDataFrame(rows, "endpoint string, page int, n_rows long")
    read = paging.accepted_pages(pages, ["endpoint"])
    got = {r["endpoint"]: (r["pages_read"], r["rows_read"], r["truncated"])
           for r in paging.page_totals(read, ["endpoint"], cap=2).collect()}
    assert got == {"full": (3, 750, True), "short": (2, 253, False), "gap": (1, 250, False),
                   "late": (0, 0, False), "none": (0, 0, False)}
    capped = paging.accepted_pages(pages, ["endpoint"], cap=2).filter("accepted")
    assert capped.filter("endpoint = 'full'").count() == 2


def test_truncation_note(spark):
    df = spark.createDataFrame(
        [("stock-latest", True), ("fmp-articles", True), ("stock-latest", False)],
        "endpoint string, truncated boolean")
    notes = [r[0] for r in df.select(paging.truncation_note("truncated", "endpoint")).collect()]
    assert notes == ["truncated at page cap", None, None]
    caps = df.select(paging.page_cap()).distinct().collect()
    assert sorted(r[0] for r in caps) == [2, 100]


@pytest.mark.parametrize("row", [
    feed(body_mod="full"), feed(tier="gold"), feed(body_mode="calendar"), {"feed_id": "x"}])
def test_bad_registry_rows(feeds, row):
    with pytest.raises(registry.RegistryError):
        feeds(row)


def test_registry(spark, feeds, tmp_path):
    with pytest.raises(registry.RegistryError, match=r"\['a', 'b'\]"):
        feeds(feed("b"), feed("a"), feed("b"), feed("a"), feed("c"))
    reg = feeds(feed("a", source="Z", tier="primary"), feed("b", source="A"),
                feed("c", source="Z", tz_offset=9))
    meta = registry.sources_meta(reg).head()
    assert meta["sources"] == ["Z", "A"] and meta["tiers"] == {"Z": "primary", "A": "wire"}
    assert reg.filter("feed_id = 'c'").head()["tz_offset"] == 9.0
    assert registry.source_drift(registry.distinct_sources(reg), reg).count() == 0
    selectors = spark.createDataFrame([("Z", ".a"), ("Q", ".b")], "source string, selector string")
    assert [r["source"] for r in registry.selector_drift(selectors, reg).collect()] == ["Q"]
    assert registry.missing_fields(reg, schemas.FEED_REGISTRY) == []
    assert "kind" in registry.missing_fields(reg, schemas.ITEM)


def test_other_registries(spark, tmp_path):
    path = tmp_path / "r.yaml"
    for body, load in (("queries: []", registry.load_searches), ("", registry.load_firehose)):
        path.write_text(body)
        with pytest.raises(registry.RegistryError):
            load(spark, path)
    path.write_text("queries: [{q: ' a '}, {q: ''}, {asset_hint: x}]")
    searches, settings = registry.load_searches(spark, path)
    assert settings == {"display": 100} and searches.count() == 3
    assert [r["q"] for r in registry.usable_searches(searches).collect()] == ["a"]
    path.write_text("endpoints: [a, b]\nblackout_start_hour: 7")
    endpoints, settings = registry.load_firehose(spark, path)
    assert endpoints.count() == 2
    assert settings == {"lookback_days": 3, "blackout_start_hour": 7, "blackout_end_hour": None}


def test_a_large_feed_file_is_read_in_parts(spark, tmp_path):
    entries = "".join(
        f"<item n='{n}'><title>T {n} &amp; co</title><link>https://e/{n}</link><description>{'x' * (n % 90)}\n</description></item>\n"
        for n in range(900))
    folder = tmp_path / "in" / "feed_id=f1"
    folder.mkdir(parents=True)
    (folder / "big.xml").write_text(
        "<?xml version='1.0'?><rss><channel><title>c</title><items/>" + entries
        + "<item><title>loose & nbsp&nbsp;</title></item><item><title>a<b></title></item></channel></rss>")
    (folder / "empty.xml").write_text("")
    (folder / "page.xml").write_text("<html><body>blocked</body></html>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = payloads.scan_feed_files(spark, str(tmp_path / "in"))
        assert rows.rdd.getNumPartitions() > 8
        got = rows.orderBy("row_pos").collect()
        assert payloads.scan_feed_files(spark, str(tmp_path / "in"), tag="entry").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["title"] for r in got[:900]] == [f"T {n} & co" for n in range(900)]
    assert {r["feed_id"] for r in got} == {"f1"} and len({r["row_pos"] for r in got}) == 902
    assert got[900]["title"] == "loose & nbsp&nbsp;" and got[901]["title"] is None  # broken, counted


def test_only_feed_files_with_an_end_tag_are_read_by_it(spark, tmp_path):
    texts = {"a b%25": "<rss><item><title>R</title></item><item><title>S</title></item></rss>",
             "7": "<feed>" + "<entry><title>A</title><summary>x</summary></entry>\n" * 2000 + "</feed>",
             "page": "<html>" + "<p>blocked &lt;/item&gt; <item>\n" * 2000}
    for feed, text in texts.items():
        folder = tmp_path / f"feed_id={feed}"
        folder.mkdir()
        (folder / "100% 1.xml").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        items, entries = (payloads.scan_feed_files(spark, str(tmp_path), tag=tag) for tag in ("item", "entry"))
        # a file without an end tag would be one record in memory, so it is not opened at all
        assert items.rdd.getNumPartitions() == 1 and entries.rdd.getNumPartitions() > 8
        assert sorted((r["feed_id"], r["title"]) for r in items.collect()) == [("a b%", "R"), ("a b%", "S")]
        assert [(r["feed_id"], r["title"]) for r in entries.collect()] == [("7", "A")] * 2000
        (tmp_path / "feed_id=7" / "100% 1.xml").unlink()
        none = payloads.scan_feed_files(spark, str(tmp_path), tag="entry")
        assert none.collect() == [] and none.columns == entries.columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
