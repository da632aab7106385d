"""Text, clock, kind and publisher expressions against hand-written vectors."""

import hashlib
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedlake.functions import classify, clock, text
from feedlake.functions.publisher import publisher
from feedlake.functions.selector import page_text, select_text
from feedlake.functions.text import BLANKS


def sha1(s):
    return hashlib.sha1(s.encode()).hexdigest()


def test_strip_takes_every_blank(column):
    assert set(BLANKS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    inputs = [f"{BLANKS}a b{BLANKS}", "", None, "\t\n"]
    assert column(inputs, text.strip) == ["a b", "", "", ""]


def test_collapse_equals_split_join(column):
    inputs = [f"a{BLANKS}b  c\td", "  x\n\ny z "]
    assert column(inputs, text.collapse) == [" ".join(s.split()) for s in inputs]


def test_clean_spaced(column):
    cases = {
        "<p>hi <b>there</b></p>": "hi there",
        "<p>Global banks are <b>curbing</b> leveraged bets.</p>":
            "Global banks are curbing leveraged bets.",
        "<script>var a='</p>';</script>k<!-- <b>no</b> -->l<style>p{}</style>": "k l",
        '<a title="x > y">z</a>': "z",
        "a < b &lt;i&gt; &amp;amp; &nbsp;&#8217;&#x1F600;&apos;": "a < b <i> &amp; ’😀'",
        "&bogus; &amp &#0; AT&T": "&bogus; &amp &#0; AT&T",
        "cut <b": "cut",
        "": "", None: "",
    }
    assert column(list(cases), text.clean_spaced) == list(cases.values())


def test_clean_tight_keeps_particles_attached(column):
    cases = {
        "&quot;오라클 강등&quot;, <b>증시</b> 경고": '"오라클 강등", 증시 경고',
        "뉴욕 <b>증시</b>의 S&amp;P500지수는": "뉴욕 증시의 S&P500지수는",
    }
    assert column(list(cases), text.clean_tight) == list(cases.values())


def test_hostile_markup_is_linear(column):
    page = "<a " + "x=" * 50_000 + " <b>" + "<" * 50_000 + "&#" * 20_000 + "<!--" * 20_000
    started = time.time()
    column([page], text.clean_spaced)
    assert time.time() - started < 20


def test_keys(spark):
    row = spark.range(1).select(
        text.content_key(F.lit(" https://e/a\n")).alias("key"),
        text.key_basis(F.lit(" "), F.lit("urn:news:abc-123"), F.lit("T")).alias("guid"),
        text.key_basis(F.lit(""), F.lit(None), F.lit(" T ")).alias("title"),
        text.key_basis(F.lit(""), F.lit(None), F.lit("\t")).alias("none"),
    ).head()
    assert row["key"] == sha1("https://e/a")
    assert (row["guid"], row["title"], row["none"]) == ("urn:news:abc-123", "T", None)


def test_small_text(column):
    tickers = ["NASDAQ:META", "NASDAQ:META,NYSE:GS", " AAPL , X", "", None]
    assert column(tickers, text.first_ticker) == ["META", "META", "AAPL", "", ""]
    assert column(["https://x/?key=SECRET-123&alt=json failed"], text.redact) == [
        "https://x/?key=[redacted]&alt=json failed"]
    assert column(["x" * 900], lambda c: text.embed_text(F.lit("T"), c)) == ["T " + "x" * 500]
    assert column(["한" * 600], lambda c: text.embed_text(F.lit(""), c)) == ["한" * 500]
    assert column(["boom", "e" * 300], lambda c: text.job_detail(F.lit(" rss=ok "), c)) == [
        "rss=ok | ERROR: boom", "rss=ok | ERROR: " + "e" * 280]
    assert column(["boom", ""], lambda c: text.job_detail(F.lit(""), c)) == [
        "ERROR: boom", "ERROR:"]
    titles = ["BitGo — files, for IPO!", "bitgo files for ipo", "…"]
    assert column(titles, text.norm_title) == ["bitgo files for ipo", "bitgo files for ipo", ""]


def utc(*parts):
    return datetime(*parts)


def test_rfc822(column):
    cases = {
        "Sun, 19 Jul 2026 18:50:00 +0900": utc(2026, 7, 19, 9, 50),
        "19 Jul 2026 18:50 GMT": utc(2026, 7, 19, 18, 50),
        "Fri, 12 Jun 2026 06:41:00 EST": utc(2026, 6, 12, 11, 41),
        "Fri, 12 Jun 2026 06:41:00 +0000 (UTC)": utc(2026, 6, 12, 6, 41),
        "Fri, 12 Jun 2026 06:41:00": None,
        "Fri, 12 Jun 2026 06:41:00 -0000": None,
        "Fri, 12 Jun 2026 06:41:00 XYZ": None,
        "nonsense": None, "": None, None: None,
    }
    assert column(list(cases), clock.rfc822_to_utc) == list(cases.values())


def test_eastern_with_both_clock_changes(column):
    cases = {
        "2026-07-18 22:45:00": utc(2026, 7, 19, 2, 45),
        "2026-01-15 22:45:00": utc(2026, 1, 16, 3, 45),
        "2026-7-18 2:45": utc(2026, 7, 18, 6, 45),
        "2026-03-08 02:30:00": utc(2026, 3, 8, 7, 30),
        "2026-11-01 01:30:00": utc(2026, 11, 1, 5, 30),
        "2026-13-01 00:00:00": None,
        "bad": None, None: None,
    }
    assert column(list(cases), clock.zone_to_utc) == list(cases.values())


def test_feed_time(column, spark):
    def read(offset):
        return lambda c: clock.feed_time(c, F.lit(None).cast("string"), F.lit(offset).cast("double"))

    plain = {
        "Fri, 12 Jun 2026 06:41:00 GMT": utc(2026, 6, 12, 6, 41),
        "Fri, 12 Jun 2026 06:41:00": utc(2026, 6, 12, 6, 41),
        "2026-06-12 19:56:57": utc(2026, 6, 12, 19, 56, 57),
        "2026-06-12T06:41:00+09:00": utc(2026, 6, 11, 21, 41),
        "2026-06-12T06:41:00.500Z": utc(2026, 6, 12, 6, 41, 0, 500000),
        "2026-06-12T06:41+0900": utc(2026, 6, 11, 21, 41),
        "2026-06-12": utc(2026, 6, 12),
        "soon": None,
    }
    assert column(list(plain), read(None)) == list(plain.values())
    assert column(["2026-06-12 19:56:57"], read(9.0)) == [utc(2026, 6, 12, 10, 56, 57)]
    assert column(["2026-06-12 19:56:57"], read(5.5)) == [utc(2026, 6, 12, 14, 26, 57)]
    fallback = spark.range(1).select(clock.feed_time(
        F.lit("?"), F.lit("2026-06-12T01:00:00Z"), F.lit(None).cast("double")).alias("t")).head()
    assert fallback["t"] == utc(2026, 6, 12, 1)


def test_blackout_and_lookback(column):
    hours = ["2026-07-18 21:59:59", "2026-07-18 22:00:00", "2026-07-18 23:00:00",
             "2026-07-19 00:00:00"]
    as_ts = lambda c: c.cast("timestamp")
    assert column(hours, lambda c: clock.in_blackout(as_ts(c), 7, 9)) == [False, True, True, False]
    assert column(hours, lambda c: clock.in_blackout(as_ts(c), None, 9)) == [False] * 4
    now = F.lit("2026-07-19 12:00:00").cast("timestamp")
    days = ["2026-07-15 23:59:59", "2026-07-16 00:00:00", "2026-07-19 23:59:59",
            "2026-07-20 00:00:00"]
    assert column(days, lambda c: clock.in_lookback(as_ts(c), now)) == [False, True, True, False]


def test_lookback_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp'2026-07-18 00:00:00' as ts, 1 as v").write.parquet(path)
    now = F.lit("2026-07-19 12:00:00").cast("timestamp")
    df = spark.read.parquet(path).filter(clock.in_lookback("ts", now))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_relative_time_and_weekend(column):
    now = F.lit("2026-07-13 12:00:00").cast("timestamp")
    cases = {"2026-07-13 11:59:30": "방금", "2026-07-13 11:55:00": "5분 전",
             "2026-07-13 09:00:00": "3시간 전", "2026-07-11 12:00:00": "2일 전",
             "2026-07-13 12:00:01": "방금"}
    assert column(list(cases), lambda c: clock.relative_time(
        c.cast("timestamp"), now)) == list(cases.values())
    assert column(["2026-07-11", "2026-07-13"], lambda c: clock.is_weekend(
        c.cast("timestamp"))) == [True, False]


@pytest.mark.parametrize("expected, titles", [
    ("digest", ["SpaceX IPO, US Vows Interim Deal Will Reopen Hormuz, More",
                "Balance of Power: SpaceX Jumps After Record IPO (Podcast)",
                " Lead Plaintiff in the news, MORE "]),
    ("spam", ["FS KKR CAPITAL ALERT: Bragar Eagel Reminds Investors",
              "$1000 Invested In KLA 15 Years Ago Would Be Worth This Much Today",
              "ROSEN, NATIONAL INVESTOR COUNSEL, Encourages GPK Investors — Class Action",
              "World Cup class action"]),
    ("sports", ["KBO 한국시리즈 1차전, LG 트윈스 끝내기 승리", "KBO리그 개막전 매진 행렬",
                "Tottenham win the Premier League", "NBA finals", "Watching the nfl"]),
    ("story", ["Buffett's checkbook is ready for big deals",
               "AI is the backbone of the new economy", "More, or less", "unbanked", "", None]),
])
def test_kind(column, expected, titles):
    assert column(titles, classify.kind) == [expected] * len(titles)


def test_keep_in_feed(column):
    kinds = ["story", None, "spam", "digest", "sports", "weird"]
    assert column(kinds, classify.keep_in_feed) == [True, True, False, False, False, False]


def test_publisher(column):
    cases = {
        "https://www.mk.co.kr/news/1": "매일경제",
        "https://biz.chosun.com/x": "조선비즈",
        "https://view.asiae.co.kr/a": "아시아경제",
        "https://businessplus.kr:8080/a?b": "businessplus.kr",
        "https://www.m.example.com/": "m.example.com",
        "https://n.news.naver.com/y": "네이버",
        "not a url": "네이버", "": "네이버", None: "네이버",
    }
    assert column(list(cases), publisher) == list(cases.values())


ARTICLE = ("<html><body><div class='ad'>광고 " + "x" * 200 + "</div><div class='wide article-body'>"
           + "<p>한국 경제 <b>본문</b> &amp; 내용.<br></p><div>안쪽</div> " * 8
           + "<script>no()</script></div><p>끝</p></body></html>")


def test_select_text():
    found = select_text(ARTICLE, ".article-body")
    assert "본문" in found and "안쪽" in found and "광고" not in found
    assert "끝" not in found and "no()" not in found
    assert select_text(ARTICLE, "#none") == ""
    assert select_text("<article id=a><p>one<article>two</article></p>three</article>four",
                       "article#a").split() == ["one", "two", "three"]


def test_page_text(column):
    pages = [ARTICLE, "<div class='article-body'>짧음</div>", "<p>no</p>", None]
    out = column(pages, lambda c: page_text(c, F.lit(".article-body")))
    assert out[0].startswith("한국 경제 본문 & 내용. 안쪽 한국") and out[1:] == ["", "", ""]
