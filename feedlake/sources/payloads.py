"""Scans over landed responses.

Fetching happens outside Spark; a response lands as one row (body, status, time).
Each ``scan_*`` parses the body into an array of entries and says whether the
response was readable, so that a block page becomes a failed poll and never a
silent zero. ``*_rows`` then explode the entries.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.text import nonempty, strip

_ITEM = (
    "struct<title:string,link:string,guid:struct<_VALUE:string,_isPermaLink:string>,"
    "description:string,`content:encoded`:string,pubDate:string,`dc:date`:string>"
)
_ENTRY = (
    "struct<title:string,link:array<struct<_href:string,_rel:string>>,id:string,"
    "summary:string,content:string,published:string,updated:string>"
)
_DOCUMENT = (
    f"struct<channel:struct<title:string,item:array<{_ITEM}>>,item:array<{_ITEM}>,"
    f"entry:array<{_ENTRY}>,_corrupt_record:string>"
)
_ROOT = r"(?s)^\s*(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>|\s)*<([A-Za-z_][\w:.-]*)"
# Root elements of RSS, Atom and RDF feeds.
FEED_ROOTS = ("rss", "feed", "rdf:rdf")
# A whole item or entry, which a cut or unclosed document may still hold.
_BLOCK = r"(?s)<(item|entry)(?:\s[^>]*)?>(?:(?!<\1[\s>]).)*?</\1>"
_BLOCK_ROWS = f"struct<item:{_ITEM},entry:{_ENTRY},_corrupt_record:string>"
# A bare ampersand or an HTML entity, which XML does not know.
_LOOSE_AMP = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#[xX][0-9a-fA-F]+);)"


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is computed once per row.

    Spark copies the expression of a plain column into every filter it pushes down, and
    would parse a body several times. A one-element outer explode is not looked through.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def _rss_entry(item: Column) -> Column:
    guid = item["guid"]["_VALUE"]
    guid_is_link = F.lower(F.coalesce(item["guid"]["_isPermaLink"], F.lit("true"))) != "false"
    full = item["content:encoded"]
    return F.struct(
        item["title"].alias("title"),
        F.coalesce(nonempty(strip(item["link"])), F.when(guid_is_link, guid)).alias("link"),
        guid.alias("guid"),
        F.coalesce(nonempty(item["description"]), full).alias("summary"),
        full.alias("content"),
        item["pubDate"].alias("published"),
        item["dc:date"].alias("updated"),
    )


def _atom_entry(entry: Column) -> Column:
    alternates = F.filter(
        entry["link"], lambda a: F.coalesce(a["_rel"], F.lit("alternate")) == "alternate"
    )
    return F.struct(
        entry["title"].alias("title"),
        F.try_element_at(alternates, F.lit(-1))["_href"].alias("link"),
        entry["id"].alias("guid"),
        F.coalesce(nonempty(entry["summary"]), entry["content"]).alias("summary"),
        entry["content"].alias("content"),
        entry["published"].alias("published"),
        entry["updated"].alias("updated"),
    )


def scan_feeds(payloads: DataFrame) -> DataFrame:
    """RSS, Atom and RDF bodies to ``entries`` and the not-a-feed guard ``is_feed``.

    A body that is not well-formed gets a second reading with its loose ampersands
    escaped, the usual fault of feeds. With it the whole items and entries of a body with a
    feed's root are read one by one; they count if the second reading fails too, so a cut
    document keeps what came through. No entry and either no readable XML or an unknown root means the
    response was not a feed.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = _once(payloads, "_first", F.from_xml("payload", _DOCUMENT, options))
    broken = F.col("_first._corrupt_record").isNotNull()
    known_root = F.lower(F.regexp_extract("payload", _ROOT, 1)).isin(*FEED_ROOTS)
    parsed = _once(parsed, "_repaired", F.when(broken, F.regexp_replace("payload", _LOOSE_AMP, "&amp;")))
    # the whole body first, then its blocks as documents of their own
    blocks = F.when(known_root, F.regexp_extract_all("_repaired", F.lit(_BLOCK), F.lit(0)))
    texts = F.concat(F.array("_repaired"), F.coalesce(
        F.transform(blocks, lambda block: F.concat(F.lit("<block>"), block, F.lit("</block>"))),
        F.array().cast("array<string>")))
    parsed = _once(parsed, "_read", F.when(broken, F.transform(
        texts, lambda body: F.from_xml(body, _DOCUMENT, options))))
    again = F.get("_read", F.lit(0))
    doc = F.when(broken, again).otherwise(F.col("_first"))
    lost = broken & again["_corrupt_record"].isNotNull() & known_root
    whole = F.filter(F.slice("_read", 2, F.size("_read") - 1), lambda b: b["_corrupt_record"].isNull())
    parsed = _once(parsed, "_blocks", F.when(lost, whole))
    saved = F.transform("_blocks", lambda b: F.when(
        F.get(b["entry"], F.lit(0)).isNotNull(), _atom_entry(F.get(b["entry"], F.lit(0)))).otherwise(
        _rss_entry(F.get(b["item"], F.lit(0)))))
    entries = F.coalesce(
        F.when(F.size("_blocks") > 0, saved),
        F.transform(doc["channel"]["item"], _rss_entry),
        F.transform(doc["item"], _rss_entry),
        F.transform(doc["entry"], _atom_entry),
        F.array().cast(
            "array<struct<title:string,link:string,guid:string,summary:string,"
            "content:string,published:string,updated:string>>"
        ),
    )
    readable = F.coalesce(known_root & doc["_corrupt_record"].isNull(), F.lit(False))
    scanned = _once(parsed, "_scan", F.struct(entries.alias("entries"), readable.alias("readable")))
    return scanned.select(
        *[c for c in payloads.columns if c != "payload"],
        F.col("_scan.entries").alias("entries"),
        ((F.size("_scan.entries") > 0) | F.col("_scan.readable")).alias("is_feed"),
    )


def _entry_rows(scanned: DataFrame, *keys: str) -> DataFrame:
    good = scanned.filter((F.col("status") == 200) & F.col("is_feed"))
    rows = good.select(*keys, F.posexplode_outer("entries").alias("_pos", "entry"))
    return rows.filter(F.col("_pos").isNotNull()).select(
        *keys, F.col("_pos").cast("long").alias("row_pos"), "entry.*"
    )


def feed_rows(scanned: DataFrame) -> DataFrame:
    """One row per entry of a successful response, with its position."""
    return _entry_rows(scanned, "feed_id", "fetched_at", "seq")


def scan_feed_files(spark: SparkSession, path: str, *, tag: str = "item") -> DataFrame:
    """Entries of feed files too large for one task: one row per ``tag`` (``item`` or ``entry``) of all files.

    The end tag is the record separator of Spark's text source, which splits a file among tasks at any record, so
    a file need not be a single document nor whole: what is before its first and after its last entry is left
    out. An entry with loose ampersands is read again with them escaped, as in ``scan_feeds``; one that is
    broken beyond that, or holds the end tag in its text, has null fields, which no article comes from and
    ``feed_rows_without_basis`` counts. Columns: those of the folders, ``row_pos``, the entry. ``row_pos`` rises along a
    file of up to 4 TB, with gaps. Empty files and folders without a file with ``tag`` give no rows.

    What lies between two end tags is one record in memory, and a file without any would be one record as a whole. So
    a first job reads all files in the short pieces that end with ``>`` and keeps those that have an end tag.
    """
    mapped = {"item": _rss_entry, "entry": _atom_entry}[tag]
    file = F.col("_metadata.file_path")
    pieces = spark.read.option("lineSep", ">").text(path)
    tagged = pieces.where(F.col("value").endswith(f"</{tag}")).select(file.alias("file")).distinct().collect()
    text = spark.read.option("lineSep", f"</{tag}>").text(path)
    # which files to read is settled when they are listed; the others are not opened
    text = text.where(file.isin([r["file"] for r in tagged]) & F.col("value").contains(f"<{tag}"))
    folders = [c for c in text.columns if c != "value"]
    # rows of one split are numbered in order; splits start at least 4 KB apart
    start = F.shiftright(F.col("_metadata.file_block_start"), 12)
    row_pos = F.shiftleft(start, 33) + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    head = rf"(?s)<{tag}(?:\s[^>]*)?>.*"
    rows = text.select(*folders, row_pos.alias("row_pos"), F.concat(
        F.lit("<block>"), F.regexp_extract("value", head, 0), F.lit(f"</{tag}></block>")).alias("_block"))
    rows = rows.filter(F.col("_block").startswith(f"<block><{tag}"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    rows = _once(rows, "_first", F.from_xml("_block", _BLOCK_ROWS, options))
    broken = F.col("_first._corrupt_record").isNotNull()
    repaired = F.when(broken, F.regexp_replace("_block", _LOOSE_AMP, "&amp;"))
    rows = _once(rows, "_again", F.from_xml(repaired, _BLOCK_ROWS, options))
    block = F.when(broken, F.when(F.col("_again._corrupt_record").isNull(), F.col("_again"))).otherwise(F.col("_first"))
    rows = _once(rows, "_entry", mapped(block[tag]))
    return rows.select(*folders, "row_pos", "_entry.*")


def scan_search(payloads: DataFrame) -> DataFrame:
    """Search responses ``{"items": [...]}``; a null list is empty, bad JSON a failure."""
    schema = f"struct<items:array<struct<{_ddl(schemas.SEARCH_ROW)}>>,_corrupt_record:string>"
    doc = F.from_json("payload", schema)
    return (
        _once(payloads, "_doc", doc)
        .withColumn("entries", F.col("_doc.items"))
        .withColumn(
            "is_feed", F.col("_doc").isNotNull() & F.col("_doc._corrupt_record").isNull()
        )
        .drop("_doc", "payload")
    )


def search_rows(scanned: DataFrame) -> DataFrame:
    return _entry_rows(scanned, "q", "fetched_at", "seq")


def scan_firehose(payloads: DataFrame) -> DataFrame:
    """Firehose pages, each a JSON array of rows; ``n_rows`` feeds the page verdict."""
    body = F.from_json(F.concat(F.lit('{"rows":'), "payload", F.lit("}")),
                       f"struct<rows:array<struct<{_ddl(schemas.FIREHOSE_ROW)}>>,"
                       "_corrupt_record:string>")
    return (
        _once(payloads, "_doc", body)
        .withColumn("entries", F.col("_doc.rows"))
        .withColumn("n_rows", F.coalesce(F.array_size("entries"), F.lit(0)).cast("long"))
        .withColumn(
            "is_feed", F.col("_doc").isNotNull() & F.col("_doc._corrupt_record").isNull()
        )
        .drop("_doc", "payload")
    )


def firehose_rows(scanned: DataFrame) -> DataFrame:
    return _entry_rows(scanned, "endpoint", "page", "fetched_at", "seq")


def _ddl(fields: str) -> str:
    """``a string, b string`` to the inside of a struct<> type."""
    return ",".join(f.strip().replace(" ", ":", 1) for f in fields.split(","))
