"""Explicit schemas. A missing field is NULL; nothing is ever inferred."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
    "date": T.DateType(),
    "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
    "array<double>": T.ArrayType(T.DoubleType()),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string;string>": T.MapType(T.StringType(), T.StringType()),
}


def _schema(fields: str) -> T.StructType:
    """``name type, ...`` without needing a session, which DDL parsing does."""
    pairs = (field.split() for field in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


ITEM_FIELDS = (
    "item_id string, feed_id string, source string, asset_hint string, language string, "
    "url string, title string, body string, symbol string, "
    "published_at timestamp, fetched_at timestamp"
)
# An article as mapped from a source, with the position that decides "first wins".
MAPPED_ITEM = _schema(f"{ITEM_FIELDS}, family string, feed_pos long, seq long, row_pos long")
# An article as stored.
ITEM = _schema(f"{ITEM_FIELDS}, kind string, expire_at timestamp, embed_pending boolean")

VECTOR = _schema(
    "item_id string, vector array<double>, embed_model string, embed_task_type string, "
    "embedded_at timestamp, expire_at timestamp"
)
EMBED_FAILURE = _schema(
    "item_id string, embed_model string, embed_task_type string, reason string, failed_at timestamp"
)
EMBED_RESULT = _schema("item_id string, outcome string, vector array<double>, reason string")

FEED_STATE = _schema(
    "feed_id string, etag string, last_modified string, last_fetched timestamp, "
    "last_success timestamp, consecutive_failures long, last_error string, "
    "last_error_at timestamp"
)
JOB_HEALTH = _schema(
    "job string, last_status string, fetched_at timestamp, last_run_at timestamp, "
    "last_finished_at timestamp, last_success_at timestamp, detail string"
)
META = _schema("key string, sources array<string>, tiers map<string;string>")

# Append-only logs that the two state tables above are folded from.
POLL_LOG = _schema(
    "family string, feed_id string, ts timestamp, seq long, status int, is_feed boolean, "
    "etag string, last_modified string, new_count long, error string"
)
RUN_LOG = _schema(
    "job string, ts timestamp, seq long, event string, detail string, error string"
)

# Registries.
FEED_REGISTRY = _schema(
    "feed_id string, url string, source string, asset_hint string, language string, "
    "body_mode string, tz_offset double, tier string, feed_pos long"
)
SEARCH_REGISTRY = _schema("q string, asset_hint string, feed_pos long")
FIREHOSE_REGISTRY = _schema("endpoint string, feed_pos long")

# Landed payloads: one row per response.
FEED_PAYLOAD = _schema(
    "feed_id string, fetched_at timestamp, seq long, status int, etag string, "
    "last_modified string, payload string"
)
SEARCH_PAYLOAD = _schema(
    "q string, fetched_at timestamp, seq long, status int, payload string"
)
FIREHOSE_PAYLOAD = _schema(
    "endpoint string, page int, fetched_at timestamp, seq long, status int, payload string"
)
# Any of these three in a folder of all families; the last three are its sub-folders.
LANDED = _schema(
    "name string, page int, fetched_at timestamp, seq long, status int, etag string, "
    "last_modified string, payload string, family string, endpoint string, date date"
)
PAGE_PAYLOAD = _schema("url string, fetched_at timestamp, status int, html string")

SEARCH_ROW = "title string, originallink string, link string, description string, pubDate string"
FIREHOSE_ROW = (
    "symbol string, publishedDate string, publisher string, site string, title string, "
    "text string, url string, link string, content string, date string, tickers string"
)
