import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from feedlake.session import configure  # noqa: E402
from tests.values import NOW  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
    )
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture
def items(spark):
    """Mapped articles from short dicts; positions follow the list order."""
    from feedlake.schemas import MAPPED_ITEM

    defaults = dict(
        item_id="i", feed_id="f1", source="S", asset_hint="", language="en", url="", title="t", body="b",
        symbol="", published_at=None, fetched_at=NOW, family="rss", feed_pos=0, seq=0)

    def make(*rows):
        full = [{**defaults, "row_pos": i, **r} for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [tuple(r[f.name] for f in MAPPED_ITEM) for r in full], MAPPED_ITEM)

    return make


@pytest.fixture
def column(spark):
    """Values of an expression over a list of inputs, in order."""
    from pyspark.sql import functions as F

    def values(inputs, expression, kind="string"):
        df = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {kind}")
        rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
        return [r["out"] for r in rows]

    return values
