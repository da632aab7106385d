"""Mixing sources to target weights: rates per source, whole copies, one seeded Bernoulli copy.

A document's size is its number of words. The weights 5, 2, 1 repeat over the sources in the order
of their names (by code point, null last) and share the wanted total, by default all sizes. A
target stops at ``max_rate`` times its source's size; what is over goes to the other sources by
weight. This has one fixed point: each target is the smaller of its stop and level * weight, where
the level is that of the first source, by stop / weight, which the rest can share without passing.

Results by case: a null text has size 0. A null source is a source. A source of size 0 has target 0
and rate 0. Rows are decided one by one from a hash of doc_id and text, so repeated rows get the
same number of copies; a null doc_id hashes as the empty string. An empty table gives no rows. Of
the columns only doc_id, text and source are read; others may have any name.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import staged

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    """Words of a text, null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: str | Column, text: str | Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1 by the document alone: 52 bits of an MD5 digest."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    empty = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(seed), empty(doc_id), F.md5(empty(text))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, source: str = "source", size: str = "size",
            weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """source, source_size, target of each source.

    ``sizes`` may hold many rows per source, also one source with most rows: partial sums
    come first. The windows see one row per source (a few dozen bytes) in one task: that bounds
    the sources of one mix to some millions, which is far more than anyone gives targets to.
    """
    total = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights))) + 1)
    stops = total.select("source", "source_size", weight.cast("long").alias("weight"),
                         (max_rate * F.col("source_size")).alias("stop"))
    by_ratio = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0))
    level = stops.withColumn("level", rest / F.sum("weight").over(onward))
    # sources are stopped up to the first whose level stays within its own stop
    within = F.min(F.when(F.col("level") * F.col("weight") <= F.col("stop"),
                          F.struct(F.col("stop") / F.col("weight"), F.isnull("source"), "source", "level"))).over(everything)
    return level.select(
        "source", "source_size",
        F.least(F.col("stop").cast("double"), F.col("weight") * within["level"]).alias("target"))


def copies(source_size: Column, target: Column, chance: Column) -> Column:
    """floor(rate) copies, and one more with the probability of the fraction."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE,
         seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies of every document."""
    rows = staged(docs.select("doc_id", "source", n_words("text").alias("size"),
                              draw("doc_id", "text", seed).alias("chance")), "mix-sizes")
    of_source = staged(targets(rows, weights=weights, max_rate=max_rate), "mix-targets")
    joined = rows.alias("d").join(of_source.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    return joined.select(
        "d.doc_id", "d.size", "s.source_size", "s.target",
        copies(F.col("s.source_size"), F.col("s.target"), F.col("d.chance")).alias("copies"))


def emit(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE,
         seed: str = SEED) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, columns as they were.

    The targets are stored, so that the planner knows their size before it would shuffle texts.
    """
    rows = staged(docs.select("source", n_words("text").alias("size")), "mix-sizes")
    of_source = staged(targets(rows, weights=weights, max_rate=max_rate), "mix-targets")
    times = copies(F.col("s.source_size"), F.col("s.target"),
                   draw("d.doc_id", "d.text", seed))
    joined = docs.alias("d").join(of_source.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    taken = joined.select(F.explode(F.array_repeat(F.struct("d.*"), times.cast("int"))).alias("row"))
    return taken.select("row.*")


#: The same plan for DuckDB, up to the rate of each source.
PLAN_SQL = f"""
sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13)
    )::BIGINT / 4503599627370496.0::DOUBLE AS chance
  FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
stops AS (
  SELECT *, 3 * source_size AS stop,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM total),
levels AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(stop) OVER before, 0))::DOUBLE
             / (sum(weight) OVER onward)::DOUBLE) AS level
  FROM stops
  WINDOW before AS (ORDER BY stop::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (ORDER BY stop::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
aims AS (
  SELECT source, source_size,
    least(stop::DOUBLE, weight * (
      SELECT level FROM levels WHERE level * weight <= stop
      ORDER BY stop::DOUBLE / weight, source NULLS LAST LIMIT 1)) AS target
  FROM levels),
mixed AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM aims)"""
