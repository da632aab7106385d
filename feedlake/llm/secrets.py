"""Secrets in texts, judged by how many repositories and owners share a value.

Three kinds of span are always found: assignments to a telling name, access ids and long runs of hex
digits. A fourth, ``opaque``, are other runs of key-like characters; these are candidates only. The
values of all candidates are hashed and counted by distinct repository and owner over the corpus. A
value of many owners is a widely copied example, a value of one owner is live-looking. An opaque run
becomes a span if its value was assigned to a telling name anywhere, or if it mixes cases and digits
like a key and belongs to one owner alone. Every span carries its verdict: live, shared or example.

Results by case: a null text counts as empty and has no span. A null owner or repository counts as
one of its own. Repeated rows are rows of the same repository and add no owner. Spans that start
together come in the order of the kinds. An empty table gives no rows. Only the named columns are
read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import staged

#: The names that tell of a secret, and what may follow them.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
KINDS = ("assign", "access", "hex", "opaque")
VALUE = "[A-Za-z0-9+/_.=-]+"
ACCESS = "AKIA[A-Z0-9]{16,}"  # 20 characters with its head
HEX = "[0-9a-f]{24,}"
OPAQUE = "[A-Za-z0-9+/_=-]{16,}"
MIN_ASSIGNED = 6
#: From this many owners on a value is a widely copied example.
EXAMPLE_OWNERS = 3


def either_case(name: str) -> str:
    """A pattern that takes ASCII letters in either case."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)


ASSIGN = (f"({'|'.join(map(either_case, NAMES))})" + r"""["']?\x20*[:=]\x20*["']?""" + f"({VALUE})")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, OPAQUE)))
#: The same, begun only where a run begins.
_RUNS = {"hex": f"(?<![0-9a-f]){HEX}", "opaque": f"(?<![A-Za-z0-9+/_=-]){OPAQUE}"}


def _matches(text: Column, kind: str) -> Column:
    """(kind, gap, length, value) of each match: gap is the text since the match before."""
    pattern = _RUNS.get(kind, PATTERNS[kind])
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else found
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"),
                         values.alias("value"))
    rows = F.transform(parts, lambda p: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), F.char_length(p["gap"]).alias("gap"),
        F.char_length(p["found"]).alias("length"), p["value"].alias("value")))
    rows = F.filter(rows, lambda r: r["length"].isNotNull())  # the text behind the last match
    return F.when(text.rlike(pattern), rows)


def _mixed(value: Column) -> Column:
    """Looks like a key: 20 characters or more of both cases and digits."""
    return ((F.char_length(value) >= 20) & value.rlike("[0-9]") & value.rlike("[a-z]")
            & value.rlike("[A-Z]"))


def candidates(docs: DataFrame, text: str = "text", repository: str = "doc_id",
               owner: str = "source") -> tuple[DataFrame, DataFrame]:
    """All rows (row, repository), and their candidates with place, value hash and traits."""
    content = F.coalesce(F.col(text), F.lit(""))
    kinds = [F.coalesce(_matches(content, kind), F.array()) for kind in KINDS]
    rows = staged(docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(repository).alias("repository"), F.col(owner).alias("owner"),
        F.concat(*kinds).alias("matches")), "secret-matches")
    each = (rows.where(F.size("matches") > 0)
            .select("row", "repository", "owner", F.posexplode("matches").alias("at", "m"))
            .select("row", "repository", "owner", "at", "m.*").repartition("row"))
    so_far = Window.partitionBy("row", "kind").orderBy("at")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far)).select(
        "row", "repository", "owner", "kind", (F.col("end") - F.col("length")).alias("start"), "end",
        F.sha2("value", 256).alias("hash"), F.char_length("value").alias("size"),
        _mixed(F.col("value")).alias("mixed"))
    placed = placed.where((F.col("kind") != 0) | (F.col("size") >= MIN_ASSIGNED))
    base = F.col("kind") < 3
    in_order = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(base, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(in_order.rowsBetween(1, Window.unboundedFollowing))
    found = placed.select("*", base.alias("base"), before.alias("before"), after.alias("after"))
    apart = F.coalesce(F.col("before") <= F.col("start"), F.lit(True)) & F.coalesce(
        F.col("after") >= F.col("end"), F.lit(True))
    found = found.where(F.col("base") | apart).drop("before", "after", "size")
    return rows.select("row", "repository"), staged(found, "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_repositories, n_owners, assigned, verdict of each value.

    Rows of one value first become distinct (owner, repository) pairs, then one row per
    owner, so a value in a third of all documents is counted by many tasks.
    """
    pairs = found.groupBy("hash", "owner", "repository").agg(F.max(F.col("kind") == 0).alias("assigned"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"),
                                                F.max("assigned").alias("assigned"))
    values = owners.groupBy("hash").agg(F.sum("n").alias("n_repositories"),
                                        F.count(F.lit(1)).alias("n_owners"),
                                        F.max("assigned").alias("assigned"))
    return values.withColumn("verdict", F.when(F.col("n_owners") == 1, "live")
                             .when(F.col("n_owners") < EXAMPLE_OWNERS, "shared").otherwise("example"))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, text: str = "text", repository: str = "doc_id",
         owner: str = "source") -> DataFrame:
    """repository, base, spans, and counts by kind and verdict, of every row.

    ``base`` and ``spans`` list kind:start:end in code points, ends exclusive.
    """
    rows, found = candidates(docs, text, repository, owner)
    values = staged(ownership(found), "secret-values")
    judged = found.join(values, "hash", "left")
    spans = judged.where(F.col("base") | F.col("assigned") | (F.col("mixed") & (F.col("verdict") == "live")))
    span = F.struct("start", "kind", "end")
    of_kind = lambda k: F.count(F.when(F.col("kind") == k, 1))
    of_verdict = lambda v: F.count(F.when(F.col("verdict") == v, 1))
    per_row = spans.groupBy("row").agg(
        F.collect_list(F.when(F.col("base"), span)).alias("base"), F.collect_list(span).alias("spans"),
        *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        *[of_verdict(v).alias(f"n_{v}") for v in ("live", "shared", "example")])
    counts = [f"n_{name}" for name in (*KINDS, "live", "shared", "example")]
    return rows.join(per_row, "row", "left").select(
        "repository",
        F.coalesce(_listed(F.col("base")), F.lit("")).alias("base"),
        F.coalesce(_listed(F.col("spans")), F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])


def _sql_kind(kind: int) -> str:
    pattern = PATTERNS[KINDS[kind]].replace("'", "''")
    value = "ms[i]" if kind else f"regexp_extract(ms[i], '{pattern}', 2)"
    return f"""
  SELECT row, doc_id, source, {kind} AS kind, length(ms[i]) AS len, {value} AS value,
    list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0) AS start
  FROM (SELECT *, regexp_extract_all(body, '{pattern}') AS ms,
               string_split_regex(body, '{pattern}') AS gaps FROM docs),
       unnest(range(1, len(ms) + 1)) AS t(i)"""


def scan_sql() -> str:
    """The whole scan for DuckDB."""
    listed = """string_agg([{names}][kind + 1] || ':' || start || ':' || (start + len), ','
        ORDER BY start, kind)""".format(names=", ".join(f"'{k}'" for k in KINDS))
    counts = ", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in (*KINDS, "live", "shared", "example"))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS body FROM documents),
matched AS ({' UNION ALL '.join(map(_sql_kind, range(4)))}),
placed AS (SELECT *, kind < 3 AS base, sha256(value) AS hash,
    length(value) >= 20 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]')
      AND regexp_matches(value, '[A-Z]') AS mixed
  FROM matched WHERE kind <> 0 OR length(value) >= {MIN_ASSIGNED}),
found AS (SELECT * FROM placed p WHERE base OR NOT EXISTS (
    SELECT 1 FROM placed b WHERE b.row = p.row AND b.base AND b.start < p.start + p.len
      AND b.start + b.len > p.start)),
owned AS (SELECT hash, count(DISTINCT coalesce('s' || source, 'n')) AS owners, max(kind = 0) AS assigned
  FROM found GROUP BY hash),
judged AS (SELECT found.*, assigned, CASE WHEN owners = 1 THEN 'live'
    WHEN owners < {EXAMPLE_OWNERS} THEN 'shared' ELSE 'example' END AS verdict
  FROM found JOIN owned USING (hash)),
per_row AS (
  SELECT row, {listed} FILTER (base) AS base_list, {listed} AS spans,
    {', '.join(f"count(*) FILTER (kind = {k}) AS n_{name}" for k, name in enumerate(KINDS))},
    {', '.join(f"count(*) FILTER (verdict = '{v}') AS n_{v}" for v in ("live", "shared", "example"))}
  FROM judged WHERE base OR assigned OR (mixed AND verdict = 'live') GROUP BY row)
SELECT doc_id, {counts}, sha256(coalesce(base_list, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_row USING (row)"""
