"""Embedding queue: what waits, what each call gave, what is stored, what to redo."""

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pandas as pd
from pyspark import Accumulator, AccumulatorParam, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake import schemas
from feedlake.functions import text
from feedlake.watch import Watched


# Task code travels with the plan; executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ServiceRefused(Exception):
    """An answer that will not change on a second try. ``code`` tells whose fault it is.

    Any exception with a true ``permanent`` attribute counts as one.
    """

    permanent = True

    def __init__(self, reason: str, code: int | None = None):
        super().__init__(reason)
        self.code = code


class SetupFault(RuntimeError):
    """The service or its settings are wrong for every item: the pass writes nothing."""


# --- queue -----------------------------------------------------------------

def pending_queue(items: DataFrame, *, cap: int | None = None) -> DataFrame:
    """Articles that wait for a vector; with ``cap``, the oldest so many.

    Without a limit the queue is whole and unsorted; sort and limit run as top-k lists per
    task.
    """
    waiting = items.filter(F.col("embed_pending")).select(
        "item_id", text.or_empty("title").alias("title"), text.or_empty("body").alias("body"),
        "expire_at", "fetched_at",
    )
    if cap is not None:
        waiting = waiting.orderBy("fetched_at", "item_id").limit(cap)
    return waiting.drop("fetched_at")


def is_current_contract(
    model="embed_model", task_type="embed_task_type", *,
    want_model: str = C.EMBED_MODEL, want_task_type: str = C.EMBED_TASK_TYPE,
) -> Column:
    """Model and task type both as now; a missing field counts as stale."""
    return F.col(model).eqNullSafe(F.lit(want_model)) & F.col(task_type).eqNullSafe(
        F.lit(want_task_type)
    )


def unembedded(
    items: DataFrame, vectors: DataFrame, now: datetime | Column, *,
    min_life: timedelta = C.MIN_LIFE, **contract,
) -> DataFrame:
    """Ids to queue again: stories without a current vector, not queued, living on.

    Both sides are read by their narrow columns only, never bodies or vectors.
    """
    alive = F.col("expire_at") >= F.lit(now) + F.lit(min_life)
    candidates = items.filter(
        (F.col("kind") == C.STORY) & ~F.coalesce("embed_pending", F.lit(False)) & alive
    ).select("item_id")
    current = vectors.filter(is_current_contract(**contract)).select("item_id")
    return candidates.join(current, "item_id", "left_anti")


def set_pending(items: DataFrame, ids: DataFrame, waiting: bool) -> DataFrame:
    """Set or clear the flag of the given ids; unknown ids are ignored."""
    hits = ids.select("item_id").distinct().withColumn("_hit", F.lit(True))
    flag = F.lit(True) if waiting else F.lit(None).cast("boolean")
    return (
        items.join(hits, "item_id", "left")
        .withColumn("embed_pending", F.when(F.col("_hit"), flag).otherwise(F.col("embed_pending")))
        .select(*items.columns)
    )


# --- calls -----------------------------------------------------------------

Answer = Sequence[float] | Exception


def one_by_one(make_single: Callable[[], Callable[[str], Sequence[float]]]):
    """An embedder of lists from one that takes a single text and may raise."""
    def make():
        single = make_single()

        def embed(texts: list[str]) -> Iterator[Answer]:
            for item_text in texts:
                try:
                    yield single(item_text)
                except Exception as fault:
                    yield fault

        return embed

    return make


def _outcome(answer: Answer, dim: int, item_codes) -> tuple[str, list[float] | None, str]:
    if isinstance(answer, Exception):
        refused = getattr(answer, "permanent", False)
        of_item = getattr(answer, "code", None) in item_codes
        return (("permanent" if of_item else "fatal") if refused else "retryable"), None, str(answer)
    if len(answer) != dim:
        return "fatal", None, f"vector of {len(answer)} numbers, {dim} expected"
    return "ok", list(map(float, answer)), ""


class _Caller:
    """Outcomes of a task's texts in lists of ``size``; after a fatal one nothing more is sent."""

    def __init__(self, embed, dim: int, item_codes, size: int):
        self.embed, self.judge, self.size = embed, lambda x: _outcome(x, dim, item_codes), size
        self.stopped = False

    def ask(self, texts: list[str]) -> list[tuple]:
        out: list[tuple] = []
        try:
            if not self.stopped:
                for answer in self.embed(texts):
                    out.append(self.judge(answer))
                    if out[-1][0] == "fatal":
                        self.stopped = True
                        break
        except Exception as fault:  # of the whole call
            out += [self.judge(fault)] * (len(texts) - len(out))
            self.stopped = self.stopped or out[-1][0] == "fatal"
        return out + [("retryable", None, "not sent")] * (len(texts) - len(out))

    def __call__(self, pool, texts: list[str]) -> list[tuple]:
        full = [i for i, t in enumerate(texts) if t]
        out = [("permanent", None, "nothing to embed")] * len(texts)
        parts = [full[i:i + self.size] for i in range(0, len(full), self.size)]
        for part, found in zip(parts, pool.map(lambda p: self.ask([texts[i] for i in p]), parts)):
            for i, outcome in zip(part, found):
                out[i] = outcome
        return out


def embed_outcomes(
    queue: DataFrame, make_embedder: Callable[[], Callable[[list[str]], Iterable[Answer]]], *,
    dim: int = C.EMBED_DIM, item_codes=C.ITEM_ERROR_CODES, body_chars: int = C.EMBED_BODY_CHARS,
    per_call: int = 100, concurrency: int = 1, partitions: int | None = None, faults: Accumulator | None = None,
) -> DataFrame:
    """Send each queued article once: ok, permanent, retryable or fatal.

    ``make_embedder`` runs once per task and returns the function from a list of texts to
    their vectors or faults, in order (``one_by_one`` makes one from single texts). A refusal
    whose code lies in ``item_codes`` belongs to the item (permanent); any other refusal and
    a wrong dimension belong to the set-up (fatal, see ``raise_if_fatal``), and the task sends
    nothing after it; the rest may be tried again. ``partitions`` sizes the stage to the rate
    the service allows. A task adds its fatal reason to ``faults`` when it ends (see ``stored_outcomes``).
    Reasons never show a key.
    """
    queue = queue.select(
        "item_id", text.embed_text("title", "body", body_chars=body_chars).alias("text")
    )
    if partitions is not None:
        queue = queue.repartition(partitions)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = _Caller(make_embedder(), dim, item_codes, per_call)
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                rows = [(i, *o) for i, o in zip(batch["item_id"], call(pool, batch["text"].tolist()))]
                if faults is not None:
                    faults.add([reason for _, outcome, _, reason in rows if outcome == "fatal"][:1])
                yield pd.DataFrame(rows, columns=["item_id", "outcome", "vector", "reason"], dtype=object)

    return queue.mapInPandas(run, schemas.EMBED_RESULT).withColumn(
        "reason", text.redact("reason")
    )


class _OneReason(AccumulatorParam):
    """The first reason that arrived, in a list: however many tasks report, the driver keeps one."""

    def zero(self, value):
        return []

    def addInPlace(self, kept, new):
        return (kept + new)[:1]


def stored_outcomes(queue: DataFrame, make_embedder, store: Callable[[DataFrame], DataFrame], **calls) -> DataFrame:
    """``embed_outcomes``, stored by ``store``; a set-up fault in one task ends the calls of all.

    A task that meets one ends without further calls and reports it; the driver then cancels
    the stage, tasks that wait included, and raises SetupFault. Nothing is stored in that case.
    """
    spark = queue.sparkSession
    faults = spark.sparkContext.accumulator([], _OneReason())
    outcomes = embed_outcomes(queue, make_embedder, faults=faults, **calls)
    calling = Watched(spark, "embed", lambda _: store(outcomes))
    try:
        while not calling.wait(0.2) and not faults.value:
            pass
    finally:
        if not calling.wait(0):
            calling.give_up()
    if faults.value:
        reason = spark.createDataFrame([tuple(faults.value)], "reason string").select(text.redact("reason"))
        raise SetupFault(reason.head()[0])
    stored = calling.result()
    raise_if_fatal(stored)
    return stored


def raise_if_fatal(outcomes: DataFrame) -> None:
    """Stop the pass on a set-up fault. ``outcomes`` must be stored, or calls repeat."""
    faults = outcomes.filter(F.col("outcome") == "fatal").select("reason").take(1)
    for fault in faults:
        raise SetupFault(fault["reason"])


def pass_stats(outcomes: DataFrame, saved: DataFrame) -> DataFrame:
    """pending, embedded, permanent, retryable; embedded counts what was stored."""
    marks = outcomes.select("outcome").unionByName(saved.select(F.lit("saved").alias("outcome")))
    return marks.agg(
        F.count_if(F.col("outcome") != "saved").alias("pending"),
        F.count_if(F.col("outcome") == "saved").alias("embedded"),
        F.count_if(F.col("outcome") == "permanent").alias("permanent"),
        F.count_if(F.col("outcome") == "retryable").alias("retryable"),
    )


# --- vectors ---------------------------------------------------------------

def vector_entries(outcomes: DataFrame, queue: DataFrame) -> DataFrame:
    """Successful calls with the expire_at of their queue row."""
    ok = outcomes.filter(F.col("outcome") == "ok").select("item_id", "vector")
    return ok.join(queue.select("item_id", "expire_at"), "item_id")


def vectors_to_save(
    entries: DataFrame, items: DataFrame, embedded_at: datetime | Column, *,
    model: str = C.EMBED_MODEL, task_type: str = C.EMBED_TASK_TYPE,
) -> DataFrame:
    """Entries whose article still exists, stamped with the contract."""
    alive = items.select("item_id").join(
        entries.select("item_id").distinct(), "item_id", "left_semi"
    )
    return entries.join(alive, "item_id", "left_semi").select(
        "item_id",
        F.col("vector").cast("array<double>").alias("vector"),
        F.lit(model).alias("embed_model"),
        F.lit(task_type).alias("embed_task_type"),
        F.lit(embedded_at).cast("timestamp").alias("embedded_at"),
        "expire_at",
    )


def upsert_vectors(vectors: DataFrame, saved: DataFrame) -> DataFrame:
    """The vector table after a save: saved rows replace rows of the same id."""
    kept = vectors.join(saved.select("item_id"), "item_id", "left_anti")
    return kept.unionByName(saved)


def vector_norm(vector="vector") -> Column:
    return F.sqrt(
        F.aggregate(
            F.col(vector), F.lit(0.0),
            lambda acc, x: acc + x.cast("double") * x.cast("double"),
        )
    )


def vector_audit(vectors: DataFrame, *, dim: int = C.EMBED_DIM, **contract) -> DataFrame:
    """Counts of wrong dimension and stale contract, and the spread of norms."""
    norm = vector_norm()
    return vectors.agg(
        F.count("*").alias("vectors"),
        F.count_if(F.coalesce(F.size("vector") != dim, F.lit(True))).alias("wrong_dim"),
        F.count_if(~is_current_contract(**contract)).alias("stale"),
        F.min(norm).alias("min_norm"),
        F.avg(norm).alias("avg_norm"),
        F.max(norm).alias("max_norm"),
    )


def reembedding_complete(vectors: DataFrame, started: datetime | Column) -> DataFrame:
    """Whether no vector is older than the start of a re-embedding job."""
    return vectors.agg(F.min("embedded_at").alias("oldest")).withColumn(
        "complete", F.col("oldest") >= F.lit(started)
    )
