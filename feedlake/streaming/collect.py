"""The collect run as a stream of landed responses: scan, mapping, insert, poll log and feed state in each batch."""

from pyspark.sql import DataFrame

from feedlake import constants as C
from feedlake.plans import collect
from feedlake.session import Scratch
from feedlake.sources import landing


def stream_collect(
    responses: DataFrame, root: str, checkpoint: str, registries: collect.Registries, *, trigger=None,
    timeout: float | None = None, deadlines: dict[str, float] | None = None,
):
    """Ingest streamed responses (``landing.stream``) into the tables below ``root``.

    A batch is one run over what has landed since the last: its files are read once, its families are staged side
    by side. What a batch writes leaves out what is there, so one that died anywhere and is run again ends as one
    that did not. Responses may land late: articles meet all stored keys, and the state of a feed with late
    polls is folded anew from the log. Of two copies of an article the one that reaches the stream first is stored.

    A family that breaks down or ends late stops the stream after the others of its batch are stored; the batch,
    with that family's responses, is run again at the next start.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with Scratch(spark, "stream-collect") as stage:
            rows = stage(batch, "responses")
            landed_here = [r[0] for r in rows.select("family").distinct().collect()]  # three at most
            families = [family for family in C.FAMILIES if family in landed_here]
            if not families:
                return
            _, broken = collect.ingest(
                spark, root, collect.Landed(**landing.split(rows, families)), registries, stage,
                timeout=timeout, deadlines=deadlines, marked=True)
            collect.require_all(broken, f"batch {batch_id}: ")

    return (
        responses.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
