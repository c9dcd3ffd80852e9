"""Change logs as streams: each micro-batch is merged into state with the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators.merge import greatest_wins
from tagloom.operators.orphans import OrphanCounts


def merge_usage(changes: DataFrame, read_state: Callable[[], DataFrame | None], write_state: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Keeps the greatest count of each (tag_id, format_id) as changes arrive.

    ``write_state`` gets the new state and the batch number; a batch that runs
    again after a failure gives the same state, as the merge is idempotent.
    """
    key, carried = ["tag_id", "format_id"], ["created_at", "updated_at"]

    def step(batch: DataFrame, number: int) -> None:
        new = batch.select(*key, "count", *carried)
        old = read_state()
        write_state(greatest_wins(new if old is None else old.select(*new.columns).unionByName(new), key, "count", carried, carried), number)

    return changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def maintain_orphans(changes: DataFrame, counts: OrphanCounts, checkpoint: str) -> StreamingQuery:
    """Keeps the counts of ``counts`` as a stream of deltas arrives.

    ``changes`` has ``ref_table, ref_field, key, period, n``; rows without
    ``ref_table`` are existence. A batch that runs again changes nothing.
    """

    def step(batch: DataFrame, number: int) -> None:
        refs, have = batch.where("ref_table is not null"), batch.where("ref_table is null").select("key", "period", "n")
        counts.apply(number, refs, have)

    return changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
