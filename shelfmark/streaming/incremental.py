"""Resume from partial output as a stream of new files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.groups import top_per_key
from shelfmark.sources.writers import append_missing


def append_new_files(stream: DataFrame, path: str, keys: Sequence[str], order: Sequence, checkpoint: str, enrich: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append every key once: each batch is reduced to its first row per key and to keys the output lacks.

    A batch that is replayed after a failure finds its rows in the output and appends nothing twice.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = top_per_key(batch, list(keys), list(order))
        append_missing(enrich(rows) if enrich else rows, path, list(keys))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
