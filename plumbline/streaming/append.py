"""Incremental append of new pages from a stream of crawl batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plumbline.sources.files import append_new


def append_new_pages(stream: DataFrame, path: str, checkpoint: str, key: str = "url") -> StreamingQuery:
    """Append each micro-batch's unseen pages to the JSON lines at ``path``.

    A batch that is run again after a failure finds its rows already there and
    adds none. Runs through what is available and stops; start it again for more.
    """

    def add(batch: DataFrame, _batch_id: int) -> None:
        append_new(batch, path, key)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
