"""Raw posts enriched as their files arrive.

The posts of a stream go through the same functions as those of a batch. What was read is noted
beside the output, and a file of it counts only once its batch is committed, so a run that was
killed anywhere is repeated without a row lost or doubled; a run without new files adds none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from crisis_posts.operators.enrich import enrich_posts


def enrich_arriving(
    raw: DataFrame, output: str, labels: DataFrame, lexicon: DataFrame | None = None, **options
) -> None:
    """Add what has arrived of a stream of raw posts to the enriched Parquet table ``output``.

    Reads all new files, in as many batches as the source makes of them, and returns. ``options``
    are those of ``enrich_posts``. ``read_enriched`` reads the table, and sees whole batches only.
    The notes lie in ``output/_offsets``: table and notes go together, or not at all.

    A post gets the labels that there are when it is read; posts whose labels come later are
    enriched by a batch job or by the bucketed tables. The lexicon must be one that may travel with
    the tasks (``max_words``); a larger one raises ``ValueError``, as words can't be counted first.
    """
    if not raw.isStreaming:
        raise ValueError("raw is no stream")
    query = (
        enrich_posts(raw, labels, lexicon, **options)
        .writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", f"{output.rstrip('/')}/_offsets")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
