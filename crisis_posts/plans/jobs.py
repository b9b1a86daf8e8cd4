"""The batch jobs: enrich posts, count their entities, merge counts, store what queries read.

Each reads its input once and writes with overwrite; a lost task is redone by Spark
from its input, nothing is kept between stages.
"""

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, SparkSession

from crisis_posts.operators import enrich, mentions
from crisis_posts.operators.rollup import write_batch
from crisis_posts.operators.tagger import learn_tagger, tag_names
from crisis_posts.operators.tiles import DEEPEST, tile_pyramid, write_pyramid
from crisis_posts.operators.wordtable import MAX_ROWS
from crisis_posts.sources import labels as label_file
from crisis_posts.sources import posts as post_files
from crisis_posts.sources import tables
from crisis_posts.sources.clustering import write_clustered
from crisis_posts.streaming.arriving import enrich_arriving


def enrichment_job(
    spark: SparkSession,
    posts: str,
    labels: str,
    lexicon: str,
    output: str,
    fmt: str = "parquet",
    by_phase: bool = False,
    by_date: bool = False,
    keep_id: bool = False,
    rejects: str | None = None,
    label_header: str | None = None,
    scorer: str | None = None,
    max_words: int = MAX_ROWS,
    modifiers: str | None = None,
) -> None:
    """``rejects`` names a JSON directory for unreadable posts; it costs a second scan.

    ``scorer`` is the import path (``package.module:name``) of a pandas UDF from text to
    struct(polarity, subjectivity), which takes the lexicon's place. ``max_words`` is the number
    of lexicon rows that may travel with the tasks. ``modifiers`` names a CSV of negators and
    boosters; with it the lexicon is read with scope.
    """
    raw = post_files.read_raw_posts(spark, posts)
    enriched = enrich.enrich_posts(
        raw,
        label_file.read_labels(spark, labels, label_header),
        None if scorer else tables.read_lexicon(spark, lexicon),
        scorer=_imported(scorer),
        keep_id=keep_id,
        max_words=max_words,
        modifiers=tables.read_modifiers(spark, modifiers) if modifiers else None,
    )
    post_files.write_enriched(
        enriched, output, fmt, ["phase"] if by_phase else [], ["date"] if by_date else []
    )
    if rejects:
        enrich.post_rejects(raw).write.mode("overwrite").json(rejects)


def entity_job(
    spark: SparkSession,
    posts: str,
    gazetteer: str,
    output: str,
    fmt: str = "parquet",
    counts_fmt: str = "json",
    tagger: str | None = None,
    learned: bool = False,
    run: str | None = None,
) -> None:
    """``tagger`` is the import path of a pandas UDF from text to mentions, used in place of
    the name pattern and the gazetteer. ``learned`` names are those of a sequence tagger that
    is learned from the posts, in which the gazetteer marks names. The counts of a named ``run``
    lie beside those of other runs; replaying it changes no total."""
    enriched = post_files.read_enriched(spark, posts, fmt)
    if not (tagger or learned):
        counts = mentions.text_mention_counts(enriched, tables.read_gazetteer(spark, gazetteer))
    else:
        if tagger:
            tagged = mentions.tag_mentions(enriched, _imported(tagger))
        else:
            known = tables.read_gazetteer(spark, gazetteer)
            tagged = tag_names(enriched, learn_tagger(enriched, known))
        found = mentions.canonical_mentions(mentions.explode_mentions(tagged))
        counts = mentions.mention_counts(found)
    tables.write_entity_counts(counts, output, counts_fmt, run)


def rollup_job(spark: SparkSession, posts: str, output: str, batch: str, fmt: str = "parquet") -> None:
    """Store the rollup of a batch of enriched posts; a repeated batch replaces itself."""
    write_batch(post_files.read_enriched(spark, posts, fmt), output, batch)


def arriving_job(
    spark: SparkSession,
    posts: str,
    labels: str,
    lexicon: str,
    output: str,
    max_files: int | None = None,
    keep_id: bool = False,
    label_header: str | None = None,
    max_words: int = MAX_ROWS,
    modifiers: str | None = None,
) -> None:
    """Enrich the post files that have come since the last run, ``max_files`` at a time."""
    enrich_arriving(
        post_files.stream_raw_posts(spark, posts, max_files),
        output,
        label_file.read_labels(spark, labels, label_header),
        tables.read_lexicon(spark, lexicon),
        keep_id=keep_id,
        max_words=max_words,
        modifiers=tables.read_modifiers(spark, modifiers) if modifiers else None,
    )


def cluster_job(spark: SparkSession, posts: str, output: str, files: int, fmt: str = "parquet") -> None:
    """Store enriched posts again, in ``files`` files, so that any filter skips most row groups."""
    write_clustered(post_files.read_enriched(spark, posts, fmt), output, files)


def tiles_job(
    spark: SparkSession,
    posts: str,
    output: str,
    fmt: str = "parquet",
    places: bool = False,
    deepest: int = DEEPEST,
) -> None:
    """Store the tile pyramid of the exact points, or of the ``places``."""
    latitude, longitude = (f"place_{c}" if places else c for c in ("latitude", "longitude"))
    enriched = post_files.read_enriched(spark, posts, fmt)
    write_pyramid(tile_pyramid(enriched, latitude, longitude, deepest), output)


def merge_job(spark: SparkSession, counts: str, output: str, counts_fmt: str = "json") -> None:
    totals = mentions.merge_counts(tables.read_entity_counts(spark, counts, counts_fmt))
    tables.write_entity_totals(totals, output)


def _imported(path: str | None) -> Callable[[Column], Column] | None:
    if path is None:
        return None
    module, _, name = path.partition(":")
    return getattr(import_module(module), name)
