"""Run a batch job: ``spark-submit`` this module, or ``python -m crisis_posts``."""

import argparse

from pyspark.sql import SparkSession

from crisis_posts.operators.tiles import DEEPEST
from crisis_posts.operators.wordtable import MAX_ROWS
from crisis_posts.plans import jobs


def main() -> None:
    parser = argparse.ArgumentParser(prog="crisis_posts")
    commands = parser.add_subparsers(dest="job", required=True)

    enrich = commands.add_parser("enrich", help="raw posts and labels to the enriched table")
    for name in ("posts", "labels", "lexicon", "output"):
        enrich.add_argument(name)
    enrich.add_argument("--fmt", choices=("parquet", "json"), default="parquet")
    enrich.add_argument("--by-phase", action="store_true")
    enrich.add_argument("--by-date", action="store_true")
    enrich.add_argument("--keep-id", action="store_true")
    enrich.add_argument("--rejects")
    enrich.add_argument("--label-header", help="the label file's header line")
    enrich.add_argument("--scorer", metavar="MODULE:NAME", help="pandas UDF instead of the lexicon")
    enrich.add_argument("--modifiers", help="CSV of negators and boosters")
    enrich.add_argument("--max-words", type=int, default=MAX_ROWS, help="lexicon rows sent with tasks")

    entities = commands.add_parser("entities", help="enriched table to entity counts")
    for name in ("posts", "gazetteer", "output"):
        entities.add_argument(name)
    entities.add_argument("--fmt", choices=("parquet", "json"), default="parquet")

    entities.add_argument("--counts-fmt", choices=("parquet", "json"), default="json")
    entities.add_argument("--tagger", metavar="MODULE:NAME", help="pandas UDF instead of names")

    entities.add_argument("--run", help="name of this run among others below OUTPUT")
    entities.add_argument("--learned", action="store_true", help="names by a tagger learned from the posts")

    merge = commands.add_parser("merge", help="entity counts of many runs to totals")
    for name in ("counts", "output"):
        merge.add_argument(name)
    merge.add_argument("--counts-fmt", choices=("parquet", "json"), default="json")

    rollup = commands.add_parser("rollup", help="enriched table to a batch of the stored rollup")
    for name in ("posts", "output", "batch"):
        rollup.add_argument(name)
    rollup.add_argument("--fmt", choices=("parquet", "json"), default="parquet")

    arriving = commands.add_parser("arriving", help="new raw post files to the enriched table")
    for name in ("posts", "labels", "lexicon", "output"):
        arriving.add_argument(name)
    arriving.add_argument("--max-files", type=int, help="files in a batch")
    arriving.add_argument("--keep-id", action="store_true")
    arriving.add_argument("--label-header", help="the label file's header line")
    arriving.add_argument("--modifiers", help="CSV of negators and boosters")
    arriving.add_argument("--max-words", type=int, default=MAX_ROWS, help="lexicon rows sent with tasks")

    cluster = commands.add_parser("cluster", help="enriched table to files that filters can skip")
    for name in ("posts", "output"):
        cluster.add_argument(name)
    cluster.add_argument("files", type=int)
    cluster.add_argument("--fmt", choices=("parquet", "json"), default="parquet")

    tiles = commands.add_parser("tiles", help="enriched table to a pyramid of map tiles")
    for name in ("posts", "output"):
        tiles.add_argument(name)
    tiles.add_argument("--fmt", choices=("parquet", "json"), default="parquet")
    tiles.add_argument("--places", action="store_true", help="place points, not exact ones")
    tiles.add_argument("--deepest", type=int, default=DEEPEST)

    arguments = vars(parser.parse_args())
    job = {
        "enrich": jobs.enrichment_job,
        "entities": jobs.entity_job,
        "merge": jobs.merge_job,
        "rollup": jobs.rollup_job,
        "arriving": jobs.arriving_job,
        "cluster": jobs.cluster_job,
        "tiles": jobs.tiles_job,
    }[arguments.pop("job")]
    job(SparkSession.builder.appName("crisis_posts").getOrCreate(), **arguments)


if __name__ == "__main__":
    main()
