"""The registered queries: one per operator, each over whole test tables.

Means are rounded to eight places, since summation order differs between engines, and
dates are given as text to the second.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crisis_posts.functions import texts
from crisis_posts.operators import (
    density, enrich, mentions, pages, rollup, scope, sentiment, tagger, tiles, views,
)
from crisis_posts.operators.selection import PostQuery
from crisis_posts.plans import binding
from crisis_posts.sources import buckets, clustering
from crisis_posts.sources.labels import label_rejects, parse_label_lines
from crisis_posts.sources.posts import read_enriched, stream_raw_posts
from crisis_posts.sources.scratch import new_path
from crisis_posts.streaming import arriving

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _seconds(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias(moment)


def _rounded(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumns({name: F.round(name, 8) for name in columns})


def _derived(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    posts = enrich.project_posts(binding.raw_posts(spark, sf_dir, wanted))
    return enrich.derive_columns(posts, binding.STATES, binding.PHASE_CUTS)


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_label_lines(binding.label_lines(spark, sf_dir), binding.HEADER)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")


# Enrichment


@register
def parse_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir)


@register
def reject_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_rejects(_labels(spark, sf_dir))


@register
def project_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = enrich.project_posts(binding.raw_posts(spark, sf_dir))
    return posts.select(
        "id", "name", "screen_name", "verified", "text", "full_text", "created_at",
        F.col("retweeted_status.id").alias("reposted_id"), "truncated", "possibly_sensitive",
        "favorite_count", F.col("place.full_name").alias("place_name"),
        F.get("coordinates.coordinates", F.lit(0)).alias("first_coordinate"),
    )


@register
def drop_reposts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.drop_reposts(binding.raw_posts(spark, sf_dir, set())).select("id")


@register
def effective_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, binding.TEXT | binding.FLAGS).select("id", "text")


@register
def parse_post_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, set()).select("id", _seconds("date"))


@register
def place_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, binding.PLACE).select("id", "place_latitude", "place_longitude")


@register
def exact_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, binding.POINT).select("id", "longitude", "latitude")


@register
def place_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, binding.PLACE).select("id", "place_name", "place_state")


@register
def phase_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.enriched_posts(spark, sf_dir, "phase")


@register
def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.enriched_posts(spark, sf_dir, "timerange_end")


@register
def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "lang")
    return enrich.join_labels(posts, _labels(spark, sf_dir))


@register
def label_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``label_join``, over posts and labels that were stored in buckets."""
    path = new_path(spark)
    posts, labels = (f"{kind}_{path.rsplit('-')[-1]}" for kind in ("posts", "labels"))
    stored = _documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "lang")
    buckets.store_posts(stored, posts, f"{path}/posts", 16)
    buckets.store_labels(_labels(spark, sf_dir), labels, f"{path}/labels", 16)
    return buckets.labelled_posts(spark, posts, labels)


@register
def enrich_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = enrich.enrich_posts(
        binding.raw_posts(spark, sf_dir),
        _labels(spark, sf_dir),
        binding.lexicon(spark),
        keep_id=True,
        states=binding.STATES,
        phase_cuts=binding.PHASE_CUTS,
    )
    return _rounded(
        posts.withColumn("date", _seconds("date")), "sentiment_polarity", "sentiment_subjectivity"
    )


@register
def enrich_arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``enrich_posts``, of all posts as files that arrive in two goes; a third run finds none."""
    path = new_path(spark)
    raw = binding.raw_posts(spark, sf_dir).drop("_corrupt_record")
    for part in (F.col("id") % 2 == 0, F.col("id") % 2 != 0, None):
        if part is not None:
            # Packed: a post's JSON holds its text twice.
            raw.filter(part).write.mode("append").json(f"{path}/raw", compression="gzip")
        arriving.enrich_arriving(
            stream_raw_posts(spark, f"{path}/raw"),
            f"{path}/enriched",
            _labels(spark, sf_dir),
            binding.lexicon(spark),
            keep_id=True,
            states=binding.STATES,
            phase_cuts=binding.PHASE_CUTS,
        )
    posts = read_enriched(spark, f"{path}/enriched", with_id=True)
    return _rounded(
        posts.withColumn("date", _seconds("date")), "sentiment_polarity", "sentiment_subjectivity"
    )


@register
def reject_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = binding.raw_posts(spark, sf_dir, binding.TEXT | binding.FLAGS)
    return enrich.post_rejects(raw).select("id", "created_at", "reason")


# Sentiment and mentions


def _scores(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    posts = _documents(spark, sf_dir).select("doc_id", "text")
    scored = sentiment.with_lexicon_sentiment(posts, binding.lexicon(spark), **options)
    return _rounded(scored.drop("text"), "sentiment_polarity", "sentiment_subjectivity")


@register
def sentiment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir)


@register
def sentiment_score_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for a lexicon beyond the size that travels with the tasks."""
    return _scores(spark, sf_dir, max_rows=0)


def _scoped_scores(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    posts = _documents(spark, sf_dir).select("doc_id", "text")
    scored = scope.with_scoped_sentiment(
        posts, binding.scoped_lexicon(spark), binding.modifiers(spark), **options
    )
    return _rounded(scored.drop("text"), "sentiment_polarity", "sentiment_subjectivity")


@register
def sentiment_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With negation, boosters and entries of several words."""
    return _scoped_scores(spark, sf_dir)


@register
def sentiment_scoped_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scoped_scores(spark, sf_dir, max_rows=0)


def _mention_lists(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    return mentions.extract_mentions(
        _documents(spark, sf_dir), binding.gazetteer(spark), **options
    )


def _flat_lists(posts: DataFrame) -> DataFrame:
    return posts.select(
        "doc_id",
        F.size("entities").alias("n"),
        F.array_join("entities.entity", " ").alias("entities"),
        F.array_join("entities.type", " ").alias("types"),
    )


@register
def extract_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_lists(_mention_lists(spark, sf_dir))


@register
def extract_mentions_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for a gazetteer beyond the size that travels with the tasks."""
    return _flat_lists(_mention_lists(spark, sf_dir, max_rows=0))


@register
def tag_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tagger learned from all texts, in which the gazetteer marks names, names those of all texts."""
    texts = _documents(spark, sf_dir)
    learned = tagger.learn_tagger(texts, binding.marked_names(spark))
    return _flat_lists(tagger.tag_names(texts, learned))


@register
def explode_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.explode_mentions(_mention_lists(spark, sf_dir))


@register
def canonical_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mentions.explode_mentions(_mention_lists(spark, sf_dir))
    return mentions.canonical_mentions(rows, binding.RULES)


@register
def mention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.text_mention_counts(
        _documents(spark, sf_dir), binding.gazetteer(spark), rules=binding.RULES
    )


@register
def mention_counts_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted mention by mention, as with a plugged-in tagger."""
    return mentions.mention_counts(canonical_mentions(spark, sf_dir))


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language is taken as one run with its own counts, which are merged."""
    names = _documents(spark, sf_dir).select(
        F.col("lang").alias("run"),
        F.explode(texts.names(F.col("text"))).alias("entity"),
    )
    partial = names.groupBy("run", "entity").count().withColumn("type", F.upper("run"))
    return mentions.merge_counts(
        mentions.canonical_mentions(
            partial.withColumnsRenamed({"entity": "Entity", "type": "Type"}), binding.RULES
        )
    )


@register
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(spark, sf_dir)


@register
def entity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.entity_table(_totals(spark, sf_dir))


# Selections


def _query(spark: SparkSession, sf_dir: str, *columns: str) -> PostQuery:
    return PostQuery(binding.enriched_posts(spark, sf_dir, *columns))


@register
def filter_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "aidr_label").where(labels=["view", "signup"]).rows()


@register
def filter_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _query(spark, sf_dir, "date").where(created_at="2024-01-03")
    return chosen.rows().select("id", _seconds("date"))


@register
def filter_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _query(spark, sf_dir, "date", "phase").where(
        created_at="2024-01-02", created_at_end="2024-01-03"
    )
    return chosen.rows().select("id", _seconds("date"), "phase")


@register
def filter_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "place_state").where(place=["N1", "N7", "N21"]).rows()


@register
def filter_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "verified").where(verified="True").rows()


@register
def filter_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "possibly_sensitive").where(possibly_sensitive="False").rows()


@register
def filter_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "phase").where(phase=["Durante", "Post"]).rows()


FILTERED = (
    "aidr_label", "verified", "possibly_sensitive", "date", "place_state", "phase",
    "sentiment_polarity", "sentiment_subjectivity",
)


@register
def filter_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _query(spark, sf_dir, *FILTERED).where(
        labels=["view", "click", "error"],
        verified="True",
        created_at="2024-01-01",
        created_at_end="2024-01-02",
        possibly_sensitive="False",
        phase=["Pre", "Durante"],
    )
    return chosen.rows().withColumn("date", _seconds("date"))


@register
def filter_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``filter_posts``, from posts stored in clusters of five columns."""
    path = new_path(spark)
    posts = binding.enriched_posts(spark, sf_dir, *FILTERED)
    clustering.write_clustered(posts, path, 8)
    chosen = PostQuery(spark.read.schema(posts.schema).parquet(path)).where(
        labels=["view", "click", "error"],
        verified="True",
        created_at="2024-01-01",
        created_at_end="2024-01-02",
        possibly_sensitive="False",
        phase=["Pre", "Durante"],
    )
    return chosen.rows().withColumn("date", _seconds("date"))


@register
def refine_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = (
        _query(spark, sf_dir, "aidr_label", "place_state", "date", "phase")
        .where(labels=["view", "click"])
        .refine(phase=["Pre"])
        .refine(labels=["click", "error"], place=["N1", "N2", "N6", "N11"])
    )
    return chosen.rows().withColumn("date", _seconds("date"))


@register
def selection_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "aidr_label", "phase").where(phase=["Pre"]).size()


MEASURED = ("sentiment_polarity", "sentiment_subjectivity")


@register
def mean_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _query(spark, sf_dir, "phase", *MEASURED).where(phase=["Durante"])
    return _rounded(chosen.means(), "polarity", "subjectivity")


@register
def mean_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _query(spark, sf_dir, "aidr_label", *MEASURED)
    return _rounded(chosen.means_by("aidr_label", binding.LABELS), "polarity", "subjectivity")


@register
def mean_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _query(spark, sf_dir, "place_state", *MEASURED)
    means = chosen.means_by("place_state", binding.STATE_DOMAIN)
    return _rounded(means, "polarity", "subjectivity")


@register
def mean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall, label and state means of one selection, in one pass."""
    return _rounded(_all_means(spark, sf_dir), "polarity", "subjectivity")


def _all_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _query(spark, sf_dir, "aidr_label", "place_state", "date", *MEASURED).where(
        created_at="2024-01-01", created_at_end="2024-01-02"
    )
    return chosen.all_means(binding.LABELS, binding.STATE_DOMAIN)


# Means and sizes from a stored rollup


def _stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts, stored in two batches, the first of which comes twice."""
    posts = binding.enriched_posts(spark, sf_dir, *rollup.DIMENSIONS, *MEASURED)
    path = new_path(spark)
    seen = F.coalesce(F.col("aidr_label").isin("view", "click"), F.lit(False))
    for batch, chosen in (("seen", seen), ("other", ~seen), ("seen", seen)):
        rollup.write_batch(posts.filter(chosen), path, batch)
    return rollup.read_rollup(spark, path)


@register
def rollup_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _stored_rollup(spark, sf_dir).withColumn("date", _seconds("date"))
    return _rounded(cells, "sum_polarity", "sum_subjectivity")


@register
def rollup_all_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``mean_all``, read from the rollup."""
    chosen = rollup.RollupQuery(_stored_rollup(spark, sf_dir)).where(
        created_at="2024-01-01", created_at_end="2024-01-02"
    )
    means = chosen.all_means(binding.LABELS, binding.STATE_DOMAIN)
    return _rounded(means, "polarity", "subjectivity")


@register
def rollup_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = rollup.RollupQuery(_stored_rollup(spark, sf_dir)).where(
        phase=["Pre"], verified="True", possibly_sensitive="False"
    )
    return chosen.size()


# Result tables


@register
def mean_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.mean_captions(_all_means(spark, sf_dir)).drop("polarity", "subjectivity")


@register
def sentiment_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = binding.enriched_posts(spark, sf_dir, "sentiment_polarity")
    return posts.withColumn("band", texts.sentiment_band(F.col("sentiment_polarity")))


@register
def markers_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.exact_markers(
        binding.enriched_posts(spark, sf_dir, "latitude", "longitude", *MEASURED)
    )


@register
def markers_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.place_markers(
        binding.enriched_posts(
            spark, sf_dir, "place_latitude", "place_longitude", "place_name", *MEASURED
        )
    )


@register
def points_pol_subj(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.subjectivity_points(binding.enriched_posts(spark, sf_dir, *MEASURED))


@register
def points_label_pol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.label_points(binding.enriched_posts(spark, sf_dir, "aidr_label", *MEASURED))


@register
def points_state_pol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.state_points(binding.enriched_posts(spark, sf_dir, "place_state", *MEASURED))


@register
def result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = binding.enriched_posts(spark, sf_dir, *views.RESULT_COLUMNS)
    return views.result_table(posts).withColumn("date", _seconds("date"))


@register
def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five pages of a selection's result, 40 rows each, by date and id."""
    chosen = _query(spark, sf_dir, "date", "aidr_label").where(labels=["view", "click"]).rows()
    after, seen = None, []
    for number in range(1, 6):
        found = pages.page(chosen, 40, after, ("date", "id"))
        seen += [(number, row.id, row.date, row.aidr_label) for row in found.rows]
        after = found.after
        if after is None:
            break
    shown = spark.createDataFrame(seen, "page int, id long, date timestamp_ntz, aidr_label string")
    return shown.withColumn("date", _seconds("date"))


# Maps and charts whose size is theirs and not the posts'

DEEPEST = 8


def _pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = binding.enriched_posts(spark, sf_dir, "latitude", "longitude", *MEASURED)
    return tiles.tile_pyramid(posts, deepest=DEEPEST)


@register
def map_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = [f"sum_{name}" for name in ("polarity", "subjectivity", "latitude", "longitude")]
    return _pyramid(spark, sf_dir).withColumns({name: F.round(name, 6) for name in sums})


@register
def map_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of the stored pyramid with at most 200 markers, which level 4 gives."""
    path = new_path(spark)
    tiles.write_pyramid(_pyramid(spark, sf_dir), path)
    box = tiles.box_markers(spark.read.parquet(path), -90, -45, 90, 45, 200, DEEPEST)
    return _rounded(box, "latitude", "longitude", "polarity", "subjectivity")


@register
def density_pol_subj(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = density.density(binding.enriched_posts(spark, sf_dir, *MEASURED))
    sums = ("sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy")
    return cells.withColumns({name: F.round(name, 6) for name in sums})


@register
def density_label_pol(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = binding.enriched_posts(spark, sf_dir, "aidr_label", *MEASURED)
    return density.histogram(posts, "aidr_label").withColumn("total", F.round("total", 6))


@register
def density_state_pol(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = binding.enriched_posts(spark, sf_dir, "place_state", *MEASURED)
    return density.histogram(posts, "place_state").withColumn("total", F.round("total", 6))


@register
def correlation_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = binding.enriched_posts(spark, sf_dir, "aidr_label", *MEASURED)
    found = density.correlation(density.density(posts, by=["aidr_label"]), ["aidr_label"])
    return found.withColumn("correlation", F.round("correlation", 6))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter the posts, then report overall, label and state means with captions."""
    chosen = _query(spark, sf_dir, *FILTERED).where(phase=["Pre", "Durante"])
    return views.mean_captions(chosen.all_means(binding.LABELS, binding.STATE_DOMAIN))
