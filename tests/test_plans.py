"""Shape of the plans: what reaches the scan, what is shuffled, how hot keys are split."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from crisis_posts.operators import enrich, mentions, scope, sentiment
from crisis_posts.operators.selection import PostQuery
from crisis_posts.plans import binding
from crisis_posts.plans.catalog import QUERIES
from crisis_posts.sources.posts import read_enriched, read_raw_posts, write_enriched
from posts import write_raw

SF_DIR = "/root/testdata/sf0.001"


def initial_plan(table):
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("enriched") / "t")
    posts = enrich.enrich_posts(
        binding.raw_posts(spark, SF_DIR),
        binding.enriched_posts(spark, SF_DIR, "aidr_label"),
        binding.lexicon(spark),
        states=binding.STATES,
        phase_cuts=binding.PHASE_CUTS,
    )
    write_enriched(posts, path, partition_by=["phase"])
    return read_enriched(spark, path)


# The tagger decodes runs of capitals in one Arrow function; it holds arrays of back pointers.
IN_PYTHON = {"tag_names"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    plan = initial_plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "from_json"):
        assert bad not in plan
    assert plan.count("EvalPython") == (name in IN_PYTHON)
    assert "Python" not in plan or name in IN_PYTHON


def test_reposts_are_dropped_by_the_scan(spark, tmp_path):
    raw = read_raw_posts(spark, write_raw(tmp_path / "posts"))
    labels = spark.createDataFrame([(1, "a")], "id long, aidr_label string")
    lexicon = binding.lexicon(spark)
    plan = initial_plan(enrich.enrich_posts(raw, labels, lexicon))
    assert "PushedFilters: [IsNull(retweeted_status), IsNotNull(id)]" in plan
    assert plan.count("FileScan json") == 1
    assert plan.count("regexp_extract_all") == 1


def test_day_filter_and_columns_reach_the_scan(stored, settings):
    settings(maxMetadataStringLength="1000")
    chosen = PostQuery(stored).where(created_at="2024-01-01", labels=["view"])
    plan = initial_plan(chosen.means())
    assert "GreaterThanOrEqual(date,2024-01-01T00:00)" in plan
    assert "LessThan(date,2024-01-02T00:00)" in plan
    assert (
        "ReadSchema: struct<date:timestamp_ntz,sentiment_polarity:double,"
        "sentiment_subjectivity:double,aidr_label:string>"
    ) in plan


def test_phase_filter_prunes_partitions(stored):
    plan = initial_plan(PostQuery(stored).where(phase=["Pre"]).size())
    assert "PartitionFilters: [isnotnull(phase" in plan or "PartitionFilters: [(phase" in plan
    assert "ReadSchema: struct<>" in plan


def test_all_means_scan_once(stored):
    plan = initial_plan(PostQuery(stored).all_means(["view"], ["N1"]))
    assert plan.count("FileScan") == 1
    # The rows are reduced to sums before the groups are formed.
    assert plan.index("Expand") < plan.index("partial_sum(sentiment_polarity")


def test_hot_id_is_split_by_the_adaptive_join(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="40",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        adaptive__advisoryPartitionSizeInBytes="50k",
        adaptive__coalescePartitions__enabled="false",
    )
    n = 60_000
    posts = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    labels = spark.range(n).select("id", (F.col("id") % 4).cast("string").alias("aidr_label"))
    joined = enrich.join_labels(posts, labels)
    rows = joined.collect()
    assert "SortMergeJoin(skew=true)" in initial_plan(joined)
    found = Counter((row.id, row.aidr_label) for row in rows)
    expected = Counter(7 if i % 3 == 0 else i for i in range(n))
    assert found == Counter({(i, str(i % 4)): k for i, k in expected.items()})


def test_hot_text_scores_alike_on_both_paths(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", shuffle__partitions="16")
    posts = spark.range(0, 20_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "the storm of the year, the worst of all")
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("in the "), F.sha2(F.col("id").cast("string"), 256)))
        .alias("text"),
    )
    lexicon = binding.lexicon(spark)
    constant = sentiment.with_lexicon_sentiment(posts, lexicon)
    joined = sentiment.with_lexicon_sentiment(posts, lexicon, max_rows=0)
    assert "SortMergeJoin" in initial_plan(joined)
    assert "Join" not in initial_plan(constant).split("Subquery")[0]
    again = joined.select(
        "id",
        F.col("sentiment_polarity").alias("p"),
        F.col("sentiment_subjectivity").alias("s"),
    )
    both = constant.join(again, "id")
    assert both.count() == 20_000
    same = F.col("p").eqNullSafe(F.col("sentiment_polarity")) & F.col("s").eqNullSafe(
        F.col("sentiment_subjectivity")
    )
    assert both.filter(~same).count() == 0
    unscored = joined.filter("sentiment_polarity is null").count()
    assert unscored == posts.filter("text is null").count() > 0


def test_a_million_words_are_cut_to_those_that_occur(spark):
    posts = spark.range(0, 2_000, 1, 8).selectExpr("id", "concat('good storm, the ', id) as text")
    known = spark.createDataFrame(
        [("the", 0.1, 0.2), ("good", 0.7, 0.3)], "word string, polarity double, subjectivity double"
    )
    strange = spark.range(1_000_000).selectExpr("concat('w', id)", "1.0d", "0.5d")
    cut = sentiment.with_lexicon_sentiment(posts, known.union(strange))
    main = initial_plan(cut).split("Subquery")[0]
    assert "Join" not in main and "Exchange" not in main and "Generate" not in main
    small = sentiment.with_lexicon_sentiment(posts, known)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, small.collect()))


def test_rows_are_sorted_within_a_file(spark, stored, tmp_path):
    path = str(tmp_path / "sorted")
    write_enriched(stored.repartition(2, "name"), path, partition_by=["phase"], sort_by=["date"])
    files = [str(file) for file in (tmp_path / "sorted").glob("*/*.parquet")]
    assert len(files) >= 2
    for file in files:
        dates = [row.date for row in spark.read.parquet(file).select("date").collect()]
        assert dates == sorted(dates, key=lambda d: (d is not None, d))


def test_hot_name_is_counted_before_the_shuffle(spark):
    n = 30_000
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    posts = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "Harvey, harvey Irma, HARVEY!")
        .otherwise(F.concat(F.lit("Name"), letters))
        .alias("text")
    )
    gazetteer = spark.createDataFrame([("Harvey", "PER")], "entity string, type string")
    counts = mentions.text_mention_counts(posts, gazetteer)
    found = {(r.Entity, r.Type): r["count"] for r in counts.collect()}
    assert found.pop(("Harvey", "MISC")) == 2 * (n // 3)
    assert found.pop(("Irma", "MISC")) == n // 3
    assert len(found) == n - n // 3 and set(found.values()) == {1}
    plan = initial_plan(mentions.text_mention_counts(posts, gazetteer))
    assert "partial_count(1)" in plan


def _columns_joined(table):
    """The names and types of the columns that meet in the joins of a plan."""
    found, nodes = [], [table._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            for child in children:
                out = child.output()
                own = [out.apply(i) for i in range(out.size())]
                found.append({a.name(): a.dataType().simpleString() for a in own})
        nodes += children
    return found


def test_a_joined_look_up_moves_each_text_once_and_none_of_its_words(spark):
    posts = spark.createDataFrame([(1, "The not of the and in"), (2, None)], "id int, text string")
    for scored in (
        scope.with_scoped_sentiment(
            posts, binding.scoped_lexicon(spark), binding.modifiers(spark), max_rows=0
        ),
        sentiment.with_lexicon_sentiment(posts, binding.lexicon(spark), max_rows=0),
        mentions.extract_mentions(posts, binding.gazetteer(spark), max_rows=0),
    ):
        sides = _columns_joined(scored)
        assert sum("text" in side for side in sides) == 1
        assert not any(kind == "array<string>" for side in sides for kind in side.values())
