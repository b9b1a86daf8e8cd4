"""Golden edge cases of the enrichment: hand-written posts to derived columns."""

import random
from datetime import datetime, timedelta
from email.utils import parsedate_to_datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from crisis_posts.functions.dates import parse_post_date, phase
from crisis_posts.operators import enrich
from crisis_posts.schemas import ENRICHED, SENTIMENT
from crisis_posts.sources.labels import label_rejects, read_labels
from crisis_posts.sources.posts import read_enriched, read_raw_posts, write_enriched
from posts import LABEL_LINES, write_labels, write_raw


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return read_raw_posts(spark, write_raw(tmp_path_factory.mktemp("raw") / "posts"))


@pytest.fixture(scope="module")
def labels(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("labels") / "labels.txt"
    return read_labels(spark, write_labels(path, LABEL_LINES))


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(
        [("t", 0.5, 0.25), ("full", -1.0, 1.0)], "word string, polarity double, subjectivity double"
    )


def by_id(table):
    return {row.id: row for row in table.collect()}


WHEN = {
    1: ("t1", datetime(2017, 8, 16, 23, 59, 59), "TX", 0, 24, 29.5, -95.8),
    2: ("full2", datetime(2017, 8, 17), "TX", 1, 1, 29.5, -95.8),
    3: ("t3", datetime(2017, 9, 12), "DC", 1, 1, 29.5, -95.8),
    4: ("t4", datetime(2017, 9, 12, 0, 0, 1), None, 2, 1, 29.5, -95.8),
    5: ("t5", datetime(2017, 9, 13, 5, 8, 45), None, 2, 6, 29.5, -95.8),
    6: ("t6", datetime(2017, 9, 13, 23, 10), None, 2, 24, None, None),
    7: ("t7", datetime(2017, 9, 13, 23, 10), None, 2, 24, None, None),
    9: ("t9", None, None, None, None, 29.5, -95.8),
}


@pytest.fixture(params=["UTC", "America/Chicago"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_derived_columns(raw, zone):
    posts = by_id(enrich.derive_columns(enrich.drop_reposts(enrich.project_posts(raw))))
    broken = posts.pop(None)
    assert not any(broken)
    assert posts.keys() == WHEN.keys()
    for id, expected in WHEN.items():
        row = posts[id]
        found = (
            row.text, row.date, row.place_state, row.phase, row.timerange_end,
            row.place_latitude, row.place_longitude,
        )
        assert found == expected, id
    assert (posts[7].longitude, posts[7].latitude) == (-95.36, 29.76)
    assert posts[1].longitude is None and posts[7].place_name is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Sun Mar 12 02:30:00 +0000 2017", datetime(2017, 3, 12, 2, 30)),
        ("Wed, 13 Sep 2017 05:08:45 +0200", datetime(2017, 9, 13, 5, 8, 45)),
        ("13 September 2017 05:08:45 GMT", datetime(2017, 9, 13, 5, 8, 45)),
        ("Wed, 13 Sep 2017 05:08:45 +0200 (CEST)", datetime(2017, 9, 13, 5, 8, 45)),
        ("Wed Sep  3 05:08:45 2017", datetime(2017, 9, 3, 5, 8, 45)),
        ("wed, 3 sep 2017 5:08 +0000", datetime(2017, 9, 3, 5, 8)),
        ("May 13 05:08:45 2017", datetime(2017, 5, 13, 5, 8, 45)),
        ("Wed Feb 30 05:08:45 +0000 2017", None),
        ("Wed Sep 13 25:08:45 +0000 2017", None),
        ("Wed Sepp 13 05:08:45 +0000 2017", None),
        ("Wed Sep 13 05:08:45 +0000 xx17", None),
        ("2017-Sep-13 05:08:45", None),
        ("", None),
        (None, None),
    ],
)
def test_date_layouts(spark, zone, text, expected):
    table = spark.createDataFrame([(text,)], "created_at string")
    row = table.select(parse_post_date(F.col("created_at")).alias("d")).first()
    assert row.d == expected


def test_dates_equal_the_standard_mail_parser(spark):
    chance = random.Random(5)
    layouts = (
        "%a %b %d %H:%M:%S {} %Y",
        "%a, %d %b %Y %H:%M:%S {}",
        "%d %b %Y %H:%M:%S {}",
        "%a, %d %B %Y %H:%M:%S {}",
        "%a %b %d %H:%M:%S %Y",
        "%b %d %H:%M %Y",
    )
    texts = []
    for _ in range(600):
        moment = datetime(2000, 1, 1) + timedelta(seconds=chance.randrange(36 * 365 * 86_400))
        offset = chance.choice(["+0000", "-0600", "+0530", "+1400"])
        texts.append(moment.strftime(chance.choice(layouts)).format(offset))
    table = spark.createDataFrame([(text,) for text in texts], "t string")
    found = table.select("t", parse_post_date(F.col("t")).alias("d")).collect()
    for row in found:
        assert row.d == parsedate_to_datetime(row.t).replace(tzinfo=None), row.t


def test_phase_cuts_are_parameters(spark):
    table = spark.sql(
        "select explode(array(timestamp_ntz'2020-01-01 23:59:59', timestamp_ntz'2020-01-02',"
        " timestamp_ntz'2020-01-03', timestamp_ntz'2020-01-03 00:00:01', null)) as d"
    )
    phases = table.select(phase(F.col("d"), ("2020-01-02", "2020-01-03"))).collect()
    assert [row[0] for row in phases] == [0, 1, 1, 2, None]


def test_enrich_and_reload(spark, raw, labels, lexicon, tmp_path):
    enriched = enrich.enrich_posts(raw, labels, lexicon, keep_id=True)
    assert enriched.columns == ["id", *ENRICHED.names]
    rows = by_id(enriched)
    assert rows.keys() == WHEN.keys()
    assert rows[2].sentiment_polarity == -1.0 and rows[2].sentiment_subjectivity == 1.0
    assert rows[1].sentiment_polarity == 0.5 and rows[1].aidr_label == "label_1"
    for fmt in ("json", "parquet"):
        path = str(tmp_path / fmt)
        write_enriched(enriched, path, fmt, ["phase"] if fmt == "parquet" else [])
        again = read_enriched(spark, path, fmt, with_id=True)
        assert again.schema.simpleString() == enriched.schema.simpleString()
        assert by_id(again) == rows


def test_unlabelled_posts_drop_out_and_labels_multiply(spark, raw, lexicon):
    labels = spark.createDataFrame(
        [(1, "a"), (1, "b"), (None, "c"), (77, "d")], "id long, aidr_label string"
    )
    rows = enrich.enrich_posts(raw, labels, lexicon, keep_id=True).collect()
    assert sorted((row.id, row.aidr_label) for row in rows) == [(1, "a"), (1, "b")]
    assert "id" not in enrich.enrich_posts(raw, labels, lexicon).columns


def test_enrich_with_a_scorer(raw, labels):
    @F.pandas_udf(SENTIMENT)
    def scorer(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"polarity": texts.str.len() / 4, "subjectivity": 0.5})

    enriched = enrich.enrich_posts(raw, labels, scorer=scorer, keep_id=True)
    rows = by_id(enriched)
    assert rows.keys() == WHEN.keys()
    assert (rows[2].sentiment_polarity, rows[1].sentiment_polarity) == (1.25, 0.5)
    plan = enriched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_one_way_to_score(raw, labels, lexicon):
    with pytest.raises(ValueError):
        enrich.enrich_posts(raw, labels)
    with pytest.raises(ValueError):
        enrich.enrich_posts(raw, labels, lexicon, scorer=lambda text: text)


def test_rejects(raw):
    reasons = {row.id: row.reason for row in enrich.post_rejects(raw).collect()}
    assert reasons == {9: "unreadable date", None: "unreadable line"}


def test_label_file(spark, tmp_path):
    lines = ["id\tdate\tlabel\tconf", "1\tx\ta\t0.9", "2\ty\tb", "abc\tz\tc\t0.1",
             "id\tdate\tlabel\tconf", "3\t\t\t"]
    table = read_labels(spark, write_labels(tmp_path / "labels.txt", lines))
    rows = [tuple(row) for row in table.collect()]
    assert rows == [
        (1, "x", "a", "0.9"),
        (2, "y", "b", None),
        (None, "z", "c", "0.1"),
        (3, "", "", ""),
    ]
    assert [row.aidr_label for row in label_rejects(table).collect()] == ["c"]


def test_headers_are_found_per_file(spark, tmp_path):
    header = "id\tdate\tlabel\tconf"
    folder = tmp_path / "labels"
    folder.mkdir()
    (folder / "big.txt").write_text("".join(f"{i}\tx\ta\t0.5\n" for i in range(10, 40)))
    (folder / "small.txt").write_text(f"{header}\n5\tx\tb\t0.1\n")
    (folder / "other.txt").write_text("post\tday\tkind\tp\n6\tx\tc\t0.1\nabc\tx\td\t0.1\n")
    ids = sorted((row.id or -1) for row in read_labels(spark, str(folder)).collect())
    assert ids == [-1, 5, 6, *range(10, 40)]
    given = read_labels(spark, str(folder), header).collect()
    assert sorted((row.id or -1) for row in given) == [-1, -1, 5, 6, *range(10, 40)]


def test_rejects_list_unreadable_fields_and_missing_ids(spark, tmp_path):
    date = "Fri Aug 25 10:00:00 +0000 2017"
    lines = [
        '{"id":1,"text":"a","created_at":"%s","favorite_count":"many"}' % date,
        '{"text":"b","created_at":"%s","favorite_count":1}' % date,
        '{"id":3,"text":"c","created_at":"%s","favorite_count":1}' % date,
        "no json",
    ]
    (tmp_path / "posts.json").write_text("\n".join(lines))
    rows = enrich.post_rejects(read_raw_posts(spark, str(tmp_path / "posts.json"))).collect()
    assert sorted((row.id or 0, row.reason) for row in rows) == [
        (0, "no id"), (0, "unreadable line"), (1, "unreadable field"),
    ]


def test_a_scorer_sees_labelled_posts_only(spark, raw, labels):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("struct<polarity: double, subjectivity: double>")
    def scorer(texts: pd.Series) -> pd.DataFrame:
        seen.add(len(texts))
        return pd.DataFrame({"polarity": texts.str.len() / 1.0, "subjectivity": texts.str.len() / 1.0})

    found = enrich.enrich_posts(raw, labels, scorer=scorer, keep_id=True).collect()
    assert seen.value <= len({row.id for row in found})


def test_empty_label_file(spark, tmp_path):
    (tmp_path / "none.txt").write_text("")
    assert read_labels(spark, str(tmp_path / "none.txt")).count() == 0
