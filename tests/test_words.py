"""Sentiment and mentions against plain Python, on both look-up paths."""

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pytest
from pyspark.sql import functions as F

from crisis_posts.operators import mentions, sentiment, wordtable
from crisis_posts.schemas import MENTIONS, SENTIMENT
from crisis_posts.sources import tables

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"
BOTH_PATHS = pytest.mark.parametrize("max_rows", [50_000, 0])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(DOCUMENTS).select("doc_id", "text")


@pytest.fixture(scope="module")
def texts(documents):
    return {row.doc_id: row.text for row in documents.collect()}


@BOTH_PATHS
def test_lexicon_scores(spark, documents, texts, max_rows):
    vocabulary = sorted({w for t in texts.values() for w in re.findall(r"[^\W\d_]+", t.lower())})
    lexicon = {w: (len(w) / 10 - 0.5, i % 7 / 7) for i, w in enumerate(vocabulary) if i % 3}
    rows = [(word, *values) for word, values in lexicon.items()]
    table = spark.createDataFrame(rows, "word string, polarity double, subjectivity double")
    scored = sentiment.with_lexicon_sentiment(documents, table, max_rows=max_rows)
    assert scored.columns == ["doc_id", "text", "sentiment_polarity", "sentiment_subjectivity"]
    rows = scored.collect()
    assert len(rows) == len(texts)
    for row in rows:
        hits = [lexicon[w] for w in re.findall(r"[^\W\d_]+", row.text.lower()) if w in lexicon]
        for i, found in enumerate((row.sentiment_polarity, row.sentiment_subjectivity)):
            mean = sum(hit[i] for hit in hits) / len(hits) if hits else 0.0
            assert found == pytest.approx(mean, abs=1e-9)


@BOTH_PATHS
def test_score_edges(spark, max_rows):
    posts = spark.createDataFrame(
        [(1, "GOOD good bad"), (2, "nothing"), (3, ""), (4, None), (5, "GOOD good bad")],
        "id long, text string",
    )
    lexicon = spark.createDataFrame(
        [("Good", 1.0, 0.5), ("good", 0.5, 0.5), ("bad", -1.0, 1.0), (None, 9.0, 9.0),
         ("nothing", None, 0.3)],
        "word string, polarity double, subjectivity double",
    )
    scored = sentiment.with_lexicon_sentiment(posts, lexicon, max_rows=max_rows).collect()
    found = {row.id: row.sentiment_polarity for row in scored}
    assert found == {1: pytest.approx(0.5 / 3), 2: 0.0, 3: 0.0, 4: None, 5: pytest.approx(0.5 / 3)}
    empty = sentiment.with_lexicon_sentiment(posts, lexicon.limit(0), max_rows=max_rows)
    assert {row.sentiment_polarity for row in empty.collect()} == {0.0, None}


def test_a_large_table_is_not_sent_with_the_tasks(spark, documents, texts):
    vocabulary = sorted({w for t in texts.values() for w in re.findall(r"[^\W\d_]+", t.lower())})
    lexicon = spark.createDataFrame(
        [(word, 1.0, 0.5) for word in vocabulary[:30]],
        "word string, polarity double, subjectivity double",
    )
    scored = sentiment.with_lexicon_sentiment(documents, lexicon, max_rows=29)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan
    fits = sentiment.with_lexicon_sentiment(documents, lexicon, max_rows=30)
    plan = fits._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "Generate" not in plan.split("Subquery")[0]


def test_size_is_counted_in_rows_and_bytes(spark):
    table = spark.createDataFrame([("a" * 600, 1.0), ("b" * 600, 2.0)], "word string, value double")
    assert wordtable.rows_if_small(table, "word") == 2
    assert wordtable.rows_if_small(table, "word", max_rows=1) is None
    assert wordtable.rows_if_small(table, "word", max_bytes=1000) is None
    assert wordtable.rows_if_small(table.limit(0), "word") == 0


def capitalized_runs(text):
    """Whole words that begin with a capital and are no single letter, joined over one space."""
    words = [m for m in re.finditer(r"[^\W\d_]+", text)]
    runs, end = [], None
    for m in words:
        if m[0][0].isupper() and len(m[0]) > 1:
            if end is not None and text[end : m.start()] == " ":
                runs[-1] += " " + m[0]
            else:
                runs.append(m[0])
            end = m.end()
        else:
            end = None
    return runs


def test_names_are_whole_words_and_runs_of_them(spark):
    text = "José saw Élan in New York, HARVEY hit; Hurricane Harvey. iPhone A McDonald ‘Ción’ x9Y"
    posts = spark.createDataFrame([(1, text)], "id long, text string")
    found = mentions.extract_mentions(posts, spark.createDataFrame([("New York", "LOC")], "entity string, type string"))
    row = found.first()
    assert [m.entity for m in row.entities] == [
        "José", "Élan", "New York", "HARVEY", "Hurricane Harvey", "McDonald", "Ción",
    ]
    assert [m.type for m in row.entities][2] == "LOC"
    counts = {(r.Entity, r.Type): r["count"] for r in mentions.text_mention_counts(
        posts, spark.createDataFrame([], "entity string, type string")).collect()}
    assert counts["Harvey", "MISC"] == 2


def test_no_name_or_word_is_part_of_a_longer_one(spark, documents, texts):
    gazetteer = spark.createDataFrame([], "entity string, type string")
    for row in mentions.extract_mentions(documents, gazetteer).collect():
        text, at = texts[row.doc_id], 0
        for mention in row.entities:
            at = text.index(mention.entity, at)
            while text[max(at - 1, 0) : at].isalpha() or text[at + len(mention.entity) :][:1].isalpha():
                at = text.index(mention.entity, at + 1)
            at += len(mention.entity)


@BOTH_PATHS
def test_mentions(spark, documents, texts, max_rows):
    known = {"The": "ART", "Of": "PREP"}
    gazetteer = spark.createDataFrame(list(known.items()), "entity string, type string")
    rows = mentions.extract_mentions(documents, gazetteer, max_rows=max_rows).collect()
    assert len(rows) == len(texts)
    counts = Counter()
    for row in rows:
        expected = [(n, known.get(n, "MISC")) for n in capitalized_runs(texts[row.doc_id])]
        assert [tuple(m) for m in row.entities] == expected
        counts.update(expected)
    table = mentions.mention_counts(
        mentions.explode_mentions(mentions.extract_mentions(documents, gazetteer))
    )
    assert {(r.Entity, r.Type): r["count"] for r in table.collect()} == counts
    at_once = mentions.text_mention_counts(documents, gazetteer, rules=())
    assert {(r.Entity, r.Type): r["count"] for r in at_once.collect()} == counts


def test_mentions_of_missing_text(spark):
    posts = spark.createDataFrame([(1, None), (2, "no names")], "id long, text string")
    gazetteer = spark.createDataFrame([], "entity string, type string")
    for max_rows in (50_000, 0):
        found = mentions.extract_mentions(posts, gazetteer, max_rows=max_rows)
        assert [(row.id, row.entities) for row in found.collect()] == [(2, [])]
        assert mentions.explode_mentions(found).count() == 0


def test_canonical_names(spark):
    rows = [
        ("HURRICANE Harvey", "PER"), ("harvey", "LOC"), ("IRMA", "PER"), ("Irma", "PER"),
        ("Hurricane Irma", "PER"), ("#Harvey", "X"), ("harvey ", "LOC"), ("Harvey", "ORG"),
    ]
    table = spark.createDataFrame(rows, "Entity string, Type string")
    found = [tuple(row) for row in mentions.canonical_mentions(table).collect()]
    assert found == [
        ("Harvey", "MISC"), ("Harvey", "MISC"), ("Irma", "MISC"), ("Irma", "MISC"),
        ("Hurricane Irma", "PER"), ("#Harvey", "X"), ("harvey ", "LOC"), ("Harvey", "MISC"),
    ]


def test_empty_and_null_lists_have_no_mentions(spark):
    posts = spark.createDataFrame(
        [([],), (None,), ([("Houston", "LOC"), ("Houston", "LOC")],)],
        "entities array<struct<entity: string, type: string>>",
    )
    found = mentions.explode_mentions(posts).collect()
    assert [tuple(row) for row in found] == [("Houston", "LOC")] * 2


def test_merge_reads_both_spellings(spark, tmp_path):
    runs = tmp_path / "runs"
    for i, text in enumerate(
        [
            '{"Entity":"Harvey","Type":"MISC","count":2}\n',
            '{"entity":"Harvey","type":"MISC","count":3}\n'
            '{"entity":"Houston","type":"LOC","count":1}\n',
            '{"entity":"Austin","type":"LOC","count":1}\n',
        ]
    ):
        (runs / f"run{i}").mkdir(parents=True)
        (runs / f"run{i}" / "part-0.json").write_text(text)
    totals = mentions.merge_counts(tables.read_entity_counts(spark, f"{runs}/*"))
    expected = [("Harvey", "MISC", 5), ("Austin", "LOC", 1), ("Houston", "LOC", 1)]
    assert totals.columns == ["entity", "type", "total_count"]
    assert [tuple(row) for row in totals.collect()] == expected
    path = str(tmp_path / "totals")
    tables.write_entity_totals(totals, path)
    again = mentions.entity_table(tables.read_entity_totals(spark, path))
    assert sorted(tuple(row) for row in again.collect()) == sorted(expected)


def test_bad_count_lines_stop_the_merge_or_are_listed(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"entity":"Austin","type":"LOC","count":1}\nbroken\n{"entity":"B","type":"X","count":"x"}\n'
    )
    path = str(tmp_path / "a.json")
    with pytest.raises(Exception, match="unreadable entity count: broken"):
        mentions.merge_counts(tables.read_entity_counts(spark, path)).collect()
    kept = tables.read_entity_counts(spark, path, skip_bad=True).collect()
    assert [tuple(row) for row in kept] == [("Austin", "LOC", 1)]
    assert tables.count_rejects(spark, path).count() == 2


def test_a_field_in_two_spellings_is_no_count(spark, tmp_path):
    lines = [
        '{"Entity": "a", "entity": "b", "Type": "X", "count": 2}',
        '{"ENTITY": "c", "type": "X", "Count": 3}', '{"entity": "d", "entity": "e", "count": 4}',
        '{"entity": "f", "type": "X", "count": 1, "Count": 5}', "[]", "",
    ]
    (tmp_path / "counts").mkdir()
    (tmp_path / "counts" / "part.json").write_text("\n".join(lines) + "\n")
    read = tables.read_entity_counts(spark, str(tmp_path / "counts"), skip_bad=True)
    assert [tuple(row) for row in read.collect()] == [("c", "X", 3)]
    rejects = [row.value for row in tables.count_rejects(spark, str(tmp_path / "counts")).collect()]
    assert sorted(rejects) == sorted([lines[0], *lines[2:]])


def test_counts_in_parquet_merge_like_json(spark, documents, tmp_path):
    counts = mentions.text_mention_counts(documents, spark.createDataFrame([], "entity string, type string"))
    found = []
    for fmt in ("json", "parquet"):
        tables.write_entity_counts(counts, str(tmp_path / fmt), fmt)
        read = tables.read_entity_counts(spark, str(tmp_path / fmt), fmt)
        found.append([tuple(row) for row in mentions.merge_counts(read).collect()])
    assert found[0] == found[1] and found[0]


def test_word_tables_are_read_by_name(spark, tmp_path):
    (tmp_path / "l.csv").write_text("word,subjectivity,polarity\ngood,0.25,0.5\n")
    assert tuple(tables.read_lexicon(spark, str(tmp_path / "l.csv")).first()) == ("good", 0.5, 0.25)
    (tmp_path / "g.csv").write_text("type,entity\nLOC,New York\n")
    assert tuple(tables.read_gazetteer(spark, str(tmp_path / "g.csv")).first()) == ("New York", "LOC")
    (tmp_path / "bad.csv").write_text("name,kind\nx,y\n")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        tables.read_gazetteer(spark, str(tmp_path / "bad.csv")).collect()


def test_merged_parts_equal_the_whole(spark, documents, tmp_path):
    gazetteer = spark.createDataFrame([("The", "ART")], "entity string, type string")
    whole = mentions.text_mention_counts(documents, gazetteer)
    for i in (0, 1):
        part = documents.filter(F.col("doc_id") % 2 == i)
        tables.write_entity_counts(
            mentions.text_mention_counts(part, gazetteer), str(tmp_path / f"run{i}")
        )
    merged = mentions.merge_counts(tables.read_entity_counts(spark, str(tmp_path / "run*")))
    assert {tuple(row) for row in merged.collect()} == {tuple(row) for row in whole.collect()}


def test_plugged_in_scorer_and_tagger(spark):
    @F.pandas_udf(SENTIMENT)
    def scorer(texts: pd.Series) -> pd.DataFrame:
        size = texts.str.len()
        return pd.DataFrame({"polarity": size / 10, "subjectivity": size / 100})

    @F.pandas_udf(MENTIONS)
    def tagger(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kind = "W"  # where a model would be loaded, once for each task
        for texts in batches:
            yield texts.map(lambda t: [{"entity": w, "type": kind} for w in t.split()])

    posts = spark.createDataFrame([(1, "irma irma x"), (2, None), (3, "")], "id long, text string")
    scored = sentiment.with_scorer_sentiment(posts, scorer)
    found = [(r.id, r.sentiment_polarity, r.sentiment_subjectivity) for r in scored.collect()]
    assert found == [(1, 1.1, 0.11), (2, None, None), (3, 0.0, 0.0)]
    rows = mentions.explode_mentions(mentions.tag_mentions(posts, tagger))
    counts = mentions.mention_counts(mentions.canonical_mentions(rows))
    assert {tuple(r) for r in counts.collect()} == {("Irma", "MISC", 2), ("x", "W", 1)}
    for table in (scored, counts):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_a_replayed_run_changes_no_total(spark, documents, tmp_path, fmt):
    gazetteer = spark.createDataFrame([("The", "ART")], "entity string, type string")
    path = str(tmp_path / "runs")
    parts = {f"part {i}": documents.filter(f"doc_id % 3 = {i}") for i in range(3)}
    for run in ("part 0", "part 1", "part 2", "part 1", "part 0"):
        counts = mentions.text_mention_counts(parts[run], gazetteer)
        tables.write_entity_counts(counts, path, fmt, run)
    whole = mentions.text_mention_counts(documents, gazetteer)
    totals = mentions.merge_counts(tables.read_entity_counts(spark, path, fmt))
    assert {tuple(r) for r in totals.collect()} == {tuple(r) for r in whole.collect()}
    assert {row.run for row in tables.counted_runs(spark, path, fmt).collect()} == set(parts)
    # A run replaced by one without counts counts for nothing.
    tables.write_entity_counts(whole.limit(0), path, fmt, "part 2")
    left = mentions.merge_counts(tables.read_entity_counts(spark, path, fmt))
    some = mentions.text_mention_counts(parts["part 0"].union(parts["part 1"]), gazetteer)
    assert {tuple(r) for r in left.collect()} == {tuple(r) for r in some.collect()}
