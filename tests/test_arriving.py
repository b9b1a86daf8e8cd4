"""Posts enriched file by file: the rows of one batch, whatever the runs and batches."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from crisis_posts.operators.enrich import enrich_posts
from crisis_posts.sources.posts import read_enriched, read_raw_posts, stream_raw_posts
from crisis_posts.streaming.arriving import enrich_arriving
from posts import RAW

LABELS = [(i, f"l{i % 2}") for i in range(1, 10)] + [(2, "again"), (99, "none")]
WORDS = [("t1", 0.5, 0.25), ("full", -0.5, 1.0)]


@pytest.fixture(scope="module")
def sides(spark):
    return (
        spark.createDataFrame(LABELS, "id long, aidr_label string"),
        spark.createDataFrame(WORDS, "word string, polarity double, subjectivity double"),
    )


def arrive(directory, name, records, extra=()):
    directory.mkdir(exist_ok=True)
    lines = [*map(json.dumps, records), *extra]
    (directory / f"{name}.json").write_text("".join(f"{line}\n" for line in lines))


def rows(table):
    return sorted(map(repr, table.collect()))


def run(spark, raw, output, sides, max_files=None, **options):
    enrich_arriving(stream_raw_posts(spark, str(raw), max_files), str(output), *sides, keep_id=True, **options)
    return rows(read_enriched(spark, str(output), with_id=True))


def whole(spark, raw, sides):
    return rows(enrich_posts(read_raw_posts(spark, str(raw)), *sides, keep_id=True))


@pytest.mark.parametrize("max_files", [None, 1])
def test_runs_add_up_to_one_batch_and_a_rerun_adds_none(spark, tmp_path, sides, max_files):
    raw, output = tmp_path / "raw", tmp_path / "out"
    arrive(raw, "a", RAW[:3])
    arrive(raw, "b", RAW[3:5], ["not json"])
    first = run(spark, raw, output, sides, max_files)
    assert first == whole(spark, raw, sides) and len(first) == 6
    assert run(spark, raw, output, sides, max_files) == first
    arrive(raw, "c", RAW[5:])
    arrive(raw, "d", RAW[:1])  # a post that comes again is a post again, as in one batch
    arrive(raw, "e", [])
    second = run(spark, raw, output, sides, max_files)
    assert second == whole(spark, raw, sides) and len(second) > len(first)


def test_a_late_old_file_is_read(spark, tmp_path, sides):
    raw, output = tmp_path / "raw", tmp_path / "out"
    arrive(raw, "a", RAW[:3])
    run(spark, raw, output, sides)
    arrive(raw, "old", RAW[3:5])
    os.utime(raw / "old.json", (0, 0))
    assert run(spark, raw, output, sides) == whole(spark, raw, sides)


def test_a_batch_killed_before_its_commit_is_done_again_once(spark, tmp_path, sides):
    raw, output = tmp_path / "raw", tmp_path / "out"
    arrive(raw, "a", RAW[:3])
    run(spark, raw, output, sides)
    arrive(raw, "b", RAW[3:])
    expected = run(spark, raw, output, sides)
    # As if the run had died: between writing the files and noting them, or just after that.
    for notes in (["_offsets/commits"], ["_offsets/commits", "_spark_metadata"]):
        for folder in notes:
            (output / folder / "1").unlink()
            (output / folder / ".1.crc").unlink(missing_ok=True)
        assert run(spark, raw, output, sides) == expected == whole(spark, raw, sides)


def test_what_cannot_stream_raises(spark, tmp_path, sides):
    raw = tmp_path / "raw"
    arrive(raw, "a", RAW)
    with pytest.raises(ValueError, match="no stream"):
        enrich_arriving(read_raw_posts(spark, str(raw)), str(tmp_path / "o"), *sides)
    with pytest.raises(ValueError, match="travel"):
        run(spark, raw, tmp_path / "o", sides, max_words=1)


def test_empty_folder_then_posts(spark, tmp_path, sides):
    raw, output = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    enrich_arriving(stream_raw_posts(spark, str(raw)), str(output), *sides, keep_id=True)
    arrive(raw, "a", RAW)
    assert run(spark, raw, output, sides) == whole(spark, raw, sides)


def test_jobs_from_the_command_line(spark, tmp_path):
    arrive(tmp_path / "raw", "a", RAW)
    (tmp_path / "labels.tsv").write_text("id\tdate\taidr_label\taidr_confidence\n" + "".join(f"{i}\td\tpersonal\t1\n" for i in range(1, 9)))
    (tmp_path / "lexicon.csv").write_text("word,polarity,subjectivity\nt1,0.5,0.5\n")

    def job(*arguments):
        done = subprocess.run(
            [sys.executable, "-m", "crisis_posts", *map(str, arguments)],
            cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=300,
        )
        assert done.returncode == 0, done.stderr[-3000:]

    paths = [tmp_path / name for name in ("raw", "labels.tsv", "lexicon.csv", "out")]
    job("arriving", *paths, "--max-files", 1)
    posts = read_enriched(spark, str(tmp_path / "out"))
    assert posts.count() == 7
    job("cluster", tmp_path / "out", tmp_path / "clustered", 2)
    assert rows(read_enriched(spark, str(tmp_path / "clustered"))) == rows(posts)
    job("tiles", tmp_path / "out", tmp_path / "tiles", "--places", "--deepest", 3)
    levels = spark.read.parquet(str(tmp_path / "tiles")).groupBy("level").sum("n").collect()
    assert {r[0] for r in levels} == {0, 1, 2, 3} and len({r[1] for r in levels}) == 1


def test_the_registered_query_stores_less_than_its_texts(spark, tmp_path, monkeypatch):
    from crisis_posts.plans import binding, catalog

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(catalog, "new_path", lambda _: str(tmp_path))
    assert catalog.QUERIES["enrich_arriving"](spark, folder).count()
    stored = sum(f.stat().st_size for f in (tmp_path / "raw").glob("part-*"))
    written = binding.raw_posts(spark, folder).selectExpr("sum(length(text))").first()[0]
    assert 0 < stored < written
