"""The batch jobs end to end, through the command line."""

import json
import sys
from collections import Counter

import pytest

from crisis_posts import __main__ as command
from crisis_posts.operators.rollup import RollupQuery, read_rollup
from crisis_posts.operators.selection import PostQuery
from crisis_posts.sources.posts import read_enriched
from crisis_posts.sources.tables import counted_runs, read_entity_counts, read_entity_totals
from posts import LABEL_LINES, write_labels, write_raw


@pytest.fixture
def run(monkeypatch):
    def start(*arguments):
        monkeypatch.setattr(sys, "argv", ["crisis_posts", *map(str, arguments)])
        command.main()

    return start


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_posts_to_totals(spark, run, tmp_path, fmt):
    raw = write_raw(tmp_path / "dataset")
    labels = write_labels(tmp_path / "labels.txt", LABEL_LINES)
    (tmp_path / "lexicon.csv").write_text("word,polarity,subjectivity\nt,0.5,0.25\nfull,-1.0,1.0\n")
    (tmp_path / "gazetteer.csv").write_text("entity,type\nHouston,LOC\n")
    out = tmp_path / "output"
    run(
        "enrich", raw, labels, tmp_path / "lexicon.csv", out,
        "--fmt", fmt, "--by-phase", "--by-date", "--rejects", tmp_path / "rejects",
    )
    posts = read_enriched(spark, str(out), fmt)
    assert posts.count() == 8
    assert PostQuery(posts).where(phase=["Durante"], place=["TX"]).rows().first().text == "full2"
    assert PostQuery(posts).where(created_at="2017-09-12").size().first().n == 2
    for batch in ("first", "first"):
        run("rollup", out, tmp_path / "cells", batch, "--fmt", fmt)
    cells = RollupQuery(read_rollup(spark, str(tmp_path / "cells")))
    assert cells.where(created_at="2017-09-12").size().first().n == 2
    rejects = [
        json.loads(line)["reason"]
        for file in (tmp_path / "rejects").glob("*.json")
        for line in file.read_text().splitlines()
    ]
    assert sorted(rejects) == ["unreadable date", "unreadable line"]

    named = posts.drop("text").selectExpr("*", "'Houston irma Houston' as text")
    named.write.mode("overwrite").format(fmt).save(str(tmp_path / "named"))
    runs = tmp_path / "runs"
    gazetteer = tmp_path / "gazetteer.csv"
    for name in ("first of two", "2", "2"):  # one run is replayed
        run("entities", tmp_path / "named", gazetteer, runs, "--fmt", fmt, "--run", name)
    listed = {row.run: row.lines for row in counted_runs(spark, str(runs)).collect()}
    assert listed == {"first of two": 1, "2": 1}
    counts = Counter()
    for row in read_entity_counts(spark, str(runs)).collect():
        counts[row.entity, row.type] += row["count"]
    assert counts == {("Houston", "LOC"): 2 * 2 * 8}
    run("entities", tmp_path / "named", gazetteer, tmp_path / "learned", "--fmt", fmt, "--learned")
    learned = read_entity_counts(spark, str(tmp_path / "learned")).collect()
    assert [(row.entity, row.type, row["count"]) for row in learned] == [("Houston", "LOC", 16)]
    run("merge", runs, tmp_path / "final")
    totals = read_entity_totals(spark, str(tmp_path / "final")).collect()
    assert [tuple(row) for row in totals] == [("Houston", "LOC", 32)]
