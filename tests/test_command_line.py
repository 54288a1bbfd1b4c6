"""The command line runs the same jobs."""

from __future__ import annotations

import uuid

import pytest

from reelhouse import __main__ as command
from reelhouse import schemas
from reelhouse.registry import inputs
from tests.test_daily import export


def run(spark, *words):
    command.run(spark, command.parser().parse_args(words))


def test_step_by_step(spark, sf_dir, folder):
    database = f"steps_{uuid.uuid4().hex}"
    feeds = []
    for feed in export(spark, sf_dir, folder):
        feeds += ["--feed", feed.platform, feed.titles, feed.credits]
    topics, lake = ["--topic-folder", f"{folder}/topics"], ["--lake", f"{folder}/lake"]
    run(spark, "ingest", *feeds, *topics)
    run(spark, "bronze", *topics, *lake, "--window-secs", "0")
    run(spark, "transform", *lake, "--database", database, "--snapshot-date", "2024-03-01", "--replace-day")
    titles = spark.table(f"{database}.{schemas.TRANSFORMED_TITLES}")
    expected = inputs.bronze_titles(spark, sf_dir).where("id IS NOT NULL AND title IS NOT NULL")
    assert titles.count() == expected.selectExpr("trim(id)", "trim(platform)").distinct().count()
    # A second bronze run and the daily run share the checkpoints: nothing is read twice.
    run(spark, "bronze", *topics, *lake)
    assert spark.read.parquet(f"{folder}/lake/ott_titles").count() == inputs.bronze_titles(spark, sf_dir).count()


def test_password_comes_from_the_environment(monkeypatch):
    monkeypatch.setenv("CATALOGUE_PASSWORD", "hidden")
    arguments = command.parser().parse_args(
        ["publish", "--jdbc-url", "jdbc:mysql://db/ott", "--jdbc-user", "me", "--jdbc-password-env", "CATALOGUE_PASSWORD"]
    )
    assert command._target(arguments).password == "hidden"
    assert "hidden" not in repr(arguments)


@pytest.mark.parametrize("words", [["ingest"], ["bronze", "--lake", "x"], ["publish"], []])
def test_missing_arguments_are_refused(words):
    with pytest.raises(SystemExit):
        command.parser().parse_args(words)
