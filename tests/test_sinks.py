"""Snapshots and tables, and publishing with its failure cases (in-memory Derby)."""

from __future__ import annotations

import datetime
import pathlib
import uuid

import pytest
from py4j.protocol import Py4JJavaError

from reelhouse import schemas
from reelhouse.sinks import jdbc
from reelhouse.sinks.snapshots import write_snapshot
from reelhouse.sinks.tables import create_database, write_table

DAY = datetime.date(2024, 3, 1)


@pytest.fixture
def target():
    return jdbc.JdbcTarget(f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver")


def frame(spark, *rows, ddl="id string, n int"):
    return spark.createDataFrame(list(rows), ddl)


def published(spark, target, table="t"):
    rows = spark.read.format("jdbc").options(**target.options()).option("dbtable", table).load().collect()
    return sorted(tuple(row) for row in rows)


# --- snapshots ---------------------------------------------------------------------


def test_append_doubles_a_day_that_runs_twice(spark, folder):
    df = frame(spark, ("a", 1), ("b", 2))
    for _ in range(2):
        write_snapshot(df, folder, DAY)
    assert spark.read.parquet(folder).count() == 4


def test_replace_day_keeps_other_days(spark, folder):
    df = frame(spark, ("a", 1), ("b", 2))
    write_snapshot(df, folder, datetime.date(2024, 2, 29))
    for _ in range(2):
        write_snapshot(df, folder, DAY, replace_day=True)
    counts = {row.snapshot_date: row["count"] for row in spark.read.parquet(folder).groupBy("snapshot_date").count().collect()}
    assert counts == {datetime.date(2024, 2, 29): 2, DAY: 2}


def test_today_is_the_default_and_days_are_pruned(spark, folder):
    write_snapshot(frame(spark, ("a", 1)), folder)
    write_snapshot(frame(spark, ("a", 1)), folder, DAY, files_per_day=1)
    back = spark.read.parquet(folder)
    assert dict(back.dtypes)["snapshot_date"] == "date"
    plan = back.where("snapshot_date = current_date()")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert back.where("snapshot_date = current_date()").count() == 1


def test_table_overwrite_replaces_rows(spark, folder):
    create_database(spark, "sink_test", f"{folder}/db")
    write_table(frame(spark, ("a", 1), ("b", 2)), "sink_test", "t")
    assert write_table(frame(spark, ("c", 3)), "sink_test", "t").collect()[0].id == "c"
    assert spark.table("sink_test.t").count() == 1


def test_changed_columns_replace_the_table(spark, folder):
    create_database(spark, "sink_test_columns", f"{folder}/db")
    write_table(frame(spark, ("a", 1)), "sink_test_columns", "t")
    wider = frame(spark, ("b", 2, 1.5), ddl="id string, n int, x double")
    assert [tuple(row) for row in write_table(wider, "sink_test_columns", "t").collect()] == [("b", 2, 1.5)]


def test_failed_write_does_not_block_the_next_one(spark, folder):
    create_database(spark, "sink_test_failed", f"{folder}/db")
    failing = frame(spark, ("a", 1)).selectExpr("id", "cast(raise_error('lost') as int) as n")
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            write_table(failing, "sink_test_failed", "t")
    (pathlib.Path(folder) / "db" / "t" / "part-0-left-behind.parquet").write_text("half a file")
    assert [tuple(row) for row in write_table(frame(spark, ("b", 2)), "sink_test_failed", "t").collect()] == [("b", 2)]


@pytest.mark.parametrize("ddl", ["id string, n int", "id string, n int, x int"])
def test_failed_overwrite_leaves_the_old_rows(spark, folder, ddl):
    database = f"sink_test_{uuid.uuid4().hex}"
    create_database(spark, database, f"{folder}/db")
    write_table(frame(spark, ("a", 1)), database, "t")
    columns = ["id", "cast(raise_error('lost') as int) as n", *(["1 as x"] if "x" in ddl else [])]
    with pytest.raises(Exception, match="lost"):
        write_table(frame(spark, ("b", 2)).selectExpr(*columns), database, "t")
    assert [tuple(row) for row in spark.table(f"{database}.t").collect()] == [("a", 1)]
    more = frame(spark, ("c", 3, 4)[: ddl.count(",") + 1], ddl=ddl)
    assert [tuple(row) for row in write_table(more, database, "t").collect()] == [tuple(more.first())]


def test_a_failing_rename_leaves_the_old_table(spark, folder, monkeypatch):
    """The name cannot be taken after the old table was renamed aside: it gets its name and rows back."""
    database = f"sink_test_{uuid.uuid4().hex}"
    create_database(spark, database, f"{folder}/db")
    write_table(frame(spark, ("a", 1)), database, "t")
    wider = frame(spark, ("b", 2, 1.5), ddl="id string, n int, x double")

    class Failing:
        """The session, but for the rename of a new table."""

        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            if text.startswith("ALTER TABLE") and text.endswith(f"RENAME TO `{database}`.`t`") and not failed:
                failed.append(text)
                raise RuntimeError("no such luck")
            return spark.sql(text)

    failed = []
    monkeypatch.setattr(type(wider), "sparkSession", property(lambda _: Failing()))
    with pytest.raises(RuntimeError, match="no such luck"):
        write_table(wider, database, "t")
    monkeypatch.undo()
    assert [tuple(row) for row in spark.table(f"{database}.t").collect()] == [("a", 1)]
    assert [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["t"]
    for number in range(2):  # and the next ones succeed
        assert [tuple(row) for row in write_table(wider, database, "t").collect()] == [("b", 2, 1.5)]
    assert [tuple(row) for row in write_table(frame(spark, ("c", 3)), database, "t").collect()] == [("c", 3)]


def test_reader_that_began_before_an_overwrite_finishes(spark, folder):
    database = f"sink_test_{uuid.uuid4().hex}"
    create_database(spark, database, f"{folder}/it's")
    reader = write_table(frame(spark, ("a", 1)), database, "t")
    write_table(frame(spark, ("b", 2)), database, "t")
    assert reader.collect()[0].id in "ab"
    for number in range(3):
        write_table(frame(spark, ("c", number)), database, "t")
    assert len(list((pathlib.Path(folder) / "it's" / "t__versions").iterdir())) == 2
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_empty_replacement_removes_the_day(spark, folder):
    df = frame(spark, ("a", 1), ("b", 2))
    for day in (datetime.date(2024, 2, 29), DAY):
        write_snapshot(df, folder, day)
    write_snapshot(df.limit(0), folder, DAY, replace_day=True)
    assert {row.snapshot_date for row in spark.read.parquet(folder).collect()} == {datetime.date(2024, 2, 29)}


# --- publish -----------------------------------------------------------------------


def test_publish_replaces_the_table(spark, target):
    jdbc.publish(frame(spark, ("a", 1)), "t", target, "id VARCHAR(8)")
    jdbc.publish(frame(spark, ("b", 2), ("c", None)), "t", target, "id VARCHAR(8)")
    assert published(spark, target) == [("b", 2), ("c", None)]


def test_staging_table_is_gone_after_success(spark, target):
    jdbc.publish(frame(spark, ("a", 1)), "t", target)
    with pytest.raises(Py4JJavaError):
        published(spark, target, "t__staging")


def test_nan_is_published_as_null(spark, target):
    df = frame(spark, ("a", float("nan")), ("b", 1.5), ddl="id string, n double")
    jdbc.publish(df, "t", target)
    assert published(spark, target) == [("a", None), ("b", 1.5)]


@pytest.mark.parametrize(
    "types, message",
    [("id TEXT", "do not parse"), ("id VARCHAR(8), ingestion_date DATE", "ingestion_date"), ("id VARCHAR(", "do not parse")],
)
def test_refused_types_leave_the_old_table(spark, target, types, message):
    jdbc.publish(frame(spark, ("a", 1)), "t", target)
    with pytest.raises(jdbc.PublishError, match=message):
        jdbc.publish(frame(spark, ("b", 2)), "t", target, types)
    assert published(spark, target) == [("a", 1)]


def test_failed_load_leaves_the_old_table_and_a_retry_succeeds(spark, target):
    jdbc.publish(frame(spark, ("a", 1)), "t", target, "id VARCHAR(4)")
    rows = [(str(number), number) for number in range(100)]
    with pytest.raises(Py4JJavaError):
        jdbc.publish(frame(spark, *rows, ("too long", 0)), "t", target, "id VARCHAR(4)")
    assert published(spark, target) == [("a", 1)]
    jdbc.publish(frame(spark, *rows), "t", target, "id VARCHAR(4)")
    assert published(spark, target) == sorted(rows)


def test_wrong_row_count_in_staging_is_refused(spark, target, monkeypatch):
    jdbc.publish(frame(spark, ("a", 1)), "t", target)
    doubled = lambda df: df.union(df)  # noqa: E731 - as if a committed task had run twice
    plain = jdbc.without_nan
    monkeypatch.setattr(jdbc, "without_nan", lambda df: Recounted(doubled(plain(df)), df))
    with pytest.raises(jdbc.PublishError, match="holds 2 rows instead of 1"):
        jdbc.publish(frame(spark, ("b", 2)), "t", target)
    assert published(spark, target) == [("a", 1)]


class Recounted:
    def __init__(self, written, counted):
        self.write, self.count = written.write, counted.count


class FakeConnection:
    """Stands in for a database product that is not here: records the statements."""

    def __init__(self, product, exists, fail_on=None):
        self.product, self.exists, self.fail_on, self.log = product, exists, fail_on, []

    def __getattr__(self, name):
        answers = {
            "getMetaData": self,
            "createStatement": self,
            "getDatabaseProductName": self.product,
            "storesUpperCaseIdentifiers": False,
            "storesLowerCaseIdentifiers": True,
            "getSearchStringEscape": "\\",
            "getTables": self,
            "next": self.exists,
            "getSchema": "public",
            "getCatalog": "ott",
        }

        def call(*arguments):
            if name in ("execute", "commit", "rollback"):
                self.log.append(arguments[0] if arguments else name)
                if self.fail_on and name == "execute" and self.fail_on in arguments[0]:
                    raise RuntimeError("refused")
            return answers.get(name)

        return call


def test_mysql_swap_is_one_rename():
    there, absent = FakeConnection("MySQL", True), FakeConnection("MySQL", False)
    jdbc._swap(there, "t__staging", "t")
    assert there.log == ["DROP TABLE IF EXISTS t__old", "RENAME TABLE t TO t__old, t__staging TO t", "DROP TABLE IF EXISTS t__old"]
    jdbc._swap(absent, "t__staging", "t")
    assert absent.log[1] == "RENAME TABLE t__staging TO t"


def test_swap_elsewhere_is_one_transaction():
    done = FakeConnection("PostgreSQL", True)
    jdbc._swap(done, "s.t__staging", "s.t")
    assert done.log == ["DROP TABLE s.t", "ALTER TABLE s.t__staging RENAME TO t", "commit"]
    refused = FakeConnection("PostgreSQL", True, fail_on="RENAME")
    with pytest.raises(RuntimeError):
        jdbc._swap(refused, "s.t__staging", "s.t")
    assert refused.log[-1] == "rollback"


def test_all_tables_are_swapped_together():
    mysql = FakeConnection("MariaDB", True)
    jdbc._swap_all(mysql, [("a__staging", "a"), ("b__staging", "b")])
    assert mysql.log[2] == "RENAME TABLE a TO a__old, a__staging TO a, b TO b__old, b__staging TO b" and len(mysql.log) == 5
    other = FakeConnection("PostgreSQL", True, fail_on="b__staging RENAME")
    with pytest.raises(RuntimeError):
        jdbc._swap_all(other, [("a__staging", "a"), ("b__staging", "b")])
    assert other.log[0] == "DROP TABLE a" and other.log[-1] == "rollback" and "commit" not in other.log


def test_unknown_products_are_refused_before_anything_is_written():
    oracle = FakeConnection("Some Database", True)
    with pytest.raises(jdbc.PublishError, match="Some Database"):
        jdbc._swap(oracle, "t__staging", "t")
    assert oracle.log == []


def test_second_table_failing_leaves_the_first(spark, target):
    tables = {"t": (frame(spark, ("a", 1)), None), "u": (frame(spark, ("a", 1)), "id VARCHAR(4)")}
    jdbc.publish_all(tables, target)
    tables = {"t": (frame(spark, ("b", 2)), None), "u": (frame(spark, ("too long", 2)), "id VARCHAR(4)")}
    with pytest.raises(Py4JJavaError):
        jdbc.publish_all(tables, target)
    assert published(spark, target) == published(spark, target, "u") == [("a", 1)]


def test_empty_table_is_refused_unless_allowed(spark, target):
    jdbc.publish(frame(spark, ("a", 1)), "t", target)
    empty = frame(spark, ("a", 1)).limit(0)
    with pytest.raises(jdbc.PublishError, match="no rows"):
        jdbc.publish(empty, "t", target)
    assert published(spark, target) == [("a", 1)]
    jdbc.publish(empty, "t", target, allow_empty=True)
    assert published(spark, target) == []


def test_infinity_is_published_as_null(spark, target):
    rows = [("a", float("inf")), ("b", -float("inf")), ("c", float("nan")), ("d", 1.5), ("e", None)]
    jdbc.publish(frame(spark, *rows, ddl="id string, n double"), "t", target)
    assert published(spark, target) == [("a", None), ("b", None), ("c", None), ("d", 1.5), ("e", None)]


def test_schema_qualified_table(spark, target):
    for rows in ([("a", 1)], [("b", 2)]):
        jdbc.publish(frame(spark, *rows), "app.my_table", target, "id VARCHAR(8)")
    assert published(spark, target, "app.my_table") == [("b", 2)]


def test_password_is_not_shown():
    secret = jdbc.JdbcTarget("jdbc:x:y", "d", "me", "hidden")
    assert "hidden" not in repr(secret)
    assert secret.options()["password"] == "hidden"


def test_declared_types_parse_and_fit_the_transformed_tables(spark):
    titles = spark.createDataFrame([], schemas.ddl(schemas.TITLES | {"ingestion_date": "date"}))
    jdbc.check_column_types(titles, schemas.ddl(schemas.PUBLISHED_TITLE_TYPES))
    credits = spark.createDataFrame([], schemas.ddl(schemas.CREDITS))
    jdbc.check_column_types(credits, schemas.ddl(schemas.PUBLISHED_CREDIT_TYPES))
