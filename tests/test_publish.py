"""Publications that break off, and files that stay."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.operators import publish
from feedkit.plans.journal import Journal
from feedkit.plans.load_job import LoadSpec, load_table
from feedkit.plans.storage import scratch_database, scratch_path
from feedkit.streaming import incremental


class BrokenOff(Exception):
    pass


@pytest.fixture
def break_after(monkeypatch):
    """Break a publication off after its n-th effect on the catalog, the table or the journal; returns how many there were."""

    def install(n):
        seen = []

        def wrap(owner, name):
            whole = getattr(owner, name)

            def part(*args, **kw):
                out = whole(*args, **kw)
                seen.append(name)
                if len(seen) == n:
                    raise BrokenOff(f"{n}: {seen}")
                return out

            patch.setattr(owner, name, part)

        patch = pytest.MonkeyPatch()
        wrap(publish, "_run")
        wrap(publish, "_add")
        wrap(Journal, "write")
        one = publish.delete_files

        def one_by_one(spark, locations):
            for location in locations:
                one(spark, [location])
                seen.append("delete")
                if len(seen) == n:
                    raise BrokenOff(f"{n}: {seen}")

        patch.setattr(publish, "delete_files", one_by_one)
        return patch

    return install


def rows(spark, table):
    return sorted(map(tuple, spark.table(table).select("id", "name", "p").collect()))


def tables_of(spark, table):
    return {t.name for t in spark.catalog.listTables(table.split(".")[0])}


SCHEMA = "id long, name string, p string"
OLD = [(k, "old", "xyz"[k % 3]) for k in range(9)]
NEW = [(1, "new", "x"), (5, "new", "x"), (20, "new", "w"), (None, "new", "w")]


def prepared(spark, parts):
    table = f"{scratch_database(spark)}.goods"
    writer = spark.createDataFrame(OLD, SCHEMA).repartition(3, "p").write
    (writer.partitionBy("p") if parts else writer).saveAsTable(table)
    return table


@pytest.mark.parametrize("how,parts", [("swap", False), ("upsert", True), ("upsert", False)])
def test_a_try_may_break_off_anywhere(spark, break_after, how, parts):
    new = spark.createDataFrame(NEW, SCHEMA)
    merged = sorted([r for r in OLD if r[0] not in (1, 5)] + NEW, key=str)
    wanted = sorted(NEW, key=str) if how == "swap" else merged

    def go(table, stamp):
        if how == "swap":
            publish.full_refresh_swap(spark, table, new, stamp)
        else:
            publish.publish_upsert(spark, table, new, ["id"], stamp)

    def content(table):
        return sorted(map(tuple, spark.table(table).select("id", "name", "p").collect()), key=str)

    broken = 0
    for n in range(1, 40):
        table = prepared(spark, parts)
        patch = break_after(n)
        try:
            go(table, "1")
            done = True
        except BrokenOff:
            done = False
        finally:
            patch.undo()
        if not done:
            broken += 1
            # what is left is the old table or the new one, also if the next try breaks off at once
            publish.recover(spark, table)
            assert content(table) in (sorted(OLD, key=str), wanted), n
            # a row without a key would come again, so the next try asks first
            if publish.is_published(spark, table, "1", {}) is None:
                go(table, "1")
        assert content(table) == wanted, n
        assert tables_of(spark, table) == {"goods"}, n
        assert publish.recover(spark, table)["step"] == "published"
        if done:
            break
    assert broken >= 5


def test_files_without_a_replaced_key_stay(spark):
    table = f"{scratch_database(spark)}.goods"
    spark.range(0, 1000, 1, 10).select("id", F.lit("old").alias("name"), F.lit("p").alias("p")).write.saveAsTable(table)

    def files():
        return {r[0] for r in spark.table(table).select(F.col("_metadata.file_path")).distinct().collect()}

    before = files()
    staged = spark.createDataFrame([(205, "new", "p"), (1500, "new", "p")], SCHEMA)
    publish.publish_upsert(spark, table, staged, ["id"], "1")
    assert len(before) == 10 and len(before & files()) == 9
    assert spark.table(table).count() == 1001 and spark.table(table).where("name = 'new'").count() == 2
    # keys that the table does not have replace nothing
    before = files()
    publish.publish_upsert(spark, table, spark.createDataFrame([(-1, "new", "p"), (None, "new", "p")], SCHEMA), ["id"], "2")
    assert before < files()
    publish.publish_upsert(spark, table, staged.limit(0), ["id"], "3")
    assert spark.table(table).count() == 1003


def test_only_near_files_are_read_for_keys(spark):
    table = f"{scratch_database(spark)}.goods"
    spark.range(10).select("id", F.lit("a").alias("name")).write.saveAsTable(table)
    near = publish._range_of(spark.createDataFrame([(3,), (7,), (None,)], "id long"), spark.table(table), ["id"])
    plan = spark.table(table).where(near)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,3)" in plan and "LessThanOrEqual(id,7)" in plan


def test_a_load_offered_again_gives_the_same_numbers(spark):
    table = f"{scratch_database(spark)}.goods"
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string").write.saveAsTable(table)
    spec = LoadSpec(T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]), ["id"], ",")

    def load(values, stamp):
        lines = spark.createDataFrame([("f", 0, i, v) for i, v in enumerate(values)], "file string, block long, line_no long, value string")
        return load_table(spark, table, lines, spec, stamp).first()["deleted"]

    assert [load(["2,B", "3,C"], "s"), load(["3,C", "2,B"], "s")] == [1, 1]
    # other rows under the same stamp are published
    assert load(["2,X"], "s") == 1 and spark.table(table).where("name = 'X'").count() == 1
    # and so are the same rows if the table was made anew
    spark.sql(f"DROP TABLE {table}")
    spark.createDataFrame([], "id long, name string").write.saveAsTable(table)
    assert load(["2,X"], "s") == 0 and spark.table(table).count() == 1


def test_a_batch_that_failed_is_loaded_when_it_is_offered_again(spark):
    table, inbox, ledger, status = f"{scratch_database(spark)}.goods", *(scratch_path(spark, x) for x in ("inbox", "ledger", "status"))
    spark.createDataFrame([(1, "old")], "id long, name string").write.saveAsTable(table)
    spec = LoadSpec(T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]), ["id"], ",")
    batch = incremental.load_batches(spark, table, spec, status)
    spark.createDataFrame([("1,new",), ("2,b",), (",no key",)], "value string").coalesce(1).write.text(inbox)

    def lost(lines, batch_id):
        batch(lines, batch_id)
        raise BrokenOff("after the table was published, before the batch was noted")

    with pytest.raises(Exception, match="before the batch was noted"):
        incremental.incremental_load(spark, inbox, lost, ledger)
    incremental.incremental_load(spark, inbox, batch, ledger)
    assert sorted(map(str, map(tuple, spark.table(table).collect()))) == sorted(map(str, [(1, "new"), (2, "b"), (None, "no key")]))
    assert [tuple(r) for r in spark.read.parquet(status).select("lines", "rejects", "clean").collect()] == [(3, 0, True)]
