"""Landings merged one after another equal one build; a stored dictionary is asked once per name."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regforge.operators import names, topk
from regforge.plans.dictionary import StoredDictionary
from regforge.plans.incremental import NameState, current_names, landing, merge_landing
from regforge.plans.stages import stage_folder
from regforge.streaming.landing import keep_names


@pytest.fixture
def rows(spark):
    """A third of the rows belong to one name."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 300)).alias("drug_names"),
        F.when(F.col("id") % 5 > 1, F.concat(F.lit("S"), F.col("id") % 4)).alias("status"),
        F.concat(F.lit("r"), (F.col("id") * 7) % 11).alias("value"),
        (F.lit(9000) - F.col("id")).alias("position"),
    )


def state_of(spark, state, part):
    tagged = names.names_from_lists(part, "drug_names", "tri", "status", "position")
    seen = part.select(F.col("drug_names").alias("drug_name"), "value", "position")
    return landing(state, [tagged], {"reactions": seen})


def full(rows, k):
    tagged = names.names_from_lists(rows, "drug_names", "tri", "status", "position")
    first = topk.first_k_distinct(rows, "drug_names", "value", "position", k, "drug_name", "reactions")
    return sorted(map(tuple, names.name_dictionary([tagged], ["tri"]).join(first, "drug_name", "left").collect()))


def held(spark, state):
    return sorted(map(tuple, current_names(spark, state).collect()))


def test_three_landings_equal_one_build(spark, rows):
    state = NameState(stage_folder(spark), ["tri"], {"reactions": 4}, buckets=5)
    assert held(spark, state) == []
    for part in (2, 0, 1):
        merge_landing(spark, state, state_of(spark, state, rows.filter(F.col("position") % 3 == part)))
    want = full(rows, 4)
    assert len(want) == 201 and held(spark, state) == want
    # Again, as after a run that was broken off.
    merge_landing(spark, state, state_of(spark, state, rows.filter(F.col("position") % 3 == 1)))
    assert held(spark, state) == want


def test_only_touched_buckets_are_rewritten(spark, rows):
    state = NameState(stage_folder(spark), ["tri"], {"reactions": 4}, buckets=16)
    merge_landing(spark, state, state_of(spark, state, rows))
    folder = state.path.removeprefix("file://")

    def files():
        return {os.path.basename(d): sorted(os.listdir(d)) for d in glob.glob(f"{folder}/bucket=*")}

    before = files()
    new = rows.limit(1).select(F.lit("n1").alias("drug_names"), F.lit("S9").alias("status"), F.lit("new").alias("value"), F.lit(-1).cast("long").alias("position"))
    merge_landing(spark, state, state_of(spark, state, new))
    changed = [b for b, held in files().items() if held != before[b]]
    assert len(before) == 16 and len(changed) == 1
    assert {r["drug_name"]: (r["status"], r["reactions"].split("; ")[0]) for r in current_names(spark, state).collect()}["n1"] == ("S9", "new")
    merge_landing(spark, state, state_of(spark, state, rows.limit(0)))  # a landing without rows


def test_a_hot_name_leaves_each_task_as_one_row(spark, rows):
    state = NameState(stage_folder(spark), ["tri"], {"reactions": 4})
    plan = state_of(spark, state, rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "partial_min" in plan


def test_landings_as_a_stream(spark, rows):
    source, state = stage_folder(spark), NameState(stage_folder(spark), ["tri"], {"reactions": 4}, buckets=4)
    checkpoint = stage_folder(spark)
    for part in range(3):
        rows.filter(F.col("position") % 3 == part).write.mode("append").json(source)
        pages = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).json(source)
        keep_names(pages, lambda batch: state_of(spark, state, batch), state, checkpoint).awaitTermination()
    assert held(spark, state) == full(rows, 4)


@pytest.fixture
def store(spark):
    return StoredDictionary(spark, stage_folder(spark), T.StructType([T.StructField("cid", T.LongType()), T.StructField("formula", T.StringType())]), buckets=8)


def test_names_are_asked_once(spark, store):
    asked = []

    def source(new):
        asked.append(sorted(r[0] for r in new.collect()))
        return new.filter("drug_name <> 'nobody'").select("drug_name", F.length("drug_name").cast("long").alias("cid"), F.lit("x").alias("formula"))

    first = spark.createDataFrame([("a",), (" a\t",), ("bb",), (None,), (" ",), ("nobody",)], "n string")
    assert store.ask(first, "n", source, at=1) == 3
    assert store.ask(first.union(spark.createDataFrame([("ccc",)], "n string")), "n", source, at=2) == 1
    assert asked == [["a", "bb", "nobody"], ["ccc"]]
    store.add(spark.createDataFrame([("bb", 77, "new")], "drug_name string, cid long, formula string"), at=3)
    want = {"a": (1, "x", 1), "bb": (77, "new", 3), "nobody": (None, None, 1), "ccc": (3, "x", 2)}
    assert {r[0]: tuple(r)[1:] for r in store.newest().collect()} == want
    assert store.answers().count() == 5
    store.compact()
    assert store.answers().count() == 4 and {r[0]: tuple(r)[1:] for r in store.newest().collect()} == want
    # Another session that only knows the folder.
    spark.sql(f"DROP TABLE {store.table}")
    again = StoredDictionary(spark, store.path, store.attributes, buckets=8)
    assert {r[0]: tuple(r)[1:] for r in again.newest().collect()} == want
    rows = spark.createDataFrame([(1, "bb "), (2, "zz"), (3, None)], "id int, name string")
    assert {r["id"]: (r["drug_name"], r["cid"]) for r in again.enrich(rows, "name").collect()} == {1: ("bb ", 77), 2: ("zz", None), 3: (None, None)}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_exchange_above_the_stored_table(spark, store, adaptive):
    store.add(spark.range(1000).select(F.concat(F.lit("n"), "id").alias("drug_name"), F.col("id").alias("cid"), F.lit("f").alias("formula")), at=1)
    names_ = spark.range(5000).select(F.concat(F.lit("n"), F.col("id") % 2000).alias("name"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": adaptive}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for frame, rows in ((store.look_up(names_, "name"), 2000), (store.unknown(names_, "name"), 1000)):
            assert frame.count() == rows
            plan = frame._jdf.queryExecution().executedPlan().toString()
            scan = plan.index(f"{store.table}")
            above = plan[:scan].splitlines()
            depth = above[-1].index("FileScan") if "FileScan" in above[-1] else len(above[-1]) - len(above[-1].lstrip(" :+-*("))
            for line in reversed(above[:-1]):
                at = len(line) - len(line.lstrip(" :+-*("))
                if at < depth:
                    depth = at
                    assert "Exchange" not in line or "Join" in line, plan
                    if "Join" in line:
                        break
            assert "Bucketed: true" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
