import json
from collections import Counter

import pytest

from regforge import schemas, sinks
from regforge.functions.columns import packed_position
from regforge.operators import scoring
from regforge.operators.split import split_counts
from regforge.plans.datasets import Extracts, build_datasets, unified_table
from regforge.plans.stages import staged
from regforge.sources import delimited, registry, trials
from workloads.queries import QUERIES


@pytest.fixture
def extracts(spark):
    n = 60
    registry = spark.createDataFrame([(f"D{i}", f"Brand {i}") for i in range(n)], "ingredient string, trade_name string")
    labels = spark.createDataFrame([(f"D{i}", None) for i in range(0, n, 2)], "brand_name string, generic_name string")
    trials = spark.createDataFrame(
        [(i, f"D{i}, New {i}", "WITHDRAWN" if i % 3 else "COMPLETED", "slow" if i % 2 else None) for i in range(n)],
        "position long, drug_names string, status string, why_stopped string",
    )
    events = spark.createDataFrame(
        [(j, f"D{i}", f"r{j % 7}") for i in range(n) for j in range(i % 9)], "position long, drug_name string, reactions string"
    )
    structures = spark.createDataFrame(
        [(f"D{i}", i, f"{'C' * (i + 1)}O") for i in range(0, n, 2)] + [("D0", 99, "N")] + [(f"New {i}", i, f"{'N' * (i + 1)}O") for i in range(n)],
        "drug_name string, cid int, canonical_smiles string",
    )
    failed = trials.filter("status = 'WITHDRAWN' and why_stopped is not null")
    return Extracts(registry, labels, trials, structures, events, failed)


def test_unified(extracts):
    rows = {}
    for r in unified_table(extracts).collect():
        rows.setdefault(r["drug_name"], []).append(r)
    assert len(rows["D0"]) == 2  # two structures
    assert rows["D2"][0]["source"] == "clinicaltrials, fda_orange_book, openfda_labels"
    assert rows["D8"][0]["adverse_reactions"] == "r0; r1; r2; r3; r4"
    assert rows["D9"][0]["adverse_reactions"] is None
    assert rows["New 1"][0]["failure_reason"] == "slow" and rows["New 2"][0]["failure_reason"] is None
    assert rows["D1"][0]["status"] == "approved" and rows["New 1"][0]["status"] == "WITHDRAWN"
    assert rows["D1"][0]["canonical_smiles"] is None


def test_absent_extracts_leave_columns_out(extracts):
    only = unified_table(Extracts(registry=extracts.registry))
    assert only.columns == ["drug_name", "source", "status"] and only.count() == 120
    done = build_datasets(Extracts(registry=extracts.registry))
    assert done.classification is None and done.instructions.count() == 120


def test_results_do_not_depend_on_shuffle_partitions(spark, extracts):
    def run():
        return sorted(map(tuple, unified_table(extracts).collect()), key=str)

    before, results = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("1", "4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(run())
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_build_datasets_and_write(spark, extracts, tmp_path):
    done = build_datasets(extracts)
    stats = {(r["dataset"], r["split"]): r["rows"] for r in done.stats.collect()}
    total = done.instructions.count()
    assert sum(n for (d, _), n in stats.items() if d == "instructions") == total
    assert stats[("instructions", "train")] / total == pytest.approx(0.8, abs=0.02)
    labels = Counter(r["label"] for r in done.classification.collect())
    assert set(labels) == {0, 1} and sum(labels.values()) == sum(n for (d, _), n in stats.items() if d == "classification")

    sinks.write_split(done.instructions.drop("drug_name"), str(tmp_path / "instructions"))
    back = spark.read.json(str(tmp_path / "instructions" / "split=train"))
    assert back.count() == stats[("instructions", "train")] and set(back.columns) == {"instruction", "input", "output", "task"}
    sinks.write_split(done.classification, str(tmp_path / "classification"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "classification")).count() == sum(labels.values())
    sinks.write_jsonl(sinks.stats_document(done.stats), str(tmp_path / "stats"))
    lines = [json.loads(line) for p in (tmp_path / "stats").glob("*.json") for line in p.read_text().splitlines()]
    assert {d["dataset"]: d["splits"] for d in lines}["instructions"]["train"] == stats[("instructions", "train")]


def test_split_by_entity_keeps_its_rows_together(extracts):
    rows = build_datasets(extracts, split_key="drug_name").instructions
    sides = {}
    for r in rows.select("drug_name", "split").distinct().collect():
        sides.setdefault(r["drug_name"], set()).add(r["split"])
    assert all(len(s) == 1 for s in sides.values()) and len(set.union(*sides.values())) == 3


def test_result_parts(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", "X "), ("a", "y", "z")], "task string, prediction string, reference string")
    details = df.withColumn("correct", scoring.strict_match("prediction", "reference"))
    sinks.write_result(str(tmp_path / "result"), by_task=scoring.accuracy_rollup(details), predictions=details)
    totals = spark.read.json(str(tmp_path / "result" / "by_task")).filter("is_total = 1").first()
    assert (totals["correct"], totals["total"]) == (1, 2)
    assert spark.read.json(str(tmp_path / "result" / "predictions")).count() == 2


def test_stage_uses_the_folder_of_the_session(spark):
    df = staged(spark.range(5).repartition(2))
    assert df.count() == 5 and spark.sparkContext.getCheckpointDir()
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert split_counts(df.selectExpr("'x' split"), "d").first()["rows"] == 5


def test_from_landed_files_to_written_data(spark, tmp_path):
    """The steps of the README, on files."""
    landing = tmp_path / "landing"
    for folder in ("registry/unpacked", "labels", "trials", "events"):
        (landing / folder).mkdir(parents=True)
    (landing / "registry/unpacked/products.txt").write_bytes("Ingredient~Trade_Name\nAlpha~Alpha Plus\nBeta~\n".encode("latin-1"))
    (landing / "labels/1.json").write_text(json.dumps({"results": [{"openfda": {"brand_name": ["Alpha"], "generic_name": []}}]}, indent=1))

    def study(status, reason, *drugs):
        return {"protocolSection": {
            "statusModule": {"overallStatus": status, "whyStopped": reason},
            "armsInterventionsModule": {"interventions": [{"type": "DRUG", "name": d} for d in drugs]},
        }}

    # Page 10 comes after page 2, whatever the file listing says.
    (landing / "trials/page10.json").write_text(json.dumps({"studies": [study("COMPLETED", "", "Gamma")]}, indent=1))
    (landing / "trials/page2.json").write_text(
        json.dumps({"studies": [study("SUSPENDED", "late", "Gamma", "Delta, salt"), study("TERMINATED", "cost", "Delta, salt")]}, indent=1)
    )
    pages = registry.read_pages(spark, str(landing / "trials"), schemas.TRIAL_PAGE).selectExpr(
        "cast(regexp_extract(_metadata.file_name, '([0-9]+)', 1) as long) AS page", "studies"
    )
    studies = trials.flatten_trials(pages, keep=["page"], position="place", arrays=True)
    studies = studies.withColumn("position", packed_position("page", "place"))
    extracts = Extracts(
        registry=delimited.read_products(spark, str(landing / "registry")),
        labels=registry.flatten_labels(registry.read_pages(spark, str(landing / "labels"), schemas.LABEL_PAGE)),
        trials=studies,
        failed_trials=trials.failed_trials(studies),
    )
    rows = {r["drug_name"]: r for r in unified_table(extracts, names="drug_name_list", separator=None).collect()}
    assert set(rows) == {"Alpha", "Alpha Plus", "Beta", "Gamma", "Delta, salt"}
    assert rows["Alpha"]["source"] == "fda_orange_book, openfda_labels"
    assert (rows["Gamma"]["status"], rows["Gamma"]["failure_reason"]) == ("SUSPENDED", "late")
    assert rows["Delta, salt"]["failure_reason"] == "late; cost"
    cut = {r["drug_name"] for r in unified_table(extracts).collect()}
    assert {"Delta", "salt"} < cut and "Delta, salt" not in cut

    done = build_datasets(extracts, names="drug_name_list", separator=None)
    sinks.write_jsonl(done.instructions, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 3 + 2 * 2  # one status row each, a failure row for two


@pytest.mark.parametrize("name", ["name_dictionary", "unified_table", "instruction_table"])
def test_names_are_cleaned_where_they_enter(spark, smoke_folder, name):
    """No regular expression over names, and few trims: filters of later steps must not repeat them below the joins."""
    plan = QUERIES[name](spark, smoke_folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
    assert plan.count("trim(") <= 30
