"""Names that are padded on one side only, blank values, and inputs that must not vanish."""

import pytest

from regforge import schemas, sinks
from regforge.functions.text import prompt
from regforge.operators import compare, enrich, names, scoring
from regforge.plans.datasets import Extracts, unified_table
from regforge.session import apply_settings
from regforge.sources import registry, tables


def test_padded_names_meet(spark):
    labels = spark.createDataFrame([("Aspirin \t", " "), ("\t", None)], "brand_name string, generic_name string")
    events = spark.createDataFrame([(" Aspirin", "rash", 1)], "drug_name string, reactions string, position long")
    structures = spark.createDataFrame([(" Aspirin", "CCO")], "drug_name string, canonical_smiles string")
    got = unified_table(Extracts(labels=labels, adverse_events=events, structures=structures)).collect()
    assert [(r["drug_name"], r["adverse_reactions"], r["canonical_smiles"]) for r in got] == [("Aspirin", "rash", "CCO")]


def test_reasons_come_from_the_trials_that_failed(spark):
    trials = spark.createDataFrame([("A, B", "TERMINATED", "no effect", 1), ("A", "COMPLETED", "not read", 0)], "drug_names string, status string, why_stopped string, position long")
    got = {r["drug_name"]: r["failure_reason"] for r in unified_table(Extracts(trials=trials)).collect()}
    assert got == {"A": "no effect", "B": "no effect"}


def test_a_source_without_a_rank_fails(spark):
    rows = spark.createDataFrame([("A", "other", None, 0)], "drug_name string, source string, status string, position long")
    with pytest.raises(Exception, match="source without a rank"):
        names.name_dictionary([rows], ["known"]).collect()


def test_enrich_agrees_with_look_up(spark):
    df = spark.createDataFrame([(1, " Aspirin"), (2, "none"), (3, " ")], "id int, name string")
    dictionary = spark.createDataFrame([("Aspirin\t", 5)], "drug_name string, cid int")
    got = {r["id"]: (r["drug_name"], r["cid"]) for r in enrich.enrich(df, "name", dictionary).collect()}
    assert got == {1: (" Aspirin", 5), 2: ("none", None), 3: (None, None)}
    assert {(r["drug_name"], r["cid"]) for r in enrich.lookup_names(df, "name", dictionary).collect()} == {(" Aspirin", 5), ("none", None)}


def test_blank_is_missing_everywhere(spark):
    df = spark.createDataFrame([("",), (None,), ("\t",), ("x",)], "a string")
    assert enrich.missing_attribute(df, "a").count() == 3
    assert tuple(enrich.coverage(df, "a").first()) == (4, 1, 3)
    rows = spark.createDataFrame([("k", "good")], "key string, a string")
    blank = spark.createDataFrame([("k", " ")], "key string, a string")
    assert enrich.update_from(rows, "key", blank, "key", ["a"]).first()["a"] == "good"


def test_missing_model_and_missing_suite_row(spark):
    rows = spark.createDataFrame([("p", "t", "base", "alpha"), ("q", "t", "base", "x"), ("q", "t", "finetuned", "x")], "prompt_id string, task string, model string, response string")
    suite = spark.createDataFrame([("p", ["alpha", "beta"])], "prompt_id string, expected_keywords array<string>")
    scored = compare.scored_responses(rows, suite)
    assert {(r["prompt_id"], r["keyword_matches"], r["total_keywords"]) for r in scored.collect()} == {("p", 1, 2), ("q", 0, 0)}
    assert {r["prompt_id"]: r["winner"] for r in compare.winners(scored).collect()} == {"p": None, "q": "Tie"}


def test_blank_input_section(spark):
    row = spark.range(1).selectExpr("'do' as i", "'' as n").select(prompt("i", "n", blank_input=True).alias("p"), prompt("i", "n").alias("q")).first()
    assert "### Input:\n\n" in row["p"] and "### Input" not in row["q"]


def test_corrupt_pages_are_kept(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"results": [{"status": "Ongoing"}]}')
    (tmp_path / "2.json").write_text('{"results": [{"sta')
    with pytest.raises(Exception):
        registry.read_pages(spark, str(tmp_path), schemas.RECALL_PAGE).collect()
    pages = registry.read_pages(spark, str(tmp_path), schemas.RECALL_PAGE, mode="PERMISSIVE")
    assert registry.flatten_recalls(pages).count() == 1
    assert [r["page"] for r in registry.rejected_pages(pages).collect()] == ['{"results": [{"sta']


def test_no_predictions_are_nought_of_nought(spark):
    empty = spark.createDataFrame([], "task string, correct boolean")
    assert [tuple(r) for r in scoring.accuracy_rollup(empty).select("task", "is_total", "correct", "total", "accuracy").collect()] == [(None, 1, 0, 0, 0.0)]
    one = spark.createDataFrame([("t", True)], "task string, correct boolean")
    assert scoring.accuracy_rollup(one).filter("is_total = 1").count() == 1


def test_split_files_read_back(spark, tmp_path):
    rows = spark.createDataFrame([('say "a, b"', None, "train")], "a string, b string, split string")
    sinks.write_split(rows, str(tmp_path / "csv"), fmt="csv")
    schema = rows.drop("split").schema
    assert tables.read_csv_or_empty(spark, str(tmp_path / "csv/split=train"), schema, multi_line=False).first()["a"] == 'say "a, b"'
    sinks.write_split(rows, str(tmp_path / "json"))
    assert '"b":null' in "".join(r["value"] for r in spark.read.text(str(tmp_path / "json/split=train")).collect())
    again = tables.parse_jsonl(sinks.jsonl_lines(rows), "line", rows.schema)
    assert again.collect() == rows.collect()


def test_settings_of_a_given_session(spark):
    assert apply_settings(spark).conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
