import pytest
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.operators import enrich, instruct, joins, names, topk
from regforge.operators.generate import batch_generate


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- names -----------------------------------------------------------------------
def tagged(spark):
    registry = spark.createDataFrame(
        [("Alpha", "Beta"), ("Beta", None), ("  ", "")], "ingredient string, trade_name string"
    )
    trials = spark.createDataFrame(
        [
            (5, "Gamma", "COMPLETED"), (1, "Gamma, Delta", None), (3, "Gamma", "TERMINATED"),
            (2, " Alpha , ", "WITHDRAWN"), (4, None, "COMPLETED"), (6, "alpha", "SUSPENDED"),
        ],
        "position long, drug_names string, status string",
    )
    return [
        names.names_from_columns(registry, ["ingredient", "trade_name", "absent"], "reg"),
        names.names_from_lists(trials, "drug_names", "tri", "status", "position"),
    ]


def test_name_dictionary(spark):
    got = rows_of(names.name_dictionary(tagged(spark), ["reg", "tri"]), "drug_name", "source", "status")
    assert got == [
        ("Alpha", "reg, tri", "approved"),  # registry status wins
        ("Beta", "reg", "approved"),
        ("Delta", "tri", None),  # only a NULL status
        ("Gamma", "tri", "TERMINATED"),  # NULL at position 1 is skipped, 3 comes before 5
        ("alpha", "tri", "SUSPENDED"),  # case-sensitive
    ]


def test_source_order_decides_not_alphabet(spark):
    got = rows_of(names.name_dictionary(tagged(spark), ["tri", "reg"]), "drug_name", "source", "status")
    assert ("Alpha", "reg, tri", "WITHDRAWN") in got


def test_explode_names_keeps_digits_and_drops_blanks(spark):
    df = spark.createDataFrame([(1, "drug 10, drug 20,  , x "), (2, ""), (3, None), (4, "a,b")], "id int, l string")
    assert rows_of(names.explode_names(df, "l", ["id"]), "id", "drug_name") == [
        (1, "drug 10"), (1, "drug 20"), (1, "x"), (4, "a,b"),
    ]
    piped = names.explode_names(df.selectExpr("replace(l, ', ', '|') l"), "l", name="n", separator="|")
    assert rows_of(piped, "n") == [("a,b",), ("drug 10",), ("drug 20",), ("x",)]


def test_names_with_a_separator_survive_as_arrays(spark):
    df = spark.createDataFrame([(1, ["a, b", " "], "S")], "position long, l array<string>, status string")
    listed = names.names_from_lists(df, "l", "tri", "status", "position", separator=None)
    assert rows_of(names.name_dictionary([listed], ["tri"]), "drug_name") == [("a, b",)]


# --- first k ---------------------------------------------------------------------
def test_first_k_distinct(spark):
    data = [
        ("a", "v3", 3), ("a", "v1", 9), ("a", "v1", 1), ("a", "v2", 2), ("a", "v4", 4),
        ("b", None, 1), ("b", "", 2), (None, "x", 1), ("c", "z", 1), ("c", "y", 1),
    ]
    df = spark.createDataFrame(data, "k string, v string, p long").repartition(5)
    got = rows_of(topk.first_k_distinct(df, "k", "v", "p", 3, "k", "vs"), "k", "vs")
    assert got == [("a", "v1; v2; v3"), ("c", "y; z")]


def test_first_k_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("v"), F.col("id").alias("p"))
    plan = topk.first_k_distinct(df, "k", "v", "p", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# --- enrichment ------------------------------------------------------------------
DICTIONARY = [("x", 1, 1.5), ("y", 2, None)]


def test_enrich_suffixes_clashes_and_keeps_misses(spark):
    df = spark.createDataFrame([(1, "x", 9.0), (2, "q", 8.0), (3, None, 7.0), (4, "x", 6.0)], "id int, name string, weight double")
    dictionary = spark.createDataFrame(DICTIONARY, "drug_name string, cid int, weight double")
    got = enrich.enrich(df, "name", dictionary)
    assert got.columns == ["id", "name", "weight", "drug_name", "cid", "weight_pubchem"]
    assert rows_of(got, "id", "cid", "weight", "weight_pubchem") == [
        (1, 1, 9.0, 1.5), (2, None, 8.0, None), (3, None, 7.0, None), (4, 1, 6.0, 1.5),
    ]
    same_key = enrich.enrich(df.withColumnRenamed("name", "drug_name"), "drug_name", dictionary)
    assert same_key.columns == ["id", "drug_name", "weight", "cid", "weight_pubchem"]


def test_lookup_keeps_misses_and_drops_blanks(spark):
    df = spark.createDataFrame([(" x ",), ("x",), ("q",), (" ",), (None,), ("x",)], "name string")
    dictionary = spark.createDataFrame(DICTIONARY, "drug_name string, cid int, weight double")
    got = rows_of(enrich.lookup_names(df, "name", dictionary), "drug_name", "cid")
    assert got == [(" x ", 1), ("q", None), ("x", 1)]


def test_update_overwrites_only_hits(spark):
    df = spark.createDataFrame([(1, "x", None, None, "f"), (2, "y", "old", 2.0, "f"), (3, "q", "old", 3.0, "f")], "id int, n string, s string, w double, f string")
    dictionary = spark.createDataFrame([("x", "C", None, "g"), ("y", None, 9.0, "g")], "k string, s string, w double, f string")
    got = enrich.update_from(df, "n", dictionary, "k", ["s", "w"])
    assert got.columns == df.columns
    assert rows_of(got, *df.columns) == [(1, "x", "C", None, "f"), (2, "y", "old", 2.0, "f"), (3, "q", "old", 3.0, "f")]


def test_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 2, "p"), ("a", 1, "q"), (None, 0, "r"), ("b", 1, None)], "k string, o int, v string")
    assert rows_of(enrich.one_row_per_key(df, "k", ["o"]), "k", "o", "v") == [("a", 1, "q"), ("b", 1, None)]


def test_left_join_many_equals_a_left_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, l int")
    right = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 7), (None, 8), ("z", 9)], "k string, r int")
    assert rows_of(joins.left_join_many(left, right, "k"), "k", "l", "r") == rows_of(left.join(right, "k", "left"), "k", "l", "r")


def test_missing_and_coverage(spark):
    df = spark.createDataFrame([("a", "C", 1), ("b", "", None), ("c", None, 2)], "n string, s string, i int")
    assert rows_of(enrich.missing_attribute(df, "s"), "n") == [("b",), ("c",)]
    assert rows_of(enrich.missing_attribute(df, "i"), "n") == [("b",)]
    assert rows_of(enrich.coverage(df, "i"), "total", "found", "not_found") == [(3, 2, 1)]


# --- instructions ----------------------------------------------------------------
UNIFIED = "drug_name string, status string, canonical_smiles string, adverse_reactions string, failure_reason string"


def instructions(spark, *rows, schema=UNIFIED, **options):
    return instruct.instruction_rows(spark.createDataFrame(list(rows), schema), **options)


def test_all_five_questions(spark):
    got = {r["task"]: r for r in instructions(spark, ("Dox", "SUSPENDED", "CCO", "rash; pain", "slow")).collect()}
    assert set(got) == {C.TASK_STATUS, C.TASK_REACTIONS, C.TASK_STRUCTURE, C.TASK_IDENTIFY, C.TASK_FAILURE}
    assert got[C.TASK_STATUS]["input"] == "Drug: Dox\nSMILES: CCO"
    assert got[C.TASK_STATUS]["output"] == "Dox has a status of SUSPENDED. Reason: slow"
    assert got[C.TASK_REACTIONS]["output"] == "Known adverse reactions for Dox include: rash; pain"
    assert got[C.TASK_IDENTIFY]["input"] == "SMILES: CCO"
    assert got[C.TASK_FAILURE]["output"] == "Dox failed because: slow"


def test_status_is_case_sensitive_and_reason_has_a_default(spark):
    rows = instructions(
        spark, ("A", "approved", None, None, None), ("B", "Approved", None, None, None),
        ("C", "TERMINATED", None, None, None), ("D", None, "", "", " "),
    )
    got = rows_of(rows, "instruction", "output")
    assert [g[0] for g in got] == ["What is the approval status of A?", "What is the status of C and why?"]
    assert got[1][1].endswith("Reason: Unknown reasons")


@pytest.mark.parametrize("name", [None, "", "  ", "Unknown"])
def test_unusable_names_are_skipped(spark, name):
    assert instructions(spark, (name, "approved", "CCO", "r", "f")).count() == 0


def test_absent_columns_count_as_missing(spark):
    rows = instructions(spark, ("A", "approved"), schema="drug_name string, status string", keep=["drug_name"])
    assert rows_of(rows, "drug_name", "task", "input") == [("A", C.TASK_STATUS, "Drug: A")]


def test_classification_keeps_the_first_name_per_structure(spark):
    df = spark.createDataFrame(
        [("b", "CC", "approved", 1.0), ("a", "CC", "WITHDRAWN", 2.0), ("c", None, "approved", 3.0), ("d", "O", None, None), ("e", "", "approved", 1.0)],
        "drug_name string, canonical_smiles string, status string, molecular_weight double",
    )
    got = instruct.classification_rows(df)
    assert got.columns == ["drug_name", "canonical_smiles", "status", "label", "molecular_weight"]
    assert rows_of(got, *got.columns) == [("a", "CC", "WITHDRAWN", 0, 2.0), ("d", "O", None, 0, None)]
    assert rows_of(instruct.class_balance(got), "positive", "negative") == [(0, 2)]


def test_status_score_and_length_filter(spark):
    df = spark.createDataFrame([("COMPLETED", "abcde"), ("recruiting", "abc"), ("other", None)], "s string, t string")
    assert rows_of(df, "s", instruct.status_score("s")) == [("COMPLETED", 1.0), ("other", None), ("recruiting", 0.5)]
    assert instruct.with_structure_length(df, "t").count() == 1


def test_length_budget(spark):
    df = spark.createDataFrame([(1, "a  b\nc d"), (2, None)], "id int, t string")
    got = rows_of(instruct.length_budget(df, "t", 3, ["id"]), "id", "n_tokens", "over_budget", "text")
    assert got == [(1, 4, True, "a  b\nc"), (2, 0, False, "")]


# --- generation ------------------------------------------------------------------
def test_batch_generate_loads_once_per_task_and_passes_options(spark):
    def make(suffix):
        loads = [0]
        loads[0] += 1

        def generate(batch):
            return [f"{i}{suffix}{loads[0]}" for i in batch["id"]]

        return generate

    got = batch_generate(spark.range(20).repartition(4), make, suffix="-")
    assert got.columns == ["id", "response"]
    assert rows_of(got, "id", "response") == sorted(((i, f"{i}-1") for i in range(20)), key=str)
