import json

from pyspark.sql import functions as F

from regforge import schemas, sinks
from regforge.sources import delimited, registry, structures, tables, trials
from regforge.streaming.landing import land, stream_pages


def pages(spark, tmp_path, schema, *documents):
    folder = tmp_path / "pages"
    folder.mkdir()
    for i, document in enumerate(documents):
        # Landed pages are pretty-printed documents, not one line each.
        (folder / f"page{i}.json").write_text(json.dumps(document, indent=1, ensure_ascii=False), encoding="utf-8")
    return registry.read_pages(spark, str(folder), schema)


def test_extracts_are_found_below_the_folder_with_their_encoding(spark, tmp_path):
    nested = tmp_path / "a" / "b"
    nested.mkdir(parents=True)
    (nested / "products.txt").write_bytes(
        "Ingredient~DF;Route~Trade_Name~Applicant Full Name \nCAFÉINE~TABLET;ORAL~\"UP\"~ACME, INC\n".encode("latin-1")
    )
    (nested / "patent.txt").write_text("Appl_No~Patent No\n1~2\n")
    (nested / "exclusivity.txt").write_text("Appl_No~Exclusivity Code\n1~ODE\n2~\n")
    products = delimited.read_products(spark, str(tmp_path))
    assert products.columns == ["ingredient", "df;route", "trade_name", "applicant_full_name"]
    assert tuple(products.first()) == ("CAFÉINE", "TABLET;ORAL", "UP", "ACME, INC")
    assert delimited.read_patents(spark, str(tmp_path)).columns == ["appl_no", "patent_no"]
    codes = delimited.read_exclusivity(spark, str(tmp_path)).orderBy("appl_no").collect()
    assert [tuple(r) for r in codes] == [("1", "ODE"), ("2", None)]


def test_labels_take_first_elements(spark, tmp_path):
    full = {"openfda": {"brand_name": ["A", "B"], "route": []}, "warnings": ["w1", "w2"], "purpose": [""]}
    rows = registry.flatten_labels(
        pages(spark, tmp_path, schemas.LABEL_PAGE, {"results": [full, {}]}, {"results": []}, {"error": "x"})
    )
    assert rows.columns == schemas.LABELS.names
    got = sorted(((r["brand_name"], r["route"], r["warnings"], r["purpose"]) for r in rows.collect()), key=str)
    assert got == [("A", None, "w1", None), (None, None, None, None)]


def test_events_have_one_row_per_drug(spark, tmp_path):
    event = {
        "serious": "1", "receivedate": "20200102",
        "patient": {
            "drug": [{"medicinalproduct": "X", "drugcharacterization": "1"}, {"medicinalproduct": ""}],
            "reaction": [{"reactionmeddrapt": "Nausea"}, {"reactionmeddrapt": "Rash"}],
        },
    }
    no_drugs = {"serious": "2", "patient": {"reaction": []}}
    rows = registry.flatten_events(
        pages(spark, tmp_path, schemas.EVENT_PAGE, {"results": [event, no_drugs]}),
        position="position", drug_position="drug",
    )
    got = sorted((r["position"], r["drug"], r["drug_name"], r["reactions"], r["receive_date"]) for r in rows.collect())
    assert [g[:2] for g in got] == [(0, 0), (0, 1)]
    assert got[0][2:] == ("X", "Nausea, Rash", "20200102") and got[1][2] is None


def test_recalls_and_products(spark, tmp_path):
    recall = {"product_description": "p", "status": "", "city": "C"}
    rows = registry.flatten_recalls(pages(spark, tmp_path, schemas.RECALL_PAGE, {"results": [recall]}))
    assert rows.columns == schemas.RECALLS.names
    assert (rows.first()["status"], rows.first()["city"]) == (None, "C")
    product = {
        "product_ndc": "1-2", "active_ingredients": [{"name": "N", "strength": "5 mg"}, {"name": "M"}], "route": ["ORAL", "NASAL"],
    }
    (tmp_path / "more").mkdir()
    rows = registry.flatten_products(
        pages(spark, tmp_path / "more", schemas.PRODUCT_PAGE, {"results": [product, {"product_ndc": "3"}]})
    )
    assert rows.columns == schemas.PRODUCTS.names
    got = {r["product_ndc"]: (r["active_ingredients"], r["route"]) for r in rows.collect()}
    assert got == {"1-2": ("N (5 mg); M ()", "ORAL, NASAL"), "3": (None, None)}


def study(status, phases=(), reason=None, interventions=(), count=None):
    module = {
        "identificationModule": {"nctId": f"N-{status}"},
        "statusModule": {"overallStatus": status, **({"whyStopped": reason} if reason is not None else {})},
        "designModule": {"phases": list(phases), "enrollmentInfo": {"count": count}},
        "armsInterventionsModule": {"interventions": [{"type": t, "name": n} for t, n in interventions]},
        "sponsorCollaboratorsModule": {"leadSponsor": {"name": "S", "class": "INDUSTRY"}},
    }
    return {"protocolSection": module}


def test_trials(spark, tmp_path):
    document = {
        "studies": [
            study("COMPLETED", ["PHASE2", "PHASE3"], interventions=[("DRUG", "a, b"), ("DEVICE", "d"), ("BIOLOGICAL", "v")], count=40),
            study("TERMINATED", reason="no money", count="many"),
            study("WITHDRAWN", reason=""),
            study("COMPLETED", ["PHASE1"]),
        ]
    }
    flat = trials.flatten_trials(pages(spark, tmp_path, schemas.TRIAL_PAGE, document), arrays=True, position="position")
    rows = {r["position"]: r for r in flat.collect()}
    assert flat.drop("position", "drug_name_list", "phase_list").columns == schemas.TRIALS.names
    assert rows[0]["drug_names"] == "a, b, v" and rows[0]["drug_name_list"] == ["a, b", "v"]
    assert rows[0]["intervention_types"] == "DRUG, DEVICE, BIOLOGICAL" and rows[0]["phase"] == "PHASE2, PHASE3"
    assert [rows[i]["enrollment"] for i in (0, 1)] == [40, None]
    assert rows[0]["sponsor_type"] == "INDUSTRY" and rows[3]["drug_names"] is None
    assert [r["position"] for r in trials.failed_trials(flat).collect()] == [1]
    assert [r["position"] for r in trials.completed_trials(flat).collect()] == [0]


def test_empty_trials_are_an_empty_table(spark, tmp_path):
    flat = trials.flatten_trials(pages(spark, tmp_path, schemas.TRIAL_PAGE, {"studies": []}))
    assert trials.failed_trials(flat).count() == 0


def test_structures(spark, tmp_path):
    def payload(**properties):
        return {"PropertyTable": {"Properties": [properties]}}

    found = pages(
        spark, tmp_path, schemas.STRUCTURE_PAYLOAD,
        payload(CID=7, MolecularWeight="46.07", CanonicalSMILES="", ConnectivitySMILES="CCO"),
        {"Fault": {}},
    )
    rows = structures.flatten_structures(found).orderBy(F.col("cid").asc_nulls_last()).collect()
    assert (rows[0]["cid"], rows[0]["molecular_weight"], rows[0]["canonical_smiles"]) == (7, 46.07, "CCO")
    assert all(value is None for value in rows[1])


def test_optional_csv(spark, tmp_path):
    schema = schemas.STRUCTURES
    assert tables.read_csv_or_empty(spark, str(tmp_path / "none.csv"), schema).count() == 0
    blank = tmp_path / "blank.csv"
    blank.write_text("\n")
    assert tables.read_csv_or_empty(spark, str(blank), schema).count() == 0
    row = [("say \"hi\", all", 702, None, 46.07, "C\nC", None, None, None)]
    sinks.write_csv(spark.createDataFrame(row, schema), str(tmp_path / "out"))
    back = tables.read_csv_or_empty(spark, str(tmp_path / "out"), schema)
    assert back.schema == schema and [tuple(r) for r in back.collect()] == row


def test_jsonl_keeps_unicode_and_skips_blank_lines(spark, tmp_path):
    rows = [("何?", "é", None, "t")]
    sinks.write_jsonl(spark.createDataFrame(rows, schemas.INSTRUCTIONS), str(tmp_path / "out"))
    part = next(p for p in (tmp_path / "out").glob("*.json") if p.stat().st_size)
    assert json.loads(part.read_text(encoding="utf-8")) == dict(zip(schemas.INSTRUCTIONS.names, rows[0]))
    assert "何" in part.read_text(encoding="utf-8")
    (tmp_path / "out" / "blank.json").write_text("\n\n")
    assert [tuple(r) for r in tables.read_jsonl(spark, str(tmp_path / "out"), schemas.INSTRUCTIONS).collect()] == rows


def test_source_summary(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    sources = {
        "there": spark.range(3),
        "opened": lambda: spark.range(2),
        "missing": lambda: spark.read.parquet(str(tmp_path / "none")),
        "broken": lambda: spark.read.parquet(str(tmp_path / "bad")),
    }
    got = {r["source"]: (r["records"], r["status"]) for r in tables.source_summary(spark, sources).collect()}
    assert got == {
        "there": (3, "Available"), "opened": (2, "Available"),
        "missing": (None, "Not downloaded"), "broken": (None, "Error"),
    }


def test_optional_columns_and_first_rows(spark):
    df = spark.range(10).withColumn("w", F.lit(1.0))
    assert tables.select_optional(df, ["id"], ["w", "absent"]).columns == ["id", "w"]
    assert [r[0] for r in tables.first_rows(df, 3, F.desc("id")).select("id").collect()] == [9, 8, 7]


def test_landing_continues_where_it_stopped(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()

    def run():
        found = stream_pages(spark, str(folder), schemas.RECALL_PAGE)
        query = land(found, registry.flatten_recalls, str(tmp_path / "table"), str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        return spark.read.schema(schemas.RECALLS).parquet(str(tmp_path / "table")).count()

    def page(i, n):
        (folder / f"{i}.json").write_text(json.dumps({"results": [{"city": f"{i}-{k}"} for k in range(n)]}, indent=1))

    page(0, 2)
    page(1, 0)
    assert run() == 2
    page(2, 3)
    assert run() == 5
