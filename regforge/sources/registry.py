"""Landed registry JSON pages to flat tables.

Every page holds an array ``results``. A page without results yields no rows. Missing
and blank values become NULL. ``keep`` names columns of the page table (page number,
file name) to carry along; together with ``position`` they are the row order.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regforge import constants as C
from regforge.functions.columns import as_column, blank_to_null, explode_rows, joined
from regforge.operators.running import with_running_totals


#: Holds the text of a page that is no JSON of the schema.
REJECTED = "_rejected"


def read_pages(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """One row per JSON page file below ``path``. A page is one document (at most a
    thousand results), so one file per task record is the right unit.

    A corrupt page fails the read. With ``mode='PERMISSIVE'`` it stays as a row whose text
    is in the column ``_rejected``, which ``rejected_pages`` lists.
    """
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def parse_pages(
    df: DataFrame, payload: str | Column, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """The same for payloads that already are a text column.

    A corrupt payload stays as a row whose text is in the column ``_rejected``.
    """
    held = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    parsed = F.from_json(as_column(payload), held, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED})
    return df.select(*keep, parsed.alias("_page")).select(*keep, "_page.*")


def bounded_pages(pages: DataFrame, page: str, results: str = "results", limit: int | None = None) -> DataFrame:
    """The pages that a page loop would have read: up to the first page without results, by
    the number in column ``page`` (one row per number), and at most ``limit`` results in page
    order, the last page cut short.

    Only page numbers and counts are looked at to find the end; it is two numbers, which
    become a filter on the pages. This runs jobs. Pages without a number take no part.
    """
    counts = pages.select(F.col(page).alias("_page"), F.greatest(F.coalesce(F.size(results), F.lit(0)), F.lit(0)).cast("long").alias("_n"))
    end = counts.filter((F.col("_n") == 0) & F.col("_page").isNotNull()).agg(F.min("_page")).first()[0]
    kept = pages.filter(F.col(page).isNotNull() if end is None else F.col(page) < F.lit(end))
    if limit is None:
        return kept
    counts = counts.filter(F.col("_page").isNotNull() if end is None else F.col("_page") < F.lit(end))
    reached = with_running_totals(counts, ["_page"], {"_n": "_before"}).filter(F.col("_before") < limit)
    left = F.least(F.col("_n"), F.lit(limit) - F.col("_before")).cast("int")
    last = reached.agg(F.max("_page").alias("page"), F.max_by(left, "_page").alias("take")).first()
    if last["page"] is None:
        return kept.limit(0)
    cut = F.when(F.col(page) == F.lit(last["page"]), F.slice(results, 1, last["take"])).otherwise(F.col(results))
    return kept.filter(F.col(page) <= F.lit(last["page"])).withColumn(results, cut)


def rejected_pages(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The pages that could not be parsed, with their text."""
    # Spark refuses to read files for the corrupt column alone, so another one is looked at.
    other = next(name for name in pages.columns if name != REJECTED)
    return pages.filter(F.col(REJECTED).isNotNull() & (F.hash(other) >= -(1 << 31))).select(*keep, F.col(REJECTED).alias("page"))


def _first(values: str) -> Column:
    """First element of a list, NULL if the list is missing or empty."""
    return blank_to_null(F.get(F.col(values), F.lit(0)))


def _kept(keep: Sequence[str], position: str | None) -> list[str]:
    return [*keep, *([position] if position else [])]


def flatten_labels(
    pages: DataFrame, keep: Sequence[str] = (), position: str | None = None
) -> DataFrame:
    rows = explode_rows(pages, "results", "_r", keep, position)
    lists = {
        "brand_name": "_r.openfda.brand_name",
        "generic_name": "_r.openfda.generic_name",
        "manufacturer": "_r.openfda.manufacturer_name",
        "substance_name": "_r.openfda.substance_name",
        "product_type": "_r.openfda.product_type",
        "route": "_r.openfda.route",
        "application_number": "_r.openfda.application_number",
        "indications": "_r.indications_and_usage",
        "warnings": "_r.warnings",
        "dosage": "_r.dosage_and_administration",
        "active_ingredients": "_r.active_ingredient",
        "purpose": "_r.purpose",
    }
    return rows.select(
        *_kept(keep, position), *[_first(path).alias(name) for name, path in lists.items()]
    )


def flatten_events(
    pages: DataFrame,
    keep: Sequence[str] = (),
    position: str | None = None,
    drug_position: str | None = None,
) -> DataFrame:
    """One row per (event, drug). The reaction list is joined before the drug array is
    exploded, so it is built once per event."""
    events = explode_rows(pages, "results", "_r", keep, position)
    terms = F.transform(
        F.col("_r.patient.reaction"), lambda x: F.coalesce(x["reactionmeddrapt"], F.lit(""))
    )
    shared = events.select(
        *_kept(keep, position),
        joined(terms, C.NAME_SEPARATOR).alias("reactions"),
        blank_to_null("_r.patient.summary.narrativeincludeclinical").alias("outcome"),
        blank_to_null("_r.serious").alias("serious"),
        blank_to_null("_r.receivedate").alias("receive_date"),
        blank_to_null("_r.occurcountry").alias("country"),
        F.col("_r.patient.drug").alias("_drugs"),
    )
    per_event = ["reactions", "outcome", "serious", "receive_date", "country"]
    kept = _kept(keep, position)
    rows = explode_rows(shared, "_drugs", "_d", [*kept, *per_event], drug_position)
    return rows.select(
        *kept,
        *([drug_position] if drug_position else []),
        blank_to_null("_d.medicinalproduct").alias("drug_name"),
        blank_to_null("_d.drugindication").alias("drug_indication"),
        blank_to_null("_d.drugcharacterization").alias("drug_characterization"),
        *per_event,
    )


def flatten_recalls(
    pages: DataFrame, keep: Sequence[str] = (), position: str | None = None
) -> DataFrame:
    rows = explode_rows(pages, "results", "_r", keep, position)
    names = (
        "product_description", "reason_for_recall", "status", "classification", "recalling_firm",
        "recall_initiation_date", "voluntary_mandated", "city", "state",
    )
    return rows.select(
        *_kept(keep, position), *[blank_to_null(f"_r.{name}").alias(name) for name in names]
    )


def flatten_products(
    pages: DataFrame, keep: Sequence[str] = (), position: str | None = None
) -> DataFrame:
    rows = explode_rows(pages, "results", "_r", keep, position)
    described = F.transform(
        F.col("_r.active_ingredients"),
        lambda x: F.concat(
            F.coalesce(x["name"], F.lit("")),
            F.lit(" ("),
            F.coalesce(x["strength"], F.lit("")),
            F.lit(")"),
        ),
    )
    plain = (
        "product_ndc", "generic_name", "brand_name", "labeler_name", "dosage_form",
        "product_type", "marketing_category", "application_number",
    )
    flat = rows.select(
        *_kept(keep, position),
        *[blank_to_null(f"_r.{name}").alias(name) for name in plain],
        joined(described, C.VALUE_SEPARATOR).alias("active_ingredients"),
        joined(F.col("_r.route"), C.NAME_SEPARATOR).alias("route"),
    )
    return flat.select(
        *_kept(keep, position), "product_ndc", "generic_name", "brand_name", "labeler_name",
        "active_ingredients", "dosage_form", "route", "product_type", "marketing_category",
        "application_number",
    )
