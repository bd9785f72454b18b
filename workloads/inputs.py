"""Views on the test tables in the shapes the operators expect.

Every view is a projection, filter or equi-join: it grows with its table, and nothing
is collected, capped or sampled.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regforge import constants as C
from regforge.functions.columns import packed_position
from regforge.operators.compare import BASE, TUNED
from regforge.plans.datasets import Extracts

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
LINE_BITS = 8
KEYWORDS = ("the", "and", "de", "la", "tion", "en", "und", "que")
KEYWORDS_BY_LANGUAGE = {
    "en": ("The", "and", "tion", "where"),
    "fr": ("la", "EAU", "tion", "pas", "elle"),
    "de": ("und", "Der", "ein"),
    "es": ("que", "los", "cion", "el"),
}
DOCUMENT_STATUSES = {1: "approved", 0: "TERMINATED"}
ORDER_STATUSES = {"F": "TERMINATED", "O": "COMPLETED", "P": "SUSPENDED"}
ORDER_TASKS = {
    "1-URGENT": C.TASK_STATUS,
    "2-HIGH": C.TASK_REACTIONS,
    "3-MEDIUM": C.TASK_IDENTIFY,
    "5-LOW": C.TASK_FAILURE,
}
TURN_TASKS = (C.TASK_STATUS, C.TASK_REACTIONS, C.TASK_STRUCTURE)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    return partial(table, spark, folder)


def mapped(column: str | Column, values: dict) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(
        *[F.when(column == key, F.lit(value)) for key, value in values.items()],
        F.lit(None).cast("string"),
    )


def entity_name() -> Column:
    return F.concat_ws(" ", "p_name", F.col("p_size").cast("string"))


def line_position() -> Column:
    return packed_position("l_orderkey", "l_linenumber", LINE_BITS)


def parts_named(t: Callable[[str], DataFrame]) -> DataFrame:
    return t("part").select("p_partkey", entity_name().alias("drug_name"))


def extracts(t: Callable[[str], DataFrame]) -> Extracts:
    """Parts are the entities: registry, labels and structures have a row per part, line
    items are the trials (status from the order) and the adverse events. The registry names
    PROMO parts only, labels LARGE and PROMO parts, and the structures of large parts belong
    to names that nothing else has."""
    part, lines, orders = t("part"), t("lineitem"), t("orders")
    named = parts_named(t)
    registry = part.select(F.when(F.col("p_type") == "PROMO", entity_name()).alias("ingredient"))
    labels = part.select(
        F.when(F.col("p_type").isin("LARGE", "PROMO"), entity_name()).alias("brand_name"), F.lit(None).cast("string").alias("generic_name")
    )
    line_names = lines.join(named, lines["l_partkey"] == named["p_partkey"])
    trials = line_names.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("drug_name").alias("drug_names"),
        mapped("o_orderstatus", ORDER_STATUSES).alias("status"),
        F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("why_stopped"),
        line_position().alias("position"),
    )
    adverse = line_names.select(
        "drug_name",
        F.concat(F.lit("quantity "), F.col("l_quantity").cast("int").cast("string")).alias("reactions"),
        line_position().alias("position"),
    )
    structures = part.select(
        F.when(F.col("p_size") <= 25, entity_name()).otherwise(F.concat(F.lit("unseen "), entity_name())).alias("drug_name"),
        F.col("p_partkey").alias("cid"),
        F.col("p_brand").alias("molecular_formula"),
        F.col("p_retailprice").alias("molecular_weight"),
        F.concat_ws("/", "p_brand", "p_type", F.col("p_partkey").cast("string")).alias("canonical_smiles"),
    )
    return Extracts(
        registry=registry,
        labels=labels,
        trials=trials,
        structures=structures,
        adverse_events=adverse,
        failed_trials=trials.filter(F.col("status").isin(*C.STOPPED_STATUSES)),
    )


def turn_pairs(t: Callable[[str], DataFrame]) -> DataFrame:
    """A user turn (reference) and the assistant turn after it (prediction)."""
    turns = t("conversations")
    user = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("reference")
    )
    reply = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction")
    )
    task = mapped(F.col("turn") % 3, dict(enumerate(TURN_TASKS)))
    return user.join(reply, ["conv_id", "turn"]).withColumn("task", task)


def order_pairs(t: Callable[[str], DataFrame]) -> DataFrame:
    """An order described in one sentence (prediction) and the order with the next key
    in another (reference); the task comes from the priority, one has none."""
    status = F.lower(mapped("o_orderstatus", ORDER_STATUSES))
    orders = t("orders")
    prediction = F.concat(
        F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" is "), status,
        F.lit(" with priority "), "o_orderpriority",
    )
    reference = F.concat(F.lit("The order was "), status, F.lit(", Priority "), "o_orderpriority")
    this = orders.select(
        "o_orderkey",
        prediction.alias("prediction"),
        F.col("o_orderpriority").alias("priority"),
        mapped("o_orderpriority", ORDER_TASKS).alias("task"),
    )
    following = orders.select(
        (F.col("o_orderkey") - 1).alias("o_orderkey"),
        reference.alias("reference"),
        F.col("o_orderpriority").alias("next_priority"),
    )
    return this.join(following, "o_orderkey")


def prompt_id() -> Column:
    """The prompt of a turn pair."""
    return F.concat_ws(
        "-", F.lpad(F.col("conv_id").cast("string"), 12, "0"), F.lpad(F.col("turn").cast("string"), 6, "0")
    ).alias("prompt_id")


def responses(t: Callable[[str], DataFrame]) -> DataFrame:
    """Both texts of a turn pair as answers of two models, from one pass."""
    pairs = turn_pairs(t)
    both = F.array(
        F.struct(F.lit(BASE).alias("model"), F.col("reference").alias("response")),
        F.struct(F.lit(TUNED).alias("model"), F.col("prediction").alias("response")),
    )
    rows = pairs.select(prompt_id(), "task", F.inline(both))
    return rows.withColumns(
        {
            "latency": F.length("response") / F.lit(100.0),
            "expected_keywords": F.array(*[F.lit(word) for word in KEYWORDS]),
        }
    )


def label_pages(t: Callable[[str], DataFrame]) -> DataFrame:
    """Each part as a landed label page."""
    def one(column: str | Column) -> Column:
        return F.array(F.col(column) if isinstance(column, str) else column)

    openfda = F.struct(
        one("p_brand").alias("brand_name"),
        F.split("p_name", " ").alias("generic_name"),
        F.when(F.col("p_size") > 25, one("p_type")).alias("manufacturer_name"),
        F.slice(one("p_type"), 1, F.when(F.col("p_size") > 10, 1).otherwise(0)).alias("product_type"),
    )
    label = F.struct(openfda.alias("openfda"), one(F.concat(F.lit("for "), "p_name")).alias("warnings"))
    return t("part").select("p_partkey", F.to_json(F.struct(F.array(label).alias("results"))).alias("payload"))


def event_pages(t: Callable[[str], DataFrame]) -> DataFrame:
    """Each line item as an event on two drugs with two reactions."""
    drugs = F.array(
        F.struct(
            F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("medicinalproduct"),
            F.col("l_linestatus").alias("drugindication"),
        ),
        F.struct(
            F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("medicinalproduct"),
            F.lit("").alias("drugindication"),
        ),
    )
    reactions = F.array(
        F.struct(F.col("l_returnflag").alias("reactionmeddrapt")),
        F.struct(F.col("l_linestatus").alias("reactionmeddrapt")),
    )
    event = F.struct(
        F.when(F.col("l_quantity") > 25, "1").alias("serious"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("receivedate"),
        F.struct(drugs.alias("drug"), reactions.alias("reaction")).alias("patient"),
    )
    return t("lineitem").select(
        "l_orderkey", F.to_json(F.struct(F.array(event).alias("results"))).alias("payload")
    )


def recall_pages(t: Callable[[str], DataFrame]) -> DataFrame:
    suppliers, nations = t("supplier"), t("nation")
    recall = F.struct(
        F.concat(F.lit("lot "), F.col("s_suppkey").cast("string")).alias("product_description"),
        F.when(F.col("s_acctbal") < 0, "debt").otherwise("").alias("reason_for_recall"),
        F.col("s_name").alias("recalling_firm"),
        F.col("n_name").alias("state"),
    )
    joined = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(
        "s_suppkey", F.to_json(F.struct(F.array(recall).alias("results"))).alias("payload")
    )


def product_pages(t: Callable[[str], DataFrame]) -> DataFrame:
    strength = F.concat(F.col("p_size").cast("string"), F.lit(" mg"))
    product = F.struct(
        F.col("p_partkey").cast("string").alias("product_ndc"),
        F.col("p_name").alias("generic_name"),
        F.transform(
            F.split("p_name", " "), lambda word: F.struct(word.alias("name"), strength.alias("strength"))
        ).alias("active_ingredients"),
        F.split("p_type", "A").alias("route"),
        F.col("p_brand").alias("labeler_name"),
    )
    return t("part").select(F.to_json(F.struct(F.array(product).alias("results"))).alias("payload"))


def trial_pages(t: Callable[[str], DataFrame]) -> DataFrame:
    """Each order as a study with three interventions, one or two of them drugs."""
    interventions = F.array(
        F.struct(F.lit("DRUG").alias("type"), F.concat(F.lit("drug "), F.col("o_custkey").cast("string")).alias("name")),
        F.struct(F.lit("DEVICE").alias("type"), F.lit("meter").alias("name")),
        F.struct(
            F.when(F.col("o_orderstatus") == "F", "BIOLOGICAL").otherwise("OTHER").alias("type"),
            F.col("o_orderpriority").alias("name"),
        ),
    )
    section = F.struct(
        F.struct(F.col("o_orderkey").cast("string").alias("nctId")).alias("identificationModule"),
        F.struct(
            mapped("o_orderstatus", ORDER_STATUSES).alias("overallStatus"),
            F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).alias("startDateStruct"),
        ).alias("statusModule"),
        F.struct(
            F.array("o_orderpriority", "o_orderstatus").alias("phases"),
            F.struct(F.col("o_custkey").cast("string").alias("count")).alias("enrollmentInfo"),
        ).alias("designModule"),
        F.struct(interventions.alias("interventions")).alias("armsInterventionsModule"),
        F.struct(F.array(F.struct(F.col("o_orderpriority").alias("measure"))).alias("primaryOutcomes")).alias(
            "outcomesModule"
        ),
        F.struct(F.struct(F.lit("").alias("name"), F.lit("INDUSTRY").alias("class")).alias("leadSponsor")).alias(
            "sponsorCollaboratorsModule"
        ),
    )
    study = F.struct(section.alias("protocolSection"))
    return t("orders").select(F.to_json(F.struct(F.array(study).alias("studies"))).alias("payload"))
