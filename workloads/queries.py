"""One query per operator: ``(spark, folder) -> DataFrame``.

Doubles are rounded here, not in the library, so that both engines print the same
value.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regforge import constants as C
from regforge import schemas, sinks
from regforge.functions import text as X
from regforge.functions.columns import explode_rows
from regforge.operators import bootstrap, compare, enrich, instruct, metrics, names, scoring, split, topk
from regforge.operators.generate import batch_generate, generate_rest
from regforge.plans.datasets import Extracts, build_datasets, entity_names, unified_table
from regforge.plans.dictionary import StoredDictionary
from regforge.plans.evaluation import evaluation_by_task, metric_report
from regforge.plans.incremental import NameState, current_names, landing, merge_landing
from regforge.plans.stages import stage_folder
from regforge.sources import delimited, positions, registry, structures, tables, trials
from workloads import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 6


def query(function: Callable) -> Query:
    """Register ``function(t, spark, folder)`` under its name; ``t`` opens a table."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(I.reader(spark, folder), spark, folder)

    QUERIES[function.__name__] = run
    return run


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), DIGITS).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema
        ]
    )


# --- sources ---------------------------------------------------------------------
@query
def scan_delimited(t, spark, folder):
    fields = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    lines = t("part").select(F.concat_ws("~", *[F.col(c).cast("string") for c in fields]).alias("line"))
    schema = T.StructType(
        [
            T.StructField("Part Key", T.LongType()),
            *[T.StructField(n, T.StringType()) for n in (" Trade Name", "Brand", "DF;Route ")],
            T.StructField("Size", T.IntegerType()),
            T.StructField("Price", T.DoubleType()),
        ]
    )
    return delimited.parse_lines(lines, "line", schema).withColumnRenamed("df;route", "df_route")


@query
def flatten_labels(t, spark, folder):
    pages = registry.parse_pages(I.label_pages(t), "payload", schemas.LABEL_PAGE, ["p_partkey"])
    return registry.flatten_labels(pages, ["p_partkey"])


@query
def flatten_events(t, spark, folder):
    pages = registry.parse_pages(I.event_pages(t), "payload", schemas.EVENT_PAGE, ["l_orderkey"])
    return registry.flatten_events(pages, ["l_orderkey"], drug_position="drug_position")


@query
def flatten_recalls(t, spark, folder):
    pages = registry.parse_pages(I.recall_pages(t), "payload", schemas.RECALL_PAGE, ["s_suppkey"])
    return registry.flatten_recalls(pages, ["s_suppkey"])


@query
def flatten_ingredients(t, spark, folder):
    return registry.flatten_products(
        registry.parse_pages(I.product_pages(t), "payload", schemas.PRODUCT_PAGE)
    )


@query
def flatten_trials(t, spark, folder):
    return trials.flatten_trials(
        registry.parse_pages(I.trial_pages(t), "payload", schemas.TRIAL_PAGE)
    )


@query
def structure_coalesce(t, spark, folder):
    props = F.from_json("props", "missing string, k string")
    rows = t("events").select("event_id", props.alias("p"))
    return rows.select("event_id", structures.first_filled("p.missing", "p.k").alias("structure"))


@query
def flatten_structures(t, spark, folder):
    """Parts as look-up payloads; large ones without properties, small ones with the second name of the structure."""
    small = F.col("p_size") <= 10
    found = F.struct(
        F.col("p_partkey").alias("CID"), F.col("p_brand").alias("MolecularFormula"),
        F.when(F.col("p_size") == 20, "heavy").otherwise(F.col("p_retailprice").cast("string")).alias("MolecularWeight"),
        F.when(small, "").otherwise(F.col("p_type")).alias("CanonicalSMILES"), F.col("p_name").alias("ConnectivitySMILES"),
    )
    pages = t("part").select(
        "p_partkey",
        F.to_json(F.struct(F.struct(F.when(F.col("p_size") <= 40, F.array(found)).alias("Properties")).alias("PropertyTable"))).alias("payload"),
    )
    parsed = registry.parse_pages(pages, "payload", schemas.STRUCTURE_PAYLOAD, ["p_partkey"])
    return structures.flatten_structures(parsed, ["p_partkey"])


@query
def limit_ordered(t, spark, folder):
    return tables.first_rows(t("documents").select("doc_id", "lang", "n_chars"), 100, "doc_id")


@query
def source_summary(t, spark, folder):
    return tables.source_summary(spark, {name: (lambda n=name: t(n)) for name in (*I.TABLES, "recalls")})


@query
def jsonl_roundtrip(t, spark, folder):
    customers = t("customer")
    return tables.parse_jsonl(sinks.jsonl_lines(customers), "line", customers.schema)


def _extract(t, folder: str) -> None:
    """Parts as a delimited extract with a header, two folders below ``folder``."""
    fields = [F.col("p_partkey").alias("Appl No "), F.col("p_name").alias("Patent No"), F.col("p_brand").alias("Use Code"), F.col("p_size").alias("Expire Date")]
    t("part").select(*fields).write.option("sep", delimited.DELIMITER).option("header", True).option("encoding", delimited.ENCODING).csv(f"{folder}/data/latest")


@query
def read_patents(t, spark, folder):
    path = stage_folder(spark)
    _extract(t, path)
    return delimited.read_patents(spark, path, "*.csv")


@query
def read_exclusivity(t, spark, folder):
    path = stage_folder(spark)
    _extract(t, path)
    return delimited.read_exclusivity(spark, path, "*.csv").drop("use_code")


@query
def csv_roundtrip(t, spark, folder):
    """Texts with line ends, quotes and commas through the CSV writer and reader."""
    path = stage_folder(spark)
    rows = t("documents").select("doc_id", "text", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit('say "'), "lang", F.lit('", ok'))).alias("quoted"))
    sinks.write_csv(rows, path)
    return tables.read_csv_or_empty(spark, path, rows.schema)


@query
def split_files(t, spark, folder):
    """A split data set as it is written, read back."""
    path = stage_folder(spark)
    sinks.write_split(split.split_by_hash(t("documents").select("doc_id", "lang"), "doc_id"), path)
    return spark.read.schema("doc_id long, lang string, split string").json(path)


@query
def result_document(t, spark, folder):
    """The parts of a written result, read back."""
    path = stage_folder(spark)
    scored = scoring.with_task_score(I.order_pairs(t))
    by_task = rounded(scoring.score_by_task(scored)).select("task", "samples", "task_specific_accuracy")
    sinks.write_result(path, by_task=by_task, predictions=scored.select("o_orderkey", "task"))
    rows = tables.read_jsonl(spark, f"{path}/predictions", T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("task", T.StringType())]))
    counts = rows.groupBy(F.coalesce("task", F.lit("unknown")).alias("task")).agg(F.count(F.lit(1)).alias("written"))
    return tables.read_jsonl(spark, f"{path}/by_task", by_task.schema).join(counts, "task")


@query
def rejected_pages(t, spark, folder):
    """Pages of recalls, every fourth cut short: rows of the good ones, and the bad ones."""
    cut = F.when(F.col("s_suppkey") % 4 == 0, F.substring("payload", 1, 40)).otherwise(F.col("payload"))
    landed = I.recall_pages(t).withColumn("payload", cut)
    pages = registry.parse_pages(landed, "payload", schemas.RECALL_PAGE, ["s_suppkey"])
    good = registry.flatten_recalls(pages, ["s_suppkey"]).select("s_suppkey", F.lit("row").alias("kind"), "recalling_firm")
    bad = registry.rejected_pages(pages, ["s_suppkey"])
    return good.unionByName(bad.select("s_suppkey", F.lit("rejected").alias("kind"), F.lit(None).cast("string").alias("recalling_firm")))


def _line_pages(t) -> DataFrame:
    """One page per order with its line items; those of every 499th order came back empty."""
    lines = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("results"))
    empty = F.when(F.col("l_orderkey") % 499 == 0, F.array().cast(lines.schema["results"].dataType)).otherwise(F.col("results"))
    return lines.withColumn("results", empty)


@query
def pages_until_empty(t, spark, folder):
    pages = registry.bounded_pages(_line_pages(t), "l_orderkey")
    return explode_rows(pages, "results", "line", ["l_orderkey"]).select("l_orderkey", "line.*")


@query
def pages_until_limit(t, spark, folder):
    """The limit falls inside a page."""
    pages = registry.bounded_pages(_line_pages(t), "l_orderkey", limit=1234)
    return explode_rows(pages, "results", "line", ["l_orderkey"]).select("l_orderkey", "line.*")


@query
def sorted_files(t, spark, folder):
    """Documents written in the order of language and id, then read file by file."""
    path = stage_folder(spark)
    sinks.write_sorted(t("documents").select("lang", "doc_id"), path, ["lang"], ["doc_id"])
    return positions.numbered_rows(spark.read.parquet(path), "place")


# --- filters ---------------------------------------------------------------------
@query
def trials_failed(t, spark, folder):
    orders = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return trials.failed_trials(orders, "o_orderstatus", "o_orderpriority", ["F", "P"])


@query
def trials_completed(t, spark, folder):
    orders = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    kept = trials.completed_trials(
        orders, F.array("o_orderpriority", "o_orderstatus"), "o_orderstatus", ["F"], ["1-URGENT", "2-HIGH"]
    )
    return kept


@query
def structure_length_filter(t, spark, folder):
    return instruct.with_structure_length(t("documents").select("doc_id", "text"), "text")


# --- names and first values ------------------------------------------------------
@query
def explode_names(t, spark, folder):
    listed = t("part").select("p_partkey", F.concat(F.regexp_replace("p_name", " ", ", "), F.lit(", ,  ")).alias("names"))
    return names.explode_names(listed, "names", ["p_partkey"])


@query
def name_dictionary(t, spark, folder):
    return entity_names(I.extracts(t))


@query
def top_reactions(t, spark, folder):
    return topk.first_k_distinct(
        t("events"), "user_id", "value", "event_id", C.MAX_REACTIONS, "user_id", "reactions"
    )


@query
def top_reasons(t, spark, folder):
    return topk.first_k_distinct(
        t("lineitem"), "l_partkey", F.concat("l_returnflag", "l_linestatus"), I.line_position(),
        C.MAX_REASONS, "l_partkey", "reasons",
    )


@query
def unified(t, spark, folder):
    return unified_table(I.extracts(t))


QUERIES["unified_table"] = QUERIES.pop("unified")


@query
def landed_names(t, spark, folder):
    """The name table from three landings, merged one after another."""
    extracts = I.extracts(t)
    state = NameState(stage_folder(spark), buckets=8)
    for part in range(3):
        def of(df, part=part):
            return df.filter(F.col("position") % 3 == part)

        tagged = [names.names_from_lists(of(extracts.trials), "drug_names", C.TRIAL_SOURCE, "status", "position")]
        if part == 1:
            tagged.append(names.names_from_columns(extracts.registry, ["ingredient"], C.REGISTRY_SOURCE))
        if part == 2:
            tagged.append(names.names_from_columns(extracts.labels, ["brand_name"], C.LABEL_SOURCE))
        reactions = of(extracts.adverse_events).select(X.clean_name("drug_name").alias("drug_name"), F.col("reactions").alias("value"), "position")
        reasons = names.explode_names(of(extracts.failed_trials), "drug_names", [F.col("why_stopped").alias("value"), "position"])
        merge_landing(spark, state, landing(state, tagged, {"adverse_reactions": reactions, "failure_reason": reasons}))
    return current_names(spark, state)


# --- enrichment ------------------------------------------------------------------
def _quality(t) -> DataFrame:
    return t("documents").select("doc_id", "lang").join(t("labels").select("doc_id", "quality"), "doc_id", "left")


@query
def missing_structure(t, spark, folder):
    return enrich.missing_attribute(_quality(t), "quality").select("doc_id", "lang")


@query
def structure_coverage(t, spark, folder):
    return enrich.coverage(_quality(t), "quality")


@query
def enrich_lookup(t, spark, folder):
    # Every third line asks for a part that does not exist.
    asked = F.when(F.col("l_orderkey") % 3 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("l_partkey")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", asked, F.col("l_extendedprice").alias("price"))
    dictionary = t("part").select("p_partkey", "p_name", F.col("p_retailprice").alias("price"))
    return enrich.enrich(lines, "l_partkey", dictionary, "p_partkey")


@query
def lookup_names(t, spark, folder):
    known = t("part").select(F.concat("p_name", F.lit("\u00a0")).alias("drug_name"), "p_partkey", "p_brand")
    dictionary = enrich.one_row_per_key(known, "drug_name", ["p_partkey"])
    unknown = F.when(F.col("p_size") > 25, F.lit(" none")).otherwise(F.lit(""))
    padded = t("part").select(F.concat(F.lit("\t "), "p_name", unknown).alias("name"))
    return enrich.lookup_names(padded, "name", dictionary)


@query
def enrich_update(t, spark, folder):
    balance = F.when(F.col("s_acctbal") > 5000, F.col("s_acctbal")).alias("c_acctbal")
    dictionary = enrich.one_row_per_key(t("supplier").select("s_nationkey", "s_suppkey", balance), "s_nationkey", ["s_suppkey"])
    customers = t("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return enrich.update_from(customers, "c_nationkey", dictionary, "s_nationkey", ["c_acctbal"])


@query
def stored_dictionary(t, spark, folder):
    """Small parts are asked first, then all (only the new names), then the smallest anew."""
    parts = t("part").select(F.col("p_name").alias("name"), "p_size", "p_partkey")
    known = parts.groupBy(F.col("name").alias("drug_name")).agg(F.min("p_partkey").alias("cid"))

    def source(asked):
        return asked.join(known, "drug_name")

    store = StoredDictionary(spark, stage_folder(spark), T.StructType([T.StructField("cid", T.LongType())]), buckets=8)
    store.ask(parts.filter("p_size <= 12"), "name", source, at=1)
    store.ask(parts, "name", source, at=2)
    renewed = parts.filter("p_size = 1").select(F.col("name").alias("drug_name")).distinct().join(known, "drug_name")
    store.add(renewed.withColumn("cid", -F.col("cid")), at=3)
    store.compact()
    return store.look_up(parts, "name")


# --- data sets -------------------------------------------------------------------
@query
def status_score(t, spark, folder):
    scores = {"click": 1.0, "view": 0.5, "error": 0.0}
    return t("events").select("event_id", instruct.status_score(F.upper("event_type"), scores).alias("score"))


@query
def instruction_table(t, spark, folder):
    return instruct.instruction_rows(unified_table(I.extracts(t)))


@query
def dataset_instructions(t, spark, folder):
    """From the extracts to instruction rows with their split: the data sets as they are written."""
    return build_datasets(I.extracts(t)).instructions.drop("drug_name")


@query
def classification_table(t, spark, folder):
    documents = t("documents").join(t("labels"), "doc_id", "left")
    rows = documents.select(
        F.concat(F.lit("document "), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("drug_name"),
        F.col("text").alias("canonical_smiles"),
        I.mapped("quality", I.DOCUMENT_STATUSES).alias("status"),
        F.col("n_chars").alias("molecular_weight"),
    )
    return instruct.classification_rows(rows)


@query
def class_balance(t, spark, folder):
    return instruct.class_balance(t("labels"), "quality")


@query
def split_hash(t, spark, folder):
    return split.split_by_hash(t("documents").select("doc_id"), "doc_id")


@query
def split_exact(t, spark, folder):
    return split.split_exact(t("documents").select("doc_id"), "doc_id")


@query
def split_stratified(t, spark, folder):
    return split.split_stratified(t("labels").select("doc_id", "quality"), "doc_id", "quality")


@query
def split_by_entity(t, spark, folder):
    """Every third order belongs to one part; all rows of a part are on one side."""
    part = F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_partkey")).alias("part")
    return split.split_exact(t("lineitem").select("l_orderkey", part), "part").groupBy("part", "split").agg(F.count(F.lit(1)).alias("rows"))


@query
def split_fallback(t, spark, folder):
    """A label of one row allows no stratified split: every row is in ``all``."""
    label = F.when(F.col("n_nationkey") == 0, "alone").otherwise("rest").alias("label")
    return split.split_stratified(t("nation").select("n_nationkey", label), "n_nationkey", "label")


@query
def dataset_stats(t, spark, folder):
    rows = split.split_exact(t("documents").select("doc_id"), "doc_id")
    classes = split.split_stratified(t("labels").select("doc_id", "quality"), "doc_id", "quality")
    return split.split_counts(rows, "instructions").unionByName(split.split_counts(classes, "classification"))


@query
def prompt_render(t, spark, folder):
    pairs = I.turn_pairs(t)
    shown = F.when(F.col("task") == C.TASK_STATUS, F.lit("")).otherwise(F.col("task"))
    return pairs.select(
        "conv_id", "turn",
        X.prompt("reference", shown, "prediction").alias("sample"),
        X.prompt("reference", shown).alias("query"),
        X.response_part(X.prompt("reference", shown, F.concat(F.lit(" "), "prediction"))).alias("answer"),
    )


@query
def length_budget(t, spark, folder):
    return instruct.length_budget(t("documents"), "text", keep=["doc_id"])


@query
def normalize_text(t, spark, folder):
    return t("documents").select("doc_id", X.normalized("text").alias("text"))


# --- metrics ---------------------------------------------------------------------
@query
def length_metrics(t, spark, folder):
    return rounded(metrics.length_summary(metrics.with_lengths(I.turn_pairs(t))))


@query
def eval_exact_match(t, spark, folder):
    pairs = I.order_pairs(t).select(
        F.col("priority").alias("prediction"),
        F.concat(F.lit("  "), F.lower(F.regexp_replace("next_priority", "-", " - ")), F.lit("!")).alias("reference"),
    )
    return rounded(metrics.exact_match_summary(metrics.with_exact_match(pairs)))


@query
def eval_word_f1(t, spark, folder):
    return rounded(metrics.word_f1_summary(metrics.with_word_f1(I.turn_pairs(t))))


@query
def pair_by_position(t, spark, folder):
    """Predictions and references without a key: the n-th turn against the n-th document."""
    predictions = t("conversations").select(F.col("text").alias("prediction"))
    references = t("documents").select(F.col("text").alias("reference"))
    scored = metrics.with_word_f1(metrics.paired_by_position(predictions, references))
    return rounded(scored.select("row_number", "word_f1", "word_precision", "word_recall"))


@query
def eval_f1_by_task(t, spark, folder):
    return rounded(metrics.word_f1_by_task(metrics.with_word_f1(I.order_pairs(t))))


@query
def task_score(t, spark, folder):
    rules = {**scoring.TASK_RULES, C.TASK_IDENTIFY: scoring.ANY_WORD_RULE}
    scored = scoring.with_task_score(I.order_pairs(t), rules=rules)
    return rounded(scored.select("o_orderkey", "task", "score"))


@query
def eval_by_task(t, spark, folder):
    return rounded(scoring.score_by_task(scoring.with_task_score(I.order_pairs(t))))


@query
def eval_accuracy_rollup(t, spark, folder):
    pairs = I.order_pairs(t)
    correct = scoring.strict_match(F.concat(F.lit("\n "), "priority"), F.lower("next_priority"))
    return rounded(scoring.accuracy_rollup(pairs.select("task", correct.alias("correct"))))


@query
def eval_bleu(t, spark, folder):
    summary = metrics.bleu_summary(metrics.with_bleu_counts(I.turn_pairs(t)))
    return rounded(summary.select("bleu", "bleu_1", "bleu_2", "match_3", "match_4", "possible_4"))


@query
def eval_rouge_n(t, spark, folder):
    return rounded(metrics.mean_summary(metrics.with_rouge_n(I.turn_pairs(t)), ["rouge1", "rouge2"]))


@query
def eval_rouge_l(t, spark, folder):
    scored = metrics.with_rouge_l(I.turn_pairs(t))
    return rounded(metrics.mean_summary(scored, ["rougeL"], ["task"]))


@query
def eval_rouge_lsum(t, spark, folder):
    scored = metrics.with_rouge_l(I.turn_pairs(t))
    return rounded(metrics.mean_summary(scored, ["rougeLsum"], ["task"]))


@query
def eval_text_cosine(t, spark, folder):
    pairs = I.turn_pairs(t).withColumn("sample", F.concat_ws("-", "conv_id", "turn"))
    return rounded(metrics.cosine_summary(metrics.text_cosine(pairs, "sample")))


@query
def eval_intervals(t, spark, folder):
    """Means with bootstrap intervals per task."""
    scored = metrics.with_exact_match(metrics.with_word_f1(I.turn_pairs(t)))
    scored = scored.select("task", F.concat_ws("-", "conv_id", "turn").alias("sample"), "word_f1", "word_recall", F.col("exact_match").cast("int").alias("exact_match"))
    return rounded(bootstrap.bootstrap_means(scored, "sample", ["word_f1", "word_recall", "exact_match"], ["task"], replicates=100))


@query
def eval_cosine(t, spark, folder):
    vectors = t("embeddings")
    this = vectors.select("vec_id", F.col("embedding").alias("prediction_vector"))
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("reference_vector"))
    pairs = metrics.paired(this, following, "vec_id")
    return rounded(metrics.cosine_summary(metrics.with_cosine(pairs)))


@query
def smiles_known_rate(t, spark, folder):
    words = explode_rows(t("benchmark"), X.tokens("text"), "canonical_smiles")
    rate = metrics.known_structure_rate(t("documents"), words, prediction="text", reference=None)
    return rounded(rate)


@query
def smiles_pair_rate(t, spark, folder):
    words = explode_rows(t("documents"), X.tokens("text"), "canonical_smiles")
    return rounded(metrics.known_structure_rate(I.turn_pairs(t), words))


@query
def metric_long(t, spark, folder):
    words = explode_rows(t("documents"), X.tokens("text"), "canonical_smiles")
    return rounded(metric_report(I.turn_pairs(t), task="task", structures=words))


@query
def eval_report_by_task(t, spark, folder):
    return rounded(evaluation_by_task(I.turn_pairs(t)))


# --- keywords and comparison -----------------------------------------------------
@query
def keyword_score(t, spark, folder):
    keywords = F.coalesce(
        *[
            F.when(F.col("lang") == lang, F.array(*[F.lit(word) for word in words]))
            for lang, words in I.KEYWORDS_BY_LANGUAGE.items()
        ],
        F.array().cast("array<string>"),
    )
    scored = scoring.with_keyword_score(t("documents"), "text", keywords)
    return rounded(scored.select("doc_id", "keyword_matches", "total_keywords", "relevance_score"))


@query
def keyword_suite(t, spark, folder):
    """Every word of the benchmark looked for in every user turn."""
    turns = t("conversations").filter("role = 'user'").select(F.concat_ws("-", "conv_id", "turn").alias("sample"), "text")
    suite = explode_rows(t("benchmark"), X.tokens("text"), "keyword").distinct()
    return rounded(scoring.suite_scores(turns, "sample", "text", suite))


@query
def compare_winner(t, spark, folder):
    return rounded(compare.winners(compare.scored_responses(I.responses(t))))


@query
def compare_missing_side(t, spark, folder):
    """Every fourth prompt lacks the tuned response."""
    responses = I.responses(t).filter("model = 'base' or not endswith(prompt_id, '4')")
    return rounded(compare.winners(compare.scored_responses(responses)))


@query
def compare_suite(t, spark, folder):
    """Keywords come from a suite that only knows the prompts of two tasks."""
    responses = I.responses(t).drop("expected_keywords")
    words = F.array(*[F.lit(word) for word in I.KEYWORDS])
    suite = I.turn_pairs(t).filter(F.col("task") != C.TASK_STATUS).select(I.prompt_id(), words.alias("expected_keywords"))
    scored = compare.scored_responses(responses, suite)
    return rounded(scored.select("prompt_id", "model", "keyword_matches", "total_keywords", "relevance_score"))


@query
def compare_summary(t, spark, folder):
    return rounded(compare.comparison_summary(compare.scored_responses(I.responses(t))))


@query
def compare_samples(t, spark, folder):
    prompts = I.turn_pairs(t).select(I.prompt_id(), F.col("reference").alias("instruction"), F.lit("").alias("input"))
    responses = I.responses(t).join(prompts, "prompt_id")
    responses = responses.withColumn("rendered", X.prompt("instruction", "input", blank_input=True))
    scored = compare.scored_responses(responses)
    return rounded(compare.sample_responses(scored, shown=["instruction", "input", "rendered"]))


@query
def padded_names(t, spark, folder):
    """Names with tabs, no-break and plain blanks on different sides meet in every join."""
    parts = t("part").select("p_partkey", "p_size", F.concat_ws(" ", "p_name", "p_size").alias("name"))
    labels = parts.select(F.concat(F.lit("\t"), "name").alias("brand_name"), F.lit(None).cast("string").alias("generic_name"))
    seen = parts.select(
        F.concat("name", F.lit("\u00a0")).alias("drug_name"), F.concat(F.lit("r"), F.col("p_partkey") % 3).alias("reactions"), F.col("p_partkey").alias("position")
    )
    first = parts.groupBy("name").agg(F.min("p_partkey").alias("cid"))
    structures = first.select(F.concat(F.lit(" "), "name", F.lit(" ")).alias("drug_name"), "cid")
    return unified_table(Extracts(labels=labels, adverse_events=seen, structures=structures))


@query
def batch_score(t, spark, folder):
    def make_generator(prefix: str):
        def generate(batch):
            return [f"{prefix}{len(text.split())} words" for text in batch["text"]]

        return generate

    rows = t("conversations").select("conv_id", "turn", "text")
    return batch_generate(rows, make_generator, prefix="answer: ").select("conv_id", "turn", "response")


@query
def batch_resume(t, spark, folder):
    """A second attempt over all turns asks for those that the first, over even turns, left."""
    def make_generator():
        return lambda batch: [f"{len(text)} characters" for text in batch["text"]]

    rows, columns, path = t("conversations"), ["conv_id", "turn", "text"], stage_folder(spark)
    generate_rest(rows.filter("turn % 2 = 0"), columns, make_generator, path, attempt=1)
    return generate_rest(rows, columns, make_generator, path, attempt=2).select("conv_id", "turn", "response", "attempt")
