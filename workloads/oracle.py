"""The queries of :mod:`workloads.queries` as SQL for DuckDB, over whole tables."""

from regforge import constants as C
from regforge.operators.bootstrap import poisson_limits
from workloads import inputs as I

ORACLE_SQL: dict[str, str] = {}


def text(value: str) -> str:
    """SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(text(v) for v in values)


def case(column: str, values: dict, other: str = "NULL") -> str:
    arms = " ".join(
        f"WHEN {column} = {text(k) if isinstance(k, str) else k} THEN {text(v) if isinstance(v, str) else v}"
        for k, v in values.items()
    )
    return f"CASE {arms} ELSE {other} END"


# --- text functions --------------------------------------------------------------
WHITESPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NON_WHITESPACE = "[^" + WHITESPACE[1:]


def tokens(column: str) -> str:
    return f"list_filter(regexp_split_to_array({column}, '{WHITESPACE}+'), lambda w: w <> '')"


def normalized(column: str) -> str:
    return rf"trim(regexp_replace(lower({column}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


def word_tokens(column: str) -> str:
    return f"list_filter(string_split({normalized(column)}, ' '), lambda w: w <> '')"


def alphanumeric(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '[a-z0-9]+')"


def candidates(column: str) -> str:
    found = f"regexp_extract_all({column}, {text(C.STRUCTURE_PATTERN)})"
    return f"list_filter({found}, lambda w: length(w) > {C.MIN_CANDIDATE_LENGTH})"


def f_measure(overlap: str, predicted: str, wanted: str) -> str:
    """2 o / (p + r), which is the harmonic mean of o / p and o / r."""
    return f"CASE WHEN {overlap} > 0 THEN 2.0 * {overlap} / ({predicted} + {wanted}) ELSE 0.0 END"


# --- shared views ----------------------------------------------------------------
ENTITY = "p_name || ' ' || p_size"
ORDER_STATUS = case("o_orderstatus", I.ORDER_STATUSES)
POSITION = f"l_orderkey * {1 << I.LINE_BITS} + l_linenumber"

PAIRS = f"""
pairs AS (
  SELECT u.conv_id, u.turn, u.text AS reference, a.text AS prediction,
         {case("u.turn % 3", dict(enumerate(I.TURN_TASKS)))} AS task,
         u.conv_id * 1000000 + u.turn AS id
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

ORDER_PAIRS = f"""
order_text AS (
  SELECT o_orderkey, o_orderpriority AS priority,
         {case("o_orderpriority", I.ORDER_TASKS)} AS task,
         'Order ' || o_orderkey || ' is ' || lower({ORDER_STATUS}) || ' with priority ' || o_orderpriority AS prediction,
         'The order was ' || lower({ORDER_STATUS}) || ', Priority ' || o_orderpriority AS reference
  FROM orders),
order_pairs AS (
  SELECT a.o_orderkey, a.task, a.priority, b.priority AS next_priority, a.prediction, b.reference
  FROM order_text a JOIN order_text b ON b.o_orderkey = a.o_orderkey + 1)"""

NAMED = f"""
named AS (
  SELECT p_partkey, {ENTITY} AS drug_name, p_brand, p_type, p_size, p_retailprice FROM part),
trial AS (
  SELECT drug_name, {ORDER_STATUS} AS status, {POSITION} AS position,
         l_returnflag || '/' || l_linestatus AS reason
  FROM lineitem JOIN named ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
seen AS (
  SELECT drug_name, {text(C.REGISTRY_SOURCE)} AS source, 0 AS rank, 'approved' AS status, 0 AS position
  FROM named WHERE p_type = 'PROMO'
  UNION ALL
  SELECT drug_name, {text(C.LABEL_SOURCE)}, 1, 'approved', 0 FROM named WHERE p_type IN ('LARGE', 'PROMO')
  UNION ALL
  SELECT drug_name, {text(C.TRIAL_SOURCE)}, 2, status, position FROM trial),
dictionary AS (
  SELECT drug_name,
         array_to_string(list_sort(list_distinct(list(source))), ', ') AS source,
         arg_min(status, rank * 1000000000000 + position) FILTER (WHERE status IS NOT NULL) AS status
  FROM seen GROUP BY drug_name)"""


def first_k(name: str, source: str, key: str, value: str, position: str, k: int, out: str) -> str:
    return f"""
{name} AS (
  SELECT {key}, string_agg(value, '; ' ORDER BY first, value) AS {out}
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY first, value) AS rn
        FROM (SELECT {key}, {value} AS value, min({position}) AS first FROM {source} GROUP BY ALL))
  WHERE rn <= {k} GROUP BY {key})"""


UNIFIED = f"""{NAMED},
adverse AS (
  SELECT drug_name, 'quantity ' || CAST(l_quantity AS INTEGER) AS reaction, {POSITION} AS position
  FROM lineitem JOIN named ON l_partkey = p_partkey),
{first_k("reactions", "adverse", "drug_name", "reaction", "position", C.MAX_REACTIONS, "adverse_reactions")},
failed AS (SELECT * FROM trial WHERE status IN ({listed(C.STOPPED_STATUSES)})),
{first_k("reasons", "failed", "drug_name", "reason", "position", C.MAX_REASONS, "failure_reason")},
structures AS (
  SELECT drug_name, p_partkey AS cid, p_brand AS molecular_formula, p_retailprice AS molecular_weight,
         p_brand || '/' || p_type || '/' || p_partkey AS canonical_smiles
  FROM named WHERE p_size <= 25),
unified AS (
  SELECT drug_name, source, status, adverse_reactions, failure_reason, cid, molecular_formula,
         molecular_weight, canonical_smiles
  FROM dictionary LEFT JOIN reactions USING (drug_name) LEFT JOIN reasons USING (drug_name)
       LEFT JOIN structures USING (drug_name))"""


def filled(template: str, **columns: str) -> str:
    """A ``{placeholder}`` template as SQL concatenation."""
    sql = text(template)
    for name, column in columns.items():
        sql = sql.replace("{" + name + "}", f"' || {column} || '")
    return sql


# --- sources ---------------------------------------------------------------------
ORACLE_SQL["scan_delimited"] = """
SELECT p_partkey AS part_key, p_name AS trade_name, p_brand AS brand, p_type AS df_route,
       p_size AS size, p_retailprice AS price FROM part"""

ORACLE_SQL["flatten_labels"] = """
SELECT p_partkey, p_brand AS brand_name, string_split(p_name, ' ')[1] AS generic_name,
       CASE WHEN p_size > 25 THEN p_type END AS manufacturer,
       CAST(NULL AS VARCHAR) AS substance_name, CASE WHEN p_size > 10 THEN p_type END AS product_type,
       CAST(NULL AS VARCHAR) AS route, CAST(NULL AS VARCHAR) AS application_number,
       CAST(NULL AS VARCHAR) AS indications, 'for ' || p_name AS warnings,
       CAST(NULL AS VARCHAR) AS dosage, CAST(NULL AS VARCHAR) AS active_ingredients,
       CAST(NULL AS VARCHAR) AS purpose FROM part"""

ORACLE_SQL["flatten_events"] = """
SELECT l_orderkey, CAST(i AS INTEGER) AS drug_position,
       CASE WHEN i = 0 THEN 'part ' || l_partkey ELSE 'supplier ' || l_suppkey END AS drug_name,
       CASE WHEN i = 0 THEN l_linestatus END AS drug_indication,
       CAST(NULL AS VARCHAR) AS drug_characterization,
       l_returnflag || ', ' || l_linestatus AS reactions, CAST(NULL AS VARCHAR) AS outcome,
       CASE WHEN l_quantity > 25 THEN '1' END AS serious,
       strftime(l_shipdate, '%Y%m%d') AS receive_date, CAST(NULL AS VARCHAR) AS country
FROM lineitem, (VALUES (0), (1)) AS v(i)"""

ORACLE_SQL["flatten_recalls"] = """
SELECT s_suppkey, 'lot ' || s_suppkey AS product_description,
       CASE WHEN s_acctbal < 0 THEN 'debt' END AS reason_for_recall,
       CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS classification,
       s_name AS recalling_firm, CAST(NULL AS VARCHAR) AS recall_initiation_date,
       CAST(NULL AS VARCHAR) AS voluntary_mandated, CAST(NULL AS VARCHAR) AS city, n_name AS state
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

ORACLE_SQL["flatten_ingredients"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_ndc, p_name AS generic_name,
       CAST(NULL AS VARCHAR) AS brand_name, p_brand AS labeler_name,
       array_to_string(list_transform(string_split(p_name, ' '), lambda w: w || ' (' || p_size || ' mg)'), '; ')
         AS active_ingredients,
       CAST(NULL AS VARCHAR) AS dosage_form,
       array_to_string(string_split(p_type, 'A'), ', ') AS route,
       CAST(NULL AS VARCHAR) AS product_type, CAST(NULL AS VARCHAR) AS marketing_category,
       CAST(NULL AS VARCHAR) AS application_number FROM part"""

ORACLE_SQL["flatten_trials"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS nct_id, CAST(NULL AS VARCHAR) AS title,
       CAST(NULL AS VARCHAR) AS official_title, {ORDER_STATUS} AS status,
       CAST(NULL AS VARCHAR) AS why_stopped, o_orderpriority || ', ' || o_orderstatus AS phase,
       CAST(NULL AS VARCHAR) AS study_type, CAST(o_custkey AS INTEGER) AS enrollment,
       CAST(NULL AS VARCHAR) AS conditions,
       'drug ' || o_custkey || CASE WHEN o_orderstatus = 'F' THEN ', ' || o_orderpriority ELSE '' END AS drug_names,
       'DRUG, DEVICE, ' || CASE WHEN o_orderstatus = 'F' THEN 'BIOLOGICAL' ELSE 'OTHER' END AS intervention_types,
       o_orderpriority AS primary_outcomes, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
       CAST(NULL AS VARCHAR) AS completion_date, CAST(NULL AS VARCHAR) AS sponsor,
       'INDUSTRY' AS sponsor_type FROM orders"""

ORACLE_SQL["structure_coalesce"] = """
SELECT event_id, coalesce(nullif(json_extract_string(props, '$.missing'), ''),
                          nullif(json_extract_string(props, '$.k'), '')) AS structure FROM events"""

ORACLE_SQL["flatten_structures"] = """
SELECT p_partkey, CASE WHEN p_size <= 40 THEN p_partkey END AS cid, CASE WHEN p_size <= 40 THEN p_brand END AS molecular_formula,
       CASE WHEN p_size <= 40 AND p_size <> 20 THEN p_retailprice END AS molecular_weight,
       CASE WHEN p_size <= 10 THEN p_name WHEN p_size <= 40 THEN p_type END AS canonical_smiles,
       CAST(NULL AS VARCHAR) AS isomeric_smiles, CAST(NULL AS VARCHAR) AS inchi, CAST(NULL AS VARCHAR) AS inchi_key
FROM part"""

ORACLE_SQL["limit_ordered"] = "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100"

ORACLE_SQL["source_summary"] = " UNION ALL ".join(
    f"SELECT {text(name)} AS source, count(*) AS records, 'Available' AS status FROM {name}" for name in I.TABLES
) + " UNION ALL SELECT 'recalls', CAST(NULL AS BIGINT), 'Not downloaded'"

ORACLE_SQL["jsonl_roundtrip"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

ORACLE_SQL["read_patents"] = """
SELECT CAST(p_partkey AS VARCHAR) AS appl_no, p_name AS patent_no, p_brand AS use_code, CAST(p_size AS VARCHAR) AS expire_date FROM part"""
ORACLE_SQL["read_exclusivity"] = """
SELECT CAST(p_partkey AS VARCHAR) AS appl_no, p_name AS patent_no, CAST(p_size AS VARCHAR) AS expire_date FROM part"""
ORACLE_SQL["csv_roundtrip"] = """
SELECT doc_id, text, CASE WHEN doc_id % 3 > 0 THEN 'say "' || lang || '", ok' END AS quoted FROM documents"""

ORACLE_SQL["rejected_pages"] = """
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'rejected' ELSE 'row' END AS kind,
       CASE WHEN s_suppkey % 4 <> 0 THEN recalling_firm END AS recalling_firm
FROM (SELECT s_suppkey, s_name AS recalling_firm FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

_PAGES = """
WITH first_empty AS (SELECT coalesce(min(l_orderkey), 9223372036854775807) AS stop FROM lineitem WHERE l_orderkey % 499 = 0)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem, first_empty WHERE l_orderkey < stop"""
ORACLE_SQL["pages_until_empty"] = _PAGES
ORACLE_SQL["pages_until_limit"] = f"SELECT * FROM ({_PAGES}) ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 1234"
ORACLE_SQL["sorted_files"] = """
SELECT lang, doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS place FROM documents"""

ORACLE_SQL["padded_names"] = """
WITH named AS (SELECT p_partkey, p_name || ' ' || p_size AS name FROM part),
reactions AS (
  SELECT name, string_agg(r, '; ' ORDER BY pos, r) AS found FROM (
    SELECT name, 'r' || p_partkey % 3 AS r, min(p_partkey) AS pos FROM named GROUP BY ALL) GROUP BY name)
SELECT name AS drug_name, 'openfda_labels' AS source, 'approved' AS status, any_value(found) AS adverse_reactions, min(p_partkey) AS cid
FROM named JOIN reactions USING (name) GROUP BY name"""

# --- filters ---------------------------------------------------------------------
ORACLE_SQL["trials_failed"] = """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority <> ''"""

ORACLE_SQL["trials_completed"] = """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' AND list_has_any([o_orderpriority, o_orderstatus], ['1-URGENT', '2-HIGH'])"""

ORACLE_SQL["structure_length_filter"] = "SELECT doc_id, text FROM documents WHERE length(text) BETWEEN 5 AND 500"

# --- names and first values ------------------------------------------------------
ORACLE_SQL["explode_names"] = """
SELECT p_partkey, unnest(list_filter(string_split(p_name, ' '), lambda w: trim(w) <> '')) AS drug_name FROM part"""

ORACLE_SQL["name_dictionary"] = f"WITH {NAMED} SELECT drug_name, source, status FROM dictionary"

ORACLE_SQL["top_reactions"] = (
    "WITH " + first_k("r", "events", "user_id", "CAST(value AS VARCHAR)", "event_id", C.MAX_REACTIONS, "reactions")
    + " SELECT user_id, reactions FROM r"
)

ORACLE_SQL["top_reasons"] = (
    "WITH " + first_k("r", "lineitem", "l_partkey", "l_returnflag || l_linestatus", POSITION, C.MAX_REASONS, "reasons")
    + " SELECT l_partkey, reasons FROM r"
)

ORACLE_SQL["unified_table"] = f"WITH {UNIFIED} SELECT * FROM unified"

ORACLE_SQL["landed_names"] = f"""
WITH {UNIFIED} SELECT DISTINCT drug_name, source, status, adverse_reactions, failure_reason FROM unified"""

# --- enrichment ------------------------------------------------------------------
ORACLE_SQL["missing_structure"] = """
SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL)"""

ORACLE_SQL["structure_coverage"] = """
SELECT count(*) AS total, count(quality) AS found, count(*) - count(quality) AS not_found
FROM documents LEFT JOIN labels USING (doc_id)"""

ORACLE_SQL["enrich_lookup"] = """
SELECT l_orderkey, l_linenumber, asked AS l_partkey, l_extendedprice AS price, asked AS p_partkey, p_name,
       p_retailprice AS price_pubchem
FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN -l_partkey ELSE l_partkey END AS asked FROM lineitem)
LEFT JOIN part ON asked = p_partkey"""

ORACLE_SQL["lookup_names"] = """
SELECT DISTINCT chr(9) || ' ' || p.p_name || CASE WHEN p.p_size > 25 THEN ' none' ELSE '' END AS drug_name,
       d.p_partkey, d.p_brand
FROM part p LEFT JOIN (
  SELECT p_name, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand
  FROM part GROUP BY p_name) d ON d.p_name = p.p_name AND p.p_size <= 25"""

ORACLE_SQL["enrich_update"] = """
SELECT c_custkey, c_nationkey, coalesce(s.balance, c_acctbal) AS c_acctbal
FROM customer LEFT JOIN (
  SELECT s_nationkey, CASE WHEN s_acctbal > 5000 THEN s_acctbal END AS balance FROM supplier
  QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1) s ON s_nationkey = c_nationkey"""

ORACLE_SQL["stored_dictionary"] = """
SELECT p_name AS drug_name, CASE WHEN min(p_size) = 1 THEN -min(p_partkey) ELSE min(p_partkey) END AS cid,
       CAST(CASE WHEN min(p_size) = 1 THEN 3 WHEN min(p_size) <= 12 THEN 1 ELSE 2 END AS BIGINT) AS answered_at
FROM part GROUP BY p_name"""

# --- data sets -------------------------------------------------------------------
ORACLE_SQL["status_score"] = f"""
SELECT event_id, CAST({case("event_type", {"click": "1.0", "view": "0.5", "error": "0.0"})} AS DOUBLE) AS score
FROM events"""

_SUBJECT = filled(C.SUBJECT_INPUT, name="drug_name")
_LINE = f"coalesce({filled(C.STRUCTURE_LINE, structure='canonical_smiles')}, '')"
ORACLE_SQL["instruction_table"] = f"""
WITH {UNIFIED},
facts AS (SELECT *, {_SUBJECT} AS subject, {_LINE} AS line FROM unified)
SELECT {filled(C.APPROVED_QUESTION, name='drug_name')} AS instruction, subject || line AS input,
       {filled(C.APPROVED_ANSWER, name='drug_name')} AS output, {text(C.TASK_STATUS)} AS task
FROM facts WHERE status IN ({listed(C.APPROVED_STATUSES)})
UNION ALL
SELECT {filled(C.STOPPED_QUESTION, name='drug_name')}, subject || line,
       {filled(C.STOPPED_ANSWER, name='drug_name', status='status', reason="coalesce(failure_reason, 'Unknown reasons')")},
       {text(C.TASK_STATUS)}
FROM facts WHERE status IN ({listed(C.STOPPED_STATUSES)})
UNION ALL
SELECT {filled(C.REACTIONS_QUESTION, name='drug_name')}, subject,
       {filled(C.REACTIONS_ANSWER, name='drug_name', reactions='adverse_reactions')}, {text(C.TASK_REACTIONS)}
FROM facts WHERE adverse_reactions <> ''
UNION ALL
SELECT {filled(C.STRUCTURE_QUESTION, name='drug_name')}, subject,
       {filled(C.STRUCTURE_ANSWER, name='drug_name', structure='canonical_smiles')}, {text(C.TASK_STRUCTURE)}
FROM facts WHERE canonical_smiles <> ''
UNION ALL
SELECT {text(C.IDENTIFY_QUESTION)}, {filled(C.STRUCTURE_INPUT, structure='canonical_smiles')},
       {filled(C.IDENTIFY_ANSWER, name='drug_name')}, {text(C.TASK_IDENTIFY)}
FROM facts WHERE canonical_smiles <> ''
UNION ALL
SELECT {filled(C.FAILURE_QUESTION, name='drug_name')}, subject || line,
       {filled(C.FAILURE_ANSWER, name='drug_name', reason='failure_reason')}, {text(C.TASK_FAILURE)}
FROM facts WHERE trim(failure_reason) <> ''"""

_SAMPLE = "sha256(task || chr(1) || instruction || chr(1) || input || chr(1) || output)"
ORACLE_SQL["dataset_instructions"] = f"""
WITH written AS (SELECT *, {_SAMPLE} AS sample FROM ({ORACLE_SQL["instruction_table"]})),
placed AS (
  SELECT *, rank() OVER (ORDER BY md5('{C.SPLIT_SEED}:' || sample), sample) AS r, count(*) OVER () AS n FROM written),
sized AS (SELECT *, CAST(ceil((1.0::DOUBLE - 0.8::DOUBLE) * n) AS BIGINT) AS held FROM placed)
SELECT instruction, input, output, task,
       CASE WHEN r <= n - held THEN 'train' WHEN r <= n - CAST(ceil(held * 0.5) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM sized"""

ORACLE_SQL["classification_table"] = f"""
SELECT 'document ' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS drug_name, text AS canonical_smiles,
       {case("quality", I.DOCUMENT_STATUSES)} AS status, CAST(coalesce(quality = 1, false) AS INTEGER) AS label,
       n_chars AS molecular_weight
FROM documents LEFT JOIN labels USING (doc_id)
WHERE text <> ''
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""

ORACLE_SQL["class_balance"] = """
SELECT count(*) FILTER (WHERE quality = 1) AS positive, count(*) FILTER (WHERE quality = 0) AS negative FROM labels"""

_HASH = f"md5('{C.SPLIT_SEED}:' || doc_id)"
ORACLE_SQL["split_hash"] = f"""
SELECT doc_id, CASE WHEN h < 0.8 THEN 'train' WHEN h < 0.9 THEN 'val' ELSE 'test' END AS split
FROM (SELECT doc_id, ('0x' || substr({_HASH}, 1, 8))::UBIGINT / 4294967296.0 AS h FROM documents)"""

ORACLE_SQL["split_files"] = ORACLE_SQL["split_hash"].replace("SELECT doc_id, CASE", "SELECT doc_id, lang, CASE").replace("SELECT doc_id, ('0x'", "SELECT doc_id, lang, ('0x'")

_HELD = "CAST(ceil((1.0::DOUBLE - 0.8::DOUBLE) * n) AS BIGINT)"
EXACT = f"""
exact_ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY {_HASH}, CAST(doc_id AS VARCHAR)) AS r, count(*) OVER () AS n
  FROM documents),
exact AS (
  SELECT doc_id, CASE WHEN r <= n - {_HELD} THEN 'train'
                      WHEN r <= n - CAST(ceil({_HELD} * 0.5) AS BIGINT) THEN 'val' ELSE 'test' END AS split
  FROM exact_ranked)"""
ORACLE_SQL["split_exact"] = f"WITH {EXACT} SELECT doc_id, split FROM exact"

STRATIFIED = f"""
per_label AS (SELECT quality, count(*) AS c FROM labels GROUP BY quality),
totals AS (
  SELECT *, sum(c) OVER () AS n, count(*) OVER () AS k,
         CAST(ceil((1.0::DOUBLE - 0.8::DOUBLE) * sum(c) OVER ()) AS BIGINT) AS held FROM per_label),
share1 AS (
  SELECT *, c * (n - held) / n AS e1, floor(c * (n - held) / n) AS f1,
         CAST(ceil(held * 0.5) AS BIGINT) AS test FROM totals),
train AS (
  SELECT *, f1 + CASE WHEN row_number() OVER (ORDER BY e1 - f1 DESC, quality) <= (n - held) - sum(f1) OVER ()
                      THEN 1 ELSE 0 END AS n_train FROM share1),
share2 AS (
  SELECT *, c - n_train AS h, (c - n_train) * (held - test) / sum(c - n_train) OVER () AS e2 FROM train),
val AS (
  SELECT *, floor(e2) + CASE WHEN row_number() OVER (ORDER BY e2 - floor(e2) DESC, quality)
                                  <= (held - test) - sum(floor(e2)) OVER () THEN 1 ELSE 0 END AS n_val FROM share2),
allocation AS (
  SELECT quality, n_train, n_val,
         n < 10
         OR (n >= 20 AND (min(c) OVER () < 2 OR n - held < k OR held < k))
         OR (held >= 10 AND (min(CASE WHEN h > 0 THEN h END) OVER () < 2
                             OR held - test < count(CASE WHEN h > 0 THEN 1 END) OVER ()
                             OR test < count(CASE WHEN h > 0 THEN 1 END) OVER ())) AS whole
  FROM val),
strat_ranked AS (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_HASH}, CAST(doc_id AS VARCHAR)) AS r
  FROM labels),
stratified AS (
  SELECT doc_id, quality, CASE WHEN whole THEN 'all' WHEN r <= n_train THEN 'train'
                               WHEN r <= n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM strat_ranked JOIN allocation USING (quality))"""
ORACLE_SQL["split_stratified"] = f"WITH {STRATIFIED} SELECT doc_id, quality, split FROM stratified"

ORACLE_SQL["split_by_entity"] = f"""
WITH entity AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS part, count(*) AS rows FROM lineitem GROUP BY 1),
placed AS (
  SELECT *, coalesce(sum(rows) OVER (ORDER BY md5('{C.SPLIT_SEED}:' || part), CAST(part AS VARCHAR)
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(rows) OVER () AS n FROM entity)
SELECT part, CASE WHEN before < n - {_HELD} THEN 'train'
                  WHEN before < n - CAST(ceil({_HELD} * 0.5) AS BIGINT) THEN 'val' ELSE 'test' END AS split, rows
FROM placed"""

ORACLE_SQL["split_fallback"] = """
SELECT n_nationkey, CASE WHEN n_nationkey = 0 THEN 'alone' ELSE 'rest' END AS label, 'all' AS split FROM nation"""

ORACLE_SQL["dataset_stats"] = f"""
WITH {EXACT}, {STRATIFIED}
SELECT 'instructions' AS dataset, split, count(*) AS rows FROM exact GROUP BY split
UNION ALL SELECT 'classification', split, count(*) FROM stratified GROUP BY split"""

_INPUT = f"CASE WHEN task = {text(C.TASK_STATUS)} THEN '' ELSE task END"
ORACLE_SQL["prompt_render"] = f"""
WITH {PAIRS},
shown AS (SELECT *, {_INPUT} AS shown FROM pairs),
head AS (
  SELECT *, '### Instruction:' || chr(10) || reference || chr(10) || chr(10)
         || CASE WHEN shown <> '' THEN '### Input:' || chr(10) || shown || chr(10) || chr(10) ELSE '' END
         || '### Response:' || chr(10) AS head FROM shown)
SELECT conv_id, turn, head || prediction AS sample, head AS query, trim(prediction, chr(10) || ' ') AS answer
FROM head"""

ORACLE_SQL["length_budget"] = f"""
SELECT doc_id, len(t) AS n_tokens, len(t) > {C.PROMPT_TOKEN_BUDGET} AS over_budget,
       CASE WHEN len(t) > {C.PROMPT_TOKEN_BUDGET} THEN array_to_string(p[1:{C.PROMPT_TOKEN_BUDGET}], '') ELSE text END AS text
FROM (SELECT doc_id, text, {tokens("text")} AS t, regexp_extract_all(text, '{WHITESPACE}*{NON_WHITESPACE}+') AS p
      FROM documents)"""

ORACLE_SQL["normalize_text"] = f"SELECT doc_id, {normalized('text')} AS text FROM documents"

# --- metrics ---------------------------------------------------------------------
LENGTHS = f"""
lengths AS (SELECT len({tokens("prediction")}) AS p, len({tokens("reference")}) AS r FROM pairs),
length_totals AS (
  SELECT round(avg(p), 6) AS avg_pred_length, round(avg(r), 6) AS avg_ref_length,
         round(avg(CASE WHEN r > 0 THEN p / r ELSE 0 END), 6) AS length_ratio,
         round(stddev_pop(p), 6) AS length_std FROM lengths)"""
ORACLE_SQL["length_metrics"] = f"WITH {PAIRS}, {LENGTHS} SELECT * FROM length_totals"

ORACLE_SQL["eval_exact_match"] = f"""
WITH {ORDER_PAIRS}
SELECT round(avg(CAST(same AS INTEGER)), 6) AS exact_match, count(*) FILTER (WHERE same) AS exact_match_count
FROM (SELECT {normalized("priority")} = {normalized("replace(next_priority, '-', ' - ') || '!'")} AS same
      FROM order_pairs)"""


def word_scores(source: str) -> str:
    return f"""
sets AS (
  SELECT task, list_distinct({word_tokens("prediction")}) AS p, list_distinct({word_tokens("reference")}) AS r
  FROM {source}),
parts AS (SELECT task, len(list_intersect(p, r)) AS o, len(p) AS np, len(r) AS nr FROM sets),
word_scores AS (
  SELECT task, CASE WHEN np > 0 THEN o / np ELSE 0 END AS p, CASE WHEN nr > 0 THEN o / nr ELSE 0 END AS r,
         {f_measure("o", "np", "nr")} AS f FROM parts)"""


WORD_TOTALS = """
word_totals AS (
  SELECT round(avg(f), 6) AS word_f1, round(avg(p), 6) AS word_precision, round(avg(r), 6) AS word_recall
  FROM word_scores)"""
ORACLE_SQL["eval_word_f1"] = f"WITH {PAIRS}, {word_scores('pairs')}, {WORD_TOTALS} SELECT * FROM word_totals"

ORACLE_SQL["pair_by_position"] = f"""
WITH numbered AS (
  SELECT row_number, a.text AS prediction, b.text AS reference, NULL AS task
  FROM (SELECT text, row_number() OVER () - 1 AS row_number FROM conversations) a
  JOIN (SELECT text, row_number() OVER () - 1 AS row_number FROM documents) b USING (row_number)),
sets AS (
  SELECT row_number, list_distinct({word_tokens("prediction")}) AS p, list_distinct({word_tokens("reference")}) AS r FROM numbered),
parts AS (SELECT row_number, len(list_intersect(p, r)) AS o, len(p) AS np, len(r) AS nr FROM sets)
SELECT row_number, round({f_measure("o", "np", "nr")}, 6) AS word_f1,
       round(CAST(CASE WHEN np > 0 THEN o / np ELSE 0 END AS DOUBLE), 6) AS word_precision,
       round(CAST(CASE WHEN nr > 0 THEN o / nr ELSE 0 END AS DOUBLE), 6) AS word_recall FROM parts"""

ORACLE_SQL["eval_f1_by_task"] = f"""
WITH {ORDER_PAIRS}, {word_scores("order_pairs")}
SELECT coalesce(task, 'unknown') AS task, round(avg(f), 6) AS f1, count(*) AS count
FROM word_scores GROUP BY ALL"""


def task_scores(any_word: bool, source: str = "order_pairs", key: str = "o_orderkey") -> str:
    status = " OR ".join(
        f"(contains(lower(prediction), {text(w)}) AND contains(lower(reference), {text(w)}))" for w in C.STATUS_WORDS
    )
    identify = (
        f"WHEN task = {text(C.TASK_IDENTIFY)} THEN CAST(len(list_filter(r, lambda w: contains(lower(prediction), w))) > 0 AS INTEGER)"
        if any_word else ""
    )
    return f"""
task_words AS (
  SELECT *, list_distinct({tokens("lower(prediction)")}) AS p, list_distinct({tokens("lower(reference)")}) AS r
  FROM {source}),
task_scores AS (
  SELECT {key}, task, prediction, reference,
         CAST(CASE WHEN task = {text(C.TASK_STATUS)} THEN CAST(({status}) AS INTEGER) {identify}
              ELSE len(list_intersect(p, r)) / greatest(len(r), 1) END AS DOUBLE) AS score FROM task_words)"""


ORACLE_SQL["task_score"] = f"""
WITH {ORDER_PAIRS}, {task_scores(True)} SELECT o_orderkey, task, round(score, 6) AS score FROM task_scores"""

ORACLE_SQL["eval_by_task"] = f"""
WITH {ORDER_PAIRS}, {task_scores(False)}
SELECT coalesce(task, 'unknown') AS task, count(*) AS samples, round(avg(score), 6) AS task_specific_accuracy,
       round(avg(len({tokens("prediction")})), 6) AS avg_pred_length,
       round(avg(len({tokens("reference")})), 6) AS avg_ref_length
FROM task_scores GROUP BY 1"""

ORACLE_SQL["result_document"] = f"""
SELECT task, samples, task_specific_accuracy, samples AS written FROM ({ORACLE_SQL["eval_by_task"]})"""

ORACLE_SQL["eval_accuracy_rollup"] = f"""
WITH {ORDER_PAIRS},
marked AS (
  SELECT coalesce(task, 'unknown') AS task, lower(priority) = lower(next_priority) AS ok FROM order_pairs)
SELECT task, CAST(grouping(task) AS INTEGER) AS is_total, count(*) FILTER (WHERE ok) AS correct,
       count(*) AS total, round(avg(CAST(ok AS INTEGER)), 6) AS accuracy
FROM marked GROUP BY ROLLUP (task)"""


def ngram_overlap(tokenized, orders: str) -> str:
    """Clipped matches and gram counts per pair and order."""
    grams = "list_transform(range(1, greatest(len(t) - n + 2, 1)), lambda i: array_to_string(t[i:i + n - 1], ' '))"
    return f"""
sides AS (
  SELECT id, 0 AS side, {tokenized("prediction")} AS t FROM pairs
  UNION ALL SELECT id, 1, {tokenized("reference")} FROM pairs),
grams AS (SELECT id, side, n, unnest({grams}) AS g FROM sides, (VALUES {orders}) AS v(n)),
gram_counts AS (
  SELECT id, n, g, count(*) FILTER (WHERE side = 0) AS p, count(*) FILTER (WHERE side = 1) AS r
  FROM grams GROUP BY ALL),
matches AS (
  SELECT id, n, sum(least(p, r)) AS o, sum(p) AS np, sum(r) AS nr FROM gram_counts GROUP BY ALL)"""


BLEU = f"""{ngram_overlap(tokens, "(1), (2), (3), (4)")},
bleu_lengths AS (SELECT sum(len(t)) FILTER (WHERE side = 0) AS c, sum(len(t)) FILTER (WHERE side = 1) AS r FROM sides),
by_order AS (SELECT n, sum(o) AS o, sum(np) AS np, coalesce(sum(o) / nullif(sum(np), 0), 0) AS p FROM matches GROUP BY n),
bleu_score AS (
  SELECT CASE WHEN min(p) > 0 THEN exp(avg(ln(CASE WHEN p > 0 THEN p END))) *
              (SELECT CASE WHEN c > r THEN 1.0 ELSE exp(1.0 - r / c) END FROM bleu_lengths) ELSE 0.0 END AS bleu,
         max(CASE WHEN n = 1 THEN p END) AS bleu_1, max(CASE WHEN n = 2 THEN p END) AS bleu_2,
         max(CASE WHEN n = 3 THEN o END) AS match_3, max(CASE WHEN n = 4 THEN o END) AS match_4,
         max(CASE WHEN n = 4 THEN np END) AS possible_4 FROM by_order)"""
ORACLE_SQL["eval_bleu"] = f"""
WITH {PAIRS}, {BLEU}
SELECT round(bleu, 6) AS bleu, round(bleu_1, 6) AS bleu_1, round(bleu_2, 6) AS bleu_2,
       CAST(match_3 AS BIGINT) AS match_3, CAST(match_4 AS BIGINT) AS match_4,
       CAST(possible_4 AS BIGINT) AS possible_4 FROM bleu_score"""

ROUGE_N = f"""{ngram_overlap(alphanumeric, "(1), (2)")},
rouge_n AS (
  SELECT n, sum({f_measure("o", "np", "nr")}) / (SELECT count(*) FROM pairs) AS f FROM matches GROUP BY n)"""
ORACLE_SQL["eval_rouge_n"] = f"""
WITH {PAIRS}, {ROUGE_N}
SELECT round(max(CASE WHEN n = 1 THEN f END), 6) AS rouge1, round(max(CASE WHEN n = 2 THEN f END), 6) AS rouge2
FROM rouge_n"""

# Row by row of the subsequence table, all pairs at once.
ROUGE_L = f"""
whole AS (SELECT id, task, {alphanumeric("prediction")} AS p, {alphanumeric("reference")} AS r FROM pairs),
wanted AS (SELECT id, unnest(range(1, len(r) + 1)) AS i, unnest(r) AS word FROM whole),
cells AS (
  SELECT id, CAST(0 AS BIGINT) AS i, unnest(range(1, len(p) + 1)) AS j, unnest(p) AS word, CAST(0 AS BIGINT) AS v
  FROM whole
  UNION ALL
  SELECT id, i, j, word, max(candidate) OVER (PARTITION BY id ORDER BY j) FROM (
    SELECT c.id, c.i + 1 AS i, c.j, c.word,
           greatest(c.v, CASE WHEN c.word = w.word
                              THEN lag(c.v, 1, 0) OVER (PARTITION BY c.id ORDER BY c.j) + 1 ELSE 0 END) AS candidate
    FROM cells c JOIN wanted w ON w.id = c.id AND w.i = c.i + 1)),
lcs AS (SELECT id, max(v) AS v FROM cells GROUP BY id),
rouge_l AS (
  SELECT task, {f_measure("coalesce(v, 0)", "len(p)", "len(r)")} AS f FROM whole LEFT JOIN lcs USING (id))"""
ORACLE_SQL["eval_rouge_l"] = f"""
WITH RECURSIVE {PAIRS}, {ROUGE_L} SELECT task, round(avg(f), 6) AS "rougeL" FROM rouge_l GROUP BY task"""

# The same table per pair of lines (equal candidate lines once), then a walk back through it:
# a step up, left or, at equal words, both. Hits are clipped by the words of the prediction.
ROUGE_LSUM = f"""
line_sides AS (SELECT id, string_split(prediction, chr(10)) AS pl, string_split(reference, chr(10)) AS rl FROM pairs),
ref_lines AS (SELECT id, line, {alphanumeric("content")} AS r FROM (SELECT id, unnest(range(1, len(rl) + 1)) AS line, unnest(rl) AS content FROM line_sides)),
pred_lines AS (SELECT id, {alphanumeric("content")} AS p FROM (SELECT id, unnest(pl) AS content FROM line_sides)),
line_pairs AS MATERIALIZED (
  SELECT row_number() OVER () AS k, id, line, r, p FROM ref_lines JOIN (SELECT DISTINCT id, p FROM pred_lines) USING (id)
  WHERE list_has_any(r, p)),
line_wanted AS (SELECT k, unnest(range(1, len(r) + 1)) AS i, unnest(r) AS word FROM line_pairs),
line_cells AS (
  SELECT k, CAST(0 AS BIGINT) AS i, unnest(range(1, len(p) + 1)) AS j, unnest(p) AS word, CAST(0 AS BIGINT) AS v FROM line_pairs
  UNION ALL
  SELECT k, i, j, word, max(candidate) OVER (PARTITION BY k ORDER BY j) FROM (
    SELECT c.k, c.i + 1 AS i, c.j, c.word,
           greatest(c.v, CASE WHEN c.word = w.word
                              THEN lag(c.v, 1, 0) OVER (PARTITION BY c.k ORDER BY c.j) + 1 ELSE 0 END) AS candidate
    FROM line_cells c JOIN line_wanted w ON w.k = c.k AND w.i = c.i + 1)),
line_rows AS MATERIALIZED (
  SELECT k, i, v, lag(v) OVER (PARTITION BY k ORDER BY i) AS above, r[i] AS word, p
  FROM (SELECT k, i, list(v ORDER BY j) AS v FROM line_cells GROUP BY k, i) JOIN line_pairs USING (k)),
walk AS (
  SELECT k, CAST(len(r) AS BIGINT) AS i, CAST(len(p) AS BIGINT) AS j, CAST(0 AS BIGINT) AS hit FROM line_pairs
  UNION ALL
  SELECT k, CASE WHEN NOT same AND left_first THEN i ELSE i - 1 END, CASE WHEN same OR left_first THEN j - 1 ELSE j END,
         CASE WHEN same THEN i ELSE 0 END
  FROM (SELECT k, i, j, word = p[j] AS same, coalesce(v[j - 1], 0) > above[j] AS left_first
        FROM walk JOIN line_rows USING (k, i) WHERE i > 0 AND j > 0)),
line_hits AS (
  SELECT id, sum(least(h, n)) AS hits
  FROM (SELECT id, word, count(*) AS h FROM (SELECT DISTINCT id, line, hit, r[hit] AS word FROM walk JOIN line_pairs USING (k) WHERE hit > 0) GROUP BY ALL)
  JOIN (SELECT id, word, count(*) AS n FROM (SELECT id, unnest(p) AS word FROM pred_lines) GROUP BY ALL) USING (id, word) GROUP BY id),
rouge_lsum AS (SELECT id, task, {f_measure("coalesce(hits, 0)", "len(p)", "len(r)")} AS f FROM whole LEFT JOIN line_hits USING (id))"""
ORACLE_SQL["eval_rouge_lsum"] = f"""
WITH RECURSIVE {PAIRS}, {ROUGE_L}, {ROUGE_LSUM} SELECT task, round(avg(f), 6) AS "rougeLsum" FROM rouge_lsum GROUP BY task"""

ORACLE_SQL["eval_text_cosine"] = f"""
WITH {PAIRS},
stacked AS (SELECT id, 0 AS side, unnest({word_tokens("prediction")}) AS w FROM pairs UNION ALL SELECT id, 1, unnest({word_tokens("reference")}) FROM pairs),
counts AS (SELECT id, w, count(*) FILTER (WHERE side = 0) AS p, count(*) FILTER (WHERE side = 1) AS r FROM stacked GROUP BY ALL),
weights AS (
  SELECT w, ln((1 + 2 * (SELECT count(*) FROM pairs)) / (1 + sum(CAST(p > 0 AS INTEGER) + CAST(r > 0 AS INTEGER)))) + 1 AS x FROM counts GROUP BY w),
cosines AS (SELECT id, sum(p * r * x * x) / nullif(sqrt(sum(p * p * x * x)) * sqrt(sum(r * r * x * x)), 0) AS s FROM counts JOIN weights USING (w) GROUP BY id),
each_pair AS (SELECT coalesce(s, 0) AS s FROM pairs LEFT JOIN cosines USING (id))
SELECT round(avg(s), 6) AS semantic_similarity, round(stddev_pop(s), 6) AS semantic_similarity_std,
       round(min(s), 6) AS semantic_similarity_min, round(max(s), 6) AS semantic_similarity_max FROM each_pair"""

_DIGITS = "substr(md5('42:' || replicate || ':' || conv_id || '-' || turn), 1, 8)"
_WEIGHT = " + ".join(f"CAST({_DIGITS} >= '{limit}' AS INTEGER)" for limit in poisson_limits())
_VALUES = ("word_f1", "word_recall", "exact_match")
ORACLE_SQL["eval_intervals"] = f"""
WITH {PAIRS},
sets AS (
  SELECT *, list_distinct({word_tokens("prediction")}) AS p, list_distinct({word_tokens("reference")}) AS r,
         CAST({normalized("prediction")} = {normalized("reference")} AS INTEGER) AS exact_match FROM pairs),
parts AS (SELECT *, len(list_intersect(p, r)) AS o, len(p) AS np, len(r) AS nr FROM sets),
scores AS (
  SELECT task, conv_id, turn, {f_measure("o", "np", "nr")} AS word_f1, CASE WHEN nr > 0 THEN o / nr ELSE 0 END AS word_recall, exact_match FROM parts),
weighted AS (
  SELECT *, CASE WHEN replicate = 0 THEN 1 ELSE {_WEIGHT} END AS w FROM scores, (SELECT unnest(range(101)) AS replicate)),
sums AS (
  SELECT task, replicate, {", ".join(f"sum(w * {v}) / nullif(sum(w), 0) AS {v}" for v in _VALUES)} FROM weighted GROUP BY ALL)
""" + " UNION ALL ".join(
    f"""SELECT task, '{v}' AS metric, round(CAST(max({v}) FILTER (WHERE replicate = 0) AS DOUBLE), 6) AS value,
       round(CAST(quantile_cont({v}, 0.025) FILTER (WHERE replicate > 0) AS DOUBLE), 6) AS low,
       round(CAST(quantile_cont({v}, 0.975) FILTER (WHERE replicate > 0) AS DOUBLE), 6) AS high FROM sums GROUP BY task"""
    for v in _VALUES
)

ORACLE_SQL["eval_cosine"] = """
WITH pairs AS (
  SELECT list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT round(avg(s), 6) AS semantic_similarity, round(stddev_pop(s), 6) AS semantic_similarity_std,
       round(min(s), 6) AS semantic_similarity_min, round(max(s), 6) AS semantic_similarity_max FROM pairs"""

ORACLE_SQL["smiles_known_rate"] = f"""
WITH words AS (SELECT DISTINCT unnest({tokens("text")}) AS w FROM benchmark),
found AS (SELECT unnest({candidates("text")}) AS c FROM documents)
SELECT count(*) AS candidates, count(w) AS valid_smiles_count, CAST(0 AS BIGINT) AS reference_smiles_count,
       round(count(w) / count(*), 6) AS smiles_validity_rate
FROM found LEFT JOIN words ON c = w"""

ORACLE_SQL["smiles_pair_rate"] = f"""
WITH {PAIRS},
words AS (SELECT DISTINCT unnest({tokens("text")}) AS w FROM documents),
found AS (
  SELECT 0 AS side, unnest({candidates("prediction")}) AS c FROM pairs
  UNION ALL SELECT 1, unnest({candidates("reference")}) FROM pairs)
SELECT count(*) FILTER (WHERE side = 0) AS candidates, count(w) FILTER (WHERE side = 0) AS valid_smiles_count,
       count(w) FILTER (WHERE side = 1) AS reference_smiles_count,
       round(count(w) FILTER (WHERE side = 0) / count(*) FILTER (WHERE side = 0), 6) AS smiles_validity_rate
FROM found LEFT JOIN words ON c = w"""

_GRAM_CTES = ("sides", "grams", "gram_counts", "matches")


def renamed(sql: str, prefix: str) -> str:
    """The n-gram views a second time under other names."""
    for name in sorted(_GRAM_CTES, key=len, reverse=True):
        sql = sql.replace(f"\n{name} AS", f"\n{prefix}{name} AS").replace(f"FROM {name}", f"FROM {prefix}{name}")
    return sql


_WIDE = (
    "exact_match", "word_f1", "bleu", "rouge1", "rougeL", "rougeLsum", "exact_match_count", "word_precision", "word_recall",
    "length_ratio", "rouge2", "avg_pred_length", "avg_ref_length", "length_std", "bleu_1", "bleu_2",
    "smiles_validity_rate", "valid_smiles_count", "reference_smiles_count",
)
_RANK = {name: i for i, name in enumerate(C.METRIC_PRIORITY, start=1)}
_LAST = len(C.METRIC_PRIORITY) + 1
ORACLE_SQL["metric_long"] = f"""
WITH RECURSIVE {PAIRS}, {LENGTHS}, {word_scores("pairs")}, {WORD_TOTALS}, {BLEU}, {renamed(ROUGE_N, "rouge_")}, {ROUGE_L}, {ROUGE_LSUM},
same AS (SELECT {normalized("prediction")} = {normalized("reference")} AS same FROM pairs),
words AS (SELECT DISTINCT unnest({tokens("text")}) AS w FROM documents),
found AS (
  SELECT 0 AS side, unnest({candidates("prediction")}) AS c FROM pairs
  UNION ALL SELECT 1, unnest({candidates("reference")}) FROM pairs),
known AS (
  SELECT count(w) FILTER (WHERE side = 0) / count(*) FILTER (WHERE side = 0) AS rate,
         count(w) FILTER (WHERE side = 0) AS p, count(w) FILTER (WHERE side = 1) AS r
  FROM found LEFT JOIN words ON c = w),
wide AS (
  SELECT (SELECT avg(CAST(same AS INTEGER)) FROM same) AS exact_match,
         word_f1, (SELECT bleu FROM bleu_score) AS bleu,
         (SELECT f FROM rouge_n WHERE n = 1) AS rouge1, (SELECT avg(f) FROM rouge_l) AS "rougeL",
         (SELECT avg(f) FROM rouge_lsum) AS "rougeLsum",
         (SELECT count(*) FROM same WHERE same) AS exact_match_count,
         word_precision, word_recall, length_ratio, (SELECT f FROM rouge_n WHERE n = 2) AS rouge2,
         avg_pred_length, avg_ref_length, length_std,
         (SELECT bleu_1 FROM bleu_score) AS bleu_1, (SELECT bleu_2 FROM bleu_score) AS bleu_2,
         rate AS smiles_validity_rate, known.p AS valid_smiles_count, known.r AS reference_smiles_count
  FROM length_totals, word_totals, known)
""" + " UNION ALL ".join(
    f'SELECT {text(name)} AS metric, round(CAST("{name}" AS DOUBLE), 6) AS value, '
    f"CAST({_RANK.get(name, _LAST)} AS INTEGER) AS rank FROM wide"
    for name in _WIDE
) + f"""
UNION ALL SELECT task || '_f1', round(avg(f), 6), CAST({_LAST} AS INTEGER) FROM word_scores GROUP BY task
UNION ALL SELECT task || '_count', CAST(count(*) AS DOUBLE), CAST({_LAST} AS INTEGER) FROM word_scores GROUP BY task"""

ORACLE_SQL["eval_report_by_task"] = f"""
WITH RECURSIVE {PAIRS}, {ngram_overlap(tokens, "(1), (2), (3), (4)")}, {renamed(ngram_overlap(alphanumeric, "(1), (2)"), "rouge_")},
{ROUGE_L}, {ROUGE_LSUM}, {task_scores(False, "pairs", "id")},
per_row AS (
  SELECT s.id, s.task, s.score, len({tokens("s.prediction")}) AS p, len({tokens("s.reference")}) AS r,
         coalesce((SELECT {f_measure("m.o", "m.np", "m.nr")} FROM rouge_matches m WHERE m.id = s.id AND m.n = 1), 0) AS f1,
         coalesce((SELECT {f_measure("m.o", "m.np", "m.nr")} FROM rouge_matches m WHERE m.id = s.id AND m.n = 2), 0) AS f2
  FROM task_scores s),
means AS (
  SELECT task, CAST(grouping(task) AS INTEGER) AS is_total, count(*) AS samples, avg(score) AS score,
         avg(f1) AS f1, avg(f2) AS f2, avg(p) AS p, avg(r) AS r, sum(p) AS c, sum(r) AS w
  FROM per_row GROUP BY ROLLUP (task)),
lcs_means AS (SELECT task, CAST(grouping(task) AS INTEGER) AS is_total, avg(f) AS f FROM rouge_l GROUP BY ROLLUP (task)),
sum_means AS (SELECT task, CAST(grouping(task) AS INTEGER) AS is_total, avg(f) AS f FROM rouge_lsum GROUP BY ROLLUP (task)),
precisions AS (
  SELECT task, CAST(grouping(task) AS INTEGER) AS is_total, n, sum(o) / sum(np) AS p
  FROM matches JOIN pairs USING (id) GROUP BY GROUPING SETS ((task, n), (n))),
bleus AS (
  SELECT task, is_total, CASE WHEN min(p) > 0 THEN exp(avg(ln(CASE WHEN p > 0 THEN p END))) ELSE 0 END AS g
  FROM precisions GROUP BY ALL)
SELECT m.task, m.is_total, m.samples, round(m.score, 6) AS task_specific_accuracy, round(m.f1, 6) AS rouge1,
       round(m.f2, 6) AS rouge2, round(l.f, 6) AS "rougeL", round(u.f, 6) AS "rougeLsum", round(m.p, 6) AS avg_pred_length,
       round(m.r, 6) AS avg_ref_length,
       round(b.g * CASE WHEN m.c > m.w THEN 1.0 ELSE exp(1.0 - m.w / m.c) END, 6) AS bleu
FROM means m JOIN bleus b ON b.is_total = m.is_total AND b.task IS NOT DISTINCT FROM m.task
     JOIN lcs_means l ON l.is_total = m.is_total AND l.task IS NOT DISTINCT FROM m.task
     JOIN sum_means u ON u.is_total = m.is_total AND u.task IS NOT DISTINCT FROM m.task"""

# --- keywords and comparison -----------------------------------------------------
_KEYWORDS = " ".join(
    f"WHEN lang = {text(lang)} THEN [{listed(words)}]" for lang, words in I.KEYWORDS_BY_LANGUAGE.items()
)


def keyword_hits(column: str, keywords: str) -> str:
    return f"len(list_filter({keywords}, lambda k: contains(lower({column}), lower(k))))"


ORACLE_SQL["keyword_score"] = f"""
WITH suite AS (SELECT doc_id, text, CASE {_KEYWORDS} ELSE [] END AS keywords FROM documents),
hits AS (SELECT doc_id, {keyword_hits("text", "keywords")} AS m, len(keywords) AS k FROM suite)
SELECT doc_id, m AS keyword_matches, k AS total_keywords,
       round(CASE WHEN k > 0 THEN m / k ELSE 0 END, 6) AS relevance_score FROM hits"""

ORACLE_SQL["keyword_suite"] = f"""
WITH suite AS (SELECT DISTINCT unnest({tokens("text")}) AS keyword FROM benchmark),
turns AS (SELECT conv_id || '-' || turn AS sample, lower(text) AS low FROM conversations WHERE role = 'user')
SELECT sample, count(*) FILTER (WHERE contains(low, lower(keyword))) AS keyword_matches, count(*) AS total_keywords,
       round(count(*) FILTER (WHERE contains(low, lower(keyword))) / count(*), 6) AS relevance_score
FROM turns, suite GROUP BY sample"""

SCORED = f"""{PAIRS},
scored AS (
  SELECT lpad(CAST(conv_id AS VARCHAR), 12, '0') || '-' || lpad(CAST(turn AS VARCHAR), 6, '0') AS prompt_id, task,
         reference AS base_text, prediction AS tuned_text,
         {keyword_hits("reference", f"[{listed(I.KEYWORDS)}]")} AS base_m,
         {keyword_hits("prediction", f"[{listed(I.KEYWORDS)}]")} AS tuned_m,
         {len(I.KEYWORDS)} AS k,
         length(reference) / 100.0::DOUBLE AS base_l, length(prediction) / 100.0::DOUBLE AS tuned_l FROM pairs)"""

ORACLE_SQL["compare_winner"] = f"""
WITH {SCORED}
SELECT prompt_id, task, round(base_m / k, 6) AS base_score, round(tuned_m / k, 6) AS tuned_score,
       CASE WHEN tuned_m > base_m THEN 'finetuned' WHEN base_m > tuned_m THEN 'base' ELSE 'Tie' END AS winner
FROM scored"""

ORACLE_SQL["compare_missing_side"] = f"""
WITH {SCORED}
SELECT prompt_id, task, round(base_m / k, 6) AS base_score,
       CASE WHEN prompt_id NOT LIKE '%4' THEN round(tuned_m / k, 6) END AS tuned_score,
       CASE WHEN prompt_id LIKE '%4' THEN NULL WHEN tuned_m > base_m THEN 'finetuned'
            WHEN base_m > tuned_m THEN 'base' ELSE 'Tie' END AS winner
FROM scored"""

ORACLE_SQL["compare_suite"] = f"""
WITH {SCORED},
sides AS (
  SELECT prompt_id, task, k, unnest(['base', 'finetuned']) AS model, unnest([base_m, tuned_m]) AS m FROM scored)
SELECT prompt_id, model, CASE WHEN known THEN m ELSE 0 END AS keyword_matches,
       CAST(CASE WHEN known THEN k ELSE 0 END AS BIGINT) AS total_keywords,
       CASE WHEN known THEN round(m / k, 6) ELSE 0.0::DOUBLE END AS relevance_score
FROM (SELECT *, task <> {text(C.TASK_STATUS)} AS known FROM sides)"""

ORACLE_SQL["compare_summary"] = f"""
WITH {SCORED},
sums AS (
  SELECT avg(base_m / k) AS b, avg(tuned_m / k) AS f, avg(base_l) AS bl, avg(tuned_l) AS fl,
         sum(base_m) AS bm, sum(tuned_m) AS fm, sum(k) AS k FROM scored)
SELECT round(b, 6) AS base_relevance, round(f, 6) AS finetuned_relevance, round(bl, 6) AS base_latency,
       round(fl, 6) AS finetuned_latency, CAST(bm AS BIGINT) AS base_matches, CAST(fm AS BIGINT) AS finetuned_matches,
       CAST(k AS BIGINT) AS total_keywords, round((f - b) / greatest(b, 0.01) * 100, 6) AS improvement_percent,
       round((fm - bm) / greatest(bm, 1) * 100, 6) AS matches_percent, round((fl - bl) / bl * 100, 6) AS latency_percent,
       round(bm / k, 6) AS base_keyword_accuracy, round(fm / k, 6) AS finetuned_keyword_accuracy,
       CASE WHEN f > b THEN 'better' WHEN f = b THEN 'similar' ELSE 'worse' END AS verdict FROM sums"""


def _excerpt(column: str) -> str:
    n = C.SAMPLE_CHARACTERS
    return f"CASE WHEN length({column}) > {n} THEN substr({column}, 1, {n}) || '...' ELSE {column} END"


ORACLE_SQL["compare_samples"] = f"""
WITH {SCORED}
SELECT prompt_id, {_excerpt("base_text")} AS instruction, '' AS input, {_excerpt("rendered")} AS rendered,
       {_excerpt("base_text")} AS base_response, round(base_m / k, 6) AS base_score,
       round(base_l, 6) AS base_latency, {_excerpt("tuned_text")} AS tuned_response,
       round(tuned_m / k, 6) AS tuned_score, round(tuned_l, 6) AS tuned_latency
FROM (SELECT *, '### Instruction:' || chr(10) || base_text || chr(10) || chr(10) || '### Input:' || chr(10)
             || chr(10) || chr(10) || '### Response:' || chr(10) AS rendered FROM scored)
ORDER BY prompt_id LIMIT {C.SAMPLE_PROMPTS}"""

ORACLE_SQL["batch_score"] = f"""
SELECT conv_id, turn, 'answer: ' || len({tokens("text")}) || ' words' AS response FROM conversations"""

ORACLE_SQL["batch_resume"] = """
SELECT conv_id, turn, length(text) || ' characters' AS response, CAST(1 + turn % 2 AS INTEGER) AS attempt FROM conversations"""
