"""Fixed values.

These decide results (status vocabularies, wording of generated rows, patterns,
ratios, separators), so they are given values. Everything that uses them takes
them as a default argument.
"""

# Status vocabularies.
APPROVED_STATUSES = ("approved", "APPROVED", "COMPLETED")
STOPPED_STATUSES = ("TERMINATED", "WITHDRAWN", "SUSPENDED")
COMPLETED_STATUSES = ("COMPLETED",)
LATE_PHASES = ("PHASE3", "PHASE4")
DRUG_INTERVENTION_TYPES = ("DRUG", "BIOLOGICAL")
STATUS_SCORES = {
    "approved": 1.0,
    "withdrawn": 0.0,
    "terminated": 0.0,
    "suspended": 0.0,
    "completed": 1.0,
    "active": 0.5,
    "recruiting": 0.5,
}
STATUS_WORDS = ("approved", "terminated", "withdrawn", "suspended", "completed")

# Separators and list sizes.
NAME_SEPARATOR = ", "
VALUE_SEPARATOR = "; "
MAX_REACTIONS = 5
MAX_REASONS = 3

# Source tags of the name dictionary and the name of unusable rows.
REGISTRY_SOURCE = "fda_orange_book"
LABEL_SOURCE = "openfda_labels"
TRIAL_SOURCE = "clinicaltrials"
LISTED_STATUS = "approved"
UNKNOWN_NAME = "Unknown"
UNKNOWN_REASON = "Unknown reasons"
UNKNOWN_TASK = "unknown"
LOOKUP_SUFFIX = "_pubchem"

# Wording of the instruction rows.
TASK_STATUS = "status_analysis"
TASK_REACTIONS = "adverse_events"
TASK_STRUCTURE = "structure_analysis"
TASK_IDENTIFY = "structure_identification"
TASK_FAILURE = "failure_analysis"
SUBJECT_INPUT = "Drug: {name}"
STRUCTURE_LINE = "\nSMILES: {structure}"
STRUCTURE_INPUT = "SMILES: {structure}"
APPROVED_QUESTION = "What is the approval status of {name}?"
APPROVED_ANSWER = (
    "{name} is an FDA-approved drug. It has completed regulatory review "
    "and is authorized for clinical use."
)
STOPPED_QUESTION = "What is the status of {name} and why?"
STOPPED_ANSWER = "{name} has a status of {status}. Reason: {reason}"
REACTIONS_QUESTION = "What are the known adverse reactions for {name}?"
REACTIONS_ANSWER = "Known adverse reactions for {name} include: {reactions}"
STRUCTURE_QUESTION = "What is the molecular structure of {name}?"
STRUCTURE_ANSWER = (
    "The molecular structure of {name} is represented by the SMILES notation: {structure}"
)
IDENTIFY_QUESTION = "Identify this drug compound from its SMILES structure."
IDENTIFY_ANSWER = "This SMILES structure corresponds to {name}."
FAILURE_QUESTION = "Why did {name} fail in clinical trials?"
FAILURE_ANSWER = "{name} failed because: {reason}"

# Prompt layout.
PROMPT_WITH_INPUT = (
    "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{output}"
)
PROMPT_WITHOUT_INPUT = "### Instruction:\n{instruction}\n\n### Response:\n{output}"
RESPONSE_MARKER = "### Response:"
PROMPT_TOKEN_BUDGET = 2048

# Split and filter settings.
SPLIT_SEED = 42
TRAIN_RATIO = 0.8
MIN_ROWS_TO_SPLIT = 10
MIN_ROWS_TO_STRATIFY = 20
MIN_HELD_OUT_TO_STRATIFY = 10
MIN_STRUCTURE_LENGTH = 5
MAX_STRUCTURE_LENGTH = 500

# Candidate structures inside free text, and the report layout.
STRUCTURE_PATTERN = (
    r"[A-Za-z0-9@+\-\[\]\(\)=#$%\\/\.]+(?:=[A-Za-z0-9@+\-\[\]\(\)=#$%\\/\.]+)*"
)
MIN_CANDIDATE_LENGTH = 5
SAMPLE_PROMPTS = 3
SAMPLE_CHARACTERS = 300
METRIC_PRIORITY = (
    "exact_match",
    "word_f1",
    "bleu",
    "rouge1",
    "rougeL",
    "semantic_similarity",
    "smiles_validity_rate",
)
