"""Declared schemas: nothing in the library infers a type at read time.

Blank and missing are the same thing (NULL); dates stay text because no operator
interprets them.
"""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT = T.StringType()
_TEXTS = T.ArrayType(_TEXT)

# --- flat tables -----------------------------------------------------------------
STRUCTURE_FIELDS = [
    T.StructField("cid", T.LongType()),
    T.StructField("molecular_formula", _TEXT),
    T.StructField("molecular_weight", T.DoubleType()),
    *_strings("canonical_smiles", "isomeric_smiles", "inchi", "inchi_key"),
]
STRUCTURES = T.StructType([*_strings("drug_name"), *STRUCTURE_FIELDS])

PRODUCTS = T.StructType(
    _strings(
        "product_ndc", "generic_name", "brand_name", "labeler_name", "active_ingredients",
        "dosage_form", "route", "product_type", "marketing_category", "application_number",
    )
)
LABELS = T.StructType(
    _strings(
        "brand_name", "generic_name", "manufacturer", "substance_name", "product_type",
        "route", "application_number", "indications", "warnings", "dosage",
        "active_ingredients", "purpose",
    )
)
ADVERSE_EVENTS = T.StructType(
    _strings(
        "drug_name", "drug_indication", "drug_characterization", "reactions", "outcome",
        "serious", "receive_date", "country",
    )
)
RECALLS = T.StructType(
    _strings(
        "product_description", "reason_for_recall", "status", "classification",
        "recalling_firm", "recall_initiation_date", "voluntary_mandated", "city", "state",
    )
)
TRIALS = T.StructType(
    [
        *_strings("nct_id", "title", "official_title", "status", "why_stopped", "phase", "study_type"),
        T.StructField("enrollment", T.IntegerType()),
        *_strings(
            "conditions", "drug_names", "intervention_types", "primary_outcomes",
            "start_date", "completion_date", "sponsor", "sponsor_type",
        ),
    ]
)
UNIFIED = T.StructType(
    [
        *_strings("drug_name", "source", "status"),
        *STRUCTURE_FIELDS,
        *_strings("adverse_reactions", "failure_reason"),
    ]
)
INSTRUCTIONS = T.StructType(_strings("instruction", "input", "output", "task"))
PREDICTIONS = T.StructType(
    _strings("sample_id", "instruction", "input", "expected", "prediction", "task")
)

# --- landed JSON pages -----------------------------------------------------------
LABEL_PAGE = _struct(
    results=T.ArrayType(
        _struct(
            openfda=_struct(
                brand_name=_TEXTS, generic_name=_TEXTS, manufacturer_name=_TEXTS,
                substance_name=_TEXTS, product_type=_TEXTS, route=_TEXTS,
                application_number=_TEXTS,
            ),
            indications_and_usage=_TEXTS, warnings=_TEXTS, dosage_and_administration=_TEXTS,
            active_ingredient=_TEXTS, purpose=_TEXTS,
        )
    )
)
EVENT_PAGE = _struct(
    results=T.ArrayType(
        _struct(
            serious=_TEXT, receivedate=_TEXT, occurcountry=_TEXT,
            patient=_struct(
                drug=T.ArrayType(
                    _struct(medicinalproduct=_TEXT, drugindication=_TEXT, drugcharacterization=_TEXT)
                ),
                reaction=T.ArrayType(_struct(reactionmeddrapt=_TEXT)),
                summary=_struct(narrativeincludeclinical=_TEXT),
            ),
        )
    )
)
RECALL_PAGE = _struct(results=T.ArrayType(RECALLS))
PRODUCT_PAGE = _struct(
    results=T.ArrayType(
        _struct(
            product_ndc=_TEXT, generic_name=_TEXT, brand_name=_TEXT, labeler_name=_TEXT,
            active_ingredients=T.ArrayType(_struct(name=_TEXT, strength=_TEXT)),
            dosage_form=_TEXT, route=_TEXTS, product_type=_TEXT, marketing_category=_TEXT,
            application_number=_TEXT,
        )
    )
)
_DATED = _struct(date=_TEXT)
TRIAL_PAGE = _struct(
    studies=T.ArrayType(
        _struct(
            protocolSection=_struct(
                identificationModule=_struct(nctId=_TEXT, briefTitle=_TEXT, officialTitle=_TEXT),
                statusModule=_struct(
                    overallStatus=_TEXT, whyStopped=_TEXT, startDateStruct=_DATED,
                    completionDateStruct=_DATED,
                ),
                designModule=_struct(
                    phases=_TEXTS, studyType=_TEXT, enrollmentInfo=_struct(count=_TEXT)
                ),
                conditionsModule=_struct(conditions=_TEXTS),
                armsInterventionsModule=_struct(
                    interventions=T.ArrayType(_struct(type=_TEXT, name=_TEXT))
                ),
                outcomesModule=_struct(primaryOutcomes=T.ArrayType(_struct(measure=_TEXT))),
                sponsorCollaboratorsModule=_struct(
                    leadSponsor=T.StructType(_strings("name", "class"))
                ),
            )
        )
    )
)
STRUCTURE_PAYLOAD = _struct(
    PropertyTable=_struct(
        Properties=T.ArrayType(
            _struct(
                CID=T.LongType(), MolecularFormula=_TEXT, MolecularWeight=_TEXT,
                CanonicalSMILES=_TEXT, ConnectivitySMILES=_TEXT, IsomericSMILES=_TEXT,
                InChI=_TEXT, InChIKey=_TEXT,
            )
        )
    )
)
