"""Target tables of the ingest jobs.

A table is a Spark DDL string plus its constraints; the raw JSON schema of a record is derived from
it, so nothing is inferred at run time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: columns of the public medical-device exports, in their documented order -------
_DEVICE_EVENT = """
adverse_event_flag string, date_facility_aware date, date_manufacturer_received date,
date_of_event date, date_received date, date_report date, date_report_to_fda date,
date_report_to_manufacturer date, device_date_of_manufacturer date, distributor_address_1 string,
distributor_address_2 string, distributor_city string, distributor_name string,
distributor_state string, distributor_zip_code string, distributor_zip_code_ext string,
event_key string, event_location string, event_type string, expiration_date_of_device date,
health_professional string, initial_report_to_fda string, manufacturer_address_1 string,
manufacturer_address_2 string, manufacturer_city string, manufacturer_contact_address_1 string,
manufacturer_contact_address_2 string, manufacturer_contact_area_code string,
manufacturer_contact_city string, manufacturer_contact_country string,
manufacturer_contact_exchange string, manufacturer_contact_extension string,
manufacturer_contact_f_name string, manufacturer_contact_l_name string,
manufacturer_contact_pcity string, manufacturer_contact_pcountry string,
manufacturer_contact_phone_number string, manufacturer_contact_plocal string,
manufacturer_contact_postal_code string, manufacturer_contact_state string,
manufacturer_contact_t_name string, manufacturer_contact_zip_code string,
manufacturer_contact_zip_ext string, manufacturer_country string, manufacturer_g1_address_1 string,
manufacturer_g1_address_2 string, manufacturer_g1_city string, manufacturer_g1_country string,
manufacturer_g1_name string, manufacturer_g1_postal_code string, manufacturer_g1_state string,
manufacturer_g1_zip_code string, manufacturer_g1_zip_code_ext string,
manufacturer_link_flag string, manufacturer_name string, manufacturer_postal_code string,
manufacturer_state string, manufacturer_zip_code string, manufacturer_zip_code_ext string,
mdr_report_key string, number_devices_in_event string, number_patients_in_event string,
previous_use_code string, product_problems array<string>, product_problem_flag string,
remedial_action array<string>, removal_correction_number string, report_date date,
report_number string, report_source_code string, report_to_fda string,
report_to_manufacturer string, reporter_occupation_code string,
reprocessed_and_reused_flag string, single_use_flag string, source_type array<string>,
type_of_report array<string>
"""
_DEVICE = """
brand_name string, catalog_number string, date_received date, date_removed_flag string,
date_returned_to_manufacturer date, device_age_text string, device_availability string,
device_evaluated_by_manufacturer string, device_operator string,
device_report_product_code string, device_sequence_number string, expiration_date_of_device date,
generic_name string, udi_di string, implant_flag string, lot_number string,
manufacturer_d_address_1 string, manufacturer_d_address_2 string, manufacturer_d_city string,
manufacturer_d_country string, manufacturer_d_name string, manufacturer_d_postal_code string,
manufacturer_d_state string, manufacturer_d_zip_code string, manufacturer_d_zip_code_ext string,
model_number string, other_id_number string, udi_public string, openfda_device_name string,
openfda_medical_specialty_description string, openfda_regulation_number string,
openfda_device_class string
"""
_PATIENT = """
date_received date, patient_sequence_number string, patient_age string, patient_sex string,
patient_weight string, patient_ethnicity string, patient_race string
"""
_MDR_TEXT = """
mdr_text_key bigint, patient_sequence_number int, text string, text_type_code varchar(1023)
"""
_RECALL = """
cfres_id string, k_number array<string>, pma_number array<string>, event_date_initiated date,
event_date_created date, event_date_posted date, event_date_terminated date, recall_status string,
recalling_firm string, firm_fei_number string, address_1 string, address_2 string, city string,
state string, postal_code varchar(20), country string, additional_info_contact string,
reason_for_recall string, other_submission_description string, product_description string,
code_info string, product_code string, product_res_number string, product_quantity string,
distribution_pattern string, res_event_number string, root_cause_description string,
action string, openfda_device_class string, openfda_device_name string,
openfda_medical_specialty_description string, openfda_regulation_number string,
openfda_fei_number array<string>, openfda_k_number array<string>,
openfda_registration_number array<string>
"""
_DEVICE_ENFORCEMENTS = """
address_1 string, address_2 string, center_classification_date date, city string,
classification string, code_info string, country string, distribution_pattern string,
recall_event_id bigint, initial_firm_notification string, more_code_info string,
product_code string, product_description string, product_quantity string, product_type string,
reason_for_recall string, recall_initiation_date date, recall_number string,
recalling_firm string, report_date date, state string, status string, termination_date date,
voluntary_mandated string
"""
_DEVICE_CLASSIFICATION = """
definition string, device_class string, device_name string, gmp_exempt_flag string,
implant_flag string, life_sustain_support_flag string, medical_specialty_code char(2),
product_code varchar(255), regulation_number varchar(255), review_code varchar(255),
review_panel varchar(255), submission_type_id string, summary_malfunction_reporting string,
third_party_flag string, unclassified_reason string, openfda_pma_number array<string>,
openfda_fei_number array<string>, openfda_k_number array<string>,
openfda_registration_number array<string>
"""
_SUBMISSION = """
address_1 string, address_2 string, city varchar(255), country_code varchar(2),
postal_code varchar(20), state varchar(50), zip_code varchar(20), applicant varchar(255),
contact varchar(255), advisory_committee_code varchar(2),
advisory_committee_description varchar(255), clearance_type_code varchar(20),
clearance_description varchar(255), date_received date, decision_code varchar(4),
decision_date date, decision_description string, expedited_review_flag boolean,
k_number varchar(50), product_code varchar(50), review_advisory_committee varchar(255),
statement_or_summary string, third_party_flag boolean, openfda_device_class varchar(1),
openfda_device_name varchar(255), openfda_medical_specialty_description varchar(255),
openfda_fei_number array<string>, openfda_registration_number array<string>,
openfda_regulation_number string
"""
_PMA_SUBMISSION = """
advisory_committee_code char(2), advisory_committee_description string, ao_statement string,
applicant string, city string, state string, street_1 string, street_2 string, zip varchar(10),
zip_ext varchar(10), date_received date, decision_code char(4), decision_date date,
docket_number string, expedited_review_flag char(1), fed_reg_notice_date date,
generic_name string, pma_number string, product_code varchar(10), supplement_number string,
supplement_reason string, supplement_type string, trade_name string, openfda_device_class char(1),
openfda_device_name string, openfda_medical_specialty_description string,
openfda_regulation_number string, openfda_fei_number array<string>,
openfda_registration_number array<string>
"""
PATIENT_OUTCOMES = (
    "Life Threatening", "Hospitalization", "Disability", "Congenital Anomaly",
    "Required Intervention", "Other", "Invalid Data", "Unknown", "No Information",
    "Not Applicable", "Death",
)
DEVICE_CLASSES = ("1", "2", "3", "U", "N", "F")
MEDICAL_SPECIALTIES = (
    ("AN", "Anesthesiology"), ("CV", "Cardiovascular"), ("CH", "Clinical Chemistry"),
    ("DE", "Dental"), ("EN", "Ear, Nose, Throat"), ("GU", "Gastroenterology, Urology"),
    ("HO", "General Hospital"), ("HE", "Hematology"), ("IM", "Immunology"),
    ("MG", "Medical Genetics"), ("MI", "Microbiology"), ("NE", "Neurology"),
    ("OB", "Obstetrics/Gynecology"), ("OP", "Ophthalmic"), ("OR", "Orthopedic"),
    ("PA", "Pathology"), ("PM", "Physical Medicine"), ("RA", "Radiology"),
    ("SU", "General, Plastic Surgery"), ("TX", "Clinical Toxicology"),
)
# --- end of fixed values ------------------------------------------------------------------------

OPENFDA_PREFIX = "openfda_"


@dataclass(frozen=True)
class TableSpec:
    """Columns of a target table and the constraints its rows must satisfy."""

    name: str
    ddl: str
    id_column: str = "id"
    natural_key: str | None = None
    unique: tuple[str, ...] = ()
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    renamed: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[T.StructField]:
        return T.StructType.fromDDL(self.ddl).fields

    def raw_fields(self) -> list[T.StructField]:
        """The JSON fields behind the columns, all textual; ``openfda`` becomes a struct."""
        plain, nested = [], []
        for column in self.columns:
            textual = T.ArrayType(T.StringType()) if is_array(column) else T.StringType()
            if column.name.startswith(OPENFDA_PREFIX):
                nested.append(T.StructField(column.name.removeprefix(OPENFDA_PREFIX), textual))
            else:
                plain.append(T.StructField(self.renamed.get(column.name, column.name), textual))
        if nested:
            plain.append(T.StructField("openfda", T.StructType(nested)))
        return plain


def is_array(column: T.StructField) -> bool:
    return isinstance(column.dataType, T.ArrayType)


DEVICE_EVENT = TableSpec(
    "device_event", _DEVICE_EVENT, "event_id", "mdr_report_key", unique=("mdr_report_key",)
)
DEVICE = TableSpec("device", _DEVICE, "device_id")
PATIENT = TableSpec("patient", _PATIENT, "patient_id")
MDR_TEXT = TableSpec("mdr_text", _MDR_TEXT, "mdr_text_id", unique=("mdr_text_key",))
PATIENT_PROBLEM = TableSpec(
    "patient_problem",
    "problem_description string, outcome string, treatment_description string",
    "problem_id",
    domains={"outcome": PATIENT_OUTCOMES},
)
RECALL = TableSpec("recall", _RECALL, natural_key="cfres_id")
DEVICE_ENFORCEMENTS = TableSpec(
    "device_enforcements",
    _DEVICE_ENFORCEMENTS,
    natural_key="recall_number",
    renamed={"recall_event_id": "event_id"},
)
DEVICE_CLASSIFICATION = TableSpec(
    "device_classification", _DEVICE_CLASSIFICATION, natural_key="product_code"
)
SUBMISSION = TableSpec("submission", _SUBMISSION, natural_key="k_number", unique=("k_number",))
PMA_SUBMISSION = TableSpec("pma_submission", _PMA_SUBMISSION, natural_key="pma_number")

FLAT_FEEDS = {
    "device_enforcements": DEVICE_ENFORCEMENTS,
    "device_classification": DEVICE_CLASSIFICATION,
    "submission": SUBMISSION,
    "pma_submission": PMA_SUBMISSION,
    "recall": RECALL,
}

META_DDL = (
    "disclaimer string, license string, last_updated string, "
    "results struct<skip: int, limit: int, total: int>"
)


def event_record() -> T.StructType:
    problems = T.StructType.fromDDL(
        "patient_problems array<string>, sequence_number_outcome array<string>, "
        "sequence_number_treatment array<string>"
    ).fields
    nested = {
        "patient": PATIENT.raw_fields() + problems,
        "device": DEVICE.raw_fields(),
        "mdr_text": MDR_TEXT.raw_fields(),
    }
    arrays = [
        T.StructField(name, T.ArrayType(T.StructType(fields))) for name, fields in nested.items()
    ]
    return T.StructType(DEVICE_EVENT.raw_fields() + arrays)


def flat_record(spec: TableSpec) -> T.StructType:
    return T.StructType(spec.raw_fields())
