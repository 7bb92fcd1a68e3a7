"""Expected results in SQL, straight from the driver tables.

No message, Bundle or document is built here: the SQL states the formulas behind the inputs, so a
parse fault cannot hide on both sides.
"""

from __future__ import annotations

from checks import expected as v
from checks import inputs
from checks.queries import FACILITY

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(values: list[str], number: str) -> str:
    listed = ", ".join(text(value) for value in values)
    return f"list_extract([{listed}], ({number}) % {len(values)} + 1)"


def case(subject: str, values: dict[str, str], other: str = "NULL") -> str:
    branches = " ".join(f"WHEN {text(k)} THEN {text(x)}" for k, x in values.items())
    return f"(CASE {subject} {branches} ELSE {other} END)"


def described(system: str, code: str) -> str:
    subject = f"upper({code})" if system == "hedis" else code
    prefix = v.UNKNOWN_PREFIX[system]
    other = code if prefix is None else f"{text(prefix)} || {code}"
    return case(subject, v.TERMINOLOGY[system], other)


def members(values: list[str]) -> str:
    return "(" + ", ".join(text(value) for value in values) + ")"


def snomed_valid(code: str) -> str:
    return f"regexp_matches({code}, '^[0-9]{{6,18}}$')"


def icd10_valid(code: str) -> str:
    return f"regexp_matches({code}, '^[A-Z][0-9][0-9]([.][A-Z0-9]{{1,4}})?$')"


def pct(part: str, whole: str) -> str:
    return f"CAST(round({part} * 100.0 / {whole}, 1) AS DOUBLE)"


# --- HL7: what each order's message must parse to. ---

HL7 = f"""
WITH base AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         o_orderkey % 97 = 0 AS broken,
         {pick(inputs.FACILITIES, 'o_custkey')} AS fac,
         {case('o_orderstatus', inputs.EVENT_OF_STATUS)} AS event,
         {pick(inputs.DIAGNOSES, 'o_orderkey')} AS dx,
         o_orderkey % 23 <> 0 AS has_pid,
         o_orderkey % 17 <> 0 AS has_dx,
         o_orderkey % 17 <> 0 AND o_orderkey % 7 = 0 AS has_second,
         CASE WHEN o_orderkey % 5 = 0 THEN 'WARD_' || (o_orderkey % 3) ELSE '' END AS ward,
         strftime(o_orderdate, '%Y%m%d%H%M%S') AS stamp,
         strftime(o_orderdate, '%Y%m%d') AS day
  FROM orders
), parsed AS (
  SELECT o_orderkey,
         CASE WHEN broken OR NOT has_pid THEN '' ELSE 'PAT' || o_custkey || '^^^' || fac END
           AS patient_id,
         CASE WHEN broken THEN '' WHEN ward <> '' THEN ward ELSE fac END AS admit_location,
         CASE WHEN broken OR NOT has_dx THEN '' ELSE dx END AS admit_diagnosis,
         CASE WHEN broken THEN '' ELSE 'ADT^' || event END AS message_type,
         CASE WHEN broken THEN 'PARSE_ERROR: first segment is not MSH' ELSE fac END AS facility,
         CASE WHEN broken THEN '' ELSE stamp END AS message_time,
         CASE WHEN broken THEN '' ELSE 'MSG' || o_orderkey END AS message_id,
         broken AS is_parse_error
  FROM base
)
"""
PARSED = (
    "patient_id, admit_location, admit_diagnosis, message_type, facility, message_time, "
    "message_id, is_parse_error"
)
EVENT_CODE = "regexp_extract(message_type, 'A[0-9]+')"
HAS_DX = "admit_diagnosis IS NOT NULL AND admit_diagnosis <> ''"
NEWEST = (
    "ORDER BY message_time DESC, message_id DESC, patient_id, facility, message_type, "
    "admit_diagnosis, admit_location LIMIT 20"
)


def hl7(sql: str) -> str:
    return HL7 + sql


ORACLES["hl7_parse_adt"] = hl7(f"SELECT o_orderkey, {PARSED} FROM parsed")
ORACLES["hl7_parse_errors"] = hl7(
    f"SELECT o_orderkey, {PARSED} FROM parsed WHERE is_parse_error"
)
ORACLES["hl7_field"] = hl7(r"""
SELECT o_orderkey,
       CASE WHEN broken THEN '' ELSE fac END AS sending_facility,
       CASE WHEN broken THEN '' ELSE stamp END AS event_time,
       CASE WHEN broken OR NOT has_pid THEN '' ELSE
         'F\F\' || o_custkey || '^G\T\' || o_orderkey END AS name,
       CASE WHEN broken THEN '' ELSE day END AS admitted,
       CASE WHEN broken OR NOT has_dx THEN '' ELSE '1' END AS diagnosis_number,
       '' AS absent
FROM base""")
ORACLES["hl7_segments"] = hl7("""
, listed AS (
  SELECT o_orderkey, 0 AS place, 'MSH' AS kind, 10 AS fields, fac AS third FROM base WHERE NOT broken
  UNION ALL SELECT o_orderkey, 1, 'EVN', 7, '' FROM base WHERE NOT broken
  UNION ALL SELECT o_orderkey, 2, 'PID', 5, 'PAT' || o_custkey || '^^^' || fac
            FROM base WHERE NOT broken AND has_pid
  UNION ALL SELECT o_orderkey, 3, 'PV1', 44, '' FROM base WHERE NOT broken
  UNION ALL SELECT o_orderkey, 4, 'DG1', 3, dx FROM base WHERE NOT broken AND has_dx
  UNION ALL SELECT o_orderkey, 5, 'DG1', 3, 'J96.01' FROM base WHERE NOT broken AND has_second
)
SELECT o_orderkey,
       CAST(place - CASE WHEN o_orderkey % 23 = 0 AND place > 2 THEN 1 ELSE 0 END AS INTEGER)
         AS segment_index,
       kind AS segment_type, CAST(fields AS INTEGER) AS field_count, third AS third_field
FROM listed""")
ORACLES["hl7_components"] = hl7("""
SELECT o_orderkey,
       CAST(CASE WHEN broken OR NOT has_pid THEN 1 ELSE 4 END AS INTEGER) AS patient_parts,
       CASE WHEN broken OR NOT has_pid THEN '' ELSE 'PAT' || o_custkey END AS id_number,
       CASE WHEN broken OR NOT has_pid THEN NULL ELSE fac END AS assigned_by,
       CASE WHEN broken THEN NULL ELSE event END AS trigger_event
FROM base""")
ORACLES["hl7_event_code"] = hl7(
    "SELECT o_orderkey, CASE WHEN broken THEN '' ELSE event END AS event_code FROM base"
)
ORACLES["hl7_build_adt"] = hl7(r"""
SELECT o_orderkey,
       CASE WHEN broken THEN 'garbage' || o_orderkey ELSE
         'MSH|^~\&|' || fac || '|' || fac || '|||' || stamp || '||ADT^' || event
         || '|MSG' || o_orderkey || e
         || 'EVN||' || stamp || '|||||' || ward || e
         || CASE WHEN has_pid THEN 'PID|||PAT' || o_custkey || '^^^' || fac
              || '||F\F\' || o_custkey || '^G\T\' || o_orderkey || e ELSE '' END
         || 'PV1' || repeat('|', 44) || day || e
         || CASE WHEN has_dx THEN 'DG1|1||' || dx || e ELSE '' END
         || CASE WHEN has_second THEN 'DG1|2||J96.01' || e ELSE '' END
       END AS message
FROM (SELECT *, CASE WHEN o_orderkey % 2 = 1 THEN ';' ELSE '/' END AS e FROM base)""")

ORACLES["hl7_file_scan"] = hl7(r"""
SELECT message_id, CASE WHEN is_parse_error THEN 'garbage' ELSE 'MSH|^~\' END AS start_of_text
FROM parsed""")
ORACLES["stream_hl7_source"] = ORACLES["hl7_file_scan"]
ORACLES["provenance_columns"] = hl7(
    "SELECT message_id, TRUE AS from_landing_folder, TRUE AS has_time FROM parsed"
)
ORACLES["stream_hl7_parse"] = hl7(f"SELECT {PARSED} FROM parsed")
ORACLES["stream_hl7_append"] = hl7("""
SELECT facility, message_type, admit_diagnosis, count(*) AS messages
FROM parsed GROUP BY ALL""")
ORACLES["optional_facility_filter"] = hl7(f"""
SELECT 'one' AS scope, facility, patient_id, message_id FROM parsed
WHERE facility = {text(FACILITY)}
UNION ALL SELECT 'all', facility, patient_id, message_id FROM parsed""")
ORACLES["preview"] = hl7("""
SELECT message_id, patient_id, admit_location, admit_diagnosis, message_type, facility
FROM parsed ORDER BY message_id LIMIT 10""")
ORACLES["hl7_file_scan_plain"] = hl7("SELECT message_id FROM parsed WHERE NOT is_parse_error")
ORACLES["fhir_parse_errors"] = """
SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN 'not JSON' ELSE 'not a Bundle' END AS cause,
       CASE c_custkey % 10 WHEN 0 THEN '{"resourceType":"Bundle","entr' ELSE '{}' END AS start_of_text
FROM customer WHERE c_custkey % 10 < 2"""
ORACLES["tolerant_count"] = """
SELECT 'parsed_hl7' AS table_name, count(*) AS rows FROM orders
UNION ALL SELECT 'no_such_table', 0"""

ORACLES["q_kpi_hl7"] = hl7("""
SELECT count(*) AS hl7_messages_parsed, count(DISTINCT facility) AS facilities FROM parsed""")
ORACLES["q_hl7_enriched"] = hl7(f"""
SELECT patient_id, facility, admit_diagnosis,
       {described('icd10', 'admit_diagnosis')} AS diagnosis_description, message_type,
       {described('adt', EVENT_CODE)} AS event_description
FROM parsed""")
ORACLES["q_top_diagnoses_by_facility"] = hl7(f"""
SELECT admit_diagnosis, facility, count(*) AS admission_count FROM parsed WHERE {HAS_DX}
GROUP BY ALL ORDER BY admission_count DESC, admit_diagnosis, facility LIMIT 20""")
ORACLES["q_admissions_by_facility"] = hl7("""
SELECT facility, count(*) AS admissions FROM parsed WHERE message_type LIKE '%A01%'
GROUP BY facility""")
ORACLES["q_messages_by_facility"] = hl7(
    "SELECT facility, count(*) AS admissions FROM parsed GROUP BY facility"
)
ORACLES["q_top_admit_diagnoses"] = hl7(f"""
SELECT admit_diagnosis, count(*) AS frequency FROM parsed WHERE {HAS_DX}
GROUP BY ALL ORDER BY frequency DESC, admit_diagnosis LIMIT 10""")
ORACLES["q_top_admit_diagnoses_described"] = hl7(f"""
SELECT admit_diagnosis AS code, {described('icd10', 'admit_diagnosis')} AS diagnosis, frequency
FROM (SELECT admit_diagnosis, count(*) AS frequency FROM parsed
      WHERE {HAS_DX} AND facility = {text(FACILITY)}
      GROUP BY ALL ORDER BY frequency DESC, admit_diagnosis LIMIT 10)""")
ORACLES["q_diagnosis_by_facility"] = hl7(f"""
SELECT facility, admit_diagnosis, count(*) AS admissions FROM parsed WHERE {HAS_DX}
GROUP BY ALL""")
ORACLES["q_recent_messages"] = hl7(f"""
SELECT patient_id, facility, message_type, admit_diagnosis, admit_location, message_time,
       message_id
FROM parsed {NEWEST}""")
ORACLES["q_recent_messages_described"] = hl7(f"""
SELECT patient_id, facility, message_type, admit_diagnosis,
       {described('icd10', 'admit_diagnosis')} AS diagnosis_name,
       {described('adt', EVENT_CODE)} AS event_description, message_time, message_id
FROM (SELECT * FROM parsed WHERE facility = {text(FACILITY)} {NEWEST})""")
ORACLES["q_facility_list"] = hl7("SELECT DISTINCT facility FROM parsed")
ORACLES["q_facility_messages"] = hl7(
    f"SELECT {PARSED} FROM parsed WHERE facility = {text(FACILITY)}"
)
ORACLES["dq_hl7_completeness"] = hl7(f"""
SELECT count(*) AS total_messages,
       count(*) FILTER (patient_id = '') AS missing_patient_id,
       count(*) FILTER (admit_diagnosis = '') AS missing_diagnosis,
       count(*) FILTER (facility = '') AS missing_facility,
       {pct("count(*) FILTER (patient_id <> '')", "count(*)")} AS patient_id_completeness_pct
FROM parsed""")

# --- FHIR ---

FHIR = f"""
WITH person AS (
  SELECT 'p' || c_custkey AS person_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender_source_value,
         DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) AS born
  FROM customer
), condition_occurrence AS (
  SELECT 'c' || o_orderkey AS condition_occurrence_id, 'p' || o_custkey AS person_id,
         'e' || o_orderkey AS visit_occurrence_id,
         {pick(inputs.CONDITIONS, 'o_orderkey')} AS condition_source_value,
         CAST(o_orderdate AS DATE) AS condition_start_date
  FROM orders
), procedure_occurrence AS (
  SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey AS procedure_occurrence_id,
         'p' || o_custkey AS person_id, 'e' || o_orderkey AS visit_occurrence_id,
         CASE WHEN l_partkey % 2 = 0 THEN '{inputs.PROCEDURE_EVEN}'
              ELSE '{inputs.PROCEDURE_ODD}' END AS procedure_source_value,
         CAST(l_shipdate AS DATE) AS procedure_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), visit_occurrence AS (
  SELECT 'e' || o_orderkey AS visit_occurrence_id, 'p' || o_custkey AS person_id,
         {case('o_orderstatus', inputs.CLASS_OF_STATUS)} AS visit_source_value,
         CAST(o_orderdate AS TIMESTAMP) AS visit_start_datetime,
         CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 9 AS INTEGER))
           AS visit_end_datetime
  FROM orders
), features AS (
  SELECT person_id,
         max(CASE WHEN condition_source_value IN {members(v.DIABETES_CODES)} THEN 1 ELSE 0 END)
           AS diabetes_ind,
         max(CASE WHEN condition_source_value IN {members(v.HYPERTENSION_CODES)}
             THEN 1 ELSE 0 END) AS hypertension_ind,
         max(CASE WHEN condition_source_value IN {members(v.SUBSTANCE_USE_CODES)}
             THEN 1 ELSE 0 END) AS substance_use_ind
  FROM condition_occurrence
  WHERE condition_source_value IN
    {members(v.DIABETES_CODES + v.HYPERTENSION_CODES + v.SUBSTANCE_USE_CODES)}
  GROUP BY person_id
)
"""
FLAG_SUM = "diabetes_ind + hypertension_ind + substance_use_ind"


def fhir(sql: str) -> str:
    return FHIR + sql


ORACLES["fhir_bundle_scan"] = """
SELECT 'p' || c_custkey AS first_id, CAST(1 AS INTEGER) AS entries FROM customer
UNION ALL SELECT 'p' || o_custkey, 3 FROM orders
UNION ALL SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey, 1 FROM lineitem"""
ORACLES["fhir_entries"] = fhir("""
SELECT 'Patient' AS resource_type, person_id AS id FROM person
UNION ALL SELECT 'Patient', person_id FROM condition_occurrence
UNION ALL SELECT 'Condition', condition_occurrence_id FROM condition_occurrence
UNION ALL SELECT 'Encounter', visit_occurrence_id FROM visit_occurrence
UNION ALL SELECT 'Procedure', procedure_occurrence_id FROM procedure_occurrence""")
ORACLES["fhir_to_person"] = fhir("""
SELECT person_id, gender_source_value, CAST(year(born) AS INTEGER) AS year_of_birth,
       CAST(month(born) AS INTEGER) AS month_of_birth, CAST(day(born) AS INTEGER) AS day_of_birth,
       born AS birth_datetime
FROM person""")
for name in ("condition_occurrence", "procedure_occurrence", "visit_occurrence"):
    ORACLES[f"fhir_to_{name}"] = fhir(f"SELECT * FROM {name}")
ORACLES["condition_features"] = fhir("SELECT * FROM features")
ORACLES["landing_file_inventory"] = """
SELECT CAST(sum(
  length('{"resourceType":"Bundle","type":"collection","entry":[{"resource":')
  + length('{"resourceType":"Patient","id":"p","gender":"","birthDate":"1940-01-01"}}]}')
  + length(CAST(c_custkey AS VARCHAR)) + CASE WHEN c_custkey % 2 = 0 THEN 4 ELSE 6 END + 1
) AS BIGINT) AS bytes, TRUE AS has_files, TRUE AS listing_complete FROM customer"""

ORACLES["q_kpi_omop_patients"] = "SELECT count(*) AS omop_patients FROM customer"
ORACLES["q_omop_row_counts"] = fhir(" UNION ALL ".join(
    f"SELECT '{name}' AS omop_table, count(*) AS rows FROM {name}"
    for name in ("condition_occurrence", "person", "procedure_occurrence", "visit_occurrence")
))
ORACLES["q_condition_prevalence"] = fhir("""
SELECT 'Diabetes' AS condition, CAST(sum(diabetes_ind) AS BIGINT) AS patients FROM features
UNION ALL SELECT 'Hypertension', CAST(sum(hypertension_ind) AS BIGINT) FROM features
UNION ALL SELECT 'Substance Use', CAST(sum(substance_use_ind) AS BIGINT) FROM features""")
ORACLES["q_prevalence_summary"] = fhir("""
SELECT CAST(sum(diabetes_ind) AS BIGINT) AS diabetic_patients,
       CAST(sum(hypertension_ind) AS BIGINT) AS hypertensive_patients,
       CAST(sum(substance_use_ind) AS BIGINT) AS substance_use_patients,
       count(*) AS total_patients_with_flags
FROM features""")
ORACLES["q_comorbidity_distribution"] = fhir(f"""
SELECT CASE {FLAG_SUM} WHEN 0 THEN 'No tracked conditions' WHEN 1 THEN '1 condition'
            WHEN 2 THEN '2 conditions' ELSE '3 conditions' END AS comorbidity_level,
       count(*) AS patients
FROM features GROUP BY 1""")
ORACLES["q_conditions_enriched"] = fhir(f"""
SELECT person_id, condition_source_value AS code,
       {described('snomed', 'condition_source_value')} AS description,
       {snomed_valid('condition_source_value')} AS valid_snomed
FROM condition_occurrence ORDER BY person_id, code LIMIT 50""")
ORACLES["q_condition_codes_described"] = fhir(f"""
SELECT condition_source_value AS code,
       {described('snomed', 'condition_source_value')} AS description, count(*) AS occurrences
FROM condition_occurrence GROUP BY 1, 2""")
BOTH = "count(*) FILTER (diabetes_ind = 1 AND hypertension_ind = 1)"
ORACLES["q_comorbid_pct"] = fhir(f"""
SELECT count(*) AS total_patients, {BOTH} AS both_conditions,
       {pct(BOTH, 'count(*)')} AS both_pct
FROM features""")
ORACLES["q_diabetes_count"] = fhir(
    "SELECT count(*) FILTER (diabetes_ind = 1) AS diabetic_patients FROM features"
)
ORACLES["q_risk_tier_counts"] = fhir(f"""
SELECT CASE {FLAG_SUM} WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'moderate'
            ELSE 'high' END AS risk_tier, count(*) AS patients
FROM features GROUP BY 1""")
VALID = f"count(*) FILTER ({snomed_valid('condition_source_value')})"
ORACLES["dq_snomed_validity"] = fhir(f"""
SELECT count(*) AS total_conditions, {VALID} AS valid_snomed_codes,
       {pct(VALID, 'count(*)')} AS snomed_valid_pct
FROM condition_occurrence""")

# --- C-CDA ---

CCDA = """
WITH patient AS (
  SELECT c_custkey, 'p' || c_custkey AS patient,
         CASE WHEN c_custkey % 41 <> 0 THEN n_name END AS city,
         'G' || (c_custkey % 50) AS first_name,
         CAST(CASE WHEN c_custkey % 6 = 0 THEN 2 ELSE 1 END AS INTEGER) AS given_names,
         'F' || (c_custkey % 200) AS last_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), line AS (
  SELECT patient.*, c_custkey % 13 <> 0 AS medicated, l_partkey,
         CASE WHEN l_partkey % 29 <> 0 THEN p_type || ' ' || p_name END AS medication_name
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN patient ON o_custkey = c_custkey
), medications AS (
  SELECT DISTINCT city, first_name, last_name, medication_name FROM line WHERE medicated
), documents AS (
  SELECT c_custkey, patient, city, first_name, given_names, last_name,
         CAST(1 AS INTEGER) AS sections FROM patient
  UNION ALL
  SELECT c_custkey, patient, city, first_name, given_names, last_name,
         CASE WHEN medicated THEN 2 ELSE 1 END FROM line
)
"""


def ccda(sql: str) -> str:
    return CCDA + sql


ORACLES["xml_scan"] = ccda(
    "SELECT patient, city, first_name, given_names, last_name, sections FROM documents"
)
ORACLES["xml_scan_plain"] = ORACLES["xml_scan"]
ORACLES["fhir_bundle_scan_plain"] = ORACLES["fhir_bundle_scan"]
ORACLES["ccda_documents"] = ccda("SELECT * FROM documents")
ORACLES["ccda_sections"] = ccda("""
SELECT c_custkey, 'Allergies' AS title, CAST(1 AS INTEGER) AS entries FROM documents
UNION ALL
SELECT c_custkey, 'Medications', CASE WHEN l_partkey % 2 = 0 THEN 2 ELSE 1 END
FROM line WHERE medicated""")
ORACLES["ccda_medications"] = ccda("SELECT * FROM medications")
ORACLES["q_kpi_ccda_documents"] = """
SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM lineitem) AS ccda_documents_loaded"""
ORACLES["q_kpi_medications"] = ccda("""
SELECT count(*) AS medications_extracted,
       count(DISTINCT medication_name) AS distinct_medications
FROM medications""")
ORACLES["q_top_medications"] = ccda("""
SELECT medication_name, count(*) AS patient_count FROM medications
WHERE medication_name IS NOT NULL
GROUP BY 1 ORDER BY patient_count DESC, medication_name LIMIT 15""")
ORACLES["q_medication_frequency"] = ccda("""
SELECT medication_name, count(*) AS patient_count FROM medications
GROUP BY 1 ORDER BY patient_count DESC, medication_name NULLS FIRST LIMIT 20""")
ORACLES["q_medications_by_city"] = ccda("""
SELECT city, count(*) AS prescription_count FROM medications WHERE city IS NOT NULL
GROUP BY 1 ORDER BY prescription_count DESC, city LIMIT 10""")
ORACLES["q_medication_records"] = ccda("""
SELECT * FROM medications
ORDER BY city NULLS FIRST, first_name NULLS FIRST, last_name NULLS FIRST,
         medication_name NULLS FIRST LIMIT 50""")
ORACLES["dq_ccda_completeness"] = ccda("""
SELECT count(*) AS total_records,
       count(*) FILTER (medication_name IS NULL) AS null_medication_name,
       count(*) FILTER (city IS NULL) AS null_city,
       count(*) FILTER (first_name IS NULL) AS null_first_name
FROM medications""")

# --- Across schemas ---

COUNTS = f"""
, fhir_person AS (SELECT count(*) AS n FROM customer),
per_order AS (SELECT count(*) AS n FROM orders),
per_line AS (SELECT count(*) AS n FROM lineitem),
medicated AS (SELECT count(*) AS n FROM medications),
flagged AS (
  SELECT count(DISTINCT o_custkey) AS n FROM orders
  WHERE {pick(inputs.CONDITIONS, 'o_orderkey')} IN
    {members(v.DIABETES_CODES + v.HYPERTENSION_CODES + v.SUBSTANCE_USE_CODES)}
),
inventory AS (
  SELECT 'ccda' AS schema_name, 'ccda_claims_raw' AS table_name,
         fhir_person.n + per_line.n AS rows FROM fhir_person, per_line
  UNION ALL SELECT 'ccda', 'medications', n FROM medicated
  UNION ALL SELECT 'fhir', 'condition_features', n FROM flagged
  UNION ALL SELECT 'fhir', 'condition_occurrence', n FROM per_order
  UNION ALL SELECT 'fhir', 'person', n FROM fhir_person
  UNION ALL SELECT 'fhir', 'procedure_occurrence', n FROM per_line
  UNION ALL SELECT 'fhir', 'visit_occurrence', n FROM per_order
  UNION ALL SELECT 'hl7', 'parsed_hl7', n FROM per_order
)
"""
ORACLES["q_table_inventory"] = ccda(COUNTS + "SELECT * FROM inventory")
ORACLES["q_records_per_schema"] = ccda(COUNTS + """
SELECT schema_name, CAST(sum(rows) AS BIGINT) AS records FROM inventory GROUP BY 1
UNION ALL SELECT 'audit', 3""")

# --- Databases and tables ---

ORACLES["jdbc_scan"] = "SELECT * FROM supplier"
ORACLES["jdbc_partitioned_scan"] = "SELECT * FROM orders"
ORACLES["jdbc_transfer_audited"] = """
SELECT 'audited' AS what, count(*) AS rows FROM orders
UNION ALL SELECT 'in target', count(*) FROM orders"""
LOG = """
SELECT 'provider' AS source_table, 0 AS row_count, FALSE AS configured
UNION ALL SELECT 'supplier', count(*), TRUE FROM supplier
UNION ALL SELECT 'orders', count(*), TRUE FROM orders"""
ORACLES["audit_append"] = (
    f"SELECT source_table, CAST(row_count AS BIGINT) AS row_count, configured FROM ({LOG})"
)
ORACLES["q_audit_recent"] = (
    f"SELECT CAST(row_count AS BIGINT) AS row_count, source_table FROM ({LOG})"
)
ORACLES["q_last_ingest"] = "SELECT 'orders' AS source_table, count(*) AS row_count FROM orders"
ORACLES["incremental_upsert"] = """
WITH early AS (SELECT * FROM orders WHERE year(o_orderdate) < 1999),
mark AS (SELECT max(o_orderdate) AS high FROM early),
changed AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1000 ELSE o_totalprice END
           AS o_totalprice,
         CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 7 YEAR ELSE o_orderdate END
           AS o_orderdate,
         o_orderpriority
  FROM orders
),
newer AS (SELECT * FROM changed WHERE o_orderdate >= (SELECT high FROM mark))
SELECT * FROM newer
UNION ALL SELECT * FROM early WHERE o_orderkey NOT IN (SELECT o_orderkey FROM newer)"""
ORACLES["table_overwrite_sink"] = "SELECT * FROM part"
ORACLES["ctas_replace"] = (
    "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment"
)
ORACLES["mask_jdbc_url"] = """
SELECT c_custkey,
       'jdbc:postgresql://host' || (c_custkey % 7) || ':5432/clinic?user=***&password=***&pad=***'
         AS masked
FROM customer"""

# --- Scalar functions ---


def codes(values: list[str], columns: str) -> str:
    return f"""
WITH coded AS (
  SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderkey % 37 <> 0 THEN {pick(values, 'o_orderkey')} END AS code
  FROM orders
)
SELECT o_orderkey, code, {columns} FROM coded"""


SYSTEM = f"""CASE WHEN code IS NULL THEN NULL WHEN {snomed_valid('code')} THEN 'snomed'
  WHEN code IN {members(list(v.TERMINOLOGY["adt"]))} THEN 'adt'
  WHEN {icd10_valid('code')} THEN 'icd10' ELSE 'unknown' END"""
ORACLES["snomed_description"] = codes(
    inputs.CONDITIONS, f"{described('snomed', 'code')} AS description"
)
ORACLES["icd10_description"] = codes(
    inputs.DIAGNOSES, f"{described('icd10', 'code')} AS description"
)
ORACLES["adt_event_description"] = codes(
    inputs.EVENT_CODES, f"{described('adt', 'code')} AS description"
)
ORACLES["hedis_measure_name"] = codes(
    inputs.MEASURES, f"{described('hedis', 'code')} AS description"
)
ORACLES["is_valid_snomed"] = codes(inputs.MIXED_CODES, f"{snomed_valid('code')} AS valid")
ORACLES["is_valid_icd10"] = codes(inputs.MIXED_CODES, f"{icd10_valid('code')} AS valid")
ORACLES["code_system"] = codes(inputs.MIXED_CODES, f"{SYSTEM} AS system")
ORACLES["validate_codes"] = codes(inputs.MIXED_CODES, f"""
  {snomed_valid('code')} AS valid_snomed, {icd10_valid('code')} AS valid_icd10,
  CASE WHEN code IS NULL OR trim(code) = '' THEN ''
       WHEN {snomed_valid('code')} THEN 'Valid SNOMED'
       WHEN {icd10_valid('code')} THEN 'Valid ICD-10-CM'
       ELSE 'Not a recognized SNOMED or ICD-10 format' END AS verdict""")
ENRICHED = f"""
  CASE {SYSTEM} WHEN 'snomed' THEN {described('snomed', 'code')}
       WHEN 'adt' THEN {described('adt', 'code')}
       WHEN 'icd10' THEN {described('icd10', 'code')} ELSE code END AS description,
  {SYSTEM} AS code_system"""
ORACLES["terminology_enrich"] = (
    f"SELECT * FROM ({codes(inputs.MIXED_CODES, ENRICHED)}) UNION ALL SELECT * FROM ("
    + codes(inputs.MEASURES, f"{described('hedis', 'code')} AS description, 'hedis' AS code_system")
    + ")"
)
ORACLES["age_from_dob"] = f"""
SELECT c_custkey, birth_date,
       CAST(floor(date_diff('day', birth_date, DATE '{inputs.AS_OF}') / 365.25) AS INTEGER) AS age,
       CAST(year(DATE '{inputs.AS_OF}') - year(birth_date)
            - CASE WHEN strftime(DATE '{inputs.AS_OF}', '%m%d') < strftime(birth_date, '%m%d')
                   THEN 1 ELSE 0 END AS INTEGER) AS exact_age
FROM (SELECT c_custkey,
             DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) AS birth_date
      FROM customer)"""


def tier(count: str) -> str:
    return (
        f"CASE WHEN {count} >= 3 THEN 'high' WHEN {count} = 2 THEN 'moderate' "
        f"WHEN {count} = 1 THEN 'low' ELSE 'none' END"
    )


def bucket(days: str) -> str:
    return (
        f"CASE WHEN {days} IS NULL THEN 'unknown' WHEN {days} <= 90 THEN '0-90 days (active)' "
        f"WHEN {days} <= 180 THEN '91-180 days (at risk)' "
        f"WHEN {days} <= 365 THEN '181-365 days (overdue)' ELSE '365+ days (lost to care)' END"
    )


ORACLES["chronic_risk_tier"] = f"""
SELECT o_orderkey, conditions, {tier('conditions')} AS tier
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 6 - 1 AS INTEGER) END
               AS conditions
      FROM orders)"""
ORACLES["days_overdue_bucket"] = f"""
SELECT o_orderkey, days, {bucket('days')} AS bucket
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 19 <> 0 THEN CAST(
               date_diff('day', CAST(o_orderdate AS DATE), DATE '{inputs.AS_OF}') AS INTEGER)
             END AS days
      FROM orders)"""
ORACLES["register_functions"] = f"""
WITH coded AS (
  SELECT o_orderkey, {pick(inputs.CONDITIONS, 'o_orderkey')} AS snomed,
         {pick(inputs.DIAGNOSES, 'o_orderkey')} AS icd10,
         {pick(inputs.EVENT_CODES, 'o_orderkey')} AS event,
         {pick(inputs.MEASURES, 'o_orderkey')} AS measure,
         date_diff('day', CAST(o_orderdate AS DATE), DATE '{inputs.AS_OF}') AS days
  FROM orders
)
SELECT o_orderkey, {described('snomed', 'snomed')} AS snomed_text,
       {described('icd10', 'icd10')} AS icd10_text, {described('adt', 'event')} AS event_text,
       {described('hedis', 'measure')} AS measure_text,
       CAST(floor(days / 365.25) AS INTEGER) AS age, {tier('o_orderkey % 5')} AS tier,
       {bucket('days')} AS bucket, {snomed_valid('snomed')} AS snomed_ok,
       {icd10_valid('icd10')} AS icd10_ok
FROM coded"""
ORACLES["hl7_segment_groups"] = """
WITH sized AS (
  SELECT o_orderkey, o_custkey, g, (o_orderkey + g) % 3 + 1 AS results, g % 2 = 0 AS noted
  FROM (SELECT o_orderkey, o_custkey, unnest(range(1, o_orderkey % 4 + 2)) AS g FROM orders)
), placed AS (
  SELECT *, 2 + coalesce(sum(2 + results + CASE WHEN noted THEN 1 ELSE 0 END) OVER (
    PARTITION BY o_orderkey ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_place
  FROM sized
), listed AS (
  SELECT o_orderkey, 0 AS place, NULL AS parent, 'MSH' AS kind, '|' AS first_field FROM orders
  UNION ALL SELECT o_orderkey, 1, NULL, 'PID', '1' FROM orders
  UNION ALL SELECT o_orderkey, start_place, 1, 'ORC', CAST(g AS VARCHAR) FROM placed
  UNION ALL SELECT o_orderkey, start_place + 1, start_place, 'OBR', CAST(g AS VARCHAR) FROM placed
  UNION ALL SELECT o_orderkey, start_place + 1 + j, start_place + 1, 'OBX', CAST(j AS VARCHAR)
            FROM (SELECT *, unnest(range(1, results + 1)) AS j FROM placed)
  UNION ALL SELECT o_orderkey, start_place + 2 + results, start_place + 1 + results, 'NTE', '1' FROM placed WHERE noted
)
SELECT o_orderkey, CAST(place AS INTEGER) AS segment_index, CAST(parent AS INTEGER) AS parent_index,
       kind AS segment_type, first_field
FROM listed"""
ORACLES["fhir_resources"] = fhir("""
SELECT 'Patient' AS resource_type, person_id AS id, NULL AS account FROM person
UNION ALL SELECT 'Patient', person_id, NULL FROM condition_occurrence
UNION ALL SELECT 'Condition', condition_occurrence_id, NULL FROM condition_occurrence
UNION ALL SELECT 'Encounter', visit_occurrence_id, 'V-' || visit_occurrence_id FROM visit_occurrence
UNION ALL SELECT 'Procedure', procedure_occurrence_id, NULL FROM procedure_occurrence""")
ORACLES["load_omop_whole"] = ORACLES["fhir_to_condition_occurrence"]
ORACLES["stream_hl7_ledgered"] = hl7("""
SELECT CASE WHEN is_parse_error THEN 'errors' ELSE 'rows' END AS part, facility, count(*) AS messages
FROM parsed GROUP BY ALL
UNION ALL SELECT 'ledger', '', count(*) FROM parsed""")
ORACLES["landing_changes"] = """
WITH nations AS (
  SELECT CAST(c_nationkey AS INTEGER) AS nation, count(*) AS bundles FROM customer GROUP BY 1)
SELECT 1 AS landing, 'new' AS change, nation, bundles FROM nations WHERE nation < 20
UNION ALL SELECT 2, 'vanished', nation, 0 FROM nations WHERE nation < 20 AND nation % 4 = 1
UNION ALL SELECT 2, 'changed', nation, 2 * bundles FROM nations WHERE nation < 20 AND nation % 4 = 0
UNION ALL SELECT 2, 'new', nation, bundles FROM nations WHERE nation >= 20
UNION ALL SELECT 3, 'new', nation, bundles FROM nations WHERE nation < 20 AND nation % 4 = 1"""

ORACLES["q_kpi_medications_loaded"] = ORACLES["q_kpi_medications"]
ORACLES["q_kpi_hl7_loaded"] = ORACLES["q_kpi_hl7"]
ORACLES["distinct_patients_by_facility"] = hl7("""
SELECT facility, count(*) AS messages, count(DISTINCT patient_id) AS patients FROM parsed
GROUP BY facility""")
