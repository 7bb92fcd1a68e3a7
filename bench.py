"""Headline queries, timed. Prints one JSON line.

Each query runs WARM_UPS times unseen and then REPEATS times into a sink that takes every row and
column; its value is the median. The clinical inputs are written once before, as raw text, so
that the parse jobs are measured from files, as they run in practice.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import tables  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from wardflow.operators import ccda, fhir, hl7  # noqa: E402
from wardflow.session import local_session  # noqa: E402
from wardflow.sources import files  # noqa: E402

WARM_UPS, REPEATS = 2, 3
OVER_TABLES = [
    "q_kpi_hl7", "q_top_admit_diagnoses_described", "q_diagnosis_by_facility", "q_hl7_enriched",
    "q_recent_messages", "dq_hl7_completeness", "q_top_medications", "q_medications_by_city",
    "q_condition_codes_described", "q_comorbidity_distribution", "q_table_inventory",
    "terminology_enrich", "register_functions", "incremental_upsert", "xml_scan_plain",
    "hl7_file_scan_plain",
]
FIELDS = {"sending_facility": ("MSH", 4), "event_time": ("EVN", 2), "name": ("PID", 5),
          "admitted": ("PV1", 44), "diagnosis": ("DG1", 3), "absent": ("PV1", 60)}


def from_files(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    messages_path = tables.landed_messages(spark, sf_dir)
    bundles_path = tables.landed_bundles(spark, sf_dir)

    def messages() -> DataFrame:
        return files.hl7_file_scan(spark, messages_path, framed=True)

    def entries(kind: str) -> DataFrame:
        bundles = files.fhir_bundle_scan(spark, bundles_path, one_per_line=True)
        return fhir.fhir_entries(bundles, kinds=[kind])

    def conditions() -> DataFrame:
        return fhir.fhir_to_condition_occurrence(entries("Condition"))

    return {
        "hl7_parse_adt": lambda: hl7.hl7_parse_adt(messages()),
        "hl7_field": lambda: messages().select(
            *[hl7.hl7_field(F.col("value"), *place).alias(name) for name, place in FIELDS.items()]),
        "hl7_parse_adt_extra": lambda: hl7.hl7_parse_adt(messages(), extra=FIELDS),
        "hl7_segments": lambda: hl7.hl7_segments(messages()),
        "fhir_to_person": lambda: fhir.fhir_to_person(entries("Patient")),
        "fhir_to_condition_occurrence": conditions,
        "fhir_to_procedure_occurrence": lambda: fhir.fhir_to_procedure_occurrence(
            entries("Procedure")),
        "condition_features": lambda: fhir.condition_features(conditions()),
        "ccda_medications": lambda: ccda.ccda_medications(
            tables.scanned_documents(spark, sf_dir, ccda.MEDICATION_SCHEMA)),
    }


def seconds(build: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    timed = from_files(spark, sf_dir)
    for name in OVER_TABLES:
        timed[name] = lambda name=name: QUERIES[name](spark, sf_dir)
    results = {}
    for name, build in timed.items():
        for _ in range(WARM_UPS):
            seconds(build)
        results[name] = round(statistics.median(seconds(build) for _ in range(REPEATS)), 4)
    print(json.dumps({
        "metric": "sum of the median seconds of the headline queries",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "spark": spark.version,
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
