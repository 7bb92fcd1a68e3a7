"""One customer with half of the orders, one order and one part with half of the lines: the
results still equal the oracles, and hot groups reach the shuffle as a few partial rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import inputs, tables
from checks.compare import difference
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL
from wardflow.operators import fhir

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
NAMES = [
    "hl7_parse_adt", "q_messages_by_facility", "q_top_admit_diagnoses_described",
    "q_facility_messages", "dq_hl7_completeness", "fhir_to_person",
    "fhir_to_condition_occurrence", "fhir_to_procedure_occurrence", "condition_features",
    "q_condition_prevalence", "q_comorbidity_distribution", "ccda_documents",
    "ccda_medications", "q_top_medications", "q_medications_by_city", "q_table_inventory",
    "incremental_upsert", "jdbc_partitioned_scan",
]


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))

    def heated(df, column, key):
        return df.withColumn(
            column, F.when(F.xxhash64(*df.columns) % 2 == 0, F.lit(key).cast("bigint"))
            .otherwise(F.col(column)))

    for name in TABLES:
        df = inputs.table(spark, SMALL, name)
        if name == "orders":
            df = heated(df, "o_custkey", 7)
        if name == "lineitem":
            df = heated(heated(df, "l_orderkey", 5), "l_partkey", 3)
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def connection(hot):
    made = duckdb.connect()
    for name in TABLES:
        parts = f"{hot}/{name}.parquet/part-*.parquet"
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{parts}')")
    return made


def test_the_keys_are_hot(spark, hot):
    orders = inputs.table(spark, hot, "orders")
    assert orders.where("o_custkey = 7").count() > 0.4 * orders.count()


@pytest.mark.parametrize("name", NAMES)
def test_results_with_hot_keys(spark, hot, connection, name):
    assert difference(QUERIES[name](spark, hot), connection, ORACLES[name]) is None


def shuffled_rows(spark, df):
    """Rows written to shuffles while a query runs."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if "ShuffleExchange" in node.getClass().getSimpleName():
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        inner = node
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            inner = node.executedPlan()
            return walk(inner)
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        children = node.children()
        for place in range(children.size()):
            walk(children.apply(place))

    walk(text)
    return sum(found)


def test_hot_groups_are_small_before_the_shuffle(spark, hot):
    people = inputs.table(spark, hot, "customer").count()
    conditions = tables.omop(spark, hot)["condition_occurrence"]
    tasks = conditions.rdd.getNumPartitions()
    assert conditions.count() > 5 * people
    assert 0 < shuffled_rows(spark, fhir.condition_features(conditions)) <= people * tasks
    parsed = tables.parsed_hl7(spark, hot)
    counted = parsed.groupBy("facility").agg(F.count("*"))
    assert 0 < shuffled_rows(spark, counted) <= 5 * parsed.rdd.getNumPartitions()
