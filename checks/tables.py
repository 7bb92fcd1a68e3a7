"""The clinical tables behind the named queries, built once per session and data folder.

They are loaded the way the library is meant to be used: raw text, parse, managed table. Files
and tables go below the shared scratch folder, so they outlive the executors that wrote them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import inputs
from wardflow.operators import ccda, fhir
from wardflow.operators.hl7 import hl7_parse_adt
from wardflow.session import scratch_folder
from wardflow.sources import files, jdbc, tables
from wardflow.sources.distincts import DistinctStore

MESSAGE_FIELDS = {"message_time": ("MSH", 7), "message_id": ("MSH", 10)}
NEWEST = ["message_time", "message_id"]

# Fixed value: driver class of the database that runs inside the driver process.
DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def folder(spark: SparkSession, sf_dir: str) -> str:
    """Scratch folder of this session and data folder."""
    return _once(spark, sf_dir, "folder", lambda: scratch_folder(spark))


def new_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{folder(spark, sf_dir)}/{name}-{uuid.uuid4().hex}"


def database(spark: SparkSession, sf_dir: str, schema: str) -> str:
    """A database in the scratch folder that stands for one of the schemas."""

    def create() -> str:
        name = f"{schema}_{uuid.uuid4().hex[:12]}"
        place = f"{folder(spark, sf_dir)}/{name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{place}'")
        return name

    return _once(spark, sf_dir, f"database {schema}", create)


def new_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{database(spark, sf_dir, 'work')}.{name}_{uuid.uuid4().hex[:12]}"


def landed_messages(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all messages, framed, many per file."""

    def land() -> str:
        path = new_path(spark, sf_dir, "messages")
        files.write_framed_messages(inputs.adt_messages(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "messages", land)


def land_texts(texts: DataFrame, path: str) -> None:
    """Land the ``value`` column as lines of gzip files, a small part of the plain text.

    Such a file is read by one task; the inputs are dealt out so that each holds a bounded number.
    """
    texts.select("value").write.text(path, compression="gzip")


def landed_bundles(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all Bundles, one per line."""

    def land() -> str:
        path = new_path(spark, sf_dir, "bundles")
        land_texts(inputs.fhir_bundles(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "bundles", land)


def landed_documents(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all documents, one per line."""

    def land() -> str:
        path = new_path(spark, sf_dir, "documents")
        land_texts(inputs.ccda_documents(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "documents", land)


def scanned_documents(
    spark: SparkSession, sf_dir: str, schema: StructType = ccda.DOCUMENT_SCHEMA
) -> DataFrame:
    return files.xml_scan(
        spark, landed_documents(spark, sf_dir), ccda.ROW_TAG, schema, one_per_line=True
    )


def parsed_hl7(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load() -> str:
        name = f"{database(spark, sf_dir, 'hl7')}.parsed_hl7"
        scanned = files.hl7_file_scan(spark, landed_messages(spark, sf_dir), framed=True)
        traced = files.provenance_columns(scanned)
        parsed = hl7_parse_adt(traced, keep=["source_file", "parsed_at"], extra=MESSAGE_FIELDS)
        tables.table_overwrite_sink(parsed, name)
        return name

    return spark.table(_once(spark, sf_dir, "parsed_hl7", load))


def omop(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def load() -> str:
        name = database(spark, sf_dir, "fhir")
        landed = f"{landed_bundles(spark, sf_dir)}/*"
        fhir.load_omop(files.fhir_bundle_scan(spark, landed, one_per_line=True), name)
        return name

    name = _once(spark, sf_dir, "omop", load)
    return {table: spark.table(f"{name}.{table}") for table in fhir.TRANSFORMS}


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load() -> str:
        name = f"{database(spark, sf_dir, 'fhir')}.condition_features"
        conditions = omop(spark, sf_dir)["condition_occurrence"]
        tables.ctas_replace(spark, name, fhir.condition_features(conditions))
        return name

    return spark.table(_once(spark, sf_dir, "condition_features", load))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load() -> str:
        name = f"{database(spark, sf_dir, 'ccda')}.ccda_claims_raw"
        tables.table_overwrite_sink(scanned_documents(spark, sf_dir), name)
        return name

    return spark.table(_once(spark, sf_dir, "ccda_claims_raw", load))


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load() -> str:
        name = f"{database(spark, sf_dir, 'ccda')}.medications"
        tables.ctas_replace(spark, name, ccda.ccda_medications(documents(spark, sf_dir)))
        return name

    return spark.table(_once(spark, sf_dir, "medications", load))


def external_table(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """URL and driver of a database that holds the table ``name``.

    The database lives in the memory of the driver process, which is also the executor here. It
    opens no port, so only a local session can read it.
    """
    url = _once(
        spark, sf_dir, "derby", lambda: f"jdbc:derby:memory:clinic_{uuid.uuid4().hex}"
    )

    def fill() -> bool:
        rows = {
            "supplier": lambda: inputs.table(spark, sf_dir, "supplier"),
            "orders": lambda: _external_orders(spark, sf_dir),
            "orders_changed": lambda: _changed_orders(_external_orders(spark, sf_dir)),
        }[name]()
        texts = [c for c, kind in rows.dtypes if kind == "string"]
        (
            rows.write.format("jdbc")
            .option("url", f"{url};create=true")
            .option("driver", DERBY_DRIVER)
            .option("dbtable", name)
            .option("createTableColumnTypes", ", ".join(f"{c} VARCHAR(200)" for c in texts))
            .save()
        )
        return True

    _once(spark, sf_dir, f"derby {name}", fill)
    return url, DERBY_DRIVER


def _external_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def _changed_orders(orders: DataFrame) -> DataFrame:
    """Orders as the source holds them later: every tenth has a new price and a newer date."""
    changed = F.col("o_orderkey") % 10 == 0
    later = F.timestamp_add("YEAR", F.lit(7), F.col("o_orderdate"))
    return orders.withColumns({
        "o_totalprice": F.when(changed, F.col("o_totalprice") + 1000).otherwise(
            F.col("o_totalprice")
        ),
        "o_orderdate": F.when(changed, later).otherwise(F.col("o_orderdate")),
    })


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of a transfer without a source, one of ``supplier`` and one of ``orders``."""

    def load() -> str:
        log = f"{database(spark, sf_dir, 'audit')}.jdbc_ingests"
        target = new_table(spark, sf_dir, "nothing")
        jdbc.audit_append(
            jdbc.jdbc_transfer_audited(spark, "", DERBY_DRIVER, "provider", target), log
        )
        for source, key in (("supplier", "s_suppkey"), ("orders", "o_orderkey")):
            url, driver = external_table(spark, sf_dir, source)
            target = new_table(spark, sf_dir, source)
            jdbc.audit_append(
                jdbc.jdbc_transfer_audited(
                    spark, url, driver, source, target, partition_column=key), log
            )
        return log

    return spark.table(_once(spark, sf_dir, "jdbc_ingests", load))


def inventory(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], DataFrame]:
    """The eight clinical tables by schema and name."""
    listed = {
        ("ccda", "ccda_claims_raw"): documents(spark, sf_dir),
        ("ccda", "medications"): medications(spark, sf_dir),
    }
    for name, df in omop(spark, sf_dir).items():
        listed["fhir", name] = df
    listed["fhir", "condition_features"] = features(spark, sf_dir)
    listed["hl7", "parsed_hl7"] = parsed_hl7(spark, sf_dir)
    return listed


def land_by_nation(rows: DataFrame, folder: str, remove: bool = False) -> None:
    """One file per nation with its ``value`` rows, always of the same name; or take it away."""
    spark = rows.sparkSession
    staged = f"{folder}-{uuid.uuid4().hex}"
    rows.repartition("nation").write.partitionBy("nation").text(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(folder))
    for status in system.globStatus(hadoop.Path(f"{staged}/nation=*/part-*")):
        source = status.getPath()
        target = hadoop.Path(folder, f"{source.getParent().getName().replace('=', '-')}.txt")
        system.delete(target, False)
        if not remove:
            system.rename(source, target)


def nation_of(path: Column) -> Column:
    return F.regexp_extract(path, r"nation-([0-9]+)[.]txt$", 1).cast("int")


def counted_loads(
    spark: SparkSession, sf_dir: str, rows: DataFrame, by_load: Column, column: str,
    by: list[str] | None = None,
) -> DistinctStore:
    """A store that counts a column of all ``rows``, which come in three loads, the first one twice."""
    groups = rows.select(*by) if by else None
    store = DistinctStore(spark, new_path(spark, sf_dir, "distincts"), [column], groups)
    for load in (0, 1, 2, 0):
        store.add_load(f"load-{load}", rows.where(F.pmod(by_load, F.lit(3)) == load))
    store.merge_loads()
    return store
