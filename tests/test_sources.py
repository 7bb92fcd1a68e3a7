"""JDBC over the in-process database, audit, upsert, sinks, landing folder."""

import uuid
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.tables import DERBY_DRIVER
from wardflow.session import scratch_folder
from wardflow.sources import files, jdbc, tables


@pytest.fixture(scope="module")
def url(spark):
    address = f"jdbc:derby:memory:test_{uuid.uuid4().hex}"
    rows = spark.range(100).select(
        F.col("id").alias("k"),
        (F.col("id") * 2).alias("n"),
        F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2020-01-01").cast("timestamp")).alias("at"),
    )
    rows.write.format("jdbc").options(
        url=f"{address};create=true", driver=DERBY_DRIVER, dbtable="items"
    ).save()
    return address


@pytest.fixture
def database(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    return name


def test_scan_pushes_the_filter_down(spark, url):
    init = "SET CURRENT ISOLATION = UR"
    scan = jdbc.jdbc_scan(spark, url, DERBY_DRIVER, "items", session_init=init)
    assert scan.count() == 100
    plan = scan.where("k > 90")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,90)" in plan


@pytest.mark.parametrize("bounds", [(None, None), (0, 100), (40, 60)])
def test_partitioned_scan_loses_no_row_outside_the_bounds(spark, url, bounds):
    scan = jdbc.jdbc_partitioned_scan(
        spark, url, DERBY_DRIVER, "items", "k", *bounds, num_partitions=4
    )
    assert scan.rdd.getNumPartitions() == 4
    assert scan.agg(F.sum("k")).first()[0] == 4950


def test_partitioned_scan_of_an_empty_table(spark, url):
    scan = jdbc.jdbc_partitioned_scan(
        spark, url, DERBY_DRIVER, "(SELECT * FROM items WHERE \"k\" < 0) AS nothing", "k"
    )
    assert scan.count() == 0


def test_predicates_split_a_hot_key(spark, url):
    parts = [f'MOD("k", 4) = {i}' for i in range(4)]
    scan = jdbc.jdbc_predicates_scan(spark, url, DERBY_DRIVER, "items", parts)
    assert scan.rdd.getNumPartitions() == 4 and scan.agg(F.sum("k")).first()[0] == 4950


def test_names_are_quoted_as_the_database_does(spark):
    assert jdbc.quoted(spark, "jdbc:mysql://h/db", "x") == "`x`"
    assert jdbc.quoted(spark, "jdbc:postgresql://h/db", "x") == '"x"'
    assert jdbc.quoted(spark, "jdbc:databricks://h/db", "x") == "`x`"


def test_transfer_and_audit(spark, url, database):
    target, log = f"{database}.items", f"{database}.jdbc_ingests"
    for _ in range(2):
        audit = jdbc.jdbc_transfer_audited(
            spark, url, DERBY_DRIVER, "items", target, partition_column="k")
        jdbc.audit_append(audit, log)
    jdbc.audit_append(jdbc.jdbc_transfer_audited(spark, "", DERBY_DRIVER, "items", target), log)
    assert spark.table(target).count() == 100
    rows = spark.table(log).orderBy("ingested_at").collect()
    assert [r.row_count for r in rows] == [100, 100, 0]
    assert rows[2].jdbc_source == "(not configured)" and rows[2].time_seconds == "0"
    assert rows[0].jdbc_source == url and float(rows[0].time_seconds) > 0
    assert rows[0].source_table == "items" and rows[0].target_table == target
    assert datetime.strptime(rows[0].refresh_date, "%Y-%m-%d")
    assert spark.table(log).schema == jdbc.AUDIT_SCHEMA


def test_transfer_fault_surfaces(spark, url, database):
    with pytest.raises(Exception):
        jdbc.jdbc_transfer_audited(spark, url, DERBY_DRIVER, "no_such", f"{database}.x")


def upserted(spark, database, tmp_path, target_rows, source_rows):
    schema = "k int, v string, at timestamp"
    target = f"{database}.t_{uuid.uuid4().hex[:6]}"
    tables.table_overwrite_sink(spark.createDataFrame(target_rows, schema), target)
    source = spark.createDataFrame(source_rows, schema)
    place = f"{tmp_path}/{uuid.uuid4().hex}"
    merged = jdbc.incremental_upsert(source, target, "k", "at", place)
    assert merged.columns == ["k", "v", "at"]
    return {r.k: r.v for r in merged.collect()}, target


def day(number):
    return datetime(2020, 1, number)


def test_upsert(spark, database, tmp_path):
    found, target = upserted(
        spark, database, tmp_path,
        [(1, "old", day(1)), (2, "old", day(5)), (3, "old", day(2))],
        [(1, "late and missed", day(3)), (2, "same instant", day(5)), (3, "new", day(6)),
         (3, "newest", day(7)), (4, "added", day(8))],
    )
    assert found == {1: "old", 2: "same instant", 3: "newest", 4: "added"}
    source = spark.createDataFrame([(4, "again", day(9))], "k int, v string, at timestamp")
    jdbc.incremental_upsert(source, target, "k", "at", f"{tmp_path}/second")
    assert {r.k: r.v for r in spark.table(target).collect()}[4] == "again"
    assert spark.table(target).count() == 4


def test_upsert_into_an_empty_table_loads_all(spark, database, tmp_path):
    found, _ = upserted(spark, database, tmp_path, [], [(1, "a", day(1)), (2, "b", None)])
    assert found == {1: "a", 2: "b"}


def test_upsert_without_news_changes_nothing(spark, database, tmp_path):
    found, _ = upserted(spark, database, tmp_path, [(1, "a", day(5))], [(1, "x", day(1))])
    assert found == {1: "a"}


def test_small_news_is_broadcast_and_the_target_not_shuffled(spark, tmp_path):
    spark.range(100_000).select(F.col("id").alias("k"), F.lit("a").alias("v")).write.parquet(
        f"{tmp_path}/current")
    spark.range(5).select(F.col("id").alias("k"), F.lit("b").alias("v")).write.parquet(
        f"{tmp_path}/newest")
    current, newest = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("current", "newest"))
    merged = jdbc.merged_by_key(current, newest, "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert merged.where("v = 'b'").count() == 5 and merged.count() == 100_000


def test_overwrite_does_not_double(spark, database):
    for _ in range(2):
        tables.table_overwrite_sink(spark.range(5), f"{database}.numbers")
    assert spark.table(f"{database}.numbers").count() == 5


def test_ctas_replaces_rows_and_columns(spark, database):
    name = f"{database}.made"
    tables.ctas_replace(spark, name, spark.range(5))
    made = tables.ctas_replace(spark, name, "SELECT 'x' AS a UNION ALL SELECT 'y'")
    assert sorted(r.a for r in made.collect()) == ["x", "y"]


def test_sink_creates_the_database(spark):
    name = f"made_{uuid.uuid4().hex[:8]}"
    for table in (f"{name}.t", f"`{name}`.`t`", f"spark_catalog.{name}.t", "t"):
        tables.create_database_of(spark, table)
        assert spark.catalog.databaseExists(name)
    spark.sql(f"DROP DATABASE {name}")


def test_tolerant_count(spark, database):
    tables.table_overwrite_sink(spark.range(7), f"{database}.there")
    assert tables.tolerant_count(spark, f"{database}.there").first().rows == 7
    assert tables.tolerant_count(spark, f"{database}.missing").first().rows == 0
    assert tables.tolerant_count(spark, "no_such_database.missing").first().rows == 0


def test_preview(spark):
    assert tables.preview(spark.range(100), 3).count() == 3
    assert [r.id for r in tables.preview(spark.range(100), 2, [F.desc("id")]).collect()] == [99, 98]


def test_landing_folder(spark, tmp_path):
    for number in range(12):
        (tmp_path / f"m{number:02d}.hl7").write_text("x" * (number + 1))
    total = files.landing_file_inventory(spark, str(tmp_path)).first()
    assert (total.files, total.bytes) == (12, 78)
    listing = files.landing_file_listing(spark, str(tmp_path), 10)
    assert [r.path[-7:] for r in listing.collect()] == [f"m{n:02d}.hl7" for n in range(10)]
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_missing_landing_folder_is_a_fault(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.landing_file_inventory(spark, f"{tmp_path}/none").collect()


def test_scratch_folder_is_new_each_time(spark):
    assert scratch_folder(spark) != scratch_folder(spark)


def test_several_messages_in_a_file(spark, tmp_path):
    one, two = "MSH|^~\\&|A|B|||1||ADT^A01\rPID|1||P1", "MSH|^~\\&|C|D|||2||ADT^A02\nEVN||3"
    cases = {"a": f"{one}\r{two}\n", "b": f"\x0b{one}\x1c\r\x0b{two}\x1c\r\n", "c": f"junk\r\n{one}", "d": " \r\n",
             "e": one + "\rOBX|1|MSHX"}
    for name, text in cases.items():
        (tmp_path / name).write_bytes(text.encode())
    found = {}
    for row in files.provenance_columns(files.hl7_file_scan(spark, str(tmp_path))).collect():
        found.setdefault(row.source_file[-1], []).append(row.value.strip())
    assert found == {"a": [one, two], "b": [one, two], "c": ["junk", one], "e": [cases["e"]]}
    framed = files.hl7_file_scan(spark, f"{tmp_path}/b", framed=True).collect()
    assert [r.value.strip() for r in framed] == [one, two]


def test_several_roots_in_a_file(spark, tmp_path):
    def root(n):
        return f'<Doc id="{n}"><x>{n}</x><y>more</y></Doc>'

    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?>\n{root(1)}\n{root(2)}{root(3)}\n")
    (tmp_path / "b.xml").write_text(root(4))
    (tmp_path / "c.xml").write_text("no document")
    schema = "x string, _id int, _corrupt_record string"
    from pyspark.sql.types import StructType

    rows = files.xml_scan(spark, str(tmp_path), "Doc", StructType.fromDDL(schema)).collect()
    assert sorted((r.x, r._id) for r in rows if r.x) == [(str(n), n) for n in range(1, 5)]
    assert [r._corrupt_record for r in rows if not r.x] == ["no document"]
    texts = files.xml_texts(spark.read.text(f"{tmp_path}/a.xml", wholetext=True), "Doc").collect()
    assert [r.value for r in texts] == [root(1), root(2), root(3)]


def test_several_bundles_in_a_file(spark, tmp_path):
    from wardflow.operators import fhir

    one = '{"resourceType": "Bundle",\n "entry": [{"resource": {"resourceType": "Patient", "id": "p1"}},\n' \
          ' {"resource": {"resourceType": "Patient", "id": "p2"}}\n ]\n}'
    two = one.replace("p1", "p3").replace("p2", "p4")
    (tmp_path / "a.json").write_text(f"{one}\r\n{two}\n")
    (tmp_path / "b.json").write_text(one[:60])
    (tmp_path / "c.json").write_text('{"resourceType": "Patient"}')
    (tmp_path / "d.json").write_text("\n")
    bundles = files.fhir_bundle_scan(spark, str(tmp_path))
    ids = fhir.fhir_entries(bundles).select("id").collect()
    assert sorted(r.id for r in ids) == ["p1", "p2", "p3", "p4"]
    errors = fhir.fhir_parse_errors(bundles).collect()
    assert sorted(r.cause for r in errors) == ["not JSON", "not a Bundle"]


def test_a_failing_overwrite_keeps_the_old_table(spark, database):
    target = f"{database}.kept"
    tables.table_overwrite_sink(spark.range(5), target)
    failing = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        tables.table_overwrite_sink(failing, target)
    assert spark.table(target).count() == 5
    assert [t.name for t in spark.catalog.listTables(database)] == ["kept"]
    tables.table_overwrite_sink(spark.table(target).where("id < 3").withColumn("x", F.lit(1)), target)
    assert spark.table(target).columns == ["id", "x"] and spark.table(target).count() == 3


def test_upsert_of_null_keys_and_null_marks(spark, database, tmp_path):
    target = f"{database}.nulls"
    schema = "k long, at timestamp, n int"
    tables.table_overwrite_sink(spark.createDataFrame(
        [(1, datetime(2020, 1, 1), 1), (None, datetime(2020, 1, 1), 2)], schema), target)
    source = spark.createDataFrame(
        [(None, datetime(2020, 1, 2), 3), (2, None, 4), (1, datetime(2019, 1, 1), 5)], schema)
    for turn in range(2):
        merged = jdbc.incremental_upsert(source, target, "k", "at", f"{tmp_path}/v{turn}")
        assert sorted((tuple(r)[::2] for r in merged.collect()), key=repr) == [(1, 1), (2, 4), (None, 3)]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def split(df):
    """Number of tasks that read the one file."""
    return df.rdd.getNumPartitions()


@pytest.mark.parametrize("end", ["\r", "\n", "\r\n", "mixed"])
def test_plain_messages_are_split(spark, tmp_path, small_splits, end):
    ends = [end if end != "mixed" else ("\r", "\n", "\r\n")[i % 3] for i in range(3000)]
    texts = [f"MSH|^~\\&|MSH|B|||{i}||ADT^A01{e}OBX|1|MSHX|é{i}" for i, e in enumerate(ends)]
    texts[7] = texts[7].replace("|", "#")
    (tmp_path / "all.hl7").write_bytes("".join(t + e for t, e in zip(texts, ends)).encode())
    scan = files.hl7_file_scan(spark, str(tmp_path))
    assert split(scan) > 4
    assert sorted(r.value.strip() for r in scan.collect()) == sorted(texts)


def test_plain_documents_are_split(spark, tmp_path, small_splits):
    def root(n):
        inner = f"<x>{n}</x>" + "<y>more</y>" * (n % 40)
        return (f'<Doc id="{n}">{inner}</Doc >' if n % 97 == 5 else f'<Doc id="{n}"/>' if n % 97 == 6
                else f'<Doc\nid="{n}">\n{inner}\n</Doc>')

    between = ["\n", "", "\n<?xml version='1.0'?>\n<!-- <z> -->\n", " "]
    text = "<?xml version='1.0'?>" + "".join(root(n) + between[n % 4] for n in range(1500))
    (tmp_path / "a.xml").write_text(text)
    (tmp_path / "cut.xml").write_text(root(1500) + root(1501)[:-9])
    scan = files.xml_file_texts(spark, str(tmp_path), "Doc")
    assert split(scan) > 4
    found = sorted(r.value for r in scan.collect())
    assert found == sorted([root(n) for n in range(1501)] + [root(1501)[:-9] + "</Doc>"])
    whole = files.xml_texts(spark.read.text(f"{tmp_path}/a.xml", wholetext=True), "Doc")
    assert sorted(r.value for r in whole.collect()) == sorted(root(n) for n in range(1500))


def test_cut_off_documents_are_told(spark, tmp_path):
    one = "<Doc><x>é</x><y/></Doc>"
    for name, text in {"whole": one * 3 + "\n", "bare": one, "cut": one + one[:-6], "none": "x",
                       "blank": "\n"}.items():
        (tmp_path / name).write_text(text)
    told = files.cut_off_files(spark, str(tmp_path), "Doc").collect()
    assert [r.path.rsplit("/", 1)[1] for r in told] == ["cut"]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n\n  ", " \n"])
def test_plain_bundles_are_split(spark, tmp_path, small_splits, end):
    def bundle(n):
        texts = ['{"a": {"b": "}"}', f'"n": {n}', '"entry": [\n{"c": "{é"},\n{"d": 1}\n]', '"e": {}']
        return ",\n".join(texts[: 2 + n % 3]) + ("}" if n % 2 else "\n}")

    (tmp_path / "a.json").write_bytes(("﻿" * 0 + end.join(map(bundle, range(1000)))).encode())
    (tmp_path / "b.json").write_bytes((end + bundle(1000) + end).encode())
    (tmp_path / "cut.json").write_text('{"n": 1001, "entry": [')
    scan = files.fhir_bundle_scan(spark, str(tmp_path))
    if end in ("\n", "\r\n"):
        assert split(scan) > 4
    found = sorted(r.value.strip() for r in scan.collect())
    assert found == sorted([*map(bundle, range(1001)), '{"n": 1001, "entry": ['])


def folders(spark, table):
    return {f.rsplit("/", 1)[0] for f in spark.table(table).inputFiles()}


def test_same_columns_are_replaced_by_one_catalog_change(spark, database, monkeypatch):
    target = f"{database}.pointed"
    tables.table_overwrite_sink(spark.range(5), target)
    monkeypatch.setattr(tables, "_rename", None)
    reader = spark.table(target)
    seen = [folders(spark, target)]
    for n in (6, 7, 8):
        tables.table_overwrite_sink(spark.range(n), target)
        assert spark.table(target).count() == n
        seen.append(folders(spark, target))
    assert len(set(map(frozenset, seen))) == 4

    def failing(*arguments):
        raise RuntimeError("no")

    monkeypatch.setattr(tables, "_relocate", failing)
    with pytest.raises(RuntimeError):
        tables.table_overwrite_sink(spark.range(9), target)
    assert spark.table(target).count() == 8 and reader.columns == ["id"]


def test_running_readers_keep_their_files_for_a_replacement(spark, database):
    target = f"{database}.read"
    tables.table_overwrite_sink(spark.range(5), target)
    files_of = spark.table(target).inputFiles()
    tables.table_overwrite_sink(spark.range(6), target)
    assert spark.read.parquet(*files_of).count() == 5
    tables.table_overwrite_sink(spark.range(7), target)
    with pytest.raises(AnalysisException):
        spark.read.parquet(*files_of).count()
    spark.sql(f"DROP TABLE {target}")
    tables.table_overwrite_sink(spark.range(4), target)
    assert spark.table(target).count() == 4


def test_a_failing_rename_gives_the_name_back(spark, database, monkeypatch):
    target = f"{database}.renamed"
    tables.table_overwrite_sink(spark.range(5), target)
    rename = tables._rename

    def failing(session, table, name):
        if "_next_" in table:
            raise RuntimeError("no")
        rename(session, table, name)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(RuntimeError):
        tables.table_overwrite_sink(spark.range(3).withColumn("x", F.lit(1)), target)
    assert spark.table(target).count() == 5 and spark.table(target).columns == ["id"]
    assert [t.name for t in spark.catalog.listTables(database)] == ["renamed"]


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a hot value, most others in a narrow range, a few far away, some NULL."""
    address = f"jdbc:derby:memory:skew_{uuid.uuid4().hex}"
    n = F.col("id")
    key = (F.when(n < 900, 7).when(n < 1000, n * 1_000_000_007).when(n < 1100, None)
           .when(n < 1200, -n).otherwise(100 + n % 400))
    spark.range(3000).select(n, key.cast("long").alias("k")).coalesce(1).write.format("jdbc").options(
        url=f"{address};create=true", driver=DERBY_DRIVER, dbtable="items").save()
    return address


def partition_sizes(scan):
    return scan.groupBy(F.spark_partition_id().alias("p")).count().collect()


@pytest.mark.parametrize("parts", [1, 4, 10])
def test_skewed_keys_give_even_partitions(spark, skewed, parts):
    scan = jdbc.jdbc_balanced_scan(spark, skewed, DERBY_DRIVER, "items", "k", parts, second="id")
    sizes = [r["count"] for r in partition_sizes(scan)]
    assert abs(len(sizes) - parts) <= 1 and max(sizes) <= 2 * min(sizes)
    assert scan.select("id").distinct().count() == 3000 == scan.count()
    assert scan.where("k IS NULL").count() == 100


def test_a_hot_value_is_a_partition_of_its_own(spark, skewed):
    scan = jdbc.jdbc_partitioned_scan(spark, skewed, DERBY_DRIVER, "items", "k", num_partitions=10)
    hot = scan.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.count_if(F.col("k") == 7).alias("hot")).where("hot > 0").collect()
    assert [(r.n, r.hot) for r in hot] == [(900, 900)] and scan.count() == 3000
    rest = [r["count"] for r in partition_sizes(scan.where("k IS NULL OR k <> 7"))]
    assert max(rest) <= 2 * 300


def test_predicates_of_odd_tables(spark):
    assert jdbc.balanced_predicates(0, [], "k", 4) == ["(k IS NOT NULL) OR k IS NULL"]
    assert jdbc.balanced_predicates(5, [], "k", 4) == ["(k IS NOT NULL)", "k IS NULL"]
    assert jdbc.balanced_predicates(0, [(3, 4, 9)], "k", 1) == ["k IS NULL OR (k IS NOT NULL)"]


def test_transfer_reads_the_source_once_and_not_the_target(spark, url, database, monkeypatch):
    seen = []
    monkeypatch.setattr(jdbc.tables, "table_overwrite_sink", lambda rows, target: (
        seen.append(rows), rows.write.saveAsTable(target, format="parquet")))
    counted = spark.table
    monkeypatch.setattr(type(spark), "table", lambda self, name: pytest.fail("read again"))
    audit = jdbc.jdbc_transfer_audited(spark, url, DERBY_DRIVER, "items", f"{database}.once")
    monkeypatch.undo()
    assert audit.first().row_count == 100 == counted(f"{database}.once").count()
    assert "CollectMetrics" in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_task_is_counted_once(spark, tmp_path, database):
    flag = str(tmp_path / "failed")

    def fails_once(batches):
        import os

        for batch in batches:
            if not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("first try")
            yield batch

    from pyspark.sql import Observation

    written = Observation()
    rows = spark.range(0, 1000, 1, 4).observe(written, F.count(F.lit(1)).alias("rows"))
    if spark.sparkContext.master.startswith("local["):
        # A local session doesn't repeat tasks, so the repeat is a second write of the same rows.
        with pytest.raises(Exception):
            rows.mapInArrow(fails_once, "id long").write.saveAsTable(f"{database}.once", format="parquet")
        written = Observation()
        rows = spark.range(0, 1000, 1, 4).observe(written, F.count(F.lit(1)).alias("rows"))
    rows.mapInArrow(fails_once, "id long").write.saveAsTable(f"{database}.twice", format="parquet")
    assert written.get["rows"] == 1000 == spark.table(f"{database}.twice").count()
