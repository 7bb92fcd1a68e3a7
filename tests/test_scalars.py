"""Edge rows of the scalar functions, as column helpers and as SQL functions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from wardflow import functions as fn
from wardflow.functions import vocabulary as v

CASES = {
    "snomed_description": ("string", [
        ("44054006", "Diabetes mellitus type 2"), ("59621000", "Essential hypertension"),
        ("999999999", "999999999"), ("", ""), (None, None),
    ]),
    "icd10_description": ("string", [
        ("I10", "Essential hypertension"), ("K92.1", "Melena (GI bleed)"), ("Z99.9", "Z99.9"),
        ("", ""), (None, None),
    ]),
    "adt_event_description": ("string", [
        ("A01", "Patient admitted"), ("A99", "Unknown ADT event: A99"),
        ("", "Unknown ADT event: "), (None, None),
    ]),
    "hedis_measure_name": ("string", [
        ("A1C", "HbA1c Management (<8%)"), ("awv", "Annual Wellness Visit"),
        ("xYz", "Unknown measure: xYz"), (None, None),
    ]),
    "chronic_risk_tier": ("int", [
        (-1, "none"), (0, "none"), (1, "low"), (2, "moderate"), (3, "high"), (9, "high"),
        (None, "none"),
    ]),
    "days_overdue_bucket": ("int", [
        (-5, "0-90 days (active)"), (0, "0-90 days (active)"), (90, "0-90 days (active)"),
        (91, "91-180 days (at risk)"), (180, "91-180 days (at risk)"),
        (181, "181-365 days (overdue)"), (365, "181-365 days (overdue)"),
        (366, "365+ days (lost to care)"), (None, "unknown"),
    ]),
    "is_valid_snomed": ("string", [
        ("12345", False), ("123456", True), ("1" * 18, True), ("1" * 19, False),
        ("12345a", False), ("", False), (None, None),
    ]),
    "is_valid_icd10": ("string", [
        ("I10", True), ("E11.9", True), ("S72.001A", True), ("E1199", False), ("I10X9", False),
        ("i10", False), ("I10.", False), ("J44.12345", False), ("", False), (None, None),
    ]),
}


@pytest.mark.parametrize("name", CASES)
def test_column_helper(column, name):
    kind, rows = CASES[name]
    assert column([x for x, _ in rows], kind, getattr(fn, name)) == [y for _, y in rows]


@pytest.mark.parametrize("name", CASES)
def test_sql_function(spark, column, name):
    fn.register_functions(spark, "scalar_tests")
    kind, rows = CASES[name]
    call = lambda c: F.call_function(f"scalar_tests.{name}", c)
    assert column([x for x, _ in rows], kind, call) == [y for _, y in rows]


def test_every_code_has_its_label(column):
    for system, name in (("snomed", "snomed_description"), ("icd10", "icd10_description"),
                         ("adt", "adt_event_description"), ("hedis", "hedis_measure_name")):
        codes = v.TERMINOLOGY[system]
        assert column(list(codes), "string", getattr(fn, name)) == list(codes.values())


def test_listed_functions(spark):
    names = fn.register_functions(spark, "listed_tests")
    listed = {row[0] for row in fn.list_functions(spark, "listed_tests").collect()}
    assert len(names) == 9
    assert {f"spark_catalog.{name}" for name in names} == listed


AGES = [
    (date(2001, 3, 1), date(2002, 3, 1), 0, 1),
    (date(2000, 3, 1), date(2004, 3, 1), 4, 4),
    (date(2000, 3, 1), date(2003, 3, 1), 2, 3),
    (date(2000, 2, 29), date(2001, 2, 28), 0, 1),
    (date(1980, 6, 15), date(2020, 6, 14), 39, 39),
    (None, date(2020, 1, 1), None, None),
]


def test_age(spark):
    fn.register_functions(spark, "age_tests")
    frame = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(AGES)],
        "i int, born date, as_of date, age int, exact int",
    )
    born, as_of = F.col("born"), F.col("as_of")
    rows = frame.select(
        "age", "exact",
        fn.age_from_dob(born, as_of).alias("a"),
        fn.age_from_dob(born, as_of, exact=True).alias("e"),
        F.expr("age_tests.age_from_dob(born, as_of)").alias("s"),
    ).collect()
    for row in rows:
        assert (row.a, row.e, row.s) == (row.age, row.exact, row.age)


def test_age_as_of_today(spark):
    fn.register_functions(spark, "age_tests")
    row = spark.range(1).select(
        fn.age_from_dob(F.lit("1990-01-01").cast("date")).alias("helper"),
        F.expr("age_tests.age_from_dob(date'1990-01-01')").alias("registered"),
    ).first()
    assert row.helper == row.registered >= 36


def test_event_code(column):
    given = ["ADT^A01", "ADT^A01^ADT_A01", "XYZ", "", None]
    assert column(given, "string", fn.hl7_event_code) == ["A01", "A01", "", "", None]


def test_code_system(column):
    given = ["44054006", "A01", "A99", "I10", "E11.9", "12345", "xyz", "", None]
    expected = ["snomed", "adt", "icd10", "icd10", "icd10", "unknown", "unknown", "unknown", None]
    assert column(given, "string", fn.code_system) == expected


def test_validate_codes(column):
    neither = "Not a recognized SNOMED or ICD-10 format"
    given = ["44054006", "I10", "xyz", "", "  ", None]
    verdicts = [row["verdict"] for row in column(given, "string", fn.validate_codes)]
    assert verdicts == ["Valid SNOMED", "Valid ICD-10-CM", neither, "", "", ""]


URLS = [
    ("jdbc:x://h/" + "a" * 84, "jdbc:x://h/" + "a" * 84),
    ("jdbc:x://h/" + "a" * 85, "jdbc:x://h/" + "a" * 84 + "..."),
    ("jdbc:postgresql://h/db?user=bob&password=pw", "jdbc:postgresql://h/db?user=***&password=***"),
    ("jdbc:mysql://bob:pw@h:3306/db", "jdbc:mysql://***@h:3306/db"),
    ("jdbc:mysql://bob:p@w@h/db", "jdbc:mysql://***@h/db"),
    ("jdbc:sqlserver://h;databaseName=d;user=bob;password={p;w};x=1",
     "jdbc:sqlserver://h;databaseName=d;user=***;password=***;x=***"),
    ("jdbc:oracle:thin:bob/pw@//h:1521/s", "jdbc:oracle:thin:***@//h:1521/s"),
    ("jdbc:x://h;UID=token;PWD=abc;AccessToken=zzz", "jdbc:x://h;UID=***;PWD=***;AccessToken=***"),
    ("jdbc:mysql://bob:p/w@h/db", "jdbc:mysql://***@h/db"),
    ("jdbc:postgresql://h:5432/db?mail=a@b", "jdbc:postgresql://h:5432/db?mail=***"),
    ("jdbc:x://h?ssl.trustPassword=a&user=b&passage=c", "jdbc:x://h?ssl.trustPassword=***&user=***&passage=***"),
    ("jdbc:derby:memory:x;create=true", "jdbc:derby:memory:x;create=true"),
    ("jdbc:x://h;password=a;b&c;ssl=true", "jdbc:x://h;password=***;ssl=true"),
    (None, None),
]


def test_mask_jdbc_url(column):
    masked = column([url for url, _ in URLS], "string", fn.mask_jdbc_url)
    assert masked == [shown for _, shown in URLS]


SECRETS = ["passphrase", "passcode", "AccountKey", "AccessKey", "SharedAccessSignature", "privateKey",
           "jwt", "credential"]


def test_no_unknown_property_shows_its_value(column):
    urls = [f"jdbc:x://h:1/db{sign}sslMode=on{sign if sign != '?' else '&'}{name}=hush/1+2==" for name in SECRETS
            for sign in "?;"]
    masked = column(urls, "string", fn.mask_jdbc_url)
    assert all("hush" not in m and "sslMode=on" in m for m in masked)
    assert column(["jdbc:x://host"], "string", lambda c: fn.mask_jdbc_url(c, 8)) == ["jdbc:x:/..."]
