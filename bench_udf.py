"""Native parse against the same parse as a Python UDF per row, on the same message files.

    python bench_udf.py [folder] [copies]

The messages are read ``copies`` times over, to set the work per row apart from the planning.
The forms take turns, so that neither runs on a colder engine; the median is shown.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bench import seconds  # noqa: E402
from checks import tables  # noqa: E402
from tests.plain_hl7 import parse  # noqa: E402
from wardflow.operators.hl7 import PARSED_COLUMNS, hl7_parse_adt  # noqa: E402
from wardflow.session import local_session  # noqa: E402
from wardflow.sources.files import hl7_file_scan  # noqa: E402

WARM_UPS, REPEATS = 4, 7


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    path = tables.landed_messages(spark, sf_dir)
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 1

    def messages() -> DataFrame:
        return reduce(DataFrame.unionAll, [hl7_file_scan(spark, path, framed=True)] * copies)

    fields = ", ".join(f"{name}: string" for name in PARSED_COLUMNS) + ", is_parse_error: boolean"
    per_row = F.udf(parse, f"struct<{fields}>")
    forms = {
        "native": lambda: hl7_parse_adt(messages()),
        "python udf": lambda: messages()
        .select(per_row("value").alias("parsed")).select("parsed.*"),
    }
    rows = forms["native"]().count()
    same = forms["native"]().exceptAll(forms["python udf"]()).isEmpty()
    runs = {name: [] for name in forms}
    for _ in range(WARM_UPS + REPEATS):
        for name, build in forms.items():
            runs[name].append(seconds(build))
    results = {n: round(statistics.median(r[WARM_UPS:]), 3) for n, r in runs.items()}
    print(json.dumps({"messages": rows, "same rows": same, "seconds": results}))
    spark.stop()


if __name__ == "__main__":
    main()
