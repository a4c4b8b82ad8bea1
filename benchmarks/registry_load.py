"""Load a CSV registry of about 1.2 million rows, and print the times.

The rows are those of the benchmark tables, repeated with other licence numbers and names. The first
drop comes as one file and, into another table, as part files. The second drop holds every row of the
first one and one tenth more.

    python benchmarks/registry_load.py [sf_dir] [copies]
"""

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from roster.operators import views  # noqa: E402
from roster.operators.outreach import outreach_candidates  # noqa: E402
from roster.plans import driver_tables as tables  # noqa: E402
from roster.plans.load import load  # noqa: E402
from roster.schema import ORDINAL  # noqa: E402
from roster.session import local_session, scratch_path  # noqa: E402
from roster.sources.registry import read_registry, write_registry  # noqa: E402
from roster.sources.table import read_table  # noqa: E402


def copies_of(raw, first: int, last: int):
    """The raw rows once for every number in first .. last-1, one copy after the other."""
    rows = raw.withColumn("_copy", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))
    return (
        rows.withColumn(ORDINAL, F.struct("_copy", ORDINAL))
        .withColumn("last_name", F.concat("last_name", F.lit(" "), F.col("_copy").cast("string")))
        .drop("_copy")
    )


def as_one_file(parts: str, path: str) -> None:
    """Part files with headers as one file, on the local disk."""
    os.makedirs(os.path.dirname(path))
    with open(path, "wb") as out:
        for i, name in enumerate(sorted(glob.glob(f"{parts}/part-*"))):
            with open(name, "rb") as part:
                header = part.readline()
                out.write(header if i == 0 else b"")
                out.write(part.read())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), **{"spark.driver.memory": "8g"})
    work = scratch_path(spark, "registry-load")
    raw, targets = tables.raw_registry(spark, sf_dir), tables.targets(spark, sf_dir)

    def timed(label, action):
        start = time.perf_counter()
        result = action()
        print(f"{label}: {time.perf_counter() - start:.2f} s {result}", flush=True)

    write_registry(copies_of(raw, 0, copies), f"{work}/day-1")
    write_registry(copies_of(raw, 0, copies + max(1, copies // 10)), f"{work}/day-2")
    as_one_file(f"{work}/day-1", f"{work}/whole/registry.csv")
    whole, table = f"{work}/whole-table", f"{work}/table"
    timed("warm-up", lambda: load(spark, f"{work}/warm", read_registry(spark, f"{work}/day-1").limit(1000), targets, "0"))
    timed("one file", lambda: load(spark, whole, read_registry(spark, f"{work}/whole"), targets, "1"))
    print("tasks of the one file:", read_registry(spark, f"{work}/whole").rdd.getNumPartitions(), flush=True)
    timed("first load", lambda: load(spark, table, read_registry(spark, f"{work}/day-1"), targets, "1"))
    timed("second load", lambda: load(spark, table, read_registry(spark, f"{work}/day-2"), targets, "2"))
    licences = read_table(spark, table)
    timed("tallies", lambda: views.status_tallies(licences).collect())
    timed("page 3", lambda: len(views.status_page(licences, "unchecked", 3).collect()))
    timed("candidates", lambda: len(outreach_candidates(licences).collect()))


if __name__ == "__main__":
    main()
