"""A registry derived from the benchmark tables: one row per order, the customer is the agent."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.operators.normalise import normalise_registry, target_cities
from roster.plans.load import Targets
from roster.schema import LICENCE, ORDINAL
from roster.session import freeze

CLASSES = ["1-URGENT", "2-HIGH"]
# Orders before this date make up the stored table, the others the new batch.
CUT = "1997-01-01"
# Orders before this date come in a late drop.
EARLY = "1993-01-01"


# The schemas of the benchmark tables in use.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw columns, the order date, and the order key as the ordinal."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    agent = F.col("o_custkey")

    def escaped(value: Column) -> Column:
        return F.concat(F.lit('="'), value.cast("string"), F.lit('"'))

    return (
        table(spark, sf_dir, "orders")
        .join(customers, agent == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias(ORDINAL),
            F.col("o_orderdate").alias("odate"),
            escaped(F.col("o_orderkey")).alias("license_number"),
            F.lit("Customer.").alias("first_name"),
            F.when(agent % 3 == 0, "").otherwise("  J.,  Q ").alias("middle_name"),
            F.substr("c_name", F.lit(10)).alias("last_name"),
            escaped(agent).alias("npn_number"),
            F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("license_desc"),
            F.when(agent % 7 == 0, "")
            .when(agent % 11 == 0, F.lit(None))
            .otherwise(F.concat(F.lit("c"), agent.cast("string"), F.lit("@example.com")))
            .alias("email"),
            F.when(agent % 4 == 0, "(305) 555-0123")
            .when(agent % 4 == 1, "+1 305 555 0123")
            .when(agent % 4 == 2, "n/a")
            .alias("phone"),
            F.concat((agent % 900).cast("string"), F.lit(" Main St")).alias("addr1"),
            F.when(agent % 2 == 0, "APT 3").otherwise("").alias("addr2"),
            F.lower("n_name").alias("city"),
            F.when(F.col("o_orderstatus") == "F", " fl ")
            .when(F.col("o_orderstatus") == "P", '="FL"')
            .otherwise("GA")
            .alias("state"),
            F.lit('="33101"').alias("zip"),
        )
    )


def with_line_breaks(raw: DataFrame) -> DataFrame:
    """Every third address goes over several lines and has quotes and commas in it."""
    broken = F.concat("addr1", F.lit('\n"Suite", 2\n\n'), F.col(ORDINAL).cast("string"))
    return raw.withColumn("addr1", F.when(F.col(ORDINAL) % 3 == 0, broken).otherwise(F.col("addr1")))


def write_faulty(raw: DataFrame, path: str) -> None:
    """Lines of three cells; of ten some have a cell less, two more, text behind a quote, or stray quotes that are no fault."""
    kind = F.col(ORDINAL) % 10
    number, name, email = F.concat(F.lit('"=""'), F.col(ORDINAL).cast("string"), F.lit('"""')), F.col("last_name"), F.coalesce("email", F.lit(""))
    line = (
        F.when(kind == 1, F.concat_ws(",", number, name))
        .when(kind == 2, F.concat_ws(",", number, name, email, F.lit("x"), F.lit('"y,z"')))
        .when(kind == 3, F.concat_ws(",", number, F.concat(F.lit('"'), name, F.lit('"tail')), email))
        .when(kind == 4, F.concat_ws(",", number, F.concat(name, F.lit('"x"')), email))
        .otherwise(F.concat_ws(",", number, name, email))
    )
    header = "License Number,Last Name,Email Address"
    raw.select(line.alias(header)).write.options(header=True, quote="", sep="\x01").csv(path)


def county(spark: SparkSession, sf_dir: str, region: str) -> DataFrame:
    """The nations of a region, standing for the cities of a county."""
    regions = table(spark, sf_dir, "region").where(F.col("r_name") == region)
    nations = table(spark, sf_dir, "nation")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select(
        F.lit(region).alias("county"), F.col("n_name").alias("city")
    )


def targets(spark: SparkSession, sf_dir: str) -> Targets:
    counties = [county(spark, sf_dir, region) for region in ("AFRICA", "AMERICA")]
    return Targets(target_cities(*counties), CLASSES)


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_registry(raw_registry(spark, sf_dir), *targets(spark, sf_dir))


def old_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("odate") < F.lit(CUT).cast("timestamp_ntz"))


def new_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("odate") >= F.lit(CUT).cast("timestamp_ntz"))


def as_table(licences: DataFrame) -> DataFrame:
    """Normalised rows as a licence table: the ordinal is the id, every third row is checked."""
    return licences.withColumn("id", F.col(ORDINAL)).withColumn("checked", F.col(ORDINAL) % 3 == 0).select(
        *LICENCE.fieldNames()
    )


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_table(normalised(spark, sf_dir))


def stored_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows written down, as the viewer and the campaign find them."""
    return freeze(licences(spark, sf_dir), "licences")


def with_edits(licences: DataFrame) -> DataFrame:
    """Some missing e-mails as '' and not NULL, as hand edits leave them."""
    emptied = F.col("business_email").isNull() & (F.col("id") % 2 == 0)
    return licences.withColumn("business_email", F.when(emptied, "").otherwise(F.col("business_email")))


def old_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table before the load; it holds duplicates and hand edits."""
    raw = old_rows(raw_registry(spark, sf_dir))
    return with_edits(as_table(normalise_registry(raw, *targets(spark, sf_dir))))


def staff_edits(licences: DataFrame) -> list[DataFrame]:
    """Two days of edits: every fourth id is checked, then every eighth is not any more; some get an e-mail."""
    every = F.col("id")
    first = licences.where(every % 4 == 0).select(
        "id",
        F.lit("2026-01-01 10:00:00").cast("timestamp").alias("edited_at"),
        F.lit(True).alias("checked"),
        F.when(every % 3 == 0, F.concat(F.lit("first"), every.cast("string"))).alias("personal_email"),
    )
    second = licences.where(every % 8 == 0).select(
        "id",
        F.lit("2026-01-02 10:00:00").cast("timestamp").alias("edited_at"),
        F.lit(False).alias("checked"),
        F.when(every % 5 == 0, F.lit("second@example.com")).alias("personal_email"),
    )
    return [second, first]


def move_with_date(spark: SparkSession, source: str, target: str, days_ago: int) -> None:
    """Move a folder, with its files dated back, as a drop that was made long before it arrives."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    system = paths(source).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(paths(source)):
        system.setTimes(status.getPath(), status.getModificationTime() - days_ago * 86_400_000, -1)
    system.rename(paths(source), paths(target))


def send_log(candidates: DataFrame) -> DataFrame:
    """Attempts for the given candidates; every fifth id fails."""
    ok = F.col("id") % 5 != 0
    return candidates.select("id", ok.alias("ok"), F.when(~ok, "refused").alias("error"))
