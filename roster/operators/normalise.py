"""From raw registry rows to licence rows."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.functions.predicates import has_class, is_in_state
from roster.functions.text import clean_trimmed_compact, full_name, mailing_address, trimmed, upper_cell
from roster.schema import ORDINAL, REGISTRY_HEADERS


def target_cities(*counties: DataFrame) -> DataFrame:
    """The distinct cities of several county lists, as one ``city`` column."""
    cities = counties[0].select("city")
    for county in counties[1:]:
        cities = cities.union(county.select("city"))
    return cities.distinct()


def filter_target(
    raw: DataFrame, cities: DataFrame, classes: Iterable[str], state: str = "FL"
) -> DataFrame:
    """Rows of one state, of the given cities and licence classes.

    State and class are decided in the scan stage. The city list is an ordinary semi join:
    Spark broadcasts it by its known size and shuffles if somebody passes a huge one.
    """
    in_scope = raw.where(is_in_state(F.col("state"), state) & has_class(F.col("license_desc"), classes))
    wanted = cities.select(F.col("city").alias("_city"))
    return in_scope.join(wanted, upper_cell(in_scope["city"]) == wanted["_city"], "left_semi")


def clean_registry(raw: DataFrame) -> DataFrame:
    """Raw rows with every cell cleaned.

    Thirteen full copies of the expression in one generated method would be too long for the JVM
    to compile, and then run several times slower; hence the compact form, over trimmed columns.
    """
    cells = REGISTRY_HEADERS.values()
    plain = raw.withColumns({c: trimmed(F.col(c)) for c in cells})
    return plain.withColumns({c: clean_trimmed_compact(F.col(c)) for c in cells})


def to_licences(raw: DataFrame) -> DataFrame:
    """Clean raw rows and project them to licence rows; an empty text is stored as NULL."""
    texts = {
        "license_number": F.col("license_number"),
        "full_name": full_name(F.col("first_name"), F.col("middle_name"), F.col("last_name")),
        "npn_number": F.col("npn_number"),
        "license_type": F.upper("license_desc"),
        "business_email": F.col("email"),
        "business_phone": F.col("phone"),
        "mailing_address": mailing_address(*[F.col(c) for c in ("addr1", "addr2", "city", "state", "zip")]),
    }
    return clean_registry(raw).select(
        *[F.nullif(text, F.lit("")).alias(name) for name, text in texts.items()],
        F.lit(None).cast("string").alias("personal_email"),
        F.lit(False).alias("checked"),
        ORDINAL,
    )


def normalise_registry(
    raw: DataFrame, cities: DataFrame, classes: Iterable[str], state: str = "FL"
) -> DataFrame:
    return to_licences(filter_target(raw, cities, classes, state))


def scan_metrics(
    raw: DataFrame, cities: DataFrame, classes: Iterable[str], state: str = "FL"
) -> DataFrame:
    """One row with the number of rows read and of rows matched, from one pass."""
    in_scope = is_in_state(F.col("state"), state) & has_class(F.col("license_desc"), classes)
    row_city = F.when(in_scope, upper_cell(F.col("city")))
    # Counting per city first leaves a hot city, and all rows out of scope, one row per task.
    tallies = raw.groupBy(row_city.alias("_row_city")).count()
    wanted = cities.select(F.col("city").alias("_city")).distinct()
    matched = F.when(F.col("_city").isNotNull(), F.col("count"))
    return tallies.join(wanted, tallies["_row_city"] == wanted["_city"], "left").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(matched), F.lit(0)).alias("rows_matched"),
    )
