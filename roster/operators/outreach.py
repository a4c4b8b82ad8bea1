"""Choosing, rendering and tracking outreach messages.

Sending is left to an external mailer: it reads the outbox and reports each attempt to the send
log. Delivery is at least once; a message that went out but was not logged is planned again.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.functions.predicates import is_candidate
from roster.operators.merge import number_rows
from roster.operators.ranks import SHALLOW, id_at_rank
from roster.session import freeze

# Messages per run, and seconds between two messages.
DEFAULT_LIMIT = 5
DEFAULT_DELAY = 5.0


def sent_ids(log: DataFrame) -> DataFrame:
    """Ids with a successful attempt, each once, however often it was logged."""
    return log.where("ok").select("id").distinct()


def mark_checked(licences: DataFrame, log: DataFrame) -> DataFrame:
    """Licences with ``checked`` set where the log has a success; failures change nothing."""
    sent = sent_ids(log).withColumn("_sent", F.lit(True))
    checked = F.col("checked") | F.col("_sent").isNotNull()
    return licences.join(sent, "id", "left").withColumn("checked", checked).drop("_sent")


def apply_edits(licences: DataFrame, edits: DataFrame) -> DataFrame:
    """Licences with the latest edit of each value: by time, then the larger value. A NULL edits nothing."""
    made = F.struct("edited_at", "checked"), F.struct("edited_at", "personal_email")
    latest = edits.groupBy("id").agg(
        F.max(F.when(F.col("checked").isNotNull(), made[0])).alias("_checked"),
        F.max(F.when(F.col("personal_email").isNotNull(), made[1])).alias("_email"),
    )
    edited = {
        "checked": F.coalesce("_checked.checked", "checked"),
        "personal_email": F.coalesce("_email.personal_email", "personal_email"),
    }
    return licences.join(latest, "id", "left").withColumns(edited).drop("_checked", "_email")


def outreach_candidates(
    licences: DataFrame,
    limit: int | None = DEFAULT_LIMIT,
    log: DataFrame | None = None,
    shallow: int = SHALLOW,
) -> DataFrame:
    """The first ``limit`` unchecked licences with an e-mail, by id; logged successes are left out.

    A small limit is a top-k. For a large one the rows are written down, so that table and log are
    joined once, the last id is found by counting and the rows are cut there, in parallel. Without a
    limit (None) every candidate is returned.
    """
    open_rows = licences.where(is_candidate()).select("id", "full_name", "business_email")
    if log is not None:
        open_rows = open_rows.join(sent_ids(log), "id", "left_anti")
    if limit is None:
        return open_rows
    if limit <= shallow:
        return open_rows.orderBy("id").limit(limit)
    open_rows = freeze(open_rows, "candidates")
    last = id_at_rank(open_rows.select("id"), limit - 1)
    return open_rows if last is None else open_rows.where(F.col("id") <= last)


def outbox(
    licences: DataFrame,
    sender: str,
    subject: str,
    template: str,
    nameless: str,
    limit: int | None = DEFAULT_LIMIT,
    delay: float = DEFAULT_DELAY,
    log: DataFrame | None = None,
    shallow: int = SHALLOW,
) -> DataFrame:
    """The messages of one run, with the planned seconds after the start.

    ``{name}`` in the template becomes the full name, or ``nameless`` where there is none.
    Nothing is recorded: without a send log the call is a dry run.
    """
    candidates = outreach_candidates(licences, limit, log, shallow)
    placed = number_rows(candidates, ["id"], "_place", at_most=limit if limit is not None and limit <= shallow else None)
    name = F.coalesce(F.nullif("full_name", F.lit("")), F.lit(nameless))
    return placed.select(
        "id",
        F.lit(sender).alias("from_addr"),
        F.col("business_email").alias("to_addr"),
        F.lit(subject).alias("subject"),
        F.replace(F.lit(template), F.lit("{name}"), name).alias("body"),
        ((F.col("_place") - 1) * F.lit(float(delay))).alias("offset_seconds"),
    )


def outreach_summary(log: DataFrame) -> DataFrame:
    """One row: attempts, successes and failures of the given log entries."""
    return log.agg(
        F.count("*").alias("candidates"),
        F.count_if("ok").alias("sent"),
        F.count_if(~F.col("ok")).alias("failed"),
    )
