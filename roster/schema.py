"""Column names and schemas shared by every module."""

from pyspark.sql import types as T

# The registry's header names, with the names used inside Spark.
REGISTRY_HEADERS = {
    "License Number": "license_number",
    "First Name": "first_name",
    "Middle Name": "middle_name",
    "Last Name": "last_name",
    "NPN Number": "npn_number",
    "License TYCL Desc": "license_desc",
    "Email Address": "email",
    "Business Phone": "phone",
    "Mailing Address": "addr1",
    "Mailing Address2": "addr2",
    "Mailing City": "city",
    "Mailing State": "state",
    "Mailing Zip": "zip",
}

# The staging file's columns, in file order, with their header names.
STAGING_HEADERS = {
    "license_number": "License Number",
    "full_name": "Full Name",
    "npn_number": "NPN Number",
    "license_type": "License Type",
    "business_email": "Business Email",
    "business_phone": "Business Phone",
    "mailing_address": "Mailing Address",
    "personal_email": "Personal Email",
    "checked": "checked",
}

BATCH_COLUMNS = list(STAGING_HEADERS)
TEXT_COLUMNS = [c for c in BATCH_COLUMNS if c != "checked"]

# Two rows describe the same person when these two columns agree.
IDENTITY = ["full_name", "business_email"]

# Hash of the identity, with NULL as ''; stored beside the licence's columns, with a Bloom filter for each row group.
IDENTITY_HASH = "identity_hash"

# Position of a row in its source; present on every raw and normalised frame.
ORDINAL = "ordinal"

LICENCE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("license_number", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("npn_number", T.StringType()),
        T.StructField("license_type", T.StringType()),
        T.StructField("business_email", T.StringType()),
        T.StructField("business_phone", T.StringType()),
        T.StructField("mailing_address", T.StringType()),
        T.StructField("checked", T.BooleanType(), False),
        T.StructField("personal_email", T.StringType()),
    ]
)

SEND_LOG = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("ok", T.BooleanType(), False),
        T.StructField("error", T.StringType()),
    ]
)

# Staff edits; a NULL leaves the stored value.
EDITS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("edited_at", T.TimestampType()),
        T.StructField("checked", T.BooleanType()),
        T.StructField("personal_email", T.StringType()),
    ]
)
