import pytest

from roster.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", partitions=4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def licences(spark):
    """Build licence rows from (id, name, email) or (id, name, email, checked)."""
    from roster.schema import LICENCE

    def build(*rows):
        full = [
            (r[0], f"L{r[0]}", r[1], f"N{r[0]}", "LIFE", r[2], "305 555 0100", "1 Main St", *(r[3:] or [False]), None)
            for r in rows
        ]
        return spark.createDataFrame(full, LICENCE)

    return build


@pytest.fixture
def batch(spark):
    """Build batch rows from (ordinal, name, email)."""
    schema = """ordinal long, license_number string, full_name string, npn_number string,
        license_type string, business_email string, business_phone string, mailing_address string,
        personal_email string, checked boolean"""

    def build(*rows):
        full = [(o, f"L{o}", name, None, "LIFE", email, None, None, None, False) for o, name, email in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture
def registry(spark):
    """Build raw rows from dictionaries; columns not given are ''."""
    from roster.schema import REGISTRY_HEADERS

    def build(*rows):
        names = list(REGISTRY_HEADERS.values())
        schema = ", ".join(f"{name} string" for name in names) + ", ordinal long"
        data = [tuple(row.get(name, "") for name in names) + (i,) for i, row in enumerate(rows)]
        return spark.createDataFrame(data, schema)

    return build


@pytest.fixture
def targets(spark):
    from roster.plans.load import Targets

    cities = spark.createDataFrame([("MIAMI",), ("DAVIE",)], "city string")
    return Targets(cities, ["LIFE", "LIFE & HEALTH"])
