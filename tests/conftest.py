from __future__ import annotations

import datetime as dt

import pytest

from tests.compare import database, session
from winback.contract import TRANSACTION_SCHEMA

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    found = session("4")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def con():
    return database(SMALL)


@pytest.fixture(scope="session")
def make_lines(spark):
    """Transactions from short rows: customer, day, and anything else by name."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            customer, day, *rest = row
            extra = rest[0] if rest else {}
            full.append(
                (
                    extra.get("invoice", f"{i}"),
                    extra.get("stock_code", "A"),
                    extra.get("description", "thing"),
                    extra.get("quantity", 1),
                    dt.datetime.fromisoformat(day),
                    extra.get("price", 2),
                    customer,
                    extra.get("country", "X"),
                )
            )
        loose = (
            "invoice string, stock_code string, description string, quantity int, "
            "invoice_date timestamp_ntz, price double, customer_id bigint, country string"
        )
        full = [(*r[:5], float(r[5]), *r[6:]) for r in full]
        df = spark.createDataFrame(full, loose)
        from winback.sources.guards import conform

        return conform(df, TRANSACTION_SCHEMA)

    return make
