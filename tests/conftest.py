"""Shared fixtures: one local Spark session and the small customer frames."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scrubline.session import local_session, shared_dir  # noqa: E402
from scrubline.sources.tables import CUSTOMER_DDL  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# --- fixed values: the ten golden input rows, as CSV text, and what comes of them ---
GOLDEN_CSV = """customer_id,first_name,last_name,email,phone,date_of_birth,address,income,account_status,created_date
1,John,Doe,john.doe@gmail.com,555-123-4567,1985-03-15,123 Main St New York NY 10001,75000,active,2024-01-10
2,Jane,Smith,jane.smith@company.com,555-987-6543,1990-07-22,,95000,active,2024-01-11
3,,Johnson,bob.johnson@email.com,(555) 234-5678,1988-11-08,456 Oak Ave Los Angeles CA 90001,,suspended,2024-01-12
4,Mary,Brown,mary.brown@gmail.com,555-345-6789,1975/05/10,789 Pine Rd Chicago IL 60601,120000,,2024-01-13
5,Robert,,robert.wilson@yahoo.com,555-456-7890,2005-12-25,892 Elm St Houston TX 77001,55000,active,01/15/2024
6,Patricia,Davis,PATRICIA.DAVIS@GMAIL.COM,555-567-8901,invalid_date,101 Birch Ln Phoenix AZ 85001,82000,active,2024-01-16
7,Michael,Miller,michael.miller@work.com,555-678-9012,1992-02-14,111 Maple Dr Philadelphia PA 19101,98000,active,2024-01-17
8,Sarah,wilson,sarah.wilson@gmail.com,555.789.0123,1968-06-18,121 Cedar way San Antonio TX 78201,105000,inactive,2024-01-18
9,David,Moore,david_moore@hotmail.com,5557890123,1958-09-30,,110000,active,2024-01-19
10,Jennifer,Taylor,jennifer.taylor@company.net,555-890-1234,1970-03-05,131 Spruce St San Diego CA 92101,88000,active,invalid_date
"""

GOLDEN_CLEANED = [
    (1, "John", "Doe", "john.doe@gmail.com", "555-123-4567", "1985-03-15", "123 Main St New York NY 10001", 75000.0, "active", "2024-01-10"),
    (2, "Jane", "Smith", "jane.smith@company.com", "555-987-6543", "1990-07-22", "[UNKNOWN]", 95000.0, "active", "2024-01-11"),
    (3, "[UNKNOWN]", "Johnson", "bob.johnson@email.com", "555-234-5678", "1988-11-08", "456 Oak Ave Los Angeles CA 90001", 0.0, "suspended", "2024-01-12"),
    (4, "Mary", "Brown", "mary.brown@gmail.com", "555-345-6789", "1975-05-10", "789 Pine Rd Chicago IL 60601", 120000.0, "unknown", "2024-01-13"),
    (5, "Robert", "[UNKNOWN]", "robert.wilson@yahoo.com", "555-456-7890", "2005-12-25", "892 Elm St Houston TX 77001", 55000.0, "active", "2024-01-15"),
    (6, "Patricia", "Davis", "patricia.davis@gmail.com", "555-567-8901", "[UNKNOWN]", "101 Birch Ln Phoenix AZ 85001", 82000.0, "active", "2024-01-16"),
    (7, "Michael", "Miller", "michael.miller@work.com", "555-678-9012", "1992-02-14", "111 Maple Dr Philadelphia PA 19101", 98000.0, "active", "2024-01-17"),
    (8, "Sarah", "Wilson", "sarah.wilson@gmail.com", "555-789-0123", "1968-06-18", "121 Cedar way San Antonio TX 78201", 105000.0, "inactive", "2024-01-18"),
    (9, "David", "Moore", "david_moore@hotmail.com", "555-789-0123", "1958-09-30", "[UNKNOWN]", 110000.0, "active", "2024-01-19"),
    (10, "Jennifer", "Taylor", "jennifer.taylor@company.net", "555-890-1234", "1970-03-05", "131 Spruce St San Diego CA 92101", 88000.0, "active", "[UNKNOWN]"),
]

GOLDEN_MASKED = [
    (1, "J***", "D***", "j***@gmail.com", "***-***-4567", "1985-**-**", "[MASKED ADDRESS]", 75000.0, "active", "2024-01-10"),
    (2, "J***", "S***", "j***@company.com", "***-***-6543", "1990-**-**", "[MASKED ADDRESS]", 95000.0, "active", "2024-01-11"),
    (3, "[UNKNOWN]", "J***", "b***@email.com", "***-***-5678", "1988-**-**", "[MASKED ADDRESS]", 0.0, "suspended", "2024-01-12"),
    (4, "M***", "B***", "m***@gmail.com", "***-***-6789", "1975-**-**", "[MASKED ADDRESS]", 120000.0, "unknown", "2024-01-13"),
    (5, "R***", "[UNKNOWN]", "r***@yahoo.com", "***-***-7890", "2005-**-**", "[MASKED ADDRESS]", 55000.0, "active", "2024-01-15"),
    (6, "P***", "D***", "p***@gmail.com", "***-***-8901", "[UNK-**-**", "[MASKED ADDRESS]", 82000.0, "active", "2024-01-16"),
    (7, "M***", "M***", "m***@work.com", "***-***-9012", "1992-**-**", "[MASKED ADDRESS]", 98000.0, "active", "2024-01-17"),
    (8, "S***", "W***", "s***@gmail.com", "***-***-0123", "1968-**-**", "[MASKED ADDRESS]", 105000.0, "inactive", "2024-01-18"),
    (9, "D***", "M***", "d***@hotmail.com", "***-***-0123", "1958-**-**", "[MASKED ADDRESS]", 110000.0, "active", "2024-01-19"),
    (10, "J***", "T***", "j***@company.net", "***-***-1234", "1970-**-**", "[MASKED ADDRESS]", 88000.0, "active", "[UNKNOWN]"),
]


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="scrubline-tests", shuffle_partitions=8)
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="scrubline-test-")


@pytest.fixture()
def golden_csv(tmp_dir):
    path = os.path.join(tmp_dir, "customers_raw.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(GOLDEN_CSV)
    return path


@pytest.fixture()
def golden_raw(spark, golden_csv):
    from scrubline.sources.csv import read_csv
    return read_csv(spark, golden_csv)


def customers(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER_DDL)


@pytest.fixture()
def sample_df(spark):
    """Five dirty rows with missing values, sentinel, mixed phones and dates, bad casing."""
    return customers(spark, [
        (1, "John", "Doe", "john.doe@gmail.com", "555-123-4567", "1985-03-15", "123 Main St New York NY 10001", 75000.0, "active", "2024-01-10"),
        (2, "jane", "Smith", "jane.smith@company.com", "555-987-6543", "1990-07-22", None, 95000.0, "active", "2024-01-11"),
        (3, None, "Johnson", "bob.johnson@email.com", "(555) 234-5678", "invalid_date", "456 Oak Ave Los Angeles CA 90001", None, "suspended", "2024-01-12"),
        (4, "Mary", "Brown", "mary.brown@gmail.com", "555.345.6789", "1975/05/10", "789 Pine Rd Chicago IL 60601", 120000.0, None, "2024-01-13"),
        (5, "Robert", None, "robert.wilson@yahoo.com", "5554567890", "2005-12-25", "892 Elm St Houston TX 77001", 55000.0, "active", "01/15/2024"),
    ])


@pytest.fixture()
def clean_df(spark):
    """Three clean rows that pass every rule."""
    return customers(spark, [
        (1, "John", "Doe", "john.doe@gmail.com", "555-123-4567", "1985-03-15", "123 Main St New York NY 10001", 75000.0, "active", "2024-01-10"),
        (2, "Jane", "Smith", "jane.smith@company.com", "555-987-6543", "1990-07-22", "456 Oak Ave Los Angeles CA 90001", 95000.0, "inactive", "2024-01-11"),
        (3, "Bob", "Johnson", "bob.johnson@email.com", "555-234-5678", "1988-11-08", "789 Pine Rd Chicago IL 60601", 60000.0, "suspended", "2024-01-12"),
    ])


@pytest.fixture()
def masker_df(spark):
    """Three cleaned rows, one with the name placeholder and one without an e-mail."""
    return customers(spark, [
        (1, "John", "Doe", "john.doe@gmail.com", "555-123-4567", "1985-03-15", "123 Main St New York NY 10001", 75000.0, "active", "2024-01-10"),
        (2, "Jane", "Smith", None, "555-987-6543", "1990-07-22", "456 Oak Ave Los Angeles CA 90001", 95000.0, "inactive", "2024-01-11"),
        (3, "[UNKNOWN]", "Johnson", "bob@email.com", "555-234-5678", "1988-11-08", "789 Pine Rd Chicago IL 60601", 60000.0, "suspended", "2024-01-12"),
    ])


def by_id(df, key="customer_id"):
    return {r[key]: r for r in df.collect()}
