"""Parquet table access and the synthetic dirty customer table.

``dirty_customers`` turns the driver's ``customer`` table into a customer
table with the same ten columns and the same kinds of defects the library is
built to find (missing values, sentinels, mixed phone and date layouts, bad
casing, out-of-set categories).  It is a pure projection of ``customer``, so
its size grows with the input and it keeps the input's partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone", "date_of_birth",
    "address", "income", "account_status", "created_date",
)
CUSTOMER_DDL = (
    "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "date_of_birth STRING, address STRING, income DOUBLE, account_status STRING, created_date STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_from(customer: DataFrame, keep: tuple = ()) -> DataFrame:
    """A ``customer`` table (batch or stream) as the dirty ten-column customer table, and its columns ``keep``."""
    more = "".join(f", {c}" for c in keep)
    sql = DIRTY_CUSTOMERS_SQL.replace(" from {customer})", more + " from {customer})").replace("\nfrom c\n", more + "\nfrom c\n")
    return customer.sparkSession.sql(sql, customer=customer)


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty table over the driver's ``customer``."""
    return dirty_from(table(spark, sf_dir, "customer"))


# Every defect that the library looks for: ids out of order, repeated, null and below 1; names in
# every casing, with blanks around them, too short and too long; every date layout; dates before
# birth; missing, NaN and out-of-range incomes; a dozen unknown categories; text with delimiters,
# quotes, line breaks and outer blanks.
DIRTY_CUSTOMERS_SQL = """
with c as (select c_custkey as k, c_name, c_acctbal, cast(1950 + c_custkey % 50 as string) as y,
             cast(c_custkey as string) as t, lpad(cast(c_custkey % 10000 as string), 4, '0') as last4 from {customer})
select
  case when k % 97 = 13 then null when k % 89 = 5 then -k when k % 53 = 7 then 50
    when k % 2 = 0 then k + 2 else k end as customer_id,
  case k % 16 when 0 then 'John' when 1 then 'jane' when 2 then 'MARY' when 3 then null when 4 then "o'brien"
    when 5 then 'A' when 6 then '  ann  marie ' when 7 then repeat('x', 51) when 8 then c_name
    when 9 then 'Élodie' when 10 then 'mary-jane' else 'Robert' end as first_name,
  case k % 13 when 0 then 'Doe' when 1 then 'smith' when 2 then null when 3 then 'mary-jane' when 4 then 'Q'
    when 5 then repeat('long', 13) when 6 then ' lee ' when 7 then "d'arc" else 'Moore' end as last_name,
  case when k % 50 = 49 then null when k % 10 = 5 then concat('USER', t, '@EXAMPLE.COM')
    when k % 50 = 48 then 'not-an-email' when k % 60 = 17 then concat(' pad.', t, '@example.com ')
    else concat('user.', t, '@example.com') end as email,
  case k % 7 when 0 then concat('555-123-', last4) when 1 then concat('(555) 123-', last4)
    when 2 then concat('555.123.', last4) when 3 then concat('555123', last4) when 4 then '12345'
    when 5 then null else '+1 555 123 4567' end as phone,
  case k % 34 when 0 then 'invalid_date' when 1 then concat(y, '/05/10') when 2 then concat('01/15/', y)
    when 3 then concat(y, '-03-15') when 4 then concat(y, '-1-5') when 5 then concat('25/12/', y)
    when 6 then concat('01-15-', y) when 7 then concat('25-12-', y) when 8 then concat(y, '0704')
    when 9 then concat(y, '.06.07') when 10 then concat('Jan 15, ', y) when 11 then concat('march 3 ', y)
    when 12 then concat('15 JAN ', y) when 13 then concat('4 July, ', y) when 14 then concat('05-Feb-', y)
    when 15 then concat(y, '-03-15 10:30') when 16 then concat(y, '-03-15T10:30:45')
    when 17 then concat(y, '-03-15 10:30:45.123') when 18 then concat(y, '/05/10 10:00:00')
    when 19 then concat('1/15/', y, ' 9:05') when 20 then concat('1/5/', substr(y, 3, 2))
    when 21 then concat('25-12-', substr(y, 3, 2)) when 22 then concat(y, '-02-30') when 23 then 'soon'
    when 24 then null when 25 then concat('15.01.', y)
    when 26 then concat('15-Jan-', substr(y, 3, 2)) when 27 then concat('Jan-15-', y) when 28 then concat(y, '-Jan-15')
    when 29 then concat('15 Jan ', substr(y, 3, 2)) when 30 then concat('22nd January ', y)
    when 31 then concat('Monday, January 15, ', y) when 32 then concat('Sept 5 ', y)
    else concat(' ', y, '-10-01 ') end as date_of_birth,
  case k % 8 when 1 then null when 2 then concat('12 "Old" Rd, NY ', t) when 3 then concat('  ', t, ' Blank St ')
    when 4 then concat('Flat 1', char(10), t, ' Main St') when 5 then 'NY' else concat(t, ' Main St') end as address,
  case when k % 9 = 2 then null when k % 31 = 4 then cast('NaN' as double) when k % 37 = 6 then 10000001.5D
    when k % 41 = 9 then -1.0D else c_acctbal end as income,
  case k % 8 when 3 then null when 6 then concat('bad', cast((k div 8) % 12 as string)) when 1 then 'inactive'
    when 2 then 'suspended' when 4 then 'ACTIVE' when 5 then case when k % 3 = 0 then "it's" else 'active' end
    else 'active' end as account_status,
  case k % 20 when 19 then 'invalid_date' when 11 then '1949-01-01' when 7 then '01/31/2024'
    when 3 then '2024-01-10 08:15' when 5 then null else '2024-01-10' end as created_date
from c
"""
