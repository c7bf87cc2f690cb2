"""Lending-shaped views over the star-schema test tables.

The test tables are not lending data; these views give them the shape of the
inputs. Amounts are whole units or binary fractions of them, so that sums and
means come out the same in whatever order an engine adds.
"""

from creditloom import settings as S

# Day offset from a fixed date, the only expression the two SQL dialects write differently.
SPARK_DAYS = "datediff(CAST({0} AS DATE), DATE '2001-12-31')"

VIEWS = {
    "application": """
        SELECT c_custkey AS SK_ID_CURR,
          CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT) AS TARGET,
          CAST(25000 + (c_custkey * 3571) % 400000 AS DOUBLE) AS AMT_INCOME_TOTAL,
          CASE WHEN c_custkey % 50 = 7 THEN CAST(0 AS DOUBLE)
               ELSE CAST(50000 + (c_custkey * 7919) % 900000 AS DOUBLE) END AS AMT_CREDIT,
          CASE WHEN c_custkey % 40 = 3 THEN NULL
               ELSE CAST(2500 + (c_custkey * 131) % 50000 AS DOUBLE) END AS AMT_ANNUITY,
          CAST(45000 + (c_custkey * 6101) % 800000 AS DOUBLE) AS AMT_GOODS_PRICE,
          CASE WHEN c_custkey % 25 = 4 THEN NULL
               ELSE CAST(1 + c_custkey % 5 AS DOUBLE) END AS CNT_FAM_MEMBERS,
          CAST(-(6570 + (c_custkey * 37) % 25000) AS INT) AS DAYS_BIRTH,
          CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243
               ELSE -((c_custkey * 13) % 15000) END AS INT) AS DAYS_EMPLOYED,
          c_mktsegment AS NAME_SEGMENT,
          CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' WHEN c_nationkey % 3 = 1 THEN 'No' END AS FLAG_YES_NO
        FROM customer""",
    "bureau": """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
          CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE,
          CAST(floor(o_totalprice) AS DOUBLE) AS AMT_CREDIT_SUM,
          CASE WHEN o_orderstatus = 'O' THEN NULL
               ELSE CAST(floor(o_totalprice) AS DOUBLE) / 2 END AS AMT_CREDIT_SUM_DEBT,
          CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(o_totalprice / 10) AS DOUBLE)
               ELSE CAST(0 AS DOUBLE) END AS AMT_CREDIT_SUM_OVERDUE,
          CAST({d_order} AS INT) AS DAYS_CREDIT,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
               ELSE CAST({d_order} + 365 AS DOUBLE) END AS DAYS_CREDIT_ENDDATE,
          CAST(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS INT) AS CNT_CREDIT_PROLONG
        FROM orders""",
    "bureau_balance": """
        SELECT l_orderkey AS SK_ID_BUREAU, CAST(-l_linenumber AS INT) AS MONTHS_BALANCE,
          CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '0' ELSE 'C' END AS STATUS
        FROM lineitem""",
    "previous_application": """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
          CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END
            AS NAME_CONTRACT_STATUS,
          CAST(floor(o_totalprice) AS DOUBLE) AS AMT_CREDIT,
          CAST(floor(o_totalprice / 12) AS DOUBLE) AS AMT_ANNUITY,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL
               ELSE CAST(floor(o_totalprice / 10) AS DOUBLE) END AS AMT_DOWN_PAYMENT,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL
               ELSE CAST(o_orderkey % 8 AS DOUBLE) / 8 END AS RATE_DOWN_PAYMENT,
          CAST({d_order} AS INT) AS DAYS_DECISION,
          CAST(o_orderkey % 24 AS INT) AS HOUR_APPR_PROCESS_START,
          CAST(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 365243 ELSE {d_order} + 30 END AS DOUBLE)
            AS DAYS_FIRST_DUE,
          CAST(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 365243 ELSE {d_order} + 360 END AS DOUBLE)
            AS DAYS_LAST_DUE,
          CAST(CASE WHEN o_orderstatus = 'P' THEN 365243 ELSE {d_order} + 370 END AS DOUBLE)
            AS DAYS_TERMINATION,
          CAST(6 + o_orderkey % 31 AS DOUBLE) AS CNT_PAYMENT
        FROM orders""",
    "pos_cash": """
        SELECT user_id * 10 + event_id % 6 AS SK_ID_CURR, event_id AS SK_ID_PREV,
          CAST(-(1 + event_id % 60) AS INT) AS MONTHS_BALANCE,
          CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(6 + event_id % 31 AS DOUBLE) END AS CNT_INSTALMENT,
          CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(event_id % 31 AS DOUBLE) END
            AS CNT_INSTALMENT_FUTURE,
          CAST(CASE WHEN event_type = 'error' THEN event_id % 90 ELSE 0 END AS INT) AS SK_DPD,
          CAST(CASE WHEN event_type = 'error' THEN event_id % 10 ELSE 0 END AS INT) AS SK_DPD_DEF,
          CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'view' THEN 'Active'
               WHEN 'signup' THEN NULL ELSE 'Signed' END AS NAME_CONTRACT_STATUS
        FROM events""",
    "credit_card": """
        SELECT user_id * 10 + event_id % 6 AS SK_ID_CURR, event_id AS SK_ID_PREV,
          CAST(-(1 + event_id % 96) AS INT) AS MONTHS_BALANCE,
          CAST(floor(value) AS DOUBLE) AS AMT_BALANCE,
          CASE WHEN user_id % 10 = 0 THEN CAST(0 AS DOUBLE)
               ELSE CAST(40 + (user_id * 17) % 200 AS DOUBLE) END AS AMT_CREDIT_LIMIT_ACTUAL,
          CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS DOUBLE) END AS AMT_DRAWINGS_CURRENT,
          CASE WHEN event_type = 'click' THEN CAST(floor(value) AS DOUBLE) END AS AMT_PAYMENT_CURRENT,
          CAST(floor(value) AS DOUBLE) * 9 / 8 AS AMT_TOTAL_RECEIVABLE,
          CASE WHEN event_type = 'purchase' THEN CAST(event_id % 7 AS DOUBLE) END AS CNT_DRAWINGS_CURRENT,
          CAST(CASE WHEN event_type = 'error' THEN event_id % 45 ELSE 0 END AS INT) AS SK_DPD,
          CAST(CASE WHEN event_type = 'error' THEN event_id % 5 ELSE 0 END AS INT) AS SK_DPD_DEF
        FROM events""",
    "installments_payments": """
        SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV,
          CAST({d_order} AS DOUBLE) AS DAYS_INSTALMENT,
          CASE WHEN l_quantity = 50 THEN NULL ELSE CAST({d_ship} AS DOUBLE) END AS DAYS_ENTRY_PAYMENT,
          CASE WHEN l_quantity = 1 THEN CAST(0 AS DOUBLE)
               ELSE CAST(floor(l_extendedprice) AS DOUBLE) END AS AMT_INSTALMENT,
          CASE WHEN l_quantity = 50 THEN NULL
               ELSE CAST(floor(l_extendedprice) AS DOUBLE) * (64 - CAST(floor(l_discount * 80) AS DOUBLE)) / 64 END
            AS AMT_PAYMENT
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "scored": """
        SELECT c_custkey AS SK_ID_CURR,
          CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT) AS label,
          CAST((c_custkey * 37) % 1000 AS DOUBLE) / 1000 AS score
        FROM customer""",
}
# Applications from the last nations have no label yet.
VIEWS["application_train"] = VIEWS["application"] + " WHERE c_nationkey < 21"
VIEWS["application_test"] = VIEWS["application"] + " WHERE c_nationkey >= 21"
BASE_TABLES = ["customer", "orders", "lineitem", "events"]


def view_sql(name, days=SPARK_DAYS):
    return VIEWS[name].format(d_order=days.format("o_orderdate"), d_ship=days.format("l_shipdate"))


class Roles:
    """The role tables of one test-data folder, built on first use."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self._base = {}

    def _table(self, name):
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._base[name]

    def __getattr__(self, name):
        if name not in VIEWS:
            raise AttributeError(name)
        text = view_sql(name)
        used = {t: self._table(t) for t in BASE_TABLES if t in text}
        for table in used:
            text = text.replace(f"FROM {table}", f"FROM {{{table}}}").replace(f"JOIN {table}", f"JOIN {{{table}}}")
        return self.spark.sql(text, **used)

    def train(self):
        return self.application_train

    def test(self):
        return self.application_test.drop(S.LABEL)
