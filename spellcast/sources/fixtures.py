"""Adapter views that give the driver's tables the shape of the pipeline's sources.

Each text is valid in Spark and in DuckDB; ``{name}`` stands for a base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "providers": """
        SELECT c_nationkey AS tin, c_custkey AS providerid,
               date '1994-01-01' + cast(mod(c_custkey * 37, 365) AS int) AS providercreatedon,
               c_mktsegment AS segment,
               CASE WHEN mod(c_custkey, 3) = 0 THEN 'MEDICAL' WHEN mod(c_custkey, 3) = 1 THEN 'DENTAL'
                    ELSE 'VISION' END AS providertype,
               n_name AS state, r_name AS taxonomygeneral,
               CASE WHEN mod(c_custkey, 2) = 0 THEN 'GENERAL' ELSE 'SPECIALIST' END AS taxonomyspecialty,
               c_acctbal AS apv
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
             JOIN {region} ON n_regionkey = r_regionkey""",
    "payments": """
        SELECT c_nationkey AS tin, c_custkey AS providerid, cast(l_shipdate AS date) AS paymentweek,
               CASE WHEN mod(l_partkey, 80) = 5 THEN 'ACH+' WHEN mod(l_partkey, 80) = 6 THEN 'VCC'
                    WHEN mod(l_partkey, 10) = 3 THEN 'PayerSponsoredACH'
                    WHEN mod(l_partkey, 40) = 7 THEN 'ACH Reversal' ELSE 'Check' END AS productline,
               CASE WHEN l_returnflag = 'R' AND mod(l_partkey, 3) = 0 THEN 'Cancelled'
                    WHEN l_linestatus = 'F' THEN 'Processed - Paid'
                    ELSE 'Processing - Out for payment' END AS statusname,
               l_suppkey AS payerid, 1 AS paymentcount, l_extendedprice AS paymentamount
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
             JOIN {customer} ON o_custkey = c_custkey""",
    "history": """
        SELECT c_nationkey AS tin, c_custkey AS providerid,
               CASE WHEN mod(o_orderkey, 8) = 0 THEN 'Opt-Out'
                    WHEN mod(o_orderkey, 8) IN (1, 3) THEN 'Opt-In' ELSE 'Under Review' END AS statusname,
               CASE WHEN mod(o_orderkey, 8) = 1 THEN 'VRA' ELSE 'Select' END AS productlinename,
               cast(o_orderdate AS date) AS statusstartdate, 0 AS optout_reason,
               CASE WHEN mod(o_orderkey, 24) = 0 THEN 'does not want a FEE'
                    WHEN mod(o_orderkey, 24) = 8 THEN 'did not understand' END AS notes
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "interactions": """
        SELECT c_nationkey AS tin, c_custkey AS providerid, cast(o_orderdate AS date) AS interactiondate,
               CASE WHEN o_orderstatus <> 'P' THEN 'Correspondence'
                    WHEN o_orderpriority = '1-URGENT' THEN 'Email' ELSE 'Disposition' END AS actionname,
               CASE o_orderpriority WHEN '2-HIGH' THEN 'Stop Payment' WHEN '3-MEDIUM' THEN 'Escalation'
                    ELSE 'Other' END AS actionreasonname
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # Two product lines per provider, so the exclusion join would fan out without its aggregate.
    "provider_map": """
        SELECT c_nationkey AS tin, c_custkey AS providerid, c_acctbal < 0 AS donotcall,
               mod(c_custkey, 50) = 0 AS globalexcluded,
               CASE WHEN mod(c_custkey, 4) = 0 THEN 31 ELSE 30 END AS statusid, 3 AS productlineid
        FROM {customer}
        UNION ALL
        SELECT c_nationkey AS tin, c_custkey AS providerid, c_acctbal < 0 AS donotcall,
               false AS globalexcluded, 31 AS statusid, 1 AS productlineid
        FROM {customer}""",
    "provider_flags": """
        SELECT c_custkey AS providerid, mod(c_custkey, 8) = 0 AS iswhitelabel,
               mod(c_custkey, 12) = 0 AS isdirectzero
        FROM {customer}""",
    # A binary target with a score in [0, 1) over orders; ``row_id`` breaks ties.
    "scored": """
        SELECT o_orderkey AS row_id, cast(o_orderdate AS date) AS event_date,
               CASE WHEN mod(o_orderkey, 11) = 0 THEN 1 ELSE 0 END AS target,
               (cast(mod(o_orderkey * 7919, 10007) AS double) / cast(10007 AS double)
                + CASE WHEN mod(o_orderkey, 11) = 0 THEN cast(0.3 AS double) ELSE cast(0 AS double) END)
               / cast(1.3 AS double) AS prob,
               mod(o_orderkey, 2) AS firstaction_bool,
               cast(mod(o_orderkey * 13, 5000) AS int) AS account_age,
               o_orderpriority AS priority, o_totalprice AS amount
        FROM {orders}""",
    # Rows to check for drift between an earlier and a later period.
    "checked": """
        SELECT o_orderkey AS row_id, cast(o_orderdate AS date) AS event_date,
               CASE WHEN o_orderdate < date '1999-01-01' THEN 'train' ELSE 'cmp' END AS dataset,
               o_orderstatus AS status, o_orderpriority AS priority, c_mktsegment AS segment,
               c_name AS customer_name, n_name AS state,
               CASE WHEN mod(o_orderkey, 7) = 0 THEN NULL ELSE concat(' note ', o_orderpriority, ' ') END AS note,
               o_totalprice AS amount, c_acctbal AS balance,
               CASE WHEN o_orderdate < date '1999-01-01' THEN o_totalprice ELSE o_totalprice * 1.5 END AS shifted,
               CASE WHEN mod(o_orderkey, 9) = 0 OR (o_orderdate >= date '1999-01-01' AND mod(o_orderkey, 3) = 0)
                    THEN NULL ELSE c_acctbal END AS sparse,
               CASE WHEN o_orderdate >= date '1999-01-01' AND mod(o_orderkey, 5) < 2 THEN o_totalprice * 20
                    ELSE o_totalprice END AS spiked
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    # Category columns with a target that depends on them.
    "binned": """
        SELECT o_orderkey AS row_id, cast(o_orderdate AS date) AS event_date, n_name AS state,
               r_name AS taxonomygeneral, c_mktsegment AS segment,
               CASE WHEN mod(o_orderkey, 5 + mod(c_nationkey, 7)) = 0 THEN 1 ELSE 0 END AS target,
               o_totalprice AS amount, c_acctbal AS balance, o_totalprice * 2 - c_acctbal * 0.01 AS amount_twin,
               mod(o_custkey, 100) AS cycle
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
             JOIN {region} ON n_regionkey = r_regionkey""",
    # Names of stored artifacts: project, model and timestamp.
    "artifacts": """
        SELECT concat('models/project__', CASE o_orderstatus WHEN 'F' THEN 'LogisticRegression'
                          WHEN 'O' THEN 'GBTClassifier' ELSE 'RandomForestClassifier' END, '__',
                      cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS string), '_',
                      lpad(cast(mod(o_orderkey, 1000000) AS string), 6, '0'), '.model') AS path,
               o_orderdate AS modified
        FROM {orders}""",
    "texts": """
        SELECT doc_id, CASE WHEN mod(n_chars, 3) = 0 THEN 'cmp' ELSE 'train' END AS dataset, lang, source, text
        FROM {documents}""",
}

BASE_TABLES = {
    "providers": ("customer", "nation", "region"),
    "payments": ("lineitem", "orders", "customer"),
    "history": ("orders", "customer"),
    "interactions": ("orders", "customer"),
    "provider_map": ("customer",),
    "provider_flags": ("customer",),
    "scored": ("orders",),
    "checked": ("orders", "customer", "nation"),
    "texts": ("documents",),
    "binned": ("orders", "customer", "nation", "region"),
    "artifacts": ("orders",),
}


class Fixtures:
    """Base tables and adapter views of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str, merged: tuple[str, ...] = ()) -> DataFrame:
        """The view; ``merged`` names tables that grow with the data and are never sent to the driver to be joined."""
        tables = {t: self.table(t) for t in BASE_TABLES[name]}
        return self.spark.sql(VIEWS[name], **{t: df.hint("merge") if t in merged else df for t, df in tables.items()})
