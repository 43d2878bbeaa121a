"""The typed owner tables as views over the driver tables.

The view texts run unchanged in Spark SQL and DuckDB, so an oracle is the same model under another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: View name -> (tables or views it reads, SELECT).
VIEWS = {
    "memberships": """SELECT o_orderkey AS id, o_custkey AS member, CAST(year(o_orderdate) - 1994 AS INT) AS term_no,
        CAST(o_orderkey % 25 AS INT) AS constituency, CAST(o_orderdate AS DATE) AS s,
        CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INT) END AS e,
        o_orderpriority AS party, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INT) AS ps,
        CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INT) END AS pe
        FROM orders""",
    "house_terms": """SELECT CAST(y - 1994 AS INT) AS term_no, make_date(y, 1, 1) AS s,
        CASE WHEN y = max(y) OVER () THEN NULL ELSE make_date(y, 12, 31) END AS e
        FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders) t""",
    "members": "SELECT c_custkey AS member, c_name AS name, c_nationkey AS home, c_mktsegment AS code FROM customer",
    "committee_memberships": """SELECT l_orderkey AS id, l_linenumber AS line, o_custkey AS member, l_suppkey AS committee,
        CAST(l_shipdate AS DATE) AS s, CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_orderkey % 200 AS INT) END AS e
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "office_holdings": """SELECT l_orderkey AS id, o_custkey AS member, CAST(l_partkey % 50 AS INT) AS office, p_type AS office_type, p_size < 10 AS cabinet,
        CAST(l_shipdate AS DATE) AS s, CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_orderkey % 90 AS INT) END AS e
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 1""",
    "bills": "SELECT o_orderkey AS bill, o_orderstatus AS status, o_orderpriority AS kind, CAST(year(o_orderdate) AS INT) AS bill_year FROM orders",
    "activities": "SELECT l_orderkey AS bill, l_linenumber AS stage_no, l_returnflag AS activity_type, CAST(l_shipdate AS DATE) AS activity_date FROM lineitem",
    "participations": "SELECT l_orderkey AS bill, l_suppkey AS sponsor, l_linenumber = 1 AS is_primary FROM lineitem",
    "components": """SELECT conv_id AS record, turn + 1 AS ordinal, role AS kind,
        CASE WHEN turn = 0 THEN NULL ELSE CAST(floor((turn - 1) / 2.0) AS BIGINT) + 1 END AS container, text FROM conversations""",
    "concepts": """SELECT item_id AS concept, CASE WHEN item_id = 0 THEN NULL ELSE CAST(floor((item_id - 1) / 3.0) AS BIGINT) END AS broader,
        lower(regexp_extract(text, '^[ \t\r\n]*[^ \t\r\n]+([ \t\r\n]+[^ \t\r\n]+)?([ \t\r\n]+[^ \t\r\n]+)?', 0)) AS label FROM benchmark""",
    "observations": "SELECT event_id, user_id AS resource, ts AS observed_at, event_type AS kind, sha256(coalesce(props, '')) AS hash, value FROM events",
    "services": """SELECT o_orderkey AS id, o_custkey AS member, CASE WHEN o_orderkey % 4 = 0 THEN 'seanad' ELSE 'dail' END AS house,
        CAST(year(o_orderdate) - 1994 AS INT) AS term_no, CAST(o_orderkey % 25 AS INT) AS constituency, CAST(o_orderdate AS DATE) AS s,
        CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INT) END AS e FROM orders""",
    "houses": "SELECT r_regionkey AS house, r_name AS name FROM region",
    "constituencies": "SELECT n_nationkey AS constituency, n_name AS name, n_regionkey AS house FROM nation",
    "committees": """SELECT s_suppkey AS committee, s_name AS name, s_nationkey AS code,
        CASE WHEN s_suppkey % 3 = 0 THEN 'joint' WHEN s_suppkey % 3 = 1 THEN 'select' ELSE 'standing' END AS kind FROM supplier""",
    "sittings": "SELECT event_id AS sitting, user_id AS record, event_type AS body, CAST(ts AS DATE) AS day FROM events",
    "votes": """SELECT l_orderkey AS division, l_linenumber AS line, l_suppkey AS member,
        CASE WHEN l_returnflag = 'R' THEN 'ta' WHEN l_returnflag = 'A' THEN 'nil' ELSE 'staon' END AS side FROM lineitem""",
}
#: Fixed value: the date on which "current" is judged.
AS_OF = "DATE '2000-06-30'"


def _ordered(names: set[str]) -> list[str]:
    return [v for v in VIEWS if v in names]


def used(text: str) -> set[str]:
    import re

    words = set(re.findall(r"\w+", text))
    return {v for v in VIEWS if v in words}


def _headed(heads: list[tuple[str, str]], text: str) -> str:
    """The statement with named selects in front of its own."""
    if not heads:
        return text
    head = ",\n".join(f"{name} AS ({select})" for name, select in heads)
    body = text.strip()
    for start in ("WITH RECURSIVE", "WITH"):
        if body.upper().startswith(start):
            return f"{start} {head},\n{body[len(start):]}"
    return f"WITH {head}\n{body}"


def with_views(text: str) -> str:
    """The statement with the model views that it names in front, for DuckDB."""
    return _headed([(v, VIEWS[v]) for v in _ordered(used(text))], text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a statement over the driver tables and model views it names; the session's own views are left alone."""
    import re

    full = with_views(text)
    words = set(re.findall(r"\w+", full))
    full = re.sub(r"\bsha256\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)", r"sha2(\1, 256)", full)
    return spark.sql(_headed([(t, f"SELECT * FROM parquet.`{sf_dir}/{t}.parquet`") for t in TABLES if t in words], full))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sql(spark, sf_dir, f"SELECT * FROM {name}")
