"""The test tables in the roles of the reports' input tables, once as DataFrames and once as SQL.

Customers are people, order lines are worked hours and answers, parts are questions and degrees,
suppliers are customers of the company, nations are categories.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import presto as P
from ..session import new_folder
from ..tables.store import TableStore

SQL = {
    "employees": """SELECT 'u' || c_custkey AS user_id, 'g' || c_custkey AS guid, c_name AS navn, 'c' || c_custkey AS email,
        'tel' AS telefon, c_mktsegment AS title, 'l' || c_custkey AS link, 'i' AS image_key,
        CASE WHEN c_nationkey = 1 THEN 0 ELSE 1930 + 4 * c_nationkey END AS born_year FROM customer""",
    "directory": """SELECT 'g' || c_custkey AS guid, nullif(c_name, 'Customer#000000000') AS displayname, 'c' || c_custkey AS email,
        CASE WHEN c_nationkey <> 4 THEN 'Customer#' || lpad(CAST(c_custkey // 10 AS VARCHAR), 9, '0') END AS manager
        FROM customer WHERE c_nationkey <> 3""",
    "hours": """SELECT 'g' || o_custkey AS guid, 'A' || o_custkey AS alias, 's' || l_suppkey AS customer, 'o' || l_partkey AS work_order,
        'w' || l_linenumber AS work_order_description, o_orderpriority AS project_type, strftime(o_orderdate, '%Y%m') AS reg_period,
        CAST(epoch(o_orderdate) AS BIGINT) AS time, CAST(l_linenumber AS BIGINT) AS weigth
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "projects": """SELECT 's' || l_suppkey AS customer, 'w' || l_linenumber AS work_order, strftime(o_orderdate, '%Y%m') AS reg_period,
        CASE l_returnflag WHEN 'N' THEN 200 ELSE 100 END AS timestamp, sum(l_quantity) AS hours, count(DISTINCT o_custkey) AS employees
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
    "mapping": """SELECT 's' || s_suppkey AS "dagens ubw prosjekt", 'w' || (s_nationkey % 7 + 1) AS arbeids_ordre,
        'k' || s_nationkey AS kunde, 'p' || s_nationkey AS prosjekt FROM supplier""",
    "education": """SELECT 'u' || (p_partkey // 2) AS user_id, CASE WHEN p_size % 5 = 0 THEN 'PhD i ' || p_name
        WHEN p_size % 5 = 1 THEN 'Master, ' || p_name WHEN p_size % 5 = 2 THEN p_name || ' Bachelor'
        WHEN p_size % 5 = 3 THEN 'Ingeniør' ELSE p_name END AS degree, 1970 + p_size AS year_to FROM part""",
    "jobs": """SELECT 'u' || o_custkey AS user_id, o_orderpriority AS employer, CAST(CASE WHEN o_totalprice < 20000 THEN 0 ELSE
        month(o_orderdate) END AS INTEGER) AS month_from, CAST(year(o_orderdate) AS INTEGER) AS year_from,
        CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 2 ELSE 11 END AS INTEGER) AS month_to,
        CAST(year(o_orderdate) + 1 AS INTEGER) AS year_to FROM orders""",
    "languages": "SELECT 'u' || o_custkey AS user_id, o_orderpriority AS name FROM orders",
    "skills": """SELECT 'u' || o_custkey AS user_id, CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END AS category,
        CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'x' END AS technology_skills FROM orders""",
    "experience_rows": """SELECT 'u' || o_custkey AS user_id, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS roles,
        'c' || o_custkey % 7 AS customer, o_orderstatus AS description, CAST(year(o_orderdate) AS INTEGER) AS year_from,
        CAST(year(o_orderdate) AS INTEGER) AS year_to, CAST(1 AS INTEGER) AS month_from, CAST(12 AS INTEGER) AS month_to FROM orders""",
    "answers": """SELECT 'n' || o_custkey AS username, 'c' || o_custkey AS email, 'q' || l_partkey AS questionid,
        l_quantity / 8 AS knowledge, CAST(l_linenumber AS DOUBLE) AS motivation, l_discount AS customscalevalue,
        'g' || o_custkey AS guid FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "questions": """SELECT 'q' || p_partkey AS id, p_brand AS topic, CASE WHEN p_size > 20 THEN 'knowledgeMotivation' ELSE 'customScale' END
        AS type, 'c' || (p_partkey % 25) AS categoryid, p_size AS "index", p_name AS text FROM part""",
    "categories": """SELECT 'c' || n_nationkey AS id, CASE n_nationkey WHEN 7 THEN 'Jobbrotasjon' ELSE n_name END AS text FROM nation""",
}


def sql(*names: str) -> str:
    """WITH clause body of these roles."""
    return ",\n    ".join(f"{n} AS ({SQL[n]})" for n in names)


def _key(prefix: str, c):
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), c.cast("string"))


class Roles:
    def __init__(self, t):
        self.t = t

    @property
    def employees(self):
        return self.t.customer.select(
            _key("u", "c_custkey").alias("user_id"), _key("g", "c_custkey").alias("guid"), F.col("c_name").alias("navn"),
            _key("c", "c_custkey").alias("email"), F.lit("tel").alias("telefon"), F.col("c_mktsegment").alias("title"),
            _key("l", "c_custkey").alias("link"), F.lit("i").alias("image_key"),
            F.when(F.col("c_nationkey") == 1, 0).otherwise(1930 + 4 * F.col("c_nationkey")).alias("born_year"))

    @property
    def directory(self):
        boss = F.concat(F.lit("Customer#"), F.lpad(F.expr("c_custkey div 10").cast("string"), 9, "0"))
        return self.t.customer.filter("c_nationkey <> 3").select(
            _key("g", "c_custkey").alias("guid"), F.nullif("c_name", F.lit("Customer#000000000")).alias("displayName"),
            _key("c", "c_custkey").alias("email"), F.when(F.col("c_nationkey") != 4, boss).alias("manager"))

    @property
    def _lines(self):
        return self.t.lineitem.join(self.t.orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @property
    def hours(self):
        return self._lines.select(
            _key("g", "o_custkey").alias("guid"), _key("A", "o_custkey").alias("alias"), _key("s", "l_suppkey").alias("customer"),
            _key("o", "l_partkey").alias("work_order"), _key("w", "l_linenumber").alias("work_order_description"),
            F.col("o_orderpriority").alias("project_type"), F.date_format("o_orderdate", "yyyyMM").alias("reg_period"),
            P.to_unixtime("o_orderdate").alias("time"), F.col("l_linenumber").cast("bigint").alias("weigth"))

    @property
    def project_rows(self):
        """Numbers and dates are grouped; the texts are made once per group."""
        grouped = self._lines.groupBy(
            "l_suppkey", "l_linenumber", F.trunc("o_orderdate", "month").alias("_month"),
            F.when(F.col("l_returnflag") == "N", 200).otherwise(100).alias("timestamp")).agg(
            F.sum("l_quantity").alias("hours"), F.count_distinct("o_custkey").alias("employees"))
        return grouped.select(
            _key("s", "l_suppkey").alias("customer"), _key("w", "l_linenumber").alias("work_order"),
            F.date_format("_month", "yyyyMM").alias("reg_period"), "timestamp", "hours", "employees")

    @property
    def projects(self):
        """The rollup is a stored table in the platform, so it is written once and read by the report."""
        store = TableStore(self.t.spark, new_folder(self.t.spark, "zone"))
        store.write(self.project_rows, "ubw_per_project_data")
        return store.read("ubw_per_project_data")

    @property
    def mapping(self):
        return self.t.supplier.select(
            _key("s", "s_suppkey").alias("dagens ubw prosjekt"), _key("w", F.col("s_nationkey") % 7 + 1).alias("arbeids_ordre"),
            _key("k", "s_nationkey").alias("kunde"), _key("p", "s_nationkey").alias("prosjekt"))

    @property
    def education(self):
        size, name = F.col("p_size") % 5, F.col("p_name")
        degree = F.when(size == 0, F.concat(F.lit("PhD i "), name)).when(size == 1, F.concat(F.lit("Master, "), name)) \
            .when(size == 2, F.concat(name, F.lit(" Bachelor"))).when(size == 3, "Ingeniør").otherwise(name)
        return self.t.part.select(_key("u", F.expr("p_partkey div 2")).alias("user_id"), degree.alias("degree"),
                                  (F.col("p_size") + 1970).alias("year_to"))

    @property
    def jobs(self):
        status = F.col("o_orderstatus")
        return self.t.orders.select(
            _key("u", "o_custkey").alias("user_id"), F.col("o_orderpriority").alias("employer"),
            F.when(F.col("o_totalprice") < 20000, 0).otherwise(F.month("o_orderdate")).alias("month_from"),
            F.year("o_orderdate").alias("year_from"),
            F.when(status == "F", 0).when(status == "O", 2).otherwise(11).alias("month_to"),
            (F.year("o_orderdate") + 1).alias("year_to"))

    @property
    def languages(self):
        return self.t.orders.select(_key("u", "o_custkey").alias("user_id"), F.col("o_orderpriority").alias("name"))

    @property
    def skills(self):
        return self.t.orders.select(
            _key("u", "o_custkey").alias("user_id"),
            F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("category"),
            F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise("x").alias("technology_skills"))

    @property
    def experience_rows(self):
        return self.t.orders.select(
            _key("u", "o_custkey").alias("user_id"),
            F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("roles"),
            _key("c", F.col("o_custkey") % 7).alias("customer"), F.col("o_orderstatus").alias("description"),
            F.year("o_orderdate").alias("year_from"), F.year("o_orderdate").alias("year_to"), F.lit(1).alias("month_from"),
            F.lit(12).alias("month_to"))

    @property
    def answers(self):
        return self._lines.select(
            _key("n", "o_custkey").alias("username"), _key("c", "o_custkey").alias("email"),
            _key("q", "l_partkey").alias("questionid"), (F.col("l_quantity") / 8).alias("knowledge"),
            F.col("l_linenumber").cast("double").alias("motivation"), F.col("l_discount").alias("customscalevalue"),
            _key("g", "o_custkey").alias("guid"))

    @property
    def questions(self):
        return self.t.part.select(
            _key("q", "p_partkey").alias("id"), F.col("p_brand").alias("topic"),
            F.when(F.col("p_size") > 20, "knowledgeMotivation").otherwise("customScale").alias("type"),
            _key("c", F.col("p_partkey") % 25).alias("categoryid"), F.col("p_size").alias("index"), F.col("p_name").alias("text"))

    @property
    def categories(self):
        return self.t.nation.select(
            _key("c", "n_nationkey").alias("id"),
            F.when(F.col("n_nationkey") == 7, "Jobbrotasjon").otherwise(F.col("n_name")).alias("text"))
