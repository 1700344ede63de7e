"""Registered queries: normal forms of names and addresses, table readers and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, text
from .records import records_view, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def addresses(spark: SparkSession, d: str) -> DataFrame:
    """Invented addresses over the customers: house number, street, city, state or postal code, country."""
    k = F.col("c_custkey")
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % len(xs) + 1).cast("int"))
    digits = F.lpad((k * 7919 % 1000000).cast("string"), 6, "0")
    zip_ = F.when(k % 3 == 1, digits).otherwise(F.substring(digits, 1, 5))
    addr = F.concat((k % 900 + 1).cast("string"), F.lit(" "), pick("Main St", "Oak Ave.", "Park Rd", "Rue de Lyon", "5th Blvd"), F.lit(", "), pick("Austin", "Pune", "Paris", "Salem"), F.lit(", "), pick("TX", "Maharashtra", "Bretagne", "West Virginia", "Goa"), F.lit(" "), zip_)
    country = pick("US", "India", "France")
    return table(spark, d, "customer").select("c_custkey", addr.alias("addr"), country.alias("country"))


ADDRESS_SQL = """addresses AS (SELECT c_custkey, (c_custkey % 900 + 1) || ' ' || (['Main St', 'Oak Ave.', 'Park Rd', 'Rue de Lyon', '5th Blvd'])[c_custkey % 5 + 1] || ', ' || (['Austin', 'Pune', 'Paris', 'Salem'])[c_custkey % 4 + 1]
  || ', ' || (['TX', 'Maharashtra', 'Bretagne', 'West Virginia', 'Goa'])[c_custkey % 5 + 1] || ' ' || CASE WHEN c_custkey % 3 = 1 THEN z ELSE substr(z, 1, 5) END AS addr, (['US', 'India', 'France'])[c_custkey % 3 + 1] AS country
  FROM (SELECT *, lpad(CAST(c_custkey * 7919 % 1000000 AS VARCHAR), 6, '0') AS z FROM customer))"""


def _skeleton_sql() -> str:
    from .queries_matching import RECORDS_SQL, SKELETON_SQL

    return f"WITH {RECORDS_SQL}, words AS (SELECT string_split(name_core, ' ') AS names, string_split(addr_core, ' ') AS addrs FROM records), {SKELETON_SQL} SELECT w AS word, sk AS skeleton FROM skel WHERE w <> ''"


@query("norm_skeleton", _skeleton_sql())
def _(spark, d):
    r = records_view(spark, d)
    words = r.select(F.explode(F.split(F.concat_ws(" ", "name_core", "addr_core"), " ")).alias("word")).where("word <> ''").distinct()
    return words.select("word", text.skeleton(F.col("word")).alias("skeleton"))


@query("norm_canon_num", "SELECT c_custkey, CASE WHEN ltrim(z, '0') = '' THEN '0' ELSE ltrim(z, '0') END AS num FROM (SELECT c_custkey, lpad(CAST(c_custkey * 37 % 1000 AS VARCHAR), 6, '0') AS z FROM customer)")
def _(spark, d):
    z = F.lpad((F.col("c_custkey") * 37 % 1000).cast("string"), 6, "0")
    return table(spark, d, "customer").select("c_custkey", text.canon_num(z).alias("num"))


@query("street_number", f"WITH {ADDRESS_SQL} SELECT c_custkey, regexp_extract(addr, '\\b(\\d+)\\b', 1) AS num FROM addresses")
def _(spark, d):
    return addresses(spark, d).select("c_custkey", clean.street_number(F.col("addr")).alias("num"))


@query("postal_code", f"WITH {ADDRESS_SQL} SELECT c_custkey, CASE WHEN country = 'India' THEN regexp_extract(addr, '\\b(\\d{{6}})\\b', 1) ELSE regexp_extract(addr, '\\b(\\d{{5}})\\b', 1) END AS code FROM addresses")
def _(spark, d):
    return addresses(spark, d).select("c_custkey", clean.postal_code(F.col("addr"), F.col("country")).alias("code"))


@query(
    "state_or_region",
    f"""WITH {ADDRESS_SQL} SELECT c_custkey, CASE WHEN country = 'US' THEN CASE WHEN contains(lower(addr), 'west virginia') THEN 'wv' WHEN regexp_extract(addr, '\\b([A-Z]{{2}})\\b', 1) = 'TX' THEN 'tx' ELSE '' END
WHEN country = 'India' THEN CASE WHEN contains(lower(addr), 'maharashtra') THEN 'maharashtra' WHEN contains(lower(addr), 'goa') THEN 'goa' ELSE '' END
WHEN contains(lower(addr), 'bretagne') THEN 'bretagne' ELSE '' END AS state FROM addresses""",
)
def _(spark, d):
    return addresses(spark, d).select("c_custkey", clean.state_or_region(F.col("addr"), F.col("country")).alias("state"))


@query("name_tokens_sorted", "WITH w AS (SELECT p_partkey, string_split(lower(trim(p_name)), ' ') AS w FROM part) SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(w, lambda x: x NOT IN ('the', 'a', 'an', 'of', 'and', '&', 'for', 'in', 'at', 'by', 'to', 'on', 'with', 'from') AND length(x) > 1))), ' ') AS name_tokens FROM w")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", clean.name_tokens(F.lower(F.trim("p_name"))).alias("name_tokens"))


@query("join_initials", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'abc shop ' || c_custkey WHEN 1 THEN 'a shop ' || c_custkey ELSE 'old xy ' || c_custkey END AS name FROM customer")
def _(spark, d):
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.lit("a b c shop ")).when(k % 3 == 1, F.lit("a shop ")).otherwise(F.lit("old x y "))
    return table(spark, d, "customer").select("c_custkey", text.join_initials(F.concat(raw, k.cast("string"))).alias("name"))


@query(
    "basic_text",
    "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'a and b llc' WHEN 1 THEN 'joes bar at ' || c_custkey WHEN 2 THEN 'sas dupont' ELSE 'x and y 12' END AS t FROM customer",
)
def _(spark, d):
    k = F.col("c_custkey")
    raw = F.when(k % 4 == 0, F.lit("A & B L.L.C.")).when(k % 4 == 1, F.concat(F.lit("Joe's  Bar @ "), k.cast("string"))).when(k % 4 == 2, F.lit("S.A.S Dupont")).otherwise(F.lit("x + y-12"))
    return table(spark, d, "customer").select("c_custkey", text.basic(raw).alias("t"))


@query(
    "norm_name",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'acme tools' WHEN 1 THEN 'acmetools' ELSE 'sharma brothers' END AS core, CASE c_custkey % 3 WHEN 0 THEN 'acme tools private limited' WHEN 1 THEN 'acmetools' ELSE 'sharma and brothers company' END AS full_name,
       CASE c_custkey % 3 WHEN 0 THEN 'ltd pvt' WHEN 1 THEN '' ELSE 'co' END AS legal, CASE c_custkey % 3 WHEN 2 THEN '7' ELSE '' END AS nums, CASE c_custkey % 3 WHEN 1 THEN 1 ELSE 0 END AS is_dom FROM customer""",
)
def _(spark, d):
    k = F.col("c_custkey") % 3
    raw = F.when(k == 0, F.lit("Acme Tools Pvt Ltd")).when(k == 1, F.lit("www.acme-tools.com")).otherwise(F.lit("Sharma & Bros Co. 007"))
    n = table(spark, d, "customer").select("c_custkey", text.norm_name(raw).alias("n"))
    return n.select("c_custkey", "n.core", F.col("n.full").alias("full_name"), "n.legal", "n.nums", "n.is_dom")


@query(
    "norm_addr",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN h || ' main street austin' WHEN 1 THEN h || ' mg road pune' ELSE h || ' rue lyon' END AS core,
       CASE c_custkey % 3 WHEN 0 THEN 'texas' WHEN 1 THEN 'maharashtra' ELSE 'bretagne' END AS state, h AS nums FROM (SELECT c_custkey, CAST(c_custkey % 900 + 1 AS VARCHAR) AS h FROM customer)""",
)
def _(spark, d):
    k = F.col("c_custkey")
    h = F.concat(F.lit("0"), (k % 900 + 1).cast("string"))
    raw = F.when(k % 3 == 0, F.concat(h, F.lit(" Main St, Austin, TX"))).when(k % 3 == 1, F.concat(h, F.lit(" M.G. Rd, Pune, Maharashtra"))).otherwise(F.concat(h, F.lit(" Rue de Lyon, Finistere")))
    country = F.when(k % 3 == 0, F.lit("US")).when(k % 3 == 1, F.lit("India")).otherwise(F.lit("France"))
    n = table(spark, d, "customer").select("c_custkey", text.norm_addr(raw, country).alias("n"))
    return n.select("c_custkey", "n.core", "n.state", "n.nums")


@query("clean_names")
def _(spark, d):
    names = table(spark, d, "customer").select("c_custkey", F.concat(F.col("c_name"), F.lit(" & Söhne, Inc. www.x.com")).alias("business_name"), F.concat((F.col("c_custkey") % 90 + 1).cast("string"), F.lit(" 1/2 Oak Ave., near City Hall, 78701")).alias("business_address"), F.lit("US").alias("country"))
    return clean.preprocess(names)


@query("country_counts", "SELECT n_name AS country, count(*) AS n, count(DISTINCT c_mktsegment) AS segments FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def _(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    # nation is a fixed table of 25 rows
    return table(spark, d, "customer").join(F.broadcast(n), "c_nationkey").groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c_mktsegment").alias("segments"))


@query("pruned_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_orderkey BETWEEN 100 AND 5000 AND l_returnflag = 'R'")
def _(spark, d):
    return table(spark, d, "lineitem").where(F.col("l_orderkey").between(100, 5000) & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_quantity")


@query("hash_sample")
def _(spark, d):
    from ..operators.learn import hash_percent

    return table(spark, d, "customer").where(hash_percent(F.col("c_custkey"), 3, 1000) < 120).select("c_custkey")
