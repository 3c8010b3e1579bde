"""Join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.scalars import many_summary, slice_filter, slice_keys
from entry_queries.tables import table
from regweave.functions import digits_only
from regweave.operators.joins import Right, left_join, lookup, normalised_key_join, semi_join
from regweave.operators.relational import prefixed, renamed


# At least nine digits, never cut; valid in Spark SQL and in DuckDB.
_PADDED_KEY = (
    "lpad(cast(o_custkey as string), cast(greatest(9, length(cast(o_custkey as string))) as int), '0')"
)


def semi_parent(spark, sf_dir):
    return semi_join(table(spark, sf_dir, "customer"), "c_custkey", slice_keys(spark, sf_dir), "o_custkey")


# Keys that match nothing for some rows; valid in Spark SQL and in DuckDB.
_RICH_NATION = (
    "case when c_mktsegment = 'BUILDING' and c_acctbal > 9000 then c_nationkey else -1 end"
)
_SOLVENT_KEY = "case when c_acctbal >= 0 then c_custkey else -1 - c_custkey end"
_SOLVENT_NAME = "case when c_acctbal >= 0 then c_name else concat(c_name, '/9') end"


def semi_lookup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(f"{_RICH_NATION} as c_nationkey")
    return semi_join(table(spark, sf_dir, "nation"), "n_nationkey", customers, "c_nationkey")


def left_parent(spark, sf_dir):
    parents = renamed(
        table(spark, sf_dir, "customer").withColumn("c_custkey", F.expr(_SOLVENT_KEY)),
        {"c_custkey": "o_custkey", "c_name": "c_name", "c_nationkey": "c_nationkey"},
    )
    return left_join(table(spark, sf_dir, "orders"), "o_custkey", [Right(parents)])


def left_lookup(spark, sf_dir):
    # The code comes from the left join before, so it is NULL for unmatched orders.
    return lookup(
        left_parent(spark, sf_dir), "c_nationkey",
        table(spark, sf_dir, "nation"), "n_nationkey", "n_name", "nation_name",
    )


def registry_enrich(spark, sf_dir):
    fact = slice_filter(spark, sf_dir).withColumn("registry_key", F.expr(_PADDED_KEY))
    named = table(spark, sf_dir, "customer").withColumn("c_name", F.expr(_SOLVENT_NAME))
    registry = prefixed(named, "reg_", ["c_name", "c_mktsegment"], keep=["c_name"])
    joined = normalised_key_join(fact, "registry_key", registry, digits_only("c_name"))
    return joined.drop("c_name")


def summary_enrich(spark, sf_dir):
    summary = many_summary(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    return left_join(table(spark, sf_dir, "orders"), "o_orderkey", [Right(summary, unique=True)])


def dependents_of_slice(spark, sf_dir):
    return semi_join(
        table(spark, sf_dir, "lineitem"), "l_orderkey", slice_filter(spark, sf_dir), "o_orderkey"
    )


QUERIES = {
    "semi_parent": semi_parent,
    "semi_lookup": semi_lookup,
    "left_parent": left_parent,
    "left_lookup": left_lookup,
    "registry_enrich": registry_enrich,
    "summary_enrich": summary_enrich,
    "dependents_of_slice": dependents_of_slice,
}

ORACLES = {
    "semi_parent": """
        select * from customer
        where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')""",
    "semi_lookup": f"""
        select * from nation where n_nationkey in (select {_RICH_NATION} from customer)""",
    "left_parent": f"""
        select o.*, c.c_name, c.c_nationkey
        from orders o left join customer c on o_custkey = {_SOLVENT_KEY}""",
    "left_lookup": f"""
        select o.*, c.c_name, c.c_nationkey, n.n_name as nation_name
        from orders o left join customer c on o_custkey = {_SOLVENT_KEY}
        left join nation n on c.c_nationkey = n.n_nationkey""",
    "registry_enrich": f"""
        select {_PADDED_KEY} as registry_key, o.*,
               c.c_name as reg_c_name, c.c_mktsegment as reg_c_mktsegment
        from orders o left join (select * replace ({_SOLVENT_NAME} as c_name) from customer) c
          on {_PADDED_KEY} = regexp_replace(c_name, '[^0-9]', '', 'g')
        where o_orderstatus = 'F'""",
    "summary_enrich": """
        select o.*, s.n_lines, s.n_r, s.n_a, s.first_ship, s.last_ship
        from orders o left join (
            select l_orderkey, count(*) as n_lines,
                   cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as n_r,
                   cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as n_a,
                   min(l_shipdate) as first_ship, max(l_shipdate) as last_ship
            from lineitem group by l_orderkey) s on o_orderkey = s.l_orderkey""",
    "dependents_of_slice": """
        select l.* from lineitem l
        where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')""",
}
