"""Scalar functions and single-table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.tables import table
from regweave.functions import blank_to_null, composite_key, digits_only, phone_number
from regweave.operators.quality import duplicate_keys, require_slice, validation_report
from regweave.operators.relational import (
    bounded_count,
    distinct_keys,
    slice_equal,
    summarise_many,
    total_count,
)
from regweave.operators.selection import (
    first_of_split_families,
    latest_release,
    select_files,
    sorted_names,
)

# Planted text, valid in Spark SQL and in DuckDB.
_PADDED_PART = (
    "case when p_size < 10 then '   ' when p_size < 20 then ''"
    " when p_size < 25 then chr(9) when p_size < 30 then null"
    " else concat('  ', p_name, ' ') end"
)
_AREA = (
    "case c_mktsegment when 'BUILDING' then ' 27 ' when 'FURNITURE' then '   '"
    " when 'MACHINERY' then null else '28' end"
)
_NUMBER = (
    "case when c_acctbal < 0 then null when c_acctbal < 2000 then '  '"
    " else concat(' ', cast(c_custkey as string)) end"
)
_LABEL = (
    "case o_orderstatus when 'P' then concat(substr(cast(o_orderdate as string), 1, 7), '-tmp')"
    " when 'O' then substr(cast(o_orderdate as string), 1, 4)"
    " else substr(cast(o_orderdate as string), 1, 7) end"
)
_FILE_NAME = (
    "case p_type when 'ECONOMY' then concat('Empresas', cast(p_partkey as string), '.zip')"
    " when 'LARGE' then concat('Estabelecimentos', cast(p_size as string), '.zip')"
    " when 'MEDIUM' then concat('Socios', cast(p_partkey as string), '.zip')"
    " when 'SMALL' then case when p_size < 10 then 'Simples.zip' when p_size < 20 then 'Cnaes.zip'"
    " when p_size < 30 then 'Naturezas.zip' else 'Municipios.zip' end"
    " when 'PROMO' then concat('Motivos', cast(p_size as string), '.zip')"
    " else concat('Empresas', p_name, '.zip') end"
)


def slice_filter(spark, sf_dir):
    return slice_equal(table(spark, sf_dir, "orders"), "o_orderstatus", "F")


def slice_keys(spark, sf_dir):
    return distinct_keys(slice_filter(spark, sf_dir), "o_custkey")


def many_summary(spark, sf_dir):
    return summarise_many(
        table(spark, sf_dir, "lineitem"),
        key="l_orderkey",
        kind="l_returnflag",
        kinds={"n_r": "R", "n_a": "A"},
        date="l_shipdate",
        count_as="n_lines",
        first_as="first_ship",
        last_as="last_ship",
    )


def global_count(spark, sf_dir):
    return total_count(table(spark, sf_dir, "lineitem"), "n_rows")


def bounded_row_count(spark, sf_dir):
    return bounded_count(table(spark, sf_dir, "lineitem"), 1000, "n_rows")


def report(spark, sf_dir):
    return validation_report(
        slice_filter(spark, sf_dir), table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    )


def checked_report(spark, sf_dir):
    return require_slice(report(spark, sf_dir), "F")


def duplicates(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", count_as="copies")


def composite(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    flag = F.nullif("l_returnflag", F.lit("N"))
    line_key = composite_key(F.col("l_orderkey").cast("string"), flag, F.col("l_linenumber").cast("string"))
    return lines.select("l_orderkey", "l_linenumber", "l_returnflag", line_key.alias("line_key"))


def blanks(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", blank_to_null(F.expr(_PADDED_PART)).alias("text")
    )


def phones(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", phone_number(F.expr(_AREA), F.expr(_NUMBER)).alias("phone")
    )


def digits(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", digits_only("c_name").alias("digits"))


def newest_release(spark, sf_dir):
    labelled = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_LABEL).alias("label"))
    return latest_release(labelled, "label")


def _file_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.expr(_FILE_NAME).alias("name"))


def manifest(spark, sf_dir):
    return select_files(_file_names(spark, sf_dir), "name", partners=True)


def manifest_without_partners(spark, sf_dir):
    return select_files(_file_names(spark, sf_dir), "name", partners=False)


def manifest_test_profile(spark, sf_dir):
    return first_of_split_families(manifest(spark, sf_dir), "name")


def listing(spark, sf_dir):
    return sorted_names(_file_names(spark, sf_dir), "name")


QUERIES = {
    "slice_filter": slice_filter,
    "slice_keys": slice_keys,
    "many_summary": many_summary,
    "total_count": global_count,
    "bounded_count": bounded_row_count,
    "validation_report": report,
    "validation_check": checked_report,
    "duplicate_keys": duplicates,
    "composite_key": composite,
    "blank_to_null": blanks,
    "phone_format": phones,
    "digits_only": digits,
    "latest_release": newest_release,
    "manifest_selection": manifest,
    "manifest_without_partners": manifest_without_partners,
    "manifest_test_profile": manifest_test_profile,
    "sorted_listing": listing,
}

_REPORT = """
select (select count(*) from (select 1 from orders where o_orderstatus = 'F' limit 1000)) as slice_rows,
       (select count(*) from (select 1 from customer limit 1000)) as company_rows,
       (select count(*) from part) as activity_rows
"""
_FAMILY = """
case when regexp_full_match(name, 'Empresas[0-9]+[.]zip') then 'empresas'
     when regexp_full_match(name, 'Estabelecimentos[0-9]+[.]zip') then 'estabelecimentos'
     when regexp_full_match(name, 'Socios[0-9]+[.]zip') then 'socios'
     when name = 'Simples.zip' then 'simples' when name = 'Cnaes.zip' then 'cnaes'
     when name = 'Naturezas.zip' then 'naturezas' when name = 'Municipios.zip' then 'municipios' end
"""
_MANIFEST = f"""
select name, {_FAMILY} as family
from (select {_FILE_NAME} as name from part) as files where {_FAMILY} is not null
"""

ORACLES = {
    "slice_filter": "select * from orders where o_orderstatus = 'F'",
    "slice_keys": "select distinct o_custkey from orders where o_orderstatus = 'F'",
    "many_summary": """
        select l_orderkey, count(*) as n_lines,
               cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as n_r,
               cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as n_a,
               min(l_shipdate) as first_ship, max(l_shipdate) as last_ship
        from lineitem group by l_orderkey""",
    "total_count": "select count(*) as n_rows from lineitem",
    "bounded_count": "select count(*) as n_rows from (select 1 from lineitem limit 1000)",
    "validation_report": _REPORT,
    "validation_check": _REPORT,
    "duplicate_keys": """
        select l_orderkey, count(*) as copies from lineitem
        where l_orderkey is not null group by l_orderkey having count(*) > 1""",
    "composite_key": """
        select l_orderkey, l_linenumber, l_returnflag,
               cast(l_orderkey as varchar)
               || case when l_returnflag is null or l_returnflag = 'N' then '' else l_returnflag end
               || cast(l_linenumber as varchar) as line_key
        from lineitem""",
    "blank_to_null": f"""
        select p_partkey, case when trim(v, ' ') = '' then null else trim(v, ' ') end as text
        from (select p_partkey, {_PADDED_PART} as v from part)""",
    "phone_format": f"""
        select c_custkey,
               case when number is null then null when area is null then number
                    else '(' || area || ') ' || number end as phone
        from (select c_custkey,
                     case when trim({_AREA}, ' ') = '' then null else trim({_AREA}, ' ') end as area,
                     case when trim({_NUMBER}, ' ') = '' then null else trim({_NUMBER}, ' ') end as number
              from customer)""",
    "digits_only": "select c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') as digits from customer",
    "latest_release": f"""
        with labelled as (select o_orderkey, {_LABEL} as label from orders)
        select * from labelled where label = (
            select max(label) from labelled where regexp_full_match(label, '[0-9]{{4}}-[0-9]{{2}}'))""",
    "manifest_selection": _MANIFEST,
    "manifest_without_partners": f"select * from ({_MANIFEST}) where family <> 'socios'",
    "manifest_test_profile": f"""
        with m as ({_MANIFEST}), r as (
            select name, family, row_number() over (partition by family order by name) as place
            from (select distinct name, family from m))
        select name, family from r
        where place = 1 or family not in ('empresas', 'estabelecimentos', 'socios')""",
    "sorted_listing": f"select distinct {_FILE_NAME} as name from part order by name",
}
