"""Raw-shaped tables derived from the driver's TPC-H-like tables.

Each rule is one SELECT that Spark and DuckDB both run, so a query and its oracle start from
the same rows. ``{name}`` refers to a driver table or to another rule. Order dates move ten
years on, so the years lie on both sides of the 2008/2009 change in the screening forms.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import keys
from ..operators.screening import (
    CODED_ITEMS,
    CONTINUOUS_ITEMS,
    DRINK_HABIT,
    DRINK_QUANTITY,
    FAMILY_ITEMS,
    GJ_ITEMS,
    HABIT_ITEMS,
    HISTORY_ITEMS,
)
from ..work import store

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_YMD = "replace(substring(cast({0} as string), 1, 10), '-', '')"
_DAY = "cast(cast(o_orderdate as date) + interval 10 year as date)"


def _screening_value(position: int, item: str) -> str:
    """A value per item and person-year, with some NULL, empty and odd texts."""
    if item in FAMILY_ITEMS:
        value = f"case when y <= 2008 then 1 + (c + {position}) % 2 else (c + {position}) % 2 end"
    elif item in (*HISTORY_ITEMS[3:],):
        value = f"(c + {position}) % 3"
    elif item in HISTORY_ITEMS[:3]:
        value = f"1 + (c + {position}) % 10"
    elif item in CODED_ITEMS:
        value = f"1 + (c + y + {position}) % 7"
    elif item in HABIT_ITEMS or item in (DRINK_HABIT, DRINK_QUANTITY):
        value = f"1 + (c * 3 + y + {position}) % 6"
    elif item in CONTINUOUS_ITEMS:
        value = f"(c + y * 3 + {position}) % 40"
    else:
        value = f"50 + (c * {position + 3} + y) % 100"
    odd = ""
    if item in ("WAIST", "BLDS"):
        odd = f"when (c * 7 + y + {position}) % 17 = 0 then '-5' "
    if item == "OLIG_PH":
        odd = "when c % 2 = 0 then '5.5' "
    return (
        f"case when (c + y + {position}) % 11 = 0 then null "
        f"when (c + y + {position}) % 13 = 0 then '' {odd}"
        f"else cast({value} as string) end as {item.lower()}"
    )


_GJ_COLUMNS = ",\n    ".join(_screening_value(i, item) for i, item in enumerate(GJ_ITEMS))

RULES: dict[str, str] = {
    "regions": """
select cast(11110 + 30 * n_nationkey as string) as code, r_name as province, n_name as district
from {nation} join {region} on n_regionkey = r_regionkey""",
    "person_years": f"""
select distinct o_custkey as c, cast(year({_DAY}) as int) as y from {{orders}}""",
    "jk": """
select c as person_id, y as stnd_y, cast(1 + c % 2 as int) as sex,
    cast(case when y = birth then 0
         else least(cast(floor((y - birth) / 5.0) as int) + 1, 18) end as int) as age_group,
    cast(11110 + 30 * (c % 27) as string) as sgg,
    cast(c % 5 as string) as ipsn_type_cd,
    case when (c + y) % 19 = 0 then '' else cast((c + y) % 12 as string) end as ctrb_pt_type_cd,
    case when c % 6 = 0 then cast(y % 3 as string) end as dfab_grd_cd,
    case when y <> last_y then ''
         when c % 51 = 6 then '199012'
         when c % 17 = 0 then cast(y as string) || lpad(cast(1 + c % 12 as string), 2, '0')
         when c % 17 = 2 then null
         else '' end as dth_ym,
    case when y = last_y and c % 17 in (0, 1, 2) then
         case c % 4 when 0 then 'A00-A09' when 1 then 'J46' when 2 then 'Z99'
              else 'K' || lpad(cast(c % 300 as string), 3, '0') end
         else '' end as dth_code1
from (select c, y, cast(1915 + (c * 13) % 97 as int) as birth,
             max(y) over (partition by c) as last_y
      from {person_years}) p
where y >= birth""",
    "t20": f"""
select o_orderkey as key_seq, o_custkey as person_id, {_YMD.format(_DAY)} as recu_fr_dt,
    case o_orderkey % 8 when 0 then '02' when 1 then '03' when 2 then '2' when 3 then '08'
         when 4 then '10' when 5 then 'ZZ' when 6 then '07' else '99' end as form_cd,
    case o_orderkey % 5 when 0 then '11' when 1 then '00' when 2 then '21' when 3 then '00'
         end as in_pat_cors_type,
    cast(o_orderkey % 7 as int) as vscn,
    cast(o_orderkey % 100 as int) as ykiho_id,
    'K' || lpad(cast(o_orderkey % 300 as string), 3, '0') as sub_sick,
    o_totalprice as dmd_tramt, o_totalprice * 0.9 as edec_tramt,
    o_totalprice * 0.7 as edec_jbrdn_amt, o_totalprice * 0.2 as edec_sbrdn_amt,
    case when o_orderkey % 10 = 0 then 'DRG' || cast(o_orderkey % 50 as string) end as dmd_drg_no
from {{orders}}""",
    "line_rows": f"""
select l_orderkey as key_seq, l_returnflag as flag, l_linenumber as n, l_suppkey as s,
    l_partkey as p, l_partkey % 400 as k, l_extendedprice as price, l_quantity as quantity,
    l_discount as discount, l_tax as tax, l_shipdate as shipdate, l_linestatus as status,
    {_DAY} as day
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "lines": """
select *, cast(row_number() over (partition by key_seq
    order by n, p, s, quantity, price, discount, tax, shipdate, flag, status) as int) as seq_no
from {line_rows}""",
    "charges": f"""
select key_seq, seq_no, flag, {_YMD.format("day")} as recu_fr_dt,
    'P' || lpad(cast(k as string), 4, '0')
        || case when k % 8 in (0, 1) and s % 2 = 1 then 'X' else '' end
        || case when n % 3 = 0 then '  ' else '' end as div_cd,
    cast(k % 8 + 1 as string) as div_type_cd,
    case n % 7 when 0 then null when 1 then '1' when 2 then '3' when 3 then 'abc'
        when 4 then '0' when 5 then '2.5' else '30' end as mdcn_exec_freq,
    case (n + s) % 5 when 0 then '1' when 1 then '2' when 2 then '0.5' when 3 then '-1'
        else '1d' end as dd_mqty_exec_freq,
    case s % 4 when 0 then '1' when 1 then '1.5' when 2 then case when n % 2 = 0 then '1,5' end
        else '1e1' end as dd_mqty_freq,
    case (n + k) % 4 when 0 then '1' when 1 then '3' when 2 then '' else '0.25' end
        as dd_exec_freq,
    case k % 4 when 0 then '3' when 1 then '03' when 2 then '4' else '04' end as clause_cd,
    case s % 6 when 0 then '1' when 1 then '01' when 2 then '2' when 3 then '02'
        when 4 then '03' end as item_cd,
    case when k % 50 = 7 then null when k % 50 = 15 then 0.0 else price end as amt,
    case when k % 50 = 23 then null when k % 50 = 31 then price * 2
        else price / quantity end as un_cost
from {{lines}}""",
    "t30_file": """
select key_seq, seq_no, recu_fr_dt, div_cd, div_type_cd, mdcn_exec_freq, dd_mqty_exec_freq,
    dd_mqty_freq, clause_cd, item_cd, amt, un_cost
from {charges} where flag = 'A'""",
    "t60_file": """
select key_seq, seq_no, recu_fr_dt, div_cd, div_type_cd, mdcn_exec_freq, dd_mqty_freq,
    dd_exec_freq, amt, un_cost
from {charges} where flag = 'R'""",
    "t40_file": f"""
select key_seq, seq_no,
    case when s % 97 = 5 then null else 'K' || lpad(cast(p % 300 as string), 3, '0')
        || case when n % 4 = 1 then ' ' else '' end end as sick_sym,
    case when s % 89 = 7 then '20089999'
         else {_YMD.format("cast(day + (n % 3) as date)")} end as recu_fr_dt
from {{lines}} where flag = 'N'""",
    # Trailing blanks do not count in comparisons: the plans normalise at load, the oracle here.
    "t30": """
select key_seq, seq_no, recu_fr_dt, rtrim(div_cd) as div_cd, div_type_cd, mdcn_exec_freq,
    dd_mqty_exec_freq, dd_mqty_freq, clause_cd, item_cd, amt, un_cost
from {t30_file}""",
    "t60": """
select key_seq, seq_no, recu_fr_dt, rtrim(div_cd) as div_cd, div_type_cd, mdcn_exec_freq,
    dd_mqty_freq, dd_exec_freq, amt, un_cost
from {t60_file}""",
    "t40": "select key_seq, seq_no, rtrim(sick_sym) as sick_sym, recu_fr_dt from {t40_file}",
    "yk_years": f"""
select distinct cast(o_orderkey % 100 as int) as ykiho_id, cast(year({_DAY}) as int) as stnd_y
from {{orders}}""",
    "yk": """
select ykiho_id, stnd_y, cast(10 + (ykiho_id * 7 + stnd_y) % 90 as string) as ykiho_gubun_cd,
    cast(ykiho_id % 15 as string) as org_type, cast(11 + ykiho_id % 9 as string) as ykiho_sido
from {yk_years}
union all
select ykiho_id, stnd_y, cast(10 + (ykiho_id * 7 + stnd_y) % 90 as string), '9',
    cast(11 + ykiho_id % 9 as string)
from {yk_years} where ykiho_id % 20 = 3
union all
select ykiho_id, stnd_y, cast(10 + (ykiho_id * 7 + stnd_y) % 90 as string),
    cast(ykiho_id % 15 as string), cast(11 + ykiho_id % 9 as string)
from {yk_years} where ykiho_id % 20 = 5""",
    "gj": f"""
select cast(y as string) as hchk_year, c as person_id, cast(10 + c % 80 as string) as ykiho_gubun_cd,
    {_GJ_COLUMNS}
from (select person_id as c, stnd_y as y from {{jk}}
      union all
      select person_id, max(stnd_y) + 2 from {{jk}} where person_id % 23 = 4 group by person_id) j
where (c + y) % 2 = 0""",
    "p_codes": "select distinct cast(p_partkey % 400 as int) as k from {part}",
    "k_codes": "select distinct cast(p_partkey % 300 as int) as j from {part}",
    # Targets of the P codes: domain by line type, second targets, the other of
    # procedure/device for ambiguous codes, an invalid relation and an invalid target.
    "p_targets": """
select k, kind, offset_id + k as target_id, relation_invalid, target_invalid from (
    select k, case when k % 8 in (0, 1, 5) then 'Procedure' when k % 8 in (2, 3, 4) then 'Drug'
                   else 'Device' end as kind,
        case when k % 8 in (0, 1, 5) then 3000000 when k % 8 in (2, 3, 4) then 1000000
             else 4000000 end as offset_id,
        cast(null as string) as relation_invalid, '' as target_invalid
    from {p_codes} where k % 10 <> 9
    union all
    select k, case when k % 8 in (0, 1, 5) then 'Procedure' when k % 8 in (2, 3, 4) then 'Drug'
                   else 'Device' end,
        case when k % 8 in (0, 1, 5) then 3100000 when k % 8 in (2, 3, 4) then 1100000
             else 4100000 end, '', cast(null as string)
    from {p_codes} where k % 10 in (0, 1)
    union all
    select k, case when k % 8 in (0, 1) then 'Device' else 'Procedure' end,
        case when k % 8 in (0, 1) then 4200000 else 3200000 end, '', ''
    from {p_codes} where k % 10 in (4, 5, 6, 7) and k % 8 in (0, 1, 6, 7)
    union all
    select k, 'Drug', 1500000, '', cast(null as string) from {p_codes} where k % 40 = 13
    union all
    select k, 'Drug', 1300000, 'D', '' from {p_codes} where k % 10 = 8
    union all
    select k, 'Drug', 1400000, '', 'U' from {p_codes} where k % 10 = 2
) t""",
    "k_targets": """
select j, kind, offset_id + j as target_id from (
    select j, 'Condition' as kind, 5000000 as offset_id from {k_codes} where j % 10 < 8
    union all
    select j, 'Condition', 5100000 from {k_codes} where j % 10 in (0, 1)
    union all
    select j, 'Observation', 6000000 from {k_codes} where j % 10 in (1, 8)
) t""",
    "raw_concept": """
select cast(concept_id as int) as concept_id, concept_name, domain_id, vocabulary_id,
    concept_class_id, standard_concept, concept_code, cast('1970-01-01' as date) as valid_start_date,
    cast(case when concept_id % 7 = 0 then '2015-06-30' else '2099-12-31' end as date)
        as valid_end_date,
    invalid_reason
from (
    select 100000 + k as concept_id, 'charge ' || cast(k as string) as concept_name,
        'Observation' as domain_id, 'EDI' as vocabulary_id, 'EDI Code' as concept_class_id,
        '' as standard_concept, 'P' || lpad(cast(k as string), 4, '0') as concept_code,
        '' as invalid_reason
    from {p_codes}
    union all
    select 200000 + j, 'diagnosis ' || cast(j as string), 'Condition', 'KCD7', 'KCD7 code', '',
        'K' || lpad(cast(j as string), 3, '0'), cast(null as string)
    from {k_codes}
    union all
    select target_id, kind || ' ' || cast(target_id as string), kind,
        case when kind = 'Drug' then 'RxNorm' else 'SNOMED' end,
        case when kind = 'Drug' then 'Clinical Drug' else 'Clinical Concept' end, 'S',
        'T' || cast(target_id as string), target_invalid
    from {p_targets}
    union all
    select target_id, kind || ' ' || cast(target_id as string), kind, 'SNOMED', 'Clinical Finding',
        'S', 'T' || cast(target_id as string), ''
    from {k_targets}
    union all
    select distinct 2000000 + k % 20, 'ingredient ' || cast(k % 20 as string), 'Drug',
        case when k % 20 = 19 then 'ATC' when k % 2 = 0 then 'RxNorm' else 'RxNorm Extension' end,
        'Ingredient', 'S', 'I' || cast(k % 20 as string), ''
    from {p_codes}
) c""",
    "raw_relationship": """
select cast(concept_id_1 as int) as concept_id_1, cast(concept_id_2 as int) as concept_id_2,
    relationship_id, cast('1970-01-01' as date) as valid_start_date,
    cast('2099-12-31' as date) as valid_end_date, invalid_reason
from (
    select 100000 + k as concept_id_1, target_id as concept_id_2, 'Maps to' as relationship_id,
        relation_invalid as invalid_reason
    from {p_targets}
    union all
    select 200000 + j, target_id, 'Maps to', '' from {k_targets}
    union all
    select 200000 + j, 200000 + j, 'Is a', '' from {k_codes}
) r""",
    "ancestor": """
select cast(ancestor_concept_id as int) as ancestor_concept_id,
    cast(descendant_concept_id as int) as descendant_concept_id
from (
    select 2000000 + k % 20 as ancestor_concept_id, target_id as descendant_concept_id
    from {p_targets} where kind = 'Drug'
    union all
    select 2000000 + (k + 7) % 20, target_id from {p_targets} where kind = 'Drug' and k % 40 = 3
    union all
    select target_id, target_id from {p_targets} where kind = 'Drug'
) a""",
    # Vocabulary after normalisation, in plain SQL for the oracle.
    "concept": """
select concept_id, concept_name, lower(domain_id) as domain_id, vocabulary_id, concept_class_id,
    nullif(standard_concept, '') as standard_concept, concept_code, valid_start_date,
    valid_end_date, nullif(invalid_reason, '') as invalid_reason
from {raw_concept}""",
    "relationship": """
select concept_id_1, concept_id_2, relationship_id, valid_start_date, valid_end_date,
    nullif(invalid_reason, '') as invalid_reason
from {raw_relationship}""",
}


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"{(\w+)}", sql)))


# Rules that are written once per session and folder, so queries start at a Parquet scan.
# The intermediate rules are read by these only.
STORED = ("jk", "t20", "lines", "yk", "gj", "raw_concept", "raw_relationship", "ancestor")
NORMALISED = ("t30", "t40", "t60")
KEYED = {"k30": (keys.TREATMENT, "t30"), "k40": (keys.DIAGNOSIS, "t40"),
         "k60": (keys.PRESCRIPTION, "t60")}
YEARLY = {"seq_gj": (keys.SCREENING, "gj", "hchk_year"),
          "seq_jk": (keys.ELIGIBILITY, "jk", "stnd_y")}

LINE_ORDER = ["n", "p", "s", "quantity", "price", "discount", "tax", "shipdate", "flag", "status"]
# Columns of the rule that only order the lines.
ORDER_ONLY = ["discount", "tax", "shipdate", "status"]
#: An order of more lines is not sorted by one task.
LARGE_ORDER = 100_000
#: Orders are counted in so many groups first.
GROUPS = 1 << 16

_tables: dict[tuple[str, str, str], DataFrame] = {}


def large_orders(lineitem: DataFrame, large: int) -> DataFrame | None:
    """(key_seq) of the orders of more than ``large`` lines; None if there are none.

    An order is not larger than a group of orders, so orders are counted only in groups beyond that.
    """
    group = F.pmod(F.xxhash64("l_orderkey"), F.lit(GROUPS)).alias("_group")
    ordered = lineitem.select("l_orderkey", group)
    groups = ordered.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") > large)
    crowded = store(groups.select("_group"), "large-groups")
    if crowded.isEmpty():
        return None
    orders = ordered.join(F.broadcast(crowded), "_group", "left_semi").groupBy("l_orderkey")
    beyond = orders.agg(F.count("*").alias("_n")).where(F.col("_n") > large)
    beyond = store(beyond.select(F.col("l_orderkey").alias("key_seq")), "large-orders")
    return None if beyond.isEmpty() else beyond


def numbered_lines(rows: DataFrame, lineitem: DataFrame, large: int = LARGE_ORDER) -> DataFrame:
    """The rule's window: rows move once, by order, with their header and for their place in it.

    Orders of more than ``large`` lines are ranked over many tasks instead.
    """
    beyond = large_orders(lineitem, large)
    place = F.row_number().over(Window.partitionBy("key_seq").orderBy(*LINE_ORDER))
    if beyond is None:
        return rows.withColumn("seq_no", place).drop(*ORDER_ONLY)
    out = rows.join(beyond, "key_seq", "left_anti").withColumn("seq_no", place)
    ranked = keys.ranked_within(rows.join(beyond, "key_seq", "left_semi"), "key_seq", LINE_ORDER, "seq_no")
    return out.unionByName(ranked).drop(*ORDER_ONLY)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw-shaped table over ``folder``, built on first use."""
    from ..operators.vocab import normalise_vocabulary
    from ..sources import loader

    key = (spark.sparkContext.applicationId, folder, name)
    if key in _tables:
        return _tables[key]
    if name in DRIVER_TABLES:
        df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    elif name == "lines":
        rows, lineitem = (table(spark, folder, part) for part in ("line_rows", "lineitem"))
        # By flag, so that each kind of line, a projection of these, reads its own.
        numbered = numbered_lines(rows, lineitem).sortWithinPartitions("flag", "key_seq", "seq_no")
        df = store(numbered, "raw-lines", ("flag",))
    elif name in KEYED:
        source, lines = KEYED[name]
        df = keys.keyed_lines(
            table(spark, folder, lines), table(spark, folder, "t20"), source
        )
    elif name in YEARLY:
        source, rows, year = YEARLY[name]
        df = keys.yearly_master(table(spark, folder, rows), year, source)
    elif name == "seq":
        df = keys.seq_master(
            *(table(spark, folder, part) for part in ("k30", "k40", "k60", "seq_gj", "seq_jk"))
        )
    elif name in NORMALISED:
        df = loader.normalise_strings(table(spark, folder, f"{name}_file"))
    elif name in ("concept", "relationship"):
        df = store(normalise_vocabulary(table(spark, folder, f"raw_{name}")), name)
    else:
        sql = RULES[name]
        inputs = {ref: table(spark, folder, ref) for ref in references(sql)}
        if name == "line_rows":
            inputs["orders"] = keys.unsent(inputs["orders"])
        df = spark.sql(sql, **inputs)
        if name in STORED:
            df = store(df, f"raw-{name}")
    _tables[key] = df
    return df


def forget() -> None:
    """Drop the memory of built tables (the files stay until the cluster clears its folder)."""
    _tables.clear()
