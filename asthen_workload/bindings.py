"""The shared test tables, dressed up as the raw tables of the pipelines.

Each base view is one SQL text that Spark and the oracle both run, so the two sides
start from the same rows; `{name}` is a test table or another base view. The views give
every row its identity, time and value from the test table and plant the known defects
by rule: padding, casing, blanks, copies, late syncs, unmatched codes, deletions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Schemas are stated, so that no job runs just to infer them.
TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
}

# A home that depends on the person only; a few are blank or unknown to the register.
_HOME = """case when {id} % 97 = 0 then null when {id} % 101 = 0 then 'DW-unknown'
            else 'DW-' || cast({id} % (select count(*) from {{part}}) as string) end"""

BASE = {
    "dwellings": """
        select 'DW-' || cast(p_partkey as string) as dwelling_id,
               cast(case when p_partkey % 61 = 0 then -1
                    else p_partkey % (select count(*) from {supplier}) end as int) as level_number,
               cast(p_partkey as int) as unit_number,
               case p_size % 4 when 0 then 'STANDARD' when 1 then ' family ' when 2 then 'Single'
                    else 'DORMITORY' end as dwelling_type,
               cast(case p_size % 4 when 0 then 3 when 1 then 5 when 2 then 1 else 12 end as int) as capacity
        from {part}""",
    "residents": f"""
        with versions as (
            select *, 0 as copy from {{customer}}
            union all select *, 1 as copy from {{customer}} where c_custkey % 40 = 0
            union all select *, 2 as copy from {{customer}} where c_custkey % 120 = 7
        )
        select 'RES-' || cast(c_custkey as string) as resident_id,
               case when c_custkey % 9 = 0 then '  ' else ' ' || c_mktsegment end as given_name,
               case when c_custkey % 7 = 0 then '' else c_name end as family_name,
               cast(date '1955-01-01' + cast(c_custkey % 20000 as int) as date) as birth_date,
               {_HOME.format(id='c_custkey')} as dwelling_id,
               case when copy > 0 then 'Deceased'
                    when c_custkey % 20 < 8 then 'active' when c_custkey % 20 < 11 then 'Active'
                    when c_custkey % 20 < 13 then 'ACTIVE' when c_custkey % 20 = 13 then ' active '
                    when c_custkey % 20 < 16 then 'deceased' when c_custkey % 20 = 16 then 'Deceased'
                    when c_custkey % 20 = 17 then 'RELOCATED' when c_custkey % 20 = 18 then ''
                    else 'unregistered' end as status,
               {{ntz}} '1994-06-01 08:00:00' + interval '1' day * cast(c_custkey % 1500 as int)
                    as registered_at,
               {{ntz}} '2001-01-01 00:00:00' + interval '1' day * cast(c_custkey % 200 as int)
                    as updated_at,
               case when copy = 2 then null
                    else {{ntz}} '2001-01-01 00:00:00' + interval '1' day * cast(c_custkey % 200 - copy as int)
                         + interval '1' minute * cast(c_custkey % 90 + 1 as int) end as _synced_at,
               case when c_custkey % 67 = 0 then copy = 0
                    when c_custkey % 5 = 0 then null else false end as _deleted
        from versions""",
    "relocations": f"""
        select 'REL-' || cast(o_orderkey as string) as relocation_id,
               'RES-' || cast(o_custkey as string) as resident_id,
               {_HOME.format(id='o_custkey')} as from_dwelling_id,
               case when o_orderkey % 53 = 0 then null
                    else 'DW-' || cast((o_orderkey * 31 + 7) % (select count(*) from {{part}}) as string)
                    end as to_dwelling_id,
               o_orderdate as relocated_at,
               case o_orderpriority when '1-URGENT' then ' sanction ' when '2-HIGH' then null
                    when '3-MEDIUM' then 'Family' when '4-NOT SPECIFIED' then 'WORK ASSIGNMENT'
                    else '' end as reason
        from {{orders}}""",
    "departments": """
        select 'D' || cast(s_suppkey as string) as department_code,
               ' ' || s_name || ' ' as department_name,
               s_nationkey as home_level,
               cast(s_suppkey % 25 as int) as establishment_headcount
        from {supplier}""",
    # Two codes more than there are departments.
    "job_assignments": """
        select 'JOB-' || cast(o_orderkey as string) as assignment_id,
               'RES-' || cast(o_custkey as string) as resident_id,
               case when o_orderkey % 3 = 0 then ' d' else 'D' end
                    || cast((o_custkey + o_orderkey % 2) % (select count(*) + 2 from {supplier}) as string)
                    || ' ' as department_code,
               case o_orderpriority when '5-LOW' then 'Shadow' when '4-NOT SPECIFIED' then ' '
                    else 'Clerk' end as role_title,
               case o_orderkey % 4 when 0 then 'DAY' when 1 then ' swing' when 2 then 'Night '
                    else '' end as shift_code,
               case when o_orderkey % 211 = 0 then null else o_orderdate end as started_at,
               case when o_orderstatus <> 'F' then case when o_orderkey % 2 = 0 then '' else '  ' end
                    else cast(o_orderdate + interval '1' day * cast(o_orderkey % 400 - 5 as int) as string)
                    end as ended_at,
               case o_orderstatus when 'F' then 'ENDED' when 'O' then ' Active ' else 'active' end as status,
               o_orderdate + interval '1' day as updated_at
        from {orders}""",
    "equipment": """
        select 'EQ-' || cast(p_partkey as string) as equipment_id,
               case when p_partkey % 31 = 0 then ' ' else p_name end as equipment_name,
               cast((p_partkey * 7 + 3) % (select count(*) + 1 from {supplier}) as int) as level_number,
               case p_type when 'LARGE' then 'critical ' when 'MEDIUM' then 'HIGH' when 'SMALL' then ' Medium'
                    when 'ECONOMY' then 'LOW' when 'STANDARD' then 'unrated' else null end as criticality,
               cast(date '1990-01-01' + p_size as date) as installed_on
        from {part}""",
    # Each reading as sent once.
    "reading_feed": """
        select event_id as n,
               'RD-' || cast(event_id as string) as reading_id,
               case event_id % 3 when 0 then event_type when 1 then upper(event_type)
                    else ' ' || event_type || ' ' end as generator_id,
               ts as read_at,
               case when event_id % 333 = 0 then case when event_id % 2 = 0 then '' else ' ' end
                    when event_id % 250 = 0 then '-' || cast(value + 1 as string)
                    else ' ' || cast(value as string) end as output_kw,
               cast(cast(value as decimal(8,2)) + cast(40 as decimal(4,2)) as decimal(8,2)) as temperature_c,
               cast(cast(event_id % 5001 as decimal(8,3)) * cast(0.001 as decimal(4,3)) as decimal(8,3))
                    as vibration_mm_s,
               case when event_id % 4 = 0 then null else event_id % 10 = 1 end as is_manual_entry,
               case when event_id % 200 = 0 then ts + interval '1' day * cast(2 + event_id / 200 % 8 as int)
                    else ts + interval '1' minute * cast(event_id % 55 + 1 as int) end as _synced_at
        from {events}""",
    # With second syncs: later ones that corrected the output, and older stray ones.
    "generator_readings": """
        select reading_id, generator_id, read_at, output_kw, temperature_c, vibration_mm_s,
               is_manual_entry, _synced_at from {reading_feed}
        union all
        select reading_id, generator_id, read_at, '77.25' as output_kw, temperature_c, vibration_mm_s,
               is_manual_entry, _synced_at + interval '1' hour as _synced_at
        from {reading_feed} where n % 50 = 0
        union all
        select reading_id, generator_id, read_at, '-1' as output_kw, temperature_c, vibration_mm_s,
               is_manual_entry, _synced_at - interval '1' second as _synced_at
        from {reading_feed} where n % 75 = 1""",
    "maintenance_orders": """
        select 'MO-' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as order_id,
               'EQ-' || cast(l_partkey as string) as equipment_id,
               ' d' || cast(l_suppkey % 27 as string) as department_code,
               l_shipdate as opened_at,
               case when l_linestatus = 'O' then case when l_linenumber % 2 = 0 then '' else ' ' end
                    else cast(l_shipdate + interval '1' hour * cast(l_partkey % 200 - 20 as int) as string)
                    end as closed_at,
               case l_returnflag when 'A' then 'p1' when 'N' then ' P2 ' else '' end as priority,
               case l_linestatus when 'O' then 'Open ' else 'closed' end as status,
               case when l_linestatus = 'O' then '' else ' ' || cast(l_quantity as string) end as labour_hours
        from {lineitem}""",
    "level_zones": """
        select cast(s_suppkey as int) as level_number, ' ' || r_name as zone_name, r_regionkey as supply_tier,
               case when s_suppkey % 12 = 0 then true when s_suppkey % 5 = 0 then null else false end
                    as has_lift_access
        from {supplier} join {nation} on s_nationkey = n_nationkey
             join {region} on n_regionkey = r_regionkey""",
    # Two states of the assignments: what had started by a day, and the table some time
    # later, where rows have appeared, changed in place (some without a new change time)
    # and gone.
    "assignments_before": """
        select 'JOB-' || cast(o_orderkey as string) as assignment_id,
               'RES-' || cast(o_custkey as string) as resident_id,
               o_orderstatus as status, o_orderdate as updated_at
        from {orders} where o_orderdate < {ntz} '2000-06-01 00:00:00'""",
    "assignments_after": """
        select 'JOB-' || cast(o_orderkey as string) as assignment_id,
               'RES-' || cast(o_custkey as string) as resident_id,
               case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'changed' else o_orderstatus end
                    as status,
               case when o_orderpriority = '1-URGENT' then o_orderdate + interval '30' day else o_orderdate end
                    as updated_at
        from {orders} where not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')""",
}

RAW_TABLES = ("dwellings", "residents", "relocations", "departments", "job_assignments", "equipment",
              "generator_readings", "maintenance_orders")

# Months covered by the test tables.
LO, HI = "1995-01-01", "2001-08-01"

_REF = re.compile(r"\{(\w+)\}")


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(r for r in _REF.findall(sql) if r != "ntz"))


class Tables:
    """Base views over one directory of test tables, each built once when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in TEST_TABLES:
                reader = self.spark.read.schema(TEST_TABLES[name])
                self._built[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                sql = BASE[name].replace("{ntz}", "timestamp_ntz")
                self._built[name] = self.spark.sql(sql, **{r: self[r] for r in references(sql)})
        return self._built[name]


def stream_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The same views over the events read as a file stream."""
    tables = Tables(spark, sf_dir)
    reader = spark.readStream.schema(TEST_TABLES["events"]).option("pathGlobFilter", "events*.parquet")
    tables._built["events"] = reader.parquet(sf_dir)
    return tables
