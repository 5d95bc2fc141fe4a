"""The driver's tables in the shapes of the domain, for the registered queries.

One SQL text gives the same frames in Spark and in DuckDB; the words in braces
are where the two dialects differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {"ts": "timestamp_ntz", "serial": "cast(datediff(d, date'1899-12-30') as string)", "plus": "date_add(date'2012-01-01', cast({n} as int))", "chr": "char"}
DUCK = {"ts": "timestamp", "serial": "cast(date_diff('day', date '1899-12-30', d) as string)", "plus": "(date '2012-01-01' + cast({n} as integer))", "chr": "chr"}

_KIDS = """
  select o_orderkey as k, o_custkey as c, o_orderstatus as st, cast(o_orderdate as date) as d,
    substr(cast(cast(o_orderdate as date) as string), 1, 4) as yy, substr(cast(cast(o_orderdate as date) as string), 6, 2) as mm,
    substr(cast(cast(o_orderdate as date) as string), 9, 2) as dd
  from orders"""

_CHILDREN = """
  select 'R' || cast(k as string) as child_record_id, 'S' || cast(c % 25 as string) as school_id,
    case when k % 2 = 0 then 'baseline' else 'endline' end as period,
    case when k % 10 < 2 then null when k % 20 = 7 then cast(c as string) else lpad(cast(c * 7 + k % 3 as string), 12, '0') end as lrn_clean,
    case when k % 13 = 0 then 'CHILD ' || cast(c % 97 as string) || ' JR' else 'CHILD ' || cast(c % 97 as string) end as student_name_clean,
    'C' as first_letter_name,
    case when k % 37 = 0 then null else yy || '-' || mm || '-' || dd end as birthday_str,
    case when st = 'F' then 'Female' when st = 'O' then 'Male' end as sex,
    cast(k % 6 + 1 as string) as grade, 'run' as run_id, 'F' || cast(k % 60 as string) as source_file_id,
    cast(k % 1000 as bigint) as source_row_number,
    '{{"Date of Birth":"' || case k % 8 when 0 then yy || '-' || mm || '-' || dd when 1 then mm || '/' || dd || '/' || yy when 2 then dd || '/' || mm || '/' || yy
      when 3 then {serial} when 4 then yy || '-' || mm || '-' || dd || ' 00:00:00' when 5 then dd || '-' || mm || '-' || yy when 6 then 'not a date' else '' end
      || '","School":"School ' || case when k % 60 < 3 then 'X' else cast(c % 25 as string) end || '"}}' as raw_payload_json
  from kids"""

_MEASURED = """
  select 'M' || cast(k as string) as measurement_id, 'R' || cast(k as string) as child_record_id, 'S' || cast(c % 25 as string) as school_id,
    case when k % 2 = 0 then 'baseline' else 'endline' end as period,
    cast(case when k % 50 = 0 then '1999-01-01' when k % 2 = 0 then '2024-09-10' else '2025-04-05' end as {ts}) as measurement_date,
    cast(k % 12 as double) as age_years,
    case when k % 19 = 0 then null when k % 101 = 0 then cast(300 as double) else cast(100 + c % 60 as double) + cast(k % 10 as double) / 10 end as height_cm,
    case when k % 23 = 0 then null when k % 103 = 0 then cast(5 as double) else cast(15 + c % 40 as double) + cast(k % 5 as double) / 4 end as weight_kg
  from kids"""

_SCHOOLS = """
  select 'S' || cast(x as string) as school_id, 'School ' || cast(x as string) as school_name, 'D' || cast(x % 3 as string) as division,
    'M' || cast(x % 5 as string) as municipality, 'B' || cast(x as string) as barangay, case when x % 2 = 0 then 'urban' else 'rural' end as urban_rural,
    cast(x % 2 as bigint) as treatment_status, cast(null as string) as matched_pair_id
  from (select distinct c_custkey % 25 as x from customer) s"""

_ALLOCATIONS = """
  select 'S' || cast(x as string) as school_id, '2024-2025' as school_year, cast(200 + x * 10 as double) as allocated_children,
    case when x % 7 = 0 then null else cast(180 + x * 13 as double) end as current_enrollment,
    case when x % 4 = 0 then null else cast(x % 4 as double) end as delivery_tranche_count
  from (select distinct c_custkey % 25 as x from customer) s"""

_FILES = """
  select 'F' || cast(x as string) as source_file_id, 'S' || cast(x % 25 as string) as school_id_guess,
    case when x % 2 = 0 then 'baseline' else 'endline' end as period_guess,
    cast(case when x % 6 = 0 then '2024-11-20' when x % 6 = 3 then '2025-06-01' else '2024-09-01' end as {ts}) as modified_at
  from (select distinct c_custkey % 60 as x from customer) s"""

_DRIFT = """
  select 'F' || cast(r_regionkey as string) as source_file_id, 'school_submission' as dataset, r_name as column_name_raw,
    case when r_regionkey % 2 = 0 then 'missing_required' else 'unmapped' end as drift_type, lower(r_name) as mapped_to
  from region"""

_PERSON = """
  select c_custkey as k, {chr}(cast(65 + c_custkey % 26 as int)) || upper(c_name) as n, c_nationkey as s, {born} as d
  from customer"""

_BASELINE = """
  select 'B' || cast(k as string) as child_record_id, 'baseline' as period, 'S' || cast(s as string) as school_id,
    case when k % 10 < 3 then null else lpad(cast(k as string), 12, '0') end as lrn_clean, n as student_name_clean, substr(n, 1, 1) as first_letter_name,
    cast(d as string) as birthday_str, case when k % 2 = 0 then 'Male' else 'Female' end as sex
  from person"""

_ENDLINE = """
  select 'E' || cast(k as string) as child_record_id, 'endline' as period, case when k % 33 = 0 then 'S' || cast(s + 1 as string) else 'S' || cast(s as string) end as school_id,
    case when k % 10 in (3, 4) then null when k % 50 = 9 then lpad(cast(k + 1 as string), 12, '0') else lpad(cast(k as string), 12, '0') end as lrn_clean,
    case when k % 20 < 9 then substr(n, 1, 8) || substr(n, 10, 1) || substr(n, 9, 1) || substr(n, 11) else n end as student_name_clean, substr(n, 1, 1) as first_letter_name,
    case when k % 7 = 0 then substr(cast(d as string), 1, 8) || substr(cast(d as string), 10, 1) || substr(cast(d as string), 9, 1) else cast(d as string) end as birthday_str,
    case when k % 29 = 0 then null when k % 2 = 0 then 'Male' else 'Female' end as sex
  from person"""

VIEWS = {"kids": _KIDS, "child_records": _CHILDREN, "measurements": _MEASURED, "schools": _SCHOOLS, "raw_allocations": _ALLOCATIONS, "file_manifest": _FILES, "schema_drift": _DRIFT, "person": _PERSON, "wave_b": _BASELINE, "wave_e": _ENDLINE}


def _text(sql: str, dialect: dict[str, str]) -> str:
    return sql.format(ts=dialect["ts"], serial=dialect["serial"], chr=dialect["chr"], born=dialect["plus"].format(n="c_custkey % 3000"))


#: The frames as common table expressions of DuckDB.
CTES = "with " + ",\n".join(f"{name} as ({_text(sql, DUCK)})" for name, sql in VIEWS.items())


def load(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named frames, lazy, as Spark plans over the parquet tables."""
    known = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "region")}
    out: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name in known:
            return known[name]
        if name not in out:
            sql = _text(VIEWS[name], SPARK).replace("{", "\x00").replace("}", "\x01")
            for source in (*VIEWS, *known):
                if f"from {source}" in sql:
                    get(source)
                    sql = sql.replace(f"from {source}", "from {%s}" % source)
            sources = {x: get(x) for x in (*VIEWS, *known) if "{%s}" % x in sql}
            out[name] = spark.sql(sql.replace("\x00", "{{").replace("\x01", "}}"), **sources)
        return out[name]

    return {n: get(n) for n in names}
