"""Parcels, cases and regions derived from the driver's customer, orders and nation tables.

Each view is one SELECT that both Spark and the checking engine can run; ``{days}`` is the only part
where the two differ. Every source row becomes a row of a view: nothing is filtered out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_DAYS = "datediff(o_orderdate, date '1970-01-01')"

PARCELS = """
select c_custkey as seq, lpad(cast(c_custkey as string), 10, '0') as ain_1,
  case when c_custkey % 9 = 4 then '' when c_custkey % 9 <> 5 then 'APN-' || cast(c_custkey as string) end as apn_1,
  case when c_custkey % 4 <> 1 then cast(c_custkey as string) || ' ' || c_mktsegment || ' ST' end as situsfulladdress,
  case when c_custkey % 3 <> 1 then cast(c_custkey as string) || ' SHORT ST' end as situsaddress,
  case c_custkey % 7 when 0 then 'Destroyed (>50%)' when 1 then 'Destroyed (>50%)' when 2 then 'Major (26-50%)'
    when 3 then 'Minor (10-25%)' when 4 then 'Affected (1-9%)' when 5 then 'No Damage' end as damage_1,
  case c_custkey % 5 when 0 then 'Red' when 1 then 'Red ' when 2 then 'Yellow' when 3 then 'Green' end as bsd_tag,
  case when c_nationkey % 2 = 0 then 'Single' else 'Multiple' end as usedescription,
  case c_custkey % 11 when 0 then null when 1 then '0210' when 2 then '0601' else '0130' end as designtype1,
  cast(800 + c_custkey % 2400 as double) as sqftmain1,
  case c_custkey % 6 when 0 then '0120' when 1 then '0300' end as designtype2,
  case when c_custkey % 6 = 0 and c_custkey % 24 <> 0 or c_custkey % 6 = 1
    then cast(400 + c_custkey % 500 as double) end as sqftmain2,
  case c_custkey % 13 when 0 then ' Issued ' when 1 then '  ' when 2 then 'Final' end as permit_status,
  case c_custkey % 8 when 0 then 'Yes' when 1 then '' end as roe_status,
  case c_custkey % 10 when 3 then 'Cleared' end as debris_cleared,
  case c_custkey % 4 when 0 then '2' when 1 then '1' when 2 then 'x' end as dins_count,
  cast(c_custkey * 7919 % 10500 as double) / 1000 as cx,
  cast(c_custkey * 104729 % 10000 as double) / 1000 as cy
from {customer}
"""

CASES = """
with k as (
 select o_orderkey as seq,
  case when o_orderkey % 50 = 49 or o_custkey % 10 = 0 then '9' else '0' end
    || lpad(cast(o_custkey as string), 9, '0') as main_ain,
  case when o_orderkey % 29 <> 0 then 'CASE' || lpad(cast(o_orderkey as string), 10, '0') end as casenumber,
  case when o_orderkey % 3 = 0 then 'PlanManagement' else 'PermitManagement' end as modulename,
  case when o_orderkey % 3 = 0 then 'Rebuild'
       else case o_orderkey % 4 when 0 then 'New' when 1 then 'Rebuild Project'
            when 2 then 'Express Temporary Housing' else 'Repair/Replacement' end end as workclass_name,
  case when o_orderkey % 23 <> 0 then o_orderkey % 7 + 1 end as rebuild_progress_num,
  case when o_orderkey % 17 <> 0 then cast({days} as double) * 86400000 end as apply_date,
  case o_orderkey % 5 when 0 then 'Like-for-Like Rebuild' when 1 then 'Non-Like-for-Like Rebuild'
       when 2 then 'Rebuild SB-9 lot' when 3 then '' end as project_name,
  case when o_orderkey % 31 = 0 then 'sb 9 pathway' when o_orderkey % 31 = 1 then 'LOT SPLIT' end as projectname,
  case when o_orderkey % 37 <> 0 then 'PRJ' || cast(o_orderkey as string) end as project_number,
  case o_orderstatus when 'F' then 'Finaled' when 'O' then 'Issued' end as status,
  case when o_orderkey % 13 <> 0 then 'Eaton Fire (01-2025)' end as disaster_type,
  case when o_orderkey % 19 < 10 then 1 else 0 end as new_dwelling_units,
  cast(floor(o_orderkey / 12.0) as bigint) % 20 as tpl,
  cast(500 + o_orderkey % 3000 as string) as sz, cast(300 + o_orderkey % 700 as string) as sz2
 from {orders})
select *, case tpl
 when 0 then 'EATON FIRE REBUILD - NEW 1-STORY ' || sz || ' S.F. SINGLE FAMILY RESIDENCE WITH 102 S.F. PORCH'
 when 1 then 'EATON FIRE LIKE FOR LIKE REBUILD - (N) ' || sz || ' SF SFD (4 BED)'
 when 2 then '1. NEW ' || sz || ' SF SFR' || chr(10) || '2. NEW ' || sz2 || ' SF ADU'
 when 3 then 'NEW 2-STORY ' || sz || ' SF SB9 (2 BEDROOMS) WITH 464 SF ATTACHED GARAGE'
 when 4 then 'NON-LIKE-FOR-LIKE NEW ' || sz || ' SF DUPLEX'
 when 5 then 'WITH 524 SF ATTACHED GARAGE WITH 270 SF PATIO NEW ' || sz || '-square-foot single-family residence'
 when 6 then 'EATON FIRE TEMPORARY HOUSING (RV)'
 when 7 then 'KITCHEN REMODEL ' || sz || ' SQ. FT.'
 when 8 then 'EATON FIRE REBUILD - rebuild project'
 when 9 then 'PREAMBLE' || chr(10) || '1. NEW ' || sz2 || ' SF JADU' || chr(10) || ' 2. DETACHED GARAGE'
 when 10 then '   '
 when 11 then '1. NEW ' || sz2 || ' SF ADU' || chr(10) || '2. NEW ' || sz2 || ' SF ADU'
 when 12 then '1. NEW ' || sz2 || ' SF ADU' || chr(10) || '2. NEW ' || sz2 || ' SF ADU' || chr(10) || '3. NEW 640 SF ADU'
 when 14 then 'DETACHED ' || sz2 || ' SF ADU BEHIND EXISTING SFD'
 when 15 then 'SEISMIC RETROFIT AND GRADING'
 when 16 then 'NEW RETAINING WALL, ' || sz2 || ' SQFT CARPORT'
 when 17 then '1. NEW 1,' || sz2 || ' SQUARE FEET TRIPLEX' || chr(13) || chr(10) || '2. RV PAD'
 when 18 then 'JUNIOR ADU ' || sz2 || ' S.F. OVER GARAGE'
 when 19 then 'EATON FIRE - SENATE BILL 9 LOT, ' || sz || ' SQ FT, CARPORT'
 end as description from k
"""

REGIONS = """
select n_nationkey as idx, lpad(cast(n_nationkey as string), 6, '0') as ct20, n_name as label,
 cast((n_nationkey % 5) * 2 as double) as x0, cast((n_nationkey - n_nationkey % 5) / 5 * 2 as double) as y0,
 cast((n_nationkey % 5) * 2 + 2 as double) as x1, cast((n_nationkey - n_nationkey % 5) / 5 * 2 + 2 as double) as y1
from {nation}
"""

SUBREGIONS = f"""
select idx * 4 + q as idx, ct20 || cast(q as string) as bg20, ct20, label,
 x0 + q % 2 as x0, y0 + (q - q % 2) / 2 as y0, x0 + q % 2 + 1 as x1, y0 + (q - q % 2) / 2 + 1 as y1
from (select *, explode(array(0, 1, 2, 3)) as q from ({REGIONS}) r) s
"""

# What a chat model answered for a parcel: well-formed, fenced, malformed and missing replies.
REPLIES = """
select lpad(cast(c_custkey as string), 10, '0') as ain, c_custkey % 10 as form, a, b,
 100 + c_custkey % 50 as input_tokens, 20 + c_custkey % 30 as output_tokens,
 case c_custkey % 10
 when 0 then '{{"structures":[{{"struct_type":"sfr","sqft":' || a || ',"confidence":"high",'
   || '"evidence_case_numbers":["C1",""],"notes":null}}],"reasoning":"one house"}}'
 when 1 then 'Here it is:' || chr(10) || '```json' || chr(10)
   || '{{"structures":[{{"struct_type":"JADU","sqft":' || b || ',"confidence":"medium","notes":"inside"}},'
   || '{{"struct_type":"adu","sqft":' || b || ',"confidence":"high"}}],"reasoning":"two units"}}' || chr(10) || '```'
 when 2 then 'I cannot tell.'
 when 3 then '[1, 2]'
 when 4 then '{{"structures":"none","reasoning":"nothing filed"}}'
 when 5 then '{{"structures":[{{"struct_type":"barn","sqft":"' || a || '","confidence":"sure"}}]}}'
 when 6 then '{{"structures":[{{"struct_type":"MFR","sqft":' || a || '.7,"confidence":"Medium"}},5],"reasoning":""}}'
 when 7 then '  {{"structures":[{{"struct_type":"sfr","sqft":null,"confidence":"low"}},'
   || '{{"struct_type":"adu","sqft":640}}],"reasoning":"' || repeat('long ', 40) || '"}}  '
 when 8 then '```' || chr(10) || '{{"structures":[}}' || chr(10) || '```'
 end as content
from (select c_custkey, cast(700 + c_custkey % 2500 as string) as a, cast(300 + c_custkey % 600 as string) as b
      from {customer}) t
"""

def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed ring of an axis-parallel rectangle, as the only ring of a geometry struct."""
    corners = ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    return _geometry([F.array(x, y) for x, y in corners])


def _geometry(points: list[Column]) -> Column:
    return F.struct(F.array(F.array(*points)).alias("rings"))


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcel rows with a square of side 0.008 around (cx, cy) as geometry."""
    df = spark.sql(PARCELS, customer=_read(spark, sf_dir, "customer"))
    cx, cy = F.col("cx"), F.col("cy")
    return df.withColumn(
        "geometry", rectangle(cx - 0.004, cy - 0.004, cx + 0.004, cy + 0.004)
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = CASES.replace("{days}", SPARK_DAYS)
    return spark.sql(sql, orders=_read(spark, sf_dir, "orders"))


def _boxed(df: DataFrame) -> DataFrame:
    box = rectangle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return df.withColumnRenamed("idx", "region_idx").withColumn("geometry", box)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxed(spark.sql(REGIONS, nation=_read(spark, sf_dir, "nation")))


def subregions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxed(spark.sql(SUBREGIONS, nation=_read(spark, sf_dir, "nation")))


def stretched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions at twice their place and size: some lie beyond the box of all parcels."""
    r = spark.sql(REGIONS, nation=_read(spark, sf_dir, "nation"))
    return _boxed(r.withColumns({c: 2 * F.col(c) for c in ("x0", "y0", "x1", "y1")}))


def wedges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-left half of every region's rectangle: its box is larger than the polygon itself."""
    r = regions(spark, sf_dir)
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    return r.withColumn(
        "geometry", _geometry([F.array(x0, y0), F.array(x1, y0), F.array(x0, y1)])
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REPLIES, customer=_read(spark, sf_dir, "customer"))
