"""Input rows for the queries, derived from the whole given tables by SQL that both engines run.

The given tables hold no missing, malformed or padded values, so these are put in according to the
attributes of a row. No row is left out for that.
"""

# Orders as a raw file would hold them: every value a text, some of them unusable.
RAW_ORDERS = """
select
  cast(o_orderkey as string) as order_id,
  cast(o_custkey as string) as customer_id,
  case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'not_a_date'
       when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then null
       else cast(cast(o_orderdate as date) as string) end as day_text,
  case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then 'n/a'
       when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then null
       when o_orderpriority = '2-HIGH' and o_orderstatus = 'F' then '0'
       when o_orderpriority = '2-HIGH' and o_orderstatus = 'O' then concat('-', cast(cast(o_totalprice as decimal(18,2)) as string))
       when o_orderpriority = '2-HIGH' and o_orderstatus = 'P' then '123456789012345678901234567890'
       else cast(cast(o_totalprice as decimal(18,2)) as string) end as amount_text,
  case when o_orderstatus = 'F' then concat('  ', o_orderpriority, ' ')
       when o_orderstatus = 'O' then '   '
       when o_orderpriority = '3-MEDIUM' then null
       else o_orderpriority end as label_text
from {orders}
"""

# Order lines with a year, a place and a product, the detail of an apportionment.
LINE_DETAIL = """
select cast(year(o_orderdate) as int) as year, n_name as nation, p_brand as brand, cast(l_quantity as double) as quantity
from {lineitem}
join {orders} on l_orderkey = o_orderkey
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
join {part} on l_partkey = p_partkey
"""

# Coarse totals for it; the nations of one region have none, and the suppliers' balance is one total per
# nation that no order line takes up.
NATION_TOTALS = """
select cast(year(o_orderdate) as int) as year, n_name as nation, cast(o_totalprice as decimal(18,2)) as price
from {orders}
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
join {region} on n_regionkey = r_regionkey
where r_name <> 'ASIA'
union all
select 1990 as year, n_name as nation, cast(s_acctbal as decimal(18,2)) as price
from {supplier} join {nation} on s_nationkey = n_nationkey
"""

# Certificates in raw form.
CERTS_RAW = """
select
  case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'not_a_date'
       else cast(cast(o_orderdate as date) as string) end as fecha,
  concat('  ', s_name, ' ') as oficina_cf,
  case sr.r_name when 'AFRICA' then ' Buenos Aires' when 'AMERICA' then 'Córdoba ' when 'ASIA' then 'Santa Fe'
       when 'EUROPE' then 'Mendoza' else 'Salta' end as provincia,
  concat(cast(s_nationkey as string), '.0') as provincia_id,
  case when c_mktsegment = 'MACHINERY' and o_orderpriority = '1-URGENT' then '   '
       when c_mktsegment = 'MACHINERY' and o_orderpriority = '2-HIGH' then null
       else concat(' ', cn.n_name) end as pais_destino,
  case when c_mktsegment = 'HOUSEHOLD' then null else concat(cast(c_nationkey as string), '.0') end as pais_destino_id,
  case when cr.r_name = 'EUROPE' and c_mktsegment = 'BUILDING' then null
       else concat('N', lpad(cast(c_nationkey as string), 2, '0')) end as pais_destino_id_iso_3166_1,
  cr.r_name as continente,
  case p_type when 'PROMO' then 'Soja' when 'STANDARD' then ' Trigo ' when 'MEDIUM' then 'MAÍZ' when 'ECONOMY' then 'Limón'
       when 'LARGE' then 'Carne Bovina' else 'Grano de Maní Partido' end as mercaderia_certificada,
  concat(l_returnflag, '|', l_linestatus) as transporte,
  case when l_returnflag = 'R' and l_discount = 0 then concat('-', cast(cast(l_quantity as decimal(18,1)) as string))
       when l_returnflag = 'A' and l_tax = 0 then null
       else cast(cast(l_quantity as decimal(18,1)) as string) end as tn
from {lineitem}
join {orders} on l_orderkey = o_orderkey
join {customer} on o_custkey = c_custkey
join {nation} cn on c_nationkey = cn.n_nationkey
join {region} cr on cn.n_regionkey = cr.r_regionkey
join {part} on l_partkey = p_partkey
join {supplier} on l_suppkey = s_suppkey
join {nation} sn on s_nationkey = sn.n_nationkey
join {region} sr on sn.n_regionkey = sr.r_regionkey
"""

# Cells of the wide matrix: year, province, country and value.
MATRIX_CELLS = """
select cast(year(o_orderdate) as int) as y,
  case r_name when 'AFRICA' then 'buenos_aires' when 'AMERICA' then 'cordoba' when 'ASIA' then 'santa_fe'
       when 'EUROPE' then 'mendoza' else 'salta' end as province,
  lower(cn.n_name) as country,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as v
from {lineitem}
join {orders} on l_orderkey = o_orderkey
join {customer} on o_custkey = c_custkey
join {nation} cn on c_nationkey = cn.n_nationkey
join {supplier} on l_suppkey = s_suppkey
join {nation} sn on s_nationkey = sn.n_nationkey
join {region} on sn.n_regionkey = r_regionkey
group by 1, 2, 3
"""

# Readings in raw form: many per day and place, ordered by event.
WEATHER_RAW = """
select event_id,
  case when event_type = 'error' and value > 50 then 'no date' else cast(cast(ts as date) as string) end as date,
  case event_type when 'click' then 'buenos_aires' when 'purchase' then 'cordoba' when 'view' then ' Salta '
       when 'signup' then null else '   ' end as province,
  concat('-', cast(cast(value as decimal(18,2)) as string)) as latitude,
  cast(cast(value as decimal(18,2)) as string) as longitude,
  cast(cast(value as decimal(18,2)) as string) as temp_max_c,
  case when value > 10 then cast(cast(value - 10 as decimal(18,2)) as string) else 'low' end as temp_min_c,
  cast(user_id as string) as precipitation_mm,
  '12345.678' as wind_speed_max_kmh,
  '4.555' as evapotranspiration_mm
from {events}
"""

# Yearly figures per indicator and country, the records of the indicator payloads.
INDICATOR_VALUES = """
select concat('value of ', o_orderpriority) as indicator, o_orderpriority as indicator_code,
  n_name as country, case when n_name = 'NATION_0' then 'ARG' else n_name end as country_code,
  cast(year(o_orderdate) as int) as year,
  cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as amount
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
group by 1, 2, 3, 4, 5
"""
