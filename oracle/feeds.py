"""DuckDB text of the five RAW feeds; the rules are those of FIXTURES.md."""

GUESTS = """
select 'G'||c_custkey::varchar as guest_id, c_name as name,
  case when c_custkey%31=0 then '31/12/1980'
       else ((date '1950-01-01' + c_custkey * interval '7' day)::date)::varchar end as dob,
  case when c_custkey%2=0 then 'F' else 'M' end as gender,
  case when c_custkey%37=0 then 'not-an-email' when c_custkey%41=0 then null
       when c_custkey%43=0 then 'ab@x.com'
       else 'guest'||c_custkey::varchar||'@mail.example' end as email,
  '+1555'||(1000000+c_custkey)::varchar as phone,
  c_nationkey::varchar||' Main St' as address, n_name as city, r_name as country,
  case c_mktsegment when 'BUILDING' then 'Gold' when 'MACHINERY' then 'Silver' else 'Bronze' end
    as loyalty_tier,
  ((date '2018-01-01' + c_custkey * interval '1' day)::date)::varchar as registration_date
from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey
union all
select 'G'||c_custkey::varchar, c_name||' (dup)', null, null,
  'dup'||c_custkey::varchar||'@mail.example', null, null, null, null, 'Gold', null
from customer where c_custkey%20=0
union all select '  ', 'blank key', null, null, 'x@y.zz', null, null, null, null, null, null
union all select null, 'null key', null, null, 'x@y.zz', null, null, null, null, null, null
"""

ROOMS = """
select 'RM'||p_partkey::varchar as room_id, 'H'||(p_partkey%20)::varchar as hotel_id,
  p_type as room_type,
  case when p_partkey%29=0 then 'G' else p_size::varchar end as floor,
  case when p_partkey%53=0 then '0' when p_partkey%59=0 then '2.5'
       else (1+p_size%4)::varchar end as capacity,
  p_name as amenities,
  case p_partkey%3 when 0 then ' available' when 1 then 'OCCUPIED ' else 'out_of_order' end as status,
  case when p_partkey%61=0 then '-5'
       else (p_retailprice::decimal(10,2) - 850::decimal(10,2))::varchar end as base_price
from part
"""

RESERVATIONS = """
select 'RS'||o_orderkey::varchar as reservation_id,
  case when o_orderkey%101=0 then null when o_orderkey%97=0 then 'G999999999'
       else 'G'||o_custkey::varchar end as guest_id,
  'RM'||((o_orderkey*7+o_custkey)%(select count(*) from part))::varchar as room_id,
  case when o_orderkey%103=0 then '2025-02-30'
       else ((o_orderdate::date + interval '10400' day)::date)::varchar end as check_in_date,
  ((o_orderdate::date + (10400+o_orderkey%15) * interval '1' day)::date)::varchar as check_out_date,
  o_orderpriority as booking_channel,
  ((o_orderdate::date + (10400-o_custkey%60) * interval '1' day)::date)::varchar||' 09:30:00'
    as booking_time,
  case when o_orderstatus='P' and o_orderkey%4<>0 then
    case when o_custkey%10=0 and not (o_custkey%20=0 and o_orderkey%5=0)
         then '2026-03-01 '||lpad((o_orderkey%24)::varchar,2,'0')||':15:00'
         else ((o_orderdate::date + (10400-o_custkey%9) * interval '1' day)::date)::varchar||' 12:00:00'
    end end as cancellation_time,
  case when o_orderstatus='F' then ' confirmed ' when o_orderstatus='O' then 'CONFIRMED'
       when o_orderkey%4=0 then 'no_show' else 'Cancelled' end as status
from orders
union all
select 'RS'||o_orderkey::varchar, 'G'||o_custkey::varchar, 'RM0', '2025-01-01', '2025-01-03',
  'DUP', null, null, 'Confirmed'
from orders where o_orderkey%50=0
"""

HOUSEKEEPING = """
select 'HK'||event_id::varchar as task_id,
  case when event_id%89=0 then 'RM999999999'
       else 'RM'||((user_id*13+event_id)%(select count(*) from part))::varchar end as room_id,
  case when event_type in ('click','view') then ' cleaning'
       when event_type='error' then 'Maintenance' else 'inspection' end as task_type,
  'ST'||(user_id%25)::varchar as assigned_staff,
  case when event_id%67=0 then 'n/a' else date_trunc('second',ts)::varchar end as scheduled_time,
  (date_trunc('second',ts) + (event_id%30) * interval '1' minute)::varchar as start_time,
  case when event_id%23=0 then null
       when event_id%41=0 then (date_trunc('second',ts) - interval '1' day)::varchar
       else (date_trunc('second',ts) + (event_id%30) * interval '1' minute
             + floor(value*60)::bigint * interval '1' second)::varchar end as end_time,
  case when event_id%7=0 then 'y' when event_id%11=0 then null else 'N' end as issue_detected_flag,
  case when event_id%5=0 then 'IN PROGRESS' else 'completed ' end as status
from events
"""

BILLING = """
select 'BL'||o_orderkey::varchar as bill_id, 'RS'||o_orderkey::varchar as reservation_id,
  'G'||o_custkey::varchar as guest_id,
  case when o_orderkey%71=0 then 'abc' else (
    ((p_retailprice::decimal(10,2)-850) * (o_orderkey%15)::decimal(4,0)
     + (o_custkey%90)::decimal(6,2) - (o_custkey%40)::decimal(6,2)
     + case when o_orderkey%17=0 then 55.50 else 0.00 end)::decimal(12,2))::varchar end as total_amount,
  ((o_custkey%90)::decimal(10,2))::varchar as taxes,
  case when o_orderkey%73=0 then '-1' else ((o_custkey%40)::decimal(10,2))::varchar end as discounts,
  o_orderpriority as payment_mode,
  case when o_orderkey%19=0 then null
       else ((o_orderdate::date + interval '10400' day)::date)::varchar||' 18:45:30' end as payment_time,
  case when o_orderkey%13=0 then 'y ' else 'N' end as is_flagged
from (select *, (o_orderkey*7+o_custkey)%(select count(*) from part) as room from orders)
  join part on p_partkey=room
"""

FEEDS = {
    "guests": GUESTS,
    "reservations": RESERVATIONS,
    "rooms": ROOMS,
    "housekeeping": HOUSEKEEPING,
    "billing": BILLING,
}
