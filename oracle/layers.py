"""DuckDB text of every layer, as named blocks that refer to each other."""

from __future__ import annotations

import re

from innlake.sources.schemas import RAW_COLUMNS
from oracle.feeds import FEEDS

AS_OF = "timestamp '2024-02-01 00:00:00'"
CHANGED_AT = "timestamp '2024-02-02 00:00:00'"
NO_TIME = "cast(null as timestamp)"

KEYS = {
    "guests": "guest_id",
    "reservations": "reservation_id",
    "rooms": "room_id",
    "housekeeping": "task_id",
    "billing": "bill_id",
}
COLUMNS = {domain: list(columns) for domain, columns in RAW_COLUMNS.items()}
UPDATES = {
    "guests": ("loyalty_tier", "email"),
    "reservations": ("status", "cancellation_time"),
    "rooms": ("status", "base_price"),
    "housekeeping": ("status", "end_time"),
    "billing": ("is_flagged",),
}


# ---- scalar expressions -----------------------------------------------------

def day(c: str) -> str:
    return rf"case when regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}}') then try_cast({c} as date) end"


def moment(c: str) -> str:
    return rf"case when regexp_matches({c}, '^\s*\d{{4}}-\d{{2}}-\d{{2}}') then try_cast({c} as timestamp) end"


def whole(c: str) -> str:
    return f"try_cast({c} as decimal(38,0))"


def money(c: str, p: int, s: int = 2) -> str:
    return f"try_cast({c} as decimal({p},{s}))"


def yes(c: str) -> str:
    return f"coalesce(upper(trim({c})) = 'Y', false)"


def cap(x: str) -> str:
    stop = r'\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>'
    words = f"regexp_extract_all(lower({x}), '[{stop}]+|[^{stop}]+')"
    # DuckDB knows a capital sharp s, full Unicode case mapping spells it SS
    capital = "replace(upper(substring(w,1,1)), 'ẞ', 'SS')"
    return f"list_aggregate(list_transform({words}, lambda w: {capital}||substring(w,2)), 'string_agg', '')"


def ymd(c: str) -> str:
    return f"cast(strftime({c}, '%Y%m%d') as integer)"


def pct(a: str, b: str) -> str:
    return f"cast(round(cast({a}/nullif({b},0) as decimal(18,6))*100, 2) as double)"


def mean(a: str, b: str) -> str:
    return f"cast(round(cast({a}/nullif({b},0) as decimal(18,6)), 2) as double)"


def per(a: str, b: str) -> str:
    return f"cast(round(cast({a}/nullif({b},0) as decimal(30,8)), 2) as double)"


def number(*keys: str) -> str:
    """Row number in order of the key's hash."""
    text = "concat_ws('|', " + ", ".join(f"coalesce({k}, '')" for k in keys) + ")"
    return f"row_number() over (order by md5({text}), {', '.join(k + ' nulls first' for k in keys)})"


CASTS = {
    "guests": {"dob": day("dob"), "registration_date": day("registration_date")},
    "reservations": {
        "check_in_date": day("check_in_date"),
        "check_out_date": day("check_out_date"),
        "booking_time": moment("booking_time"),
        "cancellation_time": moment("cancellation_time"),
        "status": cap("trim(status)"),
    },
    "rooms": {
        "floor": whole("floor"),
        "capacity": whole("capacity"),
        "status": cap("trim(status)"),
        "base_price": money("base_price", 10),
    },
    "housekeeping": {
        "task_type": "upper(trim(task_type))",
        "scheduled_time": moment("scheduled_time"),
        "start_time": moment("start_time"),
        "end_time": moment("end_time"),
        "issue_detected_flag": yes("issue_detected_flag"),
        "status": cap("trim(status)"),
    },
    "billing": {
        "total_amount": money("total_amount", 12),
        "taxes": money("taxes", 10),
        "discounts": money("discounts", 10),
        "payment_time": moment("payment_time"),
        "is_flagged": yes("is_flagged"),
    },
}
BATCH_RULES = {
    "guests": "email like '%@%.%'",
    "reservations": "check_out_date > check_in_date",
    "rooms": "capacity > 0 and base_price >= 0",
    "housekeeping": "end_time is null or end_time >= start_time",
    "billing": "total_amount >= 0 and taxes >= 0 and discounts >= 0",
}
MERGE_RULES = {
    "guests": "email like '%@%.%'",
    "reservations": "check_out_date > check_in_date",
    "rooms": "capacity > 0",
    "housekeeping": "true",
    "billing": "total_amount >= 0",
}
REDELIVERED = {
    "guests": (
        {"loyalty_tier": "'Platinum'"},
        {"loyalty_tier": "'Diamond'", "email": "'new.'||email"},
    ),
    "reservations": (
        {"status": "' CANCELLED'", "cancellation_time": "check_out_date||' 08:00:00'"},
        {"status": "'checked-in'", "cancellation_time": "null"},
    ),
    "rooms": (
        {"status": "'under repair'", "base_price": "'-7'"},
        {"status": "'AVAILABLE'", "base_price": "'99.99'"},
    ),
    "housekeeping": (
        {"status": "'completed'", "end_time": "null"},
        {"status": "'re-opened'", "end_time": "start_time"},
    ),
    "billing": ({"is_flagged": "'Y'"}, {"is_flagged": "'n'"}),
}


def _typed(domain: str) -> str:
    casts = CASTS[domain]
    return ", ".join(f"{casts[c]} as {c}" if c in casts else c for c in COLUMNS[domain])


def _pick_one(domain: str, first: str = "") -> str:
    key = KEYS[domain]
    order = ", ".join(f"{c} asc nulls first" for c in COLUMNS[domain] if c != key)
    return f"qualify row_number() over (partition by {key} order by {first}{order}) = 1"


def _delivery(domain: str, arrival: int, values: dict[str, str], rows: str = "") -> str:
    picked = ", ".join(f"{values[c]} as {c}" if c in values else c for c in COLUMNS[domain])
    return f"select {picked}, {arrival} as arrival from {rows or f'raw_{domain}'}"


def _source(domain: str, changes: str, rules: dict[str, str] = MERGE_RULES) -> str:
    return (
        f"select * from (select {_typed(domain)}, arrival from {changes} where {KEYS[domain]} is not null)"
        f" where {rules[domain]} {_pick_one(domain, 'arrival desc, ')}"
    )


def _merged(domain: str, target: str, source: str) -> str:
    key = KEYS[domain]

    def cell(c: str) -> str:
        if c == key:
            return f"coalesce(t.{c}, s.{c}) as {c}"
        if c in UPDATES[domain]:
            return f"if(s.{key} is null, t.{c}, s.{c}) as {c}"
        return f"if(t.{key} is null, s.{c}, t.{c}) as {c}"

    cells = ", ".join(cell(c) for c in COLUMNS[domain])
    return f"select {cells} from {target} t full join {source} s on t.{key} = s.{key}"


def _landed(domain: str, rows: str, more: str = "") -> str:
    """Blanks cut and null tokens removed, as a CSV loader leaves a field."""
    cells = ", ".join(
        f"if(trim({c}) in ('NULL', 'null', ''), null, trim({c})) as {c}" for c in COLUMNS[domain]
    )
    return f"select {cells}{more} from {rows}"


def _deduped(domain: str, rows: str) -> str:
    key = KEYS[domain]
    return f"select {_typed(domain)} from (select * from {rows} where trim({key}) <> '' {_pick_one(domain)})"


BLOCKS: dict[str, str] = {}
for _d, _feed in FEEDS.items():
    BLOCKS |= {
        f"raw_{_d}": _feed,
        f"one_{_d}": _deduped(_d, f"raw_{_d}"),
        f"val_{_d}": f"select * from one_{_d} where {BATCH_RULES[_d]}",
        f"chg_{_d}": " union all ".join([
            _delivery(_d, 1, REDELIVERED[_d][0]),
            _delivery(_d, 2, REDELIVERED[_d][1]),
            _delivery(_d, 2, {KEYS[_d]: f"{KEYS[_d]}||'-N'"}),
        ]),
        f"src_{_d}": _source(_d, f"chg_{_d}"),
        f"mrg_{_d}": _merged(_d, f"val_{_d}", f"src_{_d}"),
        # through CSV files, in three deliveries
        f"landed_{_d}": _landed(_d, f"raw_{_d}"),
        f"landed_one_{_d}": _deduped(_d, f"landed_{_d}"),
        f"landed_val_{_d}": f"select * from landed_one_{_d} where {BATCH_RULES[_d]}",
        f"landed_chg_{_d}": _landed(_d, f"chg_{_d}", ", arrival"),
        f"second_{_d}": _source(_d, f"(from landed_chg_{_d} where arrival = 1)"),
        f"third_{_d}": _source(_d, f"(from landed_chg_{_d} where arrival = 2)"),
        f"after_second_{_d}": _merged(_d, f"landed_val_{_d}", f"second_{_d}"),
        f"after_third_{_d}": _merged(_d, f"after_second_{_d}", f"third_{_d}"),
        # the same under the batch rules
        f"strict_second_{_d}": _source(_d, f"(from landed_chg_{_d} where arrival = 1)", BATCH_RULES),
        f"strict_third_{_d}": _source(_d, f"(from landed_chg_{_d} where arrival = 2)", BATCH_RULES),
        f"after_strict_second_{_d}": _merged(_d, f"landed_val_{_d}", f"strict_second_{_d}"),
        f"after_strict_third_{_d}": _merged(_d, f"after_strict_second_{_d}", f"strict_third_{_d}"),
        # both deliveries in one batch, the later one counts
        f"uniq_{_d}": f"select * from raw_{_d} where trim({KEYS[_d]}) <> '' {_pick_one(_d)}",
        f"uniq_chg_{_d}": " union all ".join([
            _delivery(_d, 1, REDELIVERED[_d][0], f"uniq_{_d}"),
            _delivery(_d, 2, REDELIVERED[_d][1], f"uniq_{_d}"),
            _delivery(_d, 2, {KEYS[_d]: f"{KEYS[_d]}||'-N'"}, f"uniq_{_d}"),
        ]),
        f"landed_uniq_chg_{_d}": _landed(_d, f"uniq_chg_{_d}", ", arrival"),
        f"by_time_{_d}": _source(_d, f"landed_uniq_chg_{_d}"),
        f"after_by_time_{_d}": _merged(_d, f"landed_val_{_d}", f"by_time_{_d}"),
    }

BLOCKS |= {
    "dim_hotel": "select hotel_id, 'Unknown' as hotel_name, 'Unknown' as region from val_rooms group by hotel_id",
    "dim_guest": f"""
        select {number('guest_id')} as guest_sk, * exclude (address), {AS_OF} as effective_from,
          {NO_TIME} as effective_to, true as is_current
        from val_guests""",
    "dim_room": f"""
        select {number('room_id')} as room_sk, *, {AS_OF} as effective_from,
          {NO_TIME} as effective_to, true as is_current
        from val_rooms""",
    "dim_date": f"""
        select {ymd('d')} as date_sk, d as full_date, cast(year(d) as integer) as year,
          cast(month(d) as integer) as month, cast(day(d) as integer) as day,
          cast(quarter(d) as integer) as quarter, left(dayname(d),3) as day_name,
          dayofweek(d) in (0,6) as is_weekend
        from (select date '2020-01-01' + cast(i as integer) as d from range(3650) r(i))""",
    "stays": f"""
        select reservation_id, guest_sk, room_sk, {ymd('check_in_date')} as check_in_date_sk,
          {ymd('check_out_date')} as check_out_date_sk, booking_channel, booking_time,
          cancellation_time, v.status, date_diff('day', check_in_date, check_out_date) as length_of_stay,
          coalesce(v.status = 'Cancelled', false) as is_cancelled,
          coalesce(v.status = 'No_Show', false) as is_no_show
        from val_reservations v left join dim_guest using (guest_id) left join dim_room using (room_id)""",
    "tasks": """
        select task_id, room_sk, task_type, assigned_staff, scheduled_time, start_time, end_time,
          date_diff('minute', start_time, end_time) as duration_minutes, issue_detected_flag, v.status
        from val_housekeeping v left join dim_room using (room_id)""",
    "bills": """
        select bill_id, reservation_id, guest_sk, total_amount, taxes, discounts,
          cast(total_amount - discounts as decimal(13,2)) as net_revenue, payment_mode, payment_time,
          is_flagged
        from val_billing left join dim_guest using (guest_id)""",
    # anomalies
    "double_booking": """
        select 'DOUBLE_BOOKING' as rule_name, a.reservation_id as entity_id,
          concat('Overlaps with ', b.reservation_id, ' on room_sk ', a.room_sk) as details
        from (from stays where not is_cancelled) a, (from stays where not is_cancelled) b
        where b.room_sk = a.room_sk and b.reservation_id <> a.reservation_id
          and b.check_in_date_sk < a.check_out_date_sk and a.check_in_date_sk < b.check_out_date_sk""",
    "hk_sla_breach": """
        select 'HK_SLA_BREACH' as rule_name, task_id as entity_id,
          format('Cleaning took {} mins (SLA: 120 mins)', duration_minutes) as details
        from tasks where duration_minutes > 120 and task_type = 'CLEANING' and status = 'Completed'""",
    "overdue": f"""
        select *, date_diff('hour', end_time, {AS_OF}) as age
        from tasks where issue_detected_flag and status = 'Completed'
          and date_diff('hour', end_time, {AS_OF}) > 24""",
    "maintenance_overdue": """
        select 'MAINTENANCE_OVERDUE' as rule_name, task_id as entity_id,
          format('Issue unresolved — overdue by {}h', age) as details from overdue""",
    "maintenance_followup": """
        select 'MAINTENANCE_OVERDUE' as rule_name, task_id as entity_id,
          format('Issue unresolved — overdue by {}h', age) as details
        from overdue o where not exists (
          from tasks f where f.room_sk = o.room_sk and f.task_type = 'MAINTENANCE'
            and f.start_time between o.end_time and o.end_time + interval 24 hour)""",
    "billing_mismatch": """
        select 'BILLING_MISMATCH' as rule_name, bill_id as entity_id,
          concat('Billed $', total_amount, ' vs expected $', expected) as details
        from (
          select bill_id, total_amount,
            cast(base_price * length_of_stay::decimal(8,0) + taxes - discounts as decimal(20,2)) as expected
          from bills join stays using (reservation_id) join dim_room using (room_sk))
        where total_amount - expected not between -10 and 10""",
    "suspicious_cancellation": """
        select 'SUSPICIOUS_CANCELLATION' as rule_name, cast(guest_sk as varchar) as entity_id,
          format('{} cancellations within 24h', n) as details
        from (select guest_sk, count(*) as n, min(cancellation_time) as lo, max(cancellation_time) as hi
              from stays where is_cancelled and cancellation_time is not null group by guest_sk)
        where n > 3 and date_diff('hour', lo, hi) <= 24""",
    "cancellation_sliding": """
        select 'SUSPICIOUS_CANCELLATION' as rule_name, cast(guest_sk as varchar) as entity_id,
          format('{} cancellations within 24h', max(n)) as details
        from (select guest_sk, count(*) over (partition by guest_sk order by cancellation_time
                range between interval 24 hour preceding and current row) as n
              from stays where is_cancelled and cancellation_time is not null)
        group by guest_sk having max(n) > 3""",
    "findings": " union all ".join(
        f"select rule_name, entity_id, details from {r}" for r in (
            "double_booking", "hk_sla_breach", "maintenance_overdue", "billing_mismatch",
            "suspicious_cancellation")),
    "anomaly_log": f"""
        select {number('rule_name', 'entity_id', 'details')} as anomaly_id, *, {AS_OF} as detected_at
        from findings""",
    # KPIs
    "dated": """
        select s.*, d.year, d.month, r.hotel_id
        from stays s join dim_room r using (room_sk) join dim_date d on d.date_sk = s.check_in_date_sk""",
    "kpi_occupancy": f"""
        select hotel_id, year, month, booked_rooms, total_rooms,
          {pct('booked_rooms', 'total_rooms')} as occupancy_rate_pct
        from (select hotel_id, year, month,
                count(distinct reservation_id) filter (status = 'Confirmed') as booked_rooms,
                count(distinct room_sk) as total_rooms
              from dated group by all)""",
    "kpi_conversion": f"""
        select *, {pct('confirmed', 'total_reservations')} as conversion_pct
        from (select hotel_id, year, month, count(*) as total_reservations,
                count(*) filter (status = 'Confirmed') as confirmed,
                count(*) filter (is_cancelled) as cancellations,
                count(*) filter (is_no_show) as no_shows
              from dated group by all)""",
    "kpi_hk_sla": f"""
        select *, {pct('within_sla', 'total_tasks')} as sla_pct
        from (select hotel_id, task_type, cast(year(scheduled_time) as integer) as year,
                cast(month(scheduled_time) as integer) as month, count(*) as total_tasks,
                count(*) filter (duration_minutes <= 120 and t.status = 'Completed') as within_sla
              from tasks t join dim_room using (room_sk) group by all)""",
    "kpi_revpar": f"""
        select *, {per('total_revenue', 'total_rooms')} as revpar
        from (select hotel_id, year, month, cast(sum(net_revenue) as decimal(38,2)) as total_revenue,
                count(distinct room_sk) as total_rooms
              from bills join dated using (reservation_id) group by all)""",
    "kpi_billing_accuracy": """
        select *, cast(round(1 - cast(flagged_bills/nullif(total_bills,0) as decimal(18,6)), 4) as double)
            as accuracy_index
        from (select cast(year(payment_time) as integer) as year,
                cast(month(payment_time) as integer) as month, count(*) as total_bills,
                count(*) filter (is_flagged) as flagged_bills
              from bills where payment_time is not null group by all)""",
}


def _lost(domain: str, column: str, parents: str, text: str) -> str:
    return f"""select '{domain.upper()}' as domain, {KEYS[domain]} as natural_key,
        'REF_INTEGRITY' as error_type, '{text}' as error_detail
        from val_{domain} where {column} not in (select {column} from val_{parents})"""


REASONS = {
    "guests": ("VALUE", "'email not valid'"),
    "reservations": (
        "TEMPORAL",
        "case when check_in_date is null then 'check_in_date not a date'"
        " when check_out_date is null then 'check_out_date not a date'"
        " else 'check_out_date not after check_in_date' end",
    ),
    "rooms": ("VALUE", "if(capacity > 0, 'base_price not valid', 'capacity not valid')"),
    "housekeeping": ("TEMPORAL", "'end_time before start_time'"),
    "billing": ("VALUE", "'amount not valid'"),
}


def _rejected(domain: str) -> str:
    kind, text = REASONS[domain]
    key, name = KEYS[domain], domain.upper()
    return f"""
        select '{name}', {key}, '{kind}', {text} from one_{domain}
          where not coalesce({BATCH_RULES[domain]}, false)
        union all
        select '{name}', {key}, 'VALUE', '{key} missing' from raw_{domain} where coalesce(trim({key}), '') = ''
        union all
        select '{name}', {key}, 'DEDUP', format('copy {{}} of {{}} for {key}', i, n)
        from (select {key}, row_number() over (partition by {key}) as i, count(*) over (partition by {key}) as n
              from raw_{domain} where trim({key}) <> '')
        where i > 1"""


def _merge_rejected(domain: str, arrival: int) -> str:
    """Rows of one delivery that a merge rejects or loses as copies."""
    kind, text = REASONS[domain]
    key, name, rule = KEYS[domain], domain.upper(), f"coalesce({MERGE_RULES[domain]}, false)"
    typed = f"(select {_typed(domain)} from landed_chg_{domain} where arrival = {arrival})"
    return f"""
        select '{name}' as domain, {key} as natural_key, 'VALUE' as error_type, '{key} missing' as error_detail from {typed} where {key} is null
        union all
        select '{name}', {key}, '{kind}', {text} from {typed} where {key} is not null and not {rule}
        union all
        select '{name}', {key}, 'DEDUP', format('copy {{}} of {{}} for {key}', i, n)
        from (select {key}, row_number() over (partition by {key}) as i, count(*) over (partition by {key}) as n
              from {typed} where {key} is not null and {rule})
        where i > 1"""


BLOCKS["fk_reservation_guest"] = _lost("reservations", "guest_id", "guests", "guest_id not in GUESTS")
BLOCKS["fk_housekeeping_room"] = _lost("housekeeping", "room_id", "rooms", "room_id not in ROOMS")
BLOCKS["exceptions"] = " union all ".join(
    [
        "select * from fk_reservation_guest",
        "select * from fk_housekeeping_room",
        _lost("reservations", "room_id", "rooms", "room_id not in ROOMS"),
        _lost("billing", "reservation_id", "reservations", "reservation_id not in RESERVATIONS"),
        _lost("billing", "guest_id", "guests", "guest_id not in GUESTS"),
    ]
    + [_rejected(d) for d in FEEDS]
)
BLOCKS["loads"] = " union all ".join(
    f"select '{d.upper()}' as domain, (select count(*) from raw_{d}) as total_rows,"
    f" (select count(*) from val_{d}) as passed_rows"
    for d in FEEDS
)


def _versions(dim: str, sk: str, key: str, merged: str, tracked: tuple[str, ...], columns: list[str], now: str = CHANGED_AT) -> str:
    """Slowly changing dimension after one snapshot."""
    moved = " or ".join(f"o.{c} is distinct from n.{c}" for c in tracked)
    values = [c for c in columns if c != key]
    stay = ", ".join(
        f"o.{c}" if c in tracked else f"if(n.{key} is not null and not ({moved}), n.{c}, o.{c}) as {c}"
        for c in values
    )
    return f"""
        select o.{sk}, o.{key}, {stay}, o.effective_from,
          if(n.{key} is not null and ({moved}), {now}, {NO_TIME}) as effective_to,
          not (n.{key} is not null and ({moved})) as is_current
        from {dim} o left join {merged} n on n.{key} = o.{key} where o.is_current
        union all
        select {sk}, {key}, {', '.join(values)}, effective_from, effective_to, is_current from {dim} where not is_current
        union all
        select (select max({sk}) from {dim}) + {number(key)} as {sk}, {key}, {', '.join(values)},
          {now}, {NO_TIME}, true
        from (select n.* from {merged} n left join (from {dim} where is_current) o on n.{key} = o.{key}
              where o.{key} is null or {moved})"""


BLOCKS["scd_guest"] = _versions(
    "dim_guest", "guest_sk", "guest_id", "mrg_guests", ("loyalty_tier", "email", "phone"),
    [c for c in COLUMNS["guests"] if c != "address"],
)
BLOCKS["scd_room"] = _versions(
    "dim_room", "room_sk", "room_id", "mrg_rooms", ("base_price", "status"), COLUMNS["rooms"],
)
BLOCKS["refreshed"] = f"""
    select reservation_id, guest_sk, room_sk, {ymd('check_in_date')} as check_in_date_sk,
      {ymd('check_out_date')} as check_out_date_sk, booking_channel, booking_time, cancellation_time,
      v.status, date_diff('day', check_in_date, check_out_date) as length_of_stay,
      coalesce(v.status = 'Cancelled', false) as is_cancelled,
      coalesce(v.status = 'No_Show', false) as is_no_show
    from mrg_reservations v left join (from scd_guest where is_current) g using (guest_id)
      left join (from scd_room where is_current) r using (room_id)"""


# ---- the scheduled jobs: a full load and two hours, over landed files --------

_LANDED = re.compile(r"\b(raw|one|val)_(" + "|".join(FEEDS) + r")\b")


def _over_landed(name: str) -> str:
    """A block's text over what came through files."""
    return _LANDED.sub(lambda m: f"landed_{m[2]}" if m[1] == "raw" else f"landed_{m[1]}_{m[2]}", BLOCKS[name])


_HOURS = {1: "timestamp '2024-02-01 01:00:00'", 2: "timestamp '2024-02-01 02:00:00'"}
_AFTER = {1: "after_second", 2: "after_third"}
for _dim, _of, _sk, _tracked in (("dim_guest", "guests", "guest_sk", ("loyalty_tier", "email", "phone")), ("dim_room", "rooms", "room_sk", ("base_price", "status"))):
    _columns = [c for c in COLUMNS[_of] if c != "address"]
    BLOCKS[f"job_{_dim}_0"] = _over_landed(_dim)
    for _hour, _now in _HOURS.items():
        BLOCKS[f"job_{_dim}_{_hour}"] = _versions(f"job_{_dim}_{_hour - 1}", _sk, KEYS[_of], f"{_AFTER[_hour]}_{_of}", _tracked, _columns, _now)
for _fact, _of in (("stays", "reservations"), ("tasks", "housekeeping"), ("bills", "billing")):
    BLOCKS[f"job_{_fact}"] = (
        BLOCKS[_fact].replace(f"val_{_of}", f"after_third_{_of}")
        .replace("join dim_guest", "join (from job_dim_guest_2 where is_current) g").replace("join dim_room", "join (from job_dim_room_2 where is_current) r"))
BLOCKS["job_exceptions"] = " union all ".join(
    [f"select 0 as run, domain, natural_key, error_type, error_detail from ({_over_landed('exceptions')})"]
    + [f"select {h * 5 + i}, * from ({_merge_rejected(d, h)})" for h in _HOURS for i, d in enumerate(("guests", "reservations", "rooms", "housekeeping", "billing"))])
BLOCKS["job_loads"] = " union all ".join(
    [f"select 0 as run, domain, total_rows, passed_rows, {AS_OF} as batch_ts from ({_over_landed('loads')})"]
    + [f"select {h * 5 + i}, '{d.upper()}', (select count(*) from landed_chg_{d} where arrival = {h}), (select count(*) from {s}_{d}), {_HOURS[h]}"
       for h, s in ((1, "second"), (2, "third")) for i, d in enumerate(("guests", "reservations", "rooms", "housekeeping", "billing"))])
BLOCKS["job_dim_room"] = "select * from job_dim_room_2 where is_current"
_RULES = ("double_booking", "hk_sla_breach", "overdue", "maintenance_overdue", "billing_mismatch", "suspicious_cancellation", "findings")
_OF_JOBS = re.compile(r"\b(stays|tasks|bills|dim_room|" + "|".join(_RULES) + r")\b(?! by)")
for _rule in _RULES:
    BLOCKS[f"job_{_rule}"] = _OF_JOBS.sub(r"job_\1", BLOCKS[_rule]).replace(AS_OF, _HOURS[2])

_CRC_TABLE = """(select list(c order by b) as tab from (
    select b, list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(b)))"""
BLOCKS["feed_thirds"] = f"""
    select room_id, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(room_id) + 1), lambda k: cast(ascii(room_id[k]) as bigint))),
      lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295) % 3 = 0 as third from val_rooms, {_CRC_TABLE}"""


def _feed_row(minutes: int, **new: str) -> str:
    cells = ", ".join(f"{new[c]} as {c}" if c in new else f"r.{c}" for c in COLUMNS["rooms"])
    return f"select {cells}, {CHANGED_AT} + {minutes} * interval 1 minute as seen, {minutes} as n from val_rooms r join feed_thirds using (room_id)"


BLOCKS["feed_events"] = " union all ".join([
    f"select *, {AS_OF} as seen, 0 as n from val_rooms",
    _feed_row(60, status="'Dirty'"), _feed_row(120, status="'Dirty'", amenities="'none'"),
    _feed_row(180, status="if(third, 'Dirty', 'Closed')"), _feed_row(210, base_price="cast(base_price + 1 as decimal(10,2))"), _feed_row(240, base_price="cast(base_price + 1 as decimal(10,2))"),
])
BLOCKS["feed_runs"] = """
    select *, sum(new) over (partition by room_id order by n) as run from (
      select *, if((status, base_price) is distinct from lag((status, base_price)) over (partition by room_id order by n), 1, 0) as new from feed_events)"""
BLOCKS["feed_versions"] = f"""
    select *, lead(effective_from) over (partition by room_id order by effective_from) as effective_to,
      effective_to is null as is_current
    from (select room_id, {', '.join(f"last({c} order by n) as {c}" for c in COLUMNS['rooms'] if c != 'room_id')}, min(seen) as effective_from
          from feed_runs group by room_id, run)"""
