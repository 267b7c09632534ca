"""DuckDB SQL with the same results as ``contract.queries``."""

from contract.queries import PARAMS
from ledgerlark.functions.draws import LANES
from ledgerlark.sources import synthetic

# Bindings

F1 = """
f1 as (
  select event_id, ts,
    cast(event_id as varchar) as transaction_id,
    cast(user_id + 1000 as integer) as user_id,
    round(value * 20, 2) as amount,
    'USD' as currency,
    event_type as merchant,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as "timestamp",
    (['CN', 'RU', 'GB', 'US', 'DE'])[event_id % 5 + 1] as location,
    cast(event_id % 50 = 0 as integer) as is_fraud,
    cast(floor(epoch(ts)) as bigint) as sec
  from events
)"""

# Three steps of a stream, and the watermark of each: an hour behind the latest event of those before.
# A row of the last step repeats one that an earlier step kept, if it is not late itself.
STEPS = f"""with {F1},
steps as (
  select transaction_id as id, user_id, amount, ts, false as again,
    if(event_id <= (select max(event_id) // 2 from events), 0, 1) as step
  from f1
  union all select transaction_id, user_id, amount, ts, true, 2 from f1
  union all select 'late-' || transaction_id, user_id, amount, ts, false, 2 from f1
),
marks as (
  select n.step, (select date_trunc('milliseconds', max(ts)) from steps t where t.step < n.step)
    - interval 60 minutes as mark
  from (select distinct step from steps) n
)"""

F2 = """
f2 as (
  select cast(o_orderkey as varchar) as transaction_id, cast(o_custkey as integer) as user_id,
    o_totalprice as amount, cast(floor(epoch(o_orderdate)) as bigint) as sec
  from orders
)"""

F5 = """
f5 as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as transaction_id,
    cast(l_suppkey as integer) as user_id, l_extendedprice as amount,
    cast(floor(epoch(l_shipdate)) as bigint) as sec
  from lineitem
)"""

PAYLOAD = 'transaction_id, user_id, amount, currency, merchant, "timestamp", location, is_fraud'

JSON = """
'{"transaction_id":"' || transaction_id || '","user_id":' || user_id || ',"amount":' || amount
|| ',"currency":"' || currency || '","merchant":"' || merchant || '","timestamp":"' || "timestamp"
|| '","location":"' || location || '","is_fraud":' || is_fraud || '}'"""

F3 = f"""{F1},
f3 as (
  select *, {JSON} as raw_json, ts + interval 5 seconds as kafka_ts, true as good from f1
  union all
  select *, {JSON}, ts + interval 6 seconds, true from f1 where event_id % 10 = 0
  union all
  select *, 'not json', ts + interval 5 seconds, false from f1 where event_id % 101 = 0
)"""

F1_JSON = f"with {F1}, j as (select *, {JSON} as raw_json from f1)"

ORACLES = {
    "scan_transactions": f"with {F1} select {PAYLOAD} from f1",
    "scan_silver_partitions": f"""with {F1}
        select cast(ts as date) as event_date, count(*) as n,
            cast(sum(cast(amount as decimal(18,2))) as double) as amount_sum
        from f1 group by 1""",
    "bronze_raw_records": f"with {F3} select raw_json, kafka_ts from f3",
    "bronze_ingest_stamp": f"with {F3} select count(*) as stamped, 1::bigint as stamps from f3",
    "publish_encode": f"{F1_JSON} select transaction_id as key, raw_json as value from j",
    "silver_parse_json": f"""with {F3}
        select if(good, transaction_id, null) as transaction_id,
            if(good, user_id, null) as user_id, if(good, amount, null) as amount,
            if(good, currency, null) as currency, if(good, merchant, null) as merchant,
            if(good, "timestamp", null) as "timestamp", if(good, location, null) as location,
            if(good, is_fraud, null) as is_fraud, kafka_ts
        from f3""",
    "silver_event_time": f"""with {F3}
        select transaction_id as id, ts as event_time, cast(ts as date) as event_date
        from f3 where good""",
    "silver_dedup": f"""with {F3}
        select transaction_id as id, any_value(user_id) as user_id, any_value(amount) as amount,
            any_value(cast(ts as date)) as event_date, min(kafka_ts) as kafka_ts
        from f3 where good group by 1""",
    "silver_keep_bad": f"""with {F3}
        select transaction_id as id, user_id, amount, cast(ts as date) as event_date from f1
        union all
        (select distinct null, cast(null as integer), cast(null as double), cast(null as date)
         from f3 where not good)""",
    "silver_quarantine": f"""with {F3}
        select raw_json, kafka_ts, 'not JSON' as reason from f3 where not good""",
    "stream_bronze_append": f"with {F3} select raw_json, kafka_ts from f3",
    "stream_silver_dedup": f"""with {F1}
        select transaction_id as id, user_id, amount, cast(ts as date) as event_date from f1""",
    "stream_silver_from_bronze": f"""with {F1}
        select transaction_id as id, user_id, amount, cast(ts as date) as event_date from f1""",
    "stream_late_drop": f"""with {F1}
        select transaction_id as id, cast(ts as date) as event_date from f1
        union all
        select 'late-' || transaction_id, cast(ts as date) from f1
        where ts > (select date_trunc('milliseconds', max(ts)) from f1) - interval 60 minutes""",
    "stream_late_account": f"""{STEPS}
        select cast(m.step as integer) as batch, count(*) as rows,
            count(*) filter (s.ts <= m.mark) as late,
            count(*) filter (s.again and (m.mark is null or s.ts > m.mark)) as repeated,
            count(*) filter (not s.again and (m.mark is null or s.ts > m.mark)) as kept,
            (select date_trunc('milliseconds', max(ts)) from steps t where t.step <= m.step) as latest
        from steps s join marks m on s.step = m.step group by m.step""",
    "stream_dedup_table": f"""{STEPS}
        select id, user_id, amount, cast(ts as date) as event_date, cast(s.step as integer) as batch
        from steps s join marks m on s.step = m.step
        where not again and (m.mark is null or ts > m.mark)""",
    "feat_event_ts": f"""with {F1}
        select transaction_id as id, ts as from_text, ts as from_timestamp from f1""",
    "feat_time_parts": f"""with {F1}
        select transaction_id as id, cast(hour(ts) as integer) as hour,
            cast(dayofweek(ts) + 1 as integer) as dayofweek
        from f1""",
    "feat_epoch_seconds": f"""with {F1}
        select transaction_id as id, sec, sec as sec_of_ntz from f1""",
}

# Rolling features

SECONDS = {"1h": 3600, "24h": 86400}


def rolling(source: str, spans: list[str]) -> str:
    """Rolling columns over a relation with ``user_id``, ``amount`` and ``sec``."""
    columns = ["*"]
    for s in spans:
        frame = f"""over (partition by user_id order by sec
            range between {SECONDS[s]} preceding and current row)"""
        total = f"sum(cast(amount as decimal(18,2))) {frame}"
        columns += [
            f"count(*) {frame} as u_txn_cnt_{s}",
            f"cast({total} as double) as u_amt_sum_{s}",
            f"cast({total} as double) / count(amount) {frame} as u_amt_avg_{s}",
        ]
    return f"select {', '.join(columns)} from {source}"


def rolled(spans: list[str]) -> str:
    names = [f"u_{m}_{s}" for s in spans for m in ("txn_cnt", "amt_sum", "amt_avg")]
    return ", ".join(["transaction_id as id", *names])


BOTH = ["1h", "24h"]


def features(source: str, columns: str) -> str:
    return f"""select {columns} from (
        select r.*, ts as event_ts, cast(hour(ts) as integer) as hour,
            cast(dayofweek(ts) + 1 as integer) as dayofweek
        from ({rolling(source, BOTH)}) r)"""


FEATURES = """transaction_id, user_id, amount, currency, merchant, location, event_ts, hour,
    dayofweek, u_txn_cnt_1h, u_amt_sum_1h, u_amt_avg_1h, u_txn_cnt_24h, u_amt_sum_24h,
    u_amt_avg_24h, is_fraud"""

# Amounts of 1e300, 1e-17 and 1e-30 are counted, cents are summed; whatever is summed is then one number.
LARGE = """large as (
        select *, case event_id % 10 when 0 then 1 when 1 then -1 else 0 end as huge, event_id % 10 = 2 as dust,
            event_id % 10 = 3 as grain, if(event_id % 10 > 4, cast(amount as decimal(18,2)), 0) as cents
        from f1),
    counted as (select *, """ + ", ".join(
    f"""count(*) over w{s} as u_txn_cnt_{s}, count(*) filter (event_id % 10 <> 4) over w{s} as valued_{s},
        cast(count(*) filter (dust) over w{s} || 'e-30' as double) + cast(count(*) filter (grain) over w{s} || 'e-17' as double)
        + cast(sum(cents) over w{s} as double) + cast(sum(huge) over w{s} || 'e300' as double) as total_{s}"""
    for s in BOTH
) + " from large window " + ", ".join(
    f"w{s} as (partition by user_id order by sec range between {SECONDS[s]} preceding and current row)" for s in BOTH
) + ")"
LARGE_SUMS = ", ".join(
    f"if(valued_{s} > 0, total_{s}, null) as u_amt_sum_{s}, if(valued_{s} > 0, total_{s} / valued_{s}, null) as u_amt_avg_{s}"
    for s in BOTH
)
UNTIMED = ", ".join(
    f"""count(*) over w as u_txn_cnt_{s}, cast(sum(cast(amount as decimal(18,2))) over w as double) as u_amt_sum_{s},
        cast(sum(cast(amount as decimal(18,2))) over w as double) / count(amount) over w as u_amt_avg_{s}"""
    for s in BOTH
)

both_f1 = f"with {F1} select {rolled(BOTH)} from ({rolling('f1', BOTH)})"



def best_split(name: str, rows: str, side: str) -> str:
    """The split with the largest gain of each side of ``rows``, with the sums left and right of it."""
    return f"""{name}_cuts as (
            select {side} as side, f, c,
                sum(g) filter (x <= c) as gl, sum(h) filter (x <= c) as hl,
                coalesce(sum(g) filter (x > c), 0) as gr, coalesce(sum(h) filter (x > c), 0) as hr
            from (select *, 0 as f, a as x from {rows} union all select *, 1, b from {rows})
            join (select distinct 0 as f, a as c from {rows} union all select distinct 1, b from {rows}) using (f)
            group by 1, 2, 3),
        {name} as (
            select * from (
                select *, gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1) as gain
                from {name}_cuts where hl >= 1 and hr >= 1)
            where gain > 1e-9 qualify row_number() over (partition by side order by gain desc, f, c) = 1)"""


ORACLES |= {
    "feat_roll_1h": f"with {F1} select {rolled(['1h'])} from ({rolling('f1', ['1h'])})",
    "feat_roll_24h": f"with {F1} select {rolled(['24h'])} from ({rolling('f1', ['24h'])})",
    "feat_roll_running_sums": both_f1,
    "feat_roll_per_second": both_f1,
    "feat_roll_peers": f"with {F2} select {rolled(BOTH)} from ({rolling('f2', BOTH)})",
    "feat_roll_few_users": f"with {F5} select {rolled(BOTH)} from ({rolling('f5', BOTH)})",
    "feat_roll_hot_user": f"""with {F1}, hot as (
            select * replace (if(event_id % 3 = 0, 1000, user_id) as user_id) from f1)
        select {rolled(BOTH)} from ({rolling('hot', BOTH)})""",
    "feat_project": f"with {F1} {features('f1', FEATURES.replace('currency, ', ''))}",
    "feat_table": f"with {F1} {features('f1', FEATURES)}",
}

# Checks

FAULTY = f"""{F1},
faulty as (
  select event_id as id,
    if(event_id % 53 = 0, null, transaction_id) as transaction_id,
    case when event_id % 11 = 0 then 999 when event_id % 13 = 0 then null else user_id end
      as user_id,
    case when event_id % 17 = 0 then 0.0::double when event_id % 19 = 0 then 10000.01::double
      else amount end as amount,
    case when event_id % 23 = 0 then 'usd' when event_id % 29 = 0 then 'USD' || chr(10)
      else 'USD' end as currency,
    merchant,
    case when event_id % 41 = 0 then 'not a time' when event_id % 59 = 0 then '2024'
      when event_id % 61 = 0 then '12:30:00' when event_id % 67 = 0 then '2024-01-01' else "timestamp" end
      as "timestamp",
    case when event_id % 31 = 0 then 'us' when event_id % 37 = 0 then null else location end
      as location,
    case when event_id % 43 = 0 then 2 when event_id % 47 = 0 then null else is_fraud end
      as is_fraud
  from f1
)"""

REQUIRED = ["transaction_id", "user_id", "amount", "currency", "timestamp", "is_fraud"]
# A value constraint that does not apply is NULL.
RANGE_FAULTS = [
    ("user_id: range", "user_id not between 1000 and 9999"),
    ("amount: range", "amount not between 0.01::double and 10000"),
    ("is_fraud: range", "is_fraud not between 0 and 1"),
]
PATTERN_FAULTS = [
    ("currency: pattern", "not regexp_full_match(currency, '[A-Z]{3}')"),
    ("location: pattern", "not regexp_full_match(location, '[A-Z]{2}')"),
]
TIME_FAULTS = [
    (
        "timestamp: date-time",
        '''"timestamp" is not null
            and (try_cast("timestamp" as timestamptz) is null or "timestamp" not like '____-__-__T__:__:%')''',
    )
]
REQUIRED_FAULTS = [(f"{c}: required", f'"{c}" is null') for c in REQUIRED]


def passes(faults: list[tuple[str, str]]) -> str:
    return " and ".join(f"not coalesce({bad}, false)" for _, bad in faults)


def listed(faults: list[tuple[str, str]]) -> str:
    items = ", ".join(f"if(coalesce({bad}, false), '{name}', null)" for name, bad in faults)
    return f"list_filter([{items}], lambda x: x is not null)"


def quarantined(source: str, errors: str) -> str:
    return f"""select id, cast(len(errors) as integer) as n_errors,
            array_to_string(errors, '; ') as errors
        from (select id, {errors} as errors from {source}) where len(errors) > 0"""


ALL_FAULTS = REQUIRED_FAULTS + RANGE_FAULTS + PATTERN_FAULTS + TIME_FAULTS

ORACLES |= {
    "check_required": f"with {FAULTY} select id, {passes(REQUIRED_FAULTS)} as ok from faulty",
    "check_ranges": f"with {FAULTY} select id, {passes(RANGE_FAULTS)} as ok from faulty",
    "check_patterns": f"with {FAULTY} select id, {passes(PATTERN_FAULTS)} as ok from faulty",
    "check_timestamp": f"with {FAULTY} select id, {passes(TIME_FAULTS)} as ok from faulty",
    "check_quarantine": f"with {FAULTY} {quarantined('faulty', listed(ALL_FAULTS))}",
}

ODD = f"""{F1},
odd as (
  select event_id as id,
    case when event_id % 59 = 0 then 'not json' when event_id % 61 = 0 then '[1]'
    else '{{' || concat_ws(',',
      '"transaction_id":'
        || if(event_id % 11 = 0, '' || event_id, '"' || transaction_id || '"'),
      if(event_id % 13 = 0, null, '"user_id":'
        || case when event_id % 17 = 0 then '"' || event_id || '"' when event_id % 19 = 0
           then 'true' when event_id % 23 = 0 then '1000.5' else '' || user_id end),
      '"amount":' || case when event_id % 29 = 0 then 'null' when event_id % 73 = 0 then 'NaN' else '' || amount end,
      '"currency":' || if(event_id % 31 = 0, '["USD"]', '"' || currency || '"'),
      if(event_id % 37 = 0, null, '"merchant":'
        || if(event_id % 41 = 0, 'null', '"' || merchant || '"')),
      '"timestamp":"' || "timestamp" || '"',
      '"location":' || if(event_id % 43 = 0, '{{"c":"US"}}', '"' || location || '"'),
      '"is_fraud":' || case when event_id % 47 = 0 then '0.5' when event_id % 53 = 0 then '1.0'
        else '' || is_fraud end) || '}}' end as raw_json
  from f1
),
-- NaN and repeated keys are valid for this parser, text after the object is not put in here.
doc as (
  select id, (id % 79 = 0 and id % 59 > 0 and id % 61 > 0 and id % 67 > 0 and id % 71 > 0
      and (id % 73 > 0 or id % 29 = 0)) as repeated,
    if(json_valid(raw_json) and not repeated
       and (id % 73 > 0 or id % 29 = 0 or id % 61 = 0)
       and (id % 61 = 0 or (id % 67 > 0 and id % 71 > 0 and id % 83 > 0)), raw_json::json, null) as d
  from odd)"""

KINDS = {
    "transaction_id": "string",
    "user_id": "number",
    "amount": "number",
    "currency": "string",
    "merchant": "string",
    "timestamp": "string",
    "location": "string",
    "is_fraud": "integer",
}


def has_kind(name: str, kind: str) -> str:
    found = f"json_type(d, '$.{name}')"
    value = f"try_cast(json_extract_string(d, '$.{name}') as double)"
    if kind == "string":
        return f"{found} = 'VARCHAR'"
    if kind == "number":
        return f"{found} in ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE')"
    whole = f"{found} = 'DOUBLE' and {value} = floor({value})"
    return f"({found} in ('BIGINT', 'UBIGINT', 'HUGEINT') or ({whole}))"


TYPE_FAULTS = [(f"{c}: type", f"not {has_kind(c, k)}") for c, k in KINDS.items()]
JSON_REQUIRED = [(f"{c}: required", f"json_type(d, '$.{c}') is null") for c in REQUIRED]
TYPED = ", ".join(
    f"if({has_kind(c, k)}, "
    + (
        f"json_extract_string(d, '$.{c}')"
        if k == "string"
        else f"try_cast(json_extract_string(d, '$.{c}') as double)"
    )
    + f', null) as "{c}"'
    for c, k in KINDS.items()
)
JSON_ERRORS = f"""case when repeated then ['repeated key'] when d is null then ['not JSON']
    when json_type(d) <> 'OBJECT' then ['not an object']
    else {listed(JSON_REQUIRED + TYPE_FAULTS + RANGE_FAULTS + PATTERN_FAULTS + TIME_FAULTS)} end"""

ORACLES |= {
    "check_types": f"with {ODD} select id, {passes(TYPE_FAULTS)} as ok from doc",
    "check_json_quarantine": f"""with {ODD}, typed as (select id, d, repeated, {TYPED} from doc)
        {quarantined('typed', JSON_ERRORS)}""",
}

# Synthetic transactions

SEED = PARAMS.seed
BLOCKS = -(-len(synthetic.DRAWS) // LANES)


def bits(digest: str, lane: int = 0) -> str:
    return f"cast('0x' || substr({digest}, {1 + 8 * lane}, 8) as bigint)"


def u(name: str) -> str:
    block, lane = divmod(synthetic.DRAWS.index(name), LANES)
    return f"(cast({bits(f'h{block}', lane)} as double) / 4294967296::double)"


def whole(name: str, low: int, high: int) -> str:
    return f"(cast(floor({u(name)} * {high - low + 1}::double) as bigint) + {low})"


def pick(name: str, values: list[str]) -> str:
    return f"({values})[{whole(name, 1, len(values))}]"


def uniform(name: str, low: int, high: int) -> str:
    return f"({low}::double + {u(name)} * {high - low}::double)"


def in_cents(name: str, low: int, high: int) -> str:
    return f"(floor({u(name)} * {high - low}::double + {low + 0.5}::double) / 100::double)"


COMPANY = f"""case {whole('company_form', 0, 2)}
    when 0 then {pick('company_a', synthetic.SURNAMES)} || ' '
      || {pick('company_ending', synthetic.COMPANY_ENDINGS)}
    when 1 then {pick('company_a', synthetic.SURNAMES)} || '-'
      || {pick('company_b', synthetic.SURNAMES)}
    else {pick('company_a', synthetic.SURNAMES)} || ', ' || {pick('company_b', synthetic.SURNAMES)}
      || ' and ' || {pick('company_c', synthetic.SURNAMES)} end"""
NAME = f"md5('{SEED}|id|' || id)"
DIGESTS = ", ".join(f"md5('{SEED}|{b}|' || event_id) as h{b}" for b in range(BLOCKS))

BASE = f"""
drawn as (select event_id as id, ts, {DIGESTS} from events),
base as (
  select id,
    substr({NAME}, 1, 8) || '-' || substr({NAME}, 9, 4) || '-4' || substr({NAME}, 14, 3) || '-a'
      || substr({NAME}, 18, 3) || '-' || substr({NAME}, 21, 12) as transaction_id,
    cast({whole('user', 1000, 9999)} as integer) as user_id,
    {in_cents('amount', 1, 1_000_000)} as amount,
    'USD' as currency,
    {COMPANY} as merchant,
    strftime(ts + to_seconds({whole('jitter', -300, 3000)}), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
      as "timestamp",
    {pick('location', synthetic.PLACES)} as location,
    0 as is_fraud,
    cast(null as varchar) as pattern,
    amount as base_amount, merchant as base_merchant,
    {', '.join(f'h{b}' for b in range(BLOCKS))}
  from drawn
),
compromised as (
  select user_id from (select unnest(range(1000, 9999)) as user_id)
  order by {bits(f"md5('{SEED}|user|' || user_id)")}, user_id limit 50
)"""


def rule(pattern: str, hit: str, source: str, **changes: str) -> str:
    applies = f"is_fraud = 0 and {hit}"
    changed = [f"if({applies}, {v}, {c}) as {c}" for c, v in changes.items()]
    changed.append(f"if({applies}, '{pattern}', pattern) as pattern")
    changed.append(f"if({applies}, 1, is_fraud) as is_fraud")
    return f"select * replace ({', '.join(changed)}) from {source}"


def takeover(source: str) -> str:
    return rule(
        "account_takeover",
        f"user_id in (select user_id from compromised) and base_amount > 500 and {u('takeover')} < 0.3",
        source,
        amount=uniform("takeover_amount", 500, 5000),
        merchant=pick("takeover_merchant", synthetic.HIGH_RISK),
    )


def card_testing(source: str) -> str:
    return rule(
        "card_testing",
        f"base_amount < 2.0 and user_id % 1000 = 0 and {u('testing')} < 0.25",
        source,
        amount=in_cents("testing_amount", 1, 200),
        location="'US'",
    )


def collusion(source: str) -> str:
    return rule(
        "merchant_collusion",
        f"base_merchant in ('QuickCash', 'GlobalDigital', 'FastMoneyX') and base_amount > 3000"
        f" and {u('collusion')} < 0.15",
        source,
        amount=uniform("collusion_amount", 300, 1500),
    )


def geo(source: str) -> str:
    hit = f"user_id % 500 = 0 and {u('geo')} < 0.1"
    return rule("geo_anomaly", hit, source, location=pick("geo_location", ["CN", "RU", "GB"]))


def baseline(source: str) -> str:
    hit = f"{u('baseline')} < 0.002"
    return rule("baseline", hit, source, amount=uniform("baseline_amount", 100, 2000))


def noise(source: str) -> str:
    return f"select * replace (if({u('label')} < 0.985, is_fraud, 0) as is_fraud) from {source}"


SYNTHESIZED = f"""{BASE},
t as ({takeover('base')}), c as ({card_testing('t')}), k as ({collusion('c')}),
g as ({geo('k')}), b as ({baseline('g')}), n as ({noise('b')}),
made as (select * from n where user_id between 1000 and 9999
  and amount between 0.01::double and 10000 and is_fraud in (0, 1))"""


def touched(*columns: str) -> str:
    return ", ".join(["transaction_id as id", *columns, "is_fraud", "pattern"])


def crafted(**columns: str) -> str:
    made = ", ".join(f"{v} as {c}" for c, v in columns.items())
    return f"""crafted0 as (select * replace ({made}) from base),
        crafted as (select * replace (amount as base_amount, merchant as base_merchant)
            from crafted0)"""


ORACLES |= {
    "gen_base": f"with {BASE} select {PAYLOAD} from base",
    "gen_compromised_users": f"""with {BASE}
        select user_id, count(*) as n from base
        where user_id in (select user_id from compromised) group by 1""",
    "gen_takeover": f"with {BASE} select {touched('amount', 'merchant')} from ({takeover('base')})",
    "gen_card_testing": f"""with {BASE}, {crafted(
        user_id='cast(id % 9 * 500 + 1000 as integer)',
        amount='cast(id % 400 + 1 as double) / 100')}
        select {touched('amount', 'location')} from ({card_testing('crafted')})""",
    "gen_collusion": f"""with {BASE}, {crafted(
        merchant=f"if(id % 2 = 0, ({synthetic.HIGH_RISK})[id % 3 + 1], merchant)")}
        select {touched('amount')} from ({collusion('crafted')})""",
    "gen_geo": f"""with {BASE}, {crafted(user_id='cast(id % 36 * 250 + 1000 as integer)')}
        select {touched('location')} from ({geo('crafted')})""",
    "gen_baseline": f"with {BASE} select {touched('amount')} from ({baseline('base')})",
    "gen_label_noise": f"""with {BASE}, fraud as (select * replace (1 as is_fraud) from base)
        select {touched()} from ({noise('fraud')})""",
    "gen_transactions": f"with {SYNTHESIZED} select {PAYLOAD}, pattern from made",
    "gen_fraud_rate": f"""with {SYNTHESIZED}
        select coalesce(pattern, 'none') as pattern, count(*) as n,
            cast(sum(is_fraud) as bigint) as frauds
        from made group by 1""",
}

# Training and evaluation

CHOSEN = [
    "user_id", "amount", "hour", "dayofweek", "u_txn_cnt_1h", "u_amt_sum_1h", "u_amt_avg_1h",
    "u_txn_cnt_24h", "u_amt_sum_24h", "u_amt_avg_24h", "event_ts_unix",
]


def indexed(column: str) -> str:
    return f"""select {column}, count(*) as n, cast(row_number() over (order by count(*) desc,
        {column}) - 1 as double) as idx from f1 group by 1"""


GROUPS = f"""with {F1},
groups as (select amount, sum(is_fraud) as pos, sum(1 - is_fraud) as neg from f1 group by 1),
ranked as (
  select *, sum(pos) over w as tp, sum(neg) over w as fp from groups
  window w as (order by amount desc)
)"""

ORACLES |= {
    "train_label_filter": f"""with {F1}
        select transaction_id as id, cast(is_fraud as double) as label
        from f1 where event_id % 7 <> 0""",
    "train_event_ts_unix": f"""with {F1}
        select transaction_id as id, cast(sec as double) as event_ts_unix from f1""",
    "train_feature_columns": f"with {F1}, t as ("
    + features("f1", f"{FEATURES}, cast(sec as double) as event_ts_unix")
    + ") "
    + " union all ".join(
        f"select {i} as pos, '{c}' as name, count({c}) as n_filled from t"
        for i, c in enumerate(CHOSEN)
    ),
    "train_class_balance": f"""with {F1}
        select cast(sum(is_fraud) as double) as pos, cast(sum(1 - is_fraud) as double) as neg
        from f1""",
    "train_scale_pos_weight": f"""with {F1}
        select if(sum(is_fraud) <= 0, 1.0::double, greatest(1.0::double,
            cast(sum(1 - is_fraud) as double) / cast(sum(is_fraud) as double)))
            as scale_pos_weight
        from f1""",
    "train_index_merchant": f"""with {F1}
        select merchant, idx as merchant_idx from ({indexed('merchant')})""",
    "train_index_location": f"""with {F1}
        select location, idx as location_idx from ({indexed('location')})""",
    "train_index_other": f"""with {F1}
        select merchant, least(idx, 3.0::double) as merchant_idx, n
        from ({indexed('merchant')})""",
    "train_index_wide": f"""with {F1}
        select transaction_id as id, cast(row_number() over (order by transaction_id) - 1 as double)
            as transaction_id_idx
        from f1""",
    "train_index_table": f"""with {F1}
        select merchant as value, idx, n as count from ({indexed('merchant')})""",
    "train_onehot": f"""with {F1}
        select merchant, cast(idx as integer) as slot,
            cast(count(*) over () + 1 as integer) as width
        from ({indexed('merchant')})""",
    "train_fill_missing": f"""with {F1}
        select transaction_id as id, if(event_id % 7 <> 0, amount,
            (select quantile_disc(amount, 0.5) from f1 where event_id % 7 <> 0)) as amount_filled,
            0::double as empty_filled
        from f1""",
    "train_boosted_tree": f"""with {F1},
        r as (
            select transaction_id as id, event_id % 5 as a, event_id % 7 as b, 0.25::double as h,
                0.5::double - cast((event_id % 5 >= 3 and event_id % 7 < 2) or event_id % 11 = 0 as integer) as g
            from f1),
        {best_split('root', 'r', 'true')},
        sided as (select r.*, coalesce(if(s.f = 0, a, b) <= s.c, true) as on_left from r left join root s on true),
        {best_split('child', 'sided', 'on_left')},
        sums as (select on_left, sum(g) as g, sum(h) as h from sided group by 1)
        select id, round(case when s.f is null then -0.3::double * t.g / (t.h + 1)
            when if(s.f = 0, a, b) <= s.c then -0.3::double * s.gl / (s.hl + 1)
            else -0.3::double * s.gr / (s.hr + 1) end, 9) as margin
        from sided left join child s on s.side = sided.on_left join sums t on t.on_left = sided.on_left""",
    "train_assemble": f"""with {F1}
        select transaction_id as id, 0 as pos, cast(user_id as double) as x from f1
        union all
        select transaction_id, 1, amount from f1""",
    "train_split_hash": f"""with {F1}
        select transaction_id as id,
            if({bits('md5(transaction_id)')} < 3435973837, 'train', 'test') as part
        from f1""",
    "train_split_time": f"""with {F1}, span as (
            select epoch(min(ts)) as a, epoch(max(ts)) as z from f1)
        select transaction_id as id,
            if(epoch(ts) <= a + 0.8::double * (z - a), 'train', 'test') as part
        from f1, span""",
    "eval_auc_roc": f"""{GROUPS}
        select round(sum(neg * (tp - pos / 2.0::double)) / (sum(pos) * sum(neg)), 6) as auc_roc
        from ranked""",
    "eval_auc_pr": f"""{GROUPS}, points as (
            select pos, tp / (tp + fp)::double as here,
                if(tp + fp = pos + neg, tp / (tp + fp)::double,
                   (tp - pos) / (tp - pos + fp - neg)::double) as before
            from ranked)
        select round(sum(pos * (here + before) / 2) / sum(pos), 6) as auc_pr from points""",
}

ORACLES |= {
    "sink_features": f"""with {F1}, t as (select id, u_txn_cnt_24h, user_id from
            (select *, transaction_id as id from ({rolling('f1', ['24h'])})))
        select id, u_txn_cnt_24h, '2024-01-01' as date from t
        union all
        select id, u_txn_cnt_24h, '2024-01-02' from t where user_id % 2 = 0""",
    "sink_run_ledger": f"""with {F1}
        select 'half-' || event_id % 2 as run_name, cast(count(*) as double) as n,
            cast(sum(cast(amount as decimal(18,2))) as double) as total
        from f1 group by 1""",
    "sink_model": f"with {F1} select count(*) as n, 0::bigint as differing from f1",
    "feat_roll_large_amounts": f"with {F1}, {LARGE} select {rolled(BOTH)} from (select *, {LARGE_SUMS} from counted)",
    "feat_roll_hot_hour": f"""with {F1}, hot as (
            select * replace (if(event_id % 3 = 0, 1000, user_id) as user_id,
                case when event_id % 10 = 0 then null when event_id % 3 = 0 then event_id % 3600 else sec end as sec)
            from f1),
        timed as ({rolling('(select * from hot where sec is not null)', BOTH)}),
        untimed as (select *, {UNTIMED} from hot where sec is null window w as (partition by user_id))
        select {rolled(BOTH)} from timed union all select {rolled(BOTH)} from untimed""",
    "eval_auc_skewed": f"""with {F1},
        groups as (
            select if(event_id % 50 = 3, amount, 1.0::double) as score,
                count(*) filter (event_id % 3 = 0) as pos, count(*) filter (event_id % 3 <> 0) as neg
            from f1 where event_id % 7 <> 0 group by 1),
        ranked as (
            select *, sum(pos) over w as tp, sum(neg) over w as fp from groups
            window w as (order by score desc)),
        points as (
            select *, tp / (tp + fp)::double as here,
                if(tp + fp = pos + neg, tp / (tp + fp)::double,
                   (tp - pos) / (tp - pos + fp - neg)::double) as before
            from ranked)
        select round(sum(neg * (tp - pos / 2.0::double)) / (sum(pos) * sum(neg)), 6) as auc_roc,
            round(sum(pos * (here + before) / 2) / sum(pos), 6) as auc_pr
        from points""",
}
