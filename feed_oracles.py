"""The SQL that another engine runs over the same tables to check feed_queries."""

from __future__ import annotations

# Fixed values, written out here so that no list is checked against itself.
TRANSIENT_CODES = (
    "Local_Transport", "Local_TimedOut", "Local_AllBrokersDown", "BrokerNotAvailable", "LeaderNotAvailable",
    "NotLeaderForPartition", "RequestTimedOut", "Local_MsgTimedOut", "NetworkException", "NotEnoughReplicas",
    "NotEnoughReplicasAfterAppend", "Local_QueueFull", "GroupCoordinatorNotAvailable",
)
REPORT_CODES = (
    *TRANSIENT_CODES, "TopicAuthorizationFailed", "SaslAuthenticationFailed", "UnknownTopicOrPart", "OffsetOutOfRange",
    "MsgSizeTooLarge", "Local_Authentication", "Local_MaxPollExceeded",
)
SECRETS_IN_ORDER = ("tionhe", "token", "thor", "tion")  # longest first; "th" is too short to be masked
PASSWORD_PROPERTIES = ("sasl.password", "ssl.key.password", "ssl.keystore.password", "sasl.oauthbearer.client.secret")

TS = "'%Y-%m-%dT%H:%M:%S.%fZ'"
MID, LATER = "timestamp '2024-01-15'", "timestamp '2024-01-22'"

EV = """
ev as (
  select 'events' as topic, cast(user_id % 4 as integer) as part, event_id as off, ts,
         cast(user_id as varchar) as k, props as v, event_type, user_id, event_id, value
  from events
),
marks as (select part, min(off) as low, max(off) + 1 as high from ev group by part)"""
# Offsets of a catalogued topic: three appends, each numbering its records from the high mark on.
TOPIC = f"""
parts as (
  select cast(user_id % 4 as integer) as part, event_id, cast(event_id as varchar) as k, props as v, ts,
         case when ts < {MID} then 1 when ts < {LATER} then 2 else 3 end as append
  from events),
topic as (select *, row_number() over (partition by part order by append, event_id) - 1 as off from parts)"""
AT = f"""
at_mid as (select part, min(off) as at_off from ev where ts >= {MID} group by part),
at_later as (select part, min(off) as at_off from ev where ts >= {LATER} group by part)"""
ORD = """
ord as (select cast(o_custkey % 8 as integer) as part, o_orderkey as off from orders),
ord_marks as (select part, min(off) as low, max(off) + 1 as high from ord group by part)"""
HEADERS = """
'{"type":"' || event_type || '",'
|| case when event_type = 'click' then '"id":["' || user_id || '","' || event_id || '"]'
        else '"id":"' || user_id || '"' end
|| ',"note":' || case when event_type = 'view' then 'null' else '"' || event_type || ' \\"quoted\\""' end
|| case when event_type = 'click' then '' else ',"event":"' || event_id || '"' end
|| ',"raw":"base64:/w=="}'"""
TICKS = """
ticks as (
  select user_id as client, event_id as seq,
         case when event_type in ('view', 'purchase') then tx else 0 end as tx,
         case when event_type in ('view', 'signup', 'click') then sent else 0 end as tx_bytes,
         case when event_type in ('view', 'signup', 'purchase') then received else 0 end as rx_bytes
  from (select *, event_id // 10 + k as tx, event_id * 100 + k * 1000 as sent, event_id * 50 + k * 700 as received
        from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events))
  where event_type <> 'error'
),
prev as (
  select *, greatest(0, coalesce(max(tx) over w, 0)) as p_tx,
         greatest(0, coalesce(max(tx_bytes) over w, 0)) as p_sent,
         greatest(0, coalesce(max(rx_bytes) over w, 0)) as p_received
  from ticks window w as (partition by client order by seq rows between unbounded preceding and 1 preceding)
),
deltas as (
  select client, seq, greatest(0, tx - p_tx) as requests,
         greatest(0, tx_bytes - p_sent) + greatest(0, rx_bytes - p_received) as wire_bytes
  from prev
),
totals as (
  select client, cast(sum(requests) as bigint) as requests, cast(sum(wire_bytes) as bigint) as wire_bytes
  from deltas group by client
)"""


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


REPORTS = f"""
reports as (
  select user_id as session, event_id as seq,
         case when event_type in ('error', 'signup')
              then list_extract([{_texts(REPORT_CODES)}],
                   cast(json_extract_string(props, '$.k') as integer) % {len(REPORT_CODES)} + 1) end as code,
         case when event_type in ('error', 'signup') then event_type || ' at ' || event_id end as reason
  from events
)"""


def _masked(column: str) -> str:
    for secret in SECRETS_IN_ORDER:
        column = f"replace({column}, '{secret}', '***')"
    return column


_NAMES = "|".join(p.replace(".", "\\.") for p in PASSWORD_PROPERTIES)
LINE = """{'quantity': l_quantity, 'price': cast(cast(l_extendedprice as decimal(18,2)) as varchar),
  'ship': {'at': strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ'), 'day': strftime(l_shipdate, '%Y-%m-%d')}}"""

ORACLES = {
    "relay": f"""
select event_id as id, json_extract_string(props, '$.k') as name, strftime(ts, {TS}) as seen_at from events""",
    "envelope": f"""
with {EV}
select topic, part as "partition", off as "offset", strftime(ts, {TS}) as "timestamp", k as "key", v as "value",
       {HEADERS} as headers from ev""",
    "feed_slice": f"""
with {EV}, {AT}
select topic, part as "partition", off as "offset", k as "key", v as "value"
from ev join at_mid using (part) where off >= at_off""",
    "watermarks": f"""with {EV} select part as "partition", low, high from marks""",
    "partitions": """
select distinct 'events' as topic, cast(user_id % 4 as integer) as "partition" from events
union all select distinct 'orders', cast(o_custkey % 8 as integer) from orders
union all select distinct 'conversations', cast(conv_id % 3 as integer) from conversations""",
    "bounds_earliest": f"""with {EV} select part as "partition", low as resume, high as bound from marks""",
    "bounds_latest": f"""with {EV} select part as "partition", high as resume, high as bound from marks""",
    "bounds_timestamp": f"""
with {EV}, {AT}
select part as "partition", coalesce(least(greatest(at_off, low), high), high) as resume, high as bound
from marks left join at_mid using (part)""",
    "bounds_resume": f"""
with {EV}, {AT}
select part as "partition", case when part = 3 then low else coalesce(at_off, low) end as resume, high as bound
from marks left join at_mid using (part)""",
    "unfinished": f"""
with {EV}, {AT}
select part as "partition", at_off as resume, high as bound
from marks join at_mid using (part) where part in (1, 3) and at_off < high""",
    "bound_problems": f"""
with {EV}, {AT},
stored as (
  select part, l.at_off as low, high,
         case part when 0 then m.at_off when 1 then high + 5 when 2 then l.at_off else high end as stored
  from marks join at_later l using (part) join at_mid m using (part)
)
select part as "partition", stored, low, high, case when stored < low then 'retention' else 'reset' end as problem
from stored where stored < low or stored > high""",
    "effective_bounds": f"""
with {EV}, {AT}
select part as "partition", case when part = 2 then high else low end as resume,
       case when part in (0, 1) then least(coalesce(at_off, high), high) else high end as bound
from marks left join at_later using (part)""",
    "offset_gaps": f"""
with {EV}
select part as "partition", min(off) as first_offset, max(off) as last_offset, count(*) as records,
       max(off) - min(off) + 1 - count(*) as missing from ev group by part""",
    "vanished_partitions": f"""
with {EV}, {ORD}
select part as "partition", high as next_offset from ord_marks where part not in (select part from marks)""",
    "token": f"""
with {ORD}
select 'orders' as topic, '{{"v":1,"topic":"orders","partitions":{{'
  || string_agg('"' || part || '":' || high, ',' order by part) || '}}}}' as token from ord_marks""",
    "token_empty": f"""
with {ORD}
select 'orders' as topic, '{{"v":1,"topic":"orders","partitions":{{'
  || string_agg('"' || part || '":' || high, ',' order by part) || '}}}}' as token,
  cast(0 as bigint) as landed from ord_marks""",
    "token_parse": """
select event_id, cast(null as varchar) as problem, 10 as "partition", event_id as next_offset
from events where event_type = 'view'
union all select event_id, null, 2, user_id from events where event_type = 'view'
union all select event_id, case event_type when 'click' then 'of another topic' when 'signup' then 'of version 2 instead of 1'
  when 'purchase' then 'holds an entry that is no partition with an offset' else 'no JSON value' end, null, null from events where event_type <> 'view'""",
    "headers_json": f"""with {EV} select part as "partition", off as "offset", {HEADERS} as headers from ev""",
    "payload_base64": """
select cast(conv_id % 3 as integer) as "partition", conv_id * 1048576 + turn as "offset",
       to_base64(encode(cast(conv_id as varchar))) as "key", to_base64(encode(text)) as "value" from conversations""",
    "utf8_rejects": f"""
with {EV}
select topic, part as "partition", off as "offset", 'value' as field from ev where event_type = 'error'
union all select topic, part, off, 'key' from ev where event_type = 'signup'""",
    "row_json": f"""
select o_orderkey, to_json({{'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus,
  'o_totalprice': o_totalprice, 'o_orderdate': strftime(o_orderdate, {TS}),
  'o_orderpriority': o_orderpriority}})::varchar as "value" from orders""",
    "row_json_decimal": """
select o_orderkey, to_json({'o_orderkey': o_orderkey,
  'price': cast(cast(cast(o_totalprice as decimal(18,2)) as decimal(38,9)) as varchar)})::varchar as "value"
from orders""",
    "row_json_nonfinite": """
select event_id, to_json({'event_id': event_id,
  'value': case when event_type in ('error', 'signup', 'click') then null else value end})::varchar as json
from events""",
    "row_json_nested": f"""
select l_orderkey, l_linenumber, to_json({{'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber,
  'line': case when l_returnflag <> 'R' then {LINE} end,
  'flags': [l_returnflag, case when l_returnflag = 'R' then l_linestatus end],
  'rates': {{'tax': l_tax, 'discount': case when l_returnflag <> 'R' then l_discount end}}}})::varchar as "value"
from lineitem""",
    "sink_records": f"""
select 'orders-out' as topic, cast(null as varchar) as "key",
  to_json({{'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus,
  'o_totalprice': o_totalprice, 'o_orderdate': strftime(o_orderdate, {TS}),
  'o_orderpriority': o_orderpriority}})::varchar as "value", cast(null as varchar) as headers from orders""",
    "sink_value_column": """
select 'events_out' as topic, cast(event_id as varchar) as "key", props as "value", cast(null as varchar) as headers
from events""",
    "sink_key_headers": f"""
select 'events_out' as topic, cast(user_id as varchar) as "key",
  to_json({{'event_type': event_type, 'value': value, 'props': props}})::varchar as "value",
  'ts=' || strftime(ts, {TS}) || case when event_type = 'view' then '' else ';note=' || event_type end
  || ';event_id=' || event_id as headers
from events""",
    "sink_tombstones": """
select 'events_out' as topic, cast(event_id as varchar) as "key",
  case when event_type <> 'error' then props end as "value", cast(null as varchar) as headers from events""",
    "append_offsets": """
select event_id, cast(user_id % 4 as integer) as "partition",
  row_number() over (partition by user_id % 4 order by event_id) - 1 as "offset" from events""",
    "sink_log_table": """
select 'orders' as topic, cast(o_custkey % 8 as integer) as "partition",
  row_number() over (partition by o_custkey % 8 order by o_orderkey % 5 >= 2, o_orderkey) - 1 as "offset",
  cast(o_orderkey as varchar) as "key", o_orderpriority as "value", '{}' as headers from orders""",
    "incremental_two_runs": f"""
with {EV}
select case when ts < {MID} then 1 else 2 end as run, part as "partition", off as "offset", k as "key", v as "value"
from ev""",
    "incremental_emptied_partition": f"""
with {EV}
select case when ts < {MID} then 1 when ts < {LATER} and part <> 2 then 2 else 3 end as run,
  part as "partition", off as "offset" from ev""",
    "stream_feed": f"""
with {EV}
select topic, part as "partition", off as "offset", k as "key", v as "value", {HEADERS} as headers from ev""",
    "stream_land": f"""
with {EV} select part as "partition", off as "offset", k as "key", v as "value" from ev""",
    "landed_counts": f"""
with {EV} select part as "partition", count(*) as messages from ev where ts >= {MID} group by part""",
    "consumer_lag": f"""
with {EV}, {AT}
select part as "partition", coalesce(at_off, low) as next_offset, high, high - coalesce(at_off, low) as lag
from marks left join at_mid using (part)""",
    "dedupe": f"""
with {EV}
select distinct topic, part as "partition", off as "offset", strftime(ts, {TS}) as "timestamp", k as "key",
  v as "value" from (select * from ev union all select * from ev where ts >= {MID})""",
    "compacted_view": f"""
with {EV},
last as (select part, k, max(off) as off from ev group by part, k)
select part as "partition", off as "offset", k as "key", v as "value"
from ev join last using (part, k, off) where event_type <> 'error'""",
    "stats_delta": f"""with {TICKS} select client, seq, requests, wire_bytes from deltas""",
    "stats_totals": f"""with {TICKS} select client, requests, wire_bytes from totals""",
    "stats_floor": f"""
with {TICKS}
select c_custkey as client, coalesce(requests, 1) as requests, coalesce(wire_bytes, 0) as wire_bytes
from customer left join totals on client = c_custkey""",
    "first_failure": f"""
with {REPORTS},
first as (select session, min(seq) as seq from reports where code is not null group by session)
select session, seq, code, reason, code in ({_texts(TRANSIENT_CODES)}) as transient
from (select distinct session from reports) left join first using (session)
left join (select session as s, seq as q, code, reason from reports) on s = session and q = seq""",
    "classify_errors": f"""
with {REPORTS}
select session, seq, code, coalesce(code in ({_texts(TRANSIENT_CODES)}), false) as transient from reports""",
    "redact_values": f"""select doc_id, {_masked("text")} as text from documents""",
    "redact_properties": f"""
select doc_id, regexp_replace(
  replace(text, 'token = ', 'sasl.password=') || ' ssl.key.password=' || source || ', ssl.keystore.password=' || lang
  || '; bootstrap.servers=b:9092',
  '\\b({_NAMES})=(?:"[^"]*"|[^\\s;,]+)', '\\1=***', 'g') as text from documents""",
    "feed_slice_many": """
with log as (select cast(o_custkey % 150 as integer) as part, o_orderkey as off, cast(o_custkey as varchar) as k from orders),
middle as (select part, (min(off) + max(off) + 1) // 2 as at_off from log group by part)
select part as "partition", off as "offset", k as "key" from log join middle using (part) where off >= at_off""",
    "watermarks_catalogue": f"""
with {TOPIC},
held as (select part, count(*) as high from topic group by part)
select p as "partition", case p when 1 then 7 when 2 then high else 0 end as low, coalesce(high, 0) as high
from (select cast(range as integer) as p from range(6)) left join held on part = p""",
    "topic_files": f"""
with {TOPIC}
select part as "partition", min(off) as first, max(off) + 1 as next, count(*) as records,
  strftime(min(ts), {TS}) as least_time, strftime(max(ts), {TS}) as greatest_time
from topic group by part""",
    "incremental_expired": f"""
with {TOPIC}
select append as run, part as "partition", off as "offset", k as "key", v as "value" from topic
union all
select 4, part, off, k, v from topic where not (part = 2 and append = 1) and not (part = 1 and append <= 2)""",
    "land_retry": f"""
with {TOPIC}
select case when append = 1 then 1 else 2 end as run, part as "partition", off as "offset", k as "key", v as "value" from topic""",
    "bounds_time_index": f"""
with {TOPIC}
select part as "partition", min(off) as at from topic where ts >= timestamp '2024-01-18 06:00:00' group by part""",
    "bounds_limited": f"""
with {TOPIC},
share as (select (count(*) // 3) // 4 as n from events)
select case when off < n then 1 when off < 2 * n then 2 else 3 end as run, part as "partition", off as "offset", k as "key"
from topic, share""",
    "append_offsets_blocks": """
select event_id, cast(user_id % 4 as integer) as "partition",
  row_number() over (partition by user_id % 4 order by event_id) - 1 + 1000 * (user_id % 4) as "offset" from events""",
    "stats_delta_two_runs": f"""with {TICKS}
select case when seq <= (select max(event_id) // 2 from events) then 1 else 2 end as run, client, seq, requests, wire_bytes
from deltas""",
    "stream_land_latest": f"""
with {EV},
begun as (select part, max(off) as last from ev where ts < {MID} group by part)
select case when ts < timestamp '2024-01-22 00:00:00' then 1 else 2 end as batch, part as "partition", off as "offset", k as "key",
  v as "value"
from ev left join begun using (part) where ts >= {MID} and off > coalesce(last, -1)""",
}
