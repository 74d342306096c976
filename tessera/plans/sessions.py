"""Session requests: users stand for sessions, events for requests whose action follows from their id."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tessera.plans.common import query, table
from tessera.streaming import sessions

ACTION_OF = ["start", "add_prompt", "add_prompt", "remove_object", "add_prompt", "propagate", "add_prompt", "reset", "add_prompt", "close", "remove_object", "unheard"]
TTL = timedelta(hours=36)

#: One request after another: a session's state is a row of the recursion.
_SQL = f"""with recursive q as (select user_id as session, event_id as seq, ts, {ACTION_OF}[event_id % 12 + 1] as action, event_id % 5 as obj, row_number() over (partition by user_id order by ts, event_id) as rn from events),
r as (select session, 0::bigint as rn, null::bigint as seq, null::timestamp as ts, ''::varchar as action, false as ok, 0 as life, false as was, false as alive, null::timestamp as last, 0 as prompts, []::bigint[] as objs from (select distinct session from q)
  union all select session, rn, seq, ts, action, action in ('start', 'close') or (valid and action <> 'unheard'), life + started, valid or started = 1, action <> 'close' and (valid or started = 1), case when valid or started = 1 then ts else last end,
    case when action in ('start', 'reset', 'close') or not valid then 0 else prompts + (action = 'add_prompt')::int end,
    case when action in ('start', 'reset', 'close') or not valid then []::bigint[] when action = 'add_prompt' then list_distinct(list_append(objs, obj)) when action = 'remove_object' then list_filter(objs, lambda x: x <> obj) else objs end
  from (select q.*, (q.action = 'start')::int as started, r.alive and q.ts - r.last <= interval 36 hours as valid, r.life, r.last, r.prompts, r.objs from r join q on q.session = r.session and q.rn = r.rn + 1)),
a as (select *, coalesce(lead(ts) over (partition by session order by rn), (select max(ts) from q)) as upto from r where rn > 0)
select session, seq, ts as at, action, ok, case when was then life end as lifetime, prompts::bigint as prompts, len(objs) as objects from a
union all select session, null, last + interval 36 hours, 'expired', true, life, 0, 0 from a where alive and upto - ts > interval 36 hours"""


@query(_SQL)
def n12_sessions(spark, sf_dir):
    """What each request of a session leads to, and the sessions given up."""
    action = F.element_at(F.array(*map(F.lit, ACTION_OF)), (F.col("event_id") % 12 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("at"), action.alias("action"), (F.col("event_id") % 5).alias("obj"))
    return sessions.session_answers(e, TTL).withColumn("at", F.col("at").cast("timestamp_ntz"))
