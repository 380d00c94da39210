"""Registered queries: message admission, replies, busy flags and throttled send times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators import admission
from talkloom.operators.busy import busy_at_arrival as flag_busy
from talkloom.operators.throttle import throttle_schedule as schedule
from talkloom.plans import inputs as I

GAP_US = 600_000_000
NOTICES = admission.Notices()


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as messages: all but the system's are new ones addressed to us."""
    to_us = F.col("role") != "system"
    return I.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "text",
        F.when(to_us, F.lit("message_new")).otherwise(F.lit("service")).alias("type"),
        to_us.alias("to_me"),
    )


def _admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a conversation's first message finds another one being answered
    return admission.admit(admission.new_for_us(messages(spark, sf_dir)), busy=F.col("turn") == 0)


def messages_admit(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array_join(F.transform("replies", lambda r: r["kind"]), ",")
    return _admitted(spark, sf_dir).select("conv_id", "turn", "admission", kinds.alias("kinds"))


_ADMITTED_SQL = """admitted AS (
  SELECT conv_id, turn, text, turn = 0 AS busy,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty' WHEN length(text) > 1200 THEN 'too_long'
      WHEN length(text) > 400 THEN 'long' ELSE 'normal' END AS admission
  FROM conversations WHERE role <> 'system')"""

MESSAGES_ADMIT = f"""WITH {_ADMITTED_SQL}
SELECT conv_id, turn, admission, CASE admission WHEN 'empty' THEN 'no_text'
  WHEN 'too_long' THEN CASE WHEN busy THEN 'wait,busy,too_long' ELSE 'wait,too_long' END
  WHEN 'long' THEN CASE WHEN busy THEN 'wait,busy,answer' ELSE 'wait,answer' END
  ELSE CASE WHEN busy THEN 'busy,answer' ELSE 'answer' END END AS kinds
FROM admitted"""


def messages_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = admission.replies(_admitted(spark, sf_dir))
    return sent.select("conv_id", "turn", F.col("reply_no").cast("bigint").alias("reply_no"), "kind", "reply")


def replies_sql(answer: str = "NULL") -> str:
    return f"""WITH {_ADMITTED_SQL},
options AS (
  SELECT conv_id, turn, 0 AS o, 'no_text' AS kind, {I.quote(NOTICES.no_text)} AS reply FROM admitted
    WHERE admission = 'empty'
  UNION ALL SELECT conv_id, turn, 1, 'wait', {I.quote(NOTICES.wait)} FROM admitted
    WHERE admission IN ('long', 'too_long')
  UNION ALL SELECT conv_id, turn, 2, 'busy', {I.quote(NOTICES.busy)} FROM admitted WHERE busy AND admission <> 'empty'
  UNION ALL SELECT conv_id, turn, 3, 'too_long', {I.quote(NOTICES.too_long)} FROM admitted WHERE admission = 'too_long'
  UNION ALL SELECT conv_id, turn, 4, 'answer', {answer} FROM admitted WHERE admission IN ('normal', 'long'))
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY o) - 1 AS reply_no, kind, reply
FROM options"""


MESSAGES_REPLIES = replies_sql()


def throttle_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = I.table(spark, sf_dir, "events").select("event_id", "user_id", I.micros("ts").alias("arrive_us"))
    return schedule(events, "user_id", "arrive_us", "event_id", GAP_US)


# the rule itself, request after request
THROTTLE_SCHEDULE = f"""WITH RECURSIVE ordered AS (
  SELECT event_id, user_id, epoch_us(ts) AS arrive_us,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
sent AS (
  SELECT event_id, user_id, arrive_us, n, arrive_us AS send_us FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.event_id, o.user_id, o.arrive_us, o.n, greatest(o.arrive_us, s.send_us + {GAP_US})
  FROM sent s JOIN ordered o ON o.user_id = s.user_id AND o.n = s.n + 1)
SELECT event_id, user_id, arrive_us, send_us, send_us - arrive_us AS delay_us FROM sent"""


def busy_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests at one endpoint that run for `value` seconds."""
    return (
        I.table(spark, sf_dir, "events")
        .select(
            "event_id", "user_id", F.lit("bot").alias("endpoint"), I.micros("ts").alias("start_us"),
            F.round(F.col("value") * 1_000_000).cast("bigint").alias("run_us"),
        )
        .withColumn("finish_us", F.col("start_us") + F.col("run_us"))
    )


def busy_at_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_busy(busy_requests(spark, sf_dir), "endpoint", "user_id", "start_us", "finish_us", "event_id")
    return flagged.select("event_id", "user_id", "start_us", "finish_us", "busy")


BUSY_AT_ARRIVAL = """WITH requests AS (
  SELECT event_id, user_id, epoch_us(ts) AS start_us,
    epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) AS finish_us FROM events),
running AS (
  SELECT r.event_id, count(*) FILTER (WHERE o.user_id <> r.user_id) AS others,
    count(*) FILTER (WHERE o.user_id = r.user_id) AS own
  FROM requests r JOIN requests o ON o.start_us <= r.start_us AND o.finish_us > r.start_us
    AND (o.start_us < r.start_us OR o.event_id < r.event_id)
  GROUP BY r.event_id)
SELECT r.event_id, r.user_id, r.start_us, r.finish_us, coalesce(x.others > 0 AND x.own = 0, false) AS busy
FROM requests r LEFT JOIN running x ON x.event_id = r.event_id"""

QUERIES = {
    "messages_admit": (messages_admit, MESSAGES_ADMIT),
    "messages_replies": (messages_replies, MESSAGES_REPLIES),
    "throttle_schedule": (throttle_schedule, THROTTLE_SCHEDULE),
    "busy_at_arrival": (busy_at_arrival, BUSY_AT_ARRIVAL),
}
