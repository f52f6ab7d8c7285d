"""Queries over a tracker and over runs. Events are its updates: user_id the record, event_type the stage, 'error' a failure."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.operators import track as K
from quarrymill.plans.registry import query, table

_STAGE = {"view": "poster_parsed", "click": "paper_parsed", "signup": "figures_matched", "purchase": "training_data_created"}

#: An event of a stage succeeds where its value is at least 5; an 'error' event is a message where its value is over 200.
_LOG = """(SELECT user_id AS paper_id, CASE event_type WHEN 'view' THEN 'poster_parsed' WHEN 'click' THEN 'paper_parsed' WHEN 'signup' THEN 'figures_matched' WHEN 'purchase' THEN 'training_data_created' ELSE 'unknown' END AS stage,
  value >= 5 AS success, CASE WHEN event_type = 'error' AND value > 200 THEN 'failed ' || event_id END AS error, CASE WHEN event_type = 'view' THEN round(value)::INT END AS poster_figure_count,
  CASE WHEN event_type = 'click' THEN round(value)::INT END AS paper_figure_count, ts, event_id FROM events)"""


def _log(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    stage = F.lit("unknown")
    for k, name in _STAGE.items():
        stage = F.when(kind == k, name).otherwise(stage)
    count = lambda k: F.when(kind == k, F.round(value).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("paper_id"), stage.alias("stage"), (value >= 5).alias("success"), F.when((kind == "error") & (value > 200), F.concat(F.lit("failed "), "event_id")).alias("error"),
        count("view").alias("poster_figure_count"), count("click").alias("paper_figure_count"), "ts", "event_id",
    )


def _status(spark, sf_dir):
    return K.status(_log(spark, sf_dir), fields=("poster_figure_count", "paper_figure_count"), order=("ts", "event_id"))


_LAST = lambda column, cond: f"arg_max({column}, (ts, event_id)) FILTER ({cond})"
_STATUS = (
    "(SELECT paper_id, "
    + ", ".join(f"coalesce({_LAST('success', f"stage = '{s}'")}, false) AS {s}" for s in K.STAGES)
    + f", {_LAST('error', 'error IS NOT NULL')} AS error_message, {_LAST('poster_figure_count', 'poster_figure_count IS NOT NULL')} AS poster_figure_count, {_LAST('paper_figure_count', 'paper_figure_count IS NOT NULL')} AS paper_figure_count, min(ts) AS started_at, max(ts) AS last_updated FROM {_LOG} GROUP BY 1)"
)


@query(f"SELECT paper_id, {', '.join(K.STAGES)}, error_message, poster_figure_count, paper_figure_count, epoch_us(started_at) AS started_at, epoch_us(last_updated) AS last_updated FROM {_STATUS}")
def tracker_status(spark, sf_dir):
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(c)
    return _status(spark, sf_dir).select("paper_id", *K.STAGES, "error_message", "poster_figure_count", "paper_figure_count", micros("started_at"), micros("last_updated"))


@query(f"SELECT paper_id FROM {_STATUS} WHERE NOT poster_parsed")
def tracker_pending(spark, sf_dir):
    return K.pending(_status(spark, sf_dir), "poster_parsed").select("paper_id")


@query(f"SELECT paper_id FROM {_STATUS} WHERE training_data_created")
def tracker_completed(spark, sf_dir):
    return K.done(_status(spark, sf_dir)).select("paper_id")


@query(f"SELECT paper_id, error_message FROM {_STATUS} WHERE coalesce(error_message, '') <> ''")
def tracker_failed(spark, sf_dir):
    return K.failed(_status(spark, sf_dir)).select("paper_id", "error_message")


@query(f"SELECT count(*) AS total, {', '.join(f'count(*) FILTER ({s}) AS {s}' for s in K.STAGES)}, count(*) FILTER (coalesce(error_message, '') <> '') AS failed, round(sum(coalesce(poster_figure_count, 0)) / count(*), 6) AS avg_poster_figures, round(sum(coalesce(paper_figure_count, 0)) / count(*), 6) AS avg_paper_figures FROM {_STATUS}")
def tracker_summary(spark, sf_dir):
    out = K.summary(_status(spark, sf_dir), counts=K.COUNTS[:2])
    return out.withColumns({c: F.round(c, 6) for c in ("avg_poster_figures", "avg_paper_figures")})


@query(f"SELECT paper_id::VARCHAR AS paper_id, poster_parsed, error_message FROM {_STATUS} UNION ALL SELECT DISTINCT doc_id::VARCHAR, false, NULL FROM documents WHERE doc_id NOT IN (SELECT user_id FROM events)")
def tracker_init_missing(spark, sf_dir):
    source = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"))
    return K.initialized(_status(spark, sf_dir), source).select("paper_id", "poster_parsed", "error_message")


@query("SELECT event_type AS stage, count(*) FILTER (value >= 5 AND user_id % 10 <> 0) AS processed, count(*) FILTER (value < 5 AND user_id % 10 <> 0) AS failed, count(*) FILTER (user_id % 10 = 0) AS skipped FROM events GROUP BY 1")
def stage_counters(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), (F.col("value") >= 5).alias("success"), (F.col("user_id") % 10 == 0).alias("skipped"))
    return K.stage_counters(log)


#: A run's results: purchases are completed items, errors failed ones, the others are not worked on.
@query("SELECT count(*) AS total, count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'error') AS failed, 0::BIGINT AS skipped, round(count(*) FILTER (event_type = 'purchase') * 0.003, 6)::DOUBLE AS cost FROM events WHERE event_type IN ('purchase', 'error')")
def run_stats(spark, sf_dir):
    from quarrymill.operators.assemble import run_stats as stats

    results = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "error")).select((F.col("event_type") == "purchase").alias("success"))
    return stats(results)


@query("SELECT n, start, lim, greatest(0, least(coalesce(nullif(lim, 0), n), n - start)) AS items, round(greatest(0, least(coalesce(nullif(lim, 0), n), n - start)) * 0.003, 6)::DOUBLE AS cost FROM (SELECT count(*) AS n FROM documents), (VALUES (0, 0), (0, 50), (100, 0), (150, 100)) t(start, lim)")
def cost_estimate(spark, sf_dir):
    from quarrymill.operators.assemble import cost_estimate as estimate

    n = table(spark, sf_dir, "documents").agg(F.count("*").alias("n"))
    asked = spark.createDataFrame([(0, 0), (0, 50), (100, 0), (150, 100)], "start int, lim int")
    return estimate(asked.join(n, F.lit(True)), "n", "start", "lim")


@query("SELECT user_id, completed, round(seconds / 60, 6) AS minutes, CASE WHEN seconds > 0 THEN round(completed / (seconds / 60), 6) END AS per_minute FROM (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS completed, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM events GROUP BY 1)")
def duration_rate(spark, sf_dir):
    from quarrymill.operators.assemble import durations

    return durations(table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") == "purchase")


@query("SELECT count(*) AS done FROM events WHERE event_type IN ('purchase', 'error')")
def done_count(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "error")).agg(F.count("*").alias("done"))


@query("SELECT user_id, event_id, count(*) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS progress, count(*) OVER (PARTITION BY user_id) AS total FROM events")
def progress_counts(spark, sf_dir):
    from pyspark.sql import Window as W

    mine = W.partitionBy("user_id")
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.count_if(F.col("event_type") == "purchase").over(mine.orderBy("ts", "event_id")).alias("progress"), F.count("*").over(mine).alias("total"))


@query("SELECT DISTINCT user_id FROM (SELECT user_id FROM events WHERE event_type = 'purchase' UNION ALL SELECT user_id + 100 FROM events WHERE event_type = 'error')")
def set_add(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.where("event_type = 'purchase'").select("user_id").union(e.where("event_type = 'error'").select(F.col("user_id") + 100)).distinct()


@query("SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(t) % 1000000 = 0 THEN '' ELSE strftime(t, '.%f') END AS iso, strftime(t, '%Y%m%d_%H%M%S') AS stamp, (epoch_us(t) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 AS seconds FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN date_trunc('second', ts) ELSE ts END AS t FROM events)")
def timestamps_text(spark, sf_dir):
    """Times as text; every fifth is put on a whole second, whose form has no fraction."""
    from quarrymill.functions import scan as S

    ts = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, F.date_trunc("second", ts)).otherwise(ts).alias("ts"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").cast("timestamp")
    return rows.select("event_id", S.iso(F.col("ts")).alias("iso"), S.stamp(F.col("ts")).alias("stamp"), S.elapsed(start, F.col("ts")).alias("seconds"))


@query("SELECT event_id, user_id, lang, source FROM events LEFT JOIN documents ON user_id = doc_id")
def metadata_lookup(spark, sf_dir):
    from quarrymill.operators.tables import details

    ids = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("doc_id"))
    return details(ids, table(spark, sf_dir, "documents"), "doc_id", "lang", "source").withColumnRenamed("doc_id", "user_id")
