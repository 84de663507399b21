"""Queries over telemetry: rates, ratios, quantiles, gauges and name mapping, with ``events`` as the telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import counters, metrics
from docflow.operators.statsd import RULES
from docflow.plans.registry import query


def _events(spark, sf_dir):
    return metrics.telemetry(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _sliding(size: int, step: int, body: str, tail: str = "") -> str:
    starts = f"SELECT *, make_timestamp(((floor(epoch(ts) / {step}) * {step} - k * {step}) * 1000000)::bigint) AS window_start FROM events, (SELECT unnest(range({size // step})) AS k)"
    return f"WITH w AS ({starts}) SELECT window_start, {body} FROM w GROUP BY window_start{tail}"


@query(_sliding(300, 60, "round(count_if(event_type <> 'error')::double / count(*) * 100, 6) AS success_pct, CASE WHEN count_if(event_type <> 'error')::double / count(*) * 100 >= 95 THEN 'ok' WHEN count_if(event_type <> 'error')::double / count(*) * 100 >= 85 THEN 'warn' ELSE 'alert' END AS state"))
def success_rate_5m(spark, sf_dir):
    return metrics.success_rate(_events(spark, sf_dir), "5 minutes", "1 minute").withColumn("success_pct", F.round("success_pct", 6))


@query(_sliding(300, 60, "event_type AS stage, round(count(*) / 300.0, 9)::double AS per_second", ", event_type").replace("GROUP BY window_start, event_type", "GROUP BY window_start, event_type"))
def request_rate(spark, sf_dir):
    return metrics.rate(_events(spark, sf_dir), "5 minutes", "1 minute", 300, by=("stage",)).withColumn("per_second", F.round("per_second", 9))


@query(_sliding(300, 60, "round(count_if(event_type = 'error') / 300.0, 9)::double AS per_second").replace("FROM w GROUP", "FROM w WHERE event_type = 'error' GROUP"))
def error_rate(spark, sf_dir):
    e = _events(spark, sf_dir).where(~F.col("success"))
    return metrics.rate(e, "5 minutes", "1 minute", 300).withColumn("per_second", F.round("per_second", 9))


@query(_sliding(3600, 600, "count(*)::double AS per_hour"))
def files_per_hour(spark, sf_dir):
    return metrics.rate(_events(spark, sf_dir), "1 hour", "10 minutes", 1).withColumnRenamed("per_second", "per_hour")


BOUNDS = "[" + ", ".join(map(str, metrics.BUCKETS)) + "]"
#: Values of the telemetry, in seconds.
SECONDS = "(value / 20)"


@query(
    f"""WITH b AS (SELECT event_type AS stage, list_position(list_transform({BOUNDS}, lambda x: {SECONDS} <= x), true) AS i FROM events),
    n AS (SELECT stage, coalesce(i, {len(metrics.BUCKETS) + 1}) AS i, count(*) AS c FROM b GROUP BY ALL),
    g AS (SELECT stage, g.i FROM (SELECT DISTINCT stage FROM n), (SELECT unnest(range(1, {len(metrics.BUCKETS) + 2})) AS i) g),
    cum AS (SELECT stage, i, coalesce(c, 0) AS c, sum(coalesce(c, 0)) OVER (PARTITION BY stage ORDER BY i) AS upto, sum(coalesce(c, 0)) OVER (PARTITION BY stage) AS total FROM g LEFT JOIN n USING (stage, i)),
    hit AS (SELECT stage, min(i) AS i FROM cum WHERE upto >= 0.95 * total GROUP BY stage)
    SELECT stage, round(CASE WHEN i > {len(metrics.BUCKETS)} THEN {metrics.BUCKETS[-1]} ELSE coalesce({BOUNDS}[i - 1], 0) + ({BOUNDS}[i] - coalesce({BOUNDS}[i - 1], 0)) * (0.95 * total - (upto - c)) / c END, 6)::double AS p95 FROM hit JOIN cum USING (stage, i)"""
)
def p95_histogram(spark, sf_dir):
    """Interpolated in the cumulative histogram of fixed buckets."""
    return metrics.histogram_quantile(_events(spark, sf_dir), 0.95, by=("stage",)).select("stage", F.round("quantile", 6).alias("p95"))


@query(f"SELECT event_type AS stage, round(quantile_cont({SECONDS}, 0.95), 9) AS p95, round(quantile_cont({SECONDS}, 0.5), 9) AS p50 FROM events GROUP BY event_type")
def p95_exact(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.groupBy("stage").agg(F.round(F.percentile("seconds", 0.95), 9).alias("p95"), F.round(F.percentile("seconds", 0.5), 9).alias("p50"))


@query("SELECT event_type AS stage, arg_max(value / 20, (ts, event_id)) AS value FROM events GROUP BY event_type")
def active_gauge(spark, sf_dir):
    """The last value of each series."""
    return metrics.last_value(_events(spark, sf_dir), by=("stage",))


@query("SELECT lang AS target_language, count(*)::bigint AS n FROM documents GROUP BY lang")
def language_distribution(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy(F.col("lang").alias("target_language")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT least(floor(n_chars / 500), 20)::bigint AS bucket, count(*)::bigint AS n FROM documents GROUP BY ALL")
def quality_histogram(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.groupBy(F.least(F.floor(F.col("n_chars") / 500), F.lit(20)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type AS stage, (props->>'k')::bigint AS k, count(*)::bigint AS n FROM events WHERE contains(event_type, 'c') AND json_valid(props) GROUP BY ALL")
def log_filter(spark, sf_dir):
    """Log lines that contain a word, their JSON read."""
    e = _events(spark, sf_dir).where(F.contains("stage", F.lit("c")))
    parsed = e.withColumn("j", F.from_json("labels", "k bigint")).where("j is not null")
    return parsed.groupBy("stage", F.col("j.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(_sliding(300, 60, "round(count_if(event_type <> 'error') / 300.0 * (SELECT avg(value) FROM events), 6)::double AS tokens_per_second").replace("FROM w GROUP", "FROM w WHERE event_type <> 'error' GROUP"))
def token_rate(spark, sf_dir):
    """The rate of successes times the mean tokens of one."""
    e = _events(spark, sf_dir)
    r = metrics.rate(e.where("success"), "5 minutes", "1 minute", 300)
    mean = e.agg((F.avg("seconds") * 20).alias("tokens"))  # one row
    return r.crossJoin(F.broadcast(mean)).select("window_start", F.round(F.col("per_second") * F.col("tokens"), 6).alias("tokens_per_second"))


@query("WITH u AS (SELECT user_id % 10 AS host, date_trunc('hour', ts) AS hour, avg(value) FILTER (WHERE event_type <> 'view') AS used, max(value) AS lim FROM events GROUP BY ALL) SELECT host, hour, round(used / lim * 100, 6) AS pct FROM u WHERE lim > 0 AND used IS NOT NULL")
def resource_usage(spark, sf_dir):
    """Used against limit, joined by host and hour."""
    e = _events(spark, sf_dir).select((F.col("user_id") % 10).alias("host"), F.date_trunc("hour", "ts").alias("hour"), "stage", (F.col("seconds") * 20).alias("v"))
    used = e.where("stage <> 'view'").groupBy("host", "hour").agg(F.avg("v").alias("used"))
    limit = e.groupBy("host", "hour").agg(F.max("v").alias("lim")).where("lim > 0")
    return used.join(limit, ["host", "hour"]).select("host", F.col("hour").cast("timestamp_ntz").alias("hour"), F.round(F.col("used") / F.col("lim") * 100, 6).alias("pct"))


LIFETIME, RANGE, STEP = 86_400, 21_600, 3_600


def _counter_sql(by: str, rows: str = "events") -> str:
    """CTEs up to ``r``: rates of the counts of rows by series, from differences to the sample before in the whole series."""
    return f"""s AS (SELECT {by} AS series, epoch_us(ts) AS t, event_id AS eid, row_number() OVER (PARTITION BY {by}, epoch_us(ts) // {LIFETIME * 1_000_000} ORDER BY ts, event_id)::double AS v FROM {rows}),
    d AS (SELECT *, lag(v) OVER (PARTITION BY series ORDER BY t, eid) AS b FROM s),
    g AS (SELECT *, CASE WHEN v < b THEN v ELSE v - b END AS grown, (v < b)::bigint AS reset FROM d),
    w AS (SELECT *, (t // {STEP * 1_000_000} - k) * {STEP * 1_000_000} AS start FROM g, (SELECT unnest(range({RANGE // STEP})) AS k)),
    a AS (SELECT series, start, count(*) AS n, min(t) / 1e6 AS t0, max(t) / 1e6 AS t1, arg_min(v, (t, eid)) AS v0,
            coalesce(sum(grown), 0) - coalesce(arg_min(coalesce(grown, 0), (t, eid)), 0) AS inc, coalesce(sum(reset), 0) - coalesce(arg_min(coalesce(reset, 0), (t, eid)), 0) AS resets FROM w GROUP BY ALL),
    e AS (SELECT *, t1 - t0 AS span, (t1 - t0) / (n - 1) AS mean, t0 - start / 1e6 AS f, start / 1e6 + {RANGE} - t1 AS l FROM a WHERE n > 1 AND t1 > t0),
    x AS (SELECT *, CASE WHEN f >= mean * 1.1 THEN mean / 2 ELSE f END AS front, CASE WHEN l >= mean * 1.1 THEN mean / 2 ELSE l END AS back, CASE WHEN inc > 0 THEN span * v0 / inc END AS zero FROM e),
    r AS (SELECT series, make_timestamp(start) AS window_start, n::bigint AS samples, resets::bigint AS resets, inc * (span + least(front, zero) + back) / span AS increase FROM x)"""


@query(f"WITH {_counter_sql('event_type')} SELECT series AS stage, window_start, samples, resets, round(increase, 6) AS increase, round(increase / {RANGE}, 9) AS per_second FROM r")
def counter_rate(spark, sf_dir):
    """Rates of request counters that restart every day, carried to the edges of windows."""
    r = counters.rates(counters.samples(_events(spark, sf_dir), ["stage"], LIFETIME), ["stage"], RANGE, STEP)
    return r.where("increase is not null").withColumns({"increase": F.round("increase", 6), "per_second": F.round("per_second", 9)})


@query(
    f"WITH {_counter_sql('event_type <> ' + chr(39) + 'error' + chr(39))}, p AS (SELECT window_start, sum(increase) AS total, sum(increase) FILTER (WHERE series) AS ok FROM r GROUP BY window_start) "
    "SELECT window_start, round(coalesce(ok, 0) / total * 100, 6) AS success_pct FROM p WHERE total > 0"
)
def counter_success_rate(spark, sf_dir):
    """The rate of the counter of successes over that of both counters."""
    r = counters.rates(counters.samples(_events(spark, sf_dir), ["success"], LIFETIME), ["success"], RANGE, STEP).where("increase is not null")
    p = r.groupBy("window_start").agg(F.sum("increase").alias("total"), F.sum(F.when(F.col("success"), F.col("increase"))).alias("ok")).where("total > 0")
    return p.select("window_start", F.round(F.coalesce("ok", F.lit(0.0)) / F.col("total") * 100, 6).alias("success_pct"))


ERROR_LABELS = "(SELECT ts, event_id, 'stage' || (user_id % 4) || '/' || CASE WHEN value < 5 THEN 'timeout' WHEN value < 20 THEN 'parse' ELSE 'model' END AS label FROM events WHERE event_type = 'error')"


@query(f"WITH {_counter_sql('label', ERROR_LABELS)} SELECT split_part(series, '/', 1) AS stage, split_part(series, '/', 2) AS error_type, window_start, round(increase / {RANGE}, 9) AS per_second FROM r")
def error_rate_by_stage(spark, sf_dir):
    """Rates of the error counters of each stage and type of error."""
    kind = F.when(F.col("value") < 5, "timeout").when(F.col("value") < 20, "parse").otherwise("model")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'error'").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", F.concat(F.lit("stage"), F.col("user_id") % 4).alias("stage"), kind.alias("error_type"))
    by = ["stage", "error_type"]
    r = counters.rates(counters.samples(e, by, LIFETIME), by, RANGE, STEP).where("increase is not null")
    return r.select(*by, "window_start", F.round("per_second", 9).alias("per_second"))


NAMES = (
    "CASE event_id % 9 WHEN 0 THEN 'pdf.pipeline.' || event_type || '.duration' WHEN 1 THEN 'pdf.dag.d' || (user_id % 3) || '.' || event_type || '.duration' "
    "WHEN 2 THEN 'pdf.dag.d' || (user_id % 3) || '.tasks.active' WHEN 3 THEN 'pdf.dag.d1.errors.' || event_type WHEN 4 THEN 'vllm.requests.' || event_type WHEN 5 THEN 'vllm.requests.' || event_type || '.duration' "
    "WHEN 6 THEN 'pdf.quality.overall.score' WHEN 7 THEN 'flask.api.' || event_type || '.errors.500' ELSE 'other.x' END"
)


def _rule_sql() -> str:
    rx = lambda glob: "^" + glob.replace(".", "[.]").replace("*", "([^.]+)") + "$"
    pick = lambda f: "CASE " + " ".join(f"WHEN regexp_matches(m, '{rx(g)}') THEN {f(g, metric, stars)}" for g, metric, stars in RULES) + " END"
    label = lambda g, _, stars: " || ',' || ".join(f"'{s}=' || regexp_extract(m, '{rx(g)}', {i + 1})" for i, s in sorted(enumerate(stars), key=lambda x: x[1])) or "''"
    return f"SELECT metric, labels, count(*)::bigint AS n FROM (SELECT {pick(lambda g, metric, _: repr(metric))} AS metric, coalesce({pick(label)}, '') AS labels FROM (SELECT {NAMES} AS m FROM events)) GROUP BY ALL"


@query(_rule_sql())
def statsd_mapping(spark, sf_dir):
    """Dotted names to a metric and labels, first rule first."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.expr(NAMES).alias("m")).select(metrics.mapped_name(F.col("m")).alias("x"))
    labels = F.array_join(F.transform(F.array_sort(F.map_entries("x.labels")), lambda p: F.concat(p["key"], F.lit("="), p["value"])), ",")
    return e.select("x.metric", labels.alias("labels")).groupBy("metric", "labels").agg(F.count(F.lit(1)).alias("n"))


SERIES = "CASE event_id % 3 WHEN 0 THEN 'vllm_requests_total' WHEN 1 THEN 'pdf_converter_errors' ELSE 'other_vllm_total' END"


@query(f"SELECT metric, CASE WHEN metric = 'vllm_requests_total' THEN 'model_architecture=a3b,model_name=qwen3-30b-a3b-instruct,stage=' || event_type ELSE 'model_name=' || event_type || ',stage=' || event_type END AS labels, count(*)::bigint AS n FROM (SELECT {SERIES} AS metric, event_type FROM events) GROUP BY ALL")
def labelled_metrics(spark, sf_dir):
    """Labels that rules put on metrics by name."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.expr(SERIES).alias("metric"), "event_type")
    labels = metrics.labelled(F.col("metric"), F.create_map(F.lit("stage"), F.col("event_type"), F.lit("model_name"), F.col("event_type")))
    told = F.array_join(F.transform(F.array_sort(F.map_entries(labels)), lambda p: F.concat(p["key"], F.lit("="), p["value"])), ",")
    return e.select("metric", told.alias("labels")).groupBy("metric", "labels").agg(F.count(F.lit(1)).alias("n"))


@query("WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g) SELECT user_id, min(ts) AS session_start, count(*)::bigint AS n FROM s GROUP BY user_id, sid")
def session_windows(spark, sf_dir):
    e = _events(spark, sf_dir)
    s = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), "n")
