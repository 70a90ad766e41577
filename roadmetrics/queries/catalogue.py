"""Topic catalogues, set operations, nested fields, fingerprints, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .base import EV, events, query, table


@query(f"WITH {EV} SELECT topic, count(*) AS messages, min(t) AS first_t, max(t) AS last_t, max(t) - min(t) AS duration FROM ev GROUP BY topic")
def topic_catalogue(spark, sf_dir):
    from ..sources.catalogue import topic_catalogue as catalogue

    return catalogue(events(spark, sf_dir))


@query(f"WITH {EV} SELECT topic, count(*) AS messages, count(DISTINCT drive_id) AS bags FROM ev GROUP BY topic")
def topic_catalogue_across_bags(spark, sf_dir):
    per_bag = events(spark, sf_dir).groupBy("topic", "drive_id").agg(F.count(F.lit(1)).alias("n"))
    return per_bag.groupBy("topic").agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("bags"))


@query(f"WITH {EV} SELECT r.topic FROM (SELECT unnest(['view', 'click', 'purchase', 'map', 'planning']) AS topic) r WHERE r.topic NOT IN (SELECT topic FROM ev)")
def required_minus_available(spark, sf_dir):
    from ..sources.catalogue import missing_topics

    return missing_topics(events(spark, sf_dir), ["view", "click", "purchase", "map", "planning"])


@query(f"WITH {EV} SELECT topic FROM ev UNION SELECT c_mktsegment FROM customer")
def union_topics(spark, sf_dir):
    return events(spark, sf_dir).select("topic").union(table(spark, sf_dir, "customer").select("c_mktsegment")).distinct()


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), -1) AS k, coalesce(CAST(json_extract(props, '$.missing') AS BIGINT), 0) AS missing FROM events")
def nested_default(spark, sf_dir):
    parsed = F.from_json("props", "k bigint, missing bigint")
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(parsed["k"], F.lit(-1)).alias("k"), F.coalesce(parsed["missing"], F.lit(0)).alias("missing"))


@query("""WITH a AS (SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: x <> '') AS w FROM part) SELECT p_partkey, coalesce(w[2], w[1]) AS lane FROM a""")
def array_second_nonempty(spark, sf_dir):
    from ..plans.scene import current_lane

    return table(spark, sf_dir, "part").select("p_partkey", current_lane(F.split("p_name", " ")).alias("lane"))


@query(f"WITH {EV} SELECT event_id, substr(md5(topic || ':' || drive_id || ':' || event_id), 1, 16) AS fingerprint FROM ev")
def fingerprint_md5(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", F.substring(F.md5(F.concat_ws(":", "topic", "drive_id", "event_id").cast("binary")), 1, 16).alias("fingerprint"))


@query(f"WITH {EV} SELECT event_id FROM ev WHERE regexp_matches(topic, 'error|purch')")
def description_predicate(spark, sf_dir):
    return events(spark, sf_dir).filter(F.col("topic").rlike("error|purch")).select("event_id")


@query(f"""WITH {EV}, c AS (SELECT *, CASE WHEN value < 20 THEN 'straight' WHEN value < 50 THEN 'small_curve' ELSE 'large_curve' END AS road FROM ev),
    b AS (SELECT *, CASE WHEN lag(road) OVER (PARTITION BY drive_id ORDER BY t, event_id) IS DISTINCT FROM road THEN 1 ELSE 0 END AS brk FROM c),
    i AS (SELECT *, sum(brk) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS island FROM b)
    SELECT drive_id, road, count(*) AS points, min(t) AS start_ts FROM i GROUP BY drive_id, road, island HAVING count(*) > 1""")
def refline_segments(spark, sf_dir):
    from ..operators.islands import number_islands
    from .base import by_time

    road = F.when(F.col("value") < 20, "straight").when(F.col("value") < 50, "small_curve").otherwise("large_curve")
    c = events(spark, sf_dir).withColumn("road", road)
    c = c.withColumn("_b", ~F.lag("road").over(by_time()).eqNullSafe(F.col("road")))
    rows = number_islands(c, ["drive_id"], ["t", "event_id"], F.col("_b"))
    return rows.groupBy("drive_id", "road", "island").agg(F.count(F.lit(1)).alias("points"), F.min("t").alias("start_ts")).filter("points > 1").drop("island")
