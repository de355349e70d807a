"""Message sinks with a commit and streams of complete cycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import plain, scratch, table
from catalog.registry import query
from changemill.operators import messages
from changemill.sinks import message_log
from changemill.sinks.store import Store
from changemill.sources import cycle_source
from changemill.streaming import cycles


def _messages(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return messages.partition_key(messages.to_envelope(rows, "events", "cdc", "body"), ["user_id"]).select("event_type", "partition_key", "event_id", "body")


_SENT = plain("""SELECT event_type, CAST(user_id AS VARCHAR) AS partition_key, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM {events}""")


def _log(spark, path):
    spark.dataSource.register(message_log.MessageLog)
    return spark.read.format(message_log.FORMAT).load(path)


@query("publish_sink", _SENT)
def publish_sink(spark, sf):
    """Messages of each event type in order; the batch is sent twice and committed once."""
    path = scratch(spark, "log")
    spark.dataSource.register(message_log.MessageLog)
    for _ in range(2):
        dealt = message_log.send(_messages(spark, sf), ["event_type"], ["event_id"])
        dealt.write.format(message_log.FORMAT).mode("append").option("tag", "cycle-1").save(path)
    # a destination's messages lie in one part, in their order
    found = _log(spark, path).groupBy("event_type", "part").agg(F.array_sort(F.collect_list(F.struct("place", "event_id", "partition_key"))).alias("m"))
    found = found.select("event_type", F.posexplode("m").alias("p", "m"))
    return found.select("event_type", "m.partition_key", "m.event_id", (F.col("p") + 1).cast("long").alias("n"))


@query("publish_sink_counts", plain("SELECT 'cycle-' || CAST(k AS VARCHAR) AS commit, count(*) AS n_rows FROM {events}, (SELECT unnest([1, 2]) AS k) x WHERE k = 1 OR event_type = 'click' GROUP BY k"))
def publish_sink_counts(spark, sf):
    """Messages sent by two batches, from their commits."""
    path = scratch(spark, "log")
    spark.dataSource.register(message_log.MessageLog)
    for tag, rows in (("cycle-1", _messages(spark, sf)), ("cycle-2", _messages(spark, sf).filter("event_type = 'click'"))):
        rows.write.format(message_log.FORMAT).mode("append").option("tag", tag).save(path)
    return message_log.sent(spark, path).select("commit", "n_rows")


_CYCLE = "CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END"


@query("cycle_source", plain(f"""SELECT event_id, event_type, CAST({_CYCLE} AS BIGINT) AS cycle,
    CASE WHEN {_CYCLE} = 0 THEN 'events-0' ELSE 'events-1' END AS commit FROM {{events}}"""))
def cycle_stream(spark, sf):
    """Three cycles whose manifests are there from the start; the files of the second come late, and
    hold back the third. Each run of the stream sends what is complete."""
    root = scratch(spark, "cycles")
    rows = table(spark, sf, "events").select("event_id", "event_type", F.expr(_CYCLE).alias("k"))

    def stage(*ks):
        rows.filter(F.col("k").isin(*ks)).write.mode("append").partitionBy("k").parquet(f"{root}/in")

    stage(0, 2)
    store = Store(f"{root}/in")
    for k in (0, 2):
        cycle_source.write_manifest(store.path, k, [f"k={k}/{n}" for n in store.names(f"k={k}") if n.endswith(".parquet")])
    cycle_source.write_manifest(store.path, 1, ["k=1/late.parquet"])

    def run():
        source = cycles.cycle_stream(spark, store.path, "event_id long, event_type string, cycle long")
        cycles.message_stream(source, f"{root}/out", f"{root}/checkpoint", "events").awaitTermination()

    run()
    if cycle_source.waiting(store, 0) != [(1, 1, 1), (2, len(cycle_source.files_of(store, 2)), 0)]:
        raise AssertionError("the second cycle should wait for its file")
    stage(1)
    late = [f"k=1/{n}" for n in store.names("k=1") if n.endswith(".parquet")]
    cycle_source.write_manifest(store.path, 1, late)
    run()
    return _log(spark, f"{root}/out").select("event_id", "event_type", "cycle", "commit")
