"""Message-bus stream source.

Uses Spark's Kafka source when its connector is on the class path. Without
it, the same envelope columns come from a file stream of envelopes (see
``Lakehouse.bronze_bus``); all later operators only need
the envelope schema, not the transport.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def bus_available(spark: SparkSession) -> bool:
    """True when the Kafka source class can be loaded by the session."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def bus_stream(spark: SparkSession, servers: str, topics: str | list[str],
               starting_timestamp: int = 1, max_offsets: int = 10000,
               options: dict[str, str] | None = None) -> DataFrame:
    """Subscribe to ``topics``; rate-limited by ``max_offsets`` per trigger.

    ``starting_timestamp`` is epoch milliseconds (1 = from the beginning).
    Security settings (SASL etc.) pass through ``options`` as
    ``kafka.*`` keys supplied by the caller.
    """
    if not bus_available(spark):
        raise RuntimeError("Kafka connector not on the class path; "
                           "use an envelope file stream instead")
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", subscribe)
         .option("maxOffsetsPerTrigger", int(max_offsets))
         .option("startingTimestamp", int(starting_timestamp)))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def write_envelopes(df: DataFrame, servers: str, topic: str | None = None,
                    options: dict[str, str] | None = None) -> None:
    """Batch-write envelopes (``key``, ``value`` and optionally ``topic``
    columns, e.g. from ``functions.to_envelope``) to the bus (K7). Each task
    produces its partition's records; no row passes through the driver."""
    if not bus_available(df.sparkSession):
        raise RuntimeError("Kafka connector not on the class path")
    w = df.write.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        w = w.option("topic", topic)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()
