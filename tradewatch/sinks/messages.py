"""Message and case sinks. They need Spark's Kafka connector and a JDBC driver respectively."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tradewatch.operators.cases import alert_case_rows


def topic_writer(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Publish messages with topic, key and value columns; those of one key stay in order."""
    return (
        messages.select("topic", "key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def write_cases(cases: DataFrame, url: str, table: str = "alerts", **options: str) -> None:
    """Append case rows to a database table.

    JSON columns travel as text; PostgreSQL takes them with stringtype=unspecified in the URL.
    The case id is a digest of the alert, so a unique index on it rejects a replayed batch.
    """
    cases.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def case_writer(alerts: DataFrame, url: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """Open a case for every alert of a stream."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_cases(alert_case_rows(batch), url, **options)

    return (
        alerts.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
