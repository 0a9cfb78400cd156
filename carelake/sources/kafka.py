"""Options of the event-log source. The connector package has to be on the classpath of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Offsets taken per trigger, late-data tolerance and lag limit per stream.
RATE_CAP = {"vitals": 5000, "claims": 2000, "pharmacy_cdc": 1000}
LATE_TOLERANCE = {"vitals": "5 minutes", "claims": "30 minutes", "pharmacy_cdc": "10 minutes"}
LAG_LIMIT = {"vitals": 500, "claims": 200, "pharmacy_cdc": 100}


def kafka_options(servers: str, topic: str, group: str, starting: str = "latest", rate_cap: int | None = None,
                  sasl_jaas: str | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Reader options; with `sasl_jaas` the connection is SASL_SSL / PLAIN.

    Offsets that are gone before they were read stop the query, unless the caller accepts the loss.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.group.id": group,
    }
    if rate_cap:
        options["maxOffsetsPerTrigger"] = str(rate_cap)
    if sasl_jaas:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": sasl_jaas,
        }
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream with key, value, topic, partition, offset and timestamp."""
    return spark.readStream.format("kafka").options(**options).load()
