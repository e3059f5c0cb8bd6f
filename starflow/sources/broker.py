"""Events from a Kafka-protocol broker."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the login class of the public Kafka client.
PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


def sasl_plain(username: str, password: str, login: str = PLAIN_LOGIN) -> dict[str, str]:
    """SASL_SSL / PLAIN options; the caller fetches the secret.

    ``login`` is the class name where a connector carries the client under another package.
    """
    quoted = [v.replace("\\", "\\\\").replace('"', '\\"') for v in (username, password)]
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": '{} required username="{}" password="{}";'.format(login, *quoted),
    }


def broker_options(servers: str, topic: str, **overrides: str) -> dict[str, str]:
    """Options for one topic.

    Starts at the earliest offset and fails on a gap, so that no event is lost
    unseen.  ``startingOffsets="latest"``, ``failOnDataLoss="false"`` and
    ``maxOffsetsPerTrigger`` go in as overrides.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        **overrides,
    }


def broker_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded scan of a topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def decode_messages(messages: DataFrame, payload: str = "value") -> DataFrame:
    """The payload bytes as text, with the broker's own columns that are there."""
    kept = [c for c in messages.columns if c not in (payload, "key")]
    return messages.select(*kept, F.col(payload).cast("string").alias("raw_json"))
