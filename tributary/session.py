"""Session builder with the object-store and connector options.

Memory, cores and shuffle partitions are left to the launcher unless given.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SPARK_VERSION = "4.1.2"
SCALA_VERSION = "2.13"
HADOOP_VERSION = "3.4.2"

KAFKA_PACKAGE = f"org.apache.spark:spark-sql-kafka-0-10_{SCALA_VERSION}:{SPARK_VERSION}"
AVRO_PACKAGE = f"org.apache.spark:spark-avro_{SCALA_VERSION}:{SPARK_VERSION}"
S3A_PACKAGE = f"org.apache.hadoop:hadoop-aws:{HADOOP_VERSION}"

BASE_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.schemaInference": "true",
}

# Dedup state that outgrows executor memory stays on local disk with RocksDB
# and is recovered from the checkpoint when an executor is lost.
STREAMING_OPTIONS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def object_store_options(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = True,
) -> dict[str, str]:
    """S3-compatible storage settings for the s3a:// scheme."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def sized_for(input_bytes: int, partition_bytes: int = 128 << 20, floor: int = 200) -> dict[str, str]:
    """Shuffle partitions for the bytes a job moves.

    Adaptive execution joins partitions that turn out small, but it cannot make
    more of them; the default of 200 would give half a terabyte each at 100 TB.
    A stateful stream keeps the number it was first started with.
    """
    return {"spark.sql.shuffle.partitions": str(max(floor, -(-input_bytes // partition_bytes)))}


def session(
    app_name: str,
    *,
    kafka: bool = False,
    avro: bool = False,
    streaming: bool = False,
    store: dict[str, str] | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Build or fetch a session; `options` wins over every default here."""
    settings = dict(BASE_OPTIONS)
    if streaming:
        settings.update(STREAMING_OPTIONS)
    packages = [p for p, wanted in ((KAFKA_PACKAGE, kafka), (AVRO_PACKAGE, avro)) if wanted]
    if store:
        settings.update(store)
        packages.append(S3A_PACKAGE)
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    settings.update(options or {})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
