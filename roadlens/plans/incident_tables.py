"""Incident tables derived from the events, customer and nation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators.clean import clean_events
from roadlens.operators.dedup import dedup_minute
from roadlens.schemas import ALERT

POLL_ROWS = 1000

# Declared, so that building a query reads no file.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, with some of them reported a second time."""
    event = F.col("event_id")
    again = F.when((event % 10).isin(3, 4), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    late = (F.col("again") == 1) & (event % 10 == 3)
    return (table(spark, sf_dir, "events")
            .select("event_id", "ts", "user_id", "event_type", F.explode(again).alias("again"))
            .withColumn("row_id", 2 * event + F.col("again"))
            .withColumn("ts", F.when(late, F.col("ts") + F.expr("INTERVAL 7 SECOND"))
                        .otherwise(F.col("ts"))))


def _incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    kind = (F.when(event % 97 == 0, None)
            .when(F.col("event_type") == "error", F.concat(F.lit("HAZARD_"), event % 3))
            .when(F.col("event_type") == "click", "JAM")
            .when(F.col("event_type") == "view", "POLICE")
            .when(F.col("event_type") == "purchase", "ACCIDENT")
            .otherwise("ROAD_CLOSED"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (_sightings(spark, sf_dir)
            .join(customers, user == F.col("c_custkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "row_id",
                kind.alias("tipo"),
                F.when(event % 5 == 0, None)
                .otherwise(F.concat(F.lit("SUB_"), event % 4)).alias("subtipo"),
                F.when(event % 11 == 0, None)
                .otherwise(F.concat(F.lit("Street "), user % 7)).alias("ubicacion"),
                F.when(user % 6 == 0, None).otherwise(F.lower("n_name")).alias("ciudad"),
                F.when(event % 53 == 0, "hora")
                .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("hora"),
                F.when(event % 41 == 0, None).when(event % 29 == 0, 95.0)
                .otherwise(F.lit(-33.66) + (event % 48).cast("double") / 100).alias("lat"),
                (F.lit(-70.89) + (user % 44).cast("double") / 100).alias("lon"),
                F.when(event % 53 != 0, F.unix_millis(F.col("ts").cast("timestamp")))
                .alias("pub_millis")))


# Where ``write_derived`` has put tables: (folder of the given tables, name) to path.
WRITTEN: dict[tuple[str, str], str] = {}


def write_derived(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Writes raw, filtered and unique events once; the queries of this session then read them."""
    for name, make in (("raw", raw), ("filtered", filtered), ("unique", unique)):
        make(spark, sf_dir).write.parquet(f"{root}/{name}")
        WRITTEN[sf_dir, name] = f"{root}/{name}"


def _written(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    path = WRITTEN.get((sf_dir, name))
    return spark.read.parquet(path) if path else None


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "raw") or _incidents(spark, sf_dir).drop("pub_millis")


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "filtered") or clean_events(raw(spark, sf_dir))


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "unique") or dedup_minute(filtered(spark, sf_dir))


def land_feed(spark: SparkSession, sf_dir: str, path: str, writes: int = 1, files: int = 1) -> str:
    """The incidents as feed payloads, one per ``POLL_ROWS`` numbers of the arrival order.

    With several ``writes`` the polls land in that many parts, the earliest first, ``files`` files each.
    """
    alert = F.struct(
        F.col("tipo").alias("type"), F.col("subtipo").alias("subtype"),
        F.col("ubicacion").alias("street"), F.col("ciudad").alias("city"),
        F.col("pub_millis").alias("pubMillis"),
        F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("location"))
    rows = (_incidents(spark, sf_dir)
            .select(F.floor(F.col("row_id") / POLL_ROWS).alias("poll"),
                    (F.floor(F.col("row_id") / 2) % 2).alias("kind"),
                    F.struct("row_id", alert.alias("a")).alias("e")))

    def of_kind(kind: int):
        # At most POLL_ROWS elements, since row_id is unique.
        picked = F.collect_list(F.when(F.col("kind") == kind, F.col("e")))
        ordered = F.transform(F.array_sort(picked), lambda e: e["a"])
        return F.when(F.size(ordered) > 0, ordered.cast(f"array<{ALERT}>"))

    payloads = rows.groupBy("poll").agg(of_kind(0).alias("alerts"), of_kind(1).alias("traffic"))
    if writes == 1:
        payloads.write.json(path)
        return path
    payloads.write.parquet(f"{path}-payloads")
    payloads = spark.read.parquet(f"{path}-payloads")
    step = -(-(payloads.agg(F.max("poll")).first()[0] + 1) // writes)
    for i in range(writes):
        part = payloads.filter(F.col("poll").between(i * step, (i + 1) * step - 1))
        part.repartition(files).write.mode("append").json(path)
    return path
