"""Creating and seeding the device-type dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The seed rows of the dimension.
SEED = [
    (1, "Temperature Sensor"),
    (2, "Humidity Sensor"),
    (3, "Multi-Sensor"),
    (4, "Pressure Sensor"),
    (5, "CO2 Sensor"),
]


# Fixed value: the longest name, in characters.
NAME_LENGTH = 100


def ensure(spark: SparkSession, table: str = "device_types", path: str | None = None) -> None:
    """Create the dimension table unless it exists, with its files at ``path`` if given.

    A file table enforces neither its key nor NOT NULL; ``seed`` does, before it writes.
    """
    columns = f"id INT NOT NULL, type_name VARCHAR({NAME_LENGTH}) NOT NULL"
    at = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{at}")


def missing_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``new`` whose id ``existing`` lacks, one per id.

    Rows have no order that would make one of several the first, so the smallest name is taken.
    """
    once = new.groupBy("id").agg(F.min("type_name").alias("type_name"))
    return once.join(existing, "id", "left_anti")


def insert_ignore(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Insert that leaves ids already present as they are."""
    return existing.select("id", "type_name").unionByName(missing_rows(existing, new))


def check(rows: DataFrame) -> None:
    """Raise unless every row is one that the dimension may hold, and no id occurs twice."""
    name = F.col("type_name")
    bad = F.col("id").isNull() | name.isNull() | (F.char_length(name) > NAME_LENGTH)
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.count_if(bad).alias("bad"),
    ).first()
    if found["bad"]:
        raise ValueError(f"ids and names must not be null, and names have {NAME_LENGTH} characters at most")
    if found["rows"] != found["ids"]:
        raise ValueError("dimension ids must be unique")


def seed(spark: SparkSession, new: DataFrame, table: str = "device_types") -> None:
    """Append to ``table`` the rows whose id it lacks; running it again changes nothing.

    Both what is there and what comes are checked first, so a failure leaves the table as it was.
    """
    existing = spark.table(table)
    check(existing)
    rows = new.select(F.col("id").cast("int").alias("id"), "type_name")
    added = missing_rows(existing, rows)
    check(added)
    # Nulls among repeated ids would be lost in choosing one of them.
    if rows.where(F.col("id").isNull() | F.col("type_name").isNull()).limit(1).count():
        raise ValueError("ids and names must not be null")
    added.write.insertInto(table)
