"""Tables stored for joins on one key without a shuffle, hot keys among them (LAY-1, JN-9).

All tables are bucketed by the key and a salt. Most keys have the salt 0 alone. A key with more rows
than a mean bucket has as many salts as mean buckets: its rows are dealt to them by a hash of the row, and
the row of a table with unique keys is stored once per salt. So every table has the rows of a key
and salt in the same bucket, and no bucket holds a hot key whole.

The hot keys, fewer than buckets and tables multiplied, are found when the tables are written.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALT, SALTS = "_salt", "_salts"


def hot_salts(tables: list[DataFrame], key: str, buckets: int) -> DataFrame:
    """key, _salts of the keys with more rows than a mean bucket in any of the tables."""
    found = []
    for df in tables:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        mean = max(1.0, (counts.agg(F.sum("_n")).first()[0] or 0) / buckets)
        hot = counts.filter(F.col("_n") > mean).select(key, F.ceil(F.col("_n") / mean).cast("int").alias(SALTS))
        found += hot.collect()  # fewer than buckets
    salts: dict = {}
    for value, n in found:
        salts[value] = max(n, salts.get(value, 1))
    kind = tables[0].schema[key].dataType.simpleString()
    return tables[0].sparkSession.createDataFrame(list(salts.items()), f"`{key}` {kind}, {SALTS} int")


def write_colocated(
    one: Mapping[str, DataFrame], many: Mapping[str, DataFrame], base: str, key: str, buckets: int
) -> dict[str, DataFrame]:
    """Write tables by name below ``base``: ``one`` have unique keys, ``many`` have any number of rows a key.

    Rows with a NULL key match nothing; they are stored and share a bucket unless they are many.
    """
    hot = F.broadcast(hot_salts(list(many.values()), key, buckets).withColumnRenamed(key, "_hot"))
    for name, df in (*one.items(), *many.items()):
        marked = df.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
        marked = marked.withColumn(SALTS, F.coalesce(SALTS, F.lit(1)))
        if name in one:
            salted = marked.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col(SALTS) - 1)))
        else:
            salted = marked.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), SALTS).cast("int"))
        (
            salted.repartition(buckets, key, SALT).write.mode("overwrite").option("path", f"{base}/{name}")
            .bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(name)
        )
    spark = next(iter(many.values())).sparkSession
    return {name: spark.table(name) for name in (*one, *many)}


def count_colocated(spark: SparkSession, one: DataFrame, many: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows of ``one`` with the number of rows that each of ``many`` (by the count's name) has for their key, where all have some.

    Counts and joins stay inside their buckets. Only the hot keys' counts, one row a salt, are
    summed across buckets; their result is bounded by the number of hot keys and goes back as a small table.
    """
    columns = [c for c in one.columns if c not in (SALT, SALTS)]

    def counted(part: DataFrame) -> DataFrame:
        for name, df in many.items():
            per_salt = df.groupBy(key, SALT).agg(F.count(F.lit(1)).alias(name))
            part = part.hint("merge").join(per_salt, [key, SALT], "left")
        return part

    some = reduce(lambda a, b: a & b, [F.col(n) > 0 for n in many])
    plain = counted(one.filter(F.col(SALTS) == 1)).filter(some).select(*columns, *many)
    spread = counted(one.filter(F.col(SALTS) > 1)).groupBy(*columns)
    sums = spread.agg(*[F.sum(F.coalesce(n, F.lit(0))).alias(n) for n in many]).filter(some)
    return plain.unionByName(spark.createDataFrame(sums.collect(), plain.schema))  # hot keys alone
