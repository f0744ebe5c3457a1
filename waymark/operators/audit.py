"""Duplicate checks over published sites. Groups are aggregates; pairs are listed only where the check is about pairs, and then by equi-joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.cleaning import audit_name_key, is_blank
from waymark.operators.crosswalk import near_pairs

#: Levels that must agree and the level that must differ, by scope.
SCOPES = {
    "a": (("region", "province", "municipality", "barangay"), None),
    "b": (("region", "province", "municipality"), "barangay"),
    "c": (("region", "province"), "municipality"),
    "d": (("region",), "province"),
}


def duplicate_ids(df: DataFrame, key: str = "site_id") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_names(df: DataFrame, scope: str, name: str = "site_name") -> DataFrame:
    """Groups of rows of one name within a scope: the levels, the name, n rows and how many values the differing level has."""
    same, other = SCOPES[scope]
    named = df.where(~is_blank(name))
    differing = F.countDistinct(F.coalesce(other, F.lit("")) if other is None else F.coalesce(F.col(other), F.lit(""))).alias("n_places") if other else F.lit(1).cast("long").alias("n_places")
    groups = named.groupBy(*same, name).agg(F.count("*").alias("n"), differing)
    return groups.where("n > 1" if other is None else "n_places > 1")


def near_identical_names(df: DataFrame, name: str = "site_name", unit: str = "municipality") -> DataFrame:
    """Groups of rows in a unit whose names differ only in case, abbreviations, punctuation or spaces."""
    return df.where(~is_blank(name)).groupBy(unit, audit_name_key(name).alias("name_key")).agg(F.countDistinct(name).alias("n_names"), F.count("*").alias("n")).where("n_names > 1")


def blank_names(df: DataFrame, name: str = "site_name") -> DataFrame:
    return df.where(is_blank(name))


def prefixed_pairs(df: DataFrame, key: str = "site_id", name: str = "site_name") -> DataFrame:
    """IDs x and 1x that both occur, and whether they share a name."""
    a = df.select(F.col(key).alias("short_id"), F.col(name).alias("short_name"), F.concat(F.lit("1"), key).alias("long_id"))
    b = df.select(F.col(key).alias("long_id"), F.col(name).alias("long_name"))
    return a.join(b, "long_id").withColumn("kind", F.when(F.col("short_name").eqNullSafe(F.col("long_name")), F.lit("same_name")).otherwise(F.lit("different_name")))


def near_duplicates(df: DataFrame, metres: float = 50, key: str = "site_id", name: str = "site_name") -> DataFrame:
    """Pairs of sites of one name within some metres of each other. Sites meet by name and grid cell, so a point that many sites of other names share is no burden."""
    have = _placed(df, name).select(key, name, "latitude", "longitude")
    return near_pairs(have, have, metres / 1000, same=[name]).where(F.col(f"l_{key}") < F.col(f"r_{key}"))


def near_duplicate_classes(df: DataFrame, metres: float = 50, name: str = "site_name") -> DataFrame:
    """The same without a row for each pair of copies: for each name and point, n sites and near, how many other sites of the name lie within some metres. Sites at one point are one class from the start."""
    classes = _placed(df, name).groupBy(name, "latitude", "longitude").agg(F.count("*").alias("n"))
    pairs = near_pairs(classes, classes, metres / 1000, same=[name])  # each class meets itself too
    return pairs.groupBy(F.col(f"l_{name}").alias(name), F.col("l_latitude").alias("latitude"), F.col("l_longitude").alias("longitude")).agg(F.max("l_n").alias("n"), (F.sum("r_n") - 1).alias("near"))


def _placed(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~is_blank(name))


def compare_snapshots(before: DataFrame, after: DataFrame, column: str, key: str = "site_id") -> DataFrame:
    """change (added, removed, kept) with the value of a column before and after, and n. One full outer join on the key."""
    a = before.select(F.col(key), F.col(column).alias("value_before"), F.lit(True).alias("__a"))
    b = after.select(F.col(key), F.col(column).alias("value_after"), F.lit(True).alias("__b"))
    change = F.when(F.col("__a").isNull(), F.lit("added")).when(F.col("__b").isNull(), F.lit("removed")).otherwise(F.lit("kept"))
    return a.join(b, key, "full").groupBy(change.alias("change"), "value_before", "value_after").agg(F.count("*").alias("n"))


def overlapping_ids(a: DataFrame, b: DataFrame, key: str = "site_id") -> DataFrame:
    return a.select(key).join(b.select(key).distinct(), key, "left_semi").distinct()
