"""Checks of coordinates and codes. Each sees only what the checks before it left as trusted."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import schema as S
from waymark.functions.cleaning import decimal_places, fix_swapped, has_valid_coords, invalid_coords, is_blank, within
from waymark.operators.spatial import point_in_polygon, within_buffer


def _trusted() -> Column:
    return F.coalesce(F.col("coord_status").isin(*S.TRUSTED), F.lit(False))


def _mark(df: DataFrame, hit: Column, reason: str, status: str = "suspect") -> DataFrame:
    return df.withColumn("__hit", F.coalesce(hit, F.lit(False))).withColumns({"coord_status": F.when(F.col("__hit"), F.lit(status)).otherwise(F.col("coord_status")), "coord_rejection_reason": F.when(F.col("__hit"), F.lit(reason)).otherwise(F.col("coord_rejection_reason"))}).drop("__hit")


def is_placeholder(lat: Column, lon: Column) -> Column:
    hit = F.lit(False)
    for a, b in S.PLACEHOLDERS:
        hit = hit | ((F.abs(lat - a) < S.PLACEHOLDER_TOLERANCE) & (F.abs(lon - b) < S.PLACEHOLDER_TOLERANCE))
    return F.coalesce(hit, F.lit(False))


def flag_placeholder(df: DataFrame) -> DataFrame:
    return _mark(df, _trusted() & is_placeholder(F.col("latitude"), F.col("longitude")), "placeholder_default")


def cluster_points(df: DataFrame, unit: str) -> DataFrame:
    """Points, to 5 places, that at least three trusted rows of more than one unit share. Two levels of partial sums; a point may have any number of rows."""
    name = F.nullif(F.lower(F.trim(F.col(unit))), F.lit(""))
    point = [F.bround("latitude", 5).alias("__lat5"), F.bround("longitude", 5).alias("__lon5")]
    return df.where(_trusted() & has_valid_coords("latitude", "longitude")).groupBy(*point).agg(F.count("*").alias("__n"), F.min(name).alias("__a"), F.max(name).alias("__z")).where((F.col("__n") >= S.CLUSTER_SIZE) & (F.col("__a") != F.col("__z"))).select("__lat5", "__lon5", F.lit(True).alias("__cluster"))


def flag_cluster(df: DataFrame, unit: str = "municipality") -> DataFrame:
    points = cluster_points(df, unit)
    joined = df.withColumns({"__lat5": F.bround("latitude", 5), "__lon5": F.bround("longitude", 5)}).join(points, ["__lat5", "__lon5"], "left")
    return _mark(joined, _trusted() & F.col("__cluster"), "coordinate_cluster").select(*df.columns)


def flag_round(df: DataFrame) -> DataFrame:
    few = (decimal_places("latitude") < S.DECIMALS) & (decimal_places("longitude") < S.DECIMALS)
    return _mark(df, _trusted() & few, "round_coordinates")


def detect_suspect(df: DataFrame, unit: str = "municipality") -> DataFrame:
    """Placeholder, then cluster, then round; each judges what is still trusted. One expression over three flags, the cluster's points counted without placeholders."""
    flagged = df.withColumns({"__trust": _trusted(), "__placeholder": is_placeholder(F.col("latitude"), F.col("longitude")), "__lat5": F.bround("latitude", 5), "__lon5": F.bround("longitude", 5)})
    points = cluster_points(flagged.where("__trust and not __placeholder"), unit)
    joined = flagged.join(points, ["__lat5", "__lon5"], "left")
    few = (decimal_places("latitude") < S.DECIMALS) & (decimal_places("longitude") < S.DECIMALS)
    reason = F.when(F.col("__placeholder"), F.lit("placeholder_default")).when(F.col("__cluster"), F.lit("coordinate_cluster")).when(few, F.lit("round_coordinates"))
    marked = joined.withColumn("__why", F.when(F.col("__trust"), reason))
    return marked.withColumns({"coord_status": F.when(F.col("__why").isNotNull(), F.lit("suspect")).otherwise(F.col("coord_status")), "coord_rejection_reason": F.coalesce("__why", "coord_rejection_reason")}).select(*df.columns)


def clean_self_reported(df: DataFrame, unit: str = "municipality") -> DataFrame:
    """Four passes: swapped pairs are put right, invalid ones and those out of bounds lose their coordinates, suspect ones are flagged."""
    df = fix_swapped(df)
    bad = invalid_coords(F.col("latitude"), F.col("longitude"))
    out = ~bad & ~within(F.col("latitude"), F.col("longitude"))
    df = df.withColumns({"coord_status": F.when(bad | out, F.lit("no_coords")).when(F.col("_was_swapped"), F.lit("fixed_swap")).otherwise(F.lit("valid")), "coord_rejection_reason": F.when(bad, F.lit("invalid")).when(out, F.lit("out_of_bounds"))})
    keep = F.col("coord_rejection_reason").isNull()
    df = df.withColumns({"latitude": F.when(keep, F.col("latitude")), "longitude": F.when(keep, F.col("longitude"))})
    return detect_suspect(df, unit)


def init_status(df: DataFrame) -> DataFrame:
    """coord_status and coord_rejection_reason, unless the table has them."""
    if "coord_status" in df.columns:
        return df if "coord_rejection_reason" in df.columns else df.withColumn("coord_rejection_reason", F.lit(None).cast("string"))
    have = has_valid_coords("latitude", "longitude")
    swapped = F.coalesce(F.col("_was_swapped"), F.lit(False)) if "_was_swapped" in df.columns else F.lit(False)
    return df.withColumns({"coord_status": F.when(~have, F.lit("no_coords")).when(swapped, F.lit("fixed_swap")).otherwise(F.lit("valid")), "coord_rejection_reason": F.when(~have, F.lit("no_coordinate_source"))})


def flag_outside(df: DataFrame) -> DataFrame:
    return _mark(df, _trusted() & has_valid_coords("latitude", "longitude") & F.col("observed_adm3").isNull(), "outside_all_polygons")


def same_unit(claimed: Column, observed: Column) -> Column:
    """Equal seven digits, or equal five with one side a whole city (..00)."""
    c, o = F.substring(claimed, 1, 7), F.substring(observed, 1, 7)
    return (c == o) | ((F.substring(c, 1, 5) == F.substring(o, 1, 5)) & ((F.substring(c, 6, 2) == "00") | (F.substring(o, 6, 2) == "00")))


def flag_wrong_unit(df: DataFrame, polygons: DataFrame, key: str = "site_id", claimed: str = "claimed_adm3", degrees: float = S.BUFFER_DEG) -> DataFrame:
    """Trusted points observed in another unit than claimed and not within the buffer of the claimed one. Only those in another unit meet polygons; a claimed unit that the layer lacks has no buffer."""
    wrong = _trusted() & ~is_blank(claimed) & F.col("observed_adm3").isNotNull() & ~same_unit(F.col(claimed), F.col("observed_adm3"))
    apart = df.where(wrong).select(key, "longitude", "latitude", F.substring(claimed, 1, 7).alias("__claimed"))
    near = within_buffer(apart, polygons, key, "__claimed", degrees).withColumn("__near", F.lit(True))
    return _mark(df.join(near, key, "left"), wrong & F.col("__near").isNull(), "wrong_municipality").select(*df.columns)


def validate_codes(df: DataFrame, claimed: str = "claimed_code", observed: str = "observed_code", out: str = "psgc_validation") -> DataFrame:
    """match or mismatch of two codes where the coordinates are trusted (without a status: present) and both codes are; else no_validation."""
    trusted = _trusted() if "coord_status" in df.columns else has_valid_coords("latitude", "longitude")
    both = trusted & ~is_blank(claimed) & ~is_blank(observed)
    return df.withColumn(out, F.when(~both, F.lit("no_validation")).when(F.col(claimed) == F.col(observed), F.lit("match")).otherwise(F.lit("mismatch")))


def bounds_status(lat: Column, lon: Column) -> Column:
    """valid, or out_of_bounds if a coordinate is; a missing one is not."""
    out = F.coalesce(~(lat.between(S.LAT_MIN, S.LAT_MAX) & lon.between(S.LON_MIN, S.LON_MAX)), F.lit(False))
    return F.when(out, F.lit("out_of_bounds")).otherwise(F.lit("valid"))


def flag_multi(df: DataFrame, code: str = "code", out: str = "is_multi") -> DataFrame:
    """Rows whose code, if any, more than one row has. An aggregate and a join, so that a code of very many rows is no window in one task."""
    many = df.where(F.col(code).isNotNull()).groupBy(code).count().where("count > 1").select(code, F.lit(True).alias(out))
    return df.join(many, code, "left").withColumn(out, F.coalesce(out, F.lit(False))).select(*[c for c in df.columns if c != out], out)


def is_missing(col: str) -> Column:
    return F.col(col).isNull()


def spatial_validation(df: DataFrame, polygons: DataFrame, key: str = "site_id", claimed: str = "claimed_adm3", long: DataFrame | None = None, suspect_unit: str | None = None, cut: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> DataFrame:
    """The stage in its order: containment, status, outside, wrong unit, fallback to lower sources (if long is given), suspect coordinates (if suspect_unit is), codes. cut is applied between steps that read their input several times: silver() writes it once."""
    from waymark.operators.cascade import cascade_fallback

    df = cut(df, "sites")
    df = cut(flag_outside(init_status(point_in_polygon(df, polygons, key, claimed))), "observed")
    df = flag_wrong_unit(df, polygons, key, claimed)
    if long is not None:
        df = cut(df, "validated")
        df = cascade_fallback(df, long, polygons, key, claimed)
    if suspect_unit is not None:
        df = detect_suspect(cut(df, "fallback"), suspect_unit)
    return validate_codes(df, claimed, "observed_adm3")
