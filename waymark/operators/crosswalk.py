"""From historical IDs to canonical ones: official history, then near and similar places."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark import schema as S
from waymark.functions.cleaning import has_valid_coords, levenshtein_similarity, name_similarity, name_similarity_bound, normalize_id
from waymark.functions.geo import cell, haversine_km, longitude_reach
from waymark.operators.dedup import _best, distinct_pairs, identity_first


def unpivot_history(mapping: DataFrame, canonical: str = "canonical_id", years: Sequence[str] = S.SCHOOL_YEARS, others: Sequence[str] = ("old_school_id", "old_school_id.1", "legacy_id")) -> DataFrame:
    """canonical_id, historical_id, year, row_ord, rank: a row for each ID that a mapping row (with _ord) ever had. rank is its place in the row: years ascending, then the other columns. One pass, no shuffle."""
    have = [(c, int(c[-4:])) for c in years if c in mapping.columns] + [(c, None) for c in others if c in mapping.columns]
    cells = F.array(*[F.struct(normalize_id(F.col(f"`{c}`")).alias("historical_id"), F.lit(y).cast("int").alias("year"), F.lit(i + 1).alias("rank")) for i, (c, y) in enumerate(have)])
    return mapping.select(normalize_id(canonical).alias("canonical_id"), F.col("_ord").alias("row_ord"), F.explode(cells).alias("c")).select("canonical_id", "row_ord", "c.*").where("canonical_id is not null and historical_id is not null")


def history_span(history: DataFrame) -> DataFrame:
    """First and last year of each ID within a mapping row; null if no year has it. The rank of its first entry orders it."""
    return history.groupBy("row_ord", "canonical_id", "historical_id").agg(F.min("year").alias("year_first_seen"), F.max("year").alias("year_last_seen"), F.min("rank").alias("rank"))


def reconcile_prefixed(mapping: DataFrame, known_ids: DataFrame, canonical: str = "canonical_id", year: int = 2024) -> tuple[DataFrame, DataFrame]:
    """A seven-digit canonical ID 1xxxxxx becomes xxxxxx if that is known (known_ids.site_id); the long form is then historical for that year. Returns the mapping with canonical_id and reconciled put right, and the long forms in the shape of history_span."""
    long = normalize_id(canonical)
    short = F.when(long.rlike("^1[0-9]{6}$"), F.substring(long, 2, 6))
    known = known_ids.select(normalize_id("site_id").alias("__short")).where("__short is not null").distinct().withColumn("__known", F.lit(True))
    joined = mapping.withColumns({"__long": long, "__short": short}).join(known, "__short", "left")
    out = joined.withColumns({canonical: F.when(F.col("__known"), F.col("__short")).otherwise(F.col("__long")), "reconciled": F.coalesce(F.col("__known"), F.lit(False)), "unresolved": F.col("__short").isNotNull() & F.col("__known").isNull()})
    forms = out.where("reconciled").select(F.col("_ord").alias("row_ord"), F.col(canonical).alias("canonical_id"), F.col("__long").alias("historical_id"), F.lit(year).alias("year_first_seen"), F.lit(year).alias("year_last_seen"), F.lit(0).alias("rank"))
    return out.drop("__long", "__short", "__known"), forms


def identity_rows(mapping: DataFrame, canonical: str = "canonical_id", rank: int = 1000) -> DataFrame:
    c = normalize_id(canonical)
    return mapping.select(F.col("_ord").alias("row_ord"), c.alias("canonical_id"), c.alias("historical_id"), F.lit(None).cast("int").alias("year_first_seen"), F.lit(None).cast("int").alias("year_last_seen"), F.lit(rank).alias("rank")).where("canonical_id is not null")


def official_layer(mapping: DataFrame, known_ids: DataFrame | None = None, canonical: str = "canonical_id") -> DataFrame:
    """Layer 1 with the first of equal pairs: historical_id, canonical_id, match_method, years, _ord (struct of row and rank)."""
    parts = []
    if known_ids is not None:
        mapping, forms = reconcile_prefixed(mapping, known_ids, canonical)
        parts.append(forms)
    parts.append(history_span(unpivot_history(mapping, canonical)).where("historical_id <> canonical_id"))
    parts.append(identity_rows(mapping, canonical))
    out = parts[0].select("row_ord", "canonical_id", "historical_id", "year_first_seen", "year_last_seen", "rank")
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select("historical_id", "canonical_id", F.lit("official_mapping").alias("match_method"), "year_first_seen", "year_last_seen", F.struct("row_ord", "rank").alias("_ord"))
    return distinct_pairs(out)


def _first_records(long: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Of the sources in order, the first record of each ID in (left_semi) or not in (left_anti) ids; only then those without coordinates go."""
    found = long.join(ids, "site_id", how)
    return _best(found, ["site_id"], F.struct("priority", "_ord")).where(has_valid_coords("latitude", "longitude"))


def orphans(long: DataFrame, layer1: DataFrame) -> DataFrame:
    return _first_records(long.where("site_id is not null"), layer1.select(F.col("historical_id").alias("site_id")).distinct(), "left_anti")


def references(long: DataFrame, layer1: DataFrame) -> DataFrame:
    return _first_records(long, layer1.select(F.col("canonical_id").alias("site_id")).distinct(), "left_semi")


def near_pairs(left: DataFrame, right: DataFrame, km: float = S.NEAR_KM, size: float = 0.001, lat_limit: float = S.LAT_MAX, same: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows within km of each other that agree in the columns of same, which join too; columns prefixed l_ and r_, with distance_km. The right side goes to the grid cells around it, and the join is on cells: no row meets rows that aren't near. Both sides lie within lat_limit of the equator."""
    reach_y, reach_x = max(1, -int(-(km / 111.19) // size)), longitude_reach(lat_limit, km, size)
    a = left.select(*[F.col(f"`{c}`").alias(f"l_{c}") for c in left.columns]).withColumns({"__cx": cell(F.col("l_longitude"), size), "__cy": cell(F.col("l_latitude"), size)})
    around = F.explode(F.flatten(F.transform(F.sequence(F.lit(-reach_x), F.lit(reach_x)), lambda dx: F.transform(F.sequence(F.lit(-reach_y), F.lit(reach_y)), lambda dy: F.struct((cell(F.col("r_longitude"), size) + dx).alias("x"), (cell(F.col("r_latitude"), size) + dy).alias("y"))))))
    b = right.select(*[F.col(f"`{c}`").alias(f"r_{c}") for c in right.columns]).withColumn("__cell", around).select("*", F.col("__cell.x").alias("__cx"), F.col("__cell.y").alias("__cy")).drop("__cell")
    d = haversine_km(F.col("l_latitude"), F.col("l_longitude"), F.col("r_latitude"), F.col("r_longitude"))
    a, b = (x.withColumns({f"__s{i}": F.col(f"{side}_{c}") for i, c in enumerate(same)}) for x, side in ((a, "l"), (b, "r")))
    keys = [f"__s{i}" for i in range(len(same))]
    return a.join(b, ["__cx", "__cy", *keys]).drop(*keys).withColumn("distance_km", d).where(F.col("distance_km") <= km).drop("__cx", "__cy")


def spatial_name_match(left: DataFrame, right: DataFrame, km: float = S.NEAR_KM, least: float = S.SIMILARITY, similarity=name_similarity) -> DataFrame:
    """For each left row the most similar right one within km, if similar enough; of equally similar ones the first by _ord. The measure is taken of (left, right) in that order. Of names whose letters alone rule the pair out none goes to Python."""
    pairs = near_pairs(left, right, km)
    if similarity is name_similarity:
        pairs = pairs.where(name_similarity_bound("l_site_name", "r_site_name") >= least)
    scored = pairs.withColumn("similarity", similarity("l_site_name", "r_site_name")).where(F.col("similarity") >= least)
    return _best(scored, ["l_site_id"], F.struct(-F.col("similarity"), F.col("r__ord")))


def spatial_levenshtein_match(left: DataFrame, right: DataFrame, km: float = S.NEAR_KM, least: float = S.SIMILARITY) -> DataFrame:
    return spatial_name_match(left, right, km, least, levenshtein_similarity)


def build_crosswalk(mapping: DataFrame, long: DataFrame, known_ids: DataFrame | None = None) -> DataFrame:
    """Both layers: historical_id, canonical_id, match_method, year_first_seen, year_last_seen, _ord."""
    one = official_layer(mapping, known_ids)
    found = spatial_name_match(orphans(long, one), references(long, one))
    two = found.select(F.col("l_site_id").alias("historical_id"), F.col("r_site_id").alias("canonical_id"), F.lit("spatial_name").alias("match_method"), F.lit(None).cast("int").alias("year_first_seen"), F.lit(None).cast("int").alias("year_last_seen"), F.struct(F.lit(1 << 62).alias("row_ord"), F.lit(0).alias("rank")).alias("_ord"))
    return one.unionByName(two)


def remap(df: DataFrame, crosswalk: DataFrame, key: str = "site_id") -> DataFrame:
    """IDs through the crosswalk, others as they are; _remapped tells which changed."""
    lookup = identity_first(crosswalk).select(F.col("historical_id").alias(key), F.col("canonical_id").alias("__canonical"))
    new = F.coalesce("__canonical", key)
    return df.join(lookup, key, "left").withColumns({"_remapped": F.coalesce(new != F.col(key), F.lit(False)), key: new}).select(*df.columns, "_remapped")


def ambiguous_ids(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.groupBy("historical_id").agg(F.countDistinct("canonical_id").alias("n_canonical")).where("n_canonical > 1")


def length_distribution(crosswalk: DataFrame, col: str = "canonical_id") -> DataFrame:
    return crosswalk.groupBy(F.length(col).alias("id_length")).agg(F.count("*").alias("n"))
