"""Column expressions that clean identifiers, numbers, names and flags. All stay inside code generation but name_similarity."""

from collections.abc import Mapping
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from waymark import schema as S
from waymark.schema import BOX, Box


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    return F.nullif(F.trim(_c(col)), F.lit(""))


def normalize_id(col: Column | str, zfill: int | None = None) -> Column:
    """Trimmed, without one final ".0"; digits padded to zfill, never cut; blank is null."""
    c = F.nullif(F.regexp_replace(F.trim(_c(col).cast("string")), r"\.0$", ""), F.lit(""))
    if zfill is None:
        return c
    return F.when(c.rlike(r"^[0-9]+$"), F.lpad(c, F.greatest(F.lit(zfill), F.length(c)), F.lit("0"))).otherwise(c)


def pad_code(col: Column | str, width: int = 10) -> Column:
    c = blank_to_null(_c(col).cast("string"))
    return F.lpad(c, F.greatest(F.lit(width), F.length(c)), F.lit("0"))


def to_double(col: Column | str) -> Column:
    """Text to double; whatever isn't a plain number is null, NaN too."""
    c = _c(col).cast("string")
    number = F.when(~c.rlike(r"(?i)[df]\s*$"), c.try_cast("double"))
    return F.when(~F.isnan(number), number)


def has_valid_coords(lat: Column | str, lon: Column | str) -> Column:
    """Both present and finite; never null."""
    ok = F.lit(True)
    for c in (_c(lat), _c(lon)):
        ok = ok & F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    return ok


def within(lat: Column, lon: Column, box: Box = BOX) -> Column:
    return F.coalesce(lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max), F.lit(False))


def fix_swapped(df: DataFrame, lat: str = "latitude", lon: str = "longitude", box: Box = BOX) -> DataFrame:
    """Swaps the pair where the latitude lies in the longitudes' band and the longitude in the latitudes'; adds _was_swapped."""
    swap = within(F.col(lon), F.col(lat), box)
    return df.withColumns({"_was_swapped": swap, lat: F.when(swap, F.col(lon)).otherwise(F.col(lat)), lon: F.when(swap, F.col(lat)).otherwise(F.col(lon))})


def reject_out_of_bounds(df: DataFrame, lat: str = "latitude", lon: str = "longitude", box: Box = BOX) -> DataFrame:
    """Pairs outside the box become null; rows stay."""
    ok = within(F.col(lat), F.col(lon), box)
    return df.withColumns({lat: F.when(ok, F.col(lat)), lon: F.when(ok, F.col(lon))})


def invalid_coords(lat: Column, lon: Column) -> Column:
    """Missing, not finite, beyond the globe, or exactly zero."""
    return ~has_valid_coords(lat, lon) | F.coalesce((F.abs(lat) > 90) | (F.abs(lon) > 180) | (lat == 0) | (lon == 0), F.lit(False))


def explode_ids(df: DataFrame, col: str, sep: str = ";") -> DataFrame:
    """A row for each identifier of a compound one."""
    parts = F.filter(F.transform(F.split(F.col(col), sep), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn(col, F.explode(parts))


def first_nonblank(*cols: Column | str) -> Column:
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def vertex_centroid(kind: Column | str, coordinates: Column | str) -> Column:
    """struct(x, y) of a GeoJSON geometry from the JSON of its coordinates: the point, the mean of the vertices of a line or of an outer ring with
    its closing vertex, or the mean of the parts' means."""
    kind, text = _c(kind), _c(coordinates)

    def mean(points: Column) -> Column:
        total = F.aggregate(points, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), lambda a, p: F.struct((a["x"] + F.get(p, 0)).alias("x"), (a["y"] + F.get(p, 1)).alias("y")))
        return F.when(F.size(points) > 0, F.struct((total["x"] / F.size(points)).alias("x"), (total["y"] / F.size(points)).alias("y")))

    point = F.from_json(text, "array<double>")
    line = F.from_json(text, "array<array<double>>")
    polygon = F.from_json(text, "array<array<array<double>>>")
    parts = F.transform(F.from_json(text, "array<array<array<array<double>>>>"), lambda p: mean(F.get(p, 0)))
    middle = F.aggregate(parts, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), lambda a, p: F.struct((a["x"] + p["x"]).alias("x"), (a["y"] + p["y"]).alias("y")))
    return (
        F.when(kind == "Point", F.struct(F.get(point, 0).alias("x"), F.get(point, 1).alias("y")))
        .when(kind == "LineString", mean(line))
        .when(kind == "Polygon", mean(F.get(polygon, 0)))
        .when((kind == "MultiPolygon") & (F.size(parts) > 0), F.struct((middle["x"] / F.size(parts)).alias("x"), (middle["y"] / F.size(parts)).alias("y")))
    )


def map_values(col: Column | str, values: Mapping[str, str], lower: bool = True) -> Column:
    """Values by a small dictionary, keys compared in lower case; unknown ones stay, trimmed; blank is null."""
    c = blank_to_null(col)
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(c) if lower else c), c)


def py_title(col: Column | str) -> Column:
    """Title case where every letter after a non-letter is a capital."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1)), F.initcap), "")


def normalize_location(col: Column | str) -> Column:
    """Display form of a place: single spaces, comma and space, known short names in capitals, "Region " and the rest as it is, else title case."""
    c = blank_to_null(col)
    c = F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"\s*,\s*", ", ")
    up = F.upper(c)
    return F.when(up.isin(*S.UPPER_NAMES), up).when(up.startswith("REGION "), F.concat(F.lit("Region "), F.trim(F.substring(c, 8, 1 << 20)))).otherwise(py_title(c))


def fix_mojibake(col: Column | str) -> Column:
    """UTF-8 that was read as Latin-1 put right, with replacement where it can't be; "nan" and blank are null. Bytes are built by code point, so no setting of the session matters."""
    latin = F.encode(F.regexp_replace(_c(col), r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    return F.nullif(F.nullif(F.trim(F.make_valid_utf8(latin.cast("string"))), F.lit("nan")), F.lit(""))


def harmonize(df: DataFrame) -> DataFrame:
    """Keeps region, province and city_municipality as old_*, and maps them to the common names."""
    city = F.regexp_replace(F.trim("city_municipality"), r"(?i)\s+Municipality$", "")
    province = F.upper(F.trim("province"))
    table = F.create_map(*[F.lit(x) for kv in S.PROVINCE_FIXES.items() for x in kv])
    return df.withColumns(
        {
            "old_region": F.col("region"), "old_province": F.col("province"), "old_city_municipality": F.col("city_municipality"),
            "region": map_values("region", S.NUMBERED_REGIONS, lower=False),
            "province": F.when(F.coalesce(province != "CAGAYAN VALLEY", F.lit(True)), F.coalesce(F.try_element_at(table, province), F.col("province"))),
            "city_municipality": city,
        }
    )


def old_region(region: Column | str, province: Column | str) -> Column:
    """The former region of the provinces of a new one."""
    region, province = _c(region), F.lower(F.trim(_c(province)))
    table = F.create_map(*[F.lit(x) for kv in S.OLD_REGIONS.items() for x in kv])
    return F.when(F.coalesce(F.upper(F.trim(region)) == "NIR", F.lit(False)), F.coalesce(F.try_element_at(table, province), region)).otherwise(region)


def strand_offerings(df: DataFrame, out: str = "shs_strand_offerings") -> DataFrame:
    """Labels of the strands in which any of the four enrolment columns is over 0, in fixed order; null if none, or if senior high isn't offered. Missing columns count as empty."""
    labels = []
    for prefix, label in S.STRANDS.items():
        counts = [to_double(c) for g in ("g11", "g12") for s in ("male", "female") if (c := f"{g}_{prefix}_{s}") in df.columns]
        some = F.lit(False)
        for n in counts:
            some = some | F.coalesce(n >= 1, F.lit(False))
        labels.append(F.when(some, F.lit(label)))
    listed = F.nullif(F.array_join(F.array_compact(F.array(*labels)), ","), F.lit(""))
    return df.withColumn(out, F.when(F.lower(F.trim(F.col("offers_shs").cast("string"))) == "true", listed))


def flag01(col: Column | str) -> Column:
    return F.coalesce(F.trim(_c(col)) == "1", F.lit(False)).cast("int")


def bool_text(col: Column | str) -> Column:
    c = F.lower(F.trim(_c(col).cast("string")))
    return F.when(c == "true", "True").when(c == "false", "False")


def yes_flag(col: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(_c(col))) == "yes", F.lit(False))


def capitalize(col: Column | str) -> Column:
    c = F.trim(_c(col))
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))


def coalesce_id(validated: Column | str, raw: Column | str) -> Column:
    return F.coalesce(normalize_id(validated), normalize_id(raw))


def is_validated(findings: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(_c(findings))) == "validated", F.lit(False))


def tag_source(df: DataFrame, label: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """A constant column source; columns that the table lacks as null strings."""
    return df.withColumns({"source": F.lit(label), **{c: F.lit(None).cast("string") for c in columns if c not in df.columns}})


def is_blank(col: Column | str) -> Column:
    """Null, empty or the word None."""
    return F.coalesce(_c(col).isin("", "None"), F.lit(True))


def decimal_places(col: Column | str) -> Column:
    """Decimals of a double as written with ten, without final zeros."""
    digits = F.regexp_extract(F.rtrim(F.format_string("%.10f", _c(col)), F.lit("0")), r"\.(\d+)$", 1)
    return F.when(_c(col).isNotNull(), F.length(digits))


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def display_source(status: Column | str) -> Column:
    return F.when(_c(status).isin(*S.TRUSTED), F.lit("tosf_self_reported"))


def audit_name_key(col: Column | str) -> Column:
    """Name in lower case with abbreviations written out, without punctuation and double spaces. Punctuation goes, it doesn't part words."""
    c = F.lower(_c(col))
    for short, full in S.ABBREVIATIONS.items():
        c = F.regexp_replace(c, rf"\b{short}\b", full)
    for short, full in S.SAINTS.items():
        c = F.regexp_replace(c, rf"\b{short}\.", full)
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\p{Punct}", ""), r"\s+", " "))


def reliable(df: DataFrame) -> DataFrame:
    return df.where(F.col("coord_status").isin(*S.TRUSTED))


@F.pandas_udf(DoubleType())
def _ratcliff(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype=float)


def name_similarity(a: Column | str, b: Column | str) -> Column:
    """Ratcliff-Obershelp ratio of trimmed lower-case names, 0 if either is blank. The order of the arguments matters. For pairs that blocking has left over."""
    return _ratcliff(F.lower(F.trim(F.coalesce(_c(a), F.lit("")))), F.lower(F.trim(F.coalesce(_c(b), F.lit("")))))


def name_similarity_bound(a: Column | str, b: Column | str) -> Column:
    """What name_similarity can't exceed, without Python: matching blocks hold at most the letters that both names have, each as often as in the name that has it less."""
    x, y = F.lower(F.trim(F.coalesce(_c(a), F.lit("")))), F.lower(F.trim(F.coalesce(_c(b), F.lit(""))))
    letters = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x), F.lit(1))), lambda i: F.substring(x, i, 1)))
    often = lambda t, c: F.length(t) - F.length(F.replace(t, c))
    common = F.aggregate(letters, F.lit(0), lambda n, c: n + F.least(often(x, c), often(y, c)))
    return F.when((x != "") & (y != ""), F.lit(2.0) * common / (F.length(x) + F.length(y))).otherwise(F.lit(0.0))


def levenshtein_similarity(a: Column | str, b: Column | str) -> Column:
    """Another measure, without Python: 1 - edits / length of the longer."""
    x, y = F.lower(F.trim(_c(a))), F.lower(F.trim(_c(b)))
    longer = F.greatest(F.length(x), F.length(y))
    return F.coalesce(F.when(longer > 0, 1 - F.levenshtein(x, y) / longer), F.lit(0.0))
