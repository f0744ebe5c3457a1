"""Queries over published sites: filters, ranked search, pages, options, statistics, bounds."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark import schema as S
from waymark.functions.cleaning import display_source, normalize_location
from waymark.sources.io import silver

LEVELS = ("region", "province", "municipality", "barangay")


def load_sites(public: DataFrame, private: DataFrame) -> DataFrame:
    """Both outputs under each other with their sector, and display forms of places."""
    private = private.withColumn("coord_source", display_source("coord_status"))
    both = public.withColumn("sector", F.lit("public")).unionByName(private.withColumn("sector", F.lit("private")), allowMissingColumns=True)
    return both.withColumns({c: normalize_location(c) for c in LEVELS if c in both.columns})


def _same(col: str, value: str) -> Column:
    return F.coalesce(F.lower(F.trim(F.col(col))) == value.strip().lower(), F.lit(False))


def filter_sites(df: DataFrame, sector: str | None = None, enrollment_status: str | None = None, has_coordinates: bool | None = None, **levels: str | None) -> DataFrame:
    """Exact matches, places without case and outer spaces."""
    if sector:
        df = df.where(F.col("sector") == sector.lower())
    for level, value in levels.items():
        if level not in LEVELS:
            raise ValueError(f"{level} is no level")
        if value:
            df = df.where(_same(level, value))
    if enrollment_status:
        df = df.where(F.col("enrollment_status") == enrollment_status)
    if has_coordinates is not None:
        df = df.where(F.col("latitude").isNotNull() if has_coordinates else F.col("latitude").isNull())
    return df


def search(df: DataFrame, q: str, key: str = "site_id", name: str = "site_name", order: str = "_ord") -> DataFrame:
    """Rows that match, best first, with their score: 0 the ID itself, 1 the name starts with q, 2 it contains q; of equal scores in order."""
    n = F.lower(F.coalesce(F.col(name), F.lit("")))
    score = F.when(F.col(key) == q, 0).when(n.startswith(q.lower()), 1).when(n.contains(q.lower()), 2)
    return df.withColumn("score", score).where("score is not null").orderBy("score", order)


def name_grams(df: DataFrame, key: str = "site_id", name: str = "site_name") -> DataFrame:
    """gram, key: the different strings of three characters in each name, in lower case. An index to be published in the order of gram, so that a query reads the row groups of its own grams."""
    n = F.lower(F.coalesce(F.col(name), F.lit("")))
    grams = F.transform(F.sequence(F.lit(1), F.length(n) - 2), lambda i: F.substring(n, i, 3))
    return df.where(F.length(n) >= 3).select(F.explode(F.array_distinct(grams)).alias("gram"), key).distinct()


def search_by_grams(df: DataFrame, grams: DataFrame, q: str, key: str = "site_id", name: str = "site_name", order: str = "_ord") -> DataFrame:
    """What search gives, by the index: only rows whose names have every gram of q, and the row of that ID, are looked at. Keys aren't null. Queries of fewer than three characters are scanned for."""
    low = q.lower()
    wanted = sorted({low[i : i + 3] for i in range(len(low) - 2)})
    if not wanted:
        return search(df, q, key, name, order)
    having = grams.where(F.col("gram").isin(wanted)).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") == len(wanted)).select(key)
    own = df.where(F.col(key) == q).select(key)
    return search(df.join(having.union(own), key, "left_semi"), q, key, name, order)


def page(df: DataFrame, limit: int | None = None, offset: int = 0) -> tuple[int, DataFrame]:
    """Number of all rows and those of the page."""
    out = df.offset(offset) if offset else df
    return df.count(), out if limit is None else out.limit(limit)


def page_marks(df: DataFrame, size: int, key: str = "site_id") -> DataFrame:
    """page, first: the first key of each page of `size` rows in the order of a key that doesn't repeat, one row a page. Rows are numbered within sorted ranges, and the counts of the ranges, added up, give each its offset; so no task has all rows."""
    row = F.monotonically_increasing_id()
    numbered = silver(df.select(F.col(key).alias("first")).orderBy("first").select("first", F.shiftright(row, 33).alias("range"), row.bitwiseAND((1 << 33) - 1).alias("i")), "numbered")
    counts = numbered.groupBy("range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    at = numbered.join(counts.select("range", before.alias("before")), "range").select("first", (F.col("before") + F.col("i")).alias("p"))
    return at.where(F.col("p") % size == 0).select((F.col("p") / size).cast("long").alias("page"), "first")


def seek_page(df: DataFrame, marks: DataFrame, number: int, key: str = "site_id") -> DataFrame:
    """Page number (from 0) by the marks of its ends: the scan of a table sorted by the key reads the row groups between them alone, however far the page is."""
    ends = [r["first"] for r in marks.where(F.col("page").isin(number, number + 1)).orderBy("page").collect()]  # one or two
    if not ends:
        return df.limit(0)
    own = df.where(F.col(key) >= ends[0])
    return (own.where(F.col(key) < ends[1]) if len(ends) > 1 else own).orderBy(key)


def get_site(df: DataFrame, site_id: str, key: str = "site_id") -> DataFrame:
    return df.where(F.col(key) == site_id).limit(1)


def filter_options(df: DataFrame, region: str | None = None, province: str | None = None, municipality: str | None = None) -> DataFrame:
    """level, value: the choices of each level given those above. Municipalities depend on the province only, barangays on the municipality only."""
    parts = [df.select(F.lit("region").alias("level"), F.col("region").alias("value"))]
    if region:
        parts.append(df.where(_same("region", region)).select(F.lit("province").alias("level"), F.col("province").alias("value")))
    if province:
        parts.append(df.where(_same("province", province)).select(F.lit("municipality").alias("level"), F.col("municipality").alias("value")))
    if municipality:
        parts.append(df.where(_same("municipality", municipality)).select(F.lit("barangay").alias("level"), F.col("barangay").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.where("value is not null and value <> ''").distinct().orderBy("level", "value")


def all_options(df: DataFrame) -> DataFrame:
    """Every choice of every level with the choice above it, in one aggregate: for a client that filters by itself."""
    above = dict(zip(LEVELS[1:], LEVELS, strict=False))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("level"), (F.col(above[c]) if c in above else F.lit(None).cast("string")).alias("parent"), F.col(c).alias("value")) for c in LEVELS if c in df.columns]))
    return df.select(pairs.alias("p")).select("p.*").where("value is not null and value <> ''").distinct()


def stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.col("sector") == "public").alias("public"), F.count_if(F.col("sector") == "private").alias("private"), F.count("latitude").alias("with_coordinates"), F.count_if(F.col("enrollment_status") == "active").alias("active"))


def _summary() -> list[Column]:
    private = F.col("sector") == "private"
    return [
        F.count("*").alias("total"), F.count_if(F.col("sector") == "public").alias("public"), F.count_if(private).alias("private"),
        F.count("latitude").alias("with_coordinates"), (F.count("*") - F.count("latitude")).alias("without_coordinates"),
        F.round(100.0 * F.count("latitude") / F.count("*"), 1).alias("coverage_pct"),
        F.count_if(F.col("enrollment_status") == "active").alias("active_enrollment"), F.count_if(F.col("enrollment_status") == "no_enrollment_reported").alias("no_enrollment_reported"),
    ]


def summary(df: DataFrame, programmes: Sequence[str] = ()) -> DataFrame:
    """One row of counts of the rows given (filter first)."""
    return df.agg(*_summary(), *[F.count_if((F.col("sector") == "private") & (F.col(p) == 1)).alias(p) for p in programmes])


def area_summaries(df: DataFrame, levels: Sequence[str] = LEVELS[:3], programmes: Sequence[str] = ()) -> DataFrame:
    """The summary of every area of every level, and of all: one rollup."""
    return df.rollup(*levels).agg(*_summary(), F.grouping_id().cast("long").alias("depth"), *[F.count_if((F.col("sector") == "private") & (F.col(p) == 1)).alias(p) for p in programmes])


def source_distribution(df: DataFrame) -> DataFrame:
    """Sources of public sites, statuses of all; null is none and unknown."""
    src = df.where("sector = 'public'").groupBy(F.lit("coord_source").alias("metric"), F.coalesce(F.nullif(F.col("coord_source"), F.lit("")), F.lit("none")).alias("key")).agg(F.count("*").alias("value"))
    st = df.groupBy(F.lit("coord_status").alias("metric"), F.coalesce(F.nullif(F.col("coord_status"), F.lit("")), F.lit("unknown")).alias("key")).agg(F.count("*").alias("value"))
    return src.unionByName(st)


def _narrowed(values: DataFrame, group: Sequence[str], ranges: int) -> DataFrame:
    """One step towards the wanted values: a sketch of each group's values (approximate quantiles) cuts them into ranges, exact counts of the ranges tell which one holds the wanted index, and its values stay, with the index among them."""
    keys = [*group, "i"]
    bounds = values.groupBy(*keys).agg(F.percentile_approx("v", [k / ranges for k in range(1, ranges)], 40 * ranges).alias("bounds"))
    cut = values.join(bounds, keys).withColumn("s", F.size(F.filter("bounds", lambda b: b <= F.col("v")))).drop("bounds")
    counts = cut.groupBy(*keys, "s").agg(F.sum("c").alias("n"), F.first("at").alias("at"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("s").rowsBetween(Window.unboundedPreceding, 0))  # a row for each range
    holds = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n")).where("before <= at and at < upto")
    return cut.join(holds.select(*keys, "s", "before"), [*keys, "s"]).select(*keys, "v", "c", (F.col("at") - F.col("before")).alias("at"))


def _order_statistic(df: DataFrame, group: Sequence[str], col: str, n: str, shares: Sequence[float], most: int = 100_000, ranges: int = 200) -> DataFrame:
    """For each group the values at index floor(n * share) in order, exactly. Equal values are counted first. While a group has more than `most` different ones, sketches narrow them down to the range that holds the index, some `ranges` times smaller each time; only then are they ranked, so no task ranks more than that, however close together the values lie. The driver sees one number a step."""
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(n) * s).alias("at")) for i, s in enumerate(shares)])).alias("w")
    values = df.groupBy(*group, n, F.col(col).alias("v")).agg(F.count("*").alias("c")).select(*group, "v", "c", wanted).select(*group, "w.i", "v", "c", "w.at")
    values = silver(values, "values")
    while (values.groupBy(*group, "i").count().agg(F.max("count")).first()[0] or 0) > most:
        values = silver(_narrowed(values, group, ranges), "values")
    ranked = values.withColumn("upto", F.sum("c").over(Window.partitionBy(*group, "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    return ranked.where("upto > at").groupBy(*group).agg(*[F.min(F.when(F.col("i") == i, F.col("v"))).alias(f"{col}_q{i}") for i in range(len(shares))])


def robust_bounds(df: DataFrame, group: Sequence[str] = ("region",)) -> DataFrame:
    """Bounds of each group's points without stray ones: beyond twice the quartile range on an axis. Groups of at most three, and those that would lose over half, keep all. Quartiles are the values at floor(n/4) and floor(3n/4)."""
    group = list(group)
    have = df.where("latitude is not null and longitude is not null").select(*group, "latitude", "longitude")
    sized = have.join(have.groupBy(*group).agg(F.count("*").alias("n")), group)
    axes = F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).alias("x")) for c in ("latitude", "longitude")])).alias("a")
    quartiles = _order_statistic(sized.select(*group, "n", axes).select(*group, "n", "a.*"), [*group, "axis"], "x", "n", (0.25, 0.75))
    q = sized.join(quartiles.groupBy(*group).agg(*[F.min(F.when(F.col("axis") == c, F.col(f"x_q{i}"))).alias(f"{c}_q{i}") for c in ("latitude", "longitude") for i in (0, 1)]), group)

    def fenced(c: str) -> Column:
        reach = 2 * (F.col(f"{c}_q1") - F.col(f"{c}_q0"))
        return F.col(c).between(F.col(f"{c}_q0") - reach, F.col(f"{c}_q1") + reach)

    near = fenced("latitude") & fenced("longitude")
    both = [f(x).alias(f"{p}{n}") for p, cond in (("all_", F.lit(True)), ("in_", near)) for n, f, x in (("lat_min", F.min, F.when(cond, F.col("latitude"))), ("lat_max", F.max, F.when(cond, F.col("latitude"))), ("lon_min", F.min, F.when(cond, F.col("longitude"))), ("lon_max", F.max, F.when(cond, F.col("longitude"))))]
    agg = q.groupBy(*group).agg(F.max("n").alias("n"), F.count_if(near).alias("n_in"), *both)
    use_all = (F.col("n") <= 3) | (F.col("n_in") < F.col("n") * 0.5)
    return agg.select(*group, "n", *[F.when(use_all, F.col(f"all_{c}")).otherwise(F.col(f"in_{c}")).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")])


def positions(df: DataFrame, by: str, order: str, span: int = 1 << 20) -> DataFrame:
    """p: 0-based position of each row in its group by order, a number that doesn't repeat. Rows are ranked within spans of the order, and a window over the spans' counts gives each span its offset, so no task has a whole group."""
    cut = df.withColumn("__span", F.floor(F.col(order) / span))
    counts = cut.groupBy(by, "__span").agg(F.count("*").alias("__c"))
    before = F.coalesce(F.sum("__c").over(Window.partitionBy(by).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = cut.withColumn("__i", F.row_number().over(Window.partitionBy(by, "__span").orderBy(order)) - 1)
    return inside.join(counts.select(by, "__span", before.alias("__before")), [by, "__span"]).withColumn("p", F.col("__before") + F.col("__i")).drop("__span", "__i", "__before")


def stratified_cap(df: DataFrame, n: int = 3000, by: str = "sector", first: str = "public", order: str = "_ord") -> DataFrame:
    """At most n rows with coordinates, sectors in proportion and evenly spread by position in each: the slots of the first sector are rounded, the other gets the rest. The cap is the feature."""
    have = df.where("latitude is not null")
    size = have.groupBy(by).agg(F.count("*").alias("size"))
    total = have.agg(F.count("*").alias("total"), F.count_if(F.col(by) == first).alias("n_first"))  # one row
    own = F.floor(F.col("n_first") / F.col("total") * n + 0.5)
    slots = F.when(F.col("total") <= n, F.col("size")).when(F.col(by) == first, own).otherwise(n - own)
    rows = positions(have, by, order).join(F.broadcast(size.join(F.broadcast(total), F.lit(True)).select(by, "size", slots.alias("slots"))), by)
    step = F.col("size") / F.col("slots")
    # position i * step, floored, for some i < slots
    i = F.ceil(F.col("p") / step)
    kept = (F.col("size") <= F.col("slots")) | ((F.floor(i * step) == F.col("p")) & (i < F.col("slots")))
    return rows.where((F.col("slots") > 0) & kept).drop("p", "size", "slots")


def locality_bounds(site: DataFrame, df: DataFrame) -> DataFrame:
    """For sites without coordinates the robust bounds of their municipality, else province, else region, whichever has points."""
    out = site.where("latitude is null")
    cols = ("lat_min", "lat_max", "lon_min", "lon_max")
    for level in ("municipality", "province", "region"):
        b = robust_bounds(df.where(F.col(level).isNotNull()), [level]).select(level, *[F.col(c).alias(f"{level}_{c}") for c in cols])
        out = out.join(b, level, "left")
    out = out.withColumns({c: F.coalesce(*[F.col(f"{level}_{c}") for level in ("municipality", "province", "region")]) for c in cols})
    return out.select(*site.columns, *cols)


def sort_sites(df: DataFrame, key: str, descending: bool = False) -> DataFrame:
    c = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return df.orderBy(c.desc() if descending else c.asc(), "_ord")


def severity(df: DataFrame, out: str = "severity") -> DataFrame:
    status, reason = F.col("coord_status"), F.col("coord_rejection_reason")
    bad = status == "suspect"
    value = (
        F.when(F.col("latitude").isNull(), "no_coords")
        .when(bad & reason.isin("placeholder_default", "coordinate_cluster"), "fake")
        .when(bad & (reason == "outside_all_polygons"), "outside")
        .when(bad & reason.isin("wrong_municipality", "round_coordinates"), "investigate")
        .when(status.isin(*S.TRUSTED), "confident")
        .otherwise("unknown")
    )
    return df.withColumn(out, value)


#: What each reason means, in our words.
EXPLANATIONS = {
    "no_coordinate_source": "no source has coordinates for this site",
    "outside_all_polygons": "the point lies in no administrative unit, often over water",
    "wrong_municipality": "the point lies in another unit than the one recorded",
    "placeholder_default": "the point is a known default of a form",
    "coordinate_cluster": "sites of several units share this very point",
    "round_coordinates": "the coordinates are too coarse to be a measurement",
    "invalid": "the coordinates are missing, zero or impossible",
    "out_of_bounds": "the point lies outside the country",
    "no_submission": "the site has sent no coordinates",
    "not_in_lis": "the site is not in the information system",
}


def lineage(df: DataFrame) -> DataFrame:
    """trust (of the source), n_sources and explanation (of the reason) of every row. The dictionaries are a few constants."""
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    return df.withColumns(
        {
            "trust": F.try_element_at(table(S.TRUST), F.col("coord_source")),
            "n_sources": F.when(F.coalesce(F.col("sources_available") != "", F.lit(False)), F.size(F.split("sources_available", ","))).otherwise(F.lit(0)),
            "explanation": F.try_element_at(table(EXPLANATIONS), F.col("coord_rejection_reason")),
        }
    )
