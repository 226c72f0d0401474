"""Area hierarchy, continents, geocoding parameters, coordinates, artist catalog ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playmart.functions.text import without_word
from playmart.operators.discover import areas_needing_coordinates, countries_needing_enrichment
from playmart.operators.sinks import upsert, write_merge, write_overwrite
from playmart.schemas import AREA_LEVELS
from playmart.sources.tables import read_table

# fixed values: country and island names and the name they are looked up by
NAME_OVERRIDES = {
    "Kingdom of the Netherlands": "Netherlands",
    "South Korea": "Korea, Republic of",
    "Democratic Republic of the Congo": "Congo, The Democratic Republic of the",
    "Bermuda": "United Kingdom",
    "Cayman Islands": "United Kingdom",
    "British Virgin Islands": "United Kingdom",
    "US Virgin Islands": "United States",
    "Puerto Rico": "United States",
    "Guam": "United States",
    "American Samoa": "United States",
    "Northern Mariana Islands": "United States",
    "Martinique": "France",
    "Guadeloupe": "France",
    "French Guiana": "France",
    "Réunion": "France",
    "Mayotte": "France",
    "New Caledonia": "France",
    "French Polynesia": "France",
    "Aruba": "Netherlands",
    "Curaçao": "Netherlands",
    "Sint Maarten": "Netherlands",
    "Greenland": "Denmark",
    "Faroe Islands": "Denmark",
    "Gibraltar": "United Kingdom",
    "Isle of Man": "United Kingdom",
    "Jersey": "United Kingdom",
    "Guernsey": "United Kingdom",
    "Hong Kong": "China",
    "Macau": "China",
    "Taiwan": "Taiwan",
    "Cook Islands": "New Zealand",
    "Niue": "New Zealand",
    "Tokelau": "New Zealand",
}
MUNICIPALITY = "municipality"
AREAS, CITIES = "mbz_area_hierarchy", "cities_with_lat_long"
CONTINENT_FIELDS = ("continent", "country_code", "continent_code")


def area_closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Every root with itself and all its ancestors, once each.

    ``edges`` has child, parent and optionally ``ord``, the position of the relation in the
    child's list (else parents are taken in their own order). ``visit`` is the path of positions,
    from 1, under which a depth-first walk first meets the area, so sorting by it gives the order
    of that walk. Each round extends only the rows that improved and rounds end when none did; a
    path that returns to an area it came through never improves it, so cycles end.
    """
    place = F.min("ord" if "ord" in edges.columns else "parent").alias("_place")
    listed = edges.where("child IS NOT NULL AND parent IS NOT NULL").groupBy(
        F.col("child").alias("area_id"), F.col("parent").alias("_parent")).agg(place)
    at = F.row_number().over(Window.partitionBy("area_id").orderBy("_place", "_parent"))
    step = listed.select("area_id", "_parent", at.cast("bigint").alias("_at"))
    no_path = F.array().cast("array<bigint>")
    frontier = roots.select(F.col("area_id").alias("root_id"), "area_id",
                            no_path.alias("visit")).distinct().checkpoint()
    step, closure = step.checkpoint(), frontier
    while not frontier.isEmpty():
        reached = (
            frontier.join(step, "area_id")
            .groupBy("root_id", F.col("_parent").alias("area_id"))
            .agg(F.min(F.concat("visit", F.array("_at"))).alias("visit"))
        )
        known = closure.withColumnRenamed("visit", "_known")
        frontier = (
            reached.join(known, ["root_id", "area_id"], "left")
            .where(F.col("_known").isNull() | (F.col("visit") < F.col("_known")))
            .drop("_known").checkpoint()
        )
        closure = (
            closure.unionByName(frontier).groupBy("root_id", "area_id")
            .agg(F.min("visit").alias("visit")).checkpoint()
        )
    return closure.withColumn("depth", F.size("visit").cast("bigint"))


def _level(type_name: Column) -> Column:
    return F.translate(F.lower(F.coalesce(type_name, F.lit("Unknown"))), " -", "__")


def _named_levels(closure: DataFrame, areas: DataFrame) -> DataFrame:
    return closure.join(areas, "area_id").select(
        "root_id", "area_id", "visit",
        F.coalesce("type", F.lit("Unknown")).alias("type"), _level(F.col("type")).alias("level"),
        "name", F.coalesce("sort_name", "name").alias("sort_name"),
    )


def hierarchy_levels(closure: DataFrame, areas: DataFrame) -> DataFrame:
    """One row per root and level that it or an ancestor has, whatever the area type is called:
    id, name and sort name of the area of that level that is met last."""
    entry = F.struct("visit", "area_id", "name", "sort_name")
    return _named_levels(closure, areas).groupBy(
        F.col("root_id").alias("root"), "level").agg(F.max(entry).alias("e")).select(
        F.col("root").alias("area_id"), "level", F.col("e.area_id").alias("level_id"),
        F.col("e.name").alias("level_name"), F.col("e.sort_name").alias("level_sort_name"))


def pivot_hierarchy(closure: DataFrame, areas: DataFrame, levels=AREA_LEVELS) -> DataFrame:
    """One row per root: own type and names, and id, name, sort name per ancestor level.

    ``areas`` has area_id, type, name, sort_name. Of two ancestors of one level the one met last
    wins. ``hierarchy_levels`` has the levels that are not asked for as columns.
    """
    named = _named_levels(closure, areas)
    entry = F.struct("visit", "area_id", "type", "name", "sort_name")
    own = F.max(F.when(F.col("area_id") == F.col("root_id"), entry)).alias("_own")
    latest = [F.max(F.when(F.col("level") == level, entry)).alias(f"_{level}")
              for level in levels]
    wide = named.groupBy("root_id").agg(own, *latest)
    columns = [F.col("root_id").alias("area_id"), F.col("_own.type").alias("area_type"),
               F.col("_own.name").alias("area_name"),
               F.col("_own.sort_name").alias("area_sort_name")]
    for level in levels:
        columns += [F.col(f"_{level}.area_id").alias(f"{level}_id"),
                    F.col(f"_{level}.name").alias(f"{level}_name"),
                    F.col(f"_{level}.sort_name").alias(f"{level}_sort_name")]
    return wide.select(*columns)


# names and codes by which a country may be called, where the reference has them
COUNTRY_NAMES = ("name", "alpha_2", "alpha_3", "numeric", "official_name", "common_name")


GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters; none where the text is shorter."""
    last = F.char_length(text) - size + 1
    places = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(size))))


def containing(needles: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (``needle``, ``text``) of two lists of distinct strings where the text contains the
    needle.

    An index lists each text under its runs of three characters, and of two, one and none for
    needles that are shorter. A needle is looked up under its rarest run alone, and what is listed
    there is compared, so work grows with the characters and the length of these lists. The empty
    needle is in every text; NULL contains and is in nothing.
    """
    text, needle = F.col("text"), F.col("needle")
    index = texts.where("text IS NOT NULL").select("text", F.explode(F.flatten(F.array(
        F.array(F.lit("")), *[_grams(text, n) for n in range(1, GRAM + 1)]))).alias("gram"))
    length, own = F.char_length(needle), _grams(needle, GRAM)
    for n in range(1, GRAM):
        own = F.when(length == n, _grams(needle, n)).otherwise(own)
    own = F.when(length == 0, F.array(F.lit(""))).otherwise(own)
    asked = needles.where("needle IS NOT NULL").select("needle", F.explode(own).alias("gram"))
    listed = index.join(asked.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"))
    # a run that no text has is the rarest and finds nothing, as it should
    rarest = asked.join(listed, "gram", "left").groupBy("needle").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))["gram"].alias("gram"))
    return rarest.join(index, "gram").where(F.contains(text, needle)).select("needle", "text")


def continent_lookup(countries: DataFrame, reference: DataFrame,
                     overrides: dict[str, str] | None = None) -> DataFrame:
    """Continent and codes per country name; NULLs where nothing matches.

    ``reference`` has ord, name, alpha_2, continent, continent_code and maybe more of
    ``COUNTRY_NAMES``. A name or code that is equal (any case) wins; else the first entry, by ord,
    where one name contains the other, found through an index of runs of three characters.
    """
    overrides = NAME_OVERRIDES if overrides is None else overrides
    name = F.col("country_name")
    if overrides:
        renamed = F.create_map(*[F.lit(x) for pair in overrides.items() for x in pair])
        name = F.coalesce(F.try_element_at(renamed, name), name)
    wanted = countries.select("country_name").distinct().withColumn("_name", F.lower(name))
    asked = wanted.select("_name").where("_name IS NOT NULL").distinct()
    entry = F.struct("ord", "continent", "alpha_2", "continent_code")
    listed = [F.lower(F.col(c).cast("string")) for c in COUNTRY_NAMES if c in reference.columns]
    called = reference.select(F.explode(F.array_distinct(F.array_compact(F.array(*listed))))
                              .alias("_name"), entry.alias("e"))
    equal = called.groupBy("_name").agg(F.min("e").alias("_equal"))
    named = reference.where("name IS NOT NULL").groupBy(F.lower("name").alias("_whole")).agg(
        F.min(entry).alias("e"))
    # an entry's name is a part of the wanted one, or the other way round
    inside = containing(named.select(F.col("_whole").alias("needle")),
                        asked.select(F.col("_name").alias("text"))).select(
        F.col("needle").alias("_whole"), F.col("text").alias("_name"))
    around = containing(asked.select(F.col("_name").alias("needle")),
                        named.select(F.col("_whole").alias("text"))).select(
        F.col("text").alias("_whole"), F.col("needle").alias("_name"))
    similar = inside.unionAll(around).join(named, "_whole").groupBy("_name").agg(
        F.min("e").alias("_similar"))
    return wanted.join(equal, "_name", "left").join(similar, "_name", "left").withColumn(
        "_m", F.coalesce("_equal", "_similar")).select(
        F.col("country_name").alias("country"),
        F.col("_m.continent").alias("continent"),
        F.col("_m.alpha_2").alias("country_code"),
        F.col("_m.continent_code").alias("continent_code"),
    )


def merge_continents(areas: DataFrame, lookup: DataFrame) -> DataFrame:
    """Looked-up continent fields over the stored ones; missing fields are added.

    ``lookup`` has one row per country name.
    """
    side = lookup.select(F.col("country").alias("_country"),
                         *[F.col(f).alias(f"_new_{f}") for f in CONTINENT_FIELDS])
    joined = areas.withColumn("_key", F.coalesce("country_name", "island_name")).join(
        side, F.col("_key") == F.col("_country"), "left")
    values = {
        f: F.coalesce(f"_new_{f}", f) if f in areas.columns else F.col(f"_new_{f}")
        for f in CONTINENT_FIELDS
    }
    return joined.withColumns(values).select(
        *areas.columns, *[f for f in CONTINENT_FIELDS if f not in areas.columns])


def _city() -> Column:
    return F.coalesce("city_name", "municipality_name")


def add_geocoding_params(areas: DataFrame) -> DataFrame:
    """Rows with a city or municipality, with ``params`` = city,country code.

    These rows are merged back into the stored areas by area_id.
    """
    params = F.concat(_city(), F.lit(","), F.coalesce("country_code", F.lit("")))
    return areas.where(_city().isNotNull()).withColumn("params", params)


def merge_geocoding_params(areas: DataFrame) -> DataFrame:
    """All areas, those with a city or municipality with new ``params``.

    Equal to an upsert of ``add_geocoding_params`` by area_id, without its join.
    """
    params = F.concat(_city(), F.lit(","), F.coalesce("country_code", F.lit("")))
    old = F.col("params") if "params" in areas.columns else F.lit(None).cast("string")
    return areas.withColumn("params", F.when(_city().isNotNull(), params).otherwise(old))


def add_state_codes_and_params(areas: DataFrame, states: DataFrame) -> DataFrame:
    """``params`` = city,[state code,]country code; NULL without a city or a country code.

    ``states`` has name, country_code, code.
    """
    side = states.select(F.col("name").alias("subdivision_name"), "country_code", "code")
    joined = areas.join(side, ["subdivision_name", "country_code"], "left")
    state = F.when(F.col("code").isNotNull(), F.concat("code", F.lit(","))).otherwise("")
    return joined.withColumn(
        "params", F.concat(_city(), F.lit(","), state, "country_code")
    ).select(*[c for c in areas.columns if c != "params"], "code", "params")


def clean_municipality_names(areas: DataFrame) -> DataFrame:
    return areas.withColumn(
        "municipality_name", without_word(F.col("municipality_name"), MUNICIPALITY))


def parse_location_params(df: DataFrame) -> DataFrame:
    """City, state code (three parts only) and country code of ``params`` texts."""
    parts = F.split("params", ",")
    blank = F.lit("")
    return df.where(F.col("params") != "").select(
        parts[0].alias("city_name"),
        F.when(F.size(parts) == 3, F.try_element_at(parts, F.lit(2))).otherwise(blank)
        .alias("state_code"),
        F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(blank)
        .alias("country_code"),
        "params",
    )


def attach_coordinates(params: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Parsed params with lat and long as text; unmatched ones stay with NULLs.

    ``gazetteer`` has params, lat, long, one row per params.
    """
    found = gazetteer.select("params", F.col("lat").cast("string").alias("lat"),
                             F.col("long").cast("string").alias("long"))
    return parse_location_params(params.select("params").distinct()).join(
        found, "params", "left").select(
        "city_name", "state_code", "country_code", "params", "lat", "long")


def merge_coordinates(cities: DataFrame | None, params: DataFrame,
                      gazetteer: DataFrame) -> DataFrame:
    """Stored cities with the newly looked-up ones merged in."""
    return upsert(cities, attach_coordinates(params, gazetteer), ["params"])


def coordinate_counts(attached: DataFrame) -> DataFrame:
    return attached.agg(F.count(F.lit(1)).alias("locations_processed"),
                        F.count("lat").alias("successful_lookups"))


def backfill_artist_mbids(artists: DataFrame, info: DataFrame) -> DataFrame:
    """Fills missing catalog ids; of several catalog entries per artist the lowest id is used."""
    known = (
        info.where(F.col("spotify_id").isNotNull()).groupBy(F.col("spotify_id").alias("artist_id"))
        .agg(F.min("id").alias("_mbid"))
    )
    return artists.join(known, "artist_id", "left").withColumn(
        "artist_mbid", F.coalesce("artist_mbid", "_mbid")).select(*artists.columns)


def backfill_count(artists: DataFrame, updated: DataFrame) -> DataFrame:
    """One row: artists that had no catalog id before and have one now."""
    before = artists.agg(F.count("artist_mbid")).scalar()
    return updated.agg((F.count("artist_mbid") - before).alias("updates_made"))


# enrichment flows: from stored tables to stored tables

def enrich_continents(spark: SparkSession, base: str, reference: DataFrame) -> DataFrame:
    """Looks up the countries of the stored areas that lack a continent, merges the fields in,
    cleans municipality names, and writes the areas. Returns the written table."""
    areas = read_table(spark, base, AREAS)
    lookup = continent_lookup(countries_needing_enrichment(areas), reference)
    write_overwrite(clean_municipality_names(merge_continents(areas, lookup)), base, AREAS)
    return read_table(spark, base, AREAS)


def enrich_params(spark: SparkSession, base: str, states: DataFrame | None = None) -> DataFrame:
    """Geocoding params of the stored areas, with state codes where they are given."""
    areas = read_table(spark, base, AREAS)
    if states is None:
        named = merge_geocoding_params(areas)
    else:
        plain = areas.drop("code") if "code" in areas.columns else areas
        named = add_state_codes_and_params(plain, states).drop("code").select(*areas.columns)
    write_overwrite(named, base, AREAS)
    return read_table(spark, base, AREAS)


def enrich_coordinates(spark: SparkSession, base: str, gazetteer: DataFrame) -> DataFrame:
    """Looks up the params of stored areas that no stored city has and merges them into the cities,
    those without coordinates too. Returns the written cities."""
    known = read_table(spark, base, CITIES)
    wanted = areas_needing_coordinates(read_table(spark, base, AREAS), known)
    write_merge(attach_coordinates(wanted, gazetteer), base, CITIES)
    return read_table(spark, base, CITIES)


def enrich_artist_ids(spark: SparkSession, base: str) -> DataFrame:
    """Fills the missing catalog ids of the stored artists. Returns the written artists."""
    artists, info = (read_table(spark, base, t) for t in ("spotify_artists", "mbz_artist_info"))
    write_overwrite(backfill_artist_mbids(artists, info), base, "spotify_artists")
    return read_table(spark, base, "spotify_artists")
