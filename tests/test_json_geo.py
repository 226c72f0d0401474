import json
import random

import pytest

from playmart.operators import geo, jsonops
from tests.conftest import tuples


def test_normalize_artist_documents(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({
        "id": "1", "sort-name": "S", "alias-list": [1], "tag-list": [{"name": "rock", "count": "2"}],
        "area": {"id": "x", "sort-name": "X", "iso-list": [1]}, "life-span": {"ended": "true"},
        "ipis": ["a"]}, indent=1))
    (tmp_path / "two.json").write_text(json.dumps({"id": "2", "gender": "f"}))
    out = jsonops.normalize_artist_json(jsonops.read_artist_json(spark, str(tmp_path)))
    assert set(out.columns) == {"id", "sort_name", "tag_list", "area_id", "area_sort_name",
                                "life_span_ended", "ipis", "gender", "source_file"}
    rows = {r.id: r for r in out.collect()}
    assert json.loads(rows["1"].tag_list) == [{"count": "2", "name": "rock"}]
    assert (rows["1"].source_file, rows["1"].ipis, rows["2"].area_id) == ("one", '["a"]', None)
    stored = spark.createDataFrame([], "id string, gender string, country string")
    fit = jsonops.conform_to_table(out, stored)
    assert fit.columns == stored.columns and fit.where("country is null").count() == 2


def test_flatten_json_column_takes_any_number_of_keys(spark):
    """Keys of all rows become columns, each value in its own."""
    rows = [(k, json.dumps({f"key {k}-{j}": j for j in range(20)})) for k in range(60)]
    got = jsonops.flatten_json_column(spark.createDataFrame(rows, "id int, j string"), "j", "p")
    assert len(got.columns) == 2 + 60 * 20
    row = got.where("id = 7").first()
    assert row["p_key 7_3"] == "3" and row["p_key 8_3"] is None


def test_flatten_json_column(spark):
    df = spark.createDataFrame([('{"a-b": 1, "c": {"d": 2}}',), ("[1]",), (None,), ("bad",)],
                               "j string")
    got = jsonops.flatten_json_column(df, "j", "p")
    assert got.columns == ["j", "p_a_b", "p_c"]
    assert tuples(got, "p_a_b", "p_c") == [("1", '{"d":2}'), (None, None), (None, None),
                                           (None, None)]
    assert jsonops.flatten_json_column(df, "nope") is df
    clash = spark.createDataFrame([(1, '{"a-b":"1","a_b":"2"}')], "id int, j string")
    with pytest.raises(ValueError, match="a_b"):
        jsonops.flatten_json_column(clash, "j")
    with pytest.raises(ValueError, match="overwrite column 'id'"):
        jsonops.flatten_json_column(clash, "j", keys=["id"])


def test_json_extract_and_explode(spark):
    df = spark.createDataFrame([('{"a": {"b": 5}}', ["x", "y"]), ("bad", []), (None, None)],
                               "j string, genres array<string>")
    assert [r[2] for r in tuples(jsonops.json_extract(df, "j", "$.a.b"))] == ["5", None, None]
    assert [r[1] for r in tuples(jsonops.explode_array(df))] == ["x", "y", None, None]
    text = spark.createDataFrame([('["x","y"]',), ("[]",), (None,)], "genres string")
    assert [r[0] for r in tuples(jsonops.explode_array(text))] == ["x", "y", None, None]


def test_entity_genres(spark):
    df = spark.createDataFrame([("1", "n", ["a", "", None]), ("2", "m", [])],
                               "artist_id string, artist_name string, genres array<string>")
    assert tuples(jsonops.artist_genres(df)) == [("1", "n", "a")]
    albums = df.withColumnsRenamed({"artist_id": "album_id", "artist_name": "album_name"})
    assert jsonops.album_genres(albums).columns == ["album_id", "album_name", "genre"]


def test_catalog_genres_accept_text_and_number_counts(spark):
    df = spark.createDataFrame([
        ("m", "s", "A", '[{"count":"2","name":"x"},{"count":3,"name":"x"},{"count":1}]'),
        ("m2", None, "B", '[{"name":"y"},{"count":"9","name":"z"}]'),
        ("m3", None, "C", "[]"), ("m4", None, "D", None),
    ], "id string, spotify_id string, name string, tag_list string")
    assert tuples(jsonops.catalog_artist_genre(df), "artist_mbid", "mbz_genre",
                  "count_genre_tags") == [("m", "x", 5), ("m2", "z", 9), ("m2", "y", 0)]


def test_clean_null_strings(spark):
    df = spark.createDataFrame([(1, "nan"), (2, "ok")], "a int, b string")
    assert tuples(jsonops.clean_null_strings(df)) == [("1", None), ("2", "ok")]


EDGES = "child string, ord int, parent string"


def walk(edges, root):
    """Depth-first order of a recursive walk that visits each area once."""
    seen, children = [], {}
    for child, order, parent in sorted(edges, key=lambda e: e[1]):
        children.setdefault(child, []).append(parent)

    def visit(area):
        if area in seen:
            return
        seen.append(area)
        for parent in children.get(area, []):
            visit(parent)
    visit(root)
    return seen


@pytest.mark.parametrize("edges", [
    [("c", 1, "s"), ("s", 1, "n"), ("n", 1, "c")],  # cycle
    [("c", 1, "s"), ("c", 2, "n"), ("s", 1, "m"), ("m", 1, "n"), ("n", 1, "w")],  # two ways up
    [("c", 2, "a"), ("c", 1, "b"), ("a", 1, "x"), ("b", 1, "y")],
    [("z", 1, "q")],  # root without parents
])
def test_closure_follows_the_recursive_walk(spark, edges):
    df = spark.createDataFrame(edges, EDGES)
    roots = spark.createDataFrame([("c",)], "area_id string")
    got = geo.area_closure(df, roots).orderBy("visit")
    assert [r.area_id for r in got.collect()] == walk(edges, "c")


def test_pivot_takes_the_last_visited_of_a_level(spark):
    edges = spark.createDataFrame([("c", 1, "a"), ("c", 2, "b"), ("a", 1, "n")], EDGES)
    areas = spark.createDataFrame([
        ("c", "City", "City C", "C, City"), ("a", "Subdivision", "A", None),
        ("b", "Subdivision", "B", None), ("n", None, "N", None)],
        "area_id string, type string, name string, sort_name string")
    closure = geo.area_closure(edges, areas.select("area_id"))
    rows = {r.area_id: r for r in geo.pivot_hierarchy(closure, areas).collect()}
    c = rows["c"]
    assert (c.area_type, c.area_name, c.city_sort_name) == ("City", "City C", "C, City")
    assert (c.subdivision_id, c.subdivision_sort_name, c.unknown_id) == ("b", "B", "n")
    assert rows["n"].area_type == "Unknown" and rows["n"].country_id is None


REF = "ord int, name string, alpha_2 string, continent string, continent_code string"


def test_continent_lookup(spark):
    ref = spark.createDataFrame([
        (1, "Niger", "NE", "Africa", "AF"), (2, "Nigeria", "NG", "Africa", "AF"),
        (3, "Korea, Republic of", "KR", "Asia", "AS"), (4, "France", "FR", "Europe", "EU")], REF)
    names = ["Nigeria", "fr", "South Korea", "Mayotte", "Kingdom of France", "Kor", "Atlantis"]
    df = spark.createDataFrame([(n,) for n in names], "country_name string")
    got = {r.country: r.country_code for r in geo.continent_lookup(df, ref).collect()}
    assert got == {"Nigeria": "NG", "fr": "FR", "South Korea": "KR", "Mayotte": "FR",
                   "Kingdom of France": "FR", "Kor": "KR", "Atlantis": None}
    assert len(geo.NAME_OVERRIDES) == 33


def test_continent_lookup_by_any_code_and_without_a_bound(spark):
    ref = spark.range(3000).selectExpr(
        "cast(id as int) AS ord", "concat('land ', id, '.') AS name",
        "concat('L', id) AS alpha_2", "concat('LX', id) AS alpha_3", "cast(id as string) AS numeric",
        "concat('Realm of ', id) AS official_name", "'c' AS continent", "'d' AS continent_code")
    names = ["lx7", "12", "realm of 2999", "the Land 5. isle", "and 88.", "Nowhere", None]
    df = spark.createDataFrame([(n,) for n in names], "country_name string")
    got = {r.country: r.country_code for r in geo.continent_lookup(df, ref).collect()}
    assert got == {"lx7": "L7", "12": "L12", "realm of 2999": "L2999", "the Land 5. isle": "L5",
                   "and 88.": "L88", "Nowhere": None, None: None}


def test_containing_equals_brute_force(spark):
    rng = random.Random(5)
    texts = {"".join(rng.choice("ab é") for _ in range(rng.randrange(1, 300)))
             for _ in range(60)} | {"", "a", "ab", "aaa", "zzz"}
    needles = {t[i:i + rng.choice([1, 2, 3, 4, 9, 80])] for t in texts for i in (0, 7, 40)} | {
        "", "q", "qq", "abq", "aaaaaaaaaaaa", "zz"}
    left = spark.createDataFrame([(n,) for n in needles] + [(None,)], "needle string")
    right = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    got = tuples(geo.containing(left, right))
    assert sorted(got) == sorted((n, t) for n in needles for t in texts if n in t)
    assert geo.containing(left.where("false"), right).isEmpty()
    assert geo.containing(left, right.where("false")).isEmpty()


def test_closure_keeps_the_walk_of_long_ids_deep_chains_and_all_levels(spark):
    p = "aaaaaaaa-1111-"
    edges = [(p + "c", 2, p + "0001"), (p + "c", 1, p + "0002"), (p + "0001", 1, p + "n1"),
             (p + "0002", 1, p + "n2")]
    edges += [(f"x{k}", 1, f"x{k + 1}") for k in range(15)]
    df = spark.createDataFrame(edges, EDGES)
    roots = spark.createDataFrame([(p + "c",), ("x0",)], "area_id string")
    closure = geo.area_closure(df, roots)
    for root in (p + "c", "x0"):
        got = closure.where(closure.root_id == root).orderBy("visit")
        assert [r.area_id for r in got.collect()] == walk(edges, root)
    assert closure.where("area_id = 'x15'").first()["depth"] == 15
    areas = spark.createDataFrame(
        [(p + "c", "City"), (p + "0001", "Country"), (p + "0002", "Country"),
         (p + "n1", "Military base"), (p + "n2", None)], "area_id string, type string").selectExpr(
        "*", "area_id AS name", "cast(null as string) AS sort_name")
    # the position counts, not the id: 0002 is met first, so 0001 is the last country
    wide = geo.pivot_hierarchy(closure, areas).where("area_type = 'City'").first()
    assert wide.country_id == p + "0001" and wide.unknown_id == p + "n2"
    levels = {r.level: r.level_id for r in geo.hierarchy_levels(closure, areas).where(
        f"area_id = '{p}c'").collect()}
    assert levels == {"city": p + "c", "country": p + "0001", "military_base": p + "n1",
                      "unknown": p + "n2"}


def test_merge_continents(spark):
    lookup = spark.createDataFrame([("Guam", "Oceania", "GU", "OC"), ("X", None, None, None)],
                                   "country string, continent string, country_code string, "
                                   "continent_code string")
    areas = spark.createDataFrame([("1", None, "Guam", "old"), ("2", "X", "Guam", "kept"),
                                   ("3", None, None, None)],
                                  "area_id string, country_name string, island_name string, "
                                  "continent string")
    got = geo.merge_continents(areas, lookup)
    assert got.columns == [*areas.columns, "country_code", "continent_code"]
    assert sorted(tuples(got, "area_id", "continent", "country_code")) == [
        ("1", "Oceania", "GU"), ("2", "kept", None), ("3", None, None)]


def test_params(spark):
    areas = spark.createDataFrame([
        ("1", "Oslo", None, "NO", "S1"), ("2", None, "Bern", None, "S2"), ("3", None, None, "IT", "S1")],
        "area_id string, city_name string, municipality_name string, country_code string, "
        "subdivision_name string")
    assert sorted(tuples(geo.add_geocoding_params(areas), "area_id", "params")) == [
        ("1", "Oslo,NO"), ("2", "Bern,")]
    assert sorted(tuples(geo.merge_geocoding_params(areas), "area_id", "params")) == [
        ("1", "Oslo,NO"), ("2", "Bern,"), ("3", None)]
    states = spark.createDataFrame([("S1", "NO", "03")], "name string, country_code string, code string")
    assert sorted(tuples(geo.add_state_codes_and_params(areas, states), "area_id", "params")) == [
        ("1", "Oslo,03,NO"), ("2", None), ("3", None)]
    parts = spark.createDataFrame([("a",), ("a,b",), ("a,b,c",), ("a,b,c,d",), ("",), (None,)],
                                  "params string")
    assert tuples(geo.parse_location_params(parts)) == [
        ("a", "", "", "a"), ("a", "", "b", "a,b"), ("a", "b", "c", "a,b,c"),
        ("a", "", "d", "a,b,c,d")]


def test_coordinates(spark):
    wanted = spark.createDataFrame([("Oslo,NO",), ("Oslo,NO",), ("Bern,CH",)], "params string")
    gazetteer = spark.createDataFrame([("Oslo,NO", 59.9, 10.7)], "params string, lat double, long double")
    got = geo.attach_coordinates(wanted, gazetteer)
    assert sorted(tuples(got, "params", "lat", "long")) == [
        ("Bern,CH", None, None), ("Oslo,NO", "59.9", "10.7")]
    assert tuple(geo.coordinate_counts(got).first()) == (2, 1)
    assert geo.merge_coordinates(got, wanted, gazetteer).count() == 2


def test_backfill_mbids(spark):
    artists = spark.createDataFrame([("a", None), ("b", "kept"), ("c", None)],
                                    "artist_id string, artist_mbid string")
    info = spark.createDataFrame([("m2", "a"), ("m1", "a"), ("m3", "b"), ("m4", None)],
                                 "id string, spotify_id string")
    got = geo.backfill_artist_mbids(artists, info)
    assert sorted(tuples(got), key=str) == [("a", "m1"), ("b", "kept"), ("c", None)]
    assert geo.backfill_count(artists, got).first()["updates_made"] == 1
