"""Free-text places -> city, department, region, coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from offerscope.functions.text import blank_to_null, norm, rx, strip, title_case
from offerscope.sources.places import DEFAULT_PLACES, Places, admin_key, city_key, place_key
from offerscope.vocab.labels import UNKNOWN
from offerscope.vocab import places as V

_HELPERS = ("_text", "_dept0", "_parts", "_keys", "_admins", "_both", "_head_admin", "_admin_key",
            "admin_code", "admin_region", "_area", "_place", "_city_key", "_dept", "ref_city", "ref_dept",
            "ref_region", "ref_lat", "ref_lon", "dept_region")


def with_location(df: DataFrame, raw: str = "location_raw", latitude: str = "latitude",
                  longitude: str = "longitude", places: Places = DEFAULT_PLACES) -> DataFrame:
    """Adds ``city, department_code, region`` and replaces the coordinate columns.

    List functions over the comma-separated parts, then lookups by join: the fixed administrative names, and the city reference
    of whatever size. Whether a part is a city matters before that only where it is an administrative name too; such names
    are few and are looked up once.
    """
    spark = df.sparkSession
    source = F.col(raw)
    nowhere = source.isNull() | (source == "") | norm(source).isin(*V.NOT_A_PLACE)
    text = strip(source)
    prefix = rx(V.DEPARTMENT_PREFIX)
    df = df.select(
        "*",
        F.when(~nowhere, F.coalesce(blank_to_null(F.regexp_extract(text, prefix, 2)), text)).alias("_text"),
        F.when(~nowhere, blank_to_null(F.regexp_extract(text, prefix, 1))).alias("_dept0"),
    )

    # Parts of the place with their administrative key, and the parts that name an area and a city.
    df = df.withColumn("_parts", F.filter(F.transform(F.split("_text", ","), strip), lambda p: p != ""))
    df = df.withColumn("_keys", F.transform("_parts", place_key))
    df = df.withColumns({
        "_admins": F.transform("_keys", lambda k: F.when(admin_key(k).isin(places.admin_keys), admin_key(k))),
        "_both": F.array_intersect("_keys", places.cities_named_like_areas(spark)),
    })
    df = df.withColumn("_head_admin", F.get("_admins", F.lit(0)))

    # The first administrative name after the head (or the only part); else a region at the head.
    tail = F.when(F.size("_admins") > 1, F.slice("_admins", 2, F.size("_admins") - 1)).otherwise(F.col("_admins"))
    named = F.get(F.filter(tail, lambda k: k.isNotNull()), F.lit(0))
    head_region = F.when(F.col("_head_admin").isin(places.region_keys), F.col("_head_admin"))
    df = df.withColumn("_admin_key", F.coalesce(named, head_region))
    df = df.join(places.admin_table(spark), "_admin_key", "left")

    # A department prefix wins over the code of the name found.
    df = df.withColumn("_dept", F.coalesce("_dept0", "admin_code"))
    df = df.withColumn("_area", F.col("admin_region").isNotNull() & F.col("_head_admin").isNotNull()
                       & ~F.array_contains("_both", F.get("_keys", F.lit(0))))

    # "1er Arrondissement, Lyon": the city is the next part that is a city or no administrative name.
    numbered = F.arrays_zip(F.col("_parts").alias("part"), F.col("_admins").alias("admin"), F.col("_keys").alias("key"))
    later = F.filter(numbered, lambda z, i: (i > 0) & (z["admin"].isNull() | F.array_contains(F.col("_both"), z["key"])))
    head = F.coalesce(F.get("_parts", F.lit(0)), F.lit(""))
    is_district = F.when(~head.rlike("^[A-Za-z]"), norm(head).rlike(rx(V.DISTRICT_HEAD)))
    place = F.when(is_district, F.coalesce(F.get(later, F.lit(0))["part"], head)).otherwise(head)
    for pattern in V.PLACE_SUFFIXES:
        place = F.regexp_replace(place, rx("(?i)" + pattern), "")
    place = F.regexp_replace(strip(place), rx("(?i)" + V.DISTRICT_NUMBER), "")
    df = df.withColumn("_place", F.when(F.col("_text").isNotNull() & ~F.coalesce("_area", F.lit(False)), place))
    df = df.withColumn("_city_key", F.when(F.col("_place").isNotNull(), city_key(place_key(F.col("_place")))))
    df = df.join(places.city_table(spark), "_city_key", "left")
    df = df.join(places.department_table(spark), "_dept", "left")

    hit, unknown = F.col("ref_city").isNotNull(), F.lit(UNKNOWN)
    somewhere = F.col("_text").isNotNull()
    df = df.withColumns({
        "city": F.when(hit, F.col("ref_city"))
                 .otherwise(F.coalesce(blank_to_null(title_case(strip(F.col("_place")))), unknown)),
        "department_code": F.when(hit, F.col("ref_dept")).otherwise(F.col("_dept")),
        "region": F.when(hit, F.col("ref_region")).otherwise(F.coalesce("admin_region", "dept_region", unknown)),
        latitude: F.when(hit, F.col("ref_lat")).when(somewhere, F.col(latitude)),
        longitude: F.when(hit, F.col("ref_lon")).when(somewhere, F.col(longitude)),
    })
    return df.drop(*_HELPERS)

