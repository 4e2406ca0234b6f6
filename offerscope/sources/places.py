"""City reference and administrative lookups.

The administrative names are a fixed list. The city reference is a table of any size: it is joined by its key, and the planner
broadcasts it where its measured size allows. Nothing of it is held as literals or collected.
"""

from __future__ import annotations

import csv
import io
import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from offerscope import schemas
from offerscope.functions.text import norm
from offerscope.vocab import places as V


def place_key(name: Column) -> Column:
    """Normalised name with blanks for hyphens and apostrophes; both kinds of keys derive from it."""
    return F.translate(norm(name), "-'", "  ")


def admin_key(key: Column) -> Column:
    """Key of a department or region name, from a place key."""
    return F.trim(key)


def city_key(key: Column) -> Column:
    """Key of a city name, from a place key."""
    return F.replace(key, F.lit("saint "), F.lit("st "))


def _plain(name: str) -> str:
    folded = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", folded.lower()).strip().translate(str.maketrans("-'", "  "))


@dataclass(frozen=True)
class Places:
    """One city reference: rows of the configuration, or a table of any size in place of them.

    A table has the columns of ``schemas.CITIES`` and, in ``nth``, the order of its rows: of several rows for one name the last
    counts, and a department takes its region from its first row.
    """

    cities: tuple[tuple[str, str, str, str, float, float], ...]
    table: DataFrame | None = None

    @staticmethod
    def from_csv(text: str) -> Places:
        rows = []
        for city, dept, region, lat, lon in csv.reader(io.StringIO(text)):
            rows.append((_plain(city).replace("saint ", "st "), city, dept, region, float(lat), float(lon)))
        return Places(tuple({r[0]: r for r in rows}.values()))

    def city_table(self, spark: SparkSession) -> DataFrame:
        """One row per city key."""
        if self.table is None:
            return spark.createDataFrame(list(self.cities), CITY_COLUMNS)
        last = F.max_by(F.struct("city", "dept_code", "region", "latitude", "longitude"), "nth").alias("row")
        keyed = self.table.groupBy(city_key(place_key(F.col("city"))).alias("_city_key")).agg(last)
        return keyed.select("_city_key", F.col("row.city").alias("ref_city"), F.col("row.dept_code").alias("ref_dept"),
                            F.col("row.region").alias("ref_region"), F.col("row.latitude").alias("ref_lat"),
                            F.col("row.longitude").alias("ref_lon"))

    def cities_named_like_areas(self, spark: SparkSession) -> Column:
        """Those administrative names that a city bears too, as one array: never more than there are such names."""
        names = spark.createDataFrame([(key, key.replace("saint ", "st ")) for key in self.admin_keys], "name string, _city_key string")
        return names.join(self.city_table(spark), "_city_key", "left_semi").agg(F.collect_set("name")).scalar()

    def admin_rows(self) -> list[tuple[str, str | None, str]]:
        """Departments first, so a department name hides a region of the same name."""
        by_code = {d: region for region, depts in V.REGION_DEPARTMENTS.items() for d in depts.split()}
        rows = {_plain(region).strip(): (None, region) for region in V.REGION_DEPARTMENTS}
        rows.update({name: (code, by_code.get(code)) for name, code in V.DEPARTMENT_CODES.items()})
        return [(key, code, region) for key, (code, region) in rows.items() if region]

    @property
    def region_keys(self) -> list[str]:
        return [key for key, code, _ in self.admin_rows() if code is None]

    @property
    def admin_keys(self) -> list[str]:
        return [key for key, _, _ in self.admin_rows()]

    def admin_table(self, spark: SparkSession) -> DataFrame:
        rows = self.admin_rows()  # a fixed list of names
        return F.broadcast(spark.createDataFrame(rows, "_admin_key string, admin_code string, admin_region string"))

    def department_table(self, spark: SparkSession) -> DataFrame:
        """Department code -> region; the city reference fills codes the constants do not know."""
        known = {d: region for region, depts in V.REGION_DEPARTMENTS.items() for d in depts.split()}
        fixed = spark.createDataFrame(list(known.items()), "_dept string, dept_region string")
        if self.table is None:
            more = {}
            for _, _, dept, region, _, _ in self.cities:
                more.setdefault(dept, region)
            return spark.createDataFrame(list({**more, **known}.items()), fixed.schema)
        found = self.table.groupBy(F.col("dept_code").alias("_dept")).agg(F.min_by("region", "nth").alias("dept_region"))
        return found.join(F.broadcast(fixed), "_dept", "left_anti").union(fixed)


CITY_COLUMNS = "_city_key string, ref_city string, ref_dept string, ref_region string, ref_lat double, ref_lon double"
DEFAULT_PLACES = Places.from_csv(V.CITY_CSV)


def read_cities(spark: SparkSession, path: str) -> Places:
    """City reference from CSV (header: city, dept_code, region, latitude, longitude); codes stay text."""
    rows = spark.read.schema(schemas.CITIES).option("header", True).csv(path)
    return Places((), rows.withColumn("nth", F.monotonically_increasing_id()))
