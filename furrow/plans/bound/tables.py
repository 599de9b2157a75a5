"""The given tables in the roles of the four raw sources.

A supplier stands for an area, a part type for a crop and the ship year for the
year, so areas grow with the data. The source definitions are plain SQL over
the given tables that Spark and the SQL check both read; everything after them
is written twice, once per engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.text import AREA_ALIASES
from furrow.operators.evaluation import temporal_split
from furrow.operators.features import FeatureStats
from furrow.operators.quality import KNOWN_CROPS, inspect
from furrow.plans.curate import SOURCES, accepted_frames, curate
from furrow.session import scratch_path, settle
from furrow.sources.star import build_star, read_star, write_star

CUTOFF = 2000  # first test year
SPLIT = 1998  # first year of the later era

FORMAL = {
    0: "United States of America", 1: "India", 2: "Viet Nam", 3: "Russian Federation", 4: "Republic of Korea",
    5: "Lao People''s Democratic Republic", 6: "Iran (Islamic Republic of)", 7: "Czechia", 8: "Congo",
}
COMMON = {
    0: "United States", 1: "india", 2: "  Vietnam ", 3: "RUSSIA", 4: "South Korea",
    5: "Laos", 6: "Iran", 7: "Czech Republic", 8: "congo",
}
CROP_OF = {
    "ECONOMY": "Maize", "SMALL": "Wheat", "MEDIUM": "Rice, paddy",
    "LARGE": "Sorghum", "STANDARD": "Potatoes", "PROMO": "Barley",
}


def _case(on: str, names: dict, default: str) -> str:
    whens = " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in names.items())
    return f"CASE {on} {whens} ELSE {default} END"


FORMAL_NAME = _case("s_suppkey", FORMAL, "s_name")
COMMON_NAME = _case("s_suppkey", COMMON, "lower(s_name)")
CROP = _case("p_type", CROP_OF, "p_type")
QTY = "CAST(l_quantity AS BIGINT)"

LINES = "{lineitem} l JOIN {supplier} s ON l_suppkey = s_suppkey"
LINES_PARTS = LINES + " JOIN {part} p ON l_partkey = p_partkey"

# Headers of the sources, in the order of the SQL columns.
HEADERS = {
    "yield": ["Domain Code", "Domain", "Area Code", "Area", "Element Code", "Element", "Item Code", "Item", "Year Code", "Year", "Unit", "Value"],
    "pesticides": ["Domain", "Area", "Element", "Item", "Year", "Unit", "Value"],
    "rainfall": [" Area", "Year", "average_rain_fall_mm_per_year"],
    "temp": ["year", "country", "avg_temp"],
}

# One row per area and year (and crop): what the curated table is made from.
SOURCE_SQL = {
    "yield": f"""
        SELECT domain_code, domain, area_code, area, element_code, element, item_code, item, yr AS year_code, yr,
               CASE WHEN q % 41 = 0 THEN NULL WHEN q % 37 = 0 THEN 'kg/ha' ELSE 'hg/ha' END AS unit, q * 1500 AS val
        FROM (SELECT 'QC' AS domain_code, 'Crops' AS domain, s_suppkey AS area_code, {FORMAL_NAME} AS area,
                     5419 AS element_code, 'Yield' AS element, 15 AS item_code, {CROP} AS item,
                     year(l_shipdate) AS yr, CAST(sum({QTY}) AS BIGINT) AS q
              FROM {LINES_PARTS} GROUP BY s_suppkey, s_name, p_type, year(l_shipdate)) cells""",
    "pesticides": f"""
        SELECT domain, area, element, item, yr, unit,
               CASE WHEN q % 4 = 0 THEN NULL WHEN q % 23 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(q AS DOUBLE) / 4 - 1 END AS val
        FROM (SELECT 'Pesticides Use' AS domain, {FORMAL_NAME} AS area, 'Use' AS element, 'Pesticides (total)' AS item,
                     year(l_shipdate) AS yr, 'tonnes' AS unit, CAST(sum({QTY}) AS BIGINT) AS q
              FROM {LINES} GROUP BY s_suppkey, s_name, year(l_shipdate)) cells""",
    "rainfall": f"""
        SELECT area, yr, CASE WHEN q % 5 = 0 THEN '..' WHEN q % 29 = 0 THEN 'n/a' WHEN q % 31 = 0 THEN '15001' ELSE CAST(q AS VARCHAR(20)) END AS txt
        FROM (SELECT {COMMON_NAME} AS area, year(l_shipdate) AS yr, CAST(sum({QTY}) AS BIGINT) AS q
              FROM {LINES} GROUP BY s_suppkey, s_name, year(l_shipdate)) cells""",
    "temp": f"""
        SELECT year(l_shipdate) AS yr, {COMMON_NAME} AS country,
               CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN CAST(500 AS DOUBLE)
                    WHEN l_linenumber = 2 AND l_quantity < 5 THEN NULL
                    ELSE l_quantity - 18 END AS avg_temp
        FROM {LINES}""",
}

# One row per line item: what the gate is run over, with defects of every kind
# and many full-row copies.
LINE_SQL = {
    "yield": f"""
        SELECT 'QC' AS domain_code, 'Crops' AS domain, s_suppkey AS area_code, {FORMAL_NAME} AS area,
               5419 AS element_code, 'Yield' AS element, 15 AS item_code,
               CASE WHEN l_linenumber = 6 AND l_tax = 0 THEN NULL ELSE {CROP} END AS item, year(l_shipdate) AS year_code,
               CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN 1500 WHEN l_tax = 0.08 AND l_linenumber = 2 THEN NULL
                    ELSE year(l_shipdate) END AS yr,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN 'kg/ha'
                    ELSE 'hg/ha' END AS unit,
               CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 'unknown' ELSE CAST(({QTY} - 1) * 20000 AS VARCHAR(20)) END AS val
        FROM {LINES_PARTS}""",
    "pesticides": f"""
        SELECT 'Pesticides Use' AS domain, {FORMAL_NAME} AS area, 'Use' AS element, 'Pesticides (total)' AS item,
               CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN 2027 ELSE year(l_shipdate) END AS yr, 'tonnes' AS unit,
               CAST(round(l_discount * 100) AS BIGINT) - 1 AS val
        FROM {LINES}""",
    "rainfall": f"""
        SELECT {COMMON_NAME} AS area, CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN -5 ELSE year(l_shipdate) END AS yr,
               CASE WHEN l_linenumber = 3 THEN '..' WHEN l_linenumber = 5 AND l_returnflag = 'A' THEN 'n/a'
                    ELSE CAST(({QTY} * 400) - 1000 AS VARCHAR(20)) END AS txt
        FROM {LINES}""",
    "temp": f"""
        SELECT CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN 1599 ELSE year(l_shipdate) END AS yr, {COMMON_NAME} AS country,
               CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN CAST(500 AS DOUBLE)
                    WHEN l_linenumber = 2 AND l_quantity < 5 THEN NULL
                    WHEN l_linenumber = 1 AND l_quantity = 1 THEN CAST(-91 AS DOUBLE)
                    ELSE l_quantity - 18 END AS avg_temp
        FROM {LINES}""",
}

# A series with gaps in it: user, kind of event and day.
EVENT_SQL = """
        SELECT CAST(user_id AS VARCHAR(20)) AS area, event_type AS crop, dayofyear(ts) AS year,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS yield_hg_ha
        FROM {events} GROUP BY user_id, event_type, dayofyear(ts)"""

#: Sources that know a line by its supplier and year only.
BY_YEAR = ("pesticides", "rainfall")

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


#: Folders of the stars that have been loaded.
_STARS: dict[tuple[str, str], str] = {}


class Tables:
    """The given tables and the frames derived from them, built on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def sql(self, text: str, **instead: DataFrame) -> DataFrame:
        used = {name: instead[name] if name in instead else self.table(name) for name in TABLE_NAMES if "{" + name + "}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def lines_by_year(self) -> DataFrame:
        """The lines of each supplier and year as one: their quantities added up, the first
        of their dates. Written once; the sources that add up no finer read it instead of
        all lines."""
        year = F.year("l_shipdate").alias("_year")
        quantity = F.sum(F.col("l_quantity").cast("bigint")).alias("l_quantity")
        folded = self.table("lineitem").groupBy("l_suppkey", year).agg(quantity, F.min("l_shipdate").alias("l_shipdate"))
        return settle(folded.drop("_year"))

    def raw(self, source: str) -> DataFrame:
        lines = {"lineitem": self.lines_by_year} if source in BY_YEAR else {}
        return self.sql(SOURCE_SQL[source], **lines).toDF(*HEADERS[source])

    def raw_lines(self, source: str) -> DataFrame:
        return self.sql(LINE_SQL[source]).toDF(*HEADERS[source])

    @cached_property
    def frames(self) -> dict[str, DataFrame]:
        return {source: self.raw(source) for source in SOURCES}

    @cached_property
    def accepted(self) -> dict[str, DataFrame]:
        return accepted_frames(self.frames)

    @cached_property
    def curated(self) -> DataFrame:
        return curate(self.accepted)

    @cached_property
    def settled(self) -> DataFrame:
        """The curated table written once, for jobs that read it several times."""
        return settle(self.curated)

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        """The loaded star: written by the first question that this application asks of a
        folder, read by all."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _STARS:
            path = scratch_path(self.spark, "star")
            write_star(build_star(self.settled), path)
            _STARS[key] = path
        return read_star(self.spark, _STARS[key])

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return temporal_split(self.settled, CUTOFF)

    @cached_property
    def stats(self) -> FeatureStats:
        return FeatureStats.fit(self.split[0], era_start=SPLIT)

    @cached_property
    def features(self) -> tuple[DataFrame, DataFrame]:
        """Feature tables of the training and the test years, written once."""
        table = settle(self.stats.transform(self.settled, self.settled))
        return temporal_split(table, CUTOFF)

    @cached_property
    def events(self) -> DataFrame:
        return self.sql(EVENT_SQL)

    def gate(self, source: str):
        return inspect(self.raw_lines(source), source)


def plain(text: str) -> str:
    """Source SQL with the bare table names, for the SQL check."""
    return text.format(**{name: name for name in TABLE_NAMES})


# The same path written in SQL, from the library's fixed tables.
def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def key_sql(name: str) -> str:
    key = f"lower(trim({name}))"
    whens = " ".join(f"WHEN {_quoted(formal)} THEN {_quoted(common)}" for formal, common in AREA_ALIASES.items())
    return f"CASE {key} {whens} ELSE {key} END"


KNOWN_SQL = "(" + ", ".join(map(_quoted, KNOWN_CROPS)) + ")"

CURATED_CTES = f"""
raw_yield AS ({plain(SOURCE_SQL["yield"])}),
raw_pest AS ({plain(SOURCE_SQL["pesticides"])}),
raw_rain AS ({plain(SOURCE_SQL["rainfall"])}),
raw_temp AS ({plain(SOURCE_SQL["temp"])}),
ok_yield AS (SELECT DISTINCT * FROM raw_yield WHERE val > 0 AND val <= 800000 AND unit = 'hg/ha' AND item IN {KNOWN_SQL}),
ok_pest AS (SELECT DISTINCT * FROM raw_pest WHERE coalesce(NOT val < 0, true)),
ok_rain AS (SELECT DISTINCT * FROM raw_rain WHERE coalesce(TRY_CAST(txt AS DOUBLE) BETWEEN 0 AND 15000, true)),
ok_temp AS (SELECT DISTINCT * FROM raw_temp WHERE coalesce(avg_temp BETWEEN -90 AND 60, true)),
mean_temp AS (SELECT {key_sql("country")} AS k, yr, avg(avg_temp) AS avg_temp_c FROM ok_temp GROUP BY 1, 2),
curated AS (
    SELECT y.area, y.item AS crop, y.yr AS year, y.val AS yield_hg_ha, p.val AS pesticides_tonnes,
           TRY_CAST(r.txt AS DOUBLE) AS rainfall_mm, t.avg_temp_c
    FROM ok_yield y
    LEFT JOIN ok_pest p ON {key_sql("y.area")} = {key_sql("p.area")} AND y.yr = p.yr
    LEFT JOIN ok_rain r ON {key_sql("y.area")} = {key_sql("r.area")} AND y.yr = r.yr
    LEFT JOIN mean_temp t ON {key_sql("y.area")} = t.k AND y.yr = t.yr
)"""

REGION_CTES = """
dim_region AS (SELECT row_number() OVER (ORDER BY area) AS region_id, area AS region_name FROM (SELECT DISTINCT area FROM curated) a),
dim_crop AS (SELECT row_number() OVER (ORDER BY crop) AS crop_id, crop AS crop_name FROM (SELECT DISTINCT crop FROM curated) c)"""

TRAIN_CTES = f"""
train AS (SELECT * FROM curated WHERE year < {CUTOFF}),
test AS (SELECT * FROM curated WHERE year >= {CUTOFF}),
base AS (
    SELECT c.*, coalesce(pm, cm, (SELECT avg(yield_hg_ha) FROM train)) AS prediction FROM curated c
    LEFT JOIN (SELECT area, crop, avg(yield_hg_ha) AS pm FROM train GROUP BY 1, 2) a ON c.area = a.area AND c.crop = a.crop
    LEFT JOIN (SELECT crop, avg(yield_hg_ha) AS cm FROM train GROUP BY 1) b ON c.crop = b.crop
),
threshold AS (SELECT crop, quantile_cont(yield_hg_ha, 0.25) AS threshold FROM train GROUP BY crop),
risk AS (SELECT c.*, CAST(coalesce(yield_hg_ha < threshold, false) AS BIGINT) AS label FROM curated c LEFT JOIN threshold t ON c.crop = t.crop),
med AS (SELECT quantile_cont(rainfall_mm, 0.5) AS r, quantile_cont(avg_temp_c, 0.5) AS t, quantile_cont(pesticides_tonnes, 0.5) AS p FROM train),
feat AS (
    SELECT area, crop, yield_hg_ha, year, CAST(year >= {SPLIT} AS BIGINT) AS is_post_1990,
           CAST(rainfall_mm IS NULL AS BIGINT) AS rainfall_mm_missing, coalesce(rainfall_mm, (SELECT r FROM med)) AS rainfall_mm,
           CAST(avg_temp_c IS NULL AS BIGINT) AS avg_temp_c_missing, coalesce(avg_temp_c, (SELECT t FROM med)) AS avg_temp_c,
           CAST(pesticides_tonnes IS NULL AS BIGINT) AS pesticides_tonnes_missing, coalesce(pesticides_tonnes, (SELECT p FROM med)) AS pesticides_tonnes,
           region AS region_mean_yield, CAST(lag1 IS NULL AS BIGINT) AS lag1_yield_missing, coalesce(lag1, region) AS lag1_yield,
           coalesce(coalesce(lag1, region) / nullif(region, 0), 1.0) AS yield_trend_ratio
    FROM (SELECT c.*, coalesce(m, (SELECT avg(yield_hg_ha) FROM train)) AS region, CAST(l.y AS DOUBLE) AS lag1 FROM curated c
          LEFT JOIN (SELECT area AS a, avg(yield_hg_ha) AS m FROM train GROUP BY 1) g ON c.area = g.a
          LEFT JOIN (SELECT area AS la, crop AS lc, year + 1 AS ly, yield_hg_ha AS y FROM curated) l ON c.area = la AND c.crop = lc AND c.year = ly) x
)"""


def on_curated(select: str, ctes: str = "") -> str:
    """A SQL statement over ``curated`` and any further ``ctes``."""
    return f"WITH {CURATED_CTES}{', ' + ctes if ctes else ''} {select}"
