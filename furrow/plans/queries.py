"""The eight analytical questions over the star schema, in SQL.

Tables are passed to ``spark.sql`` as DataFrames, so no view is registered and
two schemas can be queried in one session.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

Star = Mapping[str, DataFrame]


def _sql(star: Star, text: str, **values: object) -> DataFrame:
    spark = star["yield_observation"].sparkSession
    tables = {
        "facts": star["yield_observation"], "region": star["region"], "crop": star["crop"],
        "weather": star["weather_observation"], "practice": star["agricultural_practice_observation"],
    }
    used = {name: table for name, table in tables.items() if "{" + name + "}" in text}
    return spark.sql(text, args=values, **used)


def top_observations(star: Star, crop: str = "Maize", n: int = 10) -> DataFrame:
    """The highest single yields of a crop."""
    return _sql(star, """
        SELECT region_name, year, yield_hg_ha
        FROM {facts} JOIN {region} USING (region_id) JOIN {crop} USING (crop_id)
        WHERE crop_name = :crop
        ORDER BY yield_hg_ha DESC, region_name, year
        LIMIT :n""", crop=crop, n=n)


def mean_by_crop(star: Star) -> DataFrame:
    """Mean yield and number of observations of every crop."""
    return _sql(star, """
        SELECT crop_name, round(avg(yield_hg_ha), 1) AS avg_yield_hg_ha, count(*) AS n_observations
        FROM {facts} JOIN {crop} USING (crop_id)
        GROUP BY crop_name
        ORDER BY avg_yield_hg_ha DESC, crop_name""")


def regions_with_history(star: Star, crop: str = "Maize", min_years: int = 40) -> DataFrame:
    """Regions with enough years of a crop to look at on their own."""
    return _sql(star, """
        SELECT region_name, count(*) AS n_years
        FROM {facts} JOIN {region} USING (region_id) JOIN {crop} USING (crop_id)
        WHERE crop_name = :crop
        GROUP BY region_name
        HAVING count(*) >= :min_years
        ORDER BY n_years DESC, region_name""", crop=crop, min_years=min_years)


def regions_above_average(star: Star, crop: str = "Maize") -> DataFrame:
    """Regions whose mean yield of a crop exceeds the mean over all its observations."""
    return _sql(star, """
        WITH observed AS (
            SELECT region_id, yield_hg_ha FROM {facts} JOIN {crop} USING (crop_id) WHERE crop_name = :crop
        )
        SELECT region_name, round(avg(yield_hg_ha), 1) AS avg_yield_hg_ha
        FROM observed JOIN {region} USING (region_id)
        GROUP BY region_name
        HAVING avg(yield_hg_ha) > (SELECT avg(yield_hg_ha) FROM observed)
        ORDER BY avg_yield_hg_ha DESC, region_name""", crop=crop)


def yield_tiers(star: Star, crop: str = "Maize", n: int | None = 20) -> DataFrame:
    """Every observation of a crop as low, medium or high against the crop's spread."""
    tiers = _sql(star, """
        WITH observed AS (
            SELECT region_id, year, yield_hg_ha FROM {facts} JOIN {crop} USING (crop_id) WHERE crop_name = :crop
        ), spread AS (
            SELECT struct(avg(yield_hg_ha) AS mean, stddev_pop(yield_hg_ha) AS sd) AS s FROM observed
        ), placed AS (
            SELECT region_id, year, yield_hg_ha, (SELECT s FROM spread) AS s FROM observed
        )
        SELECT region_name, year, yield_hg_ha,
               CASE WHEN yield_hg_ha < s.mean - s.sd THEN 'low'
                    WHEN yield_hg_ha > s.mean + s.sd THEN 'high'
                    ELSE 'medium' END AS yield_tier
        FROM placed JOIN {region} USING (region_id)""", crop=crop)
    return tiers if n is None else tiers.orderBy("region_name", "year").limit(n)


def best_years(star: Star, crop: str = "Maize", n: int | None = 15) -> DataFrame:
    """Each region's best year for a crop; years that tie are all kept."""
    best = _sql(star, """
        WITH ranked AS (
            SELECT region_id, year, yield_hg_ha,
                   rank() OVER (PARTITION BY region_id ORDER BY yield_hg_ha DESC) AS place
            FROM {facts} JOIN {crop} USING (crop_id)
            WHERE crop_name = :crop
        )
        SELECT region_name, year, yield_hg_ha
        FROM ranked JOIN {region} USING (region_id)
        WHERE place = 1""", crop=crop)
    return best if n is None else best.orderBy(best.yield_hg_ha.desc(), "region_name", "year").limit(n)


def year_over_year(star: Star, region: str | None = "United States of America", crop: str | None = "Maize") -> DataFrame:
    """Change against the previous recorded year, for one series or for all.

    A series is one region and crop, so a window holds one row per year at most.
    """
    return _sql(star, """
        SELECT region_name, crop_name, year, yield_hg_ha,
               lag(yield_hg_ha) OVER series AS prev_year_yield,
               yield_hg_ha - lag(yield_hg_ha) OVER series AS yoy_change_hg_ha
        FROM {facts} JOIN {region} USING (region_id) JOIN {crop} USING (crop_id)
        WHERE region_name = coalesce(:region, region_name) AND crop_name = coalesce(:crop, crop_name)
        WINDOW series AS (PARTITION BY region_id, crop_id ORDER BY year)
        ORDER BY region_name, crop_name, year""", region=region, crop=crop)


def yield_in_context(star: Star, region: str | None = "India", crop: str = "Maize", n: int | None = 20) -> DataFrame:
    """Yields of a crop beside the weather and practice of their region and year."""
    rows = _sql(star, """
        SELECT region_name, year, yield_hg_ha, rainfall_mm, avg_temp_c, pesticides_tonnes
        FROM {facts} JOIN {region} USING (region_id) JOIN {crop} USING (crop_id)
        LEFT JOIN {weather} USING (region_id, year)
        LEFT JOIN {practice} USING (region_id, year)
        WHERE crop_name = :crop AND region_name = coalesce(:region, region_name)""", region=region, crop=crop)
    return rows if n is None else rows.orderBy("region_name", "year").limit(n)
