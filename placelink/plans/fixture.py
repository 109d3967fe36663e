"""Observations derived from the table ``part``: powers of two in all divisors, so every place is exact in any engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelink.functions import text
from placelink.operators.canonical import unified

_PROVENANCE = "[{{'property': '', 'dataset': {0}, 'record_id': {1}}}]"


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One relation for each source."""
    k = F.col("p_partkey")
    at = lambda base, step, divisor: F.lit(base) + ((k * step) % 1024) / F.lit(float(divisor))
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        k.alias("k"), F.concat_ws(" ", "p_name", "p_brand").alias("nm"), F.lower("p_type").alias("cat"), at(120.0, 37, 1024).alias("lon0"), at(14.0, 101, 1024).alias("lat0"))
    shift = lambda m, r: ((F.col("k") * m) % r) / F.lit(1048576.0)
    quoted = lambda name, record: F.concat(F.lit("[{'property': '', 'dataset': " + name + ", 'record_id': "), record, F.lit("}]"))
    n = F.col("k").cast("string")
    prov = F.when(F.col("k") % 4 == 0, quoted("Foursquare", F.concat(F.lit("r"), n))).when(F.col("k") % 4 == 1, quoted("meta", F.concat(F.lit("dac"), n)))
    prov = prov.when(F.col("k") % 4 == 2, quoted("AllThePlaces", F.lit("x"))).otherwise(quoted("NewProvider", F.lit("00dac")))
    none = F.lit(None).cast("string")
    last = F.element_at(F.split("nm", " "), -1)
    make = lambda df, s, prefix, name, cat, lon, lat, p: df.select(F.lit(s).alias("source"), F.concat(F.lit(prefix), n).alias("source_id"), name.alias("name"), cat.alias("category"), lon.alias("lon"), lat.alias("lat"), p.alias("provenance"))
    c = F.col
    return {
        "fsq": make(part, "fsq", "f", c("nm"), c("cat"), c("lon0"), c("lat0"), none),
        "overture": make(part.where("k % 3 <> 0"), "overture", "o", F.when(c("k") % 5 == 0, F.concat_ws(" ", last, "nm")).otherwise(c("nm")), c("cat"), c("lon0") + shift(13, 900), c("lat0") + shift(7, 500), prov),
        "osm": make(part.where("k % 2 = 0"), "osm", "node/", c("nm"), F.when(c("k") % 7 == 0, F.lit("")).otherwise(c("cat")), c("lon0") - shift(11, 700), c("lat0") + shift(3, 600), none),
    }


def observations(spark: SparkSession, sf_dir: str, sources: tuple[str, ...] = ("fsq", "overture", "osm")) -> DataFrame:
    """All sources with normalized names and each source's licence as given."""
    parts = raw(spark, sf_dir)
    given = F.when(F.col("source") == "fsq", "Apache-2.0").when(F.col("source") == "osm", "ODbL-1.0")
    out = unified([parts[s] for s in sources]).withColumn("upstream_license", given)
    return out.withColumn("name_norm", text.normalized(F.col("name"))).withColumn("name_tokens", text.sorted_tokens(F.col("name_norm")))


#: The same relation for DuckDB, with what each oracle needs on top as views of one WITH clause.
SQL = """
b AS (SELECT p_partkey AS k, p_name || ' ' || p_brand AS nm, lower(p_type) AS cat, 120.0::DOUBLE + ((p_partkey * 37) % 1024) / 1024.0::DOUBLE AS lon0,
             14.0::DOUBLE + ((p_partkey * 101) % 1024) / 1024.0::DOUBLE AS lat0 FROM part),
raw AS (SELECT 'fsq' AS source, 'f' || k AS source_id, nm AS name, cat AS category, lon0 AS lon, lat0 AS lat, NULL::VARCHAR AS provenance, 'Apache-2.0' AS upstream_license FROM b
  UNION ALL SELECT 'overture', 'o' || k, CASE WHEN k % 5 = 0 THEN string_split(nm, ' ')[-1] || ' ' || nm ELSE nm END, cat, lon0 + ((k * 13) % 900) / 1048576.0::DOUBLE, lat0 + ((k * 7) % 500) / 1048576.0::DOUBLE,
    CASE k % 4 WHEN 0 THEN '[{''property'': '''', ''dataset'': Foursquare, ''record_id'': r' || k || '}]' WHEN 1 THEN '[{''property'': '''', ''dataset'': meta, ''record_id'': dac' || k || '}]'
      WHEN 2 THEN '[{''property'': '''', ''dataset'': AllThePlaces, ''record_id'': x}]' ELSE '[{''property'': '''', ''dataset'': NewProvider, ''record_id'': 00dac}]' END, NULL FROM b WHERE k % 3 <> 0
  UNION ALL SELECT 'osm', 'node/' || k, nm, CASE WHEN k % 7 = 0 THEN '' ELSE cat END, lon0 - ((k * 11) % 700) / 1048576.0::DOUBLE, lat0 + ((k * 3) % 600) / 1048576.0::DOUBLE, NULL, 'ODbL-1.0' FROM b WHERE k % 2 = 0),
nn AS (SELECT *, trim(regexp_replace(lower(strip_accents(replace(name, '&', ' and '))), '[^a-z0-9]+', ' ', 'g')) AS name_norm FROM raw),
obs AS (SELECT *, array_to_string(list_sort(string_split(name_norm, ' ')), ' ') AS name_tokens, CASE source WHEN 'fsq' THEN 1 WHEN 'overture' THEN 2 ELSE 4 END AS code,
               CASE source WHEN 'fsq' THEN 0 WHEN 'overture' THEN 1 ELSE 2 END AS prio FROM nn)
"""
