"""All registered queries of the engine and their SQL, one entry for each operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placelink.functions import geo, licence, text
from placelink.operators import canonical, cluster, match, validate
from placelink.plans import fixture
from placelink.plans.scope import SOURCES, Scope, Tile, source_pairs, tile_columns
from placelink.plans.storage import settled, shared_dir
from placelink.sources import geoparquet, places
from placelink.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
Q: dict[str, Query] = {}
SQL: dict[str, str] = {}
SCOPE = Scope("test", ((120.0, 14.0, 121.0, 15.0),))
RADII = (5, 30, 60, 120, 200)
DIGITS = 6
c = F.col


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        Q[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# --- SQL pieces ------------------------------------------------------------------------------------------------------

_HAV = f"2 * {geo.EARTH_RADIUS_M} * asin(sqrt(pow(sin(radians({{b}}lat - {{a}}lat) / 2), 2) + cos(radians({{a}}lat)) * cos(radians({{b}}lat)) * pow(sin(radians({{b}}lon - {{a}}lon) / 2), 2)))"
_GENERIC = "(" + " OR ".join(f"{{n}} IN ({', '.join(repr(g) for g in match.GENERIC_NAMES)}) OR length({{n}}) <= {match.GENERIC_MAX_LENGTH}".split("|")) + ")"
_DATASETS = "CASE WHEN {p} IS NULL THEN '' WHEN len(regexp_extract_all({p}, '''dataset'':\\s*(''(?:[^''\\\\]|\\\\.)*''|[^,}}]*)', 1)) > 0 THEN '|' || lower(replace(array_to_string(regexp_extract_all({p}, '''dataset'':\\s*(''(?:[^''\\\\]|\\\\.)*''|[^,}}]*)', 1), '|'), '''', '')) || '|' ELSE lower({p}) END"


def _declares(p: str) -> str:
    return f"regexp_matches({_DATASETS.format(p=p)}, 'foursquare|\\bfsq\\b')"


def _licence(p: str) -> str:
    d = _DATASETS.format(p=p)
    hits = [f"regexp_matches({d}, '{pattern}')" for _, pattern in licence.FAMILIES]
    several = " + ".join(f"({h})::INT" for h in hits)
    return f"CASE WHEN {several} > 1 THEN '{licence.MIXED}' " + " ".join(f"WHEN {h} THEN '{name}'" for (name, _), h in zip(licence.FAMILIES, hits, strict=True)) + f" ELSE '{licence.UNKNOWN}' END"


def _accept(radius: float, d: str = "distance_m", s: str = "name_score", left: str = "ln", right: str = "rn") -> str:
    generic = f"({_GENERIC.format(n=left)} OR {_GENERIC.format(n=right)})"
    ladder = "CASE " + " ".join(f"WHEN {d} <= {limit} THEN {s} >= {least}" for limit, least in match.bands(radius)) + " ELSE false END"
    return f"({left} <> '' AND {right} <> '' AND CASE WHEN {generic} THEN {d} <= {min(match.GENERIC_MAX_M, radius)} AND {s} >= {match.GENERIC_MIN_SCORE} ELSE {ladder} END)"


def _edges_sql(radius: float = 120.0, sources: tuple[str, ...] = SOURCES, obs: str = "obs") -> str:
    """All pairs by brute force over a coarse box; nothing of the grid."""
    names = ", ".join(f"'{s}'" for s in sources)
    return f"""
near AS (SELECT a.source AS ls, a.source_id AS li, b.source AS rs, b.source_id AS ri, a.name_norm AS ln, b.name_norm AS rn, a.name_tokens AS lt, b.name_tokens AS rt, a.category AS lc, b.category AS rc, b.provenance AS rp,
                {_HAV.format(a='a.', b='b.')} AS distance_m
         FROM {obs} a JOIN {obs} b ON a.code < b.code AND a.source IN ({names}) AND b.source IN ({names}) AND abs(a.lat - b.lat) <= {radius * 2 / 110574} AND abs(a.lon - b.lon) <= {radius * 2 / 100000}),
within AS (SELECT *, greatest(jaro_winkler_similarity(ln, rn), jaro_winkler_similarity(lt, rt)) AS jw FROM near WHERE distance_m <= {radius}),
scored AS (SELECT *, CASE WHEN jw < {match.CUTOFF} THEN 0.0 ELSE jw END AS name_score FROM within),
kept AS (SELECT *, CASE WHEN lc IS NULL OR rc IS NULL OR trim(lc) = '' OR trim(rc) = '' THEN 0.0 ELSE jaro_winkler_similarity(lower(lc), lower(rc)) END AS category_score FROM scored WHERE {_accept(radius)}),
edges AS (SELECT ls AS left_source, li AS left_source_id, rs AS right_source, ri AS right_source_id, distance_m, name_score::FLOAT AS name_score, category_score::FLOAT AS category_score,
                 (0.80::DOUBLE * name_score + 0.18::DOUBLE * (1 - least(distance_m, {radius}) / {radius}::DOUBLE) + 0.02::DOUBLE * category_score)::FLOAT AS score,
                 CASE WHEN ls = 'fsq' AND rs = 'overture' THEN NOT {_declares('rp')} ELSE true END AS independent FROM kept)"""


_EDGE_COLUMNS = f"left_source, left_source_id, right_source, right_source_id, round(distance_m, {DIGITS}) AS distance_m, round(name_score::DOUBLE, 5) AS name_score, round(category_score::DOUBLE, 5) AS category_score, round(score::DOUBLE, 5) AS score, independent"


def _rounded(e: DataFrame) -> DataFrame:
    far = [F.round(c(x).cast("double"), 5).alias(x) for x in ("name_score", "category_score", "score")]
    return e.select("left_source", "left_source_id", "right_source", "right_source_id", F.round("distance_m", DIGITS).alias("distance_m"), *far, "independent")


_ROUNDS = 8


def _cluster_sql() -> str:
    """The rounds unrolled; more than the data need."""
    out = [_edges_sql(), """
rk AS (SELECT l.source_id AS l, r.source_id AS r, row_number() OVER (ORDER BY score DESC, name_score DESC, distance_m, left_source, left_source_id, right_source, right_source_id) AS rk
       FROM edges e JOIN obs l ON l.source_id = left_source_id JOIN obs r ON r.source_id = right_source_id)""", """
cl0 AS MATERIALIZED (SELECT source_id AS id, source_id AS c, code AS m FROM obs)"""]
    for i in range(_ROUNDS):
        out.append(f"""
act{i} AS MATERIALIZED (SELECT rk, a.c AS ca, b.c AS cb, a.m AS ma, b.m AS mb FROM rk JOIN cl{i} a ON l = a.id JOIN cl{i} b ON r = b.id WHERE a.c <> b.c AND (a.m & b.m) = 0),
best{i} AS MATERIALIZED (SELECT c, min(rk) AS rk FROM (SELECT ca AS c, rk FROM act{i} UNION ALL SELECT cb, rk FROM act{i}) GROUP BY c),
mg{i} AS MATERIALIZED (SELECT least(ca, cb) AS lo, greatest(ca, cb) AS hi, ma | mb AS m FROM act{i} t JOIN best{i} x ON ca = x.c AND t.rk = x.rk JOIN best{i} y ON cb = y.c AND t.rk = y.rk),
cl{i + 1} AS MATERIALIZED (SELECT id, coalesce(h.lo, cl{i}.c) AS c, coalesce(h.m, w.m, cl{i}.m) AS m FROM cl{i} LEFT JOIN mg{i} h ON cl{i}.c = h.hi LEFT JOIN mg{i} w ON cl{i}.c = w.lo)""")
    out.append(f"""
fin AS MATERIALIZED (SELECT id, min(id) OVER (PARTITION BY c) AS root FROM cl{_ROUNDS}),
me AS (SELECT e.*, x.root = y.root AS same_cluster_final, x.root AS root FROM edges e JOIN fin x ON left_source_id = x.id JOIN fin y ON right_source_id = y.id)""")
    return ",".join(out)


def _canonical_sql() -> str:
    lic = f"CASE WHEN source = 'overture' THEN {_licence('provenance')} ELSE upstream_license END"
    pick = lambda s, v: f"max({v}) FILTER (WHERE source = '{s}') AS {s}_{ {'source_id': 'id', 'lic': 'license'}.get(v, v)}"
    pivot = ", ".join([pick(s, "source_id") for s in SOURCES] + [pick(s, v) for s in SOURCES for v in ("name", "category", "lic")] + [pick("overture", "provenance")])
    declares = _declares("overture_provenance")
    return _cluster_sql() + f""",
mem AS (SELECT obs.*, {lic} AS lic, root FROM obs JOIN fin ON source_id = id),
grp AS (SELECT root, median(lon) AS lon, median(lat) AS lat, count(DISTINCT code) AS source_count, arg_min(name, prio) AS canonical_name, arg_min(category, prio) AS canonical_category, {pivot} FROM mem GROUP BY root),
ms AS (SELECT root, min(score) AS match_score_min, count(*) AS links FROM me WHERE same_cluster_final GROUP BY root),
dia AS (SELECT a.root, max({_HAV.format(a='a.', b='b.')}) AS dia FROM mem a JOIN mem b ON a.root = b.root AND a.source_id < b.source_id GROUP BY a.root),
can AS (SELECT coalesce('fsq:' || fsq_id, 'overture:' || overture_id, 'osm:' || osm_id) AS canonical_id, canonical_name, canonical_category, lon, lat, source_count,
               source_count - CASE WHEN fsq_id IS NOT NULL AND overture_id IS NOT NULL AND {declares} THEN 1 ELSE 0 END AS known_independent_source_count,
               CASE source_count WHEN 1 THEN 'single' WHEN 2 THEN 'double' WHEN 3 THEN 'triple' ELSE source_count::VARCHAR END AS evidence_tier,
               match_score_min, dia AS cluster_max_pair_distance_m, source_count > 2 AND coalesce(links, 0) < source_count * (source_count - 1) / 2 AS completed_transitively,
               overture_id IS NOT NULL AND {declares} AS overture_has_foursquare_provenance,
               fsq_id, fsq_name, fsq_category, fsq_license, overture_id, overture_name, overture_category, overture_provenance, overture_license, osm_id, osm_name, osm_category, osm_license
        FROM grp LEFT JOIN ms USING (root) LEFT JOIN dia USING (root))"""


def _with(*views: str, select: str) -> str:
    return "WITH " + ",".join([fixture.SQL, *views]) + "\n" + select


# --- text and licences -----------------------------------------------------------------------------------------------

_TEXTS = "SELECT doc_id, text AS name FROM documents"
_NORM = "trim(regexp_replace(lower(strip_accents(replace(name, '&', ' and '))), '[^a-z0-9]+', ' ', 'g'))"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", c("text").alias("name"))


@query("norm_names", f"SELECT doc_id, {_NORM} AS name_norm FROM ({_TEXTS})")
def norm_names(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts as names."""
    return _texts(spark, d).select("doc_id", text.normalized(c("name")).alias("name_norm"))


@query("name_tokens", f"SELECT doc_id, array_to_string(list_sort(string_split({_NORM}, ' ')), ' ') AS name_tokens FROM ({_TEXTS})")
def name_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("doc_id", text.sorted_tokens(text.normalized(c("name"))).alias("name_tokens"))


@query("datasets_extract", _with(select=f"SELECT source_id, {_DATASETS.format(p='provenance')} AS datasets FROM obs"))
def datasets_extract(spark: SparkSession, d: str) -> DataFrame:
    return fixture.observations(spark, d).select("source_id", licence.datasets(c("provenance")).alias("datasets"))


@query("licence_case", _with(select=f"SELECT source_id, CASE WHEN source = 'overture' THEN {_licence('provenance')} ELSE upstream_license END AS licence FROM obs"))
def licence_case(spark: SparkSession, d: str) -> DataFrame:
    return fixture.observations(spark, d).select("source_id", licence.source_licence(c("source"), c("provenance"), c("upstream_license")).alias("licence"))


@query("fsq_provenance", _with(select=f"SELECT source_id, {_declares('provenance')} AS declares_fsq FROM obs"))
def fsq_provenance(spark: SparkSession, d: str) -> DataFrame:
    return fixture.observations(spark, d).select("source_id", licence.declares_fsq(c("provenance")).alias("declares_fsq"))


# --- observations and tiles ------------------------------------------------------------------------------------------


@query("obs_union", _with(select="SELECT source, source_id, name, category, lon, lat, provenance, name_norm, name_tokens FROM obs"))
def obs_union(spark: SparkSession, d: str) -> DataFrame:
    return fixture.observations(spark, d).drop("upstream_license")


_IN = "lon >= 120.0 AND lon < 121.0 AND lat >= 14.0 AND lat < 15.0"


@query("obs_valid_filter", _with(select=f"SELECT source, source_id FROM (SELECT source, source_id, CASE WHEN code = 4 AND lon < 120.1 THEN '  ' ELSE name END AS name, lon, lat FROM obs) WHERE name IS NOT NULL AND trim(name) <> '' AND {_IN}"))
def obs_valid_filter(spark: SparkSession, d: str) -> DataFrame:
    df = fixture.observations(spark, d).withColumn("name", F.when((c("source") == "osm") & (c("lon") < 120.1), "  ").otherwise(c("name")))
    return canonical.valid(df, SCOPE).select("source", "source_id")


@query("obs_scope_bbox", _with(select=f"SELECT source, count(*) AS n, count(*) FILTER (WHERE NOT ({_IN})) AS outside FROM obs GROUP BY source"))
def obs_scope_bbox(spark: SparkSession, d: str) -> DataFrame:
    return fixture.observations(spark, d).groupBy("source").agg(F.count("*").alias("n"), F.count_if(~SCOPE.contains(c("lon"), c("lat"))).alias("outside"))


@query("obs_tiles", _with(select="SELECT source, floor(lon / 0.25)::INTEGER AS tile_x, floor(lat / 0.25)::INTEGER AS tile_y, count(*) AS n FROM obs GROUP BY ALL"))
def obs_tiles(spark: SparkSession, d: str) -> DataFrame:
    x, y = tile_columns(c("lon"), c("lat"), 0.25)
    return fixture.observations(spark, d).groupBy("source", x.alias("tile_x"), y.alias("tile_y")).agg(F.count("*").alias("n"))


@query("tile_mask_distinct", _with(select="SELECT DISTINCT floor(lon / 0.25)::INTEGER AS tile_x, floor(lat / 0.25)::INTEGER AS tile_y FROM obs"))
def tile_mask_distinct(spark: SparkSession, d: str) -> DataFrame:
    x, y = tile_columns(c("lon"), c("lat"), 0.25)
    return fixture.observations(spark, d).select(x.alias("tile_x"), y.alias("tile_y")).distinct()


_CFG = match.MatchConfig()
_CELL = repr(_CFG.cell)


@query("grid_cells", _with(select=f"SELECT source_id, floor(lon / {_CELL}::DOUBLE)::BIGINT AS gx, floor(lat / {_CELL}::DOUBLE)::BIGINT AS gy FROM obs"))
def grid_cells(spark: SparkSession, d: str) -> DataFrame:
    return fixture.observations(spark, d).select("source_id", geo.cell(c("lon"), _CFG.cell).alias("gx"), geo.cell(c("lat"), _CFG.cell).alias("gy"))


@query("neighbour_explode", _with(select=f"SELECT source_id, floor(lon / {_CELL}::DOUBLE)::BIGINT + i AS nx, floor(lat / {_CELL}::DOUBLE)::BIGINT + j AS ny FROM obs, unnest([-1, 0, 1]) x(i), unnest([-1, 0, 1]) y(j)"))
def neighbour_explode(spark: SparkSession, d: str) -> DataFrame:
    return geo.neighbours(grid_cells(spark, d), "gx", "gy").select("source_id", "nx", "ny")


# --- candidates, scores, edges ---------------------------------------------------------------------------------------


@query("box_join_count", _with(select=f"SELECT a.source AS left_source, b.source AS right_source, count(*) AS n FROM obs a JOIN obs b ON a.code < b.code AND abs(a.lat - b.lat) <= {_CFG.lat_span!r}::DOUBLE AND abs(a.lon - b.lon) <= {_CELL}::DOUBLE AND {_HAV.format(a='a.', b='b.')} <= 120 GROUP BY ALL"))
def box_join_count(spark: SparkSession, d: str) -> DataFrame:
    return match.candidates(fixture.observations(spark, d)).groupBy(c("l_source").alias("left_source"), c("r_source").alias("right_source")).agg(F.count("*").alias("n"))


@query("haversine_pairs", _with(_edges_sql(), select=f"SELECT li AS left_source_id, ri AS right_source_id, round(distance_m, {DIGITS}) AS distance_m FROM within"))
def haversine_pairs(spark: SparkSession, d: str) -> DataFrame:
    return match.candidates(fixture.observations(spark, d)).select(c("l_source_id").alias("left_source_id"), c("r_source_id").alias("right_source_id"), F.round("distance_m", DIGITS).alias("distance_m"))


@query("within_distance", _with(_edges_sql(60.0), select="SELECT ls AS left_source, rs AS right_source, count(*) AS n FROM within GROUP BY ALL"))
def within_distance(spark: SparkSession, d: str) -> DataFrame:
    return match.candidates(fixture.observations(spark, d), match.MatchConfig(60.0)).groupBy(c("l_source").alias("left_source"), c("r_source").alias("right_source")).agg(F.count("*").alias("n"))


def _jw(name: str, sql: str, pairs: Callable[[DataFrame], DataFrame], score: Callable[[], Column]) -> None:
    @query(name, _with(_edges_sql(), select=f"SELECT li AS left_source_id, ri AS right_source_id, round({sql}, 9) AS s FROM within"))
    def run(spark: SparkSession, d: str) -> DataFrame:
        got = pairs(fixture.observations(spark, d)).withColumn("s", score())
        return got.select(c("l_source_id").alias("left_source_id"), c("r_source_id").alias("right_source_id"), F.round("s", 9).alias("s"))


_jw("jw_names", "jaro_winkler_similarity(ln, rn)", lambda obs: match.scored(obs, tokens=False), lambda: c("name_score"))
_jw("jw_tokens_greatest", "jw", match.scored, lambda: c("name_score"))
_jw("jw_cutoff", f"jaro_winkler_similarity(ln, rn, {match.CUTOFF})", lambda obs: match.scored(obs, tokens=False), lambda: F.when(c("name_score") < match.CUTOFF, 0.0).otherwise(c("name_score")))
_jw("category_score", "CASE WHEN lc IS NULL OR rc IS NULL OR trim(lc) = '' OR trim(rc) = '' THEN 0.0 ELSE jaro_winkler_similarity(lower(lc), lower(rc)) END", match.candidates, lambda: match.category_score(c("l_category"), c("r_category")))

_NAMES = [("atm",), ("bdo",), ("bank",), ("jollibee",), ("seven eleven",), ("shop",), ("",), ("abcde",)]


@query("generic_flag", f"SELECT name, {_GENERIC.format(n='name')} AS generic FROM (VALUES " + ", ".join(f"('{n}')" for (n,) in _NAMES) + ") t(name)")
def generic_flag(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(_NAMES, "name string").select("name", match.is_generic(c("name")).alias("generic"))


_AT = (0.0, 4.9, 5.0, 14.9, 15.0, 15.1, 20.0, 20.1, 50.0, 50.1, 90.0, 90.1, 119.9, 120.0, 150.0, 200.0, 200.1)
_SCORES = (0.6, 0.7, 0.82, 0.9, 0.94, 0.9899, 0.99, 1.0)
_LADDER = [(x, s, a, b) for x in _AT for s in _SCORES for a, b in (("jollibee", "jolibee"), ("atm", "atm"), ("jollibee", "abcd"), ("", "jollibee"))]
_LADDER_SQL = "(VALUES " + ", ".join(f"({x}::DOUBLE, {s}::DOUBLE, '{a}', '{b}')" for x, s, a, b in _LADDER) + ") t(distance_m, name_score, ln, rn)"


def _bands(radius: int) -> None:
    @query(f"acceptance_bands_{radius}", f"SELECT distance_m, name_score, ln, rn, coalesce({_accept(float(radius))}, false) AS ok FROM {_LADDER_SQL}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        df = spark.createDataFrame(_LADDER, "distance_m double, name_score double, ln string, rn string")
        return df.withColumn("ok", F.coalesce(match.accepted(c("distance_m"), c("name_score"), c("ln"), c("rn"), float(radius)), F.lit(False)))


for _r in RADII:
    _bands(_r)


def _edge_query(name: str, sources: tuple[str, ...], radius: float = 120.0) -> None:
    @query(name, _with(_edges_sql(radius, sources), select=f"SELECT {_EDGE_COLUMNS} FROM edges"))
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _rounded(match.edges(fixture.observations(spark, d), match.MatchConfig(radius), sources))


_edge_query("edges_all", SOURCES)
for _a, _b in source_pairs(SOURCES):
    _edge_query(f"edges_{_a}_{_b}", (_a, _b))
_edge_query("edges_radius_60", SOURCES, 60.0)
_CORE = Tile(57, 481, 0.25)


@query("edges_core_tile", _with(_edges_sql(), select="SELECT left_source_id, right_source_id FROM edges JOIN obs ON left_source_id = source_id WHERE lon >= 120.25 AND lon < 120.5 AND lat >= 14.25 AND lat < 14.5"))
def edges_core_tile(spark: SparkSession, d: str) -> DataFrame:
    return match.edges(fixture.observations(spark, d), core=_CORE).select("left_source_id", "right_source_id")


@query("rank_score", _with(_edges_sql(), select="SELECT left_source, right_source, count(*) AS n, round(min(score::DOUBLE), 5) AS lowest, round(max(score::DOUBLE), 5) AS highest FROM edges GROUP BY ALL"))
def rank_score(spark: SparkSession, d: str) -> DataFrame:
    s = c("score").cast("double")
    return match.edges(fixture.observations(spark, d)).groupBy("left_source", "right_source").agg(F.count("*").alias("n"), F.round(F.min(s), 5).alias("lowest"), F.round(F.max(s), 5).alias("highest"))


@query("independent_flag", _with(_edges_sql(), select="SELECT left_source, right_source, independent, count(*) AS n FROM edges GROUP BY ALL"))
def independent_flag(spark: SparkSession, d: str) -> DataFrame:
    return match.edges(fixture.observations(spark, d)).groupBy("left_source", "right_source", "independent").agg(F.count("*").alias("n"))


# --- clusters and canonical points -----------------------------------------------------------------------------------


def _stages(spark: SparkSession, d: str, sources: tuple[str, ...] = SOURCES) -> tuple[DataFrame, DataFrame]:
    """(numbered observations, resolved edges)."""
    numbered = canonical.observations(fixture.observations(spark, d, sources))
    named = numbered.withColumn("name_norm", text.normalized(c("name"))).withColumn("name_tokens", text.sorted_tokens(c("name_norm")))
    return numbered, cluster.identified(match.edges(named, sources=sources, key="row_id"), numbered)


def _clustered(spark: SparkSession, d: str, sources: tuple[str, ...] = SOURCES) -> tuple[DataFrame, DataFrame, DataFrame]:
    obs, edges = _stages(spark, d, sources)
    roots = cluster.clusters(obs.select("row_id", "source_code"), cluster.ranked(edges, by_id=True))
    return obs, roots, canonical.match_edges(edges, roots)


def _points(spark: SparkSession, d: str, sources: tuple[str, ...] = SOURCES) -> tuple[DataFrame, DataFrame, DataFrame]:
    obs, roots, final = _clustered(spark, d, sources)
    return canonical.canonical(obs, roots, final, geometry=False), obs, final


@query("edge_resolution", _with(_edges_sql(), select="SELECT left_source_id, right_source_id, count(*) AS n FROM edges GROUP BY ALL"))
def edge_resolution(spark: SparkSession, d: str) -> DataFrame:
    obs, edges = _stages(spark, d)
    name = obs.select("row_id", "source_id")
    left = edges.join(name.withColumnsRenamed({"row_id": "a", "source_id": "left_name"}), c("left_id") == c("a")).join(name.withColumnsRenamed({"row_id": "b", "source_id": "right_name"}), c("right_id") == c("b"))
    return left.groupBy(c("left_name").alias("left_source_id"), c("right_name").alias("right_source_id")).agg(F.count("*").alias("n"))


@query("edge_resolution_mismatch", _with(_edges_sql(), select="SELECT count(*) FILTER (WHERE left_source = 'fsq') AS lost FROM edges"))
def edge_resolution_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Edges that would not resolve if one source's observations were missing."""
    obs = fixture.observations(spark, d)
    have = obs.where(c("source") != "fsq").select(c("source").alias("s"), c("source_id").alias("i"))
    edges = match.edges(obs)
    return edges.join(have, (c("left_source") == c("s")) & (c("left_source_id") == c("i")), "left_anti").agg(F.count("*").alias("lost"))


_RANKED = "SELECT left_source_id, right_source_id, row_number() OVER (ORDER BY score DESC, name_score DESC, distance_m, left_source, left_source_id, right_source, right_source_id) - 1 AS rank FROM edges"


@query("ranked_edges", _with(_edges_sql(), select=_RANKED))
def ranked_edges(spark: SparkSession, d: str) -> DataFrame:
    _, edges = _stages(spark, d)
    order = cluster.ranked(edges, by_id=True).select("left_id", "right_id", "rank")
    return order.join(edges.select("left_id", "right_id", "left_source_id", "right_source_id"), ["left_id", "right_id"]).select("left_source_id", "right_source_id", "rank")


@query("clusters", _with(_cluster_sql(), select="SELECT id AS source_id, root AS cluster_first FROM fin"))
def clusters(spark: SparkSession, d: str) -> DataFrame:
    obs, roots, _ = _clustered(spark, d)
    met = obs.select("row_id", "source_id").join(roots, "row_id")
    first = met.groupBy(c("cluster_root").alias("root")).agg(F.min("source_id").alias("cluster_first"))
    return met.join(first, c("cluster_root") == c("root")).select("source_id", "cluster_first")


@query("one_per_source_violations", "SELECT 0::BIGINT AS violations")
def one_per_source_violations(spark: SparkSession, d: str) -> DataFrame:
    obs, roots, _ = _clustered(spark, d)
    return obs.join(roots, "row_id").groupBy("cluster_root", "source_code").count().where("count > 1").agg(F.count("*").alias("violations"))


@query("match_edges_final", _with(_cluster_sql(), select="SELECT left_source_id, right_source_id, same_cluster_final FROM me"))
def match_edges_final(spark: SparkSession, d: str) -> DataFrame:
    return _clustered(spark, d)[2].select("left_source_id", "right_source_id", "same_cluster_final")


_KEYED = "coalesce('fsq:' || max(source_id) FILTER (WHERE code = 1), 'overture:' || max(source_id) FILTER (WHERE code = 2), 'osm:' || max(source_id) FILTER (WHERE code = 4))"


@query("cluster_diameter", _with(_canonical_sql(), select=f"SELECT canonical_id, round(cluster_max_pair_distance_m, {DIGITS}) AS diameter FROM can WHERE cluster_max_pair_distance_m IS NOT NULL"))
def cluster_diameter(spark: SparkSession, d: str) -> DataFrame:
    return _points(spark, d)[0].where(c("cluster_max_pair_distance_m").isNotNull()).select("canonical_id", F.round("cluster_max_pair_distance_m", DIGITS).alias("diameter"))


@query("canonical", _with(_canonical_sql(), select=f"SELECT * REPLACE (round(lon, 9) AS lon, round(lat, 9) AS lat, round(match_score_min::DOUBLE, 5) AS match_score_min, round(cluster_max_pair_distance_m, {DIGITS}) AS cluster_max_pair_distance_m) FROM can"))
def canonical_points(spark: SparkSession, d: str) -> DataFrame:
    out = _points(spark, d)[0]
    return out.withColumns({"lon": F.round("lon", 9), "lat": F.round("lat", 9), "match_score_min": F.round(c("match_score_min").cast("double"), 5), "cluster_max_pair_distance_m": F.round("cluster_max_pair_distance_m", DIGITS)})


def _from_canonical(name: str, columns: str) -> None:
    @query(name, _with(_canonical_sql(), select=f"SELECT {columns} FROM can"))
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _points(spark, d)[0].select(*[x.strip() for x in columns.split(",")])


_from_canonical("canonical_argmin_category", "canonical_id, canonical_category, canonical_name")
_from_canonical("canonical_id", "canonical_id, fsq_id, overture_id, osm_id")
_from_canonical("independent_counts", "canonical_id, source_count, known_independent_source_count, overture_has_foursquare_provenance")
_from_canonical("completed_transitively", "canonical_id, completed_transitively")


@query("evidence_tiers", _with(_canonical_sql(), select="SELECT evidence_tier, count(*) AS n FROM can GROUP BY ALL"))
def evidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    return canonical.tier_counts(_points(spark, d)[0])


@query("tier_window_count", _with(_canonical_sql(), select="SELECT canonical_id, evidence_tier, count(*) OVER (PARTITION BY evidence_tier) AS n FROM can"))
def tier_window_count(spark: SparkSession, d: str) -> DataFrame:
    """A window over three tiers would put the table into three tasks: the counts are joined instead."""
    points = settled(_points(spark, d)[0].select("canonical_id", "evidence_tier"))
    return points.join(F.broadcast(canonical.tier_counts(points)), "evidence_tier")  # a row a tier


@query("summary", _with(_canonical_sql(), select="""SELECT (SELECT count(*) FROM obs) AS observations, (SELECT count(*) FROM me) AS candidate_links_accepted_by_thresholds, (SELECT count(*) FROM me WHERE same_cluster_final) AS accepted_links_within_final_cluster,
  (SELECT count(*) FROM can) AS canonical_pois, (SELECT count(*) FROM can WHERE completed_transitively) AS canonical_pois_completed_transitively, (SELECT count(*) FROM can WHERE source_count > 1) AS canonical_pois_of_several_sources"""))
def summary(spark: SparkSession, d: str) -> DataFrame:
    return canonical.summary(*_points(spark, d))


@query("observed_licences", _with(_canonical_sql(), select="SELECT 'fsq' AS source, array_to_string(list_sort(list(DISTINCT fsq_license) FILTER (WHERE fsq_license IS NOT NULL)), ',') AS licences FROM can UNION ALL SELECT 'overture', array_to_string(list_sort(list(DISTINCT overture_license) FILTER (WHERE overture_license IS NOT NULL)), ',') FROM can UNION ALL SELECT 'osm', array_to_string(list_sort(list(DISTINCT osm_license) FILTER (WHERE osm_license IS NOT NULL)), ',') FROM can"))
def observed_licences(spark: SparkSession, d: str) -> DataFrame:
    return validate.observed_licences(_points(spark, d)[0]).select("source", F.array_join("licences", ",").alias("licences"))


def _subset(sources: tuple[str, ...]) -> None:
    names = ", ".join(f"'{s}'" for s in sources)
    view = f"sub AS (SELECT * FROM obs WHERE source IN ({names}))"

    @query("source_subset_" + "_".join(sources), _with(view, _edges_sql(120.0, sources, "sub"), select="SELECT (SELECT count(*) FROM sub) AS observations, (SELECT count(*) FROM edges) AS edges"))
    def run(spark: SparkSession, d: str) -> DataFrame:
        obs = fixture.observations(spark, d, sources)
        return obs.agg(F.count("*").alias("observations")).join(F.broadcast(match.edges(obs, sources=sources).agg(F.count("*").alias("edges"))))  # one row each


for _s in (("fsq",), ("overture",), ("osm",), ("fsq", "overture"), ("fsq", "osm"), ("overture", "osm"), SOURCES):
    _subset(_s)


# --- validation ------------------------------------------------------------------------------------------------------

_FAULTS = "('fsq:f1', 'twice', 120.5::DOUBLE, 14.5::DOUBLE, 1, 'single', 'f1'), (NULL, 'no id', 120.5, 14.5, 1, 'single', 'x'), ('x:1', '  ', 120.5, 14.5, 1, 'single', 'x'), ('x:2', 'nowhere', NULL, 14.5, 1, 'single', 'x'), ('x:3', 'null island', 0, 0, 1, 'single', 'x'), ('x:4', 'far', 999, 14.5, 2, NULL, 'x')"
_FAULTY = f"flt AS (SELECT 'fsq:' || source_id AS canonical_id, name AS canonical_name, lon, lat, 1 AS source_count, 'single' AS evidence_tier, source_id AS fsq_id FROM obs WHERE code = 1 UNION ALL SELECT * FROM (VALUES {_FAULTS}) t)"


def _faulty(spark: SparkSession, d: str) -> DataFrame:
    good = fixture.observations(spark, d, ("fsq",)).select(F.concat(F.lit("fsq:"), "source_id").alias("canonical_id"), c("name").alias("canonical_name"), "lon", "lat", F.lit(1).alias("source_count"), F.lit("single").alias("evidence_tier"), c("source_id").alias("fsq_id"))
    rows = [("fsq:f1", "twice", 120.5, 14.5, 1, "single", "f1"), (None, "no id", 120.5, 14.5, 1, "single", "x"), ("x:1", "  ", 120.5, 14.5, 1, "single", "x"), ("x:2", "nowhere", None, 14.5, 1, "single", "x"), ("x:3", "null island", 0.0, 0.0, 1, "single", "x"), ("x:4", "far", 999.0, 14.5, 2, None, "x")]
    return good.unionByName(spark.createDataFrame(rows, "canonical_id string, canonical_name string, lon double, lat double, source_count int, evidence_tier string, fsq_id string"))


@query("validate_failures", _with(_FAULTY, select=f"""SELECT count(*) AS n_rows, count(DISTINCT canonical_id) AS unique_ids, count(*) - count(DISTINCT canonical_id) AS duplicate_canonical_ids, count(*) FILTER (WHERE canonical_id IS NULL) AS null_canonical_ids,
  count(*) FILTER (WHERE canonical_name IS NULL OR trim(canonical_name) = '') AS missing_names, count(*) FILTER (WHERE lon IS NULL OR lat IS NULL) AS missing_coordinates, count(*) FILTER (WHERE lon < -180 OR lon > 180 OR lat < -90 OR lat > 90) AS coordinates_out_of_range,
  count(*) FILTER (WHERE NOT ({_IN})) AS outside_requested_scope, count(*) FILTER (WHERE source_count <> CASE WHEN fsq_id IS NOT NULL THEN 1 ELSE 0 END) AS source_count_mismatches, count(*) FILTER (WHERE lon = 0 AND lat = 0) AS null_island_coordinates,
  count(*) FILTER (WHERE evidence_tier IS NULL) AS null_evidence_tier, min(source_count)::BIGINT AS min_sources, max(source_count)::BIGINT AS max_sources FROM flt"""))
def validate_failures(spark: SparkSession, d: str) -> DataFrame:
    return validate.counts(_faulty(spark, d), SCOPE)


@query("validate_near_duplicates", _with(select="SELECT lower(trim(name)) AS name, round(lon, 5) AS x, round(lat, 5) AS y, count(*) AS n FROM obs GROUP BY ALL HAVING count(*) > 1"))
def validate_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return validate.near_duplicates(fixture.observations(spark, d).withColumn("canonical_name", c("name")))


@query("validate_scope_leak", _with(_FAULTY, select=f"SELECT count(*) AS leaked FROM flt WHERE NOT ({_IN})"))
def validate_scope_leak(spark: SparkSession, d: str) -> DataFrame:
    return _faulty(spark, d).where(~SCOPE.contains(c("lon"), c("lat"))).agg(F.count("*").alias("leaked"))


# --- providers -------------------------------------------------------------------------------------------------------

_RING = [(120.1, 14.1), (120.6, 14.05), (120.7, 14.4), (120.45, 14.3), (120.3, 14.6), (120.1, 14.1)]
_RING_SQL = "e AS (SELECT * FROM (VALUES " + ", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for a, b in zip(_RING[:-1], _RING[1:], strict=True)) + ") t(x1, y1, x2, y2))"


@query("land_clip", _with(_RING_SQL, """hits AS (SELECT source_id, sum(CASE WHEN ((y1 > lat) <> (y2 > lat)) AND lon < x1 + (lat - y1) / (y2 - y1) * (x2 - x1) THEN 1 ELSE 0 END) % 2 = 1 AS inside,
  min(pow(lon - (x1 + least(1.0, greatest(0.0, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) * (x2 - x1)), 2) + pow(lat - (y1 + least(1.0, greatest(0.0, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) * (y2 - y1)), 2)) <= 0.002::DOUBLE * 0.002::DOUBLE AS near
  FROM obs, e WHERE code = 2 GROUP BY source_id)""", select="SELECT source_id FROM hits WHERE inside OR near"))
def land_clip(spark: SparkSession, d: str) -> DataFrame:
    return geo.on_land(fixture.observations(spark, d, ("overture",)), _ring_edges(spark), places.LAND_TOLERANCE, "source_id").select("source_id")


def _ring_edges(spark: SparkSession) -> DataFrame:
    rings = spark.createDataFrame([("r", [{"x": x, "y": y} for x, y in _RING])], "ring_id string, points array<struct<x: double, y: double>>")
    return places.boundary_edges(rings)


@query("tile_mask_land", _with(_RING_SQL, """tl AS (SELECT DISTINCT floor(lon / 0.25)::INTEGER AS tile_x, floor(lat / 0.25)::INTEGER AS tile_y FROM obs),
met AS (SELECT tile_x, tile_y, bool_or(least(x1, x2) < (tile_x + 1) * 0.25::DOUBLE AND greatest(x1, x2) > tile_x * 0.25::DOUBLE AND least(y1, y2) < (tile_y + 1) * 0.25::DOUBLE AND greatest(y1, y2) > tile_y * 0.25::DOUBLE) AS touched,
  sum(CASE WHEN ((y1 > (tile_y + 0.5::DOUBLE) * 0.25::DOUBLE) <> (y2 > (tile_y + 0.5::DOUBLE) * 0.25::DOUBLE)) AND (tile_x + 0.5::DOUBLE) * 0.25::DOUBLE < x1 + ((tile_y + 0.5::DOUBLE) * 0.25::DOUBLE - y1) / (y2 - y1) * (x2 - x1) THEN 1 ELSE 0 END) % 2 = 1 AS inside
  FROM tl, e GROUP BY ALL)""", select="SELECT tile_x, tile_y FROM met WHERE touched OR inside"))
def tile_mask_land(spark: SparkSession, d: str) -> DataFrame:
    """The boundary's mask over the tiles of all observations."""
    found = obs_tiles(spark, d).select("tile_x", "tile_y").distinct().collect()  # an area's tile list
    return places.tiles_on_land(spark, [Tile(r.tile_y, r.tile_x, 0.25) for r in found], _ring_edges(spark))


@query("overture_category_coalesce", "SELECT p_partkey AS id, coalesce(CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) END, CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) END, lower(p_name)) AS category FROM part WHERE p_partkey % 5 <> 0")
def overture_category_coalesce(spark: SparkSession, d: str) -> DataFrame:
    k = c("p_partkey")
    raw = spark.read.parquet(f"{d}/part.parquet").select(
        k.cast("string").alias("id"), F.struct(c("p_name").alias("primary")).alias("names"), F.struct(F.when(k % 2 == 0, F.lower("p_type")).alias("primary")).alias("taxonomy"), F.when(k % 3 == 0, F.lower("p_brand")).alias("basic_category"),
        F.struct(F.lower("p_name").alias("primary")).alias("categories"), F.when(k % 5 == 0, "permanently_closed").alias("operating_status"), F.lit(120.5).alias("lon"), F.lit(14.5).alias("lat"))
    return places.overture(raw, SCOPE).select(c("source_id").cast("long").alias("id"), "category")


@query("osm_category_concat", "SELECT p_partkey AS id, concat_ws(' | ', 'amenity=' || CASE WHEN p_partkey % 2 = 0 THEN lower(p_brand) END, 'shop=' || CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) END) AS category FROM part")
def osm_category_concat(spark: SparkSession, d: str) -> DataFrame:
    k = c("p_partkey")
    raw = spark.read.parquet(f"{d}/part.parquet").select(k.alias("id"), F.when(k % 2 == 0, F.lower("p_brand")).alias("amenity"), F.when(k % 3 == 0, F.lower("p_type")).alias("shop"))
    return raw.select("id", places.osm_category(raw.columns).alias("category"))


@query("foursquare_filter", "SELECT 'p' || p_partkey AS source_id, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name_norm FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 4 <> 0")
def foursquare_filter(spark: SparkSession, d: str) -> DataFrame:
    k = c("p_partkey")
    raw = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("p"), k.cast("string")).alias("fsq_place_id"), c("p_name").alias("name"), F.array(F.lower("p_type")).alias("fsq_category_labels"), F.lit(120.5).alias("longitude"), F.lit(14.5).alias("latitude"), F.when(k % 3 == 0, "JP").otherwise("PH").alias("country"), F.when(k % 4 == 0, "2024-01-01").alias("date_closed"))
    return places.foursquare(raw, SCOPE).select("source_id", "name_norm")


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/placelink-settled/{name}-{uuid.uuid4().hex}"


def _features(spark: SparkSession, d: str, geometry: Column) -> DataFrame:
    """The osm observations, written as a GeoJSON sequence and read back."""
    rows = fixture.observations(spark, d, ("osm",))
    tags = F.struct(F.split_part("source_id", F.lit("/"), F.lit(1)).alias("@type"), F.split_part("source_id", F.lit("/"), F.lit(2)).alias("@id"), "name", c("category").alias("amenity"))
    path = _scratch(spark, "features")
    rows.select(F.concat(F.lit("\u001e"), F.to_json(F.struct(F.lit("Feature").alias("type"), tags.alias("properties"), geometry.alias("geometry")))).alias("value")).write.text(path)
    return places.osm(spark, path)


@query("osm_features", _with(select="SELECT source_id, name, 'amenity=' || category AS category, lon, lat, name_norm FROM obs WHERE source = 'osm'"))
def osm_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))).select("source_id", "name", "category", "lon", "lat", "name_norm")


@query("representative_points", _with(select="SELECT source_id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM obs WHERE source = 'osm'"))
def representative_points(spark: SparkSession, d: str) -> DataFrame:
    """Each object as two squares, of which the one around its place is larger: its point is the middle of that one."""
    at = lambda x, y: F.array(c("lon") + x, c("lat") + y)
    square = lambda x, size: F.array(F.array(at(x - size, -size), at(x + size, -size), at(x + size, size), at(x - size, size), at(x - size, -size)))
    got = _features(spark, d, F.struct(F.lit("MultiPolygon").alias("type"), F.array(square(0.1, 0.001), square(0.0, 0.01)).alias("coordinates")))
    return got.select("source_id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


@query("tiles_read_back", _with(select="SELECT source, source_id, lon, lat FROM obs WHERE source IN ('fsq', 'osm') AND lon >= 120.25 AND lon < 120.75 AND lat >= 14.25 AND lat < 14.5"))
def tiles_read_back(spark: SparkSession, d: str) -> DataFrame:
    """The tiled table, of which two sources' partitions of two tiles are read."""
    path = _scratch(spark, "tiles")
    places.write_tiles(fixture.observations(spark, d).select(*places.COLUMNS), path, 0.25)
    return places.read_tiles(spark, path, [Tile(57, 481, 0.25), Tile(57, 482, 0.25)], ("fsq", "osm")).select("source", "source_id", "lon", "lat")


@query("geoparquet_read_back", _with(select="SELECT source_id, name, lon, lat FROM obs"))
def geoparquet_read_back(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "points")
    geoparquet.write(spark, fixture.observations(spark, d).select("source_id", "name", geo.wkb_point(c("lon"), c("lat")).alias("geometry")), path)
    return spark.read.parquet(path).select("source_id", "name", geo.point_of_wkb(c("geometry")).alias("p")).select("source_id", "name", "p.lon", "p.lat")


@query("stream_edges", _with(_edges_sql(), select="SELECT left_source_id, right_source_id FROM edges"))
def stream_edges(spark: SparkSession, d: str) -> DataFrame:
    """Two files of observations in two micro-batches come to the edges of one batch. Rows of the second file stood elsewhere in the first."""
    obs = fixture.observations(spark, d).select(*places.COLUMNS)
    half, path = F.crc32("source_id") % 2 == 0, _scratch(spark, "stream")
    moved = obs.where(~half).withColumn("lon", F.when(F.crc32("source_id") % 3 == 0, c("lon") + 0.5).otherwise(c("lon")))
    for part in (obs.where(half).unionByName(moved), obs.where(~half)):
        part.write.mode("append").parquet(f"{path}/incoming")
        incremental.start(spark, f"{path}/incoming", f"{path}/table", f"{path}/edges", f"{path}/checkpoint").awaitTermination()
    return incremental.current_edges(spark, f"{path}/edges", f"{path}/table").select("left_source_id", "right_source_id")


@query("wkb_points", _with(select="SELECT source_id, 21::BIGINT AS size, true AS same FROM obs"))
def wkb_points(spark: SparkSession, d: str) -> DataFrame:
    """The bytes of a point hold its coordinates: ``same`` where the header is a point's and both coordinates, read back, are the row's."""
    df = fixture.observations(spark, d).select("source_id", "lon", "lat", geo.wkb_point(c("lon"), c("lat")).alias("w")).withColumn("p", geo.point_of_wkb(c("w")))
    same = (F.hex(F.substring("w", 1, 5)) == "0101000000") & c("p.lon").eqNullSafe(c("lon")) & c("p.lat").eqNullSafe(c("lat"))
    return df.select("source_id", F.length("w").cast("long").alias("size"), same.alias("same"))


def queries() -> dict[str, Query]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


