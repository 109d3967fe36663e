import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from placelink import cli
from placelink.operators import canonical, cluster, match, validate
from placelink.plans import attribution, fixture, state
from placelink.plans.scope import PH_BOX, Scope, SourceSelectionError, Tile, source_pairs, sources_of, tiles, with_halo
from placelink.sources import geoparquet, places
from placelink.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def rounded(rows):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


ENGINE = sorted(n for n in __spark_entry__.queries() if not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", ENGINE)
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert rounded(map(tuple, df.select(columns).collect())) == rounded(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["left_source", "left_source_id"]


def test_tiles_and_scopes():
    grid = tiles(((120.0, 14.0, 121.0, 15.0),), 0.25)
    assert len(grid) == 16 and grid[0].key == "s0.25_x+0480_y+0056" and len(Tile(14, 120, 1.0).children(0.25)) == 16
    assert set(Tile(14, 120, 1.0).children(0.25)) == set(grid) and len(tiles((PH_BOX, PH_BOX), 1.0)) == len(tiles((PH_BOX,), 1.0))
    with pytest.raises(ValueError):
        Tile(0, 0, 1.0).children(0.3)
    assert with_halo((1, 1, 2, 2), 100.0) == (0.999, 0.999, 2.001, 2.001) and Scope("a, b", (PH_BOX,)).slug == "a__b"
    assert sources_of("osm,foursquare") == ("fsq", "osm") and sources_of(None) == ("overture", "osm") and len(source_pairs(sources_of("all"))) == 3
    for bad in ("nowhere", " "):
        with pytest.raises(SourceSelectionError):
            sources_of(bad)


@pytest.mark.parametrize("seed", range(4))
def test_clusters_equal_the_sequential_rule(spark, seed):
    rnd = random.Random(seed)
    n = 150
    codes = [rnd.choice([1, 2, 4]) for _ in range(n)]
    pairs = [tuple(rnd.sample(range(n), 2)) for _ in range(250)]
    want = cluster.greedy(codes, pairs)
    nodes = spark.createDataFrame(list(enumerate(codes)), "row_id long, source_code int")
    ranked = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(pairs)], "left_id long, right_id long, rank long")
    got = {r.row_id: r.cluster_root for r in cluster.clusters(nodes, ranked).collect()}
    assert [got[i] for i in range(n)] == want
    masks = Counter((got[i], codes[i]) for i in range(n))
    assert max(masks.values()) == 1


def test_no_edges(spark):
    nodes = spark.createDataFrame([(0, 1), (1, 4)], "row_id long, source_code int")
    got = cluster.clusters(nodes, spark.createDataFrame([], "left_id long, right_id long, rank long"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0), (1, 1)]


def test_unresolved_edges_raise(spark):
    obs = fixture.observations(spark, "/root/testdata/sf0.01")
    numbered = canonical.observations(obs.where("source <> 'fsq'"))
    with pytest.raises(cluster.EdgeResolutionError, match="resolution mismatch"):
        cluster.resolved(match.edges(obs), numbered)


def test_edges_survive_tile_and_cell_borders(spark):
    """Clusters of points on the corners of degrees, quarter degrees and cells, against all pairs."""
    rnd = random.Random(9)
    cell = match.MatchConfig().cell
    rows = []
    for x, y in ((121.0, 14.5), (120.75, 14.25), (120.4, 14.8), (cell * 100_000, cell * 12_000)):
        for i in range(60):
            source = rnd.choice(["fsq", "overture", "osm"])
            rows.append((source, f"{source}{len(rows)}", rnd.choice(["jollibee ayala", "jolibee ayala", "mang inasal", "inasal mang"]), None, x + rnd.uniform(-0.0015, 0.0015), y + rnd.uniform(-0.0015, 0.0015), None))
    df = spark.createDataFrame(rows, "source string, source_id string, name string, category string, lon double, lat double, provenance string")
    from placelink.functions import geo, similarity, text

    df = df.withColumn("name_norm", text.normalized(F.col("name"))).withColumn("name_tokens", text.sorted_tokens(F.col("name_norm")))
    for radius in (60.0, 120.0):
        got = {(r.left_source_id, r.right_source_id) for r in match.edges(df, match.MatchConfig(radius)).collect()}
        a = df.select(*[F.col(x).alias(f"a_{x}") for x in df.columns])
        b = df.select(*[F.col(x).alias(f"b_{x}") for x in df.columns])
        rank = {"fsq": 0, "overture": 1, "osm": 2}
        near = a.crossJoin(b).withColumn("d", geo.haversine(F.col("a_lon"), F.col("a_lat"), F.col("b_lon"), F.col("b_lat"))).where(F.col("d") <= radius).collect()
        want = set()
        for r in near:
            if rank[r.a_source] < rank[r.b_source]:
                s = max(similarity.jaro_winkler([r.a_name_norm.encode(), r.a_name_tokens.encode()], [r.b_name_norm.encode(), r.b_name_tokens.encode()]))
                if match.accepts(r.d, s, r.a_name_norm, r.b_name_norm, radius):
                    want.add((r.a_source_id, r.b_source_id))
        assert got == want and want


def test_tile_mask_reaches_beyond_the_western_half(spark):
    got = {(r.tile_x, r.tile_y) for r in __spark_entry__.queries()["tile_mask_land"](spark, SF).collect()}
    assert (482, 56) in got and (483, 59) not in got and (480, 59) not in got


def test_report(spark):
    schema = "canonical_id string, canonical_name string, lon double, lat double, source_count int, evidence_tier string, fsq_id string, osm_id string"
    scope = Scope("x", ((120.0, 14.0, 121.0, 15.0),))
    good = spark.createDataFrame([("fsq:1", "a", 120.5, 14.5, 1, "single", "1", None), ("fsq:2", "b", 120.6, 14.5, 2, "double", "2", "n")], schema)
    run = {"active_sources": ["fsq", "osm"], "git_dirty": False}
    got = validate.report(good, scope, ("fsq", "osm"), run, strict=True)
    assert got["ok"] and got["evidence_tiers"] == {"double": 1, "single": 1}
    assert validate.report(good.limit(0), scope, ("fsq", "osm"), run)["ok"]
    bad = validate.report(good, scope, ("fsq",), run)
    assert not bad["ok"] and bad["failures"]["inactive_source_members_present"] == 1 and bad["failures"]["source_count_above_selection"] == 1 and bad["failures"]["run_source_set_mismatch"] == 1
    assert validate.report(good, scope)["warnings"]["run_manifest_missing"] == 1
    with pytest.raises(ValueError, match="missing columns"):
        validate.report(good.drop("lon"), scope)


def test_state(tmp_path):
    grid = tiles(((120.0, 14.0, 121.0, 15.0),), 1.0)
    state.pin(tmp_path, "fsq", "2026-01-01")
    keys = {t.key for t in grid}
    assert state.snapshot(tmp_path, ("fsq",), grid, {"fsq": keys}, {"fsq": "2026-01-01"})["fsq"]["release"] == "2026-01-01"
    with pytest.raises(state.StateError, match="osm: no release.*missing.*the pin is"):
        state.snapshot(tmp_path, ("osm", "fsq"), grid, {}, {"fsq": "2025-01-01"})
    stage = state.Stage(tmp_path, "edges", {"a": 1})
    assert stage.manifest is None
    stage.complete(edges=3)
    assert stage.manifest["edges"] == 3 and state.Stage(tmp_path, "edges", {"a": 2}).manifest is None
    stage.discard()
    assert stage.manifest is None and state.sealed_matches(state.sealed(["b", "a"]), ["a", "b"])


def test_attribution():
    said = attribution.text("Manila", ("fsq", "osm"), {"fsq": "2026"}, {"fsq": ["Apache-2.0"]})
    assert "UNDETERMINED" in said and "OpenStreetMap" in said and "2026" in said and attribution.block(("fsq",))["contains_odbl_source"] is False


def test_overture_source(spark):
    rows = [("a", ("Edge",), ("cafe",), [("", "meta", "m1")], None, 120.0, 14.0), ("b", ("Inner",), ("shop",), [("", "O'Brien, Co", "x")], "open", 120.5, 14.5), ("c", ("Closed",), ("shop",), None, "permanently_closed", 120.5, 14.5), ("d", ("Out",), ("shop",), None, None, 121.0, 14.5), ("e", ("新光",), None, None, None, 120.5, 14.5)]
    raw = spark.createDataFrame(rows, "id string, names struct<primary:string>, categories struct<primary:string>, sources array<struct<property:string,dataset:string,record_id:string>>, operating_status string, lon double, lat double")
    got = {r.source_id: r for r in places.overture(raw, Scope("t", ((120.0, 14.0, 121.0, 15.0),))).collect()}
    assert set(got) == {"a", "b"} and got["a"].upstream_license == "CDLA-Permissive-2.0" and "'O\\'Brien, Co'" in got["b"].provenance and got["b"].category == "shop"


def test_osm_source(spark, tmp_path):
    import json

    feature = lambda props, geometry: json.dumps({"type": "Feature", "properties": props, "geometry": geometry})
    square = {"type": "Polygon", "coordinates": [[[121.0, 14.0], [121.2, 14.0], [121.2, 14.2], [121.0, 14.2], [121.0, 14.0]]]}
    lines = [feature({"@type": "node", "@id": 1, "name": "Café", "amenity": "cafe", "shop": "bakery"}, {"type": "Point", "coordinates": [121.0, 14.5]}), feature({"@type": "way", "@id": 2, "name": "Mall", "shop": "mall"}, square), feature({"@type": "node", "@id": 3, "name": "No tag"}, {"type": "Point", "coordinates": [121.0, 14.5]}), feature({"@type": "node", "@id": 4, "name": "Far", "shop": "x"}, {"type": "Point", "coordinates": [10.0, 14.5]})]
    (tmp_path / "x.geojsonseq").write_text("".join("\x1e" + x + "\n" for x in lines))
    got = {r.source_id: r for r in places.osm(spark, str(tmp_path)).collect()}
    assert set(got) == {"node/1", "way/2"} and got["node/1"].category == "amenity=cafe | shop=bakery" and 121.0 < got["way/2"].lon < 121.2


def _obs(spark):
    return fixture.observations(spark, "/root/testdata/sf0.01").select(*places.COLUMNS)


def test_tiles_and_build(spark, tmp_path, capsys):
    places.write_tiles(_obs(spark), str(tmp_path / "observations"), 1.0)
    some = places.read_tiles(spark, str(tmp_path / "observations"), [Tile(14, 120, 1.0)], ("fsq",))
    assert some.count() == 2000 and places.read_tiles(spark, str(tmp_path / "observations"), []).count() == 0
    args = ["--root", str(tmp_path)]
    assert cli.main([*args, "build", "--bbox", "119.0,13.0,122.0,16.0", "--name", "all here", "--sources", "all"]) == 0
    out = tmp_path / "outputs" / "bbox_all_here"
    assert (out / "run.json").exists() and "Foursquare" in (out / "ATTRIBUTION.txt").read_text()
    geoparquet.assert_geo(str(out / "canonical"))
    points = spark.read.parquet(str(out / "canonical"))
    assert {r.source_count: r[1] for r in points.groupBy("source_count").count().collect()} == {1: 592, 2: 999, 3: 581}
    assert cli.main([*args, "validate", "--bbox", "119.0,13.0,122.0,16.0", "--name", "all here"]) == 0
    assert cli.main([*args, "status"]) == cli.main([*args, "storage"]) == cli.main([*args, "doctor"]) == cli.main([*args, "clean", "--all"]) == 0
    assert out.exists() and cli.main([*args, "clean", "--all", "--yes"]) == 0 and not out.exists()
    with pytest.raises(cli.Refused):
        cli.removable(tmp_path / "observations", tmp_path)
    (tmp_path / "areas.json").write_text('{"manila": {"boxes": [[120.9, 14.5, 121.1, 14.7]]}}')
    with pytest.raises(SystemExit, match="close: manila"):
        cli.main([*args, "validate", "manilla"])
    with pytest.raises(SystemExit, match="name areas"):
        cli.main([*args, "validate"])
    capsys.readouterr()


def test_ingest_from_provider_files(spark, tmp_path, capsys):
    """Dated folders, land, pins, and the gate in front of the build."""
    import json

    obs = _obs(spark)
    c = F.col
    fsq = obs.where("source = 'fsq'").select(c("source_id").alias("fsq_place_id"), "name", F.array("category").alias("fsq_category_labels"), c("lon").alias("longitude"), c("lat").alias("latitude"), F.lit("PH").alias("country"), F.lit(None).cast("string").alias("date_closed"))
    for release in ("2025-12-31", "2026-02-01"):
        (fsq if release > "2026" else fsq.limit(1)).write.parquet(str(tmp_path / "raw" / "fsq" / f"dt={release}"))
    over = obs.where("source = 'overture'").select(c("source_id").alias("id"), F.struct(c("name").alias("primary")).alias("names"), F.struct(c("category").alias("primary")).alias("categories"), F.struct(c("lon").alias("xmin"), c("lat").alias("ymin")).alias("bbox"))
    over.write.parquet(str(tmp_path / "raw" / "overture" / "2026-01-21.0"))
    ring = [(119.5, 13.5), (121.5, 13.5), (121.5, 15.5), (119.5, 15.5), (119.5, 13.5)]
    spark.createDataFrame([("r", [{"x": x, "y": y} for x, y in ring])], "ring_id string, points array<struct<x: double, y: double>>").write.parquet(str(tmp_path / "land"))
    root = tmp_path / "root"
    where = ["--bbox", "119.0,13.0,122.0,16.0", "--name", "all"]
    at = lambda name: str(tmp_path / "raw" / name)
    assert cli.main(["--root", str(root), "ingest", *where, "--fsq", at("fsq"), "--overture", at("overture"), "--land", str(tmp_path / "land")]) == 0
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert said["releases"] == {"fsq": "2026-02-01", "overture": "2026-01-21.0"} and state.pin(root, "fsq") == "2026-02-01"
    assert places.read_tiles(spark, str(root / "observations")).groupBy("source").count().orderBy("source").collect() == [("fsq", 2000), ("overture", 1333)]
    assert cli.main(["--root", str(root), "build", *where, "--sources", "fsq,osm"]) == 2 and "osm: no release" in capsys.readouterr().err
    assert cli.main(["--root", str(root), "build", *where, "--sources", "fsq,overture"]) == 0
    assert spark.read.parquet(str(root / "outputs" / "bbox_all" / "observations")).count() == 3333
    over.limit(5).write.parquet(str(tmp_path / "raw" / "overture" / "2026-01-21.1"))
    assert cli.main(["--root", str(root), "ingest", *where, "--overture", at("overture")]) == 2 and "pinned to 2026-01-21.0" in capsys.readouterr().err
    assert state.newest(spark, str(tmp_path / "raw")) is None
    (root / "areas.yml").write_text("manila:\n  boxes:\n  - [120.9, 14.5, 121.1, 14.7]\n")
    assert cli.areas(root)["manila"]["boxes"] == [[120.9, 14.5, 121.1, 14.7]]
    capsys.readouterr()


def test_stream_moves_an_id(spark, tmp_path):
    """A row that a later batch puts into another tile no longer matches where it was, and is not matched by what comes there."""
    one = lambda i, s, lon: (s, i, "jollibee ayala", None, lon, 14.5, None, None, "jollibee ayala", "ayala jollibee")
    batches = [[one("a", "fsq", 120.1), one("b", "osm", 120.1)], [one("a", "fsq", 122.1)], [one("c", "overture", 120.1), one("d", "osm", 122.1)]]
    paths = {n: str(tmp_path / n) for n in ("incoming", "table", "edges", "check")}
    for rows in batches:
        spark.createDataFrame(rows, places.SCHEMA).coalesce(1).write.mode("append").parquet(paths["incoming"])
        incremental.start(spark, paths["incoming"], paths["table"], paths["edges"], paths["check"]).awaitTermination()
    got = {(r.left_source_id, r.right_source_id) for r in incremental.current_edges(spark, paths["edges"], paths["table"]).collect()}
    assert got == {("c", "b"), ("a", "d")}
    read = incremental.around(spark.createDataFrame([one("x", "fsq", 122.1)], places.SCHEMA), spark.read.parquet(paths["table"]))
    assert {r.source_id for r in read.collect()} == {"a", "d"} and "PartitionFilters: [isnotnull(tile_x" in read._jdf.queryExecution().explainString(read._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_stream_equals_batch(spark, tmp_path):
    obs = _obs(spark).where("lon < 120.2")
    half = F.crc32("source_id") % 2 == 0
    paths = {n: str(tmp_path / n) for n in ("incoming", "table", "edges", "check")}
    for part in (obs.where(half), obs.where(~half)):
        part.coalesce(1).write.mode("append").parquet(paths["incoming"])
        q = incremental.start(spark, paths["incoming"], paths["table"], paths["edges"], paths["check"])
        q.awaitTermination()
    got = {(r.left_source_id, r.right_source_id) for r in incremental.current_edges(spark, paths["edges"], paths["table"]).collect()}
    assert got == {(r.left_source_id, r.right_source_id) for r in match.edges(obs).collect()} and got


def test_a_dense_cell_loses_no_pair_and_scores_each_pair_of_names_once(spark, monkeypatch):
    """Many rows of few names at one place: the cell is dealt to several tasks, pairs are formed in slabs, names are remembered."""
    import numpy as np
    import pyarrow as pa

    from placelink.operators import pairs

    r = np.random.default_rng(4)
    names = ["jollibee makati", "jolibee makati", "seven eleven", "atm", "bank of manila", "manila bank of"]
    rows = [(s, f"{s}{i}", names[int(r.integers(6))], None, 121.0 + float(r.random()) * 0.003, 14.5 + float(r.random()) * 0.003, None, None) for s in ("fsq", "overture", "osm") for i in range(60)]
    obs = spark.createDataFrame(rows, "source string, source_id string, name string, category string, lon double, lat double, provenance string, upstream_license string")
    obs = obs.withColumn("name_norm", F.col("name")).withColumn("name_tokens", F.array_join(F.array_sort(F.split("name", " ")), " "))
    whole = {(x.left_source_id, x.right_source_id, x.score) for x in match.edges(obs).collect()}
    monkeypatch.setattr(pairs, "DENSE", 7)
    assert {(x.left_source_id, x.right_source_id, x.score) for x in match.edges(obs).collect()} == whole and whole

    scored = []
    monkeypatch.setattr(pairs, "jaro_winkler", lambda a, b, f=pairs.jaro_winkler: scored.extend(zip(a, b, strict=True)) or f(a, b))
    known = pairs.Scores()
    number = known.encode(pa.array([*names, None]))
    i, j = (np.array(x) for x in zip(*[(i, j) for i in range(7) for j in range(7)] * 3, strict=True))
    first, again = known.of(number[i], number[j]), known.of(number[i], number[j])
    assert len(scored) == 36 and np.array_equal(first, again, equal_nan=True) and np.isnan(first).sum() == 3 * 13

    at = pa.record_batch({"nx": [0] * 9, "ny": [0] * 9, "part": [0] * 9, "side": [0] * 4 + [1] * 5, "code": [1, 1, 1, 2, 2, 2, 4, 4, 4], "lon": [0.0] * 9, "lat": [0.0] * 9})
    monkeypatch.setattr(pairs, "SLAB", 3)
    slabs = list(pairs.near(at, 1.0, 1.0, 10.0, False))
    met = {(int(a), int(b)) for x, y, _ in slabs for a, b in zip(x, y, strict=True)}
    assert met == {(a, b) for a in range(3) for b in range(4, 9)} | {(3, b) for b in (6, 7, 8)} and len(slabs) == 4
    monkeypatch.setattr(pairs, "HELD", 2)
    cut = list(pairs.cells(iter([pa.record_batch({"nx": [1, 1, 2], "ny": [0] * 3, "part": [0] * 3}), pa.record_batch({"nx": [2, 2, 3], "ny": [0] * 3, "part": [0] * 3})])))
    assert [b.column("nx").to_pylist() for b in cut] == [[1, 1], [2, 2, 2], [3]]


def test_clusters_by_codes_and_by_nodes_are_the_same(spark):
    """Edges that carry the sources of their ends cluster as the sequential rule does, without a look at the nodes."""
    rnd = random.Random(11)
    codes = [rnd.choice([1, 2, 4]) for _ in range(300)]
    pairs = list({tuple(sorted(rnd.sample(range(300), 2))) for _ in range(700)})
    pairs = [p for p in pairs if codes[p[0]] != codes[p[1]]]
    nodes = spark.createDataFrame(list(enumerate(codes)), "row_id long, source_code int")
    edges = spark.createDataFrame([(a, b, i, codes[a], codes[b]) for i, (a, b) in enumerate(pairs)], "left_id long, right_id long, rank long, left_code int, right_code int")
    want = dict(enumerate(cluster.greedy(codes, pairs)))
    for df in (edges, edges.drop("left_code", "right_code")):
        assert {r.row_id: r.cluster_root for r in cluster.clusters(nodes, df).collect()} == want
    names = {1: "fsq", 2: "overture", 4: "osm"}
    obs = spark.createDataFrame([(i, names[k], f"n{i:03d}") for i, k in enumerate(codes)], "row_id long, source string, source_id string")
    made = spark.createDataFrame([(a, b, names[codes[a]], f"n{a:03d}", names[codes[b]], f"n{b:03d}", float(i % 3), 1.0, 2.0) for i, (a, b) in enumerate(pairs)], "left_id long, right_id long, left_source string, left_source_id string, right_source string, right_source_id string, score double, name_score double, distance_m double")
    ranks = lambda by_id: {(r.left_id, r.right_id): (r.rank, r.left_code, r.right_code) for r in cluster.ranked(made, by_id).collect()}
    assert ranks(True) == ranks(False) and {v[1:] for v in ranks(True).values()} <= {(a, b) for a in (1, 2, 4) for b in (1, 2, 4)}
    assert cluster.identified(made, obs).count() == len(pairs)
    with pytest.raises(cluster.EdgeResolutionError):
        cluster.identified(made, obs.union(obs.where("row_id = %d" % pairs[0][0])))


def test_current_edges_are_read_off_bits_without_a_shuffle(spark, tmp_path):
    """Three batches, each of which replaces rows of earlier ones: edges meet no rows, only the bits of replaced ones."""
    from pyspark.sql import types as T

    rnd = random.Random(3)
    paths = {n: str(tmp_path / n) for n in ("incoming", "table", "edges", "check")}
    now = {}
    for n in range(3):
        rows = {}
        for k in rnd.sample(range(200), 90):
            s, name = ("fsq", "overture", "osm")[k % 3], rnd.choice(["jollibee ayala", "jolibee ayala", "mang inasal"])
            rows[k] = (s, f"{s}{k}", name, None, 121.0 + rnd.randrange(3) * 0.3 + rnd.random() * 0.002, 14.5, None, None, name, " ".join(sorted(name.split())))
        now.update(rows)
        spark.createDataFrame(list(rows.values()), places.SCHEMA).write.mode("append").parquet(paths["incoming"])
        incremental.start(spark, paths["incoming"], paths["table"], paths["edges"], paths["check"]).awaitTermination()
    current = incremental.current_edges(spark, paths["edges"], paths["table"])
    ids = lambda df: Counter((r.left_source_id, r.right_source_id, round(r.score, 6)) for r in df.collect())
    assert ids(current) == ids(match.edges(spark.createDataFrame(list(now.values()), T.StructType(places.SCHEMA.fields)))) and current.count() < spark.read.parquet(paths["edges"]).count()
    assert "left_id" not in current.columns and "hashpartitioning" not in current._jdf.queryExecution().toString()
    rows = spark.read.parquet(paths["table"]).where("row IS NOT NULL")
    assert rows.count() == rows.select("row").distinct().count() == 270


def test_scores_are_worked_out_once_and_by_bits_as_by_places(monkeypatch):
    """However few pairs are remembered by key, a pair of few names is scored once. Scores by bits equal those by places."""
    import numpy as np
    import pyarrow as pa

    from placelink.functions import similarity
    from placelink.operators import pairs

    rnd = random.Random(8)
    words = list({bytes(rnd.choice(b"abcd \xff") for _ in range(rnd.choice([1, 2, 5, 9, 30, 63, 64]))) for _ in range(300)})
    left, right = zip(*[(a, b) for a in words[:60] for b in words if a != b], strict=True)
    assert np.array_equal(similarity.jaro_winkler(list(left), list(right)), similarity._chunk(list(left), list(right)))
    long = [w + b"x" * 60 for w in words[:40]]
    assert np.array_equal(similarity.jaro_winkler(long[:20] + words[:20], long[20:] + long[:20]), similarity._chunk(long[:20] + words[:20], long[20:] + long[:20]))

    scored = []
    monkeypatch.setattr(pairs, "jaro_winkler", lambda a, b, f=pairs.jaro_winkler: scored.extend(zip(a, b, strict=True)) or f(a, b))
    monkeypatch.setattr(pairs, "KNOWN", 10)
    names = pa.array(["jollibee makati", "makati jollibee" + pairs.MARK + "jollibee makati", "atm", None])
    got = []
    for wide in (pairs.WIDE, 2):
        monkeypatch.setattr(pairs, "WIDE", wide)
        known = pairs.Scores()
        number = known.encode(names)
        i, j = (np.array(x) for x in zip(*[(i, j) for i in range(4) for j in range(4)], strict=True))
        got += [known.of(number[i], number[j]), known.of(number[i], number[j])]
        if wide > 2:
            assert len(scored) == 9 + 5  # names, and tokens where they are others
    assert all(np.array_equal(got[0], x, equal_nan=True) for x in got[1:]) and got[0][1] == 1.0 and np.isnan(got[0]).sum() == 7
