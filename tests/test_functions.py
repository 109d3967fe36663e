import math
import random

import pytest
from pyspark.sql import functions as F

from placelink.functions import geo, licence, similarity, text
from placelink.operators import match
from placelink.plans import catalogue

SF = "/root/testdata/sf0.001"
NAMES = ["José's Café & Grill", "Niño's Carinderia", "7‑Eleven", "Ångström", "İloilo Supermart", "ＳＭ Ｍａｌｌ", "ﬁesta mart", "Straße 7", "K² Studio", "新光 Shin Kong", "", "  ", None]


def test_normalized_column_equals_python(spark):
    rnd = random.Random(1)
    names = NAMES + ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x300, 0x370), rnd.randrange(0x1E00, 0x1F00)])) for _ in range(12)) for _ in range(400)]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", text.normalized(F.col("n")).alias("x")).collect()
    assert all(r.x == text.normalized_text(r.n) for r in rows)
    by = {r.n: r.x for r in rows}
    assert by["José's Café & Grill"] == "jose s cafe and grill" and by["ＳＭ Ｍａｌｌ"] == "" and by["ﬁesta mart"] == "esta mart" and by["新光 Shin Kong"] == "shin kong"


def test_normalized_equals_duckdb():
    import duckdb

    names = [n for n in NAMES if n is not None] + ["".join(map(chr, range(a, a + 16))) for a in range(0xA0, 0x600, 16)]
    got = duckdb.connect().execute("SELECT trim(regexp_replace(lower(strip_accents(replace(n, '&', ' and '))), '[^a-z0-9]+', ' ', 'g')) FROM (SELECT unnest(?) AS n)", [names]).fetchall()
    assert [r[0] for r in got] == [text.normalized_text(n) for n in names]


def test_jaro_winkler():
    rows = [("jollibee", "jolibee"), ("martha", "marhta"), ("", ""), ("a", ""), ("é", "è"), ("abc", "abc"), ("dwayne", "duane"), ("abcd", "xyz")]
    import duckdb

    want = [duckdb.connect().execute("SELECT jaro_winkler_similarity(?, ?)", list(r)).fetchall()[0][0] for r in rows]
    got = similarity.jaro_winkler([a.encode() for a, _ in rows], [b.encode() for _, b in rows])
    assert all(abs(a - b) < 1e-12 for a, b in zip(want, got, strict=True))
    assert len(similarity.jaro_winkler([], [])) == 0


def test_one_long_name_holds_up_no_other():
    import time

    rnd = random.Random(3)
    name = lambda n: "".join(rnd.choice("abcde fgh") for _ in range(n)).encode()
    left, right = ([name(rnd.randrange(1, 25)) for _ in range(4096)] for _ in "lr")
    want = similarity.jaro_winkler(left, right)
    took = []
    for n in (20, 2000):
        left[5], right[5] = name(n), name(n)
        began = time.perf_counter()
        got = similarity.jaro_winkler(left, right)
        took.append(time.perf_counter() - began)
    assert all(a == b for i, (a, b) in enumerate(zip(got, want, strict=True)) if i != 5) and took[1] < took[0] + 2, took


def test_upper_bound_of_the_name_score(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeilor") for _ in range(rnd.randrange(1, 9)))
    rows = []
    for _ in range(3000):
        a = " ".join(word() for _ in range(rnd.randrange(1, 4)))
        b = a[: rnd.randrange(1, len(a) + 1)].strip() or "x" if rnd.random() < 0.4 else " ".join(word() for _ in range(rnd.randrange(1, 4)))
        rows.append((a, b, " ".join(sorted(a.split())), " ".join(sorted(b.split()))))
    c = F.col
    df = spark.createDataFrame(rows, "a string, b string, ta string, tb string")
    got = df.select(similarity.best_jw(c("a"), c("b"), c("ta"), c("tb"), 0.0).alias("s"), similarity.most_jw(c("a"), c("b"), c("ta"), c("tb"), similarity.letters(c("a")), similarity.letters(c("b"))).alias("most")).collect()
    assert all(r.s <= r.most for r in got) and sum(r.most < 0.82 for r in got) > 300


def test_jw_nulls_and_cutoff(spark):
    df = spark.createDataFrame([("abc", "abc"), ("abc", None), (None, None), ("abcd", "xyz")], "a string, b string")
    assert [r[0] for r in df.select(similarity.jw(F.col("a"), F.col("b"), 0.65)).collect()] == [1.0, None, None, 0.0]


PROVENANCE = [
    ("[{'property': '', 'dataset': Foursquare, 'record_id': x}]", "Apache-2.0", True), ("[{'property': '', 'dataset': meta, 'record_id': dac1}]", "CDLA-Permissive-2.0", False),
    ("[{'property': '', 'dataset': AllThePlaces, 'record_id': x}]", "CC0-1.0", False), ("[{'dataset': NewProvider, 'record_id': dac}]", "UNKNOWN", False),
    ("[{'dataset': meta, 'record_id': a}, {'dataset': Foursquare, 'record_id': b}]", "MIXED/REVIEW", True), ("[{'dataset': 'Foo, Bar', 'record_id': b}]", "UNKNOWN", False),
    ("plain fsq text", "Apache-2.0", True), ("fsqx", "UNKNOWN", False), (None, "UNKNOWN", False),
]


def test_licences(spark):
    df = spark.createDataFrame([(p,) for p, _, _ in PROVENANCE], "p string")
    got = df.select(licence.overture_licence(F.col("p")), licence.declares_fsq(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(a, b) for _, a, b in PROVENANCE]


@pytest.mark.parametrize("radius", [5.0, 10.0, 30.0, 60.0, 120.0, 200.0])
def test_acceptance_column_equals_python(spark, radius):
    rnd = random.Random(int(radius))
    names = ["jollibee", "atm", "bdo", "market", "", "seven eleven"]
    rows = [(rnd.uniform(0, radius * 1.1), rnd.choice([0.6, 0.7, 0.82, 0.9, 0.94, 0.99, 1.0, rnd.random()]), rnd.choice(names), rnd.choice(names)) for _ in range(1500)]
    rows += [(d, s, a, a) for d in (0.0, 15.0, 20.0, 50.0, 90.0, radius) for s in (0.7, 0.82, 0.9, 0.94, 0.99) for a in ("jollibee", "atm") if d <= radius]
    rows = [r for r in rows if r[0] <= radius]
    c = F.col
    df = spark.createDataFrame(rows, "d double, s double, a string, b string").withColumn("ok", match.accepted(c("d"), c("s"), c("a"), c("b"), radius))
    assert all(r.ok == match.accepts(r.d, r.s, r.a, r.b, radius) for r in df.collect())


def test_config_and_grid_coverage():
    for bad in (0, -1, math.nan, math.inf):
        with pytest.raises(ValueError):
            match.MatchConfig(bad)
    with pytest.raises(ValueError):
        match.MatchConfig(120, 0.99)
    cfg = match.MatchConfig()
    assert 0.0011 < cfg.cell < 0.0013
    for lat in (4.5, 12.0, 21.2):  # no point within the radius is farther than a cell
        assert 120 / (111_320 * math.cos(math.radians(lat))) <= cfg.cell and 120 / 110_574 <= cfg.lat_span <= cfg.cell


def test_wkb_and_land(spark):
    import struct

    raw = spark.range(1).select(geo.wkb_point(F.lit(121.5), F.lit(14.25))).first()[0]
    assert struct.unpack("<bIdd", bytes(raw)) == (1, 1, 121.5, 14.25)
    edges = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([("in", 0.5, 0.5), ("coast", 1.001, 0.5), ("sea", 1.05, 0.5), ("corner", 1.001, 1.001)], "point_id string, lon double, lat double")
    assert {r.point_id for r in geo.on_land(points, edges, 0.002).collect()} == {"in", "coast", "corner"}


def test_land_by_cells_equals_brute_force(spark):
    """A ragged ring with a hole, points all over and close to the edges."""
    rnd = random.Random(4)
    ring = [(math.cos(a / 40 * 2 * math.pi) * r, math.sin(a / 40 * 2 * math.pi) * r) for a in range(40) for r in [0.2 + 0.25 * rnd.random()]]
    hole = [(-0.05, -0.06), (0.07, -0.04), (0.03, 0.08)]
    edges = [(*p, *q) for r in (ring, hole) for p, q in zip(r, [*r[1:], r[0]], strict=True)]
    points = [(i, rnd.uniform(-0.5, 0.5), rnd.uniform(-0.5, 0.5)) for i in range(1500)]
    points += [(2000 + i, e[0] + t * (e[2] - e[0]) + rnd.uniform(-0.004, 0.004), e[1] + t * (e[3] - e[1]) + rnd.uniform(-0.004, 0.004)) for i, e in enumerate(edges * 8) for t in [rnd.random()]]
    tolerance, want = 0.002, set()
    for i, x, y in points:
        odd, near = False, False
        for x1, y1, x2, y2 in edges:
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                odd = not odd
            dx, dy = x2 - x1, y2 - y1
            t = min(1.0, max(0.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
            near = near or (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2 <= tolerance**2
        if odd or near:
            want.add(i)
    got = geo.on_land(spark.createDataFrame(points, "point_id long, lon double, lat double"), spark.createDataFrame(edges, "x1 double, y1 double, x2 double, y2 double"), tolerance)
    assert {r.point_id for r in got.collect()} == want and 300 < len(want) < len(points) - 300


def test_whole_texts_are_normalized(spark):
    docs = {r.doc_id: text.normalized_text(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.name_norm for r in catalogue.norm_names(spark, SF).collect()} == docs
    tokens = {i: None if t is None else " ".join(sorted(t.split(" "))) for i, t in docs.items()}
    assert {r.doc_id: r.name_tokens for r in catalogue.name_tokens(spark, SF).collect()} == tokens
    assert max(len(t.split()) for t in docs.values() if t) > 1000


def test_wkb_query_reads_every_coordinate(spark, monkeypatch):
    assert catalogue.wkb_points(spark, SF).where("NOT same OR same IS NULL").isEmpty()
    right = geo.wkb_point
    for wrong in (lambda lon, lat: right(lat, lon), lambda lon, lat: right(lon, lat + 1e-9)):
        monkeypatch.setattr(geo, "wkb_point", wrong)
        assert catalogue.wkb_points(spark, SF).where("same").isEmpty()


def test_surface_point():
    x, y = geo.surface_point([[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]])
    assert 0 < x < 4 and 0 < y < 4 and not (1 < x < 3 and 1 < y < 3)
