import re

import numpy as np
import pytest

from placelink.llm import neardup, topk, warc
from placelink.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t, *_ in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            both = len(s & t)
            if both and 100 * both >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def near_rows(seed=3, groups=6):
    r = np.random.default_rng(seed)
    vocabulary = [f"t{i}" for i in range(400)]
    rows, k = [], 0
    for g in range(groups):
        base = list(r.choice(vocabulary, 120))
        for e in range(25):  # from untouched copies to texts around the threshold
            words = list(base)
            for p in r.integers(0, 120, e % 9):
                words[p] = f"new{k}_{p}"
            rows.append((1000 - k, " ".join(words).upper() if e % 4 else " ".join(words), "en", f"s{g}", 0))
            k += 1
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_by_brute_force(spark, folder, size, percent):
    rows = near_rows() + [(i, f"w{i} a b c d e", "en", "s", 0) for i in range(2000, 2030)] + [(3000, "two words", "en", "s", 0), (3001, "TWO  words", "en", "s", 0), (3002, "", "en", "s", 0), (3003, None, None, None, None), (3004, " \t", "en", "s", 0)]
    docs = spark.read.parquet(folder(documents=rows) + "/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, neardup.Plan(shingle=size, percent=percent)).collect()}
    assert got == brute_components(rows, size, percent)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_of_short_texts_by_brute_force(spark, folder, size, percent):
    """Texts of 8 to 20 words and the same with 1 to 4 words more: with 5 and 80 all pairs lie at the threshold."""
    rows = []
    for k in range(160):
        n, e = ((8, 1), (12, 2), (16, 3), (20, 4))[k % 4]
        words = [f"w{k}x{i}" for i in range(n)]
        rows += [(2 * k, " ".join(words), "en", "s", 0), (2 * k + 1, " ".join(words + [f"e{k}x{i}" for i in range(e)]), "en", "s", 0)]
    docs = spark.read.parquet(folder(documents=rows) + "/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, neardup.Plan(shingle=size, percent=percent)).collect()}
    assert got == brute_components(rows, size, percent)


def test_near_duplicates_odd_rows(spark, folder, odd_docs):
    docs = spark.read.parquet(folder(documents=odd_docs) + "/documents.parquet").selectExpr("*", "1 AS id", "2 AS bucket", "3 AS component_id", "4 AS __gone", "5 AS __row", "6 AS n_shingles")
    out = neardup.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8]
    assert neardup.op9_near_duplicates(spark, folder(documents=odd_docs)).count() == len(odd_docs)
    assert neardup.op9_near_duplicates(spark, folder(documents=[])).count() == 0


def test_one_of_each_tells_rows_of_one_id_apart(spark, folder):
    a, b, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abd")
    stay = [(7, b), (3, a), (9, d), (5, "said twice"), (2, ""), (2, "a text of the same id"), (2, None), (None, a), (None, a)]
    go = [(7, a), (9, a + " more"), (9, b), (5, "said  twice"), (2, "")]
    docs = spark.read.parquet(folder(documents=[(i, t, "en", "s", 0) for i, t in go + stay]) + "/documents.parquet")
    out = neardup.one_of_each(docs)
    assert out.columns == docs.columns
    said = lambda rows: sorted((i or 0, " ".join((t or "null").split())) for i, t in rows)
    assert said((r.doc_id, r.text) for r in out.collect()) == said(stay)


def edited_copies(n=260, length=90, seed=4):
    """One large group: copies with edits from few to so many that they fall below the threshold, one part joined only by a bridge."""
    r = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(length)]
    rows = []
    for k in range(n):
        words = list(base)
        for p in r.choice(length, int(r.integers(0, 9)), replace=False):
            words[p] = f"e{r.integers(0, 40)}"
        rows.append((k, " ".join(words), "en", "hot", 0))
    return rows


def test_large_group_of_edited_copies_stays_in_proportion(spark, folder, monkeypatch, size=5, percent=80):
    rows = edited_copies()
    plan = neardup.Plan(shingle=size, percent=percent)
    made = {}
    write = neardup.written

    def counted(df, name, *more):
        out = write(df, name, *more)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neardup, "written", counted)
    docs = spark.read.parquet(folder(documents=rows) + "/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, plan).collect()}
    assert got == brute_components(rows, size, percent)
    assert len({c for _, c in got.values()}) > 20  # many that no centre links
    each = max(n for n, _ in got.values())
    assert all(made[n] <= neardup.CENTRES * len(rows) for n in ("likely", "pairs", "links", "open-ids", "supported")), made
    assert all(made[n] <= plan.bands * len(rows) for n in ("grouped", "open-members")) and made.get("open-shingles", 0) <= each * len(rows)


def test_exact_end_by_brute_force(monkeypatch, spark):
    """Links across components come out whatever the blocks, and connect what brute force connects."""
    r = np.random.default_rng(9)
    base = r.integers(-(2**62), 2**62, 200)
    rows, sets = [], {}
    for i in range(120):
        keep = base[r.random(200) < (0.97 if i % 3 else 0.85)]
        sets[i] = set(keep.tolist()) | set(r.integers(-(2**62), 2**62, int(r.integers(0, 20))).tolist())
        rows.append((i, i if i % 4 else 0, len(sets[i]), np.array(sorted(sets[i], key=lambda x: x % 2**64), np.int64).tobytes()))
    frame = spark.createDataFrame(rows, "id long, c long, n long, s binary")
    plan = neardup.Plan(percent=80)
    monkeypatch.setattr(neardup, "BLOCK_KEYS", 2000)
    able = neardup.supported(frame.select("id", "c", "n"), frame.select("id", "s"), plan)
    links = neardup.across(able, spark.createDataFrame([(i, 0) for i in range(1, 120)], "v long, root long"), plan).collect()
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert links and all(near(x.a, x.b) and rows[x.a][1] != rows[x.b][1] for x in links)

    def roots(pairs):
        root = list(range(120))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in [*pairs, *[(0, i) for i in range(0, 120, 4)]]:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return [find(x) for x in range(120)]

    assert roots([(x.a, x.b) for x in links]) == roots([(a, b) for a in range(120) for b in range(a) if near(a, b)])
    blocks = [(np.array([k]), np.array([k]), np.array([3]), np.array(v), np.zeros(3, int)) for k, v in enumerate(([1, 2, 9], [2, 9, 11]))]
    assert neardup.in_common(*blocks, width=1).tolist() == [[2.0]]


def test_estimate_follows_similarity(spark):
    import pyarrow as pa

    plan = neardup.Plan(shingle=1, percent=80)
    words = [f"q{i}" for i in range(1000)]
    key, first = neardup.shingle_sets(pa.array([" ".join(words), " ".join(words[:800])]), 1)
    low = neardup.Minima(plan).packed(neardup.Minima(plan).of(key, first))
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(low[0].tolist(), low[1].tolist())], "a array<long>, b array<long>")
    assert abs(df.select(neardup.estimate(F.col("a"), F.col("b"), plan)).first()[0] - 0.8) < 0.06


def test_components(spark):
    r = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2)) if a != b] + [(i, i + 1) for i in range(1000, 1060)] + [(5000 + i, 4999) for i in range(50)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(v, v) == find(v) for v in root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_top(rows, k=5):
    ok = {}
    for i, v, _ in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v):
            ok[(i, tuple(v))] = np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)
    out = set()
    for (i, _), q in ok.items():
        if i % 50 == 0:
            best = sorted({(-int(q @ v), j) for (j, _), v in ok.items() if j != i})[:k]
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)}
    return out


def test_top_k_by_brute_force(spark, folder):
    r = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in r.normal(size=8).round(2)], 0) for i in range(700)]
    rows += [(1000 + i, rows[50][1], 1) for i in range(400)]  # a very common vector, with ties
    rows += [(1450, None, 0), (1500, [0.1] * 7, 0), (1550, [float("nan")] + [0.0] * 7, 0), (1600, [None] + [0.0] * 7, 0), (None, [1.0] * 8, 0), (1650, [float("inf")] * 8, 0), (7, rows[7][1], 0), (1700, [], 0)]
    got = [tuple(x) for x in topk.op5_top_k(spark, folder(embeddings=rows)).collect()]
    assert set(got) == brute_top(rows) and len(got) == len(set(got))
    assert topk.op5_top_k(spark, folder(embeddings=[])).count() == 0
    one = [(50, [1.0] * 8, 0), (51, [2.0] * 8, 0)]
    assert [tuple(x) for x in topk.op5_top_k(spark, folder(embeddings=one)).collect()] == [(50, 1, 51, 256 * 512 * 8)]


def test_top_k_prunes():
    r = np.random.default_rng(1)
    centres = r.normal(size=(6, 8)) * 5
    v = np.floor(256 * np.concatenate([c / np.linalg.norm(c) + r.normal(size=(200, 8)) * 0.005 for c in centres])).astype(np.int64)
    space = topk.Space(v[::200], float(np.max(np.sum(v.astype(float) ** 2, axis=1))))
    d = space.of_vectors(v)
    cell = d.argmin(axis=1)
    blocks = [(d[cell == c].min(axis=0), d[cell == c].max(axis=0), np.flatnonzero(cell == c).astype("<i8").tobytes(), v[cell == c].tobytes()) for c in np.unique(cell)]
    best, visited = topk.search_lane(blocks, v[:5], np.arange(5), space, 3, 8)
    score = topk.inner(v[:5], v)
    score[np.arange(5), np.arange(5)] = -(10**15)
    want = {(i, int(j)) for i in range(5) for j in np.lexsort((np.arange(len(v)), -score[i]))[:3]}
    assert {(int(a), int(b)) for a, b in zip(best.q, best.id, strict=True)} == want and visited < 5 * len(blocks)
    again, fewer = topk.search_lane(blocks, v[:5], np.arange(5), space, 3, 8, best.least)
    assert set(zip(again.q, again.id, strict=True)) == set(zip(best.q, best.id, strict=True)) and 5 <= fewer <= visited


def test_top_k_sends_queries_only_to_lanes_in_reach(spark, folder, monkeypatch):
    """Tight clusters: the notes of the blocks rule most lanes out before a vector moves."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(12, 8))
    rows = [(i, [float(x) for x in (centres[i % 12] / np.linalg.norm(centres[i % 12]) + r.normal(size=8) * 0.002)], 0) for i in range(1200)]
    monkeypatch.setattr(topk, "LANE_BLOCKS", 1)
    sent, write = {}, topk.written

    def counted(df, name, *more):
        out = write(df, name, *more)
        sent[name] = out.count()
        return out

    monkeypatch.setattr(topk, "written", counted)
    at = folder(embeddings=rows)
    got = [tuple(x) for x in topk.top_k(spark.read.parquet(at + "/embeddings.parquet").selectExpr("*", "1 AS lane", "2 AS id", "3 AS score")).collect()]
    assert set(got) == brute_top(rows) and len(got) == 5 * 24
    assert sent["reach"] < 0.5 * sent["queries"] * sent["index"], sent


def test_top_k_meets_all_notes_and_passes(spark, folder, monkeypatch):
    """More notes than one group holds, dealt to partitions that are not put together again; queries in several passes."""
    r = np.random.default_rng(9)
    rows = [(50 * i, [float(x) for x in r.normal(size=8).round(2)], 0) for i in range(500)]
    monkeypatch.setattr(topk, "NOTES", 120)
    monkeypatch.setattr(topk, "PASS", 70, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(x) for x in topk.op5_top_k(spark, folder(embeddings=rows)).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(got) == brute_top(rows) and len(got) == 5 * 500
    none = [(row[0] + 1, *row[1:]) for row in rows]
    assert topk.op5_top_k(spark, folder(embeddings=none)).count() == 0


def brute_pages(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = i is not None and i != first[h or ""]
        out.append((i, len(raw), warc.digest32(raw), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=str)


PAGES = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://b/\r\nX: y", ""), (5, "", "x" * 400_000), (5, "", "x" * 400_000), (None, "http://c", "<p>é</p>"), (-7, "http://d", "\r\n\r\nWARC/1.1\r\n\r\n")]


def test_warc_round_trip(spark, folder):
    got = warc.op10_warc(spark, folder(pages=PAGES)).collect()
    assert sorted(map(tuple, got), key=str) == brute_pages(PAGES)
    assert warc.op10_warc(spark, folder(pages=[])).count() == 0


def test_warc_pushdown_and_foreign_archives(spark, tmp_path):
    import gzip

    warc.register(spark)
    one = warc.record("response", "urn:x:1", "http://a/", "2024-01-01T00:00:00Z", b"hello")
    two = warc.record("revisit", "urn:x:2", "http://b/", "2024-01-01T00:00:00Z", b"hello", "urn:x:1")
    three = warc.record("response", "urn:x:3", None, "2024-01-01T00:00:00Z", b"y" * 300_000)
    (tmp_path / "a.warc").write_bytes(one + two + three)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, (one, two, three))))
    (tmp_path / "c.warc.gz").write_bytes(b"".join(map(warc.member, (one, two, three))))
    df = spark.read.format("warc").option("verify", "true").load(str(tmp_path))
    rows = df.collect()
    assert len(rows) == 9 and sorted({bytes(r.payload) for r in rows if r.payload is not None}) == [b"hello", b"y" * 300_000] and {r.payload_bytes for r in rows} == {5, 300_000}
    assert {r.record_id for r in df.where("record_type = 'revisit'").collect()} == {"urn:x:2"}
    assert df.where("target_uri = 'http://a/' AND status = 200").count() == 3 and df.where("record_id IN ('urn:x:1', 'urn:x:3')").count() == 6
    plan = df.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]  # taken over by the source whole
    reader = warc.WarcReader({"path": str(tmp_path / "c.warc.gz")})
    reader.tests = [("record_type", "=", "revisit")]
    assert [r[1] for p in reader.partitions() for r in reader.read(p)] == ["urn:x:2"]
    bad = bytearray(one)
    bad[bad.index(b"hello")] = ord("j")
    (tmp_path / "d.warc").write_bytes(bytes(bad))
    with pytest.raises(Exception, match="does not match its digest"):
        spark.read.format("warc").option("verify", "true").load(str(tmp_path / "d.warc")).collect()


def test_warc_long_payloads_and_rolled_archives(spark, folder, tmp_path):
    import io
    import time

    took = []
    for size in (8 << 20, 32 << 20):
        body = np.random.default_rng(0).integers(0, 255, size, dtype=np.uint8).tobytes()
        plain = warc.record("response", "urn:x", "http://a/", "2024-01-01T00:00:00Z", body)
        began = time.perf_counter()
        for raw in (plain * 2, warc.member(plain) * 2):
            seen = 0
            for reader in warc.Source(io.BytesIO(raw), raw[:2]).records():
                reader.head(), reader.block_head()
                assert reader.rest() == body
                seen += 1
            assert seen == 2
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 0.5, took
    warc.register(spark)
    rows = spark.createDataFrame([("response", f"urn:placelink:page:{i}", None, "http://a/", "2024-01-01T00:00:00Z", bytes([i]) * 3000, 7) for i in range(40)], "record_type string, record_id string, refers_to string, target_uri string, date string, payload binary, status int")
    rows.coalesce(1).write.format("warc").option("archive_bytes", "2000").mode("append").save(str(tmp_path / "rolled"))
    assert len(list((tmp_path / "rolled").iterdir())) > 2 and spark.read.format("warc").option("verify", "true").load(str(tmp_path / "rolled")).count() == 40
