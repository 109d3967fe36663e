"""Command line: ingest, build, status, validate, attribution, areas, storage, clean, doctor.

``ingest`` makes the tiled observation table under the root from provider files that Spark can read, pins their releases and notes
which tiles are covered; ``build`` then refuses tiles that are not, and releases other than the pins. A table made in another
way (``placelink.sources.places.write_tiles``) has no such note and is taken as it is.
"""

from __future__ import annotations

import argparse
import difflib
import importlib.util
import json
import math
import shutil
import sys
import uuid
from pathlib import Path

from placelink import __version__
from placelink.plans import attribution, state
from placelink.plans.scope import PH_BOX, Scope, sources_of, tile_columns, tiles
from placelink.plans.storage import read_json, sealed, write_json

REMOVABLE = ("outputs", "stages")


class Refused(RuntimeError):
    """A removal that is not plainly within the root."""


def areas(root: Path) -> dict[str, dict]:
    """name -> {"boxes": [[w, s, e, n], ...]} from areas.yml or areas.json under the root."""
    if (root / "areas.yml").exists():
        import yaml

        return yaml.safe_load((root / "areas.yml").read_text(encoding="utf-8")) or {}
    return read_json(root / "areas.json") or {}


def target(args: argparse.Namespace, root: Path) -> Scope:
    chosen = [bool(args.areas), args.national, args.bbox is not None]
    if sum(chosen) != 1:
        raise SystemExit("name areas, or --national, or --bbox with --name")
    if args.national:
        return Scope("national", (PH_BOX,), True)
    if args.bbox is not None:
        box = tuple(float(x) for x in args.bbox.split(","))
        if len(box) != 4 or not args.name:
            raise SystemExit("--bbox takes west,south,east,north and needs --name")
        return Scope("bbox_" + "".join(x if x.isalnum() else "_" for x in args.name), (box,))
    known, boxes = areas(root), []
    for name in args.areas:
        if name not in known:
            close = difflib.get_close_matches(name, list(known), 3)
            raise SystemExit(f"no area {name}" + (f"; close: {', '.join(close)}" if close else ""))
        boxes += [tuple(b) for b in known[name]["boxes"]]
    return Scope(",".join(args.areas), tuple(boxes))


def output(root: Path, scope: Scope) -> Path:
    return root / "outputs" / scope.slug


def ingest(args: argparse.Namespace, root: Path) -> int:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from placelink.operators import canonical
    from placelink.sources import places

    scope = target(args, root)
    spark = SparkSession.builder.appName("placelink").getOrCreate()
    land = places.boundary_edges(spark.read.parquet(args.land)) if args.land else None
    grid = tiles(scope.boxes, args.tile)
    on = places.tiles_on_land(spark, grid, land) if land is not None else None  # an area's tile list
    parts, releases = [], {}
    for source, path in (("fsq", args.fsq), ("overture", args.overture), ("osm", args.osm)):
        if path is None:
            continue
        found = state.newest(spark, path) if source != "osm" else None
        release, folder = found or (args.release, path)
        if release is None:
            raise state.StateError(f"{source}: no dated folder in {path}, and no --release")
        if source == "osm":
            rows = places.osm(spark, folder)
        else:
            raw = spark.read.parquet(folder)
            if source == "overture" and "lon" not in raw.columns:
                raw = raw.withColumns({"lon": F.col("bbox.xmin"), "lat": F.col("bbox.ymin")})  # a point's box
            rows = places.overture(raw, scope, land) if source == "overture" else places.foursquare(raw, scope)
        rows = rows.where(scope.contains(F.col("lon"), F.col("lat")))
        if on is not None:
            x, y = tile_columns(F.col("lon"), F.col("lat"), args.tile)
            rows = rows.join(F.broadcast(on), (x == F.col("tile_x")) & (y == F.col("tile_y")), "left_semi")
        parts.append(rows)
        releases[source] = release
    if not parts:
        raise state.StateError("name the files of one source at least")
    for source, release in releases.items():
        state.adopt(root, source, release, args.replace)
    places.write_tiles(canonical.unified(parts), str(root / "observations"), args.tile)
    note = read_json(root / "observations.json") or {"sources": {}}
    for source, release in releases.items():
        former = note["sources"].get(source, {})
        kept = former.get("tiles", []) if former.get("release") == release and former.get("tile") == args.tile else []
        note["sources"][source] = {"release": release, "tile": args.tile, "tiles": sorted({*kept, *(t.key for t in grid)})}
    write_json(root / "observations.json", note)
    print(json.dumps({"releases": releases, "tiles": len(grid)}))
    return 0


def covered(root: Path, sources: tuple[str, ...], grid: list) -> dict | None:
    """The gate before matching: every tile of every source is there, if empty, of the pinned release. None where no note says what is there."""
    note = read_json(root / "observations.json")
    if note is None:
        return None
    have = {s: set(x["tiles"]) for s, x in note["sources"].items()}
    return state.snapshot(root, sources, grid, have, {s: x["release"] for s, x in note["sources"].items()})


def build(args: argparse.Namespace, root: Path) -> int:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from placelink.operators import canonical, cluster, match, validate
    from placelink.plans.storage import settled
    from placelink.sources import geoparquet, places

    scope, sources = target(args, root), sources_of(args.sources)
    cfg = match.MatchConfig(args.max_distance)
    spark = SparkSession.builder.appName("placelink").getOrCreate()
    grid = tiles(scope.boxes, args.tile)
    gate = covered(root, sources, grid)
    inputs = {"snapshot": gate, "scope": scope.name, "boxes": scope.boxes, "sources": sources, "match": cfg.describe(), "tiles": sealed([t.key for t in grid]), "releases": {s: state.pin(root, s) for s in sources}}
    obs_in = places.read_tiles(spark, str(root / "observations"), grid, sources).where(scope.contains(F.col("lon"), F.col("lat")))
    stage = state.Stage(root / "stages", "edges", inputs)
    if args.rebuild:
        stage.discard()
    if stage.manifest is None:
        found = match.edges(obs_in, cfg, sources)
        found.write.mode("overwrite").option("compression", "zstd").parquet(stage.table)
        stage.complete(edges=spark.read.parquet(stage.table).count(), pairs=match.pair_names(sources))
    obs = settled(canonical.observations(obs_in, scope))
    edges = cluster.resolved(spark.read.parquet(stage.table), obs)
    roots = settled(cluster.clusters(obs.select("row_id", "source_code"), cluster.ranked(edges)))
    final = settled(canonical.match_edges(edges, roots))
    points = settled(canonical.canonical(obs, roots, final))
    whole = output(root, scope)
    out = whole.with_name(f".{whole.name}.{uuid.uuid4().hex}")  # takes the former one's place when all of it is there
    obs.write.parquet(str(out / "observations"))
    final.write.parquet(str(out / "match_edges"))
    geoparquet.write(spark, points, str(out / "canonical"))
    counts = canonical.summary(points, obs, final).first().asDict()
    counts["evidence_tiers"] = {r[0]: r[1] for r in canonical.tier_counts(points).collect()}
    observed = {r["source"]: r["licences"] for r in validate.observed_licences(points).collect()}
    write_json(out / "summary.json", counts | {"sources": inputs["releases"]})
    (out / "ATTRIBUTION.txt").write_text(attribution.text(scope.name, sources, inputs["releases"], observed), encoding="utf-8")
    write_json(out / "run.json", {"version": __version__, "active_sources": list(sources), "git_dirty": None, "scope": scope.name, "boxes": scope.boxes, "pairs": match.pair_names(sources), "tile": args.tile, "licensing": attribution.block(sources, inputs["releases"], observed), "summary": counts})
    former = whole.with_name(out.name + ".former")
    if whole.exists():
        whole.rename(former)
    out.rename(whole)
    shutil.rmtree(former, ignore_errors=True)
    print(json.dumps(counts, default=str))
    return 0


def check(args: argparse.Namespace, root: Path) -> int:
    from pyspark.sql import SparkSession

    from placelink.operators import validate

    scope = target(args, root)
    out = output(root, scope)
    if not (out / "canonical").exists():
        print(f"nothing is built for {scope.name}")
        return 1
    points = SparkSession.builder.appName("placelink").getOrCreate().read.parquet(str(out / "canonical"))
    got = validate.report(points, scope, sources_of(args.sources) if args.sources else None, read_json(out / "run.json"), args.strict)
    print(json.dumps(got, indent=2, default=str))
    return 0 if got["ok"] else 1


def size(path: Path) -> int:
    return sum(p.stat().st_size for p in path.rglob("*") if p.is_file() and not p.is_symlink())


def removable(path: Path, root: Path) -> Path:
    inside = [root / x for x in REMOVABLE]
    if path.is_symlink() or not any(path.resolve().is_relative_to(x.resolve()) and path.resolve() != x.resolve() for x in inside):
        raise Refused(f"{path} is not within {', '.join(REMOVABLE)}")
    return path


def clean(args: argparse.Namespace, root: Path) -> int:
    found = [p for x in REMOVABLE if (root / x).exists() and (x != "stages" or args.stages) for p in sorted((root / x).iterdir()) if x == "stages" or args.all or p.name in args.areas]
    for p in found:
        print(f"{size(removable(p, root)):>14} {p}")
    if not args.yes:
        print("a preview: --yes removes them")
        return 0
    for p in found:
        shutil.rmtree(removable(p, root))
    return 0


def status(args: argparse.Namespace, root: Path) -> int:
    for p in sorted((root / "outputs").glob("*/summary.json")):
        print(p.parent.name, json.dumps(read_json(p), default=str))
    return 0


def doctor(args: argparse.Namespace, root: Path) -> int:
    need = {m: importlib.util.find_spec(m) is not None for m in ("pyspark", "pyarrow", "pandas", "numpy")} | {"java": shutil.which("java") is not None}
    free = shutil.disk_usage(root if root.exists() else Path.cwd()).free / 2**30
    print(json.dumps({"have": need, "free_gib": round(free, 1), "enough_disk": free > 2, "root": str(root)}))
    return 0 if all(need.values()) and math.isfinite(free) else 1


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="placelink")
    top.add_argument("--root", type=Path, default=Path.cwd())
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, targeted: bool = False) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("areas", nargs="*")
        if targeted:
            p.add_argument("--national", action="store_true")
            p.add_argument("--bbox")
            p.add_argument("--name")
            p.add_argument("--sources")
        return p

    i = command("ingest", ingest, True)
    for flag in ("--fsq", "--overture", "--osm", "--land", "--release"):
        i.add_argument(flag)
    i.add_argument("--tile", type=float, default=1.0)
    i.add_argument("--replace", action="store_true")
    b = command("build", build, True)
    b.add_argument("--max-distance", type=float, default=120.0)
    b.add_argument("--tile", type=float, default=1.0)
    b.add_argument("--rebuild", action="store_true")
    command("validate", check, True).add_argument("--strict", action="store_true")
    command("attribution", lambda a, r: print((output(r, target(a, r)) / "ATTRIBUTION.txt").read_text()) or 0, True)
    command("status", status)
    command("areas", lambda a, r: print("\n".join(sorted(areas(r)))) or 0)
    command("storage", lambda a, r: print("\n".join(f"{size(r / x):>14} {x}" for x in (*REMOVABLE, "observations") if (r / x).exists())) or 0)
    x = command("clean", clean)
    for flag in ("--yes", "--all", "--stages"):
        x.add_argument(flag, action="store_true")
    command("doctor", doctor)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args, args.root)
    except (ValueError, Refused, state.StateError) as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
