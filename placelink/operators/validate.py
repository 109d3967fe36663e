"""Structural checks of a canonical layer: what must hold, and what is worth a warning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelink.functions import text
from placelink.plans.scope import SOURCES, Scope

REQUIRED = ("canonical_id", "canonical_name", "lon", "lat", "source_count", "evidence_tier")


def member_columns(points: DataFrame) -> list[str]:
    return [f"{s}_id" for s in SOURCES if f"{s}_id" in points.columns]


def counts(points: DataFrame, scope: Scope) -> DataFrame:
    """One row of all counts, by one aggregate."""
    if missing := [x for x in REQUIRED if x not in points.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    c = F.col
    members = sum((c(m).isNotNull().cast("int") for m in member_columns(points)), F.lit(0))
    return points.agg(
        F.count("*").alias("n_rows"), F.countDistinct("canonical_id").alias("unique_ids"),
        (F.count("*") - F.countDistinct("canonical_id")).alias("duplicate_canonical_ids"),
        F.count_if(c("canonical_id").isNull()).alias("null_canonical_ids"), F.count_if(text.blank(c("canonical_name"))).alias("missing_names"),
        F.count_if(c("lon").isNull() | c("lat").isNull()).alias("missing_coordinates"),
        F.count_if((c("lon") < -180) | (c("lon") > 180) | (c("lat") < -90) | (c("lat") > 90)).alias("coordinates_out_of_range"),
        F.count_if(~scope.contains(c("lon"), c("lat"))).alias("outside_requested_scope"), F.count_if(c("source_count") != members).alias("source_count_mismatches"),
        F.count_if((c("lon") == 0) & (c("lat") == 0)).alias("null_island_coordinates"), F.count_if(c("evidence_tier").isNull()).alias("null_evidence_tier"),
        F.min("source_count").cast("long").alias("min_sources"), F.max("source_count").cast("long").alias("max_sources"),
    )


def near_duplicates(points: DataFrame) -> DataFrame:
    """Groups of points with one name at one place, to five decimals."""
    c = F.col
    keyed = points.where(c("canonical_name").isNotNull()).select(F.lower(F.trim("canonical_name")).alias("name"), F.round("lon", 5).alias("x"), F.round("lat", 5).alias("y"))
    return keyed.groupBy("name", "x", "y").agg(F.count("*").alias("n")).where("n > 1")


def report(points: DataFrame, scope: Scope, sources: tuple[str, ...] | None = None, manifest: dict | None = None, strict: bool = False) -> dict:
    """The whole report; ``ok`` is False if a check fails, or in strict mode if one warns."""
    got = counts(points, scope).first().asDict()
    run_sources = manifest.get("active_sources") if manifest else None
    valid_run = isinstance(run_sources, list) and bool(run_sources) and set(run_sources) <= set(SOURCES)
    expected = sources or (tuple(run_sources) if valid_run else None)
    held = points.agg(*[F.count(m).alias(m) for m in member_columns(points)]).first().asDict() if member_columns(points) else {}
    present = {m.removesuffix("_id") for m, n in held.items() if n}
    inactive = sorted(present - set(expected)) if expected else []
    most = len(expected) if expected else len(SOURCES)
    failures = {k: got[k] for k in ("duplicate_canonical_ids", "null_canonical_ids", "missing_names", "missing_coordinates", "coordinates_out_of_range", "outside_requested_scope", "source_count_mismatches")}
    failures |= {
        "source_count_below_one": int(got["n_rows"] > 0 and (got["min_sources"] or 0) < 1), "source_count_above_selection": int((got["max_sources"] or 0) > most),
        "run_source_set_mismatch": int(bool(sources and valid_run and tuple(sources) != tuple(run_sources))), "inactive_source_members_present": len(inactive),
    }
    warnings = {
        "null_island_coordinates": got["null_island_coordinates"], "null_evidence_tier": got["null_evidence_tier"], "duplicate_name_and_location": near_duplicates(points).count(),
        "run_manifest_missing": int(manifest is None), "run_manifest_source_set_invalid": int(manifest is not None and not valid_run), "run_built_from_dirty_tree": int(bool(manifest and manifest.get("git_dirty") is True)),
    }
    tiers = {str(r[0]): r[1] for r in points.groupBy("evidence_tier").count().orderBy("evidence_tier").collect()}
    ok = not any(failures.values()) and not (strict and any(warnings.values()))
    return {"ok": ok, "rows": got["n_rows"], "unique_canonical_ids": got["unique_ids"], "source_count_range": [got["min_sources"], got["max_sources"]], "expected_max_source_count": most, "selected_sources": list(sources) if sources else None, "run_manifest_sources": run_sources, "present_sources": sorted(present), "inactive_source_members": inactive, "evidence_tiers": tiers, "failures": failures, "warnings": warnings, "strict": strict}


def observed_licences(points: DataFrame) -> DataFrame:
    """(source, licences sorted)."""
    wide = [F.struct(F.lit(s).alias("source"), F.col(f"{s}_license").alias("licence")) for s in SOURCES if f"{s}_license" in points.columns]
    long = points.select(F.explode(F.array(*wide)).alias("x")).select("x.*")
    return long.groupBy("source").agg(F.array_sort(F.collect_set("licence")).alias("licences"))
