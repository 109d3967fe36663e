"""Dataset names in provenance texts, and the licence they imply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
DATASET = r"'dataset':\s*('(?:[^'\\]|\\.)*'|[^,}]*)"
FSQ_PROVENANCE = r"foursquare|\bfsq\b"
FAMILIES = (
    ("Apache-2.0", FSQ_PROVENANCE),
    ("CC0-1.0", "alltheplaces|all_the_places"),
    ("CDLA-Permissive-2.0", "meta|microsoft|pinmeto|krick|renderseo|brightquery|dac"),
)
MIXED, UNKNOWN = "MIXED/REVIEW", "UNKNOWN"
SOURCE_LICENCE = {"fsq": "Apache-2.0", "osm": "ODbL-1.0"}


def datasets(provenance: Column) -> Column:
    """Lower-case dataset names between bars, the whole text in lower case where none is found, '' for null."""
    found = F.regexp_extract_all(provenance, F.lit(DATASET), F.lit(1))
    listed = F.concat(F.lit("|"), F.lower(F.replace(F.array_join(found, "|"), F.lit("'"), F.lit(""))), F.lit("|"))
    return F.coalesce(F.when(F.size(found) > 0, listed).otherwise(F.lower(provenance)), F.lit(""))


def declares_fsq(provenance: Column) -> Column:
    return datasets(provenance).rlike(FSQ_PROVENANCE)


def overture_licence(provenance: Column) -> Column:
    names = datasets(provenance)
    hits = [names.rlike(pattern) for _, pattern in FAMILIES]
    several = sum((h.cast("int") for h in hits[1:]), hits[0].cast("int")) > 1
    out = F.when(several, MIXED)
    for (licence, _), hit in zip(FAMILIES, hits, strict=True):
        out = out.when(hit, licence)
    return out.otherwise(UNKNOWN)


def source_licence(source: Column, provenance: Column, given: Column) -> Column:
    """Overture rows derive theirs anew from the provenance; the others keep what they came with."""
    return F.when(source == "overture", overture_licence(provenance)).otherwise(given)
