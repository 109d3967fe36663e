"""Terms of the sources and the attribution text. States provenance; concludes nothing about a combined licence."""

from __future__ import annotations

from placelink.plans.scope import sources_of

# Names, licences and addresses of the upstream sources.
TERMS = {
    "fsq": ("Foursquare OS Places", "Apache-2.0", "Contains data from Foursquare OS Places.", "https://docs.foursquare.com/data-products/docs/fsq-places-open-source"),
    "overture": ("Overture Maps Foundation, Places theme", "MULTI-LICENSE", "Contains data from the Overture Maps Foundation.", "https://docs.overturemaps.org/attribution/"),
    "osm": ("OpenStreetMap", "ODbL-1.0", "Contains data from OpenStreetMap, © OpenStreetMap contributors.", "https://www.openstreetmap.org/copyright"),
}
COMBINED = "UNDETERMINED"


def block(sources: tuple[str, ...], releases: dict | None = None, observed: dict[str, list[str]] | None = None) -> dict:
    rows = []
    for s in sources_of(list(sources)):
        name, licence, credit, url = TERMS[s]
        rows.append({"source": s, "name": name, "license": licence, "attribution": credit, "terms_url": url, "release": (releases or {}).get(s), "observed_licenses": sorted({x for x in (observed or {}).get(s, []) if x})})
    return {"sources": rows, "combined_license": COMBINED, "contains_odbl_source": any(r["source"] == "osm" for r in rows)}


def text(scope_name: str, sources: tuple[str, ...], releases: dict | None = None, observed: dict[str, list[str]] | None = None) -> str:
    lines = [f"Attribution: {scope_name}", ""]
    for r in block(sources, releases, observed)["sources"]:
        lines += [r["name"], f"  {r['attribution']}", f"  Upstream licence: {r['license']}"]
        lines += [f"  Observed licences: {', '.join(r['observed_licenses'])}"] * bool(r["observed_licenses"]) + [f"  Release: {r['release']}"] * bool(r["release"])
        lines += [f"  Terms: {r['terms_url']}", ""]
    lines += [f"Licence of the combination: {COMBINED}. These lines record upstream terms; review them before publishing."]
    return "\n".join(lines) + "\n"
