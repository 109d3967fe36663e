"""Versioned build state: release pins, stage manifests and the gates between stages.

A stage's table lies in a folder named by a digest of what it depends on, and its manifest is written last; a table without
a manifest, or with one of other inputs, is not used. Nothing is rewritten in place.
"""

from __future__ import annotations

import hashlib
import json
import re
import shutil
from dataclasses import dataclass, field
from pathlib import Path

from placelink.plans.scope import Tile
from placelink.plans.storage import read_json, sealed, write_json

FORMAT = 1


class StateError(RuntimeError):
    """What is there does not fit what is asked for; the message lists everything that is wrong."""


def digest(value: dict) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Stage:
    """A stage's folder under ``root``: inputs decide its name."""

    root: Path
    name: str
    inputs: dict = field(default_factory=dict)

    @property
    def path(self) -> Path:
        return self.root / self.name / digest({"format": FORMAT, **self.inputs})

    @property
    def table(self) -> str:
        return str(self.path / "table")

    @property
    def manifest(self) -> dict | None:
        got = read_json(self.path / "manifest.json")
        return got if got and got.get("inputs") == json.loads(json.dumps(self.inputs, default=str)) and got.get("format") == FORMAT else None

    def complete(self, **facts: object) -> None:
        write_json(self.path / "manifest.json", {"format": FORMAT, "inputs": self.inputs, **facts})

    def discard(self) -> None:
        """Renames first, so that a half-removed folder is never taken for a whole one."""
        if self.path.exists():
            gone = self.path.with_name(self.path.name + ".discarded")
            shutil.rmtree(gone, ignore_errors=True)
            self.path.rename(gone)
            shutil.rmtree(gone, ignore_errors=True)


def pin(root: Path, source: str, release: str | None = None) -> str | None:
    """The release of a source that this root uses; sets it if given."""
    at = root / "releases" / f"{source}.json"
    if release is not None:
        write_json(at, {"release": release})
    return (read_json(at) or {}).get("release")


def newest(spark, path: str) -> tuple[str, str] | None:
    """(release, folder) of the latest dated folder in ``path`` - ``dt=2026-01-31``, ``2026-01-31`` or ``2026-01-31.0`` - on any storage that Spark reads; None if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [str(x.getPath().getName()) for x in files.listStatus(at) if x.isDirectory()]
    dated = {m[1]: n for n in names if (m := re.fullmatch(r"(?:dt=)?(\d{4}-\d{2}-\d{2}(?:\.\d+)?)", n))}
    if not dated:
        return None
    release = max(dated, key=lambda r: [*r.split(".")[0].split("-"), int((r.split(".") + ["0"])[1])])
    return release, f"{path.rstrip('/')}/{dated[release]}"


def adopt(root: Path, source: str, release: str, replace: bool = False) -> str:
    """Pins a release, or the same one again; another one only where the caller says that what was made from the former goes."""
    former = pin(root, source)
    if former is not None and former != release and not replace:
        raise StateError(f"{source}: pinned to {former}, not {release}; say that the former is to be replaced")
    return pin(root, source, release)


def snapshot(root: Path, sources: tuple[str, ...], tiles: list[Tile], have: dict[str, set[str]], table_release: dict[str, str | None]) -> dict:
    """The identity of all inputs; raises one error that lists every missing tile and every release that differs.

    have: keys of the tiles that each source's table holds; table_release: the release that each was made from.
    """
    wrong, out = [], {}
    for s in sources:
        wanted = pin(root, s)
        missing = [t.key for t in tiles if t.key not in have.get(s, set())]
        if wanted is None:
            wrong.append(f"{s}: no release is pinned")
        if missing:
            wrong.append(f"{s}: {len(missing)} tiles are missing, first {missing[0]}")
        if wanted and table_release.get(s) != wanted:
            wrong.append(f"{s}: the table is of release {table_release.get(s)}, the pin is {wanted}")
        out[s] = {"release": wanted, "tiles": sealed([t.key for t in tiles])}
    if wrong:
        raise StateError("; ".join(wrong))
    return out


def sealed_matches(expected: dict, names: list[str]) -> bool:
    return sealed(names) == expected
