"""Typed list of the landed official files: one listing, explicit paths.

A landing area holds ``direction=imp|exp`` folders with files named by kind,
direction and year (an official file may be a folder of part files). Names
decide the kind: NCM and municipality files never stand for each other. The
list has one entry per official file, so it is as small as years x directions
x kinds; it is made on the driver from directory entries, no file is opened.
Readers get the paths of the entries they need and scan nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradelake.schemas import OFFICIAL_NAMES
from tradelake.session import file_system

_FOLDER = re.compile(r"direction=(imp|exp)$")


@dataclass(frozen=True)
class LandedFile:
    kind: str        # ncm or hs4
    direction: str   # imp or exp
    year: int
    file: str        # official name, upper case but for the extension
    path: str
    bytes: int       # of the file itself; 0 for a folder of part files
    modified: int    # milliseconds since the epoch


SCHEMA = "kind string, direction string, year int, file string, path string, bytes bigint, modified bigint"


def landing_manifest(spark: SparkSession, base: str, kind: str | None = None, years: Iterable[int] | None = None,
                     directions: Iterable[str] | None = None) -> list[LandedFile]:
    """Official files below ``base/direction=*``, by direction, year and name; other files are left out.

    A file whose name says another direction than its folder, and a second
    file for the same kind, direction and year, are errors: neither may be
    published or dropped silently.
    """
    fs, path = file_system(spark, f"{base.rstrip('/')}/direction=*/*")
    found: dict[tuple, LandedFile] = {}
    years, directions = years and set(years), directions and set(directions)
    for status in fs.globStatus(path) or []:
        p = status.getPath()
        name, folder = p.getName(), _FOLDER.match(p.getParent().getName())
        for k, pattern in OFFICIAL_NAMES.items():
            hit = re.fullmatch(pattern, name, re.IGNORECASE)
            if not hit or folder is None:
                continue
            direction, year = hit[1].lower(), int(hit[2])
            if direction != folder[1]:
                raise ValueError(f"{name} lies in the folder of the other direction: {p.toString()}")
            suffix = "_MUN" if k == "hs4" else ""
            entry = LandedFile(k, direction, year, f"{direction.upper()}_{year}{suffix}.csv", p.toString(),
                               0 if status.isDirectory() else status.getLen(), status.getModificationTime())
            if (k, direction, year) in found:
                raise ValueError(f"two files for {k} {direction} {year}: {found[k, direction, year].path}, {entry.path}")
            found[k, direction, year] = entry
    chosen = [f for f in found.values() if (kind is None or f.kind == kind) and (years is None or f.year in years)
              and (directions is None or f.direction in directions)]
    return sorted(chosen, key=lambda f: (f.kind, f.direction, f.year))


def as_table(spark: SparkSession, files: Sequence[LandedFile]) -> DataFrame:
    """The manifest as a table."""
    return spark.createDataFrame([(f.kind, f.direction, f.year, f.file, f.path, f.bytes, f.modified) for f in files], SCHEMA)
