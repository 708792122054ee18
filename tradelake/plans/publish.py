"""Atomic publication of the lake: staged versions and a manifest switch.

Data lie in ``version=/year=/direction=`` folders. A publication writes its
partitions into a version folder of its own, which no reader sees and no other writer touches; after the checks a
manifest names, for every partition, the version that counts. Manifests are
numbered files, created under their final name only if nobody else has taken
the number, so a publication becomes visible as a whole or not at all, two
writers can't both win, and partitions that were not asked for are carried over
untouched. Readers take the folders of the newest manifest (or of an older
one); filters on year and direction prune as before. Replaced versions and
leftovers of failed writers stay until ``vacuum``.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tradelake.session import delete_path, file_system

KEYS = ("year", "direction")
_MANIFEST = re.compile(r"([0-9]{20})\.json$")
_FOLDER = re.compile(r"/version=([^/]+)/year=([^/]+)/direction=([^/]+)/?$")
Partition = tuple[int, str]


class PublishConflict(RuntimeError):
    """Another publication took the manifest number first; stage again on top of it."""


@dataclass(frozen=True)
class Manifest:
    number: int
    versions: dict[Partition, str] = field(default_factory=dict)
    schema: str | None = None  # JSON of the facts' schema
    made_from: dict[Partition, str] = field(default_factory=dict)  # of derived data: the version they were derived from

    def folders(self, lake: str, wanted: Callable[[Partition], bool] | None = None) -> list[str]:
        return [folder(lake, p, v) for p, v in sorted(self.versions.items()) if wanted is None or wanted(p)]


@dataclass(frozen=True)
class Staged:
    """A written version that no manifest names yet."""
    lake: str
    version: str
    base: Manifest
    partitions: tuple[Partition, ...]
    schema: str
    metrics: dict


def folder(lake: str, partition: Partition, version: str) -> str:
    return f"{version_folder(lake, version)}/year={partition[0]}/direction={partition[1]}"


def version_folder(lake: str, version: str) -> str:
    return f"{lake.rstrip('/')}/version={version}"


def _manifests(spark: SparkSession, lake: str) -> list[tuple[int, object]]:
    fs, path = file_system(spark, f"{lake.rstrip('/')}/_manifest/*.json")
    hits = [(_MANIFEST.search(s.getPath().getName()), s.getPath()) for s in fs.globStatus(path) or []]
    return sorted(((int(h[1]), p) for h, p in hits if h), key=lambda x: x[0])


def manifest(spark: SparkSession, lake: str, number: int | None = None) -> Manifest | None:
    """The newest manifest (or the one of that number); None where nothing was published this way."""
    every = _manifests(spark, lake)
    chosen = [m for m in every if number is None or m[0] == number]
    if not chosen:
        if number is not None:
            raise ValueError(f"no manifest {number} in {lake}")
        return None
    n, path = chosen[-1]
    fs, _ = file_system(spark, lake)
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    body = json.loads(text)
    parts = {(p["year"], p["direction"]): p for p in body["partitions"]}
    return Manifest(n, {k: p["version"] for k, p in parts.items()}, body.get("schema"),
                    {k: p["made_from"] for k, p in parts.items() if p.get("made_from")})


def read_version(spark: SparkSession, lake: str, state: Manifest, partitions: Iterable[Partition] | None = None) -> DataFrame:
    """Facts of the partitions that a manifest names (or of some of them)."""
    from pyspark.sql.types import StructType
    wanted = None if partitions is None else set(partitions).__contains__
    paths = state.folders(lake, wanted)
    schema = StructType.fromJson(json.loads(state.schema)).add("year", "integer").add("direction", "string").add("version", "string")
    if not paths:
        return spark.createDataFrame([], schema).drop("version")
    return spark.read.schema(schema).option("basePath", lake).parquet(*paths).drop("version")


def stage(facts: DataFrame, lake: str, sort_by: Sequence[str | Column] = ("ncm", "month"), observe: dict | None = None,
          drop: Sequence[str] = (), options: dict | None = None) -> Staged:
    """Write ``facts`` under a fresh version, sorted within files. ``observe`` names aggregates taken while
    writing (over the columns of ``facts``, also those in ``drop``, which are not stored); ``options`` go to the writer."""
    spark = facts.sparkSession
    base = manifest(spark, lake) or Manifest(0)
    version = uuid.uuid4().hex
    seen = None
    if observe:
        seen = Observation(f"stage-{version}")
        facts = facts.observe(seen, *[e.alias(n) for n, e in observe.items()])
    facts = facts.drop(*drop)
    cols = [c for c in facts.columns if c not in KEYS]
    body = facts.select(*cols, *KEYS)
    try:
        (body.hint("rebalance", *KEYS)
             .sortWithinPartitions(*KEYS, *[c for c in sort_by if isinstance(c, Column) or c in cols])
             .write.options(**(options or {})).partitionBy(*KEYS).parquet(version_folder(lake, version)))
    except Exception:
        discard(spark, lake, version)
        raise
    written = tuple(sorted((p for p, v in _folders(spark, lake) if v == version), key=str))
    return Staged(lake, version, base, written, body.select(*cols).schema.json(), dict(seen.get) if seen else {})


def staged_facts(spark: SparkSession, staged: Staged) -> DataFrame:
    """What a staged version holds, for checks before it is committed."""
    return read_version(spark, staged.lake, Manifest(0, {p: staged.version for p in staged.partitions}, staged.schema))


def commit(spark: SparkSession, staged: Staged, partitions: Iterable[Partition] | None = None,
           made_from: dict[Partition, str] | None = None, remove: Iterable[Partition] = ()) -> Manifest:
    """Let the staged version count for exactly ``partitions`` (default: those it holds) and drop those in ``remove``.

    A partition that was written but not named, or named but not written, is an
    error. A lake that grew columns keeps them; readers see NULL where a
    version has none. Raises ``PublishConflict`` if another manifest came first.
    """
    named = set(staged.partitions if partitions is None else partitions)
    if named != set(staged.partitions):
        differ = ", ".join(sorted(f"{d} {y}" for y, d in named ^ set(staged.partitions)))
        raise ValueError(f"written and named partitions differ: {differ}")
    gone = set(remove)
    versions = {**{p: v for p, v in staged.base.versions.items() if p not in gone}, **{p: staged.version for p in named}}
    origins = {**staged.base.made_from, **(made_from or {})}
    fields = json.loads(staged.schema)
    if staged.base.schema:
        have = {f["name"] for f in fields["fields"]}
        fields["fields"] += [f for f in json.loads(staged.base.schema)["fields"] if f["name"] not in have]
    new = Manifest(staged.base.number + 1, versions, json.dumps(fields))
    body = json.dumps({"schema": new.schema, "partitions": [
        {"year": y, "direction": d, "version": v, "made_from": origins.get((y, d))} for (y, d), v in sorted(versions.items())]})
    jvm = spark._jvm
    root = f"{staged.lake.rstrip('/')}/_manifest"
    fs, draft = file_system(spark, f"{root}/_draft-{staged.version}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(body.encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # never over an existing file
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root}/{new.number:020d}.json")), keep)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise PublishConflict(f"manifest {new.number} of {staged.lake} was written by another publication") from e
        raise
    return new


def _folders(spark: SparkSession, lake: str) -> list[tuple[Partition, str]]:
    fs, path = file_system(spark, f"{lake.rstrip('/')}/version=*/year=*/direction=*")
    hits = [_FOLDER.search(s.getPath().toString()) for s in fs.globStatus(path) or []]
    return [((int(h[2]) if h[2].isdigit() else h[2], h[3]), h[1]) for h in hits if h]


def _versions(spark: SparkSession, lake: str) -> list[str]:
    fs, path = file_system(spark, f"{lake.rstrip('/')}/version=*")
    return [s.getPath().getName().split("=", 1)[1] for s in fs.globStatus(path) or []]


def discard(spark: SparkSession, lake: str, version: str) -> None:
    """Delete a version that was not committed, and the lake itself if nothing else was ever published or staged there."""
    delete_path(spark, version_folder(lake, version))
    if not _manifests(spark, lake) and not _versions(spark, lake):
        delete_path(spark, lake)


def vacuum(spark: SparkSession, lake: str, keep: int = 1) -> int:
    """Delete the partitions that none of the newest ``keep`` manifests names, and older manifests; returns how many partitions.

    Run it while nobody publishes: a version being staged is not named yet.
    """
    if keep < 1:
        raise ValueError("the newest manifest has to stay")
    every = _manifests(spark, lake)
    named = {(p, v) for n, _ in every[-keep:] for p, v in manifest(spark, lake, n).versions.items()}
    fs, _ = file_system(spark, lake)
    for _, path in every[:-keep]:  # first the names, then what they name
        fs.delete(path, False)
    gone = [x for x in _folders(spark, lake) if x not in named]
    for p, v in gone:
        delete_path(spark, folder(lake, p, v))
    for v in set(_versions(spark, lake)) - {v for _, v in named}:
        delete_path(spark, version_folder(lake, v))
    return len(gone)


def publish(facts: DataFrame, lake: str, partitions: Iterable[Partition] | None = None,
            verify: Callable[[DataFrame], None] | None = None, sort_by: Sequence[str] = ("ncm", "month")) -> Manifest:
    """Stage, verify what was written, switch the manifest; on any failure the lake reads as before."""
    spark = facts.sparkSession
    staged = stage(facts, lake, sort_by)
    try:
        if verify is not None:
            verify(staged_facts(spark, staged))
        return commit(spark, staged, partitions)
    except Exception:
        discard(spark, lake, staged.version)
        raise
