"""SimHash near-dedup by tiled exact comparison.

Every text gets a 64-bit fingerprint; distinct fingerprints are compared
exactly, exclusive-or and bit count in numpy, tile against tile. A tile holds
fingerprints with the same population counts of their parts (four of 16 bits, or eight of
8 bits where there are so many fingerprints that the former would fill several blocks).
Flipping a bit changes one of these counts by one, so two tiles whose counts differ
by more than the radius in sum hold no link and are skipped. Large tiles
are cut into blocks of at most about ``block_rows`` rows; a block travels as one
row, once to each block it is compared with, and a task sees one pair of blocks at a time, so
neither a popular tile nor a large group of copies gathers in one task. A pair of blocks returns a spanning forest of its
links (each row and the local component's smallest fingerprint), never all
pairs; the components of the whole are found by Spark jobs.

Defined cases: NULL, empty and blank texts have fingerprint 0 and link like
any other; under ``shingle`` words the whole sequence is one shingle; repeated
rows share a fingerprint; a NULL doc_id never becomes a component id while the
component has another; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tradelake.llm.common import free_name, staged
from tradelake.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
PARTS = (4, 8)     # into how many parts a fingerprint may be cut, whose population counts name a tile
BLOCK_ROWS = 4096
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text."""
    ws = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not ws:
        return 0
    joined = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(ws) > shingle:
        starts, ends = starts[:len(ws) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends.tolist())])
    # digests are big-endian: count the set bits place by place, in slices of bounded size
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros((8, 8), np.int64)
    for k in range(0, len(rows), 65536):
        part = rows[k:k + 65536]
        for b in range(8):
            ones[b] += np.bincount(part[:, b], minlength=256) @ _BYTE_BITS
    bits = 2 * ones.reshape(64) > len(rows)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint column as a signed long (same bits)."""
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(np.array([fingerprint(x, shingle) for x in t], np.uint64).view(np.int64))
    return of(text)


def _forest(home: np.ndarray, guest: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks (or inside one, if they are the same array) as (member, root) pairs."""
    same = guest is home
    nodes = home if same else np.concatenate([home, guest])
    a, b = [], []
    for k in range(0, len(home), 256):
        near = np.bitwise_count(home[k:k + 256, None] ^ guest[None, :]) <= radius
        i, j = np.nonzero(near)
        a.append(i + k)
        b.append(j if same else j + len(home))
    a, b = np.concatenate(a), np.concatenate(b)
    root = np.arange(len(nodes))
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new[new]
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for part in batches:
            rest = part if rest is None else pd.concat([rest, part], ignore_index=True)
            last = rest["pair"].iloc[-1] if len(rest) else None
            ready, rest = rest[rest["pair"] != last], rest[rest["pair"] == last]
            yield from forests(ready)
        if rest is not None and len(rest):
            yield from forests(rest)

    def forests(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        pair, guest, fps = rows["pair"].to_numpy(), rows["guest"].to_numpy(), rows["fps"].to_numpy()
        cut = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1], True])
        found = []
        for i, j in zip(cut[:-1], cut[1:]):
            side = {int(g): np.asarray(f, np.int64).view(np.uint64) for g, f in zip(guest[i:j], fps[i:j])}
            if 2 in side and len(side[2]) > 1:
                found.append(_forest(side[2], side[2], radius))
            if 0 in side and 1 in side:
                found.append(_forest(side[0], side[1], radius))
        if found:
            yield pd.DataFrame({"a": np.concatenate([x for x, _ in found]).view(np.int64),
                                "b": np.concatenate([y for _, y in found]).view(np.int64)})
    return run


def parts_for(n: int, block_rows: int = BLOCK_ROWS) -> int:
    """The fewest parts with which the fullest tile of ``n`` random fingerprints fits a block; at most the last of ``PARTS``."""
    for parts in PARTS:
        width = 64 // parts
        if n * (comb(width, width // 2) / 2 ** width) ** parts <= block_rows:
            return parts
    return PARTS[-1]


def _neighbours(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of population counts within the radius, one of each opposite two, without zero."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=parts) if 0 < sum(map(abs, s)) <= radius]
    return [s for s in steps if s > tuple(-x for x in s)]


def link_fingerprints(prints: DataFrame, radius: int = RADIUS, parts: int | None = None,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Spanning links (a, b) among the distinct longs in column ``fp``."""
    parts = parts or parts_for(prints.count(), block_rows)
    width = 64 // parts
    mask = (1 << width) - 1
    place = [(width + 1) ** (parts - 1 - k) for k in range(parts)]
    tile = " + ".join(f"bit_count(shiftrightunsigned(fp, {64 - width * (k + 1)}) & {mask}L) * {place[k]}L" for k in range(parts))
    tiled = staged(prints.selectExpr("fp", f"{tile} as tile"), "simhash-tiles")
    sizes = staged(tiled.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks")), "simhash-sizes")
    # a block is one row from here on
    units = staged(tiled.join(sizes, "tile").withColumn("block", F.expr("cast(pmod(xxhash64(fp), blocks) as int)"))
                   .groupBy("tile", "block", "blocks").agg(F.collect_list("fp").alias("fps")), "simhash-blocks")
    # inside a tile: a block meets itself (role 2) and the other blocks of the tile
    own = units.selectExpr("fps", "tile as t1", "tile as t2", "block", "explode(sequence(0, blocks - 1)) as other")
    own = own.selectExpr("fps", "t1", "t2", "least(block, other) as b1", "greatest(block, other) as b2",
                         "case when block = other then 2 when block < other then 0 else 1 end as guest")
    # tiles within the radius: a block goes as home to every block of the guest tile, and the other way round
    steps = _neighbours(parts, radius)
    count = lambda k: f"tile div {place[k]}L % {width + 1}"
    inside = lambda s, sign: " and ".join(f"{count(k)} + {sign * x} between 0 and {width}" for k, x in enumerate(s) if x)
    far = lambda s: sum(x * p for x, p in zip(s, place))
    as_home = ", ".join(f"case when {inside(s, 1)} then tile + {far(s)}L end" for s in steps)
    as_guest = ", ".join(f"case when {inside(s, -1)} then tile - {far(s)}L end" for s in steps)
    there = sizes.selectExpr("tile as o", "blocks as n")
    home = (units.selectExpr("tile", "block", f"explode(filter(array({as_home}), x -> x is not null)) as o")
            .join(there, "o").selectExpr("tile", "block", "tile as t1", "o as t2", "block as b1",
                                         "explode(sequence(0, n - 1)) as b2", "0 as guest"))
    guest = (units.selectExpr("tile", "block", f"explode(filter(array({as_guest}), x -> x is not null)) as o")
             .join(there, "o").selectExpr("tile", "block", "o as t1", "tile as t2",
                                          "explode(sequence(0, n - 1)) as b1", "block as b2", "1 as guest"))
    # the blocks themselves join the list of their meetings last
    met = home.union(guest.select(*home.columns)).join(units.select("tile", "block", "fps"), ["tile", "block"])
    cols = ["fps", "t1", "t2", "b1", "b2", "guest"]
    pairs = own.select(*cols).union(met.select(*cols))
    pairs = pairs.selectExpr("fps", "guest", "concat_ws(':', t1, t2, b1, b2) as pair")
    return (pairs.repartition("pair").sortWithinPartitions("pair")
            .mapInPandas(_compare(radius), "a long, b long"))


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, carry: list[str] | None = None) -> DataFrame:
    """Per row: ``carry`` columns (the id by default), fp, root (smallest fingerprint of the component, as a
    signed long) and component_id (smallest id reachable)."""
    carry = carry or [id_col]
    prints = staged(docs.select(*[F.col(f"`{c}`") for c in carry], fingerprints(F.col(f"`{text_col}`"), shingle).alias("fp")),
                    "simhash-prints")
    distinct = staged(prints.groupBy("fp").agg(F.min(F.col(f"`{id_col}`")).alias("least")), "simhash-distinct")
    links = staged(link_fingerprints(distinct, radius), "simhash-links")
    roots = staged(connected_components(links, "simhash-cc"), "simhash-roots")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = staged(rooted.select("fp", "root", "least"), "simhash-rooted")
    least = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    named = staged(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-named")
    return prints.join(named, "fp")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component: the smallest id; of repeated rows with that id, one."""
    rid = free_name(docs, "__rid")
    numbered = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "simhash-docs")
    classes = simhash_classes(numbered, id_col, text_col, carry=[id_col, rid], **options)
    # by root, not by component_id: a component without any id is one component too
    first = F.min(F.struct(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(rid)))
    winners = staged(classes.groupBy("root").agg(first.alias("w")).select(F.col(f"w.{rid}").alias(rid)), "simhash-kept")
    # texts are joined by sorting at every size alike: the winners grow with the corpus
    return numbered.hint("merge").join(winners, rid, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
