"""Embedding near-dedup: small-world graphs per shard.

Vectors that may link (equal label) are dealt into shards of bounded size;
exact copies are one node with a count. Each shard's graph is built once and
stored as a row, with the findings of its own audit: every node is planted
once more, turned by a random angle within the threshold, and searched. The
beam widens until nearly all of these probes find their node; nodes that are
still not found are *blind*, and every search compares them exactly.
Every shard of a label is queried with the vectors of every shard of it, each
pair of shards once, through the graph; a bounded sample of the queries is
answered by brute force as well, and the beams widen until the recall on it
passes, too. Where no beam passes, the pair of shards is answered exactly, in
tiles. Pairs found are
verified by cosine in double precision; a pair of shards returns, for each
linked vector, its number of links and the smallest node it reaches there,
never the pairs, and the components of the whole are found by Spark jobs.

Defined cases: a NULL label, and vectors that are NULL, empty, zero or hold NULL or
non-finite components link with nothing; vectors of different length don't
compare; repeated rows are copies of each other; a NULL vec_id never becomes a component
id while the component has another; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradelake.llm.common import staged
from tradelake.llm.components import connected_components
from tradelake.llm.hnsw import Graph

LEAST = 0.98
SHARD_ROWS = 4096
BEAM = 48
RECALL = 0.995
AUDIT = 64          # queries per pair of shards that are answered by brute force as well
TILE = 512          # queries multiplied with a whole shard at once
SLACK = 1e-5        # single-precision search keeps this much below the threshold for verification
GRAPH = ("label string, dim int, shard int, nodes binary, copies binary, vectors binary, entry int, "
         "widths array<int>, links binary, beam int, blind binary")
MAX_PARTITIONS = 20_000


def _unit(v: np.ndarray) -> np.ndarray:
    # scale first, so that squares of very small or large components stay finite
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def probes(index: np.ndarray, least: float, seed: int = 0) -> np.ndarray:
    """Each vector once more, turned in a random direction to a cosine between ``least`` and 1."""
    rng = np.random.default_rng(seed)
    aside = rng.normal(size=index.shape)
    aside -= np.einsum("ij,ij->i", aside, index)[:, None] * index
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    aside = np.where(length > 1e-9, aside / np.where(length > 0, length, 1.0), 0.0)  # one dimension has no other direction
    cosine = rng.uniform(least, 1.0, (len(index), 1))
    return _unit(cosine * index + np.sqrt(1.0 - cosine ** 2) * aside)


def blind_nodes(graph: Graph, index: np.ndarray, least: float, recall: float, beam: int = BEAM) -> tuple[int, np.ndarray]:
    """(beam, nodes that their own probe does not find with it); the beam widens until few are left, or gives up."""
    planted = probes(index, least)
    while True:
        q, n = graph.within(planted, least - SLACK, beam)
        blind = np.setdiff1d(np.arange(len(index)), n[q == n])
        if len(blind) <= (1.0 - recall) * len(index) or 16 * beam >= len(index):
            return beam, blind
        beam *= 2


def _build(least: float, recall: float):
    return lambda rows: _shard_row(rows, least, recall)


def _shard_row(rows: pd.DataFrame, least: float, recall: float) -> pd.DataFrame:
    rows = rows.sort_values("node")
    v = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    unit = _unit(v)
    g = Graph(unit)
    beam, blind = blind_nodes(g, unit, least, recall)
    r = rows.iloc[0]
    return pd.DataFrame([{
        "label": r["label"], "dim": r["dim"], "shard": r["shard"], "nodes": rows["node"].to_numpy(np.int64).tobytes(),
        "copies": rows["copies"].to_numpy(np.int64).tobytes(), "vectors": v.tobytes(), "entry": getattr(g, "entry", 0),
        "widths": [x.shape[1] for x in g.links], "links": b"".join(x.tobytes() for x in g.links),
        "beam": beam, "blind": blind.astype(np.int64).tobytes()}])


def _load(vectors: np.ndarray, entry: int, widths: list[int], links: bytes) -> Graph:
    g = Graph.__new__(Graph)
    g.v, g.entry, g.links = np.ascontiguousarray(_unit(vectors), np.float32), entry, []
    flat, at, n = np.frombuffer(links, np.int32), 0, len(vectors)
    for w in widths:
        g.links.append(flat[at:at + n * w].reshape(n, w))
        at += n * w
    return g


def _exact(queries: np.ndarray, asked: np.ndarray, index: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs of the queries numbered ``asked``, by brute force in tiles."""
    found = [(asked[:0], asked[:0])]
    for s in range(0, len(asked), TILE):
        part = asked[s:s + TILE]
        q, n = np.nonzero(queries[part] @ index.T >= least)
        found.append((part[q], n))
    return tuple(np.concatenate(x) for x in zip(*found))


def linked_pairs(graph: Graph, index: np.ndarray, queries: np.ndarray, least: float, recall: float,
                 beam: int | None = None, blind: np.ndarray | None = None, audit: int = AUDIT,
                 counts: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs with cosine of ``least`` or more: from the graph, and exactly for its blind nodes.

    ``index`` and ``queries`` are unit vectors in double precision; a shard that is searched
    with its own vectors is given as both. ``beam`` and ``blind`` are what ``blind_nodes``
    found. A sample of ``audit`` queries is answered by brute force; the beam widens until the
    graph's recall on it is ``recall``, over all their links and on the average query with links.
    ``counts`` receives how many queries the graph answered and how many the tiles.
    """
    if blind is None:
        beam, blind = blind_nodes(graph, index, least, recall)
    sample = np.sort(np.random.default_rng(0).permutation(len(queries))[:audit])
    known_q, known_n = _exact(queries, sample, index, least)
    own = known_q != known_n if queries is index else np.ones(len(known_q), bool)  # a vector finds itself
    true = known_q[own] * len(index) + known_n[own]
    every = np.arange(len(queries))
    direct_q, direct_n = _exact(queries, every, index[blind], least) if len(blind) else (every[:0], every[:0])
    direct = direct_q * len(index) + blind[direct_n]
    while True:
        if 8 * beam >= len(index) and len(index) > TILE:  # such beams cost more than the whole product
            if counts is not None:
                counts["exact"] = counts.get("exact", 0) + len(queries)
            return _exact(queries, every, index, least)
        q, n = graph.within(queries, least - SLACK, beam)
        got = np.unique(np.concatenate([q * len(index) + n, direct]))
        hit = np.isin(true, got)
        each = np.bincount(true // len(index), hit, len(queries)) / np.maximum(1, np.bincount(true // len(index), minlength=len(queries)))
        judged = each[np.unique(true // len(index))]
        if not len(true) or hit.mean() >= recall and judged.mean() >= recall:
            break
        if len(index) <= TILE:
            return _exact(queries, every, index, least)
        beam *= 2
    if counts is not None:
        counts["graph"] = counts.get("graph", 0) + len(queries)
    q, n = np.divmod(np.union1d(got, known_q * len(index) + known_n), len(index))
    keep = np.zeros(len(q), bool)
    for s in range(0, len(q), 1 << 16):
        a, b = q[s:s + (1 << 16)], n[s:s + (1 << 16)]
        keep[s:s + (1 << 16)] = np.einsum("ij,ij->i", queries[a], index[b]) >= least
    return q[keep], n[keep]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component under the links (a, b) of nodes 0..n-1."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new[new]
    return root


def _query(least: float, recall: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                raw = np.frombuffer(r.vectors, np.float64).reshape(-1, r.dim)
                nodes, copies = np.frombuffer(r.nodes, np.int64), np.frombuffer(r.copies, np.int64)
                graph, index = _load(raw, r.entry, list(r.widths), r.links), _unit(raw)
                same, found_by = r.shard == r.q_shard, (r.beam, np.frombuffer(r.blind, np.int64))
                if same:
                    q, n = linked_pairs(graph, index, index, least, recall, *found_by)
                    a, b = np.minimum(q, n), np.maximum(q, n)
                    a, b = np.divmod(np.unique((a * len(nodes) + b)[a != b]), len(nodes))
                else:
                    other = _unit(np.frombuffer(r.q_vectors, np.float64).reshape(-1, r.dim))
                    q, n = linked_pairs(graph, index, other, least, recall, *found_by)
                    a, b = n, q + len(nodes)
                    nodes = np.concatenate([nodes, np.frombuffer(r.q_nodes, np.int64)])
                    copies = np.concatenate([copies, np.frombuffer(r.q_copies, np.int64)])
                links = np.zeros(len(nodes), np.int64)
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                # number nodes by id first, so that the root is the smallest id
                order = np.argsort(nodes)
                rank = np.empty(len(nodes), np.int64)
                rank[order] = np.arange(len(nodes))
                root = nodes[order][forest(rank[a], rank[b], len(nodes))[rank]]
                has = links > 0
                if has.any():
                    yield pd.DataFrame({"node": nodes[has], "links": links[has], "root": root[has]})
    return run


def embedding_classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                      least: float = LEAST, shard_rows: int = SHARD_ROWS, recall: float = RECALL) -> DataFrame:
    """One row per vector: the id, n_links, component_id (smallest id reachable) and kept."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))
    usable = F.expr("label is not null and size(embedding) > 0 and exists(embedding, x -> x <> 0) and "
                    "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    nodes = staged(rows.where(F.coalesce(usable, F.lit(False))).groupBy("label", "embedding")
                   .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                   .withColumn("node", F.monotonically_increasing_id()), "vectors")
    kinds = nodes.withColumn("dim", F.size("embedding"))
    blocks = kinds.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard_rows)).alias("blocks"))
    shards = (kinds.join(blocks, ["label", "dim"])
              .select(F.col("label").cast("string").alias("label"), "dim", "node", "copies", "embedding",
                      F.expr("cast(pmod(xxhash64(node), blocks) as int)").alias("shard")))
    graphs = staged(shards.groupBy("label", "dim", "shard").applyInPandas(_build(least, recall), GRAPH), "vector-graphs")
    other = graphs.select("label", "dim", F.col("shard").alias("q_shard"), F.col("nodes").alias("q_nodes"),
                          F.col("copies").alias("q_copies"), F.col("vectors").alias("q_vectors"))
    pairs = graphs.join(other, ["label", "dim"]).where("shard <= q_shard")
    per_label = graphs.groupBy("label", "dim").agg(F.count("*").alias("k"))
    n = per_label.agg(F.sum(F.expr("k * (k + 1) div 2"))).first()[0] or 1
    found = staged(pairs.repartition(int(min(n, MAX_PARTITIONS)), "label", "dim", "shard", "q_shard")
                   .mapInPandas(_query(least, recall), "node long, links long, root long"), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = staged(connected_components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")),
                                        "vectors-cc"), "vector-roots")
    named = (nodes.join(roots, "node", "left").join(links, "node", "left")
             .select("label", "embedding", "least", F.coalesce("root", "node").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = staged(named, "vector-named")
    first = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "vector-components")
    named = staged(named.join(first, "root").select("label", "embedding", "n_links", "component_id"), "vector-classes")
    out = rows.join(named, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.expr("vec_id <=> component_id")).withColumnRenamed("vec_id", id_col)
