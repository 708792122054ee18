"""Hierarchical navigable small-world graph in numpy, searched by batches of queries.

A node gets a random top level; on every level it is linked to near and
mutually distant neighbours. A search walks down from the top level and keeps a beam of
the best nodes met; all queries of a batch take their steps together, so the
work is array arithmetic. Similarity is the dot product of unit vectors.
"""

from __future__ import annotations

import numpy as np


class Graph:
    def __init__(self, vectors: np.ndarray, degree: int = 12, beam: int = 48, seed: int = 7):
        self.v = np.ascontiguousarray(vectors, np.float32)
        n = len(self.v)
        self.degree, self.beam = degree, beam
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(degree)).astype(np.int64), 8)
        order = rng.permutation(n)
        top = int(self.level.max(initial=0))
        self.links = [np.full((n, 2 * degree if k == 0 else degree), -1, np.int32) for k in range(top + 1)]
        # the first node has the top level, so that every search can start from it
        if n:
            at = int(np.argmax(self.level[order]))
            order[[0, at]] = order[[at, 0]]
            self.entry = int(order[0])
        done = 1
        while done < n:
            batch = order[done:done + min(512, done)]
            self._insert(batch)
            done += len(batch)

    # --- build -----------------------------------------------------------------

    def _insert(self, batch: np.ndarray) -> None:
        q = self.v[batch]
        within = q @ q.T
        np.fill_diagonal(within, -np.inf)
        entry = np.full((len(batch), 1), self.entry)
        for k in range(len(self.links) - 1, -1, -1):
            here = self.level[batch] >= k
            ids, _ = self._beam(q, entry, k, self.beam if here.any() else 8)
            entry = ids[:, :8]
            if not here.any():
                continue
            # nodes of the same batch are candidates for each other
            peers = np.where(here[None, :] & here[:, None], within, -np.inf)
            near = np.argsort(-peers, axis=1)[:, :self.degree]
            peer_ids = np.where(np.take_along_axis(peers, near, 1) > -np.inf, batch[near], -1)
            rows = np.flatnonzero(here)
            cand = np.concatenate([ids, peer_ids], axis=1)[rows]
            chosen = self._select(batch[rows], cand, self.degree)
            self.links[k][batch[rows], :self.degree] = chosen
            self._link_back(batch[rows], chosen, k)

    def _link_back(self, new: np.ndarray, chosen: np.ndarray, k: int) -> None:
        """Add the new nodes to the lists of their neighbours; full lists are chosen anew."""
        at, who = chosen.ravel(), np.repeat(new, chosen.shape[1])
        who, at = who[at >= 0], at[at >= 0]
        sim = np.einsum("ij,ij->i", self.v[who], self.v[at])
        order = np.lexsort((-sim, at))
        at, who = at[order], who[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        width = self.links[k].shape[1]
        nodes = at[first]
        extra = np.full((len(nodes), width), -1, np.int32)
        row = np.repeat(np.arange(len(nodes)), np.diff(np.r_[first, len(at)]))
        fits = rank < width
        extra[row[fits], rank[fits]] = who[fits]
        old = self.links[k][nodes]
        both = np.concatenate([old, extra], axis=1)
        full = (both >= 0).sum(1) > width
        loose = both[~full]
        if len(loose):
            loose = np.take_along_axis(loose, np.argsort(loose < 0, axis=1, kind="stable"), 1)
            self.links[k][nodes[~full]] = loose[:, :width]
        if full.any():
            self.links[k][nodes[full]] = self._select(nodes[full], both[full], width)

    def _select(self, nodes: np.ndarray, cand: np.ndarray, m: int) -> np.ndarray:
        """Up to ``m`` neighbours per node: nearest first, each nearer to the node than to
        any chosen before; places left over go to the nearest of the rest."""
        out = np.full((len(nodes), m), -1, np.int32)
        for s in range(0, len(nodes), 256):
            ids, own = cand[s:s + 256].astype(np.int64), nodes[s:s + 256]
            ids = np.where(ids == own[:, None], -1, ids)
            ids = np.sort(ids, axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            vec = self.v[ids]
            sim = np.where(ids >= 0, np.einsum("ikd,id->ik", vec, self.v[own]), -np.inf)
            order = np.argsort(-sim, axis=1, kind="stable")
            ids, sim = np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)
            vec = np.take_along_axis(vec, order[:, :, None], 1)
            inter = vec @ vec.transpose(0, 2, 1)
            kept = np.zeros(ids.shape, bool)
            nearest = np.full(ids.shape, -np.inf, np.float32)
            count = np.zeros(len(ids), np.int64)
            for j in range(ids.shape[1]):
                ok = (ids[:, j] >= 0) & (sim[:, j] > nearest[:, j]) & (count < m)
                kept[:, j] = ok
                count += ok
                nearest = np.where(ok[:, None], np.maximum(nearest, inter[:, j, :]), nearest)
            rank = np.argsort(np.where(kept, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :m]
            out[s:s + 256, :rank.shape[1]] = np.take_along_axis(ids, rank, 1)
        return out

    # --- search ----------------------------------------------------------------

    def _beam(self, q: np.ndarray, entry: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``beam`` nodes of level ``k`` per query, best first (-1 where there are fewer)."""
        n, nq = len(self.v), len(q)
        rows = np.arange(nq)[:, None]
        seen = np.zeros((nq, n + 1), bool)
        seen[:, n] = True
        links = self.links[k]
        ids = np.where(entry >= 0, entry, n).astype(np.int64)
        seen[rows, ids] = True
        sim = np.where(ids < n, np.einsum("ikd,id->ik", self.v[np.minimum(ids, n - 1)], q), -np.inf)
        closed = ids >= n
        step = max(4, beam // 12)
        while True:
            todo = np.where(closed, -np.inf, sim)
            pick = np.argsort(-todo, axis=1, kind="stable")[:, :step]
            live = np.take_along_axis(todo, pick, 1) > -np.inf
            if not live.any():
                return np.where(ids < n, ids, -1), sim
            closed[rows, pick] |= live
            new = links[np.where(live, np.take_along_axis(ids, pick, 1), 0)]
            new = np.where(live[:, :, None] & (new >= 0), new, n).reshape(nq, -1).astype(np.int64)
            new = np.where(seen[rows, new], n, new)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            seen[rows, new] = True
            width = int((new < n).sum(1).max(initial=0))
            if width:
                new = np.take_along_axis(new, np.argsort(new >= n, axis=1, kind="stable")[:, :width], 1)
                got = np.full(new.shape, -np.inf, np.float32)
                i, j = np.nonzero(new < n)
                for s in range(0, len(i), 1 << 17):
                    a, b = i[s:s + (1 << 17)], j[s:s + (1 << 17)]
                    got[a, b] = np.einsum("ij,ij->i", self.v[new[a, b]], q[a])
                ids, sim = np.concatenate([ids, new], 1), np.concatenate([sim, got], 1)
                closed = np.concatenate([closed, new >= n], 1)
                best = np.argsort(-sim, axis=1, kind="stable")[:, :beam]
                ids, sim, closed = (np.take_along_axis(x, best, 1) for x in (ids, sim, closed))

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the ``beam`` best nodes found for each query, best first."""
        q = np.ascontiguousarray(q, np.float32)
        entry = np.full((len(q), 1), self.entry)
        for k in range(len(self.links) - 1, 0, -1):
            entry = self._beam(q, entry, k, 8)[0]
        return self._beam(q, entry, 0, beam)

    def within(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of similarity ``least`` or more; beams that end above it are widened."""
        found_q, found_n = [], []
        todo = np.arange(len(q))
        while len(todo):
            wide = []
            size = max(8, min(256, (1 << 22) // max(1, len(self.v)), (1 << 16) // beam))
            for s in range(0, len(todo), size):
                part = todo[s:s + size]
                ids, sim = self.search(q[part], beam)
                over = (sim[:, -1] >= least) & (ids.shape[1] >= beam) if beam < len(self.v) else np.zeros(len(part), bool)
                i, j = np.nonzero((sim >= least) & (ids >= 0) & ~over[:, None])
                found_q.append(part[i])
                found_n.append(ids[i, j])
                wide.append(part[over])
            todo, beam = np.concatenate(wide), beam * 4
        return np.concatenate(found_q or [np.zeros(0, np.int64)]), np.concatenate(found_n or [np.zeros(0, np.int64)])
