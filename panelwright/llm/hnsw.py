"""Hierarchical navigable small-world graph over unit vectors, searched for many queries at once.

Nodes are ordered by their level, the highest first, so that each layer is a
prefix of the nodes. All steps run over blocks of queries in numpy.
"""

from __future__ import annotations

import io

import numpy as np

LINKS = 24  # most links of a node in a layer
CHOSEN = 12  # links a new node gets
BUILD_BEAM = 32
BLOCK = 256
EXPANDED = 4  # beam entries expanded at once
AUDIT = 64  # least number of queries of each kind in a recall audit
AUDITED = 16  # one node in so many is a query of the audit, if these are more
RECALL = 0.995  # that an audit has to reach in each class of queries


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 1, least: float = 0.98, others: np.ndarray | None = None):
        """``others`` are vectors outside the graph that the audit queries too."""
        rng = np.random.default_rng(seed)
        level = np.minimum(np.floor(-np.log(1 - rng.random(len(vectors))) / np.log(CHOSEN)).astype(int), 6)
        self.order = np.argsort(-level, kind="stable")
        #: raw vectors in node order, their lengths, and unit vectors in single precision for the search
        self.raw = np.ascontiguousarray(vectors[self.order], np.float64)
        self.norms = np.sqrt((self.raw * self.raw).sum(1))
        self.unit = (self.raw / self.norms[:, None]).astype(np.float32)
        counts = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
        self.layers: list[np.ndarray] = [np.full((c, LINKS), -1, np.int32) for c in counts]
        for k in range(len(counts) - 1, -1, -1):
            self._build(k)
        self.beam = 32
        self._audit(least, others, rng)

    def _build(self, layer: int) -> None:
        links, n = self.layers[layer], len(self.layers[layer])
        at = 0
        while at < n:
            size = min(n - at, BLOCK if at == 0 else max(BLOCK, min(1024, at // 2)))
            new = np.arange(at, at + size)
            x = self.unit[new]
            inner = x @ x.T
            np.fill_diagonal(inner, -2)
            inner[np.triu_indices(size)] = -2  # links go to nodes before; the reverse links follow
            keep = min(16, size)
            near = np.argpartition(-inner, keep - 1, axis=1)[:, :keep]
            ids, sims = near + at, np.take_along_axis(inner, near, 1)
            ids[sims < -1.5] = -1
            if at:
                found = [self._search(layer, x[lo : lo + BLOCK], BUILD_BEAM, at) for lo in range(0, size, BLOCK)]
                ids = np.concatenate([np.concatenate([f[0] for f in found]), ids], 1)
                sims = np.concatenate([np.concatenate([f[1] for f in found]), sims], 1)
            links[new, :CHOSEN] = self._choose(ids, sims, CHOSEN)
            self._reverse(links, new)
            at += size

    def _choose(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates those nearer to the row than to a chosen one; free places go to the nearest left."""
        out = np.full((len(ids), most), -1, np.int32)
        for lo in range(0, len(ids), BLOCK):
            part, own = ids[lo : lo + BLOCK], np.where(ids[lo : lo + BLOCK] < 0, -2, sims[lo : lo + BLOCK])
            order = np.argsort(-own, axis=1, kind="stable")
            part, own = np.take_along_axis(part, order, 1), np.take_along_axis(own, order, 1)
            same = np.zeros(part.shape, bool)
            for k in range(1, part.shape[1]):
                same[:, k] = (part[:, :k] == part[:, k : k + 1]).any(1)
            own = np.where(same | (part < 0), -2, own)
            v = self.unit[np.maximum(part, 0)]
            between = v @ v.transpose(0, 2, 1)
            closest = np.full(part.shape, -2.0, np.float32)  # to what is chosen already
            taken = np.zeros(part.shape, bool)
            for k in range(part.shape[1]):
                ok = (own[:, k] > -1.5) & (own[:, k] > closest[:, k]) & (taken.sum(1) < most)
                taken[:, k] = ok
                closest = np.where(ok[:, None], np.maximum(closest, between[:, k]), closest)
            rank = np.where(taken, 4 + own, np.where(own > -1.5, own, -9))
            best = np.argsort(-rank, axis=1, kind="stable")[:, :most]
            chosen = np.where(np.take_along_axis(rank, best, 1) > -5, np.take_along_axis(part, best, 1), -1)
            out[lo : lo + BLOCK, : chosen.shape[1]] = chosen
        return out

    def _reverse(self, links: np.ndarray, new: np.ndarray) -> None:
        source = np.repeat(new, CHOSEN)
        target = links[new, :CHOSEN].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.lexsort((-np.einsum("ij,ij->i", self.unit[source], self.unit[target]), target))
        source, target = source[order], target[order]
        nodes, begin, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(begin, count)
        some = place < 2 * LINKS  # of a popular node's new links the nearest are weighed
        extra = np.full((len(nodes), 2 * LINKS), -1, np.int32)
        extra[np.repeat(np.arange(len(nodes)), count)[some], place[some]] = source[some]
        both = np.concatenate([links[nodes], extra], 1)
        fits = (both >= 0).sum(1) <= LINKS
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :LINKS]
        links[nodes[fits]] = packed[fits]
        over = np.flatnonzero(~fits)
        for lo in range(0, len(over), BLOCK):
            part = over[lo : lo + BLOCK]
            sims = np.einsum("ijk,ik->ij", self.unit[np.maximum(both[part], 0)], self.unit[nodes[part]])
            links[nodes[part]] = self._choose(both[part], sims, LINKS)

    def _search(self, layer: int, x: np.ndarray, beam: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest of the layer's first ``n`` nodes: ids (-1 where none) and similarities, best first."""
        entry = np.zeros(len(x), np.int64)
        for k in range(len(self.layers) - 1, layer, -1):
            entry = self._beam(self.layers[k], x, entry, 4)[0][:, 0].astype(np.int64)
        return self._beam(self.layers[layer], x, np.where(entry < n, entry, 0), beam)

    def _beam(self, links: np.ndarray, x: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        q = len(x)
        seen = np.zeros((q, len(links)), bool)
        rows = np.arange(q)
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -2, np.float32)
        done = np.ones((q, beam), bool)
        ids[:, 0], sims[:, 0], done[:, 0] = entry, np.einsum("ij,ij->i", x, self.unit[entry]), False
        seen[rows, entry] = True
        active = rows
        while len(active):
            open_ = np.where(done[active], -3, sims[active])
            pick = np.argsort(-open_, axis=1)[:, :EXPANDED]
            good = np.take_along_axis(open_, pick, 1) > -2.5
            done[active[:, None], pick] = True
            near = links[np.where(good, ids[active[:, None], pick], 0)]
            near = np.where(good[:, :, None], near, -1).reshape(len(active), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            seen[active[r], near[r, c]] = True
            own = np.full(near.shape, -2, np.float32)
            own[r, c] = np.einsum("ij,ij->i", x[active[r]], self.unit[near[r, c]])
            all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], 1)
            all_sims = np.concatenate([sims[active], own], 1)
            all_done = np.concatenate([done[active], ~fresh], 1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
            active = active[~done[active].all(1)]
        return ids, sims

    def cosines(self, vector: np.ndarray, norm: float, nodes: np.ndarray) -> np.ndarray:
        """Cosines in double precision."""
        return (self.raw[nodes] @ vector) / (self.norms[nodes] * norm)

    def within(self, raw: np.ndarray, least: float, beam: int | None = None) -> list[np.ndarray]:
        """Nodes whose cosine with each query is ``least`` or more.

        A beam finds the neighbourhood; from its matches the links are followed as long as they lead to near nodes.
        """
        beam = self.beam if beam is None else beam
        norms = np.sqrt((raw * raw).sum(1))
        if beam >= len(self.raw):
            return self.exact(raw, least)
        unit = (raw / norms[:, None]).astype(np.float32)
        out: list[np.ndarray] = []
        slack = least - (1 - least) / 2  # nodes that may still lead to matches
        for lo in range(0, len(raw), BLOCK):
            ids, sims = self._search(0, unit[lo : lo + BLOCK], beam, len(self.raw))
            for i, (near, s) in enumerate(zip(ids, sims)):
                front = near[(near >= 0) & (s >= slack)]
                if len(front) < 2:  # at most the query itself
                    cos = self.cosines(raw[lo + i], norms[lo + i], front)
                    out.append(front[cos >= least])
                    continue
                seen = np.zeros(len(self.raw), bool)
                seen[near[near >= 0]] = True
                hits = []
                while len(front):
                    cos = self.cosines(raw[lo + i], norms[lo + i], front)
                    hits.append(front[cos >= least])
                    step = np.unique(self.layers[0][front[cos >= slack]])
                    step = step[step >= 0]
                    step = step[~seen[step]]
                    seen[step] = True
                    front = step
                out.append(np.concatenate(hits))
        return out

    def exact(self, raw: np.ndarray, least: float) -> list[np.ndarray]:
        """The same by comparison with every node, in blocks."""
        out: list[np.ndarray] = []
        norms = np.sqrt((raw * raw).sum(1))
        for lo in range(0, len(raw), BLOCK):
            cos = (raw[lo : lo + BLOCK] @ self.raw.T) / (norms[lo : lo + BLOCK, None] * self.norms)
            out.extend(np.flatnonzero(c >= least) for c in cos)
        return out

    def _probes(self, nodes: np.ndarray, least: float, rng: np.random.Generator) -> np.ndarray:
        """Vectors outside the graph, each with a cosine of ``least`` or somewhat more with one of the nodes."""
        base = self.raw[nodes] / self.norms[nodes, None]
        side = rng.normal(size=base.shape)
        side -= (side * base).sum(1, keepdims=True) * base
        side /= np.sqrt((side * side).sum(1, keepdims=True))
        cos = least + (1 - least) * rng.uniform(0.05, 0.9, (len(nodes), 1))
        return cos * base + np.sqrt(1 - cos * cos) * side

    def _audit(self, least: float, others: np.ndarray | None, rng: np.random.Generator) -> None:
        """Doubles the beam until sampled queries find what an exact comparison finds; beyond 512 every node is compared.

        Queries are nodes, probes close to nodes, and ``others``. The recall of a
        query is its own share of found matches, itself left out; queries of one
        kind whose numbers of matches have the same power of two form a class, and
        the mean recall of every class has to reach ``RECALL``.
        """
        n = len(self.raw)
        if self.beam >= n:
            return
        count = min(n, max(AUDIT, n // AUDITED))
        pick = np.linspace(0, n - 1, count).astype(int)
        kinds = [(self.raw[pick], pick)]
        if self.raw.shape[1] > 1:
            kinds.append((self._probes(rng.integers(0, n, count), least, rng), None))
        if others is not None and len(others):
            kinds.append((others, None))
        # matches at the threshold are rare in some data, so nearest neighbours are audited too
        nearest = []
        for lo in range(0, count, BLOCK):
            sims = self.unit[pick[lo : lo + BLOCK]] @ self.unit.T
            sims[np.arange(len(sims)), pick[lo : lo + BLOCK]] = -2
            nearest.append(sims.argmax(1))
        nearest = np.concatenate(nearest)
        exact = [self.exact(raw, least) for raw, _ in kinds]
        while self.beam < n:
            close = [(self._search(0, self.unit[pick[lo : lo + BLOCK]], self.beam, n)[0] == nearest[lo : lo + BLOCK, None]).any(1) for lo in range(0, count, BLOCK)]
            if np.concatenate(close).mean() >= 0.9 and all(self._recalls(raw, own, want, least) >= RECALL for (raw, own), want in zip(kinds, exact)):
                break
            self.beam = self.beam * 2 if self.beam < 512 else n

    def _recalls(self, raw: np.ndarray, own: np.ndarray | None, exact: list[np.ndarray], least: float) -> float:
        """The least mean recall of a class of queries; ``own`` are the nodes that the queries are, if they are any."""
        sums = np.zeros((64, 2))
        for i, (got, want) in enumerate(zip(self.within(raw, least), exact)):
            if own is not None:
                want = want[want != own[i]]
            if len(want):
                sums[len(want).bit_length()] += np.isin(want, got).mean(), 1
        some = sums[sums[:, 1] > 0]
        return float((some[:, 0] / some[:, 1]).min(initial=1.0))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, order=self.order, raw=self.raw, beam=np.array(self.beam), **{f"layer{k}": x for k, x in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Graph:
        new = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as got:
            new.order, new.raw, new.beam = got["order"], got["raw"], int(got["beam"])
            new.layers = [got[f"layer{k}"] for k in range(len(got.files) - 3)]
        new.norms = np.sqrt((new.raw * new.raw).sum(1))
        new.unit = (new.raw / new.norms[:, None]).astype(np.float32)
        return new
