"""The most similar vectors of every vector, by an inverted file with adaptive dimension scans, on two levels.

Per collection (index version) a balanced bisecting tree over a bounded sample gives blocks of about BLOCK vectors, the
units of work. Every distinct vector asks its nearest block and the blocks that reach nearer than a neighbour of its own can
lie: a block is left out if the plane between the two centroids is farther away than the radius within which vectors of
the home block have their neighbours (measured on the sample), and VISITS at most are asked. It is listed in its nearest
block, and beyond VISITS blocks in the SPILL nearest, to which it goes anyway. The task of a block bisects its vectors into cells of about CELL, however dense a region is; an asker probes its nearest cells. Vectors
are rotated at random, so the first columns are an unbiased sample of a distance: lists are scanned in column blocks, and
a candidate whose partial distance is beyond what the asker's k-th best distance allows (a hypothesis test of false
rejection, after every column block) is abandoned before the rest is computed. Copies of one direction are one entry with
all its ids, so a group of copies of any size costs nothing. Blocks with many vectors or askers are split into parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chronofact.session import cut

K = 5
#: Vectors per cell aimed at; cells probed in the home block, half as many in others; vectors per block aimed at.
CELL, PROBES, BLOCK = 128, 32, 16_384
#: Blocks an asker goes to at most, and in how many of them it is listed if there are more than that.
VISITS, SPILL = 8, 3
#: The blocks are fitted on at most so many vectors of a collection (one task's memory), on PER_BLOCK a block below that.
SAMPLE, PER_BLOCK = 262_144, 1024
#: Bytes of vectors that one task holds: a block with more listed vectors or askers is split.
PART_BYTES = 96 << 20
#: Share of the sample's vectors whose neighbours lie within the radius of their block.
RADIUS_SHARE = 0.95
#: Centroids are searched in two steps beyond so many.
TWO_STEPS = 1024
#: Kept per asker beyond K for the exact ranking in double precision.
SPARE = 3
#: Width of the hypothesis test: chances of abandoning a true neighbour fall as exp(-EPSILON^2 / 2).
EPSILON = 2.4
#: Above this share of survivors the next columns are computed for all pairs at once.
DENSE = 0.03


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def bisect_cells(x: np.ndarray, cells: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids of a balanced tree, in the order of its leaves: neighbours in the order are neighbours in space."""
    out: list[np.ndarray] = []
    stack = [(np.arange(len(x)), cells)]
    while stack:
        rows, n = stack.pop()
        if n <= 1 or len(rows) <= 1:
            c = x[rows].mean(axis=0)
            out.append(c / max(float(np.linalg.norm(c)), 1e-12))
            continue
        part = x[rows]
        two = part[rng.choice(len(rows), 2, replace=False)]
        for _ in range(4):  # direction between two means
            side = part @ (two[0] - two[1]) > 0
            if side.all() or not side.any():
                break
            two = np.stack([part[side].mean(axis=0), part[~side].mean(axis=0)])
        along = part @ (two[0] - two[1])
        left = n // 2
        at = len(rows) * left // n
        order = np.argpartition(along, at)
        stack.append((rows[order[at:]], n - left))
        stack.append((rows[order[:at]], left))
    return np.asarray(out, dtype=np.float32)


def fit(x: np.ndarray, n: int, size: int | None = None, seed: int = 5) -> np.ndarray:
    """Centroids of cells of about `size` (CELL) for n vectors from unit vectors x, all or a sample; two rounds of reassignment."""
    cells = int(max(1, min(round(n / (size or CELL)), len(x) // 4 or 1)))
    c = bisect_cells(x, cells, np.random.default_rng(seed))
    for _ in range(2):
        near = np.concatenate([np.argmax(x[i : i + 8192] @ c.T, axis=1) for i in range(0, len(x), 8192)])
        count = np.bincount(near, minlength=len(c))
        order = np.argsort(near, kind="stable")
        first = np.searchsorted(near[order], np.arange(len(c)))
        some = np.flatnonzero(count)
        mean = np.add.reduceat(x[order], first[some], axis=0)
        c = c.copy()
        c[some] = mean / np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-12)
    return c


def nearest_cells(x: np.ndarray, c: np.ndarray, probes: int) -> np.ndarray:
    """The nearest cells of each vector, the nearest first."""
    probes = min(probes, len(c))
    out = np.empty((len(x), probes), dtype=np.int32)
    for i in range(0, len(x), 4096):
        s = x[i : i + 4096] @ c.T
        top = np.argpartition(-s, probes - 1, axis=1)[:, :probes]
        out[i : i + 4096] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, axis=1), axis=1, kind="stable"), axis=1)
    return out


class Scan:
    """Search of one block: lists of rotated unit vectors, scanned in column blocks."""

    def __init__(self, x: np.ndarray, cell: np.ndarray, keep: int, k: int = K):
        dims = x.shape[1]
        self.keep, self.dims, self.k = keep, dims, k
        self.x = x
        self.order = np.argsort(cell, kind="stable")
        self.cells, self.first = np.unique(cell[self.order], return_index=True)
        self.end = np.append(self.first[1:], len(cell))
        # each list around its own mean: distances stay exact in single precision however close its vectors lie
        self.listed = x[self.order]
        self.mean = np.add.reduceat(self.listed, self.first, axis=0) / (self.end - self.first)[:, None]
        self.listed = self.listed - np.repeat(self.mean, self.end - self.first, axis=0)
        # the test comes after 16, 32, 64, ... columns
        self.cuts = [*(16 << i for i in range(max(0, (dims - 1) // 16).bit_length())), dims]
        self.norms = self._norms(self.listed)

    def _norms(self, x: np.ndarray) -> list[np.ndarray]:
        """Squared norms by column block."""
        return [np.einsum("ij,ij->i", x[:, a:b], x[:, a:b]) for a, b in zip([0, *self.cuts], self.cuts, strict=False)]

    def run(self, q: np.ndarray, probes: np.ndarray, self_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, squared distances) of the nearest listed vectors per asker; probes: cells in order, -1 for none.

        self_row: the listed row that is the asker itself, or -1.
        """
        n = len(q)
        best = np.full((n, self.keep), np.inf, dtype=np.float32)
        rows = np.full((n, self.keep), -1, dtype=np.int64)
        place = {int(c): i for i, c in enumerate(self.cells)}
        for p in range(probes.shape[1]):  # nearest lists first: bounds are tight when the others are scanned
            order = np.argsort(probes[:, p], kind="stable")
            cells, first = np.unique(probes[order, p], return_index=True)
            left: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for cell, a, b in zip(cells, first, [*first[1:], n], strict=True):
                i = place.get(int(cell))
                if i is not None:
                    for s in range(a, b, 2048):
                        who = order[s : min(b, s + 2048)]
                        if p == 0:
                            self._home(q[who] - self.mean[i], who, i, best, rows, self_row)
                        else:
                            left.append(self._list(q[who] - self.mean[i], who, i, best))
            if left:
                self._merge(*(np.concatenate(x) for x in zip(*left, strict=True)), best, rows, self_row)
        return rows, best

    def _home(self, q, who, i, best, rows, self_row) -> None:
        """The first list of an asker, in full: it sets the bound for all others."""
        lo, hi = self.first[i], self.end[i]
        d = np.einsum("ij,ij->i", q, q)[:, None] + sum(x[lo:hi] for x in self.norms)[None, :] - 2 * (q @ self.listed[lo:hi].T)
        at = self.order[lo:hi]
        d[at[None, :] == self_row[who][:, None]] = np.inf
        keep = min(self.keep, hi - lo)
        top = np.argpartition(d, keep - 1, axis=1)[:, :keep]
        found = np.take_along_axis(d, top, axis=1)
        pick = np.argsort(found, axis=1, kind="stable")
        best[who, :keep] = np.take_along_axis(found, pick, axis=1)
        rows[who, :keep] = np.where(np.isfinite(best[who, :keep]), np.take_along_axis(at[top], pick, axis=1), -1)

    def _list(self, q, who, i, best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A further list, column block by column block; what the test leaves over: (askers, rows, squared distances)."""
        lo, hi = self.first[i], self.end[i]
        bound = best[who, self.k - 1]
        norms = self._norms(q)
        d, start = None, 0
        for j, stop in enumerate(self.cuts):
            part = q[:, start:stop] @ self.listed[lo:hi, start:stop].T
            part *= -2
            part += norms[j][:, None]
            part += self.norms[j][None, lo:hi]
            d = part if d is None else np.add(d, part, out=d)
            start = stop
            # test: can the whole distance be within the bound, given the part of it seen so far
            limit = best[who, -1] if stop == self.dims else bound * np.float32((stop / self.dims) * (1 + EPSILON / np.sqrt(stop)) ** 2)
            alive = np.flatnonzero((d <= limit[:, None]).ravel())
            if not len(alive) or stop == self.dims or len(alive) < DENSE * d.size:
                break
        qi, ci = np.divmod(alive, hi - lo)
        rest = d.ravel()[alive]
        if stop < self.dims and len(alive):
            diff = q[qi, stop:] - self.listed[lo + ci, stop:]
            rest = rest + np.einsum("ij,ij->i", diff, diff)
        ok = rest < best[who[qi], -1]
        return who[qi[ok]], self.order[lo + ci[ok]], rest[ok]

    def _merge(self, who, row, d, best, rows, self_row) -> None:
        """Put pairs into the askers' lists, all at once."""
        ok = row != self_row[who]
        who, row, d = who[ok], row[ok], d[ok]
        order = np.lexsort((row, d, who))
        who, row, d = who[order], row[order], d[order]
        askers, first = np.unique(who, return_index=True)
        at = np.repeat(np.arange(len(askers)), np.diff(np.append(first, len(who))))
        place = np.arange(len(who)) - first[at]
        ok = place < self.keep
        new = np.full((len(askers), self.keep), np.inf, dtype=np.float32)
        ids = np.full((len(askers), self.keep), -1, dtype=np.int64)
        new[at[ok], place[ok]], ids[at[ok], place[ok]] = d[ok], row[ok]
        both = np.concatenate([best[askers], new], axis=1)
        ids = np.concatenate([rows[askers], ids], axis=1)
        pick = np.argsort(both, axis=1, kind="stable")[:, : self.keep]
        best[askers] = np.take_along_axis(both, pick, axis=1)
        rows[askers] = np.take_along_axis(ids, pick, axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- on the cluster -------------------------------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float32, copy=False)


def usable_vectors(vectors: DataFrame, versions: DataFrame) -> DataFrame:
    """index_version, vec_id, embedding of rows that can be compared: an id, a known version, of its dims, all components
    finite, not all zero. Null components and unknown versions are not usable."""
    dims = versions.where("index_version is not null and dims is not null").groupBy("index_version").agg(F.max("dims").alias("dims"))
    e = F.col("embedding")
    inf = F.lit(float("inf"))
    # NaN is the greatest of an array; nulls are left out by array_compact
    finite = (F.size(F.array_compact(e)) == F.col("dims")) & (F.array_max(e) < inf) & (F.array_min(e) > -inf)
    return (
        vectors.select("index_version", "vec_id", "embedding")
        .join(dims, "index_version")
        .where(F.col("vec_id").isNotNull() & (F.size(e) == F.col("dims")) & finite & ((F.array_max(e) > 0) | (F.array_min(e) < 0)))
        .select("index_version", "vec_id", "embedding")
    )


def _directions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128 bits of every vector's direction: vectors that are multiples of each other, exactly, have the same."""
    for b in batches:
        t = pa.Table.from_batches([b])
        for v in t.column("index_version").unique().to_pylist():
            part = t.filter(pa.compute.equal(t.column("index_version"), v))
            x = _matrix(part.column("embedding")).astype(np.float64)
            bits = (x / np.abs(x).max(axis=1, keepdims=True) + 0.0).view(np.uint64)
            bits = (bits ^ (bits >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            odd = np.random.default_rng(x.shape[1]).integers(0, 1 << 63, (2, x.shape[1]), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            h = [((bits ^ (bits >> np.uint64(29))) * o).sum(axis=1, dtype=np.uint64).view(np.int64) for o in odd]
            yield pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in (part.column(k) for k in ("index_version", "vec_id", "x1", "x2"))] + [pa.array(x, pa.int64()) for x in h], names=["index_version", "vec_id", "x1", "x2", "h1", "h2"])


def near_centroids(x: np.ndarray, c: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, cosines) of the n nearest of each vector, the nearest first. Beyond TWO_STEPS centroids only those of the
    nearest runs of neighbouring leaves are compared."""
    n = min(n, len(c))
    if len(c) <= TWO_STEPS:
        top = nearest_cells(x, c, n)
        return top, np.einsum("ij,ikj->ik", x, c[top])
    run = int(len(c) ** 0.5)
    firsts = np.arange(0, len(c), run)
    heads = np.stack([m / max(float(np.linalg.norm(m)), 1e-12) for m in (c[f : f + run].mean(axis=0) for f in firsts)]).astype(np.float32)
    out, cos = np.empty((len(x), n), dtype=np.int32), np.empty((len(x), n), dtype=np.float32)
    width = max(12, -(-2 * n // run))
    for a in range(0, len(x), 256):
        q = x[a : a + 256]
        runs = nearest_cells(q, heads, width)
        some = (runs[:, :, None] * run + np.arange(run)).reshape(len(q), -1)
        s = np.where(some < len(c), np.einsum("ij,ikj->ik", q, c[np.minimum(some, len(c) - 1)]), -2)
        top = np.argsort(-s, axis=1, kind="stable")[:, :n]
        out[a : a + 256], cos[a : a + 256] = np.take_along_axis(some, top, 1), np.take_along_axis(s, top, 1)
    return out, cos


@dataclass
class Blocks:
    """Blocks of one version: centroids, radius of each, and into how many parts its listed vectors and its askers go."""

    centroids: np.ndarray
    radius: np.ndarray
    lists: np.ndarray
    askers: np.ndarray

    @property
    def spill(self) -> int:
        return SPILL if len(self.centroids) > VISITS else 1

    def visited(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, blocks, places) of all visits; a vector's home block has place 0, and it is listed below `spill`."""
        near, cos = near_centroids(u, self.centroids, VISITS)
        home = near[:, :1]
        apart = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ikj->ik", self.centroids[home[:, 0]], self.centroids[near]), 1e-12))
        plane = (cos[:, :1] - cos) / apart  # how far away the plane between the two centroids is
        go = plane <= self.radius[home]
        go[:, 0] = True
        who, place = np.nonzero(go)
        return who, near[who, place], place


def fit_blocks(u: np.ndarray, n: int, k: int) -> Blocks:
    """Blocks for n vectors from a sample of rotated unit vectors."""
    c = fit(u, n, BLOCK)
    home = near_centroids(u, c, 1)[0][:, 0]
    radius = np.full(len(c), 2.0, dtype=np.float32)
    for b in range(len(c)):  # in a sample neighbours are farther away, so the radius errs on the side of more visits
        own = u[np.flatnonzero(home == b)[:PER_BLOCK]]
        if len(own) > 2 * k:
            s = own @ own.T
            np.fill_diagonal(s, -2)
            radius[b] = np.quantile(np.sqrt(np.maximum(2 - 2 * np.partition(s, -k, axis=1)[:, -k], 0)), RADIUS_SHARE)
    blocks = Blocks(c, radius, np.ones(len(c), dtype=np.int64), np.ones(len(c), dtype=np.int64))
    scale = n / len(u) * u.shape[1] * 4 / (PART_BYTES / 2)
    _, block, place = blocks.visited(u)
    parts = lambda rows: np.maximum(1, np.ceil(np.bincount(rows, minlength=len(c)) * scale).astype(np.int64))
    blocks.lists, blocks.askers = parts(block[place < blocks.spill]), parts(block)
    return blocks


def _fit_group(k: int):
    def run(table: pa.Table) -> pa.Table:
        x = np.unique(_matrix(table.column("embedding")), axis=0)
        b = fit_blocks(unit(x).astype(np.float32) @ rotation(x.shape[1]), table.column("n")[0].as_py(), k)
        return pa.table({"index_version": pa.array([table.column("index_version")[0].as_py()], pa.string()), "dims": pa.array([x.shape[1]], pa.int32()), "centroids": pa.array([b.centroids.astype(np.float32).tobytes()], pa.binary()), "radius": pa.array([b.radius.tolist()], pa.list_(pa.float32())), "lists": pa.array([b.lists.tolist()], pa.list_(pa.int64())), "askers": pa.array([b.askers.tolist()], pa.list_(pa.int64()))})

    return run


def fit_versions(usable: DataFrame, counts: dict[str, int], k: int) -> dict[str, Blocks]:
    """Blocks of the versions that have several. A version's sample is drawn by hash of the id: PER_BLOCK vectors a block,
    at most SAMPLE; it is fitted by one task. The driver gets the centroids, at most SAMPLE / 4 a version."""
    several = {v: n for v, n in counts.items() if round(n / BLOCK) > 1}
    if not several:
        return {}
    spark = usable.sparkSession
    rate = {v: min(1.0, min(SAMPLE, max(4096, n * PER_BLOCK // BLOCK)) / n) for v, n in several.items()}
    plan = spark.createDataFrame([(v, n, int(rate[v] * (1 << 31))) for v, n in several.items()], "index_version string, n bigint, upto bigint")
    sample = usable.join(F.broadcast(plan), "index_version").where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 31)) < F.col("upto")).select("index_version", "n", "embedding")
    rows = sample.groupBy("index_version").applyInArrow(_fit_group(k), "index_version string, dims int, centroids binary, radius array<float>, lists array<bigint>, askers array<bigint>").collect()
    return {r["index_version"]: Blocks(np.frombuffer(r["centroids"], dtype=np.float32).reshape(-1, r["dims"]), np.array(r["radius"], dtype=np.float32), np.array(r["lists"]), np.array(r["askers"])) for r in rows}


#: role: 1 listed, 2 asks, 3 both.
_ASK = "index_version string, block int, part int, rep bigint, members array<bigint>, home boolean, role int, embedding array<float>"


def _assign(fitted):
    """fitted: a broadcast of Blocks by version. Rows for the blocks: each vector in the blocks it is listed in, and as an asker in every other block it visits; in
    blocks of several parts, listed in one part of the lists for all parts of askers, and asking in all parts of the lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = fitted.value
        for b in batches:
            t = pa.Table.from_batches([b])
            for v in t.column("index_version").unique().to_pylist():
                part = t.filter(pa.compute.equal(t.column("index_version"), v))
                x = _matrix(part.column("embedding"))
                n, dims = x.shape
                reps = part.column("rep").to_numpy().astype(np.uint64)
                hashed = (reps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
                if v in blocks:
                    own = blocks[v]
                    who, block, place = own.visited(unit(x).astype(np.float32) @ rotation(dims))
                    home, in_lists = place == 0, place < own.spill
                    lists, askers = own.lists[block], own.askers[block]
                else:  # one block, without parts
                    who, block, home = np.arange(n), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
                    in_lists = home
                    lists = askers = np.ones(n, dtype=np.int64)
                in_list = (hashed[who] % lists.astype(np.uint64)).astype(np.int64)
                in_asker = ((hashed[who] >> np.uint64(20)) % askers.astype(np.uint64)).astype(np.int64)
                # as askers: all parts of the lists
                at = np.repeat(np.arange(len(who)), lists)
                l = np.arange(len(at)) - np.repeat(np.cumsum(lists) - lists, lists)
                listed = in_lists[at] & (l == in_list[at])
                rows = [(at, l * askers[at] + in_asker[at], np.where(listed, 3, 2))]
                # as listed vectors: the other parts of the askers
                more = np.flatnonzero(in_lists & (askers > 1))
                at = np.repeat(more, askers[more])
                a = np.arange(len(at)) - np.repeat(np.cumsum(askers[more]) - askers[more], askers[more])
                ok = a != in_asker[at]
                rows.append((at[ok], (in_list[at] * askers[at] + a)[ok], np.ones(int(ok.sum()), dtype=np.int64)))
                at, piece, role = (np.concatenate(c) for c in zip(*rows, strict=True))
                take = pa.array(who[at])
                members = part.column("members").combine_chunks().take(take)
                rep = part.column("rep").combine_chunks().take(take)
                for i in range(0, len(at), 65_536):
                    j = slice(i, i + 65_536)
                    m = len(at[j])
                    flat = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
                    yield pa.record_batch(
                        {
                            "index_version": pa.array([v] * m, pa.string()),
                            "block": pa.array(block[at[j]], pa.int32()),
                            "part": pa.array(piece[j], pa.int32()),
                            "rep": flat(rep.slice(i, m)),
                            "members": flat(members.slice(i, m)),
                            "home": pa.array(home[at[j]]),
                            "role": pa.array(role[j], pa.int32()),
                            "embedding": pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * dims, pa.int32()), pa.array(x[who[at[j]]].ravel(), pa.float32())),
                        }
                    )

    return run


_FOUND = "index_version string, rep bigint, copies int, ids array<bigint>, cosines array<double>"


def search_block(u: np.ndarray, listed: np.ndarray, asks: np.ndarray, home: np.ndarray, k: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(listed rows, squared distances) of the nearest of each asker; listed, asks: rows of u."""
    keep = k + SPARE
    if not len(listed):
        return np.full((len(asks), keep), -1, dtype=np.int64), np.full((len(asks), keep), np.inf, dtype=np.float32)
    place = np.full(len(u), -1, dtype=np.int64)
    place[listed] = np.arange(len(listed))
    c = fit(u[listed], len(listed))
    cell = nearest_cells(u[listed], c, 1)[:, 0]
    near = nearest_cells(u[asks], c, probes)
    near[~home, max(1, -(-probes // 2)) :] = -1
    return Scan(u[listed], cell, keep, k).run(u[asks], near, place[asks])


def _rank_crowded(exact: np.ndarray, listed: np.ndarray, asks: np.ndarray, rows: np.ndarray, d: np.ndarray, rep: np.ndarray, k: int) -> np.ndarray:
    """rows, with those of askers for whom single precision can't tell the kept from the left out found anew in doubles:
    all listed vectors of the part are compared, equal cosines go by id."""
    crowded = np.flatnonzero((rows[:, -1] >= 0) & (d[:, -1] <= d[:, k - 1] * (1 + 1e-4) + 1e-12))
    for a in range(0, len(crowded), 256):
        some = crowded[a : a + 256]
        s = np.round(exact[asks[some]] @ exact[listed].T, 12)
        s[listed[None, :] == asks[some][:, None]] = -2
        for i, at in enumerate(some):
            least = np.partition(s[i], -k)[-k] if len(listed) > k else -2
            may = np.flatnonzero(s[i] >= least)
            best = may[np.lexsort((rep[listed[may]], -s[i][may]))][: rows.shape[1]]
            rows[at] = -1
            rows[at, : len(best)] = best
    return rows


def _search_group(k: int, probes: int):
    def run(table: pa.Table) -> pa.Table:
        """Search of one part. The askers' found classes come with the ids of their copies and the cosine in doubles."""
        _, once = np.unique(np.stack([table.column("rep").to_numpy(), table.column("role").to_numpy()]), axis=1, return_index=True)
        if len(once) < table.num_rows:
            table = table.take(pa.array(np.sort(once)))
        raw = _matrix(table.column("embedding"))
        exact = unit(raw)
        u = exact.astype(np.float32) @ rotation(raw.shape[1])
        role, home, rep = (table.column(c).to_numpy() for c in ("role", "home", "rep"))
        listed, asks = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        members = table.column("members").to_pylist()
        rows, d = search_block(u, listed, asks, home[asks], k, probes)
        rows = _rank_crowded(exact, listed, asks, rows, d, rep, k)
        ids: list[list[int]] = []
        cosines: list[list[float]] = []
        for a in range(0, len(asks), 4096):
            part = rows[a : a + 4096]
            cos = np.einsum("ij,ikj->ik", exact[asks[a : a + 4096]], exact[listed[np.maximum(part, 0)]]) if len(listed) else np.zeros(part.shape)
            for found, c in zip(np.where(part >= 0, listed[part] if len(listed) else -1, -1).tolist(), cos.tolist(), strict=True):
                i, s = [], []
                for f, x in zip(found, c, strict=True):
                    if f >= 0:
                        m = members[f]
                        i += m
                        s += [x] * len(m)
                ids.append(i)
                cosines.append(s)
        for at, r in enumerate(asks.tolist()):  # copies of the asker are found at its home
            if home[r] and role[r] == 3 and len(members[r]) > 1:
                ids[at] = members[r] + ids[at]
                cosines[at] = [1.0] * len(members[r]) + cosines[at]
        return pa.table({"index_version": table.column("index_version").take(pa.array(asks)), "rep": pa.array(rep[asks], pa.int64()), "copies": pa.array([len(members[r]) for r in asks.tolist()], pa.int32()), "ids": pa.array(ids, pa.list_(pa.int64())), "cosines": pa.array(cosines, pa.list_(pa.float64()))})

    return run


#: A group of copies is spread over so many parts when its ids are put back.
SALTS = 16


def similar_vectors(vectors: DataFrame, versions: DataFrame, k: int = K, probes: int = PROBES) -> DataFrame:
    """The k most similar vectors of every usable vector: vec_id, rank (from 1), neighbour, cosine.

    Neighbours are of the same version, a vector isn't its own; equal cosines (to 12 places): smaller vec_id first.
    Repeated rows count once; of an id listed with several vectors in a version, the one of the least hash counts. Copies
    (exact multiples too) are each other's neighbours. A version of one vector has none; empty tables give no rows. probes:
    cells asked in the home block; more of them raise the recall and the cost.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors, versions)
    # narrow: ids by the hash of their vector's direction; copies of any number meet in counts and the least ids only
    x = lambda i: F.xxhash64(F.lit(i), "embedding").alias(f"x{i}")
    hashed = usable.select("index_version", "vec_id", "embedding", x(1), x(2)).mapInArrow(_directions, "index_version string, vec_id bigint, x1 bigint, x2 bigint, h1 bigint, h2 bigint")
    # an id with several vectors: that of the least hash, here and below
    ids = cut(hashed.groupBy("index_version", "vec_id").agg(F.min_by(F.struct("h1", "h2"), F.struct("x1", "x2")).alias("h")).select("index_version", "vec_id", "h.h1", "h.h2"), "ids")
    place = F.row_number().over(Window.partitionBy("index_version", "h1", "h2").orderBy("vec_id"))
    classes = cut(
        ids.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("index_version", "h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).withColumn("rep", F.col("members")[0]),
        "classes",
    )
    counts = {r["index_version"]: r["n"] for r in classes.groupBy("index_version").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a version
    if not counts:
        return spark.createDataFrame([], "vec_id bigint, rank int, neighbour bigint, cosine double")
    blocks = fit_versions(usable, counts, k)
    one = usable.groupBy("index_version", F.col("vec_id").alias("rep")).agg(F.min_by("embedding", F.struct(x(1), x(2))).alias("embedding"))
    reps = one.join(classes.select("index_version", "rep", "members"), ["index_version", "rep"]).select("index_version", "rep", "members", "embedding")
    asked = reps.mapInArrow(_assign(spark.sparkContext.broadcast(blocks)), _ASK)
    found = asked.groupBy("index_version", "block", "part").applyInArrow(_search_group(k, probes), _FOUND)
    pairs = F.arrays_zip(F.transform("cosines", lambda c: -F.round(c, 12)).alias("far"), F.col("ids").alias("id"))
    key = ["index_version", "rep"]
    found = found.select(*key, "copies", pairs.alias("near"))
    if blocks:
        found = found.groupBy(*key).agg(F.first("copies").alias("copies"), F.flatten(F.collect_list("near")).alias("near"))  # a row a part asked
    if any(b.spill > 1 for b in blocks.values()):  # found in several blocks: once, in order
        once = F.slice(F.array_sort(F.array_distinct("near")), 1, 2 * SPILL * (k + 1))
        found = found.withColumn("near", once).withColumn("near", F.filter("near", lambda x, i: F.array_position(F.col("near.id"), x["id"]) == i + 1))
    found = cut(found.select(*key, "copies", F.slice(F.array_sort("near"), 1, 2 * k + 2).alias("near")), "near")
    single = found.where("copies = 1").select(F.col("rep").alias("vec_id"), "near")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    many = found.where("copies > 1").select(*key, "near", salts)
    keys = classes.where("size(members) > 1").select("index_version", "h1", "h2", "rep", salts)
    of = ids.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")).join(keys, ["index_version", "h1", "h2", "salt"]).select(*key, "vec_id", "salt")
    copied = of.join(many, [*key, "salt"]).select("vec_id", "near")
    own = F.slice(F.filter("near", lambda x: x["id"] != F.col("vec_id")), 1, k)
    return single.unionByName(copied).select("vec_id", F.posexplode(own).alias("at", "n")).select("vec_id", (F.col("at") + 1).alias("rank"), F.col("n.id").alias("neighbour"), (-F.col("n.far")).alias("cosine"))


def similar_pairs(vectors: DataFrame, versions: DataFrame, k: int = K, probes: int = PROBES) -> DataFrame:
    """Pairs (vec_a < vec_b) of which at least one is among the other's k most similar; no pair twice."""
    return similar_vectors(vectors, versions, k, probes).select(F.least("vec_id", "neighbour").alias("vec_a"), F.greatest("vec_id", "neighbour").alias("vec_b")).distinct()
