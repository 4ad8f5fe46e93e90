"""P2 against brute force: recall, copies, ties, dirt."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from chronofact.llm import knn


def brute(ids, x, k=knn.K):
    u = knn.unit(np.asarray(x, dtype=np.float64))
    out = {}
    for i, a in enumerate(ids):
        s = np.round(u @ u[i], 12)
        out[a] = [ids[j] for j in sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[j], ids[j]))[:k]]
    return out


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims))
    size = rng.dirichlet(np.ones(12) * 0.4)
    return (centres[rng.choice(12, n, p=size)] + rng.standard_normal((n, dims)) * rng.choice([0.05, 0.3, 1.0], (n, 1))).astype(np.float32)


def test_scan_finds_the_neighbours_of_a_dense_collection(monkeypatch):
    monkeypatch.setattr(knn, "CELL", 64)
    x = np.unique(clustered(6000, 48, 1), axis=0)
    x[:2000] = x[0] + 1e-3 * np.random.default_rng(2).standard_normal((2000, 48)).astype(np.float32)  # a third in one spot
    u = (knn.unit(x) @ knn.rotation(48).astype(np.float64)).astype(np.float32)
    c = knn.fit(u[::4], len(u))
    near = knn.nearest_cells(u, c, knn.PROBES)
    rows, _ = knn.Scan(u, near[:, 0], knn.K + knn.SPARE).run(u, near, np.arange(len(u)))
    assert np.bincount(near[:, 0]).max() < 1500
    e = knn.unit(x)
    hits = 0
    for i in range(0, len(x), 20):
        s = e @ e[i]
        s[i] = -9
        hits += len(set(np.argsort(-s)[: knn.K]) & set(rows[i]))
    assert hits / (knn.K * len(range(0, len(x), 20))) >= 0.97


def test_cells_are_balanced_and_unit():
    x = knn.unit(clustered(3000, 16, 4)).astype(np.float32)
    c = knn.bisect_cells(x, 40, np.random.default_rng(0))
    assert c.shape == (40, 16) and np.allclose(np.linalg.norm(c, axis=1), 1, atol=1e-4)
    assert knn.bisect_cells(x[:1], 8, np.random.default_rng(0)).shape[0] >= 1


def test_blocks_copies_and_dirt(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL", 32)
    monkeypatch.setattr(knn, "BLOCK", 128)
    x = clustered(500, 8, 7)
    x[100:140] = x[3]  # more copies than K
    x[200] = x[5]
    x[201] = x[6] * 4  # the same direction
    rows = [(int(i) * 3, "v1", "c", v.tolist()) for i, v in enumerate(x)]
    rows += rows[:50] + rows[100:110]  # repeated rows
    rows += [(5000, "v1", "c", None), (5001, "v1", "c", [0.0] * 8), (5002, "v1", "c", [float("nan")] * 8), (5003, "v1", "c", [1.0] * 7), (5004, "v1", "c", [float("inf")] + [1.0] * 7), (None, "v1", "c", [1.0] * 8), (5005, "gone", "c", [1.0] * 8), (5006, None, "c", [1.0] * 8), (5007, "v1", "c", [1.0, None] + [1.0] * 6)]
    rows += [(6000, "v2", "c", [1.0, 0.0]), (6001, "v3", "c", [1.0, 0.0, 0.0]), (6002, "v3", "c", [1.0, 0.1, 0.0])]
    v = spark.createDataFrame(rows, "vec_id bigint, index_version string, chunk_id string, embedding array<float>").withColumn("n", F.lit("clash")).withColumn("rep", F.lit(1)).repartition(3)
    iv = spark.createDataFrame([("v1", 8), ("v1", 8), ("v2", 2), ("v3", 3), (None, 3)], "index_version string, dims int")
    got: dict[int, list[int]] = {}
    for r in knn.similar_vectors(v, iv).orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append(r.neighbour)
    want = brute([int(i) * 3 for i in range(500)], x)
    assert got[6001] == [6002] and got[6002] == [6001] and 6000 not in got and not any(5000 <= k < 5010 for k in got)
    assert set(want) <= set(got)
    right = sum(len(set(got[k]) & set(want[k])) for k in want)
    assert right / (5 * len(want)) > 0.98
    assert got[309] == want[309] and got[15] == want[15] and got[600] == want[600]  # copies, smaller ids first
    pairs = knn.similar_pairs(v, iv)
    assert pairs.where("vec_a >= vec_b").count() == 0 and pairs.count() == pairs.distinct().count()
    assert knn.similar_vectors(v.limit(0), iv).count() == 0 and knn.similar_pairs(v, iv.limit(0)).count() == 0


def test_many_blocks(monkeypatch, capsys):
    """Recall and copies per vector over more than fifty blocks, with uneven density and parts of blocks."""
    monkeypatch.setattr(knn, "BLOCK", 400)
    monkeypatch.setattr(knn, "CELL", 32)
    monkeypatch.setattr(knn, "PART_BYTES", 2 * 12 * 400 * 48 * 4)  # twelve blocks, as by default
    n, dims = 24_000, 48
    x = np.unique(clustered(n, dims, 11) @ np.diag(0.93 ** np.arange(dims)).astype(np.float32), axis=0)  # columns that matter less and less
    e = knn.unit(x)
    u = (e @ knn.rotation(dims)).astype(np.float32)
    blocks = knn.fit_blocks(u[::3], len(u), knn.K)
    visits = len(blocks.visited(u)[0]) / len(u)
    assert len(blocks.centroids) >= 50 and (blocks.askers > 1).any()
    blocks.lists[::9] = 2  # as if these blocks listed more than a task may hold
    batch = pa.record_batch({"index_version": pa.array(["v"] * len(x)), "rep": pa.array(np.arange(len(x))), "members": pa.array([[i] for i in range(len(x))], pa.list_(pa.int64())), "embedding": pa.array(x.tolist(), pa.list_(pa.float32()))})
    rows = pa.Table.from_batches(list(knn._assign(SimpleNamespace(value={"v": blocks}))(iter([batch]))))
    listed = rows.filter(pc.and_(pc.equal(rows["role"], 3), rows["home"])).column("rep").to_pylist()
    assert sorted(listed) == list(range(len(x)))  # each vector asks once in the part of its home in which it is listed
    near: dict[int, list] = {i: [] for i in range(len(x))}
    search = knn._search_group(knn.K, knn.PROBES)
    groups = rows.group_by(["block", "part"]).aggregate([]).to_pylist()
    largest = 0
    for g in groups:
        part = rows.filter(pc.and_(pc.equal(rows["block"], g["block"]), pc.equal(rows["part"], g["part"])))
        largest = max(largest, part.num_rows)
        for r in search(part).to_pylist():
            near[r["rep"]] += [(-c, i) for c, i in zip(r["cosines"], r["ids"], strict=True) if i != r["rep"]]
    hits, asked = 0, range(0, len(x), 40)
    for i in asked:
        s = np.round(e @ e[i], 12)
        s[i] = -9
        hits += len({j for _, j in sorted(set(near[i]))[: knn.K]} & set(np.lexsort((np.arange(len(x)), -s))[: knn.K].tolist()))
    recall, copies = hits / (knn.K * len(asked)), rows.num_rows / len(x)
    with capsys.disabled():
        print(f"\n{len(blocks.centroids)} blocks, {len(groups)} parts, {visits:.2f} blocks and {copies:.2f} copies a vector, largest part {largest}, recall {recall:.4f}")
    assert recall >= 0.99 and copies < 2 * knn.VISITS and largest < 24 * 400


def test_more_equal_directions_than_are_kept(spark):
    """Twelve vectors of one direction and different lengths: the smaller ids, also where lengths aren't powers of two."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((60, 8)).astype(np.float32)
    rows = [(100 + i, "v", v.tolist()) for i, v in enumerate(x)] + [(i, "v", (np.array([3, 4, 0, 0, 0, 0, 5, 1], dtype=np.float32) * (i + 1)).tolist()) for i in range(12)]
    v = spark.createDataFrame(rows, "vec_id bigint, index_version string, embedding array<float>")
    iv = spark.createDataFrame([("v", 8)], "index_version string, dims int")
    want = brute([r[0] for r in rows], [r[2] for r in rows])
    got: dict[int, list[int]] = {}
    for r in knn.similar_vectors(v, iv).orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append(r.neighbour)
    assert {k: got[k] for k in range(12)} == {k: want[k] for k in range(12)}
    three = knn.similar_vectors(v, iv, k=3, probes=4)
    assert three.groupBy("vec_id").count().where("count <> 3").count() == 0


def test_two_steps_find_the_nearest_centroids(monkeypatch):
    x = knn.unit(clustered(1400, 24, 3)).astype(np.float32)
    c, q = knn.bisect_cells(x[:900], 300, np.random.default_rng(1)), x[900:]
    one = knn.near_centroids(q, c, 4)
    monkeypatch.setattr(knn, "TWO_STEPS", 10)
    two = knn.near_centroids(q, c, 4)
    assert two[0].shape == (500, 4) and (one[0][:, 0] == two[0][:, 0]).mean() > 0.95 and np.allclose(two[1], np.einsum("ij,ikj->ik", q, c[two[0]]), atol=1e-5)
