"""Operator 3: embedding near-duplicates by E8 lattice hashing.

Vectors are compared only within their label. Each unit vector is projected to eight dimensions by
TABLES independent random orthonormal projections, scaled, shifted and decoded to the nearest point of
the E8 lattice (E8 is D8 united with D8 + 1/2, so decoding is two roundings with a parity repair). The
lattice point is the vector's cell. On one side of each pair the neighbouring cells are probed too:
the PROBES cells that are nearest to the projected point among the 240 around its own.

Every (label, table, cell) group is cut into blocks by a salt of the vector, and blocks of a group meet
in pairs, so no task ever holds a whole group; groups below BLOCK vectors are one block. Inside a task a
matrix product in double precision verifies the cosine. A pair that collides in several tables is
counted in the first of them only, so link counts add up without listing pairs: a task gives for each
vector its number of new links, and for the components only the edges of a spanning forest.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors
without label, link with nothing; vectors of different length don't link; repeated rows are
separate vectors (rows of equal id count as links of each other; components are by id); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, mix64, written

#: Hash tables, neighbouring cells probed in each, scale of the projections (in lattice units), block size.
TABLES, PROBES, SCALE, BLOCK = 8, 6, 3.0, 1024


def _directions() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    eye = np.eye(8)
    pairs = [a * eye[i] + b * eye[j] for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    signs = np.array([[1 - 2 * (k >> i & 1) for i in range(8)] for k in range(256)])
    return np.vstack([np.array(pairs), 0.5 * signs[(signs < 0).sum(1) % 2 == 0]])


DIRECTIONS = _directions()


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8: whole numbers with an even sum."""
    r = np.rint(x)
    off = x - r
    worst = np.abs(off).argmax(1)
    rows = np.nonzero(r.sum(1) % 2)[0]
    step = np.where(off[rows, worst[rows]] >= 0, 1.0, -1.0)
    r[rows, worst[rows]] += step
    return r


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    near = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(near[:, None], a, b)


def _key(points: np.ndarray) -> np.ndarray:
    """A 64-bit key of lattice points (last axis)."""
    h = np.zeros(points.shape[:-1], np.uint64)
    for i in range(8):
        h = mix64(h ^ (points[..., i] * 2).astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i))
    return h


def projections(dim: int, tables: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(tables, dim, 8) projections with orthonormal columns where dim allows, and their shifts."""
    made = np.random.default_rng(seed + dim)
    p = np.stack([np.linalg.qr(made.standard_normal((max(dim, 8), 8)))[0][:dim] for _ in range(tables)])
    return p, made.random((tables, 8))


def cells(unit: np.ndarray, tables: int, probes: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (n, tables) and probed cells (n, tables, probes) of unit vectors."""
    p, shift = projections(unit.shape[1], tables)
    stretch = scale * np.sqrt(unit.shape[1] / 8)
    own, near = [], []
    for t in range(tables):
        y = unit @ p[t] * stretch + shift[t] * 4
        point = decode_e8(y)
        # Distance to a neighbour grows as (point + d - y)^2 = const + |d|^2 + 2 d.(point - y), |d|^2 = 2 throughout.
        best = np.argpartition((point - y) @ DIRECTIONS.T, probes, axis=1)[:, :probes]
        own.append(_key(point))
        near.append(_key(point[:, None, :] + DIRECTIONS[best]))
    return np.stack(own, 1), np.stack(near, 1)


def _unit(lists) -> np.ndarray:
    x = np.asarray(lists, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _first_meeting(own_a, near_a, own_b, near_b, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(table, cell) in which each pair is counted: the first table in which the two meet, and there the
    shared cell, or the lesser of the cells that one has and the other probes."""
    n, tables = own_a.shape
    near_a, near_b = near_a.reshape(n, tables, probes), near_b.reshape(n, tables, probes)
    same = own_a == own_b
    a_probed, b_probed = (near_b == own_a[:, :, None]).any(2), (near_a == own_b[:, :, None]).any(2)
    table = (same | a_probed | b_probed).argmax(1)
    at = (np.arange(n), table)
    a, b = own_a[at], own_b[at]
    only_b = ~(same[at] | a_probed[at])
    cell = np.where(only_b, b, np.where(a_probed[at] & b_probed[at], np.minimum(a, b), a))
    return table, cell


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    while (root[root] != root).any():
        root = root[root]
    return root


def _verify(group: dict[str, np.ndarray], threshold: float, tables: int, probes: int):
    """Links among the rows of whole groups: rows (member, links, root)."""
    unit, starts = _unit(group["vec"]), np.flatnonzero(np.r_[True, np.any([group[c][1:] != group[c][:-1] for c in _GROUP], 0)])
    sizes = np.diff(np.r_[starts, len(unit)])
    number = np.repeat(np.arange(len(starts)), sizes)
    cid, side, own, x, y = (group[c] for c in ("cid", "side", "own", "x", "y"))
    found_a, found_b = [], []

    def keep(a, b):
        left_a, left_b = side[a] != 1, side[b] != 1
        right_a, right_b = side[a] != 0, side[b] != 0
        ok = ((left_a & right_b) | (left_b & right_a)) & (cid[a] != cid[b])
        # A pair of own cells in two blocks meets in both tasks of the blocks: the one with the lesser on the left counts.
        ok &= (x[a] == y[a]) | ~(own[a] & own[b]) | (np.where(side[a] == 0, cid[a], cid[b]) < np.where(side[a] == 0, cid[b], cid[a]))
        a, b = a[ok], b[ok]
        for k in range(0, len(a), 1 << 16):
            p, q = a[k:k + (1 << 16)], b[k:k + (1 << 16)]
            table, cell = _first_meeting(group["cells"][p], group["near"][p], group["cells"][q], group["near"][q], probes)
            first = (table == group["t"][p]) & (cell == group["key"][p])
            found_a.append(p[first])
            found_b.append(q[first])

    small = sizes <= 64
    for d in range(1, int(sizes[small].max(initial=0))):
        a = np.flatnonzero((number[:-d] == number[d:]) & small[number[:-d]])
        for k in range(0, len(a), 1 << 15):
            p = a[k:k + (1 << 15)]
            close = np.einsum("ij,ij->i", unit[p], unit[p + d]) >= threshold
            keep(p[close], p[close] + d)
    for k in np.flatnonzero(~small):
        rows = np.arange(starts[k], starts[k] + sizes[k])
        for r in range(0, len(rows), 256):
            block = rows[r:r + 256]
            a, b = np.nonzero(unit[block] @ unit[rows[r:]].T >= threshold)
            later = b > a
            keep(block[a[later]], rows[r:][b[later]])
    a, b = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_a, found_b))
    members, at = np.unique(cid, return_inverse=True)
    weight = np.zeros(len(members), np.int64)
    weight[at] = group["weight"]
    a, b = at[a], at[b]
    links = np.bincount(a, weight[b], len(members)) + np.bincount(b, weight[a], len(members))
    linked = np.flatnonzero(links)
    return members[linked], links[linked].astype(np.int64), members[_roots(len(members), a, b)[linked]]


_GROUP = ("label", "dim", "t", "key", "x", "y")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
                    block: int = BLOCK) -> DataFrame:
    """Per row: id, n_links (other rows linked directly), component_id (least id reachable), kept."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("long").alias("label"),
                          vectors[vec_col].cast("array<double>").alias("vec"))
    usable = F.expr("coalesce(label is not null and size(vec) > 0 and forall(vec, v -> v is not null and not isnan(v) "
                    "and abs(v) < double('infinity')) and exists(vec, v -> v <> 0), false)")
    classes, _ = written(rows.where(usable).groupBy("label", "vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"))
                         .where("least is not null").withColumn("cid", F.monotonically_increasing_id()), "lattice-classes")

    def hashes(batches):
        for batch in batches:
            lengths = np.asarray(batch.column("vec").value_lengths())
            for dim in np.unique(lengths):
                some = np.flatnonzero(lengths == dim)
                part = batch.take(pa.array(some))
                own, near = cells(_unit(part.column("vec").flatten().to_numpy().reshape(len(some), dim)), tables, probes, scale)
                flat = lambda k: pa.array(list(k.reshape(len(some), -1).astype(np.int64)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({"cid": part.column("cid"), "label": part.column("label"), "dim": pa.array(np.full(len(some), dim), pa.int64()),
                                                  "vec": part.column("vec"), "weight": part.column("weight"), "cells": flat(own), "near": flat(near)})

    hashed, _ = written(classes.select("cid", "label", "vec", "weight").mapInArrow(
        hashes, "cid long, label long, dim long, vec array<double>, weight long, cells array<long>, near array<long>"), "lattice-cells")
    posts, _ = written(hashed.select("cid", "label", "dim", F.explode(F.expr(
        f"flatten(transform(cells, (c, t) -> concat(array(struct(t as t, c as key, true as own)), "
        f"transform(slice(near, t * {probes} + 1, {probes}), k -> struct(t as t, k as key, false as own)))))")).alias("post"))
        .select("cid", "label", "dim", "post.*"), "lattice-posts")
    # Cells in which at least two vectors meet; most vectors of a corpus meet none and go no further.
    met, _ = written(posts.groupBy("label", "dim", "t", "key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned"))
                     .where("owned and n > 1").select("label", "dim", "t", "key", F.expr(f"cast(ceil(n / {block}) as int)").alias("s")), "lattice-met")
    tasks = posts.join(met, ["label", "dim", "t", "key"]).withColumn("i", F.expr("cast(pmod(xxhash64(cid), s) as int)")).select(
        "cid", "t", "key", "own", F.explode(F.expr(
            "case when own then concat(transform(sequence(0, s - 1), j -> struct(i as x, j as y, if(i = j, 2, 0) as side)), "
            "transform(filter(sequence(0, s - 1), j -> j <> i), j -> struct(j as x, i as y, 1 as side))) "
            "else transform(sequence(0, s - 1), j -> struct(j as x, i as y, 1 as side)) end")).alias("task")).select("cid", "t", "key", "own", "task.*")
    placed = tasks.join(hashed, "cid").repartition("label", "dim", "t", "key", "x", "y").sortWithinPartitions(*_GROUP)

    def verify(batches):
        held: list[pa.RecordBatch] = []

        def solve(part: pa.Table):
            if not part.num_rows:
                return
            part = part.combine_chunks()
            for dim in np.unique(part.column("dim").to_numpy()):
                some = part.filter(pc.equal(part.column("dim"), int(dim)))
                group = {c: some.column(c).to_numpy() for c in ("cid", "weight", "side", *_GROUP)}
                group["own"] = some.column("own").to_numpy(zero_copy_only=False)
                for c in ("vec", "cells", "near"):
                    group[c] = some.column(c).combine_chunks().flatten().to_numpy().reshape(some.num_rows, -1)
                members, links, roots = _verify(group, threshold, tables, probes)
                yield pa.RecordBatch.from_pydict({"cid": pa.array(members, pa.int64()), "links": pa.array(links, pa.int64()),
                                                  "root": pa.array(roots, pa.int64())})

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 20_000:
                continue
            part = pa.Table.from_batches(held)
            last = np.flatnonzero(np.any([part.column(c).to_numpy() != part.column(c)[-1].as_py() for c in _GROUP], 0))
            cut = int(last[-1]) + 1 if len(last) else 0  # whole groups only; the last may go on
            yield from solve(part.slice(0, cut))
            held = part.slice(cut).to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held))

    found, _ = written(placed.mapInArrow(verify, "cid long, links long, root long"), "lattice-links")
    grouped = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "lattice-cc")
    members = grouped.select(F.col("node").alias("cid"), "component").join(classes.select("cid", "least"), "cid")
    smallest = members.groupBy("component").agg(F.min("least").alias("smallest"))
    named = members.join(smallest, "component").select("cid", "smallest")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known, _ = written(classes.join(links, "cid", "left").join(named, "cid", "left").select(
        F.col("label").alias("of"), F.col("vec").alias("like"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("smallest", "least").alias("component")), "lattice-known")
    return rows.withColumn("usable", usable).join(known, F.col("usable") & (F.col("label") == F.col("of")) & (F.col("vec") == F.col("like")), "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))
