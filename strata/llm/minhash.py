"""Operator 6: near-duplicate documents by an inverted join over MinHash signature coordinates.

1. Each document's set of word shingles gives a signature of K minima and a 128-bit fingerprint of the
   set. Documents of equal sets form a class and go on as one.
2. A class is posted under its (coordinate, value) pairs. Two sets of similarity s agree in about K * s
   coordinates; MATCHES is set 4.4 standard deviations below that. In any common order of the pairs, two
   signatures that agree in MATCHES coordinates share one of the first K - MATCHES + 1, so only that
   prefix is posted, in order of rarity: pairs that no other class has come first and need no posting,
   and pairs of very common passages are skipped unless a signature holds little else.
3. Postings are merged in two rounds, neither of which lists the pairs of a group. Round one compares
   every class with the least class of each of its postings (as many pairs as postings); a candidate must
   agree in MATCHES coordinates and is then confirmed on the full shingle sets. Round two takes the
   clusters of overlapping postings that still hold several components and compares the classes outside
   a cluster's largest component with the rest of it on their full sets, block by block - the exact way
   for what round one left, whatever the group's size.
4. The links give the components; every document gets its class's.

Words are runs of anything but space and tab to carriage return, A-Z lower-cased. Defined results: a
text with fewer words than a shingle is one shingle, texts that are null, empty or without words have
no shingles, link with nothing and are kept; repeated rows are exact copies of each other; a null id
gets the component of its exact copies and is kept only where none of them has an id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, hold, mix64, parts_for, per_batch, remove, texts, written

#: Signature coordinates; words whose hashes a worker keeps; sets that one task compares with as many others.
K, WORDS, BLOCK = 64, 500_000, 512
_MIX = np.random.default_rng(11).integers(1, 2**63, (3, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HASHES: dict[bytes, int] = {}


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words."""
    words = text.encode().lower().split()
    known = list(map(_HASHES.get, words))
    if None in known:
        if len(_HASHES) > WORDS:
            _HASHES.clear()
        for i, (w, h) in enumerate(zip(words, known)):
            if h is None:
                known[i] = _HASHES[w] = xxhash.xxh3_64_intdigest(w)
    return np.array(known, np.uint64)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = mix64(h * _MIX[2, i] + words[i:n + i])
    return np.unique(h)


def signature(shingles: np.ndarray, k: int = K) -> np.ndarray:
    """Minima of k multiply-shift hashes, 32 bits each."""
    low = np.full(k, 2**32 - 1, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(low, ((shingles[i:i + 512, None] * _MIX[0, :k] + _MIX[1, :k]) >> np.uint64(32)).min(0), out=low)
    return low


def matches_needed(similarity: float, k: int = K) -> int:
    return max(1, math.floor(k * similarity - 4.4 * math.sqrt(k * similarity * (1 - similarity))))


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("minhash", _HASHES.clear)
        sizes, first, second, signs = [], [], [], []
        salt = np.uint64(0x9E3779B97F4A7C15)
        for text in texts(batch):
            s = shingle_set(text, width)
            sizes.append(len(s))
            first.append(np.add.reduce(mix64(s + salt)).astype(np.int64))
            second.append(np.add.reduce(mix64(s ^ _MIX[0, 1])).astype(np.int64))
            signs.append(signature(s).astype(np.uint32).view(np.int32) if len(s) else None)
        return pa.RecordBatch.from_pydict({
            "id": batch.column("id"), "n": pa.array(sizes, pa.int64()), "f1": pa.array(first, pa.int64()),
            "f2": pa.array(second, pa.int64()), "sig": pa.array(signs, pa.list_(pa.int32()))})

    return per_batch(docs, make, "id long, n long, f1 long, f2 long, sig array<int>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, f1, f2, shingles) of rows (id, text)."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("minhash", _HASHES.clear)
        sets = [shingle_set(t, width) for t in texts(batch)]
        salt = np.uint64(0x9E3779B97F4A7C15)
        return pa.RecordBatch.from_pydict({
            "id": batch.column("id"), "n": pa.array([len(s) for s in sets], pa.int64()),
            "f1": pa.array([np.add.reduce(mix64(s + salt)).astype(np.int64) for s in sets], pa.int64()),
            "f2": pa.array([np.add.reduce(mix64(s ^ _MIX[0, 1])).astype(np.int64) for s in sets], pa.int64()),
            "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

    return per_batch(docs, make, "id long, n long, f1 long, f2 long, shingles array<long>")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(len(a), len(b)) sizes of the intersections of sorted distinct arrays."""
    if len(a) * len(b) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in b] for x in a]).reshape(len(a), len(b))
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    row_a, row_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b))
    out = np.zeros((len(a), len(b)), np.float32)
    at_a, at_b = np.searchsorted(shared, flat_a), np.searchsorted(shared, flat_b)
    in_a, in_b = (np.append(shared, 0)[at] == flat if len(shared) else np.zeros(len(flat), bool) for at, flat in ((at_a, flat_a), (at_b, flat_b)))
    in_a, in_b = in_a & (at_a < len(shared)), in_b & (at_b < len(shared))
    for low in range(0, len(shared), 4096):
        dense = []
        for rows, at, known, n in ((row_a, at_a, in_a, len(a)), (row_b, at_b, in_b, len(b))):
            some = known & (at >= low) & (at < low + 4096)
            m = np.zeros((n, min(4096, len(shared) - low)), np.float32)
            m[rows[some], at[some] - low] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return np.rint(out).astype(np.int64)


def _compare(open_: DataFrame, sets: DataFrame, percent: int, block: int, parts: int) -> DataFrame:
    """Links (a, b) that join components of round one, from rows (cid, component, first posting member).

    Postings that overlap form a cluster; in each, the classes outside its largest component are compared
    with all others of it. Clusters are cut into blocks, a task takes two blocks and gives only the edges
    of a spanning forest, so neither a task nor a table ever holds a whole group's pairs.
    """
    cluster = connected_components(open_.select(F.col("cid").alias("a"), F.col("first").alias("b")), "minhash-clusters")
    rows, _ = written(open_.select("cid", "component").distinct().join(cluster.select(F.col("node").alias("cid"), F.col("component").alias("cluster")), "cid"), "minhash-clustered", parts)
    sizes = rows.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("nm"), F.sum("n").alias("n")).where("n > nm")
    sized, _ = written(sizes.selectExpr("cluster", "largest", f"cast(ceil(nm / {block}) as int) sm", f"cast(ceil((n - nm) / {block}) as int) sr"), "minhash-sizes", parts)
    tasks = rows.join(sized, "cluster").withColumn("main", F.col("component") == F.col("largest")).withColumn(
        "i", F.expr("cast(pmod(xxhash64(cid), if(main, sm, sr)) as int)")).select(
        "cid", "component", "cluster", F.explode(F.expr(
            "if(main, transform(sequence(0, sr - 1), j -> struct(true as main, j as x, i as y, 1 as side)), "
            "concat(transform(sequence(0, sm - 1), j -> struct(true as main, i as x, j as y, 0 as side)), "
            "transform(sequence(0, sr - 1), j -> struct(false as main, least(i, j) as x, greatest(i, j) as y, if(i <= j, 0, 1) as side))))")).alias("task")) \
        .select("cid", "component", "cluster", "task.*")
    keys = ["cluster", "main", "x", "y"]
    placed = tasks.join(sets, "cid").repartition(*keys).sortWithinPartitions(*keys)

    def solve(group: list[dict]) -> tuple[list[int], list[int]]:
        root = {r["cid"]: r["component"] for r in group}
        parent = {c: c for c in root.values()}

        def find(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        within = not group[0]["main"] and group[0]["x"] == group[0]["y"]
        left = [r for r in group if r["side"] == 0]
        right = left if within else [r for r in group if r["side"] == 1]
        out_a, out_b = [], []
        if not right:
            return out_a, out_b
        common = _overlaps([r["shingles"] for r in left], [r["shingles"] for r in right])
        union = np.array([r["n"] for r in left])[:, None] + np.array([r["n"] for r in right])[None] - common
        for i, j in zip(*np.nonzero(100 * common >= percent * union)):
            p, q = find(root[left[i]["cid"]]), find(root[right[j]["cid"]])
            if p != q:
                parent[p] = q
                out_a.append(left[i]["cid"])
                out_b.append(right[j]["cid"])
        return out_a, out_b

    def run(batches):
        group: list[dict] = []
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("cid", "component", "n", "side", *keys)}
            lists = batch.column("shingles")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k in range(batch.num_rows):
                row = {c: v[k] for c, v in columns.items()}
                if group and any(row[c] != group[-1][c] for c in keys):
                    a, b = solve(group)
                    if a:
                        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                    group = []
                group.append(row | {"shingles": flat[ends[k]:ends[k + 1]].view(np.uint64)})
        if group:
            a, b = solve(group)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, k: int = K, block: int = BLOCK) -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable), kept."""
    spark = docs.sparkSession
    frame = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    matches = matches_needed(percent / 100, k)
    signed, signed_path = written(_signatures(frame, width), "minhash-signatures")
    classes, _ = written(
        signed.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("id").alias("least"), F.any_value("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")

    # Postings under the rarest shared pairs.
    pairs = classes.where("least is not null").select("cid", F.posexplode("sig").alias("at", "value")).select(
        "cid", (F.col("at").cast("long") * F.lit(1 << 32) + F.col("value").cast("long")).alias("pair"))
    shared, shared_path = written(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "minhash-shared")
    prefix = f"{k - matches + 1} - ({k} - size(held))"
    postings, postings_path = written(
        pairs.join(shared, "pair").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("n", "pair"))).alias("held"))
        .where(f"{prefix} > 0").select("cid", F.explode(F.expr(f"slice(held, 1, {prefix})")).alias("held"))
        .select("cid", "held.pair"), "minhash-postings")
    remove(spark, shared_path)
    parts = parts_for(postings.count())  # the narrow tables below have at most as many rows
    posted = postings.select("cid").distinct()
    members = posted.join(classes, "cid").select("cid", "least", "n", "f1", "f2", "sig")
    sets, sets_path = written(
        _sets(frame.join(members.select(F.col("least").alias("id")).distinct(), "id").select("id", "text"), width).alias("s")
        .join(members.alias("m"), F.expr("s.id = m.least and s.n = m.n and s.f1 = m.f1 and s.f2 = m.f2"))
        .select("m.cid", "m.n", "m.sig", "s.shingles").dropDuplicates(["cid"]), "minhash-sets")

    def linked(candidates: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) whose sets reach the similarity."""
        signs = sets.select("cid", "sig")
        near, near_path = written(
            candidates.join(signs.toDF("a", "sa"), "a").join(signs.toDF("b", "sb"), "b")
            .where(f"aggregate(zip_with(sa, sb, (x, y) -> if(x = y, 1, 0)), 0, (s, v) -> s + v) >= {matches}")
            .select("a", "b"), f"minhash-{name}-near", parts)
        whole = sets.select("cid", "n", "shingles")
        confirmed, _ = written(
            near.join(whole.toDF("a", "na", "ta"), "a").join(whole.toDF("b", "nb", "tb"), "b")
            .withColumn("common", F.size(F.array_intersect("ta", "tb")))
            .where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b"), f"minhash-{name}-links", parts)
        remove(spark, near_path)
        return confirmed

    least = postings.groupBy("pair").agg(F.min("cid").alias("a"))
    star, star_path = written(postings.join(least, "pair").where("a <> cid").select("a", F.col("cid").alias("b")).distinct(), "minhash-star", parts)
    links = linked(star, "star")
    remove(spark, star_path)
    part = connected_components(links, "minhash-cc1")
    placed, placed_path = written(postings.join(part.withColumnRenamed("node", "cid"), "cid", "left").select(
        "pair", "cid", F.coalesce("component", "cid").alias("component")), "minhash-placed", parts)
    several = placed.groupBy("pair").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("cid").alias("first")).where("low < high")
    open_, open_path = written(placed.join(several.select("pair", "first"), "pair").select("cid", "component", "first").distinct(), "minhash-open", parts)
    remove(spark, placed_path)
    remove(spark, postings_path)
    more, _ = written(_compare(open_, sets.select("cid", "n", "shingles"), percent, block, parts), "minhash-rest-links")
    remove(spark, sets_path)
    remove(spark, open_path)
    grouped = connected_components(links.unionByName(more), "minhash-cc2")

    named = grouped.select(F.col("node").alias("cid"), "component").join(classes.select("cid", "least"), "cid")
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
    known, _ = written(classes.join(named.join(smallest, "component").select("cid", "smallest"), "cid", "left").select(
        "f1", "f2", "n", F.coalesce("smallest", "least").alias("component")), "minhash-known")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return signed.select("id", "n", "f1", "f2").join(known, ["f1", "f2", "n"], "left").withColumn("to", component).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("to").alias("component_id"),
        F.coalesce(F.col("id") == F.col("to"), F.col("to").isNull()).alias("kept"))
