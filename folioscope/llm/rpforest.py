"""Near duplicates among embeddings by a forest of random-projection trees.

Equal directions are told first, by grouping, and one of each goes on. Every tree splits the unit vectors again and again at the median of a random projection,
and a vector near a cut goes to both sides. One direction serves a whole level of a tree. The top of the trees is cut by a sample that the driver holds,
of a bounded number of vectors a node; where leaves would still be large, further levels are cut in the cluster by a sample that grows with the table, a few
levels a round, until a leaf is a group that one task holds. There it is split on to its last leaves, whose vectors are compared with each other and joined into
groups. So neither the driver nor anything broadcast grows with the table, while the depth does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.arrow_text import map_batches, mix
from folioscope.llm.scratch import among, components, drawn, least_ids, numbering, written

TREES, LEAF, SPILL = 12, 256, 0.05
TOP, STEP, PER_NODE, HELD = 10, 4, 32, 65_536  # levels cut by the driver and in a round, sampled vectors a node, vectors that a task may hold
THRESHOLD = 0.95


def vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and which rows have one: of ``width`` numbers, none null or endless, and not all 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), width), np.float32)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    first = np.cumsum(size) - size
    ok = size == width
    if ok.any():
        rows = flat[first[ok][:, None] + np.arange(width)]
        with np.errstate(all="ignore"):
            norm = np.sqrt((rows * rows).sum(1))
            fine = np.isfinite(norm) & (norm > 0)
            out[np.flatnonzero(ok)[fine]] = (rows[fine] / norm[fine, None]).astype(np.float32)
        ok[np.flatnonzero(ok)[~fine]] = False
    return out, ok


class Cuts:
    """The band around each node's cut within which a vector goes both ways, for some levels of one tree: a heap whose root is 1."""

    def __init__(self, sample: np.ndarray, directions: np.ndarray, spill: float = SPILL):
        depth = len(directions)
        self.low, self.high = np.zeros((2, 2**depth), np.float32)
        rows, node = np.arange(len(sample)), np.ones(len(sample), np.int64)
        for level in range(depth):
            p = sample[rows] @ directions[level]
            order = np.lexsort((p, node))
            rows, node, p = rows[order], node[order], p[order]
            at = np.searchsorted(node, np.arange(2**level, 2 ** (level + 1) + 1))
            size = np.diff(at) - 1
            some = np.flatnonzero(size >= 0)
            self.low[2**level + some] = p[at[some] + np.floor(size[some] * (0.5 - spill)).astype(np.int64)]
            self.high[2**level + some] = p[at[some] + np.ceil(size[some] * (0.5 + spill)).astype(np.int64)]
            rows, node = halves(rows, node, p, self.low[node], self.high[node])


def halves(rows: np.ndarray, node: np.ndarray, p: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rows`` with the node below each that they go to, both where the projection is within the band."""
    left, right = p <= high, p > low
    right |= ~left
    return np.concatenate([rows[left], rows[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])


def directions(trees: int, depth: int, width: int, seed: int = 11) -> np.ndarray:
    """A direction for each tree and level; those of the first levels don't depend on how many follow."""
    return np.random.default_rng(seed).standard_normal((depth, trees, width)).astype(np.float32).swapaxes(0, 1)


def leaves(x: np.ndarray, size: int, seed: int = 5) -> list[np.ndarray]:
    """Rows of ``x`` split at medians, those near a cut on both sides, until no part has more than ``size``, or a cut tells nothing apart."""
    rng = np.random.default_rng(seed)
    todo, out = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) > size:
            p = x[rows] @ rng.standard_normal(x.shape[1]).astype(np.float32)
            low, high = np.quantile(p, [0.5 - SPILL, 0.5 + SPILL])
            left, right = rows[p <= high], rows[p > low]
            if max(len(left), len(right)) < 0.9 * len(rows):
                todo += [left, right]
                continue
        out.append(rows)
    return out


def linked(ids: np.ndarray, x: np.ndarray, threshold: float, leaf: int = 4 * LEAF, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join all ids whose vectors have at least ``threshold`` cosine within one leaf, no more of them than ids in each part.

    Equal vectors are joined first and one of each goes on. More than ``leaf`` are split at a random cut, both sides having all within
    the angle of ``threshold`` of it, so that no pair is lost; where that leaves a side nearly whole, blocks are compared.
    """
    _, first, same = np.unique(x, axis=0, return_index=True, return_inverse=True)
    same = same.ravel()
    lead = ids[first[same]]
    other = lead != ids
    a, b = [lead[other]], [ids[other]]
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    rng = np.random.default_rng(seed)
    todo = [first]
    while todo:
        part = todo.pop()
        if len(part) > leaf:
            d = rng.standard_normal(x.shape[1]).astype(np.float32)
            d /= np.linalg.norm(d)
            p = x[part] @ d
            cut = np.median(p)
            low, high = part[p <= cut + reach], part[p >= cut - reach]
            if max(len(low), len(high)) < 0.8 * len(part):
                todo += [low, high]
                continue
        paired = np.concatenate([(x[part[k : k + 1024]] @ x[part].T >= threshold).sum(1) > 1 for k in range(0, len(part), 1024)]) if len(part) else np.zeros(0, bool)
        left = part[paired]
        while len(left):  # breadth-first: each row taken up is compared with those that none has reached
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                i = reached.pop()
                near = x[left] @ x[i] >= threshold
                a.append(np.full(int(near.sum()), ids[i]))
                b.append(ids[left[near]])
                reached += left[near].tolist()
                left = left[~near]
    return np.concatenate(a), np.concatenate(b)


def _floats(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, width)


def _routed(rows: DataFrame, top: list[Cuts], ways: np.ndarray, rounds: list[DataFrame]) -> DataFrame:
    """(id, tree, leaf, v) of (id, v) for every leaf that the trees' top, and then each round's cuts, lead to."""
    width, levels = ways.shape[2], int(np.log2(len(top[0].low)))
    shared = rows.sparkSession.sparkContext.broadcast((top, ways))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, ways = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                x = _floats(part.column("v"), width)
                at, leaf, tree = [], [], []
                for t, c in enumerate(cuts):
                    row, node = np.arange(len(x)), np.ones(len(x), np.int64)
                    for level in range(levels):
                        row, node = halves(row, node, x[row] @ ways[t, level], c.low[node], c.high[node])
                    at.append(row)
                    leaf.append(node)
                    tree.append(np.full(len(row), t))
                take = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays([part.column("id").take(take), pa.array(np.concatenate(tree), pa.int32()), pa.array(np.concatenate(leaf)), part.column("v").take(take)], names=["id", "tree", "leaf", "v"])

    out = map_batches(rows, first, "id long, tree int, leaf long, v binary")
    for r, cuts in enumerate(rounds):

        def on(batches: Iterator[pa.RecordBatch], begin: int = levels + r * STEP) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = batch.column("low").is_valid()
                yield batch.filter(pc.invert(known)).select(["id", "tree", "leaf", "v"])
                batch = batch.filter(known)
                x, tree = _floats(batch.column("v"), width), batch.column("tree").to_numpy()
                low, high = (_floats(batch.column(c), 2**STEP) for c in ("low", "high"))
                row, node = np.arange(len(x)), np.ones(len(x), np.int64)
                for level in range(begin, begin + STEP):
                    p = (x[row] * shared.value[1][tree[row], level]).sum(1)
                    row, node = halves(row, node, p, low[row, node], high[row, node])
                leaf = mix(batch.column("leaf").to_numpy()[row].astype(np.uint64) * np.uint64(1 << STEP) + (node - 2**STEP).astype(np.uint64)).view(np.int64)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("tree").take(take), pa.array(leaf), batch.column("v").take(take)], names=["id", "tree", "leaf", "v"])

        out = map_batches(out.join(cuts, ["tree", "leaf"], "left").select("id", "tree", "leaf", "v", "low", "high"), on, "id long, tree int, leaf long, v binary")
    return out


def groups(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, top: int = TOP, held: int = HELD) -> DataFrame:
    """(id, group_id, members) of each id of ``table``; ``group_id`` is the least id of those that cosines of at least ``threshold`` join.

    Ids may be of any type that has an order; those that aren't integers are numbered, which costs a join. A null vector, one with a null or endless number, of
    another width than the most common one (the least of those as common), or all 0, is a group by itself, and rows with a null id are dropped. Rows that repeat
    an id put it in the groups of all of them. A vector may have any number of dimensions: the driver's sample is of at most 64 MB. Other columns are ignored.
    """
    numbers = numbering(table, id_col)
    one = table.select(F.col(id_col).alias("key"), F.col(vector_col).alias("v")).filter("key is not null")
    ids = one.select(F.col("key").alias("member")).distinct()
    one = one.select(F.col("key").cast("long").alias("id"), "v") if numbers is None else one.join(numbers, "key").select("id", "v")
    shape = one.filter("v is not null").groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").first()
    if shape is None or shape["w"] == 0:
        return ids.select(F.col("member").alias(id_col), F.col("member").alias("group_id"), F.lit(1).cast("long").alias("members"))
    width = shape["w"]

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ok = vectors(batch.column("v"), width)
            x = x[ok] + np.float32(0)  # which makes 0 of -0
            blob = pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * 4 * width), pa.py_buffer(np.ascontiguousarray(x))])
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(ok)), blob], names=["id", "v"])

    every = written(map_batches(one, unit, "id long, v binary"), "unit-vectors")
    heads = written(every.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "distinct-vectors")
    many = heads.filter("n > 1").select("v", F.col("id").alias("rep"))
    same = every.filter(among(F.col("v"), many.select("v"))).join(many, "v").filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    heads = heads.select("id", "v")
    n = heads.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n) / leaf))))
    want = min(PER_NODE << top, (64 << 20) // (4 * width))
    first = max(0, min(depth, top, int(np.log2(max(1, want / PER_NODE)))))
    more = 0
    while first + more * STEP < depth and n * (0.5 + spill) ** (first + more * STEP) > held:
        more += 1
    ways = directions(trees, first + more * STEP, width)
    few = _floats(drawn(heads, F.col("id"), want).select("v").toArrow().column("v"), width)
    tops = [Cuts(few, ways[t, :first], spill) for t in range(trees)]
    # the further cuts' sample has as many vectors a node as the driver's
    bound = min(1.0, PER_NODE * 2.0 ** (first + more * STEP) / max(1, n))
    sample = heads.filter(F.xxhash64(F.lit(1), "id") <= F.lit(min(2**63 - 1, int(bound * 2**64) - 2**63)))

    def fitting(begin: int):
        def fit(rows: pa.Table) -> pa.Table:
            cuts = Cuts(_floats(rows.column("v"), width), ways[rows.column("tree")[0].as_py(), begin : begin + STEP], spill)
            return pa.table({"tree": rows.column("tree")[:1], "leaf": rows.column("leaf")[:1], "low": pa.array([cuts.low.tobytes()], pa.binary()), "high": pa.array([cuts.high.tobytes()], pa.binary())})

        return fit

    rounds: list[DataFrame] = []
    for r in range(more):
        found = _routed(sample, tops, ways, rounds).groupBy("tree", "leaf").applyInArrow(fitting(first + r * STEP), "tree int, leaf long, low binary, high binary")
        rounds.append(written(found, "cuts"))

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        x, own = _floats(rows.column("v"), width), rows.column("id").to_numpy()
        got = [linked(own[part], x[part], threshold) for part in leaves(x, 4 * leaf)]
        return pa.table({"a": pa.array(np.concatenate([a for a, _ in got]), pa.int64()), "b": pa.array(np.concatenate([b for _, b in got]), pa.int64())})

    pairs = _routed(heads, tops, ways, rounds).groupBy("tree", "leaf").applyInArrow(compare, "a long, b long").distinct()
    root = written(least_ids(components(written(pairs.union(same), "near-vectors"), "vector-groups"), numbers), "vector-roots")
    size = root.groupBy("group_id").agg(F.count(F.lit(1)).alias("members"))
    found = ids.join(root.join(size, "group_id"), F.col("member") == F.col("id"), "left")
    return found.select(F.col("member").alias(id_col), F.coalesce("group_id", "member").alias("group_id"), F.coalesce("members", F.lit(1)).alias("members"))
