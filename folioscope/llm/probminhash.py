"""Near duplicates by ProbMinHash.

A text is the multiset of its runs of three words, of characters where a script has no spaces. Each distinct run is a Poisson process whose rate is the run's count; its arrivals fall
on random components of the signature, and a component keeps the run that arrives first. A run is dropped as soon as its next arrival
is later than every component's first, so a text costs about as many arrivals as it has runs. Two signatures agree in a
component with the probability Jaccard similarity of the texts. Equal signatures make one node; nodes that agree in a whole band are candidates;
a candidate pair is decided by its signatures where they leave no doubt and by the exact similarity of the texts where they do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.arrow_text import hashes, map_batches, mix, slices, utf8, words
from folioscope.llm.scratch import among, components, fresh, least_ids, numbering, written

COMPONENTS, ROWS, RUN = 128, 4, 3
THRESHOLD = 0.5
DOUBT = 0.13  # three standard errors of an estimate from 128 components
PAIRWISE, BLOCK = 64, 2048


def shingles(data: np.ndarray, offsets: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, 48-bit hash, count) of each text's distinct runs of words; a text of fewer words has one run, an empty one none."""
    distinct, at, bounds = words(data, offsets, unspaced=True)
    n = len(bounds) - 1
    value = hashes(distinct)[at]
    count = np.diff(bounds)
    runs = np.where(count >= run, count - run + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(n), runs)
    first = np.repeat(bounds[:-1] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    last = np.repeat(bounds[1:], runs)
    h = np.zeros(len(text), np.uint64)
    padded = np.concatenate([value, np.zeros(run, np.uint64)])
    for j in range(run):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.where(first + j < last, padded[first + j], np.uint64(j + 1)))
    key, times = np.unique((text.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)), return_counts=True)
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), times


def signatures(text: np.ndarray, item: np.ndarray, weight: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """The (n, m) signatures, 32 bits of the winning item in each component; 0 where a text has no item."""
    best = np.full(n * m, np.inf)
    won = np.zeros(n * m, np.uint32)
    seed = mix(item + np.uint64(0x1234567))
    print_ = (mix(item) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    when, rate = np.zeros(len(item)), weight.astype(np.float64)
    turn = 0
    while len(text):
        turn += 1
        x = mix(seed + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64))
        when = when - np.log1p(-(x >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate
        at = text * m + (mix(x) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, at, when)
        first = best[at] == when
        won[at[first]] = print_[first]
        if turn <= 8 or turn % 8 == 0:
            late = np.zeros(n)
            some = np.unique(text)
            late[some] = best.reshape(n, m)[some].max(1)
            on = when < late[text]
            text, seed, print_, when, rate = text[on], seed[on], print_[on], when[on], rate[on]
    return won.reshape(n, m)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard similarity of two weighted sets, each (items, weights) with distinct items."""
    items = np.union1d(a[0], b[0])
    x, y = np.zeros(len(items)), np.zeros(len(items))
    x[np.searchsorted(items, a[0])] = a[1]
    y[np.searchsorted(items, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.where(x > 0, x, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    upto = np.searchsorted(ratio, ratio, "right")
    below = np.concatenate([[0], np.cumsum(x)])[upto]
    above = y.sum() - np.concatenate([[0], np.cumsum(y)])[upto]
    both = (x > 0) & (y > 0)
    return float((1 / (below[both] / x[both] + above[both] / y[both])).sum())


def signed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", m: int = COMPONENTS, rows: int = ROWS) -> DataFrame:
    """(key, whole, bands, sig) of each row with an id, ``key``, and at least one word; ``whole`` and ``bands`` are hashes of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=4_000_000):
                data, offsets = utf8(part.column("text"))
                sig = np.zeros((0, m), np.uint32)
                # 16 bits tell the texts of one call apart
                for a in range(0, part.num_rows, 60_000):
                    o = offsets[a : a + 60_001]
                    sig = np.concatenate([sig, signatures(*shingles(data[o[0] : o[-1]], o - o[0]), len(o) - 1, m)])
                some = sig[:, 0] > 0
                sig = sig[some]
                n = len(sig)
                keys = np.zeros((n, m // rows), np.uint64) + np.arange(1, m // rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                for j in range(rows):
                    keys = mix(keys ^ sig[:, j::rows][:, : m // rows].astype(np.uint64))
                whole = np.zeros(n, np.uint64)
                for j in range(keys.shape[1]):
                    whole = mix(whole * np.uint64(3) + keys[:, j])
                flat = pa.array(keys.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * keys.shape[1], pa.int32()), flat)
                blob = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * 4 * m), pa.py_buffer(np.ascontiguousarray(sig))])
                yield pa.RecordBatch.from_arrays([part.column("key").filter(pa.array(some)), pa.array(whole.view(np.int64)), lists, blob], names=["key", "whole", "bands", "sig"])

    one = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).filter("key is not null and text is not null")
    return map_batches(one, run, f"key {one.schema['key'].dataType.simpleString()}, whole long, bands array<long>, sig binary")


def _spanned(m: int, low: float, high: float):
    """Within one bucket, breadth-first by estimates of ``high``, which are final: each signature taken up is compared with all that none has
    reached yet. What a search has reached is one group, and each of its pairs of at least ``low`` with what it hasn't is left to be settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("id")
        ids = table.column("id").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(ids), m)

        def estimates(i: int, others: np.ndarray) -> np.ndarray:
            return np.concatenate([np.zeros(0), *((sig[others[k : k + 50_000]] == sig[i]).mean(1) for k in range(0, len(others), 50_000))])

        left, found, size = np.arange(len(ids)), [], 0
        while len(left):
            group, left, at = [left[0]], left[1:], 0
            while at < len(group):
                like = estimates(group[at], left) >= high
                found.append((ids[group[at]], ids[left[like]]))
                group += left[like].tolist()
                left = left[~like]
                at += 1
            for i in group:
                found.append((ids[i], ids[left[estimates(i, left) >= low]]))
                size += len(found[-1][1])
                if size > 100_000:
                    yield _edges(found)
                    found, size = [], 0
        yield _edges(found)

    return run


def _edges(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    a = np.repeat(np.array([i for i, _ in found], np.int64), [len(x) for _, x in found])
    b = np.concatenate([np.zeros(0, np.int64), *(x for _, x in found)])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def candidates(heads: DataFrame, table: DataFrame, *, m: int = COMPONENTS, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a < b) of the nodes ``heads`` that agree in a band; ``table`` has the signatures.

    Equal buckets count once. A bucket of up to 64 nodes gives all its pairs. A larger one gives the pairs by which breadth-first searches
    over its signatures, by estimates that leave no doubt, reach every node, and all pairs in doubt between what two searches reached. So
    its groups are the same, and copies without doubt aren't squared. A bucket of more than about ``block`` nodes is cut into blocks of about so many, and
    every two blocks are searched together in a task of their own, so no task holds more than two of them.
    """
    rows = heads.select("id", F.explode("bands").alias("key"))
    hashed = [F.bit_xor(F.xxhash64(F.lit(k), "id")).alias(f"h{k}") for k in (0, 1)]
    kinds = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *hashed).filter("n > 1").groupBy("n", "h0", "h1").agg(F.min("key").alias("key"))
    kinds = written(kinds.select("key", "n"), "buckets")
    rows = written(rows.filter(among(F.col("key"), kinds)).join(kinds, "key"), "members")
    few = rows.filter(F.col("n") <= PAIRWISE).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    few = few.select("ids").distinct().select(F.posexplode("ids").alias("p", "a"), "ids").select("a", F.explode(F.expr("slice(ids, p + 2, size(ids))")).alias("b"))
    many = rows.filter(F.col("n") > PAIRWISE).select("id", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    sigs = table.select("id", "sig").filter(among(F.col("id"), many.select("id").distinct()))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), own))
    many = many.join(sigs, "id").select("key", "id", "sig", own.alias("x"), F.explode(others).alias("y")).select("key", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "id", "sig")
    spanned = many.groupBy("key", "x", "y").applyInArrow(_spanned(m, threshold - DOUBT, threshold + DOUBT), "a long, b long")
    return few.union(spanned.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def _agreement(pairs: DataFrame, m: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, m) for c in ("sa", "sb"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((x == y).mean(1))], names=["a", "b", "estimate"])

    return map_batches(pairs.select("a", "b", "sa", "sb"), run, "a long, b long, estimate double")


def _exact(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ta"):
                sets = []
                for c in ("ta", "tb"):
                    text, item, weight = shingles(*utf8(part.column(c)))
                    at = np.searchsorted(text, np.arange(part.num_rows + 1))
                    sets.append([(item[i:j], weight[i:j]) for i, j in zip(at, at[1:])])
                value = np.array([similarity(x, y) for x, y in zip(*sets)], float)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(value)], names=["a", "b", "similarity"])

    return map_batches(pairs.select("a", "b", "ta", "tb"), run, "a long, b long, similarity double")


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, m: int = COMPONENTS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """(id, group_id) of each id that is in a group of two or more; ``group_id`` is the group's least id.

    Ids may be of any type that has an order; those that aren't integers are numbered, which costs a join. Two ids are in one group if pairs of at least
    ``threshold`` similarity lead from one to the other. Rows with a null id, and null, empty and blank texts, are in no group. An id whose rows have several
    texts joins the groups of all of them. A text is signed whole, whatever its length; texts of equal signature are of one group. Other columns are ignored.
    """
    numbers = numbering(docs, id_col)
    table = signed(docs, id_col=id_col, text_col=text_col, m=m, rows=rows)
    table = table.withColumnRenamed("key", "id").withColumn("id", F.col("id").cast("long")) if numbers is None else table.join(numbers, "key").drop("key")
    table = written(table, "signatures")
    heads = written(table.groupBy("whole").agg(F.min("id").alias("id"), F.min_by("bands", "id").alias("bands")), "nodes")
    same = table.select("id", "whole").join(heads.select("whole", F.col("id").alias("rep")), "whole").filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    pairs = written(candidates(heads.select("id", "bands"), table, m=m, threshold=threshold, block=block), "candidates")
    sigs = table.select("id", "sig").filter(among(F.col("id"), pairs.select("a").union(pairs.select("b")).distinct()))
    sig_a, sig_b = (sigs.select(F.col("id").alias(k), F.col("sig").alias(f"s{k}")) for k in ("a", "b"))
    rated = written(_agreement(pairs.join(sig_a, "a").join(sig_b, "b"), m).filter(F.col("estimate") >= threshold - DOUBT), "rated")
    sure = rated.filter(F.col("estimate") >= threshold + DOUBT).select("a", "b")
    open_ = rated.filter(F.col("estimate") < threshold + DOUBT).select("a", "b")
    wanted = open_.select(F.col("a").alias("id")).union(open_.select("b")).distinct()
    wanted = written(wanted.withColumn("key", F.col("id")) if numbers is None else wanted.join(numbers, "id"), "wanted")
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).filter("key is not null and text is not null")
    texts = texts if numbers is not None else texts.withColumn("key", F.col("key").cast("long"))
    texts = written(texts.filter(among(F.col("key"), wanted.select("key"))).join(wanted, "key").select("id", "text").dropDuplicates(), "texts")
    ta, tb = (texts.select(F.col("id").alias(k), F.col("text").alias(f"t{k}")) for k in ("a", "b"))
    proved = _exact(open_.join(ta, "a").join(tb, "b")).filter(F.col("similarity") >= threshold).select("a", "b")
    return least_ids(components(sure.union(proved).union(same), "near"), numbers)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, group_id, copies, kept) of each row of ``docs``; a row in no group is its own. ``kept`` is true for one id of each group."""
    found = written(groups(docs, id_col=id_col, **options), "groups")
    found = found.join(found.groupBy("group_id").agg(F.count(F.lit(1)).alias("copies")), "group_id").select(F.col("id").alias("member"), "group_id", "copies")
    own = F.col("id")
    rows = docs.select(F.col(id_col).alias("id")).join(found, F.col("id") == F.col("member"), "left")
    return rows.select(own.alias(id_col), F.coalesce("group_id", own).alias("group_id"), F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce(F.col("member") == F.col("group_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its group, all columns kept, whatever their names. Rows with a null id stay."""
    gone = fresh(docs, "near_copy")
    ids = written(groups(docs, id_col=id_col, **options).filter("id <> group_id").select(F.col("id").alias(gone)), "gone")
    maybe = among(F.col(id_col).cast(ids.schema[0].dataType), ids)
    return docs.filter(~maybe).union(docs.filter(maybe).join(ids, F.col(id_col) == F.col(gone), "left_anti"))
