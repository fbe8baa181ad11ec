"""Packing of documents into sequences of fixed capacity by bin completion.

Documents are hashed into shards of bounded expected size, and each shard is packed by itself. Its bins are filled one at a time around the largest
document left: a depth-first branch and bound enumerates the fillings that no other dominates (no document left over could take the place of some that
make no more). Best-fit-decreasing gives the first incumbent, and a branch ends when the waste so
far proves that it can't use fewer bins. The search has a bounded number of nodes; beyond it the incumbent stands, so
a packing never has more bins than best fit's.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 8192
SHARD = 4096
NODES = 20_000
AT_ONCE = 16  # fillings sorted by their waste before they are tried; all others follow


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit-decreasing: places of ``sizes`` in each bin."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(room, (left - sizes[i], b))
    return bins


def fillings(room: int, rest: list[int], most_left: int, steps: list[int]) -> Iterator[tuple[int, ...]]:
    """The undominated multisets of the ascending ``rest`` that fit in ``room`` and leave at most ``most_left``, one at a time.

    Sizes are tried from the largest that fits, so the first filling is the greedy one. None is left out: those not wanted yet are found when they are.
    Each size that is tried takes one of ``steps``, which the caller may run out of.
    """
    if not rest or rest[0] > room:
        if room <= most_left:
            yield ()
        return
    upto = [0, *accumulate(rest)]  # a branch that can't leave as little as ``most_left`` ends
    every = 0
    for x in rest:
        every |= 1 << x
    taken: list[int] = []
    stack = [bisect_right(rest, room)]  # at each depth how many of ``rest`` may still be tried
    left = room
    while stack and steps[0] > 0:
        top = stack[-1]
        if top == 0 or left - upto[top] > most_left:
            stack.pop()
            if taken and len(stack) == len(taken):
                left += taken.pop()
            continue
        x = rest[top - 1]
        steps[0] -= 1
        stack[-1] = bisect_left(rest, x, 0, top)  # the same size at this place gives the same fillings
        left -= x
        taken.append(x)
        below = min(top - 1, bisect_right(rest, left))
        if below:
            stack.append(below)
            continue
        if left <= most_left and not _dominated(left, rest, every, taken):
            yield tuple(taken)
        left += taken.pop()


def _dominated(left: int, rest: list[int], every: int, taken: list[int]) -> bool:
    """Whether a size left over could take the place of others that make no more, within the room left, or be added.

    Of equal sums the single size is the better one, as what it replaces can go wherever it would. ``every`` has a bit for each size of ``rest``, and sums are
    bits too: those of the taken sizes below each size left over are told from the smallest up.
    """
    unused = every
    kinds: list[tuple[int, int]] = []  # (size, how many are taken), ascending
    for x in reversed(taken):
        if kinds and kinds[-1][0] == x:
            kinds[-1] = (x, kinds[-1][1] + 1)
        else:
            kinds.append((x, 1))
    for x, n in kinds:
        at = bisect_left(rest, x)
        if at + n >= len(rest) or rest[at + n] != x:
            unused &= ~(1 << x)
    sums, low = 1, 0
    for k in range(len(kinds) + 1):
        # sizes above the one before and up to this one are judged by the sums of those before
        high = kinds[k][0] if k < len(kinds) else rest[-1]
        some = (unused >> (low + 1)) & ((1 << (high - low)) - 1) if high > low else 0
        if some:
            wide, reach = sums, 0  # all that is within ``left`` above a sum
            while reach < left:
                step = min(reach + 1, left - reach)
                wide |= wide << step
                reach += step
            if some & (wide >> (low + 1)):
                return True
        if k < len(kinds):
            low, n = kinds[k]
            while n:  # so many of one size, by powers of two
                half = (n + 1) // 2
                sums |= sums << (low * half)
                n -= half
    return False


def least_bins(sizes: list[int], capacity: int) -> int:
    """A number of bins that no packing goes below: for each bound, sizes so large that none of at least the bound joins them have bins of
    their own, those above half a bin too, and what they leave can't hold more than its room of the rest."""
    desc = sorted(sizes, reverse=True)
    sums = [0, *accumulate(desc)]
    ascending = desc[::-1]
    n, best = len(desc), -(-sums[-1] // capacity)
    above = lambda x: n - bisect_right(ascending, x)
    half = above(capacity // 2)
    for bound in {x for x in ascending if 2 * x <= capacity} | {0}:
        alone = above(capacity - bound)
        upto = n - bisect_left(ascending, bound) if bound else n
        room = (half - alone) * capacity - (sums[half] - sums[alone])
        best = max(best, half + max(0, -(-(sums[upto] - sums[half] - room) // capacity)))
    return best


def pack(sizes: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Places of ``sizes`` (1 to ``capacity`` each) in bins; no more bins than best fit has, fewer where the search finds it."""
    return searched(sizes, capacity, nodes)[0]


def searched(sizes: list[int], capacity: int, nodes: int = NODES) -> tuple[list[list[int]], bool]:
    """``pack`` and whether its number of bins is proved to be the least.

    Where best fit needs more bins than a bound by the waste, all packings of fewer are tried: each bin is the largest size left and an undominated filling, fillings are
    taken a few at a time and the fullest of these first. Without the budget of ``nodes``, ten sizes tried for each, the search is exact; with it, what is best so
    far stands when it is used up.
    """
    best = best_fit(sizes, capacity)
    total, bound = sum(sizes), least_bins(sizes, capacity)
    if len(best) <= bound:
        return best, True
    most_waste = (len(best) - 1) * capacity - total  # a better packing wastes no more than this
    answer: list[tuple[int, ...]] = []
    steps = [10 * nodes]
    rest = sorted(sizes)
    chosen: list[tuple[int, ...]] = []
    waste = 0

    def options() -> Iterator[tuple[int, ...]]:
        top, lower = rest[-1], rest[:-1]
        found = fillings(capacity - top, lower, most_waste - waste, steps)
        while some := list(islice(found, AT_ONCE)):
            yield from sorted(((top, *f) for f in some), key=lambda f: -sum(f))

    stack = [options()]
    while stack and nodes > 0 and steps[0] > 0:
        if len(chosen) == len(stack):  # back from below
            undone = chosen.pop()
            waste -= capacity - sum(undone)
            for x in undone:
                insort(rest, x)
        pick = next(stack[-1], None)
        if pick is None:
            stack.pop()
            continue
        nodes -= 1
        if waste + capacity - sum(pick) > most_waste:  # which may have come down since the filling was found
            continue
        for x in pick:
            rest.pop(bisect_left(rest, x))
        chosen.append(pick)
        waste += capacity - sum(pick)
        if rest:
            stack.append(options())
            continue
        answer = list(chosen)
        most_waste = (len(chosen) - 1) * capacity - total
        if len(chosen) <= bound or most_waste < 0:
            stack = []
            break
        stack.append(iter(()))
    proved = not stack
    if not answer or len(answer) >= len(best):
        return best, proved
    places: dict[int, list[int]] = {}
    for i in range(len(sizes) - 1, -1, -1):
        places.setdefault(sizes[i], []).append(i)
    return [[places[x].pop() for x in pick] for pick in answer], proved


def packed(docs: DataFrame, *, id_col: str = "doc_id", size: Column | None = None, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """(id, piece, bin, place, start, length): where each piece of each document lies.

    ``size`` is a document's number of byte tokens, those of its text unless another column is given. A document longer than
    ``capacity`` is cut: full pieces fill bins of their own and what is left is packed. ``bin`` is unique over all shards; ``place``
    orders its pieces from 0; ``start`` is a piece's offset in its document. A null or empty text, or a size below 1, is one piece of
    length 0 with a null bin and place. Repeated rows are packed once each, rows of one size in the order of their ids, and so is a null id, first.
    A bin may hold any number of pieces. Other columns are ignored, whatever their names.

    Shards are spread over more tasks than the plan would otherwise merge their few bytes into: the search is what takes time.
    """
    size = F.octet_length("text") if size is None else size
    sized = docs.select(F.col(id_col).alias("id"), F.greatest(F.lit(0), F.coalesce(size.cast("long"), F.lit(0))).alias("size"))
    shards = max(1, -(-sized.count() // shard))
    kind = sized.schema["id"].dataType.simpleString()
    # a null id, and an id that many rows repeat, would gather in one shard, so the size has a part in the hash
    group = F.pmod(F.xxhash64(F.col("id").cast("string"), "size"), F.lit(shards)).cast("int")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("size", "ascending")])
        number = table.column("shard")[0].as_py()
        ids, sizes = table.column("id"), table.column("size").to_numpy()
        full = sizes // capacity
        left = sizes % capacity
        base = number << 40
        row, piece, bins, place, start, length = ([] for _ in range(6))
        some = np.repeat(np.arange(len(sizes)), full)
        within = np.arange(len(some)) - np.repeat(np.cumsum(full) - full, full)
        rest = np.flatnonzero(left)
        for b, items in enumerate(pack(left[rest].tolist(), capacity)):
            for p, i in enumerate(items):
                r = rest[i]
                row.append(r)
                piece.append(full[r])
                bins.append(base + len(some) + b)
                place.append(p)
                start.append(full[r] * capacity)
                length.append(left[r])
        none = np.flatnonzero(sizes == 0)
        joined = lambda a, b, c: np.concatenate([np.asarray(x, np.int64) for x in (a, b, c)])
        absent = np.concatenate([np.zeros(len(some) + len(row), bool), np.ones(len(none), bool)])
        zeros = np.zeros(len(none))
        return pa.table(
            {
                "id": ids.take(pa.array(joined(some, row, none))),
                "piece": pa.array(joined(within, piece, zeros)),
                "bin": pa.array(joined(base + np.arange(len(some)), bins, zeros), mask=absent),
                "place": pa.array(joined(np.zeros(len(some)), place, zeros), mask=absent),
                "start": pa.array(joined(within * capacity, start, zeros)),
                "length": pa.array(joined(np.full(len(some), capacity), length, zeros)),
            }
        )

    tasks = min(shards, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards // 64)))
    out = sized.withColumn("shard", group).repartition(tasks, "shard").groupBy("shard").applyInArrow(run, f"id {kind}, piece long, bin long, place long, start long, length long")
    return out.withColumnRenamed("id", id_col)
