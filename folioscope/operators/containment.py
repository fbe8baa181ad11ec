"""Which keys lie within which others, as an equal join of a few of their runs of characters.

In every 24 characters of a key the run of 12 with the least hash is chosen. A key of at least 24 characters that lies within another has
all of its chosen runs among those of the other, so the two meet in a join of runs, of which a key has about one for each seven of its characters. The side
with less text is told to the other as a bitmap, if it is small enough, before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.lineage import cut

LEAST_KEY, RUN = 24, 12
MOST_SHARED = 1 << 28  # characters of the smaller side beyond which no bitmap is made; it has at most 2**27 bits, 16 MB
_CODE = np.random.default_rng(3).integers(1, 2**63, 256, np.uint64)


def chosen_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the runs that are chosen in texts of bytes laid on end; one that is chosen by successive windows counts once."""
    n = len(data) - LEAST_KEY + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = _CODE[data]
    h = np.zeros(len(data) - RUN + 1, np.uint64)
    for j in range(RUN):
        h = h * np.uint64(0x9E3779B97F4A7C15) + code[j : j + len(h)]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    least = np.minimum(h[:-1], h[1:])  # of two, four and eight successive runs
    least = np.minimum(least[:-2], least[2:])
    least = np.minimum(least[:-4], least[4:])
    least = np.minimum(least[:n], least[LEAST_KEY - RUN - 7 :][:n])  # of all thirteen in a window
    text = np.searchsorted(offsets, np.arange(n), "right") - 1
    inside = np.arange(n) + LEAST_KEY <= offsets[text + 1]
    again = np.zeros(n, bool)
    again[1:] = (least[1:] == least[:-1]) & (text[1:] == text[:-1]) & inside[:-1]
    take = inside & ~again
    return text[take], least[take].view(np.int64)


def runs_of(keys: DataFrame, bitmap: np.ndarray | None = None, *, all_of_them: bool = False) -> DataFrame:
    """(id, run) of (id, key), or those that ``bitmap`` may have; with ``all_of_them`` only of keys all of whose runs it may have."""
    shared = None if bitmap is None else keys.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("key").cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(column) and ends[-1] > ends[0] else np.zeros(0, np.uint8)
            ends = ends - ends[0]
            for a, b in _spans(ends):
                text, h = chosen_runs(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                if shared is not None:
                    at = h & (64 * len(shared.value) - 1)  # the lower bits of the hash
                    maybe = (shared.value[at >> 6] >> (at & 63)) & 1 == 1
                    if all_of_them:
                        short = np.bincount(text[~maybe], minlength=b - a) > 0
                        maybe &= ~short[text]
                    text, h = text[maybe], h[maybe]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(a + text)), pa.array(h)], names=["id", "run"])

    one = keys.select("id", "key").filter(F.length("key") >= LEAST_KEY)
    return one.mapInArrow(run, f"id {one.schema['id'].dataType.simpleString()}, run long").distinct()


def _spans(ends: np.ndarray, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Successive texts of about ``most`` bytes together; a longer one by itself."""
    at = 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, to
        at = to


def _bitmap(runs: DataFrame, size: int) -> np.ndarray:
    words = 1 << max(4, min(21, int(size).bit_length() - 3))
    place = F.col("run").bitwiseAND(F.lit(64 * words - 1))
    rows = runs.select(place.alias("p")).selectExpr("p div 64 AS w", "shiftleft(cast(1 AS bigint), cast(p % 64 AS int)) AS b").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(words, np.int64)
    table[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return table


def contained(short: DataFrame, long: DataFrame) -> DataFrame:
    """(sid, lid, score) of (id, key) tables where the first's key, of at least 24 characters, lies within the second's; ``score`` is its length.

    Of a key's chosen runs the one that fewest of the others have is joined, so that a common beginning doesn't flood the join.
    """
    size = [t.agg(F.coalesce(F.sum(F.length("key").cast("long")), F.lit(0))).first()[0] for t in (short, long)]
    shared = min(size) <= MOST_SHARED
    if size[0] <= size[1]:
        pieces = cut(runs_of(short))
        common = cut(runs_of(long, _bitmap(pieces, size[0]) if shared else None).join(pieces.select("run").distinct(), "run", "left_semi"))
    else:
        every = cut(runs_of(long))
        pieces = cut(runs_of(short, _bitmap(every, size[1]) if shared else None, all_of_them=True))
        common = every.join(pieces.select("run").distinct(), "run", "left_semi")
    often = common.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    # a key with a run that no other has lies within none
    best = pieces.join(often, "run", "left").groupBy("id").agg(F.min_by("run", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("run"))).alias("run"), F.min(F.coalesce("n", F.lit(0))).alias("n")).filter("n > 0")
    hits = best.select(F.col("id").alias("sid"), "run").join(common.select(F.col("id").alias("lid"), "run"), "run").select("sid", "lid").distinct()
    keys = lambda t, name: t.filter(F.length("key") >= LEAST_KEY).select(F.col("id").alias(f"{name}id"), F.col("key").alias(f"{name}key"))
    found = hits.join(keys(short, "s"), "sid").join(keys(long, "l"), "lid").filter(F.contains("lkey", "skey"))
    return found.select("sid", "lid", F.length("skey").alias("score")).distinct()
