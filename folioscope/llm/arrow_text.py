"""Whole texts as byte arrays: numpy over an Arrow batch's own buffers, in slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of one batch on its way to Python, whose texts may be of any length; Spark by itself bounds the rows alone.
BATCH_BYTES = 8 << 20
SLICE_BYTES = 3_000_000
_CODE = np.random.default_rng(7).integers(1, 2**63, 256, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: object) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches of bounded bytes, and memory given back at the end of each partition.

    A worker serves many partitions; what its allocators keep would otherwise count against the executor for as long as it lives.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b") == "67108864":  # as Spark sets it
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(settled, schema)


def give_back() -> None:
    """Return freed memory to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end and where each begins, the end last. A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None or data.size == 0 else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows that hold about ``most`` bytes of text; a longer text is a run by itself."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size + 64) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def words(data: np.ndarray, offsets: np.ndarray, *, unspaced: bool = False) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: the distinct words, each occurrence's place among them, and each text's first occurrence.

    With ``unspaced`` a character of a script that puts no spaces between words (Han, kana, Thai, Lao) is a word by itself.
    """
    letter = ~_SPACE[data]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = letter[cut]
    last[cut - 1] = letter[cut - 1]
    if unspaced and len(data) and data.max() >= 0xE0:
        after = np.append(data[1:], np.uint8(0))
        three = ((data >= 0xE3) & (data <= 0xE9)) | ((data == 0xE0) & (after >= 0xB8) & (after <= 0xBB))
        for at, size in ((np.flatnonzero(three), 3), (np.flatnonzero((data == 0xF0) & (after >= 0xA0) & (after <= 0xB3)), 4)):
            first[at] = last[at + size - 1] = True
            last[(at - 1)[at > 0]] = letter[(at - 1)[at > 0]]
            at = at[at + size < len(data)] + size
            first[at] = letter[at]
    starts = np.flatnonzero(first)
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(last) + 1 - starts, out=places[1:])
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[letter])])
    coded = packed.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(starts, offsets)


def hashes(column: pa.Array) -> np.ndarray:
    """A 64-bit hash of each value: a polynomial in its bytes' random codes, made uniform by ``mix``."""
    data, offsets = utf8(column)
    size = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    while len(data) and place.max() >= len(_POWER[0]):
        _POWER[0] = _powers(2 * len(_POWER[0]))
    terms = _CODE[data] * _POWER[0][place]
    out = np.zeros(len(size), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        out[some] = np.add.reduceat(terms, offsets[some])
    return mix(out + size.astype(np.uint64))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, np.uint64(0x9E3779B97F4A7C15))]), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that equal inputs alone give equal outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between successive bounds, 0 where there is none."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), np.float64)
    some = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(some):
        out[some] = np.add.reduceat(values, bounds[some], axis=0, dtype=np.float64)
    return out


def with_columns(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    """The named columns of ``batch`` followed by ``new``."""
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + list(new.values()), names=keep + list(new))


_POWER = [_powers(4096)]
