"""Quality by ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(threshold_k - score)`` with ordered thresholds and one score, the sum of weights that all grades share.
Its terms are hashed: the words that a text has, each once, and shares of its words by hashed ending, by repetition and by capitals.
The words of a long text weigh less each, and those that tell a lower grade from the top one are penalised less, so that a few telling words
aren't lost among many others.
The fit is on a bounded sample of rated rows; scoring is one pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.arrow_text import give_back, hashes, map_batches, slices, utf8, with_columns, words
from folioscope.llm.lbfgs import minimise
from folioscope.llm.scratch import drawn

BITS = 18
SHARES = 64  # the last three are repetition, capitals and words without a letter or digit
PLENTY = 200  # a text of more distinct words has its words' sum scaled down
TELLING = 10.0  # the chi-square at which a word's penalty is halved
LEAST_TAIL = 0.8  # chosen on held-out rated rows: half a percent of the good and clean ones are below it
_PUNCT = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—¿¡"


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words of each text (each once, on end), where each text's begin, and the shares (texts x SHARES)."""
    distinct, at, bounds = words(data, offsets)
    n = len(offsets) - 1
    text = pc.fill_null(_as_text(distinct), "")
    core = pc.utf8_trim(text, _PUNCT)
    hashed = (hashes(pc.utf8_lower(core)) >> np.uint64(64 - BITS)).astype(np.int64)
    upper = (pc.utf8_is_upper(core).to_numpy(zero_copy_only=False) & (pc.utf8_length(core).to_numpy() > 1)).astype(np.int64)
    bare = (pc.binary_length(core).to_numpy() == 0).astype(np.int64)
    tail = _endings(text)
    ending = np.where(pc.binary_length(tail).to_numpy() > 0, (hashes(tail) % np.uint64(SHARES - 3)).astype(np.int64), -1)
    count = np.diff(bounds)
    text = np.repeat(np.arange(n), count)
    again = np.zeros(len(at), np.int64)
    again[1:] = (at[1:] == at[:-1]) & (text[1:] == text[:-1])
    shares = np.zeros((n, SHARES))
    tail = ending[at]
    some = tail >= 0
    shares += np.bincount(text[some] * SHARES + tail[some], minlength=n * SHARES).reshape(n, SHARES)
    for j, x in ((SHARES - 3, again), (SHARES - 2, upper[at]), (SHARES - 1, bare[at])):
        shares[:, j] = np.bincount(text, x, n)
    shares = np.sqrt(shares / np.maximum(count, 1)[:, None])
    once = np.unique((text << BITS) | hashed[at])
    return once & ((1 << BITS) - 1), np.searchsorted(once, np.arange(n + 1) << BITS), shares


def _as_text(values: pa.Array) -> pa.Array:
    """``values`` as strings; words split inside a character can't occur, so this only relabels them."""
    return pa.Array.from_buffers(pa.string(), len(values), values.buffers(), offset=values.offset)


def _endings(text: pa.Array) -> pa.Array:
    """The run of punctuation that each word ends with."""
    data, offsets = utf8(text)
    kept = np.diff(utf8(pc.utf8_rtrim(text, _PUNCT))[1])
    begin, end = offsets[:-1] + kept, offsets[1:]
    size = end - begin
    out = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=out[1:])
    take = np.arange(out[-1]) + np.repeat(begin - out[:-1], size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(out), pa.py_buffer(data[take]))


class OrdinalModel:
    """Weights of words and shares, and the ordered thresholds between grades."""

    def __init__(self, word: np.ndarray, share: np.ndarray, thresholds: np.ndarray):
        self.word, self.share, self.thresholds = word, share, thresholds

    def score(self, idx: np.ndarray, bounds: np.ndarray, shares: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.word[idx], dtype=np.float64)])
        return (total[bounds[1:]] - total[bounds[:-1]]) * _scale(bounds) + shares @ self.share

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def _scale(bounds: np.ndarray) -> np.ndarray:
    return np.sqrt(PLENTY / np.maximum(np.diff(bounds), PLENTY))


def _telling(row: np.ndarray, col: np.ndarray, words: int, grade: np.ndarray, grades: int) -> np.ndarray:
    """For each word the greatest chi-square, with Yates's correction, of texts that have it in a lower grade against the top one."""
    most = np.zeros(words)
    of = [np.bincount(col, grade[row] == g, words) for g in range(grades)]
    size = np.bincount(grade, minlength=grades)
    for g in range(grades - 1):
        n = size[g] + size[-1]
        if size[g] and size[-1]:
            both = of[g] + of[-1]
            expected = both * size[g] / n
            spread = expected * (size[-1] / n) * (n - both) / (n - 1)
            most = np.maximum(most, np.maximum(np.abs(of[g] - expected) - 0.5, 0) ** 2 / np.maximum(spread, 1e-9))
    return most


def fit_arrays(idx: np.ndarray, bounds: np.ndarray, shares: np.ndarray, grade: np.ndarray, grades: int, *, l2: float = 0.02, least_texts: int = 3) -> OrdinalModel:
    """Penalised maximum likelihood. A word that fewer than ``least_texts`` texts have gets no weight; a word's penalty is the less the more it tells a grade from the top one."""
    n = len(grade)
    df = np.bincount(idx, minlength=1 << BITS)
    used = np.flatnonzero(df >= least_texts)
    to = np.full(1 << BITS, -1)
    to[used] = np.arange(len(used))
    row = np.repeat(np.arange(n), np.diff(bounds))
    keep = to[idx] >= 0
    col, row = to[idx[keep]], row[keep]
    w, s, k = len(used), shares.shape[1], grades - 1
    scale = _scale(bounds)
    penalty = np.concatenate([l2 / (1 + _telling(row, col, w, grade, grades) / TELLING), np.full(s, l2 / 20), np.zeros(k)])

    def split(x: np.ndarray):
        steps = x[w + s :]
        return np.concatenate([steps[:1], steps[:1] + np.cumsum(np.exp(np.clip(steps[1:], -30, 30)))])

    def f(x: np.ndarray):
        theta = split(x)
        z = np.bincount(row, x[col], n) * scale + shares @ x[w : w + s]
        ends = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = (1 / (1 + np.exp(np.clip(z - ends[grade + j], -500, 500))) for j in (1, 0))
        p = np.maximum(hi - lo, 1e-12)
        gz = 1 - hi - lo  # d(-log p)/dz
        ghi, glo = -hi * (1 - hi) / p, lo * (1 - lo) / p
        gt = np.bincount(grade + 1, ghi, grades + 1)[1:grades] + np.bincount(grade, glo, grades + 1)[1:grades]
        steps = x[w + s :]
        gs = np.concatenate([[gt.sum()], [gt[j:].sum() * np.exp(np.clip(steps[j], -30, 30)) for j in range(1, k)]])
        g = np.concatenate([np.bincount(col, (gz * scale)[row], w), shares.T @ gz, gs])
        return float(-np.log(p).sum() + (penalty * x * x).sum() / 2 * n**0.5), g + penalty * x * n**0.5

    x = minimise(f, np.concatenate([np.zeros(w + s), np.zeros(k)]), 120)
    word = np.zeros(1 << BITS, np.float32)
    word[used] = x[:w]
    return OrdinalModel(word, x[w : w + s], split(x))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 of low quality, 1 of good quality but toxic, 2 good and clean; the least grade where ratings differ.

    A row with a null id or quality is no rating; a null ``toxic`` counts as 0.
    """
    g = F.when(F.col("quality") < 1, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    return labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(g).alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, *, grades: int = 3, most_rated: int = 12_000) -> OrdinalModel:
    """Fit on at most ``most_rated`` rated rows, those with the least hash of their id, joined to their texts.

    ``ratings`` has doc_id, of any type, and grade (0 to grades - 1). With none the model scores 0 with thresholds far below, so it rejects nothing. Texts are read
    whole; a row that repeats a rated id teaches as often as it stands there. A null text teaches nothing, an empty one that it has no word.
    """
    few = F.broadcast(drawn(ratings.select(F.col("doc_id").alias("rated"), "grade"), F.col("rated"), most_rated))
    both = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("rated")).select("rated", "grade", "text").filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                idx, bounds, shares = features(*utf8(part.column("text")))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(idx, pa.int32()))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(shares) + 1) * SHARES, pa.int32()), pa.array(shares.ravel(), pa.float64()))
                yield with_columns(part, ["rated", "grade"], idx=lists, shares=flat)

    got = map_batches(both, run, f"rated {both.schema['rated'].dataType.simpleString()}, grade int, idx array<int>, shares array<double>").toArrow().sort_by("rated")
    if not got.num_rows:
        return OrdinalModel(np.zeros(1 << BITS, np.float32), np.zeros(SHARES), np.full(grades - 1, -50.0))
    got = got.combine_chunks()
    idx, flat = (got.column(c).chunk(0) for c in ("idx", "shares"))
    bounds = np.concatenate([[0], np.cumsum(idx.value_lengths().to_numpy(zero_copy_only=False))])
    model = fit_arrays(idx.flatten().to_numpy().astype(np.int64), bounds, flat.flatten().to_numpy().reshape(-1, SHARES), got.column("grade").to_numpy().astype(np.int64), grades)
    del got, idx, flat
    give_back()
    return model


def rate(docs: DataFrame, model: OrdinalModel, *, least_tail: float = LEAST_TAIL) -> DataFrame:
    """(doc_id, expected_grade, tail, accepted) of each row; ``tail`` is the chance of the top grade, ``accepted`` that it is ``least_tail``.

    A null or empty text has null figures and is rejected; a null id stays null. A text of any length is rated whole, one of blanks alone as one without words. Equal texts
    have equal figures, and repeated rows give repeated results; other columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch):
                tails, empty = _tails(m, part.column("text"))
                yield with_columns(part, ["doc_id"], expected_grade=pa.array(tails.sum(1), mask=empty), tail=pa.array(tails[:, -1], mask=empty), accepted=pa.array(~empty & (tails[:, -1] >= least_tail)))

    one = docs.select("doc_id", "text")
    return map_batches(one, run, f"doc_id {one.schema['doc_id'].dataType.simpleString()}, expected_grade double, tail double, accepted boolean")


def _tails(model: OrdinalModel, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    return model.tails(model.score(*features(data, offsets))), np.diff(offsets) == 0


def accepted_documents(docs: DataFrame, model: OrdinalModel, *, least_tail: float = LEAST_TAIL) -> DataFrame:
    """The rows of ``docs`` that ``rate`` accepts, all columns kept, in one pass and without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, at = shared.value, schema.fieldNames().index("text")
        for batch in batches:
            for part in slices(batch.rename_columns([str(i) for i in range(batch.num_columns)]), str(at)):
                tails, empty = _tails(m, part.column(at))
                kept = part.filter(pa.array(~empty & (tails[:, -1] >= least_tail)))
                if kept.num_rows:
                    yield kept.rename_columns(schema.fieldNames())

    return map_batches(docs, run, schema)
