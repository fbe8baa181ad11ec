"""Language identification by prediction by partial matching.

For each language, counts of the byte that follows each context of up to three bytes, from a bounded sample of labelled rows, make a
variable-order context tree. A byte costs ``-log2`` of its probability in the longest context that the tree has; a byte not seen
there pays the escape (method C: distinct / (total + distinct)) and is tried one byte shorter, down to 1/256. The statistics are
frozen, so a text's code length in each language is an exact sum. All that the sample has seen is kept, each byte with its context in one hashed table an order, and
a batch of texts is scored by look-ups over all of its bytes at once, by the next shorter order for those that miss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.arrow_text import give_back, map_batches, per_text, slices, utf8, with_columns

ORDER = 3
SLICE = 500_000
LONGER = 1.25
SLACK_BITS = 256.0  # a short text may hold a name or number that no language explains


class _Table:
    """Places of distinct keys, found for many at once: keys lie by hash, and a bucket's few are tried in turn."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        bucket = self._bucket(keys)
        self.order = np.argsort(bucket, kind="stable")
        self.start = np.searchsorted(bucket[self.order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.keys = np.append(keys[self.order], keys.dtype.type(-1))

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        if keys.dtype == np.int32:
            return (keys.view(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where each key lies in the order of ``order``; -1 for one that isn't there."""
        bucket = self._bucket(keys)
        at = self.start[bucket]
        miss = np.flatnonzero(self.keys[at] != keys)
        if len(miss):
            end, keys = self.start[bucket[miss] + 1], keys[miss]
            next_ = at[miss] + 1
            at[miss] = -1
            on = next_ < end
            while on.any():
                miss, next_, end, keys = miss[on], next_[on], end[on], keys[on]
                hit = self.keys[next_] == keys
                at[miss[hit]] = next_[hit]
                next_ = next_ + 1
                on = ~hit & (next_ < end)
        return at


class PpmModel:
    """Frozen statistics: for each order the bytes seen behind each context with their ``cost`` in bits by language, and what each context's escape costs."""

    def __init__(self, texts: dict[str, list[bytes]]):
        self.languages = sorted(texts)
        self.most_bits = 8.0
        self.grams: list[tuple[_Table, np.ndarray]] = []
        self.contexts: list[tuple[_Table, np.ndarray]] = []
        if not texts:
            return
        joined = {k: b"".join(v) for k, v in texts.items()}
        seen = np.zeros(256, bool)
        for v in joined.values():
            seen[np.frombuffer(v, np.uint8)] = True
        kind = np.int32 if (int(seen.sum()) + 1) ** (ORDER + 1) < 1 << 31 else np.int64
        self.classes = np.zeros(256, kind)  # class 0 stands for every byte that no sample has, and for a text's beginning
        self.classes[seen] = np.arange(1, seen.sum() + 1)
        c = self.width = kind(seen.sum() + 1)
        n = len(self.languages)
        placed = []
        for lang in self.languages:
            data = self.classes[np.frombuffer(joined[lang], np.uint8)]
            placed.append((data, self._before(data, np.cumsum([0, *map(len, texts[lang])]))))
        for k in range(ORDER + 1):
            counted = []
            for data, prev in placed:
                context = self._context(prev, k)
                ok = np.ones(len(data), bool) if not k else prev[k - 1] > 0
                counted.append(np.unique(context[ok] * c + data[ok], return_counts=True))
            every = np.unique(np.concatenate([u for u, _ in counted]))
            count = np.zeros((len(every), n))
            for lang, (u, m) in enumerate(counted):
                count[np.searchsorted(every, u), lang] = m
            own, which = np.unique(every // c, return_inverse=True)
            sums, kinds = np.zeros((2, len(own), n))
            np.add.at(sums, which, count)
            np.add.at(kinds, which, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(sums > 0, -np.log2(kinds / (sums + kinds)), 0.0)
                cost = np.where(count > 0, -np.log2(count / (sums + kinds)[which]), 0.0)
            cost = np.where(count > 0, cost, escape[which] + self._cost(k - 1, [every // c**j % c for j in range(1, k)], every % c))
            for tables, keys, values in ((self.grams, every, cost), (self.contexts, own, escape)):
                table = _Table(keys)
                tables.append((table, np.append(values[table.order], np.zeros((1, n)), axis=0).astype(np.float32)))
                del table.order

    def _context(self, prev: list[np.ndarray], k: int) -> np.ndarray:
        """The ``k`` classes before each byte as one number."""
        if not k:
            return np.zeros_like(prev[0]) if prev else np.zeros(0, self.classes.dtype)
        out = prev[k - 1]
        for j in range(k - 1, 0, -1):
            out = out * self.width + prev[j - 1]
        return out

    def _cost(self, k: int, prev: list[np.ndarray], data: np.ndarray) -> np.ndarray:
        """Bits of each byte by language, by contexts of at most ``k`` bytes."""
        if k < 0:
            return np.full((len(data), len(self.languages)), 8.0, np.float32)
        context = self._context(prev, k) if k else np.zeros_like(data)
        table, cost = self.grams[k]
        at = table.find(context * self.width + data)
        out = cost[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            table, escape = self.contexts[k]  # a context that isn't there costs 0, as the last row
            out[miss] = escape[table.find(context[miss])] + self._cost(k - 1, [p[miss] for p in prev[: max(0, k - 1)]], data[miss])
        return out

    @staticmethod
    def _before(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The classes one, two and three bytes back; 0 before a text's beginning."""
        out = []
        starts = offsets[:-1]
        for j in range(1, ORDER + 1):
            p = np.zeros_like(data)
            p[j:] = data[:-j] if len(data) > j else []
            for i in range(j):
                at = starts + i
                p[at[at < np.minimum(offsets[1:], len(data))]] = 0
            out.append(p)
        return out

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each text in each language."""
        classes = self.classes[data]
        return per_text(self._cost(ORDER, self._before(classes, offsets), classes), offsets)


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 300) -> PpmModel:
    """Fit on at most ``per_language`` labelled rows of each language, those with the least hash of their id.

    Rows whose language or text is null or empty teach nothing. With no labelled row at all the model knows no language.
    """
    named = labelled.filter(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"))
    cut = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not cut:
        return PpmModel({})
    # the hash is uniform, so a bound on it draws about the wanted number without sorting; a margin keeps small draws whole
    bound = F.coalesce(*[F.when(F.col(lang_col) == r["lang"], F.lit(min(2**63 - 1, int(min(1.0, (per_language * 1.2 + 30) / r["n"]) * 2**64) - 2**63))) for r in cut])
    drawn = labelled.filter((F.length(text_col) > 0) & (F.xxhash64(F.col(id_col).cast("string")) <= bound)).select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(text_col).cast("binary").alias("text"))
    drawn = drawn.toArrow().sort_by([("lang", "ascending"), ("h", "ascending"), ("text", "ascending")])
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(drawn.column("lang").to_pylist(), drawn.column("text")):
        own = texts.setdefault(lang, [])
        if len(own) < per_language:
            own.append(text.as_py())
    del drawn
    model = PpmModel(texts)
    per_byte = []
    for own in texts.values():
        for text in own:
            per_byte.append(model.bits(np.frombuffer(text, np.uint8), np.array([0, len(text)])).min() / len(text))
    model.most_bits = float(min(8.0, 2.0 * np.quantile(per_byte, 0.99)))
    del texts, per_byte
    give_back()
    return model


def identify(docs: DataFrame, model: PpmModel, *, id_col: str = "doc_id", text_col: str = "text", slack_bits: float = SLACK_BITS) -> DataFrame:
    """(id, language, bits_per_byte, margin, accepted) for each row of ``docs``; repeated rows give repeated results.

    ``language`` is the one of the shortest code, the first by name on a tie; ``margin`` is how many bits a byte the second needs
    beyond it. ``accepted`` is false where no language explains the text: its code is longer than ``most_bits`` a byte (twice what all but 1 % of the sample need) by more than ``slack_bits``. A null or empty text has language ``und``, null
    figures and is not accepted; a null id stays null. A text of any length is scored whole. Other columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, most=SLICE):
                yield _scored(m, part, slack_bits)

    one = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = one.schema["id"].dataType.simpleString()
    return map_batches(one, score, f"id {kind}, language string, bits_per_byte double, margin double, accepted boolean").withColumnRenamed("id", id_col)


def _scored(model: PpmModel, part: pa.RecordBatch, slack: float) -> pa.RecordBatch:
    data, offsets = utf8(part.column("text"))
    size = np.diff(offsets)
    n = len(size)
    if not model.languages:
        none = pa.nulls(n, pa.float64())
        return with_columns(part, ["id"], language=pa.array(["und"] * n, pa.string()), bits_per_byte=none, margin=none, accepted=pa.array(np.zeros(n, bool)))
    bits = model.bits(data, offsets)
    best = bits.argmin(1)
    least = bits[np.arange(n), best]
    second = np.partition(bits, 1, axis=1)[:, 1] if bits.shape[1] > 1 else least
    empty = size == 0
    per = np.maximum(size, 1)
    names = np.array([*model.languages, "und"], object)
    return with_columns(
        part,
        ["id"],
        language=pa.array(names[np.where(empty, len(model.languages), best)], pa.string()),
        bits_per_byte=pa.array(least / per, mask=empty),
        margin=pa.array((second - least) / per, mask=empty),
        accepted=pa.array(~empty & (least - slack <= model.most_bits * size)),
    )


def accepted_documents(docs: DataFrame, model: PpmModel, *, text_col: str = "text", lang_col: str = "lang", slack_bits: float = SLACK_BITS, longer: float = LONGER) -> DataFrame:
    """The rows of ``docs`` that ``identify`` accepts and that are in the language they are said to be in, all columns kept, in one pass and without a join.

    A row is in another language than ``lang_col`` says where its code in the one said is more than ``longer`` times that in the best one and ``slack_bits``, as is that of a text
    most of which is in the other. A row whose language is null or one that the model doesn't know isn't held against it, nor are any where ``docs`` has no such column.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = schema.fieldNames()
        at, said = names.index(text_col), names.index(lang_col) if lang_col in names else None
        for batch in batches:
            for part in slices(batch.rename_columns([str(i) for i in range(batch.num_columns)]), str(at), SLICE):
                kept = part.filter(pa.array(_fits(m, part.column(at), None if said is None else part.column(said).to_pylist(), slack_bits, longer)))
                if kept.num_rows:
                    yield kept.rename_columns(names)

    return map_batches(docs, keep, schema)


def _fits(model: PpmModel, text: pa.Array, said: list[str | None] | None, slack: float, longer: float) -> np.ndarray:
    """Whether a language explains each text, and the one that it is said to be in not much worse."""
    data, offsets = utf8(text)
    size = np.diff(offsets)
    if not model.languages:
        return np.zeros(len(size), bool)
    bits = model.bits(data, offsets)
    least = bits.min(1)
    fits = (size > 0) & (least - slack <= model.most_bits * size)
    if said is not None:
        number = {x: i for i, x in enumerate(model.languages)}
        own = np.array([number.get(x, -1) for x in said], np.int64)
        fits &= (own < 0) | (bits[np.arange(len(own)), own] - slack <= longer * least)
    return fits
