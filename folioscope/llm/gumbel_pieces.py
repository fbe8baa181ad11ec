"""Sampled SentencePiece segmentations without replacement, by Gumbel top-k with A-star search.

A text's lattice has an edge for every piece of the vocabulary at every place that it fits, and for the bytes of a character that has no
piece of its own. A segmentation's probability is the product of its pieces' weights over that of all segmentations. Each gets a Gumbel
perturbation, and the k with the largest perturbed log-probability are k distinct samples without replacement. They are found without listing
any others: the best of a set of segmentations that share a beginning has a perturbation of the set's total mass, the search keeps those
sets in a queue, opens the largest, and draws the rest of its path; the sets left beside the path are bounded by it (a truncated Gumbel).

No piece of the vocabulary has a space behind another character, so the lattice falls apart where a run of spaces begins. Lattices are made
and summed backwards once for each distinct part of a batch, and the paths of all of a batch's texts are drawn in lockstep.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.arrow_text import map_batches, mix, per_text, slices, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, TEMPERATURE = 2, 1.0
SEED = 20_240
_CODE = np.random.default_rng(5).integers(1, 2**63, 256, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class Pieces:
    """The vocabulary as bytes: hashes to look pieces up by, ids, log-weights, and the ids of single bytes.

    A byte-pair vocabulary has ranks and no probabilities; a piece's weight is ``1 / (rank + 10)`` to the power of 1 / temperature,
    which is near the frequency that the piece of a rank has. A byte of a character without a piece weighs as the last piece does.
    """

    def __init__(self, model: str = MODEL, temperature: float = TEMPERATURE):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        texts, ids, ranks = [], [], []
        whole = [b""] * sp.get_piece_size()  # what each id stands for; nothing for a control
        whole[sp.unk_id()] = " \u2047 ".encode()
        self.bytes = np.zeros(256, np.int64)
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                whole[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                raw = piece.replace("▁", " ")
                if " " in raw.lstrip(" "):
                    raise ValueError(f"piece {i} has a space behind another character")
                texts.append(raw.encode())
                whole[i] = texts[-1]
                ids.append(i)
                ranks.append(-sp.get_score(i))
        self.whole = pa.array(whole, pa.large_binary())
        ranks = np.array(ranks)
        weight = -np.log(ranks - ranks.min() + 10.0) / temperature
        self.byte_weight = float(weight.min())
        self.longest = max(map(len, texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(x) for x in texts])
        starts = ends - np.array([len(x) for x in texts])
        prefix, _, back = _prefixes(data)
        hashed = _between(prefix, back, starts, ends)
        order = np.argsort(hashed)
        self.hash, self.id, self.weight = hashed[order], np.array(ids)[order], weight[order]
        if (np.diff(self.hash) == 0).any():
            raise ValueError("two pieces have one hash")
        self.place = np.zeros(1 << 22, np.int32)  # of a piece whose hash has these upper bits
        self.place[(self.hash >> np.uint64(42)).view(np.int64)] = np.arange(len(self.hash))
        # by the upper bits of a hash: 1 where a piece has it, 2 where the beginning of a longer one has
        self.maybe = np.zeros(1 << 22, np.uint8)
        self.maybe[(self.hash >> np.uint64(42)).view(np.int64)] = 1
        for length in range(1, self.longest):
            longer = starts[ends - starts > length]
            self.maybe[(_between(prefix, back, longer, longer + length) >> np.uint64(42)).view(np.int64)] |= 2


    def restored(self, ids: pa.Array, bounds: np.ndarray) -> Iterator[bytes]:
        """The text of the ids between each two successive bounds, without the space that was put before it."""
        taken = self.whole.take(ids)
        data, offsets = utf8(taken)
        data, ends = data.tobytes(), offsets[bounds].tolist()
        for a, b in zip(ends, ends[1:]):
            yield data[a + (data[a : a + 1] == b" " and a < b) : b]


def _prefixes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _STEP)]), dtype=np.uint64)
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BACK)]), dtype=np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * up[:-1], out=prefix[1:], dtype=np.uint64)
    return prefix, up, back


def _between(prefix: np.ndarray, back: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the bytes from ``a`` to ``b`` that doesn't depend on where they lie."""
    return (prefix[b] - prefix[a]) * back[a]


class Lattice:
    """Edges by beginning, over distinct parts of text laid on end, and ``beta``, the log-weight of all ways to a part's end."""

    def __init__(self, pieces: Pieces, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        size = np.diff(offsets)
        end = np.repeat(offsets[1:], size)  # of each byte's part
        prefix, _, back = _prefixes(data)
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        width = np.diff(np.append(chars, n))
        at, room = chars, end[chars] - chars
        found, many, alone = [], np.zeros(n, np.int32), np.zeros(n, bool)
        origin, scale = prefix[chars], back[chars]
        for length in range(1, pieces.longest + 1):
            fit = room >= length
            if not fit.all():
                at, room, origin, scale, width = at[fit], room[fit], origin[fit], scale[fit], width[fit]
            if not len(at):
                break
            h = (prefix[at + length] - origin) * scale
            known = pieces.maybe[(h >> np.uint64(42)).view(np.int64)]
            maybe = np.flatnonzero(known & 1)
            h = h[maybe]
            place = pieces.place[(h >> np.uint64(42)).view(np.int64)]
            hit = pieces.hash[place] == h
            others = np.flatnonzero(~hit)
            place[others] = np.minimum(np.searchsorted(pieces.hash, h[others]), len(pieces.hash) - 1)
            hit[others] = pieces.hash[place[others]] == h[others]
            own = maybe[hit]
            begin = at[own]
            found.append((begin, begin + length, place[hit]))
            many[begin] += 1
            if length <= 4:  # which characters have a piece of their own
                alone[begin[width[own] == length]] = True
            on = known > 1  # elsewhere no longer piece begins
            at, room, origin, scale, width = at[on], room[on], origin[on], scale[on], width[on]
        bare = chars[~alone[chars]]
        found.append((bare, np.append(chars[1:], n)[~alone[chars]], np.full(len(bare), -1)))
        many[bare] += 1
        self.first = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
        cursor, total = self.first[:-1].copy(), int(self.first[-1])
        self.stop, piece = np.zeros(total, np.int32), np.zeros(total, np.int32)
        for begin, stop, which in found:
            to = cursor[begin]
            self.stop[to], piece[to] = stop, which
            cursor[begin] += 1
        del found, cursor
        self.start = np.repeat(np.arange(n, dtype=np.int32), many)
        self.id = np.where(piece >= 0, pieces.id[piece], -1).astype(np.int32)
        weight = np.where(piece >= 0, pieces.weight[piece], pieces.byte_weight * (self.stop - self.start))
        beta = np.zeros(n + 1)  # a part's end is the next one's beginning, so ends are read as 0
        left = end[self.start] - self.start
        most = int(left.max()) if total else 0
        by = np.argsort(left.astype(np.uint16) if most < 1 << 16 else left, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=most + 1))])
        part_end = self.stop == end[self.start]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                e = by[a:b]
                score = weight[e] + np.where(part_end[e], 0.0, beta[self.stop[e]])
                own = self.start[e]
                heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                beta[own[heads]] = np.logaddexp.reduceat(score, heads)
        self.beta = beta
        self.log = weight + np.where(part_end, 0.0, beta[self.stop]) - beta[self.start]  # of the choice, given its beginning
        self.last = part_end
        total = np.cumsum(np.exp(self.log))
        before = np.concatenate([[0.0], total])[self.first[:-1]]
        self.upto = total - before[self.start]
        self.upto[self.first[1:][self.first[1:] > self.first[:-1]] - 1] = 2.0  # rounding leaves no gap at the last

    def other(self, edges: np.ndarray) -> np.ndarray:
        """The log-probability of any other choice than each edge at its beginning."""
        begin = self.start[edges]
        with np.errstate(divide="ignore"):
            return np.where(self.first[begin + 1] - self.first[begin] < 2, -np.inf, np.log(-np.expm1(np.minimum(self.log[edges], 0.0))))

    def draw(self, begin: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path from each ``begin`` to its part's end: edges on end and where each path's begin. ``key`` seeds each path's choices."""
        lane, pos, turn = np.arange(len(begin)), begin, 0
        lanes, edges = [], []
        while len(lane):
            turn += 1
            u = (mix(key + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            e = self.first[pos]
            todo = np.flatnonzero(self.upto[e] <= u)
            while len(todo):
                e[todo] += 1
                todo = todo[self.upto[e[todo]] <= u[todo]]
            lanes.append(lane)
            edges.append(e)
            on = ~self.last[e]
            lane, pos, key = lane[on], self.stop[e[on]], key[on]
        count = np.zeros(len(begin), np.int64)
        for x in lanes:
            count[x] += 1
        bounds = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(bounds[-1], np.int64)
        for t, (x, e) in enumerate(zip(lanes, edges)):
            out[bounds[x] + t] = e
        return out, bounds


def parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts with a space put before each, cut where a run of spaces begins: distinct parts' bytes and bounds, occurrences, texts' firsts."""
    some = offsets[1:] > offsets[:-1]
    head = offsets[:-1][some]
    data = np.insert(data, head, 32)
    offsets = offsets + np.concatenate([[0], np.cumsum(some)])
    cut = data == 32
    cut[1:] &= data[:-1] != 32
    cut[offsets[:-1][some]] = True
    starts = np.flatnonzero(cut)
    places = np.concatenate([starts, [len(data)]]).astype(np.int32)
    coded = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
    distinct, bounds = utf8(coded.dictionary)
    return distinct, bounds, coded.indices.to_numpy(), np.searchsorted(starts, offsets)


def _uniform(keys: np.ndarray, turn: int, place: np.ndarray | int = 0) -> np.ndarray:
    x = mix(keys ^ np.uint64((turn + 1) * 0xD1B54A32D192ED03 % 2**64))
    x = mix(x + np.asarray(place).astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def sample_batch(pieces: Pieces, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to ``k`` of (ids, log-probability, perturbed log-probability, log of the inclusion probability), best first."""
    distinct, bounds, at, firsts = parts(data, offsets)
    lattice = Lattice(pieces, distinct, bounds)
    n = len(keys)
    owner = np.repeat(np.arange(n), np.diff(firsts))
    place = np.arange(len(at)) - firsts[:-1][owner]

    def seeds(text: np.ndarray, where: np.ndarray, turn: int) -> np.ndarray:
        return mix(mix(keys[text] ^ np.uint64((turn + 1) * 0xA0761D6478BD642F % 2**64)) + where.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))

    edges, cuts = lattice.draw(bounds[at], seeds(owner, place, 0))
    paths: list[list[tuple[np.ndarray, np.ndarray]]] = []  # (edges, part of each edge) of each sample
    of = np.repeat(np.arange(len(at)), np.diff(cuts))
    heaps: list[list[tuple]] = [[] for _ in range(n)]
    keyed = [[float(x)] for x in _gumbel(_uniform(keys, 0))]
    ends = cuts[firsts]
    for i in range(n):
        paths.append([(edges[ends[i] : ends[i + 1]], of[ends[i] : ends[i + 1]])])
    _beside(lattice, heaps, np.arange(n), edges, ends, keys, np.array([x[0] for x in keyed]), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64), k)
    for turn in range(1, k + 1):
        text, part, begin, prefix = [], [], [], []
        for i in range(n):
            if not heaps[i]:
                continue
            if turn == k:  # only the next one's key is wanted, for the inclusion probabilities
                continue
            value, j, sample, taken, base = heapq.heappop(heaps[i])
            value = -value
            way, where = paths[i][sample]
            lo, hi = lattice.first[lattice.start[way[j]]], lattice.first[lattice.start[way[j]] + 1]
            rest = np.array([e for e in range(lo, hi) if e not in taken])
            p = np.exp(lattice.log[rest] - lattice.log[rest].max())
            e = int(rest[min(len(rest) - 1, int(np.searchsorted(np.cumsum(p) / p.sum(), float(_uniform(keys[i : i + 1], turn, np.array([j]))[0]), "right")))])
            keyed[i].append(value)
            text.append(i)
            part.append(int(where[j]))
            begin.append(-1 if lattice.last[e] else int(lattice.stop[e]))
            prefix.append((way[:j], where[:j], e, taken, base, j))
        if not text:
            continue
        texts, parted = np.array(text), np.array(part)
        after = firsts[texts + 1] - parted - 1
        lanes_of = np.repeat(np.arange(len(text)), after + 1)
        lane_part = np.concatenate([[0], np.cumsum(after + 1)])
        where = parted[lanes_of] + np.arange(lane_part[-1]) - lane_part[lanes_of]
        start = bounds[at[where]]
        start[lane_part[:-1]] = begin
        live = start >= 0
        found, cut = lattice.draw(start[live], seeds(texts[lanes_of[live]], where[live] - firsts[texts[lanes_of[live]]], turn))
        each = np.zeros(len(start), np.int64)
        each[live] = np.diff(cut)
        ends = np.concatenate([[0], np.cumsum(each)])
        parts_of = np.repeat(where, each)
        ways, tops, bases, froms, numbers = [], [], [], [], []
        for x, i in enumerate(text):
            way, own, e, taken, base, j = prefix[x]
            a, b = ends[lane_part[x]], ends[lane_part[x + 1]]
            paths[i].append((np.concatenate([way, [e], found[a:b]]), np.concatenate([own, [part[x]], parts_of[a:b]])))
            gone = (*taken, e)
            lo, hi = lattice.first[lattice.start[e]], lattice.first[lattice.start[e] + 1]
            if hi - lo > len(gone):
                others = [o for o in range(lo, hi) if o not in gone]
                mass = base + np.logaddexp.reduce(lattice.log[others])
                g = float(_gumbel(_uniform(~keys[i : i + 1], turn, np.array([j])))[0])
                heapq.heappush(heaps[i], (float(np.logaddexp(-keyed[i][-1], -(mass + g))), j, len(paths[i]) - 1, gone, base))
            ways.append(found[a:b])
            tops.append(keyed[i][-1])
            bases.append(base + lattice.log[e])
            froms.append(j + 1)
            numbers.append(len(paths[i]) - 1)
        bound = np.concatenate([[0], np.cumsum([len(w) for w in ways])])
        _beside(lattice, heaps, texts, np.concatenate(ways), bound, keys, np.array(tops), np.array(bases), np.array(froms), np.array(numbers), k)
    ways = [way for x in paths for way, _ in x]
    size = np.array([len(w) for w in ways], np.int64)
    flat = np.concatenate(ways) if ways else np.zeros(0, np.int64)
    logs = per_text(lattice.log[flat], np.concatenate([[0], np.cumsum(size)])).tolist()
    ids, cuts = _ids(pieces, lattice, distinct, flat, size)
    out, at = [], 0
    for i in range(n):
        limit = -heaps[i][0][0] if heaps[i] else -np.inf
        rows = []
        for value in keyed[i]:
            over = logs[at] - limit
            chance = 0.0 if limit == -np.inf else over if over < -30 else float(np.log(-np.expm1(-np.exp(min(50.0, over)))))
            rows.append((ids[cuts[at] : cuts[at + 1]], logs[at], float(value), chance))
            at += 1
        out.append(rows)
    return out


def _beside(lattice: Lattice, heaps: list[list[tuple]], texts: np.ndarray, ways: np.ndarray, bounds: np.ndarray, keys: np.ndarray, top: np.ndarray, base: np.ndarray, begin: np.ndarray, sample: np.ndarray, k: int) -> None:
    """Queue for each text the sets of segmentations that leave its new path at one edge, each with a Gumbel of its mass, truncated at ``top``.

    ``ways`` are the paths on end from place ``begin`` on, where their log-probability is ``base``. At most ``k`` more are ever taken from a
    text's queue, so a path's best ``k`` sets are queued.
    """
    size = np.diff(bounds)
    of = np.repeat(np.arange(len(texts)), size)
    logs = np.concatenate([[0.0], np.cumsum(lattice.log[ways])])
    place = np.arange(len(ways)) - bounds[:-1][of]
    before = base[of] + logs[:-1] - logs[bounds[:-1]][of]
    turn = mix(keys[texts] + sample.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    mass = before + lattice.other(ways)
    value = np.logaddexp(-top[of], -(mass + _gumbel(_uniform(turn[of], 7, place + begin[of]))))  # negated, least first
    for x, i in enumerate(texts.tolist()):
        a, b = bounds[x], bounds[x + 1]
        v = value[a:b]
        best = np.argpartition(v, k - 1)[:k] if len(v) > k else np.arange(len(v))
        for j in best.tolist():
            if v[j] < np.inf:
                heapq.heappush(heaps[i], (float(v[j]), int(j + begin[x]), int(sample[x]), (int(ways[a + j]),), float(before[a + j])))


def _ids(pieces: Pieces, lattice: Lattice, data: np.ndarray, ways: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The ids of paths that lie on end, a character without a piece as its bytes, and where each path's begin."""
    ids = lattice.id[ways]
    size = np.where(ids < 0, lattice.stop[ways] - lattice.start[ways], 1)
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.repeat(ids, size)
    bare = np.flatnonzero(out < 0)
    if len(bare):
        edge = np.searchsorted(ends, bare, "right") - 1
        out[bare] = pieces.bytes[data[lattice.start[ways[edge]] + bare - ends[edge]]]
    return out, ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()


def sampled(table: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, model: str = MODEL, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """(id, sample, ids, log_prob, key, log_inclusion, restored): up to ``k`` distinct segmentations of each row, fewer where there are fewer.

    ``log_inclusion`` is the log of the chance that a segmentation is among the k, given the key of the next one, and weighs estimates from the
    sample; a long text's chances are too small for anything but their logs.
    ``restored`` tells whether the ids, decoded, give the text back. What is drawn depends on the row's id, its text's length, and ``seed`` alone. An empty text has one segmentation, without pieces; a null text has one row
    with null ``ids``, scores and ``restored``. A text of any length is one lattice. Repeated rows give repeated results; other columns are ignored, whatever their names.
    """
    one = table.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string"), F.length(text_col), F.lit(seed)).alias("seed"), F.col(text_col).alias("text"))
    kind = one.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in batches:
            pieces = pieces or Pieces(model, temperature)
            for part in slices(batch, most=3_000_000):
                data, offsets = utf8(part.column("text"))
                keys = part.column("seed").to_numpy().view(np.uint64)
                got = sample_batch(pieces, data, offsets, keys, k)
                nothing = part.column("text").is_null().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(got)), [len(x) for x in got])
                flat = [s for x in got for s in x]
                empty = nothing[row]
                values = pa.array(np.concatenate([s[0] for s in flat] or [np.zeros(0)]).astype(np.int32))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(s[0]) for s in flat])]).astype(np.int32))
                lists = pa.ListArray.from_arrays(ends, values, mask=pa.array(empty))
                text, bounds = data.tobytes(), offsets.tolist()
                same = [x == text[bounds[r] : bounds[r + 1]] for x, r in zip(pieces.restored(values, ends.to_numpy()), row.tolist())]
                number = np.concatenate([np.arange(1, len(x) + 1) for x in got] or [np.zeros(0)])
                score = [pa.array(np.array([s[j] for s in flat], float), mask=empty) for j in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row)), pa.array(number.astype(np.int32)), lists, *score, pa.array(np.array(same, bool), mask=empty)], names=["id", "sample", "ids", "log_prob", "key", "log_inclusion", "restored"])

    return map_batches(one, run, f"id {kind}, sample int, ids array<int>, log_prob double, key double, log_inclusion double, restored boolean").withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, *, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with a column ``decoded``, the text of the ids; null where they are. Bytes that aren't text become replacement characters.

    Of a column ``decoded`` that is there already the new one takes the place.
    """
    rows = rows.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in batches:
            pieces = pieces or Pieces(model)
            ids = batch.column(ids_col)
            size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            texts = [x.decode("utf-8", "replace") for x in pieces.restored(ids.flatten(), np.concatenate([[0], np.cumsum(size)]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))], names=[*batch.schema.names, "decoded"])

    return map_batches(rows, run, schema)
