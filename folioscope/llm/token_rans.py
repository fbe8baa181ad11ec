"""Token ids as compressed binary rows, by a static range asymmetric numeral system.

One frequency table, counted over all documents, serves every block. A document's ids are cut into blocks; each block is coded by itself
in interleaved lanes, token ``i`` in lane ``i % LANES``, that share one stream of 32-bit words. A document's row has a checkpoint
for each block: the token and byte where it begins and a checksum of its ids, so any block can be decoded, and proved, alone and in
parallel. Many blocks are coded in lockstep, a numpy operation at a time over all lanes.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.arrow_text import map_batches, slices, utf8
from folioscope.llm.scratch import written

LANES, BLOCK, SCALE = 4, 2048, 20
LOW = np.uint64(1 << 31)
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SCHEMA = "id {}, n_tokens long, payload binary, checkpoints array<struct<token:long,byte:long,crc:long>>"


def tokenizer(vocabulary: str = VOCABULARY, pattern: str = PATTERN):
    """A byte-level BPE from a file of base64 pieces and their ranks."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Texts cut before each single space that stands between other characters, where a token always begins.

    The distinct chunks, each occurrence's place among them, and each text's first occurrence. A space next to white space of any kind is no cut.
    """
    n = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    cut = data == 32
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    wide = (data >= 0xE1) & (data <= 0xE3)
    before[1:] = ~space[:-1]
    before[2:] &= ~((data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)))
    before[3:] &= ~wide[:-3]
    after[:-1] = ~space[1:] & ~wide[1:] & (data[1:] != 0xC2)
    cut &= before & after
    first = offsets[:-1][offsets[1:] > offsets[:-1]]
    ends = offsets[1:][offsets[1:] > offsets[:-1]]
    cut[ends - 1] = False
    cut[first] = True
    starts = np.flatnonzero(cut)
    places = np.concatenate([starts, [n]]).astype(np.int32)
    coded = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(starts, offsets)


def tokenize(encoding, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids on end and where each text's begin. A chunk is encoded once for all of its occurrences."""
    distinct, at, bounds = chunks(data, offsets)
    lists = [encoding.encode_ordinary(c.decode("utf-8", "replace")) for c in distinct.to_pylist()]
    size = np.array([len(x) for x in lists], np.int64)
    flat = np.fromiter((i for x in lists for i in x), np.int64, int(size.sum()))
    first = np.cumsum(size) - size
    each = size[at]
    ends = np.concatenate([[0], np.cumsum(each)])
    ids = flat[np.repeat(first[at] - ends[:-1], each) + np.arange(ends[-1])]
    return ids, ends[bounds]


class Frequencies:
    """Counts scaled to a power of two, at least 1 for every id that occurs, and their running sums."""

    def __init__(self, counts: np.ndarray, scale: int = SCALE):
        self.scale, total = scale, 1 << scale
        counts = np.asarray(counts, np.float64)
        some = np.flatnonzero(counts)
        if len(some) > total:
            raise ValueError("more ids than the scale has room for")
        self.freq = np.zeros(len(counts), np.uint64)
        if len(some):
            share = np.maximum(1, np.floor(counts[some] / counts.sum() * total)).astype(np.int64)
            order = np.argsort(-share, kind="stable")
            over = int(share.sum()) - total
            if over < 0:
                share[order[0]] -= over
            k = 0
            while over > 0:  # take from the largest what the least were given
                take = min(over, int(share[order[k]]) // 2)
                share[order[k]] -= take
                over -= take
                k = (k + 1) % len(order)
            self.freq[some] = share
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64) if len(counts) else np.zeros(0, np.uint64)

    def packed(self) -> bytes:
        return self.freq.astype("<u4").tobytes()

    @classmethod
    def unpacked(cls, blob: bytes, scale: int = SCALE) -> Frequencies:
        new = cls(np.zeros(0), scale)
        new.freq = np.frombuffer(blob, "<u4").astype(np.uint64)
        new.start = np.concatenate([[0], np.cumsum(new.freq)[:-1]]).astype(np.uint64)
        return new


def encode_blocks(blocks: list[np.ndarray], table: Frequencies) -> list[bytes]:
    """Each block's lanes' end states (8 bytes each), then its words, in the order in which the decoder wants them."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    k = 0
    while k < len(order):
        steps = max(1, -(-len(blocks[order[k]]) // LANES))
        group = order[k : k + max(1, 1_500_000 // (steps * LANES))]
        k += len(group)
        ids = np.full((len(group), steps * LANES), -1, np.int64)
        for r, i in enumerate(group):
            ids[r, : len(blocks[i])] = blocks[i]
        wide = len(group) * LANES
        ids = ids.reshape(len(group), steps, LANES).transpose(1, 0, 2).reshape(steps, wide)
        state = np.full(wide, LOW, np.uint64)
        sent, word = np.zeros((steps, wide), bool), np.zeros((steps, wide), np.uint32)
        shift, top = np.uint64(table.scale), np.uint64(63 - table.scale)
        lengths = np.array([len(blocks[i]) for i in group])
        active = np.searchsorted(-lengths, -(np.arange(steps) * LANES), "left") * LANES
        for t in range(steps - 1, -1, -1):
            w = active[t]
            row = ids[t, :w]
            on = row >= 0
            sym = np.where(on, row, 0)
            f = np.where(on, table.freq[sym], np.uint64(1))
            x = state[:w]
            big = on & ((x >> top) >= f)
            word[t, :w] = x  # the low 32 bits
            sent[t, :w] = big
            x = np.where(big, x >> np.uint64(32), x)
            q = x // f
            state[:w] = np.where(on, (q << shift) + (x - q * f) + table.start[sym], x)
        sent = sent.reshape(steps, len(group), LANES).transpose(1, 0, 2).reshape(len(group), -1)
        word = word.reshape(steps, len(group), LANES).transpose(1, 0, 2).reshape(len(group), -1)
        count = np.concatenate([[0], np.cumsum(sent.sum(1))])
        words = word[sent].astype("<u4").tobytes()
        heads = state.reshape(len(group), LANES).astype("<u8").tobytes()
        for r, i in enumerate(group):
            out[i] = heads[r * 8 * LANES : (r + 1) * 8 * LANES] + words[4 * count[r] : 4 * count[r + 1]]
    return out


def decode_block(blob: bytes, n: int, table: Frequencies, slots: np.ndarray) -> np.ndarray:
    """The ``n`` ids of one block; ``slots`` gives the id of each place of the scale."""
    state = [int(x) for x in np.frombuffer(blob, "<u8", LANES)]
    words, at = np.frombuffer(blob, "<u4", offset=8 * LANES), 0
    out = np.zeros(n, np.int64)
    mask = (1 << table.scale) - 1
    freq, start = table.freq, table.start
    for i in range(n):
        x = state[i % LANES]
        slot = x & mask
        sym = int(slots[slot])
        x = int(freq[sym]) * (x >> table.scale) + slot - int(start[sym])
        if x < 1 << 31:
            x = (x << 32) | int(words[at])
            at += 1
        state[i % LANES] = x
        out[i] = sym
    return out


def token_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(id, n, ids) of each row, ``ids`` as little-endian 32-bit numbers; a null text has null ``ids`` and 0 of them. Other columns are ignored."""
    one = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = None
        for batch in batches:
            encoding = encoding or tokenizer(vocabulary, pattern)
            for part in slices(batch):
                ids, bounds = tokenize(encoding, *utf8(part.column("text")))
                nothing = part.column("text").is_null().to_numpy(zero_copy_only=False)
                blob = ids.astype("<u4").tobytes()
                blobs = pa.array([None if nothing[i] else blob[4 * a : 4 * b] for i, (a, b) in enumerate(zip(bounds, bounds[1:]))], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(bounds)), blobs], names=["id", "n", "ids"])

    return map_batches(one, run, f"id {one.schema['id'].dataType.simpleString()}, n long, ids binary")


def frequencies(tokens: DataFrame, scale: int = SCALE) -> Frequencies:
    """The table of all rows' ids; what reaches the driver grows with the vocabulary and not with the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column("ids"):
                if blob.is_valid:
                    own = np.bincount(np.frombuffer(blob.as_buffer(), "<u4"))
                    if len(own) > len(total):
                        total = np.concatenate([total, np.zeros(len(own) - len(total), np.int64)])
                    total[: len(own)] += own
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    rows = map_batches(tokens.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()
    counts = np.zeros(ids.max() + 1 if len(ids) else 0, np.int64)
    counts[ids] = n
    return Frequencies(counts, scale)


def encoded(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN, block: int = BLOCK) -> DataFrame:
    """(id, n_tokens, payload, checkpoints) of each row, and one row more, of a null id and -1 tokens, whose payload is the table.

    An empty text has 0 tokens, an empty payload and no checkpoint; a null text has the same but a null payload. Repeated rows are
    encoded once each.
    """
    tokens = written(token_table(docs, id_col=id_col, text_col=text_col, vocabulary=vocabulary, pattern=pattern), "tokens")
    table = frequencies(tokens)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids", 3_000_000):
                blobs = part.column("ids").to_pylist()
                blocks, owner, token, crc = [], [], [], []
                for i, blob in enumerate(blobs):
                    for a in range(0, len(blob or b""), 4 * block):
                        blocks.append(np.frombuffer(blob, "<u4", min(block, (len(blob) - a) // 4), a))
                        owner.append(i)
                        token.append(a // 4)
                        crc.append(zlib.crc32(blob[a : a + 4 * block]))
                coded = encode_blocks(blocks, shared.value)
                payload: list[list[bytes]] = [[] for _ in blobs]
                marks: list[list[dict]] = [[] for _ in blobs]
                for i, t, c, x in zip(owner, token, crc, coded):
                    marks[i].append({"token": t, "byte": sum(map(len, payload[i][-1:])) + (marks[i][-1]["byte"] if marks[i] else 0), "crc": c})
                    payload[i].append(x)
                whole = [None if b is None else b"".join(p) for b, p in zip(blobs, payload)]
                kind = pa.list_(pa.struct([("token", pa.int64()), ("byte", pa.int64()), ("crc", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("n"), pa.array(whole, pa.binary()), pa.array(marks, kind)], names=["id", "n_tokens", "payload", "checkpoints"])

    kind = tokens.schema["id"].dataType.simpleString()
    rows = map_batches(tokens, run, _SCHEMA.format(kind))
    head = docs.sparkSession.createDataFrame([(None, -1, bytearray(table.packed()), [])], _SCHEMA.format(kind))
    return rows.union(head).withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, *, id_col: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """(id, ids) of each row of ``encoded``, a task taking blocks and not whole documents; a checksum that fails raises an error."""
    table = Frequencies.unpacked(bytes(rows.filter("n_tokens < 0").first()["payload"]))
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        slots = np.repeat(np.arange(len(t.freq)), t.freq.astype(np.int64))
        for batch in batches:
            got = []
            for blob, n, crc in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "crc"))):
                ids = decode_block(blob, n, t, slots)
                if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                    raise ValueError("a block doesn't match its checksum")
                got.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("token"), pa.array(got, pa.list_(pa.int64()))], names=["row", "token", "ids"])

    named = written(rows.filter("n_tokens >= 0").withColumn("row", F.monotonically_increasing_id()), "encoded")
    blocks = named.select("row", "n_tokens", "payload", "checkpoints", F.posexplode("checkpoints").alias("pos", "c"))
    blocks = blocks.select("row", F.col("c.token").alias("token"), F.least(F.lit(block), F.col("n_tokens") - F.col("c.token")).alias("n"), F.col("c.crc").alias("crc"), F.expr("substring(payload, cast(c.byte as int) + 1, cast(coalesce(get(checkpoints, pos + 1).byte, length(payload)) - c.byte as int))").alias("part"))
    ids = map_batches(blocks, run, "row long, token long, ids array<long>").groupBy("row").agg(F.flatten(F.expr("transform(array_sort(collect_list(struct(token, ids))), x -> x.ids)")).alias("ids"))
    none = F.when(F.col("payload").isNotNull(), F.expr("cast(array() as array<long>)"))
    return named.join(ids, "row", "left").select(id_col, F.coalesce("ids", none).alias("ids"))
