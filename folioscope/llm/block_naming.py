"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of fixed size. The distinct blocks of the corpus are sorted and each gets an integer name; then adjacent names are
paired and the distinct pairs sorted and named in turn, until one name is left for each text. Equal names at the same level mean equal
texts and the other way round, with no chance of collision.

Blocks travel twice, once to be told apart and once to be sorted. Rows hold the 128-bit prints of their blocks and are matched to names by them, after it is
proved that no two blocks of the corpus share a print (if any do, all is begun anew with other prints), so a print stands for one block and a list of
prints for one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.scratch import among, fresh, written

BLOCK, PREFIX = 4096, 48


def _parts(text: Column, block: int) -> Column:
    """The blocks of a text, which an empty one has one of."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(text) / block)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(text.cast("binary"), i * block + 1, F.lit(block)))


def _print(part: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), part).alias("a"), F.xxhash64(F.lit(seed + 1), part).alias("b"))


def _key(text: Column, block: int, seed: int) -> Column:
    """The prints of a text's blocks; null for a null text."""
    return F.when(text.isNotNull(), F.transform(_parts(text, block), lambda p: _print(p, seed)))


def _sorted(df: DataFrame, order: list[Column], keys: list[str], label: str) -> DataFrame:
    """``keys`` with an integer ``name`` each, increasing by ``order``: written, so that a name never changes."""
    ranged = df.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return written(ranged.select(*keys, F.monotonically_increasing_id().alias("name")), label)


def _block_names(docs: DataFrame, text: Column, block: int) -> tuple[DataFrame, int]:
    """(a, b, name) of each distinct block, and the seed of prints that tell all of them apart.

    Blocks are ordered by their beginning, then their print, then whole. So the ends of ranges, which are sampled to the driver, stay small, and blocks that
    share a long beginning are still cut into many ranges.
    """
    parts = docs.filter(text.isNotNull()).select(F.explode(_parts(text, block)).alias("part")).distinct()
    seed = 0
    while True:
        printed = parts.select("part", _print(F.col("part"), seed).alias("p")).select("part", "p.*")
        names = _sorted(printed, [F.substring("part", 1, PREFIX), F.col("a"), F.col("part")], ["a", "b"], "blocks")
        if names.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return names, seed
        seed += 2


def _identified(docs: DataFrame, id_col: str, text_col: str, block: int) -> tuple[DataFrame, int]:
    """(row, id, key, level, name) of each row with a text, and the seed of the prints in ``key``."""
    names, seed = _block_names(docs, F.col(text_col), block)
    rows = docs.select(F.col(id_col).alias("id"), _key(F.col(text_col), block, seed).alias("key")).filter("key is not null")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    now = rows.select("row", F.size("key").alias("n"), F.posexplode("key").alias("place", "p")).select("row", "n", "place", "p.*")
    now = written(now.join(names, ["a", "b"]).select("row", "n", "place", "name"), "names")
    done, level = [], 0
    while True:
        done.append(now.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
        odd = F.col("place") % 2 == 1
        pairs = now.filter("n > 1").groupBy("row", F.floor(F.col("place") / 2).cast("int").alias("place")).agg(
            F.ceil(F.first("n") / 2).cast("int").alias("n"), F.max(F.when(~odd, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b")
        )
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            break
        names = _sorted(pairs.select("a", "b").distinct(), [F.col("a"), F.col("b")], ["a", "b"], "pair-names")
        now = written(pairs.join(names, ["a", "b"]).select("row", "n", "place", "name"), "names")
        level += 1
    every = done[0]
    for x in done[1:]:
        every = every.union(x)
    return rows.join(every, "row"), seed


def identities(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, level, name) of each row of ``docs`` with a text; ``level`` and ``name`` together are the text's identity, that of no other text."""
    return _identified(docs, id_col, text_col, block)[0].select(F.col("id").alias(id_col), "level", "name")


def _grouped(docs: DataFrame, id_col: str, text_col: str, block: int) -> tuple[DataFrame, int]:
    """(id, key, level, name, keep_id, copies) of each row with a text, and the seed of ``key``."""
    found, seed = _identified(docs, id_col, text_col, block)
    found = written(found.select("id", "key", "level", "name"), "identities")
    group = found.groupBy("level", "name").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))
    return found.join(group, ["level", "name"]), seed


def duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, keep_id, copies) of each row; ``keep_id`` is the least id of the rows with the same text and ``copies`` their number.

    Texts are compared whole and as they are, case and white space included, whatever their length. Empty texts equal each other. A null text equals nothing:
    its row has its own id and 1 copy. A null id sorts after all others. Repeated rows count as copies; other columns are ignored, whatever their names.
    """
    found, _ = _grouped(docs, id_col, text_col, block)
    none = docs.filter(F.col(text_col).isNull()).select(F.col(id_col).alias("id"), F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("copies"))
    return found.select("id", "keep_id", "copies").union(none).withColumnRenamed("id", id_col)


def without_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row of each text, that of the least id, all columns kept, whatever their names; rows with a null text all stay.

    Of rows that repeat both, the one whose columns hash least stays. A null id sorts after all others.
    """
    same, seed = _grouped(docs, id_col, text_col, block)
    first = F.col("id").eqNullSafe(F.col("keep_id"))
    gone = written(same.filter(~first).select("id", "key").distinct(), "gone")
    twice = same.filter(first).groupBy("level", "name").agg(F.first("id").alias("id"), F.first("key").alias("key"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = written(twice.select("id", "key"), "twice")
    at = fresh(docs, "block_prints")
    own = docs.withColumn(at, F.struct(F.col(id_col).alias("id"), _key(F.col(text_col), block, seed).alias("key")))
    own_hash = F.xxhash64(F.col(at)["id"], F.col(at)["key"])

    def split(keys: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The rows that can't be among ``keys``, those that may be, and ``keys`` as one column of another name."""
        maybe = among(own_hash, keys.select(F.xxhash64("id", "key").alias("h")))
        return rows.filter(~maybe), rows.filter(maybe), keys.select(F.struct("id", "key").alias(at + "_"))

    match = F.col(at)["id"].eqNullSafe(F.col(at + "_")["id"]) & (F.col(at)["key"] == F.col(at + "_")["key"])
    sure, maybe, keys = split(gone, own)
    stay = sure.union(maybe.join(keys, match, "left_anti"))
    if twice.isEmpty():
        return stay.select(*_names(docs))
    sure, maybe, keys = split(twice, stay)
    whole = F.struct(*_names(docs)).alias("row")
    repeated = maybe.join(keys, match, "left_semi").groupBy(at).agg(F.min_by(whole, F.xxhash64(*[_plain(f) for f in docs.schema])).alias("row"))
    return sure.union(maybe.join(keys, match, "left_anti")).select(*_names(docs)).union(repeated.select("row.*"))


def _names(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _plain(field: T.StructField) -> Column:
    """The column, or its JSON where it is a map, which can't be hashed."""
    return F.to_json(f"`{field.name}`") if isinstance(field.dataType, T.MapType) else F.col(f"`{field.name}`")
