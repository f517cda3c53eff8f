"""Sharding by histogram sort: splitters from exact byte counts, then one exchange.

The sort key is (hash of the text, hash of the id), so copies of a text are neighbours. Each round counts, over all partitions,
the exact bytes below evenly spaced candidate boundaries of the key (one pre-aggregated ``groupBy``); a splitter settles on a
candidate as soon as the bytes below it are within ``TOLERANCE`` of a shard's share of its target, otherwise the next
round places ``2 ** ROUND_BITS`` new candidates between its two neighbours. The first key part is refined first, so a group of equal
texts is cut only where keeping it whole would miss the tolerance; inside one text's hash the second part is refined. When
an interval holds a single key, its nearer edge is taken. At most ``(shards - 1) * 2 ** ROUND_BITS`` counts reach the driver in a
round, whatever the data.

The exchange deals rows by shard and by ``PIECES`` ranges of a seeded hash of the row, which no hot text can unbalance; a row's slot
is the number of rows in earlier pieces of its shard plus its number in its piece. Only built-in functions are used.

Law: ``bytes`` (shard sizes near equal). Size is the UTF-8 length of the text plus 1. Defined cases: a null text has no bytes (size 1);
null ids hash like a value of their own; an empty table gives no rows; a document larger than a shard's share makes its shard larger than the others;
rows repeated in all of id and text take neighbouring slots in either order; other columns pass through.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import free_name, settled

SHARDS = 8
TOLERANCE = 0.01
ROUND_BITS = 12
MOST_BITS = 60  # keys that agree in so many bits are one key
PIECES = 4096
SEED = 11

LEAST = -(1 << 63)


class Splitter(NamedTuple):
    """Rows below: first < ``first``, or first = ``first`` and second < ``second``."""

    first: int
    second: int


class Interval(NamedTuple):
    """Keys with the top ``depth`` bits ``prefix``; of the second part if ``inside`` is a value of the first."""

    depth: int
    prefix: int
    inside: int | None

    def edge(self, prefix: int) -> Splitter | None:
        """The splitter below which keys have smaller prefixes; None beyond the last key of the part."""
        if prefix >= 1 << self.depth:
            if self.inside is None or self.inside == -LEAST - 1:
                return None
            return Splitter(self.inside + 1, LEAST)
        value = (prefix << (64 - self.depth)) + LEAST
        return Splitter(value, LEAST) if self.inside is None else Splitter(self.inside, value)


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def sort_key(id_: Column, text: Column) -> tuple[Column, Column]:
    words = F.coalesce(text, F.lit(""))
    return F.xxhash64(words), F.xxhash64(F.lit(SEED), id_.isNull(), id_, text.isNull())


def _prefix(key: Column, depth: int) -> Column:
    """The top bits of a signed key, in its order."""
    return F.shiftrightunsigned(key.bitwiseXOR(F.lit(LEAST)), 64 - depth)


def find_splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Splitter]:
    """``shards - 1`` ascending splitters over ``keys`` (first, second, size)."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total or shards < 2:
        return [Splitter(LEAST, LEAST)] * max(0, shards - 1)
    near = tolerance * total / shards
    found: dict[int, Splitter | None] = {}
    # target number -> (interval that holds the target, bytes below the interval)
    waiting = {j: (Interval(0, 0, None), 0) for j in range(1, shards)}
    while waiting:
        opened = {interval for interval, _ in waiting.values()}
        counts: dict[Interval, list] = {i: [] for i in opened}
        for depth, second in {(i.depth, i.inside is not None) for i in opened}:
            own = [i for i in opened if (i.depth, i.inside is not None) == (depth, second)]
            part = F.col("second" if second else "first")
            deeper = depth + ROUND_BITS
            held = F.lit(False)
            for i in own:
                at = F.lit(True) if depth == 0 else _prefix(part, depth) == i.prefix
                held = held | (at if i.inside is None else at & (F.col("first") == i.inside))
            inside = F.col("first") if second else F.lit(None).cast("long")
            rows = (
                keys.where(held)
                .groupBy(inside.alias("inside"), _prefix(part, deeper).alias("prefix"))
                .agg(F.sum("size").alias("bytes"), F.min(part).alias("low"), F.max(part).alias("high"))
                .orderBy("prefix")
                .collect()
            )
            for r in rows:
                above = r["prefix"] >> (deeper - depth)
                counts[Interval(depth, above if depth else 0, r["inside"])].append((Interval(deeper, r["prefix"], r["inside"]), r))
        for j, (interval, below) in list(waiting.items()):
            target = total * j / shards
            cells = counts[interval]
            at = below
            for cell, r in cells:
                if at + r["bytes"] >= target or (cell, r) == cells[-1]:
                    break
                at += r["bytes"]
            gaps = (target - at, at + r["bytes"] - target)
            single = r["low"] == r["high"]
            if min(gaps) <= near or (single and cell.inside is not None) or cell.depth == MOST_BITS:
                found[j] = cell.edge(cell.prefix if gaps[0] <= gaps[1] else cell.prefix + 1)
                if found[j] is None:
                    found[j] = Splitter(-LEAST - 1, -LEAST - 1)
                del waiting[j]
            elif single:  # one text's hash: cut among its ids
                waiting[j] = (Interval(0, 0, r["low"]), at)
            else:
                waiting[j] = (cell, at)
    return sorted(found[j] for j in range(1, shards))


def shard_of(first: Column, second: Column, splitters: list[Splitter]) -> Column:
    """The number of splitters that are not above the key."""
    number = F.lit(0)
    for s in splitters:
        below = (first < s.first) | ((first == s.first) & (second < s.second))
        number = number + F.when(below, 0).otherwise(1)
    return number


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text",
                    tolerance: float = TOLERANCE) -> DataFrame:
    """All columns of ``docs``, plus ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    names = [free_name(docs, n) for n in ("key_first", "key_second", "key_size")]
    text = F.col(f"`{text_column}`")
    keyed = docs.withColumns(dict(zip(names, (*sort_key(F.col(f"`{id_column}`"), text), byte_size(text)), strict=True)))
    keys = settled(keyed.select(*names))
    return _dealt(keyed, keys, names, shards, tolerance).drop(*names)


def shard_sized(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The same for settled rows that hold first, second and size of the documents, and no texts."""
    return _dealt(rows, rows, ["first", "second", "size"], shards, tolerance)


def _dealt(docs: DataFrame, keys: DataFrame, names: list[str], shards: int, tolerance: float) -> DataFrame:
    first, second = F.col(names[0]), F.col(names[1])
    splitters = find_splitters(keys.toDF(*keys.columns).select(first.alias("first"), second.alias("second"), F.col(names[2]).alias("size")), shards, tolerance)
    turn = F.xxhash64(F.lit(SEED), first, second)
    piece = _prefix(turn, 12).cast("int")  # PIECES = 2 ** 12
    # at most shards * PIECES rows
    counts = keys.groupBy(shard_of(first, second, splitters).alias("shard"), piece.alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")
    shard, slot, own, at_shard, at_piece, start = (
        free_name(docs, n) for n in ("shard", "slot", "key_piece", "at_shard", "at_piece", "at_slot")
    )
    offsets = counts.select(F.col("shard").alias(at_shard), F.col("piece").alias(at_piece), before.alias(start))
    placed = docs.withColumns({shard: shard_of(first, second, splitters), own: piece})
    number = F.row_number().over(Window.partitionBy(shard, own).orderBy(turn, first, second))
    joined = placed.withColumn(slot, number.cast("long") - 1).join(
        F.broadcast(offsets), (F.col(shard) == F.col(at_shard)) & (F.col(own) == F.col(at_piece))
    )
    return joined.withColumn(slot, F.col(slot) + F.col(start)).drop(own, at_shard, at_piece, start)
