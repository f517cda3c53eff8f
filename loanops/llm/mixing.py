"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks, then seeded block selection.

1. Targets: sources in code point order (null last) have the weights 3, 1, 2, repeating, and share ``TOTAL`` times all words; a target
   stops at ``MOST`` times its source's words, and the excess is shared again by weight until no target is above.
2. Seats: the mix has round(sum of targets / block) blocks. A source's quota is its number of quotients
   target / 1, target / 3, target / 5, ... among the highest, ties by source order. Rounding gives all but few
   of them; the others come from ranking the few quotients around each source's last seat. The quota for each output shard is the
   difference between the apportionments of the seats up to its end and up to its start (adding seats never takes one away).
3. Selection: a source's documents, in seeded order, are one stream of words, cut into blocks. Seat number t of the
   source takes block ``perm(t mod blocks)``, with a seeded affine permutation, so a quota of two passes takes each block twice,
   and every document takes the words of its blocks that were taken. No document gives its words more than ``MOST`` times.

The block is ``BLOCK`` words, or fewer where the smallest positive target is smaller than ``FINE`` blocks. The words before a document in its
stream come from sums over (source, piece of the seeded hash) and a running sum within a piece, so a hot
source is spread over ``PIECES`` tasks. What is global is one row for each source. Only built-in functions are used.

Defined cases: null, empty and wordless texts have size 0 and give nothing; a source of such texts only has target 0. A null source is a source
of its own, the last. Null ids and repeated rows count each; equal rows share the seeded order. An empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import free_name, settled

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2
BLOCK = 64
FINE = 64
SHARDS = 8
PIECES = 1024
SEED = 5

WORD = r"[^\x20\x09-\x0D]+"
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, rank, source_size, weight, target) from one row (source, source_size) for each source.

    Sources reach their cap in the order of cap / weight, so the capped ones are a prefix of that order: the source at a
    place is capped if the level that the sources from it on would have is not below its own cap / weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.lit(most) * F.col("source_size"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    before = {c: F.coalesce(F.sum(c).over(fill), F.lit(0)) for c in ("cap", "weight")}
    budget = F.lit(total) * F.sum("source_size").over(everything)
    ranked = ranked.withColumns(
        {"level": (budget - before["cap"]) / (F.sum("weight").over(everything) - before["weight"]), "full": F.col("cap") / F.col("weight")}
    )
    capped = F.col("level") >= F.col("full")
    ranked = ranked.withColumn("open_level", F.min(F.when(~capped, F.struct(F.col("full"), F.col("rank"), F.col("level")))).over(everything)["level"])
    target = F.when(capped, F.col("cap")).otherwise(F.col("weight") * F.col("open_level")).cast("double")
    return ranked.select("source", "rank", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def apportion(targets: DataFrame, seats: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, rank, target, seats, quota): Sainte-Lague quotas of ``seats`` by the column ``target`` for each value of ``keys``.

    Rounding target * seats / sum gives quotas whose sum is off by at most half the number of sources. With the final divisor a source's quota
    differs from that by no more than its share of (error + sources) plus 1, so ranking that many quotients on either side is exact.
    """
    whole = Window.partitionBy(*keys)
    own = targets.withColumn("seats", seats.cast("long"))
    own = own.withColumn("share", F.when(F.sum("target").over(whole) > 0, F.col("target") / F.sum("target").over(whole)).otherwise(0.0))
    own = own.withColumn("near", F.floor(F.col("share") * F.col("seats") + 0.5))
    own = own.withColumn("error", F.sum("near").over(whole) - F.col("seats"))
    reach = F.ceil(F.col("share") * (F.abs("error") + F.count(F.lit(1)).over(whole))) + 1
    own = own.withColumn("reach", F.when(F.col("target") > 0, reach).otherwise(0))
    own = own.withColumn("sure", F.greatest(F.lit(0), F.col("near") - F.col("reach")))
    own = own.withColumn("open", F.col("seats") - F.sum("sure").over(whole))
    # the quotients number sure .. near + reach - 1 of each source
    steps = F.when(F.col("target") > 0, F.sequence(F.col("sure"), F.col("near") + F.col("reach") - 1))
    tried = own.select(*keys, "rank", "target", "open", F.explode(steps).alias("step"))
    tried = tried.withColumn("quotient", F.col("target") / (2 * F.col("step") + 1))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("quotient"), "rank", "step"))
    won = tried.withColumn("place", place).where(F.col("place") <= F.col("open")).groupBy(*keys, "rank").agg(F.count(F.lit(1)).alias("more"))
    joined = own.join(won, [*keys, "rank"], "left")
    return joined.select(*keys, "rank", "target", "seats", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("quota"))


def block_plan(sizes: DataFrame, weights=WEIGHTS, total=TOTAL, most=MOST, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row for each source: its target, block size, blocks, permutation, and ``ends``, its seats up to each shard's end."""
    targets = source_targets(sizes, weights, total, most)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    size = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(least / FINE))).cast("long")
    targets = targets.withColumn("block", F.coalesce(size, F.lit(block)))
    targets = targets.withColumn("all_seats", F.round(F.sum("target").over(everything) / F.col("block")).cast("long"))
    targets = settled(targets)
    by_shard = targets.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    quotas = apportion(by_shard, F.floor(F.col("all_seats") * F.col("shard") / shards), ["shard"])
    ends = quotas.groupBy("rank").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "quota"))), lambda s: s["quota"]).alias("ends"))
    plan = targets.join(ends, "rank").withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    plan = plan.withColumn("ends", F.transform("ends", lambda q: F.least(q, F.lit(int(most)) * F.col("blocks"))))
    # a prime that does not divide the number of blocks moves every block to another place
    prime = F.lit(PRIMES[-1])
    for p in reversed(PRIMES[:-1]):
        prime = F.when(F.col("blocks") % p != 0, F.lit(p)).otherwise(prime)
    plan = plan.withColumn("stride", prime % F.greatest(F.col("blocks"), F.lit(1)))
    first = F.pmod(seeded(seed, F.concat(F.lit("rank "), F.col("rank").cast("string"))), F.greatest(F.col("blocks"), F.lit(1)))
    return settled(plan.withColumn("first", first).withColumn("quota", F.element_at("ends", -1)))


def seeded(seed: int, value: Column) -> Column:
    """60 bits of an md5, as a long."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), value)), 1, 15), 16, 10).cast("long")


def _seat(mix: str, block: Column) -> Column:
    """The seat that takes a block in the first pass."""
    return F.pmod(F.col(f"{mix}.stride") * block + F.col(f"{mix}.first"), F.col(f"{mix}.blocks"))


def _times(mix: str, block: Column) -> Column:
    """How often a block is taken."""
    blocks = F.col(f"{mix}.blocks")
    return F.greatest(F.lit(0), F.floor((F.col(f"{mix}.quota") - _seat(mix, block) + blocks - 1) / blocks)).cast("long")


def mix_sources(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights=WEIGHTS,
                total: float = TOTAL, most: float = MOST, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of ``docs``, plus a struct ``mix`` as the last one: size, source_size, target, taken, and begin, block, blocks, stride, first, quota, ends.

    ``begin`` is the number of words before the document in its source's stream; ``ends`` are the source's seats up to each shard's end.
    """
    id_, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    mix, size, piece, order, void, name = (free_name(docs, n) for n in ("mix", "mix_size", "mix_piece", "mix_order", "mix_void", "mix_source"))
    source = F.col(f"`{source_column}`").cast("string")
    turn = seeded(seed, F.coalesce(id_.cast("string"), F.lit("-")))
    sized = docs.withColumns({size: word_count(text), order: turn, void: source.isNull(), name: F.coalesce(source, F.lit(""))})
    sized = sized.withColumn(piece, F.shiftright(F.col(order), 50).cast("int"))  # PIECES = 2 ** 10
    keys = [void, name, piece]
    sums = settled(sized.groupBy(*keys).agg(F.sum(size).alias("words")))
    by_source = sums.groupBy(void, name).agg(F.sum("words").alias("source_size"))
    sizes = by_source.select(F.when(~F.col(void), F.col(name)).alias("source"), "source_size")
    plan = block_plan(sizes, weights, total, most, block, shards, seed)
    told = plan.withColumns({void: F.col("source").isNull(), name: F.coalesce("source", F.lit(""))}).drop("source")
    before = F.sum("words").over(Window.partitionBy(void, name).orderBy(piece)) - F.col("words")
    placed = sums.withColumn("before", before).join(told, [void, name])
    facts = [c for c in placed.columns if c not in keys]
    placed = placed.select(*keys, F.struct(*facts).alias(free_name(docs, "mix_facts")))
    facts = placed.columns[-1]
    inside = Window.partitionBy(*keys).orderBy(order, id_, F.xxhash64(text)).rowsBetween(Window.unboundedPreceding, -1)
    run = free_name(docs, "mix_run")
    joined = sized.withColumn(run, F.coalesce(F.sum(size).over(inside), F.lit(0))).join(placed, keys)
    begin = F.col(f"{facts}.before") + F.col(run)
    mixed = F.struct(
        F.col(size).alias("size"),
        begin.alias("begin"),
        *[F.col(f"{facts}.{c}").alias(c) for c in ("source_size", "target", "block", "blocks", "stride", "first", "quota", "ends")],
    )
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], mixed.alias(mix))
    start, end, width = F.col(f"{mix}.begin"), F.col(f"{mix}.begin") + F.col(f"{mix}.size"), F.col(f"{mix}.block")
    own = F.sequence(F.floor(start / width), F.floor((end - 1) / width))
    words = lambda k: (F.least(end, (k + 1) * width) - F.greatest(start, k * width)) * _times(mix, k)
    taken = F.when(F.col(f"{mix}.size") > 0, F.aggregate(own, F.lit(0).cast("long"), lambda a, k: a + words(k))).otherwise(F.lit(0))
    return joined.withColumn(mix, F.col(mix).withField("taken", taken.cast("long")))


def mixed_texts(mixed: DataFrame, text_column: str = "text", most: int = MOST) -> DataFrame:
    """The mix itself: for each pass one row of each document of which blocks were taken, its text cut down to their words."""
    *columns, mix = mixed.columns
    text = F.col(f"`{text_column}`")
    turn = free_name(mixed, "mix_pass")
    passes = mixed.where(F.col(f"{mix}.taken") > 0).withColumn(turn, F.explode(F.sequence(F.lit(0), F.lit(int(most) - 1))))
    taken = lambda k: F.col(turn) * F.col(f"{mix}.blocks") + _seat(mix, k) < F.col(f"{mix}.quota")
    start, width = F.col(f"{mix}.begin"), F.col(f"{mix}.block")
    own = F.sequence(F.floor(start / width), F.floor((start + F.col(f"{mix}.size") - 1) / width))
    words = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    part = F.array_join(F.filter(words, lambda _, i: taken(F.floor((start + i) / width))), "")
    cut = F.when(F.forall(own, taken), text).otherwise(F.regexp_replace(part, r"^[\x20\x09-\x0D]+", ""))
    return passes.where(F.exists(own, taken)).select(*[cut.alias(c) if c == text_column else F.col(f"`{c}`") for c in columns])
