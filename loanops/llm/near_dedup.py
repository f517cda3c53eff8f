"""MinHash near-dedup with DartMinHash signatures, banded joins, exact verification and connected components.

Texts are multisets of five-word shingles (words lower-cased in A-Z; a text of one to four words is one shingle), and two texts are linked if the
weighted Jaccard similarity of their shingle counts is at least ``SIMILARITY``.

Signatures: over (weight, rank) every shingle has the same darts in every document, a Poisson process in dyadic regions drawn from
hashes. A dart below the shingle's weight hits the document and belongs to one of ``COORDINATES`` coordinates; the hit of least rank
is that coordinate's value, so two documents agree on a coordinate with probability equal to their weighted similarity. Only regions below rank t / weight
are opened, t = k (ln k + 4); documents left with an empty coordinate open twice as much. The work is the number of
shingles plus t, not their product with the coordinates.

Links: documents of equal word sequences are one node first. Nodes that share one of ``BANDS`` bands are candidates; a pair at the threshold is missed
with probability (1 - 0.8^5)^26 = 3e-5. What is wanted are components, so a bucket never becomes all its pairs:

1. Every bucket tests one leader against its members, from whole texts, and the links are joined to components.
2. Where a bucket still holds several components, only links between these can matter. Buckets of up to ``SMALL`` members test their untested
   pairs outside the largest component as pairs, each once for all buckets. Larger ones are dealt into blocks of bounded size; a task compares the
   members outside the largest component in one block with all members of another by matrix products of shingle counts and
   returns a spanning forest of the links, not the links.

Every link between candidates is therefore reflected in the components, and nothing is capped.

Defined cases: null, empty and wordless texts are equal texts of no words, one class. Of a class the row with the least id is
kept (null ids last, then by hash of the text); of rows repeated in id and text one stays. An empty table gives none. Other columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import ASCII_LOWER, Texts, arrow_sized, chunks_of, free_name, grams, mix, mix_int, owners, settled, span_hashes, spans, sums_by

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5
COORDINATES = BANDS * ROWS
DARTS = COORDINATES * (math.log(COORDINATES) + 4)
SMALL = 8
BLOCK_NODES = 256
BLOCK_BYTES = 4 << 20
COLUMNS = 8192
BROADCAST_ROWS = 1_000_000  # keys of up to so many rows (at most 40 MB) are broadcast, more are joined by shuffle
FIRST_RANK = -4  # the lowest rank region is [0, 2 ** FIRST_RANK)
TEXTS_AT_ONCE = 1 << 20


def shingled(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes, their number for each text, word hashes, words of each text)."""
    lowered = texts._replace(data=ASCII_LOWER[texts.data])
    words = spans(lowered)
    hashes = span_hashes(lowered.data, words.start, words.end)
    keys, numbers = grams(hashes, words.counts, WORDS)
    return keys, numbers, hashes, words.counts


def weighted(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, count) of the different keys of each text, texts in order."""
    owner = owners(numbers)
    if not len(keys):
        return owner, keys, np.zeros(0, np.int64)
    order = np.lexsort((keys, owner))
    ranked, owner = keys[order], owner[order]
    new = np.append(True, (ranked[1:] != ranked[:-1]) | (owner[1:] != owner[:-1]))
    at = np.flatnonzero(new)
    return owner[at], ranked[at], np.diff(np.append(at, len(ranked)))


def _poisson_steps(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities, up to where they are 1 in float64."""
    top = int(mean + 12 * math.sqrt(mean) + 24)
    n = np.arange(top)
    logs = n * math.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(n[1:]))])
    return np.cumsum(np.exp(logs))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in [0, 1) from the top bits."""
    return (x >> np.uint64(11)) * (1.0 / (1 << 53))


def dart_signatures(owner: np.ndarray, keys: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """(texts, COORDINATES) dart of least rank for each coordinate, of weighted elements (real weights > 0); all ones where a text has none."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    signature = np.full(texts * COORDINATES, empty, np.uint64)
    total = np.bincount(owner, weights, minlength=texts)
    limit = np.divide(DARTS, total, out=np.zeros(texts), where=total > 0)
    todo = total > 0
    while todo.any():
        own = todo[owner]
        who, key, weight = owner[own], keys[own], weights[own]
        top = limit[who]
        level, low = FIRST_RANK, 0.0
        while True:
            high = 2.0**level
            reach = top > low
            if not reach.any():
                break
            if not reach.all():
                who, key, weight, top = who[reach], key[reach], weight[reach], top[reach]
            region, base, width = 0, 0.0, 1.0
            inside = np.arange(len(key))
            while len(inside):
                seed = mix(key[inside] + np.uint64(mix_int(((level + 64) << 8) + region)))
                mean = width * (high - low)
                number = np.searchsorted(_poisson_steps(mean), _unit(seed), "right")
                hit = number > 0
                count = number[hit]
                source = np.repeat(inside[hit], count)
                turn = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
                dart = mix(np.repeat(seed[hit], count) + (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                place = base + width * _unit(mix(dart ^ np.uint64(0x5851F42D4C957F2D)))
                rank = low + (high - low) * _unit(mix(dart ^ np.uint64(0x14057B7EF767814F)))
                good = (place < weight[source]) & (rank < top[source])
                source, dart, rank = source[good], dart[good], rank[good]
                value = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart >> np.uint64(32))
                column = (dart & np.uint64(0xFFFFFFFF)) % np.uint64(COORDINATES)
                np.minimum.at(signature, who[source] * COORDINATES + column.astype(np.int64), value)
                base, width, region = (1.0, 1.0, 1) if region == 0 else (base + width, 2 * width, region + 1)
                inside = inside[weight[inside] > base]
            low, level = high, level + 1
        missing = (signature.reshape(texts, COORDINATES) == empty).any(1)
        todo &= missing
        limit = limit * 2
    return signature.reshape(texts, COORDINATES)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(texts, BANDS) hashes of ROWS neighbouring coordinates; different bands have different keys."""
    salts = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64))
    return mix(mix(signature + salts).reshape(len(signature), BANDS, ROWS).sum(2, dtype=np.uint64))


def sequence_hashes(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's sequence of words."""
    place = (np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    both = []
    for salt in (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85):
        parts = mix(hashes * np.uint64(salt) + place)
        both.append(sums_by(counts, parts.view(np.int64)))
    return both[0], both[1]


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def signed_nodes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, own, node, check, words, bands): one row for each document; ``own`` tells texts apart, ``node`` and ``check`` word sequences."""
    arrow_sized(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for texts in chunks_of(batch.column(2), TEXTS_AT_ONCE):
                keys, numbers, hashes, counts = shingled(texts)
                owner, key, weight = weighted(keys, numbers)
                bands = band_keys(dart_signatures(owner, key, weight.astype(np.float64), len(counts)))
                node, check = sequence_hashes(hashes, counts)
                full = counts > 0
                ends = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[full].view(np.int64).ravel()))
                part = batch.slice(texts.first, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(node), pa.array(check), pa.array(counts), lists], ["id", "own", "node", "check", "words", "bands"]
                )

    text = F.col(f"`{text_column}`")
    own = docs.select(F.col(f"`{id_column}`").alias("id"), text_key(text).alias("own"), text.alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {kind}, own long, node long, check long, words long, bands array<bigint>")


def similar_pairs(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b, text_a, text_b) whose texts are similar enough."""

    def run(batches):
        for batch in batches:
            found = []
            step = 64
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                sides = []
                for k in (2, 3):
                    owner, key, weight = [], [], []
                    for texts in chunks_of(part.column(k), TEXTS_AT_ONCE):
                        o, s, w = weighted(*shingled(texts)[:2])
                        owner.append(o + texts.first), key.append(s), weight.append(w)
                    sides.append((np.concatenate(owner), np.concatenate(key), np.concatenate(weight)))
                (oa, ka, wa), (ob, kb, wb) = sides
                _, ia, ib = np.intersect1d(ka + mix(oa.astype(np.uint64)), kb + mix(ob.astype(np.uint64)), assume_unique=True, return_indices=True)
                size = part.num_rows
                shared = np.bincount(oa[ia], np.minimum(wa[ia], wb[ib]), minlength=size)
                union = np.bincount(oa, wa, minlength=size) + np.bincount(ob, wb, minlength=size) - shared
                found.append(shared / np.maximum(union, 1))
            value = np.concatenate(found) if found else np.zeros(0)
            good = pa.array(value >= similarity)
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value)], ["a", "b", "similarity"])
            yield kept.filter(good)

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, similarity double")


def _elements(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element) of all texts, where the n-th copy of a shingle is an element of its own, and elements of each text."""
    owner, element, size = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], []
    for texts in chunks_of(column, TEXTS_AT_ONCE):
        o, key, count = weighted(*shingled(texts)[:2])
        turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owner.append(np.repeat(o, count) + texts.first)
        element.append(mix(np.repeat(key, count) + turn.astype(np.uint64)))
        size.append(np.bincount(np.repeat(o, count), minlength=len(texts.offsets) - 1))
    return np.concatenate(owner), np.concatenate(element), np.concatenate(size) if size else np.zeros(0, np.int64)


def block_similarity(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of each left with each right text, by products of bounded slices of their element matrices."""
    (lo, le, ln), (ro, re, rn) = _elements(left), _elements(right)
    both = np.intersect1d(le, re)
    shared = np.zeros((len(left), len(right)))
    for at in range(0, len(both), COLUMNS):
        own = both[at : at + COLUMNS]
        parts = []
        for owner, element, rows in ((lo, le, len(left)), (ro, re, len(right))):
            place = np.minimum(np.searchsorted(own, element), len(own) - 1)
            here = own[place] == element
            part = np.zeros((rows, len(own)), np.float32)
            part[owner[here], place[here]] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    return shared / np.maximum(ln[:, None] + rn[None] - shared, 1)


def forest(roots: np.ndarray, pairs: np.ndarray) -> list[int]:
    """Positions of the pairs (rows of ``roots`` places) that join two components not joined before."""
    parent = {int(r): int(r) for r in roots}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (a, b) in enumerate(pairs):
        x, y = find(int(roots[a])), find(int(roots[b]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return kept


def block_links(blocks: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that join components within each (bucket, left, right) group of blocks (side, node, root, text)."""

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        node, root = table["node"].to_numpy(), table["root"].to_numpy()
        text = table["text"].combine_chunks()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(left) and len(right):
            close = block_similarity(text.take(pa.array(left)), text.take(pa.array(right))) >= similarity
            x, y = np.nonzero(close & (root[left][:, None] != root[right][None]))
            pairs = np.stack([left[x], right[y]], 1)
            kept = pairs[forest(root, pairs)] if len(pairs) else pairs
            a, b = node[kept[:, 0]], node[kept[:, 1]]
        return pa.table({"a": a, "b": b})

    return blocks.groupBy("bucket", "left", "right").applyInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component, for all nodes with an edge; alternating large and small stars."""
    now = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(seen) or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        mark = tuple(seen)
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = settled(large)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = settled(down.select("a", F.col("m").alias("b")).union(moved.select(F.greatest("a", "b"), F.least("a", "b"))).where("a <> b").distinct())


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _looked_up(rows: DataFrame, keys: DataFrame, condition: Column, how: str) -> DataFrame:
    """Join of documents to settled keys; few keys are broadcast, so that the texts are not shuffled."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, condition, how)


def _tested(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    whole = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    whole = whole.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return settled(similar_pairs(whole, similarity).select("a", "b"))


def linked_nodes(nodes: DataFrame, docs: DataFrame, id_column: str, text_column: str, similarity: float) -> DataFrame:
    """(node, root) of all nodes with a link; ``nodes`` has (node, id, own, bands), one row for each word sequence."""
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    # grouped by a hash as well, so that the join exchanges both sides and hot buckets can be split
    shared = buckets.groupBy("bucket", F.xxhash64("bucket")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = settled(buckets.join(shared, "bucket"))
    candidates = settled(nodes.join(members.select("node").distinct(), "node").select("node", F.col("id").alias("of"), F.col("own").alias("its")))
    text = F.col(f"`{text_column}`")
    told = docs.select(F.col(f"`{id_column}`").alias("id"), text_key(text).alias("own"), text.alias("text"))
    found = _looked_up(told, candidates, F.col("id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("its")), "inner")
    texts = settled(found.groupBy("node").agg(F.first("text").alias("text")))

    def ordered(a: str, b: str) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    leaders = members.groupBy("bucket", F.xxhash64("bucket")).agg(F.min("node").alias("leader")).select("bucket", "leader")
    star = settled(members.join(leaders, "bucket").where("node <> leader").select(*ordered("node", "leader")).distinct())
    edges = _tested(star, texts, similarity)
    placed = settled(_rooted(members, settled(components(edges))).select("bucket", "node", "root"))
    parts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("roots"))
    mixed = settled(mixed.where("roots > 1").select("bucket", "main", "size"))
    open_ = placed.join(mixed, "bucket")
    few = open_.where(F.col("size") <= SMALL)
    outside = few.where("root <> main").select("bucket", F.col("node").alias("other"), F.col("root").alias("its"))
    pairs = few.join(outside, "bucket").where("root <> its").select(*ordered("node", "other")).distinct()
    edges = edges.union(_tested(settled(pairs.join(star, ["a", "b"], "left_anti")), texts, similarity))

    many = open_.where(F.col("size") > SMALL).join(texts.select("node", "text"), "node")
    bytes_ = open_.where(F.col("size") > SMALL).join(texts.select("node", F.octet_length("text").alias("bytes")), "node")
    bytes_ = bytes_.groupBy("bucket", F.xxhash64("bucket")).agg(F.sum("bytes").alias("bytes"))
    pieces = settled(mixed.join(bytes_, "bucket").select("bucket", F.ceil(F.greatest(F.col("size") / BLOCK_NODES, F.col("bytes") / BLOCK_BYTES)).alias("pieces")))
    many = many.join(pieces, "bucket").withColumn("piece", F.pmod(F.xxhash64("node", "bucket"), "pieces"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    left = many.where("root <> main").withColumn("right", every).withColumnRenamed("piece", "left").withColumn("side", F.lit(0))
    right = many.withColumn("left", every).withColumnRenamed("piece", "right").withColumn("side", F.lit(1))
    columns = ["bucket", "left", "right", "side", "node", "root", "text"]
    edges = edges.union(settled(block_links(left.select(*columns).union(right.select(*columns)), similarity)))
    return settled(components(edges))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, own, class_id, class_size, class_own): one row for each document; a class is named after its kept row."""
    signed = settled(signed_nodes(docs, id_column, text_column))
    row = F.struct(F.col("id").isNull().alias("void"), F.col("id").alias("id"), F.col("own").alias("own"))
    nodes = signed.groupBy("node", "check").agg(F.min(row).alias("least"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"))
    nodes = settled(nodes.select("node", "check", "least", "copies", "bands"))
    short = nodes.select("node", "least.id", "least.own", "bands")
    roots = linked_nodes(short, docs, id_column, text_column, similarity)
    rooted = _rooted(nodes.select("node", "check", "least", "copies"), roots)
    classes = rooted.groupBy("root").agg(F.min("least").alias("kept"), F.sum("copies").alias("class_size"))
    named = settled(rooted.select("node", "check", "root").join(classes, "root").select("node", "check", "kept", "class_size"))
    return signed.select("id", "own", "node", "check").join(named, ["node", "check"]).select(
        "id", "own", F.col("kept.id").alias("class_id"), "class_size", F.col("kept.own").alias("class_own")
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents without all but one of each class.

    Only rows that go, or that are repeated in id and text, have to be looked up.
    """
    classes = near_duplicates(docs, id_column, text_column, similarity)
    kept = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("own") == F.col("class_own"))
    marked = classes.groupBy("id", "own").agg(F.bool_or(kept).alias("stays"), F.count(F.lit(1)).alias("rows"))
    marked = settled(marked.where("not stays or rows > 1").select(F.col("id").alias("of"), F.col("own").alias("its"), "stays"))
    own, at, its, stays = (free_name(docs, n) for n in ("kept_own", "kept_id", "kept_its", "kept_stays"))
    keyed = docs.withColumn(own, text_key(F.col(f"`{text_column}`")))
    told = marked.toDF(at, its, stays)
    found = _looked_up(keyed, told, F.col(f"`{id_column}`").eqNullSafe(F.col(at)) & (F.col(own) == F.col(its)), "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = found.where(F.col(its).isNull()).select(*columns)
    repeated = found.where(F.col(stays)).dropDuplicates([id_column, own]).select(*columns)
    return single.union(repeated)
