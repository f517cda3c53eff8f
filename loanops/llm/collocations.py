"""Collocations by prefix-free parsing: phrases are counted inside the different chunks of a corpus, weighted by their copies.

A chunk begins with a text or where the hash of ``longest - 1`` words in a row is 0 modulo ``every``, and goes on to the end of the next
such place, so neighbours overlap by ``longest - 1`` words, equal passages fall into equal chunks wherever they lie, and every
phrase lies in the chunk in which it starts. The words that a chunk shares with the next one count there, not here.
The dictionary of (language, chunk, copies) is written once and read twice:

1. words and word pairs are counted by 48-bit hash. A phrase occurs no more often than its words and pairs, and a hash no less often than
   what falls on it, so hashes below ``least`` rule out phrases, never one that is frequent enough. Most hashes are rare, so they are
   many: each task sends its own sorted, as compressed gaps, and each range of hashes (of about ``RANGE`` bytes of chunks) is summed by itself. The others go
   into a bit filter of counted size, at most ``FILTER_BITS`` (32 MB); more of them than it can tell apart only mean more rows in 2;
2. the words and phrases that the filter lets through are counted by their text, exactly. Most are rare too, so each task sends its own sorted, as
   compressed lists, and each range of their hashes (of about ``TEXT_RANGE`` bytes of chunks) is summed by itself.

Cases: null and empty texts have no phrases; a null language is ``und``; equal rows count once each; phrases never cross a piece (``[.,;:!?]``
or a line end). A text of one repeated word may be one chunk, so memory is bounded by the longest text. Ties in rank end at the phrase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored
from .textkit import ASCII_LOWER, Spans, Texts, arrow_sized, chunks_of, mix, owners, span_hashes, spans

LONGEST, LEAST, SHARE, TOP, EVERY = 3, 10, 50, 2000, 32
FILTER_BITS = 1 << 28
BLOCK = 1 << 21  # bytes of chunks that are counted together before they reach Spark
HELD = 1 << 21  # hashes or phrases that a task sums up before it sends them
RANGE = 1 << 23  # bytes of chunks for each range of hashes
TEXT_RANGE = 1 << 25  # the same for phrases, of which fewer are left
KEY_BITS = 48
SPREAD = 64

_PIECE = np.zeros(256, np.uint8)
_PIECE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 1
_WORD = 1 - _PIECE
_WORD[[0x20, 0x09]] = 0
_IN_CHUNK = np.ones(256, np.uint8)
_IN_CHUNK[[0x20, 0x0A]] = 0


def mine_collocations(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    every: int = EVERY,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut of lowest ``score`` = floor(1000000 a a / (l r)), ``n`` the
    language's words. A phrase is left out if a longer one with ``share`` percent of its count or more contains it.
    """
    if longest < 2 or least < 1:
        raise ValueError((longest, least))
    chunks = stored(dictionary(docs, lang_column, text_column, longest, every))
    counts = stored(phrase_counts(chunks, longest, least))
    return ranked(counts, longest, least, share, top)


# ---------------------------------------------------------------- parsing


def dictionary(docs: DataFrame, lang_column: str, text_column: str, longest: int, every: int) -> DataFrame:
    """(lang, chunk, shared, copies): the different chunks; the last ``shared`` words of a chunk begin the next one too.

    Inside a chunk a space stands between words of a piece, a line end between pieces.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks_of(batch.column(1)):
                rows, chunks, shared = chunks_of_texts(texts, longest - 1, every)
                if len(rows):
                    langs = batch.column(0).take(pa.array(rows + texts.first))
                    yield pa.RecordBatch.from_arrays([langs, chunks, pa.array(shared, pa.int32())], ["lang", "chunk", "shared"])

    arrow_sized(docs.sparkSession)
    slim = docs.select(
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    parsed = slim.mapInArrow(parse, "lang string, chunk string, shared int")
    return parsed.groupBy("lang", "chunk", "shared").agg(F.count(F.lit(1)).alias("copies"))


def chunks_of_texts(texts: Texts, overlap: int, every: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(text, chunk, shared words) of every chunk of some texts."""
    data = ASCII_LOWER[texts.data]
    start, end, counts = spans(Texts(data, texts.offsets, texts.first), _WORD)
    size = len(start)
    owner = owners(counts)
    if not size:
        return owner, pa.array([], pa.string()), owner
    piece = np.cumsum(_PIECE[data], dtype=np.int64)[start]
    begins = np.append(True, owner[1:] != owner[:-1])
    if size >= overlap:
        window = np.zeros(size - overlap + 1, np.uint64)
        hashes, salts = span_hashes(data, start, end), mix(np.arange(1, overlap + 1, dtype=np.uint64))
        for k in range(overlap):
            window += hashes[k : size - overlap + 1 + k] * salts[k]
        whole = owner[: size - overlap + 1] == owner[overlap - 1 :]
        begins[: size - overlap + 1] |= whole & (mix(window) % np.uint64(every) == 0)
    first = np.flatnonzero(begins)
    rows = owner[first]
    more = np.append(rows[1:] == rows[:-1], False)
    ends = np.cumsum(counts)[rows] - 1
    last = np.where(more, np.append(first[1:], 0) + overlap - 1, ends)
    # Words one after the other, each with the byte that follows it.
    sizes = end - start + 1
    stop = np.cumsum(sizes)
    joined = np.append(data, np.uint8(0))[np.arange(stop[-1]) + np.repeat(start - (stop - sizes), sizes)]
    goes_on = np.append((owner[1:] == owner[:-1]) & (piece[1:] == piece[:-1]), False)
    joined[stop - 1] = np.where(goes_on, 0x20, 0x0A)
    return rows, sliced(joined, (stop - sizes)[first], stop[last] - 1), np.where(more, overlap, 0)


def sliced(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The text of each span; spans may overlap."""
    sizes = end - start
    stop = np.cumsum(sizes)
    total = int(stop[-1]) if len(stop) else 0
    out = data[np.arange(total) + np.repeat(start - (stop - sizes), sizes)]
    offsets = np.append(0, stop).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


# ---------------------------------------------------------------- counting


def phrase_counts(chunks: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, words, phrase, count): all words and phrases that occur ``least`` times or more, and with ``words`` 0 each language's words."""
    spark = chunks.sparkSession
    frequent = stored(frequent_keys(chunks, least))
    bits = spark.sparkContext.broadcast(bit_filter(frequent))
    ranges = min(1 + chunk_bytes(chunks) // TEXT_RANGE, 1 << 15)
    sent = chunks.mapInArrow(_text_counter(bits, longest, ranges), "part int, lang string, phrases binary, copies binary")
    return sent.repartition(ranges, "part").sortWithinPartitions("part").mapInArrow(_phrase_summer(least), "lang string, words int, phrase string, count bigint")


def chunk_bytes(chunks: DataFrame) -> int:
    return chunks.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0


def frequent_keys(chunks: DataFrame, least: int) -> DataFrame:
    """(key): the hashes of words and pairs that occur ``least`` times or more, summed range by range.

    A word takes two bytes or more with the one that follows it, so there are no more words and pairs than bytes.
    """
    ranges = min(1 + chunk_bytes(chunks) // RANGE, 1 << 15)
    sent = chunks.mapInArrow(_hash_counter(ranges), "part int, data binary")
    return sent.repartition(ranges, "part").sortWithinPartitions("part").mapInArrow(_range_summer(least), "key bigint")


def bit_filter(keys: DataFrame, most: int = FILTER_BITS) -> np.ndarray:
    """Two bits of each key, in a table of at least 16 bits a key but at most ``most`` bits; the only thing that reaches the driver."""
    wanted = 16 * max(keys.count(), 1 << 12)
    size = min(1 << (wanted - 1).bit_length(), most)
    slots = F.explode(F.array(*[F.shiftrightunsigned("key", k).bitwiseAND(size - 1) for k in (0, 20)]))
    words = keys.select(slots.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
    table = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy()
    return bits


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for k in (0, 20):
        slot = (keys >> np.uint64(k)) & np.uint64(len(bits) * 64 - 1)
        out &= (bits.view(np.uint64)[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return out


class _Block:
    """Some chunks with their words: hashes, which words start phrases here, and which go on with the next word."""

    def __init__(self, table: pa.Table, texts: Texts):
        rows = slice(texts.first, texts.first + len(texts.offsets) - 1)
        self.data = texts.data
        words: Spans = spans(texts, _IN_CHUNK)
        self.start, self.end, counts = words
        owner = owners(counts)
        place = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
        self.own = place < (counts - table["shared"].to_numpy()[rows])[owner]
        self.copies = table["copies"].to_numpy()[rows][owner]
        lang = table["lang"].combine_chunks().dictionary_encode()
        self.langs = lang.dictionary
        self.lang = lang.indices.to_numpy()[rows][owner]
        salts = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in self.langs.to_pylist()], np.uint64)
        salt = salts[self.lang] if len(owner) else np.zeros(0, np.uint64)
        hashes = span_hashes(self.data, self.start, self.end)
        self.word_keys = mix(hashes ^ salt) >> np.uint64(64 - KEY_BITS)
        after = np.append(self.data, np.uint8(0))[self.end] if len(owner) else np.zeros(0, np.uint8)
        self.goes_on = np.append(owner[1:] == owner[:-1], False)[: len(owner)] & (after == 0x20)
        following = np.append(hashes[1:], np.uint64(0))[: len(owner)]
        self.pair_keys = mix(mix(hashes ^ salt) * np.uint64(0x9E3779B97F4A7C15) + following) >> np.uint64(64 - KEY_BITS)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    held: list[pa.RecordBatch] = []
    size = 0

    def whole() -> Iterator[_Block]:
        table = pa.Table.from_batches(held)
        for texts in chunks_of(table["chunk"], BLOCK):
            yield _Block(table, texts)

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BLOCK:
            yield from whole()
            held, size = [], 0
    if held:
        yield from whole()


def _summed(keys: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, copies = keys[order], copies[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(copies, first) if len(first) else copies[:0]


def packed(keys: np.ndarray, copies: np.ndarray) -> bytes:
    """Sorted hashes and their copies: gaps between hashes, then copies, compressed byte by byte of equal weight."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8).T.ravel() for x in (gaps, copies)]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes).tobytes())


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(2, 8, -1)
    gaps, copies = (np.ascontiguousarray(x.T).view("<u8").ravel() for x in planes)
    return np.cumsum(gaps, dtype=np.uint64), copies.astype(np.int64)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([keys for keys, _ in held]), np.concatenate([copies for _, copies in held]))


def _hash_counter(ranges: int):
    def slices(keys: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
        part = (keys * np.uint64(ranges)) >> np.uint64(KEY_BITS)
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        data = [packed(keys[a:b], copies[a:b]) for a, b in zip(first, np.append(first[1:], len(keys)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(part[first].astype(np.int32)), pa.array(data, pa.binary())], ["part", "data"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for block in _blocks(batches):
            pair = block.own & block.goes_on
            keys = np.concatenate([block.word_keys[block.own], block.pair_keys[pair]])
            held.append(_summed(keys, np.concatenate([block.copies[block.own], block.copies[pair]])))
            if sum(len(keys) for keys, _ in held) >= HELD:
                held = [_merged(held)]
                if len(held[0][0]) >= HELD // 2:
                    yield slices(*held[0])
                    held = []
        if held:
            yield slices(*_merged(held))

    return count


def _range_summer(least: int):
    """Sums of one range after the other; their slices come in order of ranges."""

    def frequent(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, copies = _merged(held)
        return pa.RecordBatch.from_arrays([pa.array(keys[copies >= least].view(np.int64))], ["key"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if part != at and held:
                    yield frequent(held)
                    held = []
                held.append(unpacked(data.as_py()))
                at = part
        if held:
            yield frequent(held)

    return add


def _by_phrase(held: list[pa.Table]) -> pa.Table:
    """(lang, phrase, copies): one row for each phrase."""
    summed = pa.concat_tables(held).group_by(["lang", "phrase"], use_threads=False).aggregate([("copies", "sum")])
    return pa.table({"lang": summed["lang"], "phrase": summed["phrase"], "copies": summed["copies_sum"]})


def packed_phrases(table: pa.Table, ranges: int) -> pa.RecordBatch:
    """(part, lang, phrases, copies): the phrases of each range and language in order, line by line, and their copies."""
    table = table.take(pc.sort_indices(table["phrase"]))
    phrase = table["phrase"].combine_chunks().cast(pa.large_string())
    offsets = np.frombuffer(phrase.buffers()[1], np.int64)[phrase.offset : phrase.offset + len(phrase) + 1]
    raw = phrase.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    part = (span_hashes(data, offsets[:-1], offsets[1:]) >> np.uint64(64 - KEY_BITS)) * np.uint64(ranges) >> np.uint64(KEY_BITS)
    lang = table["lang"].combine_chunks().dictionary_encode()
    group = part.astype(np.int64) * max(len(lang.dictionary), 1) + lang.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    group, copies = group[order], table["copies"].to_numpy()[order]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    edges = np.append(first, len(group))
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), phrase.take(pa.array(order))), pa.scalar("\n", pa.large_string()))
    small = zstandard.ZstdCompressor(level=3)
    texts = [small.compress(x.as_buffer()) for x in lines]
    numbers = [small.compress(copies[a:b].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    columns = [pa.array(part[order[first]].astype(np.int32)), table["lang"].combine_chunks().take(pa.array(order[first])), pa.array(texts, pa.binary()), pa.array(numbers, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrases", "copies"])


def unpacked_phrases(lang: str, phrases: bytes, copies: bytes) -> pa.Table:
    unpack = zstandard.ZstdDecompressor()
    lines = pc.split_pattern(pa.array([unpack.decompress(phrases)], pa.large_binary()).cast(pa.large_string()), "\n").flatten()
    numbers = np.ascontiguousarray(np.frombuffer(unpack.decompress(copies), np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)
    return pa.table({"lang": pa.repeat(pa.scalar(lang, pa.string()), len(lines)), "phrase": lines, "copies": numbers})


def _text_counter(bits, longest: int, ranges: int):
    def counted(block: _Block) -> Iterator[pa.Table]:
        totals = np.bincount(block.lang[block.own], block.copies[block.own], len(block.langs)).astype(np.int64)
        yield _counted(block.langs, np.arange(len(totals)), pa.array([""] * len(totals), pa.string()), totals)
        if not len(block.start):
            return
        pair = passes(bits.value, block.pair_keys) & block.goes_on
        chosen = block.own & passes(bits.value, block.word_keys)
        for words in range(1, longest + 1):
            at = np.flatnonzero(chosen)
            phrases = sliced(block.data, block.start[at], block.end[at + words - 1]).dictionary_encode()
            size = max(len(phrases.dictionary), 1)
            keys, copies = _summed(block.lang[at].astype(np.int64) * size + phrases.indices.to_numpy(), block.copies[at])
            yield _counted(block.langs, keys // size, phrases.dictionary.take(pa.array(keys % size)), copies)
            # A phrase of one word more: the last word so far and the next make a frequent pair.
            reach = np.zeros(len(pair), bool)
            reach[: len(pair) - words + 1] = pair[words - 1 :]
            chosen = (block.own if words == 1 else chosen) & reach

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for block in _blocks(batches):
            held.extend(counted(block))
            if sum(len(table) for table in held) >= HELD:
                held = [_by_phrase(held)]
                if len(held[0]) >= HELD // 2:
                    yield packed_phrases(held[0], ranges)
                    held = []
        if held:
            yield packed_phrases(_by_phrase(held), ranges)

    return count


def _counted(langs: pa.Array, lang: np.ndarray, phrases: pa.Array, copies: np.ndarray) -> pa.Table:
    return pa.table({"lang": langs.take(pa.array(lang, pa.int64())), "phrase": phrases.cast(pa.large_string()), "copies": pa.array(copies, pa.int64())})


def _phrase_summer(least: int):
    """Sums of one range after the other; no phrase at all stands for a language's words."""

    def frequent(held: list[pa.Table]) -> pa.RecordBatch:
        table = _by_phrase(held)
        table = table.filter(pc.or_(pc.greater_equal(table["copies"], least), pc.equal(table["phrase"], ""))).combine_chunks()
        words = pc.if_else(pc.equal(table["phrase"], ""), 0, pc.add(pc.count_substring(table["phrase"], " "), 1))
        columns = [table["lang"], words.cast(pa.int32()), table["phrase"].cast(pa.string()), table["copies"]]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "count"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, size, most = [], None, 0, 2 * HELD
        for batch in batches:
            for part, *row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if part != at and held:
                    yield frequent(held)
                    held, size, most = [], 0, 2 * HELD
                held.append(unpacked_phrases(*row))
                at, size = part, size + len(held[-1])
                if size >= most:
                    held = [_by_phrase(held)]
                    size = len(held[0])
                    most = max(most, 2 * size)
        if held:
            yield frequent(held)

    return add


# ---------------------------------------------------------------- ranking


def ranked(counts: DataFrame, longest: int, least: int, share: int, top: int) -> DataFrame:
    known = counts.where(F.col("words") > 0).select("lang", "phrase", "count")
    phrases = counts.where((F.col("words") > 1) & (F.col("count") >= least)).select(
        "lang", "phrase", "words", F.split("phrase", " ").alias("word"), F.col("count").alias("a")
    )

    def part(begin, length):
        return F.array_join(F.slice("word", begin, length), " ")

    k = F.col("k")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), k).alias("__first"), part(k + 1, F.col("words") - k).alias("__rest"))
    for name, side in (("l", "__first"), ("r", "__rest")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("count").alias(name)), ["lang", side])
    big = {c: F.col(c).cast("decimal(14,0)") for c in "alr"}
    cuts = cuts.withColumns({"__top": F.lit(1000000).cast("decimal(7,0)") * big["a"] * big["a"], "__under": big["l"] * big["r"]})
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("__top div __under").alias("score"), "k", "l", "r")).alias("cut"))
    spots = F.explode(
        F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda b: part(b, n))))
    )
    inside = phrases.where(F.col("words") > 2).select("lang", spots.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("__longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(F.col("__longer").isNull() | (100 * F.col("__longer") < share * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: it is cut to ``top`` in parts first.
    for keys in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where(F.col("words") == 0).select("lang", F.col("count").alias("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
