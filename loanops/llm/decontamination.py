"""Benchmark decontamination: every passage of the corpus searches a BM25 index of the test items with block-max WAND.

* Index: the words of the test items (in lower case; ASCII punctuation separates), with postings that hold each item's BM25 impact as a
  share of the score that the item's own text would get, and for blocks of ``ITEMS_IN_BLOCK`` items the largest impact of each word.
* Passages: windows of two neighbouring segments; a segment has as many words as the longest item, so an item that is
  copied anywhere lies whole inside a window.
* Search, a chunk of documents at a time: a window's words are put in the order of their upper bounds; an item above the threshold must
  hold a word at or behind the pivot, where the sum of bounds reaches it, so only the blocks in the postings of those words are candidates. Blocks
  whose block maxima sum to less than the threshold are skipped, the items of the others are scored exactly. Nothing above ``THRESHOLD`` is missed.
* Verification: an item's answer is its last sentence, or its last quarter if it has one sentence, and the rest is its question. At least
  ``OVERLAP`` of the word triples of both must be in the passage.

Test items are indexed in portions of at most about ``PORTION_ITEMS`` items and ``PORTION_BYTES`` bytes (by hash, from their counted
size); a portion's index is built on the driver and broadcast, and each portion is one pass over the documents, so
memory is bounded whatever the size of the benchmark.

* Short items, of fewer than ``LEAST_WORDS`` words, are found by their whole word sequence only (score and overlaps 1), because prose holds their words by
  chance; an item of one word is in every document with that word. In scripts without spaces every character is a word.

Defined cases: null, empty or wordless documents have no passage and are kept; items without words are not searched for. Items with equal texts are each found. Repeated documents are judged each; an empty benchmark or
corpus has no hits. Other columns pass through.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Texts, arrow_sized, chunks_of, grams, span_hashes, spans
from .toxicity import PLAIN_WORDS

THRESHOLD = 0.6
OVERLAP = 0.5
LEAST_WORDS = 8
K1, B = 1.2, 0.75
ITEMS_IN_BLOCK = 8
PORTION_ITEMS = 20_000
PORTION_BYTES = 8 << 20
TRIPLE = 3
MARK_BITS = 20
MOST_DENSE = 1 << 22
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\x{3000}-\x{303F}\x{FF01}-\x{FF20}])"


class Index(NamedTuple):
    """Words are numbered by ascending upper bound; items of a block have neighbouring numbers."""

    ids: list
    segment: int
    words: np.ndarray  # sorted hashes
    number: np.ndarray  # of each sorted hash
    mark: np.ndarray  # by the top bits of a hash: whether any word has them
    bound: np.ndarray
    first_block: np.ndarray  # postings of word t are blocks[first_block[t] : first_block[t + 1]]
    blocks: np.ndarray
    block_keys: np.ndarray  # word * number of blocks + block, sorted; none for a dense table
    block_max: np.ndarray
    item_keys: np.ndarray  # word * number of items + item, sorted; none for a dense table
    impact: np.ndarray
    question: list[np.ndarray]  # triples of each item
    answer: list[np.ndarray]
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by words: sorted hashes of the sequences, and which of short_ids
    short_ids: list


def item_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    words = spans(texts, PLAIN_WORDS)
    return span_hashes(texts.data, words.start, words.end), words.counts


def lowered(column: pa.Array):
    """Chunks of the texts in lower case, characters of scripts without spaces apart."""
    return chunks_of(_apart(pc.utf8_lower(column.cast(pa.large_string()))))


def _apart(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, UNSPACED, r" \1 ")


def _hashes(texts: list[str]) -> list[np.ndarray]:
    out = []
    for part in lowered(pa.array(texts, pa.string())):
        hashes, counts = item_words(part)
        out += np.split(hashes, np.cumsum(counts)[:-1])
    return out


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): the last sentence is the answer, or the last quarter of the words of a single sentence."""
    cuts = [m.end() for m in re.finditer(r"[.?!:。？！](?=\s)|\n", text) if re.search(r"\w", text[m.end() :])]
    for cut in reversed(cuts):
        if len(re.findall(r"\w+", text[cut:])) >= TRIPLE and len(re.findall(r"\w+", text[:cut])) >= TRIPLE:
            return text[:cut], text[cut:]
    words = list(re.finditer(r"\S+", text))
    cut = words[-max(TRIPLE, len(words) // 4)].start() if len(words) > TRIPLE else len(text)
    return text[:cut], text[cut:]


def _triples(words: np.ndarray) -> np.ndarray:
    return np.unique(grams(words, np.array([len(words)]), TRIPLE)[0])


def _short_items(hashed: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    out = {}
    for size in sorted({len(h) for h in hashed}):
        own = np.array([i for i, h in enumerate(hashed) if len(h) == size])
        keys = np.concatenate([grams(hashed[i], np.array([size]), size)[0] for i in own])
        order = np.argsort(keys, kind="stable")
        out[size] = keys[order], own[order]
    return out


def build_index(items: list[tuple]) -> Index | None:
    """Index of (id, text) items; None if no item has a word."""
    hashed = _hashes([t or "" for _, t in items])
    keep = [i for i, h in enumerate(hashed) if len(h) >= LEAST_WORDS]
    brief = [i for i, h in enumerate(hashed) if 0 < len(h) < LEAST_WORDS]
    short, short_ids = _short_items([hashed[i] for i in brief]), [items[i][0] for i in brief]
    if not keep:
        none, marks = np.zeros(0, np.int64), np.zeros(1 << MARK_BITS, bool)
        words, bound, first = np.zeros(0, np.uint64), np.zeros(0), np.zeros(1, np.int64)
        return Index([], max(short), words, none, marks, bound, first, none, none, bound, none, bound, [], [], short, short_ids) if short else None
    hashed = [hashed[i] for i in keep]
    lengths = np.array([len(h) for h in hashed])
    words, where = np.unique(np.concatenate(hashed), return_inverse=True)
    pairs, times = np.unique(where * len(keep) + np.repeat(np.arange(len(keep)), lengths), return_counts=True)
    word, item = pairs // len(keep), pairs % len(keep)
    held = np.bincount(word, minlength=len(words))
    rarity = np.log1p((len(keep) - held + 0.5) / (held + 0.5))
    norm = K1 * (1 - B + B * lengths / lengths.mean())
    impact = rarity[word] * times * (K1 + 1) / (times + norm[item])
    impact = impact / np.bincount(item, impact, minlength=len(keep))[item]
    bound = np.zeros(len(words))
    np.maximum.at(bound, word, impact)
    order = np.argsort(bound, kind="stable")
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words))
    word = number[word]
    n_blocks = -(-len(keep) // ITEMS_IN_BLOCK)
    item_keys = word * len(keep) + item
    by_item = np.argsort(item_keys)
    block_keys, inverse = np.unique(word * n_blocks + item // ITEMS_IN_BLOCK, return_inverse=True)
    block_max = np.zeros(len(block_keys))
    np.maximum.at(block_max, inverse, impact)
    mark = np.zeros(1 << MARK_BITS, bool)
    mark[words >> np.uint64(64 - MARK_BITS)] = True
    split = [split_item(t) for t in _apart(pa.array([items[i][1] for i in keep], pa.large_string())).to_pylist()]
    first_block = np.searchsorted(block_keys, np.arange(len(words) + 1) * n_blocks)
    blocks = block_keys % n_blocks
    block_keys, block_max = _table(block_keys, block_max, len(words) * n_blocks)
    item_keys, impact = _table(item_keys[by_item], impact[by_item], len(words) * len(keep))
    return Index(
        ids=[items[i][0] for i in keep],
        segment=int(lengths.max()),
        words=words,
        number=number,
        mark=mark,
        bound=bound[order],
        first_block=first_block,
        blocks=blocks,
        block_keys=block_keys,
        block_max=block_max,
        item_keys=item_keys,
        impact=impact,
        question=[_triples(h) for h in _hashes([q for q, _ in split])],
        answer=[_triples(h) for h in _hashes([a for _, a in split])],
        short=short,
        short_ids=short_ids,
    )


def _table(keys: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The same lookup as a dense table where that is small."""
    if size > MOST_DENSE:
        return keys, values
    dense = np.zeros(size)
    dense[keys] = values
    return np.zeros(0, np.int64), dense


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and position for ``count`` positions from ``first`` on of each row."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value at each wanted key, else 0; without keys the values are a dense table."""
    if not len(keys):
        return values[wanted]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def _sum_rows(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(count) - count) if len(count) else np.zeros(0)


def search(index: Index, window: np.ndarray, word: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, item, score) of all with a score of at least ``threshold``, from the sorted distinct (window, word) pairs."""
    none = np.zeros(0, np.int64)
    if not len(window):
        return none, none, np.zeros(0)
    n_items = len(index.ids)
    n_blocks = -(-n_items // ITEMS_IN_BLOCK)
    new = np.flatnonzero(np.append(True, window[1:] != window[:-1]))
    size = np.diff(np.append(new, len(window)))
    sums = np.cumsum(index.bound[word])
    below = np.repeat(np.append(0.0, sums)[new], size)
    # the sums carry rounding errors; a little slack keeps every true hit
    pivoted = np.flatnonzero(sums - below >= threshold - 1e-6)
    local = np.repeat(np.arange(len(new)), size)
    row, at = _spread(index.first_block[word[pivoted]], np.diff(index.first_block)[word[pivoted]])
    candidates = np.unique(local[pivoted][row] * n_blocks + index.blocks[at])
    own, block = candidates // n_blocks, candidates % n_blocks
    row, at = _spread(new[own], size[own])
    best = _sum_rows(_lookup(index.block_keys, index.block_max, word[at] * n_blocks + block[row]), size[own])
    own, block = own[best >= threshold - 1e-6], block[best >= threshold - 1e-6]
    first = block * ITEMS_IN_BLOCK
    row, item = _spread(first, np.minimum(n_items, first + ITEMS_IN_BLOCK) - first)
    own = own[row]
    row, at = _spread(new[own], size[own])
    score = _sum_rows(_lookup(index.item_keys, index.impact, word[at] * n_items + item[row]), size[own])
    hit = score >= threshold
    return window[new][own[hit]], item[hit], score[hit]


def _short_hits(index: Index, hashes: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, float, float, float]]:
    """As ``contaminated``, of the short items, which are numbered behind the others."""
    out = []
    for size, (keys, items) in index.short.items():
        whole = np.where(counts >= size, counts - size + 1, 0)
        own, numbers = grams(hashes, counts, size)
        own = own[np.repeat(counts >= size, numbers)]
        first = np.searchsorted(keys, own)
        times = np.searchsorted(keys, own, "right") - first
        at = np.flatnonzero(times)
        row, place = _spread(first[at], times[at])
        text, word = np.repeat(np.arange(len(counts)), whole)[at], (np.arange(len(own)) - np.repeat(np.cumsum(whole) - whole, whole))[at]
        item = items[place]
        _, once = np.unique(text[row] * len(index.short_ids) + item, return_index=True)
        start = word // index.segment * index.segment
        out += [(int(text[row[k]]), len(index.ids) + int(item[k]), int(start[row[k]]), 1.0, 1.0, 1.0) for k in once]
    return out


def contaminated(index: Index, texts: Texts) -> list[tuple[int, int, int, float, float, float]]:
    """(text, item, first word of the passage, score, question overlap, answer overlap): the best passage for each text and item."""
    hashes, counts = item_words(texts)
    if not len(hashes):
        return []
    begin = np.cumsum(counts) - counts
    segments = -(-counts // index.segment)
    base = np.cumsum(segments) - segments
    known = np.flatnonzero(index.mark[hashes >> np.uint64(64 - MARK_BITS)])
    at = np.minimum(np.searchsorted(index.words, hashes[known]), len(index.words) - 1)
    same = index.words[at] == hashes[known]
    known, word = known[same], index.number[at[same]]
    owner = np.searchsorted(begin + counts, known, "right")
    segment = (known - begin[owner]) // index.segment
    own = base[owner] + segment
    before = segment > 0
    vocabulary = len(index.words)
    pairs = np.unique(np.concatenate([own * vocabulary + word, (own[before] - 1) * vocabulary + word[before]]))
    found = []
    for window, item, score in zip(*search(index, pairs // vocabulary, pairs % vocabulary), strict=True):
        text = int(np.searchsorted(base + segments, window, "right"))
        start = int(window - base[text]) * index.segment
        passage = hashes[begin[text] + start : begin[text] + min(int(counts[text]), start + 2 * index.segment)]
        triples = _triples(passage)
        share = [float(np.isin(part, triples).mean()) if len(part) else 1.0 for part in (index.question[item], index.answer[item])]
        if min(share) >= OVERLAP:
            found.append((text, int(item), start, float(score), *share))
    best = {}
    for hit in found:
        if hit[:2] not in best or (hit[4] + hit[5], hit[3]) > (best[hit[:2]][4] + best[hit[:2]][5], best[hit[:2]][3]):
            best[hit[:2]] = hit
    return sorted([*best.values(), *_short_hits(index, hashes, counts)])


def indexes(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text"):
    """The indexes of the portions of the benchmark, one after the other."""
    own = benchmark.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).where(F.col("text").isNotNull())
    size = own.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    portions = max(1, -(-size["n"] // PORTION_ITEMS), -(-size["bytes"] // PORTION_BYTES))
    turn = F.pmod(F.xxhash64("id", "text"), F.lit(portions))
    for k in range(portions):
        rows = own.where(turn == k).orderBy("id", "text").collect()
        index = build_index([(r["id"], r["text"]) for r in rows])
        if index is not None:
            yield index


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
                   item_text_column: str = "text") -> DataFrame:
    """(id, item, passage_start, score, question_overlap, answer_overlap): one row for each document and test item that it holds."""
    spark = arrow_sized(docs.sparkSession)
    own = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    kinds = own.schema["id"].dataType.simpleString(), benchmark.schema[item_column].dataType.simpleString()
    schema = f"id {kinds[0]}, item {kinds[1]}, passage_start long, score double, question_overlap double, answer_overlap double"
    found = None
    for index in indexes(benchmark, item_column, item_text_column):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            index = sent.value
            named = index.ids + index.short_ids
            for batch in batches:
                hits = [(texts.first + h[0], *h[1:]) for texts in lowered(batch.column(1)) for h in contaminated(index, texts)]
                if hits:
                    at, item, *rest = zip(*hits, strict=True)
                    ids = batch.column(0).take(pa.array(at))
                    items = pa.array([named[i] for i in item])
                    yield pa.RecordBatch.from_arrays(
                        [ids, items, *(pa.array(v) for v in rest)],
                        ["id", "item", "passage_start", "score", "question_overlap", "answer_overlap"],
                    )

        hits = own.mapInArrow(run, schema)
        found = hits if found is None else found.union(hits)
    return spark.createDataFrame([], schema) if found is None else found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
                      item_text_column: str = "text") -> DataFrame:
    """The documents that hold no test item; one pass, whatever the number of portions."""
    spark = arrow_sized(docs.sparkSession)
    at = docs.columns.index(text_column)
    for index in indexes(benchmark, item_column, item_text_column):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for texts in lowered(batch.column(at)):
                    clean[[texts.first + h[0] for h in contaminated(sent.value, texts)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
