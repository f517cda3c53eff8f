"""Runs of repeated word blocks, found with a suffix automaton whose root paths are recoloured by last occurrence.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least ``max(shortest, power * q)``
words long, that no neighbouring word extends. For every word of a text, in order, the path from the automaton's state of
the text so far to the root holds all its suffixes; the states of a path segment of one colour e last ended at word e. When
the next word recolours the path to its own number i, a segment of colour e whose longest suffix has l >= i - e words is a
square: the l words up to i repeat those up to e, so the stretch from e - l + 1 to i has period i - e. It is a run
if the word after it does not go on with the period; the l is the longest, so no word before it does either, and e is the last
occurrence, so no smaller period holds.

The recolouring is the access of a link-cut tree. All words of a text are known, so it works on the heavy paths of the finished
link tree with one stack of (deepest state, colour) for each path, O(log n) stacks an access, instead of splay trees.

Most words lie in no run. A run repeats each ``width`` of its words at most q words later, in places that follow one
another; ``stretches`` finds such places from word hashes for many texts at once, and only these words enter an automaton.
Equal words have equal hashes, so no run is missed; inside an automaton words are compared as bytes.

Texts: null and empty texts, or texts of white space, have no words and no runs. A row stays a row: equal rows and
null ids are judged one by one, no row depends on another, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import arrow_sized, chunks_of, mix, owners, span_hashes, spans

SHORTEST, POWER = 6, 4
RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shortest: int = SHORTEST, power: int = POWER) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` is sorted by start, then period. ``collapsed`` is the text's words joined by one space, without the words that a
    run contains after its first period.
    """
    if power < 2 or shortest < 1:
        raise ValueError((shortest, power))
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks_of(batch.column(1)):
                n = len(texts.offsets) - 1
                yield _judged(texts, batch.column(0).slice(texts.first, n), shortest, power)

    arrow_sized(docs.sparkSession)
    slim = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {id_type}, n_words bigint, runs {RUNS_TYPE}, collapsed string")


def _judged(texts, ids, shortest: int, power: int) -> pa.RecordBatch:
    start, end, counts = spans(texts)
    hashes = span_hashes(texts.data, start, end)
    owner = owners(counts)
    kept = np.ones(len(start), bool)
    found: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    begin = np.cumsum(counts) - counts
    for low, high in stretches(hashes, owner, shortest, power):
        numbers: dict[bytes, int] = {}
        words = [numbers.setdefault(texts.data[a:b].tobytes(), len(numbers)) for a, b in zip(start[low:high].tolist(), end[low:high].tolist())]
        text = owner[low]
        first = int(low - begin[text])
        for at, length, period in runs_of(words, shortest, power):
            found[text].append((first + at, length, period))
            kept[low + at + period : low + at + length] = False
    runs = [x for own in found for x in sorted(own, key=lambda r: (r[0], r[2]))]
    parts = [pa.array([r[k] for r in runs], pa.int64()) for k in range(3)]
    limits = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
    lists = pa.ListArray.from_arrays(limits, pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
    collapsed = joined_words(texts.data, start[kept], end[kept], np.bincount(owner[kept], minlength=len(counts)))
    return pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), lists, collapsed], ["id", "n_words", "runs", "collapsed"])


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, counts: np.ndarray) -> pa.Array:
    """For each text its words, joined by one space."""
    sizes = end - start + 1
    last = np.cumsum(counts)[counts > 0] - 1
    sizes[last] -= 1
    stop = np.cumsum(sizes)
    total = int(stop[-1]) if len(stop) else 0
    source = np.arange(total) + np.repeat(start - (stop - sizes), sizes)
    out = np.append(data, np.uint8(0x20))[source]
    gap = np.ones(len(start), bool)
    gap[last] = False
    out[stop[gap] - 1] = 0x20
    offsets = np.append(0, stop)[np.append(0, np.cumsum(counts))].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def stretches(hashes: np.ndarray, owner: np.ndarray, shortest: int = SHORTEST, power: int = POWER) -> list[tuple[int, int]]:
    """Disjoint stretches [low, high) of words, each within one text, such that every run lies inside one of them.

    In a run of period q the ``width`` words at each place but those of the first period occurred at most q words before, and
    those places, at least ``(power - 1) * q - width + 1``, follow one another. So a row of such places bounds q, and a place whose
    words last occurred further back than that is in no run; this is repeated until nothing changes. A stretch is a row
    of the places left, with the greatest possible period before it.
    """
    width = min(max(shortest, power * q) - q for q in range(1, shortest + 1))
    size = len(hashes)
    if size < shortest:
        return []
    total = np.zeros(size - width + 1, np.uint64)
    salts = mix(np.arange(1, width + 1, dtype=np.uint64))
    for k in range(width):
        total += hashes[k : size - width + 1 + k] * salts[k]
    at = np.flatnonzero(owner[: size - width + 1] == owner[width - 1 :])
    key = mix(total[at] ^ mix(owner[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]]) + 1
    place, back = at[order[again]], at[order[again]] - at[order[again - 1]]
    order = np.argsort(place)
    place, back = place[order], back[order]
    while len(place):
        edge = np.flatnonzero(np.diff(place) != 1) + 1
        rows = np.diff(np.concatenate([[0], edge, [len(place)]]))
        most = (rows + width - 1) // (power - 1)
        fits = back <= np.repeat(most, rows)
        if fits.all():
            break
        place, back = place[fits], back[fits]
    if not len(place):
        return []
    first = place[np.append(0, edge)]
    begin = np.searchsorted(owner, owner[first])
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, np.maximum(first - most, begin), 1)
    np.add.at(depth, first + rows - 1 + width, -1)
    inside = np.append(np.cumsum(depth)[:size] > 0, False)
    change = np.append(True, owner[1:] != owner[:-1])
    opens = np.flatnonzero(inside[:-1] & (change | ~np.append(False, inside[:-2])))
    shuts = np.flatnonzero(inside[:-1] & (~inside[1:] | np.append(change[1:], True))) + 1
    return list(zip(opens.tolist(), shuts.tolist()))


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(link, longest, state after each word); state 0 is the empty word and has link -1."""
    follow: list[dict[int, int]] = [{}]
    link, longest, states, last = [-1], [0], [], 0
    for word in words:
        new = len(link)
        follow.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        at = last
        while at != -1 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if at != -1:
            to = follow[at][word]
            if longest[to] != longest[at] + 1:
                split = len(link)
                follow.append(follow[to].copy())
                link.append(link[to])
                longest.append(longest[at] + 1)
                link[to] = split
                while at != -1 and follow[at].get(word) == to:
                    follow[at][word] = split
                    at = link[at]
                to = split
            link[new] = to
        states.append(new)
        last = new
    return link, longest, states


def heavy_paths(link: list[int], longest: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(top state of each state's path, place of each state, longest by place); places go down along each path."""
    size, heavy, weight = [1] * len(link), [-1] * len(link), [0] * len(link)
    order = np.argsort(np.array(longest), kind="stable").tolist()
    for state in reversed(order[1:]):
        up = link[state]
        size[up] += size[state]
        if size[state] > weight[up]:
            weight[up], heavy[up] = size[state], state
    top, place, depth = [0] * len(link), [0] * len(link), []
    for state in order:
        if state and heavy[link[state]] == state:
            continue
        at = state
        while at != -1:
            top[at], place[at] = state, len(depth)
            depth.append(longest[at])
            at = heavy[at]
    return top, place, depth


def runs_of(words: list[int], shortest: int = SHORTEST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in order of their ends."""
    link, longest, states = suffix_automaton(words)
    top, place, depth = heavy_paths(link, longest)
    stacks: dict[int, list[tuple[int, int]]] = {}
    found, size = [], len(words)
    for i, state in enumerate(states):
        below = -1
        while state != -1:
            path, here = top[state], place[state]
            stack = stacks.setdefault(path, [])
            first = stack[-1][1] if stack else below
            while stack:
                deepest, end = stack[-1]
                suffix = depth[min(deepest, here)]
                period = i - end
                # A colour that goes on from the path below has its longest suffix there.
                if end != below and suffix >= (power - 1) * period and suffix + period >= shortest:
                    if i + 1 == size or words[i + 1] != words[end + 1]:
                        found.append((end - suffix + 1, suffix + period, period))
                if deepest <= here:
                    stack.pop()
                if deepest >= here:
                    break
            stack.append((here, i))
            below = first
            state = link[path]
    return found
