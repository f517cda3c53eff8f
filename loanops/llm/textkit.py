"""Words, hashes and sums over Arrow batches of texts, vectorised with numpy, and small Spark helpers.

A batch of texts is one byte array plus offsets. Words are maximal runs of bytes other than 0x20 and 0x09-0x0D,
which is the same as runs of such characters, because UTF-8 uses these bytes for nothing else. A null text has no
bytes. Work goes chunk by chunk, about ``CHUNK`` bytes of whole texts at a time, so memory does not follow
the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanops.session import checkpoint_folder

CHUNK = 1 << 18
BATCH_ROWS = 1000

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_BYTES = np.ones(256, np.uint8)
WORD_BYTES[list(SPACES)] = 0
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


class Texts(NamedTuple):
    """Some whole texts: their bytes, and the n + 1 offsets at which they begin and end."""

    data: np.ndarray
    offsets: np.ndarray
    first: int  # row in the batch


class Spans(NamedTuple):
    """Runs of bytes, in order; ``counts`` has their number for each text."""

    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix); changes nothing in place."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x % (1 << 64)], np.uint64))[0])


def chunks_of(column: pa.Array, limit: int = CHUNK) -> Iterator[Texts]:
    """The texts of a column in chunks of whole texts of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        until = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        until = min(max(until, row + 1), len(column))
        at = offsets[row : until + 1]
        yield Texts(data[at[0] : at[-1]], at - at[0], row)
        row = until


def spans(texts: Texts, classes: np.ndarray = WORD_BYTES) -> Spans:
    """Maximal runs of bytes of one class within a text, without class 0."""
    data, offsets = texts.data, texts.offsets
    if not len(data):
        none = np.zeros(0, np.int64)
        return Spans(none, none, np.zeros(len(offsets) - 1, np.int64))
    kind = classes[data]
    change = np.empty(len(data), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(data))
    keep = kind[start] != 0
    start, end = start[keep], end[keep]
    return Spans(start, end, np.diff(np.searchsorted(start, offsets)))


def _powers(size: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        size = max(size, CHUNK + 4096)
        rows = []
        for base in (_BASE, _BASE_INVERSE):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            rows.append(np.cumprod(row, dtype=np.uint64))
        _POWERS[:] = rows
    return _POWERS


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; ``start`` ascends. Equal bytes have equal hashes."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        until = int(np.searchsorted(start, base + CHUNK))
        own_start, own_end = start[at:until] - base, end[at:until] - base
        size = int(own_end.max())
        power, inverse = _powers(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * power[:size], out=sums[1:])
        out[at:until] = (sums[own_end] - sums[own_start]) * inverse[own_start]
        at = until
    return mix(out ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def sums_by(counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each text, of which ``counts`` has the number of values."""
    out = np.zeros(len(counts), values.dtype if values.dtype.kind == "f" else np.int64)
    full = counts > 0
    if len(values):
        begin = np.cumsum(counts) - counts
        out[full] = np.add.reduceat(values, begin[full], dtype=out.dtype)
    return out


def owners(counts: np.ndarray) -> np.ndarray:
    """The text of each span."""
    return np.repeat(np.arange(len(counts)), counts)


def grams(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a text, and their number for each text.

    A text with fewer words than ``width``, but at least one, has one run: all its words.
    """
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    salts = mix(np.arange(1, width + 1, dtype=np.uint64))
    padded = np.concatenate([hashes, np.zeros(width - 1, np.uint64)])
    begin = np.cumsum(counts) - counts
    numbers = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    at = np.repeat(begin - (np.cumsum(numbers) - numbers), numbers) + np.arange(numbers.sum())
    total = np.zeros(len(at), np.uint64)
    room = np.repeat(np.minimum(counts, width), numbers)
    for k in range(width):
        part = padded[at + k] * salts[k] + salts[k]
        total += np.where(room > k, part, np.uint64(0)) if (counts < width).any() else part
    return mix(total), numbers


def arrow_sized(spark: SparkSession) -> SparkSession:
    """Bound the rows that Python workers get at once; texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def settled(frame: DataFrame) -> DataFrame:
    """``frame`` computed once, in the folder that all executors share (a reliable checkpoint)."""
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint()


def fold(column, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % parts


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``frame`` has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
