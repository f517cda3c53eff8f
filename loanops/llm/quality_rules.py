"""Quality rules: counts over words and lines, and compression bands.

Bands: the zstandard ratio (compressed / raw bytes) of the whole text, and of fixed chunks of it, must lie between limits that
depend on the length: low ratios are repetitive text, high ones random or encoded bytes. A text is rejected if its
own ratio is outside its band, or if chunks outside theirs hold at least ``CHUNK_SHARE`` of the chunked bytes. Codes of 4 bits a byte (hex
digits: 0.51 to 0.67) compress like prose, so no limit on the ratio can tell them.

Defined cases: a null or empty text has no words, ratio null and fails the base rules. Texts below the first band's length have no ratio
limits, because a ratio says little there; a last chunk below ``LEAST_CHUNK`` bytes is not judged. Repeated rows are judged
each; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Spans, Texts, arrow_sized, chunks_of, grams, mix, owners, span_hashes, spans, sums_by

LEVEL = 3
CHUNK_BYTES = 4096
LEAST_CHUNK = 1024
CHUNK_SHARE = 0.25
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent


class Band(NamedTuple):
    from_bytes: int
    low: float
    high: float


# Whole texts from this many bytes on; prose gets lower ratios the longer it is. The upper limits lie between the largest ratios of dense ordinary
# text (0.925 at 200 bytes, 0.80 at 400, 0.68 at 1,000, 0.62 at 2,000, 0.49 at 10,000) and the least of base64 in lines (0.93, 0.87, 0.80, 0.77, 0.75).
BANDS = (
    Band(200, 0.33, 0.925), Band(210, 0.33, 0.905), Band(250, 0.33, 0.88), Band(300, 0.33, 0.85), Band(400, 0.33, 0.81), Band(500, 0.28, 0.77), Band(700, 0.28, 0.74),
    Band(1000, 0.28, 0.70), Band(2000, 0.22, 0.65), Band(10000, 0.18, 0.60),
)
CHUNK_BANDS = (Band(LEAST_CHUNK, 0.20, 0.70), Band(2000, 0.20, 0.65))

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LINE_BYTES = np.ones(256, np.uint8)
LINE_BYTES[0x0A] = 0


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeats_in_text(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash: whether its text has it twice or more, and whether it is there an earlier time."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, bool)
    keyed = hashes + mix(owners(counts).astype(np.uint64))
    order = np.argsort(keyed, kind="stable")
    ranked = keyed[order]
    same = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keyed), bool), np.zeros(len(keyed), bool)
    twice[order[1:]], later[order[1:]] = same, same
    twice[order[:-1]] |= same
    return twice, later


def repeated_words(words: Spans, hashes: np.ndarray) -> np.ndarray:
    """Words inside windows of ``WINDOW`` words that the text has twice or more."""
    whole = np.where(words.counts >= WINDOW, words.counts - WINDOW + 1, 0)
    keys, numbers = grams(hashes, words.counts, WINDOW)
    keys = keys[np.repeat(words.counts >= WINDOW, numbers)]
    twice, _ = repeats_in_text(keys, whole)
    begin = np.cumsum(words.counts) - words.counts
    at = (np.repeat(begin - (np.cumsum(whole) - whole), whole) + np.arange(len(keys)))[twice]
    change = np.zeros(len(hashes) + 1, np.int64)
    change[at] += 1  # windows begin at different words
    np.subtract.at(change, at + WINDOW, 1)
    return sums_by(words.counts, (np.cumsum(change)[:-1] > 0).astype(np.int64))


def repeated_lines(texts: Texts, words: Spans) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    lines = spans(texts, LINE_BYTES)
    hashes = span_hashes(texts.data, lines.start, lines.end)
    full = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    _, later = repeats_in_text(hashes, lines.counts)
    return sums_by(lines.counts, (later & full).astype(np.int64))


def counted(texts: Texts) -> dict[str, np.ndarray]:
    words = spans(texts)
    hashes = span_hashes(texts.data, words.start, words.end)
    spaces = np.zeros(256, bool)
    spaces[[0x20, 9, 10, 11, 12, 13]] = True
    in_words = ~spaces[texts.data] & ((texts.data & 0xC0) != 0x80)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": _per_text(in_words, texts.offsets),
        "n_symbols": _per_text(SYMBOLS[texts.data], texts.offsets),
        "n_dup_lines": repeated_lines(texts, words),
        "n_repeat_words": repeated_words(words, hashes),
    }


def fits(bands: tuple[Band, ...], size: int, ratio: float) -> bool:
    """Whether the ratio is inside the last band that begins at ``size`` bytes or fewer, if any does."""
    band = next((b for b in reversed(bands) if size >= b.from_bytes), None)
    return band is None or band.low <= ratio <= band.high


def compression(raw: bytes, press: zstandard.ZstdCompressor) -> tuple[float | None, float | None, bool]:
    """(ratio of the whole, share of judged chunk bytes outside the band, verdict)."""
    if not raw:
        return None, None, False
    ratio = len(press.compress(raw)) / len(raw)
    judged = outside = 0
    for at in range(0, len(raw), CHUNK_BYTES):
        part = raw[at : at + CHUNK_BYTES]
        if len(part) >= LEAST_CHUNK:
            judged += len(part)
            own = len(press.compress(part)) / len(part)
            outside += len(part) * (not fits(CHUNK_BANDS, len(part), own))
    share = outside / judged if judged else None
    return ratio, share, fits(BANDS, len(raw), ratio) and (share is None or share < CHUNK_SHARE)


def judge_quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, counts, base_failed, zstd_ratio, bad_chunk_share, kept): one row for each document."""
    arrow_sized(docs.sparkSession)

    def run(batches):
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, packed = [], []
            for texts in chunks_of(batch.column(1)):
                parts.append(counted(texts))
                view = texts.data.tobytes()
                packed += [compression(view[a:b], press) for a, b in zip(texts.offsets, texts.offsets[1:])]
            columns = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            failed = (columns["n_words"] < LEAST_WORDS) | (100 * columns["n_repeat_words"] > MOST_REPEATED * columns["n_words"])
            fits = np.array([p[2] for p in packed])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(v) for v in columns.values()),
                    pa.array(failed),
                    pa.array([p[0] for p in packed], pa.float64()),
                    pa.array([p[1] for p in packed], pa.float64()),
                    pa.array(fits & ~failed),
                ],
                ["id", *columns, "base_failed", "zstd_ratio", "bad_chunk_share", "kept"],
            )

    own = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return own.mapInArrow(run, f"id {kind}, {counts}, base_failed boolean, zstd_ratio double, bad_chunk_share double, kept boolean")
