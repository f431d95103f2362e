"""Periodic runs of words, caught as squares over power-of-two blocks.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends, at least ``THRICE`` periods and ``LEAST`` words long.

For every level B = 8, 16, 32, ... each completed block of B words sets a
catcher. As words are appended, the suffix of the last B words is compared with
the catchers whose block began B to 2 B - 1 words before it (at the first
level 1 to 15): if they are equal at distance p, the words between make a
square of period p. A run of at least three periods holds such a block and its
repetition, whatever the block's place, so none is missed. Squares of one
period from neighbouring blocks merge, and comparisons of 2^k suffixes, k
falling, carry both ends to where the run stops. A stretch found with several
periods keeps the smallest: by Fine and Wilf's theorem the others are its multiples.

The words of all texts of a block of the column are appended together: one
comparison of an array does what each appended word does with its catchers.
Texts are kept apart by words that occur nowhere else, and lie in falling order
of length, so a level looks only at texts that are long enough for it. A text
of n words costs some log n passes of numpy over its words; nothing is
shuffled. Memory is that of one block of texts (``kernel.BLOCK`` bytes, or the
longest text, if that is longer), 8 bytes a word and level. Suffixes are
compared by 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.llm import kernel

LEAST = 24
THRICE = 3
#: The first level's block; runs of LEAST words hold two of them at any distance below twice its size.
FIRST = 8

_MUL = np.uint64(0xD6E8FEB86659FD93)
_ADD = np.uint64(0x9E3779B97F4A7C15)


def _double(h: np.ndarray, size: int) -> np.ndarray:
    """Numbers of suffixes of twice ``size`` words from those of ``size`` words."""
    return kernel.mix(h[:-size] * _MUL + h[size:] + _ADD)


def _caught(h: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number and period of each square that the catchers of one level report."""
    if block == FIRST:
        ks, ps = [], []
        for p in range(1, 2 * block):
            later = h[p::block]
            k = np.flatnonzero(h[::block][: len(later)] == later)
            ks.append(k)
            ps.append(np.full(len(k), p))
        return np.concatenate(ks), np.concatenate(ps)
    rows = -(-len(h) // block)
    grid = np.zeros(rows * block, dtype=np.uint64)
    grid[: len(h)] = h
    grid = grid.reshape(rows, block)
    at = np.flatnonzero((grid[1:] == grid[:-1, :1]).ravel())
    return at // block, block + at % block


def _merged(k: np.ndarray, p: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and period of the squares of one period in neighbouring blocks, as one stretch of first halves."""
    width = k.max() + 2
    key = np.sort(p * width + k)
    cut = np.flatnonzero(np.diff(key) != 1)
    first, last = key[np.concatenate([[0], cut + 1])], key[np.concatenate([cut, [len(key) - 1]])]
    return first % width * block, last % width * block + block, first // width


def squares(x: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Start, end and period of the merged squares of each level.

    x: the words of texts in falling order of ``length``, a word of its own after each.
    """
    ends = np.cumsum(length + 1)
    suffixes = [x]
    block = 1
    while True:
        long = int(np.searchsorted(-length, -max(LEAST, THRICE * block), side="right"))
        n = int(ends[long - 1]) if long else 0
        if n == 0:
            return
        if block >= FIRST:
            k, p = _caught(suffixes[-1][: n - block + 1], block)
            if len(k):
                lo, hi, p = _merged(k, p, block)
                for level in range(len(suffixes) - 2, -1, -1):
                    step, h = 1 << level, suffixes[level]
                    on = hi + p + step <= n
                    on[on] = h[hi[on]] == h[hi[on] + p[on]]
                    hi = hi + step * on
                    on = lo >= step
                    on[on] = h[lo[on] - step] == h[lo[on] - step + p[on]]
                    lo = lo - step * on
                keep = hi + p - lo >= np.maximum(LEAST, THRICE * p)
                yield lo[keep], hi[keep] + p[keep], p[keep]
        suffixes.append(_double(suffixes[-1][:n], block))
        block *= 2


def runs_of(number: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (in it), length and period of all runs, by text, start and period.

    number: numbers of the words of several texts; begin: where each text's words begin, and their end.
    """
    length = np.diff(begin)
    order = np.argsort(-length, kind="stable")
    length = length[order]
    places = np.concatenate([[0], np.cumsum(length + 1)])
    text = np.repeat(np.arange(len(length)), length + 1)
    inner = np.arange(places[-1]) - places[text]
    word = inner < length[text]
    x = kernel.mix(text.astype(np.uint64) + np.uint64(1 << 40))
    x[word] = number[begin[order][text[word]] + inner[word]]
    found = list(squares(x, length))
    start, end, period = (np.concatenate([np.empty(0, dtype=np.int64), *[f[i] for f in found]]).astype(np.int64) for i in range(3))
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    at = np.searchsorted(places, start, side="right") - 1
    owner, start, size = order[at], start - places[at], end - start
    by = np.lexsort((period, start, owner))
    return owner[by], start[by], size[by], period[by]


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All runs of each text, and the text without their repetitions.

    Returns one row for each row of ``docs``: the id column, ``runs`` (start,
    length and period in words, by start, then period) and ``text``: the words
    joined by one space, without those that any run contains after its first
    period. Other columns of ``docs`` are not read.

    Words are unchanged runs of characters other than space and U+0009 to
    U+000D. Null and empty texts have no words, no runs and an empty text.
    Ids are passed on as they are, null and repeated ones too; an empty table
    gives an empty result. Very long texts are processed whole, in n log n time.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = kernel.text_bytes(batch.column("text"))
            for lo, hi in kernel.blocks(at):
                part = raw[at[lo] : at[hi]]
                number, first, end, begin = kernel.words(part, at[lo : hi + 1] - at[lo], fold=False)
                owner, start, size, period = runs_of(number, begin)
                step = np.zeros(len(number) + 1, dtype=np.int64)
                np.add.at(step, begin[owner] + start + period, 1)
                np.add.at(step, begin[owner] + start + size, -1)
                kept = np.cumsum(step[:-1]) == 0
                # what stays, in one pass over the bytes: each kept word, and a space unless it is its text's last one
                which = np.flatnonzero(kept)
                count = np.concatenate([[0], np.cumsum(kept)])[begin]
                lasts = np.zeros(len(which), dtype=bool)
                lasts[count[1:][np.diff(count) > 0] - 1] = True
                width = end[which] - first[which] + ~lasts
                place = np.concatenate([[0], np.cumsum(width)])
                if len(which):
                    source = np.repeat(first[which] - place[:-1], width) + np.arange(place[-1])
                    out = part[np.minimum(source, len(part) - 1)]
                    out[place[1:][~lasts] - 1] = 0x20
                else:
                    out = part[:0]
                texts = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(place[count].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out)))
                values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, size, period)], names=["start", "length", "period"])
                offsets = pa.array(np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.record_batch([batch.column("id").slice(lo, hi - lo), pa.ListArray.from_arrays(offsets, values), texts.cast(pa.string())], names=["id", "runs", "text"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, runs {_RUNS}, text string").select(F.col("id").alias(id_col), "runs", F.col("text").alias(text_col))


def repeating(docs: DataFrame) -> DataFrame:
    """``documents`` (doc_id, text) with one in ten made periodic.

    With h = crc32 of the decimal id and g = floor(h / 10): if h is a multiple
    of ten, every word i >= a of the n words becomes word a + (i - a) % p, where
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Rows without an id stay.
    """
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(h / 10).cast("bigint")

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        # a one-element array binds each value once for all words
        shape = F.array(F.struct(a.alias("a"), p.alias("p")))
        every = F.sequence(F.lit(0).cast("bigint"), n - 1)
        moved = F.transform(shape, lambda s: F.transform(every, lambda i: words[F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int")]))
        return F.when(n > 0, F.array_join(moved[0], " ")).otherwise("")

    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    text = F.transform(F.array(words), repeat)[0]
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def digests(runs: DataFrame) -> DataFrame:
    """The longest run by length over period (ties: least start, then period) and digests of the result of ``periodic_runs``."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    best = F.aggregate("runs", none, better)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return runs.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
