"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and non-ASCII characters in lower case.

1. Count how often every n-gram of the test items occurs in the training texts.
2. Seeds: of every ``WINDOW`` neighbouring n-grams of an item, the rarest. So
   any unedited run of ``WINDOW + GRAM - 1`` words has a seed, however common
   the passage, while grams of common words alone are not used.
3. Every seed found in a text joins the passage around it to its item; a local
   alignment of the two scores the passage: 2 for an equal word, -1 for a
   changed, missing or added one, over twice the item's words. A passage counts
   if that share is large enough, or if the score is that of ``ENOUGH`` equal
   words, which chance does not give, however long the item.

Items go through in groups of at most ``ITEM_WORDS`` words, one pass over the
texts for each group, so what a task holds does not grow with the benchmark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeweave.llm import kernel
from cubeweave.llm.tables import save

GRAM = 3
WINDOW = 2
#: A passage that scores as many equal words counts in an item of any length.
ENOUGH = 13
#: Words of the items that one pass over the texts looks for.
ITEM_WORDS = 1_000_000
#: A longer item is looked for in pieces of so many words, and neighbouring pieces share the second number of them.
PIECE, SHARED = 2_000, 100


def _item_grams(items: DataFrame) -> DataFrame:
    """Every piece of an item (item, text) of at least GRAM words: words_id (digest of id, words and place), item, total (words of the item), place, gram, and at place 0 the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("item")
            for lo, _, _, number, _, _, begin in kernel.plain_words(batch.column("text")):
                for i in range(len(begin) - 1):
                    name, total = names[lo + i].as_py(), int(begin[i + 1] - begin[i])
                    for first in range(0, max(1, total - SHARED), PIECE - SHARED):
                        mine = number[begin[i] + first : min(begin[i] + first + PIECE, begin[i + 1])]
                        found = kernel.grams(mine, GRAM)
                        if not len(found):
                            continue
                        key = hashlib.blake2b(repr((name, first, total)).encode() + mine.tobytes(), digest_size=16).digest()
                        yield pa.record_batch(
                            [
                                pa.array([key] * len(found), pa.binary()),
                                pa.array([name] * len(found), batch.schema.field("item").type),
                                pa.array([total] * len(found), pa.int64()),
                                pa.array(np.arange(len(found)), pa.int64()),
                                pa.array(found, pa.int64()),
                                pa.array([mine.tobytes()] + [None] * (len(found) - 1), pa.binary()),
                            ],
                            names=["words_id", "item", "total", "place", "gram", "words"],
                        )

    return items.mapInArrow(run, f"words_id binary, item {items.schema['item'].dataType.simpleString()}, total bigint, place bigint, gram bigint, words binary")


def _counts(docs: DataFrame, grams: np.ndarray) -> DataFrame:
    """How often each of the sorted ``grams`` occurs in all texts: gram, n."""
    shared = docs.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        seen = np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            for _, _, _, number, _, _, begin in kernel.plain_words(batch.column("text")):
                seen += np.bincount(_find(known, number, begin)[1], minlength=len(known))
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(known[some], pa.int64()), pa.array(seen[some], pa.int64())], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _find(known: np.ndarray, number: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words at which a known gram begins, and which one; not across texts."""
    run = kernel.grams(number, GRAM)
    at = np.minimum(np.searchsorted(known, run), len(known) - 1)
    places = np.flatnonzero(known[at] == run)
    ends = begin[np.searchsorted(begin, places, side="right")]
    places = places[places + GRAM <= ends]
    return places, at[places]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score, and its first and end word in the passage."""
    step = np.arange(len(passage) + 1)
    above, begun = np.zeros(len(step), dtype=np.int64), step
    best = (0, 0, 0)
    for word in item:
        slant, down = above[:-1] + np.where(passage == word, 2, -1), above[1:] - 1
        row, origin = np.zeros(len(step), dtype=np.int64), step.copy()
        row[1:] = np.maximum(np.maximum(slant, down), 0)
        origin[1:] = np.where(row[1:] == 0, step[1:], np.where(slant >= down, begun[:-1], begun[1:]))
        # added words cost 1 each: the best of all cells to the left, less the distance
        lifted = row + step
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, step, 0))
        above, begun = top - step, origin[source]
        at = int(np.argmax(above))
        if above[at] > best[0]:
            best = (int(above[at]), int(begun[at]), at)
    return best


def _stretches(places: list[int], reach: int, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Ranges of a text's words around the seeds, ``reach`` to either side, joined where they meet."""
    a, b = places[0] - reach, places[0] + reach
    for place in places[1:]:
        if place - reach > b:
            yield max(lo, a), min(hi, b)
            a = place - reach
        b = place + reach
    yield max(lo, a), min(hi, b)


def _passages(docs: DataFrame, seeds: np.ndarray, owners: list[list[int]], targets: list[np.ndarray], totals: list[int], names: list, name_type: str, least: float, enough: int) -> DataFrame:
    """The best passage of each text (id, text) for each item that it reaches ``least`` or ``enough`` with."""
    shared = docs.sparkSession.sparkContext.broadcast((seeds, owners, targets, totals, names))
    columns = ["id", "item", "score", "points", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mine, words, whole, called = shared.value
        for batch in batches:
            found: list[tuple] = []
            for lo, raw, text_at, number, first, end, begin in kernel.plain_words(batch.column("text")):
                places, which = _find(known, number, begin)
                texts = np.searchsorted(begin, places, side="right") - 1
                hits: dict[tuple[int, int], list[int]] = {}
                for place, gram, text in zip(places.tolist(), which.tolist(), texts.tolist(), strict=True):
                    for item in mine[gram]:
                        hits.setdefault((text, item), []).append(place)
                for (text, item), at in hits.items():
                    target, best = words[item], (0, 0, 0)
                    need = min(least * whole[item], enough)
                    for a, b in _stretches(at, 2 * len(target), int(begin[text]), int(begin[text + 1])):
                        # words that the passage does not have can not score
                        if np.isin(target, number[a:b]).sum() >= need:
                            score, x, y = align(target, number[a:b])
                            best = max(best, (score, a + x, a + y), key=lambda r: r[0])
                    if best[0] > 0 and best[0] >= 2 * need:
                        _, x, y = best
                        before = _length(raw[text_at[text] : first[x]])
                        found.append((lo + text, item, best[0] / (2 * whole[item]), best[0], before, before + _length(raw[first[x] : end[y - 1]])))
            if found:
                rows, items, score, points, start, stop = zip(*found, strict=True)
                yield pa.record_batch(
                    [batch.column("id").take(pa.array(rows)), pa.array([called[i] for i in items], called.type), pa.array(score), pa.array(points, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
                    names=columns,
                )

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, item {name_type}, score double, points bigint, start bigint, end bigint")


def _length(raw: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(((raw & 0xC0) != 0x80).sum())


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = 0.5,
    enough: int = ENOUGH,
) -> DataFrame:
    """Passages of ``docs`` that are copies of ``items``, exact, edited or partial.

    Returns one row for each document and item: the two id columns, score (of
    the best local alignment over that of an exact copy), points (that alignment's
    score: 2 for an equal word, less 1 for each edit), and the passage as start and end in code points of the text, end exclusive.
    A passage is returned if its score is at least ``least`` or its points are at
    least those of ``enough`` equal words.

    An item of more than PIECE words is looked for in pieces; its score is that of
    its best passage in a piece over that of the whole item. Ties of passages
    go to the first one. Very long texts are searched whole.

    Null and empty texts have no passages. Items of fewer than GRAM words are
    too short to tell a leak from chance and are never found. A repeated row or
    id is searched like any other. An empty table on either side gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    grams = save(_item_grams(items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))), "item-grams")
    kind = items.schema[item_col].dataType.simpleString()
    parts = -(-grams.count() // ITEM_WORDS)
    found = spark.createDataFrame([], f"id {docs.schema['id'].dataType.simpleString()}, item {kind}, score double, points bigint, start bigint, end bigint")
    grams = grams.withColumn("part", F.pmod(F.xxhash64("words_id"), F.lit(max(parts, 1))))
    for part in range(parts):
        some = grams.where(F.col("part") == part)
        if some.isEmpty():
            continue
        known = np.sort(np.asarray(some.select("gram").distinct().toArrow().column("gram")))
        counts = save(_counts(docs, known), "gram-counts")
        near = Window.partitionBy("words_id").orderBy("place").rowsBetween(0, WINDOW - 1)
        ahead = F.lead("place", WINDOW - 1).over(Window.partitionBy("words_id").orderBy("place"))
        rarest = some.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        rarest = rarest.withColumn("seed", F.min(F.struct("n", F.xxhash64("gram"), "gram")).over(near)["gram"])
        rarest = rarest.withColumn("whole", ahead.isNotNull() | (F.col("place") == 0)).where("whole")
        chosen = rarest.select("words_id", "seed").distinct().toArrow()
        heads = some.where("place = 0").select("words_id", "item", "total", "words").toArrow()
        number = {w: i for i, w in enumerate(heads.column("words_id").to_pylist())}
        seeds = np.unique(np.asarray(chosen.column("seed")))
        owners: list[list[int]] = [[] for _ in seeds]
        for w, seed in zip(chosen.column("words_id").to_pylist(), np.searchsorted(seeds, np.asarray(chosen.column("seed"))).tolist(), strict=True):
            owners[seed].append(number[w])
        targets = [np.frombuffer(w, dtype=np.uint64) for w in heads.column("words").to_pylist()]
        found = found.unionByName(_passages(docs, seeds, owners, targets, heads.column("total").to_pylist(), heads.column("item").combine_chunks(), kind, least, enough))
    pieces = grams.where("place = 0").groupBy("item").agg(F.count("*").alias("n")).where("n > 1")
    if not pieces.isEmpty():
        # the best passage of the pieces of an item; repeated ids of documents have a row each
        found = found.groupBy("id", "item").agg(F.max_by(F.struct("score", "points", "start", "end"), F.struct("points", -F.col("start"))).alias("best")).select("id", "item", "best.*")
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score", "points", "start", "end")
