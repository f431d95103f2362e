"""Passages that repeat from earlier documents, by suffix automata over shards of the corpus.

A window is ``WINDOW`` consecutive words. A word goes if a window that covers
it also begins in a document with a smaller id.

The reference of a document are all documents with smaller ids. No task could
hold their automaton, nor could every document stream past every part of it,
so the reference is cut into shards that are sent to the segments they can match:

1. Anchors. Of the numbers of a window's ``GRAM``-word grams the least one is
   its anchor. Equal windows have equal anchors. Consecutive windows with one
   anchor are a segment; an anchor of one document's segments alone needs nothing more.
2. Equal segments of an anchor are one, known by its least document: every later
   document repeats it whole. No more than these rows of numbers is shuffled.
3. A shard is the different segments of one anchor. In order of their documents
   they stream through the suffix automaton of the shard so far, which
   gives matching statistics (how many words up to each one occur in a smaller
   document), and then extend it. Statistics of ``WINDOW`` words and more are repeated windows.
4. Spans of repeated windows, merged, are cut from the texts.

A shard has at most ``LIMIT`` segments of at most ``WINDOW`` + ``STRETCH`` - 1
words, so its automaton has a known bound. An anchor with more of them (a
phrase that a third of all documents have, say) would make too large a shard: there
each window is its own anchor. Such a shard is one window, its least document
the whole statistic; rows are one number for each window of those segments.
Nothing is capped and no pair of documents is made.

Grams, segments and such windows are compared by 64-bit numbers, words inside automata as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeweave.llm import kernel
from cubeweave.llm.tables import lookup, save

WINDOW = 50
GRAM = 8
#: Most windows of one segment: periodic texts have long runs of one anchor.
STRETCH = 64
#: Most segments of one automaton.
LIMIT = 2000
#: Rows that a task works on at once.
ROWS = 256


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :])


def _span_numbers(number: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for the words first .. end - 1 of each span."""
    up, down = kernel._power(len(number) + 1)
    sums = np.zeros(len(number) + 1, dtype=np.uint64)
    np.cumsum(number * up[: len(number)], out=sums[1:])
    return kernel.mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)).view(np.int64)


def segments(number: np.ndarray, begin: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, first window (in it), number of windows, anchor and content of each segment of several texts' words."""
    none = np.empty(0, dtype=np.int64)
    n = len(number) - window + 1
    if n <= 0:
        return none, none, none, none, none
    anchor = _least(kernel.grams(number, gram), window - gram + 1)
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))[:n]
    inside = np.arange(n) + window <= begin[text + 1]
    new = np.ones(n, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    # long runs of one anchor are cut
    starts = np.flatnonzero(new)
    new |= (np.arange(n) - starts[np.cumsum(new) - 1]) % STRETCH == 0
    first = np.flatnonzero(new & inside)
    border = np.append(np.flatnonzero(new | ~inside), n)
    end = border[np.searchsorted(border, first, side="right")]
    return text[first], first - begin[text[first]], end - first, anchor[first], _span_numbers(number, first, end + window - 1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """anchor, content, id, digest, first, n: the segments of all texts (id, digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            raw, at = kernel.text_bytes(batch.column("text"))
            for lo, hi in kernel.blocks(at):
                number, _, _, begin = kernel.words(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], fold=False)
                text, first, n, anchor, content = segments(number, begin, window, gram)
                row = pa.array(lo + text)
                yield pa.record_batch(
                    [pa.array(anchor), pa.array(content), batch.column("id").take(row), batch.column("digest").take(row), pa.array(first, pa.int64()), pa.array(n, pa.int64())],
                    names=["anchor", "content", "id", "digest", "first", "n"],
                )

    return docs.mapInArrow(run, f"anchor bigint, content bigint, id {docs.schema['id'].dataType.simpleString()}, digest bigint, first bigint, n bigint")


def _texts(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """anchor, content, least, words (of a segment in a shard), windows (numbers, of a segment of an anchor with too many).

    wanted: id, digest, list of (anchor, content, first, n, many).
    """
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in _pieces(batches):
            out = {c: [] for c in ("anchor", "content", "id", "words", "windows")}
            for i, digest, text, wanted in zip(*(batch.column(c) for c in ("id", "digest", "text", "wanted")), strict=True):
                if (i.as_py(), digest.as_py()) in seen:
                    continue
                seen.add((i.as_py(), digest.as_py()))
                words = text.as_py().encode().split()
                wanted = wanted.as_py()
                if any(w["many"] for w in wanted):
                    number, _, _, _ = kernel.words(*kernel.text_bytes(pa.array([text.as_py()])), fold=False)
                    at = np.arange(max(0, len(number) - window + 1))
                    numbers = _span_numbers(number, at, at + window)
                for w in wanted:
                    a, n = w["first"], w["n"]
                    out["anchor"].append(w["anchor"])
                    out["content"].append(w["content"])
                    out["id"].append(i)
                    out["words"].append(None if w["many"] else b" ".join(words[a : a + n + window - 1]).decode())
                    out["windows"].append(numbers[a : a + n] if w["many"] else None)
            yield pa.record_batch(
                [
                    pa.array(out["anchor"], pa.int64()),
                    pa.array(out["content"], pa.int64()),
                    pa.array(out["id"], batch.schema.field("id").type),
                    pa.array(out["words"], pa.string()),
                    pa.array(out["windows"], pa.list_(pa.int64())),
                ],
                names=["anchor", "content", "least", "words", "windows"],
            )

    return docs.join(wanted, ["id", "digest"]).mapInArrow(run, f"anchor bigint, content bigint, least {kind}, words string, windows array<bigint>")


class SuffixAutomaton:
    """All factors of the sequences put in, as states with transitions, suffix links and longest lengths."""

    def __init__(self) -> None:
        self.to: list[dict] = [{}]
        self.link = [-1]
        self.longest = [0]

    def matches(self, words: list) -> list[int]:
        """Matching statistics: for each word, the most words up to it that are a factor."""
        to, link, longest = self.to, self.link, self.longest
        state, length, found = 0, 0, []
        for w in words:
            while w not in to[state]:
                state = link[state]
                if state < 0:
                    state, length = 0, 0
                    break
                length = longest[state]
            else:
                state = to[state][w]
                length += 1
            found.append(length)
        return found

    def _copy(self, state: int, w, step: int) -> int:
        """A state of its own for the factors of to[state][w] that are no longer than the path by which they came."""
        to, link, longest = self.to, self.link, self.longest
        old, new = to[state][w], len(to)
        to.append(to[old].copy())
        link.append(link[old])
        longest.append(step)
        link[old] = new
        while state >= 0 and to[state].get(w) == old:
            to[state][w] = new
            state = link[state]
        return new

    def put(self, words: list) -> None:
        """Add a sequence and all its factors."""
        to, link, longest = self.to, self.link, self.longest
        last = 0
        for w in words:
            step = longest[last] + 1
            known = to[last].get(w)
            if known is not None:
                last = known if longest[known] == step else self._copy(last, w, step)
                continue
            new = len(to)
            to.append({})
            link.append(0)
            longest.append(step)
            state = last
            while state >= 0 and w not in to[state]:
                to[state][w] = new
                state = link[state]
            if state >= 0:
                known, step = to[state][w], longest[state] + 1
                link[new] = known if longest[known] == step else self._copy(state, w, step)
            last = new


def _in_shard(rows: list[tuple], window: int) -> Iterator[tuple]:
    """Anchor, content and repeated windows of the segments (content, anchor, least, words) of one shard, in order of ``least``."""
    automaton, contents = SuffixAutomaton(), set()
    for at, (_, same) in enumerate(groupby(rows, key=lambda r: r[2])):
        fresh = []
        for content, anchor, _, text in same:
            if content in contents:
                continue
            contents.add(content)
            words = text.encode().split()
            found = automaton.matches(words) if at else [0]
            if max(found) < len(words):
                fresh.append(words)
            if hits := [j - window + 1 for j, n in enumerate(found) if n >= window]:
                yield anchor, content, hits
        for words in fresh:
            automaton.put(words)


def _shards(segments: DataFrame, window: int) -> DataFrame:
    """anchor, content, hits: which windows of a segment's least document repeat (segments: anchor, content, least, words)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("content", "anchor", "least", "words")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in groupby(rows(batches), key=lambda r: r[1]):
            if found := list(_in_shard(shard, window)):
                anchor, content, hits = zip(*found, strict=True)
                yield pa.record_batch([pa.array(anchor, pa.int64()), pa.array(content, pa.int64()), pa.array(hits, pa.list_(pa.int64()))], names=["anchor", "content", "hits"])

    return segments.repartition("anchor").sortWithinPartitions("anchor", "least", "content").mapInArrow(run, "anchor bigint, content bigint, hits array<bigint>")


def _windows(segments: DataFrame) -> DataFrame:
    """The same for segments of anchors with too many (anchor, content, least, windows)."""
    every = save(segments.select("anchor", "content", "least", F.posexplode("windows").alias("at", "window")).distinct(), "windows")
    first = every.groupBy("window").agg(F.min("least").alias("earliest"), F.count("*").alias("rows"))
    return lookup(every, save(first, "windows"), ["window"]).where("earliest < least").groupBy("anchor", "content").agg(F.collect_set("at").alias("hits"))


def _cut(docs: DataFrame) -> DataFrame:
    """id, n_words, n_removed, text of each row of ``docs`` (id, text, spans: words to remove, may overlap)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            n_words, n_removed, texts = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                if spans.is_valid:
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    for s in spans.as_py():
                        step[s["a"]] += 1
                        step[s["b"]] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words).decode())
            yield pa.record_batch([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())], names=["id", "n_words", "n_removed", "text"])

    return docs.select("id", "text", "spans").mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n_words bigint, n_removed bigint, text string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Texts without the passages that begin in documents with smaller ids.

    Returns one row for each row of ``docs``: the id column, n_words, n_removed
    and the text column: the words that stay, joined by one space. A word goes
    if some window of ``window`` words that covers it occurs in a document with
    a smaller id; windows are those of the given texts. Other columns of
    ``docs`` are not read.

    Words are unchanged runs of characters other than space and U+0009 to
    U+000D. Null and empty texts, and texts shorter than a window, lose
    nothing. Rows that repeat an id are compared with smaller ids, not with each other. A document
    without an id is neither smaller nor larger than others: it loses nothing
    and is no reference. An empty table gives an empty result. Very long texts
    are processed whole, segment by segment.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    rows = save(_segments(docs.where("id is not null and text is not null"), window, gram), "segments")
    anchors = rows.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("rows")).where("low < high")
    rows = save(lookup(rows, save(anchors.select("anchor", "rows"), "anchors"), ["anchor"]).distinct(), "segments")

    # equal segments are one; those of one anchor are a shard, if they are not too many
    contents = rows.groupBy("anchor", "content").agg(F.min(F.struct("id", "digest", "first", "n")).alias("least"), F.count("*").alias("rows"))
    contents = save(contents, "contents")
    shards = save(contents.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1").withColumn("many", F.col("rows") > LIMIT), "shards")
    wanted = lookup(contents.select("anchor", "content", "least"), shards, ["anchor"])
    wanted = wanted.groupBy("least.id", "least.digest").agg(F.collect_list(F.struct("anchor", "content", "least.first", "least.n", "many")).alias("wanted"))
    texts = save(_texts(docs, wanted, window), "texts")
    hits = _shards(texts.where("words is not null").drop("windows"), window)
    if not shards.where("many").isEmpty():
        hits = hits.unionByName(_windows(texts.where("windows is not null").drop("words")))

    found = contents.join(hits, ["anchor", "content"], "left").select("anchor", "content", F.col("least.id").alias("least"), "rows", "hits")
    marked = lookup(rows, save(found, "found"), ["anchor", "content"])
    whole = marked.where("id > least").select("id", "digest", F.col("first").alias("a"), (F.col("first") + F.col("n") + (window - 1)).alias("b"))
    part = marked.where("id = least").select("id", "digest", "first", F.explode("hits").alias("at"))
    part = part.select("id", "digest", (F.col("first") + F.col("at")).alias("a"), (F.col("first") + F.col("at") + window).alias("b"))
    spans = whole.unionByName(part).groupBy("id", "digest").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    return _cut(docs.join(spans, ["id", "digest"], "left")).select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("text").alias(text_col))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of what stays."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
