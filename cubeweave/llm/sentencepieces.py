"""SentencePiece encoding and decoding.

If no piece of a model has a whitespace marker after another character, no
merge crosses from a word to the next marker, so a text can be cut before each
run of markers and around each line break, and the parts segmented alone.
Parts repeat: every block of texts gets a table of its distinct parts, each is
segmented once (or taken from the table of earlier blocks of the same worker,
which has a fixed limit), and the ids are joined back by position. A table for
all documents would have to be shuffled to every block of texts that uses it,
with the texts, which moves more than the segmentation costs.

Models for which the condition does not hold are used text by text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeweave.llm import kernel

MARKER = "▁"
#: Parts that a worker remembers from earlier blocks.
REMEMBERED = 150_000


def parts_are_independent(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether texts may be cut before markers and around line breaks."""
    pieces = [p for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and (p := model.id_to_piece(i))]
    if any(re.search(f"[^{MARKER}]{MARKER}|\n| ", p) for p in pieces):
        return False
    line = model.encode("\n")
    probe = "Aéé ﬁ 　 ｘ  b "
    return len(line) == 2 and model.is_byte(line[1]) and model.id_to_piece(line[0]) == MARKER and model.decode(model.encode(probe)) == probe


class Encoder:
    """Encodes blocks of texts with one model."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.split = parts_are_independent(self.model)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.begin = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _learn(self, parts: list[str]) -> None:
        """Add the parts to the table; the first two ids belong to the line break that stands before each."""
        ids = self.model.encode(["\n" + p for p in parts], num_threads=1)
        length = np.fromiter(map(len, ids), np.int64, len(ids)) - 2
        flat = np.fromiter((i for x in ids for i in x[2:]), np.int32, int(length.sum()))
        self.number.update(zip(parts, range(len(self.number), len(self.number) + len(parts)), strict=True))
        self.ids = np.concatenate([self.ids, flat])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(length)])

    def _parts(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The parts of the texts, and where each text's parts begin."""
        texts = pc.replace_substring(texts, MARKER, " ")
        space, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(space, texts, none))
        raw, at = kernel.text_bytes(texts)
        space, line = raw == 0x20, raw == 0x0A
        cut = np.zeros(len(raw), dtype=bool)
        cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        cut[at[:-1][at[:-1] < len(raw)]] = True
        first = np.flatnonzero(cut)
        ends = np.append(first, len(raw)).astype(np.int64)
        parts = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw)))
        return parts.dictionary_encode(), np.searchsorted(first, at)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin; without begin and end ids."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.split:
            ids = self.model.encode(texts.to_pylist(), num_threads=1)
            ends = np.cumsum([0, *map(len, ids)])
            return np.fromiter((i for x in ids for i in x), np.int32, int(ends[-1])), ends
        coded, begin = self._parts(texts)
        parts = coded.dictionary.to_pylist()
        if len(self.number) > REMEMBERED:
            self._forget()
        self._learn([p for p in parts if p not in self.number])
        number = np.fromiter((self.number[p] for p in parts), np.int64, len(parts))
        used = number[coded.indices.to_numpy(zero_copy_only=False)]
        length = self.begin[used + 1] - self.begin[used]
        ends = np.concatenate([[0], np.cumsum(length)])
        place = np.arange(ends[-1]) + np.repeat(self.begin[used] - ends[:-1], length)
        return self.ids[place], ends[begin]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder."""
    return Encoder(path)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary for each text, of little-endian unsigned 32-bit ids."""
    raw = np.ascontiguousarray(values, dtype="<u4")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int64)), pa.py_buffer(raw)])


def _decoded(model: sentencepiece.SentencePieceProcessor, ids: list[list[int]]) -> pa.Array:
    return pa.array(model.decode(ids), pa.string())


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", ends: bool = True, decoded: bool = False) -> DataFrame:
    """The ids of every whole text, exactly as the model's library gives them.

    Returns the id column and ids: binary, little-endian unsigned 32-bit ids,
    with the begin and end id around them if ``ends``; and, if ``decoded``, what
    they decode to as text, in the same pass. One row for each row of
    ``docs``, whatever its id; other columns are not read. A null text counts
    as empty: the begin and end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        around = [coder.model.bos_id(), coder.model.eos_id()]
        for batch in batches:
            texts = batch.column("text")
            _, at = kernel.text_bytes(texts)
            for lo, hi in kernel.blocks(at):
                ids, begin = coder.encode(texts.slice(lo, hi - lo))
                if ends:
                    ids = np.insert(ids, np.repeat(begin, 2)[1:-1], around * (hi - lo))
                    begin = begin + 2 * np.arange(hi - lo + 1)
                out = [batch.column("id").slice(lo, hi - lo), _binary(ids, begin).cast(pa.binary())]
                if decoded:
                    out.append(_decoded(coder.model, [ids[a:b].tolist() for a, b in pairwise(begin.tolist())]))
                yield pa.record_batch(out, names=["id", "ids", "text"][: len(out)])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, more = docs.schema[id_col].dataType.simpleString(), ", text string" if decoded else ""
    return rows.mapInArrow(run, f"id {kind}, ids binary{more}").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id") -> DataFrame:
    """The texts of ids in the form that ``encode`` gives them.

    Returns the id column, ids and text. Control ids vanish; a null counts as
    no ids and gives an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in batches:
            ids = batch.column("ids")
            for lo in range(0, len(ids), 512):
                some = ids.slice(lo, 512)
                texts = _decoded(coder.model, [np.frombuffer(x or b"", dtype="<u4").tolist() for x in some.to_pylist()])
                yield pa.record_batch([batch.column("id").slice(lo, 512), some, texts], names=["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), "ids")
    return rows.mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, ids binary, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Number of ids and digests of ids and decoded text of each document."""
    coded = encode(docs, model, decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )
