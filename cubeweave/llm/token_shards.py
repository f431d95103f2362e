"""Token ids as binary shards in training order.

Documents are encoded and packed, one after the other, into sequences of a
fixed number of ids. A keyed Feistel network, walked until it stays inside the
domain, permutes the sequences' indices; the permuted range is cut into equal
parts, each part is one task and one file, in which every sequence takes the
same number of bytes. A sequence's global slot is the number of sequences in
earlier shards plus its row, so a reader seeks to any slot and reads on.

Indices must be known before the texts are encoded, or they would have to be
encoded twice or stored in between. No text has more ids than bytes (and a
begin and an end id), so each partition gets a range of indices by its bytes.
The permutation is one of that larger domain; leaving out the indices that turn
out unused keeps the order of the others.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubeweave.llm import kernel
from cubeweave.llm.sentencepieces import encoder
from cubeweave.llm.tables import save
from cubeweave.runtime import new_dir

LENGTH = 2048
#: Indices of a shard; about two fifths of them are used.
SPAN = 16384
#: The folder of the table of shards.
MANIFEST = "manifest"
ROUNDS = 6


def feistel(index: np.ndarray, domain: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. domain - 1."""
    half = max(1, (max(domain - 1, 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), np.array(index, dtype=np.uint64)
    keys = kernel.mix(np.uint64(key & (1 << 64) - 1) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (kernel.mix(right + k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= domain]
    return out.astype(np.int64)


def width(model: str) -> np.dtype:
    """The least unsigned type that holds the model's ids, little-endian."""
    return np.dtype("<u2" if encoder(model).model.get_piece_size() <= 1 << 16 else "<u4")


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark reads it: one without a scheme is on the default file system, which all executors share."""
    if urlsplit(path).scheme:
        return path
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return whole.removeprefix("file:") if whole.startswith("file:") else whole


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if urlsplit(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _bounds(docs: DataFrame, length: int) -> list[int]:
    """First index of each partition, and the size of the domain: one number for each partition comes to the driver."""
    ids = docs.select(F.spark_partition_id().alias("p"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 2).cast("bigint").alias("n"))
    size = {r["p"]: -(-r["n"] // length) for r in ids.groupBy("p").agg(F.sum("n").alias("n")).collect()}
    first = [0]
    for p in range(max(size, default=-1) + 1):
        first.append(first[-1] + size.get(p, 0))
    return first


def _sequences(docs: DataFrame, model: str, first: list[int], key: int, length: int, span: int) -> DataFrame:
    """shard, place (permuted index), docs (ids of the documents in it) and tokens of every sequence."""
    kind, domain = docs.schema["id"].dataType.simpleString(), first[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        around = [coder.model.bos_id(), coder.model.eos_id()]
        form = np.dtype("<u2" if coder.model.get_piece_size() <= 1 << 16 else "<u4")
        at = TaskContext.get().partitionId()
        index, rest, owners = first[at] if at + 1 < len(first) else 0, np.empty(0, dtype=form), []

        def rows(tokens: np.ndarray, whose: list[tuple[int, object]], type_of: pa.DataType) -> pa.RecordBatch:
            """whose: where each document begins in the tokens, and its id."""
            nonlocal index
            n = -(-len(tokens) // length)
            if index + n > first[at + 1]:
                raise ValueError("the texts are longer than when they were measured")
            place = feistel(np.arange(index, index + n), domain, key)
            index += n
            begins = np.array([b for b, _ in whose], dtype=np.int64)
            ids = []
            for i in range(n):
                lo = int(np.searchsorted(begins, i * length, side="right")) - 1
                hi = int(np.searchsorted(begins, (i + 1) * length, side="left"))
                ids.append([whose[j][1] for j in range(lo, hi)])
            blob = [tokens[i * length : (i + 1) * length].tobytes() for i in range(n)]
            return pa.record_batch([pa.array(place // span, pa.int32()), pa.array(place), pa.array(ids, pa.list_(type_of)), pa.array(blob, pa.binary())], names=["shard", "place", "docs", "tokens"])

        type_of = pa.int64()
        for batch in batches:
            names, type_of = batch.column("id"), batch.schema.field("id").type
            _, bytes_at = kernel.text_bytes(batch.column("text"))
            for lo, hi in kernel.blocks(bytes_at):
                ids, begin = coder.encode(batch.column("text").slice(lo, hi - lo))
                ids = np.insert(ids, np.repeat(begin, 2)[1:-1], around * (hi - lo)).astype(form)
                begin = begin + 2 * np.arange(hi - lo + 1) + len(rest)
                tokens = np.concatenate([rest, ids])
                owners += zip(begin[:-1].tolist(), names.slice(lo, hi - lo).to_pylist(), strict=True)
                full = len(tokens) // length * length
                if full:
                    yield rows(tokens[:full], owners, type_of)
                    last = max(i for i, (b, _) in enumerate(owners) if b <= full)
                    owners = [(max(b - full, 0), d) for b, d in owners[last:] if b < len(tokens) or b == full < len(tokens)]
                rest = tokens[full:]
        if len(rest):
            yield rows(rest, owners, type_of)

    return docs.mapInArrow(run, f"shard int, place bigint, docs array<{kind}>, tokens binary")


def _files(sequences: DataFrame, path: str, stride: int) -> DataFrame:
    """Write the shards' files; shard, row, docs, n_tokens and crc32 of every sequence.

    A task writes a file of its own name first and moves it into place when it
    is whole, so a lost or repeated task leaves a whole file or none.
    """
    kind = sequences.schema["docs"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        shard, row, sink, name = None, 0, None, ""

        def close() -> None:
            sink.close()
            store.move(name, posixpath.join(folder, f"shard-{shard:08d}.bin"))

        for batch in batches:
            rows, sums = [], []
            for mine, tokens in zip(batch.column("shard").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                if mine != shard:
                    if sink:
                        close()
                    shard, row, name = mine, 0, posixpath.join(folder, f"part-{uuid.uuid4().hex}")
                    sink = store.open_output_stream(name)
                whole = tokens.ljust(stride, b"\0")
                sink.write(whole)
                rows.append(row)
                sums.append(zlib.crc32(whole))
                row += 1
            size = pc.binary_length(batch.column("tokens")).cast(pa.int64())
            yield pa.record_batch([batch.column("shard"), pa.array(rows, pa.int64()), batch.column("docs"), size, pa.array(sums, pa.int64())], names=["shard", "row", "docs", "bytes", "crc32"])
        if sink:
            close()

    return sequences.mapInArrow(run, f"shard int, row bigint, docs {kind}, bytes bigint, crc32 bigint")


def write_token_shards(docs: DataFrame, model: str, path: str, key: int, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """Encode, pack and permute the documents and write the shards below ``path``.

    Returns one row for each sequence: slot (its place in training order, from
    0), shard, row (its place in the shard's file), docs (ids of the documents that it
    has ids of, in order), n_tokens (fewer than ``length`` only at the end of a
    partition; the rest of the row is id 0) and crc32 of its bytes. The file of shard s
    is shard-<s as eight digits>.bin; row r begins at byte r * length * width. The
    table ``manifest`` beside them (shard, first_slot, rows) is written last: ``read_slots`` finds slots by it.

    ``docs`` must give the same rows in the same order whenever it is read, as
    stored tables do. Null and empty texts are a begin and an end id; repeated
    rows are packed like others; a null id is a null in ``docs``; an empty
    table gives no rows and no files. Other columns are not read.
    """
    path = qualified(docs.sparkSession, path)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    store, folder = _store(path)
    store.create_dir(folder, recursive=True)
    form, first = width(model), _bounds(docs, length)
    sequences = _sequences(docs, model, first, key, length, span)
    dealt = sequences.repartitionById(max(1, -(-first[-1] // span)), "shard").sortWithinPartitions("shard", "place")
    placed = save(_files(dealt, path, length * form.itemsize), "token-rows")
    # one row for each shard, that is for each file: where its first slot is
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("shard").agg(F.count("*").alias("rows"))
    sizes = sizes.select("shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first_slot"), "rows")
    manifest = posixpath.join(path, MANIFEST)
    sizes.coalesce(1).write.parquet(manifest)
    for left in store.get_file_info(fs.FileSelector(folder)):
        if left.base_name.startswith("part-"):  # of a task that was lost
            store.delete_file(left.path)
    table = docs.sparkSession.read.schema(sizes.schema).parquet(manifest).withColumnRenamed("first_slot", "before").drop("rows")
    placed = placed.join(table, "shard")
    return placed.select((F.col("before") + F.col("row")).alias("slot"), "shard", "row", "docs", (F.col("bytes") / form.itemsize).cast("bigint").alias("n_tokens"), "crc32")


def read_rows(path: str, shard: int, row: int, n: int, form: np.dtype, length: int = LENGTH) -> np.ndarray:
    """Up to ``n`` sequences of a shard from ``row`` on, in one sequential read."""
    store, folder = _store(path)
    stride = length * form.itemsize
    with store.open_input_file(posixpath.join(folder, f"shard-{shard:08d}.bin")) as file:
        file.seek(row * stride)
        return np.frombuffer(file.read(n * stride), dtype=form).reshape(-1, length)


def read_slots(path: str, first: int, n: int, form: np.dtype, length: int = LENGTH) -> Iterator[np.ndarray]:
    """The sequences of the slots first .. first + n - 1, shard by shard, each part in one sequential read.

    Reading goes on where it stopped, in the middle of a shard or not: the manifest tells which shard holds a slot.
    """
    store, folder = _store(path)
    table = ds.dataset(posixpath.join(folder, MANIFEST), filesystem=store, format="parquet")
    end = first + n
    held = table.to_table(filter=(ds.field("first_slot") < end) & (ds.field("first_slot") + ds.field("rows") > first)).sort_by("first_slot")
    for shard, begin, rows in zip(*(held.column(c).to_pylist() for c in ("shard", "first_slot", "rows")), strict=True):
        lo, hi = max(first, begin), min(end, begin + rows)
        yield read_rows(path, shard, lo - begin, hi - lo, form, length)


def materialise(spark: SparkSession, docs: DataFrame, model: str, key: int = 20240229) -> DataFrame:
    """Write the shards to a new folder of the shared ones."""
    return write_token_shards(docs, model, new_dir(spark, "token-shards"), key)
