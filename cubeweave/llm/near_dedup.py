"""Near duplicates: bottom-k sketches of one hash function.

A document is the set of its word shingles. Equal sets are one class; what
follows works on one document of each class.

1. Sketch: the k least numbers of the set.
2. Inverted lists of the retained numbers. Two sets of the wanted similarity
   have many numbers in common, so they must meet in the rarest few of either
   sketch; only those are listed, and a number that one class alone has leads
   to no list. Very common shingles are never among the rarest.
3. The union sketch of a pair estimates its similarity; pairs far below are let go.
4. Exact Jaccard similarity on whole sets confirms a link.

Pairs of a list are not all made. First every member meets the list's hub, the
member with the most common shingles; the links found give components. Members
of different components of a short list then meet each other. In lists
longer than ``SHORT`` the members that still differ from the list's largest
component meet all others in blocks: there the lists are made anew, from the
rarest numbers of the whole sets, which is exact, and two blocks of at most
``BLOCK`` sets are compared in one task without making a row for each pair.
No list, candidate or pair is capped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.llm import kernel
from cubeweave.llm.graph import components
from cubeweave.llm.tables import save

SKETCH = 64
SHORT = 64
BLOCK = 1024
#: Standard deviations by which an estimate may fall short of the truth.
SLACK = 6.0


def _sketches(docs: DataFrame, size: int, k: int) -> DataFrame:
    """id, digest, n, node (digest of the set), sketch: one row for each row of ``docs`` (id, digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, sketch = [], [], []
            for s in kernel.shingle_sets(batch.column("text"), size):
                n.append(len(s))
                node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sketch.append(s[:k])
            ends = np.cumsum([0, *map(len, sketch)], dtype=np.int32)
            values = np.concatenate([*sketch, np.empty(0, dtype=np.int64)])
            yield pa.record_batch(
                [batch.column("id"), batch.column("digest"), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                names=["id", "digest", "n", "node", "sketch"],
            )

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, digest bigint, n bigint, node binary, sketch array<bigint>")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """nid, members: the whole set of each row of ``texts`` (nid, node, text) whose digest is its node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nids, sets = [], []
            for nid, node, s in zip(batch.column("nid").to_pylist(), batch.column("node").to_pylist(), kernel.shingle_sets(batch.column("text"), size), strict=True):
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == node:
                    nids.append(nid)
                    sets.append(s)
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            values = np.concatenate([*sets, np.empty(0, dtype=np.int64)])
            yield pa.record_batch([pa.array(nids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["nid", "members"])

    return texts.mapInArrow(run, "nid bigint, members array<bigint>")


def _least_shared(n: Column, k: int, percent: int) -> Column:
    """How many numbers two linked sets' sketches share at least, from the size of one."""
    t = percent / 100
    bound = max(1, math.floor(t * k - SLACK * math.sqrt(k * t * (1 - t))))
    return F.when(n * 100 <= percent * k, F.ceil(n * percent / 100)).otherwise(F.lit(bound)).cast("int")


def _rarest(owners: DataFrame, values: DataFrame, prefix: Column) -> DataFrame:
    """(nid, value) of the numbers that come first by rarity in each owner's list, up to ``prefix``.

    values: nid, value. Numbers of one owner alone take their places but need
    no row. What is gathered for an owner is part of its own set.
    """
    common = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    held = values.join(common, "value").groupBy("nid").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("held"))
    left = prefix - (F.col("total") - F.size("held"))
    return (
        owners.join(held, "nid")
        .where(left > 0)
        .withColumn("held", F.slice("held", F.lit(1), F.greatest(F.lit(0), F.least(left, F.size("held")))))
        .select("nid", F.explode("held.value").alias("value"))
    )


def _jaccard(percent: int) -> Column:
    """Whether the sets of columns x and y are linked, exactly."""
    both = F.size(F.array_intersect("x", "y"))
    return both * 100 >= (F.size("x") + F.size("y") - both) * percent


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are linked."""
    x = sets.select(F.col("nid").alias("a"), F.col("members").alias("x"))
    y = sets.select(F.col("nid").alias("b"), F.col("members").alias("y"))
    return pairs.join(x, "a").join(y, "b").where(_jaccard(percent)).select("a", "b")


def _estimate(k: int, percent: int) -> Column:
    """Whether the union sketch of x and y, the k least of both, leaves their link possible."""
    t = percent / 100
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect("x", "y"), union))
    least = F.size(union) * t - SLACK * F.sqrt(F.size(union) * t * (1 - t))
    whole = F.greatest(F.size("x"), F.size("y")) < k
    return F.when(whole, both * 100 >= F.size(F.array_union("x", "y")) * percent).otherwise(both >= least)


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    return lists.join(labels.withColumnRenamed("node", "nid"), "nid", "left").withColumn("label", F.coalesce("label", "nid"))


def _compare_blocks(percent: int):
    """Links between the sets of two blocks, without a row for each pair."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            y = right.column("members").combine_chunks()
            y = y.chunk(0) if isinstance(y, pa.ChunkedArray) else y
            length = np.asarray(y.value_lengths())
            order = np.argsort(flat := np.asarray(y.flatten()), kind="stable")
            flat, owner = flat[order], np.repeat(np.arange(len(length)), length)[order]
            names, labels = np.asarray(right.column("nid")), np.asarray(right.column("label"))
            for nid, label, x in zip(left.column("nid").to_pylist(), left.column("label").to_pylist(), left.column("members"), strict=True):
                x = np.asarray(x.values)
                lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
                n = hi - lo
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                both = np.bincount(owner[at], minlength=len(length))
                for i in np.flatnonzero((both * 100 >= (len(x) + length - both) * percent) & (labels != label)):
                    a.append(nid)
                    b.append(int(names[i]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _long_lists(lists: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between components inside long lists (value, nid, label), exactly.

    Linked sets share one of the rarest n - ceil(t n) + 1 numbers of either,
    counted over the members of long lists, since both are members.
    """
    mine = save(sets.join(lists.select("nid").distinct(), "nid"), "long-sets")
    n = F.col("total")
    owners = mine.select("nid", F.size("members").alias("total"))
    first = _rarest(owners, mine.select("nid", F.explode("members").alias("value")), n - F.ceil(n * percent / 100) + 1)
    rare = save(_labelled(first, labels), "long-lists")
    sizes = rare.groupBy("value", "label").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("value").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("total"), F.count("*").alias("parts")).where("parts > 1")
    cells = F.ceil(F.col("total") / BLOCK).cast("int")
    rare = rare.join(sizes, "value").withColumn("cells", cells).withColumn("cell", F.pmod(F.xxhash64("nid"), "cells").cast("int")).join(mine, "nid")
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    names = [F.col(c).alias(c) for c in ("value", "nid", "label", "members")]
    left = rare.where("label <> main").select(*names, F.col("cell").alias("i"), every.alias("j"))
    right = rare.select(*names, F.col("cell").alias("j"), every.alias("i"))
    return left.groupBy("value", "i", "j").cogroup(right.groupBy("value", "i", "j")).applyInArrow(_compare_blocks(percent), "a bigint, b bigint")


def _estimated(pairs: DataFrame, sketches: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose union sketch leaves a link possible."""
    x = sketches.select(F.col("nid").alias("a"), F.col("sketch").alias("x"))
    y = sketches.select(F.col("nid").alias("b"), F.col("sketch").alias("y"))
    return pairs.join(x, "a").join(y, "b").where(_estimate(k, percent)).select("a", "b")


def _links(docs: DataFrame, classes: DataFrame, size: int, percent: int, k: int) -> DataFrame:
    """Component of each class that is linked with another: node, label."""
    owners = classes.select("nid", F.size("sketch").alias("total"), "n")
    values = classes.select("nid", F.explode("sketch").alias("value"))
    lists = save(_rarest(owners, values, F.col("total") - _least_shared(F.col("n"), k, percent) + 1), "lists")
    lengths = lists.groupBy("value").agg(F.count("*").alias("length")).where("length > 1")
    # the fewer of a sketch's places are taken by numbers of its own, the more central it is
    central = lists.groupBy("nid").agg(F.count("*").alias("central"))
    lists = save(lists.join(lengths, "value").join(central, "nid"), "lists")
    sketches = save(classes.select("nid", "sketch").join(lists.select("nid").distinct(), "nid"), "sketches")

    # whole sets of the members, each from a text of its class
    wanted = classes.join(lists.select("nid").distinct(), "nid").select("nid", "node", F.col("of.id").alias("doc"), F.col("of.digest").alias("of"))
    # rows that share an id are told apart by the digest of their texts
    texts = docs.join(wanted, F.col("id").eqNullSafe(F.col("doc")) & (F.col("digest") == F.col("of"))).select("nid", "node", "id", "text").distinct()
    sets = save(_sets(texts, size), "sets")

    hubs = lists.groupBy("value").agg(F.max_by("nid", F.struct("central", -F.col("nid"))).alias("hub"))
    stars = lists.join(hubs, "value").where("nid <> hub").select(F.least("nid", "hub").alias("a"), F.greatest("nid", "hub").alias("b")).distinct()
    first = save(_confirm(_estimated(stars, sketches, k, percent), sets, percent), "links")
    labels = save(components(first), "labels")

    here = save(_labelled(lists, labels), "lists")
    short = here.where(F.col("length") <= SHORT).select("value", F.col("nid").alias("a"), F.col("label").alias("p"))
    other = short.select("value", F.col("a").alias("b"), F.col("p").alias("q"))
    pairs = short.join(other, "value").where("a < b and p <> q").select("a", "b").distinct()
    later = _confirm(_estimated(pairs, sketches, k, percent), sets, percent)
    long = here.where(F.col("length") > SHORT)
    mixed = save(long.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("value"), "lists")
    if not mixed.isEmpty():
        later = later.unionByName(_long_lists(long.join(mixed, "value"), sets, labels, percent))
    later = save(later, "links")
    if later.isEmpty():
        return labels
    return components(later.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, k: int = SKETCH, keyed: bool = False
) -> DataFrame:
    """Components of near duplicates: sets of ``size``-word shingles whose Jaccard similarity is ``percent`` % or more.

    Returns one row for each row of ``docs``: the id column, n_shingles,
    component_id (least id that links lead to, itself included) and kept
    (whether that is its own id). Other columns of ``docs`` are not read.

    A text of fewer words is one shingle. Empty and null texts have no
    shingles and are linked with nothing. Equal sets are linked. A null id is
    never the least one; a document that has only null ids in its component
    has a null component and is kept. Rows that repeat an id are documents of
    their own, linked if their sets are. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("digest"), F.col(text_col).alias("text"))
    rows = save(_sketches(docs, size, k), "sketches")
    classes = rows.where("n > 0").groupBy("node").agg(
        F.min("id").alias("first_id"), F.min(F.struct("id", "digest")).alias("of"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = save(classes.withColumn("nid", F.monotonically_increasing_id()), "classes")
    labels = _links(docs, classes, size, percent, k)

    named = labels.join(classes.select(F.col("nid").alias("node"), "first_id"), "node")
    least = named.groupBy("label").agg(F.min("first_id").alias("least_id"))
    named = named.join(least, "label").select(F.col("node").alias("nid"), "least_id", "label")
    found = classes.select("node", "nid", "first_id").join(named, "nid", "left").withColumn("group", F.coalesce("label", "nid"))
    # coalesce would hide a component without any id; both columns are null only there
    found = found.select("node", "group", F.when(F.col("least_id").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id"))
    rows = rows.select("id", "digest", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (
        rows.join(found, "node", "left")
        .withColumn("component_id", component)
        .select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), *(["digest", "group"] if keyed else [])
        )
    )
