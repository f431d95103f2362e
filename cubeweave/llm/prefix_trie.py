"""The prefix trie of conversations, without building a tree.

1. Every turn becomes a digest (role and text) and a length; texts go no further.
2. A prefix is known by its depth and the running exclusive or of its turns'
   digests, mixed with their places: two 64-bit numbers.
3. Identical conversations collapse into one weighted sequence, known by its
   least conversation, with the list of conversations that end there.
4. Sequences that are proper prefixes of others go by an anti-join; what is left are the leaves.
5. The prefixes of the sequences are aggregated with their weights: members and
   leaves below a node are sums over the sequences that pass it.

What is summed over a subtree is a sum over sequences too. Each node is owned
by its least member. What a sequence owns are the nodes from some depth to its
end, since a node's least member is that of every deeper node on its own path. So the
distinct nodes below a node are, sequence by sequence, the owned ones below it,
and parents and children are read off the depth where each ownership begins.

Work and rows grow with the number of turns, whatever the depth. A conversation
of very many turns is cut into slices of a range partitioning: running values are
taken inside slices, and totals of earlier slices, at most two rows for each
slice, are added. Joins split off the keys with the most rows, whose number is
bounded (``tables.HEAVY``), and send those of the other side to all tasks. List digests
are made of sorted chunks, so that the list of one node is a stream in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeweave.llm.tables import lookup, save

#: Conversation ids in one chunk of a list.
CHUNK = 1000
BRANCH = 100
SHARED = 6
KEY = ["x", "y", "depth"]


def _sliced(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` dealt by ranges of group and order, with the number of its range and a last order key among equal rows."""
    df = df.withColumn("tie", F.monotonically_increasing_id())
    return save(df.repartitionByRange(group, *order, "tie").withColumn("slice", F.spark_partition_id()), "slices")


def _running(df: DataFrame, group: str, order: list[str], sums: dict[str, str], xors: dict[str, str]) -> DataFrame:
    """Add running sums and exclusive ors of columns (to and with each row) and, as all_name, the sums of the group.

    df: a table of ``_sliced``. A range border cuts one group at most, so the
    groups of several slices have no more than two rows for each slice.
    """
    inside = Window.partitionBy(group, "slice")
    upto = inside.orderBy(*order, "tie").rowsBetween(Window.unboundedPreceding, 0)
    cut = df.groupBy(group).agg(F.min("slice").alias("low"), F.max("slice").alias("high")).where("low < high").select(group)
    slices = df.join(F.broadcast(cut), group).groupBy(group, "slice").agg(
        *[F.sum(c).alias(f"t_{n}") for n, c in sums.items()], *[F.bit_xor(c).alias(f"t_{n}") for n, c in xors.items()]
    )
    earlier = Window.partitionBy(group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        group,
        "slice",
        *[F.coalesce(F.sum(f"t_{n}").over(earlier), F.lit(0)).alias(f"b_{n}") for n in sums],
        *[F.coalesce(F.bit_xor(f"t_{n}").over(earlier), F.lit(0)).alias(f"b_{n}") for n in xors],
        *[F.sum(f"t_{n}").over(Window.partitionBy(group)).alias(f"a_{n}") for n in sums],
    )
    values = {f"r_{n}": F.sum(c).over(upto) for n, c in sums.items()} | {f"r_{n}": F.bit_xor(c).over(upto) for n, c in xors.items()}
    values |= {f"w_{n}": F.sum(c).over(inside) for n, c in sums.items()}
    found = df.withColumns(values).join(F.broadcast(slices), [group, "slice"], "left")
    before = lambda n: F.coalesce(f"b_{n}", F.lit(0))
    return found.select(
        *[c for c in df.columns if c not in ("tie", "slice")],
        *[(F.col(f"r_{n}") + before(n)).alias(n) for n in sums],
        *[F.col(f"r_{n}").bitwiseXOR(before(n)).alias(n) for n in xors],
        *[F.coalesce(f"a_{n}", f"w_{n}").alias(f"all_{n}") for n in sums],
    )


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, place (from 0), u, v (digest) and size (code points of the text) of each turn.

    Turns are ordered by number, null first; those of the same number by the
    MD5 of their contents, so that equal rows change nothing. A null role or text is
    empty; rows without a conversation are left out.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    digest = F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")
    items = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), part(1).alias("u"), part(16).alias("v"), F.length(text).cast("bigint").alias("size")
    )
    order = ["turn", "u", "v"]
    counted = _running(_sliced(items.withColumn("one", F.lit(1)), "conv", order), "conv", order, {"place": "one"}, {})
    return counted.select("conv", (F.col("place") - 1).alias("place"), "u", "v", "size")


def branched(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (of ``turns``) and ids of conversations that begin as the conversation with their hundreds.

    Conversation c gets the first h turns of conversation c - c % 100 (all, if
    it has fewer; none, if there is no such one), then its own after its
    first h, where h = crc32 of the decimal id, modulo 6. The remainder has the
    sign of c. A conversation without turns left is in the ids alone.
    """
    items = save(items.withColumn("base", F.col("conv") - F.col("conv") % BRANCH), "turns")
    h = (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % SHARED).cast("bigint")
    ids = items.groupBy("conv", "base").agg(F.count("*").alias("rows"))
    # the beginning of a conversation with a round number: SHARED - 1 turns at most
    heads = items.where((F.col("conv") == F.col("base")) & (F.col("place") < SHARED - 1)).select("base", F.struct("place", "u", "v", "size").alias("head"))
    heads = heads.groupBy("base").agg(F.sort_array(F.collect_list("head")).alias("heads"))
    ids = save(ids.join(heads, "base", "left").withColumn("shared", F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), F.lit(1), h.cast("int"))).drop("heads"), "ids")
    own = lookup(items.where(F.col("place") >= h), ids.select("conv", "rows", F.size("shared").alias("n_shared")), ["conv"])
    own = own.select("conv", (F.col("place") - h + F.col("n_shared")).alias("place"), "u", "v", "size")
    shared = ids.select("conv", F.explode("shared").alias("head")).select("conv", "head.place", "head.u", "head.v", "head.size")
    return own.unionByName(shared), ids.select("conv")


def _ends(ended: DataFrame) -> DataFrame:
    """Digest of the ascending, comma-joined list of ``conv`` for each sequence (x, y, depth) of ``ended``.

    Sorted ranges of all lists become chunks of text; a task hashes the chunks of a list one after the other.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, number = None, [], 0

        def chunk():
            return pa.record_batch([pa.array([v], pa.int64()) for v in (*key, ids[0])] + [pa.array([",".join(map(str, ids))])], names=[*KEY, "first", "list"])

        for batch in batches:
            for *k, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv")), strict=True):
                if ids and (k != key or len(ids) == CHUNK):
                    yield chunk()
                    ids = []
                key = k
                ids.append(conv)
        if ids:
            yield chunk()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row():
            return pa.record_batch([pa.array([v], pa.int64()) for v in key] + [pa.array([state.hexdigest()])], names=[*KEY, "ends_sha256"])

        for batch in batches:
            for *k, text in zip(*(batch.column(c).to_pylist() for c in (*KEY, "list")), strict=True):
                if k != key:
                    if key is not None:
                        yield row()
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if key is not None:
            yield row()

    chunks = ended.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(join, "x bigint, y bigint, depth bigint, first bigint, list string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, "x bigint, y bigint, depth bigint, ends_sha256 string")


def prefix_trie(items: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each node of the trie of all conversations.

    items: conv, place (0, 1, ... within a conversation), u, v, size, as from
    ``turns``; ids: conv, each conversation once, also those without turns.

    A node is a distinct sequence of first turns; the root has none. Returns
    conv_id (least member), depth, parent_conv_id (the parent's conv_id; null for the root), n_convs (members),
    n_children, n_leaves (nodes without children in the subtree, itself
    included), saved_tokens (over the subtree: members less one, times code points of the node's last
    turn) and ends_sha256 (SHA-256 of the ascending, comma-joined members that end here).

    Without conversations there are no nodes; if none has a turn, there is the root alone.
    """
    mixed = items.withColumns({"one": F.lit(1), "p": F.xxhash64("u", "v", "place"), "q": F.xxhash64("v", "place", "u")})
    prefixes = _running(_sliced(mixed, "conv", ["place"]), "conv", ["place"], {"depth": "one", "upto": "size"}, {"x": "p", "y": "q"})
    prefixes = save(prefixes.select("conv", *KEY, "size", "upto", F.col("all_depth").alias("n"), F.col("all_upto").alias("total")), "prefixes")

    # identical conversations: one weighted sequence, known by its least conversation
    zero = F.lit(0).cast("bigint")
    last = prefixes.where("depth = n").select("conv", "x", "y", "n", "total")
    ended = save(ids.join(last, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in ("x", "y", "n", "total")]), "ended")
    sequences = ended.groupBy("x", "y", F.col("n").alias("depth")).agg(F.min("conv").alias("conv"), F.count("*").alias("weight"), F.max("total").alias("total"))
    # the anti-join, as a flag: no proper prefix equals a leaf
    proper = prefixes.where("depth < n").select(*KEY).unionByName(ended.where("n > 0").select(*[zero.alias(c) for c in KEY])).distinct()
    sequences = sequences.join(proper.withColumn("inner", F.lit(True)), KEY, "left").withColumn("leaf", F.col("inner").isNull().cast("int")).drop("inner")
    sequences = save(sequences, "sequences")

    # prefixes of sequences, with the code points from the node to the sequence's end
    named = sequences.select("conv", "weight", "leaf", F.greatest(F.col("depth"), F.lit(1)).alias("rows"))
    paths = lookup(prefixes, named, ["conv"]).select("conv", *KEY, "n", "weight", "leaf", (F.col("total") - F.col("upto") + F.col("size")).alias("rest"))
    roots = sequences.select("conv", *[zero.alias(c) for c in KEY], F.col("depth").alias("n"), "weight", "leaf", F.col("total").alias("rest"))
    paths = save(paths.unionByName(roots), "paths")

    owners = save(paths.groupBy(*KEY).agg(F.min("conv").alias("owner"), F.count("*").alias("rows")), "owners")
    owned = save(lookup(paths, owners, KEY), "owned")
    mine = F.col("owner") == F.col("conv")
    chains = owned.groupBy("conv").agg(
        F.min(F.when(mine, F.col("depth"))).alias("begin"),
        F.max(F.when(mine, F.col("rest"))).alias("chain"),
        F.max_by("owner", F.when(~mine, F.col("depth"))).alias("above"),
        F.count("*").alias("rows"),
    )
    owned = lookup(owned, save(chains, "chains"), ["conv"])
    parent = F.when(F.col("depth") > F.col("begin"), F.col("conv")).otherwise(F.col("above"))
    nodes = owned.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.max(F.when(mine & (F.col("depth") > 0), parent)).alias("parent_conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum(F.when((F.col("depth") + 1 >= F.col("begin")) & (F.col("depth") < F.col("n")), 1).otherwise(0)).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        (F.sum(F.col("weight") * F.col("rest")) - F.sum(F.when(mine, F.col("rest")).otherwise(F.coalesce("chain", zero)))).alias("saved_tokens"),
    )
    ended = ended.withColumnRenamed("n", "depth")
    alone = sequences.where("weight = 1").select(*KEY, F.sha2(F.encode(F.col("conv").cast("string"), "UTF-8"), 256).alias("ends_sha256"))
    shared = _ends(ended.join(sequences.where("weight > 1").select(*KEY), KEY, "left_semi"))
    return nodes.join(alone.unionByName(shared), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.encode(F.lit(""), "UTF-8"), 256)).alias("ends_sha256")
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are."""
    items = save(turns(conversations), "turns")
    return prefix_trie(items, items.select("conv").distinct())


#: crc32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(c::varchar) + 1), lambda i: ascii(substr(c::varchar, i::int, 1))::bigint)),
  lambda s, b: list_reduce(list_prepend(xor(s, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda r, z: xor(r >> 1, (r & 1) * 3988292384::bigint) + z)), 4294967295::bigint)"""

SQL = f"""
with raw as (
  select conv_id c, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) m, length(coalesce(text, ''))::bigint size,
    row_number() over (partition by conv_id order by turn nulls first, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 place
  from conversations where conv_id is not null
), ids as (
  select c, c - c % 100 base, ({_CRC}) % 6 h from (select distinct c from raw)
), rebuilt as (
  select ids.c, 0 own, place, m, size from ids join raw on raw.c = ids.base and place < h
  union all
  select ids.c, 1, place, m, size from ids join raw on raw.c = ids.c and place >= h
), prefixes as (
  select c, size, row_number() over w depth, md5(string_agg(m, ',') over w) k from rebuilt window w as (partition by c order by own, place)
  union all
  select c, 0, 0, '' from ids
), linked as (
  select *, lag(k) over (partition by c order by depth) up, depth = max(depth) over (partition by c) ends from prefixes
), nodes as (
  select k, depth, min(c) conv_id, any_value(up) up, count(*) n_convs, any_value(size) size,
    coalesce(string_agg(case when ends then c::varchar end, ',' order by c), '') ends
  from linked group by k, depth
), children as (
  select up k, count(*) n from nodes where up is not null group by up
), valued as (
  select nodes.*, coalesce(children.n, 0) n_children, (n_convs - 1) * size saved from nodes left join children using (k)
), below as (
  select distinct a.k top, b.k k from linked a join linked b on a.c = b.c and b.depth >= a.depth
), trees as (
  select top k, sum(case when n_children = 0 then 1 else 0 end)::bigint n_leaves, sum(saved)::bigint saved_tokens from below join valued using (k) group by top
)
select v.conv_id, v.depth::bigint depth, p.conv_id parent_conv_id, v.n_convs, v.n_children::bigint n_children, n_leaves, saved_tokens, sha256(v.ends) ends_sha256
from valued v join trees using (k) left join nodes p on p.k = v.up
"""
