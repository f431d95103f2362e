"""The prefix trie of conversations against a plain one."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from edges import CLASHING

from cubeweave.llm import prefix_trie as pt
from cubeweave.llm import tables
from cubeweave.runtime import settings


def table(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return df.select("*", *[F.lit(f"other {name}").alias(name) for name in CLASHING]).repartition(3)


def plain_turns(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found.setdefault(conv, []).append(((turn is not None, turn or 0, digest), role, text))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in found.items()}


def plain_branches(convs):
    return {c: (lambda h: convs.get(c - c % 100, [])[:h] + turns[h:])(zlib.crc32(str(c).encode()) % 6) for c, turns in convs.items()}


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        saved[node] = sum(saved[b] for b in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    rows = []
    for node, convs_of in members.items():
        ends = ",".join(map(str, sorted(c for c in convs_of if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(convs_of), len(node), parent, len(convs_of), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, rows))


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def made_up(rnd, n=300):
    rows = []
    for i in range(n):
        conv = rnd.choice([i, 100 * (i % 7), 5_000_000_000 + i])
        for t in range(rnd.choice([0, 1, 2, 5, 9])):
            rows.append((conv, rnd.choice([t, t, None, 3]), rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a", "bb", "é\U0001f600", None, ""])))
    rows += [(conv, t, "user", "same") for conv in range(1000, 1200) for t in range(4)]
    rows += [(1300, t, "user", f"long {t % 3}") for t in range(700)]
    return rows + [(None, 1, "user", "no conversation")]


@pytest.mark.parametrize("heavy", [tables.HEAVY, 3])
def test_trie_by_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(tables, "HEAVY", heavy)
    monkeypatch.setattr(pt, "CHUNK", 7)
    rows = made_up(random.Random(heavy))
    convs = plain_turns(rows)
    # small ranges stay apart, so that conversations and lists are cut
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "5"}):
        assert got(pt.conversation_trie(table(spark, rows))) == plain_trie(convs)
        assert got(pt.prefix_trie(*pt.branched(pt.turns(table(spark, rows))))) == plain_trie(plain_branches(convs))


def test_trie_at_the_edges(spark):
    assert pt.conversation_trie(table(spark, [(1, 0, "user", "x")]).limit(0)).collect() == []
    assert pt.prefix_trie(*pt.branched(pt.turns(table(spark, [(None, 0, "user", "x")])))).collect() == []
    # the own turns of 1 go (crc32 % 6 = 1) and there is no conversation 0
    rows = [(1, 0, None, None)]
    assert zlib.crc32(b"1") % 6 >= 1
    nodes = pt.prefix_trie(*pt.branched(pt.turns(table(spark, rows)))).collect()
    assert [tuple(r)[:7] for r in nodes] == [(1, 0, None, 1, 0, 1, 0)]
    # a text of a million characters, repeated rows, and a conversation that is a prefix of another
    long = "x" * 1_000_000
    rows = [(7, 0, "user", long), (7, 0, "user", long), (8, 0, "user", long), (9, None, "user", long), (9, 1, "user", "")]
    assert got(pt.conversation_trie(table(spark, rows))) == plain_trie(plain_turns(rows))
