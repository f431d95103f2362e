"""Periodic runs against a plain search."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from edges import frame

from cubeweave.llm import periodic_runs as pr
from cubeweave.llm import queries


def plain_runs(words):
    """Every run by extending each period from each place."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = j
    return sorted((a, b - a, p) for (a, b), p in found.items())


def plain_collapse(words, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *tail, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(plain_collapse(words, runs)))


def made_up(rnd):
    """Random words with repeated pieces of random periods, nested and overlapping."""
    words = []
    while len(words) < rnd.choice([0, 5, 30, 100, 400]):
        piece = [rnd.choice("abcd") + rnd.choice(["", "", "x", "é"]) for _ in range(rnd.choice([1, 2, 3, 5, 7, 8, 9, 16, 17, 31, 40]))]
        words += (piece * rnd.choice([1, 1, 2, 3, 4, 9]))[: rnd.randint(1, 200)]
    return words


def test_runs_by_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([" ", "\n", " \t "]).join(made_up(rnd))) for i in range(600)]
    rows += [(1000 + i, " ".join("ab"[(i >> j) & 1] for j in range(9)) + " z" * i) for i in range(40)]
    got = {r.doc_id: r for r in pr.periodic_runs(frame(spark, rows)).collect()}
    some = 0
    for i, text in rows:
        words = text.split()
        runs = plain_runs(words)
        some += len(runs)
        assert [tuple(r) for r in got[i].runs] == runs, text
        assert got[i].text == plain_collapse(words, runs)
    assert some > 200


def test_query_by_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").where("length(text) < 20000")
    got = sorted(map(tuple, queries.QUERIES["op13_periodic_runs"](spark, sf_dir).join(docs.select("doc_id"), "doc_id", "left_semi").collect()))
    assert got == sorted(plain_row(r.doc_id, r.text) for r in docs.collect())
    assert any(r[1] for r in got)


def test_runs_at_the_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "w"), (5, "w " * 23), (5, "w " * 23), (6, "w " * 24), (None, "w " * 30), (None, None), (30, "é \U0001f600 " * 40)]
    result = pr.digests(pr.periodic_runs(pr.repeating(frame(spark, rows))))
    assert sorted(map(repr, map(tuple, result.collect()))) == sorted(repr(plain_row(i, t)) for i, t in rows)
    assert pr.periodic_runs(frame(spark, rows).limit(0)).collect() == []
    assert {r.doc_id: len(r.runs) for r in pr.periodic_runs(frame(spark, rows).where("doc_id in (5, 6)")).collect()} == {5: 0, 6: 1}


def test_long_texts_take_n_log_n_time():
    """Half a million equal words, a long period, and words without any."""
    import time

    n = 500_000
    number = np.concatenate([np.full(n, 7), np.tile(np.arange(100_000), 5), np.arange(n)]).astype(np.uint64)
    began = time.perf_counter()
    owner, start, size, period = pr.runs_of(number, np.array([0, n, 2 * n, 3 * n]))
    assert time.perf_counter() - began < 60
    assert list(zip(owner, start, size, period)) == [(0, 0, n, 1), (1, 0, n, 100_000)]
