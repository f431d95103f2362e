"""Repeated passages against a plain search."""

from __future__ import annotations

import hashlib
import random

import pytest
from edges import frame

from cubeweave.llm import queries
from cubeweave.llm import repeated_passages as rp


def plain(rows, window=50):
    """(id, n_words, n_removed, kept text) by a table of every window's least document."""
    texts = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    least = {}
    for i, words in texts:
        if i is not None:
            for j in range(len(words) - window + 1):
                key = tuple(words[j : j + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, words in texts:
        gone = set()
        if i is not None:
            for j in range(len(words) - window + 1):
                if least[tuple(words[j : j + window])] < i:
                    gone.update(range(j, j + window))
        out.append((i, len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return sorted(map(repr, out))


def made_up(rnd, n=400):
    """Texts of common passages of many lengths, cut anywhere, in new words; copies, edits, periods, repeated ids."""
    passages = [[f"p{k}w{rnd.randint(0, 60)}" for _ in range(rnd.choice([7, 30, 49, 50, 51, 60, 120, 400]))] for k in range(12)]
    passages.append(["same"] * 300)
    passages.append(["ab", "cd", "ef"] * 70)
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 5)):
            p = rnd.choice(passages)
            a = rnd.choice([0, 0, rnd.randint(0, len(p) // 2)])
            words += p[a : a + rnd.choice([1000, rnd.randint(1, 200)])]
            words += [f"own{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(0, 40))]
        if words and rnd.random() < 0.3:
            words[rnd.randrange(len(words))] = "edit"
        rows.append((rnd.choice([i, i, i, 7, None, 10**12 + i]), rnd.choice([" ", "\n", " \t "]).join(words)))
        if rnd.random() < 0.2:
            rows.append((rnd.choice([i + 1, rows[-1][0]]), rows[-1][1]))
    return rows


def test_automaton_by_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        known, automaton = [], rp.SuffixAutomaton()
        for _ in range(rnd.randint(0, 4)):
            known.append([rnd.choice("abc") for _ in range(rnd.randint(0, 12))])
            automaton.put(known[-1])
        words = [rnd.choice("abcd") for _ in range(20)]
        factors = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i, len(k) + 1)} | {()}
        most = [max(n for n in range(j + 2) if tuple(words[j + 1 - n : j + 1]) in factors) for j in range(len(words))]
        assert automaton.matches(words) == most


@pytest.mark.parametrize("limit", [rp.LIMIT, 3])
def test_passages_by_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(rp, "LIMIT", limit)
    rows = made_up(random.Random(limit))
    got = rp.without_repeats(frame(spark, rows)).collect()
    want = plain(rows)
    assert sorted(repr(tuple(r)) for r in got) == want
    assert sum(r.n_removed > 0 for r in got) > 100
    short = made_up(random.Random(4), 100)
    assert sorted(repr(tuple(r)) for r in rp.without_repeats(frame(spark, short), window=9, gram=3).collect()) == plain(short, 9)


def test_query_by_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    got = sorted(map(repr, map(tuple, queries.QUERIES["op11_repeated_passages"](spark, sf_dir).collect())))
    want = [eval(r) for r in plain([(r.doc_id, r.text) for r in docs.collect()])]
    assert got == sorted(repr((i, n, m, hashlib.sha256(t.encode()).hexdigest())) for i, n, m, t in want)


def test_passages_at_the_edges(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, passage), (4, passage), (5, passage + " end"), (None, passage), (None, None), (0, "é \U0001f600 " * 40), (9, "é \U0001f600 " * 9000)]
    got = rp.without_repeats(frame(spark, rows)).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(rows)
    assert rp.without_repeats(frame(spark, rows).limit(0)).collect() == []
    assert rp.without_repeats(frame(spark, rows[:3])).count() == 3


def test_many_rows_of_one_document_stay_few(spark):
    """A third of all rows under one id and one text, and a phrase that all texts share."""
    phrase = " ".join(f"s{i}" for i in range(30))
    rows = [(1, f"{phrase} " * 3)] * 2000 + [(i, f"a{i} " * 5 + phrase + f" b{i}" * 60) for i in range(2, 3000)]
    got = rp.without_repeats(frame(spark, rows)).collect()
    assert len(got) == len(rows) and {r.n_removed for r in got if r.doc_id == 1} == {0} and {r.n_removed for r in got} == {0}
