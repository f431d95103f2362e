"""Operators that SQL can express, the classifier, the token shards and the pipeline."""

from __future__ import annotations

import collections
import datetime
import glob
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from edges import EDGES, frame
from oracle import compare, connect
from test_exact import brute_components, documents, plain_alignment, plain_personal, plain_terms, plain_words, texts_of

from cubeweave.llm import kernel, personal, quality, queries, rule_classifier, sharding, token_shards, url_lists

tokenizers = pytest.importorskip("public_tokenizers")
MODEL = tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)[0] > 0


def on_edges(spark, sql, df, table="documents"):
    """Rows of the SQL over ``df`` as a table."""
    import duckdb

    con = duckdb.connect()
    con.register(table, df.drop(*[c for c in df.columns if c in ("start", "end")]).toArrow())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return collections.Counter(tuple(sorted(zip(names, map(str, r), strict=True))) for r in cur.fetchall())


def as_text(df):
    return collections.Counter(tuple(sorted(zip(df.columns, map(str, r), strict=True))) for r in df.collect())


def unique_ids(spark):
    """The edge documents with ids of their own: the SQL joins by id."""
    return frame(spark, [(i, t) for i, (_, t) in enumerate(EDGES)])


def test_quality_rules_at_the_edges(spark):
    df = unique_ids(spark)
    assert as_text(quality.digests(df)) == on_edges(spark, quality.SQL, df)
    assert as_text(quality.digests(frame(spark).where("doc_id = 5"))).most_common(1)[0][1] == 2
    assert quality.digests(df.limit(0)).collect() == []
    assert quality.passing(frame(spark)).columns == frame(spark).columns


def test_a_filter_on_the_verdict_makes_no_column_twice(spark):
    plan = quality.passing(frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2 and plan.index("Filter") < plan.index("Generate")


def test_quality_counts_by_hand(spark):
    r = quality.quality_rules(frame(spark).where("doc_id in (10, 11)")).orderBy("doc_id").collect()
    assert (r[0].n_dup_lines, r[0].n_symbols) == (1, 3)
    assert r[0].clean_text == "line one is here.\nlast line, with a stop."
    assert (r[1].n_words, r[1].n_repeat_words, r[1].base_failed) == (12, 12, True)


def test_repeated_windows_by_brute_force(spark):
    import random

    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 30)))) for i in range(300)]
    got = {r.doc_id: r.n_repeat_words for r in quality.quality_rules(frame(spark, rows)).collect()}
    for i, text in rows:
        w = text.split()
        grams = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        n = collections.Counter(grams)
        assert got[i] == len({j + k for j, g in enumerate(grams) if n[g] > 1 for k in range(5)})


def test_clean_documents_stay_and_junk_goes(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.quality_rules(documents(spark, sf_dir)).join(labels, "doc_id").collect()
    assert all(r.kept or r.n_words < quality.LEAST_WORDS for r in rows if r.quality == 1)
    assert not any(r.kept for r in rows if r.quality == 0)


@pytest.mark.parametrize("limit", [700, 20_000])
def test_shards_equal_sql(spark, limit, monkeypatch):
    df = unique_ids(spark).unionByName(frame(spark, [(i, "text " * (i % 60)) for i in range(100, 900)]))
    sql = sharding.SQL.replace(str(sharding.LIMIT), str(limit))
    got = sharding.shards(df, limit=limit)
    assert as_text(got) == on_edges(spark, sql, df)
    assert got.where("not fits").groupBy("shard").count().where("count > 1").count() == 0
    assert got.groupBy("shard").agg({"bytes": "sum"}).where(f"`sum(bytes)` > {limit}").count() == got.where("not fits").select("shard").distinct().count()


def test_a_hot_key_is_split_and_equal_rows_stay_together(spark):
    rows = [(i, f"text number {i:06d}") for i in range(600)] + [(7000, "same")] * 30 + [(None, None)] * 3
    df = frame(spark, rows)
    got = sharding.shards(df, key_col="n", limit=100).collect()  # column n has one value
    assert len(got) == len(rows) and max(r.shard_bytes for r in got if r.fits) <= 100
    assert {r.shard_rows for r in got if not r.fits} == {30}
    assert sharding.shards(df.limit(0)).collect() == []


def test_written_shards(spark, sf_dir, tmp_path):
    docs = documents(spark, sf_dir)
    sharding.write_shards(docs, str(tmp_path / "s"), limit=50_000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count()
    placed = sharding.shards(docs, limit=50_000).select("doc_id", "shard")
    assert back.join(placed, "doc_id").where("_shard <> concat('s', shard)").count() == 0


def test_lists_as_of_fetch_time(spark):
    day = datetime.date
    entries = spark.createDataFrame(
        [
            ("spam", "example.com", day(2024, 1, 1), True),
            ("spam", "example.com", day(2024, 2, 1), False),
            ("spam", "example.com", day(2024, 3, 1), True),
            ("spam", "Example.com", day(2024, 3, 5), True),
            ("adult", "www.example.com/a/b/", day(2024, 1, 1), True),
            ("allow", "www.example.com/a", day(2024, 1, 1), True),
            ("malware", "same.org", day(2024, 1, 1), True),
            ("malware", "same.org", day(2024, 1, 1), False),
            ("spam", None, day(2024, 1, 1), True),
            ("spam", "", day(2024, 1, 1), True),
            (None, "org", day(2024, 1, 1), True),
            ("spam", "late.net", None, True),
        ],
        "list string, pattern string, dated date, listed boolean",
    )
    cases = [
        ("http://example.com/x", day(2024, 1, 15), "spam example.com", None, False),
        ("http://example.com/x", day(2023, 12, 31), None, None, True),
        ("http://example.com/x", day(2024, 2, 1), None, None, True),
        ("https://user@WWW.Example.com.:8080/x?q=1#f", day(2024, 3, 1), "spam example.com", None, False),
        ("https://www.example.com/a", day(2024, 3, 6), "spam example.com", "allow www.example.com/a", True),
        ("https://www.example.com/a/b/c", day(2024, 3, 6), "adult www.example.com/a/b", "allow www.example.com/a", False),
        ("https://www.example.com/ab", day(2024, 2, 6), None, None, True),
        ("http://notexample.com/", day(2024, 1, 15), None, None, True),
        ("http://same.org", day(2024, 1, 15), None, None, True),
        ("http://late.net/", day(2024, 1, 15), None, None, True),
        ("no url", day(2024, 1, 15), None, None, True),
        ("", day(2024, 1, 15), None, None, True),
        (None, day(2024, 1, 15), None, None, True),
        ("http://example.com/x", None, None, None, True),
        ("http://example.com/" + "p/" * 300, day(2024, 1, 15), "spam example.com", None, False),
    ]
    captures = spark.createDataFrame([(i, u, d, "clash", "clash") for i, (u, d, *_) in enumerate(cases)] * 2, "id int, url string, fetched date, host string, key string")
    got = {r.id: (r.blocked_by, r.allowed_by, r.kept) for r in url_lists.filter_urls(captures, entries).collect()}
    assert got == {i: tuple(c[2:]) for i, c in enumerate(cases)}
    assert url_lists.filter_urls(captures, entries).count() == len(cases)
    assert url_lists.filter_urls(captures, entries.limit(0)).where("not kept").count() == 0
    assert url_lists.filter_urls(captures.limit(0), entries).collect() == []


def test_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = rule_classifier.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = rows.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    pairs = [(a > b) + (a == b) / 2 for a in good for b in bad]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held) and sum(pairs) >= 0.97 * len(pairs)


def test_classifier_at_the_edges(spark):
    labels = spark.createDataFrame([(5, 1), (9, None), (4, 3), (None, 0)], "doc_id bigint, quality int").selectExpr("*", "'x' AS score")
    rows = rule_classifier.classify(frame(spark), labels).collect()
    assert len(rows) == len(EDGES) and len({r.score for r in rows}) == 1
    assert {r.score for r in rule_classifier.classify(frame(spark), labels.limit(0)).collect()} == {0.5}
    assert rule_classifier.classify(frame(spark).limit(0), labels).collect() == []
    both = spark.createDataFrame([(i, int(i % 2)) for i in range(200)] * 2, "doc_id bigint, quality int")
    docs = frame(spark, [(i, "good words here. " * 9 if i % 2 else "BAD!! | " * (9 + i % 4)) for i in range(200)] + EDGES)
    rows = rule_classifier.classify(docs, both).where("doc_id between 20 and 199").collect()
    assert all(r.predicted == r.doc_id % 2 for r in rows)


def test_scores_use_rules_over_statistics_only(spark):
    names = rule_classifier.statistics(frame(spark))[1]
    rule = ((names[0], True, 3.5), (names[1], False, 2.0))
    model = rule_classifier.RuleModel(((rule, 2.0),), -1.0)
    df = spark.createDataFrame([(3.0, 2.5), (3.0, 2.0), (4.0, 9.0)], f"{names[0]} double, {names[1]} double")
    got = [r.s for r in df.select(model.score().alias("s")).collect()]
    assert got == pytest.approx([1 / (1 + np.exp(-1)), 1 / (1 + np.e), 1 / (1 + np.e)])


def test_permutation_is_one_to_one_and_keyed():
    for domain in (1, 2, 3, 7, 64, 1000, 4097):
        p = token_shards.feistel(np.arange(domain), domain, 5)
        assert sorted(p.tolist()) == list(range(domain))
    a, b = (token_shards.feistel(np.arange(5000), 5000, key) for key in (1, 2))
    assert (a != b).mean() > 0.99 and abs(np.corrcoef(np.arange(5000), a)[0, 1]) < 0.05


@pytest.mark.parametrize("edges", [False, True])
def test_token_shards_round_trip(spark, sf_dir, tmp_path, edges, monkeypatch):
    """All ids come back, in the order of the permutation, with the ids of their documents."""
    monkeypatch.setattr(kernel, "BLOCK", 30_000)
    if edges:
        frame(spark).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs")) if edges else documents(spark, sf_dir)
    length, span, key, path = 64, 50, 9, str(tmp_path / "shards")
    rows = token_shards.write_token_shards(docs, MODEL, path, key, length=length, span=span).collect()
    form = token_shards.width(MODEL)
    model = token_shards.encoder(MODEL).model

    slim = docs.select("doc_id", "text")
    first = token_shards._bounds(slim, length)
    from pyspark.sql import functions as F

    parts = collections.defaultdict(list)
    for r in slim.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"), "*").orderBy("m").collect():
        parts[r.p].append((r.doc_id, model.encode(r.text or "", add_bos=True, add_eos=True)))
    want = []
    for p, members in parts.items():
        ids = [i for _, x in members for i in x]
        owner = [d for n, (d, x) in enumerate(members) for _ in x]
        order = [n for n, (_, x) in enumerate(members) for _ in x]
        for k, at in enumerate(range(0, len(ids), length)):
            seen = dict(zip(order[at : at + length], owner[at : at + length], strict=True))
            want.append((int(token_shards.feistel(np.array([first[p] + k]), first[-1], key)[0]), ids[at : at + length], list(seen.values())))
    want.sort(key=lambda w: w[0])
    rows.sort(key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(want)))
    for r, (place, ids, owners) in zip(rows, want, strict=True):
        whole = token_shards.read_rows(path, r.shard, r.row, 1, form, length)[0]
        assert r.shard == place // span and whole[: r.n_tokens].tolist() == ids and not whole[r.n_tokens :].any()
        assert list(r.docs) == owners and r.crc32 == zlib.crc32(whole.tobytes())
    # slots are read across shards, and reading goes on in the middle of one
    every = [token_shards.read_rows(path, r.shard, r.row, 1, form, length)[0].tolist() for r in rows]
    for first, n in ((0, len(rows)), (span // 2, span), (len(rows) - 3, 100), (7, 0)):
        assert [x.tolist() for part in token_shards.read_slots(path, first, n, form, length) for x in part] == every[first : first + n]
    files = glob.glob(path + "/shard-*")
    assert not glob.glob(path + "/part-*")
    assert {os.path.basename(f) for f in files} == {f"shard-{s:08d}.bin" for s in {r.shard for r in rows}}
    assert sum(map(os.path.getsize, files)) == len(rows) * length * form.itemsize


def test_token_shards_of_an_empty_table(spark, tmp_path):
    assert token_shards.write_token_shards(frame(spark).limit(0), MODEL, str(tmp_path / "none"), 1).collect() == []


def clean_lines(text):
    """The distinct lines that pass the rules of lines."""
    import regex

    out = []
    for line in dict.fromkeys(text.split("\n")):
        words = re.findall("[^\x20\x09-\x0D]+", line)
        symbols = sum(c in quality.SYMBOLS for c in line)
        many = len(words) >= quality.SHORT_LINE
        shouting = many and regex.search(r"\p{Lu}", line) and not regex.search(r"\p{Ll}", line)
        fragment = not many and not re.search("[.!?:;]", line)
        noisy = symbols * 100 > sum(map(len, words)) * quality.MOST_SYMBOLS
        if words and not (shouting or fragment or noisy or any(p in line.lower() for p in quality.BOILERPLATE)):
            out.append(line)
    return "\n".join(out)


def test_two_texts_of_one_id_both_stay(spark, sf_dir):
    import corpus_pipeline

    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(1, one), (1, two), (1, two), (2, one + " more"), (2, three), (3, three), (1, two + " x")]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars")
    got = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.one_of_each(spark, docs, sf_dir).collect())
    assert set(got.values()) == {1} and {d for d, _ in got} == {1, 2} and len(got) == 3
    assert (1, one) in got and (2, three) in got and ((1, two) in got) != ((1, two + " x") in got)


def test_many_rows_of_one_id_take_linear_time(spark):
    import time

    from cubeweave.llm import near_dedup

    rows = [(7, f"words of row {i} and {i * 7919} more {i % 13} text here") for i in range(20_000)]
    began = time.perf_counter()
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {7}
    assert time.perf_counter() - began < 120


def plain_pipeline(spark, sf_dir, docs):
    """All stages by plain means: rows (doc_id, text) that reach the last one."""
    import hashlib

    judged = {hashlib.md5((t or "").encode()).digest(): None for _, t in docs}
    frame_ = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id bigint, text string")
    verdict = {r[0]: r[1] for r in _sql(spark, frame_)}
    del judged
    rows = [(d, clean_lines(t)) for i, (d, t) in enumerate(docs) if verdict[i]]
    groups = brute_components(rows, 5, 80)
    stays = {d for d, _, c in groups if d == c and d is not None}
    seen, left = set(), []
    for d, t in rows:
        if d is None or (d in stays and d not in seen):
            seen.add(d)
            left.append((d, t))
    items = [plain_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = [{tuple(x[i : i + 6]) for i in range(len(x) - 5)} for x in items]

    def leaks(text):
        words = plain_words(text)
        mine = {tuple(words[i : i + 6]) for i in range(len(words) - 5)}
        return any(g & mine and plain_alignment(x, words) >= len(x) for g, x in zip(grams, items, strict=True))

    left = [(d, t) for d, t in left if not leaks(t)]
    out = []
    for (d, t), terms in zip(left, plain_terms([t for _, t in left]), strict=True):
        found = [(a, b, k) for k, s in plain_personal(t).items() for a, b in s] + [(a, b, k) for (a, b), k in terms.items()]
        found += [(a, b, k) for k, find in personal.INSIDE.items() for a, b in find(t)]
        at, text = 0, ""
        for a, b, k in sorted(found):
            if a >= at:
                broad = "[NUMBER]" if re.fullmatch("[0-9]+", t[a:b]) else "[NAME]" if t[a].isupper() else "[TERM]"
                text += t[at:a] + personal.INSTEAD.get(k, broad)
            at = max(at, b)
        out.append((d, text + t[at:]))
    return out


def _sql(spark, df):
    import duckdb

    con = duckdb.connect()
    con.register("documents", df.toArrow())
    return con.execute(f"SELECT doc_id, kept FROM ({quality.SQL})").fetchall()


def test_pipeline_equals_plain_stages(spark, sf_dir):
    import corpus_pipeline

    model = token_shards.encoder(MODEL).model
    want = collections.Counter()
    for d, t in plain_pipeline(spark, sf_dir, texts_of(spark, sf_dir)):
        want[d, np.array(model.encode(t, add_bos=True, add_eos=True), "<u4").tobytes()] += 1
    got = collections.Counter((r.doc_id, bytes(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == want


def test_stages_at_the_edges(spark, sf_dir):
    import corpus_pipeline

    shape = "'en' AS lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars"
    for rows in (EDGES, []):
        docs = frame(spark, rows).selectExpr("doc_id", "text", *shape, "'x' AS digest", "'x' AS kept")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == corpus_pipeline.COLUMNS, name
            ids = collections.Counter(r.doc_id for r in out.collect())
            assert set(ids) <= {d for d, _ in rows}
            if name == "near duplicates" and rows:
                assert ids[5] == 1 and ids[6] == 0 and ids[None] == 2 and ids[1] == ids[2] == 1
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)


def test_stages_are_the_five():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "benchmark decontamination", "personal data", "sentencepiece"]
    assert pa.__version__
