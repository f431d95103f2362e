"""Operators against plain versions of what they compute."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from edges import EDGES, PASSAGE, frame

from cubeweave.llm import decontaminate, kernel, near_dedup, personal, secrets, sentencepieces

tokenizers = pytest.importorskip("public_tokenizers")
MODEL = tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(spark, sf_dir):
    return [(r.doc_id, r.text) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]


# words and shingles


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words)} - {()} if len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_shingle_sets_tell_texts_apart_like_tuples(monkeypatch):
    rnd = random.Random(1)
    texts = [t for _, t in EDGES] + ["".join(rnd.choice("aB \n\té.") for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    monkeypatch.setattr(kernel, "BLOCK", 200)
    sets = list(kernel.shingle_sets(pa.array(texts), 3))
    plain = [shingles(t, 3) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    number = {}
    for s, p in zip(sets, plain, strict=True):
        assert number.setdefault(s.tobytes(), p) == p
    for a, b in ((5, 6), (5, 7), (30, 31), (40, 90)):
        assert len(np.intersect1d(sets[a], sets[b])) == len(plain[a] & plain[b])


# SentencePiece


def encoded(model, texts):
    for text in texts:
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        yield len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_encoding_equals_the_library(spark, sf_dir):
    model = sentencepieces.Encoder(MODEL).model
    for df in (documents(spark, sf_dir), frame(spark)):
        rows = df.select("doc_id", "text").collect()
        want = collections.Counter(zip([r.doc_id for r in rows], encoded(model, [r.text for r in rows]), strict=True))
        got = collections.Counter((r.doc_id, (r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in sentencepieces.digests(df, MODEL).collect())
        assert got == want


def test_parts_of_odd_texts(monkeypatch):
    coder = sentencepieces.Encoder(MODEL)
    assert coder.split
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 50)
    rnd = random.Random(2)
    for _ in range(60):
        texts = ["".join(rnd.choice(["a", " ", "  ", "\n", "▁", "é", "the", "\t", "�", "<s>", "中", "\x00"]) for _ in range(rnd.randint(0, 30))) for _ in range(20)]
        ids, begin = coder.encode(pa.array(texts))
        assert [ids[begin[i] : begin[i + 1]].tolist() for i in range(20)] == coder.model.encode(texts)


def test_a_model_with_crossing_pieces_is_used_whole():
    coder = sentencepieces.Encoder(MODEL)
    coder.split = False
    ids, begin = coder.encode(pa.array(["a b", None, "c"]))
    assert [ids[begin[i] : begin[i + 1]].tolist() for i in range(3)] == coder.model.encode(["a b", "", "c"])


def test_decoding_alone_gives_the_same(spark):
    both = sentencepieces.encode(frame(spark), MODEL, decoded=True)
    alone = sentencepieces.decode(sentencepieces.encode(frame(spark), MODEL), MODEL)
    assert collections.Counter(map(tuple, alone.collect())) == collections.Counter(map(tuple, both.collect()))
    bare = {r.doc_id: bytes(r.ids) for r in sentencepieces.encode(frame(spark), MODEL, ends=False).collect()}
    assert bare[2] == b"" and len(bare[4]) == 4


def test_encoding_an_empty_table(spark):
    assert sentencepieces.digests(frame(spark).limit(0), MODEL).collect() == []


# near duplicates


def brute_components(rows, size, percent):
    """Component of each row by comparing all sets that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for j, both in collections.Counter(j for v in s for j in holders[v]).items():
            if both * 100 >= percent * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
        for v in s:
            holders[v].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return collections.Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def found_components(df, size, percent):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, size=size, percent=percent).collect())


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, sf_dir, size, percent):
    assert found_components(documents(spark, sf_dir), size, percent) == brute_components(texts_of(spark, sf_dir), size, percent)


def test_near_duplicates_at_the_edges(spark):
    assert found_components(frame(spark), 3, 85) == brute_components(EDGES, 3, 85)
    kept = {r.doc_id: r.kept for r in near_dedup.near_duplicates(frame(spark), size=3, percent=85).where("doc_id is not null").collect()}
    assert kept[5] and not kept[6] and kept[1] and kept[2]
    assert near_dedup.near_duplicates(frame(spark).limit(0)).collect() == []


def test_a_large_group_of_edited_copies(spark, monkeypatch):
    """Long lists: most members link to the hub, some only to each other, some to none."""
    monkeypatch.setattr(near_dedup, "SHORT", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(160)]
    rows = []
    for i in range(140):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3, 5, 8, 9])):
            words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 30)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(base[:60] + [f"y{i}.{j}" for j in range(90)])) for i in range(40)]
    assert found_components(frame(spark, rows), 3, 85) == brute_components(rows, 3, 85)


def test_long_chains_are_one_component(spark):
    from cubeweave.llm.graph import components

    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 102), (102, 103), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 102, 103: 102}


# decontamination


def plain_alignment(item, passage):
    best, above = 0, [0] * (len(passage) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(passage, 1):
            row.append(max(0, above[j - 1] + (2 if a == b else -1), above[j] - 1, row[j - 1] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_the_textbook():
    rnd = random.Random(4)
    for _ in range(300):
        a, b = ([rnd.randint(0, 4) for _ in range(rnd.randint(1, 12))] for _ in range(2))
        score, x, y = decontaminate.align(np.array(a), np.array(b))
        assert score == plain_alignment(a, b)
        assert plain_alignment(a, b[x:y]) == score


def plain_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def test_passages_equal_brute_force(spark, sf_dir):
    items = [(1, PASSAGE), (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (3, "too short"), (4, None), (5, "")]
    rnd = random.Random(5)
    filler = [f"f{i}" for i in range(50)]
    rows = list(EDGES)
    for i in range(60):
        words = plain_words(items[i % 2][1])
        for _ in range(rnd.choice([0, 1, 2, 4, 7])):
            k = rnd.randrange(len(words))
            words[k : k + 1] = rnd.choice([[], ["changed"], [words[k], "added"]])
        if i % 5 == 0:
            words = words[: len(words) * 2 // 3]
        rows.append((100 + i, " ".join(rnd.choices(filler, k=rnd.randint(0, 40)) + words + rnd.choices(filler, k=20))))
    df = frame(spark, rows)
    targets = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS item", "'x' AS words")
    got = decontaminate.contaminated(df, targets).collect()
    want = set()
    for d, text in rows:
        for item, target in items:
            target = plain_words(target)
            if len(target) >= decontaminate.GRAM and (score := plain_alignment(target, plain_words(text)[:12_000])) >= len(target):
                want.add((d, item, score / (2 * len(target))))
    # a run of GRAM + WINDOW - 1 equal words has a seed; what has none may be missed
    missed = want - {(r.doc_id, r.item_id, r.score) for r in got}
    longest = {d: text for d, text in rows}
    for d, item, _ in missed:
        a, b = plain_words(dict(items)[item]), plain_words(longest[d])
        n = decontaminate.GRAM + decontaminate.WINDOW - 1
        assert not {tuple(a[i : i + n]) for i in range(len(a) - n + 1)} & {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
    assert {(r.doc_id, r.item_id, r.score) for r in got} <= want and len(missed) < len(want) / 10
    for r in got:
        if r.score == 1:
            text = next(t for d, t in rows if d == r.doc_id and t and plain_words(t))
            assert plain_words(text[r.start : r.end]) == plain_words(dict(items)[r.item_id])


def test_partial_leaks_of_long_items(spark):
    """Parts of an item that are long by themselves are found, whatever share of it they are; short ones are not."""
    item = [f"w{i}" for i in range(200)]
    around = [f"f{i}" for i in range(300)]
    quote = lambda words: " ".join([*around, *words, *around])
    edited = [*item[10:30], "changed", *item[31:41]]
    rows = [(1, quote(item[50:140])), (2, quote(item[20:33])), (3, quote(item[20:32])), (4, quote(edited)), (5, quote(item)), (6, quote([])), (7, quote([f"v{i}" for i in range(30, 59)]))]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(f"v{i}" for i in range(59)))], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    assert {k: r.points for k, r in got.items()} == {(1, 1): 180, (2, 1): 26, (4, 1): 59, (5, 1): 400, (7, 2): 58}
    assert got[1, 1].score == 0.45 and got[5, 1].score == 1
    assert rows[0][1][got[1, 1].start : got[1, 1].end] == " ".join(item[50:140])


def test_exact_leaks_are_found(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    inside = {(d, i.item_id) for d, t in texts_of(spark, sf_dir) for i in items.collect() if i.text in t}
    got = decontaminate.contaminated(documents(spark, sf_dir), items).collect()
    assert inside <= {(r.doc_id, r.item_id) for r in got}
    assert decontaminate.contaminated(documents(spark, sf_dir), items.limit(0)).collect() == []
    assert decontaminate.contaminated(documents(spark, sf_dir).limit(0), items).collect() == []


def test_groups_of_items_give_the_same(spark, sf_dir, monkeypatch):
    items, docs = spark.read.parquet(f"{sf_dir}/benchmark.parquet"), documents(spark, sf_dir)
    want = collections.Counter(decontaminate.contaminated(docs, items).collect())
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 500)
    assert collections.Counter(decontaminate.contaminated(docs, items).collect()) == want


# personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and plain_luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }


def test_patterns_of_personal_data_on_odd_texts():
    rnd = random.Random(6)
    for _ in range(20_000):
        text = "".join(rnd.choice("a1@.+ -(%_5:9@.1") for _ in range(rnd.randint(1, 40)))
        assert {k: list(f(text)) for k, f in personal.FIND.items()} == plain_personal(text)


def test_patterns_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + "(" * 300_000, "1 " * 150_000):
        for find in personal.FIND.values():
            list(find(text))


def test_personal_data_equals_brute_force(spark, sf_dir):
    for df in (documents(spark, sf_dir), frame(spark)):
        rows = df.select("doc_id", "text").collect()
        want = collections.Counter((r.doc_id, ",".join(f"{k}:{a}:{b}" for k, s in plain_personal(r.text or "").items() for a, b in s)) for r in rows)
        got = personal.personal_data(df).collect()
        assert collections.Counter((r.doc_id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans)) for r in got) == want


def test_values_that_stand_next_to_each_other(spark):
    text = "x +1 (269) 555-3296 4524132264652876 y 7536784127813050 4845168114407329 z 1 2 3 4 5 6 7 8 9 10 11 12 13 14 +1 (826) 555-4081 190.137.223.204"
    r = personal.personal_data(frame(spark, [(1, text)])).first()
    assert [(s.kind, text[s.start : s.end]) for s in r.spans] == [("ip", "190.137.223.204")]
    assert {(s.kind, text[s.start : s.end]) for s in r.added} == {
        ("card", "4524132264652876"), ("card", "7536784127813050"), ("card", "4845168114407329"), ("phone", "+1 (269) 555-3296"), ("phone", "+1 (826) 555-4081"),
    }
    clean = personal.sanitise(frame(spark, [(1, text)])).first().text
    assert clean.startswith("x [PHONE] [CARD] y [CARD] [CARD] z 1 2 3") and clean.endswith("14 [PHONE] [IP]")


def plain_terms(texts):
    """For each text the places of terms that reveal an entity, by counts over whole texts: (start, end) -> kind."""
    import math

    rows = []
    for text in texts:
        text = text or ""
        spans = [(k, a, b) for k, found in plain_personal(text).items() for a, b in found]
        spans += [(k, a, b) for k, find in personal.INSIDE.items() for a, b in find(text)]
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", text)]
        free = [w for w in words if not any(w[1] > a and w[0] < b for _, a, b in spans)]
        near = set()
        for k, a, b in spans:
            value = text[a:b].lower() if k in ("email", "ip") else re.sub("[^0-9]", "", text[a:b])
            before, after = [w for w in free if w[1] <= a], [w for w in free if w[0] >= b]
            near |= {((k, value), w[2]) for w in before[-personal.NEAR :] + after[: personal.NEAR]}
        rows.append((free, {w[2] for w in words}, near))
    with_term = collections.Counter(t for _, every, _ in rows for t in every)
    with_entity = collections.Counter(e for _, _, near in rows for e in {e for e, _ in near})
    kinds = {}
    for pair, j in collections.Counter(p for _, _, near in rows for p in near).items():
        n, n_e, total = with_term[pair[1]], with_entity[pair[0]], len(texts)
        if n_e < total:
            p = j / n
            surely = (p + 1 / (2 * n) - math.sqrt(p * (1 - p) / n + 1 / (4 * n * n))) / (1 + 1 / n)
            share = math.log(surely * total / n_e) / math.log(total / n_e)
            kinds[pair] = "remove" if share >= personal.REMOVE else "generalise" if share >= personal.GENERALISE else None
    out = []
    for free, _, near in rows:
        entities = {e for e, _ in near}
        found = {(a, b): [kinds.get((e, t)) for e in entities] for a, b, t in free}
        out.append({place: max(filter(None, ks)) for place, ks in found.items() if any(ks)})
    return out


def test_terms_equal_brute_force(spark, sf_dir):
    some = False
    for df in (documents(spark, sf_dir), frame(spark)):
        rows = df.select("doc_id", "text").collect()
        want = [(r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest(), sorted((a, b, k) for (a, b), k in t.items())) for r, t in zip(rows, plain_terms([r.text for r in rows]), strict=True)]
        got = [(r.doc_id, r.digest, [(s.start, s.end, s.kind) for s in r.added if s.kind in ("remove", "generalise")]) for r in personal.personal_data(df).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        some |= any(w[2] for w in want)
    assert some


def test_entities_of_one_and_two_documents(spark):
    rows = [(i, f"common words of thing {i % 5} and more words") for i in range(500)]
    rows += [(600, "ask Quillon 4711 at quill@example.com for words"), (601, "Ondine writes to ond@example.com of thing 1"), (602, "more words of Ondine and ond@example.com")]
    clean = {r.doc_id: r.text for r in personal.sanitise(frame(spark, rows)).where("doc_id >= 600").collect()}
    assert "Quillon" not in clean[600] and "4711" not in clean[600] and clean[600].endswith("words") and "Ondine" not in clean[601] + clean[602]
    # the classes of what is generalised
    wide = [(i, f"{'Tamsin 1234 quaint' if i < 2 else 'plain'} {'tam@example.com' if i < 2 else 'words'}") for i in range(60)]
    assert {r.text for r in personal.sanitise(frame(spark, wide)).where("doc_id < 2").collect()} == {"[NAME] [NUMBER] [TERM] [EMAIL]"}


def test_revealing_terms(spark):
    """A name that comes only with one address goes; a common word beside it stays."""
    rnd = random.Random(7)
    rows = [(i, f"please write to Zebulon at zeb@example.com about item {i}") for i in range(5)]
    rows += [(100 + i, f"please write to us about thing {i} " + " ".join(rnd.choices(["at", "item", "many", "words"], k=12))) for i in range(400)]
    rows += [(900, "Zebulon is no secret here"), (901, None)]
    got = {r.doc_id: r.added for r in personal.personal_data(frame(spark, rows)).collect()}
    text = dict(rows)[0]
    assert [(s.kind, text[s.start : s.end]) for s in got[0]] == [("generalise", "Zebulon")]
    assert not any(got[d] for d in got if d >= 100)
    clean = {r.doc_id: r.text for r in personal.sanitise(frame(spark, rows)).collect()}
    assert clean[0] == "please write to [NAME] at [EMAIL] about item 0"
    assert clean[900] == "Zebulon is no secret here" and clean[901] is None


def test_revealing_terms_far_from_the_entity(spark):
    """All places of a term go in a document that has the entity, however far from it; other documents keep it."""
    rnd = random.Random(7)
    far = " ".join(f"f{i}" for i in range(60))
    rows = [(i, f"Zebulon, é {far} then zebulon wrote zeb@example.com about item {i} {far} ZEBULON") for i in range(5)]
    rows += [(100 + i, "we write about then thing " + " ".join(rnd.choices([*far.split(), "wrote", "item"], k=200))) for i in range(400)]
    rows += [(900, f"Zebulon {far} but other@example.com"), (0, rows[0][1])]
    clean = collections.Counter((r.doc_id, r.text) for r in personal.sanitise(frame(spark, rows)).collect())
    assert clean[0, f"[REMOVED], é {far} then [REMOVED] wrote [EMAIL] about item [REMOVED] {far} [REMOVED]"] == 2
    assert clean[900, f"Zebulon {far} [TERM] [EMAIL]"] == 1


def test_information_is_as_defined(spark, sf_dir):
    """Shares of information by hand, from all texts."""
    import math

    rows = [(i, f"{'alpha' if i < 5 else 'beta'} common {'x@y.zz' if i < 4 else ''} end") for i in range(40)]
    found = {(s.kind, dict(rows)[r.doc_id][s.start : s.end]) for r in personal.personal_data(frame(spark, rows)).collect() for s in r.added}
    surely = (4 / 5 + 1 / 10 - math.sqrt(4 / 5 * 1 / 5 / 5 + 1 / 100)) / (1 + 1 / 5)
    share = math.log(surely * 40 / 4) / math.log(40 / 4)
    assert personal.GENERALISE <= share < personal.REMOVE
    assert found == {("generalise", "alpha")}


def test_sanitising_keeps_columns_and_rows(spark):
    df = frame(spark)
    out = personal.sanitise(df)
    assert out.columns == df.columns and out.count() == df.count()
    text = out.where("doc_id = 12").first().text
    assert "[EMAIL] [IP] [PHONE] or [CARD]" in text
    assert personal.personal_data(df.limit(0)).collect() == []


# secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def plain_secrets(text):
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_secrets_equal_brute_force(spark, sf_dir):
    for df in (documents(spark, sf_dir), frame(spark)):
        want = collections.Counter((r.doc_id, tuple(plain_secrets(r.text or ""))) for r in df.select("doc_id", "text").collect())
        assert collections.Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in secrets.find_secrets(df).collect()) == want
    assert secrets.find_secrets(frame(spark).limit(0)).collect() == []


def test_secrets_of_odd_texts():
    rnd = random.Random(8)
    parts = ["password", "token", "api_key", "APIkey", "=", ":", " ", '"', "'", "abc", "AKIA", "AKIAABCDEFGH0123", "ABCDEFGH", "0123abcdef", "ffffffffffff", "é", "-", "\n", "%41", "ſecret"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12)))
        assert secrets.secrets_of(text)[0] == plain_secrets(text)


def wrapped(kind, text):
    import base64
    import bz2
    import gzip
    import lzma
    import urllib.parse
    import zlib

    import zstandard

    packers = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "zstd": zstandard.compress, "base64": bytes}
    if kind == "url":
        return urllib.parse.quote(text, safe="")
    if kind == "escape":
        return "".join(f"\\u{ord(c):04x}" for c in text)
    return base64.b64encode(packers[kind](text.encode())).decode()


@pytest.mark.parametrize("kinds", [[k] for k in ("url", "escape", "base64", "gzip", "zlib", "bz2", "xz", "zstd")] + [["gzip", "url", "base64"], ["base64", "gzip", "escape", "zstd"]])
def test_secrets_inside_layers(kinds):
    inner = "password = hunter2222"
    for kind in kinds:
        inner = wrapped(kind, inner)
    text = f"é before {inner} after"
    base, added, refused = secrets.secrets_of(text)
    assert base == plain_secrets(text) and refused == 0
    spans = [s for s in added if s[0] == "assign"]
    at = text.index(inner)
    assert spans and all(at <= a < b <= at + len(inner) for _, a, b, _ in spans)


def test_parts_of_a_layer_map_to_their_place():
    text = "note token = %41%42%43%44%45%46%47 and more"
    _, added, _ = secrets.secrets_of(text)
    assert [(k, text[a:b], p) for k, a, b, p in added] == [("assign", "token = %41%42%43%44%45%46%47", "url")]


def test_a_layer_that_holds_itself_ends(monkeypatch):
    fixed = "AAAA" * 5
    monkeypatch.setitem(secrets.DECODERS, "base64", lambda text: iter([(0, len(text), fixed, np.zeros(20, dtype=int), np.full(20, len(text)))]))
    assert secrets.secrets_of("token=abcdefgh " + fixed)[0]


def test_a_block_that_grows_too_large_is_counted(monkeypatch):
    monkeypatch.setattr(secrets, "MOST_INFLATED", 1000)
    _, added, refused = secrets.secrets_of(wrapped("gzip", "a" * 5000))
    assert refused == 1 and added == []


def test_a_large_block_hides_nothing(monkeypatch):
    """Blocks beside a large one are unwrapped; the large ones are read in parts, also inside each other."""
    monkeypatch.setattr(secrets, "IN_PLACE", 3000)
    monkeypatch.setattr(secrets, "PART", 500)
    monkeypatch.setattr(secrets, "SHARED", 100)
    small, late = wrapped("base64", "password = hunter2222"), wrapped("bz2", "token: abcdefgh")
    for at in (0, 480, 495, 2990, 9000):
        inner = ("- " * at)[:at] + "secret = correcthorse " + wrapped("gzip", "api_key = abcdef123456") + " -" * 6000
        for kinds in (["gzip"], ["zlib"], ["bz2"], ["xz"], ["zstd"]):
            large = wrapped(kinds[0], inner)
            text = f"{small} {large} {late} {large}"
            _, added, refused = secrets.secrets_of(text)
            assert refused == 0
            assert {(k, text[a:b]) for k, a, b, _ in added} == {("assign", x) for x in (small, large, late)}
            assert len([s for s in added if text[s[1] : s[2]] == large]) == 2
    monkeypatch.setattr(secrets, "MOST_INFLATED", 4000)
    text = f"{small} {large} {late} " + wrapped("zlib", "b c" * 5000)
    _, added, refused = secrets.secrets_of(text)
    assert refused == 2 and {text[a:b] for _, a, b, _ in added} == {small, late}


def folded(block, width, end="\n"):
    return end.join(block[i : i + width] for i in range(0, len(block), width))


@pytest.mark.parametrize("kind", ["base64", "gzip", "zlib", "bz2", "xz", "zstd"])
def test_wrapped_blocks(kind):
    rnd = random.Random(9)
    noise = " ".join(f"{rnd.getrandbits(40):x}" for _ in range(60))
    inner = f"{noise} password = {'hunter2' * 12} {noise}"
    for width, end in ((76, "\n"), (64, "\r\n"), (60, "\n  ")):
        block = folded(wrapped(kind, inner), width, end)
        for before, after in (("x ", " after"), ("-----BEGIN CERTIFICATE-----\n", "\n-----END CERTIFICATE-----\n"), ("see:\n", "\nthe end of it")):
            text = before + block + after
            found = [text[a:b] for k, a, b, p in secrets.secrets_of(text)[1] if k == "assign" and p == "wrapped"]
            plain = end.replace(" ", "")
            assert found and all(f in block + "\nthe" for f in found)
            if kind == "base64":
                assert len(found) == 1 and plain[-1] in found[0] and len(found[0]) < 200
    twice = folded(wrapped("base64", folded(wrapped(kind, inner), 76)), 76)
    assert any(k == "assign" and p.startswith("wrapped>") for k, _, _, p in secrets.secrets_of(f"x {twice} y")[1])
    lines = [wrapped("base64", f"password = abcdef{i}") for i in range(3)]
    text = "\n".join(lines)
    assert set(lines) <= {text[a:b] for _, a, b, _ in secrets.secrets_of(text)[1]}


@pytest.mark.parametrize("kind", ["base64", "gzip", "bz2", "xz", "zstd"])
def test_blocks_glued_to_a_path(kind):
    block = wrapped(kind, "why??? >>>~~~ token??? is it? password = hunter2222???")
    assert set("+/") & set(block)
    for block in (block, block.replace("+", "-").replace("/", "_")):
        for before, after in (("https://host.com/cb/", ""), ("x_", ""), ("https://host.com/cb/", "/view/more_of-it"), ("", "/view")):
            text = f"see {before}{block.rstrip('=') if after else block}{after} there"
            found = [text[a:b] for k, a, b, _ in secrets.secrets_of(text)[1] if k == "assign"]
            assert found, (before, after)


def test_percent_runs_that_are_partly_text():
    text = "x %FF%70%61%73%73%77%6F%72%64%3D%C3%61%62%63%64%65%66 and %E9 token%3D%61%62%63%64%65%66%FF y"
    _, added, _ = secrets.secrets_of(text)
    assert [(k, text[a:b]) for k, a, b, _ in added] == [("assign", "token%3D%61%62%63%64%65%66")]
    text = "x %FF%70%61%73%73%77%6F%72%64%3D%61%62%63%64%65%66%FE y"
    assert [(k, text[a:b]) for k, a, b, _ in secrets.secrets_of(text)[1]] == [("assign", text[5:-5])]


def test_blocks_in_long_runs_take_linear_time():
    for text in ("a/" * 200_000, "cGFzc3dvcmQgPSBh/" * 20_000 + "\x00", ("Pz8/" * 19 + "\n") * 5_000, "%FF" * 200_000, ("QUJD" * 16 + "\n") * 3_000 + "////" * 16):
        secrets.secrets_of(text)
