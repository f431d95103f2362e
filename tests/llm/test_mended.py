"""Cases that once lost data, failed, or took time that grew with a square."""

from __future__ import annotations

import base64
import bz2
import datetime
import gzip
import lzma
import random
import time
import zlib

import pytest
import zstandard
from edges import frame

from cubeweave.llm import decontaminate, secrets, url_lists

SECRET = "token=0123456789abcdef0123"


def b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress], ids=["gzip", "bz2", "xz", "zstd"])
@pytest.mark.parametrize("after", [b"", b"\0\0\0\0", b"rubbish"])
def test_all_members_of_a_block_are_read(pack, after):
    raw = pack(b"harmless words first " * 9) + pack(b"and then " * 5) + pack(SECRET.encode()) + after
    text = f"see {b64(raw)} end"
    _, added, refused = secrets.secrets_of(text)
    assert [s[0] for s in added] == ["assign"] and refused == 0
    # what looks like a member and is none hides nothing
    _, added, _ = secrets.secrets_of(f"see {b64(pack(SECRET.encode()) + raw[:6] + b'broken')} end")
    assert [s[0] for s in added] == ["assign"]


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zlib.compress, zstandard.ZstdCompressor().compress], ids=["gzip", "bz2", "xz", "zlib", "zstd"])
def test_blocks_glued_to_paths(pack):
    rnd = random.Random(3)
    for i in range(60):
        block = base64.urlsafe_b64encode(pack(f"{i} words {SECRET} ".encode() * rnd.randint(1, 3))).decode().rstrip("=")
        path = "/".join("part%d" % rnd.randint(0, 10 ** rnd.randint(1, 6)) for _ in range(rnd.randint(1, 20)))
        assert secrets.secrets_of(f"at https://h.com/x/{block}/{path} end")[1], (block, path)


def test_deep_percent_and_escape_chains_take_linear_time():
    deep = "".join("%" + "25" * 100_000 + f"{ord(c):02x}" for c in "token=01")
    began = time.perf_counter()
    _, added, _ = secrets.secrets_of(f"a {deep}23456789 b")
    assert [(k, a) for k, a, _, _ in added] == [("assign", 2)]
    _, added, _ = secrets.secrets_of("\\u005c" + "u005c" * 50_000 + "u0074oken=01234567")
    assert [s[0] for s in added] == ["assign"]
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize("text", ["\\u{74}oken=01234567", "%u0074oken=01234567", "%2574oken%253d01234567", "\\u005cu0074oken=01234567"])
def test_more_escapes(text):
    assert [s[0] for s in secrets.secrets_of(f"x {text}")[1]] == ["assign"]


def test_items_larger_than_a_group(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 500)
    long = [f"word{i * 7919 % 100_003}" for i in range(6000)]
    items = spark.createDataFrame([(1, " ".join(long)), (2, "a short item of seven plain words")], "item_id bigint, text string")
    rows = [(1, " ".join(long[3000:3040])), (2, " ".join(long[1890:1930])), (3, " ".join(long[100:110])), (4, " ".join(long)), (5, "x a short item of seven plain words y")]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 1), (5, 2)}
    assert got[1, 1].points == 80 and abs(got[1, 1].score - 40 / 6000) < 1e-9 and got[5, 2].score == 1.0


def test_urls_of_a_megabyte(spark):
    day = datetime.date(2023, 5, 1)
    long = "http://a.b.example.com/" + "/".join(f"p{i}" for i in range(150_000))
    rows = [(1, long, day), (2, "http://" + "x." * 100_000 + "example.com/p0", day), (3, "http://example.com/q", day)]
    captures = spark.createDataFrame(rows, "id bigint, url string, fetched date")
    entries = spark.createDataFrame([("spam", "a.b.example.com/p0/p1", day, True), ("malware", "example.com/p0", day, True)], "list string, pattern string, dated date, listed boolean")
    began = time.perf_counter()
    got = {r.id: r.blocked_by for r in url_lists.filter_urls(captures, entries).collect()}
    assert time.perf_counter() - began < 30
    assert got == {1: "spam a.b.example.com/p0/p1", 2: None, 3: None}
    assert [r.kept for r in url_lists.filter_urls(captures, entries.limit(0)).collect()] == [True] * 3
