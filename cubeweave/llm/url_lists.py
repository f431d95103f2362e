"""URL filters: captures against dated lists, as they stood at fetch time.

A list is a log of dated entries that add or remove a pattern: a host, which
stands for its subdomains too, or a host with the beginning of a path, cut at a
slash. Entries become intervals in which a pattern is listed. A capture has one
key for each host and path beginning that it could be listed under, so the
as-of join is an equality on the key with a range on the date, and no capture
meets an entry of another key. No key has more host labels or path parts than the longest
listed pattern, so a very long URL has few keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

URL = r"^(?i:[a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
#: Lists of these names let a capture pass; entries of others block it.
ALLOW = "allow"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"\.$", "")


def path_of(url: Column) -> Column:
    """The path without slashes at its end."""
    return F.regexp_replace(F.regexp_extract(url, URL, 2), "/+$", "")


def _keys(host: Column, path: Column, labels_most: int, parts_most: int) -> Column:
    """Each host that the host belongs to, and the host with each beginning of the path, of no more labels and parts than any listed one has."""
    labels = F.split(host, r"\.")
    shortest = F.greatest(F.lit(1), F.size(labels) - labels_most + 1)
    hosts = F.when(F.lit(labels_most) > 0, F.transform(F.sequence(shortest, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    none = F.array().cast("array<string>")
    # the first sign is a slash: n parts end before the slash number n + 1
    n_parts = F.least(F.size(F.split(path, "/")) - 1, F.lit(parts_most))
    beginnings = F.transform(F.sequence(F.lit(1), n_parts), lambda n: F.concat(host, F.call_function("substring_index", path, F.lit("/"), (n + 1).cast("int"))))
    paths = F.when((path != "") & (n_parts > 0), beginnings)
    return F.when(host == "", none).otherwise(F.array_distinct(F.concat(F.coalesce(hosts, none), F.coalesce(paths, none))))


def intervals(entries: DataFrame) -> DataFrame:
    """When each pattern was listed: list, key, since, until (exclusive; null: still listed).

    entries: list, pattern, dated, listed (true: added, false: removed). Of several
    entries of one list, pattern and date a removal counts; repeats of the
    state before begin no new interval's state. Entries with a null in any
    column, or an empty pattern, are ignored.
    """
    key = F.regexp_replace(F.regexp_replace(F.concat(F.lower(F.regexp_extract("pattern", "^[^/]*", 0)), F.regexp_extract("pattern", "/.*$", 0)), "/+$", ""), r"^\.+", "")
    clean = entries.dropna(subset=["list", "pattern", "dated", "listed"]).select("list", key.alias("key"), "dated", "listed").where("key <> ''")
    daily = clean.groupBy("list", "key", "dated").agg(F.min("listed").alias("listed"))
    until = F.lead("dated").over(Window.partitionBy("list", "key").orderBy("dated"))
    return daily.withColumn("until", until).where("listed").select("list", "key", F.col("dated").alias("since"), "until")


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "id", url_col: str = "url", date_col: str = "fetched") -> DataFrame:
    """The verdict on each capture.

    captures: id, url and date of fetching; entries: see ``intervals``. Returns
    the three columns, host, blocked_by (list and pattern of the longest active
    entry that blocks, joined by a space; ties by list), allowed_by (the longest
    that allows) and kept: nothing blocks, or what allows is no shorter.

    A URL that is null, empty or has no host, and a capture without a date,
    match nothing and are kept. Repeated captures (all three columns equal)
    give one row. An entry counts on its own date. Empty tables: without
    entries all are kept. Other columns are not read.
    """
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(date_col).alias("fetched"))
    url = F.coalesce("url", F.lit(""))
    rows = rows.select("*", host_of(url).alias("host"), path_of(url).alias("path"))
    active = intervals(entries)
    parts = F.size(F.split("key", "/"))
    longest = active.agg(F.max(F.size(F.split(F.substring_index("key", "/", 1), r"\."))).alias("labels"), F.max(parts - 1).alias("parts"))
    labels_most, parts_most = (n or 0 for n in longest.first())
    keyed = rows.select("id", "url", "fetched", "host", F.explode_outer(_keys(F.col("host"), F.col("path"), labels_most, parts_most)).alias("key"))
    at = (keyed["key"] == active["key"]) & (keyed["fetched"] >= active["since"]) & (active["until"].isNull() | (keyed["fetched"] < active["until"]))
    met = keyed.join(active, at, "left").select("id", "url", "fetched", "host", active["list"].alias("list"), active["key"].alias("pattern"))
    rank = F.struct(F.length("pattern").alias("n"), F.col("list"), F.col("pattern"))
    allows = F.col("list") == ALLOW
    found = met.groupBy("id", "url", "fetched", "host").agg(F.max(F.when(~allows, rank)).alias("block"), F.max(F.when(allows, rank)).alias("allow"))
    name = lambda c: F.concat(F.col(c)["list"], F.lit(" "), F.col(c)["pattern"])
    kept = F.col("block").isNull() | F.coalesce(F.col("allow")["n"] >= F.col("block")["n"], F.lit(False))
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("fetched").alias(date_col), "host", name("block").alias("blocked_by"), name("allow").alias("allowed_by"), kept.alias("kept"))


# The query: pages have neither fetch dates nor lists, so both are derived from them.
# A page is fetched on a day of two years by its id; hosts and first path
# parts whose digest says so are entered, removed and entered again.


def captures_of(pages: DataFrame) -> DataFrame:
    day = F.pmod(F.col("page_id") * 7919, F.lit(730)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), day).alias("fetched"))


def _number(text: Column, place: int) -> Column:
    """Four hexadecimal digits of the text's digest as a number."""
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), place, 4), 16, 10).cast("int")


def entries_of(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    host, first = host_of(url), F.regexp_extract(path_of(url), "^/[^/]*", 0)
    domain = F.array_join(F.slice(F.split(host, r"\."), -2, 2), ".")
    enough = F.size(F.split(host, r"\.")) >= 2
    patterns = pages.select(F.explode(F.array(F.when(enough, domain), host, F.concat(host, first))).alias("pattern")).where("pattern <> ''").distinct()
    chosen = patterns.where(_number(F.col("pattern"), 1) % 4 == 0)
    name = F.element_at(F.array(*[F.lit(x) for x in (ALLOW, "adult", "malware", "spam")]), _number(F.col("pattern"), 5) % 4 + 1)
    begin, length = _number(F.col("pattern"), 9) % 600, _number(F.col("pattern"), 13) % 200
    steps = F.array(*[F.struct(d.alias("day"), F.lit(b).alias("listed")) for d, b in ((begin, True), (begin + length, False), (begin + 2 * length, True))])
    rows = chosen.select(name.alias("list"), "pattern", F.explode(steps).alias("s"))
    return rows.select("list", "pattern", F.date_add(F.lit("2023-01-01").cast("date"), F.col("s.day")).alias("dated"), F.col("s.listed").alias("listed"))


_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.$', '')"
_PATH = r"regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:]*(?::[0-9]*)?([^?#]*)', 1), '/+$', '')"

SQL = f"""
WITH c AS (SELECT DISTINCT page_id, url, (DATE '2023-01-01' + CAST((page_id * 7919) % 730 AS INT)) AS fetched,
  {_HOST.replace("url", "coalesce(url, '')")} AS host, {_PATH.replace("url", "coalesce(url, '')")} AS path FROM pages),
p AS (SELECT DISTINCT pattern FROM (
  SELECT CASE WHEN len(string_split(host, '.')) >= 2 THEN array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') END AS pattern FROM c
  UNION ALL SELECT host FROM c UNION ALL SELECT host || regexp_extract(path, '^/[^/]*', 0) FROM c) WHERE pattern <> ''),
n AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 4))::INT AS a, ('0x' || substr(md5(pattern), 5, 4))::INT AS b,
  ('0x' || substr(md5(pattern), 9, 4))::INT AS d, ('0x' || substr(md5(pattern), 13, 4))::INT AS e FROM p),
e AS (SELECT list_extract(['allow', 'adult', 'malware', 'spam'], b % 4 + 1) AS list, pattern, DATE '2023-01-01' + (d % 600 + k * (e % 200)) AS dated, k <> 1 AS listed
  FROM n, (SELECT unnest(range(3))::INT AS k) WHERE a % 4 = 0),
y AS (SELECT list, pattern AS key, dated, min(listed) AS listed FROM e GROUP BY ALL),
i AS (SELECT * FROM (SELECT *, lead(dated) OVER (PARTITION BY list, key ORDER BY dated) AS until FROM y) WHERE listed),
h AS (SELECT *, string_split(host, '.') AS labels, string_split(substr(path, 2), '/') AS parts FROM c),
k AS (SELECT page_id, unnest(list_distinct(list_concat(
    list_transform(range(1, len(labels) + 1), lambda x: array_to_string(labels[x:], '.')),
    CASE WHEN path = '' THEN [] ELSE list_transform(range(1, len(parts) + 1), lambda x: host || '/' || array_to_string(parts[1:x], '/')) END))) AS key, fetched
  FROM h WHERE host <> ''),
m AS (SELECT page_id, list, i.key AS pattern FROM k JOIN i ON k.key = i.key AND fetched >= dated AND (until IS NULL OR fetched < until)),
b AS (SELECT page_id, list, pattern FROM m WHERE list <> 'allow' QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, list DESC, pattern DESC) = 1),
a AS (SELECT page_id, list, pattern FROM m WHERE list = 'allow' QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, pattern DESC) = 1)
SELECT page_id, url, fetched, host, b.list || ' ' || b.pattern AS blocked_by, a.list || ' ' || a.pattern AS allowed_by,
  b.pattern IS NULL OR coalesce(length(a.pattern) >= length(b.pattern), false) AS kept
FROM c LEFT JOIN b USING (page_id) LEFT JOIN a USING (page_id)
"""
