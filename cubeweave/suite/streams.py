"""Structured Streaming queries. Each runs to completion and returns its table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cubeweave.functions import numeric
from cubeweave.functions.times import timestamp
from cubeweave.operators import forecast
from cubeweave.registry import query
from cubeweave.runtime import new_dir, settings, stream_settings
from cubeweave.sources import substrate
from cubeweave.streaming import arrivals
from cubeweave.suite.views import with_views

_COLUMNS = ["cycle", "reftime", "source", "lead", "landed"]


def _landed_passes(rows, late=None):
    """Three passes in the order of landing; late rows come with the last one."""
    first, second = timestamp("1998-01-01"), timestamp("2000-01-01")
    straggler = F.lit(False) if late is None else late
    landed = F.col("landed")
    on_time = rows.where(~straggler)
    last = rows.where(straggler | (landed >= second)) if late is not None else rows.where(landed >= second)
    return [
        df.select(*_COLUMNS)
        for df in (on_time.where(landed < first), on_time.where((landed >= first) & (landed < second)), last)
    ]


def _run(spark, passes, transform, step, conf=None):
    folder = new_dir(spark, "stream")
    landing, out = os.path.join(folder, "landing"), os.path.join(folder, "out")
    schema = passes[0].schema
    with settings(spark, {**stream_settings(spark), **(conf or {})}):
        arrivals.run_passes(landing, passes, lambda: transform(arrivals.source(spark, landing, schema)), step, out)
    return arrivals.result(spark, out)


@query("stream_arrivals", with_views("arrivals", "SELECT cycle, source, count(*) AS n, CAST(sum(value) AS DOUBLE) AS value FROM arrivals GROUP BY 1, 2"))
def stream_arrivals(spark, sf):
    """The table itself as a file stream, twice: the second pass finds nothing new."""
    # a pattern, because a stream takes a folder or a pattern but not the path of one file
    path = f"{sf.rstrip('/')}/lineitem.parquet*"
    schema = substrate.table(spark, sf, "lineitem").schema
    out = new_dir(spark, "arrivals")
    for _ in range(2):
        rows = substrate.arrivals_from(arrivals.source(spark, path, schema))
        arrivals.append_pass(rows.select(*_COLUMNS, "value"), out)
    return arrivals.result(spark, out).groupBy("cycle", "source").agg(
        F.count("*").alias("n"), numeric.total("value").alias("value")
    )


_STRAGGLER = "attempt = 2 AND member = 19"


@query(
    "stream_dedup",
    with_views(
        "arrivals",
        f"""WITH edge AS (SELECT max(landed) - INTERVAL 21 DAY AS mark FROM arrivals WHERE landed < TIMESTAMP '2000-01-01' AND NOT ({_STRAGGLER}))
        SELECT cycle, source, count(DISTINCT lead) AS n_files FROM arrivals, edge WHERE NOT ({_STRAGGLER}) OR landed >= mark GROUP BY 1, 2""",
    ),
)
def stream_dedup(spark, sf):
    rows = substrate.arrivals(spark, sf)
    late = (F.col("attempt") == 2) & (F.col("member") == 19)
    once = _run(spark, _landed_passes(rows, late), lambda s: arrivals.unique_files(s, "landed", "21 days"), arrivals.append_pass)
    return once.groupBy("cycle", "source").agg(F.count("*").alias("n_files"))


@query(
    "stream_lead_gate",
    with_views(
        "arrivals",
        """WITH c AS (SELECT cycle, count(DISTINCT lead) FILTER (source = 'TMP_TGL_2m') AS n_tas,
            count(DISTINCT lead) FILTER (source = 'APCP_SFC_0') AS n_pr FROM arrivals GROUP BY 1)
        SELECT *, n_tas > 86 AND n_pr > 86 AS complete FROM c""",
    ),
)
def stream_lead_gate(spark, sf):
    updates = _run(spark, _landed_passes(substrate.arrivals(spark, sf)), arrivals.lead_sets, arrivals.update_pass)
    state = updates.groupBy("cycle").agg(
        *[
            F.coalesce(F.max(F.when(F.col("source") == s, F.col("n_leads"))), F.lit(0)).alias(n)
            for s, n in zip(forecast.VARIABLES, ("n_tas", "n_pr"))
        ]
    )
    enough = forecast.required_leads()
    return state.withColumn("complete", (F.col("n_tas") > enough) & (F.col("n_pr") > enough))


@query(
    "stream_late",
    with_views(
        "arrivals",
        f"""WITH edge AS (SELECT max(reftime) - INTERVAL 3 DAY AS mark FROM arrivals WHERE landed < TIMESTAMP '2000-01-01' AND NOT ({_STRAGGLER}))
        SELECT cycle, source, count(*) AS n FROM arrivals, edge WHERE NOT ({_STRAGGLER}) OR reftime >= mark GROUP BY 1, 2""",
    ),
)
def stream_late(spark, sf):
    rows = substrate.arrivals(spark, sf)
    late = (F.col("attempt") == 2) & (F.col("member") == 19)
    updates = _run(spark, _landed_passes(rows, late), arrivals.counts, arrivals.update_pass)
    return updates.groupBy("cycle", "source").agg(F.max("n").alias("n"))


@query(
    "recheck_stream",
    with_views(
        "members",
        """WITH n AS (SELECT * FROM members WHERE mtime <= TIMESTAMP '2000-06-30' AND mtime > TIMESTAMP '1998-06-30'),
          v AS (SELECT variable, exp, count(*) AS n_values, CAST(sum(value) AS DOUBLE) AS value
            FROM n JOIN records USING (center, model, exp, run, domain, variable, year) GROUP BY 1, 2),
          m AS (SELECT variable, exp, count(*) AS n_new, CAST(sum(ncoords) AS BIGINT) AS steps_added FROM n GROUP BY 1, 2)
        SELECT variable, exp, n_new, steps_added, n_values, value FROM m JOIN v USING (variable, exp)""",
    ),
)
def recheck_stream(spark, sf):
    """A dataset that is scanned again: each listing of its directory goes through
    the same stream, files seen before fall out, and the rows of new ones are appended."""
    files = substrate.members(spark, sf)
    listing = lambda day: files.where(F.col("mtime") <= timestamp(day))
    seen = _run(spark, [listing("1998-06-30"), listing("2000-06-30")], lambda s: s.dropDuplicates(["path"]), arrivals.update_pass)
    first = seen.agg(F.min("batch").alias("batch"))
    new = seen.where(F.col("batch") > first.select("batch").scalar()).select(*substrate.FILE_KEYS, "ncoords")
    members = new.groupBy("variable", "exp").agg(F.count("*").alias("n_new"), F.sum("ncoords").alias("steps_added"))
    rows = substrate.records(spark, sf).join(new.select(*substrate.FILE_KEYS), substrate.FILE_KEYS)
    added = rows.groupBy("variable", "exp").agg(F.count("*").alias("n_values"), numeric.total("value").alias("value"))
    return members.join(added, ["variable", "exp"])


#: Days on which a directory is listed, and for how long one that is not listed is remembered.
_LISTED, _KEPT_DAYS = ["1998-06-30", "1999-06-30", "2000-06-29", "2001-06-29"], 400


def _listing(files, i: int):
    """Directories of datasets with files at a listing; those of a third of the centres are away at the second and third."""
    day = timestamp(_LISTED[i])
    here = files.where(F.col("mtime") <= day)
    if i in (1, 2):
        here = here.where(F.pmod(F.substring("center", 2, 20).cast("bigint"), F.lit(3)) != 0)
    return here.select(F.regexp_replace("path", "/[^/]*$", "").alias("directory"), day.alias("listed")).distinct()


@query(
    "recheck_expiry",
    with_views(
        "members",
        f"""WITH l(i, day) AS (VALUES {", ".join(f"({i}, TIMESTAMP '{d}')" for i, d in enumerate(_LISTED))}),
          s AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS directory, i, day FROM members, l
            WHERE mtime <= day AND (i NOT IN (1, 2) OR CAST(substr(center, 2) AS BIGINT) % 3 <> 0)),
          g AS (SELECT *, lag(day) OVER w AS before, lag(i) OVER w AS before_i, lead(i) OVER w AS after_i FROM s WINDOW w AS (PARTITION BY directory ORDER BY i)),
          -- a key is cleared after the first listing that is later than its time, if it is not in that listing
          x AS (SELECT *, (SELECT min(l.i) FROM l WHERE l.day >= g.day + INTERVAL {_KEPT_DAYS} DAY) AS gone_i FROM g),
          e AS (SELECT directory, day + INTERVAL {_KEPT_DAYS} DAY AS moment FROM x WHERE gone_i IS NOT NULL AND (after_i IS NULL OR after_i > gone_i)),
          n AS (SELECT directory, day AS moment FROM (SELECT *, (SELECT min(l.i) FROM l WHERE l.day >= g.before + INTERVAL {_KEPT_DAYS} DAY) AS gone_i FROM g)
            WHERE before IS NULL OR (gone_i IS NOT NULL AND gone_i < i))
        SELECT 'new' AS what, strftime(moment, '%Y-%m-%d') AS day, count(*) AS n, min(directory) AS first FROM n GROUP BY 2
        UNION ALL SELECT 'expired', strftime(moment, '%Y-%m-%d'), count(*), min(directory) FROM e GROUP BY 2""",
    ),
)
def recheck_expiry(spark, sf):
    """Directories that are listed again and again: state of those that are gone expires, and they are new when they come back."""
    files = substrate.members(spark, sf)
    passes = [_listing(files, i) for i in range(len(_LISTED))]
    told = _run(spark, passes, lambda s: arrivals.remembered(s, "directory", "listed", _KEPT_DAYS * 86400), arrivals.update_pass, arrivals.MEMORY_SETTINGS)
    day = F.date_format(F.timestamp_millis("at"), "yyyy-MM-dd")
    return told.groupBy("what", day.alias("day")).agg(F.count("*").alias("n"), F.min("key").alias("first"))
