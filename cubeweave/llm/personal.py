"""Personal data: patterns, and terms that reveal what the patterns find.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each
value is a protected entity. Terms near an entity may reveal it: how strongly
is estimated from co-occurrence in the corpus, as the pointwise mutual
information of term and entity over the information content of the entity,
PMI(t; e) / IC(e) = log(P(e | t) N / n_e) / log(N / n_e), with N documents, n_e
of them with the entity. P(e | t) is not the share of the n_t documents with the term
that have it near the entity, but the lower end of that share's confidence
interval (Wilson's, one standard deviation): an entity of one or two
documents is judged like any other, with as much doubt as its few documents
leave. A term is removed from ``REMOVE`` on and generalised to its class (a number, a
name, any other) from ``GENERALISE`` on, wherever it stands in the documents that
have the entity.

All counts cover all documents. Texts with entities are kept
beside what is found in them; once the terms are known, a pass over these looks
for every place of a term, with bitmaps of the terms and of the pairs (their size
is fixed, a full one only skips less).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.llm import kernel
from cubeweave.llm.tables import save

KINDS = ["email", "ip", "card", "phone"]
#: Words on either side of an entity that may reveal it.
NEAR = 10
REMOVE = 0.9
GENERALISE = 0.75
#: Bits of the bitmap of terms: 2 MB.
BITMAP = 1 << 24

_AT = re.compile("@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# what precedes a digit run can not be a digit, or the match had begun there
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
_CARD_PIECE = re.compile(r"(?<![0-9])(?:[0-9]{16,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])")
_GAP = re.compile(r"(?<=[0-9])\x20")
#: What a text must have before its kind is looked for (checked for a whole column at once).
_SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @, in time that grows with the text and not with the square of a run."""
    after = 0
    for sign in _AT.finditer(text):
        at = sign.start()
        begin = at
        while begin > after and text[begin - 1] in _LOCAL_CHARACTERS:
            begin -= 1
        if begin < at and (domain := _DOMAIN.match(text, at + 1)):
            yield begin, domain.end()
            after = domain.end()
        else:
            after = at + 1


def luhn(digits: str) -> bool:
    """Whether a number's check digit is right."""
    doubled = "0246813579"
    return sum(int(doubled[int(d)]) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _inside_cards(text: str) -> Iterator[tuple[int, int]]:
    """Card numbers in runs of digits that are no card as a whole: 16 to 19 digits in one piece, or four times four."""
    for m in _CARD.finditer(text):
        if 16 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            continue
        for part in _CARD_PIECE.finditer(text, *m.span()):
            if part.span() != m.span() and luhn(_NOT_DIGIT.sub("", part[0])):
                yield part.span()


def _inside_phones(text: str) -> Iterator[tuple[int, int]]:
    """The beginning of a phone match with too many digits, up to the last space that leaves 8 to 15 of them."""
    for m in _PHONE.finditer(text):
        if len(_NOT_DIGIT.sub("", m[0])) > 15:
            cuts = [c.start() for c in _GAP.finditer(m[0])]
            fit = [c for c in cuts if 8 <= len(_NOT_DIGIT.sub("", m[0][:c])) <= 15]
            if fit:
                yield m.start(), m.start() + fit[-1]


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


FIND = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}
#: Values that stand so close to others that the patterns take them for one.
INSIDE = {"card": _inside_cards, "phone": _inside_phones}


def _entity(kind: str, value: str) -> int:
    value = value.lower() if kind in ("email", "ip") else _NOT_DIGIT.sub("", value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def _free(text: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of the words that are no part of a span."""
    _, raw, _, number, first, end, _ = next(kernel.plain_words(pa.array([text], pa.large_string())))
    points = np.cumsum(np.concatenate([[0], (raw & 0xC0) != 0x80]))
    first, end = points[first], points[end]
    free = np.ones(len(first), dtype=bool)
    for a, b in spans:
        free[np.searchsorted(end, a, "right") : np.searchsorted(first, b, "left")] = False
    return first[free], end[free], number[free].astype(np.int64)


def _near(text: str, spans: list[tuple[str, int, int]]) -> Iterator[dict]:
    """The words near each entity that are no part of one."""
    first, end, number = _free(text, [s[1:] for s in spans])
    for kind, a, b in spans:
        entity = _entity(kind, text[a:b])
        before, after = int(np.searchsorted(end, a, "right")), int(np.searchsorted(first, b, "left"))
        for i in [*range(max(0, before - NEAR), before), *range(after, min(len(first), after + NEAR))]:
            yield {"entity": entity, "term": int(number[i])}


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_TERMS = "array<struct<entity:bigint,term:bigint>>"
_SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_TERMS_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("entity", "term")]))


def _found(docs: DataFrame) -> DataFrame:
    """id, digest, spans (by kind, then start), inside (more spans, likewise), terms and, if it has terms, text of each row of ``docs`` (id, digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            signs = {k: pc.match_substring_regex(texts, s).to_numpy(zero_copy_only=False) for k, s in _SIGNS.items()}
            spans, terms, inside = ([[] for _ in range(len(texts))] for _ in range(3))
            for i in np.flatnonzero(np.logical_or.reduce(list(signs.values()))):
                text = texts[int(i)].as_py()
                mine = [(k, a, b) for k in KINDS if signs[k][i] for a, b in FIND[k](text)]
                spans[i] = [{"kind": k, "start": a, "end": b} for k, a, b in mine]
                more = [(k, a, b) for k, find in INSIDE.items() if signs[k][i] for a, b in find(text)]
                inside[i] = [{"kind": k, "start": a, "end": b} for k, a, b in more]
                terms[i] = list(_near(text, mine + more)) if mine or more else []
            columns = [batch.column("id"), batch.column("digest"), pa.array(spans, _SPANS_TYPE), pa.array(inside, _SPANS_TYPE), pa.array(terms, _TERMS_TYPE)]
            some = pc.if_else(pa.array([bool(t) for t in terms], pa.bool_()), texts, pa.scalar(None, pa.large_string())).cast(pa.string())
            yield pa.record_batch([*columns, some], names=["id", "digest", "spans", "inside", "terms", "text"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, digest string, spans {_SPANS}, inside {_SPANS}, terms {_TERMS}, text string")


def _bitmap(rows: DataFrame, number: Column) -> np.ndarray:
    """BITMAP bits, of which those of the rows' numbers are set."""
    slot = F.pmod(number, F.lit(BITMAP))
    pieces = rows.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / 64).alias("piece")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
    pieces = pieces.toArrow()  # at most BITMAP / 64 rows
    wanted = np.zeros(BITMAP // 64, dtype=np.uint64)
    wanted[np.asarray(pieces.column("piece"))] = np.asarray(pieces.column("bits")).astype(np.uint64)
    return wanted


def _in_bitmap(bits: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Which of the numbers may have been put into the bitmap."""
    at = (number.astype(np.uint64) & np.uint64(BITMAP - 1)).astype(np.int64)
    return np.flatnonzero((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))


def _documents_with(docs: DataFrame) -> DataFrame:
    """In how many documents each word is: term, n.

    All words are counted, added up for each batch before they are shuffled: rows for
    the words of interest alone would grow with their number times the number of batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, dtype=np.uint64)]
            for _, _, _, number, _, _, begin in kernel.plain_words(batch.column("text")):
                text = np.repeat(np.arange(len(begin) - 1, dtype=np.uint64), np.diff(begin))
                # one of each word of a text: equal pairs of word and text have equal numbers
                _, first = np.unique(kernel.mix(number + kernel.mix(text + np.uint64(1))), return_index=True)
                found.append(number[first])
            term, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.record_batch([pa.array(term.view(np.int64)), pa.array(n, pa.int64())], names=["term", "n"])

    return docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _surely(some: Column, n: Column) -> Column:
    """The lower end of the confidence interval of a share."""
    p = some / n
    return (p + 1 / (2 * n) - F.sqrt(p * (1 - p) / n + 1 / (4 * n * n))) / (1 + 1 / n)


def _revealing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (entity, term) of which the term reveals the entity, and what to do: entity, term, kind."""
    near = found.select(F.explode(F.array_distinct(F.transform("terms", lambda t: F.struct(t["entity"], t["term"])))).alias("t")).select("t.*")
    joint = save(near.groupBy("entity", "term").agg(F.count("*").alias("joint")), "joint")
    if joint.isEmpty():
        return joint.select("entity", "term", F.lit("").alias("kind"))
    total = found.count()
    entities = found.select(F.explode(F.array_distinct("terms.entity")).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    terms = _documents_with(docs)
    content = F.log(F.lit(float(total)) / F.col("n_entity"))
    share = F.log(_surely(F.col("joint"), F.col("n")) * F.lit(float(total)) / F.col("n_entity")) / content
    kind = F.when(share >= REMOVE, F.lit("remove")).when(share >= GENERALISE, F.lit("generalise"))
    pairs = joint.join(entities, "entity").where(F.col("n_entity") < total).join(terms, "term")
    return pairs.select("entity", "term", kind.alias("kind")).where("kind is not null")


def _places(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """All places of the terms of ``pairs`` (entity, term) in texts with their entity: row, entity, term, start, end. Others may come along."""
    both = F.col("entity").bitwiseXOR(F.col("term"))
    shared = found.sparkSession.sparkContext.broadcast((_bitmap(pairs, F.col("term")), _bitmap(pairs, both)))
    every = F.transform(F.concat("spans", "inside"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    texts = found.where(F.size("terms") > 0).select("row", "text", F.array_distinct("terms.entity").alias("entities"), every.alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, joint = shared.value
        for batch in batches:
            for row, text, entities, spans in zip(*batch.columns, strict=True):
                first, end, number = _free(text.as_py(), [(s["start"], s["end"]) for s in spans.as_py()])
                hit = _in_bitmap(terms, number)
                first, end, number = first[hit], end[hit], number[hit]
                for entity in entities.as_py() if len(hit) else []:
                    if len(at := _in_bitmap(joint, number ^ np.int64(entity))):
                        same = [pa.array(np.full(len(at), v, dtype=np.int64)) for v in (row.as_py(), entity)]
                        yield pa.record_batch([*same, *(pa.array(x[at], pa.int64()) for x in (number, first, end))], names=["row", "entity", "term", "start", "end"])

    return texts.mapInArrow(run, "row bigint, entity bigint, term bigint, start bigint, end bigint")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in each row of ``docs``.

    Returns the id column, digest (MD5 of the text, as of an empty one if
    null), spans: those of the patterns by kind as in KINDS, then start; and
    added: cards and phones inside what the patterns take for one longer number,
    then revealing terms by start, of kind remove or generalise. A span is kind,
    start, end in code points, end exclusive.

    Null and empty texts have no spans. Repeated rows and ids count as
    documents of their own and get the same spans if their texts are equal. An
    empty table gives no rows. Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("id"), F.md5(F.encode(text, "UTF-8")).alias("digest"), text.alias("text"))
    found = save(_found(docs).withColumn("row", F.monotonically_increasing_id()), "personal")
    pairs = save(_revealing(docs, found), "revealing")
    spans = _places(found, pairs).join(pairs, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("kind").alias("kind"))
    added = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))
    added = added.withColumn("added", F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    rows = found.drop("terms", "text").join(added, "row", "left")
    none = F.array().cast(_SPANS)
    return rows.select(F.col("id").alias(id_col), "digest", "spans", F.concat("inside", F.coalesce("added", none)).alias("added"))


#: What stands in place of a span.
INSTEAD = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "remove": "[REMOVED]"}
#: Classes of generalised terms by their pattern; any other term is the last one.
CLASSES = {"[NUMBER]": "^[0-9]+$", "[NAME]": r"^\p{Lu}", "[TERM]": ""}


def _sanitised(text: Column, spans: Column) -> Column:
    """The text with each span replaced; of spans that overlap, the one that begins first."""
    instead = F.create_map(*(F.lit(x) for pair in INSTEAD.items() for x in pair))

    def broader(term: Column) -> Column:
        *classes, (other, _) = CLASSES.items()
        return F.coalesce(*[F.when(term.rlike(pattern), F.lit(name)) for name, pattern in classes], F.lit(other))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        mine = F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        put = F.when(s["kind"] == "generalise", broader(mine)).otherwise(F.try_element_at(instead, s["kind"]))
        more = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), put)
        out = F.when(s["start"] >= acc["at"], more).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    return F.aggregate(ordered, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data and revealing terms replaced; all columns stay.

    Texts without spans, null and empty ones among them, are unchanged.
    """
    found = personal_data(docs, id_col, text_col)
    every = F.concat("spans", "added")
    found = found.where(F.size(every) > 0).select(F.struct(F.col(id_col).alias("id"), "digest").alias("found"), every.alias("spans")).dropDuplicates(["found"])
    digest = F.md5(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"))
    mine = docs.select(F.struct(*docs.columns).alias("row"), F.struct(F.col(id_col).alias("id"), digest.alias("digest")).alias("key"))
    same = F.col("key.id").eqNullSafe(F.col("found.id")) & (F.col("key.digest") == F.col("found.digest"))
    text = F.col("row").getField(text_col)
    clean = F.when(F.col("spans").isNull(), text).otherwise(_sanitised(text, F.col("spans")))
    return mine.join(found, same, "left").select(*[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    """Counts and spans of each document, as text."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base, added = F.array_join(F.transform("spans", one), ","), F.transform("added", one)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    counts = [count(kind).alias(f"n_{kind}") for kind in KINDS]
    every = F.array_join(F.concat(F.transform("spans", one), added), ",")
    return personal_data(docs).select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), F.size("added").cast("bigint").alias("n_added"))
