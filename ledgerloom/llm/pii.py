"""Information-theoretic sanitisation of personal data.

Base finders locate emails, IP addresses, card and phone numbers. What they find
are the protected entities. A term that keeps appearing beside an entity may give
it away although it is no personal data itself. With document frequencies over the
whole corpus, the information that term ``t`` gives about entity ``e`` is the
pointwise mutual information ``PMI = log2(N n(t,e) / (n(t) n(e)))``, and its share of
the entity's own information ``-log2(n(e) / N)`` is the disclosure, at most 1.
Terms near an entity whose disclosure reaches ``generalise`` are replaced by a
placeholder of their kind, those that reach ``remove`` are removed.

Most entities are rare, so the evidence of a term is pooled: a pair counts if its term
stands beside entities of that kind in ``support`` different texts, or beside the entity
itself in ``support`` different texts or, where it has fewer, in all of them, two at
least. Copies of a text are one text and prove nothing.

Corpus counts are exact: pairs and entities are counted from the scan; for the
terms of pairs that may reach ``generalise`` a second scan of all texts counts documents,
with a fixed-size bit table as the only broadcast.

Null texts are empty. Repeated rows each get their row; they count as documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import saved
from ledgerloom.llm.texthash import NOT_ALNUM, U, chunks, lower_latin, word_hash, words
from ledgerloom.llm.tiling import in_table, seed_table

WINDOW = 6
SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
#: A term: what the corpus scan counts as a word (letters and digits; all beyond ASCII are letters).
_WORD = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def _emails(text: str):
    """An email begins where the run of local characters before its @ does."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(index of the kind, start, end) by kind, then start."""
    out = [(0, *x) for x in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def beside(text: str, start: int, end: int, window: int) -> list[tuple[int, int]]:
    """The ``window`` words before and behind a span."""
    right = []
    for m in _WORD.finditer(text, end):
        right.append(m.span())
        if len(right) == window:
            break
    reach, left = 32 * window, []
    while start:
        low = max(0, start - reach)
        left = [m.span() for m in _WORD.finditer(text, low, start)]
        if low and left and left[0][0] == low:
            left = left[1:]  # may have begun earlier
        if low == 0 or len(left) >= window:
            break
        reach *= 2
    return left[-window:] + right


def fold(term: str) -> bytes:
    """As the corpus scan sees it: ASCII and Latin-1 capitals folded."""
    raw = np.frombuffer(term.encode(), np.uint8)
    return lower_latin(raw).tobytes()


def _term_hash(terms: list[bytes]) -> np.ndarray:
    if not terms:
        return np.zeros(0, np.int64)
    off = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
    buf = np.frombuffer(b"".join(terms), np.uint8)
    return word_hash(buf, off[:-1], off[1:]).view(np.int64)


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_PLACE = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_NEAR = pa.struct([("entity", pa.string()), ("term", pa.int64()), ("places", pa.list_(_PLACE))])
_SPAN_SQL = "array<struct<kind:int,start:long,end:long>>"
_NEAR_SQL = "array<struct<entity:string,term:long,places:array<struct<start:long,end:long>>>>"


def _entity(kind: int, value: str) -> str:
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else _NOT_DIGIT.sub('', value)}"


def _near(text: str, spans: list[tuple[int, int, int]], window: int) -> list[dict]:
    """Terms beside each entity of a text, with their places."""
    by: dict[str, dict[tuple[int, int], bytes]] = {}
    for kind, start, end in spans:
        own = by.setdefault(_entity(kind, text[start:end]), {})
        for s, e in beside(text, start, end, window):
            if e - s > 1 and not any(s < b and a < e for _, a, b in spans):
                own[s, e] = fold(text[s:e])
    out = []
    for entity, places in by.items():
        order = sorted(places)
        hashes = _term_hash([places[p] for p in order])
        at: dict[int, list] = {}
        for p, h in zip(order, hashes.tolist(), strict=True):
            at.setdefault(h, []).append({"start": p[0], "end": p[1]})
        out.extend({"entity": entity, "term": h, "places": p} for h, p in at.items())
    return out


def scan(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, text_key, spans (base), entities, near: the terms beside them."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.list_(_SPAN)),
        ("entities", pa.list_(pa.string())), ("near", pa.list_(_NEAR)),
    ])

    def run(batches):
        for batch in batches:
            spans, entities, near = [], [], []
            for text in batch.column(2):
                text = text.as_py()
                found = base_spans(text)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                entities.append(sorted({_entity(k, text[s:e]) for k, s, e in found}))
                near.append(_near(text, found, window) if found else [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(spans, pa.list_(_SPAN)), pa.array(entities, pa.list_(pa.string())), pa.array(near, pa.list_(_NEAR))],
                schema=schema,
            )

    return _keyed(docs).mapInArrow(
        run, f"doc_id long, text_key long, spans {_SPAN_SQL}, entities array<string>, near {_NEAR_SQL}"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): documents that have each of ``terms(term)``, over all texts."""
    bits = 23
    table = docs.sparkSession.sparkContext.broadcast(seed_table(terms.select(F.col("term").alias("seed")), bits))
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            parts = []
            for _, _, buf, off in chunks(batch.column(0)):
                low = lower_latin(buf)
                start, end, doc = words(low, off, NOT_ALNUM)
                h = word_hash(low, start, end)
                hit = in_table(table.value, h)
                h, doc = h[hit], doc[hit]
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                parts.append(h[new])
            found, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, U), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def disclosures(
    docs: DataFrame, scanned: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE
) -> DataFrame:
    """(entity, term, disclosure) of the pairs that reach ``generalise``."""
    near = scanned.select("text_key", F.explode("near").alias("x")).select("text_key", "x.entity", "x.term")
    near = near.withColumn("kind", F.substring_index("entity", ":", 1))
    texts = F.count_distinct("text_key")
    pairs = near.groupBy("kind", "entity", "term").agg(F.count("*").alias("n_te"), texts.alias("texts_te"))
    pooled = near.groupBy("kind", "term").agg(texts.alias("texts_t"))
    entities = scanned.select("text_key", F.explode("entities").alias("entity"))
    n_e = entities.groupBy("entity").agg(F.count("*").alias("n_e"), texts.alias("texts_e"))
    total = scanned.agg(F.count("*").alias("total"))
    met = pairs.join(pooled, ["kind", "term"]).join(n_e, "entity").join(F.broadcast(total)).filter("n_e < total")  # one row
    own = -F.log2(F.col("n_e") / F.col("total"))
    share = lambda n_t: F.log2(F.col("total") * F.col("n_te") / (F.col(n_t) * F.col("n_e"))) / own
    enough = (F.col("texts_t") >= support) | (F.col("texts_te") >= F.least(F.lit(support), F.greatest(F.lit(2), F.col("texts_e"))))
    # a term has at least the documents counted here, so that common ones go before their count
    met = saved(met.filter(enough & (share("texts_t") >= generalise)))
    n_t = term_counts(docs, met.select("term").distinct()).withColumnRenamed("n", "n_t")
    found = met.join(n_t, "term").select("entity", "term", share("n_t").alias("disclosure"))
    return found.filter(F.col("disclosure") >= generalise)


def revealing(scanned: DataFrame, flagged: DataFrame) -> DataFrame:
    """(doc_id, text_key, terms): places of revealing terms beside the entities of each document."""
    near = scanned.filter(F.size("near") > 0).select("doc_id", "text_key", F.explode("near").alias("x"))
    met = near.select("doc_id", "text_key", "x.entity", "x.term", "x.places").join(flagged, ["entity", "term"])
    place = met.select("doc_id", "text_key", F.explode("places").alias("p"), "disclosure")
    # the context of one document is bounded by its own length
    place = place.groupBy("doc_id", "text_key", "p").agg(F.max("disclosure").alias("disclosure"))
    return place.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("p.start", "p.end", "disclosure"))).alias("terms")
    )


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    right = right.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "terms")
    on = left["doc_id"].eqNullSafe(right["_id"]) & (left["text_key"] == right["_key"])
    return left.join(right, on, "left").drop("_id", "_key")


def find(
    docs: DataFrame, window: int = WINDOW, support: int = SUPPORT, generalise: float = GENERALISE
) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row: doc_id, spans (kind, start, end; code
    points, end exclusive), terms (start, end, disclosure)."""
    scanned = saved(scan(docs, window))
    terms = revealing(scanned, disclosures(docs, scanned, support, generalise))
    out = _same(scanned.select("doc_id", "text_key", "spans"), terms)
    return out.select("doc_id", "spans", F.coalesce("terms", F.from_json(F.lit("[]"), "array<struct<start:long,end:long,disclosure:double>>")).alias("terms"))


def redact(text: str, spans: list[tuple[int, int, int]], terms: list[tuple[int, int, float]], remove: float = REMOVE) -> str:
    """Base spans become <KIND> (overlapping ones: the first's), revealing terms <word> or
    <number>, or nothing when their disclosure reaches ``remove``."""
    marks: list[list] = []
    for kind, s, e in sorted(spans, key=lambda x: (x[1], x[0])):
        if marks and s < marks[-1][1]:
            marks[-1][1] = max(marks[-1][1], e)
        else:
            marks.append([s, e, f"<{KINDS[kind].upper()}>"])
    for s, e, d in terms:
        general = "<number>" if text[s:e].isdigit() else "<word>"
        marks.append([s, e, "" if d >= remove else general])
    out, done = [], 0
    for s, e, put in sorted(marks):
        out += [text[done:s], put]
        done = e
    return "".join([*out, text[done:]])


def sanitise(
    docs: DataFrame, window: int = WINDOW, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """``docs`` with ``text`` sanitised; other columns, rows and null texts are kept."""
    scanned = saved(scan(docs, window))
    terms = saved(revealing(scanned, disclosures(docs, scanned, support, generalise)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # the caller's columns travel packed, so that none meets a name used here
    packed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )

    @F.pandas_udf("string")
    def clean(text, found):
        return text.combine(found, lambda t, f: t if t is None else redact(
            t, base_spans(t), [(x["start"], x["end"], x["disclosure"]) for x in (f if f is not None else [])], remove
        ))

    done = _same(packed, terms).select("row", clean(F.col("row.text").cast("string"), "terms").alias("text"))
    return done.select(*[(F.col("text") if c.lower() == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
