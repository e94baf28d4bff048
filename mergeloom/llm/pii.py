"""Personal data, and the terms of its documents that reveal it.

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone numbers; per kind they are
the leftmost non-overlapping matches, and a match that fails its check is
dropped. Each distinct value is a protected entity. The corpus then tells which terms reveal an entity:

* c(e), c(t): documents that hold entity e, or term t anywhere in their text;
* c(t, e): documents that hold e and have t anywhere outside base spans.

t discloses log2(c(t, e) * N / (c(t) * c(e))) bits about e, whose information is
log2(N / c(e)). Where the first is at least `DISCLOSURE` of the second, and e isn't
held by all documents, all mentions of t in the documents that hold e get a `term` span: `sanitise` removes them and generalises
the base spans to their kind. All counts are over all documents, as sums of per-task partial counts.
As c(t, e) is at most c(e), only terms with c(t) <= c(e)^D * N^(1 - D) are paired with e, D being `DISCLOSURE`.

Edge cases: null text counts as empty. Every row is a document of the corpus, also where
doc_ids are null or repeat; rows equal in doc_id and text get equal spans. An empty table gives an empty result. Other columns are ignored by `decide`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import WORD, plain, slices, words
from .common import cut_lineage, join_bounded, text_of

KINDS = ("email", "ip", "card", "phone")
DISCLOSURE = 0.95
# A leftmost match starts where a run of digits does and takes whole runs, so no start or end inside a run is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPANS = "struct<kind:string,start:int,end:int>"

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    """From each @ back over its local part: the leftmost match starts there."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[Span]:
    """By kind as listed in KINDS, then by start; code points, end exclusive."""
    out = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_only_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def entity(kind: str, value: str) -> int:
    """A 64-bit key of a protected value, however it is spaced or cased."""
    plain_value = value.lower() if kind == "email" else value if kind == "ip" else _only_digits(value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{plain_value}".encode(), digest_size=8).digest(), "little", signed=True)


def _lower(term: str) -> str:
    return term.translate(_ASCII_LOWER)


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text: str, spans: list[Span]) -> list[tuple[str, int, int]]:
    """(term, start, end) of every term outside all base spans."""
    covered = sorted((a, b) for _, a, b in spans)
    out, at, reached = [], 0, 0
    for m in _TERM.finditer(_lower(text)):
        while at < len(covered) and covered[at][0] < m.end():
            reached = max(reached, covered[at][1])
            at += 1
        if m.start() >= reached:
            out.append((m[0], m.start(), m.end()))
    return out


_FOUND = "struct<base:array<struct<kind:string,start:int,end:int>>,es:array<bigint>,ts:array<bigint>>"
_FOUND_ARROW = pa.struct(
    [
        ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
        ("es", pa.list_(pa.int64())),
        ("ts", pa.list_(pa.int64())),
    ]
)


def _term_keys(terms: list[str]) -> list[int]:
    """The 64-bit hashes that `words` gives to these words."""
    if not terms:
        return []
    return words(pa.array(terms, pa.string()), WORD).hashes.view(np.int64).tolist()


def _found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        out = []
        for text in plain(texts):
            text = text.as_py()
            spans = base_spans(text)
            out.append(
                {
                    "base": [{"kind": k, "start": a, "end": b} for k, a, b in spans],
                    "es": sorted({entity(k, text[a:b]) for k, a, b in spans}),
                    "ts": _term_keys(sorted({t for t, _, _ in terms(text, spans)})) if spans else [],
                }
            )
        yield pa.array(out, _FOUND_ARROW)


def _mentions(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Spans of all mentions of the given terms."""
    for texts, bases, told in batches:
        out = []
        for text, base, keys in zip(texts.to_pylist(), bases.to_pylist(), told.to_pylist()):
            found, keys = terms(text, [(s["kind"], s["start"], s["end"]) for s in base]), set(keys)
            at = zip(found, _term_keys([t for t, _, _ in found]), strict=True)
            out.append([{"kind": "term", "start": a, "end": b} for (_, a, b), key in at if key in keys])
        yield pa.array(out, _FOUND_ARROW.field("base").type)


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(plain(batch.column(0))):
            w = words(part, WORD)
            once = [np.unique(w.hashes[a:b]) for a, b in zip(w.rows[:-1], w.rows[1:])]
            term, count = np.unique(np.concatenate(once) if once else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(count, pa.int64())], ["t", "n"])


def disclosures(docs: DataFrame, held: DataFrame) -> DataFrame:
    """(place, t): terms that disclose too much of an entity of the document.
    `held` has place, es and ts of the documents that hold an entity."""
    total = docs.count()
    own = held.select("place", F.explode("es").alias("e"))
    entities = cut_lineage(own.groupBy("e").agg(F.count(F.lit(1)).alias("ce")).where(F.col("ce") < total), "entities")
    own = join_bounded(own, entities, "e", "inner")
    used = held.select("place", F.explode("ts").alias("t"))
    most = entities.agg(F.max("ce")).first()[0] or 0
    limit = F.pow(F.col("ce").cast("double"), F.lit(DISCLOSURE)) * float(max(total, 1)) ** (1 - DISCLOSURE) * (1 + 1e-9)
    highest = most**DISCLOSURE * max(total, 1) ** (1 - DISCLOSURE) * (1 + 1e-9)
    frequency = docs.select(text_of(docs).alias("text")).mapInArrow(_document_frequency, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("ct"))
    frequency = frequency.where(F.col("ct") <= highest).join(used.select("t").distinct(), "t", "left_semi")
    rare = join_bounded(used, frequency, "t", "inner")
    pairs = cut_lineage(own.join(rare, "place").where(F.col("ct") <= limit).select("place", "e", "t", "ce", "ct"), "pii-pairs")
    both = pairs.groupBy("e", "t").agg(F.count(F.lit(1)).alias("both"), F.first("ce").alias("ce"), F.first("ct").alias("ct"))
    information = F.log2(F.lit(float(total)) / F.col("ce"))
    shared = F.log2(F.col("both") * F.lit(float(total)) / (F.col("ct") * F.col("ce")))
    told = both.where(shared >= information * DISCLOSURE).select("e", "t")
    return join_bounded(pairs.select("place", "e", "t"), told, ["e", "t"], "left_semi").select("place", "t").distinct()


def _span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, row (a key of doc_id and text), base spans and term spans."""
    text = text_of(docs)
    rows = docs.select(
        docs["doc_id"],
        F.sha2(F.concat_ws(":", docs["doc_id"].cast("string"), text).cast("binary"), 256).alias("row"),
        text.alias("text"),
        F.arrow_udf(_found, _FOUND)(text).alias("f"),
    )
    rows = rows.select("doc_id", "row", "text", "f.*")
    some = F.size("base") > 0
    # Every row is a document: numbered, and with its text only where that is needed again.
    rows = rows.select("doc_id", "row", "base", "es", "ts", F.when(some, F.col("text")).alias("text"), F.monotonically_increasing_id().alias("place"))
    rows = cut_lineage(rows, "pii-spans")
    held = rows.where(some)
    told = disclosures(docs, held.select("place", "es", "ts")).groupBy("place").agg(F.collect_list("t").alias("told"))
    mentions = F.arrow_udf(_mentions, f"array<{_SPANS}>")
    per_row = held.select("place", "text", "base").join(told, "place").select("place", mentions("text", "base", "told").alias("terms"))
    rows = rows.select("doc_id", "row", "place", "base")
    none = F.array().cast(f"array<{_SPANS}>")
    return rows.join(per_row, "place", "left").select("doc_id", "row", "base", F.coalesce("terms", none).alias("terms"))


def decide(docs: DataFrame) -> DataFrame:
    """Counts per kind, a digest of the base spans and all spans, for every row."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = _span_text(F.col("base"))
    return find(docs).select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        _span_text(F.concat("base", "terms")).alias("spans"),
        F.size("terms").cast("bigint").alias("n_term"),
    )


def _cleaned(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist()):
        text, parts, at = text or "", [], 0
        for s in sorted(found or [], key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= at:
                parts += [text[at : s["start"]], "" if s["kind"] == "term" else f"<{s['kind'].upper()}>"]
                at = s["end"]
        out.append("".join([*parts, text[at:]]))
    return pa.array(out, pa.string())


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, text): terms removed, base spans generalised to their kind."""
    text = text_of(docs)
    keyed = docs.select(docs["doc_id"], text.alias("text"), F.sha2(F.concat_ws(":", docs["doc_id"].cast("string"), text).cast("binary"), 256).alias("row"))
    spans = find(docs).select("row", F.concat("base", "terms").alias("spans")).where(F.size("spans") > 0).dropDuplicates(["row"])
    clean = F.arrow_udf(_cleaned, "string")
    return keyed.join(spans, "row", "left").select("doc_id", clean("text", "spans").alias("text"))
