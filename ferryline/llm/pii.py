"""Personal data, and the terms that give it away.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each value
found is a protected entity, and so are what it generalises to (mail domain,
network, issuer, number prefix) and its kind, as most values stand in one text
alone and say nothing of the terms beside them. Over the whole corpus, documents
holding a term and an entity together, against documents holding either, give the
share of the entity's information the term reveals: pointwise mutual information
over the entity's own information. Terms over a threshold are marked where they
stand beside the entity: generalised to their kind, or removed over a higher one.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.joins import keyed_join

from .shared import digest_pair, query, stage, table, text_of

BASE_KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from everywhere within it.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W_]+")

_KEY = ["__k1", "__k2"]

#: Distinct terms a task counts before it hands its counts on.
COUNTED_TERMS = 400_000


@dataclass(frozen=True)
class DisclosureLimits:
    """``support``: different texts that must hold term and entity together;
    ``generalise`` and ``remove``: shares of an entity's information;
    ``information``: bits those texts must carry about the entity in sum, so that
    a frequent entity takes more texts than a rare one."""
    support: int = 3
    generalise: float = 0.8
    remove: float = 0.95
    information: float = 6.0


def emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` is tried once, with the longest local part before it."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            done = match.end()
        at = text.find("@", max(done, at + 1))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then by start."""
    spans = [("email", a, b) for a, b in emails(text)]
    if not _DIGITS.search(text):
        return spans
    spans += [("ip", *m.span()) for m in _IP.finditer(text)
              if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text)
              if 9 <= len(_DIGITS.findall(m.group())) <= 15]
    return spans


def entity(kind: str, value: str) -> str:
    """The value as compared: case and the signs between digits do not matter."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(_DIGITS.findall(value))}"


def entities(kind: str, value: str) -> tuple[str, str, str]:
    """The value as compared, what it generalises to, and its kind."""
    own = entity(kind, value)
    part = own[len(kind) + 1:]
    if kind == "email":
        wider = part.rsplit("@", 1)[1]
    elif kind == "ip":
        wider = ".".join(part.split(".")[:2])
    else:
        wider = part[:6] if kind == "card" else part[:-7]
    return own, f"{kind}~{wider}", kind


def terms_of(text: str) -> set[str]:
    return {t.lower() for t in set(_TERM.findall(text))}


def terms_outside(text: str, spans) -> list[tuple[str, int, int]]:
    """Terms with their places, leaving out what base spans cover."""
    covered = sorted((s[1], s[2]) for s in spans)
    found, k, reach = [], 0, 0
    for m in _TERM.finditer(text):
        a, b = m.span()
        while k < len(covered) and covered[k][0] < b:
            reach = max(reach, covered[k][1])
            k += 1
        if a >= reach:
            found.append((m.group().lower(), a, b))
    return found


def _spans_column(rows: list) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in rows],
                    pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                        ("end", pa.int64())])))


def find_base(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``__id``, key, ``base`` spans and, for texts with any, ``entities`` and text."""
    rows = docs.select(F.col(id_column).alias("__id"), *digest_pair(text_of(text)),
                       text_of(text).alias("__text"))
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("base", T.ArrayType(SPAN)),
                           T.StructField("entities", T.ArrayType(T.StringType())),
                           T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(3).to_pylist()
            spans = [base_spans(t) for t in texts]
            values = [sorted({e for k, a, b in s for e in entities(k, t[a:b])}) if s else None
                      for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _spans_column(spans), pa.array(values, pa.list_(pa.string())),
                 pa.array([t if s else None for t, s in zip(texts, spans)], pa.string())],
                schema.names)

    return stage(rows.mapInArrow(run, schema), "llm-private")


def document_counts(docs: DataFrame, text: str) -> DataFrame:
    """``term, df``: in how many rows each term stands, over all rows."""
    def run(batches):
        held: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                ["term", "n"])
            held.clear()
            return batch

        for batch in batches:
            for body in batch.column(0).to_pylist():
                held.update(terms_of(body))
                if len(held) >= COUNTED_TERMS:
                    yield flush()
        yield flush()

    return (docs.select(text_of(text).alias("__text")).mapInArrow(run, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("df")))


def term_pairs(beside: DataFrame) -> DataFrame:
    """``entity, term`` of each text, once per text, with its key and ``copies``."""
    schema = T.StructType([*[beside.schema[c] for c in (*_KEY, "copies")],
                           T.StructField("entity", T.StringType()),
                           T.StructField("term", T.StringType())])

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for k1, k2, copies, body, base, own in zip(*[c.to_pylist() for c in batch.columns]):
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                terms = list({t for t, _, _ in terms_outside(body, spans)})
                for e in own:
                    for column, value in zip(out, (k1, k2, copies, e)):
                        column += [value] * len(terms)
                    out[4] += terms
                    if len(out[4]) > 100_000:
                        yield _pair_batch(out, schema)
                        out = [[], [], [], [], []]
            yield _pair_batch(out, schema)

    return beside.select(*_KEY, "copies", "text", "base", "held").mapInArrow(run, schema)


def _pair_batch(columns, schema: T.StructType) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)


def disclosing_terms(docs: DataFrame, found: DataFrame, text: str,
                     limits: DisclosureLimits) -> tuple[DataFrame, DataFrame]:
    """Texts with shared entities (one row each), and ``entity, term, level`` of
    the terms that disclose an entity."""
    size = found.groupBy(*_KEY).count().agg(F.sum("count").alias("rows"),
                                            F.count(F.lit(1)).alias("texts")).first()
    texts = (found.where("entities is not null").groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"),
        F.first("base").alias("base"), F.first("entities").alias("entities")))
    texts = stage(texts, "llm-private-texts")
    # An entity in fewer texts cannot share `support` of them with a term.
    shared = (texts.select("copies", F.explode("entities").alias("entity"))
              .groupBy("entity").agg(F.sum("copies").alias("df_e"),
                                     F.count(F.lit(1)).alias("texts_e"))
              .where(F.col("texts_e") >= limits.support))
    shared = stage(shared, "llm-shared-entities")
    held = (keyed_join(texts.select(*_KEY, F.explode("entities").alias("entity")),
                       shared.select("entity"), ["entity"], "inner")
            .groupBy(*_KEY).agg(F.collect_set("entity").alias("held")))
    beside = stage(texts.drop("entities").join(held, _KEY), "llm-texts-beside-entities")
    together = (term_pairs(beside).groupBy("entity", "term")
                .agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("texts"))
                .where(F.col("texts") >= limits.support))
    total = F.lit(float(max(size["rows"] or 0, 1)))
    information = F.log2(total / F.col("df_e"))
    share = F.log2(F.col("n") * total / (F.col("df_e") * F.col("df"))) / information
    evidence = F.col("texts") * F.log2(F.lit(float(size["texts"])) / F.col("texts_e"))
    # An entity in every row has no information that a term could reveal.
    scored = (keyed_join(together, shared.where(F.col("df_e") < total), ["entity"], "inner")
              .where(evidence >= limits.information))
    disclosing = (scored.join(document_counts(docs, text), "term")
                  .withColumn("share", share).where(F.col("share") >= limits.generalise)
                  .select("entity", "term", F.when(F.col("share") >= limits.remove, F.lit("remove"))
                          .otherwise(F.lit("generalise")).alias("level")))
    return beside, stage(disclosing, "llm-disclosing-terms")


def private_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                  limits: DisclosureLimits | None = None) -> DataFrame:
    """One row per input row: id, key columns, ``base`` and ``spans`` (all spans:
    the base ones, then the terms to generalise, then those to remove).

    Null text is the empty text, without spans. Statistics count rows over the
    whole table; support and ``information`` count different texts, so copies
    alone prove nothing. Equal texts get equal spans. However many rows hold an
    entity, its terms are scored; one in every row has nothing to reveal. Other
    columns are not read. An empty table gives an empty result.
    """
    limits = limits or DisclosureLimits()
    found = find_base(docs, id_column, text)
    beside, disclosing = disclosing_terms(docs, found, text, limits)
    # Joined on the pairs that stand in a text, so its list is at most its own terms.
    marked = (keyed_join(term_pairs(beside).drop("copies"), disclosing, ["entity", "term"],
                         "inner").groupBy(*_KEY, "term")
              .agg(F.max("level").alias("level"))  # "remove" sorts after "generalise"
              .groupBy(*_KEY).agg(F.collect_list(F.struct("term", "level")).alias("terms")))
    schema = T.StructType([*[found.schema[k] for k in _KEY],
                           T.StructField("added", T.ArrayType(SPAN))])

    def place(batches):
        for batch in batches:
            rows = []
            for body, base, terms in zip(*[c.to_pylist() for c in batch.columns[2:]]):
                level = {t["term"]: t["level"] for t in terms}
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                at = [(level[t], a, b) for t, a, b in terms_outside(body, spans) if t in level]
                rows.append(sorted(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _spans_column(rows)], schema.names)

    added = (beside.join(marked, _KEY).select(*_KEY, "text", "base", "terms")
             .mapInArrow(place, schema))
    return keyed_join(found.drop("entities", "text"), added, _KEY, "left").select(
        F.col("__id").alias(id_column), *_KEY, "base",
        F.concat("base", F.coalesce("added", F.array().cast(T.ArrayType(SPAN)))).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with its spans replaced by their kind, or by nothing where removed."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done, span):
        label = F.when(span["kind"] == "remove", F.lit("")).otherwise(
            F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        gap = F.substring(text, (done["at"] + 1).cast("int"),
                          F.greatest(F.lit(0), span["start"] - done["at"]).cast("int"))
        fresh = span["start"] >= done["at"]
        return F.struct(
            F.concat(done["out"], F.when(fresh, F.concat(gap, label)).otherwise(F.lit("")))
            .alias("out"), F.greatest(done["at"], span["end"]).alias("at"))

    ordered = F.array_sort(F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"),
                                  s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.aggregate(ordered, start, step, lambda done: F.concat(
        done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2 ** 31 - 1))))


def sanitise(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
             limits: DisclosureLimits | None = None) -> DataFrame:
    """The input rows with ``text`` sanitised (null stays null)."""
    spans = private_spans(docs, id_column, text, limits).where(F.size("spans") > 0)
    spans = spans.groupBy(*_KEY).agg(F.first("spans").alias("spans"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       *digest_pair(text_of(text)))
    body = F.col("row")[text]
    clean = F.when(F.col("spans").isNull(), body).otherwise(sanitised(body, F.col("spans")))
    return keyed_join(rows, spans, _KEY, "left").select(
        F.col("row").withField(text, clean).alias("row")).select("row.*")


def span_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@query("op10_pii")
def op10(spark, sf_dir):
    found = private_spans(table(spark, sf_dir, "documents"))
    counts = [_number(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"),
                        span_text("spans").alias("spans"))
