"""Personal data by bootstrapped contextual extraction.

Seeds are the entities that fixed forms find: addresses, network numbers, cards, telephone numbers. The
words before an entity are its lexical patterns (the last word, the last two words). A key with ``=`` or ``:`` that is glued to
its value counts as a word, so ``email=`` and ``"tel":"`` are patterns, too. Patterns that
introduce at least ``SUPPORT`` different seeds make up, with all identifiers they introduce, a graph of
patterns and instances. In every round a pattern's confidence in a kind is the score of its instances,
over everything that follows its words anywhere, and an instance's score is the noisy or of its
patterns' confidences. Patterns of at least ``CONFIDENT`` discover the identifiers (words with a digit or an at sign)
that no fixed form covers; they become spans of kind ``context_<kind>``.

All texts are read whole, and all counts cover all documents. Patterns are counted against the words of the
corpus in slices of ``SLICE``, so what a task is sent is bounded. A very frequent pattern is one row per
distinct instance, added up before it is shuffled.

Null and empty texts have no spans. Repeated rows are scanned each, but an instance counts once per pattern. Of kinds in which a
pattern is equally confident the first listed counts, and so it does among patterns of one identifier.
An empty table gives an empty result. Other columns are carried along.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hardwood.llm.common import WORD, prepared, table, text_of, wrapped
from hardwood.operators.balance import attach
from hardwood.session import materialize

KINDS = ("email", "ip", "card", "phone")
SUPPORT, ROUNDS, CONFIDENT = 3, 3, 0.5
SLICE = 50_000

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts within a number would start at the number's first digit, too.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORDS = re.compile(WORD)
# Marks that may open a value after its key.
OPENING = "\"'([<"
LETTER = re.compile(r"[A-Za-z]")
# Marks that may surround an identifier.
EDGES = "\"'()[]{}<>,;:.!?"
MENTION = "array<struct<start: int, end: int, kind: int, value: string, one: string, two: string>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address is found from its at sign, so a long run without a domain costs no second look."""
    at, done = text.find("@"), 0
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            begin = at
            while begin > done and text[begin - 1] in LOCAL:
                begin -= 1
            if begin < at:
                done = domain.end()
                yield begin, done
        at = text.find("@", max(at + 1, done))


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in order, in code points."""
    found = [(s, 0, e) for s, e in _emails(text)]
    if not DIGIT.search(text):
        return sorted(found)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _plain(word: str) -> str:
    """A word as patterns write it."""
    return DIGIT.sub("0", word.lower())


def key_end(word: str) -> int:
    """Where a key with ``=`` or ``:`` and the marks that open its value end; 0 without one. The scheme of an address is no key."""
    places = [p for p in (word.find("="), word.find(":")) if p >= 0]
    if not places or not LETTER.search(word, 0, min(places)):
        return 0
    end = min(places) + 1
    while end < len(word) and word[end] in OPENING:
        end += 1
    return 0 if word.startswith("/", end) else end


def _contexts(text: str, spans: list[tuple[int, int]]) -> list[tuple[str | None, str | None]]:
    """The last word and the last two words before each span; ``spans`` are in order.

    What is glued to a span counts as a word, back to the span before and without the marks that open it.
    Every part of the text is looked at once, however many spans a word holds.
    """
    bounds = [m.span() for m in WORDS.finditer(text)]
    starts = [start for start, _ in bounds]
    plain: dict[int, str] = {}
    found, done = [], 0
    for start, end in spans:
        i = bisect_right(starts, start) - 1
        glued = text[max(starts[i], done) : start]
        words = [_plain(glued)] if glued.strip(EDGES) else []
        while len(words) < 2 and i > 0:
            i -= 1
            if i not in plain:
                plain[i] = _plain(text[bounds[i][0] : bounds[i][1]])
            words.append(plain[i])
        found.append((words[0] if words else None, f"{words[1]} {words[0]}" if len(words) > 1 else None))
        done = max(done, end)
    return found


def mentions(text: str) -> list[tuple[int, int, int, str, str | None, str | None]]:
    """``(start, end, kind, value, one, two)`` in order: fixed spans, and other identifiers as kind -1."""
    fixed = fixed_spans(text)
    if not fixed and not DIGIT.search(text) and "@" not in text:
        return []
    found = [(start, end, kind) for start, kind, end in fixed]
    reach, at = [], 0
    for start, _, end in fixed:  # merged, in order
        if reach and start < reach[-1][1]:
            reach[-1][1] = max(reach[-1][1], end)
        else:
            reach.append([start, end])
    for m in WORDS.finditer(text):
        word = m[0]
        if "@" not in word and not DIGIT.search(word):
            continue
        opened = max(len(word) - len(word.lstrip(EDGES)), key_end(word))
        if "@" not in word[opened:] and not DIGIT.search(word, opened):
            opened = len(word) - len(word.lstrip(EDGES))
        start = m.start() + opened
        end = m.end() - (len(word) - len(word.rstrip(EDGES)))
        while at < len(reach) and reach[at][1] <= start:
            at += 1
        if start >= end or (at < len(reach) and reach[at][0] < end):
            continue
        found.append((start, end, -1))
    found.sort(key=lambda f: (f[0], f[2]))
    around = _contexts(text, [f[:2] for f in found])
    return [(*f, text[f[0] : f[1]].lower(), *near) for f, near in zip(found, around)]


def _scanned(docs: DataFrame, text_col: str) -> DataFrame:
    """``(row, doc, mentions)``, stored."""

    @F.arrow_udf(MENTION)
    def scan(texts: pa.Array) -> pa.Array:
        names = ("start", "end", "kind", "value", "one", "two")
        kinds = pa.struct([(n, pa.int32() if i < 3 else pa.string()) for i, n in enumerate(names)])
        rows = [[dict(zip(names, m)) for m in mentions(text)] for text in texts.to_pylist()]
        return pa.array(rows, pa.list_(kinds))

    rest = F.struct(*[F.col(f"doc.`{c}`") for c in docs.columns if c != text_col]).alias("doc")
    found = wrapped(docs).select(rest, scan(text_of(f"doc.`{text_col}`")).alias("mentions"))
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "mentions")


def _occurrences(docs: DataFrame, text_col: str, patterns: DataFrame) -> DataFrame:
    """``(pattern, total)``: how often the words of a pattern stand before another word, in all documents."""
    texts = docs.select(text_of(docs[f"`{text_col}`"]).alias("text"))

    def counting(wanted: frozenset[bytes]):
        last = {p.rpartition(b" ")[2] for p in wanted}
        glued = any(key_end(word.decode()) == len(word.decode()) for word in last)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: Counter = Counter()
                for text in batch.column("text").to_pylist():
                    words = DIGIT.sub("0", text.lower()).encode().split()
                    for i in range(len(words) - 1):
                        if words[i] in last:
                            found[words[i]] += 1
                            if i:
                                found[words[i - 1] + b" " + words[i]] += 1
                    if glued and ("=" in text or ":" in text):
                        for i, word in enumerate(words):
                            if b"=" in word or b":" in word:
                                whole = word.decode()
                                end = key_end(whole)
                                if 0 < end < len(whole) and (opened := whole[:end].encode()) in last:
                                    found[opened] += 1
                                    if i:
                                        found[words[i - 1] + b" " + opened] += 1
                known = {p.decode(): n for p, n in found.items() if p in wanted}
                columns = [pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["pattern", "total"])

        return count

    slices = -(-patterns.count() // SLICE)
    whole = patterns.select("pattern", F.lit(0).cast("long").alias("total")).where("false")
    for number in range(slices):
        part = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(slices)) == number)
        wanted = frozenset(r["pattern"].encode() for r in part.collect())  # about SLICE rows
        found = texts.mapInArrow(counting(wanted), "pattern string, total long")
        whole = whole.union(found)
    return whole.groupBy("pattern").agg(F.sum("total").alias("total"))


def confident_patterns(scanned: DataFrame, docs: DataFrame, text_col: str = "text", support: int = SUPPORT) -> DataFrame:
    """``(pattern, kind, confidence)`` after the last round, one row per pattern: its best kind."""
    each = scanned.select("row", F.explode("mentions").alias("m"))
    both = each.select("m.kind", "m.value", F.explode(F.array("m.one", "m.two")).alias("pattern")).where("pattern IS NOT NULL")
    edges = both.groupBy("pattern", "value", "kind").agg(F.count(F.lit(1)).alias("times"))
    edges = materialize(edges, "edges")
    seeded = edges.where("kind >= 0").groupBy("pattern").agg(F.count(F.lit(1)).alias("seeds"))
    induced = materialize(seeded.where(F.col("seeds") >= support).select("pattern"), "patterns")
    totals = materialize(_occurrences(docs, text_col, induced), "totals")
    graph = materialize(attach(edges, totals, ["pattern"], ["value"], "inner"), "graph")
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))])).alias("k")
    # Seeds are certain; of other instances nothing is known yet.
    scores = edges.where("kind >= 0").select("value", F.col("kind").alias("k"), F.lit(1.0).alias("score")).distinct()
    confidence = None
    for _ in range(ROUNDS):
        weighed = graph.join(materialize(scores, "scores"), "value")
        by_pattern = weighed.groupBy("pattern", "k").agg(
            (F.sum(F.col("times") * F.col("score")) / F.max("total")).alias("confidence")
        )
        confidence = materialize(by_pattern.withColumn("confidence", F.least("confidence", F.lit(1.0))), "confidence")
        spread = graph.where("kind < 0").select("value", "pattern", kinds).join(confidence, ["pattern", "k"])
        doubt = F.sum(F.log(F.greatest(1.0 - F.col("confidence"), F.lit(1e-9))))
        learnt = spread.groupBy("value", "k").agg((1.0 - F.exp(doubt)).alias("score"))
        seeds = edges.where("kind >= 0").select("value", F.col("kind").alias("k"), F.lit(1.0).alias("score")).distinct()
        scores = seeds.unionByName(learnt).groupBy("value", "k").agg(F.max("score").alias("score"))
    order = Window.partitionBy("pattern").orderBy(F.col("confidence").desc(), "k")
    return confidence.withColumn("rank", F.row_number().over(order)).where("rank = 1").select(
        "pattern", F.col("k").alias("kind"), "confidence"
    )


def personal_data(docs: DataFrame, text_col: str = "text", confident: float = CONFIDENT) -> DataFrame:
    """All rows as ``doc`` with ``spans``: ``(start, kind, end, value, learnt)`` in order."""
    prepared(docs.sparkSession)
    scanned = _scanned(docs, text_col)
    patterns = confident_patterns(scanned, docs, text_col).where(F.col("confidence") >= confident)
    patterns = materialize(patterns.select("pattern", F.col("kind").alias("named")), "confident")
    loose = scanned.select("row", F.explode("mentions").alias("m")).where("m.kind < 0")
    loose = loose.select("row", "m.start", "m.end", "m.value", F.explode(F.array("m.one", "m.two")).alias("pattern"))
    found = attach(loose.where("pattern IS NOT NULL"), patterns, ["pattern"], ["row", "start"], "inner")
    found = found.groupBy("row", "start", "end", "value").agg(F.min("named").alias("kind"))
    span = F.struct("start", "kind", "end", "value", F.lit(True).alias("learnt"))
    found = found.groupBy("row").agg(F.collect_list(span).alias("more"))
    base = F.transform(
        F.filter("mentions", lambda m: m["kind"] >= 0),
        lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"), m["value"].alias("value"), F.lit(False).alias("learnt")),
    )
    whole = scanned.select("row", "doc", base.alias("base")).join(found, "row", "left")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return whole.select("doc", spans.alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    prefix = lambda s: F.when(s["learnt"], F.lit("context_")).otherwise(F.lit(""))
    name = lambda s: F.concat(prefix(s), F.element_at(names, s["kind"] + 1))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def n(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: (s["kind"] == number) & ~s["learnt"])).cast("long")

    fixed = F.filter("spans", lambda s: ~s["learnt"])
    return found.select(
        "doc.doc_id",
        *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_written(fixed).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


SQL: dict[str, str] = {}
QUERIES = {"op4_personal_data": op4_personal_data}
