"""Exact duplicates by an extendible-hash index on shared files.

Every text gets a 64-bit key. The directory starts at a depth that fits the number of rows and
doubles while a bucket is overfull: only overfull buckets are split by their next key bit. A key
that alone exceeds the capacity cannot be split by bits; its rows go to overflow pages. Owner tasks
each take a range of (key, page), keep a chain of the different texts met under a key and compare
bytes, so a collision of keys never merges two texts. Rows whose key occurs once are nobody's copy
and are not moved.

Null texts count as empty. A text of any length is one key and is compared whole. Of equal texts the row with the largest id
stays (null ids come last; of equal ids exactly one row stays). An empty table gives an empty result. Other columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm.common import table, text_of, unwrapped, wrapped
from hardwood.operators.balance import within_limit
from hardwood.session import materialize

# Rows of a bucket, and of an overflow page.
CAPACITY = 2_048
MAX_DEPTH = 30


def _prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key, as a number."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(bucket, depth, load)`` from ``(key, n)``: the leaves after all splits.

    Keys beyond the capacity are left out of the load, as they get pages of their own.
    """
    loads = keys.where(F.col("n") <= capacity)
    total = loads.agg(F.sum("n")).first()[0] or 0
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, total / capacity)))))

    def level(source: DataFrame) -> DataFrame:
        grouped = source.groupBy(_prefix(F.col("key"), depth).alias("bucket")).agg(F.sum("n").alias("load"))
        return materialize(grouped.withColumn("depth", F.lit(depth)), "directory")

    current = level(loads)
    leaves = []
    while True:
        full = current.where(F.col("load") > capacity)
        if depth >= MAX_DEPTH or full.isEmpty():
            leaves.append(current)
            break
        leaves.append(current.where(F.col("load") <= capacity))
        parents = full.select("bucket")
        split = loads.withColumn("bucket", _prefix(F.col("key"), depth)).join(parents, "bucket", "left_semi")
        depth += 1
        current = level(split)
    whole = leaves[0]
    for leaf in leaves[1:]:
        whole = whole.unionByName(leaf)
    return whole.select("bucket", "depth", "load")


def _owned(rows: DataFrame) -> DataFrame:
    """``(row, rep)`` from ``(bucket, key, page, id, row, text)``: the first row of the same text on the page."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chain = None, []
        for batch in batches:
            keys, pages = batch.column("key").to_pylist(), batch.column("page").to_pylist()
            numbers, texts = batch.column("row").to_pylist(), batch.column("text").to_pylist()
            reps = []
            for key, page, row, text in zip(keys, pages, numbers, texts):
                if at != (key, page):
                    at, chain = (key, page), []
                rep = next((r for known, r in chain if known == text), None)
                if rep is None:
                    rep = row
                    chain.append((text, row))
                reps.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(reps, pa.int64())], ["row", "rep"])

    ordered = rows.repartitionByRange("bucket", "key", "page").sortWithinPartitions(
        "bucket", "key", "page", F.col("id").desc_nulls_last(), F.col("row").desc()
    )
    texts = ordered.select("key", "page", "row", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(own, "row long, rep long")


def indexed(docs: DataFrame, id_col: str, text_col: str, key: Column | None = None) -> DataFrame:
    """The rows on shared files: ``row, key, id, doc``, numbered once so that a rerun of a task agrees."""
    rows = wrapped(docs).withColumn("row", F.monotonically_increasing_id())
    text = text_of(f"doc.`{text_col}`")
    rows = rows.withColumn("key", F.xxhash64(text) if key is None else key)
    return materialize(rows.withColumn("id", F.col(f"doc.`{id_col}`")), "index")


def copies(rows: DataFrame, text_col: str, capacity: int = CAPACITY) -> DataFrame:
    """``(row, keep_row, keep_id, group_size)`` for the rows whose text occurs more than once."""
    keys = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")
    shared = keys.where(F.col("n") > 1)
    pages = shared.select("key", F.ceil(F.col("n") / F.lit(capacity)).cast("int").alias("pages"), "n")
    leaves = directory(keys, capacity)
    depth = leaves.agg(F.max("depth")).first()[0] or 0
    # Each leaf stands for all directory entries of the final depth that point to it.
    spread = F.expr(f"explode(sequence(0L, shiftleft(1L, {depth} - depth) - 1))")
    entries = leaves.withColumn("slot", spread).select(
        F.expr(f"shiftleft(bucket, {depth} - depth) + slot").alias("entry"),
        F.expr(f"shiftleft(bucket, {depth} - depth)").alias("bucket"),
    )
    located = pages.withColumn("entry", _prefix(F.col("key"), depth)).join(entries, "entry", "left")
    # A hot key may be alone below its entry.
    located = materialize(located.select("key", "pages", F.coalesce("bucket", "entry").alias("bucket")), "located")
    small = F.broadcast(located) if within_limit(located) else located
    # A hot key's rows are dealt to its overflow pages by row number.
    wanted = rows.join(small, "key").withColumn("page", F.pmod(F.xxhash64("row"), F.col("pages")).cast("int"))
    wanted = wanted.select("bucket", "key", "page", "id", "row", text_of(f"doc.`{text_col}`").alias("text"))
    first = _owned(wanted)
    plain = rows.select("row", "key", "id").join(small.select("key", "pages"), "key")
    found = materialize(first.join(plain, "row"), "pages")
    on_page = found.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    # One row per text and overflow page, compared once more across the pages of the key.
    again = materialize(found.where((F.col("pages") > 1) & (F.col("row") == F.col("rep"))).select("row", "key", "id"), "again")
    merged = on_page.select("rep", F.col("rep").alias("keep_row"), "n")
    if not again.isEmpty():
        few = F.broadcast(again) if within_limit(again) else again
        texts = rows.select("row", text_of(f"doc.`{text_col}`").alias("text")).join(few, "row")
        across = _owned(texts.withColumn("page", F.lit(0)).withColumn("bucket", F.col("key"))).select(F.col("row").alias("rep"), F.col("rep").alias("first"))
        merged = on_page.join(across, "rep", "left").select("rep", F.coalesce("first", "rep").alias("keep_row"), "n")
    merged = materialize(merged, "merged")
    sizes = merged.groupBy("keep_row").agg(F.sum("n").alias("group_size"))
    named = found.where(F.col("row") == F.col("rep")).select(F.col("row").alias("keep_row"), F.col("id").alias("keep_id"))
    classes = merged.join(sizes, "keep_row").join(named, "keep_row").drop("n")
    return found.join(classes, "rep").select("row", "keep_row", "keep_id", "group_size")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, key: Column | None = None
) -> DataFrame:
    """All rows as ``doc`` with ``keep_id, group_size, kept``; ``key`` (a long column) replaces the hash of the text."""
    rows = indexed(docs, id_col, text_col, key)
    groups = copies(rows, text_col, capacity)
    labelled = rows.join(groups, "row", "left")
    return labelled.select(
        "doc",
        F.when(F.col("keep_row").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows that stay, with their columns; only row numbers of dropped copies are joined."""
    rows = indexed(docs, id_col, text_col)
    groups = copies(rows, text_col, capacity)
    dropped = materialize(groups.where(F.col("row") != F.col("keep_row")).select("row"), "dropped")
    small = F.broadcast(dropped) if within_limit(dropped) else dropped
    return unwrapped(rows.join(small, "row", "left_anti"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = docs.withColumn("text_sha256", F.sha2(text_of("text").cast("binary"), 256))
    found = exact_duplicates(digest)
    return found.select("doc.doc_id", "keep_id", "group_size", "kept", "doc.text_sha256")


SQL = {
    "op2_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
        FROM t JOIN g ON t.text = g.text
    """
}
QUERIES = {"op2_exact_dedup": op2_exact_dedup}
