"""Phrases of two and three words, from a weighted de Bruijn graph of every language.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at spaces
and tabs. The longest grams, three words, are edges between overlapping nodes of two words; a piece's last
two words have edges to the end mark, which are the piece-end corrections. Only edges are counted from the texts:

* the flow out of a node is the count of its two words, the flow out of all nodes that a word leads is the
  count of the word;
* a node that all its flow enters by one edge and leaves by one edge is unary. Unary nodes are compacted:
  their edges form one path with one weight, and the node, which is contained in a longer phrase as often as
  it occurs, is no collocation of its own. Pointers are doubled, so a path of m edges takes log m rounds;
* all other nodes are held against the heaviest edge that enters or leaves them.

Words go by 64-bit hashes of (language, word); the words themselves are met once more in a dictionary, and if two
words share a hash the graph is built with another seed, so counts are exact. A task hands on counted
edges. They are dealt by their node; nodes of two words that each make ``HOT_WORD`` of all tokens are dealt by
(node, slot of the third word). No other node can hold many edges, and there are at most 1 / HOT_WORD such words.
Scores are exact in 38 decimal digits, enough for 10^15 occurrences.

Null texts count as empty and have no pieces; a null language is ``und``. A text of any length is one row in a
task, a piece of any length one run of edges. Repeated rows and null ids count as often as they occur. Ties go by
count, then by the phrase's bytes. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table, text_of
from hardwood.operators.balance import attach, within_limit
from hardwood.session import materialize

LEAST, TOP = 10, 2_000
# A phrase goes if a longer one that holds it occurs in this share of its places.
HELD_PERCENT = 50
# What leads to the end of a piece.
END = 0
# Tokens and distinct words that a task holds before it hands on, checked after each text.
HELD_TOKENS, HELD_WORDS = 4_000_000, 1_000_000
HOT_WORD, SLOTS = 1e-3, 64
# Edges that a task adds up at once.
HELD_ROWS = 200_000

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_AS_STOP = bytes.maketrans(_BREAKS, b"." * len(_BREAKS))


def _tokens(text: bytes) -> list[bytes]:
    """All words of a text in order, with ``.`` where a piece ends."""
    # bytes.lower changes A-Z only; after the breaks are gone, split() sees no white space but space and tab.
    return text.lower().translate(_AS_STOP).replace(b".", b" . ").split()


def _code(lang: bytes, word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(lang + b"\0" + word, seed) or 1


def _pieces_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    return docs.select(lang.cast("binary").alias("lang"), text_of(f"`{text_col}`").cast("binary").alias("text"))


def dictionary(texts: DataFrame, seed: int) -> DataFrame:
    """``(code, lang, word, n)`` of all words of ``(lang, text)``, both binary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, dict[bytes, int]] = {}

        def handed() -> pa.RecordBatch:
            rows = [(lang, word, n) for lang, words in known.items() for word, n in words.items() if word != b"."]
            known.clear()
            codes = np.array([_code(lang, word, seed) for lang, word, _ in rows], dtype=np.uint64).view(np.int64)
            langs, words, numbers = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(codes), pa.array(langs, pa.binary()), pa.array(words, pa.binary()), pa.array(numbers, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["code", "lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = known.setdefault(lang, {})
                get = words.get
                for word in _tokens(text):
                    words[word] = get(word, 0) + 1
            if sum(map(len, known.values())) > HELD_WORDS:
                yield handed()
        yield handed()

    found = texts.mapInArrow(count, "code long, lang binary, word binary, n long")
    return materialize(found.groupBy("code", "lang", "word").agg(F.sum("n").alias("n")), "dictionary")


def _distinct(rows: np.ndarray, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of three rows of numbers, and how often each occurs."""
    width = max(1, (numbers - 1).bit_length())
    if 3 * width <= 63:
        packed, n = np.unique(rows[0] << 2 * width | rows[1] << width | rows[2], return_counts=True)
        return np.stack([packed >> 2 * width, packed >> width & (1 << width) - 1, packed & (1 << width) - 1]), n
    found = rows[:, np.lexsort(rows[::-1])]
    new = np.flatnonzero(np.r_[True, (found[:, 1:] != found[:, :-1]).any(0)])
    return found[:, new], np.diff(np.r_[new, found.shape[1]])


def _counted_edges(texts: DataFrame, seed: int, hot: set[int]) -> DataFrame:
    """``(x, y, z, slot, n)``: edges counted per task; ``slot`` is -1 but for nodes of two words in ``hot``."""
    often = np.array(sorted(hot), dtype=np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, dict[bytes, int]] = {}
        codes: list[int] = [END]
        held: list[int] = []

        def handed() -> Iterator[pa.RecordBatch]:
            at = np.array(held, dtype=np.int64)
            code = np.array(codes, dtype=np.uint64).view(np.int64)
            x, y, z = at[:-2], at[1:-1], at[2:].copy()
            z[y == 0] = 0
            word = x > 0
            edges, n = _distinct(np.stack([x[word], y[word], z[word]]), len(codes))
            x, y, z = code[edges]
            is_hot = np.isin(x, often) & np.isin(y, often)
            slot = np.where(is_hot, (z.view(np.uint64) >> np.uint64(7)) % np.uint64(SLOTS), -1).astype(np.int32)
            for start in range(0, len(n), 200_000):
                part = slice(start, start + 200_000)
                columns = [pa.array(c[part]) for c in (x, y, z, slot, n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["x", "y", "z", "slot", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                known = numbers.setdefault(lang, {b".": 0})
                words = _tokens(text)
                for word in words:
                    if word not in known:
                        known[word] = len(codes)
                        codes.append(_code(lang, word, seed))
                held.extend(map(known.__getitem__, words))
                held.extend((0, 0))
                if len(held) > HELD_TOKENS or len(codes) > HELD_WORDS:
                    yield from handed()
                    held.clear()
                    numbers.clear()
                    codes[1:] = []
        yield from handed()

    return texts.mapInArrow(count, "x long, y long, z long, slot int, n long")


def _runs(held: np.ndarray, keys: np.ndarray, n: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (columns) of sorted rows with their sums, and what is held back: the last key may go on in the next rows.

    ``held`` is what the call before held back, a column of key and sum, or nothing.
    """
    keys, n = np.concatenate([held[:-1], keys], axis=1), np.concatenate([held[-1], n])
    if not len(n):
        return keys, n, held
    new = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)])
    keys, n = keys[:, new], np.add.reduceat(n, new)
    if last:
        return keys, n, held[:, :0]
    return keys[:, :-1], n[:-1], np.r_[keys[:, -1], n[-1]][:, None]


def _flows(dealt: DataFrame, least: int) -> DataFrame:
    """``(x, y, z, n)`` from sorted edges: edges, nodes (null ``z``) and the task's part of words (null ``y``)."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {size: np.zeros((size + 1, 0), dtype=np.int64) for size in (4, 3, 1)}

        def rows(columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
            none = [pa.nulls(len(n), pa.int64())] * (3 - len(columns))
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), *none, pa.array(n)], ["x", "y", "z", "n"])

        def step(found: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            edges, n, held[4] = _runs(held[4], found[:4], found[4], last)
            keep = (n >= least) & (edges[2] != END)
            yield rows([edges[0][keep], edges[1][keep], edges[2][keep]], n[keep])
            nodes, n, held[3] = _runs(held[3], edges[[0, 1, 3]], n, last)
            keep = ((n >= least) | (nodes[2] > 0)) & (nodes[1] != END)
            yield rows([nodes[0][keep], nodes[1][keep]], n[keep])
            words, n, held[1] = _runs(held[1], nodes[:1], n, last)
            yield rows([words[0]], n)

        parts, waiting = [], 0
        for batch in batches:
            parts.append(np.stack([batch.column(c).to_numpy() for c in ("x", "y", "z", "hot", "n")]))
            waiting += batch.num_rows
            if waiting > HELD_ROWS:
                yield from step(np.concatenate(parts, axis=1), False)
                parts, waiting = [], 0
        yield from step(np.concatenate([np.zeros((5, 0), dtype=np.int64), *parts], axis=1), True)

    ordered = dealt.repartition("x", "y", "slot").sortWithinPartitions("x", "y", "z")
    ordered = ordered.select("x", "y", "z", (F.col("slot") >= 0).cast("long").alias("hot"), "n")
    return ordered.mapInArrow(flow, "x long, y long, z long, n long")


def graph(texts: DataFrame, seed: int, hot: set[int], least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges ``(x, y, z, n)`` and nodes ``(x, y, n)`` from ``least`` on, words ``(x, n)``; nodes and words by flow.

    One exchange and one sort by node serve all three.
    """
    stored = materialize(_flows(_counted_edges(texts, seed, hot), least), "graph")
    n = F.sum("n").alias("n")
    # Only nodes with slots have several rows, at most one for each slot; words have one for each task.
    nodes = stored.where("z IS NULL AND y IS NOT NULL").groupBy("x", "y").agg(n).where(F.col("n") >= least)
    words = stored.where("y IS NULL").groupBy("x").agg(n).where(F.col("n") >= least)
    return stored.where("z IS NOT NULL"), nodes, words


def unary_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(x, y, before, after, n)``: nodes that one edge enters and one edge leaves with all their flow."""
    into = edges.select(F.col("x").alias("before"), F.col("y").alias("x"), F.col("z").alias("y"), "n")
    out = edges.select("x", "y", F.col("z").alias("after"), "n")
    return nodes.join(into, ["x", "y", "n"]).join(out, ["x", "y", "n"])


def paths(edges: DataFrame, unary: DataFrame) -> DataFrame:
    """``(path, place, x, y, z, n)``: edges in the order of their compacted path; ``path`` is the first edge.

    Flow enters every chain of unary nodes where a piece begins or where flows meet, so no chain is a cycle.
    """
    edge = F.struct("x", "y", "z")
    steps = unary.select(
        F.struct(F.col("x"), F.col("y"), F.col("after").alias("z")).alias("edge"),
        F.struct(F.col("before").alias("x"), F.col("x").alias("y"), F.col("y").alias("z")).alias("back"),
        F.lit(1).cast("long").alias("steps"),
    )
    steps = materialize(steps, "steps")
    while True:
        # What a pointer meets is a step itself, or the first edge of a path.
        met = steps.select(F.col("edge").alias("back"), F.col("back").alias("further"), F.col("steps").alias("more"))
        jumped = materialize(steps.join(met, "back", "left"), "jumped")
        if jumped.where("further IS NOT NULL").isEmpty():
            break
        more = F.col("steps") + F.coalesce("more", F.lit(0))
        steps = jumped.select("edge", F.coalesce("further", "back").alias("back"), more.alias("steps"))
    placed = edges.withColumn("edge", edge).join(steps, "edge", "left")
    return placed.select(F.coalesce("back", "edge").alias("path"), F.coalesce("steps", F.lit(0).cast("long")).alias("place"), "x", "y", "z", "n")


def _score(a: str, left: str, right: str) -> Column:
    """``floor(1000000 * a * a / (left * right))`` of three columns, exact."""
    wide, long = "decimal(38,0)", "decimal(18,0)"
    square = f"cast(cast({a} AS {long}) * cast({a} AS {long}) AS decimal(31,0))"
    above = f"cast(cast(1000000 AS decimal(7,0)) * {square} AS {wide})"
    return F.expr(f"{above} div cast(cast({left} AS {long}) * cast({right} AS {long}) AS {wide})")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, held: int = HELD_PERCENT
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of every language.

    ``held`` is a share in percent, from 1 to 100: an inner node of a path is held in any case.
    """
    if not 1 <= held <= 100:
        raise ValueError("held must be a percentage from 1 to 100")
    prepared(docs.sparkSession)
    texts = _pieces_of(docs, text_col, lang_col)
    seed = 0
    while True:
        known = dictionary(texts, seed)
        if known.groupBy("code").agg(F.count(F.lit(1)).alias("words")).where("words > 1").isEmpty():
            break
        seed += 1
    total = known.agg(F.sum("n")).first()[0] or 0
    # At most 1 / HOT_WORD words.
    hot = {r["code"] for r in known.where(F.col("n") >= max(1.0, HOT_WORD * total)).select("code").collect()}
    edges, nodes, flows = graph(texts, seed, hot, least)
    nodes = materialize(nodes, "nodes")
    unary = materialize(unary_nodes(edges, nodes), "unary")

    size = F.col("n").alias("most")
    beside = edges.select("x", "y", size).unionByName(edges.select(F.col("y").alias("x"), F.col("z").alias("y"), size))
    heaviest = beside.groupBy("x", "y").agg(F.max("most").alias("most"))
    # Compaction: an inner node of a path is held by the path's phrases as often as it occurs.
    branching = materialize(nodes.join(unary.select("x", "y"), ["x", "y"], "left_anti"), "branching")
    pairs = branching.join(heaviest, ["x", "y"], "left").where(F.col("most").isNull() | (100 * F.col("most") < held * F.col("n"))).select("x", "y", "n")

    word = flows.join(known.select(F.col("code").alias("x"), "lang", "word"), "x")
    word = materialize(word, "words")
    small = within_limit(word)

    def counted(rows: DataFrame, column: str, name: str, *more: str) -> DataFrame:
        side = word.select(F.col("x").alias(column), F.col("n").alias(name), *more)
        return rows.join(F.broadcast(side) if small else side, column)

    two = counted(counted(pairs.withColumnRenamed("n", "a"), "x", "l", "lang", F.col("word").alias("w1")), "y", "r", F.col("word").alias("w2"))
    two = two.select("lang", F.concat("w1", F.lit(b" "), "w2").alias("phrase"), "a", "l", "r").withColumn("score", _score("a", "l", "r"))
    # All edges of a path have its weight; it is the count of its inner nodes, too, so only the others are looked up.
    ahead = branching.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("n").alias("yz"))
    three = attach(edges.withColumnRenamed("n", "a"), branching.withColumnRenamed("n", "xy"), ["x", "y"], ["z"])
    three = attach(three, ahead, ["y", "z"], ["x"]).withColumns({c: F.coalesce(c, "a") for c in ("xy", "yz")})
    three = counted(three, "x", "nx", "lang", F.col("word").alias("w1"))
    three = counted(counted(three, "z", "nz", F.col("word").alias("w3")), "y", "ny", F.col("word").alias("w2"))
    first, second = _score("a", "nx", "yz"), _score("a", "xy", "nz")
    three = three.withColumns({"first": first, "second": second})
    early = F.col("first") <= F.col("second")
    three = three.select(
        "lang", F.concat("w1", F.lit(b" "), "w2", F.lit(b" "), "w3").alias("phrase"), "a",
        F.when(early, F.col("nx")).otherwise(F.col("xy")).alias("l"), F.when(early, F.col("yz")).otherwise(F.col("nz")).alias("r"),
        F.least("first", "second").alias("score"),
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    best = ranked.where(F.col("rank") <= top)
    # One row for each language.
    sizes = materialize(known.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    found = attach(best, sizes, ["lang"], ["phrase"], "inner")
    as_text = [F.decode(c, "UTF-8").alias(c) for c in ("lang", "phrase")]
    return found.select(as_text[0], F.col("rank").cast("long").alias("rank"), as_text[1], "a", "l", "r", "n", "score")


def compacted_paths(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> DataFrame:
    """``(path, place, x, y, z, n)`` as codes, and thus passages of any length that repeat ``n`` times."""
    prepared(docs.sparkSession)
    edges, nodes, _ = graph(_pieces_of(docs, text_col, lang_col), 0, set(), least)
    return paths(edges, unary_nodes(edges, materialize(nodes, "nodes")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


SQL = {
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
                regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
            FROM documents WHERE text IS NOT NULL),
        split AS (SELECT lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') AS w FROM pieces),
        placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
        grams AS (
            SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM placed),
        f1 AS (SELECT lang, w1, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
        f2 AS (SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
        f3 AS (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM grams WHERE w3 IS NOT NULL GROUP BY ALL),
        size AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
        c3 AS (SELECT * FROM f3 WHERE f >= 10),
        held AS (
            SELECT lang, w1, w2, max(f) AS most
            FROM (SELECT lang, w1, w2, f FROM c3 UNION ALL SELECT lang, w2, w3, f FROM c3) GROUP BY ALL),
        c2 AS (
            SELECT f2.* FROM f2 LEFT JOIN held USING (lang, w1, w2)
            WHERE f2.f >= 10 AND (most IS NULL OR 100 * most < 50 * f2.f)),
        cut3 AS (
            SELECT lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3 AS phrase, c3.f AS a,
                a1.f AS l1, b1.f AS r1, a2.f AS l2, b2.f AS r2,
                1000000 * c3.f * c3.f // (a1.f * b1.f) AS s1, 1000000 * c3.f * c3.f // (a2.f * b2.f) AS s2
            FROM c3 JOIN f1 a1 USING (lang, w1) JOIN f2 a2 USING (lang, w1, w2)
            JOIN f2 b1 ON b1.lang = c3.lang AND b1.w1 = c3.w2 AND b1.w2 = c3.w3
            JOIN f1 b2 ON b2.lang = c3.lang AND b2.w1 = c3.w3),
        cut AS (
            SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END AS l, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END AS r,
                least(s1, s2) AS score FROM cut3
            UNION ALL
            SELECT c2.lang, c2.w1 || ' ' || c2.w2, c2.f, x.f, y.f, 1000000 * c2.f * c2.f // (x.f * y.f)
            FROM c2 JOIN f1 x ON x.lang = c2.lang AND x.w1 = c2.w1 JOIN f1 y ON y.lang = c2.lang AND y.w1 = c2.w2),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM cut)
        SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN size USING (lang) WHERE rank <= 2000
    """
}
QUERIES = {"op11_collocations": op11_collocations}
