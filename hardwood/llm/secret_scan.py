"""Secret scans: fixed forms, and a battery of randomness tests. DataFrame operations only.

Each kind's matches are cut out of the whole text with the gaps before them, in one pass; places are
running sums of lengths, in code points. Beside the fixed kinds, every run of token characters that mixes
letters and digits, or upper and lower case inside, or is all upper case, is a candidate, and the smallest of the ``ENCODINGS``
that holds all its characters is inferred. Runs of lower-case letters alone are words and no candidates. Three tests ask whether it
is a random string over that alphabet: chi-squared for uniform use (equal pairs, where a letter is expected fewer than five
times), Wald and Wolfowitz' runs above and below the middle, and serial correlation. Fisher's method joins their probabilities.

Candidates are dismissed as not random by a step-up rule over the whole table (Benjamini and
Hochberg), weighted by length, because a longer text has more power to be told from a random one. At most
a share of ``RATE`` of the dismissed ones is expected to be random. The others become spans of kind
``random``, unless they overlap a span of a fixed kind.

Tokens of equal weighted probability share a bin and its fate. Null and empty texts have no spans. Places refer to the whole text, of whatever length. Repeated rows
are scanned each; an empty table gives an empty result. Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table, text_of, wrapped
from hardwood.operators.balance import attach
from hardwood.session import materialize

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is too short fails whole, so the least length may be part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED, LEAST_TOKEN = 6, 16
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_TOKEN
KINDS = ("assign", "access", "hex", "random")
RATE = 0.05

UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Smallest first; the position of a character in its alphabet is the number the tests work on.
ENCODINGS = {
    "hex": (r"^[0-9a-f]+$", DIGITS + LOWER[:6]),
    "upper_hex": (r"^[0-9A-F]+$", DIGITS + UPPER[:6]),
    "base32": (r"^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    "base36_upper": (r"^[A-Z0-9]+$", UPPER + DIGITS),
    "base36_lower": (r"^[a-z0-9]+$", LOWER + DIGITS),
    "base62": (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    "base64": (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    "base64_url": (r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    "any": (r"^", UPPER + LOWER + DIGITS + "+/-_"),
}


def _cut(text: Column, pattern: str, group: int | None = None) -> Column:
    """The matches of a pattern, each with the length of the gap before it and (if asked) one group's length."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    group_of = matches if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), group_of.alias("part"))
    found = F.transform(
        F.slice(zipped, 1, F.size(matches)),
        lambda x: F.struct(
            F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["match"]).cast("long").alias("length"),
            F.length(x["part"]).alias("part"),
            x["match"].alias("match"),
        ),
    )
    return F.when(text.rlike(pattern), found)


def _placed(cut: DataFrame, number: int, least: int) -> DataFrame:
    """``(row, kind, start, end, token)`` of one kind; running sums within a row."""
    each = cut.select("row", F.posexplode(KINDS[number]).alias("i", "m"))
    up_to = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap") + F.col("m.length")).over(up_to)
    placed = each.select("row", F.lit(number).alias("kind"), end.alias("end"), "m")
    return placed.where(F.col("m.part") >= least).select(
        "row", "kind", (F.col("end") - F.col("m.length")).alias("start"), "end", F.col("m.match").alias("token")
    )


def _tail(z: Column) -> Column:
    """P(N > z) for z >= 0, by Abramowitz and Stegun 26.2.17 (error below 1e-7), never quite 0."""
    t = 1.0 / (1.0 + 0.2316419 * z)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.greatest(F.exp(-z * z / 2.0) * 0.3989422804014327 * series, F.lit(1e-300))


def _upper(z: Column) -> Column:
    """P(N > z) for any z."""
    return F.when(z >= 0, _tail(z)).otherwise(1.0 - _tail(-z))


def tested(tokens: DataFrame) -> DataFrame:
    """``(token, encoding, n, p)``: the probability that a random string looks as odd as the token."""
    name = F.lit("any")
    alphabet = F.lit(ENCODINGS["any"][1])
    for key, (pattern, letters) in reversed([e for e in ENCODINGS.items() if e[0] != "any"]):
        name = F.when(F.col("token").rlike(pattern), F.lit(key)).otherwise(name)
        alphabet = F.when(F.col("token").rlike(pattern), F.lit(letters)).otherwise(alphabet)
    # Padding is not part of the encoded string.
    bare = F.regexp_replace("token", "=", "")
    base = tokens.select("token", name.alias("encoding"), alphabet.alias("alphabet"), F.split(bare, "").alias("chars"))
    base = base.withColumn("x", F.transform("chars", lambda c: (F.position(c, F.col("alphabet")) - 1).cast("double")))
    base = base.withColumn("n", F.size("x").cast("double")).withColumn("a", F.length("alphabet").cast("double"))
    zero = F.lit(0.0)
    squares = F.aggregate(
        F.array_distinct("x"), zero, lambda s, c: s + F.pow(F.size(F.filter("x", lambda y: y == c)).cast("double"), F.lit(2.0))
    )
    middle = (F.col("a") - 1) / 2
    high = F.transform("x", lambda y: (y > middle).cast("int"))
    pairs = F.arrays_zip(F.slice("x", 1, F.size("x") - 1).alias("p"), F.slice("x", 2, F.size("x")).alias("q"))
    base = base.select(
        "token", "encoding", "n", "a",
        squares.alias("squares"), (squares * F.col("a") / F.col("n") - F.col("n")).alias("chi2"),
        F.aggregate(high, zero, lambda s, y: s + y).alias("n1"),
        F.aggregate(pairs, F.lit(1.0), lambda s, y: s + ((y["p"] > middle) != (y["q"] > middle)).cast("double")).alias("runs"),
        F.aggregate(pairs, zero, lambda s, y: s + (y["p"] - middle) * (y["q"] - middle)).alias("serial"),
        F.aggregate("x", zero, lambda s, y: s + (y - middle) * (y - middle)).alias("spread"),
    )
    dof = F.col("a") - 1
    # So many equal pairs or more, if their number is Poisson: a chi-squared probability again.
    pairs_met, pairs_expected = (F.col("squares") - F.col("n")) / 2, F.col("n") * (F.col("n") - 1) / (2 * F.col("a"))
    twice = 2 * F.greatest(pairs_met, F.lit(1.0))
    by_pairs = F.when(pairs_met < 1, 1.0).otherwise(
        1.0 - _upper((F.pow(2 * pairs_expected / twice, F.lit(1 / 3)) - (1 - 2 / (9 * twice))) / F.sqrt(2 / (9 * twice)))
    )
    # Wilson and Hilferty's cube root; only too uneven use speaks against randomness.
    cube = (F.pow(F.col("chi2") / dof, F.lit(1 / 3)) - (1 - 2 / (9 * dof))) / F.sqrt(2 / (9 * dof))
    both = 2 * F.col("n1") * (F.col("n") - F.col("n1"))
    expected = both / F.col("n") + 1
    variance = both * (both - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1))
    # On one side of the middle throughout: as odd as n tosses of a coin.
    by_runs = F.when(variance > 0, 2 * _tail(F.abs(F.col("runs") - expected) / F.sqrt(variance))).otherwise(F.pow(F.lit(2.0), 1 - F.col("n")))
    by_serial = 2 * _tail(F.abs(F.col("serial") / F.greatest(F.col("spread"), F.lit(1e-9))) * F.sqrt("n"))
    by_use = F.greatest(F.when(F.col("n") < 5 * F.col("a"), by_pairs).otherwise(_upper(cube)), F.lit(1e-300))
    joined = -2.0 * (F.log(by_use) + F.log(F.greatest(by_runs, F.lit(1e-300))) + F.log(F.greatest(by_serial, F.lit(1e-300))))
    half = joined / 2.0
    fisher = F.exp(-half) * (1.0 + half + half * half / 2.0)
    return base.select("token", "encoding", "n", F.least(F.greatest(fisher, F.lit(1e-300)), F.lit(1.0)).alias("p"))


def random_tokens(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """The distinct tokens that are not dismissed, from ``(token, encoding, n, p)``.

    The step-up rule needs ranks over all tokens. Probabilities are added up in bins of a fiftieth of a
    power of ten, at most 15,000 whatever the number of tokens, and a bin is dismissed as a whole.
    """
    total = tokens.agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("length"))
    # One row is joined to all.
    weighed = tokens.withColumn("one", F.lit(1)).join(F.broadcast(total.withColumn("one", F.lit(1))), "one")
    weight = F.col("n") * F.col("m") / F.col("length")
    weighed = weighed.withColumn("bin", F.floor(-50.0 * F.log10(F.least(F.col("p") / weight, F.lit(1.0)))).cast("int"))
    bins = weighed.groupBy("bin", "m").agg(F.count(F.lit(1)).alias("k"))
    rank = F.sum("k").over(Window.orderBy(F.col("bin").desc()))
    passed = bins.withColumn("rank", rank).where(F.pow(F.lit(10.0), -F.col("bin") / 50.0) <= rate * F.col("rank") / F.col("m"))
    last = passed.agg(F.min("bin").alias("last")).withColumn("one", F.lit(1))
    left = weighed.join(F.broadcast(last), "one", "left").where(F.col("last").isNull() | (F.col("bin") < F.col("last")))
    return left.select("token", "encoding", "p")


def secrets(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> DataFrame:
    """All rows as ``doc`` with ``spans``, an array of ``(start, kind, end, token)`` in order."""
    prepared(docs.sparkSession)
    text = text_of(f"doc.`{text_col}`")
    cut = wrapped(docs).select(
        F.struct(*[F.col(f"doc.`{c}`") for c in docs.columns if c != text_col]).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        *[_cut(text, p, 1 if k == "assign" else None).alias(k) for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX, CANDIDATE))],
    )
    cut = materialize(cut, "matches")
    fixed = _placed(cut, 0, LEAST_ASSIGNED).union(_placed(cut, 1, 0)).union(_placed(cut, 2, 0))
    token = F.col("token")
    mixed = (token.rlike("[0-9]") & token.rlike("[A-Za-z]")) | token.rlike("[a-z].*[A-Z]") | token.rlike("^[A-Z]+=*$")
    loose = _placed(cut, 3, 0).where(mixed)
    loose = materialize(loose, "candidates")
    chosen = materialize(random_tokens(materialize(tested(loose.select("token").distinct()), "tested"), rate), "random")
    loose = attach(loose, chosen.select("token"), ["token"], ["row", "start"], "inner")
    every = fixed.unionByName(loose.select("row", "kind", "start", "end", "token"))
    # Places of fixed spans before and after a candidate tell whether one overlaps it.
    order = Window.partitionBy("row").orderBy("start", "kind")
    is_fixed = F.col("kind") < 3
    before = F.max(F.when(is_fixed, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(is_fixed, F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    every = every.withColumn("before", before).withColumn("after", after)
    clear = F.coalesce(F.col("before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True))
    every = every.where(is_fixed | clear)
    listed = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "token"))).alias("spans"))
    whole = cut.select("row", "doc").join(listed, "row", "left")
    empty = F.array().cast(listed.schema["spans"].dataType)
    return whole.select("doc", F.coalesce("spans", empty).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def n(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    fixed = _written(F.filter("spans", lambda s: s["kind"] < 3))
    return found.select(
        "doc.doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(fixed.cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


SQL: dict[str, str] = {}
QUERIES = {"op7_secret_scan": op7_secret_scan}
