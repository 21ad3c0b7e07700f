import re
from collections import Counter

import numpy as np
import pytest
from cases import EDGES, FOLDER

from hardwood.llm import outliers as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts_of(found):
    return [(r["doc_id"], *[r[c] for c in COLUMNS], r["base_failed"]) for r in found.select("doc.doc_id", *[f"counts.{c}" for c in COLUMNS], "base_failed").collect()]


def test_query(spark, documents):
    found = op.op1_outliers(spark, FOLDER).collect()
    assert len(found) == len(documents)
    for r in found:
        assert (*[r[c] for c in COLUMNS], r["base_failed"]) == base(documents[r["doc_id"]]["text"])
        assert not (r["base_failed"] and r["kept"])


def test_edges(edges):
    assert sorted(map(str, counts_of(op.judged(edges)))) == sorted(str((d, *base(t))) for d, t, *_ in EDGES)


def test_empty(nothing):
    assert op.judged(nothing).count() == 0


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "x " * 30, "a b c d e f\n\na b c d e f\n \n", "|#| <b> é😀 $", "q\x0bq\x0cq q q q"])
def test_counts(make, text):
    assert counts_of(op.judged(make([(1, text)]))) == [(1, *base(text))]


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(4)
    p = 3
    mix = rng.normal(size=(p, p))
    good = rng.normal(size=(900, p)) @ mix.T + 5
    bad = rng.normal(size=(100, p)) * 0.3 + 40
    return good, bad, mix


def test_estimates_withstand_a_tenth_of_outliers(spark, cloud):
    """The robust centre and covariance are near those of the good rows alone; plain ones are not."""
    good, bad, mix = cloud
    rows = spark.createDataFrame([("g", [float(v) for v in r]) for r in np.vstack([good, bad])], "g string, x array<double>")
    fit = op.robust_fits(rows, [1e-3] * 3).collect()
    assert len(fit) == 1
    mean, cov = np.array(fit[0]["mean"]), np.linalg.inv(np.array(fit[0]["inverse"]).reshape(3, 3))
    assert np.abs(mean - good.mean(0)).max() < 0.5
    assert np.abs(cov / np.cov(good.T, bias=True) - 1).max() < 0.6
    assert np.abs(np.vstack([good, bad]).mean(0) - good.mean(0)).max() > 3


def brute(rows, floors):
    """The same C-steps on one array: starts, halves by distance bins, smaller determinant, reweighting."""
    p = rows.shape[1]
    distance = lambda mean, cov: np.einsum("ij,jk,ik->i", rows - mean, np.linalg.inv(cov), rows - mean)

    def raised(cov, least):
        return cov + np.diag(np.maximum(np.square(least) - np.diag(cov), 0) + 1e-6 * np.square(least))

    def fit(part):
        return part.mean(0), raised(np.cov(part.T, bias=True), floors)

    low = lambda v: np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]
    median = low(rows)
    scale = np.maximum(1.4826 * low(np.abs(rows - median)), floors)
    off = (rows - median) / scale
    sign = off * np.sqrt(p) / np.linalg.norm(off, axis=1, keepdims=True)
    starts = [np.diag(scale**2), raised(np.cov(sign.T, bias=True), [0.3] * p) * np.outer(scale, scale)]
    ends = []
    for cov in starts:
        mean = median
        for _ in range(op.STEPS):
            bins = np.floor(np.log2(np.maximum(distance(mean, cov), 1e-6)) * op.BINS_PER_OCTAVE)
            before = np.searchsorted(np.sort(bins), bins)
            mean, cov = fit(rows[before < op.HALF * len(rows)])
        ends.append((np.linalg.slogdet(cov)[1], mean, cov))
    _, mean, cov = min(ends, key=lambda e: e[0])
    grow = op.HALF / op._chi2_cdf(op.chi2_quantile(op.HALF, p), p + 2)
    return fit(rows[distance(mean, cov) / grow <= op.chi2_quantile(0.975, p)])


@pytest.mark.parametrize("limits", ["1000000", "0"])
def test_same_as_on_one_array(spark, cloud, limits):
    good, bad, _ = cloud
    groups = {"hot": np.vstack([good, bad]), "small": good[:150] * 2 - 3}
    data = [(g, [float(v) for v in r]) for g, rows in groups.items() for r in rows]
    spark.conf.set("spark.hardwood.broadcastRows", limits)
    spark.conf.set("spark.hardwood.blockRows", "100")
    try:
        fits = {r["g"]: r for r in op.robust_fits(spark.createDataFrame(data, "g string, x array<double>"), [0.1] * 3).collect()}
    finally:
        spark.conf.unset("spark.hardwood.broadcastRows")
        spark.conf.unset("spark.hardwood.blockRows")
    for g, rows in groups.items():
        mean, cov = brute(rows, [0.1] * 3)
        assert np.allclose(fits[g]["mean"], mean, atol=0.02)
        assert np.allclose(np.linalg.inv(np.array(fits[g]["inverse"]).reshape(3, 3)), cov, rtol=0.05, atol=0.02)


def test_junk_goes_and_clean_texts_stay(make):
    rng = np.random.default_rng(8)
    words = [f"{'abcdefghij'[i % 10]}{'lmnopq'[i % 6]}{'rstuv'[i % 5] * (1 + i % 4)}" for i in range(400)]
    clean = [(i, " ".join(rng.choice(words, rng.integers(30, 300)))) for i in range(400)]
    junk = [(1000 + i, " | ".join(rng.choice(words, 80)) + " ### $$$") for i in range(20)]
    kept = {r["doc_id"] for r in op.judged(make(clean + junk)).where("kept").select("doc.doc_id").collect()}
    assert not kept & {d for d, _ in junk}
    assert len(kept) >= 398


def prose(rng, n, start, lang, source):
    """Texts of sentences with a mark now and then, none of them odd."""
    words = [f"{'abcdefghij'[i % 10]}{'lmnopq'[i % 6]}{'rstuv'[i % 5] * (1 + i % 4)}" for i in range(400)]
    texts = []
    for i in range(n):
        lines = [" ".join(rng.choice(words, rng.integers(6, 14))).capitalize() + rng.choice([".", ".", ".", "!"]) for _ in range(rng.integers(6, 25))]
        texts.append((start + i, "\n".join(lines), lang, source))
    return texts


def test_kept_by_brute_force(spark, make):
    """Groups by language and source, by language, and all; fits, distances and the cut-off of every row on arrays."""
    rng = np.random.default_rng(12)
    rows = prose(rng, 150, 0, "en", "a") + prose(rng, 120, 1_000, "fr", "a") + prose(rng, 60, 2_000, "de", "a") + prose(rng, 70, 3_000, "de", None)
    rows += prose(rng, 40, 4_000, None, "b")
    rows += [(5_000 + i, t.replace(" ", " # ", 12 + 8 * i), lang, source) for i, (_, t, lang, source) in enumerate(rows[::40])]
    rows += [(6_000, "few words", "en", "a"), (6_001, None, "en", "a"), (6_002, "a b c d e " * 30, "fr", "a")]
    docs = make(rows)
    found = {r["doc_id"]: r for r in op.judged(docs).select("doc.doc_id", "counts", "base_failed", "distance", "kept").collect()}
    vectors = {r["doc_id"]: np.array(r["x"]) for r in docs.select("doc_id", op.counted(docs["text"]).alias("c")).select("doc_id", op.vector("c").alias("x")).collect()}
    floors = list(op.FLOORS.values())
    usable = [r for r in rows if not found[r[0]]["base_failed"]]
    assert {r[0] for r in rows} - {r[0] for r in usable} == {6_000, 6_001, 6_002}

    def size(*keys):
        return sum(all(r[2 + i] == k for i, k in keys) for r in usable)

    def group(r):
        if size((0, r[2]), (1, r[3])) >= op.LEAST_ROWS:
            return r[2], r[3]
        rest = sum(size((0, r[2]), (1, s)) for s in {x[3] for x in rows} if size((0, r[2]), (1, s)) < op.LEAST_ROWS)
        return (r[2],) if rest >= op.LEAST_ROWS else ()

    members = {}
    for r in usable:
        members.setdefault(group(r), []).append(r[0])
    assert len(members) == 4 and len(members[()]) < op.LEAST_ROWS < len(members[("de",)])
    cut = op.chi2_quantile(1 - op.TAIL, len(floors))
    rejected = 0
    for ids in members.values():
        if len(ids) < op.LEAST_ROWS:
            assert all(found[i]["kept"] and found[i]["distance"] is None for i in ids)
            continue
        mean, cov = brute(np.array([vectors[i] for i in ids]), floors)
        for i in ids:
            off = vectors[i] - mean
            want = off @ np.linalg.inv(cov) @ off
            assert found[i]["distance"] == pytest.approx(want, rel=0.1, abs=0.05)
            if abs(want / cut - 1) > 0.1:
                assert found[i]["kept"] == (want <= cut)
            rejected += not found[i]["kept"]
    assert rejected >= 5


def test_each_statistic_can_reject_alone(make):
    rng = np.random.default_rng(13)
    rows = prose(rng, 300, 0, "en", "a")
    plain = rows[0][1].replace("!", ".")
    lines = plain.split("\n")
    odd = {
        "dup_lines": "\n".join(x for line in lines for x in (line, "Again and once more so.")),
        "symbols": plain.replace(" ", " # ", 60),
        "exclaim": plain.replace(" ", "! "),
        "upper": plain.upper(),
        "word_length": plain.replace(" ", ""),
    }
    odd["word_length"] = " ".join(odd["word_length"][i : i + 40] for i in range(0, len(odd["word_length"]), 40)) * 2
    docs = make(rows + [(1_000 + i, t, "en", "a") for i, t in enumerate(odd.values())])
    found = {r["doc_id"]: r["kept"] for r in op.judged(docs).select("doc.doc_id", "kept").collect()}
    assert sum(found[r[0]] for r in rows) >= 299
    assert {name: found[1_000 + i] for i, name in enumerate(odd)} == dict.fromkeys(odd, False)


def test_chi2_quantile():
    for share, dof, want in [(0.975, 7, 16.013), (0.75, 3, 4.108), (0.999, 5, 20.515)]:
        assert abs(op.chi2_quantile(share, dof) / want - 1) < 0.02
