from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from cases import FOLDER

from hardwood.llm import mixing, near_dedup, packing, quality
from hardwood.llm.catalogue import oracle_sql, queries


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returns, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = found[name] = spark.read.parquet(f"{folder}/{name}")
    return found


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_columns(stages):
    names = list(stages)
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = quality.scored(stages["documents"], quality.learnt(stages["documents"], labels)).where("score >= 0.7")
    assert {r["doc_id"] for r in rows(stages["quality"])} == {r[0] for r in scored.select("doc.doc_id").collect()}
    assert 0 < stages["quality"].count() < stages["documents"].count()


def test_exact_stage(stages):
    last = {}
    for r in rows(stages["quality"]):
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    assert {r["doc_id"] for r in rows(stages["exact_dedup"])} == set(last.values())


def test_near_stage(stages):
    docs = rows(stages["exact_dedup"])
    sets = {}
    for r in docs:
        w = r["text"].encode().lower().split()
        sets[r["doc_id"]] = set(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else {tuple(w)}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {r["doc_id"] for r in rows(stages["near_dedup"])} == {find(d) for d in ids}
    assert near_dedup.Near() == near_dedup.Near(5, 80)


def test_mixing_stage(stages):
    wanted = mixing.mixed(stages["near_dedup"]).select("doc.doc_id", "copies").collect()
    found = Counter(r["doc_id"] for r in rows(stages["mixing"]))
    assert found == Counter({r["doc_id"]: r["copies"] for r in wanted if r["copies"]})


def test_packing_stage(stages):
    found = rows(stages["packing"])
    times = Counter(r["doc_id"] for r in rows(stages["mixing"]))
    encode = packing.encoder()
    length = {r["doc_id"]: len(encode(r["text"])) + 1 for r in rows(stages["near_dedup"])}
    tokens = defaultdict(int)
    places = defaultdict(list)
    for r in found:
        tokens[r["doc_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert tokens == {d: n * length[d] for d, n in times.items()}
    for held in places.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= 1024


def test_run_is_the_stages_in_turn(spark, stages):
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.columns == stages["packing"].columns
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert whole.select(key).exceptAll(stages["packing"].select(key)).count() == 0
    assert whole.count() == stages["packing"].count()


def test_registered():
    names = list(queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(oracle_sql()) <= set(names)
