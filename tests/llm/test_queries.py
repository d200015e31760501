"""The registered queries against DuckDB, and the pipeline stage by stage against brute force."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import compare, duck
from terrace.llm import minhash, mixing, quality, toxicity
from terrace.llm.oracle import ORACLE
from terrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    res = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert res["ok"], res


def test_all_are_registered():
    names = set(entry.queries())
    assert names >= set(QUERIES) | {"pipeline"} and len(QUERIES) == 13
    assert set(entry.oracle_sql()) <= names


def test_pipeline_stages(spark, tmp_path):
    library = pytest.importorskip("tiktoken")
    tokenizers = pytest.importorskip("public_tokenizers")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        seen.append((name, docs))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    seen.append(("end", docs))
    rows = [[r.asDict() for r in d.collect()] for _, d in seen]
    assert [n for n, _ in seen] == ["quality", "toxicity", "near_dedup", "mix", "byte_bpe", "end"]
    assert all(d.columns == seen[0][1].columns for _, d in seen[:5])

    model, _ = quality.train(seen[0][1], labels)
    good = [r["doc_id"] for r in rows[0] if model.scores(__import__("numpy").array([quality.statistics(r["text"])]))[0] >= 0.3]
    assert sorted(r["doc_id"] for r in rows[1]) == sorted(good)
    lexicon = toxicity.learn(seen[1][1], labels)
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(r["doc_id"] for r in rows[1] if lexicon.score(r["text"]) < 0.5)

    sets = {r["doc_id"]: set(minhash.shingle_set(r["text"], 5).tolist()) for r in rows[2]}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert sorted(r["doc_id"] for r in rows[3]) == [i for i in ids if find(i) == i]

    taken = {r.doc_id: r.copies for r in mixing.mix(seen[3][1]).collect()}
    got = {}
    for r in rows[4]:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: n for i, n in taken.items() if n}

    from terrace.llm.bpe import read_ranks
    codec = library.Encoding("own", pat_str=tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    texts = {r["doc_id"]: r["text"] for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    for r in rows[5]:
        want = codec.encode_ordinary(texts[r["doc_id"]])
        assert list(r["ids"]) == want and r["n_tokens"] == len(want)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "n_tokens" in out.columns
