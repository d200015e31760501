"""Tokenising, near duplicates, mixing and token files against brute force and libraries."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from terrace.llm import bpe, minhash, mixing, queries, token_orc
from terrace.llm.common import clear_stages, components, new_path, stage

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
WORD = "[^\x20\x09-\x0D]+"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(WORD, lower(text or ""))


# --- byte-level BPE -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_equals_library(ranks, library):
    codec, rnd = bpe.TreeBPE(ranks, P.PATTERN), random.Random(3)
    letters = "aàbeé \n\t\x1c\x85\xa0   'sSt1234567890٣²!?.,漢字テスト🙂ß́"
    for k in range(1500):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
        if k % 4 == 0:
            text += rnd.choice(letters) * rnd.randint(1, 600)
        if k % 7 == 0:
            text += "".join(rnd.choice("abcdestinor") for _ in range(300))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_join_is_a_monoid(ranks):
    codec, rnd = bpe.TreeBPE(ranks, P.PATTERN), random.Random(5)
    for _ in range(200):
        piece = "".join(rnd.choice("theiraoun") for _ in range(rnd.randint(2, 80))).encode()
        cut = rnd.randrange(len(piece))
        whole = tuple(codec.merge(piece))
        assert codec.join(tuple(codec.merge(piece[:cut])), tuple(codec.merge(piece[cut:]))) == whole
        assert codec.parts(piece) == whole


def test_bpe_rows_nulls_and_clashing_columns(spark, ranks, library):
    long = "ab" * 40000 + " word" * 20000
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (2, None, None), (3, "", "x"), (None, "é", "y"), (4, long, "z")]
    df = docs(spark, rows).withColumn("ids", F.lit("old")).withColumn("decoded", F.lit(1))
    out = bpe.digest(bpe.decode(bpe.encode(df, ranks, P.PATTERN), ranks, P.PATTERN)).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append(Row(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                        hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, want), key=str)
    once = bpe.digest(bpe.round_trip(df, ranks, P.PATTERN)).collect()
    assert sorted(map(tuple, once), key=str) == sorted(map(tuple, want), key=str)
    empty = bpe.digest(bpe.decode(bpe.encode(df.limit(0), ranks, P.PATTERN), ranks, P.PATTERN))
    assert empty.count() == 0


def test_op2_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    out = queries.op2_byte_bpe(spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- components ----------------------------------------------------------------------------

def test_components_match_union_find(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# --- MinHash near duplicates ------------------------------------------------------------------

def brute_duplicates(rows, k, percent):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return sorted(((i, len(sets[a]), least.get(find(a)), i == least.get(find(a))) for a, (i, _) in enumerate(rows)), key=str)


def near_rows(seed, groups=6, copies=9):
    rnd, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    for g in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 8, 40, 90]))]
        for c in range(copies):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(text) // 9))):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            rows.append((len(rows) * 3 + 1, " ".join(text)))
    return rows


@pytest.mark.parametrize("k,chunk", [(2, 100_000), (5, 100_000), (2, 150)])
def test_duplicates_match_brute_force(spark, k, chunk):
    rows = near_rows(k) + [(0, None), (2, ""), (5, " \n\t"), (8, "one"), (11, "ONE"), (14, "A b"), (17, "a B"), (17, "a B"),
                           (20, "x" * 30000 + " y"), (23, "É a é"), (26, "é a é"), (None, "lonely words here now"),
                           (29, "lonely words here now"), (32, "same id other text " * 3), (32, "quite another text")]
    rnd = random.Random(9)
    base = [f"v{i}" for i in range(60)]
    for c in range(120):  # one group much larger than a chunk
        text = list(base)
        for _ in range(rnd.choice([0, 1, 2, 5])):
            text[rnd.randrange(60)] = f"u{rnd.randrange(30)}"
        rows.append((1000 + c, " ".join(text)))
    got = minhash.duplicates(docs(spark, [(i, t, "s") for i, t in rows]), minhash.Params(words=k, chunk=chunk, hubs=3))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, bool(r.kept)) for r in got.collect()), key=str)
    want = [(i, n, i if n == 0 else c, True if n == 0 else kept) for i, n, c, kept in brute_duplicates(rows, k, 80)]
    assert got == sorted(want, key=str)


def test_link_within_equals_all_pairs():
    rnd = random.Random(4)
    for _ in range(30):
        sets = [np.unique(np.array([rnd.randrange(24) for _ in range(rnd.randint(1, 14))], dtype=np.uint64))
                for _ in range(rnd.randint(2, 25))]
        got = minhash.link_within(sets, 80, starts=2)
        plain = [set(s.tolist()) for s in sets]
        parent = list(range(len(sets)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a in range(len(sets)):
            for b in range(a):
                if 100 * len(plain[a] & plain[b]) >= 80 * len(plain[a] | plain[b]):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
        assert got == [find(i) for i in range(len(sets))]


def test_sketch_estimates_similarity_and_fills():
    for n, shared in ((1, 1), (5, 4), (300, 240), (3000, 2400)):
        rng = np.random.default_rng(n)
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:shared], pool[n:2 * n - shared]]))
        x, y = minhash.sketch(a, 252), minhash.sketch(b, 252)
        assert not (x == 2**64 - 1).any()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((x == y).mean() - true) < (0.15 if n > 5 else 0.45)


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    rows = [(3, "the quick brown fox jumps over"), (1, "The quick brown fox jumps over"), (1, "The quick brown fox jumps over"),
            (2, None), (2, None), (4, ""), (None, "another text of some six words"), (5, "short")]
    df = docs(spark, [(i, t, "s") for i, t in rows]).withColumn("node", F.lit("n")).withColumn("kept", F.lit(7))
    out = minhash.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, "The quick brown fox jumps over"), (2, None), (2, None), (4, ""), (None, "another text of some six words"),
         (5, "short")], key=str)
    assert minhash.deduplicate(df.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


def test_mix_targets_limits_and_reruns(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 40)), rnd.choice(["a", "b", "c", "Z", "é", None, "c", "c", "c", "c"]))
            for i in range(900)] + [(7, "x y z", "a")] * 3 + [(1000, None, "b"), (1001, "", None), (None, "p q", "a")]
    df = docs(spark, rows).withColumn("size", F.lit("clash")).withColumn("key", F.lit(1))
    out = mixing.mix(df, rows_per_slice=50, least_slices=4).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want, taken = brute_targets(sizes), {}
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= 80
    assert sum(taken.values()) <= sum(sizes.values())
    again = mixing.mix(df.repartition(7), rows_per_slice=9, least_slices=40).collect()
    key = lambda r: tuple(str(r[c]) for c in ("doc_id", "source", "size", "taken"))
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixed_documents_repeat_rows(spark):
    rows = [(i, "w " * (i % 9), "ab"[i % 2]) for i in range(60)] + [(5, "w w", "b")] * 2
    df = docs(spark, rows).withColumn("copies", F.lit("x"))
    taken = mixing.mix(df).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {r.doc_id: r.n for r in taken if r.n}


def test_mixing_is_native():
    import inspect
    source = inspect.getsource(mixing)
    assert not re.search(r"pandas|arrow|udf|\.rdd|numpy", source, re.I)


# --- ORC token files ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_text_encoder_equals_library(word_bpe):
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = token_orc.TextEncoder(f.read())
    assert encoder.plain
    rnd = random.Random(6)
    letters = "aàbeéßÿÞ \n\t\x1c\x85\xa0  'sSt1²2 !?.,漢字Σς🙂́İK"
    for _ in range(1500):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) + rnd.choice(
            ["", "", " don't ", "'ll", "<|x", "<|endoftext|>", " WORD, Mixed."])
        assert encoder.encode(text) == word_bpe.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files(spark, word_bpe):
    rows = [(i * 7 % 400 - 50, f"Text number {i}, with its words" * (i % 5), "s") for i in range(400)]
    rows += [(3, "again", "s")] * 2 + [(9000, None, "s"), (9001, "word " * 30000, "s"), (None, "no id", "s")]
    path = new_path(spark, "test-tokens")
    df = docs(spark, rows).withColumn("ids", F.lit("clash")).withColumn("offset", F.lit(1))
    token_orc.write_tokens(df, path, P.path("word_bpe_49k.json"), 2)
    got = token_orc.digest(spark, path).collect()
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i or 0))
    want = {}
    for i, t, _ in rows:
        ids = word_bpe.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    at = 0
    for r in by_start:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        at += r.n_tokens
    one = token_orc.read_tokens(spark, path, [9001])
    assert [r.n for r in one.collect()] == [30001]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,9001)]" in one._jdf.queryExecution().toString()
    empty = f"{path}-empty"
    token_orc.write_tokens(df.limit(0), empty, P.path("word_bpe_49k.json"), 2)
    assert token_orc.digest(spark, empty).count() == 0


def test_staged_tables_keep_the_schema(spark):
    df = stage(docs(spark, [(1, "a", "s")]), "t")
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"] and df.count() == 1


def test_staged_tables_of_an_application_can_be_cleared(spark):
    df = stage(docs(spark, [(1, "a", "s")]), "t")
    assert df.inputFiles()
    clear_stages(spark)
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|not_found"):
        df.collect()


def test_mixing_takes_columns_that_have_no_hash(spark):
    df = docs(spark, [(i, "word " * 10, "ab"[i % 2]) for i in range(20)]).withColumn(
        "m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("n", F.array(F.create_map(F.lit(1), F.lit("x"))))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and all(r.m == {"k": r.doc_id} for r in out.collect())
    assert out.count() == sum(r.copies for r in mixing.mix(df.drop("m", "n")).collect())


def test_token_starts_over_split_and_many_files(spark):
    rows = [(i, "some words here " * (i % 5), "s") for i in range(40)]
    path = new_path(spark, "tokens-split")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        token_orc.write_tokens(docs(spark, rows), path, P.path("word_bpe_49k.json"), 2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    at = 0
    for r in sorted(token_orc.digest(spark, path).collect()):
        assert r.start == at
        at += r.n_tokens
    # names beyond five digits: the number counts, not the text
    names = spark.createDataFrame([("part-99999-x-c000.orc", 99_999, 5), ("part-100000-x-c000.orc", 100_000, 7)], "file string, task long, n int")
    assert {r.task: r.first for r in token_orc.task_starts(names).collect()} == {99_999: 0, 100_000: 5}
    read = token_orc.read_tokens(spark, path)
    assert read.where(F.col("file").substr(6, 5).cast("long") != F.col("task")).count() == 0
