"""Whitening, alignment of two tokenizers, and sharding."""

import hashlib
import itertools
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cantilena.llm import sharding as S
from cantilena.llm import token_alignment as A
from cantilena.llm import whitening as V

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

# --- whitening


def vectors(n, d, seed=1):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, d)) * np.linspace(3, 0.1, d)).astype(np.float32)


def test_two_sums_and_slices_lose_nothing():
    r = np.random.default_rng(2)
    a, b = r.normal(size=500) * 10.0 ** r.integers(-20, 20, 500), r.normal(size=500)
    s, rest = V.two_sum(a, b)
    assert all(Fraction(x) + Fraction(y) == Fraction(p) + Fraction(q) for x, y, p, q in zip(a, b, s, rest, strict=True))
    y = r.normal(size=(50, 4)) * 1000
    parts = V.slices(y, np.zeros_like(y))
    assert all(Fraction(v) == sum(Fraction(p.ravel()[i]) for p in parts) for i, v in enumerate(y.ravel()))


def test_covariance_is_that_of_exact_fractions(spark):
    x = vectors(300, 5)
    x[:, 0] += 5000  # far from 0: products that aren't centred would lose most digits
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    rows = df.select(V.integers().alias("x"))
    exact = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in x]
    n, sums = len(exact), [sum(c) for c in zip(*exact, strict=True)]
    high, low = V.covariance(rows, 5, V.exact_mean(sums, n), n)
    for i, j in itertools.product(range(5), range(5)):
        want = sum((Fraction(v[i]) - Fraction(sums[i], n)) * (Fraction(v[j]) - Fraction(sums[j], n)) for v in exact) / n
        assert abs(Fraction(high[i, j]) + Fraction(low[i, j]) - want) <= abs(want) * Fraction(1, 10**26)


def test_whitening_by_brute_force(spark):
    x = vectors(400, 12)
    df = spark.createDataFrame([(i, v.tolist(), "q") for i, v in enumerate(x)], "vec_id long, embedding array<float>, n string").repartition(3)
    out = V.whitened(df).orderBy("vec_id").collect()
    whole = np.floor(1024 * x.astype(float)) + 100_000
    y = whole - whole.mean(0)
    values, directions = np.linalg.eigh(y.T @ y / len(y))
    want = (y @ directions[:, ::-1][:, :8]) / np.sqrt(values[::-1][:8])
    got = np.array([[p["whitened"] for p in r["parts"]] for r in out])
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-8
    assert [p["component"] for p in out[0]["parts"]] == list(range(1, 9)) and out[0]["n"] == 400
    assert np.allclose([p["explained"] for p in out[0]["parts"]], values[::-1][:8] / values.sum(), rtol=1e-9)
    assert 0 <= out[0]["identity_error"] < 1e-9 and len({r["identity_error"] for r in out}) == 1
    ints = [[int(c) for c in v] for v in whole]
    sums = [sum(c) for c in zip(*ints, strict=True)]
    assert [r["deviation"] for r in out] == [sum((400 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in ints]


def test_whitening_edge_cases(spark):
    ddl = "vec_id long, embedding array<double>, _x string, parts string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0], "a", "b"), (1, [0.5, 1.0], "a", "b"), (None, [0.25, -1.0], None, None), (3, None, "a", "b"), (4, [], "a", "b"), (5, [nan, 0.0], "a", "b"), (6, [0.0, inf], "a", "b"), (7, [None, 1.0], "a", "b"), (8, [1.0, 2.0, 3.0], "a", "b"), (9, [2.0, 0.5], "a", "b")]
    out = V.whitened(spark.createDataFrame(rows, ddl)).collect()
    assert sorted(str(r["vec_id"]) for r in out) == ["1", "1", "9", "None"] and all(r["n"] == 4 and len(r["parts"]) == 2 for r in out)
    assert "_x" in out[0].asDict() and out[0]["identity_error"] < 1e-9
    assert V.whitened(spark.createDataFrame([], ddl)).count() == 0
    assert V.whitened(spark.createDataFrame(rows[3:8], ddl)).count() == 0
    same = V.whitened(spark.createDataFrame([(i, [0.5, 1.0], "", "") for i in range(3)], ddl)).collect()  # no spread at all
    assert all(p["whitened"] is None and p["explained"] == 0 for r in same for p in r["parts"]) and {r["deviation"] for r in same} == {0}
    line = V.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i], "", "") for i in range(5)], ddl)).collect()  # one direction only
    assert all(r["parts"][0]["whitened"] is not None and r["parts"][1]["whitened"] is None for r in line) and line[0]["identity_error"] < 1e-9


def test_deviations_beyond_a_long_are_null():
    how = V.Whitening(10**9, (10**14, 10**14), (np.zeros(2), np.zeros(2)), np.zeros(2), np.eye(2), 0.0)
    assert V.deviations(np.array([[100_001, 100_000], [200_000, 100_000]]), how) == [10**18, None]


# --- alignment of two tokenizers


def brute_alignment(rows):
    """Groups by the byte offsets where tokens of both sides end."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model, letters, groups, count = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES), A.byte_level_letters(), [], Counter()
    a_model.encode_special_tokens = True
    for _, text in rows:
        a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        sa = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        sb = [bytes([int(b_model.id_to_piece(i)[3:-1], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(sa) == b"".join(sb) == f" {text}".encode():
            groups.append(None)
            continue
        ends = [list(itertools.accumulate(map(len, s))) for s in (sa, sb)]
        of, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
            of.append((a[i:x], b[j:y]))
            i, j = x, y
        groups.append((len(a), len(b), of))
        count.update({(x, y) for u, v in of for x in u for y in v})
    top: dict = {}
    for (x, _), n in count.items():
        top[x] = max(n, top.get(x, 0))
    out = []
    for (i, _), g in zip(rows, groups, strict=True):
        if g is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for u, v in g[2] for x in u for y in v]
        text = ";".join(f"{','.join(map(str, u))}|{','.join(map(str, v))}" for u, v in g[2])
        out.append((i, g[0], g[1], len(g[2]), len(links), sum(count[k] == top[k[0]] for k in links), sum(count[k] for k in links), text))
    return out


TEXTS = ["the end of it", "ünïcödé straße 𝄞𝄞 テスト", "a  b\n\n c\t", "<s> <|endoftext|> </s>", "x▁y", "1,000.50 no-one's   ’s", "ABCabc" * 400, "\x00\x85\x1c", "🙂🙃" * 40, " ", "\n", "日本語" * 30]


def test_alignment_by_brute_force(spark, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = A.align_corpus(df, BYTES, PIECES).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_alignment(rows)))


def test_alignment_keeps_other_columns(spark, edge_docs, no_docs):
    named = edge_docs.withColumnRenamed("score", "chunk").withColumnRenamed("kept", "pairs").withColumnRenamed("node", "_text")
    out = A.align_corpus(named, BYTES, PIECES)
    assert out.count() == edge_docs.count() and {"lang", "_text", "n_links", "count_sum"} <= set(out.columns)
    assert A.align_corpus(no_docs, BYTES, PIECES).count() == 0


def walked(first, second, a, b):
    ends_a, ends_b = A.array("q"), A.array("q")
    return list(zip(ends_a, ends_b, strict=True)) if A.Transducer(first, second).groups(a, b, ends_a, ends_b) else None


def test_transducer():
    first, second = {0: b"ab", 1: b"c", 2: b"abc", 3: b"d"}, {0: b"a", 1: b"bc", 2: b"abcd", 3: b"d"}
    assert walked(first, second, [0, 1, 3], [0, 1, 3]) == [(2, 2), (3, 3)]
    assert walked(first, second, [2, 3], [2]) == [(2, 1)]
    assert walked(first, second, [0, 1], [0, 1, 3]) is None and walked(first, second, [0], [1]) is None and walked(first, second, [0, 1, 3], [0]) is None
    assert walked(first, second, [], []) == []


def test_large_groups_are_counted_by_their_ids():
    r = random.Random(3)
    sizes = [(1, 1), (30, 20), (2, 3), (1, 200)]
    a, b = [[r.randint(0, 9) for _ in range(sum(s[k] for s in sizes))] for k in (0, 1)]
    ends = [list(itertools.accumulate(s[k] for s in sizes)) for k in (0, 1)]
    want: Counter = Counter()
    for i in range(4):
        u, v = (x[(e[i - 1] if i else 0) : e[i]] for x, e in ((a, ends[0]), (b, ends[1])))
        want.update((i // 2, x * A.WIDE + y) for x in u for y in v)
    text = np.array([0, 0, 1, 1])
    got = A.Aligned(*(np.array(x, dtype=np.int64) for x in (a, b, *ends)), text).linked()
    assert {(int(t), int(p)): int(n) for t, p, n in zip(*got, strict=True)} == dict(want)


# --- sharding


def shares(out):
    return Counter(r["shard"] for r in out)


def test_draws_follow_the_hypergeometric_law(spark):
    n = 20_000
    long = lambda x: F.lit(x).cast("long")
    for good, total, drawn in ((30, 100, 20), (3, 5, 4), (900, 1000, 990)):
        x = S._draw(long(good), long(total), long(drawn), S._uniform(F.col("id"), F.lit(5)))
        got = {r["x"]: r["count"] for r in spark.range(n).select(x.alias("x")).groupBy("x").count().collect()}
        law = {k: n * math.comb(good, k) * math.comb(total - good, drawn - k) / math.comb(total, drawn) for k in range(max(0, drawn + good - total), min(good, drawn) + 1)}
        assert set(got) <= set(law)
        likely = [k for k, e in law.items() if e >= 5]
        assert sum((got.get(k, 0) - law[k]) ** 2 / law[k] for k in likely) < 3 * len(likely) + 20


def test_matrix_has_its_margins(spark):
    r = random.Random(5)
    sizes = [r.randint(1, 60) for _ in range(90)]
    total = sum(sizes)
    blocks = spark.createDataFrame([(0, 3 * i, n) for i, n in enumerate(sizes)], "grp long, block long, n long")
    groups = spark.createDataFrame([(0, S.even_sizes(total, 7))], "grp long, places array<long>")
    got = {r["block"]: (r["places"], r["at"]) for r in S.matrix(blocks, groups, 3, 1).collect()}
    assert [sum(got[3 * i][0]) for i in range(90)] == sizes
    assert [sum(c) for c in zip(*(p for p, _ in got.values()), strict=True)] == S.even_sizes(total, 7)
    before = [0] * 7
    for i in sorted(got):
        assert got[i][1] == before
        before = [a + b for a, b in zip(before, got[i][0], strict=True)]


def test_shards_are_exact_and_gapless(spark):
    rows = spark.range(0, 5003, 1, 5).withColumn("text", F.repeat(F.lit("x"), (F.col("id") % 3).cast("int")))
    out = S.shuffled_shards(rows, 16, block=50).collect()  # several rounds: a shard has 313 rows
    assert sorted(r["id"] for r in out) == list(range(5003)) and sorted(shares(out).values()) == S.even_sizes(5003, 16)[::-1]
    for s in range(16):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(shares(out)[s]))
    again = S.shuffled_shards(rows, 16, block=50).collect()
    place = lambda out: {r["id"]: (r["shard"], r["slot"]) for r in out}
    assert place(out) == place(again) and place(out) != place(S.shuffled_shards(rows, 16, block=50, seed=1).collect())
    # Neighbours are parted, and neither shards nor slots follow the ids.
    ids = np.array([r["id"] for r in out])
    assert abs(np.corrcoef(ids, [r["shard"] for r in out])[0, 1]) < 0.06 and abs(np.corrcoef(ids, [r["slot"] for r in out])[0, 1]) < 0.06
    pairs = sum(place(out)[i][0] == place(out)[i + 1][0] for i in range(5002))
    assert abs(pairs - 5002 / 16) < 90


def test_each_division_is_as_likely(spark):
    """Over many groups of five rows in two blocks, each choice of three for the first part comes about as often."""
    n = 3000
    rows = spark.range(5 * n).select(F.floor(F.col("id") / 5).alias("grp"), F.floor(F.col("id") % 5 / 3).alias("block"), F.col("id").alias("row"))
    groups = spark.range(n).select(F.col("id").alias("grp"), F.array(F.lit(3), F.lit(2)).cast("array<long>").alias("places"))
    chosen = S.exchanged(rows, groups, 1, 4).where("part = 0").groupBy("grp").agg(F.sort_array(F.collect_list(F.col("row") % 5)).alias("c"), F.sort_array(F.collect_list("at")).alias("at"))
    got = {tuple(r["c"]): r["count"] for r in chosen.groupBy("c").count().collect()}
    assert len(got) == 10 and sum((k - n / 10) ** 2 / (n / 10) for k in got.values()) < 28  # nine degrees of freedom
    assert [tuple(r["at"]) for r in chosen.select("at").distinct().collect()] == [(0, 1, 2)]


def test_sharding_edge_cases(spark, edge_docs, no_docs):
    out = S.shuffled_shards(edge_docs.withColumn("_row", F.lit("mine")).withColumn("shard", F.lit("old")), 4).collect()
    assert len(out) == edge_docs.count() and {r["_row"] for r in out} == {"mine"} and sorted(shares(out).values()) == sorted(S.even_sizes(len(out), 4))
    assert {r["law"] for r in out} == {"rows"}
    assert S.shuffled_shards(no_docs, 16).count() == 0
    few = S.shuffled_shards(spark.createDataFrame([(None,), ("a",), ("a",)], "text string"), 16).collect()
    assert sorted(shares(few).values()) == [1, 1, 1] and {r["slot"] for r in few} == {0}


def test_shards_are_written_in_order(spark, tmp_path):
    out = S.shuffled_shards(spark.range(500).withColumn("text", F.sha2(F.col("id").cast("string"), 256)), 3)
    S.write_shards(out, str(tmp_path / "shards"), block=50)
    back = spark.read.parquet(str(tmp_path / "shards"))
    key = lambda df: sorted((r["shard"], r["slot"], r["id"], r["text"]) for r in df.collect())
    assert key(back) == key(out) and all(r["text"] == hashlib.sha256(str(r["id"]).encode()).hexdigest() for r in back.collect())
    for f in (tmp_path / "shards").glob("shard=*/*.parquet"):
        slots = [r["slot"] for r in spark.read.parquet(str(f)).collect()]
        assert slots == sorted(slots) and len(slots) <= 50


def test_registered_queries_over_whole_tables(spark):
    from cantilena.llm import queries as Q

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in Q.op13_sharding(spark, sf).collect()}
    assert len(got) == len(docs) and all(got[d["doc_id"]]["size"] == len((d["text"] or "").encode()) + 1 for d in docs)
    rows = [(d["doc_id"], d["text"]) for d in docs]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in brute_alignment(rows)]
    made = [tuple(r) for r in Q.op12_token_alignment(spark, sf).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    assert sorted(made) == sorted(want)
    white = Q.op11_whitening(spark, sf).where("component = 1").collect()
    assert len(white) == spark.read.parquet(f"{sf}/embeddings.parquet").count() and abs(np.var([r["whitened"] for r in white]) - 1) < 1e-9
