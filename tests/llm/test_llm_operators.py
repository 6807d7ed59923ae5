"""Operators against brute force, and their defined results on edge cases."""

import bisect
import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cantilena.llm import chat_format, fingerprints, html_extract, line_dedup, mixing, near_duplicates, packing, pii, quality_classifier, quality_rules

SPACES = " \t\n\x0b\f\r"
TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


# Line dedup


def dedup(rows, least=10, min_docs=2):
    key = lambda x: x.strip(SPACES).translate({c: c + 32 for c in range(65, 91)})
    where = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                where[key(x)].add(-(2**63) if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        mine = -(2**63) if i is None else i
        kept = [x for x in lines if len(where.get(key(x), ())) < min_docs or min(where[key(x)]) == mine]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_is_exact(edge_docs, many_docs, min_docs):
    for docs in (edge_docs, many_docs):
        got = line_dedup.drop_repeated_lines(docs, min_docs=min_docs)
        found = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in got.collect()), key=str)
        assert found == dedup(rows_of(docs), min_docs=min_docs)


# Quality rules


def counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    seen = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    marked = {i + j for i, x in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(marked), len(lines) if words else 0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t#|é\x85\xa0", max_size=60))
def test_quality_counts(text):
    assert tuple(quality_rules.counts_of(text)) == counts(text)


def test_quality_rules(edge_docs, many_docs):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(many_docs).collect()}
    for i, t in rows_of(many_docs):
        assert tuple(got[i][c] for c in quality_rules.COUNTS) == counts(t)
        if "###" in t:
            assert not got[i]["kept"]
        elif not got[i]["base_failed"]:
            assert got[i]["kept"], got[i]
    same = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(many_docs, keep_texts=False).collect()}
    assert same == {i: r["kept"] for i, r in got.items()}
    edge = quality_rules.quality_rules(edge_docs).collect()
    assert len(edge) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in edge if not (r["text"] or "").strip())


def verdicts(rows):
    """(id, rule) by sorting whole groups."""
    spec = {"word_length": (lambda c: c[1] / c[0], 3), "symbols": (lambda c: (c[2] + 1) / (c[1] + 100), 3), "dup_lines": (lambda c: (c[3] + 1) / (c[5] + 10), 2), "repeats": (lambda c: (c[4] + 3) / (c[0] + 100), 3)}
    step = np.log(1.01 / 0.99)
    counted = [(i, lang, source, counts(t or "")) for i, t, lang, source in rows]
    fine = [r for r in counted if r[3][0] >= 50 and 100 * r[3][4] <= 50 * r[3][0]]
    out = {}
    for i, lang, source, c in counted:
        if (i, lang, source, c) not in fine:
            out[i] = "base"
            continue
        out[i] = None
        for name, (f, reach) in reversed(spec.items()):
            bucket = lambda c: int(np.ceil(round(np.log(f(c)) / step, 6)))  # noqa: B023, E731
            for group in ([r for r in fine if r[1:3] == (lang, source)], [r for r in fine if r[1] == lang], fine):
                b = sorted(bucket(r[3]) for r in group)
                lo, hi = b[-(-len(b) // 4) - 1], b[-(-3 * len(b) // 4) - 1]
                if len(b) >= 100 and lo < hi:
                    break
            if bucket(c) > hi + reach * (hi - lo) or name == "word_length" and bucket(c) < lo - reach * (hi - lo):
                out[i] = name
    return out


def test_verdicts_come_from_the_groups(spark):
    r, rows = random.Random(5), []
    word = lambda k: "".join(r.choice("abcdefghij") for _ in range(max(1, round(r.gauss(k, 2)))))
    for i in range(700):
        source, lang = ["s1", "s2", "s3", None][i % 4 if i % 40 else 3], "en" if i % 5 else "de"
        long = {"s1": 5, "s2": 8}.get(source, 6)
        lines = [" ".join(word(long) for _ in range(r.randint(8, 20))) for _ in range(r.randint(8, 25))]
        odd = i % 50
        if odd == 1:
            lines = [" ".join(x + x for x in line.split()) for line in lines]
        if odd in (2, 3):
            lines = [line.replace("a", "%#") for line in lines]
        if odd == 4:
            lines += lines[:6] * 2
        if odd == 5:
            lines = ["one two three four " + line for line in lines]
        rows.append((i, "\n".join(lines), lang, source))
    rows += [(900 + i, "same words in all of them here " * 1 + " ".join(f"w{j}" for j in range(60)), "xx", "flat") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x["doc_id"]: x["rule"] for x in quality_rules.quality_rules(docs).collect()}
    assert got == verdicts(rows)
    assert set(got.values()) >= {None, "word_length", "symbols", "dup_lines", "repeats"}
    limits = {(x["_lang"], x["_source"]): x["_bounds"] for x in quality_rules.thresholds(quality_rules.text_counts(docs)).collect()}
    assert {b["level"] for v in limits.values() for b in v.values()} == {"source", "lang", "all"}
    assert all(len({v[k]["high"] for v in limits.values()}) > 1 for k in quality_rules.STATISTICS)


def test_sketch_quantiles(spark):
    values = np.random.default_rng(1).lognormal(1, 1, 4000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    b = sorted(r[0] for r in df.select(quality_rules.bucket_value(quality_rules.bucket(F.col("v")))).collect())
    for q in (0.1, 0.5, 0.9):
        assert abs(b[int(q * 4000)] / np.sort(values)[int(q * 4000)] - 1) < 0.011


# Chat formatting

texts = st.text(alphabet="a\\<>/turn =role|\n#:", max_size=30)


def test_chat_round_trip(spark):
    controls = ["<turn role=", "</turn>", "\\### Assistant: </turn> ok", "<\\/turn>", "\\", "\\\\<turn role=user>\n", "\n</turn>\n", "", None, "é𝄞 <", "turn>"]
    turns = [(c, i, ["system", "user", "assistant", "weird>\n\\role", None][(c + i) % 5], t) for c in range(5) for i, t in enumerate(controls)]
    turns += [(99, 0, "user", "hi"), (99, 1, "assistant", "yo"), (99, 1, "assistant", "yo"), (None, 0, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat_format.format_chats(df)
    out = out.withColumn("back", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("segments")))
    got = {r["conv_id"]: r for r in out.collect()}
    assert len(got) == 7
    for c, r in got.items():
        want = sorted(((t, role or "", x or "") for k, t, role, x in turns if k == c), key=lambda x: (x[0], x[1], x[2]))
        assert [(b["role"], b["text"]) for b in r["back"]] == [w[1:] for w in want]
        assert r["loss"] == "".join(x for _, role, x in want if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert not got[99]["valid"] and got[99]["error_at"] == 2
    assert not got[None]["valid"] and got[None]["error_at"] == 1


def test_turns_of_one_number_sort_by_their_own_text(spark):
    rows = [(1, 0, "user", "<turn role=x"), (1, 0, "user", "<a"), (1, 0, "user", "<turn role=" + "y" * 50_000), (1, 1, "assistant", "ok")]
    got = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [t["text"] for t in got.select(chat_format.read_turns(F.col("formatted")).alias("t")).first()["t"]] == ["<a", "<turn role=x", rows[2][3], "ok"]


def test_chat_machine(spark):
    def ends(roles):
        df = spark.createDataFrame([(1, i, r, "t") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
        return chat_format.format_chats(df).first()["error_at"]

    assert ends(["system", "user", "assistant"]) is None
    assert ends(["user", "assistant", "user", "assistant"]) is None
    assert ends(["assistant"]) == 0
    assert ends(["user", "user", "assistant"]) == 1
    assert ends(["user", "assistant", "system"]) == 2
    assert ends(["user"]) == 1
    with pytest.raises(ValueError):
        chat_format.Template(control=("<a", "b<"))


# Mixing


def test_targets_share_out(spark):
    sizes = {"a": 100, "b": 10, "c": 10, "d": 1000, None: 80}
    got = {r["source"]: r for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    want, open_, left = {}, dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2], strict=True)), float(sum(sizes.values()))
    while open_:  # round by round, as the words say
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * level > 3 * sizes[s]]
        if not full:
            want |= {s: w * level for s, w in open_.items()}
            break
        for s in full:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
            del open_[s]
    assert {s: pytest.approx(t) for s, t in want.items()} == {s: r["target"] for s, r in got.items()}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 50)), max_size=40), st.integers(0, 9))
def test_flight_keeps_totals(units, seed):
    import random

    pi, size = [u[0] for u in units], [u[1] for u in units]
    out = mixing.flight(list(pi), size, random.Random(seed).random, False)
    assert sum(0 < p < 1 for p in out) <= mixing.LANDING + 2 and all(-1e-9 <= p <= 1 + 1e-9 for p in out)
    assert abs(sum(out) - sum(pi)) < 1e-5 and abs(np.dot(out, size) - np.dot(pi, size)) < 1e-4
    assert all(p in (0, 1) for p in mixing.flight(list(pi), size, random.Random(seed).random, True))


def test_mix(spark, edge_docs, many_docs):
    docs = many_docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    one = sorted(mixing.mix(docs, keys=["doc_id"], block=40).collect(), key=str)
    two = sorted(mixing.mix(docs.repartition(7), keys=["doc_id"], block=40).collect(), key=str)
    assert one == two and len(one) == 240
    for s, rows in itertools.groupby(sorted(one, key=lambda r: r["source"]), key=lambda r: r["source"]):
        rows = list(rows)
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 0.02 * rows[0]["target"] + 10, s
        assert all(r["taken"] <= 3 * r["size"] for r in rows)
    units = edge_docs.withColumn("size", mixing.n_words(F.col("text")))
    assert mixing.mix(units, keys=["doc_id"]).count() == edge_docs.count()
    mixed = mixing.mixed_rows(edge_docs)
    assert mixed.columns == edge_docs.columns and mixed.count() <= 3 * edge_docs.count()


# Near duplicates


def classes(rows, n=5, least=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset())
    root, links = list(range(len(rows))), collections.Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if (len(a & b) / len(a | b) if a | b else 1.0) >= least - 1e-9:
            links[i] += 1
            links[j] += 1
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    of = collections.defaultdict(list)
    for i in range(len(rows)):
        of[find(i)].append(i)
    low = lambda i: -(2**63) if rows[i][0] is None else rows[i][0]
    out = []
    for members in of.values():
        first = min(map(low, members))
        out += [(rows[i][0], None if first == -(2**63) else first, len(members), links[i]) for i in members]
    return sorted(out, key=str)


def test_near_duplicates_are_exact(edge_docs, many_docs):
    for docs in (edge_docs, many_docs):
        got = near_duplicates.near_duplicates(docs).select("doc_id", "class_id", "class_size", "n_links").collect()
        assert sorted(map(tuple, got), key=str) == classes(rows_of(docs))


def test_groups_beyond_a_block(spark, monkeypatch):
    """One group of near copies and a passage that many share, in blocks far smaller than the groups."""
    import random

    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    monkeypatch.setattr(near_duplicates, "GRAMS", 2000)
    r, base, passage = random.Random(1), [f"w{i}" for i in range(120)], [f"p{i}" for i in range(70)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(120)] = f"x{r.randrange(30)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join([*passage, *(f"q{i}-{j}" for j in range(r.randint(4, 14)))])) for i in range(50)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.select("doc_id", "class_id", "class_size", "n_links").collect()), key=str) == classes(rows)


def test_many_copies_without_an_id(spark):
    """Copies under one id, or none, are one node with one set."""
    words = [f"w{i}" for i in range(100)]
    near = [*words[:50], "other", *words[51:]]
    docs = spark.createDataFrame([(None, " ".join(words)), (None, " ".join(near)), (3, " ".join(words))], "doc_id long, text string").withColumn("_k", F.explode(F.sequence(F.lit(1), F.when(F.col("doc_id").isNull(), 10_000).otherwise(2)))).drop("_k")
    got = near_duplicates.near_duplicates(docs)
    assert [tuple(r) for r in got.groupBy("class_id", "class_size", "n_links").count().collect()] == [(None, 20_002, 20_001, 20_002)]


def test_similar_at_the_threshold():
    """216 of 270 is 0.8 exactly, and counts."""
    a, b = np.arange(244), np.arange(28, 270)
    assert len(np.intersect1d(a, b)) == 216 and len(np.union1d(a, b)) == 270
    assert near_duplicates.similar([a, b], None, 0.8)[0, 1] and near_duplicates.similar([a], [b], 0.8).all()
    assert not near_duplicates.similar([a], [np.arange(29, 270)], 0.8).any()


def test_components(spark):
    import random

    r = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(r.randrange(50, 200), r.randrange(50, 200)) for _ in range(120)]
    got = {x["node"]: x["comp"] for x in near_duplicates.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {n: find(n) for n in root if sum(n in e and e[0] != e[1] for e in edges)}


def test_band_recall():
    assert 1 - (1 - 0.8**near_duplicates.BAND_ROWS) ** near_duplicates.bands_for() >= near_duplicates.RECALL


def test_one_of_each(edge_docs):
    got = near_duplicates.one_of_each(edge_docs)
    assert got.columns == edge_docs.columns
    assert got.count() == near_duplicates.near_duplicates(edge_docs).select("class_key").distinct().count() == 16


# Packing


def decreasing(lengths, capacity):
    """Best fit, longest first: how many sequences."""
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, n = capacity, n + 1
        bisect.insort(gaps, gap - x)
    return n


@pytest.mark.parametrize("kind", ["mixed", "hot", "halves", "tiny", "full", "odd"])
def test_packing_is_near_decreasing_best_fit(spark, kind):
    r = random.Random(9)
    lengths = {
        "mixed": [min(2048, int(r.lognormvariate(5.5, 1.5)) + 1) for _ in range(3000)],
        "hot": [700] * 1000 + [r.randint(1, 2048) for _ in range(1500)],
        "halves": [r.randint(600, 1400) for _ in range(1500)],
        "tiny": [r.randint(1, 9) for _ in range(4000)],
        "full": [2048] * 50 + [1],
        "odd": [683] * 7 + [1] * 3 + [1024] * 3 + [1025] * 2,
    }[kind]
    rows = [(None if i % 3 else 7, i % 2, n, str(i)) for i, n in enumerate(lengths)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, piece int, length long, offset_name string")).collect()
    assert collections.Counter((r["length"], r["offset_name"]) for r in got) == collections.Counter((n, x) for _, _, n, x in rows)
    ends = collections.defaultdict(list)
    for row in got:
        ends[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(ends) <= 1.01 * decreasing(lengths, 2048) + 1


def test_a_sweep_is_the_stack(spark):
    """Pieces from long to short, each to the slot put down last; ties go by rank, so counts by length are compared, and that slots fit."""
    r = random.Random(3)
    for _ in range(3):
        gaps, lengths, top = [r.randint(1, 60) for _ in range(40)], [r.randint(1, 20) for _ in range(80)], 20
        got = packing.sweep(spark.createDataFrame(list(enumerate(lengths)), "id long, length long"), spark.createDataFrame(list(enumerate(gaps)), "sequence long, gap long"), top).collect()
        stack, taken, none = [], collections.Counter(), 0
        for v in range(60, 0, -1):
            stack += [g for g in gaps if g == v for _ in range(max(1, g // top))]
            for _ in range(lengths.count(v)):
                if stack:
                    taken[v, stack.pop()] += 1
                else:
                    none += 1
        assert collections.Counter((x["length"], gaps[x["sequence"]]) for x in got if x["rank"] is None) == taken
        assert sorted(x["rank"] for x in got if x["rank"] is not None) == list(range(none))
        used = collections.Counter()
        for x in got:
            if x["rank"] is None:
                used[x["sequence"]] += x["length"]
        assert all(n <= gaps[k] for k, n in used.items())


def test_models_that_join_words_read_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = Tokenizer(models.WordLevel({"a b": 1, "a": 2, "b": 3, "?": 0}, unk_token="?"))
    model.pre_tokenizer = pre_tokenizers.Split("|", "removed")
    words = packing.WordTokenizer(model.to_str())
    assert words.whole and words.encode("a b|b") == np.asarray([1, 3], "<u4").tobytes()
    assert not packing._tokenizer(open(TOKENIZER, encoding="utf-8").read()).whole


def test_packing(spark, edge_docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(TOKENIZER)
    got = packing.best_fit_pack(edge_docs, TOKENIZER, keep_ids=True)
    pieces = collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got.collect())
    want = collections.Counter()
    for i, t in rows_of(edge_docs):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[i, k // 2048, k, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())] += 1
    assert pieces == want
    lengths = {r["sequence_id"]: len(r["ids"]) for r in packing.sequences(got).collect()}
    assert max(lengths.values()) <= 2048 and sum(lengths.values()) == sum(k[3] * n for k, n in want.items())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZéÉßñ€漢ǅİ'’.,!%#0 \n\t\xa0\x85")), max_size=25))
def test_words_have_the_ids_of_whole_texts(text):
    words = packing._tokenizer(open(TOKENIZER, encoding="utf-8").read())
    assert words.short
    assert words.encode(text) == np.asarray(words.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


# Fingerprints


def winnowed(spark, texts):
    """The chosen places of each text by the definition, with the hashes that Spark gives its k-grams."""
    grams = sorted({t[i : i + 12] for t in texts for i in range(len(t) - 11)} | {t for t in texts if t})
    high = {r["g"]: r["h"] >> 32 for r in spark.createDataFrame([(g,) for g in grams], "g string").withColumn("h", F.xxhash64("g").bitwiseAND(F.lit(2**63 - 2**32))).collect()}
    out = []
    for t in texts:
        h = [high[t[i : i + 12]] for i in range(len(t) - 11)]
        if not t:
            out.append([])
        elif not h:
            out.append([(0, high[t])])
        else:
            w = min(25, len(h))
            out.append(sorted({min(((h[i], -i) for i in range(s, s + w)), key=lambda x: x) for s in range(len(h) - w + 1)}, key=lambda x: -x[1]))
            out[-1] = [(-p, v) for v, p in out[-1]]
    return out


def test_fingerprints(spark, edge_docs, many_docs):
    for docs in (edge_docs.where("length(text) < 20000 or text is null").dropDuplicates(["doc_id", "text"]).where("doc_id is not null and doc_id != 18"), many_docs):
        rows = sorted(rows_of(docs), key=lambda r: -r[0])
        got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs).collect()}
        texts = [t or "" for _, t in rows]
        edited = [t[: len(t) - len(t) // 3] + texts[(k + 1) % len(texts)][: len(t) // 3] for k, t in enumerate(texts)]
        chosen = winnowed(spark, texts + edited)
        hashes = lambda f: {h for _, h in f}
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        for k, (i, _) in enumerate(rows):
            r, own, new, following = got[i], chosen[k], chosen[len(rows) + k], chosen[(k + 1) % len(rows)]
            assert r["edited"] == edited[k]
            read = lambda e: [(2**32 - 1 - (x & (2**32 - 1)), x >> 32) for x in e]
            assert read(r["entries"]) == own
            assert read(r["edited_entries"]) == new
            assert r["near_edited"] == pytest.approx(like(hashes(own), hashes(new))) and r["near_next"] == pytest.approx(like(hashes(own), hashes(following)))


def test_fingerprints_of_hot_ids_and_long_texts(spark, edge_docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE", 700)
    monkeypatch.setattr(fingerprints, "TASK", 9000)
    r = random.Random(6)
    some = [(None if i % 3 == 0 else 5 if i % 3 == 1 else r.randint(-(2**62), 2**62), " ".join(r.choice("abc") * r.randint(1, 9) for _ in range(r.randint(0, 60)))) for i in range(240)]
    some += [(None, some[0][1])] * 40
    for docs in (spark.createDataFrame(some, "doc_id long, text string"), edge_docs.select("doc_id", "text")):
        hashed = [tuple(x) for x in docs.select("doc_id", F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
        rows = sorted(hashed, key=lambda x: (x[0] is None, -(x[0] or 0), -x[2]))
        texts = [t for _, t, _ in rows]
        edited = [t[: len(t) - len(t) // 3] + texts[(k + 1) % len(texts)][: len(t) // 3] for k, t in enumerate(texts)]
        got = fingerprints.edited_fingerprints(docs).collect()
        assert sorted((str(x["doc_id"]), x["text"], x["edited"]) for x in got) == sorted((str(i), t, e) for (i, t, _), e in zip(rows, edited, strict=True))
        bucket, tasks = fingerprints.ranges_by_bytes(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
        assert tasks > 1 and docs.withColumn("text", F.coalesce("text", F.lit(""))).select(bucket.alias("b")).distinct().count() > 5


def test_fingerprints_of_edges(spark, edge_docs):
    got = fingerprints.edited_fingerprints(edge_docs)
    assert got.count() == edge_docs.count()
    assert fingerprints.edited_fingerprints(edge_docs.where("doc_id = 7")).first()["near_next"] == 1.0


# HTML extraction


def cut_cost(scores, edges, labels):
    return sum(max(-s, 0) if x else max(s, 0) for s, x in zip(scores, labels, strict=True)) + sum(c for (i, j), c in edges.items() if labels[i] != labels[j])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-6, 6), min_size=1, max_size=9), st.dictionaries(st.tuples(st.integers(0, 8), st.integers(0, 8)), st.integers(1, 8), max_size=14))
def test_minimum_cut(scores, edges):
    n = len(scores)
    scores, edges = [s / 2 for s in scores], {(i, j): c / 2 for (i, j), c in edges.items() if i < j < n}
    best = min(cut_cost(scores, edges, x) for x in itertools.product([True, False], repeat=n))
    assert cut_cost(scores, edges, html_extract.min_cut(scores, edges)) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav>
<div class="cookie-notice">We use cookies on this site. Please agree to them.</div><div id="sidebar"><p>Read also: many other fine stories that we have for you today.</p></div>
<main><article><h1>A headline here</h1><p>First &amp; foremost, <b>bold</b>text with a <a href=x>link</a>
 inside of it.<p>Second paragraph&nbsp;of the story, which is long enough to count as prose.<div class="ad">Buy this thing now, it is the very best thing of all.</div>
<p>Third.</p><form><label>Mail</label><input><p>Subscribe to our fine letter today.</p></form></article>
<section id="comments"><p>I liked this story very much, thank you for writing it.</p></section></main>
<footer>&copy; 2024 The site. All rights are reserved.</footer></body></html>"""


def test_extraction(spark):
    want = "A headline here First & foremost, boldtext with a link inside of it. Second paragraph of the story, which is long enough to count as prose. Third."
    cases = [(1, PAGE, want), (2, None, ""), (3, "", ""), (4, "<script>x</script><!-- y", ""), (5, PAGE[: PAGE.index("<footer>") + 20], want), (6, "<nav>" + "<p>" * 3000, ""), (7, '<p a="x' + "<" * 2000, "")]
    long = "This sentence of the story goes on for quite a while, as sentences do in such stories. "
    body = f'<div class="post-header"><h2 class="header">Head line</h2></div><p>{long}</p><div class="note"><p>Short one.</p></div><ul><li>One item</ul><aside><p>{long}</p></aside><p>{long}'
    cases += [
        (8, f'<body><div id="top-menu"><a href=1>a</a></div><div class="entry-content">{body}</div><div class="comment-list"><article class="comment"><p>{long}</p></article></div>', " ".join(["Head line", long.strip(), "Short one. One item", long.strip()])),
        (9, f'<article class="post with-sidebar">{body}</article><article class="comment"><p>{long}</p></article><div role="contentinfo"><p>{long}</p></div>', " ".join(["Head line", long.strip(), "Short one. One item", long.strip()])),
        (10, f"<body><p>{long}<p>{long}<div style='display: none'>{long}</div><div class=newsletterSignup><p>{long}</div>", " ".join([long.strip()] * 2)),
    ]
    df = spark.createDataFrame([(i, h, "u", "old") for i, h, _ in cases], "page_id long, html string, url string, text string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(df).collect()}
    assert {i: got[i] for i, _, _ in cases if i != 7} == {i: w for i, _, w in cases if i != 7}
    assert html_extract.extract_pages(df.limit(0)).count() == 0


def test_the_cut_decides():
    long = "This sentence of the story goes on for quite a while, as sentences do in such stories, and then some."
    pages = {
        f"<div><p>{long}</p><p>Short</p><p>{long}</p></div>": {"Short": True},  # no mark at all: the neighbours decide
        f"<div><a href=1>One</a></div><div><a href=2>Two words</a></div><div><p>{long}</p></div>": {"One": False, "Two words": False, long: True},
        f"<article><p>{long}</p><ul><li>Milk</li><li>Eggs and flour</li></ul><table><tr><td>12</td><td>13</td></tr></table></article>": dict.fromkeys(["Milk", "Eggs and flour", "12", "13"], True),
        f"<main><p>{long}</p><div class=ad>{long}</div></main><footer>{long}</footer><aside><div class=content><p>{long}</p></div></aside>": {},
    }
    kept = []
    for page, want in pages.items():
        tree = html_extract.tree_of(page)
        labels = dict(html_extract.labelled(page))
        assert {k: labels[k] for k in want} == want
        kept.append([x for _, x in html_extract.labelled(page)])
        sign = [html_extract.score(b) > 0 for b in tree.blocks]
        assert (sign != kept[-1]) == bool({"Short", "Milk"} & set(labels))
    assert kept[-1] == [True, False, False, False]


def test_the_cut_decides_on_pages():
    """Blocks of articles whose score, mark included, is below 0 are kept by their ties; a menu in an article is not; the weights are those of a fit."""
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet' where html is not null order by page_id").fetchall()
    kept = against = 0
    for (page,) in rows:
        for b, (_, x) in zip(html_extract.blocks_of(page), html_extract.labelled(page), strict=True):
            assert x == (b.mark > 0)  # what these pages' own markup says is right
            kept += x and html_extract.score(b) < 0
            against += (html_extract.text_score(b) > 0) != x
    assert kept > 0 and against > 100
    fit = html_extract.fit_weights([r[0] for r in rows])
    assert all(abs(fit[k] - w) < 0.35 * max(1, abs(w)) for k, w in html_extract.WEIGHTS.items() if k != "bias")
    long = "This sentence of the story goes on for quite a while, as sentences do in such stories, and then some."
    links = "".join(f"<li><a href={i}>Other page {i}</a></li>" for i in range(8))
    items = "".join(f"<li>Item {i}</li>" for i in range(12))
    assert all(x for _, x in html_extract.labelled(f"<article><h1>Head</h1><p>{long}</p><ul>{items}</ul><p>{long}</p></article>"))
    page = f"<article><h1>Head</h1><p>{long}</p><p>{long}</p><p>Short.</p><p>{long}</p><div><div><div><ul>{links}</ul></div></div></div></article>"
    assert [x for _, x in html_extract.labelled(page)] == [True] * 5 + [False] * 8


def test_deep_nesting_is_linear():
    import time

    def seconds(n):
        began = time.perf_counter()
        assert len(html_extract.labelled("<div>x." * n)) == n
        return time.perf_counter() - began

    seconds(2000)
    assert seconds(16_000) < 20 * max(seconds(2000), 0.01)


def test_formulas_stay_and_unclosed_elements_end():
    text = lambda page: [b[0] for b in html_extract.blocks_of(page)]
    assert text("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds") == ["so x=2 holds"]
    assert text("<p>see <object data=a><param name=b>the map</object> here</p>") == ["see the map here"]
    assert text("<p>one</p><svg><text>drawn<p>two</p><div>three</div>") == ["one", "two", "three"]
    assert text("<p>one</p><canvas><p>two</p><option>a<p>three") == ["one", "two", "a", "three"]
    assert text("<p>one</p><script>x<p>two</p>") == ["one"]


# PII


def spans(text):
    E, I, C, P = (re.compile(x) for x in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))  # noqa: E741
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])) % 10 == 0

    out = [("email", *m.span()) for m in E.finditer(text)]
    out += [("ip", *m.span()) for m in I.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in C.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in P.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a1259.@+-() é%_")), max_size=40))
def test_pii_base_is_the_patterns(text):
    assert pii.base_spans(text) == spans(text)


def test_pii_base_on_long_runs():
    assert pii.base_spans("1" * 50_000 + "@" + "a" * 50_000 + " " + "0" * 6000 + ".1.1.1")[-1][0] in ("ip", "card")


def test_pii_discovers_by_context(spark):
    people = [f"Please write to reader ann{i}@mail{i}.example.com before noon. Something else here." for i in range(12)]
    hidden = ["Please write to reader k8842-77130 before noon. And so on.", "Numbers such as 55-88421-77 are not personal, and the reader k8842-77130 isn't either."]
    docs = spark.createDataFrame(list(enumerate(people + hidden + [None, ""])), "doc_id long, text string")
    got = {r["doc_id"]: (r["base"], r["spans"]) for r in pii.find_pii(docs).collect()}
    assert [[s["kind"] for s in got[i][1]] for i in range(12)] == [["email"]] * 12
    base, found = got[12]
    assert not base and [(s["kind"], hidden[0][s["start"] : s["end"]]) for s in found] == [("email", "k8842-77130")]
    assert all("55-88421-77" != hidden[1][s["start"] : s["end"]] for s in got[13][1])
    assert got[14] == ([], []) and got[15] == ([], [])


def test_pii_leaves_common_contexts_alone(spark):
    filler = "of the world and of the sea and of the land " * 20
    docs = [f"{filler} of the a{i}@b{i}.example.com" for i in range(10)] + [f"{filler} of the 88421-7713{i}" for i in range(10)]
    got = pii.find_pii(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    assert all(r["spans"] == r["base"] for r in got)


def discovered(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], s["kind"], texts[r["doc_id"]][s["start"] : s["end"]]) for r in pii.find_pii(docs, **how).collect() for s in r["spans"] if s not in r["base"]}


def test_pii_takes_whatever_stands_in_the_slot(spark):
    people = [f"Please write to reader ann{i}@mail{i}.example.com before noon." for i in range(12)]
    hidden = ["jane@intranet", "jane [at] corp [dot] com", "account-name", "07700 900123"]
    texts = people + [f"Please write to reader {x} before noon." for x in hidden]
    assert discovered(spark, texts) == {(12 + i, "email", x) for i, x in enumerate(hidden)}


def test_pii_knows_one_word_labels(spark):
    texts = [f"Phone: +1 (212) 555-01{i}" for i in range(10, 22)] + ["Phone: 030 12345678", "Some other words here. Phone: 07700 900123."]
    assert discovered(spark, texts) == {(12, "phone", "030 12345678"), (13, "phone", "07700 900123")}


def test_pii_goes_on_until_no_instance_is_new(spark):
    names = [[f"{c}{i}77-41{i}" for i in range(4)] for c in "abcdef"]
    texts = [f"Write to hop0 u{i}@h{i}.example.com today" for i in range(40)] + [f"Write to hop0 {x} today" for x in names[0]]
    for k in range(5):
        texts += [f"Ask for hop{k + 1} {x} soon" for _ in range(3) for x in names[k]] + [f"Ask for hop{k + 1} {x} soon" for x in names[k + 1]]
    assert {x for *_, x in discovered(spark, texts)} == {x for group in names for x in group}


def test_pii_counts_whatever_stands_in_wide_slots(spark):
    cards = [x for i in range(10_000, 10_200) if pii.base_spans(x := f"4111 1111 111{i % 10} {i // 10 % 1000:03}{i % 7}")][:12]
    texts = [f"paid by card {x} then on" for x in cards] + [f"paid by card in no small q{c} then on" for c in "abcdefghijklmnopqrst"] + ["left by card 88421-77130 then on"]
    assert len(cards) >= pii.MIN_SEEDS and not discovered(spark, texts)


def plainly(texts, names=pii.NAMES):
    """Discovery over all texts at once, with dictionaries: what find_pii adds, as (document, kind, text found)."""
    label = lambda w: m[0] if (m := re.match(r"[^\s:=]+[:=]", w)) and m.end() < len(w) else ""
    lows = [t.lower().split() for t in texts]
    places = [[m.span() for m in re.finditer(r"\S+", t)] for t in texts]
    held = [[(a, b) for _, a, b in pii.base_spans(t) + pii.seed_spans(t)] for t in texts]
    free = lambda d, a, b: all(b <= x or a >= y for x, y in held[d])

    def core(d, i):
        t, (a, b) = texts[d], places[d][i]
        return pii.trimmed(t, a + len(label(t[a:b])), b)

    def slots_of(p):
        kind, *w = p.split(" ")
        for d, low in enumerate(lows):
            for i in range(len(low)):
                if kind == "L" and i and low[i - 1] == w[0] or kind == "B" and i > 1 and low[i - 2 : i] == w or kind == "G" and label(low[i]) == w[0]:
                    yield d, i, None
                elif kind == "S" and pii.shape(texts[d][slice(*core(d, i))]) == p:
                    yield d, i, i
                elif kind == "A" and i and low[i - 1] == w[0]:
                    end = next((j for j in range(i + 1, min(i + pii.MOST + 1, len(low))) if low[j] == w[1]), None)
                    if end is not None:
                        yield d, i, end - 1

    def fill(p, d, i, j):
        t, start = texts[d], places[d][i][0]
        if p[0] == "S":
            return core(d, i)
        start += len(label(t[slice(*places[d][i])])) if p[0] == "G" else 0
        last = pii.last_of(t, places[d], i, start) if j is None else j
        a, b = pii.trimmed(t, start, places[d][last][1])
        return (a, b) if p[0] != "A" or b == places[d][last][1] else (a, a)

    def coded(p, d, i):
        t, (a, b) = texts[d], places[d][i]
        x = t[slice(*(core(d, i) if p[0] == "G" else pii.trimmed(t, a, b)))]
        return len(x) >= 8 and x.isascii() and any(c.isdigit() for c in x) and any(c.isalpha() for c in x)

    def whole(x):
        """Where an instance stands, wherever that is."""
        out = set()
        for d, t in enumerate(texts):
            for i, (a, b) in enumerate(places[d]):
                for s in {0, len(label(t[a:b]))}:
                    for j in range(i, min(i + pii.MOST, len(places[d]))):
                        u, v = pii.trimmed(t, a + s, places[d][j][1])
                        if u < v and pii.norm(t[u:v]) == x:
                            out.add((d, u, v, i, s))
        return out

    pairs, kinds, waiting = collections.Counter(), {}, collections.Counter()
    for d, t in enumerate(texts):
        for k, a, b in pii.base_spans(t) + pii.seed_spans(t):
            for p in pii.contexts(t, places[d], a, b):
                pairs[p, pii.norm(t[a:b])] += 1
                kinds[p, pii.norm(t[a:b])] = k
        for i in range(len(places[d])):
            a, b = core(d, i)
            if pii.shape(t[a:b]) and free(d, a, b):
                waiting.update((p, pii.norm(t[a:b])) for p in pii.contexts(t, places[d], a, b) if p[0] != "S")
    accepted, done, named = set(), [], set(pii.seed_patterns(names))
    while True:
        by = collections.defaultdict(list)
        for p, x in pairs.keys() | waiting.keys():
            by[p].append((x, pairs.get((p, x), 0) + waiting.get((p, x), 0)))
        sure = {}
        for p in named | {p for p in by if len(by[p]) >= pii.MIN_SEEDS}:
            hits, found = sum(n for _, n in by[p]), list(slots_of(p))
            if found or hits:
                share = hits / max(hits, len(found))
                if p in named and found:
                    share = max(share, sum(coded(p, d, i) for d, i, _ in found) / len(found))
                if share >= pii.MIN_CONFIDENCE:
                    of = collections.Counter(k for x, _ in by[p] for k in [kinds.get((p, x))] * ((p, x) in pairs) + ["secret"] * ((p, x) in waiting))
                    sure[p] = (min(share, 0.999), min(of, key=lambda k: (-of[k], k)) if of else "secret")
        filled = {(p, d, *fill(p, d, i, j)) for p in sure for d, i, j in slots_of(p)}
        filled = {f for f in filled if f[2] < f[3] and free(*f[1:])}
        inside = collections.defaultdict(set)
        for p, d, a, b in filled:
            inside[pii.norm(texts[d][a:b])].add((p, d, a, b))
        got = {}
        for x, at in inside.items():
            score = 1 - np.prod([1 - sure[p][0] for p in {f[0] for f in at}])
            if score >= pii.MIN_SCORE and len({f[1:] for f in at}) >= pii.MIN_SHARE * len(whole(x)):
                of = collections.Counter(sure[p][1] for p in {f[0] for f in at})
                got[x] = min(of, key=lambda k: (-of[k], k))
        done = {(d, sure[p][1], a, b) for x in got for p, d, a, b in inside[x]}
        new = set(got) - accepted
        if not new:
            break
        accepted |= new
        waiting = collections.Counter({(p, x): n for (p, x), n in waiting.items() if x not in new})
        for x in new:
            for d, a, b, _, _ in whole(x):
                if free(d, a, b):
                    for p in pii.contexts(texts[d], places[d], a, b):
                        pairs[p, x] += 1
                        kinds[p, x] = got[x]
    out = set()
    for d in range(len(texts)):
        last = 0
        for a, _, k, b in sorted((a, -b, k, b) for e, k, a, b in done if e == d):
            if a >= last:
                out.add((d, k, texts[d][a:b]))
                last = b
    return out


def test_pii_needs_no_names(spark):
    """Codes in a context that holds little else are found, then their shape wherever it is new; a context that codes merely visit is none."""
    code = lambda i: f"{i:04}a1b2c3d4e5f6" * 2
    texts = [f'so it was with riva{i} token = "{code(i)}" and on' for i in range(8)] + [f"lone{i} words about {code(50)} here" for i in range(1)]
    texts += [f"of all that is in lago{i}" for i in range(60)] + [f"of all that is in {code(90 + i)[:-3]} then{i}" for i in range(5)]
    assert {x for *_, x in discovered(spark, texts, names=())} == {code(i) for i in (*range(8), 50)}


@pytest.mark.parametrize(("exact", "names"), [(0, ()), (pii.EXACT, pii.NAMES)])
def test_pii_discovery_is_the_definition(spark, monkeypatch, exact, names):
    monkeypatch.setattr(pii, "EXACT", exact)
    r, hexes = random.Random(8), "0123456789abcdef"
    word = lambda: r.choice("the of and to a is in ember lago stern riva".split()) + r.choice(["", "", "s", "en", "ly"])
    code = lambda n: "".join(r.choice(hexes) for _ in range(n - 2)) + "a1"
    made = [lambda: f"mail to: u{r.randint(1, 99)}@h{r.randint(1, 9)}.example.com", lambda: f"mail to: {word()}.{word()}", lambda: f'token = "{code(40)}"', lambda: f"password={code(18)},", lambda: "password: required here",
            lambda: f"call desk +1 (212) 555-{r.randint(1000, 9999)} or", lambda: f"call desk 030 {r.randint(10**6, 10**7)} or", lambda: f"AKIA{code(16).upper()}", lambda: f"see {code(40)}", lambda: f"from {r.randint(1, 255)}.7.9.{r.randint(1, 255)} by", lambda: f"id:{code(9)}", lambda: f"id:10.0.0.{r.randint(1, 9)}"]
    texts = [" ".join(x for _ in range(r.randint(1, 6)) for x in (*(word() for _ in range(r.randint(0, 12))), r.choice(made)())) for _ in range(300)]
    want = plainly(texts, names)
    found = discovered(spark, texts, names=names)
    seeds = {(d, k, t[a:b]) for d, t in enumerate(texts) for k, a, b in pii.seed_spans(t)}
    assert len(want) > 100 and {k for _, k, _ in want} >= {"secret", "phone"}
    assert found == want | seeds


def test_pii_on_edges(spark, edge_docs, no_docs):
    got = pii.find_pii(edge_docs).collect()
    assert len(got) == edge_docs.count() and sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in edge_docs.collect())
    (full,) = [r for r in got if r["doc_id"] == 15]
    assert [s["kind"] for s in full["base"]] == ["email", "phone", "ip", "card"]
    assert all(r["base"] == [] for r in got if r["doc_id"] != 15)
    assert pii.find_pii(no_docs).count() == 0
    long = "x " * 400_000 + 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + "y" * 300_000
    rows = [(None, long, "b"), (None, long, "b"), (7, long, "c"), (7, "password=abc123def456", "d"), (8, None, None)]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string, base string")).collect()
    assert sorted(len(r["spans"]) for r in found) == [0, 1, 1, 1, 1] and all(s["kind"] == "secret" for r in found for s in r["spans"])


# Quality classifier


def test_classifier(spark, many_docs, edge_docs):
    labels = many_docs.select("doc_id", F.when(F.col("text").contains("###"), 0).otherwise(1).alias("quality"))
    model = quality_classifier.train(many_docs, labels)
    assert 0 < len(model.rules) < 40
    got = {r["doc_id"]: r for r in quality_classifier.score_quality(many_docs, model).collect()}
    for i, t in rows_of(many_docs):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["predicted"] == int("###" not in t) == int(got[i]["score"] >= 0.7)
    edge = quality_classifier.score_quality(edge_docs, model).collect()
    assert len(edge) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in edge)
    none = quality_classifier.train(many_docs, labels.limit(0))
    assert none.rules == () and 0 <= quality_classifier.score_quality(many_docs, none).first()["score"] <= 1


def test_trees_and_lasso_are_the_plain_ones():
    """The first split is the best of all splits of all statistics by gain, and the weights can't be improved one by one."""
    r = np.random.default_rng(2)
    x = r.random((300, len(quality_classifier.NAMES))).round(2)
    y = ((x[:, 3] > 0.6) & (x[:, 5] < 0.7) | (r.random(300) < 0.1)).astype(float)
    rules = quality_classifier.grow_rules(x, y)
    p = y.mean()
    grad, hess = y - p, np.full(300, p * (1 - p))

    def gain(low):
        part = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1)
        return part(low) + part(~low) if min(low.sum(), (~low).sum()) >= quality_classifier.LEAF else 0.0

    cuts = {f: np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality_classifier.BINS + 2)[1:-1])) for f in range(x.shape[1])}
    best = max(gain(x[:, f] <= c) for f, cs in cuts.items() for c in cs)
    (name, _, bound), = rules[0].tests
    assert gain(x[:, quality_classifier.NAMES.index(name)] <= bound) == pytest.approx(best)
    z = np.stack([q.array(x) for q in rules[:12]], axis=1).astype(float)
    b, w = quality_classifier.lasso(z, y)
    spread = np.maximum(z.std(0), 0.05)

    def loss(b, w):
        s = z @ w + b
        return np.mean(np.log1p(np.exp(s)) - y * s) + quality_classifier.LASSO * np.abs(w * spread).sum()

    for k in range(len(w)):
        for step in (-0.05, 0.05):
            other = w.copy()
            other[k] += step
            assert loss(b, other) >= loss(b, w) - 1e-5
    assert (w == 0).any() and loss(b + 0.05, w) >= loss(b, w) - 1e-5 and loss(b - 0.05, w) >= loss(b, w) - 1e-5


def test_a_label_has_one_document(spark, many_docs):
    labels = many_docs.select("doc_id", F.when(F.col("text").contains("###"), 0).otherwise(1).alias("quality"))
    one = quality_classifier.train(many_docs, labels)
    assert quality_classifier.train(many_docs.unionByName(many_docs).unionByName(many_docs), labels, max_labelled=1000) == one


def test_compiled_rules_are_the_rules(spark, many_docs):
    stats = quality_classifier.text_statistics(many_docs).select("doc_id", "_stats")
    rules = [quality_classifier.Rule((("words", True, 100.0), ("symbols", False, 0.01))), quality_classifier.Rule((("stops", False, 0.05),))]
    rows = stats.select("_stats.*", *[r.column().alias(f"r{k}") for k, r in enumerate(rules)]).collect()
    x = np.asarray([[r[n] for n in quality_classifier.NAMES] for r in rows])
    for k, rule in enumerate(rules):
        assert rule.array(x).tolist() == [r[f"r{k}"] for r in rows]


def test_columns_named_like_the_operators_own(spark, many_docs):
    own = ["_row", "_id", "_doc", "_lines", "_t", "_w", "_stats", "_lang", "_nth", "_counts", "_share"]
    docs = many_docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in own})
    model = quality_classifier.Model(0.0, (quality_classifier.Rule((("words", True, 50.0),), 1.0),))
    pages = docs.withColumnRenamed("text", "html").withColumns({"_got": F.lit("_got")})
    results = [line_dedup.drop_repeated_lines(docs), quality_rules.quality_rules(docs), mixing.mixed_rows(docs), near_duplicates.one_of_each(docs), quality_classifier.score_quality(docs, model)]
    for out in results:
        assert set(docs.columns) <= set(out.columns)
        assert all(r[c] == f"{c}{r['doc_id']}" for r in out.collect() for c in own)
    assert html_extract.extract_pages(pages).where("_got = '_got'").count() == 240


# All of them on nothing


def test_empty_tables(spark, no_docs):
    out = [
        line_dedup.drop_repeated_lines(no_docs),
        quality_rules.quality_rules(no_docs),
        quality_rules.quality_rules(no_docs, keep_texts=False),
        near_duplicates.near_duplicates(no_docs),
        near_duplicates.one_of_each(no_docs),
        mixing.mixed_rows(no_docs),
        mixing.mix(no_docs, keys=["doc_id"]),
        packing.best_fit_pack(no_docs, TOKENIZER),
        fingerprints.edited_fingerprints(no_docs),
        pii.find_pii(no_docs),
        quality_classifier.score_quality(no_docs, quality_classifier.train(no_docs, no_docs.select("doc_id", F.lit(1).alias("quality")))),
        chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
    ]
    assert [df.count() for df in out] == [0] * len(out)
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
