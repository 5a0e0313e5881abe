"""The operators against brute-force versions, DuckDB, exact round trips and held-out accuracy."""

import collections
import hashlib
import itertools
import math
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from check_oracles import normal  # noqa: E402
from locusframe.llm import ann, jaccard, linededup, lm, merkle, mixing, packing, quality, token_counts, token_files, tokens  # noqa: E402
from locusframe.llm.queries import ORACLES, QUERIES  # noqa: E402
from locusframe.operators.lineage import scratch_path  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def frame(spark, texts, start=0):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts, start)], "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(documents):
    return documents.orderBy("doc_id").collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    mine, theirs = normal(QUERIES[name](spark, SF).toPandas()), normal(con.execute(ORACLES[name]).df())
    assert list(mine.columns) == list(theirs.columns)
    assert mine.to_dict("records") == theirs.to_dict("records")


# tokens

PARTS = st.sampled_from(["'s", "'ll", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x85", "\xa0", " ", "<|endoftext|>", "<|startoftext|>", "The", "THE", "é", "é", "ß", "İ", "Σ", "²", "½", "12", "!!", "_", "ª", "words", ".", ",", "\U0001f600", "中文", "\x00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(max_size=4)), max_size=12).map("".join))
def test_pieces_give_the_library_ids(text):
    for path in (BYTE, WORD):
        t = tokens.pieces(path)
        want = t.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(t.ids(text), "<u4").tolist() == want


def test_every_latin_character_is_cut_as_by_the_full_pattern():
    t = tokens.pieces(BYTE)
    for a in map(chr, range(256)):
        for text in (f"a{a}b", f" {a}{a} 1{a}2 .{a}", f"{a}'s  {a}\n{a}"):
            assert t.latin.findall(text) == t.any_text.findall(text)


def test_whole_tokens_are_proved():
    t, whole = tokens.pieces(BYTE), token_counts.whole_tokens(BYTE)
    assert len(whole) > 40_000
    assert all(len(t.library.encode(w, add_special_tokens=False).ids) == 1 for w in whole[::97])


def test_token_counts(documents, rows):
    library = Tokenizer.from_file(BYTE)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(documents, BYTE, 300).collect()}
    for r in rows:
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert got[r["doc_id"]] == (len((r["text"] or "").encode()), n, n > 300)


def test_token_files_round_trip_and_pruning(spark, documents, rows):
    path = scratch_path(spark)
    token_files.write_token_files(documents, path, WORD, 1)
    library = Tokenizer.from_file(WORD)
    got = {r["doc_id"]: r["ids"] for r in token_files.read_token_files(spark, path).collect()}
    assert got == {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in rows}
    some = token_files.read_token_files(spark, path, [5, 6])
    assert "PushedFilters: [In(doc_id, [5,6])]" in some._jdf.queryExecution().toString()
    assert sorted(r["doc_id"] for r in some.collect()) == [5, 6]


# packing


def fill(plan, size):
    used, ranks = collections.Counter(), collections.defaultdict(list)
    for length, low, high, first, offset in plan:
        ranks[length].append((low, high))
        for k in range(high - low):
            assert offset + length <= size
            used[first + k] += length
    return used, ranks


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=15))
def test_plan_places_every_piece_once(histogram):
    used, ranks = fill(packing.two_fit_plan(histogram, 40), 40)
    assert max(used.values(), default=0) <= 40
    for length, n in histogram.items():
        at = 0
        for low, high in sorted(ranks[length]):
            assert low == at
            at = high
        assert at == n


def test_two_smaller_pieces_replace_the_smallest():
    # 6 + 3 leaves a gap of 1; 3 gives way to 2 + 2
    plan = packing.two_fit_plan({6: 1, 3: 1, 2: 2}, 10)
    assert {(length, sequence) for length, _, _, sequence, _ in plan} == {(6, 0), (2, 0), (3, 1)}


def test_packing_is_tight(documents):
    got = packing.pack_documents(documents, BYTE, 2, 1024).toPandas()
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / 1024) * 1.03 + 1
    for _, g in got.groupby("doc_id"):
        g = g.sort_values("piece")
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1]] and (g.length.iloc[1:] == 1024).all()


# near duplicates


def components(texts, n=5, percent=80):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(texts)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((top(a), top(b)))
            label[b] = a
    return [(i, len(s), top(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates(spark, seed):
    rng = random.Random(seed)
    texts = []
    passage = " ".join(f"p{i}" for i in range(30))
    for _ in range(12):
        base = [rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.choice((1, 3, 5, 9, 30, 80)))]
        for _ in range(rng.choice((1, 2, 8))):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = str(rng.randrange(1000))
            copy = copy[: len(copy) - rng.randrange(1 + len(copy) // 6)]
            texts.append(" ".join(copy).upper() if rng.random() < 0.1 else ("  " + "\t".join(copy)))
        texts.append(passage + " " + " ".join(base))
    rng.shuffle(texts)
    got = jaccard.near_duplicates(frame(spark, texts)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == components(texts)


def test_near_duplicates_of_the_table(documents, rows):
    got = jaccard.near_duplicates(documents).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == components([r["text"] for r in rows])


def test_suffix_filter_bounds_what_is_shared(spark):
    """For random ordered sets: the bound behind each shared shingle is at least what is shared there, and can be less than the smaller rest."""
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(200), rng.randrange(20, 80))) for _ in range(30)]
    step = 200 // jaccard.PARTS + 1
    upto = [[sum(v // step <= i for v in s) for i in range(jaccard.PARTS)] for s in sets]
    rows = []
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            for g in sorted(set(x) & set(y))[:3]:
                at, ay = x.index(g), y.index(g)
                rows.append((upto[i], upto[j], at, ay, len(set(x[at + 1 :]) & set(y[ay + 1 :])), min(len(x) - at, len(y) - ay) - 1))
    table = spark.createDataFrame(rows, "ux array<long>, uy array<long>, at long, ay long, shared long, rest long")
    bound = jaccard.shared_behind(jaccard.behind(F.col("ux"), F.col("at")), jaccard.behind(F.col("uy"), F.col("ay")))
    got = table.select(bound.alias("b"), "shared", "rest").collect()
    assert all(r["shared"] <= r["b"] <= r["rest"] for r in got) and sum(r["b"] < r["rest"] for r in got) > len(got) // 2


def test_probes_cut_the_order_evenly(spark):
    counts = spark.range(1000).select(F.xxhash64("id").alias("gram"), F.when(F.col("id") < 900, 2).otherwise(18).cast("long").alias("df"))
    probes = jaccard.probes(counts)
    assert len(probes) == jaccard.PARTS - 1 and {2, 18} <= {p[0] for p in probes}
    tokens = [(r["df"], r["gram"]) for r in counts.collect() for _ in range(r["df"])]
    cut = sorted(probes)
    sizes = [0] * jaccard.PARTS
    for t in tokens:
        sizes[sum(p <= t for p in cut)] += 1
    assert max(sizes) < 2 * len(tokens) / jaccard.PARTS
    assert jaccard.probes(counts.where("df < 0")) == []


def test_near_duplicates_of_one_template(spark):
    """20,000 texts that share a template but are not alike, and two that are; no pairs are listed for the template."""
    template = " ".join(f"t{i}" for i in range(30))
    texts = [f"{template} a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(20_000)]
    texts[7] = f"{template} x y"
    texts[11] = f"{template} x y z"
    got = jaccard.near_duplicates(frame(spark, texts)).where("doc_id <> component_id").collect()
    assert [(r["doc_id"], r["component_id"]) for r in got] == [(11, 7)]


# line dedup


def later_lines(texts, least):
    """Lines of the shortest runs of enough words, from a line on or up to a line, that occur earlier; but those of the first copy."""
    first, found = {}, []
    for d, text in enumerate(texts):
        line = text.split("\n") if text else []
        n = [len(x.encode().split()) for x in line]
        runs = set()
        for i in range(len(line)):
            e = next((e for e in range(i, len(line)) if sum(n[i : e + 1]) >= least), None)
            s = next((s for s in range(i, -1, -1) if sum(n[s : i + 1]) >= least), None)
            runs |= {(i, e)} if e is not None else set()
            runs |= {(s, i)} if s is not None else set()
        for s, e in sorted(runs):
            f = first.setdefault(tuple(line[s : e + 1]), (d, s, e))
            if f != (d, s, e):
                found.append((d, range(max(s, f[2] + 1) if f[0] == d else s, e + 1)))
    gone = collections.defaultdict(set)
    for d, lines in found:
        gone[d] |= set(lines)
    return [",".join(map(str, sorted(gone[d]))) for d in range(len(texts))]


def test_a_run_that_overlaps_its_copy_keeps_the_first(spark):
    ten = " ".join("abcdefghij")
    texts = ["\n".join([ten] * 12), "\n".join(["start", *[ten] * 5, "end"])]
    got = linededup.line_report(frame(spark, texts), 50).orderBy("doc_id").collect()
    assert [r["deleted"] for r in got] == ["5,6,7,8,9,10,11", "1,2,3,4,5"]


@pytest.mark.parametrize("seed, least", [(1, 1), (2, 5), (3, 9), (4, 20)])
def test_line_dedup(spark, seed, least):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice((0, 1, 3, 7)))) for _ in range(12)]
    block = "\n".join(pool[:6])
    texts = ["\n".join([*(rng.choice(pool) if rng.random() < 0.8 else f"only {rng.random()}" for _ in range(rng.randrange(12))), *([block] if rng.random() < 0.3 else [])]) for _ in range(40)]
    got = linededup.line_report(frame(spark, texts), least).orderBy("doc_id").collect()
    assert [r["deleted"] for r in got] == later_lines(texts, least)


# language model


def kneser_ney(train, texts, order):
    count = {k: collections.Counter() for k in range(1, order + 1)}
    for t in train:
        s = ["<s>", *t, "</s>"]
        for i in range(len(s) - order + 1):
            if order > 1 or i:
                count[order][tuple(s[i : i + order])] += 1
        for k in range(2, order):
            if len(s) >= k:
                count[k][tuple(s[:k])] += 1
    for k in range(order - 1, 0, -1):
        for g in count[k + 1]:
            count[k][g[1:]] += 1
    off = {k: (0, *lm.discounts([sum(v == i for v in count[k].values()) for i in (1, 2, 3, 4)])) for k in count}
    context = {k: collections.defaultdict(lambda: [0, 0, 0, 0]) for k in count}
    for k in count:
        for g, v in count[k].items():
            context[k][g[:-1]][0] += v
            context[k][g[:-1]][min(v, 3)] += 1
    vocabulary = {x for t in train for x in (*t, "</s>")}

    def p(word, before, k):
        low = 1 / (len(vocabulary) + 1) if k == 1 else p(word, before[1:], k - 1)
        c = context[k].get(before)
        if not c:
            return low
        v = count[k].get((*before, word), 0)
        return (v - off[k][min(v, 3)] + sum(off[k][i] * c[i] for i in (1, 2, 3)) * low) / c[0]

    def score(t):
        s = ["<s>", *t, "</s>"]
        return sum(math.log10(p(s[i], tuple(s[max(0, i - order + 1) : i]), min(order, i + 1))) for i in range(1, len(s)))

    for before in [("<s>",), *[(w,) for w in sorted(vocabulary)[:3]]] if order > 1 else []:
        assert abs(sum(p(w, before, 2) for w in vocabulary) + p("<unknown>", before, 2) - 1) < 1e-9
    return [score(t) for t in texts]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_kneser_ney(documents, rows, order):
    got = {r["doc_id"]: r for r in lm.score_held_out(documents, order).collect()}
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows]
    split = [words(r["text"]) for r in rows]
    train = [t for t, h in zip(split, held) if not h]
    known = collections.Counter(x for t in train for x in [*t, "\n"])
    total = sum(known.values())
    for r, t, h, want in zip(rows, split, held, kneser_ney(train, split, order)):
        g = got[r["doc_id"]]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (h, len(t) + 1, sum(x in known for x in [*t, "\n"]), total)
        assert g["score"] == pytest.approx(want, rel=1e-9)
        assert g["base_score"] == pytest.approx(sum(math.log10((known[x] + 0.5) / (total + 0.5 * (len(known) + 1))) for x in [*t, "\n"]), rel=1e-9)
    out = [got[r["doc_id"]] for r, h in zip(rows, held) if h]
    assert sum(g["score"] for g in out) > sum(g["base_score"] for g in out)


# nearest neighbours


def test_nearest(spark):
    got = ann.nearest(spark.read.parquet(f"{SF}/../sf0.01/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20).toPandas()
    table = spark.read.parquet(f"{SF}/../sf0.01/embeddings.parquet").toPandas()
    x, ids = np.stack(table.embedding.to_numpy()).astype(np.float64), table.vec_id.to_numpy()
    found = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(axis=1)
        best = [j for j in np.lexsort((ids, -score)) if j != i][:20]
        mine = got[got.query_id == ids[i]].sort_values("rank")
        found += len(set(mine.vec_id) & set(ids[best]))
        assert mine.score.tolist() == [dict(zip(ids, score))[v] for v in mine.vec_id]
    assert found >= 0.95 * len(got)


def test_graph_recall_with_norms_that_differ():
    rng = np.random.default_rng(0)
    raw = (rng.normal(size=(3000, 24)) * rng.lognormal(0, 0.3, size=(3000, 1))).astype(np.float32)
    x = ann.lengthened(raw)
    graph = ann.build_graph(x)
    queries = np.concatenate([raw[:200], np.zeros((200, 1), np.float32)], axis=1)
    found, _ = ann.beam_search(x, graph, queries, ann.SEARCH_BEAM)
    true = np.argsort(-(raw[:200] @ raw.T), axis=1)[:, :20]
    assert np.mean([len(set(a[:20]) & set(b)) / 20 for a, b in zip(found.tolist(), true.tolist())]) > 0.9


# mixing, fingerprints, quality


def test_mix_comes_near_the_targets(documents):
    got = mixing.mix(documents).toPandas()
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"), longest=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.longest / 2 + 1).all()
    assert by.target.sum() == pytest.approx(got["size"].sum()) and (by.target <= 3 * by["size"] + 1e-6).all()
    assert (got.taken <= 3 * got["size"]).all()
    kept = mixing.mixed_documents(documents).groupBy("doc_id").count().toPandas()
    assert dict(zip(kept.doc_id, kept["count"])) == {d: c for d, c in zip(got.doc_id, got.copies) if c}


def slow_mix(rows, targets, most=3, seed=0):
    """Copies of each document, by taking documents one after the other."""
    by, copies = collections.defaultdict(list), {}
    for r in rows:
        by[r["source"]].append((r["doc_id"], r["text"] or ""))
    for source, docs in by.items():
        sized = [(d, len(words(t)), hashlib.md5(f"{seed}:{d}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()) for d, t in docs]
        total = sum(n for _, n, _ in sized)
        rate = targets[source] / total if total else 0.0
        p, wanted = rate - math.floor(rate), targets[source] - math.floor(rate) * total
        left = []
        for d, n, key in sized:
            copies[d] = math.floor(rate)
            u = (int(key[:13], 16) + 0.5) / (1 << 52)
            left += [((u / (1 - u)) * ((1 - p) / p), key, d, n)] if p else []
        left.sort()

        def take(some, most):
            got = 0
            for x in some:
                if got + x[3] > most:
                    break
                got += x[3]
                copies[x[2]] += 1
                left.remove(x)
            return got

        missing = wanted - take(list(left), wanted)
        while missing >= 1:
            fit = [x for x in left if 0 < x[3] <= missing]
            if not fit:
                break
            missing -= take([x for x in fit if x[3] <= missing / 2] or fit, missing)
        last = min(((abs(missing - x[3]), x) for x in left if abs(missing - x[3]) < missing), default=None)
        if last:
            copies[last[1][2]] += 1
    return copies


def test_registered_mix_against_brute_force(spark, documents, rows):
    got = QUERIES["op7_pareto_mix"](spark, SF).toPandas()
    targets = dict(zip(got.source, got.target))
    assert dict(zip(got.doc_id, got.copies)) == slow_mix(rows, targets)
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    left = got[(got["size"] > 0) & (got.copies == np.floor(got.target / got.source_size))].groupby("source")["size"].min()
    assert ((by.taken - by.target).abs() <= np.maximum(0.01 * by.target, left.reindex(by.index).fillna(np.inf))).all()  # without any left, all were taken


def test_short_mix_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    mine, theirs = normal(mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"), fill=False).toPandas()), normal(con.execute(mixing.mix_sql()).df())
    assert mine.to_dict("records") == theirs.to_dict("records")


@pytest.mark.parametrize("weights, seed", [((1, 4), 1), ((1, 2), 1)])
def test_mix_goes_on_behind_a_long_document(spark, weights, seed):
    """Source a holds one document of over 0.4 of its words; about 0.3 and 0.5 of the source are wanted."""
    words = F.when(F.col("id") == 0, 15000).otherwise(100 - F.col("id") % 7).cast("int")
    df = spark.range(401).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), words).alias("text"), F.when(F.col("id") <= 200, "a").otherwise("b").alias("source"))
    got = mixing.mix(df, weights=weights, seed=seed).toPandas()
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 0.01 * by.target).all()
    kept = mixing.mixed_documents(df, weights=weights, seed=seed).groupBy("doc_id").count().toPandas()
    assert dict(zip(kept.doc_id, kept["count"])) == {d: c for d, c in zip(got.doc_id, got.copies) if c}


def test_inclusion_follows_the_probability(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.when(F.col("id") < 1000, "a").otherwise("b").alias("source"))
    got = [mixing.mix(df, weights=(1, 1), seed=s).groupBy("source", "copies").count().collect() for s in (1, 2)]
    for g in got:
        assert {(r["source"], r["copies"]): r["count"] for r in g} == {("a", 2): 1000, ("b", 0): 1000, ("b", 1): 2000}


def test_inclusion_follows_a_weight(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"), (F.col("id") % 3 + 1).alias("w"))
    got = mixing.mix(df, weights=(1, 3), seed=5, weight_col="w").toPandas()
    by = got.assign(w=got.doc_id % 3 + 1).groupby(["source", "w"]).copies.mean()
    # expected copies of source a: a half in all, in proportion to 1, 2 and 3; of source b three times as many
    for w in (1, 2, 3):
        assert by["a", w] == pytest.approx(w / 4, abs=0.05) and by["b", w] == pytest.approx(min(3, 3 * w / 4), abs=0.05)
    taken = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((taken.taken - taken.target).abs() <= 3).all()
    kept = mixing.mixed_documents(df, weights=(1, 3), seed=5, weight_col="w").groupBy("doc_id").count().toPandas()
    assert dict(zip(kept.doc_id, kept["count"])) == {d: c for d, c in zip(got.doc_id, got.copies) if c}


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 1, 10), ("b", 1, 1000), ("c", 1, 5), (None, 1, 200)], "source string, n long, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 30.0, "c": 15.0, None: pytest.approx((1215 - 45) / 3), "b": pytest.approx((1215 - 45) * 2 / 3)}


def test_changed_branches_locate_an_edit(spark):
    df = spark.createDataFrame([("One. Two. Three.\nFour. Five.", "One. Two. Three.\nFour. Six.")], "a string, b string")
    a, b = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    r = df.select(merkle.changed_branches(a, b).alias("x"), merkle.likeness(a, b).alias("near"), merkle.changed_branches(a, a).alias("same"), merkle.likeness(a, a).alias("one")).first()
    assert [n[0] for n in r["x"] if n[0] == "l"] == ["l"] and 0 < r["near"] < 1
    assert r["same"] == [] and r["one"] == 1.0


def test_quality_on_held_out_rows(spark):
    big = f"{SF}/../sf0.1"
    labels = spark.read.parquet(f"{big}/labels.parquet")
    got = quality.score_documents(spark.read.parquet(f"{big}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").toPandas()
    good = got.quality == 1
    ranks = got.score.rank()
    assert (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum()) > 0.98
    assert (got.predicted[good] == 1).mean() > 0.99


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = quality.fit(x[:3000], y[:3000])
    assert ((trees.predict(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.95


def test_pipeline(spark, documents):
    """Each stage on its own input against a brute-force version."""
    import corpus_pipeline

    held, names = documents, [n for n, _ in corpus_pipeline.STAGES]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = held.toPandas().sort_values("doc_id")
        path = scratch_path(spark)
        stage(spark, held, SF).write.parquet(path)
        held = spark.read.parquet(path)
        after = held.toPandas()
        if name != names[-1]:
            assert held.columns == documents.columns
        if name == names[0]:
            score = quality.train(documents, labels).predict(quality.matrix([t.encode() for t in before.text]))
            assert sorted(after.doc_id) == sorted(before.doc_id[score >= 0.3])
        elif name == names[1]:
            gone = later_lines(before.text.tolist(), 50)
            kept = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if str(i) not in g.split(",")) for d, t, g in zip(before.doc_id, before.text, gone) if not g or len(g.split(",")) < len(t.split("\n"))}
            assert dict(zip(after.doc_id, after.text)) == kept
            assert (after.n_chars == after.text.str.len()).all()
        elif name == names[2]:
            want = [d for d, (i, _, c) in zip(before.doc_id, components(before.text.tolist())) if i == c]
            assert sorted(after.doc_id) == want
        elif name == names[3]:
            mixed = mixing.mix(spark.createDataFrame(before)).toPandas()
            want = sorted(d for d, c in zip(mixed.doc_id, mixed.copies) for _ in range(c))
            assert sorted(after.doc_id) == want
        else:
            library = Tokenizer.from_file(BYTE)
            n = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in before.text)
            assert after.length.sum() == n and after.groupby("sequence_id").length.sum().max() <= 1024
    assert pd.Series(names).is_unique
