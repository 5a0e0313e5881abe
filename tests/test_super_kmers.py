"""Super-k-mers: the same k-mers as by listing them, few bytes to shuffle, full minimizers by a way of their own."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import kmers, lineage

STRANDS = str.maketrans("ACGTacgt", "TGCAtgca")


def slow(seqs, k, canonical=False, alphabet=None):
    found = collections.Counter()
    for s in seqs:
        for i in range(len(s or "") - k + 1):
            x = s[i : i + k]
            if alphabet is None or set(x) <= set(alphabet):
                found[min(x, x[::-1].translate(STRANDS)) if canonical else x] += 1
    return found


def genome(seed=4):
    r = random.Random(seed)
    base = "".join(r.choice("ACGT") for _ in range(3000))
    out = [base[i : i + 200] for i in range(0, 2800, 90)]
    return [*out, "A" * 20_000, "ACGTN" * 300, "N" * 50, base * 40, "ACG", "", None, *[base[:150]] * 20]


@pytest.mark.parametrize(("canonical", "alphabet"), [(False, None), (True, "ACGT"), (False, "ACGT"), (True, None)])
@pytest.mark.parametrize("k", [3, 21, 33])
def test_counts(spark, k, canonical, alphabet):
    seqs = genome()
    df = spark.createDataFrame([(s,) for s in seqs], "seq string").repartition(3)
    got = {r["kmer"]: r["n"] for r in kmers.kmer_count(df, k, canonical_form=canonical, alphabet=alphabet).collect()}
    assert got == slow(seqs, k, canonical, alphabet)


def test_any_text_and_sets(spark):
    rows = [(i % 3 if i % 4 else None, t) for i, t in enumerate(["über der Brücke \U0001f600 " * 9, "a\nb\x00c" * 20, "中文" * 40000, "short", "über der"] * 2)]
    df = spark.createDataFrame(rows, "lib int, seq string")
    got = {(r["lib"], r["kmer"]): r["n"] for r in kmers.kmer_count(df, 8, by=["lib"]).collect()}
    want = collections.Counter()
    for lib, s in rows:
        want.update({(lib, x): n for x, n in slow([s], 8).items()})
    assert got == want


def test_pieces_are_short_and_full_places_are_few(spark):
    df = spark.createDataFrame([(s,) for s in genome()], "seq string")
    pieces = kmers.super_kmers(df, 21, alphabet="ACGT")
    assert pieces.agg(F.max(F.length("piece"))).first()[0] <= 4096 + 20
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = kmers.full_buckets([pieces], 21)
    assert 0 < full.count() <= 4 * tasks
    even = [("".join(random.Random(i).choices("ACGT", k=400)),) for i in range(300)]
    even = spark.createDataFrame(even, "seq string")
    spelled = kmers.super_kmers(even, 31, alphabet="ACGT").agg(F.sum(F.length("piece"))).first()[0]
    assert spelled < 31 * 370 * 300 / 5


def test_places_need_no_second_shuffle(spark):
    df = spark.createDataFrame([(s,) for s in genome()], "seq string")
    pieces = kmers.super_kmers(df, 21)
    near, _ = kmers._by_bucket(pieces, kmers.full_buckets([pieces], 21), 21, [], F.count(F.lit(1)).alias("n"), False, False)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(bucket") == 1 and "hashpartitioning(bucket#" in plan and "kmer#" not in "".join(x for x in plan.split("\n") if "Exchange" in x)


def words(n, seed=2):
    r = random.Random(seed)
    return [" ".join(r.choice(["the", "tion", "and", "über", "of", "er"]) for _ in range(r.randrange(0, 60))) for _ in range(n)]


def test_kmers_of_places_are_not_spread_one_by_one(spark):
    """K-mers of a text are told apart in groups of places; short ones are combined where they are read."""
    df = spark.createDataFrame([(t,) for t in words(40)], "seq string")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan(kmers.kmer_count(df, 13)) and "MapInArrow" in plan(kmers.kmer_count(df, 5))
    assert {r["kmer"]: r["n"] for r in kmers.kmer_count(df, 5).collect()} == slow(words(40), 5)


@pytest.mark.parametrize("full", [40, 1 << 22])
def test_colours_and_regions_with_full_places(spark, monkeypatch, full):
    monkeypatch.setattr(kmers, "FULL", full)
    monkeypatch.setattr(kmers, "GROUP", 300)
    rows = [(f"r{i}" if i % 9 else None, i % 5 if i % 7 else None, t) for i, t in enumerate(words(50))]
    df = spark.createDataFrame(rows, "name string, colour int, seq string")
    masks, seen = collections.Counter(), {}
    for _, c, t in rows:
        for x in slow([t], 13):
            masks[x] |= 0 if c is None else 1 << c
            seen[x] = seen.get(x, False) or c is not None
    got = {r["kmer"]: r["mask"] for r in kmers.kmer_masks(df, 13).collect()}
    assert got == {x: m if seen[x] else None for x, m in masks.items()}
    names = lambda m: "-".join(str(c) for c in range(6) if m >> c & 1)
    counts = {r["combination"]: r["n"] for r in kmers.kmer_colours(df, 13).collect()}
    assert counts == collections.Counter(names(m) for m in masks.values())
    flags = {r["name"]: [r[c] for c in "abcde"] for r in kmers.kmer_query(df.where("name is not null"), df, 13, 0.4, dict(zip("abcde", range(5)))).collect()}
    for name, _, t in rows:
        if name:
            own = slow([t], 13)
            share = lambda c: sum(n for x, n in own.items() if masks[x] >> c & 1) / sum(own.values()) >= 0.4
            assert flags[name] == [bool(own) and share(c) for c in range(5)]


def test_regions_travel_packed(spark, monkeypatch):
    """Super-k-mers of both sides of a query go out packed, many to a row, and groups that hold nothing asked for give nothing."""
    monkeypatch.setattr(kmers, "GROUP", 50)
    known = spark.createDataFrame([(i % 3, t) for i, t in enumerate(words(60))], "colour int, seq string").repartition(4)
    texts = {1: words(60)[7], 2: "not there at all, none of it", 3: None, 4: words(60)[7] + " or something else"}
    asked = spark.createDataFrame([(i, t) for i, t in texts.items()], "name long, seq string")
    cut = kmers.super_kmers(known, 13).count()
    packed = kmers._packed_pieces(known, 13, 5)
    assert packed.count() <= 5 * int(spark.conf.get("spark.sql.shuffle.partitions")) < cut
    assert packed.where("bucket = 3").count() > 0 and kmers._packed_pieces(known, 13, 5, [3]).where("bucket = 3").count() == 0
    loads = {r["bucket"]: r["n"] for r in kmers._part_loads(known.select("seq"), 13, 5).groupBy("bucket").agg(F.sum("load").alias("n")).collect()}
    assert sum(loads.values()) == sum(slow(words(60), 13).values())
    query = kmers.kmer_query(asked, known, 13, 0.5, {"a": 0, "b": 1, "c": 2})
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and not any("piece" in line for line in plan.split("\n") if "Exchange" in line)
    masks = [{x for i, t in enumerate(words(60)) if i % 3 == c for x in slow([t], 13)} for c in range(3)]
    for r in query.collect():
        own = slow([texts[r["name"]]], 13)
        assert [r[c] for c in "abc"] == [bool(own) and sum(n for x, n in own.items() if x in masks[c]) / sum(own.values()) >= 0.5 for c in range(3)]


@pytest.mark.parametrize(("rounds", "in_a_bucket"), [(1, 8), (3, 2)])
def test_groups_share_buckets_and_take_turns(spark, monkeypatch, rounds, in_a_bucket):
    """Many groups travel in few buckets, nothing is stored but sums of regions, and no shuffle of a round stays."""
    for name, value in (("GROUP", 60), ("BUCKETS", 8), ("IN_A_BUCKET", in_a_bucket), ("ROUNDS", rounds), ("ROUND", 1)):
        monkeypatch.setattr(kmers, name, value)
    stored = []
    monkeypatch.setattr(kmers, "written_once", lambda df: stored.append(df.columns) or lineage.written_once(df))
    rows = [(f"r{i}" if i % 9 else None, i % 5 if i % 7 else None, t) for i, t in enumerate(words(50))]
    df = spark.createDataFrame(rows, "name string, colour int, seq string")
    masks = collections.Counter()
    for _, c, t in rows:
        for x in slow([t], 13):
            masks[x] |= 0 if c is None else 1 << c
    names = lambda m: "-".join(str(c) for c in range(6) if m >> c & 1)
    assert {r["combination"]: r["n"] for r in kmers.kmer_colours(df, 13).collect()} == collections.Counter(names(m) for m in masks.values())
    assert {r["kmer"]: r["n"] for r in kmers.kmer_count(df, 13).collect()} == slow([t for *_, t in rows], 13)
    got = {(r["colour"], r["kmer"]): r["n"] for r in kmers.kmer_count(df, 13, by=["colour"]).collect()}
    assert got == {(c, x): n for c in {c for _, c, _ in rows} for x, n in slow([t for _, d, t in rows if d == c], 13).items()}
    assert not stored  # neither super-k-mers nor loads
    flags = {r["name"]: [r[c] for c in "abcde"] for r in kmers.kmer_query(df.where("name is not null"), df, 13, 0.4, dict(zip("abcde", range(5)))).collect()}
    for name, _, t in rows:
        if name:
            own = slow([t], 13)
            share = lambda c: sum(n for x, n in own.items() if masks[x] >> c & 1) / sum(own.values()) >= 0.4
            assert flags[name] == [bool(own) and share(c) for c in range(5)]
    assert stored == [["name", "n", "_0", "_1", "_2", "_3", "_4"]] * (rounds if rounds > 1 else 0)


def test_shuffles_behind_a_stored_table_are_dropped(spark):
    import glob

    folder = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folder for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}
    before, had = files(), spark.conf.get(lineage.CLEANUP)
    df = spark.range(1000).repartition(3, "id")
    out = lineage.written_once(df)
    assert files() <= before and out.count() == 1000 and spark.conf.get(lineage.CLEANUP) == had
