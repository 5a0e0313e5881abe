"""Decontamination, conversation repair and phrases: brute force, awkward rows, method."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from locusframe.llm import conversations, decontamination, phrases
from locusframe.llm.automata import Automaton, union

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# decontamination


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def slow_contamination(docs, items, n):
    rows = []
    for doc, text in docs:
        w, hit, ids = item_words(text), set(), set()
        for item, other in items:
            x = item_words(other)
            k = min(n, len(x))
            own = {tuple(x[i : i + k]) for i in range(len(x) - k + 1)} if k else set()
            for i in range(len(w) - k + 1 if k else 0):
                if tuple(w[i : i + k]) in own:
                    hit.update(range(i, i + k))
                    ids.add("" if item is None else str(item))
        rows.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(rows, key=str)


def awkward_texts(seed=1, n=60):
    r = random.Random(seed)
    words = ["a", "B", "cc", "the", "über", "x1", "中文", "longerword", "Z9"]
    out = ["".join(r.choice(words) + r.choice([" ", "  ", ", ", "\n", "-", "\x00", "."]) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return [*out, None, "", " ., ", "a", "a b", out[3], "the " * 5000 + out[5]]


@pytest.mark.parametrize("part_bytes", [1 << 20, 900])
def test_contamination_against_brute_force(spark, part_bytes):
    items = [(i * 7, t) for i, t in enumerate(awkward_texts(2, 25))] + [(7, "a B"), (None, "cc the"), (21, "x1")]
    docs = list(enumerate(awkward_texts(1))) + [(None, "the cc the"), (3, "cc the")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("found", F.lit(1)).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit("clash"))
    got = decontamination.contamination(d, b, words=4, part_bytes=part_bytes).collect()
    assert sorted((tuple(r) for r in got), key=str) == slow_contamination(docs, items, 4)
    assert any(r["contaminated"] for r in got) and not all(r["contaminated"] for r in got)


def test_contamination_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontamination.contamination(d, none).collect()] == [(1, 3, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert decontamination.contamination(d.limit(0), none).count() == 0


def test_shift_tables_skip_and_miss_nothing():
    r = random.Random(5)
    text = b" " + b" ".join(r.choice([b"alpha", b"beta", b"gamma", b"delta", b"of"]) for _ in range(4000)) + b" "
    spaces = [i for i, c in enumerate(text) if c == 32]
    windows = [text[spaces[i] : spaces[i + 5] + 1] for i in (3, 900, 1022, 2500)]
    group = decontamination.Group(5, windows, [0, 1, 2, 3])
    padded = np.frombuffer(text + bytes(8), np.uint8)
    found = set(group.candidates(padded[:-8], np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))).tolist())
    assert {spaces[i] for i in (3, 900, 1022, 2500)} <= found
    assert group.shift.max() == group.m - 7 and (group.shift == 0).sum() <= 4
    assert len(found) < len(spaces) / 20


# conversations


def slow_repair(rows):
    """The best (cost, audit) over all edits of rows (role initial, gone, truncated), by trying them in order of cost."""
    best = {}
    legal = re.compile("(s?(ua)+)?")

    def go(i, state, cost, audit):
        if cost > 4 * len(rows):
            return
        if i == len(rows) and legal.fullmatch(state):
            key = (cost, audit)
            if "all" not in best or key < best["all"]:
                best["all"] = key
        if re.fullmatch("s?(ua)*u?", state) and len(audit) < 2 * len(rows) + 2:
            due = "a" if state.endswith("u") else "u"
            if not audit.endswith("II"):
                go(i, state + due, cost + 3, audit + "I")
            if i < len(rows):
                initial, gone, truncated = rows[i]
                go(i + 1, state, cost + 4, audit + "D")
                if not gone:
                    go(i + 1, state + initial, cost + 3 * truncated, audit + "K")
                    go(i + 1, state + due, cost + 3 + 3 * truncated, audit + "R")

    go(0, "", 0, "")
    return best["all"]


ROW = st.tuples(st.sampled_from("suaut"), st.sampled_from([False, False, True]), st.sampled_from([False, False, True]))


@settings(max_examples=150, deadline=None)
@given(st.lists(ROW, max_size=6))
def test_repair_is_the_cheapest_and_first(rows):
    out = []
    repair = conversations.Repair(lambda *x: out.append(x))
    for initial, gone, truncated in rows:
        repair.row(initial, "text", gone, truncated)
    cost = repair.end()
    assert (cost, "".join(x[0] for x in out)) == slow_repair(rows)
    assert re.fullmatch("(s?(ua)+)?", "".join(x[1][0] for x in out if x[0] != "D"))


def test_unsettled_edits_stay_few():
    out = []
    repair = conversations.Repair(lambda *x: out.append(x))
    r = random.Random(3)
    for i in range(20_000):
        repair.row(r.choice(["user", "assistant"]) if i % 50 == 0 else ("user", "assistant")[i % 2], f"t{i}", i % 97 == 0, i % 31 == 0)
    assert repair.most < 200 and len(out) > 19_000
    repair.end()
    held, todo = 0, [repair.root]
    while todo:
        node = todo.pop()
        held += 1
        todo += node.children
    assert held < 500


def slow_report(rows):
    """The counts, by plain Python, of rows (conv_id, turn, role, text)."""
    talks = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        talks[conv] += []
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            talks[conv] += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, n = set(), collections.Counter()
        for _, role, text in talk:
            said = text.strip(" \t\n\x0b\x0c\r")
            n["blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "good"] += 1
            seen.add((role, text))
        turns = {t for t, _, _ in talk if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(talk))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal)
    return out


def test_conversations_on_awkward_rows(spark):
    r = random.Random(9)
    rows = [(r.choice([None, *range(40)]), r.choice([None, *range(12)]), r.choice([None, "user", "assistant", "system", "tool", "", "élan"]), r.choice([None, "", " \t", "Yes.", "Yes.", "no end", "A?\n", "\x85"])) for _ in range(700)]
    rows += [(99, i, ("user", "assistant")[i % 2], f"row {i}.") for i in range(3000)] + [(100, 5, "user", "again.")] * 50
    rows += [(101, 1, "user", "long " * 200_000 + ".")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("gone", F.lit("x")).withColumn("_d", F.lit(2)).repartition(5)
    got = conversations.repair_report(table).collect()
    want = slow_report(rows)
    assert {r["conv_id"]: tuple(r)[1:6] for r in got} == want and len(got) == len(want)
    for x in got:
        kept = len(re.sub("I", "", x["audit"]))
        assert kept >= x["blank"] + x["duplicate"] and x["audit"].count("D") >= x["blank"] + x["duplicate"]
    assert conversations.repair_report(table.limit(0)).count() == 0


def test_a_conversation_that_loses_all_rows(spark):
    lost = next(f for f in range(1000) if zlib.crc32(f"{f}:0".encode()) % 20 == 0)
    got = conversations.repair_report(spark.createDataFrame([(lost, 0, "user", "x.")], "conv_id long, turn long, role string, text string")).first()
    assert tuple(got) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# phrases

SEQUENCES = st.dictionaries(st.tuples(*[st.integers(1, 5)] * 3), st.integers(1, 9), max_size=30)


def automaton(counted):
    rows = sorted(counted)
    return Automaton.build([np.array([r[d] for r in rows], np.uint64) for d in range(3)], np.array([counted[r] for r in rows], np.int64))


@settings(max_examples=100, deadline=None)
@given(st.lists(SEQUENCES, min_size=1, max_size=4), SEQUENCES)
def test_automata_unite_and_compose(some, asked):
    packed = [Automaton.unpack(automaton(x).pack()) for x in some]
    columns, counts = union(packed)
    total = sum((collections.Counter(x) for x in some), collections.Counter())
    assert dict(zip(zip(*(c.tolist() for c in columns)), counts.tolist())) == total
    both = Automaton.build(columns, counts)
    if asked and total:
        rows = list(asked) + list(total)
        assert both.compose([np.array([r[d] for r in rows], np.uint64) for d in range(3)]).tolist() == [total[r] for r in rows]


def slow_collocations(rows, longest, least, percent, top):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = set()
    for p, a in candidates.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                sub = (p[0], *p[i : i + k])
                if 100 * a >= percent * f[sub]:
                    inside.add(sub)
    out = []
    for lang in n:
        own = []
        for p, a in candidates.items():
            if p[0] == lang and p not in inside:
                score, _, l, r = min((2000000 * a // (f[p[: k + 1]] + f[lang, *p[k + 1 :]]), k, f[p[: k + 1]], f[lang, *p[k + 1 :]]) for k in range(1, len(p) - 1))
                own.append((-score, -a, " ".join(p[1:]).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(own)[:top], 1)]
    return sorted(out)


def spoken(n=150):
    r = random.Random(11)
    words = ["the", "Of", "new", "york", "city", "in", "über", "\x1c", "\xa0", "a"]
    out = [("".join(r.choice(words) + r.choice([" ", " ", " ", "\t", ". ", ",", "\r\n"]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None, ""])) for _ in range(n)]
    out += [("new york city " * 300, "en"), (None, "en"), ("", None), ("x" * 100_000, "en"), *[("in new york", "de")] * 30]
    return out


@pytest.mark.parametrize("shard", [1 << 20, 500])
def test_collocations_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    rows = spoken()
    table = spark.createDataFrame([(t, l, "clash") for t, l in rows], "text string, lang string, w1 string").repartition(3)
    got = phrases.collocations(table, longest=4, least=3, percent=80, top=25).collect()
    assert sorted(tuple(r) for r in got) == slow_collocations(rows, 4, 3, 80, 25)
    assert len(got) > 60


def test_collocations_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_heavy_pairs_are_told_apart_by_their_third_word():
    columns = [np.full(1000, 7, np.uint64), np.full(1000, 9, np.uint64), np.arange(1, 1001, dtype=np.uint64)]
    heavy = phrases.prints([c[:1] for c in columns[:2]])
    assert len(set(phrases.Ranges(4, np.zeros(0, np.uint64)).of(columns).tolist())) == 1
    assert len(set(phrases.Ranges(4, heavy).of(columns).tolist())) == 16
