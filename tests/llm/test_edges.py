"""Every operator on awkward rows: nulls in any column, empty and very long texts, repeated rows, clashing names, empty tables."""

import hashlib
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locusframe.llm import ann, jaccard, linededup, lm, merkle, mixing, packing, quality, token_counts, token_files
from locusframe.operators.lineage import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = "The quick brown fox. Jumps over\nthe lazy dog! " * 8000
ROWS = [
    (1, "one two three four five six seven", "en", "a", 5),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, "one two three four five six seven", "en", "b", 1),
    (4, "one two three four five six seven", "en", "b", 1),
    (5, LONG, "en", "a", 1),
    (None, "no id here", "en", "a", 1),
    (None, "no id here", "en", None, 1),
    (6, " \t\r\n\x0b\x0c ", "en", "c", 1),
    (7, "\U0001f600 Ünïcode   text\x1c\x00 <|endoftext|> x", None, None, None),
    (8, "short", "en", "c", 1),
    (9, "line\n" * 300, "en", "c", 1),
    (-5, "negative id", "en", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns that operators use inside
CLASH = ["class", "rank", "at", "n", "size", "tie", "_block", "_row", "piece", "x", "length", "target", "_key", "text_hash", "_size", "_rate", "_target", "_upto", "_one", "_source", "_mix_key", "_id", "_hash", "_tie", "_i", "_h", "_text", "_deleted", "_weighted", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


LABELS = [(1, 1, 0), (4, 0, None), (None, 1, 1), (8, None, 0), (5, 1, 0), (3, 0, 0), (99, 1, 0)]


def by_id(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def test_token_counts(spark, docs, none):
    rows = token_counts.count_tokens(docs, BYTE, 6).collect()
    library = Tokenizer.from_file(BYTE)
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 6) for r in rows)
    assert token_counts.count_tokens(none, BYTE).count() == 0


def test_token_files(spark, docs, none):
    path = scratch_path(spark)
    token_files.write_token_files(docs, path, WORD, 1)
    rows = token_files.token_file_digest(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(WORD)
    ids = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in ROWS]
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted((str(i), len(x), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in x))) for i, x in ids)
    starts, order = 0, []
    for r in rows:
        assert r["start"] == starts
        starts += r["n_tokens"]
        order.append((r["doc_id"] is not None, r["doc_id"] or 0))
    assert order == sorted(order)
    path = scratch_path(spark)
    token_files.write_token_files(none, path, WORD, 1)
    assert token_files.token_file_digest(spark, path).count() == 0


def test_packing(docs, none):
    rows = packing.pack_documents(docs, BYTE, 2, 1024).collect()
    library = Tokenizer.from_file(BYTE)
    assert sum(r["length"] for r in rows) == sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ROWS)
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 1024
    assert packing.pack_documents(none, BYTE, 2).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3 for r in rows)
    total, target = sum(r["size"] for r in rows), {r["source"]: r["target"] for r in rows}
    assert abs(sum(target.values()) - total) < 1e-6 * total
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_merkle(docs, none):
    rows = merkle.edit_report(docs).collect()
    # descending ids, null ids last, rows of one id in any order of equal texts
    order = sorted([(r[0], r[1] or "") for r in ROWS], key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        want.append((str(i), len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in rows) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert len({r["fingerprint"] for r in rows}) == len({r[1] or "" for r in ROWS})
    assert merkle.edit_report(none).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert quality.score_documents(none, labels).count() == 0
    assert {r["score"] for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_jaccard(docs, none):
    rows = jaccard.near_duplicates(docs).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows)
    n = {1: 3, 2: 0, 3: 0, 4: 3, 6: 0, 8: 1, -5: 1}
    for i, size in n.items():
        assert {(s, c) for d, s, c in got if d == str(i)} == {(size, "1" if i == 4 else str(i))}
    assert [(s, c) for d, s, c in got if d == "None"] == [(1, "None")] * 2
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "5", "None", "None", "6", "7", "8", "9", "-5"])
    assert jaccard.near_duplicates(none).count() == 0 and jaccard.one_of_each(none).count() == 0


def test_one_of_near_copies_that_repeat_an_id(spark):
    common = " ".join(f"w{i}" for i in range(100))
    rows = [(1, common + " x"), (1, common + " y"), (1, common.upper() + " X"), (1, "a text of its own that shares nothing"), (1, ""), (2, common + " z"), (3, "w w w"), (3, "W w w")]
    kept = [(r["doc_id"], r["text"].lower()) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum(d == 1 and t.startswith("w0 ") for d, t in kept) == 1
    assert sorted(k for k in kept if not k[1].startswith("w0 ")) == [(1, ""), (1, rows[3][1]), (3, "w w w")]


def test_line_dedup(docs, none):
    rows = {(r["doc_id"], r["n_lines"]): r for r in linededup.line_report(docs, 5).collect()}
    assert linededup.drop_repeated_lines(docs, 5).drop("_n_lines", "_deleted").columns == [c for c in docs.columns if c != "_deleted"]
    assert rows[4, 1]["n_deleted"] == 1 and rows[1, 1]["n_deleted"] == 0
    assert rows[2, 0]["n_deleted"] == 0 and rows[3, 0]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert rows[9, 301]["n_deleted"] == 295  # the first five lines stay, and the empty end, the last line
    assert linededup.line_report(docs, 5).count() == len(ROWS)
    assert linededup.line_report(none).count() == 0


def test_lm(docs, none):
    rows = lm.score_held_out(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["n_tokens"] == len((r_text or "").encode().split()) + 1 for r, r_text in [(r, next(x[1] for x in ROWS if x[0] == r["doc_id"])) for r in rows])
    assert all(r["score"] <= 0 and r["n_known"] <= r["n_tokens"] for r in rows)
    assert lm.score_held_out(none).count() == 0
    empty = lm.score(docs, lm.build(none)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == 0 and r["base_score"] == 0 for r in empty)


def test_nearest(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [None, 1.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 1.0]), (5, [1.0, 1.0, 1.0]), (7, [float("inf"), 1.0]), (9, []), (2, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x")).withColumn("shard", F.lit(1))
    got = ann.nearest(table, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 2, 0.0), (20, 3, 3, 0.0)]
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
