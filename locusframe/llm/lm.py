"""Interpolated modified Kneser-Ney n-gram model, counted in Spark.

Words get dense numbers in order of their hash. N-grams of numbers are counted in
slices, sent to parts by the first bits of their hash and merged there. A part of the
highest order writes its sorted hashes and counts, and sends on what the next order
needs: each distinct n-gram once to its suffix, and sums to its context. The model is
a folder of sorted hash arrays that workers map into memory and search; discounts
follow from counts of counts, so nothing is joined when it is built.

Files are written under a name of their own and then moved to one that depends on
order and part only, so a task that runs again writes the same file again.
"""

from __future__ import annotations

import json
import struct
from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..operators.lineage import scratch_path
from . import common, shingles
from .folder import Folder

#: Text whose n-grams are counted before they are sent.
SLICE_BYTES = 6 << 20
# No word has white space, so these stand for no word.
END, BEGIN = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b" ", b"\n"))


def pack(arrays: list[np.ndarray]) -> bytes:
    """Unsigned arrays of one length, the first ascending and stored as steps, in the narrowest type, by byte planes."""
    n, out = len(arrays[0]), [struct.pack("<IQ", len(arrays), len(arrays[0]))]
    for i, a in enumerate(arrays):
        a = a.astype(np.uint64)
        if i == 0 and n:
            a = np.concatenate([a[:1], a[1:] - a[:-1]])
        most = int(a.max()) if n else 0
        size = next(s for s in (1, 2, 4, 8) if most < 1 << 8 * s)
        out += [bytes([size]), np.ascontiguousarray(a.astype(f"<u{size}").view(np.uint8).reshape(n, size).T).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count, n = struct.unpack_from("<IQ", raw)
    at, out = 12, []
    for i in range(count):
        size = raw[at]
        planes = np.frombuffer(raw, np.uint8, n * size, at + 1).reshape(size, n)
        a = np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(n).astype(np.uint64)
        out.append(np.cumsum(a, dtype=np.uint64) if i == 0 else a)
        at += 1 + n * size
    return out


def step(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of its first n - 1 words and its last word."""
    return shingles.mixed(h * shingles._K + word.astype(np.uint64) + np.uint64(1))


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = step(h, c)
    return h


def merged(h: np.ndarray, sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes, ascending; the first place of each; sums of the columns."""
    order = np.argsort(h, kind="stable")
    h = h[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[start], order[start], [np.add.reduceat(s[order], start) if len(h) else s for s in sums]


_maps: dict[tuple[str, str], np.ndarray] = {}


@dataclass
class Table:
    """Sorted hashes with columns, in parts by the first bits."""

    uri: str
    name: str
    bits: int
    rows: dict[int, int]  # of each part that has any
    columns: tuple[str, ...]

    def array(self, part: int, column: str) -> np.ndarray:
        key = (self.uri, f"{self.name}-{part:06d}.{column}")
        if key not in _maps:
            _maps[key] = Folder(self.uri).map(key[1], "<u8" if column == "hash" else "<u4" if column == "count" else "<i8")
        return _maps[key]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Place of each hash in the whole table (-1: not there), and its columns (0: not there)."""
        q, back = np.unique(h, return_inverse=True)
        place, out = np.full(len(q), -1, np.int64), [np.zeros(len(q), np.int64) for _ in self.columns]
        part = (q >> np.uint64(64 - self.bits)).astype(np.int64)
        before = 0
        for p in sorted(self.rows):
            a, b = np.searchsorted(part, [p, p + 1])
            if b > a:
                keys = self.array(p, "hash")
                at = np.searchsorted(keys, q[a:b])
                at = np.minimum(at, len(keys) - 1)
                hit = np.flatnonzero(keys[at] == q[a:b])
                place[a + hit] = before + at[hit]
                for o, c in zip(out, self.columns):
                    o[a + hit] = self.array(p, c)[at[hit]]
            before += self.rows[p]
        return place[back], [o[back] for o in out]


@dataclass
class Model:
    order: int
    words: Table
    grams: dict[int, Table]
    contexts: dict[int, Table]
    tokens: int
    discounts: dict[int, tuple[float, float, float]]
    unigrams: tuple[int, int, int, int]  # sum of counts, and types with a count of 1, 2, 3 or more

    @property
    def size(self) -> int:
        return sum(self.words.rows.values())

    def sequences(self, found: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and counts of the distinct tokens of the texts; which of them stand one after the other; lengths.

        Each text has a begin before its words and an end behind them.
        """
        h = np.concatenate([np.concatenate([[BEGIN], shingles.word_hashes(f), [END]]) for f in found])
        length = np.array([len(f) + 2 for f in found])
        h, back = np.unique(h, return_inverse=True)
        ids, (counts,) = self.words.find(h)
        ids = np.where(ids < 0, self.size + 1, ids)
        ids[h == BEGIN] = self.size
        return ids, counts, back, length

    def probabilities(self, distinct: np.ndarray, back: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of each token behind a begin, given up to order - 1 tokens of its own text before it; 1 for a begin."""
        place = np.arange(len(back)) - np.repeat(np.cumsum(length) - length, length)
        ids, first = distinct[back], step(np.zeros(len(distinct), np.uint64), distinct)
        total, n1, n2, n3 = self.unigrams
        d = self.discounts[1]
        p = np.full(len(distinct), 1 / (self.size + 1))
        if total:
            _, (c,) = self.grams[1].find(first)
            p = lowered(c, d) / total + (d[0] * n1 + d[1] * n2 + d[2] * n3) / total * p
        p = np.where(place > 0, p[back], 1.0)
        for k in range(2, self.order + 1):
            at = np.flatnonzero(place >= k - 1)
            if not len(at) or not self.contexts[k].rows:
                break
            d = self.discounts[k]
            # contexts of one token are looked up once for each distinct token
            h = first if k == 2 else gram_hash([ids[at - j] for j in range(k - 1, 0, -1)])
            where, (total, n1, n2, n3) = self.contexts[k].find(h)
            weight = (d[0] * n1 + d[1] * n2 + d[2] * n3) / np.maximum(total, 1)
            if k == 2:
                h, where, total, weight = (x[back[at - 1]] for x in (h, where, total, weight))
            known = np.flatnonzero(where >= 0)
            at, h, total, weight = at[known], h[known], total[known], weight[known]
            _, (c,) = self.grams[k].find(step(h, ids[at]))
            p[at] = lowered(c, d) / total + weight * p[at]
        return p


def lowered(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(c > 0, c - np.array([0.0, *d])[np.minimum(c, 3)], 0.0)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """From the numbers of n-grams with counts of 1, 2, 3 and 4; 0.5, 1 and 1.5 where these are too few or out of order."""
    if min(n[:3]) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        d = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
        if all(0 < x <= k for k, x in zip((1, 2, 3), d)):
            return d
    return 0.5, 1.0, 1.5


def _texts(batch):
    import pyarrow as pa

    shingles.begin()
    for a, b in common.slices(batch.column("text"), SLICE_BYTES):
        yield a, b, [shingles.words(t) for t in batch.column("text").slice(a, b - a).cast(pa.binary()).to_pylist()]


def _rows(rows):
    import pyarrow as pa

    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["kind", "ord", "part", "data"])


def _sent(kind: str, order: int, h: np.ndarray, columns: list[np.ndarray], bits: int):
    """Rows that carry the columns to the parts of the hashes; the first column ascends in each."""
    part = (h >> np.uint64(64 - bits)).astype(np.int64)
    by = np.lexsort((columns[0], part))
    cut = np.searchsorted(part[by], np.arange((1 << bits) + 1))
    for p in np.flatnonzero(np.diff(cut)):
        at = by[cut[p] : cut[p + 1]]
        yield kind, order, int(p), pack([c[at] for c in columns])


ROWS = "kind string, ord int, part int, data binary"


def build(docs: DataFrame, order: int = 2, uri: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count a model of the given order over all texts; its files are in `uri`, else in a new folder of spark.checkpoint.dir.

    Every word and n-gram of every text counts; there is no cut-off. A text without
    words, null texts too, is one end token.
    """
    import pandas as pd

    spark = docs.sparkSession
    common.ship(spark)
    uri = uri or scratch_path(spark)
    texts = common.texts(docs, id_col, text_col).select("text")
    bits = max(1, (common.input_partitions(texts) - 1).bit_length())

    def count_words(batches):
        for batch in batches:
            for _, _, found in _texts(batch):
                h = np.concatenate([shingles.word_hashes([w for f in found for w in f]), np.full(len(found), END)])
                h, n = np.unique(h, return_counts=True)
                yield _rows(list(_sent("word", 0, h, [h, n], bits)))

    def merge_words(pdf):
        part, columns = int(pdf["part"].iloc[0]), [unpack(x) for x in pdf["data"]]
        h, _, (n,) = merged(np.concatenate([c[0] for c in columns]), [np.concatenate([c[1] for c in columns])])
        Folder(uri).write(f"word-{part:06d}.hash", h.astype("<u8"))
        Folder(uri).write(f"word-{part:06d}.total", n.astype("<i8"))
        return pd.DataFrame({"part": [part], "n": [len(h)], "tokens": [int(n.sum())]})

    # one row for each part comes to the driver
    parts = texts.mapInArrow(count_words, ROWS).groupBy("part").applyInPandas(merge_words, "part int, n long, tokens long").collect()
    words = Table(uri, "word", bits, {r["part"]: r["n"] for r in parts}, ("total",))
    model = Model(order, words, {}, {}, sum(r["tokens"] for r in parts), {}, (0, 0, 0, 0))

    def count_grams(batches):
        for batch in batches:
            for _, _, found in _texts(batch):
                ids, _, back, length = model.sequences(found)
                ids = ids[back]
                start = np.cumsum(length) - length
                place = np.arange(len(ids)) - np.repeat(start, length)
                rows = []
                for k in range(1, order + 1):
                    # of the lower orders those that start at the begin, once for each text
                    first = start[length >= k] if 1 < k < order else np.flatnonzero(place >= max(k - 1, 1)) - (k - 1) if k == order else start[:0]
                    columns = [ids[first + j].astype(np.uint64) for j in range(k)]
                    h, at, (n,) = merged(gram_hash(columns), [np.ones(len(first), np.uint64)])
                    rows += _sent("gram", k, h, [*[c[at] for c in columns], n], bits)
                if rows:
                    yield _rows(rows)

    def level(k: int):
        def run(pdf):
            kind, o, part = pdf["kind"].iloc[0], int(pdf["ord"].iloc[0]), int(pdf["part"].iloc[0])
            if kind == "stat" or kind == "gram" and o != k:
                return pdf
            columns = [np.concatenate(c) for c in zip(*map(unpack, pdf["data"]))]
            folder, name = Folder(uri), f"{kind}{o}-{part:06d}"
            if kind == "context":
                h, _, sums = merged(gram_hash(columns[: o - 1]), columns[o - 1 :])
                folder.write(f"{name}.hash", h.astype("<u8"))
                for c, s in zip(("total", "n1", "n2", "n3"), sums):
                    folder.write(f"{name}.{c}", s.astype("<i8"))
                return pd.DataFrame([("stat", o, part, json.dumps({"kind": kind, "rows": len(h)}).encode())], columns=pdf.columns)
            h, at, (n,) = merged(gram_hash(columns[:k]), columns[k:])
            words_ = [c[at] for c in columns[:k]]
            folder.write(f"{name}.hash", h.astype("<u8"))
            folder.write(f"{name}.count", np.minimum(n, 0xFFFFFFFF).astype("<u4"))
            of = [int((n == i).sum()) for i in (1, 2, 3, 4)]
            out = [("stat", o, part, json.dumps({"kind": kind, "rows": len(h), "n": of, "sum": int(n.sum())}).encode())]
            if k > 1:
                rest, context = words_[1:], words_[:-1]
                low, first, (times,) = merged(gram_hash(rest), [np.ones(len(h), np.uint64)])
                out += _sent("gram", k - 1, low, [*[c[first] for c in rest], times], bits)
                high, first, sums = merged(gram_hash(context), [n, *[(n == i).astype(np.uint64) for i in (1, 2)], (n > 2).astype(np.uint64)])
                out += _sent("context", k, high, [*[c[first] for c in context], *sums], bits)
            return pd.DataFrame(out, columns=pdf.columns)

        return run

    rows = texts.mapInArrow(count_grams, ROWS)
    for k in range(order, 0, -1):
        rows = rows.groupBy("kind", "ord", "part").applyInPandas(level(k), ROWS)
    stats = [(r["ord"], r["part"], json.loads(bytes(r["data"]))) for r in rows.where("kind = 'stat'").collect()]
    for k in range(1, order + 1):
        grams = [(p, s) for o, p, s in stats if o == k and s["kind"] == "gram"]
        model.grams[k] = Table(uri, f"gram{k}", bits, {p: s["rows"] for p, s in grams}, ("count",))
        model.contexts[k] = Table(uri, f"context{k}", bits, {p: s["rows"] for o, p, s in stats if o == k and s["kind"] == "context"}, ("total", "n1", "n2", "n3"))
        of = [sum(s["n"][i] for _, s in grams) for i in range(4)]
        model.discounts[k] = discounts(of)
        if k == 1:
            model.unigrams = (sum(s["sum"] for _, s in grams), of[0], of[1], sum(s["rows"] for _, s in grams) - of[0] - of[1])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score), one for each row of docs.

    Tokens are the words and one end. score is the model's log10 probability of the
    text, base_score that of smoothed single-word counts; perplexity is
    10 ** (-score / n_tokens). Null and empty texts are one end token; null ids stay.
    """
    common.ship(docs.sparkSession)
    total, size = model.tokens, model.size

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b, found in _texts(batch):
                ids, counts, back, length = model.sequences(found)
                start = np.cumsum(length) - length
                p = np.log10(model.probabilities(ids, back, length))
                base = np.log10((counts + 0.5) / (total + 0.5 * (size + 1)))[back]
                base[start], known = 0.0, (counts > 0)[back]
                known[start] = False
                columns = [pa.array(length - 1), pa.array(np.add.reduceat(known.astype(np.int64), start)), pa.array(np.full(len(found), total)), pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(p, start))]
                yield pa.record_batch([batch.column("doc_id").slice(a, b - a), *columns], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return common.texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_held_out(docs: DataFrame, order: int = 2, folds: int = 5, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows whose crc32 of the id modulo `folds` is not `held`, and score all rows; a null id learns."""
    out = lambda c: F.coalesce(F.crc32(F.col(c).cast("long").cast("string").cast("binary")) % folds == held, F.lit(False))
    model = build(docs.where(~out(id_col)), order, None, id_col, text_col)
    return score(docs, model, id_col, text_col).select("doc_id", out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
