"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once, on the driver,
by encoding each of them; the proof grows with the vocabulary only. Texts are cut
into pre-tokens, those with a proof count as one, and only the rest is merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import common, tokens


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that are one pre-token and that the library encodes as one token."""
    t = tokens.pieces(path)
    if t.kind != "byte":
        return []
    found = []
    strings = [s for s in (t.library.decode([i], skip_special_tokens=False) for i in range(t.library.get_vocab_size())) if s and s not in t.special]
    for s, e in zip(strings, t.library.encode_batch_fast(strings, add_special_tokens=False)):
        if len(e.ids) == 1 and t.pre_tokens(s) == [s]:
            found.append(s)
    return sorted(set(found))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each row of docs.

    The counts are those of the library without begin, end or added tokens. Null
    and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows
    stay; other columns are left out. A very long text is one row of work.
    """
    spark = docs.sparkSession
    common.ship(spark)
    whole = spark.sparkContext.broadcast(whole_tokens(path))  # at most one string for each id of the vocabulary

    def count(batches):
        import pyarrow as pa

        t = tokens.pieces(path)
        merged = counters(t, whole.value, path)
        for batch in batches:
            for a, b in common.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                text = part.column("text").to_pylist()
                n = [sum(map(merged.__getitem__, t.split(x))) for x in text]
                merged.trim()
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array([len(x) if x.isascii() else len(x.encode()) for x in text], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return common.texts(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


_counters: dict[str, tokens.Memory] = {}


def counters(t: tokens.Pieces, whole: list[str], path: str) -> tokens.Memory:
    """Tokens of a pre-token: 1 with a proof, else merged by the library and remembered; one memory for each worker."""
    if path not in _counters:
        _counters[path] = tokens.Memory(lambda p: len(t.ids(p)) >> 2 if t.kind != "byte" or p in t.special else len(t.pre_token(p)), fixed=dict.fromkeys(whole, 1))
    tokens.forget(_counters[path])
    return _counters[path]
