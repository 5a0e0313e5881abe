"""Conversation structure repair by the Viterbi algorithm with coalescing survivors.

A conversation is edited row by row into one whose roles read `(s?(ua)+)?`: a system
row may come first, then user and assistant rows alternate and end with an assistant.
The states are what the repaired rows so far end with: nothing, system, user, assistant.
For every state one survivor is kept, the cheapest edits that lead to it and, among
those, the first in ASCII order. Two survivors of a state that cost the same can not be
one the beginning of the other, as the rest would be inserts that lead back to the
state and cost something; so the order between them is final.

Survivors are leaves of a tree of edits with pointers to the edit before. A node knows
its children; one that is neither a survivor nor has any is freed, with all above it
that it alone held. As soon as all survivors share an ancestor, the edits down to it are
settled: they are given out and forgotten. Ties are broken by the edits below the last
common ancestor of the two survivors, all of which are still there. What is held is what
is not settled yet, whatever the length of the conversation.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from ..operators.lineage import written_once
from . import common, tokens

BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant row where one is due, and that row's role.
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: The state after a row that is kept, by its role's initial.
KEEP = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What a survivor in the first state costs more, at most, than one in the second from there on: by inserts, or by deleting a system row.
MORE = {
    (START, SYSTEM): 0, (START, ASSISTANT): 0, (START, USER): INSERT,
    (SYSTEM, START): 2 * INSERT, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT,
    (USER, START): INSERT + DELETE, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT,
    (ASSISTANT, START): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT,
}


class Node:
    """An edit: its initial, the repaired row (None for a deleted one), and its place in the tree."""

    __slots__ = ("parent", "edit", "role", "text", "depth", "children", "alive")

    def __init__(self, parent, edit, role=None, text=None):
        self.parent, self.edit, self.role, self.text = parent, edit, role, text
        self.depth, self.children, self.alive = parent.depth + 1 if parent else 0, [], False


def before(a: Node, x: str, b: Node, y: str) -> bool:
    """Whether the edits of a and then x come before those of b and then y; compared below their last common ancestor."""
    left, right = [x], [y]
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Repair:
    """The cheapest edits of one conversation, row after row; settled edits go to `out`, a function of (edit, role, text)."""

    def __init__(self, out):
        self.out, self.root, self.most = out, Node(None, ""), 0
        self.survivors = self._with_inserts({START: (0, self.root)})
        for _, leaf in self.survivors.values():
            leaf.alive = True

    def _with_inserts(self, best: dict) -> dict:
        # at most two inserts in a row: no state is further from another
        for state in (START, SYSTEM, ASSISTANT, USER):
            if state in best:
                cost, leaf = best[state]
                to, role = NEXT[state]
                there = best.get(to)
                if there is None or cost + INSERT < there[0] or cost + INSERT == there[0] and self._first(leaf, "I", there[1]):
                    if there is not None:
                        self._free(there[1])
                    node = Node(leaf, "I", role, "")
                    leaf.children.append(node)
                    best[to] = (cost + INSERT, node)
        return best

    @staticmethod
    def _first(leaf: Node, edit: str, other: Node) -> bool:
        return before(leaf, edit, other.parent, other.edit)

    def _free(self, node: Node) -> None:
        while node is not self.root and not node.children and not node.alive:
            node.parent.children.remove(node)
            node = node.parent

    def row(self, role: str, text: str, gone: bool, truncated: bool) -> None:
        """The next row; gone: it has to be deleted."""
        more = TRUNCATED if truncated else 0
        found: dict[int, tuple] = {}

        def offer(to, cost, leaf, edit, as_role):
            there = found.get(to)
            if there is None or cost < there[0] or cost == there[0] and before(leaf, edit, there[1], there[2]):
                found[to] = (cost, leaf, edit, as_role)

        for state, (cost, leaf) in self.survivors.items():
            offer(state, cost + DELETE, leaf, "D", None)
            if not gone:
                kept = KEEP[state].get(role[:1])
                if kept is not None:
                    offer(kept, cost + more, leaf, "K", role)
                to, as_role = NEXT[state]
                offer(to, cost + REROLE + more, leaf, "R", as_role)
        old = [leaf for _, leaf in self.survivors.values()]
        best = {}
        for state, (cost, leaf, edit, as_role) in found.items():
            node = Node(leaf, edit, as_role, None if edit == "D" else text)
            leaf.children.append(node)
            best[state] = (cost, node)
        best = self._with_inserts(best)
        self.survivors = {s: v for s, v in best.items() if not any(c + MORE[q, s] < v[0] for q, (c, _) in best.items() if q != s)}
        for _, leaf in self.survivors.values():
            leaf.alive = True
        for leaf in old:
            leaf.alive = False
            self._free(leaf)
        for s, (_, leaf) in best.items():
            if s not in self.survivors:
                self._free(leaf)
        self._settle()

    def _settle(self) -> None:
        while not self.root.alive and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            self.out(self.root.edit, self.root.role, self.root.text)
        self.most = max(self.most, max(leaf.depth for _, leaf in self.survivors.values()) - self.root.depth)

    def end(self) -> int:
        """The cost, after the rest of the edits is given out."""
        ends = [self.survivors[s] for s in (START, ASSISTANT) if s in self.survivors]
        cost, leaf = ends[0]
        for c, other in ends[1:]:
            if c < cost or c == cost and before(other, "", leaf, ""):
                cost, leaf = c, other
        path = []
        while leaf is not self.root:
            path.append(leaf)
            leaf = leaf.parent
        for node in reversed(path):
            self.out(node.edit, node.role, node.text)
        return cost


class Conversation:
    """Faults, cost and digest of one conversation; rows come in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None
        self.audit, self.digest, self.empty = bytearray(), hashlib.sha256(), True
        self.repair = Repair(self._out)

    def _out(self, edit, role, text):
        self.audit += edit.encode()
        if edit != "D":
            self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self, turn, role: str, text: str, earlier: bool) -> None:
        """earlier: the same role and text at an earlier turn; the same within a turn come next to each other."""
        said = text.rstrip(BLANKS)
        blank, truncated = not said, said[-1:] not in (".", "!", "?")
        duplicate = not blank and (earlier or self.last == (turn, role, text))
        truncated = truncated and not blank and not duplicate
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += self.high != turn
            self.high = turn
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last is not None:
            self.illegal += self.last[1][:1] + role[:1] not in ("su", "ua", "au")
        self.last = (turn, role, text)
        self.repair.row(role, text, blank or duplicate, truncated)

    def end(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost = self.repair.end()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.audit.decode(), self.digest.hexdigest()


def damaged(talk: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text, gone), the conversations with the faults of the test.

    Null roles and texts are one space, as are nulls in the hashed key. By
    crc32("conv_id:turn") % 20 a row is dropped (0, kept here with gone = true), emptied (1), loses
    its `[.!?]` (2), is repeated (3) or gets the role user (4).
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = talk.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"), (F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col))) % 20).alias("_d"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_d") == 0).alias("gone"), F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")


def repaired(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one for each conversation of rows (conv_id, turn, role, text, gone).

    Order is by turn, nulls first; rows of one turn by role and text. Rows with gone =
    true only stand for their conversation. A row's first fault counts: blank, a
    duplicate of an earlier role and text, truncated. gaps are missing turn numbers;
    illegal counts neighbours whose initials are none of su, ua, au; cost and audit are
    the cheapest edits (Keep 0, Rerole 3, Delete 4, Insert 3, and 3 for a truncated row that
    stays; blank rows and duplicates must go), ties to the first audit in ASCII
    order. repaired_sha256 is the hash of the repaired `role:text` lines. Without rows
    all numbers are 0, the audit is empty and the hash that of an empty text. A null
    conv_id is a conversation of its own; roles and texts must not be null (`damaged` sees to it).

    A conversation is read in order by one task, as its hash has to be, from a sorted
    partition and without being held; duplicates are found by an aggregate beforehand.
    """
    common.ship(rows.sparkSession)
    rows = written_once(rows)
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    same = rows.where("NOT gone").select("conv_id", "role", F.md5("text").alias("h"), at.alias("at")).groupBy("conv_id", "role", "h")
    same = same.agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last")
    same = same.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("h").alias("_h"), "first")
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.md5("text") == F.col("_h"))
    marked = rows.join(same, on, "left").select("conv_id", "turn", "role", "text", "gone", F.coalesce(F.col("first") < at, F.lit(False)).alias("earlier"))
    kind = rows.schema["conv_id"].dataType
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def repair(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        tokens.forget()
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        kinds = [to_arrow_type(kind), *[pa.int64()] * 6, pa.string(), pa.string()]
        now, talk, done, held = None, None, [], 0

        def batch():
            return pa.record_batch([pa.array([x[i] for x in done], k) for i, k in enumerate(kinds)], names=names)

        for part in batches:
            for a, b in common.slices(part.column("text")):
                for conv, turn, role, text, gone, earlier in zip(*(c.to_pylist() for c in part.slice(a, b - a).columns)):
                    if talk is None or conv != now:
                        if talk is not None:
                            done.append((now, *talk.end()))
                            held += len(done[-1][7])
                            if len(done) >= 4096 or held > common.SLICE_BYTES:
                                yield batch()
                                done, held = [], 0
                        now, talk = conv, Conversation()
                    if not gone:
                        talk.row(turn, role, text, earlier)
        if talk is not None:
            done.append((now, *talk.end()))
            yield batch()

    out = f"conv_id {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return ordered.mapInArrow(repair, out)


def repair_report(talk: DataFrame) -> DataFrame:
    """The report of `repaired` on the damaged rows of a table (conv_id, turn, role, text), one row for every conv_id it has."""
    return repaired(damaged(talk))


def repair_report_sql() -> str:
    """repair_report for the table conversations, for DuckDB. A survivor is its cost in 12 digits and its edits, so the least of some is the best."""
    crc = "list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(key, ''), lambda c: [CAST(unicode(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"

    def then(survivor, cost, edit):
        return f"(CASE WHEN {survivor} IS NULL THEN NULL ELSE lpad(CAST(CAST(left({survivor}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({survivor}, 13) || '{edit}' END)"

    keep = lambda state, initial: f"(CASE WHEN NOT must AND r = '{initial}' THEN {then(state, 'more', 'K')} END)"
    rerole = lambda state: f"(CASE WHEN NOT must THEN {then(state, '3 + more', 'R')} END)"
    least = lambda *x: f"list_min(list_filter([{', '.join(x)}], lambda y: y IS NOT NULL))"
    user = [f(s) for s in ("st", "sy", "ai") for f in (lambda s: keep(s, "u"), rerole)]
    return f"""
WITH RECURSIVE q AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
g AS (SELECT *, xor({crc}, 4294967295) % 20 AS d FROM q),
m AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM g WHERE d <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM m),
e AS (SELECT *, said = '' AS blank, said <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM o),
f AS (SELECT *, blank OR dup AS must, NOT blank AND NOT dup AND right(said, 1) NOT IN ('.', '!', '?') AS trunc, CASE WHEN right(said, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS more FROM e),
dp AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000000000' AS st, CAST(NULL AS VARCHAR) AS sy, '000000000003I' AS us, '000000000006II' AS ai FROM f
    UNION ALL SELECT conv_id, i, st, sy, us, {least('ai', then('us', 3, 'I'))} FROM (
        SELECT conv_id, i, st, sy, {least('us', then('st', 3, 'I'), then('sy', 3, 'I'), then('ai', 3, 'I'))} AS us, ai FROM (
            SELECT f.conv_id, f.i, {then('st', 4, 'D')} AS st, {least(then('sy', 4, 'D'), keep('st', 's'))} AS sy, {least(then('us', 4, 'D'), *user)} AS us, {least(then('ai', 4, 'D'), keep('us', 'a'), rerole('us'))} AS ai
            FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1))),
c AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS dup, count(*) FILTER (trunc) AS trunc, count(*) FILTER (p IS NOT NULL AND p || r NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
b AS (SELECT c.*, {least('st', 'ai')} AS best FROM c JOIN dp ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.n = dp.i),
u AS (SELECT conv_id, unnest(string_split(substr(best, 13), '')) AS edit, unnest(range(1, length(best) - 11)) AS j FROM b),
v AS (SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER w AS k FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
x AS (SELECT v.*, f.role, f.text, max(CASE WHEN k = 1 AND edit = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY v.conv_id) AS sys FROM v LEFT JOIN f ON edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i),
y AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (k - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS repaired FROM x WHERE edit <> 'D' GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(dup, 0) AS BIGINT) AS duplicate, CAST(coalesce(trunc, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
    coalesce(CAST(left(best, 12) AS BIGINT), 0) AS cost, coalesce(substr(best, 13), '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN b ON a.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN y ON a.conv_id IS NOT DISTINCT FROM y.conv_id"""
