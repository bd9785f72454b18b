"""Conversation structure repair: the cheapest edits that make the roles of a conversation
alternate, as an audit string, with the repaired turns and counts of what was wrong.

Faults of a turn, the first of these: blank (no character but blanks), duplicate (role and
text stood earlier in the conversation), truncated (the last such character is none of
``.!?``). Edits: K keeps a turn (0), R gives it the role user or assistant (3), D deletes it
(4, the only choice for blank and duplicate turns), I inserts an empty user or assistant turn
(3); a truncated turn that stays costs 3 more. The initials of the roles have to read
``(s?(ua)+)?``. Of the cheapest audits the first in ASCII order wins.

The search is a DP over turns and the four states of that pattern. An audit prefix is a node
that points at the node before it, so the states share what they have in common. Ties are
broken by the longest common prefix: nodes know their ancestors at distances 1, 2, 4, ...
and a rolling hash of their prefix; prefixes of equal hash are compared character by
character once and remembered as equal. In one state, after the same turns and for the same
cost, no audit is a prefix of another (it would differ in paid insertions only), so the
smaller of two prefixes stays the smaller one whatever follows.

States too dear to matter are left out. Where the others agree on a prefix it is final: its turns are hashed (or returned) and
forgotten. A conversation is read as a stream in the order of its turns, so a very long one
costs memory only for the turns whose edits are still open, and its audit, which is one
value of one row. Its turns do pass through one task, since the digest of its repaired text
is one chain. Which turn came first with a role and text is found by an aggregate over
digests, merged into the stream as marker rows: no join, and texts are shuffled once.

Turns are ordered by ``turn`` (NULL first), equal ones by the digest of role and text; a NULL
role or text is one blank. A NULL conversation id is a conversation of its own. Empty tables
give an empty result; other columns are ignored. Gaps beyond a long are the largest long.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regforge.llm.common import small_batches, staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn of that initial leads; a given or inserted role leads on from every state.
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_PRIME, _BASE = (1 << 61) - 1, 911382323
#: A state this much dearer than another is never part of a cheapest audit: two insertions
#: lead from any state to ASSISTANT, which can follow every other state for at most 4 more.
HOPELESS = 2 * INSERT + DELETE
COMMIT = 256
BATCH_ROWS = 512


class Prefixes:
    """Audit prefixes as linked nodes; node 0 is the empty one."""

    def __init__(self):
        self.code, self.hash, self.depth, self.up, self._same = [""], [1], [0], [[]], [0]

    def add(self, parent: int, code: str) -> int:
        node, up = len(self.code), [parent]
        while len(self.up[up[-1]]) >= len(up):
            up.append(self.up[up[-1]][len(up) - 1])
        self.code.append(code)
        self.hash.append((self.hash[parent] * _BASE + ord(code)) % _PRIME)
        self.depth.append(self.depth[parent] + 1)
        self.up.append(up)
        self._same.append(node)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.up[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def spelled(self, node: int, after: int = 0) -> str:
        """The codes from below ``after``, an ancestor, to ``node``."""
        out = []
        while node != after:
            out.append(self.code[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _first(self, node: int) -> int:
        while self._same[node] != node:
            self._same[node] = node = self._same[self._same[node]]
        return node

    def equal(self, a: int, b: int) -> bool:
        """Whether two prefixes of one length read the same; equal hashes are verified."""
        met = []
        while (a := self._first(a)) != (b := self._first(b)):
            if self.hash[a] != self.hash[b] or self.code[a] != self.code[b]:
                return False
            met.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        for a, b in met:
            self._same[self._first(a)] = self._first(b)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the prefix ``a`` comes before ``b`` in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.equal(x, y):
            return self.depth[a] < self.depth[b]
        if self.hash[x] != self.hash[y]:
            # Climb while the prefixes differ: afterwards the parents agree.
            for k in reversed(range(len(self.up[x]))):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            if self.equal(self.up[x][0], self.up[y][0]):
                return self.code[x] < self.code[y]
        return self.spelled(a) < self.spelled(b)  # two prefixes share a hash


class Audit:
    """The search over one conversation, turn after turn."""

    def __init__(self):
        self.prefixes = Prefixes()
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self._insert([(0, 0, ""), None, None, None])
        self.since, self.every = 0, COMMIT

    def _better(self, old: tuple[int, int, str] | None, new: tuple[int, int, str]) -> tuple[int, int, str]:
        """The better of two candidates (cost, prefix, code); no code: the prefix itself."""
        if old is None or new[0] != old[0]:
            return new if old is None or new[0] < old[0] else old
        if new[1] == old[1]:
            return new if new[2] < old[2] else old
        old, new = ((c, self.prefixes.add(n, code) if code else n, "") for c, n, code in (old, new))
        return new if self.prefixes.less(new[1], old[1]) else old

    def _insert(self, found: list[tuple[int, int, str] | None]) -> None:
        """Takes the candidates after a turn, and one or two inserted turns after them."""

        def made(state: int) -> tuple[int, int] | None:
            if (c := found[state]) and c[2]:
                found[state] = c = (c[0], self.prefixes.add(c[1], c[2]), "")
            return c and (c[0], c[1])

        best = [made(state) for state in range(4)]
        for state in (START, SYSTEM, ASSISTANT):
            if best[state]:
                found[USER] = self._better(found[USER], (best[state][0] + INSERT, best[state][1], "I"))
        best[USER] = made(USER)
        found[ASSISTANT] = self._better(found[ASSISTANT], (best[USER][0] + INSERT, best[USER][1], "I")) if best[USER] else found[ASSISTANT]
        best[ASSISTANT] = made(ASSISTANT)
        least = min(known[0] for known in best if known)
        self.best = [known if known and known[0] <= least + HOPELESS else None for known in best]

    def turn(self, initial: str, unusable: bool, truncated: bool) -> None:
        found: list[tuple[int, int, str] | None] = [None] * 4
        extra = TRUNCATED if truncated else 0
        for state, known in enumerate(self.best):
            if known is None:
                continue
            cost, node = known
            found[state] = self._better(found[state], (cost + DELETE, node, "D"))
            if unusable:
                continue
            if (to := _KEPT[state].get(initial)) is not None:
                found[to] = self._better(found[to], (cost + KEEP + extra, node, "K"))
            to = _NEXT[state]
            found[to] = self._better(found[to], (cost + REROLE + extra, node, "R"))
        self._insert(found)
        self.since += 1

    def settled(self) -> str:
        """What all states agree on since the last call, from time to time."""
        if self.since < self.every:
            return ""
        nodes = {known[1] for known in self.best if known}
        depth = min(self.prefixes.depth[n] for n in nodes)
        met = {self.prefixes.ancestor(n, depth) for n in nodes}
        while len(met) > 1:
            met = {self.prefixes.up[n][0] for n in met}
        root = met.pop()
        out, old = self.prefixes.spelled(root), self.prefixes
        # Twice the wait where little was settled, so that the copying stays in proportion.
        self.every = COMMIT if len(out) * 2 >= self.since else self.every * 2
        self.prefixes, moved = Prefixes(), {root: 0}
        for state, known in enumerate(self.best):
            if known:
                path, node = [], known[1]
                while node not in moved:
                    path.append(node)
                    node = old.up[node][0]
                for node in reversed(path):
                    moved[node] = self.prefixes.add(moved[old.up[node][0]], old.code[node])
                self.best[state] = (known[0], moved[known[1]])
        self.since = max(self.prefixes.depth)
        return out

    def finish(self) -> tuple[int, str]:
        """Cost, and the rest of the audit."""
        whole = (*self.best[START], "") if self.best[START] else None
        if self.best[ASSISTANT]:
            whole = self._better(whole, (*self.best[ASSISTANT], ""))
        return whole[0], self.prefixes.spelled(whole[1])


class Conversation:
    """Counts, audit and digest of one conversation while its turns stream by."""

    def __init__(self, ident: object, keep: Callable[[tuple], None] | None):
        self.ident, self.keep, self.audit, self.spelled = ident, keep, Audit(), []
        self.open: deque[tuple[str, str]] = deque()
        self.state, self.place, self.digest = START, 0, hashlib.sha256()
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        body = text.rstrip(BLANKS)
        blank, cut = not body, False
        if blank:
            self.blank += 1
        elif repeated:
            self.duplicate += 1
        elif body[-1] not in ".!?":
            self.truncated += 1
            cut = True
        self.open.append((role, text))
        self.audit.turn(role[:1], blank or repeated, cut)
        self._apply(self.audit.settled())

    def _apply(self, codes: str) -> None:
        for code in codes:
            role, text = ("", "") if code == "I" else self.open.popleft()
            if code == "D":
                continue
            if code in "IR":
                self.state = _NEXT[self.state]
                role = _ROLE[self.state]
            else:
                self.state = _KEPT[self.state][role[:1]]
            self.digest.update((("\n" if self.place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            if self.keep:
                self.keep((self.ident, self.place, code, role, text))
            self.place += 1
        self.spelled.append(codes)

    def summary(self) -> tuple:
        cost, rest = self.audit.finish()
        self._apply(rest)
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, (1 << 63) - 1)
        return (self.ident, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.spelled), self.digest.hexdigest())


_PRESENT, _FIRST, _TURN = range(3)


def _stream(texts: bool, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: Conversation | None = None
        marker = None

        def block() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[] for _ in schema]
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            names = ("conv_id", "turn", "digest", "kind", "role", "text")
            for ident, turn, digest, kind, role, text in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if now is None or ident != now.ident:
                    if now is not None:
                        found = now.summary()
                        if not texts:
                            out.append(found)
                    now, marker = Conversation(ident, out.append if texts else None), None
                if kind == _FIRST:
                    marker = turn, digest
                elif kind == _TURN:
                    now.add(turn, role, text, marker != (turn, digest))
                    marker = None
            yield block()
        if now is not None:
            found = now.summary()
            if not texts:
                out.append(found)
        yield block()

    return read


def _read(turns: DataFrame, texts: bool) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), gone.alias("gone"))
    kept = rows.filter(~F.col("gone")).withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    none = F.lit(None).cast("string")
    early = kept.groupBy("conv_id", "digest").agg(F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("none"))
    firsts = early.select("conv_id", F.when(~F.col("none"), F.col("least")).alias("turn"), "digest", F.lit(_FIRST).alias("kind"), none.alias("role"), none.alias("text"))
    present = rows.select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(_PRESENT).alias("kind"), none.alias("role"), none.alias("text")
    )
    stream = kept.select("conv_id", "turn", "digest", F.lit(_TURN).alias("kind"), "role", "text").unionByName(firsts).unionByName(present)
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest", "kind")
    kind = turns.select("conv_id").schema[0].dataType.simpleString()
    ident = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    if texts:
        fields = [("conv_id", ident), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
        sql = f"conv_id {kind}, place long, edit string, role string, text string"
    else:
        fields = [("conv_id", ident), *((n, pa.int64()) for n in longs), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        sql = f"conv_id {kind}, {', '.join(f'{n} long' for n in longs)}, audit string, repaired_sha256 string"
    with small_batches(turns.sparkSession, BATCH_ROWS):
        return staged(stream.mapInArrow(_stream(texts, pa.schema(fields)), sql), "repaired")


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation: gaps in the turn numbers, turns per fault, illegal pairs of
    neighbours, cost, audit and the digest of the repaired turns. ``turns`` has conv_id (a
    number or text), turn, role and text; a row with a true column ``gone`` only says that
    its conversation exists. Staged."""
    return _read(turns, texts=False)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations, turn by turn: conv_id, place, edit, role, text. Staged."""
    return _read(turns, texts=True)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns damaged by a hash of conversation and turn: of twenty, one is dropped (kept as
    ``gone``), one emptied, one loses its full stops, one is repeated, one becomes user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20).cast("long"))
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    return audits(damaged(turns))
