"""Repairs against all edit sequences, against a DP over whole strings, and against SQL."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from oracle_check import difference, duck

from regforge.llm import conversation_repair as R
from regforge.llm.oracle import ORACLE_SQL
from regforge.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, audit string, kind string"
PATTERN = re.compile("(s?(ua)+)?")


def exhaustive(turns, inserts=3):
    """The best (cost, audit) over every choice per turn and every place of up to ``inserts`` insertions."""
    best = None
    n = len(turns)
    for choice in itertools.product("KRD", repeat=n):
        if any(unusable and c != "D" for c, (_, unusable, _) in zip(choice, turns, strict=True)):
            continue
        for places in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(n + 1), k) for k in range(inserts + 1)):
            cost, audit, options = 0, "", [""]
            for i in range(n + 1):
                for _ in range(places.count(i)):
                    cost, audit = cost + 3, audit + "I"
                    options = [o + r for o in options for r in "ua"]
                if i < n:
                    initial, _, cut = turns[i]
                    audit += choice[i]
                    cost += {"K": 0, "R": 3, "D": 4}[choice[i]] + (3 if cut and choice[i] != "D" else 0)
                    if choice[i] != "D":
                        options = [o + r for o in options for r in (initial if choice[i] == "K" else "ua")]
            if any(PATTERN.fullmatch(o) for o in options) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def by_strings(turns):
    """The same DP with whole audit strings."""
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    given = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(found):
        for _ in range(3):
            for q, (cost, audit) in list(found.items()):
                new = cost + 3, audit + "I"
                found[given[q]] = min(found.get(given[q], new), new)
        return found

    states = inserted({0: (0, "")})
    for initial, unusable, cut in turns:
        after = {}

        def put(q, cost, audit, after=after):
            after[q] = min(after.get(q, (cost, audit)), (cost, audit))

        for q, (cost, audit) in states.items():
            put(q, cost + 4, audit + "D")
            if not unusable:
                if initial in moves[q]:
                    put(moves[q][initial], cost + 3 * cut, audit + "K")
                put(given[q], cost + 3 + 3 * cut, audit + "R")
        states = inserted(after)
    return min(states[q] for q in (0, 3) if q in states)


def audited(turns):
    found, text = R.Audit(), ""
    for turn in turns:
        found.turn(*turn)
        text += found.settled()
    cost, rest = found.finish()
    return cost, text + rest


def some(rng, n):
    return [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


def test_all_edit_sequences():
    rng = random.Random(1)
    for _ in range(60):
        turns = some(rng, rng.randrange(5))
        assert audited(turns) == exhaustive(turns)


@pytest.mark.parametrize("commit", [1, 4, 256])
def test_long_conversations(monkeypatch, commit):
    monkeypatch.setattr(R, "COMMIT", commit)
    rng = random.Random(commit)
    for n in [*range(30), 200, 700]:
        turns = some(rng, n)
        assert audited(turns) == by_strings(turns)
        same = [(rng.choice("suax"), False, False)] * n
        assert audited(same) == by_strings(same)


def test_hash_collisions_are_found(monkeypatch):
    """With hashes modulo 3 nearly all prefixes collide, and the audits stay right."""
    monkeypatch.setattr(R, "_PRIME", 3)
    rng = random.Random(8)
    for n in (1, 5, 20, 60):
        for _ in range(10):
            turns = some(rng, n)
            assert audited(turns) == by_strings(turns)


def test_open_turns_stay_few():
    rng = random.Random(2)
    conversation = R.Conversation(1, None)
    most = 0
    for i in range(20_000):
        conversation.add(i, rng.choice(["user", "assistant", "system"]), "x." * rng.randrange(2), rng.random() < 0.1)
        most = max(most, len(conversation.open))
    assert most < 4 * R.COMMIT and len(conversation.audit.prefixes.code) < 40 * R.COMMIT


def expected(rows):
    """The query's rows from the definition."""
    blanks = " \t\n\x0b\x0c\r"
    conversations = {}
    for conv, turn, role, text in rows:
        held = conversations.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, held in conversations.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        numbers = {t for t, _, _ in held if t is not None}
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, role, text in held:
            body = text.rstrip(blanks)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            turns.append((role[:1], fault < 2, fault == 2))
        cost, audit = by_strings(turns)
        repaired, rest, state = [], list(held), 0
        for code in audit:
            _, role, text = rest.pop(0) if code != "I" else (None, "", "")
            if code == "D":
                continue
            state = {0: {"s": 1}.get(role[:1], 2), 1: 2, 2: 3, 3: 2}[state] if code == "K" else {2: 3}.get(state, 2)
            repaired.append(f"{role if code == 'K' else {2: 'user', 3: 'assistant'}[state]}:{text}")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(held))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def cases():
    rng = random.Random(4)
    texts = ["Yes.", "yes. \n", "no", "", " \t", None, "What?", "Ä!", "x" * 50_000]
    rows = []
    for conv in [*range(80), None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "system", "", None, "Ünder", "a"]), rng.choice(texts)))
    rows += [(7, 3, "user", "Again.")] * 5 + [(200, 2**63 - 1, "user", "End."), (200, -(2**63), "user", "Start.")]
    rows += [(300, i % 900, "user" if i % 2 else "assistant", f"t{i % 500}.") for i in range(3000)]  # one conversation holds most rows
    return rows


def test_equals_the_definition(spark):
    rows = cases()
    frame = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    want = expected(rows)
    want[200] = ((1 << 63) - 1, *want[200][1:])
    got = R.repair_damaged(frame.repartition(3)).collect()
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want


def test_repaired_turns_are_what_was_hashed(spark):
    frame = spark.createDataFrame([(*r, None, None) for r in cases()], SCHEMA)
    hurt = R.damaged(frame)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in R.audits(hurt).collect()}
    texts = {}
    for r in sorted(R.repaired_turns(hurt).collect(), key=lambda r: r["place"]):
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["edit"] in "KRI"
    assert {c: hashlib.sha256("\n".join(texts.get(c, [])).encode()).hexdigest() for c in digests} == digests


def test_empty_table(spark):
    assert R.repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op12_conversation_repair"](spark, folder), duck(folder), ORACLE_SQL["op12_conversation_repair"]) is None
