import numpy as np

from regforge.llm import transcripts as tr
from regforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def model(seed=3):
    rng = np.random.default_rng(seed)
    scaled = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return tr.MarkovModel(scaled(rng.random(tr.STATES)), scaled(rng.random((tr.STATES, tr.STATES))), scaled(rng.random((tr.STATES, tr.SYMBOLS))))


def test_blocks_give_the_path_of_one_pass():
    m, rng = model(), np.random.default_rng(9)
    symbols = rng.integers(0, tr.SYMBOLS, 200)
    whole = tr.decode(m, symbols)
    import pandas as pd

    parts = np.array_split(symbols, 7)
    ends = tr._ends(pd.DataFrame({"conv_id": 1, "block": range(7), "matrix": [tr.block_matrix(m, p).reshape(-1).tolist() for p in parts]}))
    path = np.concatenate([tr.decode(m, p, b, e) for p, b, e in zip(parts, ends["before"], ends["last"], strict=True)])
    assert (path == whole).all()


def test_roles_are_recovered(spark):
    turns = {(r["conv_id"], r["turn"]): r["role"] for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()}
    out = QUERIES["op10_transcript_parsing"](spark, SMALL).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["conv_id"], r["position"])):
        found.setdefault((r["conv_id"], r["turn"]), r["role"])
    assert sum(found.get(k) == role for k, role in turns.items()) >= 0.95 * len(turns)
    assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") and r["rendered"].endswith("\n<|end|>") for r in out)


def test_roles_of_held_out_transcripts_are_recovered(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    held = {(r["conv_id"], r["turn"]): r["role"] for r in turns.filter(tr.held_out()).collect()}
    assert len(held) > 100 and turns.filter(~tr.held_out()).count() > 2 * len(held)
    found = {}
    for r in sorted(tr.parse_conversations(turns).filter(tr.held_out()).collect(), key=lambda r: (r["conv_id"], r["position"])):
        found.setdefault((r["conv_id"], r["turn"]), r["role"])
    assert sum(found.get(k) == role for k, role in held.items()) >= 0.95 * len(held)


def test_counts_of_the_model(spark):
    """The counted model against a plain walk over the states of a few transcripts."""
    rows = [(c, t, tr.ROLES[(c + t) % 3], "\n".join(f"line {k}" for k in range(1 + (c * t) % 4))) for c in range(5) for t in range(6)]
    lines = tr.transcript_lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    emit, step, start = np.full((tr.STATES, tr.SYMBOLS), 0.1), np.full((tr.STATES, tr.STATES), 0.05), np.full(tr.STATES, 0.05)
    told = lines.select("conv_id", "turn", "line_no", "role", tr.symbol(tr.F.col("line")).alias("s")).collect()
    before = {}
    for r in sorted(told, key=lambda r: (r["conv_id"], r["turn"], r["line_no"])):
        state = tr.ROLES.index(r["role"]) + (0 if r["line_no"] == 0 else 3)
        emit[state, r["s"]] += 1
        if r["conv_id"] in before:
            step[before[r["conv_id"]], state] += 1
        else:
            start[state] += 1
        before[r["conv_id"]] = state
    have = tr.train(lines)
    for x, y in ((have.start, start), (have.step, step), (have.emit, emit)):
        assert np.allclose(x, np.log(y / y.sum(-1, keepdims=True)))


def test_blocks_bound_lines_and_not_places(spark, monkeypatch):
    monkeypatch.setattr(tr, "BLOCK", 8)
    rows = [(1, None, "user", f"line {i}") for i in range(100)] + [(1, None, "user", "same")] * 60 + [(2, 5, "user", "\n".join(f"l{i}" for i in range(90)))]
    lines = tr.transcript_lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    blocks = tr._in_blocks(lines).groupBy("conv_id", "block").count().collect()
    assert max(r["count"] for r in blocks) <= 8 and sum(r["count"] for r in blocks) == lines.count()
    m = tr.train(lines)
    out = tr.parse(lines, m).collect()
    assert sum(r["n_lines"] for r in out) == lines.count()
    for conv in (1, 2):
        places = sorted(r["position"] for r in out if r["conv_id"] == conv)
        assert places == list(range(len(places)))
    monkeypatch.setattr(tr, "BLOCK", 100_000)
    whole = sorted((r["conv_id"], r["position"], r["role"]) for r in tr.parse(lines, m).collect())
    assert whole == sorted((r["conv_id"], i, r["role"]) for c in (1, 2) for i, r in enumerate(x for x in sorted(out, key=lambda r: r["position"]) if x["conv_id"] == c and not x["continued"]))


def test_long_transcripts_lose_no_line(spark, monkeypatch):
    rows = [(1, i, ("user", "assistant")[i % 2], f"line {i}\nmore of {i}?") for i in range(60)] + [(2, 0, "user", "hello")]
    lines = tr.transcript_lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    m = tr.train(lines)
    key = lambda r: (r["conv_id"], r["position"])
    whole = sorted(tr.parse(lines, m).collect(), key=key)
    monkeypatch.setattr(tr, "BLOCK", 8)
    parts = sorted(tr.parse(lines, m).collect(), key=key)
    assert sum(r["n_lines"] for r in parts) == sum(r["n_lines"] for r in whole) == lines.count()
    assert [r["position"] for r in parts if r["conv_id"] == 1] == list(range(sum(r["conv_id"] == 1 for r in parts)))
    assert [(r["role"], r["turn"]) for r in parts if not r["continued"]] == [(r["role"], r["turn"]) for r in whole]


def test_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (None, 0, "user", "a"), (None, None, None, "b"), (2, 0, "odd role", "c\n\nd"), (2, 1, "user", "x"), (2, 1, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as line", "2 as block")
    out = tr.parse_conversations(frame).collect()
    assert sum(r["n_lines"] for r in out) == tr.transcript_lines(frame).count() and {r["conv_id"] for r in out} == {1, 2, None}
    assert tr.parse_conversations(frame.limit(0)).count() == 0
