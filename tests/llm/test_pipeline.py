import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import difference, duck
from regforge.llm.common import staged
from regforge.llm.oracle import ORACLE_SQL
from regforge.llm.queries import QUERIES

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, TINY), duck(TINY), ORACLE_SQL[name]) is None


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages(spark):
    """Each stage against what the operators say about its own input."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = staged(stage(spark, docs, TINY), "test-stage")
        assert out.columns == docs.columns, name
        before, after = {r["doc_id"] for r in docs.collect()}, [r["doc_id"] for r in out.collect()]
        assert after and set(after) <= before
        if name != "mixing":
            assert len(after) == len(set(after))
        if name == "near_dedup":
            from test_near_dedup import brute_force

            want = {i for i, _, root, kept in brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], 80) if kept}
            assert set(after) == want
        docs = out
    final = corpus_pipeline.STAGES[4][1](spark, docs, TINY)
    assert final.count() == docs.count() and final.select("shard").distinct().count() == 16


def test_repeated_and_null_ids_leave_one_row(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "other text that stands here alone"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' as source", "1 as __n")
    out = corpus_pipeline.one_of_each_group(spark, docs, TINY)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "3", "4", "None"] and out.columns == docs.columns


def test_different_texts_under_null_or_repeated_ids_stay(spark):
    texts = [f"the {w} text number {i} stands alone and says {w} twice" for i, w in enumerate("red blue green black white brown".split())]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[4]), (None, texts[2]), (None, texts[3]), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' as source", "1 as __n")
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, TINY).collect()]
    assert sorted(out, key=str) == sorted([(1, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[3]), (None, texts[4]), (None, None), (None, "")], key=str)
    passage = spark.read.parquet(f"{TINY}/benchmark.parquet").filter("text is not null").first()["text"]
    some = spark.createDataFrame([(None, passage), (None, texts[0]), (1, passage), (1, texts[1])], "doc_id long, text string")
    assert {r["text"] for r in corpus_pipeline.drop_contaminated(spark, some, TINY).collect()} == {texts[0], texts[1]}
