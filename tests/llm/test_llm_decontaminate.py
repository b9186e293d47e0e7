import random

import pytest
from llm_texts import rows_of, words

from loglens.llm import decontaminate as D


@pytest.fixture()
def case(spark, docs):
    rng = random.Random(2)
    items = [" ".join(words(rng, rng.randint(8, 60))) for _ in range(15)] + ["too few words here", "", None, " ".join(words(rng, 5))]

    def leak(text, edits):
        w = text.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = "edited"
        return " ".join(words(rng, rng.randint(0, 80)) + w + words(rng, rng.randint(0, 80)))

    texts = [None, "", "too few words here", items[0], items[18], items[3].upper(), ", ".join(items[4].split()) + "!"]
    texts += [leak(rng.choice(items[:15]), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(60)]
    texts += [" ".join(words(rng, 200)) for _ in range(30)] + [" ".join([items[1], *words(rng, 4000), items[2]])]
    marked = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(0, items[0], "y")], "item_id long, text string, n string")
    return docs(rows_of(texts)), marked, items


def test_query_equals_its_sql(case, table_dir, twin):
    docs, benchmark, _ = case
    ours, theirs = twin(D, "op5_decontamination", table_dir(documents=docs, benchmark=benchmark))
    assert ours == theirs and len(ours) > 30


def test_whole_passages_are_found_and_clean_documents_left(case):
    docs, benchmark, items = case
    found = {(r.doc_id, r.item_id): r.similarity for r in D.find_leaks(docs, benchmark).collect()}
    for r in docs.collect():
        for i, t in enumerate(items[:15]):
            if t in (r.text or ""):
                assert found[r.doc_id, i] == 1.0
    kept = {r.doc_id for r in D.clean_documents(docs, benchmark).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in found}
    assert {0, 1, 2} <= kept


def test_index_holds_every_byte_within_the_block_radius():
    want = {m for m in range(256) if bin(m).count("1") <= D.BLOCK_RADIUS}
    assert set(D._MASKS) == want
    assert D.RADIUS < 8 * (D.BLOCK_RADIUS + 1)


def test_simhash_is_the_majority_of_bits(spark):
    rng = random.Random(4)
    hashes = [rng.getrandbits(63) - (rng.random() < 0.5) * 2**63 for _ in range(7)]
    got = spark.createDataFrame([(hashes,)], "hs array<long>").select(D.simhash("hs").alias("f")).first().f
    want = sum(1 << b for b in range(64) if sum(1 if h >> b & 1 else -1 for h in hashes) > 0)
    assert got % 2**64 == want


def test_empty_tables_null_and_repeated_ids(spark, docs, case):
    some, benchmark, items = case
    none = spark.createDataFrame([], benchmark.schema)
    assert D.find_leaks(some, none).collect() == [] == D.find_leaks(docs([]), benchmark).collect()
    assert D.clean_documents(some, none).count() == some.count()
    df = spark.createDataFrame([(None, items[0], 1), (4, items[0], 2), (4, items[0], 2)], "doc_id long, text string, start int")
    got = sorted((str(r.doc_id), r.item_id) for r in D.find_leaks(df, benchmark).collect())
    assert got == [("4", 0), ("None", 0)]
    assert D.clean_documents(df, benchmark).collect() == []
    mixed = spark.createDataFrame([(None, items[0]), (None, "another text"), (None, None), (4, items[0]), (4, "another text")], "doc_id long, text string")
    left = sorted((str(r.doc_id), str(r.text)) for r in D.clean_documents(mixed, benchmark).collect())
    assert left == [("4", "another text"), ("None", "None"), ("None", "another text")]


def test_thresholds_that_the_radius_does_not_cover_are_refused(case):
    docs, benchmark, _ = case
    with pytest.raises(ValueError, match="radius"):
        D.find_leaks(docs, benchmark, threshold=0.6)


def test_plan_is_native(case):
    docs, benchmark, _ = case
    plan = D.find_leaks(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
