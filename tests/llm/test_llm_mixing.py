import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from llm_texts import corpus

from loglens.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(seed=1, n=400):
    """Documents of seven sources, one of them hot, one of null, one without words, with repeats and null ids."""
    rng = random.Random(seed)
    texts = corpus(seed, 80)
    out = []
    for i in range(n):
        source = rng.choice(["big"] * 8 + ["a", "b", "é", "Z", None])
        out.append((i, rng.choice(texts), "en", source, 0))
    out += [(n, "", "en", "empty", 0), (n + 1, None, "en", "empty", 0), (None, "no id " * 9, "en", "a", 0), (None, "other " * 9, "en", "a", 0)]
    return out + [out[3]] * 5 + [(7, "same words again " * 4, "en", "rep", 0)] * 900


def brute_targets(sizes, weights, share, cap):
    """Targets by dealing the excess again and again, exactly."""
    part = {s: Fraction(0) for s in sizes}
    left, open_ = Fraction(*share) * sum(sizes.values()), set(sizes)
    while open_:
        w = sum(weights[s] for s in open_)
        give = {s: left * weights[s] / w for s in open_}
        over = {s for s in open_ if give[s] > cap * sizes[s]}
        if not over:
            part.update(give)
            break
        for s in over:
            part[s] = Fraction(cap * sizes[s])
        left -= sum(part[s] for s in over)
        open_ -= over
    return part


def ordered(sources):
    return sorted(sources, key=lambda s: (s is None, (s or "").encode()))


@pytest.mark.parametrize("seed", [1, 2])
def test_twin(spark, table_dir, twin, seed):
    folder = table_dir(documents=spark.createDataFrame(rows(seed), SCHEMA).repartition(5))
    ours, theirs = twin(M, "op11_source_mix", folder)
    assert ours == theirs and len(ours) == len(rows(seed))


def test_targets_equal_the_resharing_by_hand(spark):
    rng = random.Random(4)
    for case in range(6):
        names = [f"s{i}" for i in range(rng.randint(1, 9))] + [None] * (case % 2)
        sizes = {s: rng.choice([0, 1, 10, 1000, 10 ** 6, 3 * 10 ** 12]) for s in names}
        cycle, share, cap = (5, 2, 1), rng.choice([(3, 2), (1, 1), (5, 2)]), rng.choice([1, 2, 3])
        df = M.cyclic_weights(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), cycle)
        got = {r.source: r for r in M.targets(df, share, cap).collect()}
        weights = {s: cycle[i % 3] for i, s in enumerate(ordered(sizes))}
        assert {s: r.weight for s, r in got.items()} == weights
        want = brute_targets(sizes, weights, share, cap)
        for s in sizes:
            assert got[s].target == pytest.approx(float(want[s]), rel=1e-12), (case, s)
            assert got[s].rate <= cap


def test_many_sources_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    df = spark.createDataFrame(rows(3), SCHEMA)
    monkeypatch.setattr(M, "COPIES", 16)
    plan = M.mix_plan(df, (5, 2, 1), (3, 2), 2).collect()
    monkeypatch.undo()
    assert Counter(map(tuple, plan)) == Counter(map(tuple, M.mix_plan(df, (5, 2, 1), (3, 2), 2).collect()))


def test_taken_words_come_near_targets_and_reruns_agree(spark):
    df = spark.createDataFrame(rows(5, 3000), SCHEMA)
    plan = M.mix_plan(df, (5, 2, 1), (3, 2), 2).collect()
    again = M.mix_plan(df.repartition(11), (5, 2, 1), (3, 2), 2).collect()
    assert Counter(map(tuple, plan)) == Counter(map(tuple, again))
    assert all(r.times <= 2 for r in plan)
    by = {}
    for r in plan:
        by.setdefault(r.source, []).append(r)
    for source, members in by.items():
        f = members[0].rate % 1
        noise = math.sqrt(sum(r.size ** 2 for r in members) * f * (1 - f))
        taken = sum(r.size * r.times for r in members)
        assert abs(taken - members[0].target) <= 4.5 * noise + max(r.size for r in members), source
    # A group of 900 repeats is not taken all or nothing.
    reps = [r for r in by["rep"]]
    assert abs(sum(r.times for r in reps) - 900 * reps[0].rate) <= 1


def test_mixed_emits_the_planned_documents(spark):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows(6)], SCHEMA + ", target string, rate double").repartition(4)
    plan = M.mix_plan(df, (5, 2, 1), (3, 2), 2).collect()
    out = M.mixed(df, (5, 2, 1), (3, 2), 2)
    assert out.columns == df.columns
    want = Counter()
    for r in plan:
        want[r.doc_id, r.source, r.size] += r.times
    got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in out.collect())
    assert got == +want


def test_weights_as_a_table(spark):
    df = spark.createDataFrame([(i, "one two three", "en", "ab"[i % 2], 0) for i in range(400)], SCHEMA)
    weights = spark.createDataFrame([("a", 3)], "source string, weight long")
    out = M.mixed(df, weights, (1, 2), 5).collect()
    assert {r.source for r in out} == {"a"}
    assert abs(len(out) - 100) < 50


def test_empty_and_wordless_tables(spark, table_dir):
    for data in ([], [(1, None, None, None, None)], [(1, " ", "en", "a", 1), (None, "", "en", None, 0)]):
        df = spark.createDataFrame(data, SCHEMA)
        got = M.op11_source_mix(spark, table_dir(documents=df)).collect()
        assert len(got) == len(data) and all(r.taken == 0 and r.target == 0 for r in got)
        assert M.mixed(df, (5, 2, 1)).collect() == []


def test_no_python_in_the_plan(spark, table_dir):
    folder = table_dir(documents=spark.createDataFrame(rows(1, 50), SCHEMA))
    plan = M.op11_source_mix(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
