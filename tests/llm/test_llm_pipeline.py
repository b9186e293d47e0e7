import random

import corpus_pipeline
from llm_texts import words

from loglens.llm import decontaminate, packing, toxicity
from test_llm_jaccard import brute
from test_llm_packing import expected, tokenizer  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(spark, docs):
    rng = random.Random(5)
    items = [" ".join(words(rng, 30)) for _ in range(4)]
    rows, labels = [], []
    for i in range(300):
        w = words(rng, rng.randint(20, 60))
        toxic = i % 5 == 0
        if toxic:
            w[3] = w[-2] = "grimblesnout"
        if i % 7 == 1 and i > 20:
            text = rows[i - 7][1]
        elif i % 11 == 1:
            text = " ".join(w[:10]) + " " + items[i % 4] + " " + " ".join(w[10:])
        elif i % 13 == 1:
            text = " ".join(w) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
        else:
            text = " ".join(w)
        rows.append((i, text, rng.choice(["en", "de", None]), "s", len(text)))
        labels.append((i, 1, int("grimblesnout" in text)))
    rows += [(300, None, "en", "s", 0), (301, "", "en", "s", 0), (5, *rows[5][1:])]
    return {"documents": docs(rows), "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
            "benchmark": spark.createDataFrame(list(enumerate(items)), "item_id long, text string")}


def rows_by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_each_stage_against_its_plain_version(spark, docs, table_dir, tokenizer):  # noqa: F811
    folder = table_dir(**tables(spark, docs))
    stages = dict(corpus_pipeline.STAGES)
    before = spark.read.parquet(f"{folder}/documents.parquet").cache()

    clean = stages["toxicity"](spark, before, folder).cache()
    assert clean.columns == COLUMNS
    kept = rows_by_id(clean)
    gone = set(rows_by_id(before)) - set(kept)
    toxic = {r.doc_id for r in before.collect() if "grimblesnout" in (r.text or "")}
    assert gone == toxic

    single = stages["jaccard_join"](spark, clean, folder).cache()
    assert single.columns == COLUMNS
    groups = brute([(r.doc_id, r.text) for r in clean.collect()], 5, 4, 5)
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c, _ in groups})

    fresh = stages["decontamination"](spark, single, folder).cache()
    assert fresh.columns == COLUMNS
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert sorted(rows_by_id(fresh)) == sorted(i for i, r in rows_by_id(single).items() if not any(t in (r.text or "") for t in items))

    safe = stages["secret_scan"](spark, fresh, folder).cache()
    assert safe.columns == COLUMNS
    redacted = rows_by_id(safe)
    for i, r in rows_by_id(fresh).items():
        want = r.text and r.text.replace('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff', "[SECRET]")
        assert redacted[i].text == want
        assert redacted[i].n_chars == len(want or "")

    packed = stages["best_fit_packing"](spark, safe, folder)
    by_id = sorted(rows_by_id(safe).items())
    want = [(by_id[i][0], *rest) for i, *rest in expected(tokenizer, [r.text for _, r in by_id])]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed.collect()) == sorted(want)


def test_run_applies_all_stages_and_is_registered(spark, docs, table_dir):
    from loglens.llm import queries
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard_join", "decontamination", "secret_scan", "best_fit_packing"]
    assert queries.llm_queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    folder = table_dir(**tables(spark, docs))
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 100


def test_operators_are_the_stages(monkeypatch):
    assert corpus_pipeline.decontaminate is decontaminate and corpus_pipeline.packing is packing and corpus_pipeline.toxicity is toxicity


def test_empty_documents(spark, docs, table_dir):
    made = tables(spark, docs)
    folder = table_dir(**(made | {"documents": docs([])}))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_rows_without_id_and_used_ids_take_part_in_all_stages(spark, table_dir):
    rng = random.Random(9)
    item, lone, twin = (" ".join(words(rng, 40)) for _ in range(3))
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, score double"
    rows = [(None, lone), (None, lone), (None, f"{item} {lone}"), (4, twin), (4, f"{twin[:100]} {item}"), (4, lone + " and more words of its own " + twin),
            (9, twin), (None, None), (7, "")]
    folder = table_dir(documents=spark.createDataFrame([(i, t, "en", "s", len(t or ""), "d", 0.5) for i, t in rows], schema),
                       labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                       benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["decontamination"](spark, stages["jaccard_join"](spark, stages["toxicity"](spark, docs, folder), folder), folder)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), str(r.text)) for r in kept.collect())
    assert got == sorted([("None", lone), ("4", twin), ("4", rows[5][1]), ("None", "None"), ("7", "")])


def test_empty_labels_and_benchmark(spark, docs, table_dir):
    folder = table_dir(documents=docs(["one text of some words", "another text"]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                       benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == [0, 1]
