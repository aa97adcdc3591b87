"""The pipeline's stages on planted cases."""

import random

import corpus_pipeline
from tests.conftest import SF_SMALL


def test_stages_on_planted_cases(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    rnd = random.Random(8)
    english = [r for r in docs if r.lang == "en" and r.n_chars > 900]
    clean = english[0]
    words = clean.text.split()
    near = list(words)
    near[len(near) // 2] = "changed"
    # a passage of 60 words that only the planted documents hold
    passage = " ".join("".join(rnd.choice("abcdeiou") for _ in range(rnd.randrange(2, 8))) for _ in range(60))
    added = [(10**6, clean.text), (10**6 + 1, " ".join(near)), (10**6 + 2, english[1].text[:700] + " " + bench[0].text + " the end"),
             (10**6 + 3, " ".join(english[2].text.split()[::-1]) + " " + passage), (10**6 + 4, " ".join(english[3].text.split()[::-1]) + " " + passage),
             (10**6 + 5, None), (10**6 + 6, "12 34")]
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "x") for r in docs] + [(i, t, "en", "src1", len(t or ""), "x") for i, t in added]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, taken string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench).write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        now = stage(spark, now, str(tmp_path))
        if name != "mixing":
            assert now.columns == before.columns
        now.write.parquet(str(tmp_path / f"out{k}"))
        now = spark.read.parquet(str(tmp_path / f"out{k}"))
        kept[name] = {r.doc_id: r for r in now.collect()}
    assert not {10**6 + 5, 10**6 + 6} & set(kept["language"]) and len(kept["language"]) == len(rows) - 2
    assert clean.doc_id in kept["minhash"] and not {10**6, 10**6 + 1} & set(kept["minhash"])
    assert passage in kept["substrings"][10**6 + 3].text and passage not in kept["substrings"][10**6 + 4].text
    assert 10**6 + 2 in kept["substrings"] and 10**6 + 2 not in kept["benchmark"]
    assert clean.doc_id in kept["benchmark"] and kept["benchmark"][clean.doc_id].text == kept["minhash"][clean.doc_id].text
    assert set(kept["mixing"]) == set(kept["benchmark"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted((tuple(r) for r in kept["mixing"].values()), key=str)


def test_copies_with_null_or_repeated_ids_go(spark):
    rnd = random.Random(9)
    one, two, three, four = [" ".join("".join(rnd.choices("abcdeiou", k=5)) for _ in range(60)) for _ in range(4)]
    rows = [(None, one, 1), (None, one, 2), (None, one + " end", 3),  # null ids only
            (7, two, 4), (7, two, 5), (9, two, 6), (None, two, 7),  # the smallest id is repeated
            (8, three, 8), (8, four, 9), (3, four + " end", 10),  # one id, two texts
            (None, None, 11), (None, "", 12), (5, " ", 13), (5, " ", 14)]  # no words
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(4)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    by = {r.row: r for r in kept.collect()}
    assert len(by) == kept.count() == 8 and len({1, 2, 3} & set(by)) == 1 and len({4, 5, 6, 7} & set(by)) == 1
    assert {4, 5} & set(by) and {8, 10, 11, 12, 13, 14} <= set(by)


def test_whole_texts_go_to_python_a_few_at_a_time(spark, monkeypatch):
    """In every stage that does not pack its batches, and the session's setting holds again after."""
    from tidyload.llm import common
    seen, before = {}, spark.conf.get(common.ARROW_ROWS)

    def stage(name):
        def run(spark, docs, sf_dir):
            seen[name] = int(spark.conf.get(common.ARROW_ROWS))
            return docs
        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage(name) for name, _ in corpus_pipeline.STAGES])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: spark.range(3))
    monkeypatch.setattr(corpus_pipeline, "written", lambda docs: docs)
    assert corpus_pipeline.run(spark, "").count() == 3 and spark.conf.get(common.ARROW_ROWS) == before
    assert [seen[s] for s in ("language", "minhash", "benchmark")] == [1000] * 3 and seen["substrings"] == int(before)
