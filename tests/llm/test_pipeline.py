import corpus_pipeline
from pyspark.sql import functions as F

from cutlight.llm import jaccard_join, mixing, queries, tiling, token_store, toxicity
from cutlight.llm.scratch import materialise

SF = "/root/testdata/sf0.01"


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = toxicity.keep_clean(docs, model).cache()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    single = jaccard_join.one_of_each_group(clean).cache()
    groups = {r.component_id for r in jaccard_join.near_duplicates(clean).collect()}
    assert {r.doc_id for r in single.collect()} == groups
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    free = tiling.clean(single, bench).cache()
    bad = {r.doc_id for r in tiling.report(single, bench).where("contaminated").collect()}
    assert bad and {r.doc_id for r in free.collect()} == groups - bad
    assert tiling.report(free, bench).where("contaminated").count() == 0
    mixed = mixing.mixed_rows(free).cache()
    assert mixed.columns == docs.columns
    last = token_store.tokenize(mixed, queries.tokenizer_path()).collect()
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, last), key=repr)


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]


ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "some plain words of a clean text", "en", "a", 1), (4, "some plain words of a clean text", "en", "a", 1), (None, "no id here at all", None, "b", 1),
    (5, " ".join(f"w{i}" for i in range(150_000)), "en", "b", 1), (6, "Some  plain words of a clean TEXT", "de", None, 1),
]


def test_stages_on_odd_rows_and_on_none(spark, tmp_path):
    """Each stage keeps its columns, and rows without text, with an empty table, repeated ids and clashing names do not stop it."""
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for name, rows in (("odd", ODD), ("none", [])):
        at = tmp_path / name
        given = spark.createDataFrame(rows, kind)
        for c in ("size", "cls", "key", "comp", "score", "row", "n", "block"):
            given = given.withColumn(c, F.lit(1))
        given.write.parquet(str(at / "documents.parquet"))
        labels = [(r[0], 1, 0) for r in rows] + ([(4, 1, 1), (None, None, None)] if rows else [])
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
        spark.createDataFrame([(1, None), (2, "")] if rows else [], "item_id bigint, text string").write.parquet(str(at / "benchmark.parquet"))
        now = spark.read.parquet(str(at / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(at))
            assert now.columns == given.columns
        out = corpus_pipeline.run(spark, str(at)).collect()
        assert len(out) == now.count()
        if not rows:
            assert not out


def test_names_that_stages_use_themselves(spark):
    names = ["_text", "_drop", "_bad", "_tag", "_id", "_of", "_source", "_take", "_takes", "_cut", "_n", "_c0", "row", "take", "cut", "tag", "of", "score", "_Drop2"]
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    for name in names:
        rows = rows.withColumn(name, F.concat(F.lit(f"{name}:"), F.col("doc_id").cast("string")))
    docs = rows
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == rows.columns
        docs = materialise(docs, "named")
        got = docs.collect()
        assert got and all(r[name] == f"{name}:{r.doc_id}" for r in got for name in names)
