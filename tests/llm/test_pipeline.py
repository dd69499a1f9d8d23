import corpus_pipeline
from helpers import SF, Groups, shingles
from pyspark.sql import functions as F

from tenorline.llm.shared import written


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, None, "src0", None), (9002, "123 456", "en", None, 7), (None, "the that with", None, "src1", 3),
         (9004, 'the plain words with token = "9f8e7d6c5b4a39281706f5e4" and a reader', "en", "src2", 66),
         (9003, "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 " * 5, "en", "src1", 60)], docs.schema)
    given = written(docs.unionByName(odd).unionByName(docs.filter("doc_id = 5")), "given")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "minhash_dedup", "secret_scan", "poisson_mix", "length_buckets"]
    before, seen = given, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = written(stage(spark, before, SF), name)
        before = seen[name]
        if name != "length_buckets":
            assert before.columns == docs.columns and before.schema == docs.schema

    kept = [r["doc_id"] for r in seen["language_id"].collect()]
    assert sorted(kept, key=str) == sorted([r["doc_id"] for r in docs.collect()] + [5, 9004, None], key=str)
    assert seen["language_id"].filter("lang is null").isEmpty()

    rows = seen["language_id"].filter("doc_id is not null").collect()
    groups, sets = Groups({r["doc_id"] for r in rows}), [(r["doc_id"], shingles(r["text"])) for r in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and 100 * len(a & b) >= 80 * len(a | b):
                groups.tie(i, j)
    unique = [r["doc_id"] for r in seen["minhash_dedup"].filter("doc_id is not null").collect()]
    assert sorted(unique) == sorted({groups.find(i) for i, _ in sets})

    changed = (seen["secret_scan"].alias("a").join(seen["minhash_dedup"].alias("b"), "doc_id")
               .select("doc_id", F.col("a.text").alias("now"), F.col("b.text").alias("then"), F.col("a.n_chars").alias("n")).collect())
    assert len(changed) == len(unique) and any("[SECRET]" in r["now"] for r in changed)
    assert all(r["n"] == len(r["now"]) and (r["now"] == r["then"] or "[SECRET]" in r["now"]) for r in changed)
    assert not any("token = \"" in r["now"] for r in changed)

    mixed = seen["poisson_mix"].count()
    assert 0.8 * len(unique) < mixed < 1.2 * len(unique)
    packed = seen["length_buckets"]
    assert packed.count() == mixed and packed.filter("n_tokens > 0 and batch is null").isEmpty()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").filter("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_and_clashing_columns_pass_through(spark):
    names = ["lang_pred", "score", "base", "spans", "copy", "shuffle_key", "row", "_row", "_gone", "name", "count", "a.b", "Kept"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs.select(F.array(F.col("doc_id")).alias("first"), *docs.columns,
                        *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    before = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, SF), name)
        assert after.columns == given.columns and after.schema.simpleString() == given.schema.simpleString()
        rows = after.collect()
        assert rows and all(r["first"] == [r["doc_id"]] and r[n] == f"{n} {r['doc_id']}" for r in rows for n in names)
        before = after
    assert corpus_pipeline.pack(spark, before, SF).count() == len(rows)
