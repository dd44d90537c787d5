"""The same odd table through every operator and stage: nulls in any column, empty and long texts, ties, repeated rows,
clashing column names, no rows."""

import os

import pytest
from pyspark.sql import functions as F

from firnline.llm import langid, media, minhash, mixing, quality, secrets, spm, topk, toxicity

CLASHES = [
    "label", "score", "u", "v", "h", "p", "bucket", "size", "target", "whole", "node", "center", "component", "bands", "x", "media", "tile", "spans", "part", "row", "weight", "n", "count",
    "rank", "raw", "lang_pred", "tokens", "level", "copies", "in_class", "size_class", "waits", "first_id", "element", "total", "keeper", "unit", "evidence",
]
LONG = "lorem ipsum dolor sit amet consectetur " * 8000
ROWS = [
    (1, "plain words in a short text", "en", "a", 27), (1, "plain words in a short text", "en", "a", 27), (2, "plain words in a short text", "de", None, None),
    (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n\t", None, "b", 3), (6, LONG, "en", "a", len(LONG)), (None, "no id but words here all the same", "fr", "c", None),
    (7, "é😀 token = 'abcdef0123456789' ###", "fr", "é", 30), (8, "x", "en", "a", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    base = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return base.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 0, 1), (7, None, None), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").withColumn("label", F.lit(5))


def per_row(df):
    """Every input row has its result row."""
    assert sorted(r["doc_id"] or -1 for r in df.select("doc_id").collect()) == sorted(r[0] or -1 for r in ROWS)


def test_operators_keep_every_row(spark, odd, labels):
    per_row(langid.identify(odd, langid.fit_profiles(odd)))
    per_row(quality.score_quality(odd, quality.fit_quality(odd, labels, F.lit(True))))
    per_row(toxicity.score_toxicity(odd, toxicity.fit_toxicity(odd, labels, F.lit(True))))
    per_row(media.media_columns(odd))
    per_row(secrets.scan_secrets(odd))
    per_row(mixing.mix_sources(odd))
    per_row(minhash.near_duplicates(odd)[0])


def test_classes_of_odd_rows(odd):
    rows, classes, _ = minhash.near_duplicates(odd)
    out = {(r["doc_id"], r["class_id"]) for r in rows.join(classes, "node", "left").collect()}
    assert {(1, 1), (2, 1), (6, 6), (8, 8), (3, None), (4, None), (None, None)} <= out


@pytest.mark.skipif(not os.path.exists(spm.MODEL_PATH), reason="no model file")
def test_tokens_of_odd_rows(odd):
    out = spm.encode_documents(odd)
    per_row(out)
    assert out.filter("not round_trip").count() == 0


@pytest.mark.parametrize("stage", [minhash.stage, secrets.stage, mixing.stage], ids=["minhash", "secrets", "mixing"])
def test_stages_keep_columns(spark, odd, stage):
    out = stage(spark, odd, "")
    assert out.columns == odd.columns and dict(out.dtypes) == dict(odd.dtypes)
    rows = out.collect()
    assert rows and all(r[c] == f"extra {c}" for r in rows for c in CLASHES)
    assert stage(spark, odd.limit(0), "").count() == 0


def test_dedup_stage_keeps_what_it_should(spark, odd):
    ids = sorted((r["doc_id"] or -1) for r in minhash.stage(spark, odd, "").select("doc_id").collect())
    assert ids == [-1, 1, 3, 4, 5, 6, 7, 8]


def test_toxicity_stage_with_tables(spark, odd, labels, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = toxicity.stage(spark, odd, str(tmp_path))
    assert out.columns == odd.columns and out.count() >= 1
    assert toxicity.stage(spark, odd.limit(0), str(tmp_path)).count() == 0


def test_no_rows(spark, odd, labels):
    none = odd.limit(0)
    assert langid.identify(none, langid.fit_profiles(none)).count() == 0
    assert quality.score_quality(none, quality.fit_quality(none, labels.limit(0), F.lit(True))).count() == 0
    assert toxicity.score_toxicity(none, toxicity.fit_toxicity(none, labels.limit(0), F.lit(True))).count() == 0
    assert media.media_columns(none).count() == 0 and secrets.scan_secrets(none).count() == 0 and mixing.mix_sources(none).count() == 0
    assert spm.encode_documents(none).count() == 0


def test_vectors_with_clashing_columns(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    df = df.withColumns({c: F.lit(1) for c in ("number", "query_id", "score", "rank", "label")})
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()] == [(0, 1, 1, 1024 * 1024), (0, 2, 1, 1024 * 1024)]


def test_scratch_folder():
    """The session's checkpoint folder; without one the warehouse, but no machine's own disk on a cluster."""
    from types import SimpleNamespace

    from firnline.llm.common import scratch_dir

    def session(master, **conf):
        conf = {"spark.sql.warehouse.dir": "file:/w", **{k.replace("_", "."): v for k, v in conf.items()}}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(master=master))

    assert scratch_dir(session("spark://a:1", spark_checkpoint_dir="hdfs://h/c/")) == "hdfs://h/c" and scratch_dir(session("local[2]")) == "file:/w/_scratch"
    shared = session("spark://a:1")
    shared.conf.get = lambda k, d=None: {"spark.sql.warehouse.dir": "hdfs://h/w"}.get(k, d)
    assert scratch_dir(shared) == "hdfs://h/w/_scratch"
    with pytest.raises(ValueError):
        scratch_dir(session("spark://a:1"))


def test_discarded_tables_are_gone(spark):
    from firnline.llm.common import discard, materialize

    table = materialize(spark.range(5), "gone")
    assert table.count() == 5
    discard(table)
    assert not os.path.exists(table.scratch_path.removeprefix("file:"))


def test_sieve_lets_every_key_through(spark):
    from firnline.llm.common import Sieve

    keys = spark.range(3000).select((F.col("id") * 7).alias("k"))
    df = spark.range(40000).withColumn("sieve_word", F.lit(1))
    out = Sieve(keys, F.col("k")).marked(df, F.col("id"), "may")
    hit = {r["id"] for r in out.filter("may").collect()}
    assert out.columns == ["id", "sieve_word", "may"] and {i * 7 for i in range(3000)} <= hit and len(hit) < 3000 + 0.1 * 37000
    assert Sieve(keys.limit(0), F.col("k")).marked(df, F.col("id"), "may").filter("may").isEmpty()
