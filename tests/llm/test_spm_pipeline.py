import os
import random
import time

import pytest

from firnline.llm import registry, spm

sentencepiece = pytest.importorskip("sentencepiece")
pytestmark = pytest.mark.skipif(not os.path.exists(spm.MODEL_PATH), reason="no model file")

TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b   c     d", " " * 30, " " * 30 + "x", "Hello  world\n\tx 😀 日本語 ", "aaaa" * 50, "====" * 9 + "----" * 5, "x" * 300,
    "....!!!???", "     \n    \n", "The quick brown fox's 12345 jumps; for(i=0;i<n;++i){}", "\x00\x01", "é́", "Straßenbahnhaltestelle loweiungkeit", "antidisestablishmentarianism" * 3,
]


@pytest.fixture(scope="module")
def vocabulary():
    return spm.Vocabulary.read(spm.MODEL_PATH)


def noise(rng):
    kinds = ["the", "ing", "tion", "er", " ", " ", "  ", "\n", ".", "é", "ß", "中", "0", "7", "A", "qu", "zz", "😀", "-", "▂"]
    return "".join(rng.choice(kinds) for _ in range(rng.randrange(0, 60)))


def test_ids_equal_the_library_for_merging_models(vocabulary):
    rng = random.Random(1)
    texts = TEXTS + [noise(rng) for _ in range(300)]
    e, lib = spm.Encoder(vocabulary), sentencepiece.SentencePieceProcessor(model_file=spm.MODEL_PATH)
    ids, offsets = e.encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == lib.encode(texts)
    assert e.decode(got) == texts


def test_ids_equal_the_library_for_unigram_models():
    """The same pieces and scores declared a unigram model: the plain Viterbi maximum."""
    data = open(spm.MODEL_PATH, "rb").read()
    for key, value in spm._fields(data):
        if key == 2:
            at = value.index(b"\x18\x02")
            changed = value[:at] + b"\x18\x01" + value[at + 2 :]
            data = data.replace(value, changed)
    v = spm.Vocabulary.parse(data)
    assert v.model_type == spm.UNIGRAM
    lib = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["hello world", "tokenization of unknown words", "The quick brown fox", "internationalisation", "ab cd ef"]
    ids, offsets = spm.Encoder(v).encode(texts)
    for t, a, b in zip(texts, offsets, offsets[1:]):
        mine, theirs = ids[a:b].tolist(), lib.encode(t)
        assert mine == theirs or abs(sum(v.scores[mine]) - sum(v.scores[theirs])) < 1e-3


def test_cache_can_start_over(vocabulary, monkeypatch):
    monkeypatch.setattr(spm, "CACHE_WORDS", 5)
    e, lib = spm.Encoder(vocabulary), sentencepiece.SentencePieceProcessor(model_file=spm.MODEL_PATH)
    for t in ("one two three four five six seven", "eight nine one two", "ten"):
        assert e.encode([t])[0].tolist() == lib.encode(t)


def test_unbroken_texts(vocabulary):
    """Ids equal the library's, and a text without blanks takes no longer for a character than one with them."""
    rng = random.Random(3)
    e, lib = spm.Encoder(vocabulary), sentencepiece.SentencePieceProcessor(model_file=spm.MODEL_PATH)
    stems = ["the", "ing", "tion", "er", "an", "x", "q", "st", "é", "ß", "7", "A", "in"]
    texts = ["".join(rng.choice(stems) for _ in range(n)) for n in (200, 700, 3000)]
    texts += [u * (2500 // len(u)) for u in ("a", "ab", "abc", "hello", "=", "ha", "theing", "-=", "1234567", "antidis", "e" * 9 + "s")]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/") for _ in range(3000)), "中" * 900 + "文字" * 500, "x" * 257, "ab" * 128 + "c"]
    for t in texts:
        assert e.encode([t])[0].tolist() == lib.encode(t), t[:40]
    ids, offsets = e.encode(texts)  # all together, from an empty cache
    e._clear()
    ids, offsets = e.encode([" ".join(texts), *texts])
    assert ids[: offsets[1]].tolist() == lib.encode(" ".join(texts)) and [ids[a:b].tolist() for a, b in zip(offsets[1:], offsets[2:])] == lib.encode(texts)
    began = time.time()
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    assert e.encode([long])[0].tolist() == lib.encode(long)
    assert time.time() - began < 20


def test_documents(spark, docs):
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, "word " * 40000), (1, "Hello world"), (5, "a▁b")]
    out = sorted(spm.encode_documents(docs(rows)).collect(), key=lambda r: r["doc_id"])
    lib = sentencepiece.SentencePieceProcessor(model_file=spm.MODEL_PATH)
    for r, (i, t) in zip(out, sorted(rows, key=lambda x: x[0])):
        assert r["tokens"] == lib.encode(t or "") and r["n_tokens"] == len(r["tokens"]) and r["round_trip"] == ("▁" not in (t or ""))
    assert spm.encode_documents(docs(rows).limit(0)).count() == 0


def test_pipeline_over_the_small_tables(spark):
    import corpus_pipeline

    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf_dir):
        pytest.skip("test tables are not here")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_dedup", "secrets", "mixing", "sentencepiece"]
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, counts = source, [source.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "test")
        assert docs.schema == source.schema
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] == counts[3] and counts[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == counts[4]
    by_run = corpus_pipeline.run(spark, sf_dir)
    key = lambda df: sorted((r["doc_id"], tuple(r["tokens"])) for r in df.collect())
    assert key(by_run) == key(last)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_runs(spark, name):
    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf_dir):
        pytest.skip("test tables are not here")
    out = registry.QUERIES[name](spark, sf_dir)
    table = "embeddings" if name.startswith("op2_") else "conversations" if name.startswith("op6_") else "documents"
    n = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert out.count() == (n if table != "embeddings" else out.count())
    if name in registry.SQL:
        import duckdb

        con = duckdb.connect()
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
        want = con.execute(registry.SQL[name]).fetchall()
        columns = [c[0] for c in con.execute(registry.SQL[name]).description]
        got = [tuple(r) for r in out.select(*columns).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
