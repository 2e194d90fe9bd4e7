"""The pipeline on a small corpus: what each stage must drop, keep and mask."""

import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, `a.b` string, kept string, row string"


@pytest.mark.parametrize("rows", [[], [None, "", "few words"]])
def test_pipeline_edge_cases(spark, tmp_path, rows):
    """An empty table; null ids and texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i}" for i in range(90))
    texts = [(k, t) for k, t in enumerate(rows)] + ([(None, long), (None, long), (7, long), (7, long), (7, long + " z"), (8, long)] if rows else [])
    spark.createDataFrame([(i, t, None, "s", None, "x", "y", "z") for i, t in texts], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    made = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((x["doc_id"] or -1, x["a.b"], x["kept"], x["row"]) for x in made) == ([(-1, "x", "y", "z")] * 2 + [(7, "x", "y", "z")] if rows else [])


def test_pipeline(spark, tmp_path):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("aeioubcdfg") for _ in range(6)) for _ in range(800)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    item = prose(30)
    texts = {i: prose(120) for i in range(60)}
    texts[100] = texts[1]
    texts[101] = texts[2] + " " + vocabulary[0]
    texts[102] = prose(60) + " " + item + " " + prose(20)
    texts[103] = "too short"
    texts[104] = prose(100) + ' token = "0123456789abcdef0123456789abcdef" ' + prose(9)
    texts[105] = None
    texts[106] = " ".join(f"###{k}" for k in range(150))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, after = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after[name] = {x["doc_id"]: x.asDict() for x in docs.collect()}
        assert k == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = set(range(60))
    good = after["quality_rules"].keys()
    assert clean <= good and not {103, 105} & good
    assert clean <= after["simhash_near_dedup"].keys() and not {100, 101} & after["simhash_near_dedup"].keys()
    assert 102 not in after["benchmark_decontamination"] and clean <= after["benchmark_decontamination"].keys()
    masked = after["secret_scans"][104]
    assert "0123456789abcdef" not in masked["text"] and masked["n_chars"] == len(masked["text"]) and after["secret_scans"][0]["text"] == texts[0]
    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert after["bpe_encoding"][0]["n_tokens"] == len(tk.encode(texts[0], add_special_tokens=False).ids)
    whole = {x["doc_id"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == after["bpe_encoding"].keys()
