import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline

from . import plain


@pytest.fixture
def folder(spark, tmp_path, prose):
    dice = random.Random(8)
    texts = {i: prose(dice.randrange(1, 120), i, 3000) for i in range(240)}
    for i in range(0, 240, 6):
        texts[i] += " idiot moron scum" * (1 + i % 2)
    for i in range(1, 60, 6):
        texts[i + 240] = texts[i]
        texts[i + 300] = texts[i + 1] + " end"
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t)) for i, t in texts.items()] + [(900, None, "en", "s1", 0), (901, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(i < 240 and i % 6 == 0), 1) for i in range(240)]
    spark.createDataFrame(marks, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema, seen = docs.schema, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else {}
        out = stage(spark, docs, folder)
        rows = out.collect()
        seen[name] = (before, rows)
        if name != "packing":
            assert out.schema == schema
            docs = spark.createDataFrame(rows, schema)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]

    before, rows = seen["toxicity"]
    assert sorted(set(before) - {r.doc_id for r in rows}) == [i for i in range(0, 240, 6)]
    before, rows = seen["exact_dedup"]
    assert sorted(r.doc_id for r in rows) == sorted({r[1] for r in plain.exact(list(before.items()))})
    before, rows = seen["near_dedup"]
    assert sorted(r.doc_id for r in rows) == sorted(r[0] for r in plain.near(list(before.items()), 5) if r[3])
    before, rows = seen["mixing"]
    total = sum(len(plain.words(t)) for t in before.values())
    assert abs(sum(len(plain.words(r.text)) for r in rows) - total) <= 5
    _, rows = seen["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen["mixing"][1])
    assert sum(r.length for r in rows) == wanted


def test_registered(spark, folder):
    assert {f"op{n}_" for n in range(1, 11)} <= {name.split("_")[0] + "_" for name in driver.queries()}
    assert driver.queries()["pipeline"](spark, folder).count() > 0
