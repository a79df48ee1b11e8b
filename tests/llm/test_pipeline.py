"""The pipeline's stages, one after the other, against plain Python."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from seasonmart.llm import bpe
from tests.llm.test_near_dedup import brute

BAD = ["grimwort", "snidefell", "vilebrack"]


def test_pipeline(spark, prose, tmp_path):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(700):
        words = prose(int(rng.integers(30, 70))).split()
        if i % 7 == 0:
            for _ in range(4):
                words.insert(int(rng.integers(0, len(words))), BAD[int(rng.integers(0, 3))])
        lines = [" ".join(words[:20]), " ".join(words[20:])]
        rows.append((i, "\n".join([*lines, "all rights are with us"] if i % 2 else lines)))
        labels.append((i, 1, int(i % 7 == 0)))
    rows += [(1000 + i, rows[8 * i + 1][1] + " tail") for i in range(30)]
    documents = [(i, t, "en", f"src{i % 20}", len(t)) for i, t in rows] + [(5000, None, None, None, None)]
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(documents, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if number < 4:
            assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(f"{folder}/out/{name}")
        docs = spark.read.parquet(f"{folder}/out/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}

    toxic = {i for i, t in rows if any(b in t for b in BAD)}
    clean = {i for i, _ in rows} - toxic | {5000}
    kept = set(seen["toxicity"])
    assert len(kept & toxic) <= 0.05 * len(toxic) and len(clean - kept) <= 0.02 * len(clean)

    cleaned = {i: r.text for i, r in seen["line_dedup"].items()}
    assert set(cleaned) == kept
    for i in kept - {5000}:
        before = seen["toxicity"][i].text.split("\n")
        assert cleaned[i] == "\n".join(x for x in before if x != "all rights are with us")

    pairs = list(cleaned.items())
    assert set(seen["near_dedup"]) == {i for i, _, _, stays in brute(pairs, 5) if stays}

    mixed = seen["mixing"]
    assert set(mixed) <= set(seen["near_dedup"]) and len(mixed) > 0.5 * len(seen["near_dedup"])
    assert all(mixed[i].text == cleaned[i] for i in mixed)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in seen["bpe"].values():
        if r.text is not None:
            assert bpe.ids_of(r.ids) == library.encode(r.text, add_special_tokens=False).ids
            assert r.decoded == r.text
    assert set(seen["bpe"]) == set(mixed)

    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {i: r.ids for i, r in seen["bpe"].items()}


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, ids string, _site string, node string"


def odd_folder(spark, folder, rows):
    values = [(i, t, "en", s, None, "a", "b", "c", "d") for i, t, s in rows]
    spark.createDataFrame(values, ODD).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 0, 0) for i, *_ in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_on_odd_rows(spark, prose, tmp_path):
    """Nulls in all columns, repeated rows, a very long text and names that stages use inside."""
    long = prose(20_000)
    rows = [(i, prose(30), "src1") for i in range(40)]
    rows += [(100, long, "src2"), (101, None, "src1"), (102, "", None), (103, "  ", "src1"), (None, prose(20), None), (None, None, None)]
    rows += [rows[3], rows[3], (200, rows[4][1], "src9")]
    odd_folder(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c.split(" ")[0] for c in ODD.split(", ")], name
        docs.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in docs.collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {t for _, t, _ in rows}
    for r in out:
        assert r.text in texts and r.decoded == r.text
        assert bpe.ids_of(r._ids) == library.encode(r.text, add_special_tokens=False).ids
    near = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/out/near_dedup").collect()}
    assert 200 not in near and {3, 4, 100} <= near


def test_pipeline_on_an_empty_table(spark, tmp_path):
    odd_folder(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
