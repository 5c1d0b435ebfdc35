import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from lexroll.llm import quality_classifier, quality_rules
from tests.llm.test_jaccard import brute_kept
from tests.llm.test_pairs import brute_contamination

FOLDER = "/root/testdata/sf0.001"
LLM = sorted(n for n in entry.queries() if n.startswith("op"))


def test_all_are_registered():
    assert {n.split("_")[0] for n in LLM} == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality classifier"](spark, docs, FOLDER).cache()
    ranking = quality_classifier.learn_quality(docs, labels)
    wanted = {r["doc_id"] for r in quality_classifier.score_quality(docs, ranking).where("predicted = 1").collect()}
    assert good.columns == columns and {r["doc_id"] for r in good.collect()} == wanted
    sound = steps["quality rules"](spark, good, FOLDER).cache()
    own = {r["doc_id"] for r in good.collect() if not quality_rules.text_fails(r["text"])}
    assert sound.columns == columns and {r["doc_id"] for r in sound.collect()} == own  # no bad host here
    once = steps["near-duplicates"](spark, sound, FOLDER).cache()
    rows = [(r["doc_id"], r["text"]) for r in sound.collect()]
    assert once.columns == columns and sorted(r["doc_id"] for r in once.collect()) == brute_kept(rows)
    clean = steps["decontamination"](spark, once, FOLDER).cache()
    left = sorted(r["doc_id"] for r in once.collect() if not brute_contamination(r["text"], items)[4])
    assert clean.columns == columns and sorted(r["doc_id"] for r in clean.collect()) == left
    final = steps["tokens"](spark, clean, FOLDER)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in final.collect():
        assert r["n_tokens"] == len(library.encode(r["text"], add_special_tokens=False).ids)
    assert final.columns == [*columns, "n_tokens", "ids_sha256", "decoded_sha256"]
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(str, whole.collect())) == sorted(map(str, final.collect()))


def test_clashing_columns(spark, odd_documents, no_documents):
    tokens = dict(corpus_pipeline.STAGES)["tokens"]
    docs = odd_documents.withColumn("N_tokens", odd_documents.source).withColumn("_tokens", odd_documents.text).withColumn("row", odd_documents.lang)
    found = tokens(spark, docs, FOLDER)
    assert found.columns == ["doc_id", "text", "source", "lang", "score", "kept", "_tokens", "row", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(str, found.select("doc_id", "text", "_tokens", "row").collect())) == sorted(
        map(str, docs.select("doc_id", "text", "_tokens", "row").collect())
    )
    assert all(r["n_tokens"] == 0 for r in found.where("text IS NULL OR text = ''").collect())
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, no_documents, FOLDER).count() == 0
