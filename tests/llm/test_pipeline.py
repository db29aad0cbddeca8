"""The pipeline on the smallest table: each stage's decisions take effect, and clean documents stay."""

import corpus_pipeline
import public_tokenizers
from brute import WORDS

from feedmill.llm import mixing, packing
from feedmill.llm.winnowing import Words


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    columns, tables = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        tables.append(docs)
    ids = [{r["doc_id"] for r in t.collect()} for t in tables]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] >= ids[4]
    clean = {d for d in ids[0] if labels.get(d) == 1}
    assert len(clean & ids[1]) >= 0.97 * len(clean)
    words = sum(len(WORDS.findall(r["text"] or "")) for r in tables[3].collect())
    mixed = sum(len(WORDS.findall(r["text"])) for r in tables[4].collect())
    assert abs(mixed - 1.5 * words) < 0.02 * words + 20 * mixing.BLOCK_WORDS
    packed = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    tokens = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).agg({"length": "sum"}).first()[0]
    assert packed.agg({"length": "sum"}).first()[0] == tokens
    places = packed.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in places) <= 2048


def test_lines_stage_leaves_out_no_pair(spark):
    """Every fifth word changed, and the others such that a sample of runs by their hash's low bits has none of them."""
    words = [f"w{k}" for k in range(2000)]
    odd = [w for w, h in zip(words, Words(words).hash.tolist()) if h & 1]
    rows = []
    for size in (20, 31, 40, 64, 99, 160):
        line, odd = odd[:size], odd[size:]
        rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(f"x{w}" if k % 5 == 4 else w for k, w in enumerate(line)))]
    left = corpus_pipeline.lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r["doc_id"] for r in left.collect()} == set(range(0, len(rows), 2))
