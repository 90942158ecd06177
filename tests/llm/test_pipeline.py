"""Every stage of the pipeline against a plain version of its decisions."""

from collections import Counter

import pyarrow.parquet as pq
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from helixframe.llm.bpe import codec
from helixframe.llm.queries import BLOCK_ROWS, RANKS, WEIGHTS
from tests.llm.test_simhash import brute_components

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    truth = dict(zip(*pq.read_table(f"{DATA}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values(), strict=True))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    kept = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        kept[name] = docs.collect()
        if name != names[-1]:
            assert docs.columns == columns
    ids = {n: [r.doc_id for r in rows] for n, rows in kept.items()}
    assert ids["language_id"] == [r.doc_id for r in kept["documents"] if any(c.isalpha() for c in r.text)]
    junk = {d for d, q in truth.items() if not q}
    gone = set(ids["language_id"]) - set(ids["quality_classifier"])
    assert len(gone & junk) >= 0.9 * len(junk) and not gone & (set(truth) - junk)
    rows = [(r.doc_id, r.text) for r in kept["quality_classifier"]]
    assert sorted(ids["simhash_dedup"]) == sorted(d for d, _, c in brute_components(rows) if d == c)
    assert sorted(ids["source_mix"]) == sorted(ids["simhash_dedup"])
    lib = tiktoken.Encoding("own", pat_str=codec.__wrapped__.__globals__["public_tokenizers"].PATTERN, mergeable_ranks=codec(RANKS, codec.__wrapped__.__globals__["public_tokenizers"].PATTERN).ranks, special_tokens={})
    text = {r.doc_id: r.text for r in kept["source_mix"]}
    for r in kept["byte_bpe"]:
        assert r.ids == lib.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.decodes
    assert sorted(ids["byte_bpe"]) == sorted(ids["source_mix"])
    # Full blocks lead the mix in proportion to the weights.
    head = [r.source for r in kept["source_mix"]][: 5 * BLOCK_ROWS]
    assert set(head) & set(WEIGHTS)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()) == sorted(ids["byte_bpe"])


def test_weights_hold_in_the_rows_of_run(spark, tmp_path):
    """Rows of run() name their slots: full blocks take them in proportion to the weights, and every row has its own place."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("source", F.concat(F.lit("src"), F.col("doc_id") % 6))
    rows.repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({(r.mix_slot, r.mix_row) for r in got}) == len(got) > 0
    slots, blocks = {}, Counter()
    for r in got:
        assert slots.setdefault(r.mix_slot, r.source) == r.source and 0 <= r.mix_row < BLOCK_ROWS
        blocks[r.source, r.mix_block] += 1
    units = {s: WEIGHTS.get(s, 1) for s in {r.source for r in got}}
    period, size = sum(units.values()), Counter(r.source for r in got)
    for s, n in size.items():
        assert sorted(blocks[s, j] for j in range(-(-n // BLOCK_ROWS)))[1:] == [BLOCK_ROWS] * (-(-n // BLOCK_ROWS) - 1)
    # Until the first source runs out, each has run less than a block more or less than its share.
    whole = min(size[s] // BLOCK_ROWS * period // u for s, u in units.items())
    assert whole > 0
    for t in range(1, whole + 1):
        ran = Counter(slots[i] for i in range(t))
        assert all(abs(ran[s] - t * u / period) < 1 for s, u in units.items())


def test_empty_and_odd_documents(spark):
    empty = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, DATA)
        assert empty.count() == 0
