"""The pipeline's stages against brute force on a small corpus, and its contract."""

import hashlib
from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
import tiktoken

from daymill.llm import bpe, mixing, secrets, toxicity
from test_similar import brute


def test_stages_in_order(spark, sf_dir, tmp_path):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "secrets", "mixing", "bpe"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at, seen = docs, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, at, sf_dir)
        out.write.parquet(str(tmp_path / name))
        seen[name] = (at.collect(), spark.read.parquet(str(tmp_path / name)).collect())
        if name != "bpe":
            assert out.columns == docs.columns
            at = spark.read.parquet(str(tmp_path / name))

    before, after = seen["toxicity"]
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    wanted = [r.doc_id for r, s in zip(before, toxicity.scores(model, [r.text for r in before])) if s < toxicity.REJECT]
    assert sorted(r.doc_id for r in after) == sorted(wanted)

    before, after = seen["near_dedup"]
    wanted = {c for _, c in brute([(r.doc_id, r.text) for r in before])}
    assert sorted(r.doc_id for r in after) == sorted(wanted)

    before, after = seen["secrets"]
    changed = {r.doc_id: r.text for r in after}
    assert len(before) == len(after)
    for r in before:
        if r.text != changed[r.doc_id]:
            assert any(f"<{k}>" in changed[r.doc_id] for k in secrets.RULES)

    before, after = seen["mixing"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    sizes = Counter()
    for r in before:
        sizes[r.source] += len(r.text.split(" "))
    assert max(Counter(r.doc_id for r in after).values()) <= mixing.REPETITIONS + 1

    before, after = seen["bpe"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    wanted = {r.doc_id: library.encode_ordinary(r.text) for r in before}
    assert len(before) == len(after) and all(list(r.ids) == wanted[r.doc_id] and r.n_tokens == len(r.ids) for r in after)
    digest = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in before}
    assert all(r.decoded_sha256 == digest[r.doc_id] for r in after)


def test_run_gives_every_row(spark, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"] and out.count() > 0
