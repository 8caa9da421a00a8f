"""The pipeline, stage by stage, each against a brute-force version over its own input."""

import re
from collections import Counter

import numpy as np
from cases import SMALL
from test_decontaminate import plain_words
from test_near import brute as near_brute
from tokenizers import Tokenizer

import corpus_pipeline
from varigrove.llm import toxicity
from varigrove.llm.common import saved, table


def test_stages(spark, tokenizer):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]
    docs = table(spark, SMALL, "documents")
    kept = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = saved(stage(spark, kept[-1], SMALL), "test-stage")
        if n < 4:
            assert out.columns == docs.columns
        kept.append(out)
    rows = [df.collect() for df in kept]
    ids = [Counter(r.doc_id for r in part) for part in rows]

    # Toxicity: what goes is what the labels call toxic, as far as they reach.
    labels = {r.doc_id: r.toxic for r in table(spark, SMALL, "labels").collect()}
    assert np.mean([(i in ids[1]) == (not labels[i]) for i in ids[0] if i in labels]) > 0.9
    assert set(rows[1]) <= set(rows[0])

    # Near duplicates: one of each class of what is left.
    left = [(r.doc_id, r.text) for r in rows[1]]
    assert sorted(ids[2]) == sorted(set(near_brute(left))) and max(ids[2].values()) == 1

    # Decontamination: no window of an item is left, and nothing else is gone.
    windows = set()
    for r in table(spark, SMALL, "benchmark").collect():
        ws = plain_words(r.text)
        n = min(10, len(ws))
        windows |= {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1 if n else 0)}
    sizes = {len(w) for w in windows}

    def dirty(text):
        line = plain_words(text)
        return any(tuple(line[k : k + n]) in windows for n in sizes for k in range(len(line) - n + 1))

    assert sorted(ids[3]) == sorted(r.doc_id for r in rows[2] if not dirty(r.text))

    # Mixing: copies of documents that are left, near 1.5 times all words.
    count = lambda part: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in part)
    assert set(rows[4]) <= set(rows[3]) and max(ids[4].values()) <= 2
    assert abs(count(rows[4]) - 1.5 * count(rows[3])) < 0.05 * count(rows[3])

    # Token files: every copy, in order.
    library, start = Tokenizer.from_file(tokenizer), 0
    last = sorted(rows[5], key=lambda r: r.start)
    texts = {r.doc_id: r.text for r in rows[4]}
    assert [r.doc_id for r in last] == sorted(ids[4].elements())
    for r in last:
        assert r.start == start and r.n_tokens == 1 + len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        start += r.n_tokens


def test_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0


def test_odd_documents(spark, odd, none):
    """Every stage takes odd rows, and an empty table."""
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.count() <= 2 * docs.count()


def test_toxic_rows_are_caught(spark):
    labels = table(spark, SMALL, "labels")
    docs = table(spark, SMALL, "documents").join(labels.where("toxic = 1"), "doc_id")
    chain = toxicity.train(table(spark, SMALL, "documents"), labels.selectExpr("doc_id", "1 - quality as low_quality", "toxic"), ["low_quality", "toxic"])
    scored, (_, p) = toxicity.score(docs, chain)
    assert scored.where(f"{p} >= {chain.limits[1]}").count() >= 0.9 * docs.count()
