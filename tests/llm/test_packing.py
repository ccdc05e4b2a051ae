import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pressgauge.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aAéÉß'sll  \t\n ́.,.,1２३ΣςİǅñÑ　!?-\x85\x1cµªŉſ"


def test_ids_equal_the_tokenizer():
    plain, encoder, rng = Tokenizer.from_file(PATH), packing.WordEncoder(PATH), random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += [t[:5] + mark + t[5:] for t in texts[:50] for mark in ("<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>.")]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_plan_holds_the_demand_in_few_bins():
    rng = np.random.default_rng(2)
    for n, scale in ((16, 1), (32, 40), (64, 200)):
        demand = rng.poisson(scale * np.exp(-np.arange(n) / 8))
        patterns, times = packing.plan(demand)
        assert ((patterns * times[:, None]).sum(0) == demand).all()
        assert ((patterns * np.arange(1, n + 1)).sum(1) <= n).all()
        assert times.sum() <= np.ceil((demand * np.arange(1, n + 1)).sum() / n) * 1.02 + 2


def test_price_is_the_best_pattern():
    values = np.array([0.1, 0.25, 0.2, 0.55, 0.5])
    best, pattern = packing.price(values)
    assert best == pytest.approx(0.65) and (pattern * np.arange(1, 6)).sum() <= 5 and pattern @ values == pytest.approx(best)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_every_id_once_and_no_overlap(spark, capacity):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "unbelievably"]) for _ in range(rng.randint(0, 120)))) for i in range(200)]
    rows += [(i, "same words") for i in range(300, 400)] + [(7, rows[7][1]), (500, None), (501, "")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, offset int")
    got = packing.pack_documents(docs, PATH, capacity=capacity).collect()
    plain = Tokenizer.from_file(PATH)
    expected = []
    for d, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        expected += [(d, s, len(ids[s: s + capacity]), zlib.crc32(ids[s: s + capacity].tobytes()), len(ids)) for s in range(0, len(ids), capacity)]
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(expected)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) <= sum(r.length for r in got) / capacity * 1.2 + 3


def test_empty_table(spark, no_documents):
    assert packing.pack_documents(no_documents, PATH).count() == 0
