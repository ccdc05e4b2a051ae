import random

import numpy as np
import public_tokenizers
import tiktoken

from pressgauge.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ALPHABET = "aé's ll  \t\n\n  123२ß漢字😀́\x85　.,!'՘꟎\U000107bb\U00011de0\U000323b0"


def plain():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def texts(count=400, most=60):
    rng = random.Random(1)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most))) for _ in range(count)]
    return out + ["", None, "a" * 500, " " * 300, "\n\n" * 100 + "b", "x\n\nb" * 90, "<|endoftext|>", "don't they'll 've" * 20]


def test_every_character_is_split_alike():
    own, encoder = plain(), bpe.Encoder(bpe.load_ranks(RANKS), bpe.patterns(PATTERN))
    plain_text, careful, rare = bpe.patterns(PATTERN)
    for c in [*range(0x3000), *map(ord, "՘꟎꟏\U000107bb\U00011de0\U0001246f\U000323b0")]:
        text = f"a{chr(c)}{chr(c)}1 {chr(c)}b"
        assert np.frombuffer(encoder.ids([encoder.split(text)])[0], "<u4").tolist() == own.encode_ordinary(text), hex(c)


def test_against_the_library_and_round_trip(spark):
    own = plain()
    rows = [(i, t, b"x") for i, t in enumerate(texts())]
    rows += [(3, rows[3][1], b"y"), (None, "null id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary")
    expected = sorted((str(d), tuple(own.encode_ordinary(t or ""))) for d, t, _ in rows)
    for long, overlap in ((1 << 16, 1 << 10), (16, 6), (7, 3)):
        coded = bpe.decode(bpe.encode(docs, RANKS, PATTERN, long=long, overlap=overlap), RANKS).collect()
        assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in coded) == expected
        assert sorted((str(r.doc_id), bytes(r.decoded)) for r in coded) == sorted((str(d), (t or "").encode()) for d, t, _ in rows)


def test_stitched_boundaries_are_true():
    split, rng = bpe.Encoder(bpe.load_ranks(RANKS), bpe.patterns(PATTERN)).split, random.Random(2)
    for text in [t for t in texts(200, 300) if t]:
        size, overlap = rng.randint(3, 40), rng.randint(1, 20)
        count = max(1, -(-(len(text) - overlap) // size))
        chunks = []
        for i in range(count):
            piece = text[i * size: (i + 1) * size + overlap]
            chunks.append((i * size, i == count - 1, piece, bpe._ends(split(piece))))
        got, at = [], 0
        for piece, ends in bpe.stitch(iter(chunks), split):
            got += [piece[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
            at += len(piece)
        assert got == split(text)


def test_empty_table(spark, no_documents):
    assert bpe.decode(bpe.encode(no_documents, RANKS, PATTERN), RANKS).count() == 0
