import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from odd_rows import TEXTS, empty, frame
from twinsieve.llm import pieces
from twinsieve.llm.queries import table, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _encode(text):
    data = text.replace("▁", " ").encode()
    return pieces.encode_text(data, np.array([0, len(data)]), PATH)


def test_ids_equal_the_library_on_random_texts(library):
    draw = random.Random(5)
    model, _ = pieces.load(PATH)
    texts = ["", " ", "   ", "▁a", "  執 x", " " * 40, "a" * 300, "x" + " " * 17 + "y", "\n \n", "𝒳  "]
    texts += ["".join(draw.choice("  \n\tab1.éthein執𝒳’'s—▁") for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    for text in texts:
        ids, sizes = _encode(text)
        want = [1, *library.encode(text), 2]
        assert ids.tolist() == want
        assert model.decode_all(ids, sizes)[0].decode() == library.decode(want)


def test_decoding_of_any_ids_equals_the_library(library):
    draw = random.Random(6)
    model, _ = pieces.load(PATH)
    for _ in range(1000):
        ids = [draw.choice([draw.randint(1, 300), draw.randint(1, 31999)]) for _ in range(10)]
        assert model.decode_all(np.array(ids), np.array([10]))[0].decode() == library.decode(ids)


def test_pair_rule_agrees_with_merging_both_tokens():
    model, _ = pieces.load(PATH)
    draw = random.Random(7)
    known = [i for i in model.rank if i in model.parts and not model.text[i].startswith(pieces.BLANK)]
    for _ in range(1500):
        a, b = draw.choice(known), draw.choice(known)
        merged = pieces.merge_queue(list(model.text[a] + model.text[b]), model.score)
        assert model.pair_fits(a, b) == (merged == [model.text[a], model.text[b]])


def test_odd_rows(spark, library):
    found = sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.decoded) for r in pieces.encode_pieces(frame(spark), PATH).collect())
    want = sorted((i is None, i or 0, [1, *library.encode(t or ""), 2], library.decode(library.encode(t or ""))) for i, t in TEXTS)
    assert found == want
    assert pieces.piece_digests(empty(spark), PATH).count() == 0


def test_query_digests(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in pieces.piece_digests(docs, PATH).collect():
        ids = [1, *library.encode(texts[row.doc_id]), 2]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_workers_keep_little_and_get_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, None)
    try:
        spark.conf.set(key, str(64 << 20))
        assert pieces.piece_digests(frame(spark), PATH).count() == len(TEXTS)
        assert int(spark.conf.get(key).rstrip("b")) <= 4 << 20
    finally:
        spark.conf.set(key, held) if held else spark.conf.unset(key)
    _, cache = pieces.load(PATH)
    assert cache.most == pieces.MOST_UNITS <= 1 << 19
