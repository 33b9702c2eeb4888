import numpy as np
import pytest
from tokenizers import Tokenizer

from odd_rows import TEXTS, empty, frame
from twinsieve.llm import token_counts as counts
from twinsieve.llm.queries import op13_two_tier, table, tokenizer_path
from twinsieve.llm.words import Text

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def library(name):
    """Tokens of a text by the file's own library, with its defaults."""
    path = tokenizer_path(name)
    if name.endswith(".json"):
        tokenizer = Tokenizer.from_file(path)
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: len(model.encode(text))


def joined(texts):
    raw = [t.encode() for t in texts]
    return Text(b"".join(raw), np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]))


@pytest.mark.parametrize("name", FILES)
def test_random_texts_count_as_in_the_library(name):
    count, draw = library(name), np.random.default_rng(5)
    signs = list(" \n\t'ab1.é　’sA7,-́▁") + ["<|endoftext|>", "<|endof", "text|>", " x", "don't", "  ", "'re", "\x85", "執"]
    for size in (1, 3, 14, 60):
        texts = ["".join(draw.choice(signs, size)) for _ in range(400)] + ["", "<|endoftext|>"]
        assert counts.text_tokens(joined(texts), tokenizer_path(name)).tolist() == [count(t) for t in texts]


def test_a_literal_across_two_texts_is_none():
    texts = ["a<|endof", "text|>b", "", "x <|endoftext|> y<|endoftext|>", "<|endof<|endoftext|>"]
    count = library(FILES[0])
    assert counts.text_tokens(joined(texts), tokenizer_path(FILES[0])).tolist() == [count(t) for t in texts]


def test_table_keeps_what_it_was_given():
    draw = np.random.default_rng(1)
    held, keys = counts.LengthTable(5000), np.unique(draw.integers(0, 2**63, 4000, np.int64)).view(np.uint64)
    keys[:200] >>= np.uint64(40)                                    # many on one slot
    keys = np.unique(keys)
    held.add(keys[::2], np.arange(len(keys[::2])))
    found, known = held.find(keys)
    assert known[::2].all() and not known[1::2].any()
    assert found[::2].tolist() == list(range(len(keys[::2])))
    held.add(keys[1::2], np.arange(len(keys[1::2])))
    assert held.find(keys)[1].all()
    held.add(np.arange(1, 4000, dtype=np.uint64) << np.uint64(50), np.zeros(3999, int))      # no room: emptied first
    assert not held.find(keys)[1].any()


@pytest.mark.parametrize("name", FILES)
def test_query_on_whole_table(spark, sf_dir, name, monkeypatch):
    monkeypatch.setattr(counts, "FREQUENT_IN_FOLD", 4)
    docs, count = table(spark, sf_dir, "documents"), library(name)
    path = tokenizer_path(name)
    used = op13_two_tier(spark, sf_dir) if name == FILES[0] else counts.count_tokens(docs, path)
    want = {r.doc_id: (len(r.text.encode()), count(r.text)) for r in docs.collect()}
    got = used.collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(want)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_frequent_pre_tokens_are_in_the_table(spark):
    docs = spark.createDataFrame([(k, "often again often " * 50 + f"rare{'xyz'[k % 3] * k}") for k in range(40)], "doc_id long, text string")
    keys, values = counts.frequent_lengths(docs, tokenizer_path(FILES[0]))
    held = counts.LengthTable.of(keys, values)
    text = joined([" often", " again", "rarex"])
    found, known = held.find(counts.hash_spans(text.data, text.offsets[:-1], text.offsets[1:]))
    assert known.tolist() == [True, True, False]
    count = library(FILES[0])
    assert found[:2].tolist() == [count(" often"), count(" again")]


@pytest.mark.parametrize("name", FILES)
def test_odd_rows(spark, name):
    count = library(name)
    got = counts.count_tokens(frame(spark), tokenizer_path(name)).collect()
    want = [(i, len((t or "").encode()), count(t or "")) for i, t in TEXTS]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(want, key=key)
    assert counts.count_tokens(empty(spark), tokenizer_path(name)).count() == 0
    with pytest.raises(ValueError):
        counts.count_tokens(frame(spark), "/nowhere/ranks.tiktoken")


def test_texts_and_stretches_come_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(counts, "ENCODED_AT_ONCE", 7)
    held = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        assert counts.count_tokens(frame(spark), tokenizer_path(FILES[0])).count() == len(TEXTS)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", held) if held else spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    count = library(FILES[0])
    stretches = [f" {'word' * k}{k}" for k in range(30)]
    assert counts._json_counter(tokenizer_path(FILES[0])).lengths([s.encode() for s in stretches]) == [count(s) for s in stretches]
