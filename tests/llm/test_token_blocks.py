import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from odd_rows import TEXTS, empty, frame
from twinsieve.llm import token_blocks as blocks
from twinsieve.llm.queries import table, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [0, 1, 2, 31, 2047, 2048, 2049, 70_000])
def test_round_trip_of_random_ids(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50257).astype(np.uint32)
    assert (blocks.decode_ids(blocks.encode_ids(ids, 50257), n, 50257) == ids).all()


def test_nothing_is_learnt_after_the_last_round(monkeypatch):
    calls, learn = [], blocks._Model.learn
    monkeypatch.setattr(blocks._Model, "learn", lambda self, *a: calls.append(1) or learn(self, *a))
    ids = (np.random.default_rng(1).zipf(1.3, 9000) % 50257).astype(np.uint32)
    rounds = len(list(blocks._rounds(len(ids))))
    raw = blocks.encode_ids(ids, 50257)
    assert rounds > 2 and len(calls) == rounds - 1
    assert (blocks.decode_ids(raw, len(ids), 50257) == ids).all() and len(calls) == 2 * (rounds - 1)


def test_repetition_costs_little():
    ids = np.tile(np.arange(50, dtype=np.uint32), 2000)
    raw = blocks.encode_ids(ids, 50257)
    assert (blocks.decode_ids(raw, len(ids), 50257) == ids).all()
    assert len(raw) < len(ids) / 2


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint32)
    block = bytearray(blocks.pack_block(np.array([7]), np.array([5000]), ids, 50257))
    names, lengths, back = blocks.unpack_block(bytes(block), 50257)
    assert names.tolist() == [7] and lengths.tolist() == [5000] and (back == ids).all()
    block[-900] ^= 0x40
    with pytest.raises(ValueError):
        blocks.unpack_block(bytes(block), 50257)


def test_units_never_change_the_ids(library):
    draw = np.random.default_rng(3)
    signs = list(" \n\tab1.é  　’'s") + ["<|endoftext|>", " x", "don't"]
    for _ in range(1500):
        text = "".join(draw.choice(signs, 14))
        data = text.encode()
        ids, _ = blocks.tokenize(data, np.array([0, len(data)]), PATH)
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_special_strings_in_many_texts(library):
    draw = np.random.default_rng(4)
    signs = ["<|endoftext|>", "<|endof", "text|>", " ", "a", "\n", "  ", "'s", " <|", "|>"]
    texts = ["".join(draw.choice(signs, draw.integers(0, 9))) for _ in range(800)] + ["end <|endoftext|> next", "<|endof", "text|>"]
    raw = [t.encode() for t in texts]
    ids, lengths = blocks.tokenize(b"".join(raw), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), PATH)
    found = [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]
    assert found == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert found[-3] == [437, 220, 50256, 1306, 2]



def test_fresh_units_are_joined_at_once(library, monkeypatch):
    """Odd neighbours go alone, special strings are one id, and cuts are looked for a few times only, however many units."""
    calls, cuts = [], blocks.unit_cuts
    monkeypatch.setattr(blocks, "unit_cuts", lambda *a: calls.append(1) or cuts(*a))
    encoder = blocks.ByteEncoder(PATH)
    calls.clear()
    draw = np.random.default_rng(6)
    odd = ["a", "é", "\n", "  ", " ", "　b", "'s", "don't", "<|endoftext|>", "x y"]
    texts = [f" w{k}" if draw.random() < 0.9 else odd[k % len(odd)] + str(k) * (k % 3) for k in range(20_000)] + odd
    ids, lengths = encoder.memory.encode([t.encode() for t in texts])
    assert len(calls) <= 8 and lengths.sum() == len(ids)
    found = [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]
    # A special string with digits after it is no unit that the cutting makes.
    same = [k for k, t in enumerate(texts) if t == "<|endoftext|>" or "<|" not in t]
    assert [found[k] for k in same] == [library.encode(texts[k], add_special_tokens=False).ids for k in same]


def _expected(rows, library):
    out, at = [], 0
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_reads_back_every_document(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    found = sorted(map(tuple, blocks.token_digests(docs, PATH).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert found == _expected(sorted((r.doc_id, r.text) for r in docs.collect()), library)


def test_odd_rows_and_small_blocks(spark, library, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/blocks"
    blocks.write_token_blocks(frame(spark), path, PATH, block_ids=40)
    found = blocks.read_token_blocks(spark, path, PATH).collect()
    assert sum(len(r.ids) for r in found) == max(r.start + len(r.ids) for r in found)
    want = sorted((i is not None, i or 0, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in TEXTS)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in found) == want
    ordered = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ordered[0] is None and ordered[1:] == sorted(ordered[1:])
    assert blocks.token_digests(empty(spark), PATH).count() == 0


def test_texts_and_blocks_come_in_small_batches(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, None)
    try:
        spark.conf.set(key, str(64 << 20))
        blocks.write_token_blocks(frame(spark), str(tmp_path / "blocks"), PATH)
        assert int(spark.conf.get(key).rstrip("b")) <= 4 << 20
        spark.conf.set(key, str(64 << 20))
        assert blocks.read_token_blocks(spark, str(tmp_path / "blocks"), PATH).count() == len(TEXTS)
        assert int(spark.conf.get(key).rstrip("b")) <= 4 << 20
    finally:
        spark.conf.set(key, held) if held else spark.conf.unset(key)
