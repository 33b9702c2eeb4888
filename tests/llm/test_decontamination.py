import random

import numpy as np

from odd_rows import TEXTS, empty, frame
from twinsieve.llm import decontamination as dec
from twinsieve.llm.queries import table


def brute(item, text, shortest):
    marked_item, marked_text, tiles = [0] * len(item), [0] * len(text), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while (i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k]
                       and not marked_item[i + k] and not marked_text[j + k]):
                    k += 1
                if k >= shortest and (best is None or (-k, i, j) < best):
                    best = (-k, i, j)
        if best is None:
            return tiles
        k, i, j = -best[0], best[1], best[2]
        marked_item[i:i + k] = marked_text[j:j + k] = [1] * k
        tiles.append((i, j, k))


def test_tiles_equal_brute_force():
    draw = np.random.default_rng(0)
    for _ in range(250):
        item = draw.integers(0, 3, draw.integers(1, 14)).astype(np.uint64)
        text = draw.integers(0, 3, draw.integers(1, 25)).astype(np.uint64)
        shortest = min(int(draw.integers(1, 4)), len(item))
        assert dec.tile(item, text, shortest) == brute(item.tolist(), text.tolist(), shortest)


def _planted(spark):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    item = [word() for _ in range(40)]
    noise = lambda n: [word() for _ in range(n)]
    moved = item[20:] + noise(30) + item[:20]
    most = item[:34] + noise(6)
    half = noise(20) + item[:20]
    broken = [w for k in range(0, 40, 4) for w in item[k:k + 4] + noise(1)]
    rows = [(1, noise(50) + item + noise(50)), (2, moved), (3, most), (4, half), (5, broken), (6, noise(300)), (7, ["Tiny", "ITEM"]), (8, ["tiny"])]
    docs = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in rows], "doc_id long, text string")
    items = spark.createDataFrame([(0, " ".join(item)), (1, None), (2, ""), (3, "tiny item")], "item_id long, text string")
    return docs, items


def test_whole_reordered_and_partial_passages(spark, monkeypatch):
    docs, items = _planted(spark)
    for size in (dec.BLOCK_WORDS, 10):              # in one block and in several
        monkeypatch.setattr(dec, "BLOCK_WORDS", size)
        found = {(r.doc_id, r.item_id): r for r in dec.contaminated(docs, items).collect()}
        assert set(found) == {(1, 0), (2, 0), (3, 0), (7, 3)}
        assert found[2, 0].n_tiles == 2 and found[2, 0].coverage == 1.0
        assert abs(found[3, 0].coverage - 34 / 40) < 1e-12
        assert {r.doc_id for r in dec.without_leaks(docs, items).collect()} == {4, 5, 6, 8}


def test_long_quotes_of_long_items(spark):
    draw = random.Random(5)
    noise = lambda n: ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    item = noise(400)
    rows = [(1, noise(20) + item[50:350] + noise(20)), (2, noise(10) + item[7:32] + noise(10)), (3, item[300:320] + noise(9) + item[10:30]),
            (4, noise(10) + item[7:27] + noise(10)),                                    # 20 words stay below the limit
            (5, [w for k in range(0, 390, 13) for w in item[k:k + 12] + noise(1)][:200]),   # no tile of 13 words
            (6, noise(400))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    items = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: r for r in dec.contaminated(docs, items).collect()}
    assert set(found) == {1, 2, 3}
    assert found[1].tiled_words == 300 and found[1].coverage == 0.75 and found[2].tiled_words == 25 and found[3].tiled_words == 40
    assert {r.doc_id for r in dec.without_leaks(docs, items).collect()} == {4, 5, 6}


def test_query_equals_brute_force(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    words = {r.item_id: (r.text or "").encode().lower().split() for r in items.collect()}
    want = {}
    for r in docs.collect():
        text = (r.text or "").encode().lower().split()
        runs = {tuple(text[k:k + 5]) for k in range(len(text) - 4)}
        for name, item in words.items():
            hit = [tuple(item[k:k + 5]) in runs for k in range(len(item) - 4)]
            if sum(hit) * 5 >= 0.8 * len(item):
                near = [w for k, w in enumerate(text) if any(tuple(text[j:j + 5]) in {tuple(item[i:i + 5]) for i in range(len(item) - 4)}
                                                             for j in range(max(0, k - 4), k + 1))]
                tiled = sum(t[2] for t in brute(item, near, 5))
                if tiled >= 0.8 * len(item):
                    want[r.doc_id, name] = tiled
    found = {(r.doc_id, r.item_id): r.tiled_words for r in dec.contaminated(docs, items).collect()}
    assert set(found) == set(want)
    assert all(found[k] <= want[k] for k in found)


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (None, "a b c")], "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in dec.contaminated(frame(spark), items).collect()]
    assert sorted(found, key=str) == sorted([(1, 1), (1, 1), (10, None), (11, None)], key=str)
    kept = dec.without_leaks(frame(spark), items)
    assert kept.columns == frame(spark).columns and kept.count() == len(TEXTS) - 4
    assert dec.contaminated(empty(spark), items).count() == 0
    assert dec.contaminated(frame(spark), items.limit(0)).count() == 0
