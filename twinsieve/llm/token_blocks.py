"""Token ids on disk: adaptive context-mixing range coder over independently reset, checksummed blocks.

An id's probability mixes three predictions: the id last seen after the previous two ids, the id last seen
after the previous one, and the frequencies of all ids so far. The mixing weights are counted from how often
each prediction held at the same confidence. The mix drives a carryless range coder.

A block holds whole documents and starts from an empty model, so any block can be read alone. It is cut into
rounds that grow to ``ROUND_IDS`` ids. Within a round the model stands still and the ids run through parallel
lanes, each with its own coder; after the round the model learns the round's ids. All arithmetic is on
integers, so every machine decodes alike.

Payload: magic ``TWRC``, version, number of documents and ids (u4, u4, u8), CRC-32 of the ids (u4), document
ids (i8 each), their lengths (u8 each); then per round the lane lengths (u2 each) and the lanes' words (u4).
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.columns import c
from ..session import ensure_checkpoint_dir
from .stored import small_batches
from .units import UnitCache, worker_memory
from .words import chunks, gather_ragged

BLOCK_IDS = 1 << 20         # a block closes at this many ids; a longer document is a block of its own
ROUND_IDS = 1 << 18
STEPS = 64                  # ids of one lane in a full round
FIRST_ROUND = 1 << 11
END_ID = 2

_MAGIC = b"TWRC"
_HEAD = "<4sIIQI"
_SCALE = 24                 # probabilities are parts of 2^24
_BASE = 17                  # order-0 frequencies are parts of 2^17, each id at least one
_SLOTS = 18                 # order-2 table of 2^18 slots
_SYMBOLS = 1 << 16
_NONE = np.uint32(0xFFFFFFFF)
_WORD = np.uint64(32)
_LOW32 = np.uint64(0xFFFFFFFF)
_TOP = np.uint64(1 << 32)
_PAIR = np.uint64(17)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Model:
    """What a block has taught so far."""

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.counts = np.zeros(symbols, np.int64)
        self.after_one = np.full(_SYMBOLS + 1, _NONE, np.uint32)
        self.trust_one = np.zeros(_SYMBOLS + 1, np.uint8)
        self.after_two = np.full(1 << _SLOTS, _NONE, np.uint32)
        self.trust_two = np.zeros(1 << _SLOTS, np.uint8)
        self.outcomes = np.zeros((3, 32), np.int64)     # misses, order-2 hits, order-1 hits by confidence
        self.freeze()

    def freeze(self) -> None:
        """Frequencies and weights for the next round."""
        spare = (1 << _BASE) - self.symbols
        total = int(self.counts.sum())
        freq = 1 + (self.counts * spare // total if total else np.zeros(self.symbols, np.int64))
        freq[int(np.argmax(freq))] += (1 << _BASE) - int(freq.sum())
        self.freq = freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)
        _, two, one = self.outcomes
        seen = self.outcomes.sum(0)
        most = (1 << _SCALE) - (1 << _SCALE - 4)
        one_weight = most * (2 * one + 1) // (2 * seen + 6)
        one_weight[16:] = 0                             # both predictions agree
        two_weight = most * (2 * two + 1) // (2 * seen + 6)
        step = ((1 << _SCALE) - one_weight - two_weight) >> _BASE
        two_weight += (1 << _SCALE) - one_weight - two_weight - (step << _BASE)
        self.two_weight, self.one_weight, self.step = (x.astype(np.uint64) for x in (two_weight, one_weight, step))

    def by_part(self) -> np.ndarray:
        """Id of every order-0 part."""
        return np.repeat(np.arange(self.symbols, dtype=np.uint32), self.freq.astype(np.int64))

    @staticmethod
    def slot(before: np.ndarray, last: np.ndarray) -> np.ndarray:
        key = (before.astype(np.uint64) << _PAIR) + last.astype(np.uint64)
        return (key * _GOLDEN >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def predict(self, before: np.ndarray, last: np.ndarray):
        """(order-2 id, order-1 id, confidence class, order-2 slot)."""
        slot = self.slot(before, last)
        two, one = self.after_two[slot], self.after_one[last]
        kind = self.trust_two[slot] * np.uint8(4) + self.trust_one[last] + np.uint8(16) * (two == one)
        return two, one, kind, slot

    def learn(self, ids, last, two, one, kind, slot) -> None:
        self.counts += np.bincount(ids, minlength=self.symbols)
        hit_two, hit_one = two == ids, one == ids
        outcome = np.where(hit_two, 1, np.where(hit_one, 2, 0))
        self.outcomes += np.bincount(outcome * 32 + kind, minlength=96).reshape(3, 32)
        # Repeated places keep the last write, which is the latest id.
        self.trust_two[slot] = np.where(hit_two, np.minimum(self.trust_two[slot] + 1, 3), 0)
        self.trust_one[last] = np.where(hit_one, np.minimum(self.trust_one[last] + 1, 3), 0)
        self.after_two[slot] = ids
        self.after_one[last] = ids
        self.freeze()


def _rounds(n: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, lanes) of each round of a block with n ids."""
    start, size = 0, FIRST_ROUND
    while start < n:
        end = min(n, start + size)
        yield start, end, -(-(end - start) // min(STEPS, size // 32))
        start, size = end, min(ROUND_IDS, max(FIRST_ROUND, end))


def _laid_out(ids: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids by step and lane, ids of each lane): lanes are consecutive stretches, the first ones a step longer."""
    lengths = np.full(lanes, len(ids) // lanes)
    lengths[:len(ids) % lanes] += 1
    return lengths, np.cumsum(lengths) - lengths


def encode_ids(ids: np.ndarray, symbols: int) -> bytes:
    """Compressed ids of one block."""
    model, out = _Model(symbols), []
    for start, end, lanes in _rounds(len(ids)):
        part = ids[start:end].astype(np.int64)
        lengths, begins = _laid_out(part, lanes)
        last = np.empty(len(part), np.int64)
        last[1:] = part[:-1]
        before = np.empty(len(part), np.int64)
        before[2:] = part[:-2]
        last[begins] = _SYMBOLS                 # a lane does not see the one before it
        before[begins] = _SYMBOLS
        second = begins + 1
        before[second[second < len(part)]] = _SYMBOLS
        two, one, kind, slot = model.predict(before, last)
        w2, w1, step = model.two_weight[kind], model.one_weight[kind], model.step[kind]
        hit2, hit1 = two == part, one == part
        low_part = np.where(hit2, 0, np.where(hit1, w2, w2 + w1 + model.cum[part] * step))
        width = np.where(hit2, w2, np.where(hit1, w1, model.freq[part] * step))
        out += _range_encode(low_part.astype(np.uint64), width.astype(np.uint64), lengths, begins)
        if end < len(ids):
            model.learn(part, last, two, one, kind, slot)
    return b"".join(out)


def _range_encode(low_part, width, lengths, begins) -> list[bytes]:
    lanes = len(lengths)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    owners, words = [], []
    numbers = np.arange(lanes, dtype=np.int32)
    steps = int(lengths.max())
    at = np.minimum(begins[None, :] + np.arange(steps)[:, None], len(width) - 1)
    low_part, width = low_part[at], width[at]
    for step in range(steps):
        live = lanes if step < lengths[-1] else int(np.searchsorted(-lengths, -step))
        part = span[:live] >> np.uint64(_SCALE)
        lo = low[:live] + low_part[step, :live] * part
        sp = width[step, :live] * part
        out = np.flatnonzero(sp < _TOP)
        if len(out):
            l, s = lo[out], sp[out]
            s = np.where((l ^ (l + s)) < _TOP, s, -l & _LOW32)   # cut the interval where it crosses a word
            owners.append(numbers[out])
            words.append((l >> _WORD).astype(np.uint32))
            lo[out], sp[out] = l << _WORD, s << _WORD
        low[:live], span[:live] = lo, sp
    owners.append(numbers)
    words.append(((low + _LOW32) >> _WORD).astype(np.uint32))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return [np.bincount(owner, minlength=lanes).astype("<u2").tobytes(),
            np.concatenate(words)[order].astype("<u4").tobytes()]


def decode_ids(payload: bytes, n: int, symbols: int) -> np.ndarray:
    """The ``n`` ids of one block."""
    model, ids, at = _Model(symbols), np.empty(n, np.int64), 0
    for start, end, lanes in _rounds(n):
        sizes = np.frombuffer(payload, "<u2", lanes, at).astype(np.int64)
        at += 2 * lanes
        words = np.concatenate([np.frombuffer(payload, "<u4", int(sizes.sum()), at), np.zeros(2, np.uint32)]).astype(np.uint64)
        at += 4 * int(sizes.sum())
        part = ids[start:end]
        lengths, begins = _laid_out(part, lanes)
        read = np.cumsum(sizes) - sizes
        stop = read + sizes
        nothing = len(words) - 1
        code = words[read] << _WORD | words[np.where(read + 1 < stop, read + 1, nothing)]
        read = read + 2
        low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
        last = np.full(lanes, _SYMBOLS, np.uint64)
        before = last << _PAIR
        two_table = model.after_two.astype(np.uint64) << _WORD | model.trust_two * np.uint64(4)
        one_table = model.after_one.astype(np.uint64) << _WORD | model.trust_one
        order0, by_part = model.cum << _WORD | model.freq, model.by_part()
        both_weights = model.two_weight + model.one_weight
        kept = []
        for step in range(int(lengths.max())):
            live = lanes if step < lengths[-1] else int(np.searchsorted(-lengths, -step))
            after = last[:live]
            slot = ((before[:live] + after) * _GOLDEN >> np.uint64(64 - _SLOTS)).view(np.int64)
            two, one = two_table[slot], one_table[after.view(np.int64)]
            kind = (two & _LOW32) + (one & _LOW32)
            two, one = two >> _WORD, one >> _WORD
            kind += (two == one) * np.uint64(16)
            kind = kind.view(np.int64)
            w2, both, unit = model.two_weight[kind], both_weights[kind], model.step[kind]
            share = span[:live] >> np.uint64(_SCALE)
            value = (code[:live] - low[:live]) // share
            np.minimum(value, np.uint64((1 << _SCALE) - 1), out=value)
            plain = value >= both
            part_of = (value - both) // unit
            part_of[~plain] = 0
            third = by_part[part_of.view(np.int64)]
            entry = order0[third]
            is_two = value < w2
            got = np.where(is_two, two, np.where(plain, third, one))
            lo_part = np.where(plain, both + (entry >> _WORD) * unit, w2)
            lo_part[is_two] = 0
            width = np.where(plain, (entry & _LOW32) * unit, np.where(is_two, w2, both - w2))
            lo, sp, cd = low[:live] + lo_part * share, width * share, code[:live]
            out = np.flatnonzero(sp < _TOP)
            if len(out):
                l, s = lo[out], sp[out]
                s = np.where((l ^ (l + s)) < _TOP, s, -l & _LOW32)
                where = read[out]
                cd[out] = cd[out] << _WORD | words[np.where(where < stop[out], where, nothing)]
                read[out] = where + 1
                lo[out], sp[out] = l << _WORD, s << _WORD
            low[:live], span[:live] = lo, sp
            part[begins[:live] + step] = got
            if end < n:
                kept.append((live, two, one, kind, slot))
            before[:live] = after << _PAIR
            last[:live] = got
        if end < n:
            _relearn(model, part, lengths, begins, kept)
    return ids.astype(np.uint32)


def _relearn(model: _Model, part, lengths, begins, kept) -> None:
    """Teach the decoded round in the order of its ids, as the encoder did."""
    last = np.empty(len(part), np.int64)
    last[1:] = part[:-1]
    last[begins] = _SYMBOLS
    columns = [np.empty(len(part), x.dtype) for x in kept[0][1:]]
    for step, (live, *found) in enumerate(kept):
        for column, values in zip(columns, found):
            column[begins[:live] + step] = values
    model.learn(part, last, *columns)


def pack_block(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, symbols: int) -> bytes:
    head = struct.pack(_HEAD, _MAGIC, 1, len(doc_ids), len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
    return head + doc_ids.astype("<i8").tobytes() + lengths.astype("<u8").tobytes() + encode_ids(ids, symbols)


def unpack_block(block: bytes, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, lengths, ids); raises ValueError when the block is damaged."""
    magic, version, docs, n, crc = struct.unpack_from(_HEAD, block)
    if magic != _MAGIC or version != 1:
        raise ValueError("not a token block")
    at = struct.calcsize(_HEAD)
    doc_ids = np.frombuffer(block, "<i8", docs, at)
    lengths = np.frombuffer(block, "<u8", docs, at + 8 * docs).astype(np.int64)
    try:
        ids = decode_ids(block[at + 16 * docs:], n, symbols)
    except (IndexError, ValueError) as error:       # damaged words lead to impossible ids or run out
        raise ValueError("token block cannot be decoded") from error
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("token block fails its checksum")
    return doc_ids, lengths, ids


# ---------------------------------------------------------------- text to ids

# First bytes of the characters among which all Unicode spaces above ASCII lie (fixed values).
_SPACE_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_IS_LEAD = np.zeros(256, bool)
_IS_LEAD[list(_SPACE_LEADS)] = True


def unit_cuts(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Sorted positions where the byte-level splitting pattern certainly starts a new piece.

    That is around a lone ASCII space between characters that are no spaces; a blank stays with what follows.
    Characters that might be other spaces make no cut, so units near them are just longer.
    """
    b = np.frombuffer(data, np.uint8)
    n = len(b)
    if n < 3:
        return np.unique(offsets)
    space = _IS_SPACE[b]
    at = np.flatnonzero(space[1:-1] & ~space[:-2] & ~space[2:]) + 1
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    at = at[~(edge[at] | edge[at + 1])]
    wide = b[at - 1] >= 0x80
    odd = _IS_LEAD[b[at + 1]] | wide & (_IS_LEAD[b[np.maximum(at - 2, 0)]] | _IS_LEAD[b[np.maximum(at - 3, 0)]])
    at = at[~odd]
    after = at[b[at] != 32] + 1
    cuts = np.zeros(n + 1, bool)
    cuts[at] = True
    cuts[after] = True
    cuts[offsets] = True
    return np.flatnonzero(cuts)


JOINED_UNITS = 1024


def _encode_joined(tokenizer, width: np.ndarray, special: dict[bytes, int], units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units end to end, number of ids of each unit).

    Units that certainly start a new piece after each other are encoded as one text and told apart by bytes.
    """
    whole = {} if special.keys().isdisjoint(units) else {i: special[u] for i, u in enumerate(units) if u in special}
    kept = np.delete(np.arange(len(units)), list(whole))
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    while True:     # leaving units out makes new neighbours, so look again
        data = b"".join([units[i] for i in kept.tolist()])
        ends = np.cumsum(sizes[kept])
        starts = ends - sizes[kept]
        cut = np.zeros(len(data) + 1, bool)
        cut[unit_cuts(data, np.array([0, len(data)]))] = True
        sure = cut[starts] & cut[ends]
        if sure.all():
            break
        kept = kept[sure]
    bounds = np.append(starts[::JOINED_UNITS], len(data)).tolist()
    texts = [data[low:high].decode() for low, high in zip(bounds[:-1], bounds[1:])]
    parts = [np.array(found.ids, np.uint32) for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    ids = np.concatenate([np.zeros(0, np.uint32), *parts])
    upto = np.searchsorted(np.cumsum(width[ids]), ends, side="right")
    lone = np.ones(len(units), bool)
    lone[kept] = False
    lone = np.flatnonzero(lone)
    plain = [i for i in lone.tolist() if i not in whole]
    found = dict(zip(plain, tokenizer.encode_batch_fast([units[i].decode() for i in plain], add_special_tokens=False)))
    apart = [[whole[i]] if i in whole else found[i].ids for i in lone.tolist()]
    order = np.concatenate([kept, lone])
    lengths, starts = np.zeros((2, len(units)), np.int64)
    lengths[order] = np.concatenate([np.diff(upto, prepend=0), np.fromiter(map(len, apart), np.int64, len(apart))])
    starts[order] = np.cumsum(lengths[order]) - lengths[order]
    apart = np.fromiter(chain.from_iterable(apart), np.uint32, int(lengths[lone].sum()))
    return np.concatenate([ids, apart])[gather_ragged(starts, lengths)], lengths


class ByteEncoder:
    """A tokenizer file with its memory of units; special strings inside a text are ids of their own, as in the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.symbols = tokenizer.get_vocab_size()
        self.special = {token.content.encode(): number for number, token in tokenizer.get_added_tokens_decoder().items()}
        self.literals = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # The strings are cut out before, so that none is read into units that stand side by side by chance.
        tokenizer.encode_special_tokens = True
        # Bytes of each id: the vocabulary writes one character per byte.
        width = np.zeros(self.symbols, np.int64)
        for token, number in tokenizer.get_vocab().items():
            width[number] = len(token)

        self.memory = UnitCache(lambda units: _encode_joined(tokenizer, width, self.special, units))

    def cuts(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """Cuts of ``unit_cuts``, and around every special string; the text between these is split by itself."""
        if self.literals is None or not self.literals.search(data):
            return unit_cuts(data, offsets)
        bounds = [offsets]
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            bounds.append(np.array([p + low for m in self.literals.finditer(data[low:high]) for p in m.span()], np.int64))
        return unit_cuts(data, np.unique(np.concatenate(bounds)))


def byte_encoder(path: str) -> ByteEncoder:
    """The encoder of a file, one per worker."""
    loaded = worker_memory("tokens")
    if path not in loaded:
        loaded[path] = ByteEncoder(path)
    return loaded[path]


def tokenize(data: bytes, offsets: np.ndarray, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents end to end with the end id after each, ids of each document)."""
    encoder = byte_encoder(path)
    docs = len(offsets) - 1
    cuts = encoder.cuts(data, offsets)
    ids, lengths = encoder.memory.encode_spans(data, cuts[:-1], cuts[1:])
    sums = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(cuts, offsets)]
    out = np.full(len(ids) + docs, end_id, np.uint32)
    out[gather_ragged(sums[:-1] + np.arange(docs), np.diff(sums))] = ids
    return out, np.diff(sums) + 1


# ---------------------------------------------------------------- Spark side

_BLOCKS = "part int, block int, n_ids long, payload binary"


def write_token_blocks(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                       end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode whole texts and write them as token blocks, in ascending order of the id.

    One range shuffle of the texts gives the order; each task packs its stretch. A null text is empty, a
    null id comes first, repeated ids stay beside each other, an empty table gives no block. Other columns
    are not read. The file is a Parquet table of blocks, so Spark commits it task by task.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, block, symbols = TaskContext.get().partitionId(), 0, byte_encoder(tokenizer).symbols
        names, sizes, runs, held = [], [], [], 0

        def flush():
            nonlocal block, held
            lengths, ids = np.concatenate(sizes), np.concatenate(runs)
            payload = pack_block(np.concatenate(names), lengths, ids, symbols)
            made = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                                               pa.array([len(ids)], pa.int64()), pa.array([payload], pa.binary())],
                                              ["part", "block", "n_ids", "payload"])
            names.clear(), sizes.clear(), runs.clear()
            block, held = block + 1, 0
            return made

        for batch in batches:
            for rows, text in chunks(batch, "text", 4 << 20):
                ids, lengths = tokenize(text.data, text.offsets, tokenizer, end_id)
                keys = rows.column(0).fill_null(-2**63).to_numpy(zero_copy_only=False)
                low, ends = 0, np.cumsum(lengths)
                while low < len(keys):
                    done = int(ends[low - 1]) if low else 0
                    high = max(low + 1, int(np.searchsorted(ends, done + block_ids - held, side="right")))
                    names.append(keys[low:high])
                    sizes.append(lengths[low:high])
                    runs.append(ids[done:int(ends[high - 1])])
                    held += len(runs[-1])
                    low = high
                    if held >= block_ids or low < len(keys):
                        yield flush()
        if names:
            yield flush()

    small_batches(docs.sparkSession)
    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text"))
    (chosen.repartitionByRange(F.col("id"), F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
     .mapInArrow(pack, _BLOCKS).write.mode("errorifexists").option("compression", "uncompressed").parquet(path))


def read_token_blocks(spark: SparkSession, path: str, tokenizer: str,
                      per_block: Callable | None = None, schema: str | None = None) -> DataFrame:
    """Decode the blocks of a file: one row (doc_id, start, ids) per document.

    ``start`` counts the ids of all documents before it; a table with one row per written part and a window
    inside the part give it. ``per_block(doc_ids, lengths, ids) -> columns`` replaces the id lists.
    """
    small_batches(spark)
    totals = spark.read.parquet(path).select("part", "block", "n_ids")
    parts = totals.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.withColumn("ahead", F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).drop("ids")
    within = Window.partitionBy("part").orderBy("block")
    starts = (totals.withColumn("inside", F.sum("n_ids").over(within) - F.col("n_ids")).join(before, "part")
              .select("part", "block", (F.col("ahead") + F.col("inside")).alias("ahead")))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = byte_encoder(tokenizer).symbols
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, lengths, ids = unpack_block(batch.column(2)[i].as_buffer().to_pybytes(), symbols)
                ends = np.cumsum(lengths)
                if per_block is None:
                    rest = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                                     pa.array(ids.astype(np.int32)))]
                else:
                    rest = per_block(doc_ids, lengths, ids)
                missing = doc_ids == -2**63
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), batch.column(0)[i].as_py()), pa.int32()),
                     pa.array(np.full(len(ends), batch.column(1)[i].as_py()), pa.int32()),
                     pa.array(doc_ids, pa.int64(), mask=missing), pa.array(ends - lengths, pa.int64()), *rest],
                    ["part", "block", "doc_id", "within", *names])

    names = [f.split()[0] for f in (schema or "ids array<int>").split(", ")]
    decoded = spark.read.parquet(path).select("part", "block", "payload").mapInArrow(
        unpack, f"part int, block int, doc_id long, within long, {schema or 'ids array<int>'}")
    return (decoded.join(starts, ["part", "block"])
            .select("doc_id", (F.col("ahead") + F.col("within")).alias("start"), *names))


def _digests(doc_ids, lengths, ids) -> list[pa.Array]:
    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths)
    return [pa.array(lengths, pa.int64()),
            pa.array([zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())], pa.int64())]


def token_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token blocks of ``docs`` to the shared folder, read them back, digest every document.

    (doc_id, start, n_tokens, ids_crc32), from the ids that were read.
    """
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/token-blocks-{uuid.uuid4().hex}"
    write_token_blocks(docs, path, tokenizer, id_col, text_col)
    return read_token_blocks(spark, path, tokenizer, _digests, "n_tokens long, ids_crc32 long")
