"""SentencePiece encoding and decoding for merge-type (BPE) models, through a table of prefixes.

For every prefix of a text unit there is exactly one token that ends its encoding. The table keeps that
token per prefix: of the vocabulary pieces that end there (found by an automaton), it is the longest whose
pair with the token stored for the remaining shorter prefix could not have merged otherwise. The ids are
then read backwards from the last prefix. No merge queue runs over the text.

Units are a blank and the word after it: no piece spans a blank inside, except runs of blanks, whose pieces
share one lowest score and merge after everything else, from the left.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..functions.columns import c
from .stored import small_batches
from .units import UnitCache, give_back, worker_memory
from .words import chunks, gather_ragged

BLANK = "▁"
_BLANK_BYTES = BLANK.encode()
_UNKNOWN = -1               # a character outside the vocabulary: spelled in bytes, never merged
MOST_PAIRS = 1 << 18
CHUNK_BYTES = 1 << 19       # text encoded at once; a longer document is a chunk of its own
MOST_UNITS = 1 << 19        # units remembered per worker (30 MB); workers keep them after the task


class PieceModel:
    """Vocabulary of one model file with the tables that encoding and decoding need."""

    def __init__(self, path: str):
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        size = lib.vocab_size()
        text = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i) for i in range(size)]
        self.text = text
        self.ids = {text[i]: i for i in range(size) if not special[i]}
        self.score = {text[i]: lib.get_score(i) for i in range(size) if not special[i]}
        self.byte_ids = {int(text[i][3:-1], 16): i for i in range(size) if lib.is_byte(i)}
        inner = [p for p in self.ids if BLANK in p[1:]]
        if any(p.strip(BLANK) for p in inner):
            raise ValueError("pieces that span a blank inside are not supported")
        rest = [self.score[p] for p in self.ids if len(p) > 1 and p not in set(inner)]
        if inner and max(self.score[p] for p in inner) >= min(rest, default=0) or len(rest) != len(set(rest)):
            raise ValueError("runs of blanks must score below all other pieces, which must differ in score")
        # Rank of a piece as a merge result: lower merges earlier; a single character is there from the start.
        order = sorted((p for p in self.ids if len(p) > 1 and p not in set(inner)), key=lambda p: -self.score[p])
        self.rank = {self.ids[p]: k for k, p in enumerate(order)}
        self.joined = {p: self.rank[self.ids[p]] for p in order}
        self.parts: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if piece in set(inner):
                continue
            if len(piece) == 1 or self._split(piece):
                self.automaton.add_word(piece, (self.ids[piece], len(piece)))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}       # by left << 20 | right
        self.runs: dict[int, list[int]] = {}
        # Bytes below 0x80 that occur in no longer piece stand alone and may cut units.
        used = {b for p in self.ids if len(p) > 1 for b in p.encode() if b < 0x80}
        self.lone = np.array([b < 0x80 and b not in used and b != 32 for b in range(256)])
        self._decoding(size, special)

    def _split(self, piece: str) -> bool:
        """Remember the last merge that makes ``piece`` from its characters; False if merging ends elsewhere."""
        made = merge_queue(list(piece), self.score, stop=2)
        if len(made) != 2 or merge_queue(list(piece), self.score) != [piece]:
            return False
        if any(p not in self.ids for p in made):
            return False
        self.parts[self.ids[piece]] = (self.ids[made[0]], self.ids[made[1]])
        return True

    def pair_fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay side by side when the characters of both are merged together.

        Undo merges at the seam, the later one first. Two neighbours that could join earlier than either was
        used up by its own token would have done so; the leftmost of equal merges goes first.
        """
        key = left << 20 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= MOST_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        never = len(self.rank)
        left_used, right_used = never, never
        while True:
            joint = self.joined.get(self.text[left] + self.text[right])
            if joint is not None and joint < left_used and joint <= right_used:
                return False
            made_left, made_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                left, left_used = self.parts[left][1], made_left
            else:
                right, right_used = self.parts[right][0], made_right

    def word(self, unit: str) -> list[int]:
        """Ids of a unit that holds a blank at its start at most."""
        size = len(unit)
        last, width, settled = [_UNKNOWN] * (size + 1), [1] * (size + 1), -1
        fits = self.fits
        for end, (token, length) in self.automaton.iter(unit):      # at each end the longest comes first
            if end == settled:
                continue
            before = last[end + 1 - length]
            if before >= 0:
                fit = fits.get(before << 20 | token)
                if not (self.pair_fits(before, token) if fit is None else fit):
                    continue
            last[end + 1], width[end + 1], settled = token, length, end
        found: list[int] = []
        at = size
        while at:
            if last[at] == _UNKNOWN:
                found += [self.byte_ids[b] for b in reversed(unit[at - 1].encode())] if self.byte_ids else [self.unknown]
            else:
                found.append(last[at])
            at -= width[at]
        return found[::-1]

    def run(self, blanks: int) -> list[int]:
        """Ids of a run of blanks alone."""
        if blanks not in self.runs:
            self.runs[blanks] = [self.ids[p] for p in merge_queue([BLANK] * blanks, self.score)]
        return self.runs[blanks]

    def unit(self, raw: bytes) -> list[int]:
        """Ids of a unit as cut by ``spans``: blanks (as 0x20), then a word."""
        text = raw.decode()
        word = text.lstrip(" ")
        blanks = len(text) - len(word)
        if not word:
            return self.run(blanks)
        ids = self.word(BLANK + word if blanks else word)
        if blanks < 2:
            return ids
        if ids[0] == self.ids.get(BLANK):
            return self.run(blanks) + ids[1:]
        return self.run(blanks - 1) + ids

    def spans(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """Sorted cuts: before each run of blanks, around each lone byte, and at document starts."""
        b = np.frombuffer(data, np.uint8)
        cuts = np.zeros(len(b) + 1, bool)
        cuts[offsets] = True
        if len(b):
            blank = b == 32
            cuts[1:-1] |= blank[1:] & ~blank[:-1]
            lone = self.lone[b]
            cuts[:-1] |= lone
            cuts[1:] |= lone
        return np.flatnonzero(cuts)

    # ---- decoding

    def _decoding(self, size: int, special: list[bool]) -> None:
        spelled = [b"" if special[i] else self.text[i].replace(BLANK, " ").encode() for i in range(size)]
        self.is_byte = np.zeros(size, bool)
        for value, i in self.byte_ids.items():
            spelled[i] = bytes([value])
            self.is_byte[i] = True
        if self.unknown >= 0:
            spelled[self.unknown] = " ⁇ ".encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_length = np.array([len(s) for s in spelled])
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length

    def decode_all(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """UTF-8 text of each document's ids; controls vanish, one blank at the very start is dropped."""
        sizes = self.spelled_length[ids]
        flat = self.spelled[gather_ragged(self.spelled_start[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.concatenate([[0], np.cumsum(lengths)])
        out = []
        has_bytes = np.concatenate([[0], np.cumsum(self.is_byte[ids])])[at]
        for i in range(len(lengths)):
            text = flat[ends[at[i]]:ends[at[i + 1]]]
            if has_bytes[i + 1] > has_bytes[i]:
                try:
                    text.decode()
                except UnicodeDecodeError:
                    text = self._repaired(ids[at[i]:at[i + 1]])
            first = ids[at[i]:at[i + 1]]
            first = first[self.spelled_length[first] > 0][:1]
            out.append(text[1:] if len(first) and text[:1] == b" " and not self.is_byte[first[0]] and first[0] != self.unknown else text)
        return out

    def _repaired(self, ids: np.ndarray) -> bytes:
        """Runs of byte ids that are no UTF-8: each byte that starts no whole character becomes U+FFFD."""
        out, pending = [], bytearray()

        def settle():
            at = 0
            while at < len(pending):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(pending[at:at + size]).decode().encode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�".encode())
                    at += 1
            pending.clear()

        for i in ids:
            piece = self.spelled[self.spelled_start[i]:self.spelled_start[i] + self.spelled_length[i]].tobytes()
            if self.is_byte[i]:
                pending += piece
            else:
                settle()
                out.append(piece)
        settle()
        return b"".join(out)


def merge_queue(symbols: list[str], score: dict[str, float], stop: int = 1) -> list[str]:
    """Plain best-first merging down to ``stop`` symbols: highest score first, leftmost of equals.

    Used on single pieces and on runs of blanks, never on text.
    """
    texts: list[str | None] = list(symbols)
    after = [*range(1, len(texts)), -1]
    before = [*range(-1, len(texts) - 1)]
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (joint := texts[i] + texts[j]) in score:
            heapq.heappush(heap, (-score[joint], i, j, joint))

    for i in range(len(texts) - 1):
        offer(i)
    left = len(texts)
    while heap and left > stop:
        _, i, j, joint = heapq.heappop(heap)
        if texts[i] is None or texts[j] is None or after[i] != j or texts[i] + texts[j] != joint:
            continue
        texts[i], texts[j] = joint, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        left -= 1
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [t for t in texts if t is not None]


def load(path: str) -> tuple[PieceModel, UnitCache]:
    """The model and its memory of units, one per worker and file."""
    loaded = worker_memory("pieces")
    if path not in loaded:
        model = PieceModel(path)
        loaded[path] = model, UnitCache(lambda units: [model.unit(u) for u in units], MOST_UNITS)
    return loaded[path]


def encode_text(data: bytes, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents end to end, ids of each document), with begin and end ids."""
    model, cache = load(path)
    docs = len(offsets) - 1
    full = np.diff(offsets) > 0
    marked = np.full(len(data) + int(full.sum()), 32, np.uint8)         # a blank before every text that is not empty
    starts = offsets[:-1] + np.cumsum(full) - full
    marked[gather_ragged(starts + full, np.diff(offsets))] = np.frombuffer(data, np.uint8)
    bounds = np.concatenate([starts, [len(marked)]])
    data = marked.tobytes()
    cuts = model.spans(data, bounds)
    ids, lengths = cache.encode_spans(data, cuts[:-1], cuts[1:])
    sums = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(cuts, bounds)]
    sizes = np.diff(sums) + 2
    out = np.empty(len(ids) + 2 * docs, np.int64)
    ends = np.cumsum(sizes)
    out[ends - sizes], out[ends - 1] = model.begin, model.end
    out[gather_ragged(ends - sizes + 1, sizes - 2)] = ids
    return out, sizes


def _plain_blanks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The model cannot tell its blank sign from a space; write both as a space."""
    text = pc.replace_substring(batch.column(1).fill_null(""), BLANK, " ")
    return pa.RecordBatch.from_arrays([batch.column(0), text], ["id", "text"])


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row, with begin and end ids.

    A null text is empty: just the begin and end ids, decoded to an empty text. Rows keep their partition;
    nothing is shuffled. Repeated rows give repeated rows; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = load(model_path)
        for batch in map(_plain_blanks, batches):
            for rows, text in chunks(batch, "text", CHUNK_BYTES):
                ids, sizes = encode_text(text.data, text.offsets, model_path)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                                 pa.array(ids, pa.int32()))
                decoded = pa.array([t.decode(errors="replace") for t in model.decode_all(ids, sizes)], pa.string())
                yield pa.RecordBatch.from_arrays([rows.column(0), lists, decoded], ["id", "ids", "decoded"])
            give_back()

    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): as ``encode_pieces``, digested where the ids are made."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = load(model_path)
        for batch in map(_plain_blanks, batches):
            for rows, text in chunks(batch, "text", CHUNK_BYTES):
                ids, sizes = encode_text(text.data, text.offsets, model_path)
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes)
                of_ids = [hashlib.sha256(raw[4 * (e - n):4 * e]).hexdigest() for e, n in zip(ends.tolist(), sizes.tolist())]
                of_text = [hashlib.sha256(t).hexdigest() for t in model.decode_all(ids, sizes)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                                                 ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
            give_back()

    chosen = docs.select(c(id_col).cast("long").alias("id"), c(text_col).cast("string").alias("text"))
    return (chosen.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))
