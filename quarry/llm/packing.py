"""Packing: sum-of-squares online packing of tokenised documents into windows.

Each task packs the documents of its own input partition, in order, so nothing is shuffled and a lost task packs the
same again. A document's full windows are cut off first; the rest goes to the fill level h for which the sum over
levels of the squared number of windows at that level grows least (a new window is level 0; ties go to the fuller
window). At most one window for OPEN_EACH documents so far is open (OPEN_LEAST at least, OPEN_MOST at most, which bounds
memory). Where the document fits in no window and no other may be opened, it is cut: it fills up the window, and begins
one, for which the sum of squares grows least. Windows still open at the end of a task are closed: the fullest take
from the emptiest what they lack, and the last one is cut into powers of two, so nothing is padded.

Column how: `full`, a whole window of one document; `level`, where the level array placed it; `closed`, moved or cut as
the task's last open windows were closed.

Cases: a null text counts as empty and is one token, the end-of-document id; a long document spans many windows;
repeated rows are packed each; an empty table gives no rows. sequence_id is the partition's number times 2 ** 32 plus the
window's number within it.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .bpe import TextIds, default_path
from .common import documents, passes

WINDOW = 2048
END_ID = 1
OPEN_EACH, OPEN_LEAST, OPEN_MOST = 16, 4, 256
RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, how string"


class WordTokens(TextIds):
    """The library's ids of texts. It drops white space, so pieces between it are encoded apart; its model encodes each new word once."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        out = {}
        for a in range(0, len(words), 40_000):
            parts = [words[i : i + 2000] for i in range(a, min(a + 40_000, len(words)), 2000)]
            for part, e in zip(parts, self.model.encode_batch([" ".join(p) for p in parts], add_special_tokens=False)):
                ids, ends = array("I", e.ids).tobytes(), np.flatnonzero(np.diff(e.word_ids, append=-1)) * 4 + 4
                ends = ends.tolist()
                out.update(zip(part, [ids[x:y] for x, y in zip([0, *ends], ends)]))
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for a in range(0, len(pieces), 20_000):
            out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces[a : a + 20_000], add_special_tokens=False)]
        return out


class SumOfSquares:
    """The level array: how many open windows are filled to each level, and which."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.at: list[list[int]] = [[] for _ in range(window)]
        self.numbers = self.open = self.placed = 0

    def number(self) -> int:
        self.numbers += 1
        return self.numbers - 1

    def _leave(self, level: int) -> int:
        self.count[level] -= 1
        self.open -= 1
        return self.at[level].pop()

    def _enter(self, level: int, number: int) -> None:
        if level < self.window:
            self.count[level] += 1
            self.open += 1
            self.at[level].append(number)

    def place(self, size: int) -> list[tuple[int, int]]:
        """(window, tokens) for an item of 1 to window - 1 tokens: one part, or two if it is cut."""
        c, w = self.count, self.window
        self.placed += 1
        # growth of the sum of squares when a window goes from level h to h + size; a full window counts for nothing
        growth = 2 * (c[size:] - c[: w - size + 1]) + 2
        growth[-1] -= 1
        growth[c[: w - size + 1] == 0] = 1 << 60
        if self.open < min(max(self.placed // OPEN_EACH, OPEN_LEAST), OPEN_MOST):
            growth[0] = 2 * c[size] + 1
        best = w - size - int(np.argmin(growth[::-1]))
        if growth[best] < 1 << 60:
            number = self._leave(best) if best else self.number()
            self._enter(best + size, number)
            return [(number, size)]
        # windows at levels over w - size are filled up, and the rest begins one
        growth = c[1:size] - c[w - size + 1 : w]
        growth[c[w - size + 1 : w] == 0] = 1 << 60
        over = size - 1 - int(np.argmin(growth[::-1]))
        number = self._leave(w - size + over)
        other = self.number()
        self._enter(over, other)
        return [(number, size - over), (other, over)]


def pack(items: Iterator[tuple[object, np.ndarray]], window: int = WINDOW) -> Iterator[tuple]:
    """Pieces (doc, start, length, crc32, doc_tokens, sequence, offset, how) of (doc, ids) items; every id lies in one piece."""
    levels = SumOfSquares(window)
    held: dict[int, list[tuple]] = {}  # open windows: (doc, start, ids, doc_tokens, how)

    def out(number: int, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total, how in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, number, offset, how
            offset += len(ids)

    for doc, ids in items:
        total = len(ids)
        at = total - total % window
        for a in range(0, at, window):
            yield from out(levels.number(), [(doc, a, ids[a : a + window], total, "full")])
        rest = ids[at:].copy()
        if not len(rest):
            continue
        for number, n in levels.place(len(rest)):
            part, rest = rest[:n], rest[n:]
            mine = held.setdefault(number, [])
            mine.append((doc, at, part, total, "level"))
            at += n
            if sum(len(p[2]) for p in mine) == window:
                yield from out(number, held.pop(number))
    # the fullest windows take from the emptiest what they lack
    fills = {number: sum(len(p[2]) for p in pieces) for number, pieces in held.items()}
    order = sorted(held, key=lambda number: (-fills[number], number))
    while len(order) > 1:
        number = order.pop(0)
        room = window - fills[number]
        while room and order:
            giver = order[-1]
            doc, start, ids, total, _ = held[giver].pop()
            taken = ids[:room]
            held[number].append((doc, start, taken, total, "closed"))
            if len(taken) < len(ids):
                held[giver].append((doc, start + len(taken), ids[len(taken) :], total, "closed"))
            room -= len(taken)
            fills[giver] -= len(taken)
            if not fills[giver]:
                order.pop()
        if not room:
            yield from out(number, held[number])
        else:
            fills[number] = window - room
            order.append(number)
            break
    for number in order:
        pieces, left = held[number], fills[number]
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            mine = []
            while size:
                doc, start, ids, total, how = pieces.pop(0)
                if len(ids) > size:
                    pieces.insert(0, (doc, start + size, ids[size:], total, "closed"))
                    ids, how = ids[:size], "closed"
                mine.append((doc, start, ids, total, how))
                size -= len(ids)
            yield from out(number, mine)
            number = levels.number()


def pack_documents(df: DataFrame, path: str | None = None, window: int = WINDOW, key: str = "doc_id", text: str = "text", end: int = END_ID) -> DataFrame:
    """The pieces of all documents, packed partition by partition; no shuffle."""
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    path = path or default_path()
    schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in RESULT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(path)
        base = TaskContext.get().partitionId() << 32

        def items() -> Iterator[tuple[object, np.ndarray]]:
            for b in passes(batches, text, 8 << 20):
                ids, at = tokens(b.column(text), end)
                yield from zip(b.column(key).to_pylist(), (ids[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())))

        rows: list[tuple] = []
        for p in pack(items(), window):
            rows.append((*p[:5], base + p[5], *p[6:]))
            if len(rows) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return df.select(key, text).mapInArrow(run, RESULT)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
