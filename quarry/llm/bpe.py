"""BPE encoding and decoding by traversal of a prefix-sharing trie.

The distinct words of a batch form a trie; a depth-first walk (the words in sorted order, keeping what belongs to the
prefix shared with the word before) gives every prefix its state, the last token of its encoding, so a prefix that many
words share is encoded once. The last token of a prefix is the one vocabulary entry ending there that may follow the
last token of the prefix before it; a word's tokens are read off its states backwards. Two tokens may be neighbours if
no merge across their border comes before the merges that build them.

Cases: a null text counts as empty and has no ids; special tokens written out in a text are their ids, as the library
has it; one very long word is one path of the trie; repeated rows give repeated rows, an empty table none.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import documents, passes

END = "</w>"
#: Words whose ids a Python worker keeps, at most; half of them go at a time, those not met since the last such time.
KEPT_WORDS = 400_000
#: Letters that normalise to themselves or their lower case alone, and punctuation that is one word after them.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SIMPLE = rf"^[{LETTERS}]*[{re.escape(PUNCTUATION)}]*$"
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in own else next(other)) for b in range(256)]


LATIN = {ord(c): "".join(byte_letters()[b] for b in c.encode()) for c in map(chr, range(192, 256))}


def places(texts: pa.Array) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Distinct words, distinct other pieces, what each place of the texts is, and the n + 1 offsets of the texts there.

    A piece between ASCII white space of letters, then punctuation, is two places (words, lower case); any other piece
    is one, and a place that holds nothing. Places number the words, then the other pieces, then nothing.
    """
    texts = texts.cast(pa.large_string())
    lists = pc.ascii_split_whitespace(texts.fill_null("") if texts.null_count else texts)
    offsets = lists.offsets.to_numpy()
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    pieces, which = coded.dictionary, coded.indices.to_numpy()
    easy = pc.match_substring_regex(pieces, SIMPLE)
    some = pieces.filter(easy)
    ends = pc.utf8_ltrim(some, characters=ALPHABET)
    words = pa.concat_arrays([pc.utf8_lower(pc.utf8_rtrim(some, characters=PUNCTUATION)), ends]).dictionary_encode()
    other = pieces.filter(pc.invert(easy)).to_pylist()
    easy = easy.to_numpy(zero_copy_only=False)
    n = len(words.dictionary)
    both = np.full((len(pieces), 2), n + len(other), np.int64)
    both[easy] = words.indices.to_numpy().reshape(2, -1).T
    both[~easy, 0] = n + np.arange(len(other))
    return words.dictionary.to_pylist(), other, both[which].ravel(), 2 * (offsets - offsets[0])


ALPHABET = "".join(c for c in map(chr, range(256)) if re.match(f"[{LETTERS}]", c))


class TextIds:
    """Ids of whole texts from those of their distinct words; a word's ids are kept from text to text."""

    def __init__(self):
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids, as unsigned 32-bit numbers, of distinct words in byte letters."""
        raise NotImplementedError

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces that are more than a word."""
        raise NotImplementedError

    def of_words(self, words: list[str]) -> list[bytes]:
        kept, older = self.kept, self.older
        new = [w for w in words if w not in kept]
        if len(kept) + len(new) > KEPT_WORDS // 2:
            self.older = older = kept
            self.kept = kept = {}
            new = words
        out, unknown = {}, []
        for w in new:
            ids = older.get(w)
            if ids is None:
                unknown.append(w)
            else:
                out[w] = ids
        written = {w if w.isascii() else w.translate(LATIN): w for w in unknown}
        for w, ids in self.encode_words([w for w in written if w]).items():
            out[written[w]] = ids
        out[""] = b""
        codes = [out[w] if w in out else kept[w] for w in words]
        kept.update((w, ids) for w, ids in out.items() if len(w) <= 200)
        return codes

    def __call__(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids (each with the end id after it, if given), and the n + 1 offsets of the texts there."""
        words, other, at_place, at = places(texts)
        codes = [*self.of_words(words), *self.encode_pieces(other), b""]
        ids = np.frombuffer(b"".join(codes), "<u4")
        size = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        each = size[at_place]
        done = np.concatenate([[0], np.cumsum(each)])
        out = ids[np.repeat(begin[at_place] - done[:-1], each) + np.arange(done[-1])]
        offsets = done[at]
        if end is not None:
            n = len(offsets) - 1
            spaced = np.full(len(out) + n, end, "<u4")
            spaced[np.arange(len(out)) + np.repeat(np.arange(n), np.diff(offsets))] = out
            out, offsets = spaced, offsets + np.arange(n + 1)
        return out, offsets


class TrieEncoder(TextIds):
    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
            raise ValueError("a BPE vocabulary with word ends is expected")
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.text = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(END)}
        self.last = {t[: -len(END)]: i for t, i in self.vocab.items() if t.endswith(END)}
        self.heads = {t[:k] for d in (self.inner, self.last) for t in d for k in range(1, len(t) + 1)}
        self.letters = byte_letters()
        self.spines: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.steps: dict[str, tuple[str, tuple, tuple]] = {}

    def spine(self, token: int) -> tuple | None:
        """How the token's first and last part grow while it is built: [(part, merge rank)] for each; None if it is not its own encoding."""
        if token not in self.spines:
            t = self.text[token]
            parts = list(t[: -len(END)]) if t.endswith(END) and len(t) > len(END) else list(t)
            if t.endswith(END) and len(t) > len(END):
                parts[-1] += END
            first, last = [(parts[0], -1)], [(parts[-1], -1)]
            while len(parts) > 1:
                r, i = min((self.rank.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if r == 1 << 30:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                if i == 0:
                    first.append((parts[0], r))
                if i == len(parts) - 1:
                    last.append((parts[-1], r))
            self.spines[token] = (first, last) if len(parts) == 1 else None
        return self.spines[token]

    def follows(self, a: int, b: int) -> bool:
        """Whether b may come right after a (-1: the word's start) in an encoding."""
        known = self.pairs[a << 20 | b] = self._follows(a, b) if a >= 0 else self.spine(b) is not None
        return known

    def _follows(self, a: int, b: int) -> bool:
        left, right = self.spine(a), self.spine(b)
        if left is None or right is None:
            return False
        x, y = left[1], right[0]
        i = j = 0
        while True:
            across = self.rank.get((x[i][0], y[j][0]), 1 << 30)
            of_x = x[i + 1][1] if i + 1 < len(x) else 1 << 30
            of_y = y[j + 1][1] if j + 1 < len(y) else 1 << 30
            if across < of_x and across <= of_y and across < 1 << 30:
                return False
            if of_x == of_y == 1 << 30:
                return True
            if of_x <= of_y:
                i += 1
            else:
                j += 1

    def step(self, letters: str) -> tuple[str, tuple, tuple]:
        """The longest end of these letters that begins a token, and the tokens (id, length) that are an end of it, longest first:
        those within a word, and those that end one."""
        s = letters
        while s not in self.heads:
            s = s[1:]
        ends = [s[k:] for k in range(len(s))]
        out = self.steps[letters] = s, *(tuple((d[e], len(e)) for e in ends if e in d) for d in (self.inner, self.last))
        return out

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of distinct words, written in byte letters, by a walk through their trie."""
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        if len(self.steps) > 1_000_000:
            self.steps.clear()
        pairs, steps, step, follows = self.pairs, self.steps, self.step, self.follows
        out: dict[str, bytes] = {}
        before = ""
        # by prefix of the word at hand: last token, its length, and what goes on from there
        tokens, sizes, nodes = [-1], [0], [("", (), ())]
        for w in sorted(words):
            same = 0
            for x, y in zip(before, w):
                if x != y:
                    break
                same += 1
            del tokens[same + 1 :], sizes[same + 1 :], nodes[same + 1 :]
            node = nodes[-1]
            for d in range(same, len(w)):
                key = node[0] + w[d]
                node = steps.get(key) or step(key)
                for t, n in node[1]:
                    a = tokens[d + 1 - n]
                    ok = pairs.get(a << 20 | t)
                    if ok is None:
                        ok = follows(a, t)
                    if ok:
                        break
                else:
                    raise ValueError(f"no token ends at {d + 1} in {w!r}")
                tokens.append(t)
                sizes.append(n)
                nodes.append(node)
            for t, n in node[2]:
                a = tokens[len(w) - n]
                ok = pairs.get(a << 20 | t)
                if ok is None:
                    ok = follows(a, t)
                if ok:
                    break
            else:
                raise ValueError(f"no token ends {w!r}")
            ids, d = [t], len(w) - n
            while d:
                ids.append(tokens[d])
                d -= sizes[d]
            ids.reverse()
            out[w] = array("I", ids).tobytes()
            before = w
        return out

    def pieces(self, chunk: str) -> list[str | int]:
        """A piece of text without ASCII white space as words in byte letters, and ids of special tokens."""
        out: list[str | int] = []
        for part in self.cut.split(chunk) if self.cut and "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                part = "".join(c.lower() for c in unicodedata.normalize("NFC", part))
                letters = self.letters
                out += ["".join([letters[b] for b in p.encode()]) for p in PIECES.findall(part)]
            else:
                part = part.lower()
                if part.isalpha():
                    out.append(part)
                else:
                    letters = self.letters
                    out += [p if p.isprintable() else "".join([letters[ord(c)] for c in p]) for p in PIECES.findall(part)]
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        cut = [self.pieces(c) for c in pieces]
        known = self.encode_words({p for ps in cut for p in ps if isinstance(p, str)})
        return [b"".join([known[p] if isinstance(p, str) else array("I", [p]).tobytes() for p in ps]) for ps in cut]


_encoders: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    if path not in _encoders:
        _encoders[path] = TrieEncoder(path)
    return _encoders[path]


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(df: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Number of tokens and digests of ids and decoded text for each text (with keep_ids, the ids too); no shuffle."""
    path = path or default_path()
    schema = RESULT + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        written = [pa.array([f(i) for i in range(max(coder.text) + 1)], pa.large_string()) for f in (str, lambda i: coder.text.get(i, ""))]
        for b in passes(batches, text):
            ids, at = coder(b.column(text))
            columns = [b.column(key).cast(pa.int64()), pa.array(np.diff(at))]
            for names in written:
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), names.take(pa.array(ids))), pa.scalar(" ", pa.large_string()))
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in joined.cast(pa.large_binary()).to_pylist()], pa.string()))
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return df.select(key, text).mapInArrow(run, schema)


def decode_ids(ids: Iterable[int], path: str | None = None) -> str:
    """The tokens' text joined by one space, special tokens included."""
    coder = encoder(path or default_path())
    return " ".join([coder.text[i] for i in ids])


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
