"""Byte-level BPE with word ends: encode and decode from a vocabulary file.

The merge loop keeps a contiguous array of parts and one of the ranks of
adjacent pairs per word: scan for the lowest rank (leftmost on a tie), delete
the boundary between the two parts, refresh the two neighbouring ranks.  Many
short words are scanned at once, a row each.  The scan is quadratic in the
length of a word, so words of more than ``LONG_WORD`` symbols go through a
heap over the same pairs instead; both give the same ids.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from tessera.llm.common import bounded

LONG_WORD = 64              # symbols; longer words use the heap
SCAN_ROWS = 8192            # words scanned together
SLICE = 2 << 20             # bytes of text worked on at once
GROUP_CHARS = 2_000_000     # characters encoded together
CACHE_ENTRIES = 400_000     # distinct words held per worker: about 50 MB
SHORT_WORD = 12             # longer words come back seldom and are not held
NEAR = 0x250                # below: Latin letters
NO_PAIR = 2 ** 31 - 1
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"      # ASCII without letters, numbers and white space

# White space of the vocabulary's own split pattern.
_SPACE = "\x09-\x0d\x20\x85\xa0  -     　"
# Characters at which str.split() cuts although the pattern does not call them white space.
_SPLIT_ONLY = regex.compile("[\x1c-\x1f]")
_WORDS = regex.compile(f"[^{_SPACE}]+")


def _code_points(below: int = 0x110000) -> Iterator[list[str]]:
    """All characters below a code point, some thousands at a time."""
    for start in range(0, below, 1 << 14):
        yield [chr(c) for c in range(start, min(start + (1 << 14), below)) if not 0xD800 <= c < 0xE000]


def _library_lower() -> dict[str, str]:
    """Characters whose lower case in the tokenizers library is not Python's."""
    odd = {}
    for every in _code_points():
        every = [c for c in every if c != "\n"]
        lowered = normalizers.Lowercase().normalize_str("\n".join(every)).split("\n")
        odd |= {c: low for c, low in zip(every, lowered) if c.lower() != low and ord(c) >= NEAR}
    return odd


def _library_class(name: str, below: int = 0x110000) -> str:
    """Inside of a character class with what ``name`` means to the tokenizers
    library, whose Unicode tables may be of another version than Python's."""
    split = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True)
    runs = [run for every in _code_points(below) if every for run, _ in split.pre_tokenize_str("".join(every))]
    return "".join(f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run in runs)


@lru_cache(maxsize=1)
def library_tables() -> tuple[dict[str, str], dict[tuple[str, int], str]]:
    """Odd lower cases, and letters and numbers among all characters and below NEAR."""
    return _library_lower(), {(k, n): _library_class(k, n) for k in (r"\p{L}", r"\p{N}") for n in (NEAR, 0x110000)}


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte value."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class HeldWords(dict):
    """Ids of words in two generations of half of ``CACHE_ENTRIES`` each: a word
    met again moves to the young one, and the old one is dropped when the young
    one is full.  A word not held gets a place that is filled when its group of
    texts is merged."""

    def __init__(self):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.places: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytes | bytearray:
        if (ids := self.old.get(word)) is not None:
            self[word] = ids
            return ids
        return self.places.setdefault(word, bytearray())

    def turn(self) -> None:
        if len(self) > CACHE_ENTRIES // 2:
            self.old = dict(self)
            self.clear()


class WordBpe:
    """Tokenizer built from the text of a ``tokenizers`` JSON file whose model
    is BPE with an end-of-word suffix and a byte-level alphabet."""

    def __init__(self, spec: str, tables: tuple | None = None):
        self.lower, classes = tables or library_tables()
        spec = json.loads(spec)
        model = spec["model"]
        vocab = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.specials.values()])
        tokens = [""] * size
        for token, i in [*vocab.items(), *self.specials.items()]:
            tokens[i] = token
        self.size = size
        self.tokens = [t.encode() for t in tokens]
        rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        self.merged = np.array([new for _, _, new in rules], np.int32)
        self.pairs = {(a, b): rank for rank, (a, b, _) in reversed([*enumerate(rules)])}
        self.key_type = np.uint32 if size < 1 << 16 else np.int64
        keys = np.array([a * size + b for a, b in self.pairs], self.key_type)
        order = keys.argsort()
        self.pair_keys, self.pair_ranks = keys[order], np.array([*self.pairs.values()], np.int32)[order]
        alphabet = _byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int32)
        self.last = np.array([vocab[c + suffix] for c in alphabet], np.int32)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        letters, numbers = classes[r"\p{L}", 0x110000], classes[r"\p{N}", 0x110000]
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\p{L}", letters).replace(r"\p{N}", numbers)
                                    .replace(r"\s", _SPACE))
        # the same for words of code points below NEAR, and for those words with "\n" between them
        near = {k: classes[k, NEAR] for k in (r"\p{L}", r"\p{N}")}
        self.near_pieces = re.compile("\n|" + split["pattern"]["Regex"].replace(r"[\p{L}]", f"[{near[r'\p{L}']}]")
                                      .replace(r"[\p{N}]", f"[{near[r'\p{N}']}]")
                                      .replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACE}{near[r'\p{L}']}{near[r'\p{N}']}]"))
        self.far = re.compile(f"[^\\x00-\\U{NEAR - 1:08x}]")
        # characters below NEAR that Python and the library do not both call letters, or both not
        letter = re.compile(f"[{near[r'\p{L}']}]")
        doubtful = [c for c in map(chr, range(NEAR)) if c.isalpha() != bool(letter.match(c))]
        self.unsure = re.compile(f"[^\\x00-\\U{NEAR - 1:08x}]" + "".join(f"|{re.escape(c)}" for c in doubtful))
        self.odd_lower = re.compile(f"[{''.join(map(re.escape, self.lower))}]") if self.lower else None
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        self.dtype = np.dtype("<u4" if size > 1 << 16 else "<u2")
        self._cache = HeldWords()

    # ------------------------------------------------------------ merge loop

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every adjacent pair; NO_PAIR where the two parts never merge."""
        key = left.astype(self.key_type) * self.key_type(self.size) + right.astype(self.key_type)
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], np.int32(NO_PAIR))

    def _merge_scan(self, parts: np.ndarray) -> list[bytes]:
        """The scan for many short words at once, one word per row, ended by -1.

        Each round scans every row's ranks for its minimum, deletes that
        boundary (the rows move up by one) and refreshes the two ranks beside
        the new part.  A row without a mergeable pair is done.
        """
        done: list[bytes] = [b""] * len(parts)
        row = np.arange(len(parts))
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        while True:
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(row), int)
            low = ranks[np.arange(len(row)), at] if ranks.shape[1] else np.full(len(row), NO_PAIR)
            over = low == NO_PAIR
            if over.any():
                ended = parts[over]
                sizes = (ended >= 0).sum(1)
                flat = ended[ended >= 0].astype(self.dtype).tobytes()
                ends = (sizes.cumsum() * self.dtype.itemsize).tolist()
                for r, start, end in zip(row[over].tolist(), [0, *ends], ends):
                    done[r] = flat[start:end]
                keep = ~over
                parts, ranks, row, at, low = parts[keep], ranks[keep], row[keep], at[keep], low[keep]
                if not len(row):
                    return done
            line = np.arange(len(row))
            parts[line, at] = self.merged[low]
            stays = np.arange(parts.shape[1]) != at[:, None] + 1
            parts, ranks = parts[stays].reshape(len(row), -1), ranks[stays[:, 1:]].reshape(len(row), -1)
            before, behind = at > 0, at < ranks.shape[1]
            r, i = np.concatenate([line[before], line[behind]]), np.concatenate([at[before] - 1, at[behind]])
            ranks[r, i] = self._ranks(parts[r, i], parts[r, i + 1])

    def _merge_heap(self, parts: list[int]) -> bytes:
        n = len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        alive = [True] * n
        pair = self.pairs.get
        heap = [(rank, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (rank := pair((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i] = new = int(self.merged[rank])
            alive[j] = False
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (rank := pair((new, parts[k]))) is not None:
                    heapq.heappush(heap, (rank, i, new, parts[k]))
            if (h := before[i]) >= 0 and (rank := pair((parts[h], new))) is not None:
                heapq.heappush(heap, (rank, h, parts[h], new))
        return np.array([p for p, kept in zip(parts, alive) if kept], self.dtype).tobytes()

    def merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of every piece: short ones together by length, long ones through the heap."""
        raw = [p.encode() for p in pieces]
        sizes = np.array([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = sizes.cumsum() - sizes
        out: list[bytes] = [b""] * len(raw)
        low = 0
        for high in (8, 16, 32, LONG_WORD):
            group = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for start in range(0, len(group), SCAN_ROWS):
                some = group[start:start + SCAN_ROWS]
                n, first = sizes[some], starts[some]
                place = np.arange(n.max())
                parts = np.where(place < n[:, None], self.inner[data.take(first[:, None] + place, mode="clip")], np.int32(-1))
                parts[np.arange(len(some)), n - 1] = self.last[data[first + n - 1]]
                for i, ids in zip(some.tolist(), self._merge_scan(parts)):
                    out[i] = ids
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            out[i] = self._merge_heap([*self.inner[np.frombuffer(raw[i][:-1], np.uint8)].tolist(),
                                       int(self.last[raw[i][-1]])])
        return out

    # ------------------------------------------------------------ text <-> ids

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words (runs without white space, already normalised)."""
        # Letters are one piece, and so are marks behind them.
        unsure = self.unsure.search
        letters, marked, rest = [], [], []
        for w in words:
            stem = w if w.isalpha() else w.rstrip(MARKS)
            if not stem.isalpha() or not stem.isascii() and unsure(stem):
                rest.append(w)
            elif stem is w:
                letters.append(w)
            else:
                marked.append((w, stem, w[len(stem):]))
        far = self.far.search
        plain, other = [], []
        for w in rest:
            (other if far(w) else plain).append(w)
        # white space never joins a piece, so all plain words are split in one call
        cut, pieces = [], []
        for p in self.near_pieces.findall("\n".join(plain)) if plain else ():
            if p == "\n":
                cut.append(pieces)
                pieces = []
            else:
                pieces.append(p)
        if plain:
            cut.append(pieces)
        cut += [self.pieces.findall(w) for w in other]
        pieces = {p for ps in cut for p in ps}
        for _, stem, mark in marked:
            pieces.add(stem)
            pieces.add(mark)
        # a piece is cut the same way when it is a word, so a held word's ids are the piece's
        young, old = self._cache.get, self._cache.old.get
        ids = {p: x for p in pieces if (x := young(p) or old(p))}
        pieces.update(letters)
        pieces = [p for p in pieces if p not in ids]
        ids.update(zip(pieces, self.merge(pieces)))
        known = {w: ids[w] for w in letters}
        known.update([(w, ids[stem] + ids[mark]) for w, stem, mark in marked])
        return known | {w: ids[ps[0]] if len(ps) == 1 else b"".join([ids[p] for p in ps]) for w, ps in zip(plain + other, cut)}

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # each character on its own: no special form of a final sigma
            if "Σ" in text or self.odd_lower and self.far.search(text) and self.odd_lower.search(text):
                text = "".join([self.lower.get(c) or c.lower() for c in text])
            else:
                text = text.lower()
        else:
            text = text.lower()
        return _WORDS.findall(text) if _SPLIT_ONLY.search(text) else text.split()

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        held = self._cache
        held.turn()
        held.places = places = {}
        find = held.__getitem__
        coded = []      # per text: ids, or places of ids, of its words and special tokens
        for text in texts:      # a text's words are let go before the next one is cut
            if any(s in text for s in self.specials):
                found = []
                for p in self.special_split.split(text):
                    if p in self.specials:
                        found.append(np.array([self.specials[p]], self.dtype).tobytes())
                    else:
                        found += map(find, self._words(p))
                coded.append(found)
            else:
                coded.append(list(map(find, self._words(text))))
        new = self._learn(list(places))
        for w, place in places.items():
            place[:] = new[w]
        held.update([(w, x) for w, x in new.items() if len(w) <= SHORT_WORD])
        return [b"".join(found) for found in coded]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``self.dtype``; texts are
        taken in groups of about ``GROUP_CHARS`` so that memory follows a group.
        Words and ids form no cycles, so the cycle collector rests meanwhile."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode_groups(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_groups(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        group, chars = [], 0
        for text in texts:
            group.append(text or "")
            chars += len(group[-1])
            if chars > GROUP_CHARS:
                out += self._encode_some(group)
                group, chars = [], 0
        return out + self._encode_some(group)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_all([text])[0], self.dtype)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text: tokens joined by one space, as a vocabulary file without a decoder asks for."""
        tokens = self.tokens
        return b" ".join([tokens[i] for i in ids.tolist()])

    def decode(self, ids) -> str:
        return self.decode_bytes(np.asarray(ids, np.int64)).decode()


_tokenizers: dict[str, WordBpe] = {}


class Vocabulary:
    """A vocabulary file read once on the driver and broadcast with the
    library's character tables (a few MB, fixed by the file); each Python worker
    builds its tokenizer once and holds one."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            self._shared = spark.sparkContext.broadcast((f.read(), library_tables()))

    def tokenizer(self) -> WordBpe:
        spec, tables = self._shared.value
        if spec not in _tokenizers:
            _tokenizers.clear()
            _tokenizers[spec] = WordBpe(spec, tables)
        return _tokenizers[spec]


def encode(docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the token ids of every whole text as an array of integers.

    A null or empty text, or one of white space only, has no ids.  Repeated
    rows give repeated rows; other columns are not read.
    """
    def run(batches):
        bpe = vocabulary.tokenizer()
        for batch in bounded(batches, 1, SLICE):
            coded = bpe.encode_all(batch.column(1).to_pylist())
            ids = [np.frombuffer(c, bpe.dtype).astype(np.int32) for c in coded]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(coded: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)``: the text of every list of ids (null: empty)."""
    def run(batches):
        bpe = vocabulary.tokenizer()
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = coded.schema[id_col].dataType.simpleString()
    out = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("i")).mapInArrow(run, f"id {kind}, text string")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids, decoded)`` with ids as binary little-endian
    unsigned 32-bit integers and the decoded text in UTF-8: ``encode`` then
    ``decode`` in one pass over the text, without a list per document in
    between.  Same rules for nulls, empty texts and repeated rows."""
    def run(batches):
        bpe = vocabulary.tokenizer()
        for batch in bounded(batches, 1, SLICE):
            n, coded, decoded = [], [], []
            for c in bpe.encode_all(batch.column(1).to_pylist()):
                ids = np.frombuffer(c, bpe.dtype)
                n.append(len(ids))
                coded.append(ids.astype("<u4").tobytes())
                decoded.append(bpe.decode_bytes(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.binary()), pa.array(decoded, pa.binary())],
                ["id", "n_tokens", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"id {kind}, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def digest(binary: Column) -> Column:
    return F.sha2(binary, 256)
