"""Operator 9, BPE encoding and decoding with a public vocabulary file.

Encoding: the text is normalised (NFC, lower case), cut into pieces, each piece becomes a doubly linked
list of symbols, and a priority queue hands out its pairs by merge rank; an entry whose symbols have
changed since it was queued is stale and skipped.  Decoding concatenates the vocabulary strings, one
blank between tokens, as the file's (absent) decoder does.

Words repeat, so each worker keeps the ids of recent words in two tables of about ``CACHE_BYTES`` each;
words of more than ``CACHE_LENGTH`` letters are not kept.

Defined results: null or empty text: no ids, an empty string.  Repeated rows: one result each.  Very
long pieces take n log n steps.  Extra columns are ignored.  Marker strings of the vocabulary in a text
are that token, as the file's own library has it.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

CACHE_BYTES = 40 << 20
CACHE_LENGTH = 64
#: What an entry of a word table takes besides its letters.
_ENTRY_BYTES = 240
_ID_BITS = 17
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
# Fixed value: the split pattern of the vocabulary file.
_PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 is itself, the rest follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A word-end BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.strings = [""] * (1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]))
        for s, i in ids.items():
            self.strings[i] = s
        self.markers = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.markers.items():
            self.strings[i] = s
        self.inner = [ids[c] for c in byte_letters()]
        self.last = [ids[c + end] for c in byte_letters()]
        self.ranks, self.merged = {}, []       # pair of ids -> rank -> id of the merged symbol
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(ids[a] << _ID_BITS | ids[b], rank)
            self.merged.append(ids[a + b])
        self.split = regex.compile(_PIECE)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.markers, key=len, reverse=True))) + ")")
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.room = CACHE_BYTES

    def merge(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece: the least rank first, the leftmost among equals."""
        data = piece.encode()
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        n, rank_of, merged = len(symbols), self.ranks.get, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [rank << 32 | i for i in range(n - 1) if (rank := rank_of(symbols[i] << _ID_BITS | symbols[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if symbols[i] < 0 or j >= n or rank_of(symbols[i] << _ID_BITS | symbols[j]) != rank:
                continue                       # stale: one of the two was merged meanwhile
            symbols[i], symbols[j] = new, _ = merged[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(new << _ID_BITS | symbols[k])) is not None:
                    heapq.heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(symbols[h] << _ID_BITS | new)) is not None:
                heapq.heappush(queue, rank << 32 | h)
        return tuple([s for s in symbols if s >= 0])

    def _keep(self, word: str, ids: tuple[int, ...]) -> None:
        if len(word) <= CACHE_LENGTH:
            self.room -= len(word) + 8 * len(ids) + _ENTRY_BYTES
            if self.room < 0:
                self.known, self.older, self.room = {}, self.known, CACHE_BYTES
            self.known[word] = ids

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of a run without white space, kept for the next time."""
        if word in self.older:
            ids = self.older[word]
        else:
            out = []
            for piece in self.split.findall(word):
                ids = self.known.get(piece) or self.older.get(piece)
                if ids is None:
                    ids = self.merge(piece)
                    if piece != word:
                        self._keep(piece, ids)
                out.append(ids)
            ids = out[0] if len(out) == 1 else tuple(chain.from_iterable(out))
        self._keep(word, ids)
        return ids

    def _plain(self, text: str) -> list[tuple[int, ...]]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:                   # letter by letter: no special last sigma
            text = text.replace("Σ", "σ")
        text = text.lower()
        words = self.split.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()   # str.split cuts at these four, too
        found = list(map(self.known.get, words))
        if None in found:
            word = self._word
            found = [word(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
        return found

    def encode(self, text: str) -> list[int]:
        if "<|" not in text:
            return list(chain.from_iterable(self._plain(text)))
        out: list[int] = []
        for part in self.marks.split(text):
            if part in self.markers:
                out.append(self.markers[part])
            else:
                out.extend(chain.from_iterable(self._plain(part)))
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _ids(c: spans.Chunk, v: Vocabulary) -> pa.ListArray:
    raw = c.buf.tobytes()
    ids = [v.encode(raw[a:b].decode()) for a, b in zip(c.off[:-1].tolist(), c.off[1:].tolist(), strict=True)]
    off = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, int(off[-1]))))


def _texts(ids: pa.Array, strings: pa.Array) -> pa.Array:
    ids = ids.cast(pa.large_list(pa.int32()))
    tokens = pa.LargeListArray.from_arrays(ids.offsets, strings.take(ids.values), mask=ids.is_null() if ids.null_count else None)
    return pc.binary_join(tokens, pa.scalar(" ", pa.large_string())).cast(pa.string())


@lru_cache(2)
def _strings(path: str) -> pa.Array:
    """The vocabulary strings alone, by id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    found = {**{i: s for s, i in spec["model"]["vocab"].items()}, **{t["id"]: t["content"] for t in spec["added_tokens"]}}
    return pa.array([found.get(i, "") for i in range(max(found) + 1)], pa.large_string())


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    path = path or public_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in spans.chunks(batches):
            yield pa.RecordBatch.from_arrays([c.ids, _ids(c, vocabulary(path))], ["doc_id", "ids"])

    return spans.texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds the decoded text to (doc_id, ids)."""
    path = path or public_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(batch.column(1), _strings(path))], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task: (doc_id, ids, decoded)."""
    path = path or public_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        strings = pa.array(v.strings, pa.large_string())
        for c in spans.chunks(batches):
            ids = _ids(c, v)
            yield pa.RecordBatch.from_arrays([c.ids, ids, _texts(ids, strings)], ["doc_id", "ids", "decoded"])

    return spans.texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """Token counts and digests of (doc_id, ids, decoded)."""
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
