"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document's token ids end with a separator id. Every full window of them is a
sequence of its own; what remains is cut into pieces of at most ``piece`` ids and halves of the
rest. The pieces are dealt at random into groups of bounded size. In
a group each piece starts as a partition of the windows with one filled; the
two partitions with the largest spread are merged with opposing imbalances until one is
left, which gives nearly equal windows. If a window exceeds the capacity, the
window count rises by one and the group is packed again.

Defined cases: a NULL or empty text is the separator alone; a text of any
length is cut, never truncated; repeated rows are packed each; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradelake.llm.common import SPACE_CHARS, staged

WINDOW = 2048
PIECE = 512
LEAST = 16
SEPARATOR = 1
GROUP_TOKENS = 256 * WINDOW
CACHE_ENTRIES = 600_000
#: Longer units are encoded at each use, so that the cache stays small whatever the texts hold.
CACHED_CHARS = 64
#: Texts of so many characters together are encoded at once.
ENCODED_CHARS = 8_000_000
#: Finds what keeps a text from being plain Latin: any other character, or what could begin a special token.
_ODD = re.compile("<[|]|[^\\x20-\\x7e\\xc0-\\u017f\\n]").search
#: Finds a place to cut a long text at, which its units allow whatever the tokenizer: a single character before a space.
_CUT = re.compile("[!-~](?= )").search
# Bytes between which a text may be cut, as bits: 1 a character before white space, 2 a letter before a sign.
# Where these tables know nothing of a character, no cut is made. _STRANGE: a byte of what _ODD finds.
_BEFORE, _AFTER, _STRANGE = np.zeros((3, 256), np.uint8)
for _c in map(chr, range(128)):
    _BEFORE[ord(_c)] = ("!" <= _c <= "~") + 2 * _c.isalpha()
    _AFTER[ord(_c)] = (_c in SPACE_CHARS) + 2 * ("!" <= _c <= "~" and not _c.isalnum())
_BEFORE[128:] = 1
_STRANGE[[*range(0x0a), *range(0x0b, 0x20), 0x7f, *range(0xc0, 0xc3), *range(0xc6, 0x100)]] = 1
_WHITE = [c.encode() for c in map(chr, range(128, 0x10000)) if c.isspace()]
PIECES = "doc_id string, start long, length long, doc_tokens long, ids binary"


class _Units(dict):
    """Token bytes of a unit (a word with the space before it), made when first asked for.

    Plain Latin units go through the same vocabulary as ranks, which takes a
    tenth of the time; all others, and any that could hold a special token,
    through the tokenizer itself. Only a cache: it is emptied when full and
    results don't depend on it. ``whole`` gives the bytes of a plain Latin text without it.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None):
        super().__init__()
        self.tokenizer_path = tokenizer_path
        self.fast = self.whole = None
        if ranks_path:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(x): int(n) for x, n in map(bytes.split, f)}
            encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                         special_tokens={})
            self.fast = encoding.encode_ordinary
            self.token_len = np.zeros(max(ranks.values()) + 1, np.int64)
            self.token_len[list(ranks.values())] = list(map(len, ranks))
            self.whole = lambda text: encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        encode = Tokenizer.from_file(self.tokenizer_path).encode
        return lambda unit: encode(unit, add_special_tokens=False).ids

    def __missing__(self, unit: str) -> bytes:
        encode = self.fast if self.fast and not _ODD(unit) else self.slow
        ids = encode(unit)
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(unit) > CACHED_CHARS:
            return ids
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[unit] = ids
        return ids


def token_bytes(text: str, units: _Units) -> bytes:
    """Ids of ``text`` as little-endian 32-bit integers.

    A plain Latin text is encoded whole: finding its words costs more than encoding
    them again. Any other goes by units: the tokenizer never joins a character with the white space after it and
    takes a single space into the word that follows, so a text whose
    spaces all stand alone is the concatenation of its units.
    """
    if units.whole and not _ODD(text):
        return units.whole(text)
    parts = text.split(" ")
    first, rest = parts[0], parts[1:]
    out = [units[first]] if first else []
    held = ""
    for p in rest:
        unit = held + " " + p
        if not p or p[-1].isspace():  # the next space belongs to the same run
            held = unit
            continue
        held = ""
        out.append(units[unit])
    if held:
        out.append(units[held])
    return b"".join(out) if not (first and first[-1].isspace()) else units[text]


def encode_texts(texts: list[str], units: _Units) -> list[bytes]:
    """``token_bytes`` of each text, with every distinct word of them encoded once.

    With ranks the tokenizer splits by ``public_tokenizers.PATTERN``, where no match goes on from a letter to a sign
    or from a character that isn't white space to one that is, and none looks back: texts cut there give the ids of
    the whole. Texts that could hold a special token, and all when there are no ranks, go one by one.
    """
    alone = {i: t for i, t in enumerate(texts) if not units.whole or "<|" in t}
    raw = [b"" if i in alone else t.encode() for i, t in enumerate(texts)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in raw], dtype=np.int64)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, ends = b"", [0] * len(starts)
    if len(data):
        at = np.zeros(len(data) + 1, bool)
        at[1:-1] = _BEFORE[data[:-1]] & _AFTER[data[1:]]
        wide = np.flatnonzero(at[1:-1] & (data[:-1] >= 128))
        at[1 + wide[_is_white(data, wide)]] = False
        at[starts] = True
        at = np.flatnonzero(at)
        words = _binary(pa.utf8(), at.astype(np.int32), data).dictionary_encode()
        taken = _word_ids(words.dictionary, units).take(words.indices)
        ids = memoryview(taken.buffers()[2])
        ends = np.frombuffer(taken.buffers()[1], np.int64)[np.searchsorted(at, starts)].tolist()
    return [token_bytes(alone[i], units) if i in alone else bytes(ids[ends[i]:ends[i + 1]]) for i in range(len(texts))]


def _is_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each byte is one of ``_WHITE``."""
    tail = data[at - 2].astype(np.int64) << 16 | data[at - 1].astype(np.int64) << 8 | data[at]
    return np.logical_or.reduce([tail % 256 ** len(c) == int.from_bytes(c, "big") for c in _WHITE])


def _binary(kind: pa.DataType, ends: np.ndarray, data) -> pa.Array:
    return pa.Array.from_buffers(kind, len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _ends_and_data(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.frombuffer(words.buffers()[1], np.int32)[:len(words) + 1]
    return ends, np.frombuffer(words.buffers()[2] or b"", np.uint8)[:ends[-1]]


def _word_ids(words: pa.StringArray, units: _Units) -> pa.LargeBinaryArray:
    """Token bytes of each word.

    Plain words from white space to another character can follow each other in one text, which is encoded in one call;
    the lengths of its tokens tell where each word ends. The rest go through the units.
    """
    ends, data = _ends_and_data(words)
    first, last = data[ends[:-1]], data[ends[1:] - 1]
    joined = (_AFTER[first] & ~_AFTER[last] & 1) > np.maximum.reduceat(_STRANGE[data], ends[:-1])
    order = np.empty(len(words), np.int64)
    order[np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])] = np.arange(len(words))
    line = words.filter(pa.array(joined))
    ends, data = _ends_and_data(line)
    ids = units.whole(data.tobytes().decode())
    ends = 4 * np.searchsorted(np.cumsum(units.token_len[np.frombuffer(ids, "<u4")]), ends[1:], side="right")
    line = _binary(pa.large_binary(), np.concatenate([[0], ends]), ids)
    rest = pa.array([units[w] for w in words.filter(pa.array(~joined)).to_pylist()], pa.large_binary())
    return pa.concat_arrays([line, rest]).take(pa.array(order))


def cut(n: int, window: int, piece: int, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: full windows, then
    whole pieces, then halves of what is left, so that sizes of all kinds are there to balance with."""
    out, at = [], 0
    while at < n:
        rest = n - at
        k = window if rest >= window else piece if rest > piece else rest // 2 if rest > 2 * least else rest
        out.append((at, k))
        at += k
    return out


def _tokenize(path: str, ranks_path: str | None, window: int, piece: int, separator: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = _Units(path, ranks_path)
        end = np.array([separator], "<u4").tobytes()
        for docs in batches:
            rows, held = [], 0
            for doc_id, ids in zip(docs["doc_id"], _encoded((text or "" for text in docs["text"]), units)):
                ids += end
                n = len(ids) // 4
                for i, k in cut(n, window, piece):
                    rows.append((doc_id, i, k, n, ids[4 * i:4 * (i + k)]))
                held += len(ids)
                if held > 8_000_000:
                    yield _frame(rows)
                    rows, held = [], 0
            if rows:
                yield _frame(rows)
    return run


def _encoded(texts: Iterable[str], units: _Units) -> Iterator[bytes]:
    """Ids of each text in order, about ``ENCODED_CHARS`` of them at a time; a longer one is cut for it."""
    few, held = [], 0
    for text in texts:
        if few and held + len(text) > ENCODED_CHARS:
            yield from encode_texts(few, units)
            few, held = [], 0
        if len(text) > ENCODED_CHARS:
            yield b"".join(encode_texts([part], units)[0] for part in _parts(text))
        else:
            few.append(text)
            held += len(text)
    yield from encode_texts(few, units)


def _parts(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        found = _CUT(text, at + ENCODED_CHARS)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"])


def difference(sizes: np.ndarray, m: int) -> np.ndarray:
    """Window (0..m-1) of each piece by multiway differencing.

    A partition is held by its windows above the least filled one, fullest first: a piece alone by its size, a
    merged one by their sums and the places they had before. The other windows stay in the order they had.
    """
    n = len(sizes)
    merges, sums, held, kind = [], {}, [1] * n, np.min_scalar_type(m)
    heap = [(-s if m > 1 else 0, k) for k, s in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        x = sums.pop(a) if a >= n else sizes[a:a + 1]
        y = sums.pop(b) if b >= n else sizes[b:b + 1]
        both = np.zeros(m, np.int64)
        both[:len(x)] = x
        both[m - len(y):] += y[::-1]
        order = (-both).argsort(kind="stable")
        both = both[order]
        both -= both[-1]
        above = np.count_nonzero(both)
        k = n + len(merges)
        merges.append((a, b, order[:above].astype(kind)))
        sums[k] = both[:above].copy()
        held.append(held[a] + held[b])
        heapq.heappush(heap, (-int(both[0]), k))
    out, rest = np.zeros(n, np.int64), np.ones(m, bool)
    todo = [(heap[0][1], np.arange(m))] if n else []
    while todo:
        k, at = todo.pop()
        if k < n:
            out[k] = at[0]
            continue
        a, b, order = merges[k - n]
        merged = np.empty(m, np.int64)
        rest[order] = False
        merged[order], merged[rest] = at[:len(order)], at[len(order):]
        rest[order] = True
        parts = [(a, merged), (b, merged[::-1])]
        todo += parts if held[a] >= held[b] else parts[::-1]  # the one of fewer pieces is next, so that few wait
    return out


def pack_sizes(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of the pieces; the window count rises until no window exceeds the capacity."""
    m = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = difference(sizes, m)
        if len(sizes) == 0 or np.bincount(at, weights=sizes, minlength=m).max() <= capacity:
            return at
        m += 1


def _pack(window: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "key"], ascending=[False, True], ignore_index=True)
        at = pack_sizes(pieces["length"].to_numpy(np.int64), window)
        pieces["sequence_id"] = 2 * (pieces["bucket"] * (1 << 24) + at)
        pieces["offset"] = pieces.groupby(at)["length"].cumsum() - pieces["length"]
        return pieces[["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]]
    return run


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         piece: int = PIECE, separator: int = SEPARATOR, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian), sequence_id, offset."""
    # ids travel as text: pandas would turn a long column with NULLs into doubles
    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = staged(texts.mapInPandas(_tokenize(tokenizer_path, ranks_path, window, piece, separator), PIECES)
                    .withColumn("key", F.monotonically_increasing_id()), "pack-pieces")
    full, small = pieces.where(F.col("length") == window), pieces.where(F.col("length") < window)
    total = small.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    packed = (small.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(groups)))
              .groupBy("bucket").applyInPandas(_pack(window), PIECES + ", sequence_id long, offset long"))
    own = full.select("doc_id", "start", "length", "doc_tokens", "ids",
                      (2 * F.col("key") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(own).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
