"""Word-level BPE: ids of texts by a tokenizer file, merged under segment trees, and decoding.

The file's own normalizer and pre-tokenizer, run by its library, split words into pieces; strings of the file's
added tokens are cut out before, as the library does. The merges are made here: over a piece's adjacent pairs stands a segment tree of
minima of (rank, place), whose root is the leftmost pair of lowest rank. Merging it replaces one symbol and changes three leaves, each
renewed along its path to the root, until no pair of the piece has a rank. Many pieces go through the
steps together, one tree per row of an array; a piece of more than ``SHORT`` symbols has a tree of its own.

Every step of the file treats a run of ASCII white space as a border, so texts are cut there first and each distinct word
of a task is encoded once. Words are told apart by 64-bit codes. Tasks need nothing but their rows and the file: no
shuffle, no dictionary of the whole data.

Defined results: null and empty texts, and texts of white space alone, have no ids and decode to the empty text; null ids decode to it as
well; repeated rows are encoded each; a symbol that the vocabulary lacks is left out, as the library does without an unknown
token. Input columns stay, clashing ones are replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.llm.arrowtext import AS_IS, SPACES, inserted, list_array, ranges, row_chunks, text_buffers, with_columns, words_of
from innlake.llm.bpe import spread

SHORT = 64
FOREST_ROWS = 1 << 15
CHUNK = 1 << 20
MOST_KNOWN = 450_000
NONE = np.int64(1) << 40
_WHITE = re.compile(r"\s")


class Merges:
    """The vocabulary and the ranked merges of a tokenizer file, as arrays."""

    def __init__(self, content: str):
        model = json.loads(content)["model"]
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault(self.vocab[left] << 32 | self.vocab[right], (rank, self.vocab[left + right]))
        self.pairs = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[p][0] for p in self.pairs.tolist()], np.int64)
        self.made = np.zeros(len(model["merges"]), np.int64)
        for rank, new in pairs.values():
            self.made[rank] = new
        self.by_pair = pairs

    def symbols(self, piece: str) -> list[int]:
        """Ids of a piece's letters, the last one with the mark of a word's end."""
        names = [*piece[:-1], piece[-1] + self.suffix]
        return [self.vocab[n] for n in names if n in self.vocab]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE for a pair that does not merge."""
        if not len(self.pairs):
            return np.full(len(left), NONE)
        pair = left << np.int64(32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], NONE)


def merged_forest(symbols: np.ndarray, sizes: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all, number of each) of many pieces (rows of ``symbols``, filled up to one width), a segment tree over pairs for each."""
    rows, width = symbols.shape
    leaves = 1 << (width - 1).bit_length()
    keys = np.full((rows, leaves), NONE * leaves)
    place = np.arange(width - 1)
    real = place + 1 < sizes[:, None]
    row, at = np.nonzero(real)
    rank = merges.rank(symbols[row, at], symbols[row, at + 1])
    keys[row, at] = np.where(rank < NONE, rank * leaves + at, NONE * leaves)
    tree = np.full((rows, 2 * leaves), NONE * leaves)
    tree[:, leaves:] = keys
    for node in range(leaves - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    # columns 0 and width + 1 are borders without a symbol; a symbol at place p stands in column p + 1
    after = np.tile(np.arange(1, width + 3), (rows, 1))
    before = np.tile(np.arange(-1, width + 1), (rows, 1))
    after[np.arange(rows), sizes] = width + 1
    symbol = np.zeros((rows, width + 2), np.int64)
    symbol[:, 1:-1] = symbols
    alive = np.zeros((rows, width + 2), bool)
    alive[:, 1:-1] = np.arange(width) < sizes[:, None]
    active = np.flatnonzero(tree[:, 1] < NONE * leaves)
    while len(active):
        root = tree[active, 1]
        at = root % leaves + 1
        gone = after[active, at]
        following, earlier = after[active, gone], before[active, at]
        symbol[active, at] = merges.made[root // leaves]
        alive[active, gone] = False
        after[active, at] = following
        before[active, np.minimum(following, width + 1)] = at
        tree[active, leaves + gone - 1] = NONE * leaves
        rank = np.where(following <= width, merges.rank(symbol[active, at], symbol[active, following]), NONE)
        tree[active, leaves + at - 1] = np.where(rank < NONE, rank * leaves + at - 1, NONE * leaves)
        some = earlier > 0
        rank = merges.rank(symbol[active[some], earlier[some]], symbol[active[some], at[some]])
        tree[active[some], leaves + earlier[some] - 1] = np.where(rank < NONE, rank * leaves + earlier[some] - 1, NONE * leaves)
        paths = [(active, (leaves + gone - 1) >> 1), (active, (leaves + at - 1) >> 1), (active[some], (leaves + earlier[some] - 1) >> 1)]
        for _ in range(leaves.bit_length() - 1):
            for who, node in paths:
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
            paths = [(who, node >> 1) for who, node in paths]
        active = active[tree[active, 1] < NONE * leaves]
    return symbol[alive], alive.sum(1)


def merged_long(symbols: list[int], merges: Merges) -> list[int]:
    """Ids of one piece under a segment tree of its own."""
    n, found, made = len(symbols), merges.by_pair, merges.made.tolist()
    leaves = 1 << max(0, (n - 2)).bit_length()
    none = 1 << 62
    key = lambda left, right, at: found[pair][0] * leaves + at if (pair := left << 32 | right) in found else none
    tree = [none] * (2 * leaves)
    for at in range(n - 1):
        tree[leaves + at] = key(symbols[at], symbols[at + 1], at)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def renew(at: int, value: int) -> None:
        node = leaves + at
        tree[node] = value
        while node > 1:
            node >>= 1
            low = tree[2 * node] if tree[2 * node] < tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == low:
                break
            tree[node] = low

    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    while tree[1] < none:
        rank, at = divmod(tree[1], leaves)
        gone = after[at]
        symbols[at], symbols[gone] = made[rank], -1
        following, earlier = after[gone], before[at]
        after[at] = following
        if following >= 0:
            before[following] = at
        renew(gone, none) if gone < n - 1 else None
        renew(at, key(symbols[at], symbols[following], at) if following >= 0 else none)
        if earlier >= 0:
            renew(earlier, key(symbols[earlier], symbols[at], earlier))
    return [s for s in symbols if s >= 0]


def merged(pieces: list[str], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of the pieces."""
    symbols = [merges.symbols(p) if p else [] for p in pieces]
    sizes, places, found = np.zeros(len(pieces), np.int64), [], []
    by_width: dict[int, list[int]] = {}
    for k, ids in enumerate(symbols):
        if len(ids) < 2 or len(ids) > SHORT:
            ids = merged_long(ids, merges) if len(ids) > SHORT else ids
            sizes[k] = len(ids)
            places.append(np.full(len(ids), k))
            found.append(np.array(ids, np.int64))
        else:
            by_width.setdefault(1 << (len(ids) - 1).bit_length(), []).append(k)
    for width, members in by_width.items():
        for low in range(0, len(members), FOREST_ROWS):
            part = np.array(members[low : low + FOREST_ROWS])
            length = np.array([len(symbols[k]) for k in part.tolist()], np.int64)
            filled = np.zeros((len(part), width), np.int64)
            filled[np.arange(width) < length[:, None]] = np.array([s for k in part.tolist() for s in symbols[k]], np.int64)
            ids, sizes[part] = merged_forest(filled, length, merges)
            places.append(np.repeat(part, sizes[part]))
            found.append(ids)
    order = np.argsort(np.concatenate(places), kind="stable") if places else np.empty(0, np.int64)
    return (np.concatenate(found)[order] if found else np.empty(0)).astype(np.int32), np.concatenate(([0], np.cumsum(sizes)))


class Encoder:
    """Ids of words; each distinct one is split and merged once while it is kept."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.merges = Merges(content)
        added = {t["content"]: t["id"] for t in json.loads(content)["added_tokens"]}
        self.added = added
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.hint = os.path.commonprefix([*added]) if added else ""
        self.forget()

    def forget(self) -> None:
        self.known, self.order = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.ids, self.bounds = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.of_piece = {token: k for k, token in enumerate(self.added)}
        self.piece_ids, self.piece_bounds = np.array([*self.added.values()], np.int32), np.arange(len(self.added) + 1)

    def _split(self, word: str) -> list[str]:
        """Pieces of a word; an added token is one."""
        tokenizer, out = self.tokenizer, []
        for part in self.cut.split(word) if self.cut else [word]:
            if part in self.added:
                out.append(part)
            elif part:
                out.extend([p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(part))])
        return out

    def _split_all(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """(pieces, bounds by word). Words without inner white space or added tokens go to the library as one text."""
        plain = [k for k, w in enumerate(words) if not (self.hint in w if self.hint else self.cut and self.cut.search(w)) and not _WHITE.search(w)]
        text = self.tokenizer.normalizer.normalize_str("\n".join(words[k] for k in plain))
        gaps = np.array([m.start() for m in _WHITE.finditer(text)], np.int64)
        owner, flat = [], []
        if len(gaps) == max(0, len(plain) - 1):
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            owner.append(np.array(plain, np.int64)[np.searchsorted(gaps, np.array([at for _, (at, _) in found], np.int64))] if found else np.empty(0, np.int64))
            flat = [p for p, _ in found]
        else:  # the file's rules join or add white space
            plain = []
        for k in sorted(set(range(len(words))) - set(plain)):
            some = self._split(words[k])
            owner.append(np.full(len(some), k))
            flat += some
        owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return [flat[k] for k in order.tolist()], np.searchsorted(owner[order], np.arange(len(words) + 1))

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of words not met before."""
        flat, rows = self._split_all(words)
        fresh = [p for p in dict.fromkeys(flat) if p not in self.of_piece]
        ids, bounds = merged(fresh, self.merges)
        for piece in fresh:
            self.of_piece[piece] = len(self.of_piece)
        self.piece_ids = np.concatenate([self.piece_ids, ids])
        self.piece_bounds = np.concatenate([self.piece_bounds, self.piece_bounds[-1] + bounds[1:]])
        return spread(self.piece_ids, self.piece_bounds, np.array([self.of_piece[p] for p in flat], np.int64), rows)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds by text) of texts given as bytes and offsets."""
        words = words_of(data, offsets, SPACES, AS_IS)
        if len(self.known) > MOST_KNOWN:  # start anew; only time depends on what is kept
            self.forget()
        codes, first, index = np.unique(words.codes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, codes), max(len(self.known) - 1, 0))
        old = self.known[at] == codes if len(self.known) else np.zeros(len(codes), bool)
        fresh = np.flatnonzero(~old)
        places = np.empty(len(codes), np.int64)
        places[old] = self.order[at[old]] if len(self.known) else 0
        places[fresh] = len(self.bounds) - 1 + np.arange(len(fresh))
        raw = data.tobytes()
        ids, bounds = self._new([raw[words.starts[k] : words.ends[k]].decode() for k in first[fresh].tolist()])
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
        self.known, self.order = inserted(self.known, self.order, codes[fresh], places[fresh])
        return spread(self.ids, self.bounds, places[index], words.bounds)


def _encoder(content: str, text_col: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(content)
        for batch in batches:
            data, offsets = text_buffers(batch.column(text_col))
            for low, high in row_chunks(offsets, CHUNK):
                rows = batch.slice(low, high - low)
                ids, bounds = encoder.encode(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                rows = rows if keep_text else rows.drop_columns([text_col])
                yield with_columns(rows, {"ids": list_array(pa.array(ids, pa.int32()), bounds)})

    return run


def encode(docs: DataFrame, content: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``ids``, array<int>, by the content of a tokenizer file; without ``keep_text`` the text stays behind."""
    docs = docs.drop("ids").withColumn(text_col, F.col(text_col).cast("string"))
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    return docs.mapInArrow(_encoder(content, text_col, keep_text), T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def _tokens(content: str) -> list[bytes]:
    """Every id's token as it is written in the file."""
    parsed = json.loads(content)
    names = {i: t for t, i in parsed["model"]["vocab"].items()} | {t["id"]: t["content"] for t in parsed["added_tokens"]}
    return [names.get(k, "").encode() for k in range(max(names) + 1)]


def _decoder(tokens: list[bytes], ids_col: str, pack: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(t + b" " for t in tokens), np.uint8)
        edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in tokens])))
        for batch in batches:
            lists = batch.column(ids_col)
            some = ~lists.is_null().to_numpy(zero_copy_only=False)
            sizes = np.where(some, np.diff(lists.offsets.to_numpy()), 0) if len(batch) else np.empty(0, np.int64)
            ids, bounds = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
            for low, high in row_chunks(bounds, CHUNK // 4):
                part, size = ids[bounds[low] : bounds[high]], sizes[low:high]
                length = edges[part + 1] - edges[part]
                last = np.cumsum(size)[size > 0] - 1
                length[last] -= 1  # one space between tokens, none after the last
                steps = bounds[low : high + 1] - bounds[low]
                ends = np.concatenate(([0], np.cumsum(length)))[steps]
                text = pa.py_buffer(data[ranges(edges[part], length)])
                made = {"decoded": pa.LargeStringArray.from_buffers(high - low, pa.py_buffer(ends.astype(np.int64)), text).cast(pa.string())}
                rows = batch.slice(low, high - low)
                if pack:
                    rows = rows.drop_columns([ids_col])
                    packed = pa.py_buffer(np.ascontiguousarray(part, "<u4"))
                    made |= {"packed": pa.BinaryArray.from_buffers(pa.binary(), high - low, [None, pa.py_buffer((steps * 4).astype(np.int32)), packed]),
                             "n_tokens": pa.array(size, pa.int64())}
                yield with_columns(rows, made)

    return run


def decode(docs: DataFrame, content: str, ids_col: str = "ids", pack: bool = False) -> DataFrame:
    """The documents with ``decoded``: their tokens, parted by one space, as the library writes them for a file without a decoder.

    With ``pack`` the ids turn into ``packed``, little-endian unsigned 32-bit integers, and their number ``n_tokens``.
    """
    new = [T.StructField("decoded", T.StringType())]
    new += [T.StructField("packed", T.BinaryType()), T.StructField("n_tokens", T.LongType())] if pack else []
    docs = docs.drop(*(f.name for f in new))
    kept = [f for f in docs.schema.fields if not pack or f.name != ids_col]
    return docs.mapInArrow(_decoder(_tokens(content), ids_col, pack), T.StructType([*kept, *new]))
