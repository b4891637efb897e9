"""SentencePiece encoding and decoding (merge type) with seeded merge-dropout.

A text gets a blank in front, is cut before every run of blanks, and every cut piece starts as single characters. An agenda of candidate merges
(neighbours whose joined text is in the vocabulary) is worked off by score, leftmost first. A candidate is skipped for good if the keyed hash of
(seed, variant, word, where it begins, is cut and ends) falls below `dropout`. Occurrences of a word are dealt over `variants` by the hash
of their document and their place in it, so that the same word is segmented in several ways; a retried task gives the same tokens.
Without dropout the tokens are those of the vocabulary's own library.

Characters that are no piece become bytes, as does a literal U+2581, so decoding gives back every text, blanks and all. Null texts have null
tokens, empty texts none. The vocabulary is read on the driver from a path (it is never trained) and sent out; its size bounds the broadcast.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import mixed, raw, span_hashes

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED, VARIANTS = 0.1, 17, 8
#: Characters of text that are segmented together, and the longest word that is segmented together with others.
CHUNK_CHARS, LONG_WORD = 1 << 21, 48
_NEVER = np.int64(1 << 62)
_CUT = re.compile(" +[^ ]*|[^ ]+")


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[bytes, ...]  # what each id stands for, blanks as blanks
    symbol: np.ndarray  # first symbol of each code point, -1: none
    size: int  # symbols from here on are characters that are only part of pieces
    pairs: np.ndarray  # left * 2^32 + right, sorted
    merged: np.ndarray  # the joined piece
    rank: np.ndarray  # order of the joined pieces by score, equal scores have equal ranks
    byte: np.ndarray  # ids of the 256 bytes


def load_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ids = {names[i]: i for i in plain}
    symbols = dict(ids)
    for c in sorted({c for i in plain for c in names[i]} - set(ids)):
        symbols[c] = size + len(symbols) - len(ids)
    first = np.full(0x110000, -1, np.int32)
    for s, i in symbols.items():
        if len(s) == 1:
            first[ord(s)] = i
    first[ord(" ")], first[0x2581] = first[0x2581], -1
    scores = sorted({model.get_score(i) for i in plain}, reverse=True)
    order = {s: k for k, s in enumerate(scores)}
    found = sorted((symbols[p[:k]] << 32 | symbols[p[k:]], ids[p], order[model.get_score(ids[p])]) for p in ids for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
    table = np.array(found, np.int64).reshape(-1, 3)
    byte = np.zeros(256, np.int64)
    is_plain = set(plain)
    stands = [n.replace("\u2581", " ").encode() if i in is_plain else b"" for i, n in enumerate(names)]
    for i in range(size):
        if model.is_byte(i):
            value = int(names[i][3:5], 16)
            byte[value], stands[i] = i, bytes([value])
    return Vocabulary(tuple(stands), first, size, table[:, 0], table[:, 1], table[:, 2], byte)


class Segmenter:
    """Segments words; each has a key, which decides together with a candidate's place whether it is skipped."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT):
        self.v = vocabulary
        self.below = np.uint64(min(int(dropout * 2.0**64), (1 << 64) - 1))

    def candidates(self, left, right, key, begin, cut, end) -> tuple[np.ndarray, np.ndarray]:
        """Rank (`_NEVER` if there is no such merge or it is skipped) and joined symbol of neighbours."""
        v = self.v
        pair = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(v.pairs, pair), len(v.pairs) - 1) if len(v.pairs) else np.zeros(len(pair), np.int64)
        ok = (v.pairs[at] == pair) & (left >= 0) & (right >= 0) if len(v.pairs) else np.zeros(len(pair), bool)
        if self.below:
            place = (begin.astype(np.uint64) << np.uint64(42)) ^ (cut.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
            ok &= mixed(key ^ mixed(place)) >= self.below
        return np.where(ok, v.rank[at] if len(v.pairs) else 0, _NEVER), v.merged[at] if len(v.pairs) else at

    def together(self, symbols: np.ndarray, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words of one length, a row each: every round takes the best candidate of each row. Yields (rows, symbols, where they begin)."""
        n, size = symbols.shape
        rows, bounds = np.arange(n), np.tile(np.arange(size + 1), (n, 1))
        flat = lambda a: a.reshape(-1)
        ranks = joined = np.empty((n, 0), np.int64)
        if size > 1:
            wide = np.repeat(keys, size - 1)
            ranks, joined = (x.reshape(n, size - 1) for x in self.candidates(flat(symbols[:, :-1]), flat(symbols[:, 1:]), wide, flat(bounds[:, :-2]), flat(bounds[:, 1:-1]), flat(bounds[:, 2:])))
        while len(rows):
            width = symbols.shape[1]
            if width == 1:
                yield rows, symbols, bounds[:, :-1]
                return
            best = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            go = ranks[each, best] < _NEVER
            if not go.all():
                stay = ~go
                yield rows[stay], symbols[stay], bounds[stay, :-1]
                rows, symbols, bounds, ranks, joined, keys, best = rows[go], symbols[go], bounds[go], ranks[go], joined[go], keys[go], best[go]
                each = np.arange(len(rows))
                if not len(rows):
                    return
            symbols[each, best] = joined[each, best]
            drop = lambda a, at: (lambda keep: a[keep].reshape(len(a), -1))(at[:, None] != np.arange(a.shape[1]))
            symbols, bounds = drop(symbols, best + 1), drop(bounds, best + 1)
            ranks, joined = drop(ranks, best), drop(joined, best)
            for near in (best - 1, best):  # the neighbours of the new symbol
                ok = np.flatnonzero((near >= 0) & (near < width - 2))
                j = near[ok]
                ranks[ok, j], joined[ok, j] = self.candidates(symbols[ok, j], symbols[ok, j + 1], keys[ok], bounds[ok, j], bounds[ok, j + 1], bounds[ok, j + 2])

    def alone(self, symbols: np.ndarray, key: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """A long word: its candidates in a heap. Returns (symbols, where they begin)."""
        n = len(symbols)
        sym, nxt, prv, end = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        at = np.arange(n)
        ranks, joined = self.candidates(symbols[:-1], symbols[1:], np.full(n - 1, key), at[:-1], at[1:], at[1:] + 1)
        agenda = [(r, i, i + 1, i + 2, j) for i, (r, j) in enumerate(zip(ranks.tolist(), joined.tolist(), strict=True)) if r < _NEVER]
        heapq.heapify(agenda)
        while agenda:
            _, i, cut, stop, to = heapq.heappop(agenda)
            if sym[i] is None or end[i] != cut or cut >= n or sym[cut] is None or end[cut] != stop:
                continue
            sym[i], sym[cut], end[i], nxt[i] = to, None, stop, nxt[cut]
            if nxt[i] < n:
                prv[nxt[i]] = i
            near = [(a, nxt[a]) for a in (prv[i], i) if a >= 0 and nxt[a] < n]
            if near:
                a, b = np.array(near).T
                stops = np.array([end[x] for x in b.tolist()])
                r, j = self.candidates(np.array([sym[x] for x in a.tolist()]), np.array([sym[x] for x in b.tolist()]), np.full(len(a), key), a, b, stops)
                for k in range(len(a)):
                    if r[k] < _NEVER:
                        heapq.heappush(agenda, (int(r[k]), int(a[k]), int(b[k]), int(stops[k]), int(j[k])))
        begin = [i for i in range(n) if sym[i] is not None]
        return np.array([sym[i] for i in begin]), np.array(begin)

    def words(self, words: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the offsets of the words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.cumsum(sizes) - sizes
        first = self.v.symbol[code]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            if size > LONG_WORD:
                for w in own.tolist():
                    symbols, begin = self.alone(first[start[w] : start[w] + size], keys[w])
                    done.append((np.array([w]), symbols[None, :], begin[None, :]))
            else:
                done += [(own[r], s, b) for r, s, b in self.together(first[start[own][:, None] + np.arange(size)], keys[own])]
        count = np.zeros(len(words), np.int64)
        for rows, symbols, _ in done:
            count[rows] = symbols.shape[1]
        offset = np.concatenate(([0], np.cumsum(count)))
        ids, place = np.empty(offset[-1], np.int64), np.empty(offset[-1], np.int64)
        for rows, symbols, begin in done:
            to = offset[rows][:, None] + np.arange(symbols.shape[1])
            ids[to], place[to] = symbols, start[rows][:, None] + begin
        return self.as_bytes(ids, code[place], offset)

    def as_bytes(self, ids: np.ndarray, code: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace symbols that are no piece by the bytes of their character."""
        odd = (ids < 0) | (ids >= self.v.size)
        if not odd.any():
            return ids, offset
        c = code.astype(np.int64)
        n = np.where(odd, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
        to = np.concatenate(([0], np.cumsum(n)))
        which = np.repeat(np.arange(len(ids)), n)
        k = np.arange(to[-1]) - to[which]
        out, c, n = ids[which], c[which], n[which]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n] | c >> 6 * (n - 1)
        value = np.where(k == 0, np.where(n == 1, c, lead), 0x80 | (c >> 6 * (n - 1 - k)) & 0x3F)
        spelt = odd[which]
        out[spelt] = self.v.byte[value[spelt]]
        return out, to[offset]


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _doc_keys(texts: pa.Array) -> np.ndarray:
    data, off = raw(texts)
    out, full = np.zeros(len(off) - 1, np.uint64), off[1:] > off[:-1]
    out[full] = span_hashes(data, off[:-1][full], off[1:][full])
    return out


def encode_texts(segmenter: Segmenter, texts: pa.Array, seed: int = SEED, variants: int = VARIANTS) -> pa.Array:
    """Token ids of each text."""
    values, starts, out, a = texts.to_pylist(), _doc_keys(texts), [], 0
    while a < len(values):
        z, size = a, 0
        while z < len(values) and size < CHUNK_CHARS:
            size, z = size + len(values[z] or ""), z + 1
        cut = [_CUT.findall(" " + t) if t else [] for t in values[a:z]]
        count = np.fromiter(map(len, cut), np.int64, z - a)
        table = _Numbers()
        which = np.fromiter(map(table.__getitem__, chain.from_iterable(cut)), np.int64, count.sum())
        place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        dealt = mixed(np.repeat(starts[a:z], count) + place.astype(np.uint64)) % np.uint64(variants)
        distinct, back = np.unique(which * variants + dealt.astype(np.int64), return_inverse=True)
        data, off = raw(pa.array(list(table), pa.large_string()))
        own = span_hashes(data, off[:-1], off[1:]) if len(table) else np.empty(0, np.uint64)
        names = list(table)
        words = [names[i] for i in (distinct // variants).tolist()]
        keys = mixed(own[distinct // variants] + mixed((distinct % variants).astype(np.uint64) + np.uint64(seed * variants)))
        ids, offset = segmenter.words(words, keys)
        sizes = np.diff(offset)[back]
        ends = np.cumsum(sizes)
        flat = ids[np.repeat(offset[back] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(count)))]
        null = np.array([t is None for t in values[a:z]] + [False])
        out.append(pa.ListArray.from_arrays(pa.array(upto.astype(np.int32), pa.int32(), mask=null), pa.array(flat.astype(np.int32))))
        a = z
    return pa.chunked_array(out, pa.list_(pa.int32())).combine_chunks() if out else pa.array([], pa.list_(pa.int32()))


def decode_ids(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text that was encoded: pieces put together, without the blank in front."""
    return b"".join(map(vocabulary.pieces.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, keep: list[Column | str], vocabulary: Vocabulary, text_col: str = "text", dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS) -> DataFrame:
    """Columns `keep`, `ids array<int>`, and `decoded_same` (whether decoding gave the text again) for each row. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    kept = rows.drop("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(shared.value, dropout)
        for b in batches:
            texts = b.column(b.num_columns - 1)
            ids = encode_texts(segmenter, texts, seed, variants)
            same = [None if t is None else decode_ids(shared.value, i.values.to_numpy().tolist()) == t for t, i in zip(texts.to_pylist(), ids, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids, pa.array(same, pa.bool_())], [*b.schema.names[:-1], "ids", "decoded_same"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "ids array<int>, decoded_same boolean"])
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, keep: list[Column | str], vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """Columns `keep` and the `text` of each row's ids; null for null."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    chosen = rows.select(*keep, F.col(ids_col).alias("_ids"))
    kept = chosen.drop("_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode_ids(shared.value, i.values.to_numpy().tolist()) if i.is_valid else None for i in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*b.schema.names[:-1], "text"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "text string"])
    return chosen.mapInArrow(run, schema)
