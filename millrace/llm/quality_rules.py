"""Quality rules by repetition coverage: how much of a text lies inside n-grams and lines that it has had before.

Words are runs of bytes other than \\x20 and \\x09-\\x0D. Every text is read whole; null and empty texts have no words and fail the base
rule. Rows are judged one by one, so repeated rows and repeated ids each get their own row, and other columns of the input are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.words import Words, chunks, grams, mixed, span_hashes

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 50, 50, 3
#: Largest share of the characters of words that may lie in later occurrences of n-grams of this many words.
NGRAM_SHARES = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest shares of lines with a word, and of their characters, that repeat an earlier line.
LINE_SHARE, LINE_CHAR_SHARE = 0.30, 0.20

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "line_chars", "dup_line_chars")
_NGRAMS = tuple(f"dup_chars_{n}" for n in NGRAM_SHARES)
SCHEMA = ", ".join([*(f"{c} bigint" for c in (*_COUNTS, *_NGRAMS)), "base_failed boolean", "kept boolean"])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is there more than once, and whether it is a later occurrence."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    often, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    often[order], later[order] = same[1:] | same[:-1], same[:-1]
    return often, later


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside runs of n words that begin at `starts`."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _chunk(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    w = Words(data, off)
    letters = ((data & 0xC0) != 0x80) & w.inside
    row, left, size = w.row, w.left, len(w.start)
    upto = np.concatenate(([0], np.cumsum(letters, dtype=np.int64)))
    chars = upto[w.end] - upto[w.start]
    per_word = lambda x: np.bincount(row, x, len(off) - 1).astype(np.int64)
    out = {"n_words": w.count, "word_chars": w.per_row(letters), "n_symbols": w.per_row(_SYMBOL[data])}

    hashes = w.hashes()
    own = mixed(row.astype(np.uint64) + np.uint64(1))  # keeps texts apart
    at = np.flatnonzero(left >= REPEAT_WINDOW)
    often, _ = _repeats(grams(hashes, REPEAT_WINDOW)[at] ^ own[at])
    out["n_repeat_words"] = per_word(_covered(at[often], REPEAT_WINDOW, size))
    at = at[often]
    for n in NGRAM_SHARES:  # an n-gram can only repeat where its shorter head does
        at = at[left[at] >= n]
        often, later = _repeats(grams(hashes, n)[at] ^ own[at]) if len(at) else (np.zeros(0, bool),) * 2
        out[f"dup_chars_{n}"] = per_word(np.where(_covered(at[later], n, size), chars, 0))
        at = at[often]

    # lines: cut at \n and at the ends of texts
    cuts = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, off)))
    start, end = cuts[:-1], cuts[1:]
    end = end - (data[end - 1] == 10)
    words = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    start, end = start[words > 0], end[words > 0]
    owner = np.searchsorted(off, start, "right") - 1
    size_of = upto[end] - upto[start]
    _, later = _repeats(span_hashes(data, start, end) ^ mixed(owner.astype(np.uint64) + np.uint64(1)))
    per_line = lambda x: np.bincount(owner, x, len(off) - 1).astype(np.int64)
    out |= {"n_lines": per_line(np.ones(len(start))), "line_chars": per_line(size_of), "n_dup_lines": per_line(later), "dup_line_chars": per_line(np.where(later, size_of, 0))}
    return out


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """All counts and both verdicts, one entry for each text."""
    parts = [_chunk(data, off) for _, _, data, off in chunks(texts)]
    out = {c: np.concatenate([p[c] for p in parts]) if parts else np.empty(0, np.int64) for c in (*_COUNTS, *_NGRAMS)}
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    repetitive = (out["n_dup_lines"] > LINE_SHARE * out["n_lines"]) | (out["dup_line_chars"] > LINE_CHAR_SHARE * out["line_chars"])
    for n, share in NGRAM_SHARES.items():
        repetitive |= out[f"dup_chars_{n}"] > share * out["word_chars"]
    out["kept"] = ~out["base_failed"] & ~repetitive
    return out


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: its id, the counts, `base_failed` and `kept`. No shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = measure(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, found.values())], [id_col, *found])

    names = (*_COUNTS, *_NGRAMS, "base_failed", "kept")
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}").select(id_col, *names)


def keep_clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of `docs` that the rules keep, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(measure(b.column(at))["kept"]))

    return docs.mapInArrow(run, docs.schema)

