"""Counts over whole texts, as one struct column.

A word is a run without ASCII white space. A null text counts as empty; all counts of an empty text are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from hardwood.llm.common import text_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 5

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_distinct n_adjacent n_symbol_runs n_upper n_lower "
    "n_digits n_exclaim n_marks n_pipes n_lines"
).split()
KIND = ", ".join(f"{name} long" for name in COUNTS)


def _member(of: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(of)] = True
    return found


def repeated_words(ids: np.ndarray, vocabulary: int, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more; exact, as windows are ranked and not hashed."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    rank, base, width = ids, vocabulary, 1
    while width < window:
        step = min(width, window - width)
        # A window of width + step words is two overlapping or adjoining windows of width words.
        joined = rank[: len(rank) - step] * np.int64(base) + rank[step:]
        values, rank = np.unique(joined, return_inverse=True)
        base, width = len(values), width + step
        if width >= 2 and len(values) == len(rank):
            return 0
    often = np.bincount(rank) > 1
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    starts = np.flatnonzero(often[rank])
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def count_words(text: bytes) -> tuple[int, int, int, int]:
    """Words, words in repeated windows, different words, and words equal to the word before."""
    words = text.split()
    if not words:
        return 0, 0, 0, 0
    known = dict.fromkeys(words)
    for number, word in enumerate(known):
        known[word] = number
    ids = np.array(list(map(known.__getitem__, words)), dtype=np.int64)
    return len(words), repeated_words(ids, len(known)), len(known), int((ids[1:] == ids[:-1]).sum())


def count_batch(texts: pa.Array) -> pa.StructArray:
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]

    def per_text(mask: np.ndarray) -> np.ndarray:
        # A batch of Arrow has fewer than 2 ** 31 bytes, or is one text of them.
        before = np.zeros(len(mask) + 1, dtype=np.int32 if len(mask) < 2**31 else np.int64)
        np.cumsum(mask, out=before[1:])
        return (before[offsets[1:]] - before[offsets[:-1]]).astype(np.int64)

    symbol = _member(SYMBOLS)[data]
    run = symbol.copy()
    run[1:] &= ~symbol[:-1]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    run[starts] = symbol[starts]
    letters = "abcdefghijklmnopqrstuvwxyz".encode()
    found = {
        "word_chars": per_text(((data & 0xC0) != 0x80) & ~_member(b" \t\n\x0b\x0c\r")[data]),
        "n_symbols": per_text(symbol),
        "n_symbol_runs": per_text(run),
        "n_upper": per_text(_member(letters.upper())[data]),
        "n_lower": per_text(_member(letters)[data]),
        "n_digits": per_text(_member(b"0123456789")[data]),
        "n_exclaim": per_text(data == ord("!")),
        "n_marks": per_text(_member(b".,;:?")[data]),
        "n_pipes": per_text(data == ord("|")),
        "n_lines": per_text(data == ord("\n")) + (np.diff(offsets) > 0),
    }
    by_word, lines = np.zeros((n, 4), dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i, text in enumerate(texts):
        text = text.as_py()
        by_word[i], lines[i] = count_words(text), duplicate_lines(text)
    found |= dict(zip(("n_words", "n_repeat_words", "n_distinct", "n_adjacent"), by_word.T))
    found["n_dup_lines"] = lines
    return pa.StructArray.from_arrays([pa.array(found[c], pa.int64()) for c in COUNTS], COUNTS)


def counted(text: Column) -> Column:
    """The struct of all counts of a text column."""

    @F.arrow_udf(KIND)
    def count(texts: pa.Array) -> pa.Array:
        return count_batch(texts)

    return count(text_of(text).cast("binary"))
