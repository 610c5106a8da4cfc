"""Statistics of whole texts for the classifiers: byte classes, words, repeats, lines."""

from __future__ import annotations

from collections import Counter

import numpy as np

_code = np.arange(256)
UPPER = (_code >= 65) & (_code <= 90)
LOWER = (_code >= 97) & (_code <= 122)
DIGIT = (_code >= 48) & (_code <= 57)
SPACE = (_code == 32) | ((_code >= 9) & (_code <= 13))
LEAD = (_code < 128) | (_code >= 192)  # a character's first byte
WIDE = _code >= 192
STOPS = np.isin(_code, [ord(c) for c in ".,;:?'\"-()"])
SYMBOLS = (_code > 32) & (_code < 127) & ~UPPER & ~LOWER & ~DIGIT & ~STOPS & (_code != ord("!")) & (_code != ord("|"))
CONTROL = ((_code < 32) & ~SPACE) | (_code == 127)

QUALITY = [
    "log_chars", "log_words", "word_length", "upper", "digits", "spaces", "symbols_a_word", "bars_a_word", "shouts_a_word",
    "stops_a_word", "letters", "unique_words", "repeats", "top_word", "log_lines", "repeated_lines", "words_a_line", "unique_in_window",
    "longest_run", "control",
]


def byte_counts(data: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)


def quality_features(text: str | None) -> list[float]:
    """QUALITY of the whole text; a null counts as empty. Rates are a character or a word, so length alone says little."""
    data = (text or "").encode("utf-8", "replace")
    n = byte_counts(data)
    words = data.lower().split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    chars, m = max(1, int(n[LEAD].sum())), max(1, len(words))
    distinct = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:]))
    top = max(Counter(words).values()) if words else 0
    window = sum(len(set(words[i : i + 50])) for i in range(0, len(words), 50)) / len(words) if words else 1.0  # the last may be short
    letters = n[UPPER | LOWER | WIDE].sum()
    run = np.diff(np.flatnonzero(np.diff(np.frombuffer(data, dtype=np.uint8), prepend=256, append=256))).max(initial=0) if data else 0
    return [
        np.log1p(chars), np.log1p(len(words)), min(40.0, len(data) / m), n[UPPER].sum() / max(1, letters), n[DIGIT].sum() / chars, n[SPACE].sum() / chars,
        min(4.0, n[SYMBOLS].sum() / m), min(2.0, n[ord("|")] / m), min(3.0, n[ord("!")] / m), min(3.0, n[STOPS].sum() / m), letters / chars,
        distinct / m, same / m, top / m, np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(words) / max(1, len(lines))), window,
        np.log1p(run), min(1.0, n[CONTROL].sum() / chars),
    ]
