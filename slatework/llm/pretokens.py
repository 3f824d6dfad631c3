"""Pre-tokens of a byte-level vocabulary: the stretches of text across which it never merges."""

from __future__ import annotations

import os
import re

import numpy as np

# The pre-tokenisation rule of the byte-level vocabulary (a fixed value), with
# white space spelled out by its Unicode property.
RULE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The same rule for the standard module, which is twice as fast, on texts that hold only ASCII, the
# letters from U+00C0 to U+024F, and signs that are neither letters, digits nor white space.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SIGNS = "\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7\u2010-\u2027\u2030-\u205e"
_LATIN_RULE = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \t-\r{_LETTERS}0-9]+"
    r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PreTokens:
    """Cuts texts into pre-tokens; the ids of a text are those of its pre-tokens in order.

    The file's added tokens (``<|endoftext|>``) are cut out first and are pieces
    of their own, as in ``tokenizers``; what lies between two of them is cut for itself.
    """

    def __init__(self, vocabulary: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self._any, self._latin = regex.compile(RULE).findall, re.compile(_LATIN_RULE).findall
        self._only_latin = re.compile(rf"[\x00-\x7f{_LETTERS}{_SIGNS}]*").fullmatch
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added) or self.tokenizer.normalizer:
            raise ValueError("added tokens that take white space or whole words, and normalizers, are not supported")
        # Leftmost first, longest first: the order in which tokenizers finds them.
        self.added = sorted((t.content for t in added if t.content), key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split if self.added else None

    def _find(self, text: str) -> list[str]:
        return self._latin(text) if text.isascii() or self._only_latin(text) else self._any(text)

    def __call__(self, text: str) -> list[str]:
        if self._cut is None or not any(token in text for token in self.added):
            return self._find(text)
        # Every second part is an added token.
        parts = self._cut(text)
        return [word for k, part in enumerate(parts) for word in ([part] if k % 2 else self._find(part))]

    def pieces(self, words: list[str]) -> list[int]:
        """Number of ids of each pre-token."""
        return [len(x.ids) for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of distinct pre-tokens one after the other, number of ids of each).

        Many are encoded as one text, joined by an added token, at whose id the result is cut.
        """
        flat, lengths = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        between = self.added[0] if self.added else None
        mark = self.tokenizer.token_to_id(between) if self.added else None
        for k in range(0, len(words), 4096):
            part = words[k : k + 4096]
            if between is None or between in part:
                encoded = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                flat.append(np.array([i for ids in encoded for i in ids], "<u4"))
                lengths.append(np.array([len(ids) for ids in encoded], np.int64))
                continue
            [encoded] = self.tokenizer.encode_batch_fast([between.join(part)], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == mark), len(ids))
            flat.append(ids[ids != mark])
            lengths.append(np.diff(ends, prepend=-1) - 1)
        return np.concatenate(flat), np.concatenate(lengths)
