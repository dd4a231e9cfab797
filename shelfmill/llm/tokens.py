"""Public byte-level BPE, from files named by a path."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

# Runs of Unicode white space from this length on are encoded apart: the
# vocabulary's pattern looks back from the end of a run, and the regex engine's
# stack does not hold runs of any length.
LONG_RUN = 10_000
_RUN = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % LONG_RUN)


def _file(path: str | None, name: str) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def _load(path: str | None):
    """The JSON file's vocabulary and merges as ranks: an id below the special
    ones is the rank of its byte string, so both libraries give the same ids."""
    import tiktoken

    with open(_file(path, "byte_bpe_50k.json"), encoding="utf-8") as f:
        data = json.load(f)
    # The printable stand-ins of byte-level BPE: bytes that print stand for
    # themselves, the others for code points from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of_char = {chr(b): b for b in plain} | {
        chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)
    }
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    ranks = {
        bytes(of_char[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in special
    }
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special), special


def _ordinary(encoding) -> Callable[[str], Sequence[int]]:
    """Encoder of text without special tokens, whatever its runs of white space:
    all of a run but the character before the next word is one piece."""

    def encode(text: str) -> Sequence[int]:
        if len(text) < LONG_RUN:
            return encoding.encode_ordinary(text)
        found, at = [], 0
        for run in _RUN.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            found += encoding.encode_ordinary(text[at : run.start()])
            found += encoding._encode_single_piece(text[run.start() : stop])
            at = stop
        rest = encoding.encode_ordinary(text[at:])
        return [*found, *rest] if found else rest

    return encode


def byte_bpe(path: str | None = None) -> Callable[[str], Sequence[int]]:
    """Encoder with the ids that ``tokenizers`` gives for the same file without
    added special tokens; a special token's string in a text is that token."""
    encoding, special = _load(path)
    ordinary = _ordinary(encoding)
    marks = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None

    def encode(text: str) -> Sequence[int]:
        if not marks or not marks.search(text):
            return ordinary(text)
        # Every second part is a special token.
        found = []
        for i, part in enumerate(marks.split(text)):
            found += [special[part]] if i % 2 else ordinary(part)
        return found

    return encode


def plain_bpe(path: str | None = None):
    """Encoder that reads special strings as ordinary text, and its decoder to bytes."""
    encoding, _ = _load(path)
    return _ordinary(encoding), encoding.decode_bytes


def plain_bpe_arrays(path: str | None = None):
    """Like ``plain_bpe``, into numpy arrays, with the byte string of each id in place of the decoder."""
    import numpy as np

    encoding, special = _load(path)
    ordinary = _ordinary(encoding)

    def encode(text: str):
        if len(text) < LONG_RUN:
            return encoding.encode_to_numpy(text, disallowed_special=())
        return np.array(ordinary(text), dtype=np.uint32)

    return encode, [b"" if i in special.values() else encoding.decode_single_token_bytes(i) for i in range(encoding.n_vocab)]


def pieces_bpe(path: str | None = None):
    """Encoder of a sentence-piece file, which puts a space before the text, and the byte string of each id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=str(_file(path, "piece_bpe_32k.model")))
    found = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model.encode, found
