"""Byte-level BPE word by word: what operators 3 and 6 share.

A text is split into words so that encoding each word alone and concatenating
gives exactly the encoding of the whole text: the tokenizer's own pre-tokenizer
never joins anything across a single space that stands between two non-space
characters, so such a space begins a new word. Special tokens hold no space and
stay inside one word.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

#: A space between two characters that no definition of white space includes.
_BREAK = re.compile(r"(?<=\S) (?=\S)")
#: White space other than the space and the line feed (the last one is U+3000).
_ODD_SPACES = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
#: Runs that the byte-level pre-tokenizer keeps whole and apart: letters, digits,
#: ASCII signs but ``'`` (contractions) and ``<`` (special tokens), a lone line feed.
_PART = r"[A-Za-zÀ-ÖØ-öø-ÿ]++|[0-9]++|[!-&(-/:;=-@\[-`{-~]++|\n(?!\n)"
_PARTS, _WHOLE = re.compile(_PART), re.compile(f"(?:{_PART})++")


def word_parts(word: str) -> list[str] | None:
    """Parts of a word that are encoded alone as in the word, the first one with
    the space that stands in front of the word; None for words of other characters."""
    return _PARTS.findall(word) if _WHOLE.fullmatch(word) else None


@lru_cache(maxsize=4)
def cuts_at_classes(path: str) -> bool:
    """Whether a tokenizer's words fall apart as ``word_parts`` says."""
    conf = json.loads(load_tokenizer(path).to_str())
    pre = conf.get("pre_tokenizer") or {}
    return (conf.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and conf["model"].get("dropout") is None
            and all("<" in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                    for t in conf.get("added_tokens") or []))


def split_words(text: str) -> list[str]:
    """Words of a text: joined by one space they give the text. All but the
    first are encoded with that space in front."""
    # every space is a break where none has white space beside it
    if "  " in text or " \n" in text or "\n " in text or any(c in text for c in _ODD_SPACES):
        return _BREAK.split(text)
    return text.split(" ")


@lru_cache(maxsize=4)
def begins_with_space(path: str) -> np.ndarray:
    """Of each id: whether its piece begins with a space (special tokens: no)."""
    tok = load_tokenizer(path)
    special = tok.get_added_tokens_decoder()
    vocab = tok.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values(), default=0) + 1, bool)
    out[[i for piece, i in vocab.items() if i not in special and piece.startswith(chr(256 + 32))]] = True
    return out


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a file, once per process, without truncation or
    padding; its special tokens are recognised inside texts."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_size(path: str) -> int:
    return load_tokenizer(path).get_vocab_size(with_added_tokens=True)


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for
    themselves, the other bytes for the code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def pieces(path: str) -> list[tuple[int, bytes]]:
    """(id, bytes) of every entry of the vocabulary."""
    alphabet = byte_alphabet()
    tok = load_tokenizer(path)
    special = {i for i, t in tok.get_added_tokens_decoder().items()}
    out = []
    for piece, i in tok.get_vocab(with_added_tokens=True).items():
        whole = i not in special and all(c in alphabet for c in piece)
        out.append((i, bytes(alphabet[c] for c in piece) if whole else piece.encode()))
    return sorted(out)
