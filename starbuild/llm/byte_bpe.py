"""What the two byte-level BPE operators share: reading a tokenizer file on
the driver and cutting a text into the words inside which merges happen."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import regex

#: The published pattern that cuts text into words before the
#: merges of byte-level vocabularies.
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The printable stand-in character of every byte in a vocabulary file:
    visible Latin-1 characters stand for themselves, the other bytes take the
    code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    out = [""] * 256
    for b in own:
        out[b] = chr(b)
    for i, b in enumerate(rest):
        out[b] = chr(256 + i)
    return out


@dataclass(frozen=True)
class Vocabulary:
    """``labels[id]`` are the bytes of a token; ``merges`` are (left id,
    right id, merged id) in rank order; ``added`` maps the text of an added
    token to its id."""

    labels: list[bytes]
    merges: list[tuple[int, int, int]]
    byte_ids: list[int]
    added: dict[str, int] = field(default_factory=dict)


def read_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file (on the driver; its size is that of one
    vocabulary).  Files of another kind raise ``ValueError``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and spec.get("normalizer") is None and not model.get("dropout")
             and not model.get("ignore_merges") and not model.get("byte_fallback"))
    if not plain:
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
        raise ValueError(f"{path}: added tokens that strip or match whole words are not supported")
    alphabet = byte_alphabet()
    byte_of = {c: b for b, c in enumerate(alphabet)}
    vocab = model["vocab"]
    added = {a["content"]: a["id"] for a in spec["added_tokens"]}
    labels = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, i in vocab.items():
        labels[i] = bytes(byte_of[c] for c in token)
    for token, i in added.items():
        labels[i] = token.encode("utf-8")
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    return Vocabulary(labels, merges, [vocab[c] for c in alphabet], added)


class Splitter:
    """Cuts texts into words; the strings of added tokens stand alone."""

    def __init__(self, added: dict[str, int]):
        self.added = added
        self.find = regex.compile(SPLIT_PATTERN).findall
        longest = sorted(added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if added else None

    def parts(self, text: str) -> list[str]:
        """Stretches between added tokens and, at odd places, added tokens."""
        if self.special is None or not any(a in text for a in self.added):
            return [text]
        return self.special.split(text)
