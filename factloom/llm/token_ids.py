"""Token ids of whole texts by a public byte-level BPE file, merged by tiktoken where that is proved the same.

The library of the file merges the pair that stands first in its list; tiktoken merges the pair
whose joined bytes have the least id. Both give the same ids under conditions that are shown
once from the file (``alike``):

* the ids of merged strings rise along the list, and a merge joins only strings made before it;
* no string is the result of two merges;
* a string is only given to tiktoken if its own bytes, merged by the list, end as that string.
  A stretch whose ends nothing was merged across is merged as if it stood alone, so any two
  neighbours that join to such a string are the very pair of the list; and a string for which
  this does not hold is never made by the list at all.

Both cut texts by one pattern. Characters that the two need not put in the same class of it are
looked up once; texts that hold one are left to the library, as are texts with a special
token's string and those with a stretch on which tiktoken's pattern or merging is slow.
"""

from __future__ import annotations

import json
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken

from factloom.llm.bpe import load
from factloom.llm.token_counts import PATTERN, prove

#: Texts with a longer stretch of bytes without a blank are left to the library.
STRETCH = 2_000
#: Texts of more bytes are searched for long runs of white space.
LONG = 200_000
RUN = re.compile(r"\s{2000}")


@dataclass(frozen=True)
class Alike:
    """What was shown for one file: ids by bytes, and the texts that are left to the library."""

    path: str
    ranks: dict[bytes, int]
    unlike: str
    special: tuple[str, ...]


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level files write each byte: visible Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


def merged_alone(parts: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """The parts after all merges of the list, the first in the list first, from left to right."""
    while len(parts) > 1:
        best = min(zip(parts, parts[1:]), key=lambda pair: rank.get(pair, len(rank)))
        if best not in rank:
            break
        out, k = [], 0
        while k < len(parts):
            if tuple(parts[k : k + 2]) == best:
                out.append(parts[k] + parts[k + 1])
                k += 2
            else:
                out.append(parts[k])
                k += 1
        parts = out
    return parts


def reached(vocab: dict[str, int], merges: list[tuple[str, str]], letters: dict[str, int]) -> dict[bytes, int]:
    """Ids by bytes of all single bytes and of the strings that their own merges end in."""
    made = [a + b for a, b in merges]
    ids = [vocab[m] for m in made]
    place = dict.fromkeys(letters, -1) | {m: k for k, m in enumerate(made)}
    if len(set(made)) < len(made) or any(x >= y for x, y in zip(ids, ids[1:])):
        raise ValueError("the ids of merged strings must rise along the list, each made by one merge")
    if any(place.get(part, len(made)) >= k for k, pair in enumerate(merges) for part in pair):
        raise ValueError("a merge must join strings made before it")
    rank = {pair: k for k, pair in enumerate(merges)}
    whole = [*letters, *[m for m in made if merged_alone(list(m), rank) == [m]]]
    return {bytes(letters[c] for c in s): vocab[s] for s in whole}


def _class(characters: str, name: str) -> set[str]:
    """The characters that tiktoken's regular expressions put in a class: other text gives no ids."""
    own = tiktoken.Encoding("bytes", pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    return set(bytes(own.encode_ordinary(characters)).decode())


@lru_cache(maxsize=4)
def alike(path: str) -> Alike:
    """The proof for one file; its size is bounded by the vocabulary."""
    proof = prove(path)  # the kind of file, and the characters on which library and pattern differ
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
        raise ValueError("only plain byte-level BPE files are merged by ids")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    odd = set(regex.findall(f"[{proof.unlike}]", every))
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        odd |= _class(every, name) ^ set(regex.findall(name, every))
    places = sorted(map(ord, odd))
    begins = [p for k, p in enumerate(places) if not k or places[k - 1] != p - 1]
    ends = [p for k, p in enumerate(places) if k + 1 == len(places) or places[k + 1] != p + 1]
    ranges = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(begins, ends, strict=True))
    return Alike(path, reached(model["vocab"], merges, byte_letters()), f"[{ranges}]", proof.special)


class Encoder:
    """Ids as little-endian 32-bit bytes, in one worker process."""

    def __init__(self, shown: Alike) -> None:
        self.shown = shown
        self.merge = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=shown.ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """The ids of each text; NULL counts as empty."""
        texts = pc.fill_null(texts, "")
        merge = self.merge
        return [
            self.whole(t) if w else array("I", merge(t)).tobytes()
            for t, w in zip(texts.to_pylist(), self.left(texts).tolist(), strict=True)
        ]

    def left(self, texts: pa.StringArray) -> np.ndarray:
        """Which texts are left to the library."""
        out = pc.match_substring_regex(texts, self.shown.unlike)
        for string in self.shown.special:
            out = pc.or_(out, pc.match_substring(texts, string))
        left = out.to_numpy(zero_copy_only=False).copy()
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero((sizes > STRETCH) & ~left).tolist():
            text = texts[k].as_buffer()
            blanks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 32)
            gaps = np.diff(blanks, prepend=-1, append=len(text))
            left[k] = gaps.max() > STRETCH or (len(text) > LONG and RUN.search(texts[k].as_py()) is not None)
        return left

    def whole(self, text: str) -> bytes:
        return array("I", _library(self.shown.path).encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=4)
def _library(path: str):
    return load(path)


_ENCODERS: dict[str, Encoder] = {}


def encoder(shown: Alike) -> Encoder:
    """One per worker process and file."""
    if shown.path not in _ENCODERS:
        _ENCODERS[shown.path] = Encoder(shown)
    return _ENCODERS[shown.path]
