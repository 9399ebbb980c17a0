"""Token counts without encoding most of a text.

Byte-level BPE merges within pre-tokens only, so a text's count is the sum over its
pre-tokens. Which vocabulary strings are one pre-token and encode alone as one token is
proved once with the library itself; those count one each. The rest is merged by the library,
each distinct one once per slice of text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.bpe import AT_ONCE, load, special_strings
from factloom.llm.text import slices, texts_of

#: The pre-token pattern of the byte-level BPE files. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Other characters are in no class that is known to last; texts that hold one are encoded whole.
ASSIGNED = r"[^\p{Cn}\p{Co}]"
REMEMBERED = 300_000

_COUNTERS: dict[str, Counter] = {}


@dataclass(frozen=True)
class Proof:
    """What was shown for one tokenizer file.

    ``single``: strings that are one pre-token and one token. ``unlike``: ranges of characters that
    the library and the pattern here need not put in the same class; texts that hold one are
    encoded whole, like texts that hold a special token's string.
    """

    single: frozenset[str]
    unlike: str
    special: tuple[str, ...]


@lru_cache(maxsize=4)
def prove(path: str) -> Proof:
    library = load(path)
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    if kind["pre_tokenizer"]["type"] != "ByteLevel" or kind["normalizer"] is not None or kind["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("only plain byte-level BPE files can be counted by pre-tokens")
    pattern, special = regex.compile(PATTERN), special_strings(path)
    names = {i: library.decode([i], skip_special_tokens=False) for i in library.get_vocab().values()}
    texts = {i: t for i, t in names.items() if t and t not in special and pattern.fullmatch(t)}
    found = library.encode_batch_fast(list(texts.values()), add_special_tokens=False)
    single = frozenset(t for (i, t), e in zip(texts.items(), found, strict=True) if e.ids == [i] and len(pattern.findall(t)) == 1)
    return Proof(single, _unlike(library.pre_tokenizer, pattern), tuple(special))


def _unlike(pre_tokenizer, pattern) -> str:
    """The characters, as ranges of a character class, that are unassigned or private, or for which the
    pieces of "aca", "1c1", "!c!" differ between library and pattern."""

    def differ(some: list[str]) -> bool:
        line = "".join(f"a{c}a\n1{c}1\n!{c}!\n" for c in some)
        return [b for _, (_, b) in pre_tokenizer.pre_tokenize_str(line)] != [m.end() for m in pattern.finditer(line)]

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assigned = regex.findall(ASSIGNED, "".join(every))
    odd = set(every).difference(assigned)
    for low in range(0, len(assigned), 64):
        some = assigned[low : low + 64]
        if differ(some):
            odd.update(c for c in some if differ([c]))
    places = sorted(map(ord, odd))
    begins = [p for k, p in enumerate(places) if not k or places[k - 1] != p - 1]
    ends = [p for k, p in enumerate(places) if k + 1 == len(places) or places[k + 1] != p + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(begins, ends, strict=True))


@dataclass
class Counter:
    """Counts tokens of texts in one worker process."""

    path: str
    proof: Proof
    merged: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.library = load(self.path)
        self.pieces = regex.compile(PATTERN).findall
        self.odd = re.compile(f"[{self.proof.unlike}]").search
        self.late = re.compile(f"[{self.proof.unlike[:10]}-\\U0010ffff]").search  # at or after the first odd character

    def whole(self, text: str) -> bool:
        """Whether pre-tokens are left to the library."""
        if any(s in text for s in self.proof.special):
            return True
        return not text.isascii() and self.late(text) is not None and self.odd(text) is not None

    def count(self, texts: list[str]) -> list[int]:
        single = self.proof.single
        out, open_ = [], []
        for text in texts:
            if self.whole(text):
                out.append(len(self.library.encode(text, add_special_tokens=False).ids))
                open_.append([])
                continue
            pieces = self.pieces(text)
            rest = [p for p in pieces if p not in single]
            out.append(len(pieces) - len(rest))
            open_.append(rest)
        self.merge(set(chain.from_iterable(open_)))
        merged = self.merged
        return [n + sum([merged[p] for p in rest]) for n, rest in zip(out, open_, strict=True)]

    def merge(self, needed: set[str]) -> None:
        new = list(needed.difference(self.merged))
        if len(self.merged) + len(new) > REMEMBERED:
            self.merged, new = {}, list(needed)
        for k in range(0, len(new), AT_ONCE):
            some = new[k : k + AT_ONCE]
            found = self.library.encode_batch_fast(some, add_special_tokens=False)
            self.merged.update((p, len(e.ids)) for p, e in zip(some, found, strict=True))


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``; NULL text counts as empty.

    n_tokens is what the library gives for the whole text without added tokens; a special
    token's string inside a text is one token, as is the library's default. Rows with NULL or
    repeated ids stay; other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(prove(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path, held.value)
        counter = _COUNTERS[path]
        for batch in batches:
            for some in slices(batch):
                texts = pc.fill_null(some.column("text"), "")
                yield pa.record_batch(
                    [some.column("doc_id"), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(counter.count(texts.to_pylist()), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    rows = texts_of(docs)
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
