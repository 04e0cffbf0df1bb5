"""Exact token counts of every prefix of a text, for byte-level BPE vocabularies.

The last token of a BPE encoding of a prefix decides everything about longer prefixes:
a sequence of tokens is the encoding of its bytes exactly if each adjacent pair is the
encoding of the pair's bytes. So for every prefix of a pre-token one table entry holds
its last token and its count, and the next entry is found by trying the tokens that end
there. Counts of pre-tokens add up to counts of text prefixes; a count at any place then
answers how long a text is, whether it fits, and where to cut it, without encoding again.

Three places need care, because a prefix may split otherwise than the whole text: inside
a run of white space, inside a contraction, and inside a special string. They get the
count of the prefix as it would be encoded alone.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from dataclasses import dataclass
from itertools import accumulate, pairwise
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from marketlane.llm.common import with_text_columns, without

# Fixed value: how byte-level BPE cuts a text before merging.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_MEMO = 500_000


def byte_characters() -> dict[str, int]:
    """The printable stand-ins that vocabulary files use for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """What a vocabulary file says; its size does not depend on the texts."""

    tokens: dict[bytes, int]
    merges: dict[tuple[bytes, bytes], int]
    specials: tuple[str, ...]
    digest: str

    @staticmethod
    def load(path: str) -> Vocabulary:
        content = Path(path).read_bytes()
        told = json.loads(content)
        model, cut = told["model"], told.get("pre_tokenizer") or {}
        plain = (
            model.get("type", "BPE") == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            and not cut.get("add_prefix_space") and told.get("normalizer") is None and not model.get("dropout")
            and not model.get("ignore_merges")
        )
        odd = [a for a in told.get("added_tokens", []) if a["lstrip"] or a["rstrip"] or a["single_word"]]
        if not plain or odd:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        of = byte_characters()

        def raw(token: str) -> bytes:
            return bytes(of[c] for c in token)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return Vocabulary(
            {raw(t): i for t, i in model["vocab"].items() if all(c in of for c in t)},
            {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)},
            tuple(a["content"] for a in told.get("added_tokens", [])),
            hashlib.sha256(content).hexdigest(),
        )


class PrefixCounter:
    """Prefix tables of pre-tokens, remembered within a task up to a fixed number."""

    def __init__(self, vocabulary: Vocabulary):
        self._number(vocabulary)
        self.cut = regex.compile(PRE_TOKENS)
        self.space = regex.compile(r"\s{2,}")
        names = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.tables: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _number(self, vocabulary: Vocabulary) -> None:
        """Tokens that an encoding can hold, with the merge that makes each.

        A token is only made by the first merge, in rank, whose two sides are its own
        encoding; others of its spelling never occur.
        """
        self.names: list[bytes] = [bytes([b]) for b in range(256)]
        self.split: list[tuple[int, int, int] | None] = [None] * 256
        self.joins: dict[tuple[int, int], int] = {}
        self._merged: dict[tuple[int, int], int] = {}
        number = {name: i for i, name in enumerate(self.names)}
        for (a, b), rank in sorted(vocabulary.merges.items(), key=lambda m: m[1]):
            left, right = number.get(a), number.get(b)
            if left is None or right is None:
                continue
            self.joins[left, right] = rank
            if a + b not in number:
                number[a + b] = len(self.names)
                self.names.append(a + b)
                self.split.append((rank, left, right))
            self._merged[left, right] = number[a + b]
        self.endings = ahocorasick.Automaton()
        for name, i in number.items():
            if self._alone(name) == [i]:
                self.endings.add_word(name.decode("latin-1"), (i, len(name)))
        self.endings.make_automaton()

    def _alone(self, data: bytes) -> list[int]:
        """A short string's encoding, by merging in rank."""
        parts = list(data)
        while len(parts) > 1:
            best = min(pairwise(parts), key=lambda p: self.joins.get(p, len(self.joins) + 1))
            if best not in self.joins:
                break
            whole = self._merged[best]
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    merged.append(whole)
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def _fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side, when each alone does.

        They do not if some merge across their border comes before the merges that built
        them: the latest merge of either side is taken back step by step, and what then
        meets at the border must not merge earlier than it.
        """
        split, joins = self.split, self.joins
        limit = len(split)
        while True:
            rank = joins.get((left, right))
            if rank is not None and rank < limit:
                return False
            own, other = split[left], split[right]
            # The later of the two merges is undone; single bytes cannot be. At equal
            # rank the border comes before a merge on its right.
            if own is not None and (other is None or own[0] > other[0]):
                limit, left = own[0], own[2]
            elif other is not None:
                limit, right = other[0] + 1, other[1]
            else:
                return True

    def byte_counts(self, data: bytes) -> list[int]:
        """Tokens of data[:i] for every i: the dynamic programme.

        The automaton names the tokens that end at each place, longest first.
        """
        count, last, pairs = [0] * (len(data) + 1), [-1] * (len(data) + 1), self.pairs
        done = 0
        for at, (token, length) in self.endings.iter(data.decode("latin-1")):
            end = at + 1
            if end == done:
                continue
            start = end - length
            if start:
                before = last[start]
                key = before << 20 | token
                known = pairs.get(key)
                if known is None:
                    if len(pairs) > 3 * _MEMO:
                        pairs.clear()
                    known = pairs[key] = self._fits(before, token)
                if not known:
                    continue
            last[end], count[end], done = token, count[start] + 1, end
        return count

    def table(self, word: str) -> bytes:
        """Counts after each code point of a pre-token, as 16-bit numbers (32-bit sums follow)."""
        found = self.tables.get(word)
        if found is None:
            if word in ("'re", "'ve", "'ll"):
                quote, rest = self.total("'"), self.total(word[1])
                counts = [quote, quote + rest, self.byte_counts(word.encode())[-1]]
            else:
                by_byte = self.byte_counts(word.encode())
                if len(by_byte) == len(word) + 1:
                    counts = by_byte[1:]
                else:
                    counts = [by_byte[e] for e in accumulate(len(c.encode()) for c in word)]
            found = array("i", counts).tobytes()
            if len(self.tables) > _MEMO:
                self.tables.clear()
            self.tables[word] = found
        return found

    def total(self, word: str) -> int:
        return int.from_bytes(self.table(word)[-4:], "little")

    def _plain(self, text: str) -> np.ndarray:
        """Counts after each code point of a text without special strings."""
        words = self.cut.findall(text)
        known = self.tables
        inner = np.frombuffer(b"".join([known.get(w) or self.table(w) for w in words]), dtype=np.int32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        totals = inner[ends - 1].astype(np.int64) if len(words) else np.zeros(0, dtype=np.int64)
        out = inner + np.repeat(np.cumsum(totals) - totals, lengths)
        for run in self.space.finditer(text):
            start, stop = run.span()
            before = out[start - 1] if start else 0
            # The run's end keeps its count unless the text ends there: the prefix does.
            out[start:stop] = before + np.frombuffer(self.table(run[0]), dtype=np.int32)
        return out

    def counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for i = 1, 2, ...: exactly as each prefix alone is encoded."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts, base, at = [], 0, 0
        for hit in self.special.finditer(text):
            own = text[at : hit.start()]
            parts.append(self._plain(own) + base)
            inside = [base + self.tokens(own + hit[0][:k]) for k in range(1, len(hit[0]))]
            base += self.tokens(own) + 1
            parts.append(np.array([*inside, base], dtype=np.int64))
            at = hit.end()
        parts.append(self._plain(text[at:]) + base)
        return np.concatenate(parts)

    def tokens(self, text: str) -> int:
        """Tokens of a whole text without special strings."""
        return sum(self.total(w) for w in self.cut.findall(text))


@dataclass(frozen=True)
class Prefixes:
    """A text's table: counts after each code point."""

    counts: np.ndarray

    @staticmethod
    def read(stored: bytes) -> Prefixes:
        return Prefixes(np.cumsum(np.frombuffer(stored, dtype=np.int16), dtype=np.int64))

    def total(self) -> int:
        return int(self.counts[-1]) if len(self.counts) else 0

    def at(self, place: int) -> int:
        """Tokens of the first ``place`` code points."""
        return int(self.counts[place - 1]) if place else 0

    def cut(self, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        fits = np.flatnonzero(self.counts <= budget)
        return int(fits[-1]) + 1 if len(fits) and budget > 0 else 0


_counters: dict[str, PrefixCounter] = {}


def _counter(vocabulary: Vocabulary) -> PrefixCounter:
    """One per Python worker, so that later tasks find the tables of earlier ones."""
    if vocabulary.digest not in _counters:
        _counters[vocabulary.digest] = PrefixCounter(vocabulary)
    return _counters[vocabulary.digest]


def _steps(counts: np.ndarray) -> bytes:
    steps = np.diff(counts, prepend=0)
    if len(steps) and np.abs(steps).max() > 32767:
        raise OverflowError("counts of neighbouring prefixes differ by more than 16 bits hold")
    return steps.astype(np.int16).tobytes()


def with_prefixes(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", column: str = "prefixes") -> DataFrame:
    """All rows plus ``column``: 16-bit differences of the prefix counts, for ``Prefixes.read``.

    Nulls and empty texts have an empty table; repeated rows have one each. A column already
    called so is replaced. Counts of neighbouring prefixes that differ by more than 32,767
    are an error.
    """

    def compute(texts: pa.Array) -> list:
        counter = _counter(vocabulary)
        return [pa.array([_steps(counter.counts(t)) if t else b"" for t in texts.to_pylist()], pa.binary())]

    return with_text_columns(without(docs, [column]), text, compute, [StructField(column, BinaryType())])


def budgets(docs: DataFrame, vocabulary: Vocabulary, limit: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``n_tokens, cut``: whole count, and where a cut at ``limit`` tokens falls.

    Both are read off the prefix table of each text; 0 for null and empty ones. A text is
    handled whole, in some 30 times its bytes.
    """

    def compute(texts: pa.Array) -> list:
        counter = _counter(vocabulary)
        tables = [Prefixes(counter.counts(t)) if t else Prefixes(np.zeros(0)) for t in texts.to_pylist()]
        return [pa.array([p.total() for p in tables]), pa.array([p.cut(limit) for p in tables])]

    docs = without(docs, [c for c in ("n_tokens", "cut") if c != text])
    fields = [StructField("n_tokens", LongType()), StructField("cut", LongType())]
    return with_text_columns(docs, text, compute, fields, keep)


def count_rows(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: UTF-8 bytes, tokens, whether they exceed ``limit``, and the cut there.

    Null and empty texts have 0 of each; repeated rows are counted each.
    """
    sized = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    )
    counted = budgets(sized, Vocabulary.load(path), limit, "text", ["doc_id", "n_bytes"])
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        F.col("cut").alias("cut_at_limit"),
    )
