"""Secrets in texts: fixed patterns, and strings that look drawn at random.

Every maximal run of 20 or more letters, digits and ``+ / _ -`` is put to a battery under
the smallest usual encoding that holds its characters: chi-squared uniformity over the
encoding's alphabet, Wald-Wolfowitz runs about the alphabet's middle, and lag-one serial
correlation. A run is consistent with a random key if Fisher's combination of the three
p-values is at least ``random_level``.

That alone says little about short runs. So each run also gets the probability that
characters drawn as the corpus uses them (byte counts over all documents) give so even a
string; it falls with the length of a true key. Benjamini-Hochberg control over all runs
of the corpus, by length class, decides which are reported: short runs are judged among
short ones, where chance evenness is common. Probabilities are rounded up to twentieths
of a decade, so that counts per step, not the runs themselves, decide the threshold.

A run that fixed patterns cover only in part is judged by the rest, put together, where
that has ``least_rest`` characters, otherwise as a whole; it is reported as a whole.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from marketlane.llm.common import fresh_name, raw_bytes, slices, with_text_columns, without

# Kinds, in the order in which spans at one place are listed.
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")

_DIGIT, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Usual encodings, smaller alphabets first.
ENCODINGS = (
    ("decimal", _DIGIT),
    ("hex", _DIGIT + "abcdef"),
    ("hex_upper", _DIGIT + "ABCDEF"),
    ("lower", _LOWER),
    ("upper", _UPPER),
    ("base32", _UPPER + "234567"),
    ("base36", _DIGIT + _LOWER),
    ("base36_upper", _DIGIT + _UPPER),
    ("letters", _UPPER + _LOWER),
    ("base62", _DIGIT + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
    ("any", _UPPER + _LOWER + _DIGIT + "+/-_"),
)

SPAN = StructType(
    [StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]
)
RUN = StructType(
    [
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("stratum", IntegerType()),
        StructField("step", IntegerType()),
    ]
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_ARROW_RUNS = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("stratum", pa.int32()), ("step", pa.int32())])
)


@dataclass(frozen=True)
class Battery:
    random_level: float = 0.01
    discovery: float = 0.01
    lengths: tuple[int, ...] = (24, 32, 40, 48, 64, 128)
    steps_per_decade: int = 20
    least_rest: int = 16


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns in code points, by start, then kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=_place)


def _place(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def uncovered(
    runs: list[tuple[int, int]], spans: list[tuple[str, int, int]]
) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Runs that base spans do not cover from end to end, with the pieces left open.

    Both lists go by start; one pass over both.
    """
    joined: list[list[int]] = []
    for _, start, end in spans:
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    out, at = [], 0
    for start, end in runs:
        pieces, place = [], start
        while at < len(joined) and joined[at][0] < end:
            left, right = joined[at]
            if left > place:
                pieces.append((place, left))
            place = max(place, right)
            if right > end:
                break
            at += 1
        if place < end:
            pieces.append((place, end))
        if pieces:
            out.append((start, end, pieces))
    return out


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def infer(run: str) -> str:
    used = set(run)
    return next(alphabet for _, alphabet in ENCODINGS if used <= set(alphabet))


def battery(run: str, alphabet: str) -> tuple[float, float, float]:
    """p-values of evenness, runs and serial correlation for a uniform random string."""
    n, size = len(run), len(alphabet)
    index = {c: i for i, c in enumerate(alphabet)}
    x = np.array([index[c] for c in run], dtype=np.float64)
    chi = _evenness(x.astype(np.int64), size)
    spread = math.sqrt(2.0 * (size - 1) * (n - 1) / n)
    even = _normal_tail((chi - (size - 1)) / spread)

    high = x >= size / 2
    ones = int(high.sum())
    zeros = n - ones
    if ones and zeros:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2.0 * ones * zeros / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        alternation = 2 * _normal_tail(abs(runs - mean) / math.sqrt(var))
    else:
        alternation = 2.0 ** (1 - n)
    centred = x - x.mean()
    whole = float((centred * centred).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / whole if whole else 1.0
    correlation = 2 * _normal_tail(abs(serial + 1.0 / n) * math.sqrt(n))
    return even, min(1.0, alternation), min(1.0, correlation)


def fisher(values: tuple[float, ...]) -> float:
    """Combined p-value; the chi-squared tail with an even number of degrees."""
    half = -sum(math.log(max(v, 1e-300)) for v in values)
    term = total = 1.0
    for i in range(1, len(values)):
        term *= half / i
        total += term
    return min(1.0, math.exp(-half) * total)


def _evenness(x: np.ndarray, size: int) -> float:
    counts = np.bincount(x, minlength=size).astype(np.float64)
    return float((counts * counts).sum()) * size / len(x) - len(x)


def as_text(run: str, alphabet: str, usage: np.ndarray) -> float:
    """Probability that so even a string comes from characters as the corpus uses them.

    The number of equal pairs of positions has a known mean and variance when characters
    are drawn with the corpus shares within the alphabet.
    """
    n = len(run)
    share = usage[[ord(c) for c in alphabet]]
    share = share / share.sum()
    second, third = float((share**2).sum()), float((share**3).sum())
    counts = np.array([run.count(c) for c in set(run)], dtype=np.float64)
    pairs = float((counts * (counts - 1)).sum()) / 2
    mean = n * (n - 1) / 2 * second
    var = n * (n - 1) / 2 * (second - second**2) + n * (n - 1) * (n - 2) * (third - second**2)
    return _normal_tail((mean - pairs - 0.5) / math.sqrt(max(var, 1e-9)))


def usage_of(docs: DataFrame, text: str) -> np.ndarray:
    """Share of each byte over all texts, with one added to each count."""
    source = docs.select(text)

    def run(batches):
        seen = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                part = batch.column(0).slice(start, stop - start).fill_null("")
                seen += np.bincount(raw_bytes(part)[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(seen)], names=["byte", "n"])

    out = np.ones(256)
    for byte, n in source.mapInArrow(run, "byte bigint, n bigint").groupBy("byte").agg(F.sum("n")).collect():
        out[byte] += n
    return out / out.sum()


def with_findings(
    docs: DataFrame, usage: np.ndarray, rules: Battery, text: str, base: str, runs: str, keep: list[str]
) -> DataFrame:
    """The kept columns plus base spans and tested runs of every text."""
    edges = np.array(rules.lengths)

    def step(run: str) -> int:
        alphabet = infer(run)
        if fisher(battery(run, alphabet)) < rules.random_level:
            return 0
        chance = as_text(run, alphabet, usage)
        return int(math.floor(-math.log10(max(chance, 1e-300)) * rules.steps_per_decade))

    def compute(texts: pa.Array) -> list:
        bases, tested = [], []
        for value in texts.to_pylist():
            spans = base_spans(value)
            bases.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            own = []
            for start, end, pieces in uncovered([m.span() for m in _RUN.finditer(value)], spans):
                # What a base span leaves of a key speaks for the key, if it is long enough.
                rest = "".join(value[a:b] for a, b in pieces)
                tried = rest if len(rest) >= rules.least_rest else value[start:end]
                own.append(
                    {"start": start, "end": end, "step": step(tried),
                     "stratum": int(np.searchsorted(edges, len(tried), side="right"))}
                )
            tested.append(own)
        return [pa.array(bases, _ARROW_SPANS), pa.array(tested, _ARROW_RUNS)]

    fields = [StructField(base, ArrayType(SPAN)), StructField(runs, ArrayType(RUN))]
    return with_text_columns(docs, text, compute, fields, keep)


def thresholds(found: DataFrame, runs: str, rules: Battery) -> dict[int, int]:
    """Least step that is a discovery, by length class; classes without one are left out."""
    counts = (
        found.select(F.explode(runs).alias("r")).groupBy("r.stratum", "r.step").count().collect()
    )  # as many rows as length classes and steps
    out: dict[int, int] = {}
    for stratum in {r["stratum"] for r in counts}:
        own = sorted(((r["step"], r["count"]) for r in counts if r["stratum"] == stratum), reverse=True)
        tests, ahead = sum(n for _, n in own), 0
        for step, n in own:
            ahead += n
            if step > 0 and 10.0 ** (-step / rules.steps_per_decade) <= rules.discovery * ahead / tests:
                out[stratum] = step
    return out


def with_secrets(
    docs: DataFrame, text: str = "text", rules: Battery | None = None, column: str = "secrets",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows with ``column``: all secrets as (kind, start, end), by start, then kind.

    Places are code points, ends exclusive. All columns stay unless ``keep`` names some.
    A random key around a base span is a span of its own beside it.
    Nulls and empty texts hold none; an empty table gives no rows; texts are read whole.
    A column already called like ``column`` is replaced.
    """
    rules = rules or Battery()
    docs = without(docs, [column])
    keep = docs.columns if keep is None else keep
    base, runs = fresh_name(docs, "_base"), fresh_name(docs, "_runs")
    usage = usage_of(docs, text)
    # Texts are scanned once for the thresholds and once more for the result: what is
    # kept in between is a count per length class and step, not a copy of the corpus.
    least = thresholds(with_findings(docs, usage, rules, text, base, runs, []), runs, rules)
    found = with_findings(docs, usage, rules, text, base, runs, keep)
    hit = F.lit(False)
    extra = F.array().cast(ArrayType(SPAN))
    if least:
        picked = F.filter(
            runs, lambda r: F.coalesce(r["step"] >= F.create_map(*[F.lit(x) for kv in least.items() for x in kv])[r["stratum"]], hit)
        )
        extra = F.transform(
            picked, lambda r: F.struct(F.lit("random").alias("kind"), r["start"].alias("start"), r["end"].alias("end"))
        )
    number = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    ranked = F.transform(
        F.concat(base, extra),
        lambda s: F.struct(s["start"].alias("start"), number[s["kind"]].alias("n"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    spans = F.transform(
        F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return found.withColumn(column, spans).drop(base, runs)


def redacted(docs: DataFrame, text: str = "text", rules: Battery | None = None, length: str | None = None) -> DataFrame:
    """All rows, with each secret replaced by ``[kind]``; overlapping spans as one.

    ``length`` names a column of text lengths that then follows the new text. Texts
    without a secret, nulls included, stay as they are.
    """
    name = fresh_name(docs, "_secrets")
    found = with_secrets(docs, text, rules, name)
    # Cut from the left: what is written so far and the place up to which it reaches.
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(state, span):
        fresh = span["start"] >= state["at"]
        before = F.substring(F.col(text), state["at"] + 1, span["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], before, F.lit("["), span["kind"], F.lit("]")))
        return F.struct(
            out.otherwise(state["out"]).alias("out"), F.greatest(state["at"], span["end"]).alias("at")
        )

    def rest(state):
        return F.concat(state["out"], F.substring(F.col(text), state["at"] + 1, F.length(F.col(text))))

    clean = F.aggregate(name, start, cut, rest)
    changed = F.size(name) > 0
    out = found.withColumn(text, F.when(changed, clean).otherwise(F.col(text)))
    if length is not None:
        kind = docs.schema[length].dataType
        out = out.withColumn(
            length, F.when(changed, F.length(text).cast(kind)).otherwise(F.col(length))
        )
    return out.drop(name)


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Battery | None = None) -> DataFrame:
    """Per document: numbers of base spans by kind, a digest of them, and all spans as text."""
    found = with_secrets(docs.select(key, text), text, rules, "_spans", [key])

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind: str):
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("_spans", lambda s: s["kind"] != "random")
    return found.select(
        F.col(key).alias("doc_id"), number("assign"), number("access"), number("hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("_spans")).alias("spans"), number("random"),
    )
