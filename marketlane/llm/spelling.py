"""Spelling variants: words one edit apart, found through numbered trie nodes.

The nodes of a trie of all words, and of one of all words read backwards, get numbers. A
word without its character at ``i`` is then the pair (node of what is before, node of
what is after), and a word with a gap at ``i`` is the pair of nodes that meet there. Two
words whose skipped pairs are equal differ in that one character; a skipped pair equal to
a gap's pair is an insertion. Both are joins on two integers, they find every pair of
words within one edit and no other, and a key has at most as many words as the alphabet
has characters. Nodes that one word alone visits cannot be in a match and get no number.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.llm.common import scratch, slices, stored, stored_counted

#: Distinct words that a task keeps before it passes their counts on.
_FLUSH = 200_000
#: Rows of a batch of trie nodes.
_NODE_ROWS = 50_000


@dataclass(frozen=True)
class Words:
    """Which words count: at least ``least_points`` long, at least ``least_n`` times; ``ratio``
    is how much more frequent a form must be. One of ``damage`` occurrences by the hash of
    document and word loses a character (0: none), which plants known misspellings."""

    least_points: int = 5
    least_n: int = 3
    ratio: int = 2
    damage: int = 0


# --- counting --------------------------------------------------------------------------


def counted(docs: DataFrame, words: Words, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: maximal runs of letters of whole texts, A-Z lower-cased.

    Tasks add up before the shuffle, so a frequent word costs it a row a task. Null texts
    have no words; a null key damages like an empty one.
    """
    least, damage = words.least_points, words.damage
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall
    source = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))

    def batch(seen: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for rows in batches:
            for start, stop in slices(rows.column(1)):
                keys = rows.column(0).slice(start, stop - start).to_pylist()
                texts = rows.column(1).slice(start, stop - start).to_pylist()
                for name, body in zip(keys, texts, strict=True):
                    if not body:
                        continue
                    # bytes.lower() changes A-Z alone
                    own = Counter(runs(body.encode().lower().decode()))
                    if damage:
                        _damage(own, f"{name or ''}:".encode(), damage, least)
                    seen.update(own)
                if len(seen) > _FLUSH:
                    yield batch(seen)
                    seen = Counter()
        yield batch(seen)

    counts = source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= words.least_n)


def _damage(own: Counter, before: bytes, damage: int, least: int) -> None:
    start, changed = zlib.crc32(before), Counter()
    for word in list(own):
        code = zlib.crc32(word.encode(), start)
        if code % damage == 0:
            at = code % len(word)
            changed[word[:at] + word[at + 1 :]] += own.pop(word)
    own.update({word: n for word, n in changed.items() if len(word) >= least})


# --- trie nodes ------------------------------------------------------------------------


def trie_visits(words: DataFrame) -> DataFrame:
    """``w, side, i, node``: the nodes that each word visits but the roots.

    Side 0 has the nodes of word[:i], side 1 those of word[i:]; ``node`` is a 128-bit
    digest of the way to it, carried on from character to character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["w", "side", "i", "node"]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        out: list[tuple] = []

        def full() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for rows in batches:
            for w, word in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                size = len(word)
                for side, walk in ((0, word), (1, reversed(word))):
                    way = hashlib.blake2b(digest_size=16)
                    for step, c in enumerate(walk, 1):
                        way.update(c.encode("utf-32-le"))
                        out.append((w, side, step if side == 0 else size - step, way.copy().digest()))
                        if len(out) >= _NODE_ROWS:
                            yield full()
                            out = []
        if out:
            yield full()

    return words.select("w", "word").mapInArrow(run, "w bigint, side int, i int, node binary")


def positions(words: DataFrame) -> DataFrame:
    """``w, i, before, after, skipped``: numbers of the nodes around each place of each word.

    ``before`` is the node of word[:i], ``after`` that of word[i:], ``skipped`` that of
    word[i+1:]. A root is number 0; nodes of a single word are null. Numbers are drawn
    once and stored, in tables that the caller's ``scratch`` removes.
    """
    visits = stored(trie_visits(words), "visits")
    shared = visits.groupBy("side", "node").agg(F.count(F.lit(1)).alias("visitors")).filter("visitors > 1")
    nodes = stored(shared.select("side", "node", (F.monotonically_increasing_id() + 1).alias("id")), "nodes")
    known = visits.join(nodes, ["side", "node"]).select("w", "side", "i", "id")
    ends = words.select("w", F.char_length("word").alias("size"))
    root = ends.select("w", F.lit(0).alias("side"), F.lit(0).alias("i"), F.lit(0).cast("bigint").alias("id"))
    leaf = ends.select("w", F.lit(1).alias("side"), F.col("size").alias("i"), F.lit(0).cast("bigint").alias("id"))
    known = known.unionByName(root).unionByName(leaf)
    left = known.filter("side = 0").select("w", "i", F.col("id").alias("before"))
    right = known.filter("side = 1").select("w", "i", F.col("id").alias("after"))
    skip = known.filter("side = 1 AND i > 0").select("w", (F.col("i") - 1).alias("i"), F.col("id").alias("skipped"))
    rows = left.unionByName(right, allowMissingColumns=True).unionByName(skip, allowMissingColumns=True)
    merged = rows.groupBy("w", "i").agg(*(F.max(c).alias(c) for c in ("before", "after", "skipped")))
    return merged.filter("before IS NOT NULL AND (after IS NOT NULL OR skipped IS NOT NULL)")


def neighbour_pairs(words: DataFrame) -> DataFrame:
    """``w, near``: both directions of every pair of numbered words (w, word) one edit apart.

    Edits insert, delete or replace one code point. Words must be distinct and not null.
    """
    with scratch(words.sparkSession) as keep:
        places = stored(positions(words), "positions")
        texts = words.select("w", "word")
        # Of a run of equal characters only the first is skipped: any gives the same word.
        skipped = places.filter("skipped IS NOT NULL").join(texts, "w").select(
            "w", F.col("before").alias("p"), F.col("skipped").alias("s"),
            (F.col("i").eqNullSafe(0) | (F.substring("word", F.col("i") + 1, F.lit(1)) != F.substring("word", F.col("i"), F.lit(1)))).alias("first"),
        )
        gaps = places.filter("after IS NOT NULL").select(F.col("w").alias("v"), F.col("before").alias("p"), F.col("after").alias("s"))
        other = skipped.select(F.col("w").alias("v"), "p", "s")
        replaced = skipped.join(other, ["p", "s"]).filter("w <> v").select("w", F.col("v").alias("near"))
        longer = skipped.filter("first").join(gaps, ["p", "s"]).select("w", "v")
        both = F.explode(F.array(F.struct("w", F.col("v").alias("near")), F.struct(F.col("v").alias("w"), F.col("w").alias("near"))))
        pairs = replaced.unionByName(longer.select(both.alias("e")).select("e.w", "e.near"))
        return keep(stored(pairs, "pairs"))


# --- forms and roots -------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``w, root``: where a chain of forms (w, form) ends, for words that have a form.

    Each step doubles the way followed. A form is more frequent than its word, so chains
    end, after at most a logarithm of the largest count.
    """
    with scratch(forms.sparkSession) as keep:
        now, size = stored_counted(forms.select("w", F.col("form").alias("root")), "roots")
        while True:
            on = now.select(F.col("w").alias("mid"), F.col("root").alias("far"))
            moved = now.join(on, F.col("root") == F.col("mid"), "left")
            moved = moved.select("w", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
            now = stored(moved, "roots", size)
            if now.filter("moved").isEmpty():
                return keep(now).select("w", "root")


def variants(docs: DataFrame, words: Words | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word that counts.

    ``n_near`` words are one edit away. The form is the most frequent of them (ties: the
    first in code-point order), if it is ``ratio`` times as frequent as the word; the root
    is the last form of the chain, the word itself if it has none. Null and empty texts
    have no words; repeated rows count each; no words give no rows. A word is a run of
    letters of any length: its nodes are rows of their own, so a very long one is no very
    large row.
    """
    words = words or Words()
    with scratch(docs.sparkSession) as keep:
        numbered = counted(docs, words, key, text).withColumn("w", F.monotonically_increasing_id())
        numbered, size = stored_counted(numbered, "words")
        pairs = neighbour_pairs(numbered)
        other = numbered.select(F.col("w").alias("near"), F.col("n").alias("near_n"), F.col("word").alias("near_word"))
        best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near_word").alias("form"), F.col("near").alias("form_w")))
        linked = pairs.join(other, "near").groupBy("w").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        told = numbered.join(linked, "w", "left")
        fits = -F.col("best.minus") >= words.ratio * F.col("n")
        told = keep(stored(told.select(
            "w", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n"),
            F.when(fits, F.col("best.form_w")).alias("form_w"),
        ), "variants", size))
        ends = roots(told.filter("form_w IS NOT NULL").select("w", F.col("form_w").alias("form")))
        named = ends.join(numbered.select(F.col("w").alias("root"), F.col("word").alias("root_word")), "root").select("w", "root_word")
        named = keep(stored(named, "root-names", size))
    out = told.join(named, "w", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root_word", "word").alias("root"))


def variants_sql() -> str:
    """The same with damage 97 and the other numbers of ``Words``, for DuckDB.

    CRC32 is taken byte by byte with a table made from its polynomial.
    """
    return """
WITH RECURSIVE crc(table_) AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i)
    FROM (SELECT unnest(range(256)) AS i)
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[a-z\\x{00C0}-\\x{00FF}]+')) AS run
    FROM documents
), hexed AS (
    SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h
    FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2),
        lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, table_[(xor(c, b) & 255) + 1]))) AS code
    FROM hexed, crc
), damaged AS (
    SELECT CASE WHEN code % 97 = 0 THEN substr(run, 1, code % length(run)) || substr(run, code % length(run) + 2) ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
    SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words
), skips AS (
    SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM places WHERE i < length(word)
), pairs AS (
    SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM skips x JOIN skips y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION
    SELECT x.word, x.n, w.word, w.n FROM skips x JOIN words w ON w.word = x.a || x.b
    UNION
    SELECT w.word, w.n, x.word, x.n FROM skips x JOIN words w ON w.word = x.a || x.b
), best AS (
    SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM pairs GROUP BY word, n
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
        CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS at, form AS next FROM forms
    UNION ALL
    SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.at AS root FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
