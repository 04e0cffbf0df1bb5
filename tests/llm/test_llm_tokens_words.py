"""Packing, spelling variants and fill-in-the-middle against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlane.llm import fill_middle, packing, spelling

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["", None, "a", "<|endoftext|>", "x <|endoftext|> y", "é" * 300, "日本語のテキスト", "\t\n    x", "I'll 'REve it's", "<P>a<S>", "\U0001f600 <M", "\x00a"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


# --- packing ---------------------------------------------------------------------------


def test_encoder_equals_the_library(library):
    file = packing.TokenFile.read(PATH)
    assert file.ranks
    encoder = packing.Encoder(file)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}\n{chr(c)}x" for c in range(0x260)] + [t for t in ODD if t]
    rng = random.Random(5)
    texts += ["".join(rng.choice("ab E'st\n .,1é日") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += [" ".join(rng.choice(["alpha", "Beta's", "日本", "12 ", "\n"]) for _ in range(60_000)), "z" * 150_000]
    texts += ["".join(rng.choice("qzjkxwv") for _ in range(100_000)) + " end", *(t.decode("utf-8", "ignore") for t in list(file.ranks)[::7])]
    texts += ["".join(rng.choice("etaoinshr'  ") for _ in range(20_000)) for _ in range(20)]
    for text in texts:
        assert encoder.ids(text) == np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text[:50]


def packed_and_checked(library, frame, cutting, texts):
    sequences = sorted(packing.sequences(frame, PATH, cutting).collect(), key=lambda r: r["sequence_id"])
    parts, width = defaultdict(list), cutting.width
    assert [r["sequence_id"] for r in sequences] == list(range(len(sequences)))
    for r in sequences:
        ids, filled = np.frombuffer(r["ids"], dtype="<u4"), 0
        for p in r["pieces"]:
            assert p["offset"] == filled and p["length"] > 0
            parts[p["doc_id"]].append((p["start"], ids[filled : filled + p["length"]], p["doc_tokens"]))
            filled += p["length"]
        assert filled == r["n_tokens"] <= width
        if r is not sequences[-1]:
            assert filled == width
        assert len(ids) == width or (len(ids) == filled and filled & (filled - 1) == 0)
        assert not np.any(ids[filled:] != cutting.pad)
    assert set(parts) == set(texts)
    for key, text in texts.items():
        own, place = sorted(parts[key], key=lambda p: p[0]), 0
        for start, ids, tokens in own:
            assert start == place
            place += len(ids)
        expected = [*library.encode(text or "", add_special_tokens=False).ids, cutting.end]
        assert np.concatenate([ids for _, ids, _ in own]).tolist() == expected and {t for *_, t in own} == {len(expected)}


@pytest.mark.parametrize(("width", "partitions"), [(8, 1), (8, 7), (64, 3), (2048, 5), (1, 2)])
def test_every_token_lies_in_one_piece(spark, library, width, partitions):
    rng = random.Random(width)
    texts = dict(enumerate(ODD + [" ".join(rng.choice(["one", "two's", "drei"]) for _ in range(rng.randrange(90))) for _ in range(80)]))
    texts[500] = "long text here " * (3000 if width > 8 else 40)
    frame = spark.createDataFrame([(k, t, 1, 2, 3, b"x") for k, t in texts.items()], "doc_id bigint, text string, part int, base int, at int, ids binary")
    packed_and_checked(library, frame.repartition(partitions), packing.Cutting(width=width, pad=9), texts)


def test_packing_without_rows_and_with_repeated_keys(spark, library):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.sequences(empty, PATH).count() == 0
    frame = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c"), (1, "c")], "doc_id bigint, text string")
    rows = packing.pieces(packing.sequences(frame, PATH)).collect()
    assert Counter((r["doc_id"], r["start"], r["length"]) for r in rows) == {(None, 0, 3): 2, (1, 0, 2): 2}
    told = zlib.crc32(np.array([*library.encode("a b").ids, 1], dtype="<u4").tobytes())
    assert {r["ids_crc32"] for r in rows if r["doc_id"] is None} == {told}


def test_places_of_partitions_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 3)
    counts = {p: (p * 7) % 5 for p in range(0, 20, 2)}
    frame = spark.createDataFrame([(p, 1) for p, n in counts.items() for _ in range(n)], "part bigint, doc_tokens bigint")
    for r in packing.partition_places(frame).collect():
        assert r["base"] == sum(n for p, n in counts.items() if p < r["part"])


def test_places_beyond_the_broadcast_bound(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "MOST_BROADCAST", 0)
    texts = {k: "some words in a row " * k for k in range(40)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    packed_and_checked(library, frame, packing.Cutting(width=32), texts)


# --- spelling --------------------------------------------------------------------------


def plain_variants(docs, words):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if words.damage and code % words.damage == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= words.least_points and c >= words.least_n}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, rows = {}, {}
    for w in n:
        close = [v for v in n if near(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= words.ratio * n[w] else None
        rows[w] = [n[w], len(close), form[w], n.get(form[w])]
    for w in n:
        end = w
        while form[end]:
            end = form[end]
        rows[w].append(end)
    return {w: tuple(r) for w, r in rows.items()}


@pytest.mark.parametrize("damage", [0, 3])
def test_variants_equal_all_pairs(spark, damage):
    rng = random.Random(damage)
    base = ["receive", "committee", "aaaaa", "Élève", "straße", "abcde", "grammar"]

    def edited(w):
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i, c = rng.randrange(len(w)), rng.choice("abcéÉÿ")
            w = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]]) or "a"
        return w

    docs = [(rng.choice([None, k, 7]), " ".join(edited(rng.choice(base)).upper() if rng.random() < 0.2 else edited(rng.choice(base)) for _ in range(60))) for k in range(60)]
    docs += [(900, None), (901, ""), (902, "Ångström×÷" * 3 + " 5words5 " * 4), (903, ("long" * 6000 + " ") * 3 + ("long" * 6000 + "x ") * 9)]
    words = spelling.Words(damage=damage)
    frame = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id bigint, text string, n int, word string")
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(frame.repartition(3), words).collect()}
    assert found == plain_variants(docs, words)
    assert any(r[2] for r in found.values())


def test_chains_of_forms_and_no_words(spark):
    text = " ".join(["aaaaabbbbb"[i:] * 1 + "cccccc" for i in range(6) for _ in range(3 * 2**i)])
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    rows = {r["word"]: r for r in spelling.variants(frame).collect()}
    assert len(rows) == 6 and {r["root"] for r in rows.values()} == {"bbbbbcccccc"}
    assert spelling.variants(frame.limit(0)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "few")], frame.schema)).count() == 0


# --- fill in the middle ----------------------------------------------------------------


def test_index_turns_points_into_bytes_and_back():
    rng = random.Random(3)
    for text in [t for t in ODD if t] + ["".join(rng.choice("ab é日\U0001f600") for _ in range(200)) for _ in range(50)]:
        index = fill_middle.ByteIndex.of(np.frombuffer(text.encode(), dtype=np.uint8))
        points = np.arange(len(text) + 1)
        places = np.array([len(text[:i].encode()) for i in points])
        assert (index.to_bytes(points) == places).all() and (index.to_points(places) == points).all()
        assert len(index.points) == sum(ord(c) > 127 for c in text)


def plain_form(key, text):
    text = text or ""
    hexed = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    u, v = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    prefix, middle, suffix = text[:u], text[u:v], text[v:]
    spm = h[3] % 100 < 20
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(text), "spm" if spm else "psm", u, v - u, out


def test_forms_equal_plain_and_restore(spark):
    rng = random.Random(4)
    pieces = ["a", "é", "日", "\U0001f600", "<", "P>", "<S", ">", "|", "\n", " ", "M"]
    docs = list(enumerate(ODD)) + [(100 + k, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for k in range(300)]
    docs += [(None, "no key é"), (None, "no key é"), (5, "again"), (6, "y" * 300_000 + "é" * 100_000)]
    frame = spark.createDataFrame([(k, t, "x", 5) for k, t in docs], "doc_id bigint, text string, form string, _seed int")
    made = fill_middle.transformed(frame.repartition(3)).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    found = Counter((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made.collect())
    assert found == Counter((k, t, *plain_form(k, t)) for k, t in docs)
    assert all(r["back"] == (r["text"] or "") and r["_seed"] == 5 for r in made.collect())
    assert {"psm", "spm", "plain"} == {r["form"] for r in made.collect()}
    assert fill_middle.transformed(frame.limit(0)).count() == 0
