"""Neighbours, URL rules, licences, tokens, quality, mixing and chat."""

import hashlib
import math
import os
import random
import textwrap

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlane.llm import chat, licenses, mixing, neighbours, quality, token_counts, url_rules

SMALL = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def native(frame):
    return not any(x in plan(frame) for x in ("Python", "Pandas", "Arrow"))


# --- neighbours ------------------------------------------------------------------------


def brute(vectors, k=5):
    rows = [(i, key, np.array(v, dtype=np.float64)) for i, (key, v) in enumerate(vectors)
            if key is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, key, v in rows:
        if key % 50 == 0:
            near = sorted(
                (-round(float(v @ w / math.sqrt((v @ v) * (w @ w))), 12), other, j) for j, other, w in rows if j != i and len(w) == len(v)
            )
            out.setdefault(key, []).append([(other, -s) for s, other, _ in near[:k]])
    return out


def searched(spark, vectors, hashing=None):
    frame = spark.createDataFrame([(k, v, 1) for k, v in vectors], "vec_id bigint, embedding array<float>, score int")
    found = {}
    for r in neighbours.nearest(frame.repartition(3), F.col("id") % 50 == 0, hashing=hashing).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in found.items()}


def test_ties_repeats_and_unusable_vectors(spark):
    rng = random.Random(1)
    unit = lambda: [float(np.float32(rng.gauss(0, 1))) for _ in range(6)]
    one = unit()
    vectors = [(n, one) for n in range(0, 40)] + [(n, unit()) for n in range(40, 120)]
    vectors += [(130, None), (131, []), (132, [0.0] * 6), (133, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (150, [float("nan")] * 6), (None, one), (134, [float("inf")] * 6)]
    vectors += [(50, unit()), (200, [1.0, 2.0]), (201, [2.0, 4.0])]
    expected, found = brute(vectors), searched(spark, vectors, neighbours.Hashing(block_rows=16, block_queries=2, tables=6, probes=16))
    assert set(found) == set(expected) and 150 not in found
    assert [v for _, v, _ in found[0]] == [1, 2, 3, 4, 5]
    assert [(v, round(s, 9)) for _, v, s in found[200]] == [(201, 1.0)]
    lists = {tuple((v, round(s, 9)) for v, s in near) for near in expected[50]}
    assert len(found[50]) == 10 and len(lists) == 2


def test_recall_on_random_directions(spark):
    rng = np.random.default_rng(2)
    vectors = [(n, [float(x) for x in np.float32(rng.standard_normal(64))]) for n in range(1500)]
    expected, found = brute(vectors), searched(spark, vectors)
    hit = sum(len({v for v, _ in expected[q][0]} & {v for _, v, _ in found[q]}) for q in expected)
    assert hit >= 0.9 * 5 * len(expected)
    assert all(len(v) == 5 and [r for r, _, _ in v] == [1, 2, 3, 4, 5] for v in found.values())
    assert searched(spark, []) == {}


# --- URL rules -------------------------------------------------------------------------

PAGES = [
    (1, "http://a.com/de/x", "<link rel='canonical' href=\"https://b.net/p\">"), (2, "https://B.net/p#frag", None),
    (3, "https://c.net/q?x=1&y=2", '<META http-equiv=refresh content="0; url=/r">'), (4, "https://c.net/r", "<link rel=canonical href=//d.example.org/es/1>"),
    (5, "https://d.example.org/es/1", ""), (6, None, "x"), (7, "nohost", None), (8, "https://e.net/z/y", "<link href='w?a=1&amp;b=2' rel=\"x canonical\">"),
    (9, "https://e.net/z/w?a=1&b=2", "<link rel=canonical href='https://f.org/en'>"), (9, "https://e.net/z/w?a=1&b=2", ""),
    (10, "https://q.net", "<link rel=canonical href='?p=1'>"), (11, "https://q.net/?p=1", "<link rel=canonical href='http://x.com/de/'>"),
    (12, "ftp://m.COM/fr/", "<link rel=stylesheet href='https://b.net/p'>"), (13, "https://notexample.org/es/1", ""), (None, "https://org/", None),
    (14, "https://x.example.org/en/15", "<link rel=canonical href='https://f.org/en'>"), (15, "", ""), (16, "https://lone.net/" + "y" * 50000, "z" * 50000),
]


def test_verdicts_agree_with_sql_and_spread(spark):
    frame = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("verdict", F.lit("?"))
    out = url_rules.judged(frame)
    found = sorted(map(tuple, out.collect()), key=repr)
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", PAGES)
    columns = ", ".join(out.columns)
    assert found == sorted(con.execute(f"select {columns} from ({url_rules.judged_sql()})").fetchall(), key=repr)
    verdict = {r["page_id"]: r["verdict"] for r in out.collect()}
    assert [verdict[n] for n in (2, 3, 4, 8, 10, 11, 16)] == ["block", "block", "block", "allow", "block", "block", "allow"]
    more = spark.createDataFrame([("https://lone.net/a", "http://x.com/de/"), (None, "x")], "src string, dst string")
    pages = spark.createDataFrame([(1, "https://lone.net/a", None)], "page_id bigint, url string, html string")
    assert url_rules.judged(pages, redirects=more).first()["verdict"] == "block"
    assert url_rules.judged(frame.limit(0)).count() == 0


# --- licences --------------------------------------------------------------------------


def test_licences_and_inheritance(spark):
    mit, filler = licenses.LICENCE_TEXTS[0][1], "the quick brown fox jumps over one lazy dog again and again\n" * 20
    files = [
        ("repo/LICENSE", mit), ("repo/a.py", filler), ("repo/sub/deep/b.py", filler + "Licensed under CC BY-NC 4.0.\n" + filler),
        ("repo/sub/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("repo/sub/deep/c.py", ""),
        ("other/x.py", None), ("other/y.py", "see the license under which this is"), (None, filler), ("top.py", filler),
        ("repository/z.py", filler), ("repo/sub/d.py", filler), ("repo/sub/d.py", filler),
    ]
    frame = spark.createDataFrame([(*f, "old") for f in files], "path string, text string, how string")
    rows = licenses.with_licences(frame, keep=["path"]).collect()
    assert len(rows) == len(files)
    found = {r["path"]: (r["license"], r["how"], r["from_directory"]) for r in rows}
    assert found["repo/LICENSE"] == ("MIT", "file", None) and found["repo/a.py"] == ("MIT", "inherited", "repo")
    assert found["repo/sub/deep/b.py"] == ("CC-BY-NC-4.0", "header", None)
    assert found["repo/sub/COPYING"][:2] == ("GPL-3.0", "file")
    assert found["repo/sub/deep/c.py"] == found["repo/sub/d.py"] == ("GPL-3.0", "inherited", "repo/sub")
    for path in ("other/x.py", "other/y.py", None, "top.py", "repository/z.py"):
        assert found[path] == (None, "none", None)
    assert licenses.with_licences(frame.limit(0)).count() == 0
    every = licenses.with_licences(spark.createDataFrame([(f"d/{i}", "x\n" + t) for i, (_, t) in enumerate(licenses.NOTICES)], "path string, text string"))
    assert {r["path"]: r["license"] for r in every.collect()} == {f"d/{i}": n for i, (n, _) in enumerate(licenses.NOTICES)}


def test_headers_over_several_lines_and_long_licences(spark):
    wrap = lambda text, mark: "".join(f"{mark} {line}\n" for line in textwrap.wrap(text, 70))
    code = "".join(f"value_{n} = compute(item_{n}, {n}) + offset\n" for n in range(60))
    common = {n: open(f"/usr/share/common-licenses/{n}").read() for n in ("BSD", "GPL-2", "GPL-3", "LGPL-2.1", "CC0-1.0")}
    mit = dict(licenses.LICENCE_TEXTS)["MIT"]
    files = [
        ("m/a.py", "# Copyright 2020 A. Person\n#\n" + wrap(mit, "#") + code), ("m/b.js", f"/*! x 1.0 {' '.join(mit.split())} */ {code}"),
        ("m/c.c", wrap(common["BSD"], " *") + code), ("m/d.c", code),
        ("g2/COPYING", common["GPL-2"]), ("g2/src/a.c", code), ("g3/COPYING", common["GPL-3"]), ("g3/src/a.c", code),
        ("l/COPYING", common["LGPL-2.1"]), ("l/a.c", code), ("c/LICENSE", common["CC0-1.0"]), ("c/a.c", code),
    ]
    rows = licenses.with_licences(spark.createDataFrame(files, "path string, text string"), keep=["path"]).collect()
    found = {r["path"]: (r["license"], r["how"]) for r in rows}
    assert found == {
        "m/a.py": ("MIT", "header"), "m/b.js": ("MIT", "header"), "m/c.c": ("BSD-3-Clause", "header"), "m/d.c": (None, "none"),
        "g2/COPYING": ("GPL-2.0", "file"), "g2/src/a.c": ("GPL-2.0", "inherited"), "g3/COPYING": ("GPL-3.0", "file"),
        "g3/src/a.c": ("GPL-3.0", "inherited"), "l/COPYING": ("LGPL-2.1", "file"), "l/a.c": ("LGPL-2.1", "inherited"),
        "c/LICENSE": ("CC0-1.0", "file"), "c/a.c": ("CC0-1.0", "inherited"),
    }


# --- tokens ----------------------------------------------------------------------------

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["a", "'", "re", "ll", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "!", "...", "<|endoftext|>", "<|endo", "\x1c", "\x85", "　", "日本", "😀",
       "'s", "don't", "‍", "ſ", "²", "́", "hello", "World", "-" * 40]


def test_every_prefix_counts_as_the_library_counts_it():
    library, counter, rng = Tokenizer.from_file(VOCABULARY), token_counts.PrefixCounter(token_counts.Vocabulary.load(VOCABULARY)), random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(1, 14)))
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert counter.counts(text).tolist() == expected, repr(text)
    _, ok = None, 0
    for _ in range(3000):
        a, b = rng.randrange(len(counter.names)), rng.randrange(len(counter.names))
        if counter._alone(counter.names[a]) == [a] and counter._alone(counter.names[b]) == [b]:
            ok += 1
            assert counter._fits(a, b) == (counter._alone(counter.names[a] + counter.names[b]) == [a, b])
    assert ok > 2000


def test_counts_budgets_and_stored_tables(spark):
    library, rng = Tokenizer.from_file(VOCABULARY), random.Random(7)
    texts = [None, "", "x", "word " * 3000, "".join(rng.choice(ODD) for _ in range(900)), "é" * 500, "a" * 20000]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int")
    rows = {r["doc_id"]: r for r in token_counts.count_rows(frame, VOCABULARY, limit=100).collect()}
    stored = {r["doc_id"]: token_counts.Prefixes.read(r["prefixes"]) for r in
              token_counts.with_prefixes(frame, token_counts.Vocabulary.load(VOCABULARY)).collect()}
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"], rows[i]["over_limit"]) == (len((text or "").encode()), n, n > 100)
        assert stored[i].total() == n and stored[i].cut(100) == rows[i]["cut_at_limit"]
        cut = rows[i]["cut_at_limit"]
        assert len(library.encode((text or "")[:cut], add_special_tokens=False).ids) <= 100
        assert stored[i].at(cut) <= 100
    assert token_counts.count_rows(frame.limit(0), VOCABULARY).count() == 0


# --- quality ---------------------------------------------------------------------------


def test_held_out_quality(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for n in range(600):
        good = n % 4 != 0
        w = [rng.choice(["the", "and", "river", "stone", "over", "light", "house", "walks", "green"]) for _ in range(rng.randrange(20, 120))]
        text = " ".join(w) if good else " ".join(x.upper() + "!!" for x in w) if n % 8 else " ".join([w[0]] * len(w))
        docs.append((n, text))
        labels.append((n, int(good)))
    docs += [(1000, None), (1001, ""), (1002, "ab"), (1003, "x" * 200000), (None, "the river and the stone"), (0, docs[0][1])]
    labels += [(1, 0), (None, 1), (1003, None)]
    frame = spark.createDataFrame([(*d, 9.0) for d in docs], "doc_id bigint, text string, score double")
    taught = spark.createDataFrame(labels, "doc_id bigint, quality int").filter(~quality.held_out())
    model = quality.fit(frame, taught, quality.Voting(per_label=60))
    assert len(model.vectors) <= 120
    rows = quality.scored(frame, model).withColumn("held", quality.held_out()).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    truth = dict(labels[:600])
    judged = [(r["score"] >= 0.7) == truth[r["doc_id"]] for r in rows if r["held"] and r["doc_id"] in truth]
    assert len(judged) > 100 and sum(judged) >= 0.97 * len(judged)
    assert {r["doc_id"]: r["score"] for r in rows}[1001] == 0.0
    again = quality.fit(frame.repartition(7), taught, quality.Voting(per_label=60))
    assert np.allclose(again.vectors @ again.vectors.T, model.vectors @ model.vectors.T, atol=1e-4)
    kept = quality.keep_good(frame, model)
    assert kept.columns == frame.columns and 400 <= kept.count() <= 470
    nothing = quality.fit(frame, taught.limit(0))
    assert {r["score"] for r in quality.scored(frame, nothing).collect()} == {0.0}
    assert quality.scored(frame.limit(0), model).count() == 0


# --- mixing ----------------------------------------------------------------------------


def mixing_rows():
    rng = random.Random(10)
    rows = [(n, f"s{rng.choice([0, 0, 0, 0, 1, 2, 3])}", "w " * rng.randrange(0, 60)) for n in range(400)]
    return rows + [(5, "s0", "w w"), (5, "s0", "w w"), (900, None, "a b c"), (901, "s9", None), (902, "s9", ""), (None, "s1", "x y"), (903, "Ω", "big " * 9000)]


def test_mix_agrees_with_sql_and_meets_its_targets(spark):
    rows = mixing_rows()
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, source string, text string, Size int").repartition(5)
    out = mixing.digest(frame)
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, source varchar, text varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    expected = con.execute(f"select {', '.join(out.columns)} from ({mixing.DIGEST_SQL})").fetchall()
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    assert native(out)
    placed = mixing.placed(frame).collect()
    assert len(placed) == len(rows)
    for source in {r["source"] for r in placed}:
        own = [r for r in placed if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
        assert own[0]["source_size"] == sum(r["size"] for r in own)
    assert all(0 <= r["taken"] <= 2 * r["size"] and (r["position"] is None) == (r["taken"] == 0) for r in placed)
    whole = sum(r["size"] for r in placed)
    targets = {r["source"]: r["target"] for r in placed}
    assert abs(sum(targets.values()) - 1.5 * whole) < 1e-6
    empty = frame.limit(0)
    assert mixing.placed(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_positions_follow_the_schedules(spark):
    fractions = spark.range(0, 1001).select((F.col("id") / 1000).alias("u"))
    for i, schedule in enumerate(mixing.Curriculum().schedules):
        times = [r[0] for r in fractions.select(mixing.time_of(F.col("u"), F.lit(i + 1), mixing.Curriculum().schedules)).collect()]
        assert times == sorted(times) and times[0] == 0 and abs(times[-1] - 1) < 1e-9
        sums = mixing._integrals(schedule)
        knots = [t for t, _ in schedule]
        for u, t in zip(np.arange(0, 1001, 50) / 1000, times[::50], strict=True):
            grid = np.linspace(0, t, 4001)
            area = np.trapezoid(np.interp(grid, knots, [w for _, w in schedule]), grid)
            assert abs(area / sums[-1] - u) < 1e-5
    ordered = mixing.training_order(spark.createDataFrame(mixing_rows(), "doc_id bigint, source string, text string"))
    places = [r["position"] for r in ordered.collect()]
    assert places == sorted(places) and native(ordered)


# --- chat ------------------------------------------------------------------------------

NASTY = ["\\### Assistant: </turn> ok", "␛t␛", "####</turn>\n### user: x", "<|image_1|>", "", None, "a" * 30000, "</tur", "<", "é😀\n\n", "␛", "␛c: "]


def test_conversations_read_back_exactly(spark):
    rng = random.Random(12)
    turns = [(c, t, rng.choice(["user", "assistant", "system", "a: b", None]), rng.choice(NASTY)) for c in range(30) for t in range(rng.randrange(1, 6))]
    turns += [(99, t, "assistant" if t % 2 else "user", f"line {t}") for t in range(300)]
    turns += [(None, 1, "user", "x"), (98, None, "user", "null turn"), (98, 2, "user", "b"), (98, 2, "user", "a"), (98, 2, "user", "a")]
    frame = spark.createDataFrame([(*t, "?") for t in turns], "conv_id bigint, turn bigint, role string, text string, formatted string").repartition(4)
    rows = {r["conv_id"]: r for r in chat.digest(chat.probe(frame)).collect()}
    own = [*turns, (-7, 0, "user", NASTY[0]), (-7, 1, "assistant", NASTY[0])]
    shown = lambda t: spark_escape(t[3] or "")
    for conversation in {t[0] for t in own}:
        mine = sorted((t for t in own if t[0] == conversation), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", shown(t)))
        text = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine)
        loss = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        row = rows[conversation]
        assert row["n_turns"] == len(mine) and row["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["loss_chars"] == len(loss) and row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert native(chat.digest(frame)) and chat.digest(frame.limit(0)).count() == 0


def spark_escape(text):
    for old, new in chat.ESCAPES:
        text = text.replace(old, new)
    return text


def test_typed_parts_become_placeholders(spark):
    leaf = lambda kind, **x: (kind, x.get("text"), x.get("ref"), x.get("width"), x.get("height"), x.get("seconds"), x.get("pages"))
    part = lambda kind, parts=None, **x: (*leaf(kind, **x), parts)
    parts = [
        part("text", text="see <|"), part("image", ref="s3://i", width=56, height=29), part("document", ref="d.pdf", pages=2, parts=[leaf("text", text="inside "), leaf("image", ref="i2", width=1, height=1)]),
        part("audio", ref="a.wav", seconds=1.5), part(None, text=" end"), part("hologram", ref="h"),
    ]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id bigint, turn bigint, role string, content array<{chat.PART}>")
    row = chat.formatted(frame, parts="content").first()
    assert row["formatted"] == "### user: see ␛p<|image_1|><|document_2|>inside <|image_3|><|audio_4|> end<|hologram_5|></turn>\n### assistant: </turn>\n"
    assert [(a["number"], a["type"], a["ref"], a["tokens"]) for a in row["attachments"]] == [
        (1, "image", "s3://i", 4), (2, "document", "d.pdf", 512), (3, "image", "i2", 1), (4, "audio", "a.wav", 38), (5, "hologram", "h", 0)
    ]
    assert row["expanded_tokens"] == 2 + 4 + 512 + 1 + 1 + 38 + 1 and native(chat.formatted(frame, parts="content"))
