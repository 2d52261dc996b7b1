"""Sharding, quality, licenses, mixing, decontamination, language ID and the
pipeline against plain-Python versions, and their behaviour on odd rows."""
import collections
import functools
import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs, odd_rows, words  # noqa: E402

import corpus_pipeline  # noqa: E402
from twosample.llm import bm25_decontam as BM  # noqa: E402
from twosample.llm import hd_langid as HD  # noqa: E402
from twosample.llm import license_scan as LS  # noqa: E402
from twosample.llm import quality_gam as QG  # noqa: E402
from twosample.llm.catalog import ORACLE, QUERIES, domain_of_source  # noqa: E402
from twosample.llm.common import id_remainder  # noqa: E402
from twosample.llm.kd_sharding import kd_shards  # noqa: E402
from twosample.llm.mixing import leaf_budgets, mix, waterfill, weights_column  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = {re.match(r"op\d+_|pipeline", q)[0] for q in QUERIES}
    assert names == {f"op{n}_" for n in range(1, 11)} and set(ORACLE) <= set(QUERIES)
    import __spark_entry__
    assert "pipeline" in __spark_entry__.queries()


# --- sharding ----------------------------------------------------------------
def check_shards(rows, got, shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(by) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_kd_shards_odd_rows_and_nothing(spark):
    rows = odd_rows()
    check_shards(rows, kd_shards(docs(spark, rows), shards=8).collect(), 8)
    assert kd_shards(docs(spark, []), shards=8).count() == 0
    check_shards([(1, None)], kd_shards(docs(spark, [(1, None)]), shards=4).collect(), 4)


@pytest.mark.parametrize("shards", [8, 5])
def test_kd_shards_have_near_equal_bytes(spark, shards):
    rng = random.Random(6)
    rows = [(k, words(rng, rng.randrange(1, 60)), "en", "src0" if k % 3 else f"src{k % 11}") for k in range(900)]      # a hot source
    rows += [(1000 + k, "copy " * 20) for k in range(30)]                              # a group that stays together
    got = kd_shards(docs(spark, rows), shards=shards, slot_rows=20).collect()
    check_shards(rows, got, shards)
    sizes = collections.Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    mean = sum(sizes.values()) / shards
    assert max(abs(s - mean) for s in sizes.values()) < 0.05 * mean
    assert len({r.shard for r in got if r.doc_id >= 1000}) == 1


def test_kd_shards_split_a_group_that_is_too_large(spark):
    rows = [(k, "the same text again") for k in range(400)] + [(1000 + k, f"other {k}") for k in range(400)]
    sizes = collections.Counter()
    for r in kd_shards(docs(spark, rows, extra=False), shards=4).collect():
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) < 1.1 * sum(sizes.values()) / 4


def test_kd_target_bytes(spark):
    rows = [(k, "x" * 99) for k in range(64)]
    got = kd_shards(docs(spark, [(k, f"{k:099d}") for k, _ in rows]), target_bytes=800).collect()
    assert set(collections.Counter(r.shard for r in got).values()) == {8}
    with pytest.raises(ValueError):
        kd_shards(docs(spark, rows))


# --- quality -----------------------------------------------------------------
def test_quality_held_out_accuracy(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = QG.quality_scores(d, lab, id_remainder("doc_id", 5) == 0).join(lab, "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    assert np.mean([(r.predicted == r.quality) for r in got]) > 0.9
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_quality_odd_rows(spark):
    rows = odd_rows()
    schema = "doc_id long, quality int, score double, x string"
    for known in ([], [(1, 1, 0.0, "")], [(1, 1, 0.0, ""), (4, 0, 0.0, ""), (5, None, 0.0, ""), (None, 1, 0.0, ""), (9, 0, 0.0, "")]):
        got = QG.quality_scores(docs(spark, rows), spark.createDataFrame(known, schema), F.col("doc_id") == 3).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert QG.quality_scores(docs(spark, []), spark.createDataFrame([], schema), F.lit(False)).count() == 0


def test_quality_learns_a_repeated_id_once(spark, monkeypatch):
    """Rows that repeat a labelled id do not all reach the driver."""
    seen, fit = [], QG.fit
    monkeypatch.setattr(QG, "fit", lambda x, y: seen.append(len(y)) or fit(x, y))
    rows = [(1, f"text {k}") for k in range(300)] + [(2, "other text"), (3, "third")]
    known = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    got = QG.quality_scores(docs(spark, rows), known, F.lit(False), max_train_rows=3).collect()
    assert len(got) == 302 and seen == [3]


def test_gam_learns_steps_and_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(float)          # only a pair table can tell
    model = QG.fit(x, y)
    assert np.mean((model.score(x) > 0.5) == y) > 0.9
    assert (0, 1) in {tuple(sorted(p[:2])) for p in model.pairs}
    one = x[:5]
    z = model.base + sum(t[b] for t, b in zip(model.tables, model.bins(one)))
    z = z + sum(t[model.coarse[i][model.bins(one)[i]], model.coarse[j][model.bins(one)[j]]] for i, j, t in model.pairs)
    assert model.score(one) == pytest.approx(1 / (1 + np.exp(-z)))


def test_tree_takes_the_best_cuts():
    g = np.array([-5.0, -5, 3, 3, 3, -9, -9])
    v = QG._leaves(g, np.ones(7), 3, 0.5)
    assert v == pytest.approx([10 / 3] * 2 + [-9 / 4] * 3 + [18 / 3] * 2)


# --- licenses ----------------------------------------------------------------
compiled = functools.cache(re.compile)      # more patterns than the module keeps


def license_brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(LS.WORD.replace(r"\x", "\\x"), low)
    at = collections.defaultdict(list)
    for phrase, label in LS.BASE:
        p = phrase.split()
        at[label] += [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
    base = sorted(x for x in at if at[x])
    norm, found = " " + " ".join(w) + " ", []
    if re.search(LS.GATE.replace(" ", "[^a-z]+"), low):
        for label, key, prio, conf, rx in LS.rules():
            if f" {key}" in norm:
                for m in compiled(f"(?<= )(?:{rx})(?= )").finditer(norm):
                    s = norm[:m.start()].count(" ") - 1
                    found.append((s, s + m.group().count(" ") + 1, prio, label, conf))
    kept = []
    for d in sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3])):
        if not any(o[0] <= d[0] and o[1] >= d[1] and o[2] <= d[2] and
                   (o[0], -o[1], o[2], o[3]) < (d[0], -d[1], d[2], d[3]) for o in found):
            kept.append(d)
    places = [k for x in at.values() for k in x]
    labels = sorted({*base, *(d[3] for d in kept)})
    score = 1.0
    for x in labels:
        score *= 1 - max([0.9 if x in base else 0.0, *(d[4] for d in kept if d[3] == x)])
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(base), ",".join(labels), round(1 - score, 9))


def test_license_scan(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "MIT license, MIT license; mit-license!", "This work is licensed under the GNU General Public License, version 3.",
             "Released under CC BY-NC-SA 4.0 and the ISC licence", "SPDX-License-Identifier: BSD 3", "all rights reserved. Copyright (c) 2019", "no licence here, permission denied",
             "general public license version 2 is not the Lesser General Public License", "É MIT LICENSE ß" * 3, "mit\nlicense apache\tlicense " * 40, "license " * 500, None, "", "  "]
    rows = [(k, t) for k, t in enumerate(texts)] + odd_rows()
    got = [tuple(r) for r in LS.scan_licenses(docs(spark, rows)).collect()]
    want = [(i, *license_brute(t)) for i, t, *_ in rows]
    assert sorted(((*r[:7], round(r[7], 9)) for r in got), key=str) == sorted(want, key=str)
    assert any("cc-by-nc-sa" in r[6] for r in got) and any(r[6] == "gpl,lgpl" for r in got)
    assert LS.scan_licenses(docs(spark, [])).count() == 0


def test_license_rules_number_in_the_hundreds_and_compile():
    rx = LS.rules()
    assert len(rx) > 200 and [r[2] for r in rx] == sorted(r[2] for r in rx)
    for r in rx:
        re.compile(r[4])


def test_license_gate_and_keywords_lose_nothing(spark):
    """Labels are those of all rules tried on all texts, without gate or keyword."""
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of it"
    texts = [grant, "released under the MIT.", "Distributed under the terms of the GNU GPL v3.", "available under bsd", "Use is granted under the Apache.",
             "Rights are hereby granted under Zlib", "Distributed under CC BY-SA 4.0", "under the University of Illinois license", "released under university of Illinois",
             "redistributed under ISC", "granted, under the MIT", "understood and available", "you may not use this file except in compliance with the License",
             "free and unencumbered software released into the public domain"]
    words_of = {"ncsa": ["ncsa", "university of illinois"], "mulan": ["mulan"], "cc-by": ["cc by", "creative commons attribution"]}
    shapes = ["spdx license identifier {}", "released under {}", "available under the terms of the {} 2", "use is granted under {}", "{} licence 2", "{} license"]
    texts += [sh.format(n) for names in words_of.values() for n in names for sh in shapes]
    texts += [sh.format(key) for _, key, _ in LS.FAMILIES for sh in shapes]
    got = {r.doc_id: (set(r["labels"].split(",")) - {""}, r.score) for r in LS.scan_licenses(docs(spark, list(enumerate(texts)), extra=False)).collect()}
    for k, t in enumerate(texts):
        norm = " " + " ".join(re.findall(LS.WORD, t.lower())) + " "
        found = [(m.start(), -m.end(), prio, label) for label, _, prio, _, rx in LS.rules() for m in compiled(f"(?<= )(?:{rx})(?= )").finditer(norm)]
        kept = {d[3] for d in found if not any(o[0] <= d[0] and o[1] <= d[1] and o[2] <= d[2] and o < d for o in found)}
        base = {label for phrase, label in LS.BASE if f" {phrase} " in norm}
        assert got[k][0] == kept | base, t
    assert got[0][0] == got[1][0] == {"mit"} and got[7][0] == got[8][0] == {"ncsa"}
    assert all(got[k][0] for k in range(10))


def _sample(parsed, rng):
    """A text that a parsed pattern of words, groups, classes and repeats matches."""
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "ANY":
            out += "x"
        elif op == "IN":
            kind, what = rng.choice(arg)
            out += chr(what) if str(kind) == "LITERAL" else chr(rng.randint(*what))
        elif op == "BRANCH":
            out += _sample(rng.choice(arg[1]), rng)
        elif op == "SUBPATTERN":
            out += _sample(arg[3], rng)
        elif op == "MAX_REPEAT":
            lo, hi, inner = arg
            out += "".join(_sample(inner, rng) for _ in range(rng.randint(lo, min(hi, lo + 1))))
        else:
            raise ValueError(op)
    return out


def test_every_rule_is_found_behind_gate_and_keyword(spark):
    """Texts drawn from each pattern: the gate lets them pass, they hold the keyword, and Spark finds what the plain version finds."""
    rng, rows = random.Random(8), []
    for label, key, _, _, rx in LS.rules():
        for _ in range(6):
            text = _sample(re._parser.parse(rx), rng)
            if not re.fullmatch(rx, text) or "  " in text or text != text.strip():
                continue        # a repeat of any character that ran into a word border
            assert re.search(LS.GATE.replace(" ", "[^a-z]+"), text), text
            assert f" {key}" in f" {text}", (key, text)
            rows.append((len(rows), f"Before: {text}. After"))
    assert len(LS.SIGNATURES) > 50 and sum(map(len, LS.SIGNATURES.values())) > 180 and len(rows) > 5 * len(LS.rules())
    got = {r[0]: (*r[1:7], round(r[7], 9)) for r in LS.scan_licenses(docs(spark, rows)).collect()}
    for i, t in rows:
        assert got[i] == license_brute(t), t
        assert got[i][5], t


# --- mixing ------------------------------------------------------------------
def fill_brute(budget, children):
    """children: {name: (capacity, weight)} to {name: budget}, by rounds."""
    out, open_ = {}, {n: c for n, c in children.items() if c[1] > 0}
    left = budget
    while open_:
        weight = sum(w for _, w in open_.values())
        full = [n for n, (c, w) in open_.items() if c * weight <= left * w]
        if not full:
            return out | {n: left * w // weight for n, (_, w) in open_.items()} | {n: 0 for n, c in children.items() if c[1] == 0}
        for n in full:
            out[n] = open_.pop(n)[0]
        left = budget - sum(out.values())
    return out | {n: 0 for n, c in children.items() if c[1] == 0}


@pytest.mark.parametrize("budget", [0, 7, 100, 555, 10_000])
def test_waterfill(spark, budget):
    rng = random.Random(budget)
    kids = {f"s{k}": (rng.randrange(1, 200), rng.randrange(0, 4)) for k in range(12)}
    df = spark.createDataFrame([("d", n, c, w, budget) for n, (c, w) in kids.items()], "domain string, source string, capacity long, weight long, parent_budget long")
    assert {r.source: r.budget for r in waterfill(df, ["domain"]).collect()} == fill_brute(budget, kids)


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "en", "x", 10), ("a", "en", "y", 1000), ("b", "en", "z", 50)], "domain string, lang string, source string, tokens long")
    one = weights_column("lang", {}, 1)
    got = {r.source: r.budget for r in leaf_budgets(leaves, 400, one, one, one, 1).collect()}
    assert got == {"x": 10, "y": 340, "z": 50}       # x's shortage to y; b's 150 to a, whose only open leaf is y
    got = {r.source: r.budget for r in leaf_budgets(leaves, 60, one, one, one, 1).collect()}
    assert got == {"x": 10, "y": 20, "z": 30}


@pytest.mark.parametrize("share,epochs", [(0.5, 1), (1.5, 3)])
def test_mix(spark, share, epochs):
    rng = random.Random(8)
    rows = odd_rows() + [(100 + k, words(rng, rng.randrange(1, 40)), rng.choice(["en", "en", "de", None]), f"src{min(k % 9, 3)}") for k in range(300)]
    got = mix(docs(spark, rows), domain_of_source(), lambda total: int(total * share), {"en": 3, "de": 1}, epochs=epochs, seed=2, keep=["text", "tokens"]).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        assert r.tokens == max(1, -(-len((r.kept_text or "").encode()) // 4)) and 0 <= r.copies <= epochs
        by[r.domain, r.lang, r.source].append(r)
    for leaf in by.values():
        total, budget = leaf[0].leaf_tokens, leaf[0].leaf_budget
        assert total == sum(r.tokens for r in leaf)
        rounds = budget // total
        order = sorted(leaf, key=lambda r: (hashlib.md5("-".join(["2", str(rounds), "" if r.doc_id is None else str(r.doc_id), str(r.tokens)]).encode()).hexdigest()))
        taken = [r.copies - rounds for r in order]
        assert taken == sorted(taken, reverse=True) and set(taken) <= {0, 1}             # a prefix of the epoch's order
        assert abs(sum(r.copies * r.tokens for r in leaf) - budget) <= max(r.tokens for r in leaf)
    assert mix(docs(spark, []), domain_of_source(), lambda total: total, {}).count() == 0


# --- decontamination ---------------------------------------------------------
def contaminated_brute(rows, items, n=5):
    """Every item against every text, on whole texts that are one passage long."""
    out = set()
    for d, text, *_ in rows:
        ws = BM.words_of(text)
        for i, t in items:
            want = BM.shingles(BM.words_of(t), n)
            if not want:
                continue
            size = len(next(iter(want)))
            have, bag = BM.shingles(ws, size), set(ws)
            q, a = (set(x) for x in BM.split_item(t))
            if len(want & have) >= 0.8 * len(want) and len(q & bag) >= 0.5 * len(q) and len(a & bag) >= 0.5 * len(a):
                out.add((d, i))
    return out


def test_decontamination(spark):
    rng = random.Random(12)
    items = [(k, " ".join(words(rng, rng.randrange(3, 12)) + "." for _ in range(rng.randrange(1, 4)))) for k in range(60)]
    rows = []
    for k in range(120):
        i, t = items[rng.randrange(60)]
        ws = t.split()
        kind = k % 6
        body = {0: t, 1: t.upper().replace(" ", " -- "), 2: " ".join(ws[:-1]), 3: " ".join(ws[: len(ws) // 2]), 4: " ".join(w if j != len(ws) // 2 else "zzz" for j, w in enumerate(ws)), 5: ""}[kind]
        rows.append((k, f"{words(rng, rng.randrange(0, 30))} {body} {words(rng, rng.randrange(0, 30))}"))
    table = spark.createDataFrame([*items, (61, None), (62, ""), (None, "x y z"), items[0]], "item_id long, text string")
    index = BM.ItemIndex(items, 5, 0.8, 0.5)
    index.longest = 100                             # whole texts are passages, as in the plain version
    plain = {(d, h[0]) for d, t in rows for h in index.search(BM.words_of(t))}
    assert plain == contaminated_brute(rows, items) and len(plain) > 40
    far = [(1000 + d, words(rng, 3000) + " " + t + " " + words(rng, 3000)) for d, t in rows]
    got = {(r.doc_id, r.item_id) for r in BM.contaminated(docs(spark, rows + far + odd_rows()), table).collect()}
    assert plain <= got and {(1000 + d, i) for d, i in plain} <= got
    split = {(r.doc_id, r.item_id) for r in BM.contaminated(docs(spark, rows), table, block_bytes=500).collect()}     # many blocks of items
    assert {d for d, _ in split} == {d for d, _ in got if d is not None and d < 1000 and d >= 0 and d in dict(rows)}
    left = BM.drop_contaminated(docs(spark, rows), table)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in split} and left.columns == docs(spark, rows).columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert BM.contaminated(docs(spark, rows), none).count() == 0 and BM.contaminated(docs(spark, []), table).count() == 0


def test_decontamination_does_not_depend_on_the_blocks_of_items(spark):
    """Every column is the same for one index of all items and for many small ones."""
    rng = random.Random(44)
    items = [(k % 50, " ".join(words(rng, rng.randrange(1, 14), vocab=60) + "." for _ in range(rng.randrange(1, 4)))) for k in range(60)]
    rows = [(k, f"{words(rng, rng.randrange(0, 400))} {items[rng.randrange(60)][1]} {words(rng, rng.randrange(0, 400))}") for k in range(80)]
    table = spark.createDataFrame([*items, (61, None), (62, ""), (63, "..."), (None, "x y z"), items[0]], "item_id long, text string")
    whole = sorted((tuple(r) for r in BM.contaminated(docs(spark, rows + odd_rows()), table).collect()), key=str)
    assert len(whole) > 60
    for size in (300, 2000):
        assert sorted((tuple(r) for r in BM.contaminated(docs(spark, rows + odd_rows()), table, block_bytes=size).collect()), key=str) == whole


def test_drop_contaminated_on_odd_rows(spark):
    """Null and empty texts stay, repeated rows go together, clashing columns keep their values, no items drop nothing."""
    text = words(random.Random(33), 40)
    table = spark.createDataFrame([(1, text)], "item_id long, text string")
    d = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (2, None, "c"), (None, "", "d"), (3, "one two", "e")], "doc_id long, text string, item_id string")
    assert sorted(r.item_id for r in BM.drop_contaminated(d, table).collect()) == ["c", "d", "e"]
    assert BM.drop_contaminated(d, table.limit(0)).count() == 5 and BM.drop_contaminated(d.limit(0), table).count() == 0


def test_decontamination_finds_spread_items_at_all_offsets():
    """An item with a gap inside, over a span of at most twice the longest item, is found wherever it stands."""
    rng = random.Random(21)
    question, answer = words(rng, 30), words(rng, 10)
    index = BM.ItemIndex([(1, f"{question}. {answer}."), (2, words(rng, 20) + ". " + words(rng, 10) + ".")], 5, 0.8, 0.5)
    filler = words(rng, 700, 9999).split()
    for gap in (10, 20, 30, 40):
        for at in range(0, 560, 3):
            text = filler[:at] + question.split() + filler[600:600 + gap] + answer.split() + filler[at:560]
            assert [h[0] for h in index.search(BM.words_of(" ".join(text)))] == [1], (gap, at)


def test_items_without_an_id_count(spark):
    text = words(random.Random(30), 40)
    table = spark.createDataFrame([(None, text), (None, None), (7, words(random.Random(31), 40))], "item_id long, text string")
    rows = [(1, text), (2, words(random.Random(32), 40))]
    assert [(r.doc_id, r.item_id) for r in BM.contaminated(docs(spark, rows), table).collect()] == [(1, None)]
    assert [r.doc_id for r in BM.drop_contaminated(docs(spark, rows), table).collect()] == [2]


def test_retrieval_gives_all_items_at_or_above_theta():
    rng = random.Random(2)
    items = [(k, words(rng, 30, vocab=40)) for k in range(100)]
    ix = BM.ItemIndex(items, 5, 0.8, 0.5, block=8)
    for _ in range(50):
        tids = np.array([ix.term[w] for w in BM.words_of(items[rng.randrange(100)][1])[:rng.randrange(5, 30)]])
        dense = np.zeros(100)
        for t in set(tids.tolist()):
            for p in range(ix.start[t], ix.start[t + 1]):
                dense[ix.post[p]] += ix.impact[p]
        hit, score = ix.retrieve(tids)
        assert hit.tolist() == np.flatnonzero(dense >= ix.theta).tolist() and score == pytest.approx(dense[hit])


# --- language ----------------------------------------------------------------
def test_language_id_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = id_remainder("doc_id", 4) == 2
    got = HD.identify(d, ~held).join(d, "doc_id").filter(held).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.98


def test_language_id_odd_rows(spark):
    rows = odd_rows()
    got = {(r.doc_id, r.lang_pred != "und") for r in HD.identify(docs(spark, rows), F.lit(True)).collect()}
    assert {(1, False), (2, False), (3, False), (9, False), (4, True), (7, True), (None, True)} <= got
    assert {r.lang_pred for r in HD.identify(docs(spark, rows), F.lit(False)).collect()} == {"und"}
    assert HD.identify(docs(spark, []), F.lit(True)).count() == 0
    left = HD.drop_unidentified(docs(spark, rows), F.lit(True))
    assert left.count() == len(rows) - 4 and left.columns == docs(spark, rows).columns


def test_bundle_is_the_sum_of_bound_letters():
    v = np.random.default_rng(7).choice(np.array([-1, 1], dtype=np.int8), (HD.SYMBOLS, 64))
    codes, n = HD.counted(HD.gram_codes("Abba é"))
    want = np.zeros(64)
    for c, k in zip(codes, n):
        a, b, d = c // HD.SYMBOLS ** 2, c // HD.SYMBOLS % HD.SYMBOLS, c % HD.SYMBOLS
        want += k * np.roll(v[a], 2) * np.roll(v[b], 1) * v[d].astype(int)
    assert HD.bundle(codes, n, 64, 7) == pytest.approx(want)
    assert HD.gram_codes("12 !") is None and n.sum() == 5


# --- pipeline ----------------------------------------------------------------
def test_pipeline_stages(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    extra = d.withColumns({"h": F.lit(1), "fp": F.lit("x"), "kept_text": F.lit(0)})
    before = {r.doc_id: r.text for r in d.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, SF).columns == extra.columns, name
    left = {r.doc_id for r in corpus_pipeline.language_id(spark, d, SF).collect()}
    assert left == {i for i, t in before.items() if t and any(c.isalpha() for c in t)}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in corpus_pipeline.decontaminate(spark, d, SF).collect()}
    assert left == {i for i, t in before.items() if not any(x in t for _, x in items)}
    out = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(out) < len(before) and {r.shard for r in out} == set(range(8))
    check_shards([(r.doc_id, before[r.doc_id]) for r in out], out, 8)
