"""Exact, SimHash, suffix-array and line dedup against plain-Python versions."""
import collections
import glob
import hashlib
import os
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import all_pairs, components, docs, odd_rows, words  # noqa: E402

from twosample.llm import exact_dedup as ED  # noqa: E402
from twosample.llm import simhash as SH  # noqa: E402
from twosample.llm import suffix_dedup as SD  # noqa: E402
from twosample.llm.catalog import QUERIES  # noqa: E402
from twosample.llm.common import cut  # noqa: E402
from twosample.llm.components import connected_components  # noqa: E402
from twosample.llm.fuzzy_lines import STRIDE, _set, _shingle_rows, _texts, dedup_lines, line_links, shingle_hashes, signatures  # noqa: E402


# --- exact -------------------------------------------------------------------
def exact_brute(rows):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity,collide", [(2 << 20, False), (50, False), (50, True)])
def test_exact_dedup(spark, capacity, collide):
    rows = odd_rows() + [(100 + k, f"copy {k % 7}") for k in range(60)]
    hash_of = (F.length("text") % 3).cast("long") if collide else None      # chains of different texts
    got = ED.exact_dedup(docs(spark, rows), bucket_bytes=capacity, hash_of=hash_of)
    assert sorted(map(tuple, got.collect()), key=str) == exact_brute(rows)


def test_exact_dedup_of_nothing(spark):
    assert ED.exact_dedup(docs(spark, [])).count() == 0


def test_directory_doubles_where_buckets_are_overfull():
    slots = {0: 100, 1: 1, 2: 1, 3: 1, 7: 1}
    directory, buckets = ED.split_directory(slots, 3, 50)
    assert len(directory) == 8 and sum(n for *_, n in buckets) == 104
    assert directory[0] != directory[1] and len(set(directory[4:])) == 1
    directory, buckets = ED.split_directory(slots, 3, 1000)
    assert len(directory) == 1 and len(buckets) == 1


# --- SimHash -----------------------------------------------------------------
def fp_brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall("[^\x20\x09-\x0d]+", low)
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_simhash_components(spark):
    rng = random.Random(4)
    base = [words(rng, 40) for _ in range(5)]
    rows = [r for r in odd_rows() if r[0] != 8] + [(200 + k, base[k % 5] + f" Z{k // 5}") for k in range(40)]
    rows = [r for r in rows if r[0] is not None]
    fps = [fp_brute(r[1]) for r in rows]
    comp = components(len(rows), [(i, j) for i, j in all_pairs(len(rows)) if bin(fps[i] ^ fps[j]).count("1") <= 3])
    least = collections.defaultdict(list)
    for c, r in zip(comp, rows):
        least[c].append(r[0])
    want = sorted((r[0], f"{f:016x}", min(least[c])) for r, f, c in zip(rows, fps, comp))
    got = sorted(map(tuple, SH.simhash_components(docs(spark, rows)).collect()))
    assert got == want
    assert SH.simhash_components(docs(spark, [])).count() == 0


@pytest.mark.parametrize("blocks,task_rows", [(4, 100_000), (5, 40), (6, 100_000)])
def test_hamming_links_join_what_all_pairs_join(spark, blocks, task_rows, monkeypatch):
    rng = np.random.default_rng(blocks)
    seeds = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = {int(s) for s in seeds}
    hot = int(seeds[0]) & ~0xFFFFFF            # hundreds of values that share long prefixes
    fps |= {hot | int(x) for x in rng.integers(0, 1 << 24, 300)}
    for s in seeds:
        for _ in range(10):
            fps.add(int(s) ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)))
    fps = sorted(fps)
    monkeypatch.setattr(SH, "LEAF", 4)          # many leaves and nodes
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = cut(spark.createDataFrame([(f,) for f in signed], "fp long"), "test-fps")
    at = {f: k for k, f in enumerate(signed)}
    links = [(at[r.a], at[r.b]) for r in SH.hamming_links(df, 3, blocks, task_rows).collect()]
    want = [(i, j) for i, j in all_pairs(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    assert {tuple(sorted(x)) for x in links} <= set(want)
    assert components(len(fps), links) == components(len(fps), want)


def test_tables_cover_every_choice_of_differing_bits():
    rng = random.Random(1)
    for blocks in (4, 5, 6):
        masks = SH.tables(blocks, 3)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(diff & m == 0 for m in masks)


def test_keep_one_of_each(spark):
    rng = random.Random(3)
    a = words(rng, 60)
    rows = [(5, a, "en", "s"), (5, a, "en", "s"), (7, a.upper(), "en", "s"), (None, words(rng, 60), None, None), (9, None, "en", "s"), (8, "", "en", "s")]
    got = SH.keep_one_of_each(docs(spark, rows))
    assert got.columns == docs(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(5, a), (None, rows[3][1]), (8, "")], key=str)
    # columns with the operator's own names keep their values and types
    source = {5: "s", None: None, 8: "s"}
    assert all(r[c] == source[r.doc_id] for r in got.collect() for c in ("_row", "id", "fp", "kept_0", "first"))
    assert dict(got.dtypes)["_row"] == "string" and SH.keep_one_of_each(docs(spark, [])).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- suffix array ------------------------------------------------------------
def repeats_brute(rows, length):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = collections.Counter(b[p:p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for (i, *_), b in zip(rows, data):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("class_rows,task_rows", [(50_000, 20_000), (50_000, 3), (1, 20_000)])
def test_suffix_dedup(spark, class_rows, task_rows):
    rng = random.Random(11)
    passage, phrase, wave = words(rng, 45), words(rng, 17), "ab " * 120
    rows = [r for r in odd_rows(2) if r[0] != 8] + [(8, words(rng, 3000))]
    for k in range(12):
        text = words(rng, rng.randrange(5, 60))
        cut_at = rng.randrange(len(text))
        rows.append((50 + k, text[:cut_at] + (passage[k:], phrase, wave[:200 + 3 * k], passage[:201 - k], phrase + passage)[k % 5] + text[cut_at:]))
    rows.append((90, "x" * 700))                      # repeats inside one text
    rows.append((91, passage + words(rng, 5) + passage[20:]))
    got = SD.strip_repeats(docs(spark, rows), class_rows=class_rows, task_rows=task_rows)
    assert sorted(map(tuple, got.collect()), key=str) == repeats_brute(rows, 200)


def test_suffix_dedup_of_nothing(spark):
    assert SD.strip_repeats(docs(spark, [])).count() == 0
    assert SD.strip_repeats(docs(spark, [(1, None), (2, "short")])).count() == 2


def test_every_window_has_an_anchor_at_a_place_of_its_own_content(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 5000, dtype=np.uint8)
    data[3000:3600] = data[1000:1600]
    whole = SD.anchors(data, 200)
    monkeypatch.setattr(SD, "CHUNK", 700)              # pieces of a long text give the same anchors
    parts = SD.anchors(data, 200)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    p = set(whole[0].tolist())
    for w in range(0, 4800):
        assert any(x in p for x in range(w, w + 200 - SD.GRAM + 1))
    inside = {x for x in p if 1150 <= x < 1400}
    assert {x + 2000 for x in inside} <= p


def test_rounds_match_sorting():
    rng = np.random.default_rng(2)
    m = rng.integers(97, 99, (60, 30), dtype=np.uint8)
    m[10:20, 5:25] = m[0:10, 5:25]
    m[3, :4] = SD.END
    first, last = SD.repeated_columns(m, 12)
    for i in range(60):
        cols = [c for c in range(19) if SD.END not in m[i, c:c + 12] and any(j != i and (m[i, c:c + 12] == m[j, c:c + 12]).all() for j in range(60))]
        assert (first[i], last[i]) == ((cols[0], cols[-1]) if cols else (-1, -1))


# --- lines -------------------------------------------------------------------
def shingles_brute(line):
    found = re.findall(r"(?<!\S)(?=(\S.{8}))", line)
    return frozenset(found or [line])


def test_line_dedup(spark):
    rng = random.Random(5)
    long = [words(rng, 40) for _ in range(6)]
    near = [ln + f" t{k}" for k, ln in enumerate(long)]
    rows = [(1, "\n".join([long[0], "short line", long[1]])), (2, "\n".join([near[0], "short line", long[2], ""])), (3, long[0]), (None, near[2]),
            (4, None), (5, ""), (6, "\n".join([long[3]] * 3)), (6, "\n".join([long[3]] * 3)), (7, words(rng, 20_000)), (8, "  " + long[4] + " "), (9, near[4])]
    got = {(r.doc_id, r.kept_text): (r.n_lines, r.n_dropped) for r in dedup_lines(docs(spark, rows)).collect()}
    want = {(1, "\n".join(["short line", long[1]])): (3, 1), (2, "\n".join(["short line", ""])): (4, 2), (3, ""): (1, 1), (None, near[2]): (1, 0),
            (4, ""): (1, 0), (5, ""): (1, 0), (6, long[3]): (3, 2), (7, rows[8][1]): (1, 0), (8, "  " + long[4] + " "): (1, 0), (9, ""): (1, 1)}
    # the null id sorts first, so near[2] stays there and long[2] goes; long[0] is first seen in document 1
    want[(1, "\n".join([long[0], "short line", long[1]]))] = (3, 0)
    del want[(1, "\n".join(["short line", long[1]]))]
    assert got == want
    assert dedup_lines(docs(spark, [])).count() == 0


def test_line_links_recall(spark):
    rng = random.Random(9)
    lines = []
    for _ in range(120):
        ws = words(rng, 40).split()
        lines.append(" ".join(ws))
        for _ in range(rng.randrange(4)):
            ch = list(ws)
            ch[rng.randrange(40)] = words(rng, 1)
            lines.append(" ".join(ch))
    lines = sorted(set(lines))
    sets = [shingles_brute(x) for x in lines]
    pairs = [(i, j) for i, j in all_pairs(len(lines)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    df = cut(spark.createDataFrame(list(enumerate(lines)), "lid long, line string"), "test-lines")
    links = [(r.u, r.v) for r in line_links(df, cut(signatures(df, 6, 3, 5), "test-keys"), 0.8, 6, 3, 5).collect()]
    assert {tuple(sorted(x)) for x in links} <= set(pairs)
    want, got = components(len(lines), pairs), components(len(lines), links)
    assert sum(a == b for a, b in zip(want, got)) >= 0.97 * len(lines)


def test_line_links_of_a_base_with_many_edited_copies(spark):
    """Copies near the base but far from each other: components are those of all pairs that share a key."""
    rng = random.Random(3)
    base = words(rng, 42).split()
    lines = [" ".join(base)]
    for _ in range(1000):
        ws = list(base)
        for at in rng.sample(range(1, 40, 3), 2):
            ws[at] = words(rng, 1, 1000)
        lines.append(" ".join(ws))
    lines = sorted(set(lines))
    sets = [frozenset(x[i:i + 9] for i in range(len(x) - 8)) for x in lines]
    df = cut(spark.createDataFrame(list(enumerate(lines)), "lid long, line string"), "test-lines")
    keyed = cut(signatures(df, 6, 3, 5), "test-keys")
    keys = {r.lid: set(r["keys"]) for r in keyed.collect()}
    pairs = [(i, j) for i, j in all_pairs(len(lines)) if keys[i] & keys[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = components(len(lines), pairs)
    assert collections.Counter(want).most_common(1)[0][1] > 0.97 * len(lines)
    for rounds in (10, 1):                             # 1: nearly all is left to the last step
        links = [(r.u, r.v) for r in line_links(df, keyed, 0.8, 6, 3, 5, rounds).collect()]
        assert components(len(lines), links) == want


def test_line_shingles_are_all_runs_of_characters(spark):
    """Lines that differ beyond the first characters of their words only are apart; scripts without blanks are compared whole."""
    rng = random.Random(4)
    far = [("2024-01-01T00:00:01 request ok", "2024-01-01T23:59:59 request ok"), ("see https://example.org/a/1 here", "see https://example.org/zzzz/99 here")]
    wide = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(150)) + "\U0001F600" * 3
    near = [("x" + wide, "y" + wide)]                  # no word start in common
    lines = [x for pair in far + near for x in pair] + ["short", "short2"]
    df = cut(spark.createDataFrame(list(enumerate(lines)), "lid long, line string"), "test-lines")
    sets = df.select("lid", "line", shingle_hashes(F.col("line")).alias("hs")).collect()
    assert [len(r.hs) for r in sorted(sets)] == [len({x[i:i + 9] for i in range(max(1, len(x) - 8))}) for x in lines]
    links = [(r.u, r.v) for r in line_links(df, cut(signatures(df, 6, 3, 5), "test-keys"), 0.8, 6, 3, 5).collect()]
    assert {tuple(sorted(x)) for x in links} == {(4, 5)}


def test_registered_line_dedup_takes_short_lines(spark, tmp_path):
    wide = "".join(chr(0x4E00 + 7 * k) for k in range(60))
    rows = [(1, f"Yes.\none two\n\n{wide}"), (2, f"Yes.\n \none two\n{wide}\nNo."), (3, "\nYes.")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: (4, 0, rows[0][1]), 2: (5, 3, " \nNo."), 3: (2, 1, "")}


def test_line_dedup_stores_no_shingle_sets(spark):
    """No table is much larger than the texts; sets of 64-bit hashes are some 8 bytes for each character."""
    rng = random.Random(12)
    rows = []
    for k in range(300):
        ln = words(rng, 150, 5000)
        rows += [(2 * k, ln), (2 * k + 1, ln + f" t{k}")]
    df = docs(spark, rows)
    tables = lambda: set(glob.glob(spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/llm/lines-*"))
    old = tables()
    assert sum(r.n_dropped for r in dedup_lines(df).collect()) == 300
    sizes = {p: sum(os.path.getsize(f) for f in glob.glob(f"{p}/*.parquet")) for p in tables() - old}
    assert sizes and max(sizes.values()) < 2 * sum(len(x) for _, x in rows), sizes


def test_shingles_of_signatures_are_those_of_lines(spark):
    """Cut as bytes, block by block or by regular expression, short lines and block ends included."""
    rng = random.Random(13)
    wide = "".join(rng.choice("ab\u00e9\u4e2d\U0001F600") for _ in range(700))
    lines = ["a", "\u4e2d", "12345678", "123456789", *[wide[:n] for n in (8, 9, 31, 32, 33, 39, 40, 41, 64, 72, 73, 700)], *[words(rng, 200)[:n] for n in (10, 11, 12, 13, 600, 601, 900)]]
    df = cut(spark.createDataFrame(list(enumerate(lines)), "lid long, line string"), "test-lines")
    want = {r.lid: set(r.hs) for r in df.select("lid", shingle_hashes(F.col("line")).alias("hs")).collect()}
    got, firsts = collections.defaultdict(set), collections.Counter()
    for r in _shingle_rows(df, "lid").collect():
        got[r.lid] |= {r[f"h{k}"] for k in range(STRIDE)}
        firsts[r.lid] += r.first
    assert got == want and set(firsts.values()) == {1}
    texts = cut(_texts(df, df.select("lid")), "test-texts")
    assert {r.lid: set(r.hs) for r in texts.select("lid", _set("line", "bytes").alias("hs")).collect()} == want


def test_signatures_match_no_pattern_per_block(spark):
    """Lines beyond ASCII are cut as bytes too; a regular expression over them took most of the signatures' time."""
    df = spark.createDataFrame([(1, "déjà vu, déjà lu, déjà su")], "lid long, line string")
    assert "regexp_extract_all" not in signatures(df, 6, 3, 5)._jdf.queryExecution().optimizedPlan().toString()


def test_small_crowds_end_in_one_comparison(spark):
    """Three lines that share a key are far apart: one round, then all that is left at once, with the links of all pairs."""
    from twosample.llm.fuzzy_lines import similar_crowd

    rng = random.Random(21)
    lines = []
    for _ in range(40):
        base = words(rng, 40).split()
        for k in range(3):                                 # ends that differ, so that 0.7 to 0.9 of the shingles are common
            lines.append(" ".join(base[:34 + rng.randrange(4)] + words(rng, 3, 1000).split()) + f" é{k}")
    lines = sorted(set(lines))
    sets = [frozenset(x[i:i + 9] for i in range(len(x) - 8)) for x in lines]
    df = cut(spark.createDataFrame(list(enumerate(lines)), "lid long, line string"), "test-lines")
    keyed = cut(signatures(df, 6, 3, 5), "test-keys")
    keys = {r.lid: set(r["keys"]) for r in keyed.collect()}
    near = {(i, j) for i, j in all_pairs(len(lines)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    pairs = [(i, j) for i, j in all_pairs(len(lines)) if keys[i] & keys[j]]
    assert 20 < len(near & set(pairs)) < len(pairs) - 20
    tables = lambda: set(glob.glob(spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/llm/lines-marked-*"))
    old = tables()
    links = [(r.u, r.v) for r in line_links(df, keyed, 0.8, 6, 3, 5).collect()]
    assert components(len(lines), links) == components(len(lines), [p for p in pairs if p in near])
    assert len(tables() - old) == 2, tables() - old
    table = cut(spark.createDataFrame(pairs, "a long, b long"), "test-pairs")
    texts = cut(_texts(df, df.select("lid")), "test-texts")
    assert {(r.a, r.b) for r in similar_crowd(table, texts, 0.8).collect()} == near & set(pairs)
