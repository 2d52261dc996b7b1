"""N-gram join, spelling variants and filter audit against plain-Python versions."""
import collections
import itertools
import random
import re
import string
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from helpers import all_pairs, components, docs, odd_rows, words  # noqa: E402

from twosample.llm import filter_audit as FA  # noqa: E402
from twosample.llm import group_join as GJ  # noqa: E402
from twosample.llm import permuterm as PT  # noqa: E402

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def least_id(ids):
    return min((i for i in ids if i is not None), default=None)


# --- n-gram join ---------------------------------------------------------------
def join_brute(rows):
    sets = []
    for r in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (r[1] or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    def near(a, b):
        both = len(a & b)
        return both and 100 * both >= 80 * (len(a) + len(b) - both)
    comp = components(len(rows), [(i, j) for i, j in all_pairs(len(rows)) if near(sets[i], sets[j])])
    ids = collections.defaultdict(list)
    for c, r in zip(comp, rows):
        ids[c].append(r[0])
    return sorted(((r[0], len(s), least_id(ids[c])) for r, s, c in zip(rows, sets, comp)), key=str)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 9)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def join_rows():
    rng = random.Random(8)
    rows, bases = odd_rows(), [words(rng, n) for n in (30, 60, 120, 300)]
    line = words(rng, 12)
    for k, b in enumerate(bases):
        rows.append((1000 + k, b))
        rows += [(2000 + 100 * k + i, edited(rng, b, rng.choice([1, 2, 3, len(b.split()) // 45 + 1]))) for i in range(40)]
    rows += [(5000 + i, line + " " + words(rng, rng.choice([3, 20, 60]))) for i in range(40)]      # a line that many share
    rows += [(6000 + i, words(rng, 3)) for i in range(5)] + [(6100, "one two"), (6101, "ONE  two\n"), (6102, "two one")]
    # a chain: each similar to the next one only
    chain = words(rng, 200).split()
    rows += [(7000 + i, " ".join(chain[5 * i:5 * i + 120])) for i in range(10)]
    return rows


def test_ngram_join(spark, join_rows):
    got = GJ.jaccard_components(docs(spark, join_rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == join_brute(join_rows)


def test_ngram_join_does_not_depend_on_order_hubs_or_broadcasts(spark, join_rows, monkeypatch):
    # no frequencies: hubs are arbitrary; one member a chunk; keys are shuffled
    monkeypatch.setattr(GJ, "_class", lambda tokens: np.zeros(len(tokens), dtype=np.int64))
    monkeypatch.setattr(GJ, "CHUNK", 1)
    monkeypatch.setattr(GJ, "BROADCAST_KEYS", 0)
    got = GJ.jaccard_components(docs(spark, join_rows))
    assert sorted(map(tuple, got.collect()), key=str) == join_brute(join_rows)


def test_ngram_join_of_nothing(spark):
    assert GJ.jaccard_components(docs(spark, [])).count() == 0
    assert sorted(map(tuple, GJ.jaccard_components(docs(spark, [(2, None), (1, "")])).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_shingle_sets_do_not_depend_on_how_texts_are_hashed_together(monkeypatch):
    rng = random.Random(1)
    texts = [r[1] for r in odd_rows()] + ["a\0 b", "a b", "x" * 700, "x" * 700 + " y", "p q r s t " * 3, "P\tq\nr  s t p", " "] + [
        words(rng, rng.randrange(200)) for _ in range(50)]
    whole = [s.tolist() for s in GJ.shingle_sets(texts)]
    want = []
    for t in texts:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        want.append(len({tuple(w[i:i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else min(1, len(w)))
    assert [len(s) for s in whole] == want
    assert whole == [s.tolist() for t in texts for s in GJ.shingle_sets([t])]
    monkeypatch.setattr(GJ, "SEGMENT", 300)         # long texts go segment by segment
    small = [s.tolist() for s in GJ.shingle_sets(texts)]
    assert [s for s, t in zip(small, texts) if "x" * 700 not in (t or "")] == [s for s, t in zip(whole, texts) if "x" * 700 not in (t or "")]
    assert [len(s) for s in small] == want


def test_similar_sets_pass_the_filters_of_group_pairs():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randrange(1, 60)
        a = set(rng.sample(range(1000), n))
        b = set(rng.sample(sorted(a), rng.randrange(n // 2, n + 1))) | set(rng.sample(range(1000, 1100), rng.randrange(0, 8)))
        if not b or 5 * len(a & b) < 4 * len(a | b):
            continue
        x, y = sorted(a, reverse=True), sorted(b, reverse=True)
        common = [t for t in x[:GJ.prefix_size(len(x))] if t in y[:GJ.prefix_size(len(y))]]
        assert common
        for t in common:
            i, j = x.index(t), y.index(t)
            assert (min(i, j) + min(len(x) - i, len(y) - j)) * 9 >= 4 * (len(x) + len(y))
        behind = max(-(-4 * len(x) // 5), -(-4 * len(y) // 5)) - 1
        assert (len(common) + behind) * 9 >= 4 * (len(x) + len(y))


# --- spelling variants ---------------------------------------------------------
def counts_brute(rows, damage):
    n = collections.Counter()
    for r in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            if damage and h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return n


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def variants_brute(counts, min_chars=5, min_count=3):
    n = {w: c for w, c in counts.items() if len(w) >= min_chars and c >= min_count}
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and distance(v, w) == 1] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_variants(spark):
    rng = random.Random(5)
    stems = ["aaaaa", "aaaa", "banana", "bananna", "bbananaa", "hausüber", "hausuber", "éléphant", "elephant", "abcabc", "abcab", "bcabc", "abc×abc"]
    pool = stems + [s[:i] + rng.choice("abcü") + s[i + rng.randrange(2):] for s in stems for i in range(len(s))]
    rows = odd_rows() + [(100 + k, " ".join(rng.choices(pool, [1 + i % 7 * 3 for i in range(len(pool))], k=60)).title() + " 1x2\nx-ray") for k in range(40)]
    for damage in (0, 7):
        counts = counts_brute(rows, damage)
        found = PT.word_counts(docs(spark, rows), damage=damage)
        assert {r.word: r.n for r in found.collect()} == dict(counts)
        got = PT.spelling_variants(found)
        assert got.columns == COLUMNS
        want = variants_brute(counts)
        assert sorted(map(tuple, got.collect())) == want
        assert sum(w[2] != w[1] and w[1] is not None for w in want) > 0          # longer ways


def test_spelling_variants_tables(spark):
    rows = [("abcde", 5), ("abcde", 4), (None, 9), ("abcdx", None), ("abcdf", 3), ("abcdg", 3), ("abcdfg", 3), ("abcd", 99)]
    df = spark.createDataFrame(rows, "word string, n int").withColumn("root", F.lit(1)).withColumn("prefix", F.lit("p"))
    want = variants_brute({"abcde": 9, "abcdf": 3, "abcdg": 3, "abcdfg": 3})
    assert sorted(map(tuple, PT.spelling_variants(df).collect())) == want
    assert PT.spelling_variants(df.limit(0)).count() == 0
    assert PT.word_counts(docs(spark, [])).count() == 0


def test_long_ways_to_the_root(spark):
    ways = [(f"w{k:03d}", f"w{k + 1:03d}") for k in range(40)]
    got = {r.word: r.root for r in PT.roots(spark.createDataFrame(ways, "word string, form string")).collect()}
    assert got == {w: "w040" for w, _ in ways}


def test_word_counts_hand_on_what_does_not_fit(spark, monkeypatch):
    monkeypatch.setattr(PT, "HELD_WORDS", 5)
    rows = odd_rows()
    assert {r.word: r.n for r in PT.word_counts(docs(spark, rows), damage=97).collect()} == dict(counts_brute(rows, 97))


# --- filter audit --------------------------------------------------------------
def audit_brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    marked = []
    for r in rows:
        t = r[1] or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                                             re.search("[#$%&*|]", t), r[0] is not None and first[t] < r[0])) if x}
        marked.append(((r[2] if len(r) > 2 else "en") or "", fails, r[0] in good, r[0] in toxic))
    out = []
    for part in {m[0] for m in marked}:
        own, lost, lines = [m for m in marked if m[0] == part], collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            left, before = own, set()
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                lost[f] += len(gone)
                lines.append([part, "".join(order), step, len(left), len(gone), sum(f in m[1] and bool(m[1] & before) for m in own),
                              sum(m[1] == {f} for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone), f])
                before.add(f)
        out += [(*x[:9], lost[x[9]]) for x in lines]
    return sorted(out)


@pytest.fixture(scope="module")
def audit_rows():
    rng = random.Random(6)
    opening = words(rng, 12) + " "
    texts = [opening + words(rng, rng.choice([5, 190, 260]), rng.choice([2, 400])) + rng.choice(["", " #", " A|B", " LOUD" * 60]) for _ in range(60)]
    texts += ["", "a", "a\0", "a\0\0", "A", "É" * 300, opening, opening.strip()]
    rows = odd_rows() + [(rng.randrange(400), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 400, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("leaf_rows,held", [(4_000, 32 << 20), (8, 2_000)])
def test_filter_audit(spark, audit_rows, leaf_rows, held, monkeypatch):
    monkeypatch.setattr(FA, "HELD_BYTES", held)     # copies meet in tries, not in the scan; several tries a range
    rows, labels = audit_rows
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(1))
    got = FA.filter_audit(docs(spark, rows), table, leaf_rows=leaf_rows)
    assert sorted(map(tuple, got.collect())) == audit_brute(rows, labels)


def test_filter_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert FA.filter_audit(docs(spark, []), none).count() == 0
    got = FA.filter_audit(docs(spark, [(1, None, None), (2, None, None)]), none).collect()
    assert sorted(map(tuple, got)) == audit_brute([(1, None, None), (2, None, None)], [])


def test_router_steps_over_a_shared_opening(spark):
    rng = random.Random(9)
    opening = "The same first line of a great many documents. " * 20
    base = words(rng, 300)
    texts = ([opening + words(rng, 4) for _ in range(600)] + ["copy of one text"] * 400 + [words(rng, 6) for _ in range(500)]
             + [edited(rng, base, 1) for _ in range(400)] + [base] * 300)
    rng.shuffle(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    router = FA.text_router(table, leaf_rows=50, tasks=4)
    assert any(isinstance(at, int) and at >= len(opening) for at, *_ in router.nodes)
    assert len(router.nodes) < 30                   # copies edited at hundreds of places need no node each
    leaf = {t: router.leaf(t.encode()) for t in texts}
    ordered = [leaf[t] for t in sorted(leaf, key=str.encode)]
    assert ordered == sorted(ordered)               # a range partition
    held = collections.Counter(leaf[t] for t in set(texts))
    assert max(held.values()) <= 150


def test_trie_terminals_are_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode() for _ in range(400)]
    trie = FA.Trie()
    for i, t in enumerate(texts):
        trie.at(t).append(i)
    want = collections.defaultdict(list)
    for i, t in enumerate(texts):
        want[t].append(i)
    assert sorted(trie.terminals()) == sorted(want.values())
