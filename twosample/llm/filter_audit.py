"""Filter interaction audit: what each order of a set of filters removes.

Five filters, four on a text alone and one on identical texts, give each document
a mask of the filters that it fails.  All orders are then sums over masks.

Identical texts are found with radix tries.  Texts are range-partitioned by
prefixes that adapt to the data: a node of the router cuts the next six bytes of its
texts into ranges of about equal counts.  Where one value of these bytes holds more
than a range's share, a child cuts its texts by where they leave the path of one of
them, so a line that opens a third of all documents is stepped over at once, and
so are thousands of edited copies.  Every task inserts the full texts of its ranges, in order, into one
compressed trie per range (a range larger than memory gets several); a terminal holds the smallest id seen for its text,
with what is needed of the rows that carry it.  A larger id is a duplicate at once; a
smaller one turns the holder out as a duplicate.  The traversal at the end gives the
rows of the smallest ids.  Before that, each task of the scan collapses its own copies
by the same rule, so a text in a third of all rows is a few rows when it moves.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

FILTERS = "ABCDE"
DUPLICATE = 16                  # the mask's bit of filter E
SYMBOL = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(65, 91))
DIGIT = 6                       # bytes that a node looks at: the sketch holds them as doubles, whole below 53 bits
HELD_BYTES = 32 << 20           # texts that a task holds at once, to collapse copies or in a trie
LEAF_ROWS = 4_000               # rows a range should hold
LONGEST = 1 << 40               # more than any text's bytes
MOST_RANGES = 10_000            # of one node; a larger table gets larger ranges, not a larger sketch


def text_mask(text: bytes) -> int:
    """Which of the filters A to D a text fails, as bits 1, 2, 4, 8."""
    words = text.split()                        # at the bytes 0x20 and 0x09-0x0D
    points = len(text) if text.isascii() else len(text.decode())
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * capitals > 3 * points) << 2 | (SYMBOL.search(text) is not None) << 3)


class Trie:
    """Compressed trie of byte strings; ``at(text)`` is the mutable terminal of a text."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]       # label, children by first byte, terminal

    def at(self, text: bytes) -> list:
        node, pos = self.root, 0
        while pos < len(text):
            child = node[1].get(text[pos])
            if child is None:
                new = [text[pos:], {}, []]
                node[1][text[pos]] = new
                return new[2]
            label = child[0]
            if not text.startswith(label, pos):
                same = shared_prefix(label, text[pos:pos + len(label)])
                upper = [label[:same], {label[same]: child}, None]
                child[0] = label[same:]
                node[1][text[pos]] = child = upper
            node, pos = child, pos + len(child[0])
        if node[2] is None:
            node[2] = []
        return node[2]

    def terminals(self) -> Iterator[list]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2]:
                yield node[2]
            stack.extend(node[1].values())


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:                              # a[:lo] == b[:lo] holds throughout
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return lo


def claim(terminal: list, doc: int | None, lang: str | None, mask: int, count: int, out: list) -> None:
    """A row meets the terminal of its text: [smallest id, mask, {lang: rows}].
    Rows that cannot be the smallest go to ``out`` as (id, lang, mask, rows)."""
    if doc is None:                             # not comparable, so never a duplicate
        out.append((None, lang, mask, count))
    elif not terminal:
        terminal[:] = doc, mask, {lang: count}
    elif doc == terminal[0]:
        terminal[2][lang] = terminal[2].get(lang, 0) + count
    elif doc > terminal[0]:
        out.append((doc, lang, mask | DUPLICATE, count))
    else:
        out.extend((terminal[0], x, terminal[1] | DUPLICATE, n) for x, n in terminal[2].items())
        terminal[:] = doc, mask, {lang: count}


def _digit(text: Column, depth: Column) -> Column:
    """The ``DIGIT`` bytes of a text behind ``depth`` bytes, as a number (zeros behind its end)."""
    part = F.rpad(F.hex(F.substring(text.cast("binary"), depth + 1, F.lit(DIGIT))), 2 * DIGIT, "0")
    return F.conv(part, 16, 10).cast("long")


def path_code(text: bytes, path: bytes) -> int:
    """A number that orders texts as their bytes do, told by where they leave ``path``:
    the earlier a text does, the smaller or the larger it is."""
    if text == path:
        return 0
    at = shared_prefix(text, path)
    return (at - LONGEST) if text < path else (LONGEST - at)


class Router:
    """Nodes (depth or path, cut points, {code: child}) of the adaptive prefixes.  A node
    with a depth tells texts apart by the bytes there, one with a path by where they leave
    it.  ``leaf`` numbers a text's range, in text order."""

    def __init__(self) -> None:
        self.nodes: list[tuple[int | bytes, list[int], dict[int, int]]] = []
        self.first: dict[tuple[int, int], int] = {}
        self.leaves = 0

    def number(self, node: int = 0) -> None:
        """Numbers the ranges below a node: range, child, range, child, ..."""
        _, cuts, children = self.nodes[node]
        for k in range(len(cuts) + 1):
            self.first[node, k] = self.leaves
            self.leaves += 1
            if k < len(cuts) and cuts[k] in children:
                self.number(children[cuts[k]])

    def leaf(self, text: bytes) -> int:
        node = 0
        while True:
            at, cuts, children = self.nodes[node]
            if isinstance(at, bytes):
                code = path_code(text, at)
            else:
                code = int.from_bytes(text[at:at + DIGIT].ljust(DIGIT, b"\0"), "big")
            if code not in children:
                # a heavy code without a child (equal texts) has the range in front of its cut
                return self.first[node, bisect_left(cuts, code)]
            node = children[code]


def _path_codes(paths: dict[int, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [path_code(t.encode(), paths[k]) for k, t in zip(b.column("node").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes, pa.int64())], names=[*b.schema.names, "code"])
    return run


def text_router(texts: DataFrame, leaf_rows: int = LEAF_ROWS, tasks: int = 12) -> Router:
    """Adaptive prefixes of ``texts`` (text, not null; id) so that a range holds about
    ``leaf_rows`` rows, or fewer so that there are a few ranges a task.

    Rounds take turns.  One cuts the bytes at its nodes' depths by a quantile sketch each;
    bytes that are two cut points in a row are heavy, and their texts go on to a node
    with a path, some text of theirs.  The next round cuts these nodes by the places at which texts leave
    the path, so texts with a long shared prefix, or copies edited at many places, are
    parted at once; a heavy place gives a node with that depth.  Only texts of heavy codes
    are written for the next round.  What reaches the driver is a few numbers a range
    and a text a path."""
    spark, router, share = texts.sparkSession, Router(), None
    open_nodes: list[tuple] = [(None, None, 0)]         # (parent, its code, depth)
    rows = texts.select("text", "id", F.lit(0).alias("node"))
    by_path = False
    while open_nodes:
        sizes = {r.node: r.n for r in rows.groupBy("node").agg(F.count("*").alias("n")).collect()}
        if share is None:
            share = max(1, min(leaf_rows, sum(sizes.values()) // (4 * tasks)))
        if by_path:
            some = rows.groupBy("node").agg(F.min_by("text", F.xxhash64("text", "id")).alias("path"))
            at = {r.node: r.path.encode() for r in some.collect()}
            coded = rows.mapInArrow(_path_codes(at), "text string, id long, node int, code long")
        else:
            at = {k: depth for k, (_, _, depth) in enumerate(open_nodes)}
            depths = F.get(F.array(*[F.lit(d) for _, _, d in open_nodes]), F.col("node"))
            coded = rows.withColumn("code", _digit(F.col("text"), depths))
        most = max(1, min(max(sizes.values(), default=0) // share, MOST_RANGES))
        marks = {r.node: r.q for r in coded.groupBy("node").agg(
            F.percentile_approx("code", [k / most for k in range(1, most + 1)], 20 * most).alias("q")).collect()}
        heavy = []
        for k, (parent, code, depth) in enumerate(open_nodes):
            every = max(1, most // max(1, sizes.get(k, 0) // share))       # a smaller node has fewer ranges
            q, node = marks.get(k, [])[every - 1:most - 1:every], len(router.nodes)
            router.nodes.append((at.get(k, 0), sorted(set(q)), {}))
            if parent is not None:
                router.nodes[parent][2][code] = node
            for x in sorted({x for x, y in zip(q, q[1:]) if x == y}):
                below = depth + DIGIT if not by_path else LONGEST - abs(x)
                if not by_path or x and below >= depth:         # else equal texts, or trailing zero bytes: nothing to part
                    heavy.append((k, x, node, below))
        open_nodes = [(node, x, below) for _, x, node, below in heavy]
        if heavy:
            keys = spark.createDataFrame([(k, x, i) for i, (k, x, *_) in enumerate(heavy)], "node int, code long, to int")
            rows = cut(coded.join(F.broadcast(keys), ["node", "code"]).select("text", "id", F.col("to").alias("node")), "audit-heavy")
        by_path = not by_path
    router.number()
    return router


def fail_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
               leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(id, part, mask, rows): the mask of failed filters of every row of ``docs``, rows
    alike in all three counted together.

    Null texts count as empty; a row with a null id is no duplicate, nor is
    any a duplicate of it; rows that share id and text are no duplicates of each other."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    router = text_router(rows.select("text", "id"), leaf_rows, tasks)
    schema = "id long, part string, mask int, rows long, leaf int, text binary"

    def batch(found: list, leaves: list | None = None, texts: list | None = None) -> pa.RecordBatch:
        cols = list(zip(*found)) or [()] * 4
        none = [None] * len(found)
        return pa.record_batch({"id": pa.array(cols[0], pa.int64()), "part": pa.array(cols[1], pa.string()), "mask": pa.array(cols[2], pa.int32()),
                                "rows": pa.array(cols[3], pa.int64()), "leaf": pa.array(leaves or none, pa.int32()), "text": pa.array(texts or none, pa.binary())})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size, out = 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            rows_, leaves, texts = [], [], []
            for text, t in held.items():
                for part, n in (t[2] if t else {}).items():
                    rows_.append((t[0], part, t[1], n))
                    leaves.append(router.leaf(text))
                    texts.append(text)
            for at in range(0, len(rows_), 500):
                yield batch(rows_[at:at + 500], leaves[at:at + 500], texts[at:at + 500])
            held.clear()

        for b in batches:
            for doc, part, text in zip(*(c.to_pylist() for c in b.columns)):
                text = text.encode()
                t = held.get(text)
                if t is None:
                    t, size = held.setdefault(text, []), size + len(text)
                claim(t, doc, part, t[1] if t else text_mask(text), 1, out)
                if size > HELD_BYTES:
                    yield from flush()
                    size = 0
            if out:
                yield batch(out)
                out = []
        yield from flush()

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        out: list[tuple] = []
        trie, size, range_, last = Trie(), 0, None, None
        for doc, part, mask, n, leaf, text in each():
            # a range that is larger than memory goes on in a new trie, between two different texts
            if leaf != range_ or size > HELD_BYTES and text != last:
                out.extend((t[0], p, t[1], m) for t in trie.terminals() for p, m in t[2].items())
                trie, size, range_ = Trie(), 0, leaf
            if leaf is None:
                out.append((doc, part, mask, n))
            else:
                claim(trie.at(text), doc, part, mask, n, out)
                size, last = size + (len(text) if text != last else 0), text
            if len(out) >= 20_000:
                yield batch(out).select(["id", "part", "mask", "rows"])
                out.clear()
        out.extend((t[0], p, t[1], m) for t in trie.terminals() for p, m in t[2].items())
        if out:
            yield batch(out).select(["id", "part", "mask", "rows"])

    # rows that are settled in the scan have no leaf; a hash of the id spreads them
    dealt = rows.mapInArrow(scan, schema).repartition(tasks, "leaf", F.when(F.col("leaf").isNull(), F.xxhash64("id", "part", "mask")))
    return dealt.sortWithinPartitions("leaf", "text").mapInArrow(insert, "id long, part string, mask int, rows long")


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step, from ``masks`` (part, mask, n,
    good, toxic): part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.  An empty table gives an empty result."""
    every = 1 << len(filters)
    sums = masks.groupBy("part").agg(*[F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long") for m in range(every)]).alias(c)
                                       for c in ("n", "good", "toxic")])

    def total(of: str, holds) -> Column:
        """Sum of a count over the masks for which ``holds(mask)``."""
        chosen = F.filter(F.sequence(F.lit(0), F.lit(every - 1)), holds)
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda s, m: s + F.get(F.col(of), m))

    orders = []
    for order in permutations(filters):
        seen = 0
        for step, f in enumerate(order, 1):
            bit = 1 << filters.index(f)
            orders.append(f"('{''.join(order)}', {step}, {seen}, {bit})")
            seen |= bit
    # an array of literals: each part's row meets all steps without a join
    steps = F.expr("array(" + ", ".join(f"struct{o}" for o in orders) + ")")
    rows = sums.select("*", F.explode(steps).alias("s")).select("part", "n", "good", "toxic", F.col("s.col1").alias("filter_order"),
                                                                F.col("s.col2").alias("step"), F.col("s.col3").alias("seen"), F.col("s.col4").alias("bit"))
    seen, bit, zero = F.col("seen"), F.col("bit"), F.lit(0)

    def gone_here(m: Column) -> Column:
        return (m.bitwiseAND(bit) != zero) & (m.bitwiseAND(seen) == zero)
    # in as many orders as not, each filter that a document fails comes first of them
    fact = 1
    for k in range(2, len(filters) + 1):
        fact *= k
    share = F.aggregate(F.sequence(zero, F.lit(every - 1)), F.lit(0).cast("long"), lambda s, m: s + F.when(
        m.bitwiseAND(bit) != zero, F.get(F.col("n"), m) * (F.lit(fact) / F.bit_count(m)).cast("long")).otherwise(F.lit(0)))
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda m: m.bitwiseAND(seen.bitwiseOR(bit)) == zero).alias("kept"),
        total("n", gone_here).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) != zero) & (m.bitwiseAND(seen) != zero)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", gone_here).alias("good_lost"),
        total("toxic", gone_here).alias("toxic_lost"),
        share.alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                 leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The audit of the five filters per value of ``part_col`` (null: empty string), with what
    the orders cost in rows labelled quality 1 and toxic 1.

    A: under 200 words; B: fewer distinct words than half the words; C: A-Z over 3 % of the
    code points; D: any of ``#$%&*|``; E: the text of a smaller id.  ``labels`` (doc_id, quality,
    toxic) may repeat an id, which then counts as 1 if any row says so; null ids have
    no label.  Rows that repeat id and text count each.  No documents: no rows."""
    masks = fail_masks(docs, id_col, text_col, part_col, leaf_rows).groupBy("id", "part", "mask").agg(F.sum("rows").alias("n"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    some = masks.join(marks, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce("good", F.lit(0)) * F.col("n")).alias("good"), F.sum(F.coalesce("toxic", F.lit(0)) * F.col("n")).alias("toxic"))
    return audit(some)
