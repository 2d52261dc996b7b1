"""N-gram Jaccard join by groups of equal prefixes.

A document is the set of its word shingles, ordered from rare to frequent.  Two sets
that are similar by 4/5 share a token in the prefix of about a fifth of each, so
documents meet under the tokens of their prefixes.  Those with the same prefix
and size form one group, which is posted once under each of its tokens, however many
documents it stands for.

The posting lists come from one sorted shuffle and are streamed; a token of one group
only leaves nothing.  Group pairs are filtered by their sizes and by the places of
each shared token, which bound the overlap, and by how many tokens their prefixes
share.  Then groups are expanded to members, the distinct texts, which are compared on
their whole sets.

No list is paired with itself.  First every group goes to one hub, the group that
most of its lists name; a list names the group in whose prefix its token comes first, which
is the one with the fewest tokens of its own, as an original is among its edited
copies.  Verified links give components, and within a component there is nothing left to
do.  What a list still holds of other components is then compared with all of the
list, so no link between two components can be missed.

Frequencies only choose the order; any order gives the same links.  They are counted over
all documents in 2 ** ``ORDER_BITS`` classes of tokens, a table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .components import connected_components

ORDER_BITS = 18                 # classes of tokens whose frequency is told: 1 MB in every task
BROADCAST_KEYS = 500_000        # keys (16 bytes each) that may be broadcast
CHUNK = 256                     # members that one task compares with a copy of their hub
SEGMENT = 1 << 18               # bytes of text hashed together
NUM, DEN = 4, 5                 # the similarity, 0.8, in whole numbers


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(SEGMENT + 1, base, dtype=np.uint64)], dtype=np.uint64)


SEPARATORS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BASE = 0x9E3779B97F4A7C15                               # odd, so it has an inverse modulo 2 ** 64
POWERS, INVERSES = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of at most ``SEGMENT`` bytes that begin and end with a blank:
    each word's polynomial in its bytes, from one running sum over all of them."""
    a = np.frombuffer(data, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(SEPARATORS[a].view(np.int8))) + 1
    starts, ends = edges[::2], edges[1::2]
    total = np.cumsum((a.astype(np.uint64) + np.uint64(1)) * POWERS[:len(a)], dtype=np.uint64)
    return starts, _mixed((total[ends - 1] - total[starts - 1]) * INVERSES[starts])


def _long_words(data: bytes) -> np.ndarray:
    """Word hashes of one text, segment by segment; each ends where a blank is.  A word
    longer than a segment gets a hash of its own kind."""
    data, at, out = b" " + data + b" ", 0, []
    while at < len(data) - 1:
        part = data[at:at + SEGMENT]
        blanks = np.flatnonzero(SEPARATORS[np.frombuffer(part, dtype=np.uint8)])
        if blanks[-1] > 0:
            out.append(_words(part[:blanks[-1] + 1])[1])
            at += int(blanks[-1])
        else:
            end = at + 1
            while not SEPARATORS[data[end]]:
                end += 1
            out.append(np.array([xxhash.xxh64_intdigest(data[at + 1:end])], dtype=np.uint64))
            at = end
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def _shingled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` word hashes."""
    x = np.full(max(0, len(h) - k + 1), k, dtype=np.uint64)
    for i in range(k):
        x = x * np.uint64(BASE) + h[i:len(x) + i]
        x ^= x >> np.uint64(29)
    return _mixed(x)


def shingle_sets(texts: Iterable[str | None], words: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles (fewer words: of
    the whole sequence; none: empty).  Words are parted by the bytes 0x20 and 0x09-0x0D, A-Z
    lower-cased.  Texts are hashed together, about ``SEGMENT`` bytes at a time."""
    def sets(h: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
        x = _shingled(h, words)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield np.unique(x[a:b - words + 1] if b - a >= words else _shingled(h[a:b], b - a)) if a < b else h[:0]

    held, size = [], 0

    def flush() -> Iterator[np.ndarray]:
        offsets = np.cumsum([1, *(len(t) + 1 for t in held)])
        starts, h = _words(b" " + b" ".join(held) + b" ")
        yield from sets(h, np.searchsorted(starts, offsets))

    for text in texts:
        data = (text or "").encode().lower()
        if held and size + len(data) + len(held) > SEGMENT - 8:
            yield from flush()
            held, size = [], 0
        if len(data) > SEGMENT - 8:
            h = _long_words(data)
            yield from sets(h, np.array([0, len(h)]))
        else:
            held.append(data)
            size += len(data)
    if held:
        yield from flush()


def prefix_size(n: int) -> int:
    """Tokens of which a set of ``n`` shares one at least with any similar set."""
    return n - -(-NUM * n // DEN) + 1


def _class(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def _count(words: int):
    """(kind 0: id, key, n; kind 1: class, count) of one task's documents (id, key, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = {}, np.zeros(1 << ORDER_BITS, dtype=np.int64)
        for b in batches:
            keys = b.column(1).to_pylist()
            new = {k: t for k, t in zip(keys, b.column(2).to_pylist()) if k not in seen}
            for key, tokens in zip(new, shingle_sets(new.values(), words)):
                seen[key] = len(tokens)
                np.add.at(counts, _class(tokens), 1)
            yield _rows(b.num_rows, kind=np.zeros(b.num_rows, np.int32), id=b.column(0), key=b.column(1), n=[seen[k] for k in keys])
        at = np.flatnonzero(counts)
        yield _rows(len(at), kind=np.ones(len(at), np.int32), id=at, n=counts[at])
    return run


COUNTED = {"kind": pa.int32(), "id": pa.int64(), "key": pa.binary(), "n": pa.int64()}
POSTED = {"token": pa.int64(), "g": pa.int64(), "size": pa.int32(), "pos": pa.int32(), "key": pa.binary()}
LISTED = {"token": pa.int64(), "g": pa.int64(), "size": pa.int32(), "pos": pa.int32(), "hub": pa.int64(), "hub_size": pa.int32(),
          "hub_pos": pa.int32(), "key": pa.binary()}


def _rows(n: int, schema: dict = COUNTED, /, **cols) -> pa.RecordBatch:
    return pa.record_batch({k: pa.nulls(n, t) if k not in cols else cols[k] if isinstance(cols[k], pa.Array) else pa.array(cols[k], t)
                            for k, t in schema.items()})


def _ddl(schema: dict) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{k} {names[t]}" for k, t in schema.items())


def _post(words: int, counts: np.ndarray):
    """Postings (token, g, size, pos) of one task's groups, and for each distinct text a row
    (token = g, pos = -1, key) that makes it a member of its group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, groups = set(), set()
        got: list[tuple] = []

        def flush() -> pa.RecordBatch:
            t, g, size, pos, key = zip(*got)
            reps = [len(x) for x in t]
            out = _rows(sum(reps), POSTED, token=np.concatenate(t).view(np.int64), g=np.repeat(np.array(g, np.uint64).view(np.int64), reps),
                        size=np.repeat(np.array(size, np.int32), reps), pos=np.concatenate(pos).astype(np.int32),
                        key=[k for k, n in zip(key, reps) for _ in range(n)])
            got.clear()
            return out
        for b in batches:
            new = {k: t for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if k not in seen}
            seen.update(new)
            for key, tokens in zip(new, shingle_sets(new.values(), words)):
                n = len(tokens)
                if not n:
                    continue
                of = _class(tokens)
                first = np.lexsort((tokens, counts[of]))[:prefix_size(n)]
                prefix = tokens[first]
                g = xxhash.xxh64_intdigest(prefix.tobytes(), n)
                got.append((np.array([g], np.uint64), g, n, np.array([-1]), key))
                if g not in groups:
                    groups.add(g)
                    got.append((prefix, g, n, np.arange(len(prefix)), None))
                if len(got) >= 500:
                    yield flush()
            if got:
                yield flush()
    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings, streamed: lists of two groups or more with their hubs, and members.
    The last row of a batch waits for the next one, nothing else is kept."""
    kept = None                 # (token, is_member, g, size, pos, key, prior is same list, hub, hub_size, hub_pos)
    for b in batches:
        token, g, size, pos = (b.column(k).to_numpy() for k in ("token", "g", "size", "pos"))
        key = np.array(b.column("key").to_pylist(), dtype=object)
        own = pos < 0
        if kept is not None:
            token, g, size, pos, own = (np.r_[np.array([kept[k]], x.dtype), x] for k, x in zip(("token", "g", "size", "pos", "own"), (token, g, size, pos, own)))
            key = np.r_[np.array([kept["key"], None], dtype=object)[:1], key]
        if not len(token):
            continue
        keep = np.r_[True, (token[1:] != token[:-1]) | (own[1:] != own[:-1]) | (g[1:] != g[:-1]) | (own[1:] & (key[1:] != key[:-1]))]
        token, g, size, pos, own, key = (x[keep] for x in (token, g, size, pos, own, key))
        n = len(token)
        same = np.r_[False, (token[1:] == token[:-1]) & (own[1:] == own[:-1])]        # as the row before
        start = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        hub, hub_size, hub_pos = g[start], size[start], pos[start]
        if kept is not None and kept["same"]:
            of = start == 0     # rows of the list that began in an earlier batch
            hub[of], hub_size[of], hub_pos[of], same[0] = kept["hub"], kept["hub_size"], kept["hub_pos"], True
        done = n - 1
        listed = np.flatnonzero(~own[:done] & (same[:done] | same[1:]))
        if len(listed):
            yield _rows(len(listed), LISTED, token=token[listed], g=g[listed], size=size[listed], pos=pos[listed], hub=hub[listed],
                        hub_size=hub_size[listed], hub_pos=hub_pos[listed])
        members = np.flatnonzero(own[:done])
        if len(members):
            yield _rows(len(members), LISTED, g=g[members], pos=pos[members], key=list(key[members]))
        kept = {"token": token[-1], "g": g[-1], "size": size[-1], "pos": pos[-1], "own": own[-1], "key": key[-1], "same": bool(same[-1]),
                "hub": hub[-1], "hub_size": hub_size[-1], "hub_pos": hub_pos[-1]}
    if kept is not None and (kept["own"] or kept["same"]):
        cols = {k: [kept[k]] for k in (("g", "pos", "key") if kept["own"] else ("token", "g", "size", "pos", "hub", "hub_size", "hub_pos"))}
        yield _rows(1, LISTED, **cols)


def _can_be_similar(size: Column, pos: Column, other_size: Column, other_pos: Column) -> Column:
    """Whether two sets with a common token at these places can be similar: what both have in
    front of it, it itself and what both have behind it make the overlap at most."""
    most = F.least(pos, other_pos) + F.least(size - pos, other_size - other_pos)
    return most * F.lit(NUM + DEN) >= F.lit(NUM) * (size + other_size)


def _enough_shared(shared: Column, size: Column, other_size: Column) -> Column:
    """Whether two sets with that many common tokens in their prefixes can be similar: common
    tokens that are not in both prefixes lie behind the prefix that ends first."""
    behind = F.greatest(F.ceil(size * F.lit(NUM) / F.lit(DEN)), F.ceil(other_size * F.lit(NUM) / F.lit(DEN))) - 1
    return (shared + behind) * F.lit(NUM + DEN) >= F.lit(NUM) * (size + other_size)


def _verify(words: int):
    """Links (a, b) among the sorted rows (a, chunk, role, b, text): a hub's text, then its members'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, at = None, None
        for b in batches:
            out, cols = [], [c.to_pylist() for c in b.columns]
            for a, chunk, role, other, tokens in zip(*cols[:4], shingle_sets(cols[4], words)):
                if role == 0:
                    hub, at = tokens, (a, chunk)
                elif at == (a, chunk):
                    both = len(np.intersect1d(hub, tokens, assume_unique=True))
                    if both and DEN * both >= NUM * (len(hub) + len(tokens) - both):
                        out.append((a, other))
            if out:
                u, v = zip(*out)
                yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def verified(pairs: DataFrame, nodes: DataFrame, base: DataFrame, words: int, tasks: int) -> DataFrame:
    """(u, v): the ``pairs`` (a, b; numbers of ``nodes``) whose whole sets are similar.  Only their
    texts leave ``base`` (key, text).  A hub's text goes once to every ``CHUNK`` of its members."""
    ends = cut(pairs.select(F.col("a").alias("num")).union(pairs.select("b")).distinct().join(nodes, "num"), "join-ends")
    keys = F.broadcast(ends.select("key")) if ends.count() <= BROADCAST_KEYS else ends.select("key")
    # the first of equal texts, where it is read
    texts = base.join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    texts = cut(texts.join(ends, "key").select("num", "text"), "join-texts")
    stars = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(stars, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"))
    members = dealt.join(texts.withColumnRenamed("num", "b"), "b").select("a", "chunk", F.lit(1).alias("role"), "b", "text")
    hubs = stars.join(texts.withColumnRenamed("num", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("role"), F.col("a").alias("b"), "text")
    rows = hubs.unionByName(members).repartition(tasks, "a", "chunk").sortWithinPartitions("a", "chunk", "role")
    return cut(rows.mapInArrow(_verify(words), "u long, v long"), "join-links")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    A set holds a text's distinct shingles of ``words`` words (fewer words: the whole
    sequence as one); texts without words, or null, have the empty set and link with
    nothing.  Rows link whose sets have at least 4/5 of their union in common; component_id
    is the smallest doc_id that links lead to, the row's own included.  Equal texts
    with words link; a component of null ids only has a null component_id; rows without words
    keep their own id.  An empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    counted = cut(base.mapInArrow(_count(words), _ddl(COUNTED)), "join-counted")
    rows = counted.filter("kind = 0").select("id", "key", "n")
    counts = np.zeros(1 << ORDER_BITS, dtype=np.int64)
    found = counted.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toPandas()      # at most one row a class
    counts[found["id"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)

    posted = base.select("key", "text").mapInArrow(_post(words, counts), _ddl(POSTED))
    lists = cut(posted.repartition(tasks, "token").sortWithinPartitions("token", "pos", "size", "g", "key").mapInArrow(_lists, _ddl(LISTED)), "join-lists")
    members, lists = lists.filter("pos < 0").select("g", "key"), lists.filter("pos >= 0").drop("key")
    # distinct texts that may link: of groups that meet another one, or that hold several; numbered, and written so that they stay
    meet = lists.select("g").union(members.groupBy("g").count().filter("count > 1").select("g")).distinct()
    wanted = members.join(meet, "g")
    nodes = cut(wanted.select("key").distinct().withColumn("num", F.monotonically_increasing_id()), "join-nodes")
    of = cut(wanted.join(nodes, "key").select("g", "num"), "join-members")
    base = base.select("key", "text")

    near = _can_be_similar(F.col("size"), F.col("pos"), F.col("hub_size"), F.col("hub_pos"))
    votes = lists.filter("g <> hub").filter(near).groupBy("g", "hub").agg(F.count("*").alias("votes"))
    best = votes.groupBy("g").agg(F.max(F.struct("votes", "hub")).alias("best")).select("g", F.col("best.hub").alias("hub"))
    # how many tokens the two prefixes share, in the lists of whatever hub
    mine = lists.join(best.withColumnRenamed("hub", "h"), "g").select("g", "h", "token", "size")
    theirs = lists.select(F.col("g").alias("h"), "token", F.col("size").alias("h_size"))
    best = (mine.join(theirs, ["h", "token"]).groupBy("g", "h").agg(F.count("*").alias("shared"), F.first("size").alias("size"), F.first("h_size").alias("h_size"))
            .filter(_enough_shared(F.col("shared"), F.col("size"), F.col("h_size"))).select("g", F.col("h").alias("hub")))
    least = of.groupBy("g").agg(F.min("num").alias("a"))
    # each member of a group with the first member of its hub, and with that of its own group
    pairs = cut(of.join(best, "g").join(least.withColumnRenamed("g", "hub"), "hub").select("a", F.col("num").alias("b"))
                .union(of.join(least, "g").filter("num <> a").select("a", F.col("num").alias("b"))), "join-pairs")
    links = verified(pairs, nodes, base, words, tasks)

    comp = cut(connected_components(links), "join-components")
    named = cut(of.join(comp, F.col("num") == F.col("node"), "left").select("g", "num", F.coalesce("component", "num").alias("c")), "join-named")
    # a group lies in one component, or counts as one of its own (a negative number)
    where = named.groupBy("g").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).select(
        "g", F.when(F.col("c0") == F.col("c1"), F.col("c0")).otherwise(F.col("g").bitwiseOR(F.lit(-(1 << 63)))).alias("c"))
    placed = lists.select("token", "g", "size", "pos").join(where, "g")
    main = (placed.groupBy("token", "c").agg(F.count("*").alias("n")).groupBy("token")
            .agg(F.max(F.struct("n", "c")).alias("main"), F.count("*").alias("components")).filter("components > 1")
            .select("token", F.col("main.c").alias("main")))
    placed = cut(placed.join(main, "token"), "join-placed")
    # tokens a group has in these lists from here on: at the first common token of two groups, all that they share
    in_order = Window.partitionBy("g").orderBy(F.desc("pos"))
    placed = placed.withColumn("rest", F.row_number().over(in_order))          # at most a prefix of rows a group
    small = placed.filter("c <> main")
    other = placed.select(F.col("token").alias("t"), F.col("g").alias("g2"), F.col("size").alias("size2"), F.col("pos").alias("pos2"), F.col("c").alias("c2"),
                          F.col("rest").alias("rest2"))
    # a similar pair passes both filters at the first token it shares
    across = small.join(other, (F.col("token") == F.col("t")) & (F.col("c") != F.col("c2")) & ((F.col("c2") == F.col("main")) | (F.col("g") < F.col("g2")))
                        & _can_be_similar(F.col("size"), F.col("pos"), F.col("size2"), F.col("pos2"))
                        & _enough_shared(F.least("rest", "rest2"), F.col("size"), F.col("size2")))
    across = across.select(F.least("g", "g2").alias("g"), F.greatest("g", "g2").alias("g2")).distinct()
    mixed = where.filter("c < 0").select("g", F.col("g").alias("g2"))
    there = named.select(F.col("g").alias("g2"), F.col("num").alias("b"), F.col("c").alias("cb"))
    seen = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = (across.union(mixed).join(named.withColumnRenamed("num", "a"), "g").join(there, "g2").filter("c <> cb and (g <> g2 or a < b)")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(seen, ["a", "b"], "left_anti"))
    more = verified(cut(left, "join-left"), nodes, base, words, tasks)

    comp = connected_components(links.union(more))
    # smallest id of each text, then of each component; a text without a partner is its own
    by_key = rows.filter("n > 0").groupBy("key").agg(F.min("id").alias("first"))
    linked = cut(nodes.join(comp, F.col("num") == F.col("node")).select("key", F.col("component").alias("c")).join(by_key, "key"), "join-linked")
    least = linked.join(linked.groupBy("c").agg(F.min("first").alias("least")), "c").select("key", "least")
    final = by_key.join(least, "key", "left").select("key", F.coalesce("least", "first").alias("component"))
    return rows.join(final, "key", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                                  F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"))
