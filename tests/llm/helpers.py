"""Small tables for the operators' tests, and plain-Python versions of them."""
import itertools
import random

EXTRA = ["h", "id", "size", "fp", "key", "node", "line", "score", "held_out", "v", "u", "path", "_row", "copies", "tokens",
         "bucket", "th", "x", "first", "component", "label", "kept_0", "d", "shard", "part", "rounds"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=True):
    """rows: (doc_id, text[, lang, source]); extra columns have names that operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        for c in EXTRA:
            df = df.withColumn(c, df.source)
    return df.repartition(3)


def words(rng, n, vocab=400):
    return " ".join(f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(vocab):03d}"[::-1] for _ in range(n))


def odd_rows(seed=1):
    """Nulls, empty and blank texts, repeated rows, one very long text, characters beyond ASCII."""
    rng = random.Random(seed)
    a, b = words(rng, 90), words(rng, 120)
    return [(1, None, None, None), (2, "", "en", None), (3, " \n\t ", None, "src1"), (4, a, "en", "src1"), (5, a, "en", "src2"),
            (5, a, "en", "src2"), (None, b, "de", "src1"), (6, b + " x", "de", None), (7, "é ß 日本 😀 " * 30, "fr", "src1"),
            (8, words(rng, 30_000), "en", "src1"), (9, "!!! ... 123", "en", "src1"), (10, b, "de", "src1"), (-3, "ab", "en", "src1"),
            (11, "one\ntwo\n\nthree", "en", "src0")]


def components(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, j in pairs:
        p, q = find(i), find(j)
        up[max(p, q)] = min(p, q)
    return [find(i) for i in range(n)]


def all_pairs(n):
    return itertools.combinations(range(n), 2)
