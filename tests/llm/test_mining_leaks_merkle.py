"""Hard negatives, benchmark decontamination and the Merkle manifest against plain versions, and queries against their SQL."""

import glob
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from oracle import differences
from pyspark.sql import functions as F

from feedmill.catalogue.base import Query
from feedmill.llm import hard_negatives, merkle, queries, winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    assert differences(Query(name, queries.QUERIES[name], queries.SQL[name]), spark, folder, con) is None


# -- hard negatives


def plain_negatives(rows):
    """rows: (id, label, integers), distinct."""
    out = Counter()
    for a in rows:
        if a[0] is None or a[0] % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), 1 << 63 if b[0] is None else b[0], b[0], b[1]) for b in rows if b is not a and len(a[2]) == len(b[2])]
        scored.sort(key=lambda s: s[:2])
        for p in [s for s in scored if s[3] == a[1]][:5]:
            fit = [s for s in scored if s[3] != a[1] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:10]
            for rank, s in enumerate(fit, 1):
                out[a[0], p[2], rank, s[2], -p[0], -s[0]] += 1
    return out


@pytest.mark.parametrize("shard_rows", [8192, 100])
def test_hard_negatives(spark, shard_rows):
    random = np.random.default_rng(5)
    centre = random.normal(size=(12, 8))
    x = (centre[random.integers(0, 12, 900)] + random.normal(size=(900, 8)) * 0.7).round(2)
    x[::9] = x[3]  # ties
    rows = [(k, [float(v) for v in row], int(random.integers(0, 10))) for k, row in enumerate(x)]
    rows += [rows[4], rows[100], (100, rows[7][1], 3), (None, rows[5][1], rows[5][2]), (None, rows[5][1], (rows[5][2] + 1) % 10)]
    rows += [(1000 + k, [float(v) for v in random.normal(size=3)], k % 3) for k in range(0, 300, 5)] + [(2000, [], 1), (2001, [], 1), (2002, [], 2), (2100, [0.0] * 8, 1)]
    out = [(3000, None, 1), (3100, [1.0] * 8, None), (3200, [float("nan")] * 8, 1), (3300, [None] * 8, 1), (3400, [float("inf")] * 8, 1)]
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows + out], "vec_id long, embedding array<double>, label int, score string")
    got = Counter(map(tuple, hard_negatives.hard_negatives(df, F.expr("vec_id % 100 = 0"), shard_rows=shard_rows).collect()))
    whole = {(i, lab, tuple(int(np.floor(256 * a)) for a in v)) for i, v, lab in rows}
    assert got == plain_negatives(list(whole))
    assert hard_negatives.hard_negatives(df.limit(0), F.expr("vec_id % 100 = 0")).count() == 0


def test_threshold_stops_early():
    """Long tails are not read: rows far along one dimension settle the search."""
    x = np.zeros((4096, 2), np.int64)
    x[:, 0] = np.arange(4096)
    shard = hard_negatives.Shard(np.arange(4096), np.zeros(4096, np.int64), x)
    read = []
    shard.vectors = type("Seen", (), {"__getitem__": lambda self, rows: (read.append(len(rows)), x[rows])[1], "__len__": lambda self: 4096})()
    ((places, scores),) = shard.search(np.array([3, 0]), np.ones(4096, bool), [(1, -(1 << 40), 1 << 40)], 5)
    assert places.tolist() == [4095, 4094, 4093, 4092, 4091] and scores[0] == 3 * 4095 and sum(read) < 200


def test_anchors_of_a_block_fetch_rows_together():
    """Rows are fetched once for all anchors of a block, few times, and each anchor gets what a scan of all rows gives."""
    random = np.random.default_rng(13)
    x = random.integers(-300, 300, (3000, 16))
    x[::50] = x[7]  # ties
    labels = random.integers(0, 3, 3000)
    shard = hard_negatives.Shard(np.arange(3000), labels, x)
    fetched = []
    shard.vectors = type("Seen", (), {"__getitem__": lambda self, rows: (fetched.append(len(rows)), x[rows])[1], "__len__": lambda self: 3000})()
    anchors = np.concatenate([x[:40], np.zeros((1, 16), np.int64), np.full((1, 16), 1 << 20)])
    windows = [[(1, -(1 << 62), 1 << 62), (100, 30 * 400_000, 90 * 400_000)]] * 41 + [[]]
    got = shard.search_all(anchors, lambda a: labels != a % 3, windows, 10)
    assert sum(fetched) <= 3000 and len(fetched) <= 8
    for a, results in enumerate(got):
        scores = x @ anchors[a]
        for (factor, low, high), (places, found) in zip(windows[a], results):
            all_of = np.flatnonzero((labels != a % 3) & (factor * scores >= low) & (factor * scores <= high))
            want = all_of[np.lexsort((all_of, -scores[all_of]))][:10]
            assert places.tolist() == want.tolist() and found.tolist() == scores[want].tolist()
    assert got[41] == []


# -- decontamination


def plain_leaks(docs, bench, window=10):
    def words(text):
        return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    items = defaultdict(set)
    for item, text in bench:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if n else ():
            items[tuple(w[i : i + n])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in items}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in items:
                    hit |= set(range(i, i + n))
                    found |= items[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), ",".join(sorted(str(i) for i in found if i is not None))))
    return Counter(out)


def leaks(found):
    return Counter((r["doc_id"], r["n_words"], sum(s["words"] for s in r["spans"]), ",".join(r["items"])) for r in found.collect())


def test_contamination(spark, monkeypatch):
    random = np.random.default_rng(6)
    vocabulary = ["alpha", "Beta", "γάμμα", "d4", "É", "the", "of"]

    def prose(n):
        return " ".join(vocabulary[k] for k in random.integers(0, 7, n))

    bench = [(k, prose(int(random.integers(1, 40)))) for k in range(60)] + [(60, None), (61, ""), (62, "... !"), (63, "rare"), (63, "rare"), (None, "nobody's own words"), (64, prose(300))]
    texts = [t for _, t in bench if t and len(t) > 30]
    docs = [(k, prose(int(random.integers(0, 200))) + ", " + texts[k % len(texts)].upper() + ". " + prose(20)) for k in range(80)]
    docs += [(100, None), (101, ""), (102, "a rare word; nobody's own words"), (103, texts[0]), (103, texts[0]), (103, "other"), (None, texts[1]), (104, " ".join(texts) * 40), (105, "x\0rare\x7fy")]
    made = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n_words int, span string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    want = plain_leaks(docs, bench)
    assert leaks(winnowing.contamination(made, items)) == want
    monkeypatch.setattr(winnowing, "PIECE", 50)  # texts of many pieces
    assert leaks(winnowing.contamination(made, items)) == want
    assert leaks(winnowing.contamination(made, items, window=4)) == plain_leaks(docs, bench, 4)
    assert leaks(winnowing.contamination(made, items.limit(0))) == Counter((d, n, 0, "") for d, n, _, _ in want.elements())
    assert winnowing.contamination(made.limit(0), items).count() == 0


def test_winnowing_keeps_one_of_every_window():
    words = winnowing.Words(["a b c d e f g h i j k l m n o p a b c d e f g h i j k", "x", "", "a b c d e f g h i j"])
    for span in range(1, 11):
        k = winnowing.gram_words(span)
        kept = set(winnowing.fingerprints(words, span)[0].tolist())
        for p in np.flatnonzero(words.whole(span)).tolist():
            assert any(s in kept for s in range(p, p + span - k + 1))


# -- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, arity):
    """Root and each leaf's (left, right) pairs."""
    nodes = [(d, [k]) for k, d in enumerate(leaves)]
    proofs = [[] for _ in leaves]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for k, (_, below) in enumerate(run):
                for leaf in below:
                    proofs[leaf].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
            above.append((h(*[d for d, _ in run]), [leaf for _, below in run for leaf in below]))
        nodes = above
    return nodes[0][0], proofs


def plain_manifest(rows, arity):
    def leaf(r, more=0):
        values = [r[0], r[1], r[2], r[3] if r[3] is None else r[3] + more, r[4]]
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    groups = defaultdict(list)
    for r in rows:
        tampers = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        groups[r[2]].append((r[0] is not None, r[0], leaf(r), leaf(r, int(tampers))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2]))], arity) for g in names}
    root, tops = plain_tree([trees[g][0] for g in names], arity)
    out = Counter()
    for g, top in zip(names, tops):
        for (_, doc, own, claimed), proof in zip(sorted(groups[g], key=lambda x: (x[0], x[1] or 0, x[2])), trees[g][1]):
            folded = claimed
            for left, right in proof + top:
                folded = h(left, folded, right)
            out[doc, own, trees[g][0], root, h(*[a + b for a, b in proof + top]), folded, folded == root] += 1
    return out


@pytest.mark.parametrize("arity,levels", [(2, 12), (2, 2), (3, 1)])
def test_merkle_manifest(spark, arity, levels):
    random = np.random.default_rng(8)
    rows = [(int(k), f"s{k % 3}", ["en", "de", None, "", "é"][int(random.integers(0, 5))], int(k), "tëxt" * int(k % 4)) for k in random.permutation(70)]
    rows += [(5, None, "en", None, None), (5, "", "en", 0, ""), (5, "", "en", 0, ""), (None, "a", "en", 1, "x"), (None, "a", "en", 1, "y"), (7, "a", "alone", None, "z"), (8, "b", "two", 1, "x"), (9, "b", "two", 1, "x" * 100_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, idx int")
    more = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, 1).otherwise(0)
    claimed = merkle.digest_of("doc_id", "source", "lang", F.col("n_chars") + more, "text")

    def manifest(df):
        found = merkle.merkle_manifest(df, carry={"claimed": claimed}, arity=arity, levels=levels)
        return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(), merkle.folded("claimed").alias("f"), (F.col("f") == F.col("root")))

    want = plain_manifest(rows, arity)
    assert Counter(map(tuple, manifest(df).collect())) == want
    assert {r[-1] for r in want} == {True, False}
    assert Counter(map(tuple, manifest(df.filter("doc_id = 7 AND lang = 'alone'")).collect())) == plain_manifest([rows[-3]], arity)
    assert manifest(df.limit(0)).count() == 0
