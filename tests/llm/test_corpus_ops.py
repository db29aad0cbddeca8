"""The text-corpus operators against plain versions, on the small table and on a fixture of odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedmill.llm import components, embedding_neardup, language_id, license_scan, line_dedup, mixing, packing, quality_classifier, quality_rules, simhash_neardup, token_output
from feedmill.llm.tokens import encoder

#: Words from which on the plain versions compare lines.
LINE_WORDS = 5
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken long, fp string, kept boolean"
LINE = " ".join(f"word{k}" for k in range(200))
ROWS = [
    (1, LINE + "\nshort line", "en", "a", 9, 1, "x", True),
    (2, LINE.replace("word77", "changed77") + "\nshort line", "en", "a", 9, 1, "x", True),
    (3, "one two three four five. One two", "en", "b", 9, 1, "x", False),
    (4, None, "en", "b", None, None, None, None),
    (5, "", None, "b", 0, 1, "x", True),
    (6, " \t\n ", "de", None, 4, 1, "x", True),
    (7, "same same same same same same same same same same same", "de", None, 9, 1, "x", True),
    (8, "a b", "de", "é", 9, 1, "x", True),
    (8, "a b", "de", "é", 9, 1, "x", True),
    (None, LINE.upper(), "en", "a", 9, 1, "x", True),
    (10, "many words here. " * 3000, "en", "b", 9, 1, "x", True),
    (11, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.\na licence to fish", "en", "b", 9, 1, "x", True),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


#: Lines without letters beyond x, digits, and white space: patterns must keep their backslashes.
REPEATED_LINES = ["hello\nhello\nx y", "Menu\nMenu\nMenu\nHome", "abc\nabc", "99\n99", "x20\nx20", "  \n  \na b", "\t\t\n\t\t\n", "a\n\n\na", "zz\nzz", "\x0b\n\x0b"]


def test_quality_rules(spark, odd, none, docs):
    lines = spark.createDataFrame(list(enumerate(REPEATED_LINES)), "doc_id long, text string")
    assert [r["n_dup_lines"] for r in quality_rules.quality_rules(lines).orderBy("doc_id").collect()] == [1, 2, 1, 1, 1, 0, 0, 1, 1, 0]
    for df in (odd, docs, lines):
        want = Counter((r["doc_id"], *brute.base_figures(r["text"])) for r in df.select("doc_id", "text").collect())
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        got = quality_rules.quality_rules(df).collect()
        assert Counter(tuple(r[n] for n in names) for r in got) == want
        assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.quality_rules(none).count() == 0


def test_quality_rules_against_labels(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good = [got[r["doc_id"]] for r in labels if r["quality"] == 1]
    assert all(r["kept"] for r in good if not r["base_failed"])


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_mixing(request, which):
    df = request.getfixturevalue(which)
    got = mixing.mix_sources(df).collect()
    sizes = defaultdict(int)
    for r in df.collect():
        sizes[r["source"]] += len(brute.WORDS.findall(r["text"] or ""))
    target, taken = plain_targets(dict(sizes)), defaultdict(int)
    assert len(got) == df.count()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(2 * mixing.BLOCK_WORDS, 0.02 * t)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_sources(df.repartition(3)).collect()))


def test_mixed_documents_have_the_words_taken(docs, odd, none):
    for df in (docs, odd):
        planned = defaultdict(int)
        for r in mixing.mix_sources(df).collect():
            planned[r["doc_id"]] += r["taken"]
        out, before = mixing.mixed_documents(df), texts(df)
        got = defaultdict(int)
        for r in out.collect():
            got[r["doc_id"]] += len(brute.WORDS.findall(r["text"]))
            assert r["n_chars"] == len(r["text"])
            assert set(brute.WORDS.findall(r["text"])) <= set(brute.WORDS.findall(before[r["doc_id"]]))
        assert {k: v for k, v in planned.items() if v} == dict(got)
        assert out.columns == df.columns
    assert mixing.mixed_documents(none).count() == 0 and mixing.mix_sources(none).count() == 0


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 128, 1000):
        row = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n), F.lit(5)).alias("x"))
        assert sorted(r["x"] for r in row.collect()) == list(range(n))


def test_slots_meet_every_source(spark):
    sources = spark.createDataFrame([("sa", 7000, 60), ("sb", 9000, 80), ("t", 3, 2), ("sc", 0, 0)], "_mix_src string, slots long, blocks long")
    got = Counter((r["_mix_src"], r["j"]) for r in mixing.drawn_slots(sources, 100).collect())
    assert got == Counter([("sa", j) for j in range(7000)] + [("sb", j) for j in range(9000)] + [("t", j) for j in range(3)])


def unit(rows):
    rows = np.array(rows, float)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_embedding_groups(spark):
    random = np.random.default_rng(1)
    centre = unit(random.normal(size=(40, 16)))
    x = np.concatenate([centre[k] + random.normal(size=(30, 16)) * 0.06 for k in range(40)] + [random.normal(size=(600, 16))]).astype(np.float32)
    rows = [(k, [float(a) for a in v], 0) for k, v in enumerate(x)]
    odd = [(9001, None, 0), (9002, [0.0] * 16, 0), (9003, [float("nan")] + [1.0] * 15, 0), (9004, [None] + [1.0] * 15, 0), (9005, [1.0, 2.0], 0), (9006, [], 0), (5, rows[5][1], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, n_links int")
    got = {r["vec_id"]: r for r in embedding_neardup.embedding_groups(df).collect()}
    u = unit(x)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    found = sum(got[k]["n_links"] for k in range(len(x)))
    assert found >= 0.9 * near.sum() and all(got[k]["n_links"] <= near[k].sum() for k in range(len(x)))
    group = brute.groups(len(x), lambda a, b: near[a, b])
    assert np.mean([got[k]["component_id"] == group[k] for k in range(len(x))]) > 0.95
    assert all(got[k]["component_id"] >= group[k] for k in range(len(x)))
    assert len(got) == len(x) + 6 and all(got[k]["n_links"] == 0 and got[k]["kept"] for k in range(9001, 9007))
    assert embedding_neardup.embedding_groups(df.limit(0)).count() == 0


def test_embeddings_of_several_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0]), (5, [0.0, 1.0, 0.01])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_neardup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4)}


def test_an_embedding_search_that_misses_links_is_an_error(spark, monkeypatch):
    rows = [(k, [1.0, k / 1000]) for k in range(40)] + [(100 + k, [float(np.cos(k)), float(np.sin(k))]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(embedding_neardup, "_links", lambda usable, *_: usable.sparkSession.createDataFrame([], "kind int, a long, b long"))
    with pytest.raises(RuntimeError, match="widest search"):
        embedding_neardup.embedding_groups(df)


def test_simhash_groups(odd, none, docs):
    for df in (docs, odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        rows = sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()) if df is docs else sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: r[0])
        fps = [brute.fingerprint(t) for _, t in rows]
        group = brute.groups(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
        got = {r["doc_id"]: r for r in simhash_neardup.simhash_groups(df).collect()}
        for k, (doc, _) in enumerate(rows):
            assert got[doc]["fp"] & (1 << 64) - 1 == fps[k] and got[doc]["component_id"] == rows[group[k]][0]
        kept = {r["doc_id"] for r in simhash_neardup.keep_one_per_group(df).collect()}
        assert kept == {rows[g][0] for g in group}
    assert simhash_neardup.simhash_groups(odd).count() == len(ROWS)
    assert simhash_neardup.simhash_groups(none).count() == 0 and simhash_neardup.keep_one_per_group(none).count() == 0


def test_simhash_links_lose_none_in_large_shards(spark):
    random = np.random.default_rng(4)
    base = int(random.integers(1 << 62))
    values = {base}
    while len(values) < 400:
        values.add(base ^ sum(1 << int(b) for b in random.choice(63, random.integers(1, 4), replace=False)))
    values = sorted(values) + [int(v) for v in random.integers(0, 1 << 62, 100)]
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "fp long, rep long")
    group = brute.groups(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= 3)
    found = {r["node"]: r["component"] for r in components.components(simhash_neardup.link_fingerprints(df, tree_rows=16)).collect()}
    assert [found.get(k, k) for k in range(len(values))] == group


def test_bk_tree_finds_all():
    random = np.random.default_rng(3)
    values = sorted({int(v) for v in random.integers(0, 1 << 12, 500)})
    tree = simhash_neardup.BKTree(values)
    for value in values[::50]:
        assert sorted(tree.within(value, 3)) == [k for k, v in enumerate(values) if (v ^ value).bit_count() <= 3]


def test_components_of_a_chain(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def tokens(name, df, end):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    rows = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    return [(d, e.ids + [end]) for (d, _), e in zip(rows, library.encode_batch([t for _, t in rows], add_special_tokens=False))]


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    want = tokens("byte_bpe_50k.json", df, 0)
    got = packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    by_doc, places = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    expect = defaultdict(list)
    for doc, ids in want:
        cuts = [0, len(ids)] if len(ids) <= 2048 else [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        expect[doc] += [(k, a, b - a, brute.crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in expect.items()}
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.03 * sum(len(i) for _, i in want) / 2048 + 1


def test_sum_of_squares_closes_exact_fits():
    assert sorted(map(len, packing.sum_of_squares([6, 6, 4, 4, 10], 10))) == [1, 2, 2]
    assert packing.sum_of_squares([], 10) == []


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_token_files(request, which):
    df = request.getfixturevalue(which)
    want = tokens("word_bpe_49k.json", df, 1)
    got = token_output.token_files(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((d, len(i), brute.crc(i)) for d, i in want)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert ids == sorted(ids)


def test_empty_tables(none, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_output.token_files(none, path).count() == 0 and packing.pack_documents(none, path).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_classifier.classify_quality(none, labels).count() == 0 and language_id.identify_languages(none).count() == 0
    assert line_dedup.dedup_report(none).count() == 0 and license_scan.scan_licenses(none).count() == 0


def test_huffman_codes():
    random = np.random.default_rng(2)
    counts = np.bincount(random.zipf(1.3, 200_000) % 3000, minlength=3001)
    lengths = token_output.code_lengths(counts, 13)
    used = lengths[counts > 0].astype(float)
    assert used.max() <= 13 and (2.0**-used).sum() == 1 and lengths[3000] == 0
    assert token_output.code_lengths(np.array([0, 5])).tolist() == [0, 1]
    codes, table = token_output.canonical_codes(lengths), token_output.decoding_table(lengths)
    ids = random.choice(np.flatnonzero(counts), 5000)
    payload, checkpoints = token_output.encode_ids(ids, lengths, codes)
    sizes = np.minimum(256, 5000 - 256 * np.arange(len(checkpoints)))
    assert (token_output.decode_stretches(payload, checkpoints, sizes, table) == ids).all()


def test_encoder_gives_the_librarys_ids(docs):
    odd = ["", "  ", "a  b", "foo.\n Are", "it's 12.5% don’t", "x́ é", "\x1ca \x85b", "<|endoftext|> hi", "Σας ΟΔΟΣ.", "日本語 テスト", "a,\nB.\nC \n", "!!! ,,, a.,b", "x\0y", "e.. f, g", "ǅ, ½. ²"]
    odd += ["TÜRKİ. — İ, x", "\u0958. a", "\ufb2a, b\n"] + [f"q{chr(c)}. — w" for c in range(0x80, 0x30000, 7) if chr(c).isalnum()]
    some = odd + [r["text"] or "" for r in docs.select("text").collect()]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        library = Tokenizer.from_file(public_tokenizers.path(name))
        library.encode_special_tokens = True
        want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(some, add_special_tokens=False)]
        assert encoder(public_tokenizers.path(name)).encode(some) == want


@pytest.mark.parametrize("slice_chars", [1 << 22, 50])
def test_encoder_looks_up_distinct_pieces_only(monkeypatch, slice_chars):
    """A word that stands ten thousand times costs one look-up per slice of texts, and ids stay the library's."""
    from feedmill.llm import tokens

    monkeypatch.setattr(tokens, "SLICE_CHARS", slice_chars)
    asked = []

    class Seen(dict):
        def get(self, *key):
            asked.append(key)
            return super().get(*key)

    some = ["again and " * 10_000 + "end", "", "one, two.\nthree", "", " x", "!. a", "three, one.", "İ, q", "a"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        known = tokens.Encoder(public_tokenizers.path(name))
        known.known = Seen()
        library = Tokenizer.from_file(public_tokenizers.path(name))
        library.encode_special_tokens = True
        assert [np.frombuffer(x, "<u4").tolist() for x in known.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]
        assert len(asked) < 100
        asked.clear()


def test_language_id(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in language_id.identify_languages(docs).collect()}
    held = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.97
    model = language_id.fit(docs)
    odd_got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(odd, model).collect()]
    assert {d: p for d, p, _ in odd_got if d in (4, 5, 6)} == {4: "und", 5: "und", 6: "und"} and all(0 <= s <= 1 for *_, s in odd_got)


def test_quality_classifier(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    vectors, network = quality_classifier.fit(docs, labels)
    score = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, vectors, network).collect()}
    held = [(score[r["doc_id"]], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(s >= 0.3) == bool(q) for s, q in held]) > 0.93
    scored = quality_classifier.score(odd, vectors, network).collect()
    assert len(scored) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scored)
    kept = quality_classifier.keep_quality(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, s in score.items() if s >= 0.3}


def test_licenses(odd, spark):
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(odd).collect()}
    assert got[11]["licenses"] == "Apache-2.0,MIT" and got[4]["licenses"] == "" and got[11]["n_candidates"] == 3
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names = {"Apache-2.0": "Apache License", "CC-BY-NC": "CC BY-NC", "GPL": "GNU General", "MIT": "MIT License", "proprietary": "All rights reserved"}
    want = {d: ",".join(sorted(k for k, v in names.items() if v in t)) for d, t in texts(docs).items()}
    assert {r["doc_id"]: r["licenses"] for r in license_scan.scan_licenses(docs).collect()} == want


def plain_lines(rows):
    """What stays of the lines, for documents in order, by the same relation on all pairs."""
    found = []
    for doc, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            norm = re.sub(r"[\W_]+", " ", line.lower()).strip()
            if len(norm.split(" ")) >= LINE_WORDS:
                found.append((doc, pos, norm))
    first = {}
    for doc, pos, norm in found:
        first.setdefault(norm, (doc, pos))
    return {(doc, pos) for doc, pos, norm in found if first[norm] != (doc, pos)}, len(first)


def test_line_dedup(docs, odd):
    rows = sorted(texts(docs).items())
    exact, _ = plain_lines(rows)
    gone = {(r["doc"], p) for r in line_dedup.surplus_lines(docs, LINE_WORDS).collect() for p in r["places"]}
    assert exact <= gone  # fuzzy links only add to equal lines
    lines = {d: t.split("\n") for d, t in rows}
    for doc, pos in gone - exact:  # each is close to a line that stays
        words = re.sub(r"[\W_]+", " ", lines[doc][pos].lower()).split()
        assert any(len(set(words) & set(re.sub(r"[\W_]+", " ", x.lower()).split())) >= 0.7 * len(set(words)) for d, ls in lines.items() for p, x in enumerate(ls) if (d, p) != (doc, pos) and (d, p) not in gone)
    got = {r["doc_id"]: r for r in line_dedup.dedup_report(odd, LINE_WORDS).collect()}
    assert got[1]["n_dropped"] == 0 and got[2]["n_dropped"] == 1 and got[None]["kept_chars"] == 0 and got[4]["n_lines"] == 0
    left = line_dedup.dedup_documents(odd, LINE_WORDS)
    assert left.columns == odd.columns and {r["doc_id"] for r in left.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 10, 11}


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup_finds_changed_lines(spark):
    """Words changed at random places: nearly all lines at the similarity go, and none below it."""
    random = np.random.default_rng(7)
    rows, many = [], Counter()
    for words, changed in ((5, 1), (8, 1), (9, 1), (10, 1), (10, 2), (12, 2), (15, 3), (16, 3), (19, 3), (20, 1), (20, 4), (40, 4), (40, 8), (80, 8), (80, 16), (5, 2), (20, 5), (40, 9)):
        for _ in range(20):
            line = [f"w{k}" for k in random.integers(0, 10**9, words)]
            other = list(line)
            for at in random.choice(words, changed, replace=False):
                other[at] = f"x{random.integers(0, 10**9)}"
            rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(other))]
            many[words, changed] += 1
    sizes = [key for key, n in many.items() for _ in range(n)]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(got[k] for k in range(0, len(rows), 2))
    found = Counter(key for k, key in enumerate(sizes) if got[2 * k + 1])
    for (words, changed), n in many.items():
        if changed > words // 5:
            assert not found[words, changed]
        else:
            assert found[words, changed] >= (n if words < 20 else 0.9 * n), (words, changed)


@pytest.mark.parametrize("words_from", [LINE_WORDS, 1])
def test_line_dedup_recall_of_pairs(docs, words_from):
    """All pairs by brute force; what goes is what goes by them."""
    at = defaultdict(list)
    for doc, text in sorted(texts(docs).items()):
        for pos, line in enumerate((text or "").split("\n")):
            norm = re.sub(r"[\W_]+", " ", line.lower()).strip()
            if norm and len(norm.split(" ")) >= words_from:
                at[norm].append((doc, pos))
    words = [n.split(" ") for n in at]
    bags = [Counter(w) for w in words]

    def linked(a, b):
        n, m = len(words[a]), len(words[b])
        most = max(n, m) // 5
        return abs(n - m) <= most and (bags[a] & bags[b]).total() >= max(n, m) - most and word_edits(words[a], words[b]) <= most

    group, places = brute.groups(len(words), linked), list(at.values())
    want = {p for k, g in enumerate(group) for p in places[k] if p != places[g][0]}
    got = {(r["doc"], p) for r in line_dedup.surplus_lines(docs, words_from).collect() for p in r["places"]}
    assert got <= want and len(got) >= 0.98 * len(want), (len(got), len(want))


def test_lines_with_one_frequent_run(spark):
    """A phrase of many lines makes no pairs, nor does a line form with numbers of its own; copies of it still meet."""
    random = np.random.default_rng(9)
    phrase = [" ".join(["at", "the", "end", *(f"w{k}" for k in random.integers(0, 10**9, 7))]) for _ in range(300)]
    form = [f"order {k} of customer {k + 10000} went out on day {k + 20000} at noon" for k in range(1000, 1300)]
    copies = ["the same line of text with one word that changes here " + f"v{k}" for k in range(300)]
    rows = list(enumerate(phrase + form + copies))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    distinct = line_dedup.line_table(df).groupBy("k").agg(F.min("norm").alias("norm"))
    blocks = line_dedup._blocks(distinct, True)
    hot = blocks.groupBy("part").count().filter(F.col("count") > line_dedup.HOT).select("part")
    refined = line_dedup._refined(blocks.join(hot, "part"), distinct)
    assert refined.join(distinct.filter("norm LIKE 'at the end%' OR norm LIKE 'order%'"), "k").count() <= 60  # words that share a counter
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_report(df).collect()}
    assert [k for k, n in got.items() if n] == [k for k in got if k > 600]


def test_line_dedup_takes_every_run_if_asked(spark):
    """Edits as evenly apart as they can be, on long lines: no pair is missed without the sample."""
    random = np.random.default_rng(10)
    rows = []
    for words in (20, 31, 40, 64, 99):
        for _ in range(10):
            line = [f"w{k}" for k in random.integers(0, 10**9, words)]
            other = [f"x{k}" if k % 5 == 4 else w for k, w in enumerate(line)]
            rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(other))]
    gone = line_dedup.surplus_lines(spark.createDataFrame(rows, "doc_id long, text string"), sampled=False)
    assert {r["doc"] for r in gone.collect()} == set(range(1, len(rows), 2))


def test_short_lines_take_part(spark, tmp_path):
    from feedmill.llm.queries import op10_line_dedup

    chinese = "版权所有未经许可不得转载本网站的任何内容"
    rows = [(1, "All rights reserved.\n" + chinese + "\none two three four"), (2, "alpha\nALL rights reserved\n" + chinese.replace("转", "复")), (3, "--\none two three more four\nbeta\nbeta\n--")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_dropped"] for r in op10_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 2, 3: 2}


def test_wrapped_licenses(spark):
    gpl = "# This program is free software: you can redistribute it and/or\n# modify it under the terms of the GNU\n# General Public License."
    mit = "Some words before it. Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and\nassociated documentation files. And words after it"
    rows = [(1, gpl), (2, mit), (3, "Anna was here. All rights\nreserved."), (4, "a licence to fish\nand to hunt in the woods\n\nnothing more"), (5, "text\n\n" + gpl + "\n\n" + mit), (6, None)]
    model = license_scan.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {1: "GPL", 2: "MIT", 3: "proprietary", 4: "", 5: "GPL,MIT", 6: ""}


def test_license_model_and_threshold_come_from_all_candidates(spark, monkeypatch):
    """Every distinct candidate is trained on or held out, also beyond ten thousand; the threshold counts all that are held."""
    random = np.random.default_rng(11)
    words = [f"w{k}" for k in random.integers(0, 10**9, 12_000)]
    rows = [(k, f"a license for {w}\nno cue {w}\nthe copy\nright of {w}") for k, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert license_scan.candidates(df).count() == len(set(words))
    settled = []
    monkeypatch.setattr(license_scan, "settle", lambda t, name: settled.append(t) or t)
    monkeypatch.setattr(license_scan, "discard", lambda *tables: None)
    license_scan.fit(df)
    assert settled[0].filter("norm LIKE 'a license for %'").count() == len(set(words))
    assert settled[0].filter("held = 1").count() > 2500
    shares = spark.createDataFrame([(k / 20_000,) for k in range(20_000)], "p double")
    assert license_scan._exceeded(shares) == pytest.approx(np.quantile(np.arange(20_000) / 20_000, 1 - license_scan.MISTAKES), abs=2 / license_scan.STEPS)
    assert license_scan._exceeded(shares.filter("p < 0")) == 0


def test_line_dedup_misses_no_pair_by_default(spark):
    """Edits as evenly apart as they can be, insertions too, and texts whose SimHashes lie far apart: all at the similarity go."""
    random = np.random.default_rng(12)
    rows = []
    for words in (*range(10, 20), 20, 31, 40, 64, 99, 160):
        for _ in range(5):
            line = [f"w{k}" for k in random.integers(0, 10**9, words)]
            changed = [f"x{k}" if k % 5 == 4 else w for k, w in enumerate(line)]
            shorter = [w for k, w in enumerate(line) if k % 5 != 4]
            for a, b in ((line, changed), ([f"y{w}" for w in line], [f"y{w}" for w in shorter])):
                rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    far = 0
    while far < 5:  # the four words decide the bits in which the others are tied
        a, b, c, d = (f"w{k}" for k in random.integers(0, 10**9, 4))
        pair = [" ".join([a] * 8 + [b] * 8 + [x] * 4) for x in (c, d)]
        votes = [line_dedup.Words([x]).hash[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1) for x in pair]
        if sum(x != y for x, y in zip(*(2 * v.sum(0) > 20 for v in votes))) > 26:
            rows += [(len(rows), pair[0]), (len(rows) + 1, pair[1])]
            far += 1
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k for k, n in got.items() if n} == set(range(1, len(rows), 2))


def test_alike_lines_meet_once(spark, monkeypatch):
    """Long lines that share many runs: blocks of the same lines are one, and pairs below the similarity meet once or little more."""
    random = np.random.default_rng(14)
    rows = []
    for _ in range(4):
        line = [f"w{k}" for k in random.integers(0, 10**9, 100)]
        for _ in range(12):
            other = list(line)
            for at in random.choice(100, 15, replace=False):  # two of these differ in more than 20 words
                other[at] = f"x{random.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(other)))
    distinct = line_dedup.line_table(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("k").agg(F.min("norm").alias("norm"))
    blocks = line_dedup._blocks(distinct, False)
    one = line_dedup._distinct_blocks(blocks, "test-blocks")
    assert 0 < one.count() < blocks.groupBy("part").count().filter("count > 1").count()
    ranked = line_dedup._ranked(blocks.join(one, "part"))
    other = ranked.select(*[F.col(c).alias(c + "_") for c in ranked.columns])
    pairs = ranked.join(other, (F.col("part") == F.col("part_")) & (F.col("k") < F.col("k_"))).select("k", "k_", "before", "before_")
    met = pairs.filter(~F.arrays_overlap("before", "before_"))
    assert met.select("k", "k_").distinct().count() == pairs.select("k", "k_").distinct().count()
    assert 2 * met.count() < pairs.count()


def test_sketches_of_long_lines_tell_them_apart(spark):
    """Lines of 100 words with one run in common are refused before their letters are fetched; alike ones never are."""
    random = np.random.default_rng(15)
    rows = [(i, " ".join(["at the end", *(f"w{k}" for k in random.integers(0, 10**9, 97))])) for i in range(40)]
    rows += [(40 + i, " ".join(f"y{j}" if j % 5 == 4 else w for j, w in enumerate(rows[i][1].split()))) for i in range(40)]
    distinct = line_dedup.line_table(spark.createDataFrame(rows, "doc_id long, text string")).select("doc", "k", "norm")
    sketches = line_dedup._sketched(distinct, distinct).drop("letters").join(distinct.select("k", "doc"), "k")
    other = sketches.select(*[F.col(c).alias(c + "_") for c in sketches.columns])
    near = {(r["doc"], r["doc_"]) for r in sketches.join(other, F.col("doc") < F.col("doc_")).filter(line_dedup._near()).collect()}
    assert near == {(i, 40 + i) for i in range(40)}


@pytest.mark.parametrize("words", range(8, 60))
def test_bound_of_lost_runs(words):
    """As many runs as it takes for partners of every length within the distance."""
    most = 0
    for other in range(4 * words // 5, 5 * words // 4 + 1):
        edits = max(words, other) // 5
        if abs(words - other) <= edits:
            inserted = max(0, other - words)
            most = max(most, 3 * (edits - inserted) + 2 * inserted)
    assert line_dedup._lost_runs(np.array([words]))[0] == most


def test_line_groups_meet_before_their_lines_are_paired(spark, monkeypatch):
    """A family of one line: groups that link are contracted line by line, few pairs are left for the comparison of all, and no link is lost."""
    random = np.random.default_rng(11)
    base, lines = [f"w{k}" for k in range(40)], []
    for number in range(120):
        line = list(base)
        for at in sorted(random.choice(40, 6 if number % 8 == 0 else 3, replace=False).tolist(), reverse=True):
            line[at : at + 1] = [[], [f"x{number}n{at}"], [line[at], f"y{number}n{at}"]][int(random.integers(3))]
        lines.append(line)
    met, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, sketches: met.append(pairs.count()) or verified(pairs, sketches))
    distinct = line_dedup.line_table(spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(lines)], "doc_id long, text string"))
    first = {r["k"]: r["doc"] for r in distinct.collect()}
    component = {first[r["node"]]: r["component"] for r in line_dedup.fuzzy_links(distinct.groupBy("k").agg(F.min("norm").alias("norm"))).collect()}
    plain = brute.groups(len(lines), lambda a, b: words_apart(lines[a], lines[b]) <= max(len(lines[a]), len(lines[b])) // 5)
    for a in range(len(lines)):
        for b in range(a):
            assert (plain[a] == plain[b]) == (component.get(a, ("alone", a)) == component.get(b, ("alone", b)))
    assert 10 * met[-1] < met[0], met


def words_apart(a, b):
    """Edit distance in words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_near_counts_words_more_or_less_once(spark):
    """Twelve words less and four others more: 16 bits as eight changed words have, but twelve edits at least, where nine are allowed."""
    base = [f"w{k}" for k in range(48)]
    lines = [base, [f"z{k}" for k in range(4)] + base[:36], base[3:] + ["q1", "q2"], base[:40]]
    df = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(lines)], "doc_id long, text string")
    distinct = line_dedup.line_table(df).select("doc", "k", "norm")
    sketches = line_dedup._sketched(distinct, distinct).drop("letters").join(distinct.select("k", "doc"), "k")
    other = sketches.select(*[F.col(c).alias(c + "_") for c in sketches.columns])
    near = {(r["doc"], r["doc_"]) for r in sketches.join(other, F.col("doc") < F.col("doc_")).filter(line_dedup._near()).collect()}
    assert {(0, 2), (0, 3), (1, 3)} <= near  # 5, 8 and 8 edits
    edits = {(a, b): words_apart(lines[a], lines[b]) for a in range(4) for b in range(a + 1, 4)}
    assert all(pair in near for pair, apart in edits.items() if apart <= max(len(lines[x]) for x in pair) // 5)
    assert (0, 1) not in near and edits[0, 1] > 9


def test_documents_are_coded_together():
    """Documents coded side by side have the bytes and checkpoints each has alone, and are decoded together."""
    random = np.random.default_rng(5)
    weights = random.integers(1, 10**6, 300) ** 2
    lengths = token_output.code_lengths(weights)
    codes = token_output.canonical_codes(lengths)
    counts = np.array([1, 256, 257, 1, 700, 0, 3, 512, 90])
    ids = random.integers(0, 300, counts.sum())
    ends = np.cumsum(counts)
    code, n_bytes, checkpoints = token_output.encode_documents(ids, counts, lengths, codes)
    alone = [token_output.encode_ids(ids[b - n : b], lengths, codes) for b, n in zip(ends, counts)]
    assert code == b"".join(c for c, _ in alone) and n_bytes.tolist() == [len(c) for c, _ in alone]
    assert checkpoints.tolist() == [x for _, marks in alone for x in marks]
    stretches = -(-counts // token_output.CHECKPOINT)
    doc = np.repeat(np.arange(len(counts)), stretches)
    rank = np.arange(len(doc)) - (np.cumsum(stretches) - stretches)[doc]
    left = np.minimum(token_output.CHECKPOINT, counts[doc] - rank * token_output.CHECKPOINT)
    back = token_output.decode_stretches(code, checkpoints + 8 * (np.cumsum(n_bytes) - n_bytes)[doc], left, token_output.decoding_table(lengths))
    assert back.tolist() == ids.tolist()
    shares = list(token_output._shares(np.array([1 << 18, 1 << 18, 1, 1 << 20, 5])))
    assert shares == [(0, 2), (2, 3), (3, 4), (4, 5)] and not list(token_output._shares(np.zeros(0, np.int64)))


def test_runs_are_counted_by_buckets(spark):
    """A row of fixed size for each bucket tells which pieces are of several lines; no row a piece is shuffled or kept."""
    random = np.random.default_rng(21)
    lines = [" ".join(f"w{k}" for k in random.integers(0, 30, int(n))) for n in random.integers(4, 60, 300)]
    distinct = line_dedup.line_table(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).groupBy("k").agg(F.min("norm").alias("norm"))
    counts = line_dedup._piece_counts(distinct, False)
    bits, levels = line_dedup._filters(counts)
    held = {r["part"]: r["many"] for r in line_dedup._blocks(distinct, False).groupBy("part").agg(F.count("*").alias("many")).collect()}
    part = np.array(sorted(held))
    many = np.array([held[p] for p in part.tolist()])
    bit, place = part >> (line_dedup.PART_BITS + 1 - line_dedup.FILTER_BITS.bit_length()), part >> (line_dedup.PART_BITS + 1 - line_dedup.LEVELS.bit_length())
    assert counts.count() <= 1 << line_dedup.BUCKET_BITS < len(part)
    assert (many > 1).any() and (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)[many > 1].all()
    assert np.unpackbits(bits).sum() == len(np.unique(bit[many > 1]))
    assert (levels[place][many > 1] >= np.floor(8 * np.log2(many[many > 1]))).all() and (levels > 0).sum() == len(np.unique(place[many > 1]))


def test_blocks_of_some_hundred_lines_are_not_refined(spark, monkeypatch):
    """300 lines with a phrase in common, some of them alike: pairs are found in numpy, in blocks above and below ``HOT``."""
    monkeypatch.setattr(line_dedup, "_refined", lambda *_: pytest.fail("refined"))
    random = np.random.default_rng(22)
    rows = []
    for i in range(100):
        words = ["at the end", *(f"w{k}" for k in random.integers(0, 10**9, 27))]
        for j in range(3):  # the third is alike to the second only
            words = list(words)
            for at in random.choice(np.arange(1, 28), 4, replace=False) if j else ():
                words[at] = f"x{random.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(words)))
    assert len(rows) > line_dedup.HOT
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k for k, n in got.items() if n} == {k for k in range(300) if k % 3}
