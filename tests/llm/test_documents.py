"""Each document operator on odd rows, against plain Python; and on an empty table."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from shopsignal.llm import exact_dedup, language, mixing, packing, quality, simhash, token_counts, token_files
from shopsignal.llm.common import shared_path
from shopsignal.llm.encode import SegmentEncoder
from tests.conftest import SF_SMALL
from tests.llm.conftest import COLUMNS, odd_rows

BYTE = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD = str(public_tokenizers.path("word_bpe_49k.json"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def like(pairs):
    return sorted(pairs, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# -- exact duplicates ---------------------------------------------------------------------------
@pytest.mark.parametrize("sizes", [{}, {"bucket_rows": 1, "first_depth": 1, "max_depth": 6}])
def test_exact_dedup(odd, sizes):
    given = odd_rows()
    groups = {}
    for i, t, *_ in given:
        groups.setdefault(t or "", []).append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        kept = False
        for i in sorted(ids, key=lambda i: i is None):
            first = i == keep and not kept
            kept |= first
            want.append((i, keep, len(ids), first, sha))
    got = exact_dedup.decide(odd, **sizes)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == like(want)
    stay = exact_dedup.deduplicate(odd, **sizes)
    assert stay.columns == odd.columns
    assert rows(stay, "doc_id") == like([(k,) for k in (max((i for i in ids if i is not None), default=None)
                                                        for ids in groups.values())])


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key")).union(
        spark.range(500).select(F.lit(7).cast("long").alias("key")))
    directory, depth = exact_dedup.build_directory(keys, bucket_rows=200, first_depth=1, max_depth=8)
    slots = directory.collect()
    assert len(slots) == 1 << depth and sorted(r["slot"] for r in slots) == list(range(1 << depth))
    size = Counter()
    bucket = {r["slot"]: r["bucket"] for r in slots}
    deep = {r["bucket"]: r["depth"] for r in slots}
    for r in keys.collect():
        size[bucket[(r["key"] & (2**64 - 1)) >> (64 - depth)]] += 1
    assert all(n <= 200 or deep[b] == 8 for b, n in size.items())
    # a bucket of depth d is named by 2 ** (depth - d) neighbouring slots
    named = Counter(bucket.values())
    assert all(n == 1 << (depth - deep[b]) for b, n in named.items())


# -- SimHash ------------------------------------------------------------------------------------
def simhash_by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(points, bits=3):
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, f) in enumerate(points):
        for j in range(i):
            if (f ^ points[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(points):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, f"{f:016x}", low.get(find(i))) for i, (d, f) in enumerate(points)]


def test_simhash_odd_rows(odd):
    points = [(i, simhash_by_hand(t)) for i, t, *_ in odd_rows()]
    want = groups_by_hand(points)
    assert rows(simhash.near_duplicates(odd), "doc_id", "fingerprint", "component_id") == like(want)
    stay = simhash.drop_near_duplicates(odd)
    assert stay.columns == odd.columns
    classes = {c for _, _, c in want}
    assert Counter(r[0] for r in rows(stay, "doc_id")) == Counter(classes)


@pytest.mark.parametrize("tile", [4096, 5])
def test_simhash_links_against_all_pairs(spark, tile):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40)
    points = set(base.tolist())
    for b in base[:25].tolist():  # planted neighbours at 1 to 5 bits, chains included
        for _ in range(12):
            p = b
            for bit in rng.choice(64, rng.integers(1, 6), replace=False).tolist():
                p ^= 1 << bit
            points.add(p)
            b = p if rng.random() < 0.4 else b
    points = sorted(points)
    signed = [p - 2**64 if p >= 2**63 else p for p in points]
    df = spark.createDataFrame([(p, 1, i) for i, p in enumerate(signed)], "fp long, size long, low long").repartition(4)
    got = {r["fp"] & (2**64 - 1): r["component_id"] for r in simhash.group_points(df, tile=tile).collect()}
    want = groups_by_hand(list(enumerate(points)))
    assert [got[p] for p in points] == [w[2] for w in want]
    with pytest.raises(ValueError):
        simhash.link_points(df.select("fp"), max_bits=4)


# -- tokens -------------------------------------------------------------------------------------
def test_token_counts(odd, docs, texts):
    tk = Tokenizer.from_file(BYTE)
    n = lambda t: len(tk.encode(t or "", add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), n(t), n(t) > 1024) for i, t, *_ in odd_rows()]
    got = token_counts.count_tokens(odd, BYTE)
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == like(want)
    assert rows(token_counts.count_tokens(docs, BYTE), "doc_id", "n_tokens") == like((i, n(t)) for i, t in texts.items())


@pytest.mark.parametrize("chunk", [1, 7, 512])
def test_chunk_maps_compose(chunk):
    """Any chunk length, texts without synchronising places and a table that is emptied often."""
    tk, m = Tokenizer.from_file(BYTE), token_counts.Transducer(BYTE, table_cells=100_000)
    cases = [t or "" for _, t, *_ in odd_rows() if t is None or len(t) < 1000]
    cases += ["a" * 3000, "'" * 50, "we're 'tis ''ll x'd 'R", " " * 90 + "b", "\n" * 9 + "c", "é" * 700, "1a" * 400,
              "don't" * 300, "\u3000 \u3000a", "", "'"]
    cases = [c for c in cases if "<|endoftext|>" not in c]
    want = [len(tk.encode(c, add_special_tokens=False).ids) for c in cases]
    assert m.count([c.encode() for c in cases], chunk).tolist() == want
    assert m.count([c.encode() for c in cases[::-1]], chunk).tolist() == want[::-1]


def test_token_files(spark, odd, docs, texts):
    tk = Tokenizer.from_file(BYTE)

    def by_hand(pairs):
        out, start = [], 0
        for d, t in pairs:
            ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
            out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        return out

    path = shared_path(spark, "test-files")
    token_files.write_token_files(docs, path, BYTE, block_tokens=5000)
    got = token_files.read_token_files(spark, path)
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == like(by_hand(sorted(texts.items())))
    path = shared_path(spark, "test-files")
    token_files.write_token_files(odd, path, BYTE)
    got = [tuple(r) for r in token_files.read_token_files(spark, path).orderBy("start").collect()]
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    one = Counter((d, n, c) for d, _, n, c in by_hand([(i, t) for i, t, *_ in odd_rows()]))
    assert Counter((d, n, c) for d, _, n, c in got) == one


def test_elias_fano_round_trip_and_space():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 511, 5000):
        for gap in (1, 3, 1000, 2**20):
            v = np.cumsum(rng.integers(0, gap + 1, n))
            code = token_files.EliasFano.encode(v)
            assert code.select(np.arange(n)).tolist() == v.tolist()
            if n:
                k = int(rng.integers(n))
                assert code.select(k)[0] == v[k]
    v = np.cumsum(rng.integers(1, 2000, 100_000))
    code = token_files.EliasFano.encode(v)
    size = len(code.low) + len(code.high) + 4 * len(code.ranks)
    assert size < 1.1 * len(v) * (2 + np.log2(v[-1] / len(v))) / 8 + 200


# -- packing ------------------------------------------------------------------------------------
def best_fit_by_hand(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] -= n
    return len(rooms)


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([5, 16, 37, 100]))
    items = rng.integers(1, capacity + 1, rng.integers(0, 150)).tolist()
    if seed % 3 == 0:
        items = [int(x) for x in rng.choice([2, 3, capacity], len(items))]
    used, seen = {}, Counter()
    for length, rank, number, sequence, each, at in packing.plan(dict(Counter(items)), capacity):
        assert rank == seen[length]
        seen[length] += number
        for k in range(number):
            used.setdefault(sequence + k // each, []).append((at + k % each * length, length))
    assert seen == Counter(items) and len(used) == best_fit_by_hand(items, capacity)
    for parts in used.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= capacity


def test_packing(spark, odd):
    tk, capacity = Tokenizer.from_file(WORD), 512
    want, lengths = [], []
    for i, t, *_ in odd_rows():
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at:at + capacity]
            want.append((i, k, at, len(cut), zlib.crc32(cut.tobytes())))
            lengths.append(len(cut))
    got = packing.pack(odd, WORD, capacity, with_ids=True)
    got.cache()
    assert rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == like(want)
    by = {}
    for r in got.collect():
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["ids"]))
    assert len(by) == best_fit_by_hand(lengths, capacity)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(got).collect()}
    for s, parts in by.items():
        end, ids = 0, []
        for at, n, part in sorted(parts):
            assert at == end
            end, ids = end + n, ids + part
        assert end <= capacity and whole[s] == ids


# -- quality ------------------------------------------------------------------------------------
def test_quality_odd_rows_and_held_out(spark, odd, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.learn(big, labels, quality.learning_rows())
    for d, n in ((odd, len(odd_rows())), (docs, docs.count())):
        got = quality.score_quality(d, labels).collect()
        assert len(got) == n and all(0 <= r["score"] <= 1 for r in got)
        assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    scored = quality.with_score(big, model).select(F.col("rec.doc_id").alias("doc_id"), "score")
    held = scored.join(labels, "doc_id").where(~quality.learning_rows()).collect()
    right = np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in held])
    assert len(held) > 50 and right > 0.95
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns


def test_quality_ignores_held_out_labels_and_other_columns(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    flipped = labels.withColumn("quality", F.when(quality.learning_rows(), F.col("quality")).otherwise(1 - F.col("quality")))
    a = quality.learn(big, labels, quality.learning_rows())
    b = quality.learn(big.withColumn("lang", F.lit("?")).withColumn("source", F.lit("?")), flipped, quality.learning_rows())
    x = np.array([quality.statistics(t) for t in ("", "a b", "THE!! END!!", "some text with words. " * 9)])
    assert np.allclose(a.score(x), b.score(x))


def test_density_equals_the_formula():
    rng = np.random.default_rng(1)
    k = len(quality.STATISTICS)
    a, b = rng.normal(size=(200, k)), rng.normal(1, 2, size=(300, k))
    model = quality.fit({c: (len(v), v.sum(0), v.T @ v) for c, v in ((0, a), (1, b))})
    z = (a[:5] - model.shift) / model.scale
    for c in model.classes.values():
        cov = np.linalg.inv(c.factor.T @ c.factor)
        d = z - c.mean
        want = c.log_prior - 0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
        assert np.allclose(c.log_density(z), want)


def test_quality_without_labels(spark, odd):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_quality(odd, empty).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_quality(odd, one).collect()} == {1.0}


# -- language -----------------------------------------------------------------------------------
def test_language(spark, odd):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(big).join(big.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    model = language.learn(big)
    out = language.identify(odd, model=model).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    text = {i: t for i, t, *_ in odd_rows()}
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {i for i, t in text.items() if not language.has_letter(t)}
    # held-out languages and other columns play no part
    other = big.withColumn("source", F.lit("?")).withColumn(
        "lang", F.when(language.learning_rows(), F.col("lang")).otherwise(F.lit("xx")))
    a, b = (language.learn(d, language.learning_rows()) for d in (big, other))
    assert a.langs == b.langs and np.array_equal(a.weights, b.weights)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 12, 30])
def test_codewords_are_apart(n):
    code = language.codewords(n).astype(int)
    apart = (code.shape[1] - code @ code.T) // 2 + 99 * np.eye(n, dtype=int)
    assert apart.min() >= max(1, code.shape[1] // 4) and (np.abs(code.sum(0)) < n).all()


def test_ngrams_of_blocks_equal_the_whole(monkeypatch):
    text = "Ça va? 12 The quick  brown fox. " * 40
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "BLOCK_CHARS", 50)
    parts = language.ngram_counts(text)
    # overlaps repeat at most the two characters before each block
    assert abs(parts[2] - whole[2]).sum() <= 3 * (len(text) // 50 + 1) * 2


# -- mixing -------------------------------------------------------------------------------------
def test_mixing_odd_rows(odd):
    got = mixing.assign(odd, budget_share=2.0).collect()  # both epochs in full
    want = [(i, e) for i, *_ in odd_rows() for e in (0, 1)]
    assert Counter((r["doc_id"], r["epoch"]) for r in got) == Counter(want)
    stay = mixing.mix(odd, budget_share=0.5)
    some = mixing.assign(odd, budget_share=0.5)
    assert stay.columns == odd.columns
    assert Counter(r[0] for r in rows(stay, "doc_id")) == Counter(r[0] for r in rows(some, "doc_id"))
    spent = some.groupBy("domain", "lang", "source").agg(F.sum("n_tokens").alias("n"), F.max("budget").alias("b"))
    assert spent.where("n > b").count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "en", "s1", 10, 50), ("a", "en", "s2", 1000, 50), ("a", "de", "s1", 1000, 100), ("b", "en", "s1", 1000, 200)],
        "domain string, lang string, source string, tokens long, weight long")
    got = {(r["domain"], r["lang"], r["source"]): r["budget"]
           for r in mixing.leaf_budgets(leaves, 800, epochs=1).collect()}
    # s1 can give 10 of its 100: its sibling s2 gets the other 90, nobody else
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 190, ("a", "de", "s1"): 200, ("b", "en", "s1"): 400}
    tight = leaves.withColumn("tokens", F.when(F.expr("domain = 'a' and lang = 'en'"), 10).otherwise(F.col("tokens")))
    got = {(r["domain"], r["lang"], r["source"]): r["budget"]
           for r in mixing.leaf_budgets(tight, 800, epochs=1).collect()}
    # all of a/en is short: a/de makes up for it, domain b is not touched
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 10, ("a", "de", "s1"): 380, ("b", "en", "s1"): 400}


# -- empty tables -------------------------------------------------------------------------------
def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = shared_path(spark, "test-files")
    token_files.write_token_files(none, path, BYTE)
    for df in (exact_dedup.decide(none), simhash.near_duplicates(none), token_counts.count_tokens(none, BYTE),
               token_files.read_token_files(spark, path), packing.pack(none, WORD), quality.score_quality(none, labels),
               language.identify(none), mixing.assign(none)):
        assert df.count() == 0
    for df in (exact_dedup.deduplicate(none), simhash.drop_near_duplicates(none), quality.keep_good(none, labels), mixing.mix(none)):
        assert df.columns == COLUMNS.names and df.count() == 0


# -- segment encoder ----------------------------------------------------------------------------
@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_of_any_bytes_in_any_order(path, texts):
    """Every single-byte character at the beginning, inside and at the end of texts, many texts through one encoder."""
    rng = np.random.default_rng(11)
    signs = ["!!", "''", "=", "...", "\u2019", "\u20ac", "he said", "'s", "'re", " ", "\n\n", "\t", "a", "7", ",", ".", "e\u0301",
             "\u0301", "\u00a0", "\u03a3", "\u4e2d", "<|endoftext|>", "\u0338"]
    chars = [chr(i) for i in range(256)]
    cases = [c + t for c in chars for t in ("", " b", "b !!", ", x")] + ["he said " + s + c for c in chars for s in signs[:6]]
    cases += ["".join(rng.choice(signs + chars, rng.integers(1, 30))) for _ in range(6000)]
    cases += [t for t in texts.values() if t]
    tk = Tokenizer.from_file(path)
    want = [e.ids for e in tk.encode_batch(cases, add_special_tokens=False)]
    enc = SegmentEncoder(path)
    for _ in range(2):  # the second time in another order, from a warm cache
        order = rng.permutation(len(cases))
        at = 0
        while at < len(order):
            take = order[at:at + int(rng.integers(1, 200))]
            for i, ids in zip(take, enc.encode([cases[i] for i in take])):
                assert ids.tolist() == want[i], repr(cases[i])
            at += len(take)


def test_unproven_tokenizer_encodes_whole_texts(tmp_path):
    tk = Tokenizer.from_file(BYTE)
    from tokenizers.pre_tokenizers import ByteLevel
    tk.pre_tokenizer = ByteLevel(add_prefix_space=True, use_regex=False)
    tk.save(str(tmp_path / "other.json"))
    enc = SegmentEncoder(str(tmp_path / "other.json"))
    assert not enc.cut and SegmentEncoder(BYTE).cut and SegmentEncoder(WORD).cut
    cases = ["a b c, d", "", "x  y\n"]
    assert [e.tolist() for e in enc.encode(cases)] == [tk.encode(c, add_special_tokens=False).ids for c in cases]


# -- what results must come through, and long texts ------------------------------------------------
def test_groups_are_read_through_the_directory(spark, docs):
    """With entries of the directory exchanged, rows no longer find their groups."""
    rows, index, directory, depth = exact_dedup.build_index(docs, bucket_rows=8, first_depth=2, max_depth=8)
    good = exact_dedup.look_up(rows, index, directory, depth)
    assert good.count() == docs.count() and good.where("link.group_size < 1").count() == 0
    wrong = directory.withColumn("bucket", F.col("bucket").bitwiseXOR(F.lit(1).cast("long")))
    found = exact_dedup.look_up(rows, index, wrong, depth)
    assert found.count() < docs.count() / 2
    # files of the index hold ranges of buckets
    spans = index.select(F.input_file_name().alias("f"), "bucket").groupBy("f").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    spans = sorted((r["a"], r["b"]) for r in spans.collect())
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_texts_that_share_a_key_are_a_chain(spark, monkeypatch):
    """Keys that collide: texts are told apart by their bytes, and chains name each."""
    df = spark.createDataFrame([(i, "abcdefghij"[i % 10]) for i in range(60)], "doc_id long, text string")
    keyed = exact_dedup._keyed
    monkeypatch.setattr(exact_dedup, "_keyed", lambda *a, **k: keyed(*a, **k).withColumn("key", F.pmod("key", F.lit(3))))
    got = exact_dedup.decide(df).collect()
    assert all(r["group_size"] == 6 and r["keep_id"] == 50 + r["doc_id"] % 10 for r in got) and len(got) == 60
    assert sorted(r["doc_id"] for r in got if r["kept"]) == list(range(50, 60))
    assert sorted(r["doc_id"] for r in exact_dedup.deduplicate(df).collect()) == list(range(50, 60))


def test_ngram_counts_by_hand(monkeypatch):
    """Every n-gram of the whole text once, whatever the blocks."""
    text = "Été 12  à la  plage; İzmir ΣΑΣ\t\n...x y" * 7
    plain, last = [], None
    for c in text.lower():
        c = " " if ord(c) < 128 and not c.isalpha() else c
        if not (c == " " and last == " "):
            plain.append(c)
        last = c
    grams = [Counter("".join(plain[i:i + n]) for i in range(len(plain) - n + 1)) for n in (1, 2, 3)]
    whole = language.ngram_counts(text)
    for k, want in enumerate(grams):
        cells = np.zeros(language.CELLS)
        for g, m in want.items():
            cells[language._cells(np.array([ord(c) for c in g], np.uint32))[k][0]] += m
        assert (whole[k] == cells).all()
    for block in (1, 2, 3, 7, 50):
        monkeypatch.setattr(language, "BLOCK_CHARS", block)
        assert (language.ngram_counts(text) == whole).all()


@pytest.mark.parametrize("langs", [2, 4, 5, 6, 9])
def test_decoding_by_hand(langs):
    """Weights, margins and loss-weighted decoding with plain loops, with both families of codes."""
    rng = np.random.default_rng(langs)
    words = {f"l{i}": ["".join(rng.choice(list("abcdefghijklm"), 4, p=rng.dirichlet(np.ones(13)))) for _ in range(60)] for i in range(langs)}
    model = language.Codes.learn({k: language.ngram_counts(" ".join(v)) for k, v in words.items()})
    assert (model.code.shape[1] == 2 ** (langs - 1) - 1) == (langs <= language.EXHAUSTIVE_LANGS)
    share = []
    for k in sorted(words):
        c = language.ngram_counts(" ".join(words[k]))
        share.append((c + 0.5) / (c.sum(1, keepdims=True) + 0.5 * language.CELLS))
    for name, ws in words.items():
        text = " ".join(ws[:9])
        c = language.ngram_counts(text)
        losses = []
        margins = []
        for bit in range(model.code.shape[1]):
            one, zero = ([s for s, b in zip(share, model.code[:, bit]) if b == side] for side in (1, -1))
            w = np.log(sum(one) / len(one)) - np.log(sum(zero) / len(zero))
            margins.append(sum((c[k] / c[k].sum() * w[k]).sum() for k in range(3)) / 3)
            expected = [sum((s[k] * w[k]).sum() for k in range(3)) / 3 for s in share]
            assert np.isclose(model.spread[bit], np.mean(np.abs(expected)))
        for word in model.code:
            signed = [max(-6, min(6, b * m / s)) for b, m, s in zip(word, margins, model.spread)]
            losses.append(sum(np.exp(-x) * t for x, t in zip(signed, model.trust)) / model.trust.sum())
        lang, score, _ = model.decode(text)
        p = np.exp(-4 * (np.array(losses) - min(losses)))
        assert lang == sorted(words)[int(np.argmin(losses))] and np.isclose(score, p.max() / p.sum(), rtol=1e-4)


def test_quality_fit_by_hand(spark):
    """The sums that Spark adds up give the fit of a plain loop; repeated label rows count again."""
    texts = [f"word{i % 7} the and {i} " * (3 + i % 5) + "|" * (i % 3) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    given = [(i, int(i % 3 > 0)) for i in range(40)] + [(4, 1)] * 5 + [(5, 0), (99, 1), (None, 1), (6, None), (7, 2)]
    labels = spark.createDataFrame(given, "doc_id long, quality int").repartition(3)
    got = quality.learn(docs, labels)
    x = {c: np.array([quality.statistics(texts[i]) for i, q in given if q == c and i is not None and i < 40]) for c in (0, 1)}
    every = np.concatenate([x[0], x[1]])
    scale = every.std(0)
    scale[scale < 1e-9] = 1
    z = {c: (v - every.mean(0)) / scale for c, v in x.items()}
    within = {c: (v - v.mean(0)).T @ (v - v.mean(0)) for c, v in z.items()}
    pooled = (within[0] + within[1]) / len(every)
    pooled = 0.9 * pooled + 0.1 * np.diag(np.diag(pooled)) + 1e-3 * np.eye(len(scale))
    probe = np.array([quality.statistics(t) for t in texts[:10]])
    w = np.clip((probe - every.mean(0)) / scale, -5, 5)
    log = {}
    for c in (0, 1):
        cov = 0.8 * within[c] / len(x[c]) + 0.2 * pooled + 1e-3 * np.eye(len(scale))
        d = w - z[c].mean(0)
        log[c] = np.log(len(x[c]) / len(every)) - 0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(got.score(probe), 1 / (1 + np.exp(log[0] - log[1])), rtol=1e-6, atol=1e-9)


def test_repeated_labels_are_one_broadcast_row(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "| | |")], "doc_id long, text string")
    labels = spark.range(50_000).select(F.lit(1).alias("doc_id"), F.lit(1).alias("quality")).union(
        spark.createDataFrame([(2, 0)], "doc_id long, quality int"))
    model = quality.learn(docs, labels, max_labels=10)
    assert set(model.classes) == {0, 1} and model.prior == pytest.approx(50_000 / 50_001)


def test_statistics_of_long_texts(monkeypatch):
    text = "One line of words, repeated | now and then.\n\nOne line of words\t" * 300
    whole = quality.statistics(text)
    words, lines = text.split(), [line for line in text.split("\n") if line]
    triples = len(words) - 2 - len(set(zip(words, words[1:], words[2:])))
    assert whole[0] == np.log1p(len(words)) and whole[9] == quality._odds(triples, len(words), 0.03)
    assert whole[10] == quality._odds(len(lines) - len(set(lines)), len(lines), 0.05)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 50)
    assert quality.statistics(text) == whole


def test_long_text_takes_little_memory():
    """50 MB of text in a process of its own."""
    import subprocess
    import sys
    code = """
import resource
from shopsignal.llm import quality
text = " ".join(f"w{i % 99991}" for i in range(2_000_000)) * 4
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
quality.statistics(text)
print(len(text), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    size, more = map(float, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert size > 50e6 and more < 450
