"""Fill-in-the-middle and lexical search on odd rows, against plain Python."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from shopsignal.llm import fim, lexical
from tests.llm.conftest import odd_rows


def fim_by_hand(doc_id, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MARKED = [(100 + i, t) for i, t in enumerate(["a <P> b", "<S>", "x<M", "<", "P>S>M>", "<<P<S<M", "café \U0001f600 naïve", "abc" * 999])]


def test_fim_on_odd_rows(spark, odd, none):
    given = [(r[0], r[1]) for r in odd_rows()] + MARKED
    extra = spark.createDataFrame(MARKED, "doc_id long, text string")
    rows = fim.transform(odd.select("doc_id", "text").union(extra))
    got = sorted(map(tuple, rows.collect()), key=repr)
    assert got == sorted([(i, *fim_by_hand(i, t or "")) for i, t in given], key=repr)
    back = fim.digest(rows).collect()
    want = Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in given)
    assert Counter((r["doc_id"], r["restored_sha256"]) for r in back) == want
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}
    assert fim.digest(fim.transform(none)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10**12), st.text(alphabet="abZ <PSM>\né\U0001f600", max_size=60), st.integers(1, 9))
def test_fim_blocks_do_not_change_the_cut(doc_id, text, block):
    got = fim.arrange(doc_id, text, block_chars=block)
    assert got == fim_by_hand(doc_id, text)
    n, form, _, _, out = got
    piece = re.split("<[PSM]>", out)
    back = {"plain": lambda: out, "psm": lambda: piece[1] + piece[3] + piece[2], "spm": lambda: piece[2] + piece[3] + piece[1]}
    assert back[form]() == text


def words(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold)


def search_by_hand(docs, queries, top):
    terms = {}
    for i, t in queries:
        terms.setdefault(i, set()).update(words(t))
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, ts in terms.items():
        scored = []
        for place, (i, b) in enumerate(bags):
            m = 50 + (50 * sum(b.values()) * n_docs) // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m))
                    for t in ts if b[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, place, i))
        out += [(item, k + 1, x[4], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


QUERIES = [(1, "The thing that was, in the HOUSE!"), (2, "no id here"), (2, "a b c"), (3, None), (4, "??"), (None, "word1 und"),
           (5, "zzz unknown"), (6, "中文字 more"), (1, "The thing that was, in the HOUSE!")]
Q = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])


@pytest.mark.parametrize("settings", [{}, {"top": 2, "shard_docs": 3}, {"shard_postings": 5}, {"terms_at_once": 4, "shard_docs": 1}])
def test_search_on_odd_rows(spark, odd, none, settings):
    queries = spark.createDataFrame([(*q, "?") for q in QUERIES], Q)
    got = lexical.search(odd, queries, **settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = search_by_hand([(r[0], r[1]) for r in odd_rows()], QUERIES, settings.get("top", 50))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert lexical.search(none, queries, **settings).collect() == []
    assert lexical.search(odd, spark.createDataFrame([], Q), **settings).collect() == []


def test_long_texts_are_split_between_terms(monkeypatch):
    text = "alpha Beta été-42 x" * 50
    whole = [t for part in lexical.terms_of(text) for t in part]
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 7)
    assert [t for part in lexical.terms_of(text) for t in part] == whole == [w.encode() for w in words(text)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 40), st.integers(1, 6), st.integers(1, 8), st.integers(1, 4))
def test_nra_against_full_sums(seed, docs, n_lists, top, spread):
    rng = np.random.default_rng(seed)
    lists, total = [], np.zeros(docs, np.int64)
    for _ in range(n_lists):
        p = rng.permutation(docs)[:rng.integers(0, docs + 1)]
        x = np.sort(rng.integers(1, 1 + spread * 3, len(p)))[::-1].astype(np.int64)
        total[p] += x
        lists.append((p, x))
    found, score, read = lexical.nra(lists, docs, top, first_read=2)
    bar = np.sort(total)[::-1][:top][-1] if docs else 0
    want = {int(d) for d in range(docs) if total[d] > 0 and total[d] >= bar}
    assert set(found.tolist()) >= want and all(total[d] == s for d, s in zip(found, score))
    assert read <= sum(len(p) for p, _ in lists)


def test_nra_stops_before_the_end_of_the_lists():
    n = 100_000
    x = np.concatenate([np.full(60, 10**6), np.ones(n - 60)]).astype(np.int64)
    found, score, read = lexical.nra([(np.arange(n), x), (np.arange(n), x)], n, 50)
    assert set(found.tolist()) == set(range(60)) and read < n // 10
