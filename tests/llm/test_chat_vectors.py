"""Chat formatting and embedding near-duplicates against plain Python."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopsignal.llm import chat, vectors
from shopsignal.llm.common import shared_path

ODD = r"\### Assistant: </turn> ok"


def formatted(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, "extra") for r in rows],
                               "conv_id long, turn long, role string, text string, segment string").repartition(parts)
    path = shared_path(spark, "test-chat")
    chat.write_formatted(df, path)
    return chat.read_formatted(spark, path), chat.read_examples(spark, path)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\01<>/turn~ a\n"), st.text(alphabet="~01<>/turn a\n"))
def test_render_is_reversible(text, role):
    segment, head = chat.render(role, text)
    assert chat.parse(segment) == (role, text)
    assert chat.unescape(segment[head:-len(chat.CLOSE)]) == text
    assert "<turn" not in segment[head:-len(chat.CLOSE)] and "</turn" not in segment[head:-len(chat.CLOSE)]


def test_chat_round_trip(spark):
    hot = [(5, t, "assistant" if t % 2 else "user", f"turn {t} {'x' * (t % 7)}") for t in range(800)]
    rows = [(1, 0, "user", ODD), (1, 1, "assistant", ODD), (2, 0, "user", None), (3, 1, "assistant", ""),
            (3, 0, None, "a"), (4, 0, "assistant", "b"), (4, 0, "assistant", "b"), (4, None, "tool>~1", "é\n中"),
            (None, 0, "user", "q"), (None, 1, "assistant", "r"), (6, 0, "assistant", "long " * 100_000), *hot]
    f, examples = formatted(spark, rows)
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is None, t or 0, role or "", text or ""))
    got = {r["conv_id"]: r for r in chat.digest(f, examples).collect()}
    spans = {(r["conv_id"], r["nth"]): r for r in examples.collect()}
    whole = {(r["conv_id"], r["nth"]): r for r in chat.expand(
        *(t.where("conv_id <> 5 or conv_id is null") for t in (f, examples))).collect()}
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        trained = [t[3] for t in turns if t[2] == "assistant"]
        r = got[c]
        assert (r["n_turns"], r["n_examples"]) == (len(turns), len(trained))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest()
        assert r["loss_chars"] == sum(map(len, trained))
        assert r["loss_sha256"] == hashlib.sha256("".join(trained).encode()).hexdigest()
        rendered = [chat.render(t[2], t[3])[0] for t in turns]
        assert r["formatted_chars"] == sum(map(len, rendered))
        for n, t in enumerate(turns):
            if t[2] != "assistant":
                assert (c, n) not in spans
                continue
            s, upto = spans[c, n], "".join(rendered[:n + 1])
            assert s["example_chars"] == len(upto) and s["nth"] == n
            assert chat.unescape(upto[s["target_from"]:s["target_to"]]) == t[3]
            if c != 5:
                assert whole[c, n]["text"] == upto and whole[c, n]["target_from"] == s["target_from"]


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    path = shared_path(spark, "test-chat")
    chat.write_formatted(df, path)
    f, examples = chat.read_formatted(spark, path), chat.read_examples(spark, path)
    assert chat.digest(f, examples).count() == 0 and examples.count() == 0 and chat.expand(f, examples).count() == 0


def test_the_examples_are_the_loss_mask(spark):
    """Without an example its reply is no longer in the loss; a narrower span leaves characters out."""
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "first"), (1, 2, "user", "q"), (1, 3, "assistant", "second")]
    f, examples = formatted(spark, rows)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for kept, want in ((examples, "firstsecond"), (examples.where("nth <> 3"), "first"), (examples.where("nth > 3"), ""),
                       (examples.selectExpr("conv_id", "nth", "target_from + 1 as target_from", "target_to", "example_chars"), "irstecond")):
        r = chat.digest(f, kept).first()
        assert (r["loss_sha256"], r["loss_chars"], r["n_turns"]) == (digest(want), len(want), 4)


def vectors_by_hand(rows, threshold):
    ok = []
    for _, v, label in rows:
        good = label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)
        ok.append(np.array(v, float) if good and any(v) else None)
    n = len(rows)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]):
                a, b = (v / 2.0 ** np.frexp(np.abs(v).max())[1] for v in (ok[i], ok[j]))
                link[i, j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(link[todo.pop()]).tolist():
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], int(link[i].sum()), low, rows[i][0] == low))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [2048, 7])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors(spark, tile, kind):
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for label in (1, 2, None):
        for _ in range(6):
            centre = rng.normal(size=8)
            for _ in range(9):
                v = centre + rng.normal(size=8) * rng.choice([0.05, 0.2, 0.35])
                rows.append((i, np.float32(v).astype(float).tolist(), label))
                i += 1
    rows += [(200 + k, rows[0][1], 1) for k in range(25)]  # a group of copies
    # finite components whose squares are not: only their directions count
    base = rows[3][1]
    extreme = [] if kind == "float" else [(400, [x * 2.0**600 for x in base], 1), (401, [x * 2.0**-600 for x in base], 1)]
    rows += [(300, [2 * x for x in rows[0][1]], 1), (301, [0.0] * 8, 1), (302, None, 1), (303, [], 1),
             (304, [float("nan")] * 8, 1), (305, [float("inf")] + [1.0] * 7, 1), (306, [None] + [1.0] * 7, 1),
             (None, rows[0][1], 1), (0, rows[0][1], 1), *extreme, (307, rows[0][1][:4], 1), (308, rows[0][1][:4], 1), (None, None, None)]
    df = spark.createDataFrame([(*r, "?") for r in rows], f"vec_id long, embedding array<{kind}>, label int, node string")
    got = vectors.near_vectors(df.repartition(3), tile=tile).collect()
    assert sorted(map(tuple, got), key=repr) == vectors_by_hand(rows, 0.93)


def test_quantisation_bound_is_rigorous():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 48)) * rng.choice([1e-3, 1, 50], (400, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, e, m = vectors.quantise(x)
    approx = vectors._product(q, q) * s[:, None] * s[None, :]
    bound = e[:, None] * m[None, :] + m[:, None] * e[None, :] + e[:, None] * e[None, :]
    assert (np.abs(x @ x.T - approx) <= bound + 1e-12).all()


def test_vectors_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(df).count() == 0
