"""Personal data: patterns against the contract's own, messages against enumeration, added spans on written texts."""

import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobstrata.llm import pii, queries
from tests.llm import odd

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def check(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(x) <= 255 for x in text.split("."))
    if kind == 2:
        total = sum(sum(divmod(int(x) * (1 + k % 2), 10)) for k, x in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == 0 or 8 <= len(digits) <= 15


def plain(text):
    return [(k + 1, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if check(k, m[0])]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+01239 (é_%\n", max_size=60))
def test_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_patterns_on_written_texts():
    for text in [
        "4111 1111 1111 1111, 4111-1111-1111-1112 and 4111111111111111 4111111111111111", "1.2.3.4.5.6.7.8 0001.02.3.256 999.1.1.1",
        "a@b.c-d@e.f @x.y q@@r.s t@u v@w.x.", "+1 (743) 555-3824 +12 +1 2 +123456789012345678 ++49 (0)30-1234567.", "é@b.c 日a@b.c",
    ]:
        assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("piece", ["x", "1", "1.", "@a", "a.b@", "+1 ", "(1) ", "1-", "a@b.c ", "+12345678 ", "12345678 "])
def test_long_texts_take_linear_time(piece):
    begun = time.process_time()
    text = piece * (200_000 // len(piece))
    spans = pii.base_spans(text)
    row = pii.tokens(text, spans)
    assert time.process_time() - begun < 5 and len(pii.ties(row)[1]) <= 2 * len(row)


def enumerated(unary, edges, potentials):
    n, m = unary.shape
    out = np.zeros((n, m))
    for labels in itertools.product(range(m), repeat=n):
        score = sum(unary[i, x] for i, x in enumerate(labels)) + sum(t[labels[a], labels[b]] for (a, b), t in zip(edges, potentials))
        for i, x in enumerate(labels):
            out[i, x] += np.exp(score)
    return out / out.sum(1, keepdims=True)


def test_messages():
    rng = np.random.default_rng(3)
    tree = np.array([(0, 1), (1, 2), (1, 3), (3, 4)])
    unary, tables = rng.normal(size=(5, 3)), rng.normal(size=(4, 3, 3))
    unary[2] = [-np.inf, 0, -np.inf]
    assert np.allclose(pii.marginals(unary, tree, tables, 200), enumerated(unary, tree, tables), atol=1e-6)
    # With a loop the result is close, not exact.
    loop = np.array([(0, 1), (1, 2), (0, 2), (2, 3)])
    tables = rng.normal(size=(4, 3, 3)) * 0.5
    near = pii.marginals(unary[:4], loop, tables, 200)
    assert np.abs(near - enumerated(unary[:4], loop, tables)).max() < 0.1


def test_pseudo_likelihood_gradient_ends_at_a_maximum():
    counts = {(0, 0, 0, -1, -1, -1, 0): 40, (3, 2, 0, -1, 0, -1, 4): 30, (3, 1, 4, 0, -1, 4, 4): 9, (8, 0, 0, -1, -1, -1, 3): 20, (0, 0, 1, 4, -1, -1, 0): 5}
    field = pii.fit(counts)
    rows = {**{k: v * 0.95 / 104 for k, v in counts.items()}}
    prior = pii._prior()

    def objective(f):
        total = 0.0
        for row, weight in [*rows.items(), *[(p, 0.05 / len(prior)) for p in prior]]:
            shape, style, cue, left, right, like, y = row
            score = f.shape[shape] + f.style[style] + f.cue[cue]
            score = score + (f.chain[left] if left >= 0 else 0) + (f.chain[:, right] if right >= 0 else 0)
            if like >= 0:
                score = score + np.eye(5)[like] * f.skip
            total += weight * (score[y] - np.logaddexp.reduce(score))
        return total - 0.5e-5 * sum(float((x**2).sum()) for x in vars(f).values())

    best = objective(field)
    rng = np.random.default_rng(0)
    for _ in range(60):
        other = pii.Field(*[x + rng.normal(size=x.shape) * 0.3 for x in vars(field).values()])
        assert objective(other) < best + 1e-4


def written(spark):
    filler = "The house of the old town has 12345678 doors and 2024-01-15 dates. " * 3
    texts = [f"{filler} write to {n}.{k}@mail.example.com or call +1 ({200 + k}) 555-{1000 + k} now. {filler}" for k, n in enumerate(["ana", "bob", "eve"] * 20)]
    texts += ["ids 1234567890 and 99887766 and 20240115 here", "nothing at all", "10.20.30.40 is a host", "paid with 4111111111111111 then"] * 20
    probes = {
        1000: ("Call +1 (743) 555-3824 today. " + filler + " Again: 743-555-3824.", ["743-555-3824"]),
        1001: ("4465758382889437 4465758382889437 twice", ["4465758382889437", "4465758382889437"]),
        1002: ("Mail ana.lima@mail.example.com. " + filler + " User ana.lima was here, ana was not.", ["ana.lima"]),
        1003: ("Only 743-555-38 and 12 and 2024-01-15 and 1234567890 here.", []),
        1004: ("Nothing.", []),
        1005: ("17435553824 seen " * 3 + "then +1 743 555 3824", ["17435553824"] * 3),
    }
    rows = [(k, t) for k, t in enumerate(texts)] + [(k, t) for k, (t, _) in probes.items()]
    return spark.createDataFrame(rows, "doc_id long, text string"), probes


def test_added_spans(spark):
    docs, probes = written(spark)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in pii.detect(docs).collect():
        own = text[row["doc_id"]]
        base = pii.as_text(plain(own))
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        spans = [x for x in row["spans"].split(",") if x]
        more = [x for x in spans if x not in base.split(",")]
        assert len(more) == row["n_added"] and len(spans) == row["n_added"] + sum(row[f"n_{k}"] for k in pii.KINDS)
        expected = probes.get(row["doc_id"], ("", []))[1]
        found = sorted(own[slice(*map(int, x.split(":")[1:]))] for x in more)
        assert found == sorted(expected), own


def test_query_and_odd_rows(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = queries.queries()["op11_pii"](spark, data_dir).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(text)
    for row in found:
        base = plain(text[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(pii.as_text(base).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in range(1, 5)]
    rows = pii.detect(odd.frame(spark)).collect()
    assert sorted(map(repr, (r["doc_id"] for r in rows))) == sorted(repr(r[0]) for r in odd.rows())
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (0, 1, 2, 3))
    assert pii.detect(odd.empty(spark)).count() == 0


def test_redact():
    text = "a b.c@d.e f +1 (743) 555-3824"
    assert pii.redact(text, pii.as_text(pii.base_spans(text))) == "a <email> f <phone>"
    assert pii.redact("abcdef", "card:1:3,phone:2:5") == "a<card/phone>f" and pii.redact("abc", "") == "abc"
