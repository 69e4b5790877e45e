"""Token alignment against a merge of the two token rows, with the libraries' own encoders."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from jobstrata.llm import alignment, queries
from jobstrata.llm.bpe import _byte_letters
from tests.llm import odd

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    letters = {letter: i for i, letter in enumerate(_byte_letters())}
    a_bytes = {i: bytes(letters[c] for c in x) for x, i in first.get_vocab().items() if x != "<|endoftext|>"}

    def piece(i):
        found = re.fullmatch("<0x(..)>", second.id_to_piece(i))
        return bytes([int(found[1], 16)]) if found else second.id_to_piece(i).replace("▁", " ").encode()

    def encode(text):
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        return a, b, [a_bytes[i] for i in a], [piece(i) for i in b]

    return encode


def merged(encode, text):
    """Groups and links by walking both token rows side by side; None where bytes differ."""
    if not text:
        return None
    a, b, a_bytes, b_bytes = encode(text)
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None
    groups, links, i, j = [([], [])], [], 0, 0
    end_a, end_b = len(a_bytes[0]), len(b_bytes[0])
    groups[-1][0].append(a[0])
    groups[-1][1].append(b[0])
    while True:
        links.append((a[i], b[j]))
        on_a, on_b = end_a <= end_b, end_b <= end_a
        if on_a and on_b:
            if i + 1 == len(a):
                return groups, links
            groups.append(([], []))
        if on_a:
            i += 1
            end_a += len(a_bytes[i])
            groups[-1][0].append(a[i])
        if on_b:
            j += 1
            end_b += len(b_bytes[j])
            groups[-1][1].append(b[j])


def plain(encode, texts):
    found = [merged(encode, x) for x in texts]
    counts, best = Counter(), defaultdict(int)
    for one in found:
        counts.update(set(one[1]) if one else [])
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for one in found:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links = one
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((
            sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
            sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


def test_query(spark, data_dir, libraries):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.queries()["op12_token_alignment"](spark, data_dir).collect()}
    assert found == dict(zip([r["doc_id"] for r in docs], plain(libraries, [r["text"] for r in docs])))


def test_odd_rows(spark, libraries):
    more = ["a ▁ b", "tail ", " head", "two  blanks   three\t\n x", "<s> </s> <0x41> <unk>", "‮﻿ ́", "ﬁ ½ Ⅷ"]
    rows = odd.rows() + [odd._row(100 + k, x, "en") for k, x in enumerate(more)]
    docs = spark.createDataFrame(rows, odd.SCHEMA).repartition(3)
    found = sorted(map(repr, (tuple(r) for r in alignment.compare(docs, A, B).collect())))
    expected = plain(libraries, [r[1] for r in rows])
    assert found == sorted(repr((r[0], *e)) for r, e in zip(rows, expected))
    assert alignment.compare(odd.empty(spark), A, B).count() == 0


def test_units_make_up_the_whole(libraries):
    own = alignment.vocabularies(A, B)
    for text in ["It's one  text, with\n\nparts 12 345 and it's \n cut \t anywhere " * 4 + "ü" * 300 + " end", " lead", "x", "a \n b", "a\u00a0 b \u3000c 'll 's"]:
        a, b, n_a, n_b, good = own.encode(alignment.units_of(text))
        whole = libraries(text)
        assert good.all() and a.tolist() == whole[0] and b.tolist() == whole[1] and n_a.sum() == len(a) and n_b.sum() == len(b)


def test_pointer_jumping():
    rng = np.random.default_rng(5)
    for _ in range(50):
        end = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, end + 1, rng.integers(1, 40)), end)) for _ in range(2)]
        label = alignment.terminals(*ends)
        common = np.intersect1d(*ends)
        for side, first in zip(ends, (0, len(ends[0]))):
            expected = np.searchsorted(ends[0], common[np.searchsorted(common, side)])
            assert np.array_equal(label[first : first + len(side)], expected)


def test_groups_as_text(spark, libraries):
    text = "Some words, Ünïcode and more words 123"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    groups = merged(libraries, text)[0]
    found = alignment.aligned(docs, A, B, groups=True).first()["groups"]
    assert found == ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
