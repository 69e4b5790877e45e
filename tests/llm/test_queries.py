"""Every corpus query against a plain version, a library, its SQL or its held-out rows."""

import hashlib
import re
import zlib
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from jobstrata.llm import exact_dedup, fingerprints, quality, queries, simhash_dedup, url_filter, warc


@pytest.fixture(scope="module")
def tables(data_dir):
    with duckdb.connect() as con:
        for name in ("documents", "pages", "labels"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data_dir}/{name}.parquet')")
        yield con


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary())


def rows(spark, data_dir, name):
    return queries.queries()[name](spark, data_dir).collect()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, data_dir, tables, name):
    expected = tables.sql(queries.oracle_sql()[name])
    columns = sorted(expected.columns)
    found = queries.queries()[name](spark, data_dir)
    assert sorted(found.columns) == columns
    key = repr
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=key) == sorted(expected.select(*columns).fetchall(), key=key)


def test_language_on_held_out_rows(spark, data_dir, tables):
    lang = dict(tables.sql("SELECT doc_id, lang FROM documents").fetchall())
    found = rows(spark, data_dir, "op1_language_id")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"]]
    assert len(held) > 20 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97


def plain_simhash(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    return sum(1 << k for k in range(64) if 2 * int((hashes >> np.uint64(k) & np.uint64(1)).sum()) > len(hashes))


def plain_components(prints, radius):
    keys, root = sorted(prints), {}
    for k in keys:
        root[k] = k
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if (prints[a] ^ prints[b]).bit_count() <= radius and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def test_simhash(spark, data_dir, texts):
    prints = {k: plain_simhash(v) for k, v in texts.items()}
    root = plain_components(prints, 2)
    found = rows(spark, data_dir, "op2_simhash_dedup")
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {k: (f"{prints[k]:016x}", root[k]) for k in texts}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_links(spark, radius):
    """Large buckets, dealt into several cells, and small ones give the components of all pairs."""
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))) for c in centres for _ in range(25)]
    values = sorted({*near, *map(int, rng.integers(0, 2**63, 50, dtype=np.uint64)), 0, 2**64 - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    links = [(r["a"], r["b"]) for r in simhash_dedup.edges(distinct, radius, cell=16).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    expected = plain_components(dict(enumerate(values)), radius)
    parent = {v: v for v in signed}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[top(a)] = top(b)
    groups = {}
    for k, v in enumerate(signed):
        groups.setdefault(top(v), set()).add(k)
    plain = {}
    for k, r in expected.items():
        plain.setdefault(r, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_fingerprints(spark, data_dir, texts):
    found = {r["doc_id"]: r for r in rows(spark, data_dir, "op3_fingerprints")}
    keys = sorted(texts)
    assert sorted(found) == keys
    for k, after in zip(keys, keys[1:] + keys[:1]):
        text, half = texts[k], len(texts[k]) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        assert (found[k]["n_chars"], found[k]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    assert sum(r["near_edited"] > r["near_next"] for r in found.values()) / len(found) > 0.95
    prints = {k: int(r["fingerprint"], 16) for k, r in found.items()}
    for k in (0, 100):
        near = sum((prints[k] ^ x).bit_count() <= fingerprints.RADIUS for x in prints.values())
        assert found[k]["near_docs"] == near


def test_block_tables_find_all(spark):
    rng = np.random.default_rng(5)
    base = [(int(a), int(b)) for a, b in rng.integers(-(2**62), 2**62, (40, 2))]
    moved = [(a ^ (1 << int(k)), b ^ (1 << int(m)) ^ (1 << int(n))) for (a, b), (k, m, n) in zip(base * 3, rng.integers(0, 62, (120, 3)))]
    prints = sorted({*base, *moved})
    known = spark.createDataFrame(prints, "low long, high long")
    found = {tuple(r) for r in fingerprints.near(spark.createDataFrame(base, "low long, high long"), known).collect()}
    expected = {(*q, *p, n) for q in base for p in prints if (n := (q[0] ^ p[0]).bit_count() + (q[1] ^ p[1]).bit_count()) <= 3}
    assert found == expected


def test_quality_on_held_out_rows(spark, data_dir, tables):
    label = dict(tables.sql("SELECT doc_id, quality FROM labels").fetchall())
    found = rows(spark, data_dir, "op4_quality")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    held = [(r["predicted"], label[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in label]
    assert held and sum(a == b for a, b in held) / len(held) >= 0.9


def test_discriminant_is_the_density_difference(spark, data_dir):
    """Scores from the factors equal those from plain normal densities."""
    rng = np.random.default_rng(1)
    means, covariances = rng.normal(size=(2, 4)), [np.cov(rng.normal(size=(4, 30))) for _ in range(2)]
    lower = [np.linalg.cholesky(c) for c in covariances]
    model = quality.Model(0.7, np.zeros(4), np.ones(4), means, np.array([np.linalg.inv(x) for x in lower]), np.array([np.linalg.slogdet(c)[1] for c in covariances]))
    points = rng.normal(size=(50, 4))
    density = [np.exp(-0.5 * np.einsum("ij,jk,ik->i", points - m, np.linalg.inv(c), points - m)) / np.sqrt(np.linalg.det(c)) for m, c in zip(means, covariances)]
    assert np.allclose(model.score(points), 0.7 * density[1] / (0.7 * density[1] + 0.3 * density[0]))


def test_urls(spark, data_dir, tables):
    fixed = [(r.verdict, *r.parts, r.text) for r in queries.URL_RULES]
    urls = dict(tables.sql("SELECT page_id, url FROM pages").fetchall())
    found = rows(spark, data_dir, "op5_url_filter")
    assert sorted(r["page_id"] for r in found) == sorted(urls)
    for r in found:
        rest = (urls[r["page_id"]] or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path, host = re.match(r"[^?#]*", rest[len(host) :])[0], host.lower()
        fits = [(len(text), text, verdict) for verdict, h, p, text in fixed if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r["host"], r["path"], r["rule"]) == (host, path, max(fits)[1] if fits else None)
        assert r["verdict"] == (max(fits)[2] if fits else ("block" if r["block_score"] > 0.5 else "allow"))


def test_trees_learn(spark):
    """Trees separate what one feature and a pair of features tell apart."""
    data = [(f"u{k}", *[float(k * (j + 3) % 17) for j in range(len(url_filter.FEATURES))]) for k in range(300)]
    data = [(*row, "block" if (row[1] > 8) != (row[2] > 5) else "allow") for row in data]
    df = spark.createDataFrame(data, "url string, " + ", ".join(f"{x} double" for x in url_filter.FEATURES) + ", ruled string")
    blocked = sum(row[-1] == "block" for row in data)
    model = url_filter.train(df, len(data), blocked)
    right = df.filter((model.margin() > 0) == (df["ruled"] == "block")).count()
    assert right / len(data) > 0.95


def test_bpe(spark, data_dir, texts, library):
    for r in rows(spark, data_dir, "op6_bpe"):
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_on_any_text(library):
    import pyarrow as pa
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from jobstrata.llm import bpe
    from tests.llm.odd import TEXTS

    own = bpe.encoder(queries.vocabulary())

    def same(texts):
        flat, ends = own.encode(pa.array(texts, pa.string()))
        for k, text in enumerate(texts):
            assert flat[ends[k] : ends[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text

    same(TEXTS)
    letters = st.text(st.sampled_from("'sTreVELlmMd 1é́Σİ<|endoftext>\n\t-_!世"), max_size=60)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(letters, min_size=1, max_size=5))
    def run(texts):
        same(texts)

    run()
    long = "word, another " * 40 + "x" * 700
    assert np.concatenate([own.encode(pa.array([p]))[0] for p in bpe.segments(long, 50)]).tolist() == library.encode(long, add_special_tokens=False).ids


def test_packing(spark, data_dir, texts, library):
    at, sequences = dict.fromkeys(texts, 0), {}
    for r in sorted(rows(spark, data_dir, "op9_packing"), key=lambda r: (r["doc_id"], r["start"])):
        ids = np.array(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2], "<u4")
        start, length = r["start"], r["length"]
        assert start == at[r["doc_id"]] and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[start : start + length].tobytes())
        at[r["doc_id"]] += length
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], length))
    assert all(at[k] == len(library.encode(v, add_special_tokens=False).ids) + 1 for k, v in texts.items())
    assert all(len(x) == 1 and x[0][0] == 0 and x[0][1] <= 4096 and x[0][1].bit_count() == 1 for x in sequences.values())


def test_polynomials_compose():
    rng = np.random.default_rng(2)
    for n, m in ((0, 0), (0, 5), (7, 0), (4096, 4096), (5000, 12_345), (3, 40_000)):
        a, b = rng.bytes(n), rng.bytes(m)
        assert exact_dedup.compose(exact_dedup.polynomial(a), exact_dedup.polynomial(b), m) == exact_dedup.polynomial(a + b)
    for p, r in exact_dedup.FIELDS:
        value = 0
        for x in b"plain":
            value = (value * r + x + 1) % p
        assert value in exact_dedup.polynomial(b"plain")


def test_unequal_texts_under_one_fingerprint(spark, monkeypatch):
    """Groups that only share a fingerprint are taken apart by the comparison of chunks."""
    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "a b"), (4, "xyz")], "doc_id long, text string")
    real = exact_dedup.polynomial
    monkeypatch.setattr(exact_dedup, "_chunks", _colliding(exact_dedup._chunks))
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda d: _collided(spark))
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.find_duplicates(docs).collect()}
    assert real(b"ab") != real(b"cd") and found == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1)}


def _colliding(chunks):
    def run(batches):
        import pyarrow as pa

        for batch in chunks(batches):
            keys = ["same" if bytes(x) in (b"ab", b"cd") else "other" for x in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *batch.columns[1:]], batch.schema.names)

    return run


def _collided(spark):
    def sha(x):
        return hashlib.sha256(x).hexdigest()

    rows = [(1, 2, "same", sha(b"ab")), (2, 2, "same", sha(b"cd")), (3, 3, "same", sha(b"ab")), (4, 3, "other", sha(b"xyz"))]
    return spark.createDataFrame(rows, "doc_id long, n_points long, fingerprint string, text_sha256 string")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_warc(spark, data_dir, tables):
    pages = dict(tables.sql("SELECT page_id, html FROM pages").fetchall())
    made = rows(spark, data_dir, "op7_warc")
    assert len(made) == 2 * len(pages)
    sources = {}
    for r in made:
        sources.setdefault(r["page_id"], set()).add((r["refers_to"], r["source_payload_digest"]))
        assert r["block_digest"] == warc.digest(r["content"].encode())
        if r["warc_type"] == "conversion":
            parser = _Text()
            parser.feed(pages[r["page_id"]])
            assert "".join(r["content"].split()) == "".join("".join(parser.out).split())
    assert all(len(x) == 1 and next(iter(x))[1] == warc.digest(pages[k].encode()) for k, x in sources.items())
    assert len({r["record_id"] for r in made}) == len(made)


def test_warc_files(spark, data_dir, tmp_path):
    pages = spark.read.parquet(f"{data_dir}/pages.parquet")
    source = warc.responses(pages, "2024-01-01T00:00:00Z")
    warc.write_warc(source.repartition(2), f"{tmp_path}/source")
    back = warc.read_warc(spark, f"{tmp_path}/source")
    columns = ["warc_type", "record_id", "target_uri", "warc_date", "content_type", "headers", "block"]
    assert back.filter("not complete").count() == 0
    key = lambda r: r["record_id"]
    assert sorted(back.select(columns).collect(), key=key) == sorted(source.select(columns).collect(), key=key)
    first = {r["record_id"]: r for r in warc.derive(source).collect()}
    warc.write_warc(warc.derive(back), f"{tmp_path}/derived")
    again = warc.read_warc(spark, f"{tmp_path}/derived")
    assert {r["record_id"]: bytes(r["block"]) for r in again.collect()} == {k: bytes(r["block"]) for k, r in first.items()}
    one = again.filter("warc_type = 'conversion'").first()["headers"]
    assert one["WARC-Refers-To"].startswith("<urn:uuid:") and one["Source-Payload-Digest"].startswith("sha1:") and one["WARC-Refers-To-Date"]
