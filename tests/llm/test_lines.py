"""Repeated lines and passages that the SQL of op8 and its tables don't show."""

import numpy as np

import corpus_pipeline
from jobstrata.llm import line_dedup


def words(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]


def runs(text, size=50):
    own = text.split()
    return {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}


def cleaned(spark, texts):
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()}


def test_passages_in_differing_lines(spark):
    """A run of 50 words goes from later documents wherever it stands and however its lines are broken; other words stay."""
    rng = np.random.default_rng(3)
    run, long = words(rng, 50), words(rng, 400)
    own = [words(rng, n) for n in (40, 41, 3, 0, 60, 30, 30)]
    broken = " ".join(run[:20]) + "\n" + " ".join(run[20:])
    texts = [
        " ".join(own[0] + run + own[1]), " ".join(own[2] + run + ["x"]), "y " + broken, " ".join(own[4] + long),
        " ".join(long[100:170] + own[5]), " ".join(own[6] + long[200:249] + own[2]), " ".join(own[6] + long[:30] + own[4][:10]), None, "",
    ]
    found = cleaned(spark, texts)
    assert found[0] == texts[0] and found[3] == texts[3] and found[7] is None and found[8] == ""
    seen = runs(texts[0]) | runs(texts[3])
    for k in (1, 2, 4, 5):
        assert not runs(found[k]) & seen
    # What goes is of the shared run alone, and at most 24 words of it stay at either end.
    for k, shared in ((1, run), (2, run), (4, long[100:170]), (5, long[200:249])):
        left = found[k].split()
        assert [x for x in left if x not in shared] == [x for x in texts[k].split() if x not in shared]
        assert sum(x in shared for x in left) <= 48 and len(left) < len(texts[k].split())
    assert set(own[6]) <= set(found[5].split())


def test_no_passage_of_fewer_words_goes(spark):
    rng = np.random.default_rng(4)
    short = words(rng, 24)
    texts = [" ".join(words(rng, 60) + short + words(rng, 60)) for _ in range(3)]
    assert cleaned(spark, texts) == dict(enumerate(texts))


def test_cut_keeps_line_ends():
    rng = np.random.default_rng(5)
    run = words(rng, 49)
    text = "a b\n" + " ".join(run[:30]) + "\n" + " ".join(run[30:]) + " c\nd"
    keys = line_dedup.windows(run)[1].view(np.int64).tolist()
    left = line_dedup.without_windows(text, set(keys))
    assert left.startswith("a b\n") and left.endswith(" c\nd") and len(left.split()) == 53 - 25
    assert line_dedup.without_windows(text, set()) == text


def dropped(spark, texts):
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r["n_dropped"] for r in line_dedup.deduplicate(docs).collect()}


def test_lines_that_do_not_repeat_stay(spark):
    """Rows of numbers, and short sentences that differ in a word or two, are no repeats."""
    texts = [
        "1 2 3 4 5\n2024-01-01 10 20 30 total 7 8 9\nwe will paint the old house in May",
        "9 8 7 6 5\n2024-01-02 11 21 31 total 5 6 7\nwe will paint the old bridge in May",
        "EUR 1 2 3 4 5 6 7 8 9\nsold in 3 6 9 12 15 18 21 24 27 30 33",
        "EUR 9 8 7 6 5 4 3 2 1\nsold in 1 4 7 10 13 16 19 22 25 28 31",
    ]
    assert dropped(spark, texts) == dict.fromkeys(range(4), 0)


def test_lines_that_repeat_go(spark):
    """Equal rows of numbers, and long lines that differ in digits or in one span."""
    long = "our team builds the data platform that every other team of the company relies on"
    texts = ["1 2 3 4 5\nposted 3 days ago by Acme\n" + long, "1 2 3 4 5\nposted 17 days ago by Acme\n" + long.replace("every other", "each other")]
    assert dropped(spark, texts) == {0: 0, 1: 3}
