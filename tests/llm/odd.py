"""Rows that every operator has to take: nulls, empty and long texts, ties, repeats, clashing columns."""

TEXTS = [
    None, "", " \t\n\r\x0b ", "!!! ???", "a", "Word", "The of and to in the house.", "the OF and to in the house.", "日本語 テスト 한국어",
    "ÀÉÎ straße İSTANBUL ΣΑΣ", "😀👨‍👩‍👧 done", "x" * 5000, "line one of the text here\n\nline one of the text here\n", "it's we'RE don't 1234 a_b",
    "long text of many words and parts, " * 3000, "nul \x00 inside", "<|endoftext|> tail", "a\u00a0b\u2003c\x85d",
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, row_id long, n long, key string, "
    "line string, label int, words string, held_out boolean, rule string, node long, root long, n_lines long, ids string, predicted int, lang_pred string"
)


def _row(doc_id, text, lang):
    return (doc_id, text, lang, "s", len(text or ""), 7.5, "f", 1, 2, "k", "l", 3, "w", True, "r", 4, 5, 6, "i", 9, "zz")


def rows():
    out = [_row(k, x, ["en", "de", None][k % 3]) for k, x in enumerate(TEXTS)]
    out += [out[6], out[6], out[0]]  # repeated rows
    out += [_row(6, "another text under one id", "en"), _row(None, "no id but a text", "en"), _row(None, None, None)]
    return out


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
