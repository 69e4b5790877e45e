"""Personal data by a skip-chain conditional random field.

Fixed patterns give base spans: mail addresses, IP addresses, card numbers that pass the Luhn test, phone numbers. Around them
stand candidates that no pattern takes, such as a phone number without its plus, a card number in a longer run of digits, or
the name in front of a known address. Spans and candidates of a document are the tokens of a random field with the labels
``LABELS``. Neighbours in the text share a chain potential. Tokens that repeat each other, or look alike (the last
``TAIL`` digits, the name of an address), share a skip potential, however far apart: each is tied to the one before it
and to the first base span among them, so a group of any size has two ties a token. Loopy message passing over all of
a batch's documents then carries labels along both kinds of ties. Base spans keep their label; a candidate becomes a span when one
label has at least ``SURE`` of its marginal.

Weights are fitted by pseudo-likelihood on counts over all documents: of base spans with what gives them away hidden (the plus
of a phone number), and of candidates that resemble no base span, which count as no data. The counts are one row per kind of
surroundings, a product of short lists, and that is all the driver gets.

A null or empty text has no span. Texts of any length are matched whole in one task, in linear time; what is kept of them are
their tokens. Positions are code points. Repeated rows are judged each on their own, equal texts alike. An empty table gives an
empty result and a model of its prior. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import materialize, slices, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
EMAIL, IP, CARD, PHONE = range(1, 5)
TAIL = 8
GAP = 48
SURE = 0.9
BATCH = 1 << 23

# The patterns of the contract, each written so that no text takes more than linear time.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@(?:[A-Za-z0-9-]++((?:\.[A-Za-z0-9-]++)+)?)?")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Candidates: groups of digits that stand alone, and words.
_NUMBER = re.compile(r"(?<![0-9A-Za-z_+])\(?[0-9]++(?![A-Za-z_])(?:(?:[ .-]|\)[ .-]?| \()[0-9]++(?![A-Za-z_]))*+")
_WORD = re.compile(r"[A-Za-z0-9._%+-]++")
_DATE = re.compile(r"(?:19|20)[0-9]{2}[ .-][0-9]{2}[ .-][0-9]{2}|[0-9]{2}[ .-][0-9]{2}[ .-](?:19|20)[0-9]{2}")
_DIGITS = re.compile(r"[^0-9]+")

SHAPES = (*[f"digits{n}" for n in range(8, 16)], "luhn", "long", "quads", "address", "name")
STYLES = ("bare", "grouped", "brackets", "date", "text")
# Words in front of a token that speak for a kind; the last one wins.
CUES = {
    **dict.fromkeys(("email", "e-mail", "mail", "correo", "courriel"), EMAIL),
    **dict.fromkeys(("ip", "host", "server", "addr"), IP),
    **dict.fromkeys(("card", "visa", "mastercard", "carte", "tarjeta", "karte", "cartão"), CARD),
    **dict.fromkeys(("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "teléfono", "telefone", "whatsapp"), PHONE),
}


def luhn(digits: str) -> bool:
    doubled = [int(x) for x in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(x * 2 - 9 * (x > 4) for x in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return _DIGITS.sub("", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Label, start and end of every span of the patterns, by label, then start."""
    out = []
    last = before = 0
    if "@" in text:
        for found in _DOMAIN.finditer(text):
            at = found.start()
            # The name is the run of its characters in front, as far as nothing else has taken it.
            low = max(last, before)
            start = low + len(text[low:at].rstrip(_LOCAL))
            if start < at and found[1]:
                out.append((EMAIL, start, found.end()))
                last = found.end()
            before = at + 1
    for found in _IP.finditer(text):
        # Parts are numbers: zeros in front do not count, and a part may have any length.
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in (part.lstrip("0") for part in found[0].split("."))):
            out.append((IP, *found.span()))
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = _digits(found[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((CARD, *found.span()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= len(_digits(found[0])) <= 15:
                out.append((PHONE, *found.span()))
    return out


@dataclass
class Token:
    """A base span (``base`` is its label) or a candidate (0), with what the field knows of it."""

    start: int
    end: int
    base: int
    shape: int
    style: int
    cue: int
    key: str


def _style(text: str) -> str:
    if _DATE.fullmatch(text):
        return "date"
    if "(" in text or ")" in text:
        return "brackets"
    return "bare" if text.isdigit() else "grouped"


def _shape(digits: str) -> str:
    return f"digits{len(digits)}" if len(digits) < 16 else "luhn" if luhn(digits) else "long"


def _cue(text: str, start: int) -> int:
    words = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", text[max(0, start - 32) : start].lower())[-3:]
    return next((CUES[w] for w in reversed(words) if w in CUES), 0)


def _token(text: str, start: int, end: int, base: int) -> Token | None:
    """The token of a span, as it would look without what gives a base span away; None if it cannot be personal data."""
    piece = text[start:end]
    if base == EMAIL or "@" in piece:
        key, shape, style = "m" + piece.split("@")[0].lower(), "address", "text"
    elif base == IP:
        key, shape, style = "i" + piece, "quads", "grouped"
    elif piece.count(".") == 3 and _IP.fullmatch(piece):
        key, shape, style = "i" + piece, "quads", "grouped"
    else:
        digits = _digits(piece)
        if not 8 <= len(digits) <= 19:
            return None
        key, shape, style = "d" + digits[-TAIL:], _shape(digits), _style(piece.lstrip("+"))
    return Token(start, end, base, SHAPES.index(shape), STYLES.index(style), _cue(text, start), key)


def _numbers(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Groups of digits outside the taken places; a group that fits no number is cut at its blanks."""
    at = 0

    def free(start: int, end: int) -> bool:
        nonlocal at
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        return at == len(taken) or taken[at][0] >= end

    for found in _NUMBER.finditer(text):
        start, end = found.span()
        if end - start < 8:
            continue
        digits = _digits(found[0])
        if free(start, end) and (8 <= len(digits) <= 15 or len(digits) <= 19 and luhn(digits)):
            yield start, end
        elif " " in found[0]:
            for piece in re.finditer(r"[^ ]+", found[0]):
                low, high = start + piece.start(), start + piece.end()
                if piece.end() - piece.start() >= 8 and free(low, high):
                    yield low, high
        elif free(start, end):
            yield start, end


def tokens(text: str, spans: list[tuple[int, int, int]]) -> list[Token]:
    """Base spans and candidates of a text in order."""
    taken: list[tuple[int, int]] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(end, taken[-1][1]))
        else:
            taken.append((start, end))
    found = [_token(text, s, e, k) for k, s, e in spans]
    found += [_token(text, s, e, 0) for s, e in _numbers(text, taken)]
    if "@" in text:
        names = {text[s:e].split("@")[0].lower() for k, s, e in spans if k == EMAIL}
        # Plain words are no names: a name has a digit or one of the marks inside.
        names = {x for x in names if len(x) >= 5 and re.search(r"[a-z].*[0-9._+-]|[0-9._+-].*[a-z]", x)}
        at = 0
        for word in _WORD.finditer(text) if names or text.count("@") > sum(k == EMAIL for k, _, _ in spans) else ():
            start, end = word.start(), word.start() + len(word[0].rstrip("._%+-"))
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at < len(taken) and taken[at][0] < end:
                continue
            if text[end : end + 1] == "@" and (host := _WORD.match(text, end + 1)):
                if at == len(taken) or taken[at][0] >= host.end():
                    found.append(_token(text, start, host.end(), 0))
            elif text[start:end].lower() in names:
                token = Token(start, end, 0, SHAPES.index("name"), STYLES.index("text"), _cue(text, start), "m" + text[start:end].lower())
                found.append(token)
    return sorted((x for x in found if x is not None), key=lambda x: (x.start, x.end, x.base))


def ties(row: list[Token]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain ties between neighbours and skip ties between tokens of one key, as pairs of places."""
    chain = [(i, i + 1) for i in range(len(row) - 1) if row[i].end <= row[i + 1].start <= row[i].end + GAP]
    groups: dict[str, list[int]] = {}
    for i, token in enumerate(row):
        groups.setdefault(token.key, []).append(i)
    skip = set()
    for group in groups.values():
        centre = next((i for i in group if row[i].base), group[0])
        skip.update((min(i, centre), max(i, centre)) for i in group if i != centre)
        skip.update(zip(group, group[1:]))
    return chain, sorted(skip)


def views(row: list[Token]) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """What the fit counts: shape, style, cue, labels of both neighbours and of a likeness (-1: there is none), label."""
    chain, _ = ties(row)
    before, after = {b: a for a, b in chain}, dict(chain)
    known: dict[str, list[int]] = {}
    size = Counter(x.key for x in row)
    for i, token in enumerate(row):
        if token.base:
            known.setdefault(token.key, []).append(i)
    for i, token in enumerate(row):
        like = [row[j].base for j in known.get(token.key, [])[:2] if j != i]
        # A candidate like a base span is neither an example for nor against; an address without one says nothing.
        if not token.base and like or token.base == EMAIL and not like:
            continue
        # Candidates that resemble each other only are examples of agreeing on no label.
        if not like and not token.base and size[token.key] > 1:
            like = [0]
        sides = [row[x[i]].base if i in x else -1 for x in (before, after)]
        yield token.shape, token.style, token.cue, *sides, like[0] if like else -1, token.base


@dataclass
class Field:
    """Weights: label by shape, by style, by cue; label by next label; agreement of alike tokens, one for all labels.

    A weight per label would let tokens that only resemble each other talk themselves into one.
    """

    shape: np.ndarray
    style: np.ndarray
    cue: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, row: list[Token]) -> np.ndarray:
        out = np.zeros((len(row), len(LABELS)))
        for i, x in enumerate(row):
            if x.base:
                out[i] = -np.inf
                out[i, x.base] = 0.0
            else:
                out[i] = self.shape[x.shape] + self.style[x.style] + self.cue[x.cue]
        return out


# What the fit assumes before it has seen anything, as rows of ``views``: any candidate alone is no data, and what is like a
# base span of a fitting kind is data, whatever stands beside it. Together they weigh PRIOR of all counts, so they matter alike at every size.
PRIOR = 0.05


def _prior() -> list[tuple[int, ...]]:
    out = []
    for shape, name in enumerate(SHAPES):
        alike = {"quads": (IP,), "address": (EMAIL,), "name": (EMAIL,), "luhn": (CARD,), "long": (CARD,)}.get(name, (PHONE,))
        for style in range(len(STYLES)):
            for sides in ((-1, -1), (0, -1), (-1, 0), (0, 0)):
                out += [(shape, style, 0, *sides, -1, 0), (shape, style, 0, *sides, 0, 0)]
                out += [(shape, style, 0, *sides, k, k) for k in alike]
    return out


def fit(counts: dict[tuple[int, ...], int], steps: int = 600, penalty: float = 1e-5) -> Field:
    """Weights that make the labels likeliest given their surroundings."""
    prior = _prior()
    rows = np.array([*counts, *prior], np.int64)
    given = float(sum(counts.values()))
    share = PRIOR if given else 1.0
    weight = np.array([n * (1 - share) / given for n in counts.values()] + [share / len(prior)] * len(prior))
    shape, style, cue, left, right, like, label = rows.T
    n, m = len(rows), len(LABELS)
    sizes = [(len(SHAPES), m), (len(STYLES), m), (m, m), (m, m), (1,)]
    ends = np.cumsum([int(np.prod(s)) for s in sizes])
    theta = np.zeros(ends[-1])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    target = np.eye(m)[label]
    has_left, has_right, has_like = left >= 0, right >= 0, like >= 0
    for step in range(1, steps + 1):
        w = [x.reshape(s) for x, s in zip(np.split(theta, ends[:-1]), sizes)]
        score = w[0][shape] + w[1][style] + w[2][cue]
        score[has_left] += w[3][left[has_left]]
        score[has_right] += w[3].T[right[has_right]]
        score[np.flatnonzero(has_like), like[has_like]] += w[4]
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = weight[:, None] * (target - p)
        grads = [np.zeros(s) for s in sizes]
        for g, index in zip(grads, (shape, style, cue)):
            np.add.at(g, index, error)
        np.add.at(grads[3], left[has_left], error[has_left])
        np.add.at(grads[3].T, right[has_right], error[has_right])
        grads[4] += error[np.flatnonzero(has_like), like[has_like]].sum()
        gradient = np.concatenate([g.ravel() for g in grads]) - penalty * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Field(*[x.reshape(s) for x, s in zip(np.split(theta, ends[:-1]), sizes)])


def _normal(x: np.ndarray) -> np.ndarray:
    return x - np.logaddexp.reduce(x, axis=-1, keepdims=True)


def marginals(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Marginals by loopy sum-product; exact where ties form no loop.

    ``edges`` are pairs of tokens, ``potentials`` one matrix per edge (first token's label by the second's), all in logs.
    """
    if not len(edges):
        return np.exp(_normal(unary))
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    tables = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((len(source), unary.shape[1]))
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, target, messages)
        sent = _normal(np.logaddexp.reduce((belief[source] - messages[back])[:, :, None] + tables, axis=1))
        # Half of the old message keeps loops from swinging.
        change = np.abs(sent - messages).max()
        messages = 0.5 * messages + 0.5 * sent
        if change < 1e-9:
            break
    belief = unary.copy()
    np.add.at(belief, target, messages)
    return np.exp(_normal(belief))


def label(field: Field, docs: list[list[Token]]) -> list[list[tuple[int, int, int]]]:
    """Label, start and end of the candidates that become spans, per document; all documents' messages pass together."""
    agree = np.eye(len(LABELS)) * field.skip
    rows, edges, tables, first = [], [], [], 0
    for row in docs:
        rows.append(field.unary(row))
        chain, skip = ties(row)
        edges += [(a + first, b + first) for a, b in chain + skip]
        tables += [field.chain] * len(chain) + [agree] * len(skip)
        first += len(row)
    sure = marginals(np.concatenate(rows), np.array(edges, np.int64).reshape(-1, 2), np.array(tables).reshape(-1, len(LABELS), len(LABELS)))
    out, first = [], 0
    for row in docs:
        own = sure[first : first + len(row)]
        best = own[:, 1:].argmax(1) + 1
        out.append([(int(k), x.start, x.end) for x, k, p in zip(row, best, own) if not x.base and p[k] >= SURE])
        first += len(row)
    return out


def as_text(spans: list[tuple[int, int, int]]) -> str:
    """Spans as kind:start:end, by kind, then start."""
    return ",".join(f"{LABELS[k]}:{s}:{e}" for k, s, e in sorted(spans))


_TOKEN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("base", pa.int8()), ("shape", pa.int8()), ("style", pa.int8()), ("cue", pa.int8()), ("key", pa.string())])
_TOKENS = "array<struct<start:int,end:int,base:byte,shape:byte,style:byte,cue:byte,key:string>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH):
        base, rows = [], []
        for value in batch.column("text"):
            text = value.as_py()
            spans = base_spans(text)
            base.append(spans)
            rows.append([vars(x) for x in tokens(text, spans)])
        columns = [batch.column("doc_id"), *[pa.array([sum(x[0] == k for x in spans) for spans in base], pa.int64()) for k in range(1, 5)]]
        columns += [pa.array([as_text(x) for x in base], pa.string()), pa.array(rows, pa.list_(_TOKEN))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *[f"n_{k}" for k in KINDS], "base", "tokens"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans per kind, base (the spans as text) and tokens of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_scan, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + f", base string, tokens {_TOKENS}")


_VIEW = ("shape", "style", "cue", "left", "right", "like", "label")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for row in batch.column("tokens"):
            counts.update(views([Token(**x) for x in row.as_py()]))
        columns = list(zip(*counts)) or [()] * len(_VIEW)
        arrays = [pa.array(x, pa.int64()) for x in [*columns, list(counts.values())]]
        yield pa.RecordBatch.from_arrays(arrays, [*_VIEW, "n"])


def learn(scanned: DataFrame) -> Field:
    """The field fitted on the counts of all scanned rows."""
    found = scanned.filter(F.size("tokens") > 0).select("tokens")
    counted = found.mapInArrow(_count, ", ".join(f"{x} long" for x in (*_VIEW, "n")))
    rows = counted.groupBy(*_VIEW).agg(F.sum("n").alias("n")).orderBy(*_VIEW).collect()
    return fit({tuple(r[:-1]): r["n"] for r in rows})


def find(scanned: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts, base_sha256, spans (base and added, as text) and n_added of every scanned row."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column("base").to_pylist()
            some, spans = [], list(base)
            for at, row in enumerate(batch.column("tokens")):
                own = [Token(**x) for x in row.as_py()]
                # Without a candidate there is nothing to decide.
                if not all(x.base for x in own):
                    some.append((at, own))
            added = [0] * batch.num_rows
            # All documents of a batch pass their messages together, in portions of bounded size.
            portion: list[tuple[int, list[Token]]] = []
            size = 0
            for k, (at, row) in enumerate(some):
                portion.append((at, row))
                size += len(row)
                if size >= 1 << 15 or k == len(some) - 1:
                    for (place, own), more in zip(portion, label(field, [x for _, x in portion])):
                        added[place] = len(more)
                        spans[place] = as_text([(x.base, x.start, x.end) for x in own if x.base] + more)
                    portion, size = [], 0
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in base]
            arrays = [batch.column(k) for k in range(5)] + [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = ["long"] * 5 + ["string", "string", "long"]
    return scanned.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, kinds)))


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    scanned = materialize(scan(docs), "tokens")
    return find(scanned, learn(scanned))


def redact(text: str, spans: str) -> str:
    """A text with its spans (as ``detect`` writes them) replaced by their kinds; overlapping ones by the kinds together."""
    found = sorted((int(s), int(e), kind) for kind, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at, k = [], 0, 0
    while k < len(found):
        start, end, kinds = found[k][0], found[k][1], {found[k][2]}
        while k + 1 < len(found) and found[k + 1][0] < end:
            k += 1
            end = max(end, found[k][1])
            kinds.add(found[k][2])
        out += [text[at:start], "<" + "/".join(sorted(kinds)) + ">"]
        at, k = end, k + 1
    return "".join(out) + text[at:]
