"""Personal data by fixed patterns and a conditional random field.

Patterns find plain e-mail addresses, IP addresses, card and phone numbers.
A linear-chain conditional random field over word-shape features adds spans
the patterns miss (a number without its country code, groups set apart by
dots); a span it finds must still pass the checks of its kind (check digit,
parts of an address).  It is trained on a small labelled table
and decoded by Viterbi in numpy batches.

Neither needs most of a text.  Every pattern match, and every label but
"outside", lies in a *run*: neighbouring chunks of non-space with nothing but
spaces between them, each with a digit, ``@`` or ``+``, or made of ``().-``
alone.  A chunk outside any run has the one label "outside", so the chain falls
apart there and decoding the runs one by one is exact for the whole text.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.arrays import Words, batch_words, slices

KINDS = ("email", "ip", "card", "phone")

# The patterns of plain matches.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

LABELS = ("O", *[f"{p}-{kind}" for kind in KINDS for p in "BI"])
#: Rows of the built-in labelled table, and training of the field.
EXAMPLES = 500
ROUNDS = 80
RATE = 0.3
PENALTY = 2e-4
#: Bytes of text decoded at a time; counting characters takes some 30 times as many.
PIECE = 1 << 19

Span = tuple[str, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _holds(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(part.lstrip("0")) < 4 and int(part) <= 255 for part in text.split("."))
    digits = re.sub("[^0-9]", "", text)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, by start, then kind."""
    found = [
        (kind, match.start(), match.end())
        for kind, pattern in PATTERNS.items()
        for match in re.finditer(pattern, text)
        if _holds(kind, match.group())
    ]
    return _ordered(found)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# --- features --------------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\x20\t-\r]")


def tokens(run: str) -> list[tuple[int, int]]:
    return [match.span() for match in _TOKEN.finditer(run)]


def _shape(token: str) -> str:
    if token[0] in "0123456789":
        return f"d{min(len(token), 17)}"
    if token.isalpha():
        return ("X" if token[0].isupper() else "x") + str(min(len(token), 4))
    return token


def features(run: str, places: list[tuple[int, int]], before: str) -> list[list[str]]:
    """Names of the features of every token; ``before`` is the word in front
    of the run."""
    shapes = [_shape(run[a:b]) for a, b in places]
    gaps = ["^"] + [" " if a > b else "" for (_, b), (a, _) in zip(places, places[1:], strict=False)] + ["$"]
    lead = re.sub("[^a-z]", "", before.lower())[:8]
    digits = len(re.findall("[0-9]", run))
    dots, at = run.count("."), "@" in run
    out = []
    for i, shape in enumerate(shapes):
        near = [shapes[j] if 0 <= j < len(shapes) else "_" for j in range(i - 3, i + 4)]
        out.append(
            [
                "bias",
                f"s{shape}",
                f"l{near[2]}{gaps[i]}{shape}",
                f"r{shape}{gaps[i + 1]}{near[4]}",
                f"ll{near[1]}|{near[2]}|{shape}",
                f"rr{shape}|{near[4]}|{near[5]}",
                f"m{near[2]}|{shape}|{near[4]}",
                f"3{near[0]}|{near[2]}|{shape}",
                f"4{shape}|{near[4]}|{near[6]}",
                f"w{lead}|{shape[0]}",
                f"n{min(digits, 20)}|{shape[0]}",
                f"d{min(dots, 5)}|{at}|{shape[0]}",
                f"g{gaps[i]}{gaps[i + 1]}|{shape[0]}",
            ]
        )
    return out


# --- the labelled table ----------------------------------------------------


def _number(r: random.Random, count: int) -> str:
    return str(r.randrange(1, 10)) + "".join(str(r.randrange(10)) for _ in range(count - 1))


def _example(r: random.Random) -> tuple[str, list[Span]]:
    word = lambda: "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(2, 9)))
    n = lambda k: _number(r, k)
    host = f"{word()}{r.choice(['', str(r.randrange(10))])}.{r.choice(['example.com', 'example.org', word() + '.net'])}"
    user = r.choice([word(), f"{word()}.{n(2)}", f"{word()}_{word()}", f"{word()}{n(2)}"])
    octets = ".".join(str(r.randrange(1, 256)) for _ in range(4))
    four = [n(4) for _ in range(4)]
    entity = {
        "email": [f"{user}@{host}", f"{user}@{host}"],
        "ip": [octets, octets],
        "card": [n(16), n(15), "-".join(four), " ".join(four), ".".join(four), f"{n(4)} {n(6)} {n(5)}"],
        "phone": [
            f"+1 ({n(3)}) {n(3)}-{n(4)}",
            f"({n(3)}) {n(3)}-{n(4)}",
            f"{n(3)}-{n(3)}-{n(4)}",
            f"{n(3)}.{n(3)}.{n(4)}",
            f"+{n(2)} {n(2)} {n(4)} {n(4)}",
            f"+{n(2)} {n(3)} {n(7)}",
            f"1-{n(3)}-{n(3)}-{n(4)}",
        ],
    }
    other = [
        f"{n(4)}-{r.randrange(10, 13)}-{r.randrange(10, 29)}",
        f"{r.randrange(10, 29)}.{r.randrange(10, 13)}.{n(4)}",
        f"{r.randrange(1, 12)}/{r.randrange(1, 29)}/{n(4)}",
        f"{r.randrange(10, 24)}:{n(2)}",
        f"{r.randrange(10)}.{r.randrange(10)}",
        f"v{r.randrange(10)}.{r.randrange(20)}.{r.randrange(10)}",
        f"{r.randrange(10)}.{r.randrange(20)}.{r.randrange(10)}",
        f"${n(2)}.{n(2)}",
        f"{n(r.randrange(1, 8))}",
        f"{n(1)},{n(3)},{n(3)}",
        f"{n(2)}%",
        f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}",
        f"#{n(5)}",
        f"{word()}{n(3)}",
        f"password={word()}{n(4)}{word()}{n(5)}",
        "AKIA" + "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(16)),
        "".join(r.choice("0123456789abcdef") for _ in range(r.choice([16, 20, 32, 40]))),
        f"{n(1)} + {n(1)}",
        f"{n(r.randrange(2, 4))} {n(r.randrange(2, 4))}",
        f"@{word()}",
        f"{word()}-{n(2)}",
        f"{n(r.randrange(20, 30))}",
        f"{n(2)}-{n(2)}",
        f"({n(4)})",
        f"[{n(2)}]",
        f"4.0. {word()} 2.0.",
    ]
    kind = r.choice([*KINDS, None, None])
    middle = r.choice(entity[kind]) if kind else r.choice(other)
    lead = {"phone": ["call", "tel", "phone:"], "card": ["card", "visa"], "email": ["mail", "write"], "ip": ["host"]}
    front = r.choice([word(), word() + ".", word() + ",", *(lead[kind] if kind and r.random() < 0.3 else [])])
    behind = r.choice([" " + word(), "." + " " + word(), ",", ".", ""])
    text = f"{front} {middle}{behind}"
    begin = len(front) + 1
    return text, [(kind, begin, begin + len(middle))] if kind else []


def labelled_examples(spark: SparkSession, count: int = EXAMPLES) -> DataFrame:
    """The built-in labelled table ``text, spans(kind, start, end)``: short
    texts with and without personal data, the same each time."""
    r = random.Random(7)
    return spark.createDataFrame(
        [_example(r) for _ in range(count)], "text string, spans array<struct<kind:string,start:int,end:int>>"
    )


# --- the field -------------------------------------------------------------


def _transitions() -> np.ndarray:
    """0 where a label may follow another, else a number that rules it out."""
    allowed = np.full((len(LABELS), len(LABELS)), -1e9)
    for i, a in enumerate(LABELS):
        for j, b in enumerate(LABELS):
            if not b.startswith("I-") or a[2:] == b[2:]:
                allowed[i, j] = 0
    return allowed


_MAY_START = np.array([0.0 if not label.startswith("I-") else -1e9 for label in LABELS])


@dataclass(frozen=True)
class Field:
    """Weights of the features (row 0: unknown ones) and of label pairs."""

    index: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray

    def scores(self, names: list[list[str]]) -> np.ndarray:
        rows = [[self.index.get(name, 0) for name in token] for token in names]
        return self.emission[np.array(rows)].sum(axis=1)

    def viterbi(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of every run, all runs of a batch at once."""
        longest = max(map(len, runs))
        scores = np.zeros((len(runs), longest, len(LABELS)))
        lengths = np.array([len(run) for run in runs])
        for i, run in enumerate(runs):
            scores[i, : len(run)] = run
        best = scores[:, 0] + _MAY_START
        back = np.zeros((longest, len(runs), len(LABELS)), np.int8)
        for t in range(1, longest):
            paths = best[:, :, None] + self.transition[None]
            back[t] = paths.argmax(axis=1)
            step = paths.max(axis=1) + scores[:, t]
            best = np.where((t < lengths)[:, None], step, best)
        label = best.argmax(axis=1)
        labels = np.zeros((len(runs), longest), np.int8)
        for t in range(longest - 1, -1, -1):
            labels[:, t] = label
            if t:
                label = np.where(t < lengths, back[t, np.arange(len(runs)), label], label)
        return [labels[i, :n] for i, n in enumerate(lengths.tolist())]


def fit_field(examples: list[tuple[str, list[Span]]]) -> Field:
    """Trains on whole texts, each one run, by gradient steps on the
    penalised conditional likelihood."""
    index: dict[str, int] = {}
    sequences = []
    for text, spans in examples:
        front, _, run = text.partition(" ")
        shift = len(front) + 1
        places = tokens(run)
        labels = np.zeros(len(places), np.int64)
        for kind, start, end in spans:
            inside = [i for i, (a, b) in enumerate(places) if a + shift >= start and b + shift <= end]
            for i in inside:
                labels[i] = LABELS.index(f"{'B' if i == inside[0] else 'I'}-{kind}")
        names = features(run, places, front)
        rows = [[index.setdefault(name, len(index) + 1) for name in token] for token in names]
        sequences.append((np.array(rows), labels))
    n, width, longest = len(LABELS), 13, max(len(rows) for rows, _ in sequences)
    at = np.zeros((len(sequences), longest, width), np.int64)
    gold = np.zeros((len(sequences), longest), np.int64)
    mask = np.zeros((len(sequences), longest), bool)
    for i, (rows, labels) in enumerate(sequences):
        at[i, : len(rows)], gold[i, : len(rows)], mask[i, : len(rows)] = rows, labels, True
    allowed = _transitions()
    emission, pairs = np.zeros((len(index) + 1, n)), np.zeros((n, n))
    seen = [np.zeros_like(emission), np.zeros_like(pairs)]
    inside = at[mask]
    flat = inside.reshape(-1)
    gold_rows = np.eye(n)[gold]

    def total(values, axis):
        top = values.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))

    for _ in range(ROUNDS):
        scores = np.zeros((*mask.shape, n))
        scores[mask] = emission[inside].sum(axis=1)
        move = pairs + allowed
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0] + _MAY_START
        for t in range(1, longest):
            step = total(forward[:, t - 1, :, None] + move[None], 1) + scores[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        norm = total(forward[:, -1], 1)
        pair_gradient = np.zeros_like(pairs)
        for t in range(longest - 2, -1, -1):
            ahead = scores[:, t + 1] + backward[:, t + 1]
            step = total(move[None] + ahead[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
            joint = forward[:, t, :, None] + move[None] + ahead[:, None, :] - norm[:, None, None]
            joint = np.exp(np.minimum(joint, 0)) * mask[:, t + 1, None, None]
            pair_gradient -= joint.sum(axis=0)
            np.add.at(pair_gradient, (gold[:, t][mask[:, t + 1]], gold[:, t + 1][mask[:, t + 1]]), 1)
        marginal = np.exp(np.minimum(forward + backward - norm[:, None, None], 0))
        error = (gold_rows - marginal)[mask]
        gradient = np.zeros_like(emission)
        for label in range(n):
            gradient[:, label] = np.bincount(flat, np.repeat(error[:, label], width), minlength=len(gradient))
        for weights, slope, squares in zip((emission, pairs), (gradient, pair_gradient), seen, strict=True):
            slope = slope / len(sequences) - PENALTY * weights
            squares += slope**2
            weights += RATE * slope / np.sqrt(squares + 1e-10)
    emission[0] = 0
    return Field(index, emission, pairs + allowed)


def fit_table(labelled: DataFrame) -> Field:
    """Trains on a labelled table; it is small and read whole."""
    rows = labelled.where("text IS NOT NULL").collect()
    return fit_field([(row["text"], [tuple(span) for span in row["spans"] or ()]) for row in rows])


def _plausible(kind: str, text: str) -> bool:
    digits = len(re.sub("[^0-9]", "", text))
    if kind == "email":
        return "@" in text.strip("@ ") and "." in text
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and _holds("ip", ".".join(parts))
    if kind == "card":
        return 14 <= digits <= 19 and luhn(re.sub("[^0-9]", "", text))
    return 9 <= digits <= 15


def _decoded(run: str, places: list[tuple[int, int]], labels: np.ndarray) -> Iterator[Span]:
    i = 0
    while i < len(places):
        label = LABELS[labels[i]]
        if label == "O":
            i += 1
            continue
        kind, j = label[2:], i + 1
        while j < len(places) and LABELS[labels[j]] == f"I-{kind}":
            j += 1
        start, end = places[i][0], places[j - 1][1]
        if _plausible(kind, run[start:end]):
            yield kind, start, end
        i = j


# --- texts -----------------------------------------------------------------

_SIGNAL = np.zeros(256, bool)
_SIGNAL[[ord(c) for c in "0123456789@+"]] = True
_BRIDGE = np.zeros(256, bool)
_BRIDGE[[ord(c) for c in "().-"]] = True


def _runs(data: np.ndarray, found: Words) -> Iterator[tuple[int, int, int, str, str]]:
    """``text, first byte, last byte, run, word in front`` of every run."""
    if not len(found.hash):
        return

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total

    signal, bridge, blank = count(_SIGNAL[data]), count(_BRIDGE[data]), count(data == 32)
    has = signal[found.end] > signal[found.start]
    only = bridge[found.end] - bridge[found.start] == found.end - found.start
    part = has | only
    if not has.any():
        return
    joined = np.zeros(len(part), bool)
    joined[1:] = part[1:] & part[:-1]
    gap = found.start[1:] - found.end[:-1]
    joined[1:] &= blank[found.start[1:]] - blank[found.end[:-1]] == gap
    joined[found.offsets[:-1][found.offsets[:-1] < len(joined)]] = False
    heads = np.flatnonzero(part & ~joined)
    follows = np.append(joined[1:], False)
    tails = np.flatnonzero(part & ~follows)
    signals = np.concatenate([[0], np.cumsum(has)])
    for head, tail in zip(heads.tolist(), tails.tolist(), strict=True):
        if signals[tail + 1] == signals[head]:
            continue
        text = int(np.searchsorted(found.offsets, head, "right")) - 1
        begin, end = int(found.start[head]), int(found.end[tail])
        before = ""
        if head > found.offsets[text]:
            before = data[found.start[head - 1] : found.end[head - 1]][-32:].tobytes().decode(errors="ignore")
        yield text, begin, end, data[begin:end].tobytes().decode(), before


def find_spans(batch: pa.RecordBatch, field: Field, text: str = "text") -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of every text of a batch, in code points."""
    out: list[tuple[list[Span], list[Span]]] = [([], []) for _ in range(len(batch))]
    for first, _, data, found in batch_words(batch, text, PIECE):
        runs = list(_runs(data, found))
        places = [tokens(run) for *_, run, _ in runs]
        labels: list = [None] * len(runs)
        order = sorted(range(len(runs)), key=lambda i: len(places[i]))
        while order:
            group, size = [order[0]], len(places[order[0]])
            while len(group) < len(order) and len(places[order[len(group)]]) * (len(group) + 1) <= 20_000:
                group.append(order[len(group)])
            order = order[len(group) :]
            group = [i for i in group if places[i]]
            if group:
                scores = [field.scores(features(runs[i][3], places[i], runs[i][4])) for i in group]
                for i, found_labels in zip(group, field.viterbi(scores), strict=True):
                    labels[i] = found_labels
        behind: dict[int, tuple[int, int]] = {}  # text -> byte, code points in front of it
        for (row, begin, _, run, _), where, got in zip(runs, places, labels, strict=True):
            byte, points = behind.get(row, (int(found.bounds[row]), 0))
            points += int(((data[byte:begin] & 0xC0) != 0x80).sum())
            behind[row] = (begin, points)
            base = base_spans(run)
            more = [
                span
                for span in (_decoded(run, where, got) if got is not None else ())
                if not any(span[1] < end and start < span[2] for _, start, end in base)
            ]
            moved = lambda spans: [(k, a + points, b + points) for k, a, b in spans]  # noqa: B023, E731
            out[first + row][0].extend(moved(base))
            out[first + row][1].extend(moved(_ordered(base + more)))
    return [(_ordered(base), _ordered(every)) for base, every in out]


def _told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _reported(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*shared.value)
        for batch in batches:
            found = find_spans(batch, field)
            counts = [[sum(span[0] == kind for span in base) for base, _ in found] for kind in KINDS]
            digests = [hashlib.sha256(_told(base).encode()).hexdigest() for base, _ in found]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(digests, pa.string()),
                    pa.array([_told(every) for _, every in found], pa.string()),
                ],
                names=["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"],
            )

    return run


def personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    The numbers and the digest are of the patterns' spans, ``spans`` has those
    and the field's, as ``kind:start:end`` in code points.  A null text is
    empty.  Every row is returned, also repeated ones and those without an
    id; other columns are ignored.  ``labelled`` replaces the built-in table.
    """
    spark = docs.sparkSession
    field = fit_table(labelled if labelled is not None else labelled_examples(spark))
    shared = spark.sparkContext.broadcast((field.index, field.emission, field.transition))
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _reported(shared), f"doc_id long, {counts}, base_sha256 string, spans string"
    )


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with the spans replaced by their kinds; overlapping spans
    become one, named by the first."""
    parts, behind = [], 0
    for kind, start, end in spans:
        if start >= behind:
            parts += [text[behind:start], f"[{kind.upper()}]"]
        behind = max(behind, end)
    return "".join([*parts, text[behind:]])


def _pieces(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Rows of a batch by ``PIECE`` bytes of text: a batch may hold all rows of
    a task, and its new texts would stand beside it a second and third time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    offsets = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64))
    for first, last in slices(offsets, PIECE):
        yield batch.slice(first, last - first)


def _replaced(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for piece in _pieces(batch):
                every = [spans for _, spans in find_spans(piece, field)]
                old = piece.column(at)
                new = [
                    masked(text.as_py(), spans) if spans else text.as_py()
                    for text, spans in zip(old, every, strict=True)
                ]
                columns = list(piece.columns)
                columns[at] = pa.array(new, old.type)
                yield pa.record_batch(columns, names=piece.schema.names)
            pa.default_memory_pool().release_unused()

    return run


def mask_personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by ``[KIND]``; other
    columns and rows stay as they are."""
    spark = docs.sparkSession
    field = fit_table(labelled if labelled is not None else labelled_examples(spark))
    shared = spark.sparkContext.broadcast((field.index, field.emission, field.transition))
    return docs.mapInArrow(_replaced(shared), docs.schema)
