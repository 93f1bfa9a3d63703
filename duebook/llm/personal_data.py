"""Personal data in texts: exact rules, and a character tagger that adds what the rules miss.

The rules give base spans of four kinds. A bidirectional LSTM with CRF transitions is trained in numpy
on windows whose spans the rules have labelled (a bounded sample of them, ``Detector.sample``), with
altered copies: other separators, missing plus signs, two items next to each other. It then reads every
place of every text where an item can be: windows of ``width`` characters, each overlapping the next
by half, that hold a digit or an ``@`` (each kind needs one of them). Each window is decoded; spans cut
by a window's edge are left to its neighbour, and the rest are reconciled over the whole text: the
surest first, none overlapping another or a base span. A span also has to be valid for its kind.

Edge cases. NULL is an empty text: no spans, the digest of the empty string. Texts of any length are
read whole. Equal rows give equal results. Without any base span in the corpus there is nothing to learn
from and no span is added. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm import crf_tagger
from duebook.llm.common import packed
from duebook.session import bound_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits that a match could have begun before, so looking only
# at the beginnings of runs finds the same and stays linear on long runs.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid(kind: str, text: str) -> bool:
    """Whether a piece of text can be of the kind, apart from how it is written."""
    digits = _digits(text)
    if kind == "email":
        name, at, host = text.partition("@")
        return bool(at and name.strip() and "." in host.strip())
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the exact rules, by kind and start."""
    found: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        local = text[done:at]
        begin = done + len(local.rstrip(LOCAL))
        host = DOMAIN.match(text, at + 1) if begin < at else None
        if host:
            found.append(("email", begin, host.end()))
            done = host.end()
        else:
            # characters of the local part never hold an @: nothing before it can begin a match
            done = at + 1
        at = text.find("@", done)
    if DIGIT.search(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
            found += [
                (kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m.group())
            ]
    return found


def doubtful_spans(text: str) -> list[tuple[int, int]]:
    """Matches that begin like an international number and are dropped for their length.

    Often a number runs into the one behind it: what they hold is not known, so no example is made of them.
    Digits alone that fail the card's checksum are mostly something else, and stay examples of that.
    """
    dropped = (m for m in PHONE.finditer(text) if not valid("phone", m.group()))
    return [(m.start(), m.end()) for m in dropped]


@dataclass(frozen=True)
class Detector:
    """``sample`` windows are learnt from, the same share of it for each kind and for windows without items;
    they are read ``epochs`` times, but for ``least_steps`` steps where a table has few of them. ``sure`` is
    the least probability of each character."""

    width: int = 96
    sample: int = 1600
    hidden: int = 16
    epochs: int = 12
    least_steps: int = 400
    batch: int = 64
    sure: float = 0.6
    seed: int = 11


def window_starts(text: str, width: int) -> list[int]:
    """Starts of the windows, half a width apart, that hold a digit or an ``@``."""
    half = width // 2
    cells = sorted({m.start() // half for m in HINT.finditer(text)})
    return sorted({half * c for cell in cells for c in (cell - 1, cell) if c >= 0})


def training_windows(docs: DataFrame, model: Detector) -> DataFrame:
    """Windows with their base spans, and windows with digits but without spans: the sample.

    Windows that hold a doubtful span teach nothing and are left out. Each kind has its share of different
    windows, and which ones depends only on a hash of their text. At most a share of each kind leaves a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, order, kinds = [], [], [], []
            for text in dict.fromkeys(batch["text"].to_pylist()):
                if not text or not HINT.search(text):
                    continue
                base = base_spans(text)
                doubtful = doubtful_spans(text)
                # two windows of a text at most: it has one voice, not as many as its items
                picks = [s for s in base[:: max(1, len(base) // 2)]][:2]
                if not picks:
                    picks = [("", m.start(), m.end()) for m in HINT.finditer(text)][:1]
                for kind, begin, end in picks:
                    a = max(0, (begin + end - model.width) // 2)
                    b = a + model.width
                    part = text[a:b]
                    inside = [f"{k}:{s - a}:{e - a}" for k, s, e in base if a <= s and e <= b]
                    cut = any(s < a < e or s < b < e for _, s, e in base)
                    unknown = any(s < b and a < e for s, e in doubtful)
                    if part and not cut and not unknown:
                        texts.append(part)
                        spans.append(",".join(inside))
                        order.append(hashlib.md5(part.encode()).hexdigest())
                        kinds.append(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string()) for x in (texts, spans, order, kinds)],
                names=["part", "spans", "place", "kind"],
            )

    windows = docs.select("text").mapInArrow(run, "part string, spans string, place string, kind string")
    first = Window.partitionBy("kind").orderBy("place", "part", "spans")
    share = model.sample // (len(KINDS) + 1)
    return windows.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= share)


def _parsed(spans: str) -> list[Span]:
    items = (s.split(":") for s in spans.split(",") if s)
    return [(k, int(a), int(b)) for k, a, b in items]


def _altered(kind: str, text: str, random: np.random.Generator) -> str:
    """The same item written in a way that the rules need not know."""
    digits = _digits(text)
    if kind == "phone" and len(digits) >= 10:
        a, b, c, d = digits[:-10] or "1", digits[-10:-7], digits[-7:-4], digits[-4:]
        forms = (f"({b}) {c}-{d}", f"{b}-{c}-{d}", f"{b}.{c}.{d}", f"{a}-{b}-{c}-{d}", f"00{a} {b} {c} {d}")
        return str(random.choice(forms))
    if kind == "email":
        name, _, host = text.partition("@")
        return str(random.choice((f"{name} @ {host}", f"{name}@ {host}", f"{name} @{host}")))
    if kind == "ip":
        return text.replace(".", str(random.choice((" . ", ". ", " ."))))
    if kind == "card":
        mark = str(random.choice((" ", "-", ".", "/")))
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return text


def _plain(random: np.random.Generator) -> str:
    """Numbers that are nobody's: dates, times, versions, amounts, long serial numbers."""
    n = [int(x) for x in random.integers(0, 10000, 6)]
    forms = (
        f"{1900 + n[0] % 130}-{1 + n[1] % 12:02}-{1 + n[2] % 28:02}", f"{n[0] % 24}:{n[1] % 60:02}",
        f"{n[0] % 20}.{n[1] % 30}.{n[2] % 40}", f"{n[0] % 1000},{n[1] % 1000:03}.{n[2] % 100:02}",
        f"{n[0]:04}{n[1]:04}", f"{n[0]}", f"{300 + n[0] % 600}.{n[1]}.{n[2]}.{n[3]}",
        f"{n[0]:04}{n[1]:04}{n[2]:04}{n[3]:04}{n[4]:04}{n[5]:04}", f"{n[0] % 100} - {n[1] % 100}",
    )
    return str(random.choice(forms))


def examples(rows: list[tuple[str, str]], model: Detector) -> tuple[np.ndarray, np.ndarray]:
    """Classes and gold tags of the sampled windows and of an altered copy of each."""
    random = np.random.default_rng(model.seed)
    made: list[tuple[str, list[Span]]] = []
    items = [(k, part[a:b]) for part, spans in rows for k, a, b in _parsed(spans)]
    for part, spans in rows:
        own = _parsed(spans)
        made.append((part, own))
        # the copy: items altered in place, sometimes another item or a plain number behind them
        text, new, at = "", [], 0
        for kind, a, b in sorted(own, key=lambda s: s[1]):
            if a < at:
                continue
            text += part[at:a]
            item = _altered(kind, part[a:b], random) if random.random() < 0.6 else part[a:b]
            new.append((kind, len(text), len(text) + len(item)))
            text += item
            if random.random() < 0.4 and items:
                kind, item = items[int(random.integers(len(items)))]
                text += " "
                new.append((kind, len(text), len(text) + len(item)))
                text += item
            at = b
        text += part[at:]
        if random.random() < 0.5:
            cut = text.rfind(" ", 0, new[0][1] if new else len(text) // 2)
            if cut > 0:
                number = " " + _plain(random)
                text = text[:cut] + number + text[cut:]
                new = [(k, a + len(number), b + len(number)) for k, a, b in new]
        made.append((text[: model.width], [s for s in new if s[2] <= model.width]))
    x = np.full((len(made), model.width), crf_tagger.PAD, np.int64)
    gold = np.zeros_like(x)
    for i, (text, spans_of) in enumerate(made):
        x[i, : len(text)] = crf_tagger.classes_of(text)
        for kind, a, b in spans_of:
            k = KINDS.index(kind)
            gold[i, a], gold[i, a + 1 : b] = 2 * k + 1, 2 * k + 2
    return x, gold


def trained(docs: DataFrame, model: Detector = Detector()) -> crf_tagger.Tagger | None:
    """The tagger for this corpus, learnt on the driver from the bounded sample."""
    found = training_windows(docs, model).collect()
    rows = [(r["part"], r["spans"]) for r in sorted(found, key=lambda r: (r["place"], r["part"]))]
    if not any(spans for _, spans in rows):
        return None
    x, gold = examples(rows, model)
    steps = max(model.least_steps, model.epochs * -(-len(x) // model.batch))
    return crf_tagger.train(x, gold, len(KINDS), model.hidden, steps, model.batch, model.seed)


def tagged_spans(texts: list[str], tagger: crf_tagger.Tagger, model: Detector) -> list[list[tuple[float, str, int, int]]]:
    """What the windows of each text propose: (probability, kind, start, end)."""
    proposals: list[list] = [[] for _ in texts]
    places = [(i, at) for i, text in enumerate(texts) for at in window_starts(text, model.width)]
    for first in range(0, len(places), 512):
        block = places[first : first + 512]
        x = np.full((len(block), model.width), crf_tagger.PAD, np.int64)
        for row, (i, at) in enumerate(block):
            part = texts[i][at : at + model.width]
            x[row, : len(part)] = crf_tagger.classes_of(part)
        tags, sure = tagger.decode(x)
        for row, start in zip(*np.nonzero(tags % 2 == 1)):
            i, at = block[row]
            inside = tags[row, start] + 1
            end = start + 1
            while end < model.width and tags[row, end] == inside:
                end += 1
            text = texts[i]
            if (start == 0 and at > 0) or (end == model.width and at + end < len(text)):
                continue  # cut by the edge: whole in the window that overlaps
            a, b = at + int(start), at + int(end)
            while b > a and text[b - 1] in " .-(":
                b -= 1
            alone = not (a and text[a - 1].isalnum()) and not text[b : b + 1].isalnum()
            kind = KINDS[(inside - 1) // 2]
            p = float(sure[row, start:end].min())
            if p >= model.sure and alone and valid(kind, text[a:b]):
                proposals[i].append((p, kind, a, b))
    return proposals


def reconciled(base: list[Span], proposals: list[tuple[float, str, int, int]]) -> list[Span]:
    """Base spans and, the surest first, proposals that touch nothing taken before."""
    taken = [(a, b) for _, a, b in base]
    added = []
    for _, kind, a, b in sorted(set(proposals), key=lambda s: (-s[0], s[2], s[3], s[1])):
        if all(b <= c or d <= a for c, d in taken):
            taken.append((a, b))
            added.append((kind, a, b))
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1]))


def detected(docs: DataFrame, model: Detector = Detector()) -> DataFrame:
    """``docs`` packed as ``row``, with counts of the base spans, their digest, and all spans."""
    bound_batches(docs.sparkSession)
    tagger = trained(docs, model)

    def joined(spans: list[Span]) -> str:
        return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                texts = [t or "" for t in batch["row"].field("text").to_pylist()]
                bases = [base_spans(t) if HINT.search(t) else [] for t in texts]
                more = tagged_spans(texts, tagger, model) if tagger else [[] for _ in texts]
                spans = [reconciled(b, m) for b, m in zip(bases, more)]
                counts = [[sum(s[0] == k for s in b) for b in bases] for k in KINDS]
                digest = [hashlib.sha256(joined(b).encode()).hexdigest() for b in bases]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"],
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(digest),
                        pa.array([joined(s) for s in spans], pa.string()),
                    ],
                    names=["row", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    rows = packed(docs)
    kind = rows.schema["row"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"row {kind}, {counts}, base_sha256 string, spans string")


def redacted(found: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; ``n_chars`` follows."""

    spans = F.array_sort(
        F.transform(
            F.filter(F.split("spans", ","), lambda s: s != ""),
            lambda s: F.struct(
                F.split(s, ":")[1].cast("int").alias("a"),
                F.split(s, ":")[2].cast("int").alias("b"),
                F.upper(F.split(s, ":")[0]).alias("kind"),
            ),
        )
    )
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(state, span):
        # a span that begins inside the one before only lengthens it
        new = F.concat(
            state["text"],
            F.substring(F.col("row.text"), state["at"] + 1, F.greatest(span["a"] - state["at"], F.lit(0))),
            F.when(span["a"] >= state["at"], F.concat(F.lit("<"), span["kind"], F.lit(">"))).otherwise(""),
        )
        return F.struct(new.alias("text"), F.greatest(state["at"], span["b"]).alias("at"))

    def end(state):
        return F.concat(state["text"], F.substring(F.col("row.text"), state["at"] + 1, F.length("row.text")))

    text = F.when(F.col("spans") == "", F.col("row.text")).otherwise(F.aggregate(spans, start, step, end))
    return (
        found.withColumn("row", F.col("row").withField("text", text))
        .withColumn("row", F.col("row").withField("n_chars", F.length("row.text").cast("long")))
        .select("row.*")
    )
