"""Personal data by weak supervision.

Patterns propose spans: the base spans of each kind, near misses of them, and written-out or loosely
separated forms. Four labelers vote on every span: the strict pattern with its checks, a gazetteer
of number ranges and domain ends, cue words around it, and the signs at its borders.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is,
its posteriors train a span classifier, and that decides on the spans beyond the base, which always
stay. Positions are code points, ends exclusive; null texts count as empty.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import small_batches, stored
from docloom.llm.words import mix, pieces

KINDS = ("email", "ip", "card", "phone")
# Bound of the sample that the span classifier is fitted on, and the least probability it takes.
SAMPLE = 20_000
TAKE = 0.9
BUCKETS = 64
WIDTH = len(KINDS) + 14 + BUCKETS
LABELERS = 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = (
    ("email", re.compile(
        r"(?<![\w.])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
        r"(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63})+(?!\w)")),
    ("ip", re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9./_])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9./_])")),
    ("phone", re.compile(r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")),
)
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_ENDINGS = frozenset("com org net edu gov info io de fr es uk eu us ch at it nl".split())
_CUES = {
    "email": frozenset("email mail e contact write correo courriel kontakt address reach".split()),
    "ip": frozenset("ip host server address login client node adresse".split()),
    "card": frozenset("card visa credit mastercard payment pay tarjeta carte karte amex".split()),
    "phone": frozenset("phone tel call telephone mobile cell fax telefon anruf llame appelez".split()),
}
_AGAINST = frozenset("version isbn order invoice token id sku build release serial price".split())


def luhn(digits: str) -> bool:
    """Whether the check digit holds."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            done = found.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


# A base match that holds, a form beyond the base, a base match that fails its check.
BASE, LOOSE, FAILED = 1, 0, -1


def proposals(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, form) of every proposed span."""
    out = [("email", b, e, BASE) for b, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out + _loose(text, _LOOSE[:1]) if "dot" in text else out

    def add(kind: str, match: re.Match, good: bool) -> None:
        out.append((kind, *match.span(), BASE if good else FAILED))

    for m in _IP.finditer(text):
        add("ip", m, all(map(_small, m.group().split("."))))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start():
            digits = _digits(m.group())
            if 13 <= len(digits):
                add("card", m, len(digits) <= 19 and luhn(digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            add("phone", m, 9 <= len(_digits(m.group())) <= 15)
    return out + _loose(text, _LOOSE)


def _loose(text: str, patterns) -> list[tuple[str, int, int, int]]:
    found = []
    for kind, pattern in patterns:
        if kind == "email" and "dot" not in text:
            continue
        if kind == "ip" and ".]" not in text and ".)" not in text:
            continue
        found += [(kind, *m.span(), LOOSE) for m in pattern.finditer(text)]
    return found


def _border(text: str, at: int) -> int:
    """0 outside or space, 1 a sign, 2 a letter or digit."""
    if at < 0 or at >= len(text) or text[at].isspace():
        return 0
    return 2 if text[at].isalnum() else 1


def _around(text: str, begin: int, end: int) -> list[str]:
    before = _WORD.findall(text[max(0, begin - 40) : begin].lower())[-4:]
    return before + _WORD.findall(text[end : end + 25].lower())[:2]


def _ranges(kind: str, body: str) -> int:
    """Vote of the gazetteer: domain ends, card issuers, private or reserved addresses, prefixes."""
    if kind == "email":
        return 1 if re.split(r"[.\s)\]]+", body.lower())[-1] in _ENDINGS else 0
    digits = _digits(body)
    if kind == "card":
        return 1 if digits[:1] in "3456" and len(digits) in (13, 14, 15, 16, 19) else -1
    if kind == "phone":
        return 1 if not body.startswith("+") and digits[:1] not in "01" else int(digits[:1] != "0")
    parts = [p for p in re.split(r"[^0-9]+", body) if p]
    return -1 if any(not _small(p) for p in parts) or parts[0].strip("0") == "" else 1


def votes(text: str, span: tuple[str, int, int, int]) -> tuple[int, ...]:
    """Votes of the labelers on a span: 1 for, -1 against, 0 none."""
    kind, begin, end, form = span
    around = _around(text, begin, end)
    cue = 1 if any(w in _CUES[kind] for w in around) else -1 if any(w in _AGAINST for w in around) else 0
    left, right = _border(text, begin - 1), _border(text, end)
    border = -1 if 2 in (left, right) else 1 if (left, right) == (0, 0) else 0
    return (form, _ranges(kind, text[begin:end]), cue, border)


def span_features(text: str, span: tuple[str, int, int, int]) -> np.ndarray:
    """Features of a span that do not repeat the votes: its kind, form, borders and words around."""
    kind, begin, end, _ = span
    body = text[begin:end]
    row = np.zeros(WIDTH)
    row[KINDS.index(kind)] = 1
    at = len(KINDS)
    digits = _digits(body)
    row[at : at + 8] = (
        len(body) / 20, len(digits) / 16, len(digits) / len(body), body.count(" ") / 4,
        body.count(".") / 4, body.count("-") / 4, float(luhn(digits)) if digits else 0.0,
        len(set(body)) / len(body),
    )
    row[at + 8 + _border(text, begin - 1)] = 1
    row[at + 11 + _border(text, end)] = 1
    for word in _around(text, begin, end):
        code = np.array([int.from_bytes(hashlib.md5(word.encode()).digest()[:8], "little")], np.uint64)
        row[at + 14 + int(mix(code)[0] % np.uint64(BUCKETS))] = 1
    return row


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 60):
    """Posterior that a span is real for each vote pattern, by expectation-maximisation.

    Every labeler has one distribution of votes for real spans and one for others. Votes start as
    their majority; smoothing keeps rare votes possible.
    """
    patterns = sorted(counts)
    table = np.array(patterns) + 1
    weight = np.array([counts[p] for p in patterns], np.float64)
    real = 1 / (1 + np.exp(-1.5 * (table - 1).sum(axis=1)))
    for _ in range(rounds):
        prior = (weight @ real + 1) / (weight.sum() + 2)
        score = np.full(len(patterns), np.log(prior / (1 - prior)))
        for labeler in range(LABELERS):
            for_real = np.bincount(table[:, labeler], weight * real, 3) + 0.5
            others = np.bincount(table[:, labeler], weight * (1 - real), 3) + 0.5
            ratio = np.log(for_real / for_real.sum()) - np.log(others / others.sum())
            score += ratio[table[:, labeler]]
        real = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return dict(zip(patterns, real))


def fit(rows: np.ndarray, target: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of a logistic model on soft labels, the last one a constant."""
    table = np.hstack([rows, np.ones((len(rows), 1))])
    weights = np.zeros(table.shape[1])
    for _ in range(steps):
        miss = 1 / (1 + np.exp(-np.clip(table @ weights, -30, 30))) - target
        weights -= 0.8 * (table.T @ miss / len(table) + 1e-4 * weights)
    return weights


def _scan(rows: DataFrame, make, schema: str) -> DataFrame:
    columns = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for batch in batches:
            found = [row for text in batch.column("_text").to_pylist() if text for row in make(text)]
            arrays = [pa.array([row[i] for row in found]) for i in range(len(columns))]
            if found:
                yield pa.RecordBatch.from_arrays(arrays, columns)

    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Classifier weights from all proposed spans of ``docs``.

    The vote patterns of all spans are counted; at most 81 per kind reach the driver. The fit reads
    at most ``sample`` spans, those of lowest hash. Without spans nothing is ever added.
    """
    def spans(text):
        for span in proposals(text):
            yield (
                span[0], ",".join(map(str, votes(text, span))),
                span_features(text, span).astype("<f4").tobytes(),
            )

    found = stored(
        _scan(docs.select(F.col("text").alias("_text")), spans,
              "kind string, votes string, features binary"), "pii-spans",
    )
    counted: dict[str, dict[tuple[int, ...], int]] = {}
    for row in found.groupBy("kind", "votes").count().collect():
        counted.setdefault(row["kind"], {})[tuple(map(int, row["votes"].split(",")))] = row["count"]
    if not counted:
        return np.append(np.zeros(WIDTH), -30.0)
    real = {kind: reliabilities(counts) for kind, counts in counted.items()}
    some = (
        found.groupBy("kind", "votes", "features").count()
        .orderBy(F.xxhash64("features"), "kind", "votes").limit(sample).toPandas()
    )
    rows = np.stack([np.frombuffer(f, "<f4") for f in some["features"]]).astype(np.float64)
    target = np.array([
        real[k][tuple(map(int, v.split(",")))] for k, v in zip(some["kind"], some["votes"])
    ])
    return fit(rows, target)


def decide(text: str | None, weights: np.ndarray) -> tuple[list, list]:
    """Base spans and all spans (kind, start, end) of a text, by kind, then start.

    A loose form is added if the classifier takes it, no labeler of its ranges or borders is
    against it, and it overlaps no span taken before.
    """
    base, added = [], []
    for span in proposals(text) if text else ():
        kind, begin, end, form = span
        if form == BASE:
            base.append((kind, begin, end))
        elif form == LOOSE:
            row = span_features(text, span)
            if row @ weights[:-1] + weights[-1] >= np.log(TAKE / (1 - TAKE)):
                strict = votes(text, span)
                if strict[1] >= 0 and strict[3] >= 0:
                    added.append((kind, begin, end))
    taken = list(base)
    for kind, begin, end in added:
        if all(end <= b or begin >= e for _, b, e in taken):
            taken.append((kind, begin, end))

    def order(span):
        return KINDS.index(span[0]), span[1], span[2]

    return sorted(base, key=order), sorted(taken, key=order)


def joined(spans) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in spans)


def annotate(docs: DataFrame, weights: np.ndarray, *keep: str) -> DataFrame:
    """``keep`` columns, ``base`` and ``spans`` (kind:start:end, comma-joined) of every text."""
    rows = docs.select(*keep, F.col("text").alias("_text"))
    small_batches(docs.sparkSession)
    schema = docs.select(*keep, F.lit("").alias("base"), F.lit("").alias("spans")).schema

    def run(batches):
        for batch in batches:
            found = [decide(t, weights) for t in batch.column("_text").to_pylist()]
            out = batch.drop_columns(["_text"])
            out = out.append_column("base", pa.array([joined(f[0]) for f in found], pa.string()))
            yield out.append_column("spans", pa.array([joined(f[1]) for f in found], pa.string()))

    return rows.mapInArrow(run, schema)


def masked(text: str | None, weights: np.ndarray) -> str | None:
    """``text`` with a tag in place of every span; overlapping spans become one, named by its first."""
    if not text:
        return text
    out, at = [], 0
    for kind, begin, end in sorted(decide(text, weights)[1], key=lambda s: (s[1], s[2])):
        if begin >= at:
            out += [text[at:begin], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with ``text`` masked, all other columns as they are."""

    small_batches(docs.sparkSession)
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in pieces(texts):
                part = batch.slice(begin, end - begin)
                clean = pa.array([masked(t, weights) for t in texts[begin:end]], pa.string())
                yield part.set_column(part.schema.get_field_index("text"), "text", clean)

    return docs.mapInArrow(run, docs.schema)


def pii_query(spark, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = annotate(docs, train(docs), "doc_id")

    def number(kind: str):
        return F.regexp_count(F.concat(F.lit(","), "base"), F.lit(f",{kind}:")).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans"
    )
