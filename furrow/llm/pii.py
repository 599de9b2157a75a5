"""Personal data by aggregated weak supervision.

Patterns find the base spans, which always count. Beside them, looser patterns propose
candidates, and labelers of three sorts vote on each: patterns (is the form strict?),
gazetteers (known domain endings, dialling forms, first names) and context (words in
front that announce such data, or other things). A labeler may abstain. Spark counts
how often each pattern of votes occurs over all texts; expectation-maximisation on
these counts estimates each labeler's reliability, and a logistic span classifier is
trained on the resulting posteriors. A candidate that the classifier accepts and that
overlaps no base span is added.

What reaches the driver is one row per kind and vote pattern: at most 3 to the power of
the number of labelers for each kind, whatever the input.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import narrow
from furrow.session import settle

#: The kinds in their order.
KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
# A match can only begin where a run of digits begins; saying so spares a long run of
# digits from being tried at each of its places.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    d = [int(x) for x in digits[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches of local@domain.domain: found from the @ outwards, so that a
    long run without one costs nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL_END.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base spans, in that order; code points."""
    found = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda x: (x[0], x[2]))


#: Looser forms that are no base span by themselves: an address spelt out, a dotted quad
#: with spaces, a long number that fails the checksum, a number without a plus.
LOOSE = (
    re.compile(r"(?<![\w.])[A-Za-z0-9._%+-]{1,64}\s?[\[(]at[\])]\s?[A-Za-z0-9-]{1,63}(?:\s?(?:[\[(]dot[\])]|\.)\s?[A-Za-z0-9-]{1,63}){1,4}"),
    re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s?[\[(]?\.[\])]?\s?[0-9]{1,3}){3}(?![\w.])"),
    re.compile(r"(?<![\w])[0-9]{4}(?:[\x20./-][0-9]{4}){2}[\x20./-][0-9]{3,7}(?!\w)"),
    re.compile(r"(?<![\w+])(?:00[0-9]{1,3}[\x20.-]?|)(?:\([0-9]{2,5}\)[\x20.-]?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?!\w)"),
)
_SPELT_AT, _DIGIT = ("[at]", "[at)", "(at]", "(at)"), re.compile("[0-9]")
#: Gazetteers and context words.
ENDINGS = frozenset("com org net edu gov info io de fr es it uk eu ch at example".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
ANNOUNCING = (
    frozenset("mail email e-mail contact write address courriel correo adresse kontakt".split()),
    frozenset("ip host server address addr client from adresse".split()),
    frozenset("card visa mastercard credit carte tarjeta karte kreditkarte payment".split()),
    frozenset("phone tel call fax mobile telephone telefon telefono cell".split()),
)
OTHER = frozenset("version isbn issn section page chapter figure table id order no invoice".split())
LABELERS = ("strict", "gazetteer", "announced", "other", "edges")
_BEFORE = re.compile(r"[\w-]+")


def votes(text: str, start: int, end: int, kind: int) -> tuple[int, ...]:
    """Each labeler's vote on a candidate: 1 for, -1 against, 0 for none."""
    span, digits = text[start:end], _NOT_DIGIT.sub("", text[start:end])
    before = {w.lower() for w in _BEFORE.findall(text[max(0, start - 40) : start])[-4:]}
    if kind == 0:
        strict = 1 if " " not in span else 0
        gazetteer = 1 if re.split(r"[^A-Za-z0-9]+", span)[-1].lower() in ENDINGS else -1
    elif kind == 1:
        quads = [int(x) for x in re.findall(r"[0-9]+", span)]
        strict = 1 if all(x <= 255 for x in quads) else -1
        gazetteer = 1 if quads[0] in (10, 127, 172, 192) else 0
    elif kind == 2:
        strict = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_STARTS) else -1
    else:
        strict = 1 if 9 <= len(digits) <= 15 else -1
        gazetteer = 1 if digits.startswith("00") or "555" in digits or "(" in span else 0
    announced = 1 if before & ANNOUNCING[kind] else 0
    other = -1 if before & OTHER else 0
    sides = text[max(0, start - 1) : start] + text[end : end + 1]
    edges = -1 if any(ch in "=/\\_#" for ch in sides) else 0
    return strict, gazetteer, announced, other, edges


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """Loose matches clear of all base spans, with their votes as text."""
    out = []
    for kind, pattern in enumerate(LOOSE):
        # What a form cannot do without, looked for first because it is cheap.
        if not (any(x in text for x in _SPELT_AT) if kind == 0 else _DIGIT.search(text)):
            continue
        for m in pattern.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b, _ in base):
                out.append((m.start(), m.end(), kind, ",".join(map(str, votes(text, m.start(), m.end(), kind)))))
    return out


class Classifier(NamedTuple):
    """Per kind the logistic weights of the votes, the constant last; no entry: reject."""

    weights: dict[int, list[float]]

    def probability(self, kind: int, vote: str) -> float:
        if kind not in self.weights:
            return 0.0
        w = self.weights[kind]
        z = sum(a * int(b) for a, b in zip(w, vote.split(","), strict=False)) + w[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def aggregate_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: the probability of each pattern to be
    personal data, and each labeler's chance of each vote given each class.

    It starts from the majority of votes; every chance has a weak prior that a labeler
    is right more often than wrong."""
    values = np.array([-1, 0, 1])
    posterior = 1 / (1 + np.exp(-patterns.sum(axis=1).astype(float)))
    chance = np.empty((patterns.shape[1], 2, 3))
    for _ in range(rounds):
        share = np.stack([(1 - posterior) * counts, posterior * counts])
        for j in range(patterns.shape[1]):
            for c in (0, 1):
                prior = np.array([2.0, 2.0, 1.0]) if c == 0 else np.array([1.0, 2.0, 2.0])
                n = np.array([share[c][patterns[:, j] == v].sum() for v in values]) + prior
                chance[j, c] = n / n.sum()
        rate = (share[1].sum() + 1) / (counts.sum() + 2)
        logs = [math.log(1 - rate) * np.ones(len(patterns)), math.log(rate) * np.ones(len(patterns))]
        for c in (0, 1):
            for j in range(patterns.shape[1]):
                logs[c] = logs[c] + np.log(chance[j, c][patterns[:, j] + 1])
        updated = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30)))
        if np.abs(updated - posterior).max() < 1e-9:
            posterior = updated
            break
        posterior = updated
    return posterior, chance


def train(patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray, rounds: int = 200) -> list[float]:
    """Logistic weights of the votes fitted to the posteriors, with a small penalty."""
    x = np.column_stack([patterns.astype(float), np.ones(len(patterns))])
    w = np.zeros(x.shape[1])
    scale = counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (scale * (p - posterior)) + 1e-3 * w
        hessian = (x * (scale * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        base, loose = [], []
        for text in batch["text"]:
            own = base_spans(text) if text else []
            base.append([f"{KINDS[k]}:{a}:{b}" for a, b, k in own])
            loose.append([f"{k}|{v}|{a}|{b}" for a, b, k, v in _candidates(text, own)] if text else [])
        yield batch.drop(columns="text").assign(base=base, loose=loose)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table with one row per row of ``docs``: id, base spans and candidates with
    their votes."""
    keyed = narrow(docs, key=id_col, text=text_col).withColumn("key", F.col("key").cast("string"))
    return settle(keyed.mapInPandas(_scan, "key string, base array<string>, loose array<string>"))


def fit(scanned: DataFrame) -> Classifier:
    """Reliabilities and the span classifier from the votes of all candidates."""
    parts = F.split("one", r"\|")
    table = (
        scanned.select(F.explode("loose").alias("one"))
        .groupBy(F.get(parts, F.lit(0)).alias("kind"), F.get(parts, F.lit(1)).alias("votes"))
        .count()
        .collect()
    )
    weights = {}
    for kind in sorted({r["kind"] for r in table}):
        own = sorted((r["votes"], r["count"]) for r in table if r["kind"] == kind)
        patterns, counts = np.array([[int(v) for v in p.split(",")] for p, _ in own]), np.array([c for _, c in own], dtype=float)
        posterior, _ = aggregate_votes(patterns, counts)
        weights[int(kind)] = train(patterns, counts, posterior)
    return Classifier(weights)


def _decide(classifier: Classifier):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for base, loose in zip(batch["base"], batch["loose"], strict=True):
                spans = []
                for one in base:
                    kind, a, b = one.split(":")
                    spans.append((int(a), KINDS.index(kind), int(b)))
                for one in loose:
                    kind, vote, a, b = one.split("|")
                    if classifier.probability(int(kind), vote) >= 0.5:
                        spans.append((int(a), int(kind), int(b)))
                kinds = [one.partition(":")[0] for one in base]
                rows.append(
                    (
                        *[kinds.count(k) for k in KINDS],
                        hashlib.sha256(",".join(base).encode()).hexdigest(),
                        ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)),
                    )
                )
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
            yield out.assign(key=batch["key"].to_numpy())

    return run


_SHAPE = "key string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base counts ``n_email``, ``n_ip``,
    ``n_card`` and ``n_phone``, ``base_sha256`` (of the base spans ``kind:start:end`` by
    start, then kind, comma-joined) and ``spans`` (base and added ones, joined alike).

    A null text is empty and has no span. Null ids and repeated rows are kept. Places
    are code points, ends exclusive. An empty table gives an empty one."""
    scanned = scan(docs, id_col, text_col)
    found = scanned.mapInPandas(_decide(fit(scanned)), _SHAPE)
    return found.withColumnRenamed("key", "doc_id").withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def mask(text: str | None, classifier: Classifier) -> str | None:
    """The text with each span replaced by its kind in brackets."""
    if not text:
        return text
    base = base_spans(text)
    spans = [*base, *[(a, b, k) for a, b, k, v in _candidates(text, base) if classifier.probability(k, v) >= 0.5]]
    out, done = [], 0
    for a, b, k in sorted(spans):
        # Spans of different kinds may overlap; together they are one place.
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, each found span in the text replaced by its kind in
    brackets; ``length_col``, if there, follows the text unless that is null. A null text stays
    null, an empty one empty, and an empty table gives an empty one."""
    classifier = fit(scan(docs, id_col, text_col))

    @F.pandas_udf("string")
    def masks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: mask(text, classifier), na_action="ignore")

    out = docs.withColumn(text_col, masks(docs[text_col]))
    if length_col in docs.columns:
        length = F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.length(text_col))
        out = out.withColumn(length_col, length.cast(docs.schema[length_col].dataType))
    return out
