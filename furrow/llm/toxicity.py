"""Toxicity from a learned lexicon, matched with typing errors, read in context.

The lexicon holds words and word beginnings that mark labelled toxic texts; it is
learned from the training labels and joined with a short list of common insults. Its
trie is intersected once with the Levenshtein automata of all terms: the product is
one deterministic automaton whose states are sets of (trie node, errors so far), each
worked out when a word first reaches it, so the lexicon may have any size. All words of a batch of texts run through it side by side, one character a step; nearly
all have died after three.

A hit is read in its window: quoted or reported speech, speech at a person, or
neither. The weight of (term, errors) and of the kind of context are log-odds counted
on the training rows, so a term or a context that clean texts share counts little.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import broadcast_if_small, code_points, narrow, segments, shingle_set
from furrow.session import settle

#: Labelled rows that the classifier is fitted on: about so many of each label, chosen
#: by a hash of the id. All of them up to that number.
FIT_ROWS = 20_000
#: Lengths of learned word beginnings, toxic texts that must hold a term whatever the input.
STEMS, SUPPORT = (4, 5, 6, 7), 5
#: Texts of a label are near copies at this Jaccard similarity; values that sketch a text.
COPY, SKETCH = 0.8, 32
#: A learned term is at least so much likelier (log) in toxic than in clean texts, and
#: so far from chance (likelihood ratio statistic), as very many terms are tried.
LEAST_ODDS, LEAST_RATIO = 2.5, 30.0
#: A term must look so both in the texts it is chosen from and in the others: training
#: texts are dealt into two halves, and each half must bear out what both show together.
HALF_SUPPORT, HALF_ODDS = 2, 1.5
#: A term is dense in a text if it stands there once in so many words, else rare.
DENSE = 200
#: Terms of so many letters may be matched with one error, with two (or a transposition).
ONE_ERROR, TWO_ERRORS = 5, 8
#: Known states of the automaton beyond which they are forgotten and worked out anew.
MOST_STATES = 100_000
#: Words on each side of a hit that make its context.
AROUND = 8
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "imbecile", "filthy", "bastard")
REPORTING = frozenset("said says called calls quote quoted word term phrase wrote cited sagte nannte dit appelle dijo llama".split())
TO_PERSON = frozenset("you your youre u du dich dein tu te toi tes vous eres".split())
CONTEXTS = ("plain", "person", "quoted")
#: Log-odds of a context before any label is seen, worth so many texts.
PRIOR, PRIOR_TEXTS = {"plain": 0.0, "person": 0.5, "quoted": -9.0}, 5.0
#: A hit whose learned log-odds are lower is no evidence.
LEAST_WEIGHT = 1.0


def errors_of(word: str) -> int:
    """How many errors a term of this length tolerates."""
    return int(len(word) >= ONE_ERROR) + int(len(word) >= TWO_ERRORS)


@functools.cache
def _classes() -> np.ndarray:
    """For each code point: part of a word or not."""
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def word_spans(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of code points."""
    edge = np.diff(np.concatenate([[0], _classes()[c].view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Automaton:
    """The lexicon's trie intersected with the Levenshtein automata of its terms.

    ``terms`` are words, or beginnings if they end in ``*``. A word is given to the
    term it reaches with the fewest errors, then the first in order. ``rejected`` words
    are no misspelling of any term."""

    def __init__(self, terms: list[str], rejected: frozenset[str] = frozenset()):
        self.terms, self.rejected = terms, rejected
        kids: list[dict[str, int]] = [{}]
        ends: list[tuple[int, bool] | None] = [None]
        reach = [0]
        for t, term in enumerate(terms):
            stem, word, node = term.endswith("*"), term.rstrip("*"), 0
            errors = errors_of(word)
            for ch in word:
                reach[node] = max(reach[node], errors)
                if ch not in kids[node]:
                    kids[node][ch] = len(kids)
                    kids.append({}), ends.append(None), reach.append(0)
                node = kids[node][ch]
            reach[node] = max(reach[node], errors)
            if ends[node] is None or (stem and not ends[node][1]):
                ends[node] = (t, stem)
        self.kids, self.ends, self.reach = kids, ends, reach
        alphabet = sorted({ch for k in kids for ch in k})
        self.letter = np.zeros(0x110000, dtype=np.int32)
        for i, ch in enumerate(alphabet, 1):
            self.letter[ord(ch)] = i
        self.alphabet = ["", *alphabet]
        self._forget()

    def _close(self, states: dict[int, int]) -> dict[int, int]:
        """Adds what is reached by leaving out a letter of a term: (node, errors)."""
        out, todo = dict(states), list(states.items())
        while todo:
            node, e = todo.pop()
            for kid in self.kids[node].values():
                if e + 1 <= self.reach[kid] and out.get(kid, 9) > e + 1:
                    out[kid] = e + 1
                    todo.append((kid, e + 1))
        return out

    def _accepts(self, states: dict[int, int], stems: bool) -> tuple[int, int] | None:
        """(errors, term) of the best term that ends in these states."""
        found = []
        for node, e in states.items():
            end = self.ends[node]
            if end and (end[1] or not stems) and e <= errors_of(self.terms[end[0]].rstrip("*")):
                found.append((e, end[0]))
        return min(found, default=None)

    def _forget(self) -> None:
        """Only the dead state 0 and the first one are known, with no step from it."""
        self.states: list[dict[int, int]] = []
        self.number: dict[tuple, int] = {}
        self.at_end: list[tuple[int, int] | None] = []
        self.at_once: list[tuple[int, int] | None] = []
        self.table = np.full((64, len(self.alphabet)), -1, dtype=np.int32)
        self.stem_ends = np.zeros(64, dtype=bool)
        self._number({}), self._number(self._close({0: 0}))
        self.table[0] = 0

    def _number(self, states: dict[int, int]) -> int:
        name = tuple(sorted(states.items()))
        if name not in self.number:
            n = self.number[name] = len(self.states)
            if n == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.stem_ends = np.concatenate([self.stem_ends, np.zeros_like(self.stem_ends)])
            self.states.append(states)
            self.at_end.append(self._accepts(states, False))
            self.at_once.append(self._accepts(states, True))
            self.stem_ends[n] = self.at_once[n] is not None
        return self.number[name]

    def _steps(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after a letter each; a step is worked out when it is first taken."""
        after = self.table[state, letter]
        if (after < 0).any():
            for s, i in sorted(set(zip(state[after < 0].tolist(), letter[after < 0].tolist(), strict=True))):
                to: dict[int, int] = {}
                ch = self.alphabet[i]
                for node, e in self.states[s].items():
                    kids = self.kids[node]
                    # A wrong letter is only worth a look while an error is left.
                    tried = kids.items() if e < self.reach[node] else [(ch, kids[ch])] if ch in kids else []
                    for kid, errors in [*((kid, e + (c != ch)) for c, kid in tried), (node, e + 1)]:
                        if errors <= self.reach[kid] and to.get(kid, 9) > errors:
                            to[kid] = errors
                there = self._number(self._close(to))
                self.table[s, i] = there
            after = self.table[state, letter]
        return after

    def run(self, c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
        """(word number, term, errors) for each word that a term reaches."""
        if len(self.states) > MOST_STATES:
            self._forget()
        letters = self.letter[c]
        alive = np.arange(len(starts))
        state = np.ones(len(starts), dtype=np.int32)
        found: dict[int, tuple[int, int]] = {}
        step = 0
        while len(alive):
            over = starts[alive] + step >= ends[alive]
            for w, s in zip(alive[over], state[over], strict=True):
                if (hit := self.at_end[s]) is not None:
                    found[int(w)] = min(found.get(int(w), (9, 0)), hit)
            alive, state = alive[~over], state[~over]
            state = self._steps(state, letters[starts[alive] + step])
            for j in np.flatnonzero(self.stem_ends[state]):
                w = int(alive[j])
                found[w] = min(found.get(w, (9, 0)), self.at_once[state[j]])
            alive, state = alive[state > 0], state[state > 0]
            step += 1
        return [(w, term, errors) for w, (errors, term) in sorted(found.items())]


def context_of(text: str, starts: np.ndarray, ends: np.ndarray, w: int) -> str:
    """How the word number ``w`` is used, from ``AROUND`` words on either side."""
    a, b = max(0, w - AROUND), min(len(starts), w + AROUND + 1)
    before, after = text[starts[a] : starts[w]], text[ends[w] : ends[b - 1]]
    opened = any(before.count(q) % 2 for q in '"') or any(before.rfind(o) > before.rfind(c) for o, c in ("“”", "«»", "„“"))
    closed = any(q in after for q in '"”»“')
    words = {text[starts[i] : ends[i]] for i in range(a, b) if i != w}
    if (opened and closed) or words & REPORTING:
        return "quoted"
    return "person" if words & TO_PERSON else "plain"


def hits(text: str | None, automaton: Automaton, rejecting: bool = True) -> dict[tuple[int, int], tuple[str, set[str]]]:
    """By (term, errors): dense or rare in the text, and the contexts it stands in.

    A beginning that was learned from longer words is not hit by itself alone."""
    if not text:
        return {}
    text = text.lower()
    c = code_points(text)
    starts, ends = word_spans(c)
    found: dict[tuple[int, int], list[str]] = {}
    for w, t, e in automaton.run(c, starts, ends):
        term = automaton.terms[t]
        if term.endswith("*") and ends[w] - starts[w] < len(term):
            continue
        if not e or not rejecting or text[starts[w] : ends[w]] not in automaton.rejected:
            found.setdefault((t, e), []).append(context_of(text, starts, ends, w))
    return {key: (density(len(contexts), len(starts)), set(contexts)) for key, contexts in found.items()}


def density(times: int, words: int) -> str:
    return "dense" if times * DENSE >= words else "rare"


def _misspelled(automaton):
    """In how many texts of this task, by label, each word stands that a term reaches with errors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                text = (text or "").lower()
                c = code_points(text)
                starts, ends = word_spans(c)
                counts.update({(text[starts[w] : ends[w]], int(label)) for w, _, e in automaton.value.run(c, starts, ends) if e})
        if counts:
            yield pd.DataFrame([(w, label, n) for (w, label), n in counts.items()], columns=["word", "toxic", "n"])

    return run


def rejected_words(training: DataFrame, automaton: Automaton, n_toxic: int, n_clean: int) -> frozenset[str]:
    """The words near a term that clean texts hold and whose own log-odds are no evidence."""
    shared = training.sparkSession.sparkContext.broadcast(automaton)
    found = training.mapInPandas(_misspelled(shared), "word string, toxic int, n long").groupBy("word")
    both = found.agg(*[F.sum(F.when(F.col("toxic") == v, F.col("n")).otherwise(0)).alias(c) for v, c in ((1, "a"), (0, "b"))])
    odds = F.log((F.col("a") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("b") + 0.5) / (n_clean + 1.0))
    return frozenset(r["word"] for r in both.where((F.col("b") > 0) & (odds < LEAST_WEIGHT)).select("word").collect())


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many texts of this task each word and beginning is dense, by half."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, half in zip(batch["text"], batch["half"], strict=True):
            text = (text or "").lower()
            starts, ends = word_spans(code_points(text))
            times: Counter = Counter(text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
            for w, n in list(times.items()):
                for k in STEMS:
                    if len(w) > k:
                        times[w[:k] + "*"] += n
            least = len(starts) / DENSE
            counts[half].update(t for t, n in times.items() if n >= least)
    for half in (0, 1):
        terms = list(counts[half])
        for at in range(0, len(terms), 100_000):
            own = terms[at : at + 100_000]
            yield pd.DataFrame({"term": own, "half": half, "n": [counts[half][t] for t in own]})


def _smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(text, 3) for text in batch["text"]]
        least = [f"{label}:{x[0] if len(x) else 0}" for x, label in zip(sets, batch["toxic"], strict=True)]
        yield batch[["text", "toxic"]].assign(least=least)


def _without_copies(_: object, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Of texts with the same smallest shingle, those that are no near copy of one before.

    A sketch picks the texts to compare, generously; the sets themselves decide."""
    factors = np.random.default_rng(1).integers(0, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sketches, sets, kept = np.empty((len(rows), SKETCH), dtype=np.uint64), [], []
    for place, text in enumerate(rows["text"]):
        x = shingle_set(text, 3)
        mixed = x ^ (x >> np.uint64(32))
        sketch = np.array([(mixed * f).min() if len(x) else 0 for f in factors], dtype=np.uint64)
        alike = np.flatnonzero((sketches[: len(sets)] == sketch).mean(axis=1) >= COPY / 2) if sets else ()
        for other in alike:
            both = len(np.intersect1d(x, sets[other], assume_unique=True))
            if both >= COPY * (len(x) + len(sets[other]) - both):
                break
        else:
            sketches[len(sets)] = sketch
            sets.append(x)
            kept.append(place)
    yield rows.iloc[kept][["text", "toxic"]]


def learn_terms(training: DataFrame, sizes: dict[tuple[int, int], int]) -> list[str]:
    """The fixed insults and all terms that mark toxic texts, the best first. ``sizes``: texts
    by label and half. A longer term that begins like a chosen beginning is left out.

    Spark counts and tests the terms; only those that pass reach the driver."""

    def counted(label: int) -> DataFrame:
        return training.where(F.col("toxic") == label).select("text", "half").mapInPandas(_terms, "term string, half int, n long")

    def by_half(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("term").agg(*[F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"{name}{h}") for h in (0, 1)])

    def odds_of(a: Column, b: Column, n_toxic: int, n_clean: int) -> Column:
        return F.log((a + 0.5) / (n_toxic + 1.0)) - F.log((b + 0.5) / (n_clean + 1.0))

    toxic = settle(by_half(counted(1), "a").where(F.col("a0") + F.col("a1") >= SUPPORT))
    # A clean text's terms are dropped before the shuffle unless enough toxic ones hold them.
    clean = by_half(counted(0).join(broadcast_if_small(toxic.select("term")), "term", "left_semi"), "b")
    known = toxic.join(clean, "term", "left").select("term", "a0", "a1", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("b0", "b1")])
    n_toxic, n_clean = (sizes.get((label, 0), 0) + sizes.get((label, 1), 0) for label in (1, 0))
    rate = (n_toxic + 0.5) / (n_toxic + n_clean + 1.0)
    a, b = F.col("a0") + F.col("a1"), F.col("b0") + F.col("b1")
    odds = odds_of(a, b, n_toxic, n_clean)
    ratio = 2 * (a * F.log(a / ((a + b) * rate)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - rate)))).otherwise(0.0))
    borne_out = [
        (F.col(f"a{h}") >= HALF_SUPPORT) & (odds_of(F.col(f"a{h}"), F.col(f"b{h}"), sizes.get((1, h), 0), sizes.get((0, h), 0)) >= HALF_ODDS) for h in (0, 1)
    ]
    passed = (
        known.where(borne_out[0] & borne_out[1])
        .select("term", (odds * F.sqrt(a)).alias("strength"), odds.alias("odds"), ratio.alias("ratio"))
        .where((F.col("odds") >= LEAST_ODDS) & (F.col("ratio") >= LEAST_RATIO))
        .collect()
    )
    return chosen_terms([(-r["strength"], -len(r["term"].rstrip("*")), r["term"]) for r in passed])


def chosen_terms(ranked: list[tuple[float, int, str]]) -> list[str]:
    chosen: list[str] = list(INSULTS)
    words, begun, stems = set(chosen), {t[:k] for t in chosen for k in range(1, len(t) + 1)}, set()
    for _, _, term in sorted(ranked):
        word = term.rstrip("*")
        if word in words or any(word[:k] in stems for k in range(1, len(word))) or (term.endswith("*") and word in begun):
            continue
        chosen.append(term)
        words.add(word)
        begun.update(word[:k] for k in range(1, len(word) + 1))
        if term.endswith("*"):
            stems.add(word)
    return chosen


class Model(NamedTuple):
    automaton: Automaton
    #: Log-odds of (term, errors, density), of a context, of a text without a term as it is, of any text.
    weights: dict[tuple[int, int, str], float]
    contexts: dict[str, float]
    silent: float
    prior: float

    def score(self, text: str | None) -> float:
        best: dict[int, float] = {}
        for (term, errors), (dense, contexts) in hits(text, self.automaton).items():
            weight = self.weights.get((term, errors, dense), 0.0)
            if weight >= LEAST_WEIGHT:
                best[term] = max(best.get(term, -99.0), weight + max(self.contexts[c] for c in contexts))
        evidence = sum(best.values()) if best else self.silent
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.prior + evidence))))


def choose_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``id`` and ``toxic`` of about ``fit_rows`` rows of each label, all up to that number,
    by a hash of the id; and how many rows of each label there are."""
    rows = narrow(labels, id=id_col, toxic=label_col).where("toxic in (0, 1) and id is not null")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {label: min(1.0, fit_rows / max(1, sizes.get(label, 0))) for label in (0, 1)}
    below = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 20)
    return settle(rows.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < below)), sizes


def fit(chosen: DataFrame, sizes: dict[int, int], text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns from the texts of chosen rows labelled 1 or 0; ``sizes`` are the numbers of
    rows with each label that they were chosen from. Without labels of both kinds the
    fixed insults get a fixed weight."""
    rows = narrow(chosen, text=text_col, toxic=label_col).where("toxic in (0, 1)")
    # Near copies of one text, which mostly share their smallest shingle, count once:
    # else the chance words of a much copied toxic text would pass for terms.
    keyed = rows.mapInPandas(_smallest, "text string, toxic int, least string")
    picked = settle(segments(keyed, "least", _without_copies, "text string, toxic int"))
    halved = picked.withColumn("half", F.pmod(F.xxhash64("text", F.lit(3)), F.lit(2)).cast("int"))
    n = {(r["toxic"], r["half"]): r["n"] for r in halved.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    n1, n0 = (n.get((label, 0), 0) + n.get((label, 1), 0) for label in (1, 0))
    terms = learn_terms(halved, n)
    automaton = Automaton(terms)
    automaton.rejected = rejected_words(picked, automaton, n1, n0)
    shared = chosen.sparkSession.sparkContext.broadcast(automaton)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                found = hits(text, shared.value)
                own = {f"{t}:{e}:{dense}" for (t, e), (dense, _) in found.items()} | {c for _, contexts in found.values() for c in contexts}
                # The rejected words were found in these very texts; without them an error would
                # seem better evidence here than in a new text.
                own |= {f"{t}:{e}:{dense}:any" for (t, e), (dense, _) in hits(text, shared.value, False).items() if e}
                own |= set() if any(not e for _, e in found) else {"silent"}
                counts.update((f, int(label)) for f in own)
        if counts:
            yield pd.DataFrame([(f, label, c) for (f, label), c in counts.items()], columns=["feature", "toxic", "n"])

    seen: dict[tuple[str, int], int] = {
        (r["feature"], r["toxic"]): r["n"]
        for r in picked.mapInPandas(features, "feature string, toxic int, n long").groupBy("feature", "toxic").agg(F.sum("n").alias("n")).collect()
    }

    def odds(feature: str, prior: float = 0.0, strength: float = 0.0) -> float:
        a, b = seen.get((feature, 1), 0), seen.get((feature, 0), 0)
        own = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
        return own if not strength else (own * (a + b) + prior * strength) / (a + b + strength)

    weights = {}
    for t, term in enumerate(terms):
        fixed = 5.0 if term in INSULTS else 0.0
        for dense in ("dense", "rare"):
            for e in range(errors_of(term.rstrip("*")) + 1):
                # Unseen typing errors of a fixed term are worth nearly as much as the term;
                # those of a learned one count for what the labels say of all words so near.
                if e and not fixed:
                    weights[t, e, dense] = odds(f"{t}:{e}:{dense}:any", 0.0, 5.0)
                else:
                    weights[t, e, dense] = odds(f"{t}:{e}:{dense}", fixed if e == 0 else weights[t, 0, dense] - e, 2.0)
    # A context's odds among texts with hits, beside those of all texts with hits.
    with_hits = odds("plain") if (("plain", 1) in seen or ("plain", 0) in seen) else 0.0
    contexts = {"plain": 0.0}
    for c in CONTEXTS[1:]:
        total = seen.get((c, 1), 0) + seen.get((c, 0), 0)
        own = odds(c) - with_hits if total else 0.0
        contexts[c] = (own * total + PRIOR[c] * PRIOR_TEXTS) / (total + PRIOR_TEXTS)
    silent = odds("silent") if n1 and n0 else -4.0
    prior = math.log((sizes.get(1, 0) + 1) / (sizes.get(0, 0) + 1))
    return Model(automaton, weights, contexts, min(silent, 0.0), prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score`` and ``predicted``.

    A null or empty text has no hit and gets the score of such texts. Null ids and
    repeated rows are kept; an empty table gives an empty one."""
    keyed = narrow(docs, key=id_col, text=text_col).withColumn("key", F.col("key").cast("string"))
    scored = keyed.mapInPandas(_scorer(docs, model, ["key"]), "key string, score double")
    return scored.select(
        F.col("key").cast(docs.schema[id_col].dataType).alias("doc_id"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _scorer(docs: DataFrame, model: Model, columns: list[str]):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[columns].assign(score=[shared.value.score(text) for text in batch["text"]])

    return run


def clean_rows(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under 0.5, all columns kept. A text is judged once for
    all its rows. Rows with a null text stay, and null ids make no difference."""
    keyed = narrow(docs, text=text_col).where("text is not null").withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), "text")})
    scored = keyed.mapInPandas(_scorer(docs, model, ["h", "g"]), "h long, g long, score double")
    gone = broadcast_if_small(settle(scored.where("score >= 0.5").select("h", "g").distinct()))
    text = docs[text_col]
    return docs.join(gone, (F.xxhash64(text) == gone["h"]) & (F.xxhash64(F.lit(1), text) == gone["g"]), "left_anti")
