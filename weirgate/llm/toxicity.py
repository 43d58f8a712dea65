"""Toxicity by a weighted finite-state grammar over clauses.

Insult words and stems are learned from labelled rows: terms that stand mostly in toxic texts
get non-negative weights by ridge logistic regression, so that words which merely keep
company with insults weigh little. Five small transducers (insult, threat, target, negation,
reported speech) run composed over the tokens of each clause that holds a hit; what they
emit are matched clauses by kind, and a logistic model weighs the kinds. Clauses without a
hit cost one pass of an automaton and nothing else.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import filled, map_texts
from weirgate.session import cut_lineage

# The classifier is fitted on at most about this many labelled rows.
SAMPLE_ROWS = 20_000
# Terms that reach the driver, the most frequent in toxic rows first.
CANDIDATES = 6_000
MIN_TOXIC, MIN_PRECISION = 4, 0.45
RIDGE, LEAST_WEIGHT = 2.0, 0.3
STEM = range(3, 9)

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n]")

# Closed word classes of the grammar, four languages each.
TARGET = set("""you your yours yourself he she they them him her people du dich dir ihr euch dein
    sie tu toi ton ta vous votre vos il ils tú usted ustedes vosotros ellos ella""".split())
NEGATION = set("not no never neither nor without nicht kein keine keinen nie niemals ne jamais sans nunca jamás sin".split())
REPORTED = set("""said says saying called calls quoted quote claims claimed wrote sagte sagt nannte
    schrieb dit disait appelé écrit dijo dice llamó escribió""".split())
THREAT = set("""kill murder destroy hurt punch stab töten umbringen vernichten tuer détruire frapper
    matar destruir golpear""".split())
NEGATION_REACH = 3
KINDS = ["insult", "targeted", "negated", "reported", "threat", "threat_at_target"]
# Where the labels say nothing of a kind, its weight stays here.
PRIOR = np.array([1.0, 1.0, 0.6, 0.6, 0.5, 1.5])
PRIOR_STRENGTH = 5.0


def terms_of(text: str) -> Counter:
    """How often a text has each word and each stem (``stem*``)."""
    out: Counter = Counter()
    for word, n in Counter(WORD.findall(text.lower())).items():
        out[word] += n
        for size in STEM:
            if size < len(word):
                out[word[:size] + "*"] += n
    return out


@dataclass
class Grammar:
    """Learned lexicon (term to weight), weights of the clause kinds, and the intercept."""

    lexicon: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    intercept: float = -2.0

    def matcher(self) -> Matcher:
        return Matcher(self.lexicon)

    def scores(self, features: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(features @ self.weights + self.intercept)))


class Matcher:
    """The composed transducers."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        import ahocorasick

        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for term in lexicon:
            key = term.rstrip("*")
            known = self.automaton.get(key, ())
            self.automaton.add_word(key, (*known, term))
        for term in THREAT:
            self.automaton.add_word(term, (*self.automaton.get(term, ()), "!" + term))
        self.automaton.make_automaton()

    def hits(self, text: str) -> dict[int, list[str]]:
        """Lexicon terms at each word's start; threats begin with an exclamation mark."""
        out: dict[int, list[str]] = {}
        for end, terms in self.automaton.iter(text):
            for term in terms:
                threat, stem = term[0] == "!", term[-1] == "*"
                start = end + 1 - len(term) + (threat or stem)
                if start and text[start - 1].isalpha():
                    continue
                if not stem and end + 1 < len(text) and text[end + 1].isalpha():
                    continue
                out.setdefault(start, []).append(term)
        return out

    def features(self, text: str) -> np.ndarray:
        """Weight of what was matched in clauses of each kind; repetition counts less and less."""
        text = text.lower()
        hits = self.hits(text)
        sums = np.zeros(len(KINDS))
        if not hits:
            return sums
        ends = [m.start() for m in CLAUSE_END.finditer(text)] + [len(text)]
        starts = [0, *(e + 1 for e in ends[:-1])]
        found = np.searchsorted(starts, sorted(hits), side="right") - 1
        matched: Counter = Counter()
        for clause in dict.fromkeys(found.tolist()):
            self.clause(text, starts[clause], ends[clause], hits, matched)
        for (kind, term), n in matched.items():
            sums[kind] += self.lexicon.get(term, 1.0) * damped(n)
        return sums

    def clause(self, text: str, start: int, end: int, hits: dict[int, list[str]], matched: Counter) -> None:
        """Run the machines over one clause; the target may stand before or after the hit."""
        negated, reported, targeted = 0, False, False
        insults, threats = [], []
        for token in WORD.finditer(text, start, end):
            word = token.group()
            for term in hits.get(token.start(), ()):
                if term[0] != "!":
                    insults.append((term, 3 if reported else 2 if negated else None))
                elif not negated:
                    threats.append(term)
            negated = NEGATION_REACH if word in NEGATION else max(0, negated - 1)
            reported |= word in REPORTED
            targeted |= word in TARGET
        for term, kind in insults:
            matched[(1 if targeted else 0) if kind is None else kind, term] += 1
        for term in threats:
            matched[5 if targeted else 4, term] += 1


def damped(n):
    return np.log2(1.0 + n)


def held_out(id: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id's text divisible by five."""
    return F.coalesce(F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): numbers of texts, summed inside each batch before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.iloc[at : at + 500]
                counts = {0: Counter(), 1: Counter()}
                for text, label in zip(batch["_w_text"], batch["_w_label"]):
                    counts[int(label)].update(terms_of(text))
                # A term that this batch saw in no toxic text may be toxic in another.
                names = list(counts[0].keys() | counts[1].keys())
                yield pd.DataFrame({
                    "term": names,
                    "toxic": [counts[1][n] for n in names],
                    "clean": [counts[0][n] for n in names],
                })

    return (
        sample.mapInPandas(run, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def distinct_terms(found: list) -> list[str]:
    """Of terms that one text set cannot tell apart, the whole word or else the longest stem."""
    best: dict[tuple, tuple] = {}
    for row in found:
        key = row["toxic"], row["clean"], row["term"][: STEM.start]
        rank = row["term"][-1] != "*", len(row["term"]), row["term"]
        best[key] = max(best.get(key, rank), rank)
    return sorted(r[-1] for r in best.values())


def weigh_terms(rows: list[tuple], terms: list[str]) -> dict[str, float]:
    """Non-negative ridge logistic weights of the terms over (label, terms, counts) of texts."""
    labels = np.array([r[0] for r in rows], dtype=float)
    sizes = [len(r[1]) for r in rows]
    row = np.repeat(np.arange(len(rows)), sizes)
    term = np.array([t for r in rows for t in r[1]], dtype=np.int64)
    value = damped(np.array([n for r in rows for n in r[2]], dtype=float))
    w, bias = np.zeros(len(terms)), -2.0
    first, second = np.zeros(len(terms) + 1), np.zeros(len(terms) + 1)
    for i in range(1, 401):
        margin = np.bincount(row, weights=w[term] * value, minlength=len(rows)) + bias
        wrong = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels
        gradient = np.append(
            np.bincount(term, weights=wrong[row] * value, minlength=len(terms)) + RIDGE * w, wrong.sum()
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        step = 0.05 * first / (1 - 0.9**i) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
        w, bias = np.maximum(w - step[:-1], 0.0), bias - step[-1]
    return {terms[t]: float(w[t]) for t in np.flatnonzero(w >= LEAST_WEIGHT)}


def _fit_weights(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression pulled to the prior weights, by Newton steps."""
    x = np.column_stack([features, np.ones(len(features))])
    prior = np.append(PRIOR, -2.0)
    pull = np.append(np.full(len(KINDS), PRIOR_STRENGTH), 0.01)
    w = prior.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + pull * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    # A matched clause never speaks against toxicity.
    return np.maximum(w[:-1], 0.0), float(w[-1])


def fit(
    df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Grammar:
    """Learn from labelled rows that are not held out, a hashed sample of about ``sample_rows``.

    Rows without a label or id are not learned from; a label that repeats counts once, at
    its largest value. Without rows of both classes the lexicon is empty and every score is
    the smoothed share of toxic rows.
    """
    known = (
        labels.select(F.col(f"`{id}`").alias("_w_id"), F.col(f"`{label}`").alias("_w_label"))
        .where(F.col("_w_label").isNotNull() & F.col("_w_id").isNotNull() & ~held_out("_w_id"))
        .groupBy("_w_id")
        .agg(F.max("_w_label").alias("_w_label"))
    )
    total = known.count()
    if total > sample_rows:
        cut = int(sample_rows / total * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("_w_id", F.lit("toxicity")), F.lit(1 << 30)) < cut)
    # Equal texts count once, or a much copied one would make its every word toxic.
    sample = cut_lineage(
        df.select(F.col(f"`{id}`").alias("_w_id"), filled(text).alias("_w_text")).join(known, "_w_id")
        .groupBy("_w_text").agg(F.max("_w_label").alias("_w_label"))
    )
    precise = F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean"))
    found = (
        _term_counts(sample)
        .where((F.col("toxic") >= MIN_TOXIC) & precise)
        .orderBy(F.desc("toxic"), "term")
        .limit(CANDIDATES)
        .collect()
    )
    terms = distinct_terms(found)
    number = {t: i for i, t in enumerate(terms)}

    def matches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [{number[t]: n for t, n in terms_of(x).items() if t in number} for x in batch["_w_text"]]
            yield pd.DataFrame({
                "label": batch["_w_label"].astype("int32"),
                "found": [list(s) for s in sets], "counts": [list(s.values()) for s in sets],
            })

    # One short row per sampled text.
    rows = [
        (r["label"], r["found"], r["counts"])
        for r in sample.mapInPandas(matches, "label int, found array<int>, counts array<int>").collect()
    ]
    grammar = Grammar(weigh_terms(rows, terms) if terms else {})
    toxic = sum(r[0] for r in rows)
    if not grammar.lexicon:
        share = (toxic + 1) / (len(rows) + 3)
        return Grammar({}, PRIOR.copy(), float(np.log(share / (1 - share))))

    def clauses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = grammar.matcher()
        for batch in batches:
            yield pd.DataFrame({
                "label": batch["_w_label"].astype("int32"),
                "features": [matcher.features(x).tolist() for x in batch["_w_text"]],
            })

    seen = sample.mapInPandas(clauses, "label int, features array<double>").collect()
    features = np.array([list(r["features"]) for r in seen])
    grammar.weights, grammar.intercept = _fit_weights(features, np.array([r["label"] for r in seen], dtype=float))
    return grammar


def score(df: DataFrame, grammar: Grammar, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``score`` (0 to 1) and ``predicted`` (score >= 0.5).

    Every whole text is scored from its characters alone. Null counts as empty and gets the
    score of a text without a match. Repeated rows get equal scores; columns named like an
    added one are replaced; an empty table gives an empty table.
    """

    def make():
        matcher = grammar.matcher()

        def run(texts: list[str]) -> list:
            scores = grammar.scores(np.array([matcher.features(t) for t in texts]).reshape(len(texts), -1))
            return [scores, (scores >= 0.5).astype("int32")]

        return run

    return map_texts(df, text, make, "score double, predicted int", keep)
