"""Toxicity by a weighted finite-state pattern grammar.

The lexical transducer maps words to symbols: insult (with a weight), threat, target, negation, reported speech.
Its patterns are whole words and word beginnings, from short fixed lists and from labelled documents: a pattern is
learned where its share of toxic documents beats its share of clean ones by a log-likelihood ratio, and its weight
is its smoothed log odds. A clause (text up to a full stop, question or exclamation mark, semicolon, line end, or
`CLAUSE` words) is a string of symbols, read left to right by five transducers, each a table (state, symbol) -> (state, factor):

- insult: a further insult in the clause counts `REPEAT` times its weight
- threat: counts in full with a target within `REACH` words on either side, else in part; the target after it is
  promised, and a path whose promise is not kept ends
- target: raises the weight of insults that follow within `REACH` words
- negation: lowers the weight of what follows within `REACH` words
- reported speech: lowers the weight of what follows to the clause's end

Their composition is one table over the reachable tuples of states. A path through it weighs the sum of its words'
weights, each times the factors of its arc; a clause's score is its best path, found in one pass.

A document's features are the sum of its clause scores, the largest, and the number of matched clauses; a logistic
link fitted on the same labelled sample, held to default coefficients by a Gaussian prior, gives the score.

The sample is bounded: `POSITIVES` toxic and `NEGATIVES` clean labelled documents, the first by a hash of the id.
The grammar is bounded by `PATTERNS` learned patterns, so it is small enough to send to all tasks. Scoring reads
whole texts. Labels, lang, source and doc_id are no inputs of a score.

Null and empty texts have no clause and get the score of the intercept (below 0.5). Labels of unknown documents
are ignored; several labels of one document all count. Without labels the fixed lists and defaults hold. Long texts
are read whole, in time proportional to their length, also without any stop. Repeated rows are scored each; of patterns with
equal ratios the first in alphabetical order is taken. Extra columns are not read (`clean` returns them unchanged). An empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bvengine.llm.common import free_name

POSITIVES, NEGATIVES, PATTERNS = 4000, 8000, 2000
PREFIXES = (3, 4, 5, 6)
LEAST_RATIO, LEAST_SHARE = 25.0, 0.01
CLAUSE, REACH, REPEAT = 64, 4, 0.8
#: Factors of a target, a negation and reported speech on what follows, and of a threat without a target.
TARGETED, NEGATED, REPORTED, LOOSE = 1.3, 0.3, 0.5, 0.4

# Words of the grammar.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "imbecile", "stupid", "scum", "worthless", "pathetic", "disgusting", "loser", "losers",
    "scumbag", "dumbass", "asshole", "bastard", "dimwit", "halfwit", "lowlife",
    "dummkopf", "arschloch", "abschaum", "connard", "ordure", "débile", "imbécil", "estúpido", "idiota", "basura",
)
THREATS = ("kill", "murder", "hurt", "destroy", "töten", "umbringen", "tuer", "matar", "matarte")
TARGETED_WORDS = ("you", "your", "yours", "u", "they", "them", "he", "she", "him", "du", "dich", "dir", "ihr", "tu", "toi", "vous", "tú", "usted")
NEGATIONS = ("not", "never", "no", "nobody", "isn't", "aren't", "don't", "nicht", "nie", "kein", "keine", "pas", "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "quoted", "called", "reported", "wrote", "sagte", "schrieb", "nannte", "dit", "écrit", "dijo", "escribió", "llamó")
FIXED_WEIGHT, THREAT_WEIGHT = 4.0, 3.0

WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
STOPS = re.compile(r"[.!?;\n]")
#: Prior mean and precision of the link: intercept, log of the sum, largest clause, log of the matched clauses.
PRIOR, PRECISION = (-4.0, 1.6, 0.8, 0.4), (0.25, 1.0, 1.0, 1.0)


@dataclass
class Grammar:
    """Weights by pattern (a word, or a beginning with ``*``) and the link's coefficients."""

    words: dict = field(default_factory=lambda: dict.fromkeys(INSULTS, FIXED_WEIGHT))
    link: tuple = PRIOR

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for p, w in self.words.items():
            a.add_word(p.rstrip("*"), ())
        for p in THREATS:
            a.add_word(p, ())
        for p in {x.rstrip("*") for x in self.words} | set(THREATS):
            a.add_word(p, (len(p), self.words.get(p), self.words.get(p + "*"), p in THREATS))
        a.make_automaton()
        return a


def symbols(text: str, automaton) -> dict[int, tuple[str, float]]:
    """Word start -> (insult or threat, weight) of the words that a pattern matches."""
    out: dict[int, tuple[str, float]] = {}
    for last, (size, whole, start, threat) in automaton.iter(text):
        at = last - size + 1
        if at and (text[at - 1].isalnum() or text[at - 1] == "'"):
            continue
        ends = last + 1 == len(text) or not text[last + 1].isalnum()
        weight = max((w for w in (whole if ends else None, start) if w is not None), default=None)
        if weight is not None and weight > out.get(at, ("", 0.0))[1]:
            out[at] = ("insult", weight)
        elif threat and ends:
            out.setdefault(at, ("threat", THREAT_WEIGHT))
    return out


#: What a word is to the grammar: a target or not, a negation or a report or neither, an insult or a threat or neither.
SYMBOLS = [(t, m, h) for t in (False, True) for m in ("", "negation", "report") for h in ("", "insult", "threat")]
FAR = REACH + 1


def arcs(states, step) -> dict:
    """The table of a transducer: (state, symbol) -> its (state, factor) arcs."""
    return {(s, x): tuple(step(s, *x)) for s in states for x in SYMBOLS}


def insult_step(seen, target, mark, hit):
    yield (True, REPEAT if seen else 1.0) if hit == "insult" else (seen, 1.0)


def target_step(since, target, mark, hit):
    since = 0 if target else min(since + 1, FAR)
    yield since, TARGETED if hit == "insult" and since <= REACH else 1.0


def negation_step(since, target, mark, hit):
    since = 0 if mark == "negation" else min(since + 1, FAR)
    yield since, NEGATED if since <= REACH else 1.0


def report_step(reported, target, mark, hit):
    reported = reported or mark == "report"
    yield reported, REPORTED if reported else 1.0


def threat_step(state, target, mark, hit):
    """Words since the last target, and words left for the target that the earliest open threat is promised (0: none)."""
    since, left = state
    since = 0 if target else min(since + 1, FAR)
    if left and not target and left == 1:
        return  # the promise is broken
    left = 0 if target else max(0, left - 1)
    if hit != "threat":
        yield (since, left), 1.0
    elif since <= REACH:
        yield (since, left), 1.0
    else:
        yield (since, left), LOOSE
        yield (since, left or REACH), 1.0


#: (start, table, whether a state may end a clause) of each transducer.
AGES = range(FAR + 1)
TRANSDUCERS = {
    "insult": (False, arcs((False, True), insult_step), lambda s: True),
    "threat": ((FAR, 0), arcs([(a, b) for a in AGES for b in range(REACH + 1)], threat_step), lambda s: s[1] == 0),
    "target": (FAR, arcs(AGES, target_step), lambda s: True),
    "negation": (FAR, arcs(AGES, negation_step), lambda s: True),
    "report": (False, arcs((False, True), report_step), lambda s: True),
}


@lru_cache(maxsize=1)
def composed() -> tuple[list[list[tuple[tuple[int, float], ...]]], list[bool]]:
    """Of the reachable tuples of states, numbered from the start: the arcs by symbol, and which may end a clause."""
    tables = [t for _, t, _ in TRANSDUCERS.values()]
    ends = [e for _, _, e in TRANSDUCERS.values()]
    start = tuple(s for s, _, _ in TRANSDUCERS.values())
    number, todo, table = {start: 0}, [start], []
    for states in todo:  # grows while it is read
        row = []
        for x in SYMBOLS:
            out = []
            for way in product(*[t[s, x] for t, s in zip(tables, states, strict=True)]):
                to = tuple(s for s, _ in way)
                if to not in number:
                    number[to] = len(todo)
                    todo.append(to)
                out.append((number[to], math.prod(f for _, f in way)))
            row.append(tuple(out))
        table.append(row)
    return table, [all(e(s) for e, s in zip(ends, states, strict=True)) for states in todo]


NUMBER = {x: i for i, x in enumerate(SYMBOLS)}
MARKS = dict.fromkeys(NEGATIONS, "negation") | {w: "report" for w in REPORTS if w not in NEGATIONS}
TARGETS = frozenset(TARGETED_WORDS)


def spelled(words: list[tuple[int, str]], found: dict[int, tuple[str, float]]) -> list[tuple[int, float]]:
    """(symbol's number, weight) of each word (place in the text, lower-case word)."""
    out = []
    for at, word in words:
        kind, weight = found.get(at, ("", 0.0))
        out.append((NUMBER[word in TARGETS, MARKS.get(word, ""), kind], weight))
    return out


def clause_score(words: list[tuple[int, str]], found: dict[int, tuple[str, float]]) -> float:
    """Weight of the best path of one clause through the composed transducers."""
    table, ends = composed()
    paths = {0: 0.0}
    for symbol, weight in spelled(words, found):
        after: dict[int, float] = {}
        for state, total in paths.items():
            for to, factor in table[state][symbol]:
                if (score := total + weight * factor) > after.get(to, -1.0):
                    after[to] = score
        paths = after
    return max(total for state, total in paths.items() if ends[state])


def clauses(text: str, automaton) -> list[float]:
    """Scores of the clauses that hold a matched word; `text` is in lower case. Every word is read once."""
    found = symbols(text, automaton)
    hits = sorted(found)
    out, i, end = [], 0, -1
    while i < len(hits):
        start = max(end, last_stop(text, hits[i], end)) + 1
        stop = STOPS.search(text, hits[i])
        end = stop.start() if stop else len(text)
        clause: list[tuple[int, str]] = []
        for m in WORD.finditer(text, start, end):
            if len(clause) == CLAUSE:  # clauses without a stop are cut every CLAUSE words
                if i < len(hits) and hits[i] <= clause[-1][0]:
                    out.append(clause_score(clause, found))
                while i < len(hits) and hits[i] < m.start():
                    i += 1
                if i == len(hits):
                    return out
                clause = []
            clause.append((m.start(), m[0]))
        if clause and i < len(hits) and hits[i] < end:
            out.append(clause_score(clause, found))
        while i < len(hits) and hits[i] < end:
            i += 1
    return out


def last_stop(text: str, before: int, after: int) -> int:
    """Place of the last stop before a place and not before another one; -1 without."""
    return max(text.rfind(c, max(after, 0), before) for c in ".!?;\n")


def features(text: str | None, automaton) -> tuple[float, float, float]:
    scores = clauses(text.lower(), automaton) if text else []
    return (math.log1p(sum(scores)), max(scores, default=0.0), math.log1p(len(scores)))


def fit(x: np.ndarray, y: np.ndarray) -> tuple:
    """Logistic coefficients by Newton steps, held to PRIOR."""
    mean, precision = np.array(PRIOR), np.array(PRECISION)
    x = np.hstack([np.ones((len(x), 1)), x])
    b = mean.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (y - p) - precision * (b - mean)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(precision)
        step = np.linalg.solve(h, g)
        b = b + step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, b))


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def chosen(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """The patterns worth keeping of those found, (toxic documents, weight) each: a beginning only where no single
    word accounts for it, at its greatest length, and words and longer beginnings only where none kept covers them."""
    whole = [p for p in found if not p.endswith("*")]
    starts = sorted((p for p in found if p.endswith("*")), key=len)
    kept: dict[str, float] = {}
    for p in starts:
        k, weight = found[p]
        one_word = any(found[w][0] >= 0.8 * k for w in whole if w.startswith(p[:-1]))
        longer = any(found[q][0] >= 0.95 * k for q in starts if len(q) > len(p) and q.startswith(p[:-1]))
        covered = any(p.startswith(q[:-1]) and v >= weight - 0.5 for q, v in kept.items())
        if not (one_word or longer or covered):
            kept[p] = weight
    for p in whole:
        if not any(p.startswith(q[:-1]) and v >= found[p][1] - 0.5 for q, v in kept.items()):
            kept[p] = found[p][1]
    return kept


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, patterns: int = PATTERNS) -> Grammar:
    """A grammar from labelled documents (doc_id, toxic) that are not held out."""
    base = Grammar()
    known = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    part = lambda y, n: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    picked = part(1, positives).unionByName(part(0, negatives))  # bounded, so it may be sent to all tasks
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id").select("text", "toxic").distinct().persist()
    try:
        sizes = dict(sample.groupBy("toxic").count().collect())
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        if not n1 or not n0:
            return base
        words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
        each = F.filter(words, lambda w: F.length(w) > 2)
        begin = lambda n: F.transform(F.filter(each, lambda w: F.length(w) >= n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))
        tokens = F.array_distinct(F.concat(each, *[begin(n) for n in PREFIXES]))
        counts = sample.select("toxic", F.explode(tokens).alias("p")).groupBy("p").agg(
            F.sum("toxic").alias("k1"), F.sum(1 - F.col("toxic")).alias("k0")
        )
        least = max(3, math.ceil(LEAST_SHARE * n1))
        r1, r0, r = F.col("k1") / n1, F.greatest(F.col("k0"), F.lit(0.5)) / n0, (F.col("k1") + F.greatest(F.col("k0"), F.lit(0.5))) / (n1 + n0)
        ratio = 2 * (F.col("k1") * F.log(r1 / r) + F.col("k0") * F.log(r0 / r))
        found = (
            counts.where(F.col("k1") >= least)
            .withColumn("ratio", ratio)
            .withColumn("weight", F.log((F.col("k1") + 0.1) / (n1 + 0.2)) - F.log((F.col("k0") + 0.1) / (n0 + 0.2)))
            .where((F.col("ratio") > LEAST_RATIO) & (F.col("weight") > 2.5) & (F.col("k0") <= 0.05 * F.col("k1")))
            .orderBy(F.desc("ratio"), "p")
            .limit(patterns)
            .collect()
        )
        words_ = base.words | {p: min(6.0, max(1.0, float(w))) for p, w in chosen({r["p"]: (r["k1"], r["weight"]) for r in found}).items()}
        grammar = Grammar(words_)
        rows = sample.select("toxic", _features(grammar)(F.col("text")).alias("f")).select("toxic", "f.*").collect()  # bounded by the sample
        data = np.array([tuple(x) for x in rows], float)
        grammar.link = fit(data[:, 1:], data[:, 0])
        return grammar
    finally:
        sample.unpersist()


def _features(grammar: Grammar):
    @F.pandas_udf(T.StructType().add("total", "double").add("largest", "double").add("clauses", "double"))
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = grammar.automaton()
        for s in texts:
            yield pd.DataFrame([features(t, automaton) for t in s], columns=["total", "largest", "clauses"], dtype=float)

    return udf


def score(text: Column, grammar: Grammar) -> Column:
    """Score from 0 to 1 of a text column."""
    f = _features(grammar)(text)
    b = grammar.link
    return 1 / (1 + F.exp(-(b[0] + b[1] * f["total"] + b[2] * f["largest"] + b[3] * f["clauses"])))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): held_out, score and predicted."""
    grammar = learn(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), grammar).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """`docs` without the rows whose score reaches the threshold, its columns unchanged."""
    name = free_name(docs, "toxic_score")
    return docs.withColumn(name, score(F.col("text"), learn(docs, labels))).where(F.col(name) < threshold).drop(name)
