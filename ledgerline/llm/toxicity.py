"""Toxicity: a lexicon trie met by Levenshtein automata, and windows that tell abuse from quotation.

The lexicon is learnt: words, and stems that words begin with, which labelled toxic documents hold far more often
than others.  Stems matter in languages that inflect.  Trie and automaton are run together: a state is a set of
(trie node, edits so far), found once and remembered, so a clean word leaves the automaton after a letter or two and
a misspelled one is followed through every way of spelling it.  Terms shorter than five letters must match exactly; longer
ones may have one letter wrong, missing, added or swapped, the first excepted.

Each hit is looked at in its window: inside quotation marks, or after a word of reporting, it is a quotation.  A
logistic regression weighs direct and quoted, exact and misspelled hits and their density.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import clear_text, per_row, text_key
from .quality_model import held_out, training_labels

SAMPLE_ROWS = 20_000
LEAST_LIFT, LEAST_SIGNIFICANCE = 8.0, 16.0
STEM = (4, 9)
FUZZY_FROM = 5
REACH = 8
WORDS = re.compile(r"[^\W_]+")
QUOTES = "\"“”«»„‘’"
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes quoting reported word words term phrase "
    "sagte schrieb zitat zitiert nannte dit écrit cité citation appelé dijo escribió cita citado llamó".split()
)
ADDRESS = frozenset("you your youre ur u du dich dein ihr tu toi vous ton tú usted eres".split())
INPUTS = ["exact", "misspelled", "quoted_exact", "quoted_misspelled", "strongest", "dense", "addressed", "length"]


def words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


class Lexicon:
    """Terms (text, open, weight) in a trie; ``open`` terms match words that begin with them.

    ``find(word)`` gives (weight, edits) of the best term within the allowed edits, or None.
    """

    def __init__(self, terms: list[tuple[str, bool, float]], remembered: int = 1 << 18):
        self.children: list[dict[str, int]] = [{}]
        self.closed: list[float] = [0.0]
        self.open: list[float] = [0.0]
        self.depth: list[int] = [0]
        for text, is_open, weight in terms:
            node = 0
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.closed.append(0.0)
                    self.open.append(0.0)
                    self.depth.append(self.depth[node] + 1)
                node = self.children[node][letter]
            values = self.open if is_open else self.closed
            values[node] = max(values[node], weight)
        self.remembered = remembered
        self.forget()

    def forget(self) -> None:
        """Start the tables anew; they only save work."""
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.verdicts: dict[str, tuple[float, int] | None] = {}
        self.start = self.number(self.close({(0, 0, "")}), None)

    def close(self, places: set[tuple[int, int, str]]) -> frozenset:
        """With the places reached by leaving out a letter of the term.  A place: node, edits, letter owed by a swap."""
        out = set(places)
        for node, edits, owed in places:
            if not edits and not owed and node:
                out.update((child, 1, "") for child in self.children[node].values())
        return frozenset(out)

    def number(self, places: frozenset, best: tuple[float, int] | None) -> int:
        state = (places, best)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return self.numbers[state]

    def better(self, a: tuple[float, int] | None, b: tuple[float, int] | None) -> tuple[float, int] | None:
        """Fewer edits first, then the larger weight."""
        if a is None or b is None:
            return a or b
        return min(a, b, key=lambda x: (x[1], -x[0]))

    def step(self, state: int, letter: str) -> int:
        places, best = self.states[state]
        after = set()
        for node, edits, owed in places:
            children = self.children[node]
            if owed:
                if letter == owed:
                    after.add((node, edits, ""))
                continue
            if letter in children:
                after.add((children[letter], edits, ""))
            if not edits and node:
                after.add((node, 1, ""))
                for key, child in children.items():
                    after.add((child, 1, ""))
                    if letter in self.children[child] and key != letter:
                        after.add((self.children[child][letter], 1, key))
        after = self.close(after)
        for node, edits, owed in after:
            if not owed and self.open[node] and self.allowed(node, edits):
                best = self.better(best, (self.open[node], edits))
        return self.number(after, best)

    def allowed(self, node: int, edits: int) -> bool:
        return not edits or self.depth[node] >= FUZZY_FROM

    def find(self, word: str) -> tuple[float, int] | None:
        if word in self.verdicts:
            return self.verdicts[word]
        if len(self.verdicts) >= self.remembered or len(self.states) >= self.remembered:
            self.forget()
        state = self.start
        for letter in word:
            after = self.steps[state].get(letter)
            if after is None:
                after = self.steps[state][letter] = self.step(state, letter)
            state = after
            if not self.states[state][0]:
                break
        places, best = self.states[state]
        for node, edits, owed in places:
            if not owed and self.closed[node] and self.allowed(node, edits):
                best = self.better(best, (self.closed[node], edits))
        self.verdicts[word] = best
        return best

    def inputs(self, text: str) -> list[float]:
        """The INPUTS of one text."""
        low = text.lower()
        found = WORDS.findall(low)
        hits = {w for w in set(found) if self.find(w)}
        if not hits:
            return [0.0] * (len(INPUTS) - 1) + [math.log1p(len(found))]
        spots = [(i, m) for i, m in enumerate(WORDS.finditer(low)) if m.group() in hits]
        sums, strongest, addressed, direct = [0.0] * 4, 0.0, 0.0, []
        for i, m in spots:
            weight, edits = self.find(m.group())
            quoted = self.quoted(low, m.start(), m.end(), found, i)
            sums[2 * quoted + (edits > 0)] += weight
            if not quoted:
                strongest = max(strongest, weight / (1 + edits))
                direct.append(i)
                addressed += any(w in ADDRESS for w in found[max(0, i - REACH) : i + REACH + 1])
        dense, left = 0, 0
        for right, i in enumerate(direct):
            while i - direct[left] > 4 * REACH:
                left += 1
            dense = max(dense, right - left + 1)
        return [*map(math.log1p, sums), strongest, math.log1p(dense), math.log1p(addressed), math.log1p(len(found))]

    @staticmethod
    def quoted(text: str, start: int, end: int, found: list[str], i: int) -> bool:
        """Whether a hit stands between quotation marks nearby, or up to three words after a word of reporting."""
        before, after = text[max(0, start - 10 * REACH) : start], text[end : end + 10 * REACH]
        before = before[before.rfind("\n") + 1 :]
        after = after.split("\n", 1)[0]
        marks = sum(before.count(q) for q in QUOTES)
        if marks % 2 and any(q in after for q in QUOTES):
            return True
        return any(w in REPORTING for w in found[max(0, i - 3) : i])


def learn_terms(worded: DataFrame) -> list[tuple[str, bool, float]]:
    """The lexicon from (words array, label): all significant terms, the most significant first.

    Each term stands in three or more of the documents that it is learnt from, whose number is bounded.

    Documents are counted per word, then per stem over its words.  A term is kept if it is LEAST_LIFT times likelier
    in toxic documents and significant by the likelihood ratio; a stem whose longer form says as much is dropped.
    """
    totals = worded.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t")).first()
    n, t = totals["n"], totals["t"] or 0.0
    if not t or t == n:
        return []
    counts = worded.select(F.explode("words").alias("word"), "label").groupBy("word").agg(
        F.sum("label").alias("hit"), F.count(F.lit(1)).alias("seen")
    )
    sizes = F.sequence(F.lit(STEM[0]), F.least(F.length("word"), F.lit(STEM[1])))
    stems = counts.filter(F.length("word") >= STEM[0]).select(
        F.explode(F.transform(sizes, lambda k: F.substring(F.col("word"), F.lit(1), k))).alias("term"), F.lit(True).alias("open"), "hit", "seen"
    )
    both = counts.select(F.col("word").alias("term"), F.lit(False).alias("open"), "hit", "seen").filter(F.length("term") >= 3).union(stems)
    both = both.groupBy("term", "open").agg(F.sum("hit").alias("hit"), F.sum("seen").alias("seen"))
    lift = ((F.col("hit") + 0.25) / t) / ((F.col("seen") - F.col("hit") + 0.25) / (n - t))
    sure = 2 * F.col("hit") * F.log(F.col("hit") / F.col("seen") / F.lit(t / n))
    chosen = both.filter((F.col("hit") >= 3) & (lift >= LEAST_LIFT)).withColumn("lift", F.log(lift)).withColumn("sure", sure)
    chosen = chosen.filter(F.col("sure") >= LEAST_SIGNIFICANCE).orderBy(F.desc("sure"), "term", "open").collect()
    hits = {(r["term"], r["open"]): r["hit"] for r in chosen}
    longer: dict[str, float] = {}
    for (term, is_open), hit in hits.items():
        above = term[:-1] if is_open else term
        longer[above] = max(longer.get(above, 0.0), hit)
    return [(r["term"], r["open"], r["lift"]) for r in chosen if not (r["open"] and longer.get(r["term"], 0.0) >= 0.9 * r["hit"])]


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 60) -> tuple[float, np.ndarray]:
    """Intercept and weights by Newton's method; classes count equally.  Without both classes, a constant."""
    if not len(y) or y.min() == y.max():
        mean = (y.sum() + 0.5) / (len(y) + 1.0)
        return float(np.log(mean / (1 - mean))), np.zeros(x.shape[1])
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    z = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(z.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[0, 0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (share * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), w[1:]


def toxicity(
    docs: DataFrame, labels: DataFrame, ident: str = "doc_id", parts: int = 3, part: int = 1, threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(ident, held_out, score, predicted): one row per input row; a score near 1 means toxic.

    Lexicon and weights are learnt from about ``sample_rows`` labelled rows at most, none held out (crc32 of the ident
    modulo ``parts`` is ``part``).  Several labels of one ident count as the largest; null labels don't count.  Null and
    empty texts have no hits and score like any text without.  Without labels every score is 0.5; an empty table
    gives no rows.  Ident, language and source are never inputs; other columns are ignored.
    """
    # Bounded by sample_rows, so it may be sent to every task; texts of other rows stay where they are.
    chosen = F.broadcast(training_labels(labels, "toxic", ident, parts, part, sample_rows))
    # Of the rows of one ident, that with the smallest hash of its text; so the sample is bounded and doesn't depend on order.
    sample = docs.select(ident, "text").join(chosen, ident).groupBy(ident).agg(F.max("label").alias("label"), F.min_by(F.coalesce("text", F.lit("")), text_key()).alias("text"))
    sample = stored(sample.select("label", clear_text()), "toxicity-sample")
    worded = per_row(sample, [F.col("text")], lambda: lambda text: (sorted(set(words(text))),), "words array<string>", ["label"])
    terms = learn_terms(worded)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(terms)

    def make_inputs():
        lexicon = Lexicon(shared.value)
        return lambda text: (lexicon.inputs(text),)

    rows = per_row(sample, [F.col("text")], make_inputs, "x array<double>", ["label"]).collect()
    rows = sorted((r["x"], r["label"]) for r in rows)
    model = fit_logistic(np.array([r[0] for r in rows]).reshape(-1, len(INPUTS)), np.array([r[1] for r in rows]))
    fitted = context.broadcast(model)

    def make_scores():
        lexicon = Lexicon(shared.value)
        intercept, weights = fitted.value
        flat = [float(w) for w in weights]

        def score(text: str) -> tuple[float]:
            margin = intercept + sum(a * b for a, b in zip(flat, lexicon.inputs(text)))
            return (1 / (1 + math.exp(-min(max(margin, -30.0), 30.0))),)

        return score

    scored = per_row(docs, [clear_text()], make_scores, "score double", [ident])
    return scored.select(
        ident, held_out(ident, parts, part).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
