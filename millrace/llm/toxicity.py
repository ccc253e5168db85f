"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding keeps one character per character: case, accents, look-alike letters
of other scripts, full-width forms and digit substitutions go to a-z; joiners
and soft hyphens are removed.  Matches must stand as whole words.  A match
inside an exception phrase does not count.  Weighted matches are counted, and
normalised by the number of words; a logistic model of both, fitted on a
bounded sample of labelled rows, gives the score.

The lexicon starts from a fixed list.  Words, and beginnings that families of
inflected words share, are learned from the sample and weighted by their
log-odds; each must hold in both halves of the sample, so that chance entries
fall out, and needs a fixed number of toxic texts, not a share, so that rare
languages count.  A beginning matches at the start of a longer word.

A null or empty text has no matches and gets the score of such texts.  A long
text is scored whole.  Repeated rows get equal scores; a score equal to the
threshold is toxic.  An empty table gives an empty result; without labelled
rows the fixed list is used with fixed coefficients.  Other columns, whatever
their names, are not read and are passed through unchanged.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_rows
from .kernels import let_go
from .language import held_out

# Insults, phrases that hold one innocently, look-alikes, digit and sign substitutions.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers clown clowns pathetic worthless disgusting imbecile dumbass bastard bastards vermin filth degenerate cretin".split()
EXCEPTIONS = ("clown fish", "clown fishes", "trash can", "trash cans", "trash bin", "trash bag", "trash bags", "trash collection", "recycle trash", "circus clown", "class clown", "pond scum", "idiot proof", "sore loser rule", "worthless currency", "not stupid", "not worthless", "not an idiot")
LOOKALIKES = dict(zip("асеорхуіјѕһԁɡǀοαερτυνικаıɑԛԝ", "aceopxyijshdgloaeptuvikaiaqw"))
DIGITS = dict(zip("01345789", "oieastbg"))
SIGNS = {"@": "a", "$": "s"}


def _folding() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for c in range(0xA0, 0x2100):
        base = unicodedata.normalize("NFKD", chr(c)).lower()
        if base and "a" <= base[0] <= "z" and all(unicodedata.combining(x) for x in base[1:]):
            table[c] = base[0]
    for c in range(0xFF21, 0xFF5B):
        base = unicodedata.normalize("NFKC", chr(c)).lower()
        if "a" <= base <= "z":
            table[c] = base
    for a, b in LOOKALIKES.items():
        table[ord(a)] = table[ord(a.upper()[0])] = b
    for c in range(65, 91):
        table[c] = chr(c + 32)
    for a, b in DIGITS.items():
        table[ord(a)] = b
    table.update(dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)]))
    return table


_FOLD = _folding()
_ASCII = bytes(ord(_FOLD.get(c) or chr(c)) for c in range(128)) + bytes(range(128, 256))
_SIGN = re.compile(r"(?<=\w)[@$](?=\w)|(?<!\S)[@$](?=\w)")


def fold(text: str) -> str:
    """The text in the form that is matched."""
    if "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text.encode().translate(_ASCII).decode() if text.isascii() else text.translate(_FOLD)


class Matcher:
    """Finds lexicon words that stand alone, and words with a lexicon beginning, outside exception phrases.

    A word counts once, with the greatest weight of its entries.
    """

    def __init__(self, weights: dict[str, float], exceptions: Iterable[str], beginnings: dict[str, float] | None = None) -> None:
        import ahocorasick

        entries: dict[str, list[float | None]] = {}  # weight as a word, as a beginning, and whether it is an exception
        for given, slot in ((weights, 0), (beginnings or {}, 1)):
            for word, weight in given.items():
                entries.setdefault(fold(word), [None, None, None])[slot] = weight
        for phrase in exceptions:
            entries.setdefault(fold(phrase), [None, None, None])[2] = 1.0
        self.automaton = ahocorasick.Automaton()
        for word, kinds in entries.items():
            self.automaton.add_word(word, (len(word), *kinds))
        self.automaton.make_automaton()

    def find(self, text: str) -> tuple[float, int]:
        """Sum of weights, and number, of the matches in a folded text."""
        hits: dict[int, tuple[int, float]] = {}  # by start: end and weight
        shields = []
        for last, (size, word, beginning, exception) in self.automaton.iter(text):
            start, end = last - size + 1, last + 1
            if start and text[start - 1].isalnum():
                continue
            ends = end == len(text) or not text[end].isalnum()
            weight = word if ends else beginning
            if weight is not None and (start not in hits or hits[start][1] < weight):
                hits[start] = (end, weight)
            if ends and exception is not None and word is None:
                shields.append((start, end))
        kept, shields, at, reach = [], sorted(shields), 0, 0
        for start in sorted(hits):
            while at < len(shields) and shields[at][0] <= start:  # the farthest end of all phrases that begin by here
                reach = max(reach, shields[at][1])
                at += 1
            if hits[start][0] > reach:
                kept.append(hits[start][1])
        return sum(kept), len(kept)


@dataclass
class ToxicityModel:
    """Weights of words and of beginnings, and the logistic coefficients (bias, log count, density)."""

    weights: dict[str, float]
    coefficients: list[float]
    beginnings: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    matcher: Matcher | None = field(default=None, repr=False)

    def features(self, text: str | None) -> list[float]:
        if self.matcher is None:
            self.matcher = Matcher(self.weights, self.exceptions, self.beginnings)
        folded = fold(text or "")
        total, _ = self.matcher.find(folded)
        return self.shape(total, folded)

    @staticmethod
    def shape(total: float, folded: str) -> list[float]:
        words = max(1, folded.count(" ") + folded.count("\n") + 1)
        return [1.0, math.log1p(total), math.log1p(100 * total / words)]

    def score(self, text: str | None) -> float:
        z = sum(c * x for c, x in zip(self.coefficients, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"matcher": None}


_WORD = re.compile(r"[^\W\d_]{3,}")
#: Letters of a learned beginning, and what an entry needs: toxic texts in each half of the sample, times as frequent
#: in toxic texts, and standard errors of its log-odds above 0; a beginning also needs that many forms.
LETTERS, LEAST_TEXTS, LEAST_ODDS, LEAST_ERRORS, LEAST_FORMS = (4, 10), 3, 8.0, 3.0, 4


def _weight(odds: float) -> float:
    return min(2.0, max(0.25, math.log(max(odds, 1.0)) / math.log(100)))


def _learned(halves: list[list[tuple[list[str], int]]], entries: Callable[[str], Iterable[str]]) -> dict[str, float]:
    """Entries that stand much more often in toxic texts, in every half, with their least odds."""
    odds: dict[str, float] = {}
    for nth, half in enumerate(halves):
        times, texts, total = (Counter(), Counter()), Counter(), [1, 1]
        for words, label in half:
            found = Counter(e for w in words for e in entries(w))
            times[label].update(found)
            total[label] += len(words)
            if label:
                texts.update(found.keys())
        now = {}
        for entry, n in texts.items():
            if n >= LEAST_TEXTS and (nth == 0 or entry in odds):
                often, seldom = times[1][entry] + 0.5, times[0][entry] + 0.5
                ratio = (often / total[1]) / (seldom / total[0])
                # Repeats within a text are no further evidence: the error goes by texts.
                if ratio >= LEAST_ODDS and math.log(ratio) >= LEAST_ERRORS * math.sqrt(1 / n + 1 / max(seldom, n / ratio)):
                    now[entry] = min(ratio, odds.get(entry, ratio))
        odds = now
    return odds


def _starts(word: str) -> Iterator[str]:
    """Beginnings of a word, shorter than the word."""
    return (word[:k] for k in range(LETTERS[0], min(LETTERS[1], len(word) - 1) + 1))


def lexicon(texts: list[list[str]], toxic: list[int]) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of the words and of the beginnings, from the words of labelled texts."""
    halves = [list(zip(texts, toxic))[k::2] for k in (0, 1)]
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for words, label in zip(texts, toxic):
        seen[label].update(set(words))
    many = {k: max(1, sum(1 for x in toxic if x == k)) for k in (0, 1)}
    weights = {w: _weight(odds) for w, odds in _learned(halves, lambda w: (w,)).items()}
    for word in INSULTS:
        if seen[1][word] + seen[0][word] < 10:
            weights[word] = 1.0
        elif (ratio := ((seen[1][word] + 0.5) / many[1]) / ((seen[0][word] + 0.5) / many[0])) > 2:
            weights[word] = _weight(ratio)
    # What the words cover already tells nothing of beginnings.
    halves = [[([w for w in words if w not in weights], label) for words, label in half] for half in halves]
    forms: dict[str, set[str]] = {}
    for half in halves:
        for words, label in half:
            for word in set(words) if label else ():
                for start in _starts(word):
                    forms.setdefault(start, set()).add(word)
    found = {s: odds for s, odds in _learned(halves, _starts).items() if len(forms[s]) >= LEAST_FORMS}
    beginnings: dict[str, float] = {}
    for start in sorted(found, key=lambda s: (-found[s] * len(forms[s]), s)):  # of nested ones the best stays
        if not any(start.startswith(b) or b.startswith(start) for b in beginnings):
            beginnings[start] = _weight(found[start])
    return weights, beginnings


def learn(texts: list[str], toxic: list[int]) -> ToxicityModel:
    """Lexicon and coefficients from labelled texts."""
    weights, beginnings = lexicon([_WORD.findall(fold(t)) for t in texts], toxic)
    model = ToxicityModel(weights, [-3.0, 3.0, 1.0], beginnings)
    y = np.array(toxic, float)
    if len(set(toxic)) == 2:
        x = np.array([model.features(t) for t in texts])
        c = np.array(model.coefficients)
        for _ in range(50):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
            grad = x.T @ (p - y) + 0.1 * c
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), grad)
            c = c - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        c[1:] = np.maximum(c[1:], 0)
        model.coefficients = [float(v) for v in c]
    return model


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, sample_chars: int = 20_000, text: str = "text", key: str = "doc_id", label: str = "toxic") -> ToxicityModel:
    """Learn from at most ``sample_rows`` labelled documents, hash-ordered, outside the held-out fold."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("doc_id")).agg(F.max(label).alias("label"))
    picked = F.broadcast(known.orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(sample_rows))  # bounded by the limit
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where(F.length("text") <= sample_chars)
    got = rows.join(picked, "doc_id").select("text", "label").orderBy(F.xxhash64("text"), "text").limit(sample_rows).collect()
    return learn([r["text"] for r in got], [int(r["label"] > 0) for r in got])


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            scores = np.array([model.score(t.as_py()) for t in batch.column(2)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; rows are tested where they are read."""
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            keep = pa.array([model.score(t.as_py()) < threshold for t in batch.column(0).field(at)], pa.bool_())
            yield batch.filter(keep)

    return as_rows(docs).mapInArrow(run, T.StructType([T.StructField("row", docs.schema)])).select("row.*")
