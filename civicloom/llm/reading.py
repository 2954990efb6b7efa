"""How demanding a text is to read: a pairwise ranker over syntax and vocabulary, calibrated to grades."""

from __future__ import annotations

import math
import re
import string
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.session import stage

#: Rated documents the ranker is fitted on at most (the least hashes of their ids), and pairs of them.
MAX_RATED, MAX_PAIRS = 20_000, 200_000
#: Rated documents a word of the graded vocabulary must occur in.
LEAST_DOCS = 3
#: An ending is a footer if it surely closes more than this share of the texts: its count less so many of its standard
#: deviations. As a rule on the share it means the same in a corpus of any size.
ENDING_SHARE, SURELY = 0.005, 2.0
#: What ends a text besides its letters.
_BLANKS = " \t\r\n\v\f"
#: Words of a heading in capitals at most, and the share of lower-case letters under which a sentence is in capitals.
HEADING_WORDS, LOWER_SHARE = 12, 0.1

_LINES = re.compile("[\r\n\v\f\x85" + chr(0x2028) + chr(0x2029) + "]+")
_SENTENCE = re.compile(r"[.!?][\"')\]]*\s+(?=[\"'(\[]*[A-Z0-9])")
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
_ASCII_WORD = re.compile(r"[A-Za-z]+(?:[-'][A-Za-z]+)*")
_MARKED = re.compile(r"^\s*(?:[*•\-–—+o·▪]\s|\d+[.)]\s|\|)")
_VOWELS = re.compile(r"[aeiouy]+")
_LOWER, _UPPER = string.ascii_lowercase.encode(), string.ascii_uppercase.encode()


_ODD = re.compile(r"[^\x00-\x7f]+")


def _undamaged(m: re.Match[str]) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", m.group()) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")


def plain(text: str) -> str:
    """The text without marks of damage: compatibility forms and accents undone, format characters gone."""
    return text if text.isascii() else _ODD.sub(_undamaged, text)


def ending_key(sentence: str) -> str:
    """What makes two endings one: letters only, in lower case."""
    return re.sub(r"[^a-z]", "", sentence.lower())


def in_capitals(text: str) -> bool:
    """Whether hardly any of the letters are in lower case (a text without letters has none)."""
    if text.isascii():
        raw = text.encode()
        low, high = len(raw) - len(raw.translate(None, _LOWER)), len(raw) - len(raw.translate(None, _UPPER))
    else:
        low, high = sum(map(str.islower, text)), sum(map(str.isupper, text))
    return low <= LOWER_SHARE * (low + high)


def sentences_of(text: str, endings: frozenset[str]) -> list[list[str]]:
    """The words of each sentence of the running text: no list items, table rows, headings or footers.

    A line belongs to the running text if it ends like a sentence, has more than three words and isn't a heading
    in capitals: a short one beside running text in mixed case. If nothing is left, the whole text counts.
    """
    lines = [x.strip() for x in _LINES.split(plain(text))]
    prose = [x for x in lines if len(x.split()) > 3 and not _MARKED.match(x) and x.rstrip("\"')]").endswith((".", "!", "?"))]
    if any(map(in_capitals, prose)) and any(not in_capitals(x) and ending_key(x) not in endings for x in prose):
        prose = [x for x in prose if len(x.split()) > HEADING_WORDS or not in_capitals(x)]
    while prose and ending_key(prose[-1]) in endings:
        prose.pop()
    found = [s for x in prose for s in _SENTENCE.split(x)]
    while found and (ending_key(found[-1]) in endings or ending_key("".join(found[-2:])) in endings):
        del found[-1 if ending_key(found[-1]) in endings else -2 :]
    if not found:
        found = [s for x in lines for s in _SENTENCE.split(x)]
    pattern = _ASCII_WORD if text.isascii() else _WORD
    return [w for s in found if (w := pattern.findall(s))]


def counted(sentence: list[str]) -> list[str]:
    """The words that aren't names, as far as their capitals tell; in a sentence in capitals they tell nothing, so all count."""
    plainly = [w for i, w in enumerate(sentence) if i == 0 or w[0].islower()]
    return plainly if 2 * len(plainly) > len(sentence) or not in_capitals("".join(sentence)) else sentence


class Words(dict):
    """What is known of a word: (length, syllables, itself in lower case, sum of grades, documents).

    Filled as words are met; it starts afresh beyond ``MEMO`` words, so its size is bounded.
    """

    MEMO = 300_000

    def __init__(self, book: dict[str, tuple[float, int]]) -> None:
        super().__init__()
        self.book = book

    def __missing__(self, word: str) -> tuple[int, int, str, float, int]:
        if len(self) >= self.MEMO:
            self.clear()
        low = word.lower()
        found = self[word] = (len(word), len(_VOWELS.findall(low)), low, *self.book.get(low, (0.0, 0)))
        return found


def features(text: str, endings: frozenset[str], words: Words, mean: float, own: float | None = None) -> list[float]:
    """Syntax and vocabulary features of one text. ``own`` is its own grade, taken out of the vocabulary's."""
    sentences = sentences_of(text, endings)
    known = [words[w] for s in sentences for w in counted(s)]
    if not known:
        return [0.0] * N_FEATURES
    n, k = len(known), len(sentences)
    if own is None:
        grades = sorted((g + mean) / (docs + 1) for _, _, _, g, docs in known if docs)
    else:
        grades = sorted((g - own + mean) / docs for _, _, _, g, docs in known if docs > 1)
    m = len(grades)
    sizes = [f[0] for f in known]
    spans = sorted(map(len, sentences))
    return [
        sum(grades) / m if m else mean,
        grades[int(0.8 * (m - 1))] if m else mean,
        grades[int(0.3 * (m - 1))] if m else mean,
        sum(sizes) / n,
        sum([x >= 8 for x in sizes]) / n,
        sum([x >= 11 for x in sizes]) / n,
        sum([x <= 4 for x in sizes]) / n,
        sum([f[1] for f in known]) / n,
        float(spans[k // 2]),
        math.log1p(sum(spans) / k),
        sum([x >= 25 for x in spans]) / k,
        len({f[2] for f in known}) / n**0.5,
    ]


N_FEATURES = 12


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step function closest to y (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    means: list[float] = []
    weights: list[float] = []
    left: list[float] = []
    right: list[float] = []
    for i in order:
        means.append(float(y[i])), weights.append(float(w[i])), left.append(float(x[i])), right.append(float(x[i]))
        while len(means) > 1 and means[-2] >= means[-1]:
            total = weights[-2] + weights[-1]
            means[-2] = (means[-2] * weights[-2] + means[-1] * weights[-1]) / total
            weights[-2], right[-2] = total, right[-1]
            means.pop(), weights.pop(), left.pop(), right.pop()
    return np.array([v for a, b in zip(left, right) for v in (a, b)]), np.repeat(np.array(means), 2)


@dataclass
class Reader:
    """A fitted ranker with its calibration."""

    endings: frozenset[str]
    book: dict[str, tuple[float, int]]
    mean: float
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.centre) / self.scale @ self.weights

    def level(self, scores: np.ndarray) -> np.ndarray:
        return np.interp(scores, self.knots, self.levels) if len(self.knots) else np.full(len(scores), self.mean)


def rank_weights(rows: np.ndarray, grades: np.ndarray, least: float = 1.0, pairs: int = MAX_PAIRS, l2: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weights of a linear ranker: logistic regression on the differences of pairs whose grades differ."""
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, len(rows), pairs), rng.integers(0, len(rows), pairs)
    apart = grades[a] - grades[b]
    keep = np.abs(apart) >= least
    if not keep.any():
        return np.zeros(rows.shape[1])
    d = (rows[a] - rows[b])[keep] * np.sign(apart[keep])[:, None]
    w = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = d.T @ p / len(d) - l2 * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + l2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, gradient)
    return w


def frequent_endings(docs: DataFrame, text: str) -> frozenset[str]:
    """Ends of texts that close so many of them that they are footers; at most 3 / ENDING_SHARE of them.

    The ends of a text are its last line, last sentence and last two sentences, letters only. Each step is a projection
    of its own, so that none is computed again for each of the three.
    """
    lined = docs.select(F.rtrim(F.col(text), F.lit(_BLANKS)).alias("t")).filter("t <> ''")
    last = lined.select(F.substring_index(F.substring_index("t", "\n", -1), "\r", -1).alias("line"))
    cut = last.select(F.split("line", r"(?<=[.!?\])])\s++(?=[A-Z(])", -1).alias("p")).select(F.element_at("p", -1).alias("s"), F.try_element_at("p", F.lit(-2)).alias("r"), F.array_join(F.slice("p", 1, F.greatest(F.size("p") - 2, F.lit(0))), " ").alias("q"))
    letters = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z]++", ""))
    known = cut.select(letters("s").alias("s"), F.coalesce(letters("r"), F.lit("")).alias("r"), letters("q").alias("q"))
    ends = F.array_distinct(F.array("s", F.concat("r", "s"), F.concat("q", "r", "s"), F.lit("#")))
    counts = known.select(F.explode(ends).alias("e")).groupBy("e").agg(F.count("*").alias("n"))
    # Each text has three ends and one "#", so what a share of the texts ends with is among the first few.
    rows = {r["e"]: r["n"] for r in counts.orderBy(F.desc("n"), "e").limit(1 + math.ceil(3 / ENDING_SHARE)).collect()}
    least = ENDING_SHARE * rows.pop("#", 0)
    return frozenset(e for e, n in rows.items() if e and n - SURELY * n**0.5 >= least)


def _words_of(docs: DataFrame, endings: frozenset[str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(w, g) for t, g in zip(batch["text"], batch["grade"]) for w in {x.lower() for s in sentences_of(t, endings) for x in counted(s)}]
            yield pd.DataFrame(out, columns=["word", "grade"])

    return docs.select("text", "grade").mapInPandas(run, "word string, grade double")


def fit(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", max_rated: int = MAX_RATED) -> Reader:
    """A reader from rated documents. A document's grade is the mean of its ratings; null ratings don't count.

    The ranker is fitted on at most ``max_rated`` rated documents, a documented bound; the footers
    are counted over all documents. Without ratings every text gets the level 0.
    """
    endings = frequent_endings(docs.select(text), text)
    rated = ratings.filter(F.col(grade).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.avg(grade).alias("grade"), F.count("*").cast("int").alias("n"))
    rated = rated.orderBy(F.xxhash64("_k"), "_k").limit(max_rated)
    rated = stage(rated, "rated")
    sample = stage(docs.select(F.col(key).alias("_k"), F.col(text).alias("text")).join(F.broadcast(rated), "_k").filter(F.length(F.trim("text")) > 0), "sample")
    book_rows = _words_of(sample, endings).groupBy("word").agg(F.sum("grade").alias("g"), F.count("*").alias("n")).filter(F.col("n") >= LEAST_DOCS).collect()
    book = {r["word"]: (r["g"], r["n"]) for r in book_rows}  # of the rated sample, so as bounded as it
    mean = rated.agg(F.avg("grade")).first()[0] or 0.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(book)
        for batch in batches:
            rows = [features(t, endings, words, mean, g) for t, g in zip(batch["text"], batch["grade"])]
            yield pd.DataFrame({"k": batch["_k"], "grade": batch["grade"], "n": batch["n"], "f": rows})

    kind = sample.schema["_k"].dataType.simpleString()
    got = sample.mapInPandas(run, f"k {kind}, grade double, n int, f array<double>").orderBy("k").collect()
    none = np.zeros(N_FEATURES)
    if not got:
        return Reader(endings, book, mean, none, none + 1, none, np.array([]), np.array([]))
    rows, grades, n = np.array([r["f"] for r in got]), np.array([r["grade"] for r in got]), np.array([r["n"] for r in got], dtype=float)
    centre, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-6)
    weights = rank_weights((rows - centre) / scale, grades)
    reader = Reader(endings, book, mean, centre, scale, weights, none, none)
    reader.knots, reader.levels = isotonic(reader.score(rows), grades, n)
    return reader


def reading_levels(docs: DataFrame, reader: Reader, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, score, level) of each text that has a word; others have none. No shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = Words(reader.book)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            words = [len(t.split()) for t in texts]
            rows = np.array([features(t, reader.endings, book, reader.mean) if n else [0.0] * N_FEATURES for t, n in zip(texts, words)]).reshape(len(texts), N_FEATURES)
            scores = reader.score(rows)
            yield pd.DataFrame({"key": batch["key"], "n_words": words, "score": scores, "level": reader.level(scores)}).loc[np.array(words, dtype=int) > 0]

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"key {kind}, n_words int, score double, level double")
