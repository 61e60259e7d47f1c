"""Problem 10: a score for abusive, hateful or sexual passages, and the rate per source.

Method: counterfactual-regularised classifier.  A linear model over hashed words and word pairs of single sentences
is fitted to labelled documents; a document counts by its worst sentence (multiple-instance learning).  In
sentences that name a group, the group's name is swapped for others, and the squared change of the score is part of
the loss, so that naming a group does not make a sentence abusive.

Identity terms are rows of names that may stand for one another: those given (``identity_terms``, by default common
names of peoples, faiths and other groups) and those found in the labelled texts.  The latter are the words or short
phrases that fill one place of sentences a first model scores high, alike but for that place, and that clean
documents name too; so a corpus with its own names needs no list.

Before that, disguises are undone: look-alikes and hidden characters, letters set apart by dots, dashes or blanks,
digits and signs that stand for letters, drawn-out letters, and one letter masked by ``*`` or ``#``.

The fit reads at most ``max_labelled`` labelled documents of at most ``max_chars`` characters together (documented
bounds; a hash order decides which), the model has a fixed size, and the scoring covers every document.  Null and
empty texts score 0.  Several labels of one document are averaged; null labels and ties are left out.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postweave.llm.canon import _fold, transducer

BITS = 18
# Names of groups that may stand for one another, with neutral ones, per language and case.
IDENTITY_TERMS = (
    ("русские", "украинцы", "сербы", "албанцы", "цыгане", "евреи", "мусульмане", "христиане", "мигранты", "беженцы", "геи", "женщины", "мужчины", "соседи", "студенты", "туристы"),
    ("русских", "украинцев", "сербов", "албанцев", "цыган", "евреев", "мусульман", "христиан", "мигрантов", "беженцев", "геев", "женщин", "мужчин", "соседей", "студентов", "туристов"),
    ("rusi", "ukrajinci", "srbi", "albanci", "romi", "jevreji", "muslimani", "hrišćani", "migranti", "izbeglice", "gejevi", "žene", "muškarci", "komšije", "studenti", "turisti"),
    ("russians", "ukrainians", "serbs", "albanians", "roma", "jews", "muslims", "christians", "migrants", "refugees", "gays", "women", "men", "neighbours", "students", "tourists"),
)
# Signs that stand for a letter inside a word.
SIGNS = {"@": "a", "0": "o", "3": "e", "6": "б", "$": "s", "1": "i"}

_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
_APART = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_]){2,}[^\W\d_](?!\w)")
_TOKEN = re.compile(r"[^\W_]+(?:[*#@$][^\W_]+)*[*#@$]?|[*#@$][^\W_]+")
_DRAWN = re.compile(r"(.)\1+")
_MIXED = re.compile(r"[^\W\d_]")
_SIGNED = re.compile("[@0361$]")
_LETTERS = str.maketrans(SIGNS)


Term = tuple[str, ...]


class Words:
    """Text to sentences of plain words."""

    def __init__(self, vocabulary: Iterable[str] = ()) -> None:
        fold = dict(_fold())
        fold.update({ord(c): "u" for c in "иИйЙ"})
        self.fold = fold
        self.canon = transducer()
        self.known = set(vocabulary)
        self.masked: dict[str, str] = {}
        for w in sorted(self.known, key=lambda w: (-len(w), w)):
            if len(w) > 2:
                for i in range(len(w)):
                    self.masked.setdefault(w[:i] + "*" + w[i + 1 :], w)
        self.plain: dict[str, str] = {}

    def _word(self, raw: str) -> str:
        got = self.plain.get(raw)
        if got is None:
            w = raw
            if w.isdigit():
                return "0"
            if _MIXED.search(w) and _SIGNED.search(w):
                w = w.translate(_LETTERS)
            w = _DRAWN.sub(r"\1", self.canon(w).translate(self.fold).replace("#", "*"))
            if "*" in w:
                w = self.masked.get(w, w.replace("*", ""))
            got = w
            if len(self.plain) < 400_000:
                self.plain[raw] = got
        return got

    def _joined(self, m: re.Match[str]) -> str:
        w = re.sub(r"[ .\-_]", "", m.group())
        plain = self._word(w)
        if self.known and plain not in self.known:
            # A word of one letter before or after may have been drawn in.
            for a, b in ((0, 1), (1, 0), (1, 1)):
                if self._word(w[a : len(w) - b]) in self.known:
                    return f"{w[:a]} {w[a : len(w) - b]} {w[len(w) - b :]}"
        return w

    def split(self, text: str | None) -> list[str]:
        """The sentences of a text in canonical letters."""
        return [s for s in _SENTENCE.split(self.canon(text)) if s] if text else []

    def words(self, sentence: str) -> list[str]:
        if _APART.search(sentence):
            sentence = _APART.sub(self._joined, sentence)
        return [self._word(w) for w in _TOKEN.findall(sentence)]

    def sentences(self, text: str | None) -> list[list[str]]:
        return [ws for s in self.split(text) if (ws := self.words(s))]


class Features:
    """Hashed words, word stems and pairs of neighbours."""

    def __init__(self) -> None:
        self.ids: dict[str, tuple[int, int]] = {}
        self.mask = (1 << BITS) - 1

    def _id(self, w: str) -> tuple[int, int]:
        got = self.ids.get(w)
        if got is None:
            b = w.encode("utf-8", "surrogatepass")
            got = (zlib.crc32(b), zlib.crc32(b"~" + w[:5].encode("utf-8", "surrogatepass")))
            if len(self.ids) < 400_000:
                self.ids[w] = got
        return got

    def rows(self, sentences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(feature index, row start) of the sentences."""
        flat = [self._id(w) for s in sentences for w in s]
        both = np.array(flat, dtype=np.uint64).reshape(-1, 2)
        n = np.array([len(s) for s in sentences], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
        word, stem = both[:, 0], both[:, 1]
        before = np.concatenate([[np.uint64(7)], word[:-1]])
        before[first] = np.uint64(7)
        pair = (before * np.uint64(0x9E3779B97F4A7C15) + word * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITS)
        m = np.uint64(self.mask)
        idx = np.stack([word & m, (stem >> np.uint64(3)) & m, pair], axis=1).reshape(-1).astype(np.int64)
        return idx, first * 3


def _scores(w: np.ndarray, bias: float, idx: np.ndarray, start: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.empty(0)
    n = np.diff(np.append(start, len(idx)))
    return np.add.reduceat(w[idx], start) / np.sqrt(n) + bias


class Rows:
    """Sentences by those of their features that are learned, weighed by the number of all."""

    def __init__(self, idx: np.ndarray, start: np.ndarray, place: np.ndarray) -> None:
        n = np.diff(np.append(start, len(idx)))
        row, at = np.repeat(np.arange(len(start)), n), place[idx] if len(idx) else idx
        keep = at >= 0
        self.at, self.row, self.size = at[keep], row[keep], len(start)
        self.share = (1 / np.sqrt(n))[self.row]

    def scores(self, w: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.at] * self.share, minlength=self.size) + bias

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, weights=g[self.row] * self.share, minlength=size)


class Fit:
    """Logistic regression by Adam over all rows, with the counterfactual term."""

    def __init__(self, idx: np.ndarray, start: np.ndarray, twin_of: np.ndarray, twin_idx: np.ndarray, twin_start: np.ndarray, strength: float) -> None:
        # A feature of fewer than three different sentences says nothing about others (mostly names).
        self.kept = np.flatnonzero(np.bincount(idx, minlength=1 << BITS) >= 3)
        place = np.full(1 << BITS, -1, dtype=np.int64)
        place[self.kept] = np.arange(len(self.kept))
        self.rows, self.twins = Rows(idx, start, place), Rows(twin_idx, twin_start, place)
        self.twin_of, self.strength = twin_of, strength
        self.w, self.bias = np.zeros(len(self.kept)), 0.0

    def scores(self) -> np.ndarray:
        return self.rows.scores(self.w, self.bias)

    def weights(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.kept] = self.w
        return out

    def run(self, y: np.ndarray, weight: np.ndarray, steps: int, rate: float = 0.3, decay: float = 1e-5) -> None:
        m, v = np.zeros_like(self.w), np.zeros_like(self.w)
        mb = vb = 0.0
        total, size = max(weight.sum(), 1e-9), len(self.w)
        for t in range(1, steps + 1):
            s = self.scores()
            g = weight * (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y) / total
            gr = g.copy()
            extra = None
            if len(self.twin_of):
                d = s[self.twin_of] - self.twins.scores(self.w, self.bias)
                q = self.strength * d / len(d)
                gr += np.bincount(self.twin_of, weights=q, minlength=len(gr))
                extra = self.twins.back(-q, size)
            gw = self.rows.back(gr, size) + decay * self.w
            if extra is not None:
                gw += extra
            gb = g.sum()
            m = 0.9 * m + 0.1 * gw
            v = 0.99 * v + 0.01 * gw * gw
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            self.w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
            self.bias -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-7)


class Model:
    """Weights, threshold and the words that masked ones are resolved to; of fixed size but for the word list (``keep_words``)."""

    def __init__(self, w: np.ndarray, bias: float, threshold: float, vocabulary: list[str], names: list[list[Term]] | None = None) -> None:
        self.w, self.bias, self.threshold, self.vocabulary, self.names = w.astype(np.float32), bias, threshold, vocabulary, names or []

    def dump(self) -> bytes:
        """The model as bytes that ``parse`` reads; no code is in them."""
        at = np.flatnonzero(self.w)
        head = {"bias": float(self.bias), "threshold": float(self.threshold), "vocabulary": self.vocabulary, "names": self.names, "at": at.tolist(), "w": self.w[at].tolist()}
        return zlib.compress(json.dumps(head, ensure_ascii=False).encode("utf-8", "surrogatepass"))

    @classmethod
    def parse(cls, data: bytes) -> Model:
        head = json.loads(zlib.decompress(data).decode("utf-8", "surrogatepass"))
        w = np.zeros(1 << BITS)
        w[np.array(head["at"], dtype=np.int64)] = head["w"]
        return cls(w, head["bias"], head["threshold"], head["vocabulary"], [[tuple(t) for t in row] for row in head["names"]])

    def score(self, words: Words, features: Features, texts: Iterable[str | None]) -> np.ndarray:
        """The worst sentence's probability per text."""
        per = [words.sentences(t) for t in texts]
        flat = [s for ss in per for s in ss]
        out = np.zeros(len(per))
        if flat:
            idx, start = features.rows(flat)
            s = _scores(self.w, self.bias, idx, start)
            np.maximum.at(p := np.full(len(per), -30.0), np.repeat(np.arange(len(per)), [len(ss) for ss in per]), s)
            out = np.where([bool(ss) for ss in per], 1 / (1 + np.exp(-np.clip(p, -30, 30))), 0.0)
        return out


def _named(terms: Iterable[Iterable[str]], words: Words) -> list[list[Term]]:
    return [list(dict.fromkeys(tuple(words._word(w) for w in n.split()) for n in row)) for row in terms]


def found_terms(high: list[list[str]], clean: Counter[Term], longest: int = 3, least: int = 2) -> list[list[Term]]:
    """Rows of terms that fill one place of sentences (``high``) alike but for it, and that clean documents name too.

    A term of a place takes at least two words beside it, and two terms are of one row if they share ``least`` places.
    """
    places: dict[tuple[Term, Term], set[Term]] = defaultdict(set)
    for s in {tuple(s) for s in high}:
        for i in range(len(s)):
            for n in range(1, longest + 1):
                if i + n <= len(s) and len(s) - n >= 2:
                    places[s[:i], s[i + n :]].add(s[i : i + n])
    alike: Counter[tuple[Term, Term]] = Counter()
    for fill in places.values():
        told = sorted((f for f in fill if clean[f] >= 3), key=lambda f: (-clean[f], f))
        # Of a place that anything fills, each with the one most named; it says little.
        alike.update((min(a, b), max(a, b)) for k, a in enumerate(told if len(told) <= 50 else told[:1]) for b in told[k + 1 :])
    root: dict[Term, Term] = {}

    def find(t: Term) -> Term:
        while root.setdefault(t, t) != t:
            t = root[t]
        return t

    for (a, b), n in sorted(alike.items()):
        if n >= least:
            root[find(b)] = find(a)
    rows: dict[Term, list[Term]] = defaultdict(list)
    for t in sorted(root):
        rows[find(t)].append(t)
    return [r for _, r in sorted(rows.items()) if len(r) > 1]


def _twins(unique: list[list[str]], names: list[list[Term]]) -> tuple[list[int], list[list[str]]]:
    """Sentences with a group's name, and the same with each other name of its row."""
    first = defaultdict(list)
    for row in names:
        for n in row:
            first[n[0]].append((n, row))
    of, swapped = [], []
    for k, s in enumerate(unique):
        for i, w in enumerate(s):
            for n, row in first.get(w, ()):
                if tuple(s[i : i + len(n)]) == n:
                    for other in row:
                        if other != n:
                            of.append(k)
                            swapped.append([*s[:i], *other, *s[i + len(n) :]])
    return of, swapped


def fit(rows: list[tuple[str, float]], strength: float = 0.5, keep_words: int = 50_000, rounds: int = 4, steps: int = 40, identity_terms: Iterable[Iterable[str]] = IDENTITY_TERMS) -> Model:
    """A model from (text, share of annotators who said abusive)."""
    raw = Words()
    count: Counter[str] = Counter()
    told = [raw.split(text) for text, _ in rows]
    for ss in told:
        count.update({w for s in ss for w in raw.words(s) if "*" not in w})
    vocabulary = [w for w, n in count.most_common(keep_words) if n > 2]
    words, features = Words(vocabulary), Features()
    index: dict[tuple[str, ...], int] = {}
    docs: list[np.ndarray] = []
    for ss in told:
        docs.append(np.array([index.setdefault(tuple(ws), len(index)) for s in ss if (ws := words.words(s))], dtype=np.int64))
    unique = [list(k) for k in index]
    if not unique:
        return Model(np.zeros(1 << BITS), -5.0, 0.5, vocabulary)
    idx, start = features.rows(unique)
    y_doc = np.array([r[1] > 0.5 for r in rows])
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(rows))])

    def train(use: np.ndarray, names: list[list[Term]], rounds: int = rounds) -> Fit:
        of, swapped = _twins(unique, names)
        t_idx, t_start = features.rows(swapped) if swapped else (np.empty(0, np.int64), np.empty(0, np.int64))
        f = Fit(idx, start, np.array(of, dtype=np.int64), t_idx, t_start, strength)
        worst = None
        for r in range(rounds):
            y, weight = np.zeros(len(unique)), np.zeros(len(unique))
            for d in np.flatnonzero(use):
                own = docs[d]
                if not len(own):
                    continue
                if not y_doc[d]:
                    # From the second round on, a clean label that contradicts the model flatly is not trusted.
                    if worst is None or worst[own].max() < 2.5:
                        weight[own] += 1.0
                elif worst is None:
                    y[own] += 1.0 / len(own)
                    weight[own] += 1.0 / len(own)
                else:
                    top = own[int(np.argmax(worst[own]))]
                    y[top] += 2.0
                    weight[top] += 2.0
            share = np.divide(y, weight, out=np.zeros_like(y), where=weight > 0)
            f.run(share, np.minimum(weight, 50.0), steps if r + 1 < rounds else 2 * steps)
            worst = f.scores()
        return f

    names = _named(identity_terms, words)
    first = train(~held, names, max(1, rounds // 2)).scores()
    high = [unique[k] for k in np.flatnonzero(first > 0)]
    wanted = {w for s in high for w in s}
    clean: Counter[Term] = Counter()
    for d in np.flatnonzero(~y_doc):
        terms = set()
        for k in docs[d]:
            if first[k] <= 0:
                s = unique[k]
                terms.update(tuple(s[i : i + n]) for i in range(len(s)) if s[i] in wanted for n in (1, 2, 3) if i + n <= len(s) and wanted.issuperset(s[i : i + n]))
        clean.update(terms)
    names += found_terms(high, clean)
    f = train(~held, names)
    s = f.scores()
    worst = np.array([s[d].max() if len(d) else -30.0 for d in docs])
    tried = []
    for cut in np.arange(-1.5, 0.51, 0.125):
        hit = worst[held] > cut
        tp = float((hit & y_doc[held]).sum())
        tried.append((2 * tp / max(1.0, float(hit.sum() + y_doc[held].sum())), float(cut)))
    # Of the cuts as good as the best but for wrong labels, the one nearest to the middle.
    top = max(f1 for f1, _ in tried)
    cut = min((c for f1, c in tried if f1 >= top - 0.005), key=lambda c: abs(c + 0.75))
    f = train(np.ones(len(rows), dtype=bool), names)
    return Model(f.weights(), f.bias, float(1 / (1 + np.exp(-cut))), vocabulary, names)


def labelled(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_chars: int = 100_000_000) -> list[tuple[str, float]]:
    """At most ``max_labelled`` labelled texts of ``max_chars`` characters together, in an order given by a hash of the id."""
    own = labels.where("abusive is not null").groupBy("doc_id").agg(F.avg("abusive").alias("y")).where("y <> 0.5")
    rows = docs.select("doc_id", "text").where("text is not null and text <> ''").join(own, "doc_id")
    taken = rows.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_labelled)
    so_far = Window.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # over at most max_labelled rows
    return [(r.text, r.y) for r in taken.withColumn("chars", F.sum(F.length("text")).over(so_far)).where(F.col("chars") <= max_chars).orderBy("h", "doc_id").select("text", "y").collect()]


def score_documents(docs: DataFrame, model: Model, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, abusive, *extra) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        words, features = Words(m.vocabulary), Features()
        for p in parts:
            s = np.concatenate([m.score(words, features, (t if isinstance(t, str) else None for t in p["text"].iloc[i : i + 1000])) for i in range(0, len(p), 1000)]) if len(p) else np.empty(0)
            out = p.drop(columns="text")
            out.insert(1, "score", s)
            out.insert(2, "abusive", s > m.threshold)
            yield out

    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in extra)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *extra, "text").mapInPandas(run, f"doc_id {kind}, score double, abusive boolean{kinds}")


def rates(scored: DataFrame, by: str = "source") -> DataFrame:
    """Documents, abusive documents, their share and the mean score per source."""
    return scored.groupBy(by).agg(F.count("*").alias("documents"), F.count_if("abusive").alias("abusive"), F.avg(F.col("abusive").cast("int")).alias("rate"), F.avg("score").alias("mean_score"))
