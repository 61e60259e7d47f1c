"""Problem 2: several values packed in one cell.

Method: expectation-maximisation segmentation.  A cell is cut into pieces at everything that could be a delimiter
(punctuation, line ends, tabs, joining words, blanks).  A value is a run of pieces; how often values occur, and how
often each kind of gap separates, is learned from the distinct cells of the whole column with forward-backward
passes, and the Viterbi path gives the split.  Every kind of gap starts even (it separates as often as not), and
passes go on until no kind of any column moves by more than ``STILL``.  Quoted spans are atomic, gaps beside them and
the commas of a bracketed list always separate.

A value's key for counting is its small-letter form with every digit as ``9``, so phone numbers are known by their
shape.  Distinct cells of the same pieces, however they are set apart, are one piece of evidence together, and a value
known from one such only gets no more than the base measure; otherwise whole cells would be learned as values.  The
base measure of an unseen value is fixed (``Lattice``): it is what a value costs that nothing is known of.

Defined results: null, empty and delimiter-only cells have no value; repeated values stay; an empty place gets no
position; positions count from 1.  A run of more than ``SPAN`` pieces can be a value if it is the whole stretch between two
certain separators, or all that lies between neighbouring marks: marks of any kind, of any but one, or of one kind.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.session import cut

# Words that join values.
JOINERS = {"и", "или", "i", "ili", "and", "or"}
SPAN = 12
_PIECE = re.compile(
    r"""(?P<quoted>"(?:[^"\\]|\\.|"")*"(?=\s*(?:[,;|/•·\n\t&+]|$)))|(?P<mark>[,;|/•·])|(?P<lone>(?<!\S)[&+](?!\S))|(?P<line>[  ]*[\n\t\r][\s]*)|(?P<blank>[^\S\n\t\r]+)|(?P<text>[^\s,;|/•·]+)""",
    re.X,
)
_UNQUOTE = re.compile(r'\\(.)|""')


class Cell:
    """Pieces of a cell: (value or None, start, end) and, after each but the last, the kind of gap ('' = certain)."""

    __slots__ = ("text", "pieces", "gaps")

    def __init__(self, text: str) -> None:
        body, base, listed = text, 0, False
        m = re.fullmatch(r"\s*([\[{])(.*)([\]}])\s*", text, re.S)
        if m and m.group(1) + m.group(3) in ("[]", "{}"):
            body, base, listed = m.group(2), m.start(2), True
        self.text = text
        raw: list[tuple[str, str, int, int]] = [(m.lastgroup or "", m.group(), base + m.start(), base + m.end()) for m in _PIECE.finditer(body)]
        self.pieces: list[tuple[str | None, int, int]] = []
        self.gaps: list[str] = []
        marks: list[str] = []
        blank = False
        hard = False
        last_text = [k for k, r in enumerate(raw) if r[0] in ("text", "quoted")]
        edge = {last_text[0], last_text[-1]} if last_text else set()
        for k, (kind, s, i, j) in enumerate(raw):
            if kind in ("text", "quoted"):
                joiner = (
                    kind == "text" and k not in edge and not listed and s.lower() in JOINERS
                    and raw[k - 1][0] in ("blank", "line") and k + 1 < len(raw) and raw[k + 1][0] in ("blank", "line")
                )
                if joiner and self.pieces:
                    marks.append("word")
                    continue
                quoted = kind == "quoted"
                if self.pieces:
                    if hard or quoted or self.pieces[-1][0] is not None or len(marks) > 1:
                        gap = ""
                    elif listed:
                        gap = "" if marks == [","] else ("in" if marks else " ")
                    elif marks:
                        gap = marks[0]
                    else:
                        gap = " " if blank else "none"
                    self.gaps.append(gap)
                value = _UNQUOTE.sub(lambda h: h.group(1) or '"', s[1:-1]).strip() if quoted else None
                self.pieces.append((value, i, j))
                marks, blank, hard = [], False, False
            elif kind == "line":
                marks.append("line")
            elif kind == "blank":
                blank = True
            else:
                marks.append(s)

    def value(self, i: int, j: int) -> str:
        """The text of pieces i to j (inclusive)."""
        if i == j and self.pieces[i][0] is not None:
            return self.pieces[i][0]
        return self.text[self.pieces[i][1] : self.pieces[j][2]].strip()

    def spans(self) -> Iterator[tuple[int, int]]:
        """The runs of pieces that could be a value."""
        n, lo = len(self.pieces), 0
        while lo < n:
            hi = lo
            while hi + 1 < n and self.gaps[hi] != "":
                hi += 1
            for i in range(lo, hi + 1):
                for j in range(i, min(hi, i + SPAN - 1) + 1):
                    yield i, j
            if hi - lo >= SPAN:
                yield from self._long(lo, hi)
            lo = hi + 1

    def _long(self, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """The runs of more than ``SPAN`` pieces of a stretch; per set of kinds each piece is in one run, so they stay linear."""
        kinds = sorted({self.gaps[k] for k in range(lo, hi)} - {" ", "none"})
        sets = {frozenset(), frozenset(kinds)} | {frozenset({x}) for x in kinds} | {frozenset(kinds) - {x} for x in kinds}
        runs = set()
        for cuts in sets:
            i = lo
            for j in range(lo, hi + 1):
                if j == hi or self.gaps[j] in cuts:
                    if j - i >= SPAN:
                        runs.add((i, j))
                    i = j + 1
        yield from sorted(runs)


_DIGIT = re.compile(r"\d")
_SPACE = re.compile(r"\s+")


def value_key(value: str) -> str:
    return _SPACE.sub(" ", _DIGIT.sub("9", value.lower()))


class Lattice:
    """Scores of a cell's spans and gaps under the present model."""

    BASE = -14.0  # log measure of a value that was never seen
    # And for each further piece of it: a blank goes well within a value, a mark that separates does not.
    PIECE = {" ": -2.5, "none": -2.5, "/": -8.0, "in": -8.0}

    def __init__(self, cell: Cell, known: dict[str, float], gap: dict[str, float]) -> None:
        self.cell, n = cell, len(cell.pieces)
        self.ends: list[list[tuple[int, float, str]]] = [[] for _ in range(n)]
        for i, j in cell.spans():
            key = value_key(cell.value(i, j))
            score = max(known.get(key, -math.inf), self.BASE + sum(self.PIECE.get(cell.gaps[k], self.BASE) for k in range(i, j)))
            for k in range(i, j):
                score += math.log(1 - gap.get(cell.gaps[k], EVEN))
            if j + 1 < n and cell.gaps[j]:
                score += math.log(gap.get(cell.gaps[j], EVEN))
            self.ends[j].append((i, score, key))

    def best(self) -> list[str]:
        n = len(self.cell.pieces)
        top: list[tuple[float, int]] = []
        for j in range(n):
            top.append(max(((top[i - 1][0] if i else 0.0) + s, i) for i, s, _ in self.ends[j]))
        out, j = [], n - 1
        while j >= 0:
            i = top[j][1]
            out.append(self.cell.value(i, j))
            j = i - 1
        return [v for v in reversed(out) if v]

    def expected(self) -> tuple[dict[str, float], dict[str, list[float]]]:
        """Expected uses of each value key, and per kind of gap [separating, all]."""
        n = len(self.cell.pieces)
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b))) if a > -math.inf and b > -math.inf else max(a, b)
        f = [-math.inf] * (n + 1)
        f[0] = 0.0
        for j in range(n):
            for i, s, _ in self.ends[j]:
                f[j + 1] = add(f[j + 1], f[i] + s)
        b = [-math.inf] * (n + 1)
        b[n] = 0.0
        for j in range(n - 1, -1, -1):
            for i, s, _ in self.ends[j]:
                b[i] = add(b[i], b[j + 1] + s)
        keys: dict[str, float] = {}
        for j in range(n):
            for i, s, key in self.ends[j]:
                p = math.exp(f[i] + s + b[j + 1] - f[n])
                if p > 1e-4:
                    keys[key] = keys.get(key, 0.0) + p
        gaps: dict[str, list[float]] = {}
        for k, g in enumerate(self.cell.gaps):
            if g:
                own = gaps.setdefault(g, [0.0, 0.0])
                own[0] += math.exp(min(0.0, f[k + 1] + b[k + 1] - f[n]))
                own[1] += 1.0
        return keys, gaps


# How probable it is that a gap of a kind separates, before anything is learned; it weighs as much as EVEN_USES gaps.
EVEN, EVEN_USES = 0.5, 4.0
STILL = 0.002  # a change of a gap's probability that ends the passes
MOST_ROUNDS = 12  # passes converge in two or three; a bound for tables that swing

_KNOWN = "array<struct<key:string,p:double>>"


def _same_of(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows with ``same``, what the pieces of a cell are, however they are set apart."""
    for p in parts:
        same = []
        for text in p["cell"]:
            cell = Cell(text)
            body = " ".join(value_key(cell.value(i, i)) for i in range(len(cell.pieces)))
            same.append(int.from_bytes(hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True))
        yield p.assign(same=same)


def _keys_of(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(field, cid, key, start): the value keys a cell could hold, and the use each begins with."""
    for p in parts:
        rows = []
        for field, cid, text, share in zip(p["field"], p["cid"], p["cell"], p["share"]):
            cell = Cell(text)
            if not cell.pieces:
                continue
            seen: dict[str, bool] = {}
            for i, j in cell.spans():
                k = value_key(cell.value(i, j))
                alone = (i == 0 or cell.gaps[i - 1] == "") and (j + 1 == len(cell.pieces) or cell.gaps[j] == "") and i == j
                seen[k] = seen.get(k, False) or alone
            n = len(cell.pieces)
            rows += [(field, cid, k, share * (1.0 if sure else 1.0 / (1 + n))) for k, sure in seen.items()]
        yield pd.DataFrame(rows, columns=["field", "cid", "key", "start"])


def learn(cells: DataFrame, rounds: int = MOST_ROUNDS) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """From distinct (field, cid, cell): (field, cid, cell, known) with the log frequency of each key, and the gap model per field."""
    named = cut(cells.select("field", "cid", "cell").mapInPandas(_same_of, "field string, cid string, cell string, same bigint"))
    share = named.groupBy("field", "same").agg((1 / F.count("*")).alias("share"))
    # A cell's weight: cells of the same pieces weigh one together.
    weight = cut(named.join(share, ["field", "same"]).select("field", "cid", "cell", "share"))
    keys = cut(weight.mapInPandas(_keys_of, "field string, cid string, key string, start double"))
    counts = keys.groupBy("field", "key").agg(F.sum("start").alias("n"))
    gaps: dict[str, dict[str, float]] = {}
    moved = 1.0
    for r in range(rounds + 1):
        # A value of one cell is no evidence: one use is taken off.
        total = counts.groupBy("field").agg(F.sum("n").alias("total"))
        model = counts.where("n > 1.001").join(F.broadcast(total), "field").select("field", "key", F.log((F.col("n") - 0.9) / F.col("total")).alias("p"))
        # Only the cell's name goes with its keys; the text is joined once.
        known = keys.select("field", "cid", "key").join(model, ["field", "key"], "left")
        known = known.groupBy("field", "cid").agg(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("key", "p"))).alias("known"))
        known = weight.join(known, ["field", "cid"]).select("field", "cid", "cell", "share", "known")
        if r == rounds or moved <= STILL:
            return known.drop("share"), gaps
        fixed = {f: dict(g) for f, g in gaps.items()}

        def run(parts: Iterable[pd.DataFrame], fixed=fixed) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            for p in parts:
                rows = []
                for field, text, share, near in zip(p["field"], p["cell"], p["share"], p["known"]):
                    got, gap = Lattice(Cell(text), {x["key"]: x["p"] for x in near}, fixed.get(field, {})).expected()
                    rows += [(field, "v", k, n * share, 0.0) for k, n in got.items()]
                    rows += [(field, "g", k, a, b) for k, (a, b) in gap.items()]
                yield pd.DataFrame(rows, columns=["field", "what", "key", "n", "all"])

        use = cut(known.mapInPandas(run, "field string, what string, key string, n double, all double").groupBy("field", "what", "key").agg(F.sum("n").alias("n"), F.sum("all").alias("all")))
        counts = use.where("what = 'v'").select("field", "key", "n")
        # The kinds of gap are a fixed short list.
        moved = 0.0
        for g in use.where("what = 'g'").collect():
            now = min(0.9999, max(0.0001, (g["n"] + EVEN_USES * EVEN) / (g["all"] + EVEN_USES)))
            moved = max(moved, abs(now - gaps.get(g["field"], {}).get(g["key"], EVEN)))
            gaps.setdefault(g["field"], {})[g["key"]] = now
    raise AssertionError


def cell_name(cell: Column) -> Column:
    """What a cell is known by in joins, so that its text need not move."""
    return F.md5(cell.cast("binary"))


def split_cells(cells: DataFrame, rounds: int = MOST_ROUNDS) -> DataFrame:
    """From (field, cell), repeated as they may be: (field, cid, cell, items) for each distinct cell."""
    cells = cells.where("cell is not null and cell <> ''").select("field", "cell").distinct()
    cells = cut(cells.withColumn("cid", cell_name(F.col("cell"))))
    known, gaps = learn(cells, rounds)

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            items = []
            for field, text, near in zip(p["field"], p["cell"], p["known"]):
                items.append(Lattice(Cell(text), {x["key"]: x["p"] for x in near}, gaps.get(field, {})).best())
            yield pd.DataFrame({"field": p["field"], "cid": p["cid"], "cell": p["cell"], "items": items})

    return known.mapInPandas(run, "field string, cid string, cell string, items array<string>")


def split_values(rows: DataFrame) -> DataFrame:
    """From (field, key, cell): (field, key, pos, item, size), one row per value; size is the number of values of its cell."""
    done = split_cells(rows.select("field", "cell")).select("field", "cid", "items")
    of = rows.where("key is not null").select("field", "key", cell_name(F.col("cell")).alias("cid")).join(done, ["field", "cid"])
    return of.select("field", "key", F.size("items").alias("size"), F.posexplode("items").alias("p", "item")).select("field", "key", (F.col("p") + 1).alias("pos"), "item", "size")


def packed(df: DataFrame, table_name: str, key: str, columns: Iterable[str]) -> DataFrame:
    """(field, key, cell) of several columns of one table, read once."""
    cols = list(columns)
    pairs = F.explode(F.array(*[F.struct(F.lit(f"{table_name}.{c}").alias("field"), F.col(c).alias("cell")) for c in cols]))
    return df.select(F.col(key).alias("key"), pairs.alias("x")).select("x.field", "key", "x.cell").where("cell is not null and cell <> ''")
