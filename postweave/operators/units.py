"""Problem 7: quantities recorded in different units and scales.

Method: every spelling of a unit is a node of a source graph: unit words found in free text and the codes of the
structured column.  Statements of one entity (its text, its structured fields, and the same of the other records of
its duplicate group) are linked: per entity each unit's median meets that of the entity's best known unit, so an
entity of any size gives a star and not all pairs.  The robust scale of a link is the most frequent log ratio of its
entities; what needs an offset has no common ratio and is no link, as no conversion of money has one.  The codes of
the rate table are anchors; spellings of the known list are anchors only where no link reaches them (too few
records).  A node linked to a resolved one snaps to a known conversion: a power of ten of the neighbour's currency,
else another currency of the rate table (whole, in hundredths or in thousands).  Currency and power are carried from
link to link until no node is added, and both are applied to every amount.

The text then holds: the lowest of its amounts in the unit of its word.  Where the text states no amount the
structured value holds in the unit of its code.

Defined results: null or empty texts state nothing; times, measures and percentages are no amounts, nor is a number
of 10^20 and more; an amount whose unit is unknown (no anchor, and no link that ``least`` entities support), or a
structured value without a known code, gives no row; repeated rows give repeated rows; null entities stand alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postweave.session import cut

# Spellings of currencies that need no learning.
KNOWN_UNITS = {
    "EUR": ("eur", "€", "евро", "evra", "euro", "euros"),
    "RSD": ("rsd", "csd", "csd/rsd", "дин", "динар", "динаров", "динара", "din", "dinar", "dinara"),
    "USD": ("usd", "$", "us$", "долл", "доллар", "долларов", "доллара", "баксов", "dolara", "dollars"),
    "BAM": ("bam", "km", "марок", "maraka"),
    "HUF": ("huf", "ft", "форинтов", "forinti"),
}
# Words for a thousand, number words.
THOUSAND = ("тыс", "тысяч", "тысячи", "тысяча", "hilj", "hiljada", "hiljade", "k", "к", "thousand")
NUMBER_WORDS = {
    "один": 1, "два": 2, "две": 2, "три": 3, "четыре": 4, "пять": 5, "шесть": 6, "семь": 7, "восемь": 8, "девять": 9, "десять": 10,
    "двенадцать": 12, "пятнадцать": 15, "двадцать": 20, "тридцать": 30, "сорок": 40, "пятьдесят": 50, "шестьдесят": 60, "семьдесят": 70,
    "восемьдесят": 80, "девяносто": 90, "сто": 100, "двести": 200, "триста": 300, "четыреста": 400, "пятьсот": 500, "полторы": 1.5, "полтора": 1.5,
    "jedan": 1, "dva": 2, "dve": 2, "tri": 3, "četiri": 4, "pet": 5, "šest": 6, "sedam": 7, "osam": 8, "devet": 9, "deset": 10, "petnaest": 15,
    "dvadeset": 20, "trideset": 30, "četrdeset": 40, "pedeset": 50, "sto": 100, "dvesta": 200, "dvesto": 200, "trista": 300, "petsto": 500,
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "fifteen": 15, "twenty": 20,
    "thirty": 30, "forty": 40, "fifty": 50, "hundred": 100,
}
# What a number can count other than money.
OTHER_UNITS = ("час", "часа", "часов", "ч", "мин", "минут", "минуты", "день", "дня", "дней", "сеанс", "сеанса", "кг", "г", "м", "м²", "м2", "m²", "m2", "m", "km/h", "см", "л", "шт", "раз", "hour", "hours", "h", "min", "minutes", "days", "kg", "sat", "sata", "sati", "dana", "visit", "visits")

_BLANK = " \u00a0\u2007\u2009\u202f"
_NUM = rf"\d{{1,3}}(?:[{_BLANK}.,’']\d{{3}})+(?:[.,]\d{{1,2}})?(?!\d)|\d+(?:[.,]\d{{1,2}})?(?!\d)|\d+"


def read_number(s: str) -> Decimal:
    """A written number; a group of exactly three digits at the end is thousands, else the last mark is decimal."""
    s = re.sub(rf"[{_BLANK}’']", "", s)
    marks = [c for c in s if c in ".,"]
    if not marks:
        return Decimal(s)
    last = max(s.rfind("."), s.rfind(","))
    tail = len(s) - last - 1
    if tail == 3 and (len(set(marks)) == 1):
        return Decimal(re.sub(r"[.,]", "", s))
    return Decimal(re.sub(r"[.,]", "", s[:last]) + "." + s[last + 1 :])


class AmountReader:
    """Amounts of a text as (value, unit word); unit words are whatever letters stand beside a number."""

    def __init__(self) -> None:
        word = r"[^\W\d_]+\$?|[€$£₽¥]"
        words = "|".join(sorted(map(re.escape, {*NUMBER_WORDS, "тысяча", "тысячу", "hiljadu", "hiljada", "тысячи", "тысяч", "hiljade", "hundred", "thousand"}), key=len, reverse=True))
        mult = "|".join(sorted(map(re.escape, THOUSAND), key=len, reverse=True))
        self.token = re.compile(
            rf"(?P<num>{_NUM})(?P<mult>\s?(?:{mult})(?![^\W\d_])\.?)?|(?P<pct>%)|(?P<said>(?<![^\W_])(?:{words})(?![^\W_]))|(?P<word>{word})|(?P<range>\.\.+|[-–—])|(?P<per>/)|(?P<other>[^\s])",
            re.I,
        )

    def amounts(self, text: str | None) -> list[tuple[Decimal, str]]:
        if not text:
            return []
        toks = [(m.lastgroup if m.lastgroup != "mult" else "num", m) for m in self.token.finditer(text)]
        # Numbers in words become one number token.
        items: list[tuple[str, Decimal | str, bool]] = []
        k = 0
        while k < len(toks):
            kind, m = toks[k]
            if kind == "said":
                value, whole = Decimal(0), Decimal(0)
                while k < len(toks) and toks[k][0] == "said":
                    w = toks[k][1].group().lower()
                    if w in NUMBER_WORDS and w != "hundred":
                        value += Decimal(str(NUMBER_WORDS[w]))
                    elif w == "hundred":
                        value = (value or Decimal(1)) * 100
                    else:
                        whole += (value or Decimal(1)) * 1000
                        value = Decimal(0)
                    k += 1
                items.append(("num", whole + value, whole > 0))
                continue
            if kind == "num":
                v = read_number(m.group("num"))
                thousand = bool(m.group("mult"))
                items.append(("num", v * 1000 if thousand else v, thousand))
            else:
                items.append((kind or "other", m.group().lower(), False))
            k += 1
        out: list[tuple[Decimal, str]] = []
        waiting: list[tuple[Decimal, bool]] = []
        before = ""
        for n, (kind, v, thousand) in enumerate(items):
            after = items[n + 1] if n + 1 < len(items) else ("", "", False)
            if kind == "num":
                if before in ("€", "$", "£", "us$"):
                    out.append((v, before))
                    waiting = []
                elif after[0] == "pct":
                    waiting = []
                elif after[0] == "word" and after[1] not in OTHER_UNITS and not self._joins(after[1]):
                    u = after[1]
                    # A range has its unit, and a word for thousand, at its end only.
                    out += [((w * 1000 if thousand and not t else w), u) for w, t in waiting]
                    out.append((v, u))
                    waiting = []
                elif after[0] == "range" or (after[0] == "word" and self._joins(after[1])):
                    waiting.append((v, thousand))
                else:
                    waiting = []
            elif kind == "word" and not self._joins(v):
                waiting = [] if waiting and v in OTHER_UNITS else waiting
            before = v if kind in ("word", "other") else ""
        return out

    @staticmethod
    def _joins(w: str) -> bool:
        return w in ("до", "do", "to", "и", "i", "and")


@lru_cache(maxsize=1)
def reader() -> AmountReader:
    return AmountReader()


def unit_node(col: Column) -> Column:
    """The spelling by which a unit is a node."""
    return F.regexp_replace(F.lower(F.trim(col)), r"\.$", "")


def text_amounts(col: Column) -> Column:
    """array<struct<value, unit>> of the amounts of a text."""

    @F.pandas_udf("array<struct<value:decimal(24,4),unit:string>>")
    def run(s: pd.Series) -> pd.Series:
        r = reader()
        q = Decimal("0.0001")
        most = Decimal(10) ** 20
        return s.map(lambda t: [{"value": v.quantize(q, ROUND_HALF_UP), "unit": u} for v, u in r.amounts(t) if v < most] if isinstance(t, str) else [])

    return run(col)


MOST_RATES = 10_000  # a table of currencies is no larger; beyond that the rates given are something else
NEAR_LOG = 0.01  # how far a scale may be from a known conversion, in powers of ten
# Powers of ten in which another currency may be stated (hundredths, whole, thousands).
POWERS = (0, -2, 3)


def anchor_nodes(codes: list[str], known: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """Spelling -> currency: the known spellings of the codes of the rate table, and the codes in small letters."""
    has = {c.upper() for c in codes}
    return {s: c for c, ss in known.items() if c in has for s in ss} | {c.lower(): c for c in sorted(has)}


def entity_links(statements: DataFrame, anchors: dict[str, str]) -> DataFrame:
    """From (entity, unit, value): (unit, code, stated, value), each unit of an entity beside the entity's best known unit."""
    own = statements.where("entity is not null and unit <> '' and value > 0").groupBy("entity", "unit").agg(F.percentile_approx(F.col("value").cast("double"), 0.5, 1000).alias("value"))
    often = own.groupBy("unit").agg(F.count("*").alias("n"))
    own = own.join(often, "unit")
    rank = F.struct(F.col("unit").isin(*anchors), "n", "unit", "value")
    hub = own.groupBy("entity").agg(F.max(rank).alias("hub"), F.count("*").alias("units")).where("units > 1").select("entity", F.col("hub.unit").alias("code"), F.col("hub.value").alias("of_code"))
    return own.join(hub, "entity").where("unit <> code").select("unit", "code", F.col("value").alias("stated"), F.col("of_code").alias("value"))


def link_units(pairs: DataFrame, least: int = 3) -> DataFrame:
    """From (unit, code, stated, value): the links (unit, code, n, lg): one of the unit is 10^lg of the code.

    The scale is the most frequent log ratio of the entities (a column may mix whole amounts, hundredths and
    thousands, so that their median may be none of them), told by at least ``least`` entities and a third of all; the
    scale of fewer is no estimate, so such a link is none.  Amounts that differ by an offset have no common ratio.
    """
    pos = pairs.where("stated > 0 and value > 0 and unit <> '' and code <> ''").withColumn("lg", F.log10(F.col("value").cast("double") / F.col("stated").cast("double")))
    told = pos.groupBy("unit", "code", F.round(F.col("lg") / NEAR_LOG).alias("bin")).agg(F.count("*").alias("n"), F.sum("lg").alias("lg"))
    top = told.groupBy("unit", "code").agg(F.max(F.struct("n", -F.abs("bin"), "bin", "lg")).alias("m"), F.sum("n").alias("all"))
    return top.where((F.col("m.n") >= least) & (3 * F.col("m.n") >= F.col("all"))).select("unit", "code", F.col("m.n").alias("n"), (F.col("m.lg") / F.col("m.n")).alias("lg"))


def resolve_units(links: DataFrame, rates: DataFrame, known: dict[str, tuple[str, ...]] = KNOWN_UNITS) -> DataFrame:
    """(node, currency, power, eur_per_unit) of every spelling reachable from an anchor: one of it is 10^power of the currency.

    A node takes the currency with the most support among its resolved neighbours and, within that, the power with the most.
    """
    spark = links.sparkSession
    rate = [(r[0].upper(), r[1]) for r in rates.select("currency_code", "eur_per_unit").where("currency_code is not null and eur_per_unit > 0").limit(MOST_RATES + 1).collect()]
    if len(rate) > MOST_RATES:
        raise ValueError(f"more than {MOST_RATES} rates")
    codes = [c for c, _ in rate]
    nodes = spark.createDataFrame([(n, c, 0) for n, c in anchor_nodes(codes, {}).items()], "node string, currency string, power int")
    listed = [(n, c, 0) for n, c in anchor_nodes(codes, known).items()]
    edges = links.select(F.col("unit").alias("a"), F.col("code").alias("b"), "lg", "n").union(links.select("code", "unit", -F.col("lg"), "n"))
    edges = cut(edges)
    logs = F.array(*[F.struct(F.lit(c).alias("to"), F.log10(F.lit(float(e))).alias("of")) for c, e in rate]) if rate else F.array().cast("array<struct<to:string,of:double>>")
    all_of = Window.partitionBy("a", "currency")
    best = Window.partitionBy("a").orderBy(F.desc("support"), "currency", F.desc("n"), F.abs("power"), "power")
    while rate:
        met = edges.join(nodes, edges.b == nodes.node).join(nodes.select(F.col("node").alias("a")), "a", "left_anti")
        met = met.withColumn("own", F.get(F.filter(logs, lambda x: x["to"] == F.col("currency")), F.lit(0))["of"])
        # What one of the node is worth, as a power of ten of EUR.
        worth = F.col("lg") + F.col("power") + F.col("own")
        near = lambda x: F.abs(worth - x["of"] - F.round(worth - x["of"]))
        step = lambda x: F.round(worth - x["of"]).cast("int")
        fits = F.filter(logs, lambda x: (near(x) <= NEAR_LOG) & ((x["to"] == F.col("currency")) | step(x).isin(*POWERS)))
        # The neighbour's own currency first, then the whole unit, then the nearest.
        first = F.array_min(F.transform(fits, lambda x: F.struct((x["to"] != F.col("currency")).alias("other"), (step(x) != 0).alias("scaled"), near(x).alias("gap"), x["to"].alias("to"), step(x).alias("power"))))
        new = met.withColumn("m", first).where("m is not null").groupBy("a", F.col("m.to").alias("currency"), F.col("m.power").alias("power")).agg(F.sum("n").alias("n"))
        new = new.withColumn("support", F.sum("n").over(all_of)).withColumn("rn", F.row_number().over(best)).where("rn = 1")
        new = cut(new.select(F.col("a").alias("node"), "currency", "power"))
        if new.isEmpty():
            if not listed:
                break
            # Known spellings that no link has reached.
            new = cut(spark.createDataFrame(listed, nodes.schema).join(nodes.select("node"), "node", "left_anti").select(*nodes.columns))
            listed = []
        nodes = cut(nodes.unionAll(new))
    return nodes.join(rates.select(F.upper("currency_code").alias("currency"), "eur_per_unit"), "currency").select("node", "currency", "power", "eur_per_unit")


def lowest_in_unit(rows: DataFrame, key: str, text: str, value: str, code: str, rates: DataFrame, entity: str | None = None, known: dict[str, tuple[str, ...]] = KNOWN_UNITS) -> DataFrame:
    """(key, amount): the lowest stated amount of every row in the unit of the rates, where one is stated.

    Rows with the same non-blank ``entity`` speak of the same thing, others of their own.
    """
    of = F.when(F.trim(F.coalesce(F.col(entity), F.lit(""))) != "", F.concat(F.lit("group:"), F.col(entity))) if entity else F.lit(None).cast("string")
    base = rows.select(F.col(key).alias("key"), F.coalesce(of, F.concat(F.lit("key:"), F.col(key).cast("string"))).alias("entity"), F.col(value).cast("decimal(24,4)").alias("value"), unit_node(F.coalesce(F.col(code), F.lit(""))).alias("code"), text_amounts(F.col(text)).alias("stated"))
    base = cut(base.withColumn("stated", F.transform("stated", lambda x: F.struct(x["value"].alias("value"), unit_node(x["unit"]).alias("unit")))))
    # A text of one amount and the structured value are two statements.
    told = F.array_compact(F.array(F.when(F.size("stated") == 1, F.col("stated")[0]), F.when(F.col("value").isNotNull(), F.struct("value", F.col("code").alias("unit")))))
    statements = base.select("entity", F.explode(told).alias("s")).select("entity", "s.unit", "s.value")
    codes = [r[0] for r in rates.select("currency_code").where("currency_code is not null").limit(MOST_RATES).collect()]
    rate = resolve_units(link_units(entity_links(statements, anchor_nodes(codes, known))), rates, known)
    # The spellings resolved are no more than there are nodes with an anchor or a link.
    own = base.withColumn("row", F.monotonically_increasing_id())
    wanted = own.select("key", "row", F.explode(F.when(F.size("stated") > 0, F.col("stated")).when(F.col("value").isNotNull() & (F.col("code") != ""), F.array(F.struct("value", F.col("code").alias("unit"))))).alias("s"))
    amounts = wanted.select("key", "row", F.col("s.value").alias("v"), F.col("s.unit").alias("node")).join(rate.drop("currency"), "node")
    amounts = amounts.withColumn("plain", F.col("v") * F.col("eur_per_unit"))
    scaled = (F.col("plain").cast("double") * F.pow(F.lit(10.0), "power")).try_cast(amounts.schema["plain"].dataType)
    return amounts.groupBy("key", "row").agg(F.min(F.when(F.col("power") == 0, F.col("plain")).otherwise(scaled)).alias("amount")).select("key", "amount")
