"""Queries of the general data problems."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postweave.operators.segment import packed, split_values
from postweave.operators.units import KNOWN_UNITS, NUMBER_WORDS, THOUSAND, lowest_in_unit
from postweave.session import table


def _packed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = packed(table(spark, sf_dir, "providers"), "providers", "provider_key", ["phones", "city_codes"])
    return a.unionAll(packed(table(spark, sf_dir, "offers"), "offers", "offer_key", ["service_tags", "city_codes"]))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per value of every cell that holds at least two."""
    got = split_values(_packed_cells(spark, sf_dir)).where("size >= 2")
    return got.select(F.col("field").alias("field_name"), F.col("key").alias("record_key"), "pos", "item")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest price of every offer that states one, in cents of EUR."""
    got = lowest_in_unit(table(spark, sf_dir, "offers"), "offer_key", "price_text_best", "price_min", "currency_code", table(spark, sf_dir, "currency_rates"), "offer_merge_override_group")
    return got.select(F.col("key").alias("offer_key"), F.round(F.col("amount") * 100).cast("bigint").alias("eur_cents"))


QUERIES = {"p2_found": p2_found, "p7_found": p7_found}


def _prices_sql() -> str:
    """p7_found for texts whose spellings are all known: amounts before their unit, ranges, signs, number words."""
    num = r"[0-9]{1,3}(?:[ .,][0-9]{3})+(?:[.,][0-9]{1,2})?|[0-9]+(?:[.,][0-9]{1,2})?"
    units = sorted(((u, c) for c, us in KNOWN_UNITS.items() for u in us), key=lambda x: (-len(x[0]), x[0]))
    alt = "|".join(re.escape(u) for u, _ in units)
    mult = "|".join(re.escape(m) for m in sorted(THOUSAND, key=len, reverse=True))
    amount = rf"({num})(?:(?: ?(?:-|–|—|\.\.) ?| до | do )(?:{num}))? ?((?:{mult})?)\.? ?({alt})"
    sign = rf"[€$]({num}) ?((?:(?:{mult})(?:[^\\p{{L}}]|$))?)"
    text = "regexp_replace(lower(coalesce(price_text_best, '')), '[\\x{a0}\\x{2007}\\x{2009}\\x{202f}]', ' ', 'g')"
    thousands = (("полторы тысячи", 1500), ("две тысячи", 2000), ("три тысячи", 3000), ("пять тысяч", 5000), ("тысяча", 1000), ("dve hiljade", 2000), ("hiljadu", 1000))
    words = [*thousands, *((w, n) for w, n in NUMBER_WORDS.items() if len(w) > 2 and n >= 20)]
    for w, n in words:
        text = f"regexp_replace({text}, '(^| ){w}( |$)', '\\1{n}\\2', 'g')"
    value = r"CASE WHEN regexp_matches(v, '[.,][0-9]{1,2}$') THEN CAST(replace(regexp_replace(regexp_replace(v, '[.,]([0-9]{1,2})$', 'd\1'), '[.,]', '', 'g'), 'd', '.') AS DECIMAL(18,4)) ELSE CAST(regexp_replace(v, '[.,]', '', 'g') AS DECIMAL(18,4)) END"
    known = ", ".join(f"('{u}', '{c}')" for u, c in units)
    return f"""WITH k(u, c) AS (VALUES {known}), r AS (SELECT u, eur_per_unit AS e FROM k JOIN currency_rates ON currency_code = c),
    t AS (SELECT offer_key, price_min, rtrim(lower(trim(coalesce(currency_code, ''))), '.') AS code, {text} AS p FROM offers),
    m AS (SELECT offer_key, unnest(regexp_extract_all(p, '{amount}')) AS m FROM t),
    a AS (SELECT offer_key, replace(regexp_extract(m, '{amount}', 1), ' ', '') AS v, CASE WHEN regexp_extract(m, '{amount}', 2) <> '' THEN 1000 ELSE 1 END AS f, regexp_extract(m, '{amount}', 3) AS u FROM m
      UNION ALL SELECT offer_key, replace(regexp_extract(s, '{sign}', 1), ' ', ''), CASE WHEN regexp_extract(s, '{sign}', 2) <> '' THEN 1000 ELSE 1 END, s[1] FROM (SELECT offer_key, unnest(regexp_extract_all(p, '{sign}')) AS s FROM t)),
    x AS (SELECT offer_key, min({value} * f * e) AS eur FROM a JOIN r ON r.u = a.u GROUP BY offer_key)
    SELECT offer_key, CAST(round(eur * 100) AS BIGINT) AS eur_cents FROM x
    UNION ALL SELECT offer_key, CAST(round(price_min * e * 100) AS BIGINT) FROM t JOIN r ON r.u = t.code WHERE price_min IS NOT NULL AND offer_key NOT IN (SELECT offer_key FROM a)"""


SQL: dict[str, str] = {"p7_found": _prices_sql()}
