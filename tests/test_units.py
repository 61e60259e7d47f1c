from decimal import Decimal

import pytest

from postweave.operators.units import AmountReader, link_units, lowest_in_unit, read_number, resolve_units


@pytest.mark.parametrize("text,want", [("1.200", "1200"), ("1 200", "1200"), ("1 200", "1200"), ("3.500,00", "3500.00"), ("7,600", "7600"), ("11,50", "11.50"), ("14.5", "14.5"), ("1.200.000", "1200000"), ("9", "9")])
def test_numbers(text, want):
    assert read_number(text) == Decimal(want)


@pytest.mark.parametrize("text,want", [
    ("2 часа — 432 eur", [("432", "eur")]), ("45 мин / €16", [("16", "€")]), ("скидка 10%", []), ("скидка 10%, итого 32 euro", [("32", "euro")]),
    ("от 600 до 1000 rsd", [("600", "rsd"), ("1000", "rsd")]), ("92..107марок", [("92", "марок"), ("107", "марок")]), ("5-7 тыс. дин", [("5000", "дин"), ("7000", "дин")]),
    ("полторы тысячи динаров", [("1500", "динаров")]), ("hiljadu dinara", [("1000", "dinara")]), ("57,2K дин", [("57200", "дин")]), ("95 евро за 1 кг", [("95", "евро")]),
    ("2.600,00 rsd/m²", [("2600", "rsd")]), ("по запросу", []), ("", []), (None, []),
])
def test_amounts(text, want):
    got = [(v.normalize(), u) for v, u in AmountReader().amounts(text)]
    assert got == [(Decimal(v).normalize(), u) for v, u in want]


def rates(spark):
    return spark.createDataFrame([("EUR", Decimal("1.000000")), ("RSD", Decimal("0.008500"))], "currency_code string, eur_per_unit decimal(12,6)")


def test_unknown_spelling_is_learned_from_links(spark):
    pairs = spark.createDataFrame([("zlotnik", "rsd", float(i), float(i * 100)) for i in range(1, 9)] + [("x", "eur", 1.0, 3.3)] * 5, "unit string, code string, stated double, value double")
    links = link_units(pairs)
    assert [(r.unit, r.code, round(r.lg, 6)) for r in links.collect() if r.unit == "zlotnik"] == [("zlotnik", "rsd", 2.0)]
    of = {r.node: r.currency for r in resolve_units(links, rates(spark)).collect()}
    assert of["zlotnik"] == "RSD" and of["€"] == "EUR" and "usd" not in of and "x" not in of


def test_rows(spark):
    rows = [("a", "9 евро", None, ""), ("b", None, Decimal("200.00"), "RSD"), ("c", "скидка 5%", Decimal("3.00"), "€"), ("d", "см. прайс", Decimal("3.00"), ""), ("e", None, None, None), ("f", "1.000 дин / 5 eur", Decimal("9"), "EUR"), ("a", "9 евро", None, "")]
    df = spark.createDataFrame(rows, "key string, stated string, value decimal(12,2), unit string")
    got = sorted((r.key, float(r.amount)) for r in lowest_in_unit(df, "key", "stated", "value", "unit", rates(spark)).collect())
    assert got == [("a", 9.0), ("a", 9.0), ("b", 1.7), ("c", 3.0), ("f", 5.0)]
    assert lowest_in_unit(df.limit(0), "key", "stated", "value", "unit", rates(spark)).count() == 0


def test_scales_are_carried_along_the_links(spark):
    # Cents are known by rows that state them beside a value in euro; further spellings hang on one another, five in a row.
    pairs = [("центов", "eur", float(i * 100), float(i)) for i in range(1, 6)]
    for k in range(5):
        pairs += [(f"u{k}", f"u{k + 1}", float(i), float(i)) for i in range(1, 6)]
    pairs += [("центов", "u0", float(i * 100), float(i * 100)) for i in range(1, 6)]
    links = link_units(spark.createDataFrame(pairs, "unit string, code string, stated double, value double"))
    of = {r.node: (r.currency, r.power) for r in resolve_units(links, rates(spark)).collect()}
    assert of["eur"] == ("EUR", 0) and [of[n] for n in ("центов", "u0", "u1", "u5")] == [("EUR", -2)] * 4
    rows = [(f"k{i}", f"{i * 100} центов", Decimal(i), "EUR") for i in range(1, 6)] + [("alone", "250 центов", None, None)]
    df = spark.createDataFrame(rows, "key string, stated string, value decimal(12,2), unit string")
    got = {r.key: r.amount for r in lowest_in_unit(df, "key", "stated", "value", "unit", rates(spark)).collect()}
    assert got == {f"k{i}": Decimal(i) for i in range(1, 6)} | {"alone": Decimal("2.5")}


def test_units_of_one_entity_are_linked_across_records(spark):
    # No record states both; the records of a group state the same price, so the scale tells the currency.
    rows = [(f"a{i}", f"g{i}", f"{i * 2000} zlotnik", None, None) for i in range(1, 9)] + [(f"b{i}", f"g{i}", f"{i * 17} евро", None, None) for i in range(1, 9)] + [("c", None, "7 zlotnik", None, None), ("d", "", "9 denar", None, None)]
    df = spark.createDataFrame(rows, "key string, grp string, stated string, value decimal(12,2), unit string")
    got = {r.key: round(float(r.amount), 6) for r in lowest_in_unit(df, "key", "stated", "value", "unit", rates(spark), "grp").collect()}
    assert got["a3"] == got["b3"] == 51.0 and got["c"] == 0.0595 and "d" not in got
    # One of this unit is a hundred of a known one.
    rows = [(f"a{i}", None, f"{i} zlotnik", Decimal(i * 100), "RSD") for i in range(1, 9)] + [("b", None, "7 zlotnik", None, None), ("c", None, "12345678901234567 rsd", None, None)]
    got = {r.key: round(float(r.amount), 6) for r in lowest_in_unit(spark.createDataFrame(rows, df.schema), "key", "stated", "value", "unit", rates(spark), "grp").collect()}
    assert got["b"] == 5.95 and got["a2"] == 1.7 and got["c"] > 1e14


def test_links_that_disagree_or_need_an_offset_are_none(spark):
    pairs = [("far", "eur", float(i), float(i + 100)) for i in range(1, 30)] + [("wild", "eur", 10.0, float(10 ** (i % 5))) for i in range(30)] + [("two", "eur", 1.0, 1.0)] * 2
    assert link_units(spark.createDataFrame(pairs, "unit string, code string, stated double, value double")).count() == 0
