from pyspark.sql import functions as F

from postweave.operators.segment import Cell, packed, split_cells, split_values


def split(spark, cells):
    df = spark.createDataFrame([("f", c) for c in cells], "field string, cell string")
    return {r["cell"]: list(r["items"]) for r in split_cells(df).collect()}


def test_quotes_brackets_and_escapes():
    assert [p[0] for p in Cell('["a, b","c"]').pieces] == ["a, b", "c"]
    assert [p[0] for p in Cell('"x ""y"" z";"q"').pieces] == ['x "y" z', "q"]
    assert [p[0] for p in Cell('{"x \\"y\\" z",q}').pieces] == ['x "y" z', None]
    assert Cell("{}").pieces == [] and Cell(" ; | ").pieces == []


def test_learned_splits(spark):
    words = ["red", "green", "blue", "deep sea", "teal"]
    cells = [f"{a}{d}{b}" for a in words for b in words for d in (",", "; ", " | ", "/", "\n", " и ") if a != b] + words
    cells += ['"red, blue";green', '["red, blue"]', '"red, blue" | teal', "red,,blue", "green;", "", " | "]
    got = split(spark, cells)
    for a in words:
        for b in words:
            if a != b:
                for d in (",", "; ", " | ", "/", "\n", " и "):
                    assert got[f"{a}{d}{b}"] == [a, b], (a, d, b)
    assert got['"red, blue";green'] == ["red, blue", "green"]
    assert got["red,,blue"] == ["red", "blue"] and got["green;"] == ["green"]
    assert got.get(" | ", []) == []


def test_phone_shapes_keep_their_punctuation(spark):
    phones = [f"+381 6{i % 10} 01{i % 10} {1000 + i}" for i in range(40)] + [f"06{i % 10}/01{i % 10}-{1000 + i}" for i in range(40)]
    cells = phones + [f"{phones[i]}, {phones[40 + i]}" for i in range(30)] + [f"{phones[40 + i]}\t{phones[i]}" for i in range(30)]
    got = split(spark, cells)
    for i in range(30):
        assert got[f"{phones[i]}, {phones[40 + i]}"] == [phones[i], phones[40 + i]]
        assert got[f"{phones[40 + i]}\t{phones[i]}"] == [phones[40 + i], phones[i]]
        assert got[phones[i]] == [phones[i]]


def test_rows_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([("k1", "a|b|a", 1), ("k1", "a|b|a", 1), ("k2", None, 2), (None, "a|b", 3), ("k3", "", 4), ("k4", "x" * 50_000 + "|a", 5), ("k5", "b|" * 4000, 6)], "key string, cell string, item int")
    got = split_values(packed(df.withColumnRenamed("cell", "field"), "t", "key", ["field"]))
    assert [(r["n"], r["top"]) for r in got.where("key = 'k5'").groupBy("key").agg(F.count("*").alias("n"), F.max("pos").alias("top")).collect()] == [(4000, 4000)]
    rows = sorted((r["key"], r["pos"], r["item"][:5], r["size"]) for r in got.where("key <> 'k5'").collect())
    assert rows == sorted([("k1", 1, "a", 3), ("k1", 2, "b", 3), ("k1", 3, "a", 3)] * 2 + [("k4", 1, "xxxxx", 2), ("k4", 2, "a", 2)])


def test_empty(spark):
    assert split_values(spark.createDataFrame([], "field string, key string, cell string").where(F.lit(True))).count() == 0


def test_long_values_between_uncertain_separators():
    from postweave.operators.segment import Cell, Lattice

    learned = {",": 0.9, ";": 0.95, "/": 0.6, " ": 0.02}
    long = " ".join(f"word{c}" for c in "abcdefghijklm")
    slashed = long.replace(" wordg", "/wordg")
    assert Lattice(Cell(f"haircut, {long}, nails"), {}, learned).best() == ["haircut", long, "nails"]
    assert Lattice(Cell(f"haircut, {slashed}; nails"), {slashed: -2.0}, learned).best() == ["haircut", slashed, "nails"]
    cell = Cell(", ".join([long] * 40))
    assert len(list(cell.spans())) <= 13 * len(cell.pieces)


def test_passes_decide(spark):
    # Two rare values stand side by side in several cells; only the learned marks tell that they are two.
    cells = [f"t{chr(97 + i)}ag; t{chr(97 + j)}ag; t{chr(97 + k)}ag" for i in range(12) for j in range(12) for k in range(0, 12, 3) if len({i, j, k}) == 3]
    rare = [f"visa; papers; t{chr(97 + i)}ag" for i in range(2)] + [f"t{chr(97 + i)}ag; visa; papers" for i in range(2)] + ["visa; taag", "papers; tbag", "visa", "papers"]
    df = spark.createDataFrame([("f", c) for c in cells + rare], "field string, cell string")
    wrong = lambda **k: sum(list(r["items"]) != r["cell"].split("; ") for r in split_cells(df, **k).collect())
    assert wrong(rounds=0) > 0 and wrong() == 0


def test_gaps_start_even_and_are_learned(spark):
    # The slash joins in one column and separates in the other, and a blank is part of a value in one and a mark in the other.
    joins = [f"{a}/{b}" for a in ("day", "night") for b in ("call", "visit")] * 2 + [f"{x}, {y}" for x in ("day/call", "night/call", "day/visit", "night/visit") for y in ("day/call", "night/call", "day/visit", "night/visit") if x != y]
    parts = [f"{a}/{b}" for a in ("bg", "ns", "nis", "su") for b in ("bg", "ns", "nis", "su") if a != b] + ["bg", "ns", "nis", "su"] + [f"{a} {b}" for a in ("bg", "ns", "nis", "su") for b in ("bg", "ns", "nis", "su") if a != b]
    df = spark.createDataFrame([("j", c) for c in joins] + [("p", c) for c in parts], "field string, cell string")
    got = {(r["field"], r["cell"]): list(r["items"]) for r in split_cells(df).collect()}
    assert got["j", "day/call, night/call"] == ["day/call", "night/call"] and got["j", "day/call"] == ["day/call"]
    assert got["p", "bg/ns"] == ["bg", "ns"] and got["p", "nis su"] == ["nis", "su"]
