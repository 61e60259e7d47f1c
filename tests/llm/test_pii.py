import pytest

from postweave.llm.pii import detector, find_items, redacted

CASES = [
    ("Тел.: +381 (60) 012-34-56.", [("phone", "+381 (60) 012-34-56")]), ("моб.0601234567!", [("phone", "0601234567")]), ("Viber 060/123-4567", [("phone", "060/123-4567")]),
    ("☎️00381 60 1234567 ✅", [("phone", "00381 60 1234567")]), ("Звоните 0️⃣6️⃣3️⃣0️⃣7️⃣3️⃣5️⃣3️⃣6️⃣8️⃣", [("phone", "0️⃣6️⃣3️⃣0️⃣7️⃣3️⃣5️⃣3️⃣6️⃣8️⃣")]),
    ("ноль шесть ноль один два три четыре пять шесть", [("phone", "ноль шесть ноль один два три четыре пять шесть")]),
    ("Mail a_b+c@x-y.example.", [("email", "a_b+c@x-y.example")]), ("Почта ab[собака]posta[точка]example ✅", [("email", "ab[собака]posta[точка]example")]), ("to ab (at) x.com!", [("email", "ab (at) x.com")]),
    ("Мой паспорт 00 00 458634.", [("id_number", "00 00 458634")]), ("JMBG: 0105964 998449!", [("id_number", "0105964 998449")]), ("my ID number X00959248", [("id_number", "X00959248")]),
    ("Адрес: ул.Трёх Ключей д.166, кв. 51. До", [("street_address", "ул.Трёх Ключей д.166, кв. 51")]), ("📍 бульвар Тихая Заводь, дом 169!", [("street_address", "бульвар Тихая Заводь, дом 169")]),
    ("Мы находимся: Ветровая 61/3.", [("street_address", "Ветровая 61/3")]), ("Lokacija Ulica Majstorska Reka br. 35.", [("street_address", "Ulica Majstorska Reka br. 35")]),
    ("Location - 118A Larkspur Lane", [("street_address", "118A Larkspur Lane")]), ("Find us at 19B Miller's Rise Lane!", [("street_address", "19B Miller's Rise Lane")]), ("Address: Quiet Weir Road 63", [("street_address", "Quiet Weir Road 63")]),
    ("С уважением, Роман Рыжерецкий ✅", [("person_name", "Роман Рыжерецкий")]), ("Каменокрылов Игорь", [("person_name", "Каменокрылов Игорь")]), ("Рыжеградова О. М.!", [("person_name", "Рыжеградова О. М.")]),
    ("С уважением, ПОЛИНА СУХОВЕТВИНА.", [("person_name", "ПОЛИНА СУХОВЕТВИНА")]), ("Your host Harriet Pelllow", [("person_name", "Harriet Pelllow")]), ("Аdмinистратор", []),
    ("Спр﻿oсить: Ан​на Лукo​рецкая", [("person_name", "Ан​на Лукo​рецкая")]),
    ("Артикул в каталоге AR-0616219371, Заказ № 0601234567, Номер очереди 79", []), ("На улице у рынка 5 минут, мастер Зомовафе, «Идиот»", []), ("@handle_one https://t.me/x", []), ("2 часа — 10 100 RSD, 10:00 - 16:00", []),
]


@pytest.mark.parametrize("text,want", CASES)
def test_items(text, want):
    assert [(k, text[i:j]) for k, i, j in detector().items(text)] == want


@pytest.mark.parametrize("text,want", [
    ("ПАСПОРТА №123456789", "123456789"), ("ПАСПОРТА 4510 123456", "4510 123456"), ("PASOŠA 123456789", "123456789"), ("ЛИЧНЫЙ НОМЕР 0105964998449", "0105964998449"), ("JMBG 0105964998449", "0105964998449"),
    ("УДОСТОВЕРЕНИЕ № 123456789", "123456789"), ("PASSPORT NO. 123456789", "123456789"), ("LIČNA KARTA BR. 123456789", "123456789"), ("ID CARD 123456789", "123456789"), ("ИНН 123456789012", "123456789012"),
])
def test_labels_in_capitals(text, want):
    assert [(k, text[i:j]) for k, i, j in detector().items(text)] == [("id_number", want)]


@pytest.mark.parametrize("text,want", [("ask for Liam Novak!", "Liam Novak"), ("our manager Rajesh Kumar will help", "Rajesh Kumar"), ("MANAGER: RAJESH KUMAR", "RAJESH KUMAR"), ("Pozdrav, Keisha Obi", "Keisha Obi"), ("Спросить: Лю Ван-Дер", "Лю Ван-Дер")])
def test_announced_names_need_no_list(text, want):
    assert [(k, text[i:j]) for k, i, j in detector().items(text)] == [("person_name", want)]


def test_first_names_are_a_parameter(spark):
    df = spark.createDataFrame([("a", "Wei Zhang came"), ("b", "Роман Рыжерецкий")], "k string, t string")
    assert find_items(df, "k", "t").count() == 1
    assert [tuple(r) for r in find_items(df, "k", "t", ("Wei",)).collect()] == [("a", "person_name", 0, 9)]
    assert df.select(redacted(df.t, ("Wei",))).first()[0] == "[PERSON_NAME] came"


def test_many_items_take_linear_time():
    import time

    one = "Звоните 060 123 45 67 или ноль шесть ноль один два три четыре пять шесть, Роман Рыжерецкий, ab@c.rs. "
    n = {}
    for k in (400, 3200):
        began = time.perf_counter()
        assert len(detector().items(one * k)) == 4 * k
        n[k] = time.perf_counter() - began
    assert n[3200] < 24 * max(n[400], 0.02)


def test_redaction_keeps_the_rest():
    text = "Пишите Анне: a@b.rs​, тел. 060 123 45 67!\nКонец"
    assert detector().redact(text) == "Пишите Анне: [EMAIL]​, тел. [PHONE]!\nКонец"
    for text, _ in CASES:
        items = detector().items(text)
        rest = detector().redact(text)
        for kind, i, j in items:
            assert text[:i] == rest[:i] or i > items[0][1]
            rest = rest.replace(f"[{kind.upper()}]", text[i:j], 1)
        assert rest == text


def test_rows(spark):
    long = "слово " * 20_000 + "060 123 45 67"
    df = spark.createDataFrame([("a", "060 123 45 67", 1), ("b", None, 2), ("c", "", 3), (None, "060 123 45 67", 4), ("d", long, 5)], "pii_type string, text string, record_key int")
    got = sorted(tuple(r) for r in find_items(df, "pii_type", "text").collect())
    assert got == [("a", "phone", 0, 13), ("d", "phone", 120_000, 120_013)]
    assert [r[0] for r in df.select(redacted(df.text)).take(3)] == ["[PHONE]", None, ""]
    assert find_items(df.limit(0), "pii_type", "text").count() == 0


@pytest.mark.parametrize("said", ["ноль-шесть-четыре-один-два-три-четыре-пять-шесть", "ноль. шесть. четыре. один. два. три. четыре. пять. шесть", "0 шесть шесть шесть шесть шесть шесть шесть шесть", "0, 6, 4, шесть, 2, 3, 4, 5, 6", "плюс-три-восемь-один-шесть-четыре-один-два-три-четыре-пять-шесть"])
def test_spelled_digits_with_any_marks(said):
    text = f"Запись: {said}! Ждём"
    assert [(k, text[i:j]) for k, i, j in detector().items(text)] == [("phone", said)]
    assert detector().items("раз, два, три, один, два, три, один, два, три") == []
