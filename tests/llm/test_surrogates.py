import re

import pytest

from tillroll.llm import surrogates as S

TEXTS = [
    None,
    "",
    "Nothing here, 12 apples and 3.5 pears; version 1.2.3, token = \"f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda\".",
    "Write to Anna.Lee+x@mail7.example.com or ANNA.LEE+X@MAIL7.EXAMPLE.COM.",
    "Call +1 (017) 555-7713 now, or (017) 555-7713, or 017-555-7713.",
    "Card 4111 1111 1111 1111 or 4111111111111111, not 9807915762804490.",
    "Host 97.51.17.173. SSN 123-45-6789.",
    "IBAN DE89 3704 0044 0532 0130 00 and DE89370400440532013000, bad DE12 3704 0044 0532 0130 00",
    "Mr. John Smith met Mrs. Smith and Mr SMITH; Dr. Robin Oak too. Mrs. Anna Oak left.",
    "г-н Иванов и г-жа Анна Иванова",
    "réau.12@mail3.example.com###",
]


def run(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    out = S.masked(docs, key=key)
    assert out.columns == [*docs.columns, "n_entities"]
    rows = out.collect()
    assert len(rows) == len(texts)
    return {r.doc_id: r for r in rows}


@pytest.fixture(scope="module")
def got(spark):
    return run(spark, TEXTS + TEXTS[3:5])


def test_texts_without_entities_stay(got):
    for i in (0, 1, 2):
        assert got[i].text == TEXTS[i] and got[i].n_entities == 0


def test_format_and_coreference(got):
    a, b = re.fullmatch(r"Write to (\S+) or (\S+)\.", got[3].text).groups()
    assert b == a.upper() and a.endswith(".com") and re.fullmatch(r"[a-z]{4}\.[a-z]{3}\+[a-z]@[a-z]{4}\d\.[a-z]{7}\.com", a)
    p = re.fullmatch(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) now, or (\(\d{3}\) \d{3}-\d{4}), or (\d{3}-\d{3}-\d{4})\.", got[4].text).groups()
    assert "".join(re.findall(r"\d", p[1])) == "".join(re.findall(r"\d", p[2])) != "0175557713"
    c = re.fullmatch(r"Card (\d{4} \d{4} \d{4} \d{4}) or (\d{16}), not (\d{16})\.", got[5].text).groups()
    assert c[0].replace(" ", "") == c[1] and valid(c[1]) and not valid(c[2])
    assert re.fullmatch(r"Host (\d+\.){3}\d+\. SSN \d{3}-\d\d-\d{4}\.", got[6].text)
    i = re.fullmatch(r"IBAN (DE\d\d(?: \d{4}){4} \d\d) and (DE\d{20}), bad (DE\d\d .*)", got[7].text).groups()
    assert i[0].replace(" ", "") == i[1] and iban(i[1]) and not iban(i[2].replace(" ", ""))
    assert re.fullmatch(r"[a-z]{4}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com###", got[10].text)
    assert got[11].text == got[3].text and got[12].text == got[4].text


def valid(number):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(number))) % 10 == 0


def iban(number):
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def test_names_by_part_gender_and_script(got):
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) and Mr (\w+); Dr\. (\w+) (\w+) too\. Mrs\. (\w+) (\w+) left\.", got[8].text)
    john, smith, smith2, smith3, robin, oak, anna, oak2 = m.groups()
    assert smith == smith2 and smith3 == smith.upper() and oak == oak2 != smith and smith != "Smith"
    assert john.lower() in S.GIVEN["given_m", "latin"] and anna.lower() in S.GIVEN["given_f", "latin"]
    assert robin.lower() in S.GIVEN["given", "latin"] or robin.endswith(("i", "ey", "e"))
    assert re.fullmatch(r"г-н [А-Я][а-я]+ и г-жа [А-Я][а-я]+ [А-Я][а-я]+", got[9].text) and "Иванов" not in got[9].text


def test_nothing_of_an_entity_is_left_and_keys_matter(spark, got):
    for i, gone in {3: ["Anna.Lee", "ANNA.LEE"], 4: ["555-7713"], 5: ["4111", "9807915762804490"], 6: ["97.51.17.173", "123-45-6789"], 8: ["John", "Smith", "Oak"]}.items():
        assert not any(g in got[i].text for g in gone)
    other = run(spark, TEXTS, key="another")
    assert all(other[i].text != got[i].text for i in range(3, 11))
    assert all(r.n_chars == len(r.text or "") for r in got.values())


def test_collisions_are_drawn_again(spark):
    texts = [f"Mr. {chr(65 + i % 26)}{chr(97 + i // 26)}el X{i and ''}y" for i in range(60)] + [f"Mr. {n.title()} Oy" for n in S.GIVEN["given_m", "latin"]]
    rows = run(spark, texts)
    pairs = {(t.split()[1], rows[i].text.split()[1]) for i, t in enumerate(texts)}
    originals, new = {a for a, _ in pairs}, {b for _, b in pairs}
    assert len(pairs) == len(originals) == len(new) and not originals & new


def test_long_text_and_empty_table(spark):
    text = " ".join(f"a{i}@b.example.com and" for i in range(3000)) + " x" * 50_000
    rows = run(spark, [text])
    assert rows[0].n_entities == 3000
    mails = re.findall(r"\S+@\S+", rows[0].text)
    assert len(set(mails)) == 3000 and not set(mails) & set(re.findall(r"\S+@\S+", text))
    assert run(spark, []) == {}


def test_native(spark):
    docs = spark.createDataFrame([(1, "x@y.example.com")], "doc_id BIGINT, text STRING")
    plan = S.masked(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def entities(spark, kind, norms):
    return spark.createDataFrame([(kind, n) for n in norms], "kind STRING, norm STRING")


def distinct(spark, kind, norms):
    got = S.distinct_surrogates(entities(spark, kind, norms), "k").collect()
    new = [r.surrogate for r in got]
    assert sorted(r.norm for r in got) == sorted(norms)
    assert len(set(new)) == len(norms) and not set(new) & set(norms)
    return new


def test_full_forms(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = distinct(spark, "email", [f"{a}@{b}.com" for a in letters[:20] for b in letters])
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.com", m) for m in mails)
    phones = distinct(spark, "phone", [f"+5/5{i:04}" for i in range(5000)])
    assert all(re.fullmatch(r"\+5/5[0-9]{4}", p) for p in phones)
    with pytest.raises(ValueError, match="no free surrogates"):
        S.distinct_surrogates(entities(spark, "phone", [f"/{i:04}" for i in range(5001)]), "k")


def test_names_grow_with_the_attempts(spark):
    rows = entities(spark, "surname", ["smith"]).selectExpr("kind", "norm", "explode(sequence(4, 24)) AS attempt")
    made = rows.select(S.surrogate(S.F.col("kind"), S.F.col("norm"), S.F.col("attempt"), "k").alias("s")).collect()
    assert all(len(r.s) >= 3 * (4 + i) for i, r in enumerate(made)) and len(made) == 21


def test_whole_names(spark):
    texts = [
        "Mrs. Anna Maria Schmidt, Mr. J. Smith, Dr. Martin L. King and Prof. Dr. von Braun.",
        "Smith came late. My name is John Miller. Miller, not Millers; I met Mr. Smith's aunt, Mrs. O'Neil-Bond; O'Neil-Bond left.",
        "Mr. Smith She said so. Mr. Smith Dr. Jones. JONES",
        "Smith is a common word here, and Braun too.",
        "Frau Dr. Anna-Lena Müller; Müller. Ich heiße Jonas. Jonas",
        "Mr. Smith@x.example.com Smith.lee@x.example.com Smith",
    ]
    got = run(spark, texts)
    word = r"([A-Z][a-z]+)"
    m = re.fullmatch(rf"Mrs\. {word} {word} {word}, Mr\. ([A-Z])\. {word}, Dr\. {word} ([A-Z])\. {word} and Prof\. Dr\. von {word}\.", got[0].text)
    assert m and not {"Anna", "Maria", "Schmidt", "Smith", "Martin", "King", "Braun"} & set(m.groups()) and m[4] != "J" and m[7] != "L" and m[4] != m[7]
    assert got[0].n_entities == 7
    smith = m[5]
    m = re.fullmatch(rf"{word} came late\. My name is {word} {word}\. {word}, not Millers; I met Mr\. {word}'s aunt, Mrs\. {word}; {word} left\.", got[1].text)
    assert m[1] == m[5] == smith and m[3] == m[4] != "Miller" and m[6] == m[7] and m[2] != "John"
    m = re.fullmatch(rf"Mr\. {word} She said so\. Mr\. {word} Dr\. {word}\. ([A-Z]+)", got[2].text)
    assert m[1] == m[2] == smith and m[3].upper() == m[4] != "JONES"
    assert got[3].text == texts[3] and got[3].n_entities == 0
    m = re.fullmatch(rf"Frau Dr\. {word} {word}; {word}\. Ich heiße {word}\. {word}", got[4].text)
    assert m[2] == m[3] and m[4] == m[5] != "Jonas"
    # A mail address is no name, so the word alone is none either.
    assert re.fullmatch(r"Mr\. [a-z]{5}@[a-z]\.[a-z]{7}\.com [a-z]{5}\.[a-z]{3}@[a-z]\.[a-z]{7}\.com Smith", got[5].text) and got[5].n_entities == 2


def test_phones_with_spaces_and_ipv6(spark):
    texts = [
        "Call 555 123 4567, 01 23 45 67 89 or 0171 5557713; 555-123-4567.",
        "Host 2001:db8:0:0:0:ff00:42:8329, fe80::1ff:fe23:4567:890a or FE80::1FF:FE23:4567:890A.",
        "At 12:30:45, x[10::2], std::min, 00:1a:2b:3c:4d:5e, 1 234 567 890, 2024 2025 2026, face::off",
    ]
    got = run(spark, texts)
    m = re.fullmatch(r"Call (\d{3} \d{3} \d{4}), (\d\d(?: \d\d){4}) or (\d{4} \d{7}); (\d{3}-\d{3}-\d{4})\.", got[0].text)
    assert m[1].replace(" ", "") == m[4].replace("-", "") != "5551234567" and m[2] != "01 23 45 67 89" and m[3] != "0171 5557713"
    h = r"[0-9a-f]"
    m = re.fullmatch(rf"Host ({h}{{4}}:{h}{{3}}:{h}:{h}:{h}:{h}{{4}}:{h}{{2}}:{h}{{4}}), ({h}{{4}}::{h}{{3}}:{h}{{4}}:{h}{{4}}:{h}{{4}}) or (\S+)\.", got[1].text)
    assert m[2].upper() == m[3] != "FE80::1FF:FE23:4567:890A"
    assert got[2].text == texts[2] and got[2].n_entities == 0


def test_phones_followed_by_other_numbers(spark):
    """A match of 20 digits and more: the number of its surrogates is beyond a long."""
    texts = [
        "Call +1 (017) 555-7713 4802 1234 5678 now",
        "Call +1 (0171) 5557 7713 4802 1234 5678, not +1 (0171) 5557 7713 4802 1234 5679",
        "Call +1 (017) 555-7713 now",
    ]
    got = run(spark, texts)
    a = re.fullmatch(r"Call (\+1 \(\d{3}\) \d{3}-\d{4} \d{4} \d{4} \d{4}) now", got[0].text)[1]
    b, c = re.fullmatch(r"Call (\+1 \(\d{4}\)(?: \d{4}){5}), not (\+1 \(\d{4}\)(?: \d{4}){5})", got[1].text).groups()
    assert a not in texts[0] and b not in texts[1] and c not in texts[1] and b != c
    assert [got[i].n_entities for i in range(3)] == [1, 2, 1] and re.fullmatch(r"Call \+1 \(\d{3}\) \d{3}-\d{4} now", got[2].text)


def test_clashing_columns(spark):
    columns = "_found STRING, n_entities STRING, _text_id INT, text STRING, _row INT, _tail INT, kind STRING, nth INT, _text STRING"
    docs = spark.createDataFrame([("f", "n", 1, "Mr. Smith. Smith", 2, 3, "k", 4, "t"), ("f", "n", 1, None, 2, 3, "k", 4, "t")], columns)
    out = S.masked(docs)
    assert out.columns == ["_found", "_text_id", "text", "_row", "_tail", "kind", "nth", "_text", "n_entities"]
    a, b = sorted(out.collect(), key=lambda r: r.n_entities)
    assert (a.text, a.n_entities, b.n_entities) == (None, 0, 2) and "Smith" not in b.text
    assert all((r._found, r._text_id, r._row, r._tail, r.kind, r.nth, r["_text"]) == ("f", 1, 2, 3, "k", 4, "t") for r in (a, b))
