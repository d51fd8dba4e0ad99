import random
import zlib

import pytest

from tidemark.llm import langid, pii

WORDS = {
    "en": "the of and to in is that it was for on are with as his they at be this from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "xx": "qua zzor vlex thrummp oklo wibb yorr".split(),
}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for i in range(600):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 60))), lang, "x"))
    return out


def test_languages_of_held_out_documents(spark, rows):
    df = spark.createDataFrame([*rows, (600, None, "en", "x"), (601, "123 -- 4", "en", "x"), (602, "", None, "x"), (None, "the of and to", None, "x"), rows[0]], "doc_id bigint, text string, lang string, score string")
    got = langid.identify(df).toPandas()
    assert len(got) == 605 and got.score.between(0, 1).all()
    by_id = got.drop_duplicates("doc_id").set_index("doc_id")
    assert all(by_id.held_out[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(600))
    assert [by_id.lang_pred[i] for i in (600, 601, 602)] == ["und"] * 3
    held = [(by_id.lang_pred[i], lang) for i, _, lang, _ in rows if by_id.held_out[i]]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_nothing_to_learn_from(spark, corpus):
    assert langid.identify(corpus([])).count() == 0
    df = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert langid.identify(df).first().lang_pred == "und"


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


TEXTS = [
    "pay 4485275742308327, 4485-2757-4230-8327 or 4485 2757 4230 8327; not 4485275742308328 nor 123456789012345678901",
    "amex 3782 822463 10005 and 378282246310005", "born 1987-03-12 = 12.03.1987 = 1987/03/12, never 1987-02-30, 1899-01-01 or 31.02.2000",
    "ip 152.143.123.131 and 10.0.0.1, not 999.1.1.1 nor 1.2.3.4.5", "call +1 (663) 555-6869, 663-555-6869 or +1 663.555.6869; (063) 155-6869, not 63-555-6869", "mail Jo.Hein+19@mail5.example.com!", "two: 4485275742308327 4485275742308327", None, "", "plain text", "1987-03-12",
]


@pytest.fixture(scope="module")
def changed(corpus):
    return {r.doc_id: r for r in pii.pseudonyms(corpus(TEXTS)).collect()}


def test_values_keep_their_format_and_stay_linked(changed):
    import re

    cards = re.findall(r"[0-9][0-9 -]{14,}[0-9]", changed[0].text)
    assert changed[0].n_card == 3 and "4485275742308328" in changed[0].text and "123456789012345678901" in changed[0].text
    a, b, c = (re.sub("[^0-9]", "", x) for x in re.findall(r"\b(?:\d{16}|\d{4}(?:-\d{4}){3}|\d{4}(?: \d{4}){3})\b", changed[0].text)[:3])
    assert a == b == c != "4485275742308327" and luhn_ok(a) and cards
    assert len(set(changed[6].text.split()[1:])) == 1 and changed[6].text.split()[1] == a
    assert changed[1].n_card == 2 and luhn_ok(re.sub("[^0-9]", "", changed[1].text.split(" and ")[1]))
    y, m, d = re.search(r"born (\d{4})-(\d\d)-(\d\d)", changed[2].text).groups()
    assert f"{d}.{m}.{y}" in changed[2].text and f"{y}/{m}/{d}" in changed[2].text and changed[2].n_date == 3 and changed[10].text == f"{y}-{m}-{d}"
    assert "1987-02-30, 1899-01-01 or 31.02.2000" in changed[2].text
    assert changed[3].n_address == 2 and "999.1.1.1 nor 1.2.3.4.5" in changed[3].text
    assert changed[4].n_phone == 4 and "not 63-555-6869" in changed[4].text and "(063) 155-6869" not in changed[4].text
    assert re.fullmatch(r"mail [A-Z][a-z]\.[A-Z][a-z]{3}\+\d\d@mail5\.example\.com!", changed[5].text)
    assert changed[7].text is None and changed[8].text == "" and changed[9].text == "plain text"


def test_the_key_turns_values_back(spark, changed):
    df = spark.createDataFrame([(i, r.text) for i, r in changed.items()], "doc_id bigint, text string")
    back = {r.doc_id: r.text for r in pii.pseudonyms(df, forward=False).collect()}
    assert back == dict(enumerate(TEXTS))
    wrong = {r.doc_id: r.text for r in pii.pseudonyms(df, key="another", forward=False).collect()}
    assert wrong[0] != TEXTS[0]


def test_dates_are_permuted(spark):
    n = 3000
    df = spark.sql(f"SELECT id AS doc_id, cast(date_add(DATE '1950-01-01', CAST(id AS INT)) AS string) AS text FROM range({n})")
    got = [r.text for r in pii.pseudonyms(df).collect()]
    assert len(set(got)) == n and min(got) >= "1900-01-01" and max(got) <= "2099-08-04"


def test_main_path_is_native(corpus):
    plan = pii.pseudonyms(corpus(TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert pii.pseudonyms(corpus([])).count() == 0
